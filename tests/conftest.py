import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sparkloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false",
        spark_checkpoint_dir=str(root / "shared"), spark_sql_warehouse_dir=str(root / "warehouse"),
        spark_driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
