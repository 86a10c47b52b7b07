"""Query registry, driver tables and the views the queries run on."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import pin_runtime_conf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: view -> (driver table, projection). The expressions read the same in Spark SQL and in the checking engine.
VIEWS: dict[str, tuple[str, list[str]]] = {
    "readings": ("events", [
        "event_id AS id",
        "CAST(user_id AS STRING) AS station_id",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "value * 0.61372917 - 30.0 AS temperature",
        "(event_id % 106) * 1.0E0 AS humidity",
        "795.0E0 + event_id % 410 AS pressure",
        "(event_id % 207) * 1.0E0 AS wind_speed",
        "(event_id % 365) * 1.0E0 AS wind_direction",
        "event_type AS weather_condition",
        "props AS metadata",
    ]),
    "http": ("events", [
        "event_id AS id",
        "CAST(ts AS TIMESTAMP) AS event_timestamp",
        "CONCAT('/p', CAST(user_id % 20 AS STRING)) AS path",
        "value AS processing_time_ms",
        "CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS status_code",
        "CASE event_type WHEN 'view' THEN 'http_request' ELSE 'http_response' END AS event_type",
    ]),
    "flights": ("lineitem", [
        "month(l_shipdate) AS Month",
        "CAST(l_linenumber AS BIGINT) AS DayOfWeek",
        "l_orderkey AS FlightNum",
        "CAST(l_linenumber AS BIGINT) AS Leg",
        "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CONCAT('N', CAST(l_partkey % 997 AS STRING)) END AS TailNum",
        "CASE WHEN l_suppkey % 40 = 7 THEN NULL ELSE CONCAT('C', CAST(l_suppkey % 60 AS STRING)) END AS UniqueCarrier",
        "CONCAT('A', CAST(l_suppkey % 30 AS STRING)) AS Origin",
        "CONCAT('A', CAST(l_partkey % 28 AS STRING)) AS Dest",
        "CAST(floor(l_quantity) AS BIGINT) - 15 AS DepDelay",
        "CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(floor(l_quantity) AS BIGINT) + l_linenumber - 20 END AS ArrDelay",
        "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_orderkey % 23 AS BIGINT) + l_linenumber END AS WeatherDelay",
        "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(l_partkey % 190 AS BIGINT) END AS CarrierDelay",
        "CAST(floor(l_extendedprice / 40) AS INT) AS Distance",
        "CAST(floor(l_extendedprice / 320) AS INT) + 20 AS CRSElapsedTime",
        "CAST(l_partkey % 24 AS INT) * 100 AS CRSDepTime",
        "CAST(l_suppkey % 24 AS INT) * 100 AS CRSArrTime",
        "l_linenumber * 2 + CAST(l_suppkey % 5 AS INT) AS TaxiIn",
        "CAST(l_partkey % 20 AS INT) + 5 AS TaxiOut",
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS Cancelled",
        "CASE WHEN l_returnflag <> 'R' THEN NULL WHEN l_linenumber % 4 = 0 THEN 'A' WHEN l_linenumber % 4 = 1 THEN 'B' "
        "WHEN l_linenumber % 4 = 2 THEN 'C' ELSE 'D' END AS CancellationCode",
    ]),
    "carriers": ("supplier", [
        "CONCAT('C', CAST(s_suppkey AS STRING)) AS Code",
        "s_name AS Description",
    ]),
    "airports": ("nation", [
        "CONCAT('A', CAST(n_nationkey AS STRING)) AS iata",
        "n_name AS airport",
        "CONCAT('City ', CAST(n_regionkey AS STRING)) AS city",
        "n_nationkey * 7.0E0 - 80.0E0 AS lat",
        "n_nationkey * 14.0E0 - 170.0E0 AS long",
    ]),
    # a wide numeric table in the shape of the measurement data: species, weight and five sizes
    "fish": ("lineitem", [
        "l_orderkey * 8 + l_linenumber AS row_id",
        "CONCAT(l_returnflag, l_linestatus) AS Species",
        "l_extendedprice / 100.0E0 AS Weight",
        "l_quantity AS Length1",
        "l_quantity * (1.0E0 + l_tax) AS Length2",
        "l_quantity * (1.2E0 + l_discount) AS Length3",
        "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_discount * 100.0E0 + l_linenumber END AS Height",
        "l_tax * 100.0E0 + (l_suppkey % 7) AS Width",
    ]),
    # weight, an estimate of it from one size, and the class each falls in
    "scored": ("orders", [
        "o_orderkey AS row_id",
        "o_orderpriority AS species",
        "o_totalprice / 100.0E0 AS actual",
        "o_totalprice * (0.8137E0 + (o_custkey % 41) * 0.0091E0) / 100.0E0 AS predicted",
        "CAST(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS BIGINT) AS label",
        "CAST(CASE WHEN o_totalprice * (0.8137E0 + (o_custkey % 41) * 0.0091E0) > 255000 THEN 1 ELSE 0 END AS BIGINT) AS called",
        "0.5E0 + (o_custkey % 49) * 0.01E0 AS confidence",
    ]),
    "jobs": ("orders", [
        "CAST(o_orderkey AS STRING) AS name",
        "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'InProgress' ELSE 'Failed' END AS status",
        "CAST(o_orderdate AS TIMESTAMP) AS creation_time",
    ]),
    "usage": ("orders", [
        "CAST(o_orderdate AS TIMESTAMP) AS day",
        "o_orderpriority AS service",
        "o_totalprice * 0.00098137219 AS cost",
        "(o_custkey % 100) * 1.0E0 AS usage",
    ]),
    # function-call rows whose JSON texts are put together from the event fields; some are left unreadable
    "calls": ("events", [
        "event_id AS id",
        "CASE WHEN event_id % 17 = 0 THEN '' ELSE CONCAT('find ', event_type) END AS query",
        "CASE WHEN event_id % 13 = 0 THEN 'not json' ELSE CONCAT('[{\"name\": \"', event_type, '\", \"description\": \"d\"}]') END AS tools",
        "CONCAT('[{\"name\": \"', event_type, '\", \"arguments\": ', props, '}]') AS answers",
        "CASE WHEN event_id % 11 = 0 THEN 'no answer' "
        "WHEN event_id % 7 = 0 THEN CONCAT('[{\"name\": \"', event_type, '\", \"arguments\": {}}]') "
        "WHEN event_id % 5 = 0 THEN CONCAT('[{\"name\": \"other\", \"arguments\": ', props, '}]') "
        "ELSE CONCAT('[{\"name\": \"', event_type, '\", \"arguments\": ', props, '}]') END AS predicted",
    ]),
}

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


class Tables:
    """Driver tables and views as attributes, read when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = pin_runtime_conf(spark)
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in VIEWS:
            table, columns = VIEWS[name]
            frame = getattr(self, table).selectExpr(*columns)
        else:
            frame = self.spark.read.parquet(table_path(self.sf_dir, name))
        setattr(self, name, frame)
        return frame

    @cached_property
    def labelled(self) -> DataFrame:
        """Texts with a 0/1 label."""
        return self.documents.join(self.labels, "doc_id").select(
            "doc_id", "text", "lang", F.col("quality").alias("label"), "toxic")


def canonical(df: DataFrame, digits: int = 4) -> DataFrame:
    """Result types every engine hashes alike: 64-bit integers, rounded doubles, text timestamps, JSON for nested values."""
    columns = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, STAMP)
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def _fill(sql: str) -> str:
    for name, (table, columns) in VIEWS.items():
        sql = sql.replace("{" + name + "}", f"(SELECT {', '.join(columns)} FROM {table})")
    return sql


def query(name: str, sql: str | None = None, digits: int = 4):
    """Register a function of ``Tables`` as a query, with the SQL that checks it."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return canonical(build(Tables(spark, sf_dir)), digits)

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _fill(sql)
        return build

    return add


def stamp(expression: str) -> str:
    """Checking-engine text of a timestamp in the canonical form."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
