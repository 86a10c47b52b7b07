"""sparkloom: data operators and jobs written as Spark DataFrame, SQL, streaming and MLlib code."""

from .session import build_session

__all__ = ["build_session"]
