"""Sorting, top-k and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def order_columns(order: Sequence[tuple[str, str]]) -> list[Column]:
    return [F.desc(c) if direction == "desc" else F.asc(c) for c, direction in order]


def sort_by(df: DataFrame, order: Sequence[tuple[str, str]]) -> DataFrame:
    """Sort on several keys, each ``asc`` or ``desc``."""
    return df.orderBy(*order_columns(order))


def top_k(df: DataFrame, order: Sequence[tuple[str, str]], k: int) -> DataFrame:
    """First k rows of the order; every task keeps k candidates only."""
    return sort_by(df, order).limit(k)


def page(df: DataFrame, ts: str, tie: str, limit: int = 100, where: Column | None = None) -> DataFrame:
    """Newest-first page of the matching rows."""
    return top_k(df if where is None else df.where(where), [(ts, "desc"), (tie, "desc")], limit)


def most_common(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value, the smallest one on a tie."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return top_k(counted, [("count", "desc"), (column, "asc")], 1)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union without duplicates; each side is reduced before they meet."""
    return a.distinct().unionByName(b.distinct()).distinct()


def distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()
