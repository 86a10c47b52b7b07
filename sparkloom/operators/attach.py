"""Bring per-group figures back to the rows they were computed from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import materialise


#: Rows that a table sent to every executor has at most. A file of few megabytes may hold millions.
BROADCAST_ROWS = 100_000


def shuffled_if_many(stored: DataFrame) -> DataFrame:
    """A stored frame to join with, which is not sent to every executor where it has many rows, however small its file."""
    return stored.hint("merge") if stored.count() > BROADCAST_ROWS else stored


def attach(df: DataFrame, stats: DataFrame, key: Sequence[str], name: str, stored: bool = True) -> DataFrame:
    """Add the non-key columns of ``stats`` (one row per key) to ``df`` as the struct ``name``.

    Without a key ``stats`` is a single row and comes in as a scalar subquery, so
    no join happens at all. With a key the figures are first written to the
    shared folder: they are computed once, and their rows are counted, so they
    are broadcast when they are few and both sides shuffled (with skew splitting)
    when they are not. ``stored=False`` takes ``stats`` as it is, for frames that
    are themselves small or stored.
    """
    key = list(key)
    figures = F.struct(*[F.col(c) for c in stats.columns if c not in key])
    if not key:
        return df.withColumn(name, stats.select(figures).scalar())
    renamed = stats.select(*[F.col(k).alias(f"_{name}_{k}") for k in key], figures.alias(name))
    if stored:
        renamed = shuffled_if_many(materialise(renamed, "figures"))
    condition = None
    for k in key:
        same = F.col(k).eqNullSafe(F.col(f"_{name}_{k}"))
        condition = same if condition is None else condition & same
    return df.join(renamed, condition, "left").drop(*[f"_{name}_{k}" for k in key])
