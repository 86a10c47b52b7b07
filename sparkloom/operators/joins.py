"""Joins. No side is ever hinted: the optimiser broadcasts only what its size check allows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fx
from ..functions.numbers import as_col, haversine_km


def without_match(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str,
                  null_aware: bool = False) -> DataFrame:
    """Rows of ``dim`` whose key never occurs in ``fact``.

    The fact side is cut to its distinct keys first (combined before the
    shuffle), so a hot key costs one row. ``null_aware`` gives SQL ``NOT IN``:
    a single NULL key in ``fact`` empties the result.
    """
    keys = fact.select(F.col(fact_key).alias("_k")).distinct()
    unmatched = dim.join(keys.where(F.col("_k").isNotNull()), F.col(dim_key) == F.col("_k"), "left_anti")
    if not null_aware:
        return unmatched
    nulls = keys.agg(F.count_if(F.col("_k").isNull()).alias("n"))
    return unmatched.where(F.col(dim_key).isNotNull() & (nulls.scalar() == 0))


def count_by_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, label: str,
                       count_name: str = "Num") -> DataFrame:
    """Number of fact rows per dimension label, largest first; counted before the join."""
    counted = fact.where(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias("_k")).agg(
        F.count("*").alias("_n"))
    joined = counted.join(dim, F.col("_k") == F.col(dim_key))
    return (joined.groupBy(label).agg(F.sum("_n").alias(count_name))
            .orderBy(F.desc(count_name), F.desc(label)))


def mean_of_two_sides(df: DataFrame, left_key: str, left_value: str, right_key: str, right_value: str,
                      key: str = "airport", out: str = "taxi") -> DataFrame:
    """Mean of two per-key averages, for keys that occur on both sides, ascending.

    Both sides come out of one scan: each row counts once under either key, and
    a key needs rows of both kinds, which is what joining the averages asks for.
    """
    def side(k: str, left, right) -> Column:
        return F.struct(F.col(k).alias(key), left.cast("double").alias("_l"), right.cast("double").alias("_r"),
                        F.lit(k == left_key).alias("_is_left"))

    nothing = F.lit(None)
    both = df.select(F.inline(F.array(side(left_key, F.col(left_value), nothing),
                                      side(right_key, nothing, F.col(right_value)))))
    averaged = both.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg("_l").alias("_l"), F.avg("_r").alias("_r"),
        F.bool_or("_is_left").alias("_left"), F.bool_or(~F.col("_is_left")).alias("_right"))
    return (averaged.where("_left AND _right")
            .select(key, ((F.col("_l") + F.col("_r")) / 2).alias(out))
            .orderBy(out, key))


def share_by_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, hit,
                       labels: Sequence[str], out: str = "percentage") -> DataFrame:
    """Share of fact rows that are hits, per dimension row with at least one, highest first."""
    per_key = fact.where(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias("_k")).agg(
        F.count_if(hit).alias("_hits"), F.count("*").alias("_all"))
    return (per_key.where(F.col("_hits") > 0)
            .join(dim, F.col("_k") == F.col(dim_key))
            .select(*labels, (F.col("_hits") / F.col("_all")).alias(out))
            .orderBy(F.desc(out), F.desc(labels[0])))


def _split(df: DataFrame, splits: int, out: str) -> DataFrame:
    """Each row ``splits`` times, numbered from 0.

    By a join: the size that the optimiser expects of it grows with ``splits``, which that of ``explode`` does not. So
    what is much larger than its file is broadcast only where the shuffled rows turn out to be small.
    """
    return df.crossJoin(df.sparkSession.range(splits).withColumnRenamed("id", out))


def lookup(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner",
           salt: int = 1) -> DataFrame:
    """Attach dimension columns to facts.

    When the dimension is too large to broadcast and fact keys are hot, ``salt``
    splits every fact key over that many tasks and repeats each dimension row
    once per split; the rows returned are the same. That holds for joins that
    return no unmatched dimension row, so others are refused.
    """
    on = [on] if isinstance(on, str) else list(on)
    if salt <= 1:
        return fact.join(dim, on, how)
    if how.lower().replace("_", "") not in ("inner", "left", "leftouter", "leftsemi", "leftanti", "semi", "anti"):
        raise ValueError(f"a {how} join cannot be salted: unmatched dimension rows would come once per split")
    others = [F.col(c) for c in fact.columns if c not in on] or [F.lit(0)]
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(salt)))
    return salted.join(_split(dim, salt, "_salt"), [*on, "_salt"], how).drop("_salt")


def reattach(part: DataFrame, source: DataFrame, row_id: str, columns: Sequence[str]) -> DataFrame:
    """Bring source attributes back to a subset of its rows by an explicit row id."""
    return part.join(source.select(row_id, *columns), row_id)


def _unit_cell(lat, lon, cell_km: float, axis: str):
    phi, lam = F.radians(as_col(lat)), F.radians(as_col(lon))
    position = {"x": F.cos(phi) * F.cos(lam), "y": F.cos(phi) * F.sin(lam), "z": F.sin(phi)}[axis]
    return F.floor(position * (fx.EARTH_RADIUS_KM / cell_km))


def within_km(a: DataFrame, b: DataFrame, km: float, a_id: str, b_id: str, a_pos=("lat", "lon"),
              b_pos=("lat", "lon"), salt: int = 1) -> DataFrame:
    """Pairs of a-row and b-row ids no further than ``km`` apart, with their distance.

    Points go into cubes of edge ``km`` in earth-centred space (a chord is never
    longer than its arc, so a partner is in the same or a touching cube, also at
    the poles and the date line). The join is an equi-join on the cube; ``salt``
    splits crowded cubes of ``a`` over several tasks.
    """
    axes = ("x", "y", "z")
    left = a.select(F.col(a_id).alias("a_id"), F.col(a_pos[0]).alias("a_lat"), F.col(a_pos[1]).alias("a_lon"),
                    *[_unit_cell(a_pos[0], a_pos[1], km, ax).alias(f"_{ax}") for ax in axes])
    left = left.withColumn("_salt", F.pmod(F.xxhash64("a_id"), F.lit(salt)))
    right = b.select(F.col(b_id).alias("b_id"), F.col(b_pos[0]).alias("b_lat"), F.col(b_pos[1]).alias("b_lon"),
                     *[_unit_cell(b_pos[0], b_pos[1], km, ax).alias(f"_{ax}") for ax in axes])
    # a touching cube is one step or none away on each axis
    right = _split(right, 27 * salt, "_n").withColumns(
        {f"_{ax}": F.col(f"_{ax}") + F.floor(F.col("_n") / 3 ** i).cast("bigint") % 3 - 1 for i, ax in enumerate(axes)})
    right = right.withColumn("_salt", F.floor(F.col("_n") / 27).cast("bigint")).drop("_n")
    distance = haversine_km("a_lat", "a_lon", "b_lat", "b_lon")
    return (left.join(right, ["_x", "_y", "_z", "_salt"])
            .withColumn("distance_km", distance)
            .where(F.col("distance_km") <= km)
            .select("a_id", "b_id", "distance_km"))
