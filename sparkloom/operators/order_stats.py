"""Exact order statistics that never sort or hold a whole group in one task.

1. values fall into logarithmic bins; the running count over a key's bins tells
   which bin holds each wanted rank;
2. a bin that holds many rows is cut into parts of equal width and counted again,
   and while a part still holds many, it is cut at values picked by a mergeable
   sketch of its own rows; each is one map-side combined pass;
3. only the rows of the bins or parts that hold the ranks, slivers of the group,
   are collapsed to (value, count) and put in order.

What one pass finds is a few rows per key. It is written to the shared folder,
so the next pass joins it by its real size and no pass is ever run twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialise
from .attach import attach

SKETCH_ACCURACY = 10_000
BINS_PER_DOUBLING = 256
PARTS = 65_536
#: Rows of one key and rank that are put in order by one task; more are narrowed down first.
ORDERED_ROWS = 100_000
#: Parts that a pass of the last resort cuts a crowded part into, and the accuracy of its sketch.
SPLITTERS = 64
SPLITTER_ACCURACY = 2_000

#: maps the row count of a key to the wanted 0-based rank
Rank = Callable[[Column], Column]


def below_position(p: float) -> Rank:
    return lambda n: F.floor((n - 1) * F.lit(float(p)))


def above_position(p: float) -> Rank:
    return lambda n: F.ceil((n - 1) * F.lit(float(p)))


def last_of_fraction(fraction: float) -> Rank:
    """Rank of the last of the first ``floor(fraction * n)`` rows, -1 when there is none."""
    return lambda n: F.floor(n * F.lit(float(fraction))) - 1


def _log_bin(value: Column) -> Column:
    """Never falls when the value rises, whatever its size or sign."""
    size = F.log2(1 + F.abs(value)) * BINS_PER_DOUBLING
    return (F.signum(value) * F.floor(size)).cast("bigint")


def _part(value: Column, lo: Column, hi: Column) -> Column:
    place = F.when(hi > lo, (value - lo) / (hi - lo) * PARTS).otherwise(F.lit(0.0))
    return F.floor(place).cast("bigint")


def _running(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Add ``_before`` and ``_end``: rows of the group ahead of this bin, and up to its end."""
    ordered = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_end", F.sum("_n").over(ordered)).withColumn("_before", F.col("_end") - F.col("_n"))


def _same_key(key: Sequence[str]) -> list[Column]:
    return [F.col(f"b.{k}").eqNullSafe(F.col(f"t.{k}")) for k in key]


_NODE = ["n", "bin", "lo", "hi", "before", "rows", "ranks"]


def _with_ranks(placed: DataFrame, ranks: Column, before: Column, end: Column) -> DataFrame:
    """The rows that hold a wanted rank, ``ranks`` (array of i and rank) cut down to those that they hold."""
    here = F.filter(ranks, lambda r: (r["rank"] >= before) & (r["rank"] < end))
    return placed.withColumn("_ranks", here).where(F.size("_ranks") > 0)


def _rows_in(base: DataFrame, nodes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of ``base`` that lie in a node, with the node's columns."""
    condition = (F.col("b._bin") == F.col("t.bin")) & F.col("b._x").between(F.col("t.lo"), F.col("t.hi"))
    for same in _same_key(key):
        condition = condition & same
    return base.alias("b").join(nodes.alias("t"), condition).select("b._v", "b._x", *[F.col(f"t.{c}") for c in nodes.columns])


def _narrowed(base: DataFrame, nodes: DataFrame, key: Sequence[str], sampled: bool) -> DataFrame:
    """Each node cut into parts; the parts that hold a wanted rank.

    Parts are spans of equal width, or lie between values picked by a mergeable
    sketch of the node's rows. Each picked value is a part of its own, so a value
    that most rows share is set apart and what is left of the node falls to a
    ``SPLITTERS``-th, however the values are spread.
    """
    node = [*key, *_NODE]
    if sampled:
        at = [i / SPLITTERS for i in range(1, SPLITTERS)]
        picked = _rows_in(base, nodes, key).groupBy(*key, "bin", "lo").agg(
            F.array_sort(F.array_distinct(F.percentile_approx("_x", at, SPLITTER_ACCURACY))).alias("cuts"))
        nodes = attach(nodes, picked, [*key, "bin", "lo"], "_picked").withColumn("cuts", F.col("_picked.cuts")).drop("_picked")
        node = [*node, "cuts"]
        part = F.size(F.filter("cuts", lambda c: c < F.col("_x"))) * 2 + F.array_contains("cuts", F.col("_x")).cast("int")
    else:
        part = _part(F.col("_x"), F.col("lo"), F.col("hi"))
    parts = _rows_in(base, nodes, key).withColumn("_part", part).groupBy(*node, "_part").agg(
        F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    begin, end = F.col("before") + F.col("_before"), F.col("before") + F.col("_end")
    return _with_ranks(_running(parts, [*key, "bin", "lo"], "_part"), F.col("ranks"), begin, end).select(
        *key, "n", "bin", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), begin.alias("before"), F.col("_n").alias("rows"),
        F.col("_ranks").alias("ranks"))


def order_statistics(df: DataFrame, value: str, ranks: Sequence[Rank], key: Sequence[str] = (),
                     ordered_rows: int = ORDERED_ROWS) -> DataFrame:
    """One row per key: ``n`` and per rank its ``value_i``, ``before_i``, the number of smaller values, and ``same_i``, that of equal ones.

    Missing values (and not-a-number) are left out of the count. A key none of
    whose ranks exists has no row. Groups of more than ``ordered_rows`` rows are
    narrowed, those of one value excepted.
    """
    key = list(key)
    base = df.select(*key, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    if isinstance(base.schema["_v"].dataType, (T.DoubleType, T.FloatType)):
        base = base.where(~F.isnan("_v"))
    base = base.withColumn("_x", F.col("_v").cast("double")).withColumn("_bin", _log_bin(F.col("_x")))

    # which logarithmic bin holds each rank
    bins = base.groupBy(*key, "_bin").agg(F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    placed = _running(bins, key, "_bin").withColumn("n", F.sum("_n").over(Window.partitionBy(*key)))
    asked = F.array(*[F.struct(F.lit(i).alias("i"), r(F.col("n")).cast("bigint").alias("rank")) for i, r in enumerate(ranks)])
    nodes = materialise(_with_ranks(placed, asked, F.col("_before"), F.col("_end")).select(
        *key, "n", F.col("_bin").alias("bin"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"),
        F.col("_before").alias("before"), F.col("_n").alias("rows"), F.col("_ranks").alias("ranks")), "ranks")

    # what is still crowded is cut into parts, by equal widths first
    crowded = (F.col("rows") > ordered_rows) & (F.col("lo") < F.col("hi"))
    sampled, most = False, None
    while (now := nodes.where(crowded).agg(F.max("rows")).first()[0]) is not None:
        if sampled and most is not None and now >= most:
            break  # values that differ, but not as doubles
        most = now if sampled else None
        smaller = _narrowed(base, nodes.where(crowded), key, sampled)
        nodes, sampled = materialise(nodes.where(~crowded).unionByName(smaller), "ranks"), True

    # order the values of these slivers; equal values are one row
    values = _rows_in(base, nodes, key).groupBy(*key, *_NODE, "_v").agg(F.count("*").alias("_n"))
    begin, end = F.col("before") + F.col("_before"), F.col("before") + F.col("_end")
    found = _with_ranks(_running(values, [*key, "bin", "lo"], "_v"), F.col("ranks"), begin, end).select(
        *key, "n", "_v", begin.alias("_begin"), "_n", F.explode("_ranks").alias("r"))
    picked = []
    for i in range(len(ranks)):
        mine = F.col("r.i") == i
        picked.append(F.max(F.when(mine, F.col("_v"))).alias(f"value_{i}"))
        picked.append(F.max(F.when(mine, F.col("_begin"))).alias(f"before_{i}"))
        picked.append(F.max(F.when(mine, F.col("_n"))).alias(f"same_{i}"))
    return found.groupBy(*key, "n").agg(*picked)


def percentiles(df: DataFrame, value: str, probs: Sequence[float], key: Sequence[str] = (),
                exact: bool = True) -> DataFrame:
    """Percentiles ``p_0, p_1, ...`` per key, missing values ignored, with linear interpolation.

    ``exact=False`` answers from one mergeable sketch in a single pass instead.
    """
    key = list(key)
    if not exact:
        base = df.where(F.col(value).isNotNull()).groupBy(*key).agg(
            F.count("*").alias("n"), F.percentile_approx(value, list(probs), SKETCH_ACCURACY).alias("_q"))
        return base.select(*key, "n", *[F.col("_q")[i].cast("double").alias(f"p_{i}") for i in range(len(probs))])
    ranks = [rank for p in probs for rank in (below_position(p), above_position(p))]
    stats = order_statistics(df, value, ranks, key)

    def interpolate(i: int, p: float) -> Column:
        position = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"value_{2 * i}").cast("double"), F.col(f"value_{2 * i + 1}").cast("double")
        return lo + (hi - lo) * (position - F.floor(position))

    return stats.select(*key, "n", *[interpolate(i, p).alias(f"p_{i}") for i, p in enumerate(probs)])


def first_fraction(df: DataFrame, order: str, tie: str, fraction: float, key: Sequence[str] = (),
                   flag: str = "is_train", ordered_rows: int = ORDERED_ROWS) -> DataFrame:
    """Mark the first ``floor(fraction * n)`` rows per key in ``(order, tie)`` order.

    The cut value comes from ``order_statistics``. The rows that share it are
    numbered; where more than ``ordered_rows`` do and ``tie`` is a number or a time,
    the cut among them is found in the same way, and only rows equal in both are
    numbered.
    Missing values of ``order`` are not marked; missing ties come first.
    """
    key = list(key)
    cut = materialise(order_statistics(df, order, [last_of_fraction(fraction)], key, ordered_rows), "cut")
    most = cut.agg(F.max("same_0")).first()[0] or 0
    marked = attach(df, cut, key, "_cut", stored=False)
    tied = F.coalesce(F.col(order) == F.col("_cut.value_0"), F.lit(False))
    spare = F.floor(F.col("_cut.n") * F.lit(float(fraction))) - F.col("_cut.before_0")
    off_cut = marked.where(~tied).withColumn(flag, F.coalesce(F.col(order) < F.col("_cut.value_0"), F.lit(False))).drop("_cut")
    on_cut = marked.where(tied).withColumn("_spare", spare).drop("_cut")
    if most <= ordered_rows or not isinstance(df.schema[tie].dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType)):
        number = F.row_number().over(Window.partitionBy(*key, order).orderBy(tie))
        on_cut = on_cut.withColumn("_rn", number).withColumn(flag, F.col("_rn") <= F.col("_spare")).drop("_rn", "_spare")
        return off_cut.unionByName(on_cut)
    missing = on_cut.where(F.col(tie).isNull()).groupBy(*key).agg(F.count("*").alias("missing"))
    on_cut = attach(on_cut, missing, key, "_m").withColumn(
        "_left", F.col("_spare") - F.coalesce("_m.missing", F.lit(0))).drop("_m")
    last = order_statistics(on_cut, tie, [lambda n: F.least(F.col("_left"), n) - 1], [*key, "_left"], ordered_rows)
    on_cut = attach(on_cut, last, [*key, "_left"], "_last")
    equal = F.coalesce(F.col(tie) == F.col("_last.value_0"), F.lit(False)) | (F.col(tie).isNull() & (F.col("_left") < 0))
    sure = on_cut.where(~equal).withColumn(flag, F.col(tie).isNull() | F.coalesce(F.col(tie) < F.col("_last.value_0"), F.lit(False)))
    number = F.row_number().over(Window.partitionBy(*key, tie).orderBy(F.lit(1)))
    room = F.when(F.col(tie).isNull(), F.col("_spare")).otherwise(F.col("_left") - F.col("_last.before_0"))
    same = on_cut.where(equal).withColumn("_rn", number).withColumn(flag, F.col("_rn") <= room).drop("_rn")
    return off_cut.unionByName(sure.unionByName(same).drop("_spare", "_left", "_last"))
