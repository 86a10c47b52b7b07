"""Row-history features per key.

A window over a whole key would put one key's rows into one task. Here a key is
cut into runs of consecutive time slots with a bounded number of rows; each run
also receives the last rows of its predecessors, as many as the deepest frame
looks back. The window then runs per (key, run), gives the same values, and a
hot key spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..session import materialise
from .attach import attach, shuffled_if_many
from .cleaning import last_hours

SLOT_SECONDS = 3600
RUN_ROWS = 1_000_000
MAX_PIECES = 1 << 20


def with_lookback(df: DataFrame, key: Sequence[str], ts: str, depth: int, tie: str,
                  slot_seconds: int = SLOT_SECONDS, run_rows: int = RUN_ROWS) -> DataFrame:
    """Add ``_run`` and ``_halo``: every row once with ``_halo = false``, plus the rows a later run looks back on."""
    if run_rows < depth:
        raise ValueError("a run must be able to hold the rows it hands on")
    key = list(key)
    micros, slot_micros = F.unix_micros(F.col(ts).cast("timestamp")), slot_seconds * 1_000_000
    busy = materialise(df.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > run_rows), "busy-keys")
    if busy.isEmpty():
        return df.withColumns({"_run": F.lit(0).cast("bigint"), "_halo": F.lit(False)})
    busy = shuffled_if_many(busy)

    def of_busy(rows: DataFrame) -> DataFrame:
        return attach(rows, busy, key, "_b", stored=False).where(F.col("_b").isNotNull()).drop("_b")

    slotted = df.withColumn("_slot", F.floor(micros / slot_micros).cast("bigint"))
    # one row per busy key and slot: bounded by the time span, whatever the row count
    sizes = materialise(of_busy(slotted).groupBy(*key, "_slot").agg(
        F.count("*").alias("_n"), F.min(micros).alias("first"), F.max(micros).alias("last")), "slot-sizes")
    crowded = sizes.where(F.col("_n") > run_rows).select(
        *key, "_slot", "first", "last", F.ceil(F.col("_n") / run_rows).alias("pieces"))
    if not crowded.isEmpty():
        # a slot that is too much for one run is cut into shorter ones, over the time its rows really span
        place = (micros - F.col("_c.first")) / (F.col("_c.last") - F.col("_c.first") + 1)
        piece = F.coalesce(F.floor(place * F.col("_c.pieces")), F.lit(0)).cast("bigint")
        slotted = attach(slotted, crowded, [*key, "_slot"], "_c", stored=False).withColumn(
            "_slot", F.col("_slot") * MAX_PIECES + F.least(piece, F.lit(MAX_PIECES - 1))).drop("_c")
        sizes = of_busy(slotted).groupBy(*key, "_slot").agg(F.count("*").alias("_n"))
    in_time = Window.partitionBy(*key).orderBy("_slot")
    slots = (sizes.select(*key, "_slot", "_n")
             .withColumn("_end", F.sum("_n").over(in_time.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("_run", F.floor((F.col("_end") - F.col("_n")) / run_rows))
             .withColumn("_next", F.lead("_run").over(in_time))
             .withColumn("_opens", F.when(F.col("_next") != F.col("_run"), F.col("_next"))))
    # a run opening at row s needs rows [s - depth, s): all slots that end in (s - depth, s]
    reach = Window.partitionBy(*key).orderBy("_end").rangeBetween(0, max(depth - 1, 0))
    slots = slots.withColumn("_feeds", F.array_distinct(F.collect_list("_opens").over(reach)))
    slots = materialise(slots.select(*key, "_slot", "_run", "_feeds"), "slots")

    own = attach(slotted, shuffled_if_many(slots).select(*key, "_slot", "_run"), [*key, "_slot"], "_s", stored=False)
    own = own.withColumns({"_run": F.coalesce("_s._run", F.lit(0).cast("bigint")), "_halo": F.lit(False)}).drop("_s", "_slot")

    feeding = shuffled_if_many(slots.where(F.size("_feeds") > 0).select(*key, "_slot", "_feeds"))
    newest_first = Window.partitionBy(*key, "_slot").orderBy(F.desc(ts), F.desc(tie))
    lent = attach(slotted, feeding, [*key, "_slot"], "_s", stored=False).where(F.col("_s._feeds").isNotNull())
    lent = (lent.withColumn("_rn", F.row_number().over(newest_first)).where(F.col("_rn") <= depth)
            .withColumn("_run", F.explode("_s._feeds")).withColumn("_halo", F.lit(True))
            .drop("_s", "_slot", "_rn"))
    return own.unionByName(lent)


def over_history(df: DataFrame, key: Sequence[str], ts: str, tie: str, depth: int,
                 columns: Callable[[WindowSpec], dict[str, Column]], **sizing) -> DataFrame:
    """Add columns computed over an ordered per-key window that looks back at most ``depth`` rows."""
    runs = with_lookback(df, key, ts, depth, tie, **sizing)
    ordered = Window.partitionBy(*key, "_run").orderBy(ts, tie)
    return runs.withColumns(columns(ordered)).where(~F.col("_halo")).drop("_run", "_halo")


def _lag_columns(ordered: WindowSpec, column: str, steps: Sequence[int], prefix: str) -> dict[str, Column]:
    return {f"{prefix}_lag_{n}": F.lag(column, n).over(ordered) for n in steps}


def _rolling_columns(ordered: WindowSpec, column: str, widths: Sequence[int], prefix: str,
                     with_std: bool = True) -> dict[str, Column]:
    out = {}
    for n in widths:
        frame = ordered.rowsBetween(-(n - 1), 0)
        full = F.count(column).over(frame) == n
        out[f"{prefix}_mean_{n}"] = F.when(full, F.avg(column).over(frame))
        if with_std:
            out[f"{prefix}_std_{n}"] = F.when(full, F.stddev_samp(column).over(frame))
    return out


def _diff_columns(ordered: WindowSpec, column: str, steps: Sequence[int], prefix: str) -> dict[str, Column]:
    return {f"{prefix}_diff_{n}": F.col(column) - F.lag(column, n).over(ordered) for n in steps}


def lags(df: DataFrame, key: Sequence[str], ts: str, tie: str, column: str, steps: Sequence[int],
         prefix: str = "temp", **sizing) -> DataFrame:
    """Values 1, 2, ... rows earlier within the key."""
    return over_history(df, key, ts, tie, max(steps), lambda w: _lag_columns(w, column, steps, prefix), **sizing)


def rolling(df: DataFrame, key: Sequence[str], ts: str, tie: str, column: str, widths: Sequence[int],
            prefix: str = "temp", with_std: bool = True, **sizing) -> DataFrame:
    """Mean and sample deviation of the last n rows including the current one; NULL until n rows are there."""
    return over_history(df, key, ts, tie, max(widths) - 1,
                        lambda w: _rolling_columns(w, column, widths, prefix, with_std), **sizing)


def diffs(df: DataFrame, key: Sequence[str], ts: str, tie: str, column: str, steps: Sequence[int],
          prefix: str = "temp", **sizing) -> DataFrame:
    """Change against the value n rows earlier."""
    return over_history(df, key, ts, tie, max(steps), lambda w: _diff_columns(w, column, steps, prefix), **sizing)


def history_features(df: DataFrame, key: Sequence[str], ts: str, tie: str, column: str, lag_steps, widths,
                     diff_steps, second: str | None = None, with_std: bool = True, **sizing) -> DataFrame:
    """Lags, rolling figures and differences of one column (and lag 1 of a second) from a single pass."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        out = {**_lag_columns(w, column, lag_steps, "temp"),
               **_rolling_columns(w, column, widths, "temp_rolling", with_std),
               **_diff_columns(w, column, diff_steps, "temp")}
        if second:
            out["humidity_lag_1"] = F.lag(second, 1).over(w)
        return out

    depth = max([*lag_steps, *[n - 1 for n in widths], *(diff_steps or [0])])
    return over_history(df, key, ts, tie, depth, columns, **sizing)


def latest_n(df: DataFrame, key: Sequence[str], ts: str, tie: str, n: int, rank: str | None = None) -> DataFrame:
    """The newest n rows per key. Spark limits each map task to n rows per key before the shuffle."""
    newest_first = Window.partitionBy(*key).orderBy(F.desc(ts), F.desc(tie))
    ranked = df.withColumn("_rn", F.row_number().over(newest_first)).where(F.col("_rn") <= n)
    return ranked.withColumnRenamed("_rn", rank) if rank else ranked.drop("_rn")


def first_per_group(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row per group in the given order."""
    return df.groupBy(key).agg(F.min_by(F.struct("*"), F.col(order)).alias("_r")).select("_r.*")


def station_stats(df: DataFrame, key: str, column: str, ts: str, tie: str, as_of, hours: int = 24,
                  limit: int | None = 100) -> DataFrame:
    """Newest value, average, extremes and points of the last hours; ``limit`` keeps the newest rows only, None all."""
    recent = last_hours(df, ts, hours, as_of)
    if limit is not None:
        recent = latest_n(recent, [key], ts, tie, limit)
    return recent.groupBy(key).agg(
        F.max_by(column, F.struct(F.col(ts), F.col(tie))).alias(f"latest_{column}"),
        F.avg(column).alias(f"avg_{column}_{hours}h"),
        F.min(column).alias(f"min_{column}_{hours}h"),
        F.max(column).alias(f"max_{column}_{hours}h"),
        F.count("*").alias(f"data_points_{hours}h"),
    )


def latest_state(df: DataFrame, key: str, ts: str, tie: str, column: str, second: str | None, lag_steps, widths,
                 default_second: float, epsilon: float, n: int = 24) -> DataFrame:
    """One row of forecast features per key out of its newest n rows.

    Lags that reach too far fall back to the newest value, rolling figures use
    what there is with the *population* deviation, differences are 0 when the
    history is too short.
    """
    kept = latest_n(df.select(key, ts, tie, column, *([second] if second else [])), [key], ts, tie, n, rank="_rn")
    rank, value = F.col("_rn"), F.col(column)

    def back(i: int) -> Column:
        """The value i rows back from the end (1 = newest), NULL when there is none."""
        return F.max(F.when(rank == i, value))

    def recent(width: int) -> Column:
        return F.when(rank <= width, value)

    out = {"last_ts": F.max(ts), "rows": F.count("*")}
    for step in lag_steps:
        out[f"temp_lag_{step}"] = F.coalesce(back(step), back(1))
    for width in widths:
        out[f"temp_rolling_mean_{width}"] = F.avg(recent(width))
        out[f"temp_rolling_std_{width}"] = F.stddev_pop(recent(width))
    out["temp_diff_1"] = F.coalesce(back(1) - back(2), F.lit(0.0))
    out["temp_diff_24"] = F.coalesce(back(1) - back(24), F.lit(0.0))
    if second:
        humidity = F.max(F.when(rank == 1, F.col(second)))
        out["humidity_lag_1"] = humidity
        out["temp_humidity_ratio"] = back(1) / (humidity + epsilon)
    else:
        out["humidity_lag_1"] = F.lit(default_second)
        out["temp_humidity_ratio"] = back(1) / default_second
    return kept.groupBy(key).agg(*[c.alias(name) for name, c in out.items()])


def trend(df: DataFrame, station: str, value, ts: str, as_of, hours: int, columns: Sequence[str]) -> DataFrame:
    """Ascending series of one station over the last hours, rows without a reading left out."""
    recent = last_hours(df.where(F.col(station) == F.lit(value)), ts, hours, as_of)
    return recent.where(F.col(columns[0]).isNotNull()).select(ts, *columns).orderBy(ts)

