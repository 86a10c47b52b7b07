"""Reset windows: a window restarts at the first event more than W after the start of the current one.

Each start depends on the one before it, so the naive way walks a whole key in
one task. Here a key's time line is cut into slots of a bounded number of event
times. A slot on its own can say, for every moment at which the incoming window
may end, which window would be open when the slot is left: its exit table, with
at most one row per event time of the slot's first W.

Exit tables of neighbouring slots compose into the table of both, of the same
bounded size. Consecutive slots are composed in groups of bounded rows, group by
group in parallel and level by level, until a key is one group. The way back
down hands each group the window that is open when it begins, and it hands one
to each of its slots, which then assign their own rows in parallel. An ordinary
key is one group at once; a busy one takes a few levels.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as fx
from ..functions.numbers import is_error
from ..session import materialise

_NEVER = np.iinfo(np.int64).min
#: Distinct event times of a slot, and exit-table rows that one task composes, at most
#: (a task takes the tables of four slots in any case, or nothing would ever join up).
SLOT_TIMES = 50_000
GROUP_ROWS = 100_000


def chain_starts(times: np.ndarray, window: int, open_start: int | None) -> np.ndarray:
    """Window start of each sorted event time, given the start that is open on entry."""
    following = np.searchsorted(times, times + window, side="right")
    starts = np.empty(len(times), dtype=np.int64)
    at = 0
    if open_start is not None:
        at = int(np.searchsorted(times, open_start + window, side="right"))
        starts[:at] = open_start
    while at < len(times):
        end = int(following[at])
        starts[at:end] = times[at]
        at = end
    return starts


def _compressed(ends_from: np.ndarray, ends_before: np.ndarray, leaves: np.ndarray, until: int) -> pd.DataFrame:
    """The rows for ends before ``until``; neighbouring ones that leave with the same window as one row."""
    known = ends_from < until
    ends_from, ends_before, leaves = ends_from[known], np.minimum(ends_before[known], until), leaves[known]
    first = np.flatnonzero(np.r_[True, leaves[1:] != leaves[:-1]]) if len(leaves) else np.empty(0, np.int64)
    last = np.r_[first[1:] - 1, len(leaves) - 1] if len(leaves) else first
    return pd.DataFrame({"ends_from": ends_from[first], "ends_before": ends_before[last], "leaves": leaves[first],
                         "until": np.int64(until)})


def exit_table(times: np.ndarray, window: int) -> pd.DataFrame:
    """For incoming windows ending in ``[ends_from, ends_before)``: the start of the window open at the end of the slot.

    ``times`` are sorted and distinct. An incoming window began before the first of
    them, so it ends less than ``window`` after it; one that outlasts all events
    has no row. ``until``: the end that no incoming window reaches.
    """
    # the window after the incoming one opens at the first event past its end
    entries = np.flatnonzero(np.concatenate(([True], times[:-1] < times[0] + window)))
    following = np.searchsorted(times, times + window, side="right")
    current = entries.copy()
    while True:
        step = following[current]
        more = step < len(times)
        if not more.any():
            break
        current = np.where(more, step, current)
    before = np.where(entries == 0, _NEVER, times[np.maximum(entries - 1, 0)])
    return _compressed(before, times[entries], times[current], int(times[0]) + window)


def _look_up(table: pd.DataFrame, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in the table incoming windows with these ends lie, and whether they do."""
    at = np.searchsorted(table["ends_before"].to_numpy(), ends, side="right")
    return np.minimum(at, max(0, len(table) - 1)), at < len(table)


def compose(first: pd.DataFrame, second: pd.DataFrame, window: int) -> pd.DataFrame:
    """The exit table of two neighbouring slots; ``second`` may begin in the windows that ``first`` leaves open."""
    at, met = _look_up(second, first["leaves"].to_numpy() + window)
    leaves = np.where(met, second["leaves"].to_numpy()[at], first["leaves"].to_numpy())
    # windows that outlast the first slot come to the second as they are
    since = first["ends_before"].iloc[-1]
    rest = second[second["ends_before"].to_numpy() > since]
    return _compressed(np.r_[first["ends_from"].to_numpy(), np.maximum(rest["ends_from"].to_numpy(), since)],
                       np.r_[first["ends_before"].to_numpy(), rest["ends_before"].to_numpy()],
                       np.r_[leaves, rest["leaves"].to_numpy()], int(first["until"].iloc[0]))


_TABLE = ["ends_from", "ends_before", "leaves", "until"]


def _tables(pdf: pd.DataFrame):
    """(slot, its exit table) in order of time."""
    pdf = pdf.sort_values(["_slot", "ends_before"], kind="stable")
    cuts = np.flatnonzero(np.diff(pdf["_slot"].to_numpy())) + 1
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(pdf)], strict=True):
        yield int(pdf["_slot"].iloc[lo]), pdf.iloc[lo:hi]


def _grouped(exits: DataFrame, group_rows: int) -> tuple[DataFrame, bool]:
    """(_k, _slot, _group): consecutive slots in groups of bounded rows; whether each key is one group."""
    sizes = exits.groupBy("_k", "_slot").agg(F.count("*").alias("_n"))
    most = sizes.agg(F.max("_n")).first()[0] or 1
    order = Window.partitionBy("_k").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(order), F.lit(0))
    groups = materialise(sizes.select("_k", "_slot", F.floor(before / max(group_rows, 4 * most)).cast("bigint").alias("_group")),
                         "reset-groups")
    return groups, groups.where("_group > 0").isEmpty()


def _in_groups(exits: DataFrame, groups: DataFrame) -> DataFrame:
    named = groups.select(F.col("_k").alias("_gk"), F.col("_slot").alias("_gslot"), "_group")
    return exits.join(named, F.col("_k").eqNullSafe(F.col("_gk")) & (F.col("_slot") == F.col("_gslot"))).drop("_gk", "_gslot")


def _entry_windows(exits: DataFrame, kind: str, window_ms: int, group_rows: int) -> DataFrame:
    """(_k, _slot, _open): the start of the window that is open when a slot begins, null for the first one."""
    def together(ids, pdf: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for _, table in _tables(pdf):
            whole = table if whole is None else compose(whole, table, window_ms)
        return whole.assign(_k=[ids[0]] * len(whole), _slot=ids[1])[["_k", "_slot", *_TABLE]]

    def enter(ids, pdf: pd.DataFrame) -> pd.DataFrame:
        slots, opened = [], []
        current = None if pd.isna(pdf["_open"].iloc[0]) else int(pdf["_open"].iloc[0])
        for slot, table in _tables(pdf):
            slots.append(slot)
            opened.append(current)
            at, met = _look_up(table, np.array([_NEVER if current is None else current + window_ms]))
            if met[0]:
                current = int(table["leaves"].iloc[at[0]])
        return pd.DataFrame({"_k": [ids[0]] * len(slots), "_slot": slots, "_open": pd.array(opened, dtype="Int64")})

    levels = []
    while True:
        groups, whole = _grouped(exits, group_rows)
        levels.append(_in_groups(exits, groups))
        if whole:
            break
        exits = materialise(levels[-1].groupBy("_k", "_group").applyInPandas(
            together, f"_k {kind}, _slot bigint, {' bigint, '.join(_TABLE)} bigint"), "reset-exits")
    entered = None
    for level in reversed(levels):
        if entered is None:
            level = level.withColumn("_open", F.lit(None).cast("bigint"))
        else:
            above = entered.select(F.col("_k").alias("_ek"), F.col("_slot").alias("_eslot"), "_open")
            level = level.join(above, F.col("_k").eqNullSafe(F.col("_ek")) & (F.col("_group") == F.col("_eslot"))).drop("_ek", "_eslot")
        entered = level.groupBy("_k", "_group").applyInPandas(enter, f"_k {kind}, _slot bigint, _open bigint")
        if len(levels) > 1:
            entered = materialise(entered, "reset-entries")
    return entered


def _in_slots(times: DataFrame, slot_times: int) -> DataFrame:
    """``_slot``, where a row's slot begins, such that none has more than ``slot_times`` event times.

    A crowded slot is cut by its number of event times, so that there are never many more slots than these need; what
    is still crowded is cut again. A slot of ``slot_times`` milliseconds cannot be crowded, so this ends.
    """
    while True:
        cut = F.greatest(F.lit(slot_times), F.floor(F.col("_width") * F.lit(slot_times / 4) / F.col("count"))).cast("bigint")
        crowded = materialise(times.groupBy("_k", "_slot", "_width").count().where(F.col("count") > slot_times).select(
            F.col("_k").alias("_ck"), F.col("_slot").alias("_cslot"), cut.alias("_cut")), "reset-crowded")
        if crowded.isEmpty():
            return times.drop("_width")
        begin = F.col("_slot") + F.floor((F.col("_ms") - F.col("_slot")) / F.col("_cut")).cast("bigint") * F.col("_cut")
        times = times.join(crowded, F.col("_k").eqNullSafe(F.col("_ck")) & (F.col("_slot") == F.col("_cslot")), "left").withColumns(
            {"_slot": F.coalesce(begin, "_slot"), "_width": F.coalesce("_cut", "_width")}).drop("_ck", "_cslot", "_cut")


def window_starts(df: DataFrame, key: str, ms: str, window_ms: int, slot_windows: int = 12,
                  counters: Mapping[str, Column] | None = None, slot_times: int = SLOT_TIMES,
                  group_rows: int = GROUP_ROWS) -> DataFrame:
    """Key ``_k``, event time ``_ms`` (epoch milliseconds), ``window_start`` and counters per distinct event time.

    A slot spans ``slot_windows`` windows; where a key has more than ``slot_times``
    event times in one, it is cut into so many spans that each has far fewer.
    """
    slot_ms = window_ms * slot_windows
    counters = {"_rows": F.count("*")} if counters is None else counters
    names = list(counters)
    times = materialise(df.groupBy(F.col(key).alias("_k"), F.col(ms).cast("bigint").alias("_ms")).agg(
        *[c.cast("bigint").alias(name) for name, c in counters.items()]), "reset-times")
    kind = dict(times.dtypes)["_k"]

    times = _in_slots(times.withColumns({"_slot": F.floor(F.col("_ms") / slot_ms).cast("bigint") * slot_ms,
                                         "_width": F.lit(slot_ms).cast("bigint")}), slot_times)

    def leave(ids, pdf: pd.DataFrame) -> pd.DataFrame:
        table = exit_table(np.sort(pdf["_ms"].to_numpy()), window_ms)
        return table.assign(_k=[ids[0]] * len(table), _slot=ids[1])[["_k", "_slot", *_TABLE]]

    exits = materialise(times.select("_k", "_slot", "_ms").groupBy("_k", "_slot").applyInPandas(
        leave, f"_k {kind}, _slot bigint, {' bigint, '.join(_TABLE)} bigint"), "reset-exits")
    entered = _entry_windows(exits, kind, window_ms, group_rows)

    def assign(ids, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_ms")
        opened = pdf["_open"].iloc[0]
        starts = chain_starts(pdf["_ms"].to_numpy(), window_ms, None if pd.isna(opened) else int(opened))
        return pdf.assign(window_start=starts)[["_k", "_ms", *names, "window_start"]]

    joined = times.join(entered.withColumnRenamed("_k", "_k2").withColumnRenamed("_slot", "_slot2"),
                        F.col("_k").eqNullSafe(F.col("_k2")) & (F.col("_slot") == F.col("_slot2")))
    counted = ", ".join(f"{name} bigint" for name in names)
    return joined.select("_k", "_slot", "_ms", *names, "_open").groupBy("_k", "_slot").applyInPandas(
        assign, f"_k {kind}, _ms bigint, {counted}, window_start bigint")


def with_reset_window(df: DataFrame, key: str, ms: str, window_ms: int,
                      counters: Mapping[str, Column] | None = None) -> DataFrame:
    """Add the ``window_start`` of each row and, per counter, its total over the window's *earlier* event times.

    Totals run over distinct event times, of which a window has a bounded
    number, so a window crowded with rows is never numbered in one task.
    """
    starts = window_starts(df, key, ms, window_ms, counters=counters)
    earlier = Window.partitionBy("_k", "window_start").orderBy("_ms").rowsBetween(Window.unboundedPreceding, -1)
    table = starts.select(
        F.col("_k").alias("_wk"), F.col("_ms").alias("_wms"), "window_start",
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in counters or {}])
    return df.join(table, F.col(key).eqNullSafe(F.col("_wk")) & (F.col(ms) == F.col("_wms"))).drop("_wk", "_wms")


def _same_time(key: str, ms: str, tie: str):
    """Rows of one event time in tie order, up to the current one."""
    return Window.partitionBy(key, ms).orderBy(tie).rowsBetween(Window.unboundedPreceding, 0)


def request_counts(df: DataFrame, key: str, ms: str, tie: str, window_ms: int = fx.REQUEST_WINDOW_MS) -> DataFrame:
    """Each event with the number of events so far in its key's reset window."""
    windowed = with_reset_window(df, key, ms, window_ms, {"_earlier": F.count("*")})
    here = F.count("*").over(_same_time(key, ms, tie))
    return windowed.withColumn("request_count", F.col("_earlier") + here).drop("_earlier")


def suppressed(df: DataFrame, key: str, ms: str, tie: str, suppress_ms: int) -> DataFrame:
    """Keep an event only when the last kept one of its key is more than ``suppress_ms`` ago."""
    windows = with_reset_window(df, key, ms, suppress_ms).where(F.col(ms) == F.col("window_start"))
    first = Window.partitionBy(key, "window_start").orderBy(tie)
    return windows.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1).drop("_rn", "window_start")


def rate_alerts(counted: DataFrame, key: str, ms: str, tie: str, threshold: int = fx.REQUEST_THRESHOLD,
                suppress_ms: int = fx.REQUEST_SUPPRESS_MS) -> DataFrame:
    """Events over the threshold, at most one per key and suppression time."""
    over = counted.where(F.col("request_count") > threshold).drop("window_start")
    return suppressed(over, key, ms, tie, suppress_ms)


def error_rates(df: DataFrame, key: str, ms: str, tie: str, status: str | Column,
                window_ms: int = fx.ERROR_WINDOW_MS, min_requests: int = fx.ERROR_MIN_REQUESTS,
                pct_above: float = fx.ERROR_PCT_ABOVE) -> DataFrame:
    """Each event with its window's requests, errors and error rate so far, and the alert flag."""
    failed = F.when(is_error(status), 1).otherwise(0)
    here = _same_time(key, ms, tie)
    windowed = with_reset_window(df, key, ms, window_ms, {"_all": F.count("*"), "_failed": F.sum(failed)})
    counted = windowed.withColumns({
        "total_requests": F.col("_all") + F.count("*").over(here),
        "error_requests": F.col("_failed") + F.sum(failed).over(here)}).drop("_all", "_failed")
    rate = F.col("error_requests") * 100.0 / F.col("total_requests")
    return counted.withColumns({
        "error_rate_percent": F.round(rate, 2),
        "is_alert": (F.col("total_requests") >= min_requests) & (rate > pct_above),
    })


