"""Keyed state on streams: request counters, error rates and bounded histories.

A processor keeps a few numbers per key. Rows of a key arrive in pieces; they
are put in event order once and worked through with array operations, one step
per window instead of one per row. The trigger's intake limit bounds how much
of a busy key one batch can hold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import fixed_values as fx
from ..operators.resetting import chain_starts

REQUEST_SCHEMA = ("endpoint string, event_ms bigint, id bigint, record string, request_count bigint,"
                  "status_code int, processing_time_ms double")
ERROR_SCHEMA = ("endpoint string, event_ms bigint, id bigint, record string, total_requests bigint,"
                "error_requests bigint, error_rate_percent double")


#: Rows that are put together for output at once.
SLICE_ROWS = 50_000


def _ordered(rows: Iterator[pd.DataFrame], values: Sequence[str]) -> pd.DataFrame:
    """The numbers of a key's rows in event order; of each piece nothing else is kept, texts least of all."""
    pieces = [piece[["event_ms", "id", *values]].copy() for piece in rows]
    return pd.concat(pieces).sort_values(["event_ms", "id"], kind="stable", ignore_index=True)


def _slices(places: np.ndarray) -> Iterator[np.ndarray]:
    for lo in range(0, len(places), SLICE_ROWS):
        yield places[lo:lo + SLICE_ROWS]


def _before_window(starts: np.ndarray) -> np.ndarray:
    """Per row of ordered window starts the place of its window's first row."""
    first = np.flatnonzero(np.r_[True, starts[1:] != starts[:-1]])
    return np.repeat(first, np.diff(np.r_[first, len(starts)]))


class _Timed(StatefulProcessor):
    """Window bookkeeping shared by the monitors."""

    def __init__(self, window_ms: int, ttl_ms: int | None, timers: bool):
        self.window_ms, self.ttl_ms, self.timers = window_ms, ttl_ms, timers

    def _value(self, handle: StatefulProcessorHandle, name: str, schema: str):
        return handle.getValueState(name, schema, self.ttl_ms) if self.ttl_ms else handle.getValueState(name, schema)

    def _arm(self, start: int) -> None:
        """One timer per window: when it is over, counters are given back even if nothing else arrives."""
        if self.timers:
            self.handle.registerTimer(start + self.window_ms + 1)

    def close(self) -> None:
        pass


class RequestMonitor(_Timed):
    """Running request count per reset window, and an alert over the threshold at most once per suppression time."""

    def __init__(self, threshold: int = fx.REQUEST_THRESHOLD, window_ms: int = fx.REQUEST_WINDOW_MS,
                 suppress_ms: int = fx.REQUEST_SUPPRESS_MS, ttl_ms: int | None = fx.REQUEST_STATE_TTL_MS,
                 timers: bool = False):
        super().__init__(window_ms, ttl_ms, timers)
        self.threshold, self.suppress_ms = threshold, suppress_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = self._value(handle, "window", "start bigint, n bigint")
        self.alerted = self._value(handle, "alerted", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = _ordered(rows, ["status_code", "processing_time_ms"])
        ms = events["event_ms"].to_numpy()
        start, carried = self.window.get() if self.window.exists() else (None, 0)
        starts = chain_starts(ms, self.window_ms, start)
        counts = np.arange(1, len(starts) + 1) - _before_window(starts)
        if start is not None:
            counts = counts + np.where(starts == start, carried, 0)
        self.window.update((int(starts[-1]), int(counts[-1])))
        if start is None or starts[-1] != start:
            self._arm(int(starts[-1]))

        def out(places: np.ndarray, record: str) -> Iterator[pd.DataFrame]:
            for at in _slices(places):
                yield events.iloc[at].assign(endpoint=key[0], record=record, request_count=counts[at])[
                    ["endpoint", "event_ms", "id", "record", "request_count", "status_code", "processing_time_ms"]]

        yield from out(np.arange(len(counts)), "metrics")
        over = np.flatnonzero(counts > self.threshold)
        if len(over):
            last = self.alerted.get()[0] if self.alerted.exists() else None
            at = chain_starts(ms[over], self.suppress_ms, last)
            # an alert is the event that opens a suppression time
            alerts = over[np.concatenate(([last is None or at[0] != last], at[1:] != at[:-1]))]
            if len(alerts):
                self.alerted.update((int(ms[alerts[-1]]),))
                yield from out(alerts, "HIGH_REQUEST_RATE")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.window.exists():
            start = self.window.get()[0]
            if expiredTimerInfo.getExpiryTimeInMs() > start + self.window_ms:
                self.window.clear()
        return iter([])


class ErrorRateMonitor(_Timed):
    """Running error rate per reset window, and an alert whenever it is too high with enough requests."""

    def __init__(self, window_ms: int = fx.ERROR_WINDOW_MS, min_requests: int = fx.ERROR_MIN_REQUESTS,
                 pct_above: float = fx.ERROR_PCT_ABOVE, ttl_ms: int | None = fx.ERROR_STATE_TTL_MS,
                 timers: bool = False):
        super().__init__(window_ms, ttl_ms, timers)
        self.min_requests, self.pct_above = min_requests, pct_above

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = self._value(handle, "window", "start bigint, total bigint, errors bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = _ordered(rows, ["status_code"])
        start, total, errors = self.window.get() if self.window.exists() else (None, 0, 0)
        starts = chain_starts(events["event_ms"].to_numpy(), self.window_ms, start)
        first = _before_window(starts)
        failed = np.r_[0, np.cumsum((events["status_code"] >= fx.ERROR_STATUS_FROM).to_numpy(), dtype=np.int64)]
        carried = np.zeros(len(events), dtype=bool) if start is None else starts == start
        totals = np.arange(1, len(starts) + 1) - first + np.where(carried, total, 0)
        fails = failed[1:] - failed[first] + np.where(carried, errors, 0)
        self.window.update((int(starts[-1]), int(totals[-1]), int(fails[-1])))
        if start is None or starts[-1] != start:
            self._arm(int(starts[-1]))

        rate = fails / totals * 100

        def out(places: np.ndarray, record: str) -> Iterator[pd.DataFrame]:
            for at in _slices(places):
                yield events.iloc[at].assign(endpoint=key[0], record=record, total_requests=totals[at], error_requests=fails[at],
                                             error_rate_percent=np.round(rate[at], 2))[
                    ["endpoint", "event_ms", "id", "record", "total_requests", "error_requests", "error_rate_percent"]]

        yield from out(np.arange(len(totals)), "error_metrics")
        yield from out(np.flatnonzero((totals >= self.min_requests) & (rate > self.pct_above)), "HIGH_ERROR_RATE")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.window.exists():
            start = self.window.get()[0]
            if expiredTimerInfo.getExpiryTimeInMs() > start + self.window_ms:
                self.window.clear()
        return iter([])


class BoundedHistory(StatefulProcessor):
    """The newest n records per key; each batch emits the kept records of the keys it touched with a rising version."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", "event_ms bigint, id bigint, value double")
        self.version = handle.getValueState("version", "v bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = None
        if self.kept.exists():
            newest = pd.DataFrame(list(self.kept.get()), columns=["event_ms", "id", "value"])
        # only n rows are held at any time, however many pieces arrive
        for piece in rows:
            piece = piece[["event_ms", "id", "value"]]
            newest = piece if newest is None else pd.concat([newest, piece])
            newest = newest.sort_values(["event_ms", "id"], kind="stable").tail(self.n)
        version = (self.version.get()[0] if self.version.exists() else 0) + 1
        self.version.update((version,))
        self.kept.put([(int(m), int(i), float(v)) for m, i, v in newest.itertuples(index=False)])
        yield newest.assign(key=key[0], version=version)[["key", "version", "event_ms", "id", "value"]]

    def close(self) -> None:
        pass


def _apply(stream: DataFrame, key: str, processor: StatefulProcessor, schema: str, time_mode: str) -> DataFrame:
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode=time_mode)


def request_monitor(stream: DataFrame, key: str = "path", time_mode: str = "ProcessingTime", **settings) -> DataFrame:
    """Metrics and rate alerts per event; needs ``event_ms``, ``id``, ``status_code``, ``processing_time_ms``.

    State lives for its time-to-live in processing-time mode. In event-time mode
    (a watermark is needed) a timer at the end of each window frees it instead.
    """
    event_time = time_mode == "EventTime"
    if event_time:
        settings.setdefault("ttl_ms", None)
    else:  # event time needs the column of the watermark
        stream = stream.select(key, "event_ms", "id", "status_code", "processing_time_ms")
    return _apply(stream, key, RequestMonitor(timers=event_time, **settings), REQUEST_SCHEMA, time_mode)


def error_rate_monitor(stream: DataFrame, key: str = "path", time_mode: str = "ProcessingTime", **settings) -> DataFrame:
    """Error metrics and alerts per event; modes as in ``request_monitor``."""
    event_time = time_mode == "EventTime"
    if event_time:
        settings.setdefault("ttl_ms", None)
    else:
        stream = stream.select(key, "event_ms", "id", "status_code")
    return _apply(stream, key, ErrorRateMonitor(timers=event_time, **settings), ERROR_SCHEMA, time_mode)


def bounded_history(stream: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """Newest n records per key as versioned rows; needs ``event_ms``, ``id`` and ``value``."""
    schema = f"key {dict(stream.dtypes)[key]}, version bigint, event_ms bigint, id bigint, value double"
    return _apply(stream, key, BoundedHistory(n), schema, "None")
