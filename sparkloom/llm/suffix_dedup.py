"""Removal of byte strings of at least ``LENGTH`` that occur elsewhere in the corpus.

Every window of ``LENGTH`` bytes is tied to its anchor, the place of the smallest
hash of a short gram inside it (leftmost on ties), which depends on the window's
bytes alone. So equal windows have equal anchors at equal offsets, and only
windows of one anchor need to be compared. Consecutive windows with one anchor
place form a run; a run's key is a digest of all its bytes.

1. Runs of anchors that occur once are done. 2. A run whose key occurs again is
covered whole. 3. Of anchors with several different runs (the edges of repeated
passages) one run of each key is cut into chunks, whose cores and envelopes
decide most windows; the rest are spelled out, and those found twice are covered. Lengths of common intervals thus come from counted digests,
and no suffix is sorted: see the README for why the merge of shard transforms by
interleave refinement is not used.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import discard, map_texts, store

LENGTH = 200
GRAM = 40
#: Window places of a chunk at the edge of a repeated passage.
STEP = 16
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOW = np.uint64(0xBF58476D1CE4E5B9)


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.empty(n + 1, np.uint64)
    out[0] = 1
    out[1:] = np.multiply.accumulate(np.full(n, factor, np.uint64))
    return out


_TABLES = [np.ones(1, np.uint64)] * 2


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, as far as needed so far."""
    if len(_TABLES[0]) <= n:
        size = max(n, 2 * len(_TABLES[0]))
        _TABLES[:] = [_powers(int(_BASE), size), _powers(pow(int(_BASE), -1, 2 ** 64), size)]
    return _TABLES


#: A fixed 64-bit value per byte, by the finaliser of splitmix64.
def _byte_values() -> np.ndarray:
    z = (np.arange(1, 257, dtype=np.uint64) * _BASE)
    z = (z ^ (z >> np.uint64(30))) * _LOW
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_VALUES = _byte_values()


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes that start at each place (polynomial over mixed byte values, finalised)."""
    n = len(raw)
    if n < size:
        return np.empty(0, np.uint64)
    powers, inverse = _tables(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[raw] * powers[:n], out=total[1:])
    # sum of value[i + k] * base^(i + k), over base^i
    h = (total[size:] - total[:-size]) * inverse[:n - size + 1]
    h ^= h >> np.uint64(32)
    h *= _LOW
    h ^= h >> np.uint64(29)
    return h


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value in h[i : i + width] for each i."""
    n = len(h) - width + 1
    low, have = h, 1
    while have < width:  # doubling
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    # the place: next occurrence of the least value at or after i
    hit = np.empty(n, np.int64)
    change = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    ends = np.r_[change[1:], n]
    for a, b in zip(change.tolist(), ends.tolist(), strict=True):
        at = np.flatnonzero(h[a:b - 1 + width] == low[a]) + a
        hit[a:b] = at[np.searchsorted(at, np.arange(a, b))] if len(at) > 1 else at[0]
    return hit


def runs(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor offset in the first window, start, number of windows) of each run."""
    b = np.frombuffer(raw, np.uint8)
    none = np.empty(0, np.int64)
    if len(b) < length:
        return np.empty(0, np.uint64), none, none, none
    h = gram_hashes(b, gram)
    at = _window_min(h, length - gram + 1)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    count = np.diff(np.r_[first, len(at)])
    return h[at[first]], at[first] - first, first, count


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _run_rows(df: DataFrame, length: int, gram: int) -> DataFrame:
    """anchor, key, d (document), start, n of all runs; ``df`` has d and x."""

    def made(kept: list, texts: list) -> list:
        anchors, keys, owner, starts, counts, offsets = [], [], [], [], [], []
        for row, text in enumerate(texts):
            raw = (text or "").encode("utf-8", "surrogatepass")
            a, offset, start, n = runs(raw, length, gram)
            anchors.append(a)
            keys.extend([xxhash.xxh3_64_intdigest(raw[s:s + c + length - 1], seed=o) for s, c, o in
                         zip(start.tolist(), n.tolist(), offset.tolist(), strict=True)])
            owner.append(np.full(len(a), row))
            starts.append(start)
            counts.append(n)
            offsets.append(offset)
        return [pa.array(_signed(np.concatenate(anchors))), pa.array(_signed(np.array(keys, np.uint64))),
                kept[0].take(pa.array(np.concatenate(owner))), pa.array(np.concatenate(starts).astype(np.int32)),
                pa.array(np.concatenate(counts).astype(np.int32)), pa.array(np.concatenate(offsets).astype(np.int32))]

    schema = T.StructType([*T.StructType.fromDDL("anchor bigint, key bigint").fields,
                           T.StructField("d", df.schema["d"].dataType),
                           *T.StructType.fromDDL("start int, n int, offset int").fields])
    return map_texts(df, ["d", "x"], schema, made)


def _document(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """d: what a document is known by (its id and a digest of its text), x: the text."""
    text = F.coalesce(df[text_col], F.lit(""))
    return df.select(F.struct(df[id_col].alias("id"), F.xxhash64(text).alias("h")).alias("d"), text.alias("x"))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM) -> DataFrame:
    """(d, spans): the covered byte ranges [start, end) of each document that has one, unmerged, in no order."""
    docs = _document(df, id_col, text_col)
    found = store(_run_rows(docs, length, gram), "runs")
    # stored apart, so that the join is of two plain shuffles and a frequent anchor can be split
    twice = store(found.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "twice")
    # rows that repeat id and text stand for as many places: they are counted, not made distinct
    met = store(found.join(twice, "anchor"), "met")
    discard(found, twice)
    keys = store(met.groupBy("anchor", "key").agg(
        F.count("*").alias("c"), F.min(F.struct("d", "start", "n", "offset")).alias("rep")), "keys")
    edge = store(_edges(docs, keys, length), "edges")
    whole = (met.join(keys.where("c > 1").select("anchor", "key"), ["anchor", "key"])
             .select("d", F.struct(F.col("start").alias("s"), (F.col("start") + F.col("n") + length - 1).alias("e")).alias("r")))
    single = keys.where("c = 1").select("anchor", "key")
    partial = (met.join(edge.join(single, "key"), ["anchor", "key"]).select("d", F.explode(F.transform(
        "ranges", lambda p: F.struct((F.col("start") + p["a"]).alias("s"), (F.col("start") + p["b"] + length - 1).alias("e"))))
        .alias("r")))
    spans = store(whole.union(partial).groupBy("d").agg(F.collect_list("r").alias("spans")), "spans")
    discard(met, keys, edge)
    return spans


def _edges(docs: DataFrame, keys: DataFrame, length: int, step: int = STEP) -> DataFrame:
    """(key, ranges): window ranges [a, b) of runs that share them with a run of another key.

    A run's windows are dealt into chunks by their distance to the anchor, ``step``
    distances each. The bytes that all windows of a chunk have in common are its
    core, those that any has its envelope. No window of a chunk is shared unless
    the core is; all are if the envelope is; only chunks between the two are
    spelled out window by window.
    """
    several = keys.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor")
    spelled = keys.join(several, "anchor").select(
        "rep.d", F.struct("key", "rep.start", "rep.n", "rep.offset").alias("run"))

    def cut(kept: list, texts: list) -> list:
        out: list[list] = [[] for _ in range(5)]
        for run_list, t in zip(kept[0].field("runs").to_pylist(), texts, strict=True):
            raw = t.encode("utf-8", "surrogatepass")
            for r in run_list:
                start, n, anchor = r["start"], r["n"], r["start"] + r["offset"]
                at = start
                while at < start + n:  # distances anchor - at fall as at grows
                    c = (anchor - at) // step
                    end = min(start + n, anchor - c * step + 1)
                    first = anchor - c * step - step + 1  # where the chunk's windows would begin
                    whole = end - at == step
                    for column, value in zip(out, (
                            r["key"], at - start, end - at,
                            _signed64(xxhash.xxh3_64_intdigest(raw[anchor - c * step:first + length], seed=c)),
                            _signed64(xxhash.xxh3_64_intdigest(raw[first:anchor - c * step + length], seed=c + 2 ** 32))
                            if whole else None), strict=True):
                        column.append(value)
                    at = end
        return out

    # the same text in several rows of one id gives the same chunks again: keys, not rows, are compared
    chunks = store(map_texts(_with_text(docs, spelled), ["k", "x"], T.StructType.fromDDL(
        "key bigint, at int, m int, core bigint, env bigint"), cut), "chunks")

    def shared(frame: DataFrame, column: str) -> DataFrame:
        return frame.groupBy(column).agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi")

    env = store(shared(chunks.where("env IS NOT NULL"), "env"), "envelopes")
    all_of = chunks.join(env, "env").select("key", F.col("at").alias("a"), (F.col("at") + F.col("m")).alias("b"))
    between = store(chunks.join(env.select("env"), "env", "left_anti").join(shared(chunks, "core").select("core"), "core")
                    .select("key", "at", "m", "core"), "between")
    # of chunks with one envelope, one stands for all where others with its core are undecided
    first = (chunks.join(env.withColumnRenamed("lo", "key"), ["env", "key"])
             .join(between.select("core").distinct(), "core", "left_semi").select("key", "at", "m"))
    places = store(between.select("key", "at", "m").union(first).distinct(), "places")
    decided = store(all_of, "decided")
    discard(chunks, env, between)
    undecided = places.join(keys.select("key", "rep"), "key").select(
        "rep.d", F.struct("key", "at", (F.col("rep.start") + F.col("at")).alias("start"), "m").alias("run"))

    def windows(kept: list, texts: list) -> list:
        digest, key, place = [], [], []
        for run_list, t in zip(kept[0].field("runs").to_pylist(), texts, strict=True):
            h = gram_hashes(np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8), length)
            for r in run_list:
                digest.append(h[r["start"]:r["start"] + r["m"]])
                key.append(np.full(r["m"], r["key"], np.int64))
                place.append(np.arange(r["at"], r["at"] + r["m"], dtype=np.int32))
        return [pa.array(_signed(np.concatenate(digest))), pa.array(np.concatenate(key)),
                pa.array(np.concatenate(place))]

    one = store(map_texts(_with_text(docs, undecided), ["k", "x"], T.StructType.fromDDL("w bigint, key bigint, a int"),
                          windows), "windows")
    some = one.join(shared(one, "w").select("w"), "w").select("key", "a", (F.col("a") + 1).alias("b"))
    out = store(decided.union(some).groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("ranges")), "ranges")
    discard(places, decided, one)
    return out


def _with_text(docs: DataFrame, runs_of: DataFrame) -> DataFrame:
    """k.runs (bounded by the text they lie in) and x of the documents that ``runs_of(d, run)`` names."""
    per = runs_of.groupBy("d").agg(F.collect_set("run").alias("runs"))
    return docs.join(per, "d").select(F.struct("runs").alias("k"), "x")


def _signed64(x: int) -> int:
    return x - 2 ** 64 if x >= 2 ** 63 else x


def _union(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for r in sorted((r["s"], r["e"]) for r in spans or []):
        if out and r[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r[1])
        else:
            out.append([*r])
    return [(a, b) for a, b in out]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, as bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else, in the same document included; overlaps count, and strings are
    judged on the input. Matches never cross documents. Null is the empty text.
    Repeated rows are repeated text: both lose what they share. One row per input
    row; a null id is an id; other columns are ignored; an empty table gives no
    rows.
    """
    spans = repeated_spans(df, id_col, text_col, length, gram)
    docs = _document(df, id_col, text_col)
    held = docs.join(spans.withColumnRenamed("d", "d2"), docs["d"].eqNullSafe(F.col("d2")), "left").select(
        F.struct("d", "spans").alias("k"), "x")
    fields = [T.StructField(id_col, df.schema[id_col].dataType),
              *T.StructType.fromDDL("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string").fields]
    if with_text:
        fields.append(T.StructField("kept", T.BinaryType()))

    def made(kept: list, texts: list) -> list:
        out: list[list] = [[] for _ in range(5)]
        for row, text in zip(kept[0].field("spans").to_pylist(), texts, strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            merged, left, at = _union(row), [], 0
            for a, b in merged:
                left.append(raw[at:a])
                at = b
            rest = b"".join([*left, raw[at:]])
            for column, value in zip(out, (len(raw), len(raw) - len(rest), len(merged),
                                           hashlib.sha256(rest).hexdigest(), rest), strict=True):
                column.append(value)
        return [kept[0].field("d").field("id"), *out[:4 + with_text]]

    return map_texts(held, ["k", "x"], T.StructType(fields), made)
