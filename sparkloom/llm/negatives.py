"""Hard negatives: different-label rows whose score with an anchor lies just under that of a positive.

1. Rows are written once with their integer vector, its norm and its angles to a
   few reference directions (means of the labels in a bounded sample; they decide
   how much is skipped, never what is found).
2. Anchors are taken in slices of bounded bytes. Every task reads rows batch by
   batch against the whole slice. The angle between anchor and row lies between
   the difference and the sum of their angles to any reference, so the cosines of
   both, times the norms and widened by what rounding can do, bound the score.
3. First job of a slice: of rows with the anchor's label, those whose upper bound
   reaches the task's present last place get their integer score. Second job: of
   the other rows, those whose bounds overlap the score window of a positive, and
   whose upper bound reaches the last place there. A task returns the best few of
   each anchor, or of each anchor and positive, and a window picks among tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import scratch_path, store

#: An id divisible by the first is an anchor, by the second gets the next of so many labels.
ANCHOR_EVERY = 100
RELABEL_EVERY = 7
LABELS = 10
SCALE = 256
#: Positives of an anchor and negatives of a positive; the window is [80, 100] percent of the positive's score.
N_POSITIVES = 5
N_NEGATIVES = 5
LOW_PERCENT = 80
#: Rows that the reference directions are fitted on, and directions at most.
SAMPLE_ROWS = 2_000
REFERENCES = 8
#: Bytes of anchor vectors that are sent to the tasks at once.
SLICE_BYTES = 4 << 20
#: Anchors by rows that a task bounds at once.
TILE = 1 << 18
#: Part of the product of the norms by which a bound is widened: angles from arccos are off by 3e-8 at most.
SLACK = 1e-6
#: Rows whose squared norm reaches this take no part, so that each score and four times each score is a long.
NORM_LIMIT = 2.0 ** 60


def _matrix(lists: pa.Array, width: int | None = None, kind: type = np.float64) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros; nulls inside become NaN."""
    sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = lists.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False) if kind is np.float64 else flat.to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0)) if width is None else width
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), kind)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _angles(q: np.ndarray, norm: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of rows to unit references; a zero row has a right angle to all."""
    w = min(q.shape[1], references.shape[1])
    cosine = q[:, :w] @ references[:, :w].T / np.where(norm > 0, norm, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


def _mapped(df: DataFrame, schema: str, made: Callable[[pa.RecordBatch], list]) -> DataFrame:
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(made(batch), out, strict=True)], schema=out)

    return df.mapInArrow(run, schema)


def integer_rows(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, q (integer vector), norm of the rows that take part, labels already moved on."""
    usable = df.select(df[id_col].cast("bigint").alias("id"), df[label_col].cast("bigint").alias("label"),
                       df[vector_col].alias("v")).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")

    def made(batch: pa.RecordBatch) -> list:
        key, label = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        v = _matrix(batch.column(2))
        with np.errstate(invalid="ignore", over="ignore"):
            q = np.floor(v * SCALE)
            norm = np.sqrt((q * q).sum(1))
        fine = np.isfinite(v).all(1) & (norm * norm < NORM_LIMIT)
        label = np.where(key % RELABEL_EVERY == 0, np.fmod(label + 1, LABELS), label)
        return [key[fine], label[fine], [r[:n].astype(np.int64) for r, n in zip(q[fine], sizes[fine], strict=True)], norm[fine]]

    return _mapped(usable, "id bigint, label bigint, q array<bigint>, norm double", made)


def reference_directions(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, count: int = REFERENCES) -> np.ndarray:
    """Unit vectors: the means of the largest labels in a sample of at most ``sample_rows`` rows, by a hash of the id."""
    sample = rows.select("id", "label", "q").orderBy(F.xxhash64("id"), "id", "label", "q").limit(sample_rows).toArrow()
    sample = sample.combine_chunks()
    q, label = _matrix(sample.column(2).combine_chunks()), sample.column(1).to_numpy()
    kinds, n = np.unique(label, return_counts=True)
    means = [q[label == k].mean(0) for k in kinds[np.argsort(-n, kind="stable")][:count]]
    means = [m / s for m in means if (s := np.linalg.norm(m)) > 0]
    return np.array(means) if means else np.eye(1, max(1, q.shape[1]))


class Anchors:
    """A slice of anchors in arrays; ``bound`` gives score bounds against a batch of rows."""

    def __init__(self, table: pa.Table):
        self.key, self.id, self.label = (table.column(c).to_numpy() for c in ("a", "id", "label"))
        self.exact = _matrix(table.column("q").combine_chunks(), kind=np.int64)
        self.q, self.norm = self.exact.astype(np.float64), table.column("norm").to_numpy()
        self.angles = _matrix(table.column("angles").combine_chunks())

    def bounds(self, s: slice, norm: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) of the scores of the anchors in ``s`` with each row."""
        size = self.norm[s, None] * norm[None, :]
        low, high = np.full(size.shape, -1.0), np.full(size.shape, 1.0)
        for r in range(self.angles.shape[1]):
            mine = self.angles[s, r, None]
            both = np.cos(mine) * np.cos(angles[:, r])[None, :]
            rest = np.sin(mine) * np.sin(angles[:, r])[None, :]
            np.maximum(low, both - rest, out=low)  # cosine of the sum of the angles
            np.minimum(high, both + rest, out=high)  # and of their difference
        slack = SLACK * size + 1
        return np.floor(low * size - slack), np.ceil(high * size + slack)

    def scores(self, i: int, q: np.ndarray, norm: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Integer scores of anchor ``i``: floating sums where norms show that they are exact, else long ones."""
        w = min(self.q.shape[1], q.shape[1])
        if self.norm[i] * float(norm[rows].max(initial=0)) < 2.0 ** 52:
            return np.rint(q[rows, :w].astype(np.float64) @ self.q[i, :w]).astype(np.int64)
        return q[rows, :w] @ self.exact[i, :w]


def _best(score: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n of the distinct (score, id), highest score first, then smallest id."""
    by = np.lexsort((key, -score))
    score, key = score[by], key[by]
    new = np.r_[True, (score[1:] != score[:-1]) | (key[1:] != key[:-1])] if len(by) else np.empty(0, bool)
    return score[new][:n], key[new][:n]


def _tiles(anchors: Anchors, batch: pa.RecordBatch):
    key, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    q, norm = _matrix(batch.column(2), kind=np.int64), batch.column(3).to_numpy(zero_copy_only=False)
    angles = _matrix(batch.column(4))
    step = max(1, TILE // max(1, len(key)))
    for i in range(0, len(anchors.key), step):
        s = slice(i, min(i + step, len(anchors.key)))
        yield s, key, label, q, norm, anchors.bounds(s, norm, angles)


def _positive_task(sent, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = sent.value
        top = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(anchors.key)
        last = np.full(len(anchors.key), -np.inf)  # the score to reach
        for batch in batches:
            for s, key, label, q, norm, (_, high) in _tiles(anchors, batch):
                near = (anchors.label[s, None] == label) & (anchors.id[s, None] != key) & (high >= last[s, None])
                for i in np.flatnonzero(near.any(1)):
                    at, rows = s.start + i, np.flatnonzero(near[i])
                    score = anchors.scores(at, q, norm, rows)
                    top[at] = _best(np.r_[top[at][0], score], np.r_[top[at][1], key[rows]], n)
                    if len(top[at][0]) == n:
                        last[at] = top[at][0][-1]
        counts = [len(x) for x, _ in top]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(anchors.key, counts), pa.int64()), pa.array(np.repeat(anchors.id, counts), pa.int64()),
             *(pa.array(np.concatenate([t[k] for t in top] or [[]]).astype(np.int64)) for k in (0, 1))],
            names=["a", "anchor_id", "positive_score", "positive_id"])

    return run


def _negative_task(sent, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, windows = sent.value  # windows: per anchor the arrays (lowest score, highest score, positive's id)
        top = [[(np.empty(0, np.int64), np.empty(0, np.int64))] * len(w[0]) for w in windows]
        floor = [w[0].astype(float) for w in windows]  # the score to reach, by window
        least = np.array([f.min(initial=np.inf) for f in floor])
        most = np.array([w[1].max(initial=-1) for w in windows], float)
        for batch in batches:
            for s, key, label, q, norm, (low, high) in _tiles(anchors, batch):
                near = (anchors.label[s, None] != label) & (high >= least[s, None]) & (low <= most[s, None])
                for i in np.flatnonzero(near.any(1)):
                    at, rows = s.start + i, np.flatnonzero(near[i])
                    upper = windows[at][1]
                    meets = (high[i, rows, None] >= floor[at]) & (low[i, rows, None] <= upper)
                    rows, meets = rows[meets.any(1)], meets[meets.any(1)]
                    score = anchors.scores(at, q, norm, rows)
                    for j in range(len(upper)):
                        k = np.flatnonzero((score >= floor[at][j]) & (score <= upper[j]))
                        if len(k):
                            top[at][j] = _best(np.r_[top[at][j][0], score[k]], np.r_[top[at][j][1], key[rows[k]]], n)
                            if len(top[at][j][0]) == n:
                                floor[at][j] = top[at][j][0][-1]
                    least[at] = floor[at].min()
        found = [(at, j, score, key) for at, t in enumerate(top) for j, (score, key) in enumerate(t) if len(score)]
        counts = [len(f[2]) for f in found]
        columns = [np.repeat([anchors.key[f[0]] for f in found], counts), np.repeat([anchors.id[f[0]] for f in found], counts),
                   np.repeat([windows[f[0]][2][f[1]] for f in found], counts),
                   np.repeat([windows[f[0]][1][f[1]] for f in found], counts),
                   np.concatenate([f[2] for f in found] or [[]]), np.concatenate([f[3] for f in found] or [[]])]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64), pa.int64()) for c in columns],
                                         names=["a", "anchor_id", "positive_id", "positive_score", "negative_score", "negative_id"])

    return run


def _windows(anchors: Anchors, positives: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    where = {a: i for i, a in enumerate(anchors.key.tolist())}
    rows: list[list[tuple[int, int, int]]] = [[] for _ in where]
    for a, score, key in zip(*(positives.column(c).to_pylist() for c in ("a", "positive_score", "positive_id")), strict=True):
        low = -(-LOW_PERCENT * score // 100)
        if low <= score:
            rows[where[a]].append((low, score, key))
    return [tuple(np.array([r[k] for r in sorted(x)], np.int64) for k in range(3)) for x in rows]


def _slices(anchors: DataFrame, rows_each: int) -> Iterator[pa.Table]:
    """The anchors in the order of their key, at most ``rows_each`` at once."""
    order, last = F.struct("a", "id", "label"), None
    while True:
        rest = anchors if last is None else anchors.where(order > F.struct(
            *(F.lit(x).cast("bigint").alias(c) for c, x in zip(("a", "id", "label"), last, strict=True))))
        part = rest.orderBy("a", "id", "label").limit(rows_each).toArrow()
        if part.num_rows:
            yield part
        if part.num_rows < rows_each:
            return
        last = [part.column(c)[-1].as_py() for c in ("a", "id", "label")]


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label or vector or a null or non-finite component take no
    part, nor do those whose squared integer norm is 2^60 or more (their scores
    might fit no long). Shorter vectors count as filled with zeros, an empty one as
    zero. Rows equal in id, label and vector are one row; of the rows that have one
    id and one score with an anchor one counts; rows of the anchor's own id are no
    positives of it. An anchor without positives, or whose positives have no row in
    their window, and an empty table give no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    rows = store(integer_rows(df, id_col, vector_col, label_col), "negatives-integers")
    references = reference_directions(rows)

    def with_angles(batch: pa.RecordBatch) -> list:
        q = _matrix(batch.column(2))
        return [*batch.columns, list(_angles(q, batch.column(3).to_numpy(), references))]

    rows = store(_mapped(rows, "id bigint, label bigint, q array<bigint>, norm double, angles array<double>", with_angles),
                 "negatives-rows")
    anchors = store(rows.where(F.col("id") % ANCHOR_EVERY == 0).dropDuplicates(["id", "label", "q"]).withColumn(
        "a", F.xxhash64("id", "label", "q")), "negatives-anchors")
    widest = anchors.agg(F.max(F.size("q"))).first()[0] or 1
    path = scratch_path(spark, "negatives-found")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    best = Window.partitionBy("a").orderBy(F.desc("positive_score"), "positive_id")
    rank = Window.partitionBy("a", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    for part in _slices(anchors, max(1, slice_bytes // (8 * max(1, widest)))):
        held = Anchors(part)
        sent = spark.sparkContext.broadcast(held)
        found = rows.mapInArrow(_positive_task(sent, n_positives),
                                "a bigint, anchor_id bigint, positive_score bigint, positive_id bigint").distinct()
        positives = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= n_positives).drop("r").toArrow()
        sent.destroy()
        sent = spark.sparkContext.broadcast((held, _windows(held, positives)))
        found = rows.mapInArrow(_negative_task(sent, n_negatives), "a bigint, anchor_id bigint, positive_id bigint, "
                                "positive_score bigint, negative_score bigint, negative_id bigint").distinct()
        (found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= n_negatives)
         .select(*schema.replace(",", "").split()[::2]).write.mode("append").parquet(path))
        sent.destroy()
    return spark.read.schema(schema).parquet(path)
