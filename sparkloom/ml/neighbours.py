"""Exact nearest neighbours by a metric index: pivots, Voronoi cells and triangle bounds.

1. Pivots are training rows in the order of a hash, a bounded number of them. Each
   distinct training row (with the number of its copies) falls to the cell of its
   nearest pivot; of a cell the least, the largest and the k smallest distances
   to the pivot are known.
2. A test row's distances to the pivots bound the distance of its k-th neighbour
   from above. It is sent to the cells that can hold a row within that bound: the
   triangle inequality gives the least distance to a cell's ring, the bisecting
   plane of two pivots that to the other one's side. Most cells fall out.
3. Cells meet their visitors in groups of bounded rows on both sides: a crowded
   cell is cut into chunks by a hash. In a group only training rows whose distance
   to the pivot lies within the bound are compared.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import materialise

#: Pivots at most; rows of a cell on average below that, and of a chunk of a cell.
MAX_PIVOTS = 1024
CELL_ROWS = 2_000
#: Part of a distance that rounding of sums and roots can be off by.
SLACK = 1e-9


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all of y, as plain sums."""
    d = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d += (x[:, j:j + 1] - y[None, :, j]) ** 2
    return d


def _complete(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows without missing features; features become doubles."""
    df = df.select(*[c for c in df.columns if c not in features], *[F.col(c).cast("double").alias(c) for c in features])
    for c in features:
        df = df.where(F.col(c).isNotNull() & ~F.isnan(c))
    return df


class Cells:
    """The pivots with what bounds need of their cells."""

    def __init__(self, pivots: np.ndarray, k: int):
        self.pivots, self.k = pivots, k
        self.between = np.sqrt(_distances(pivots, pivots))
        self.low, self.high = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
        self.near = np.full((len(pivots), k), np.inf)

    def learn(self, cell: int, low: float, high: float, near: Sequence[float]) -> None:
        self.low[cell], self.high[cell] = low, high
        self.near[cell, :len(near)] = sorted(near)

    def visits(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, cell, distance to its pivot, bound of the k-th distance) of the cells that rows must visit."""
        step = max(1, (1 << 20) // max(1, self.near.size))
        for start in range(0, len(x), step):
            d = np.sqrt(_distances(x[start:start + step], self.pivots))
            reached = (d[:, :, None] + self.near[None]).reshape(len(d), -1)
            bound = np.partition(reached, self.k - 1, axis=1)[:, self.k - 1]
            mine = d.argmin(1)
            own = d[np.arange(len(d)), mine][:, None]
            apart = self.between[mine]
            with np.errstate(divide="ignore", invalid="ignore"):
                side = np.where(apart > 0, (d * d - own * own) / (2 * apart), 0)
            least = np.maximum(np.maximum(d - self.high, self.low - d), side)
            slack = SLACK * (1 + d + own)
            row, cell = np.nonzero((least <= bound[:, None] + slack) & (self.high >= 0))
            yield start + row, cell, d[row, cell], bound[row] + slack[row, cell]


def _in_cells(rows: DataFrame, features: Sequence[str], pivots: np.ndarray) -> DataFrame:
    """The rows with ``_cell`` (the nearest pivot, the first of equally near ones) and ``_pd``, the distance to it."""
    names = list(features)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            x = pdf[names].to_numpy(float)
            step = max(1, (1 << 21) // len(pivots))
            cells, away = [], []
            for start in range(0, len(x), step):
                d = _distances(x[start:start + step], pivots)
                cells.append(d.argmin(1))
                away.append(np.sqrt(d.min(1)))
            yield pdf.assign(_cell=np.concatenate(cells or [[]]).astype(np.int32), _pd=np.concatenate(away or [[]]))

    return rows.mapInPandas(run, T.StructType([*rows.schema.fields, *T.StructType.fromDDL("_cell int, _pd double").fields]))


def _chunked(rows: DataFrame, sizes: DataFrame, mine: str, other: str, number: str) -> DataFrame:
    """The rows with a chunk of their own side, once for every chunk of the other side."""
    return rows.join(sizes, "_cell").withColumn(number, F.pmod(F.xxhash64(*[c for c in rows.columns if c != "_cell"]), F.col(mine))).withColumn(
        "_b" if number == "_a" else "_a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))).drop(mine, other)


def candidates(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, row_id: str, k: int,
               cell_rows: int = CELL_ROWS, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(_id, _d, _label, _n, _compared): rows that hold the k nearest training rows of each test row.

    ``_d`` is the squared distance, ``_n`` the number of equal training rows (k at
    most); ``_compared`` counts the training rows the test row was compared with in
    the group that found the candidate.
    """
    features = list(features)
    known = _complete(train.select(F.col(label).cast("double").alias("_label"), *features), features).groupBy(
        *features, "_label").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("_n"))
    known = materialise(known.where(F.col("_label").isNotNull()), "neighbours")
    asked = _complete(test.select(F.col(row_id).alias("_id"), *features), features)
    found = T.StructType([asked.schema["_id"], *T.StructType.fromDDL("_d double, _label double, _n int, _compared int").fields])
    count = max(1, min(max_pivots, -(-known.count() // cell_rows)))
    chosen = known.select(*features).orderBy(F.xxhash64(*features), *features).limit(count).distinct().toPandas()
    if chosen.empty:
        return asked.sparkSession.createDataFrame([], found)
    cells = Cells(chosen.to_numpy(float), k)

    placed = materialise(_in_cells(known, features, cells.pivots), "neighbours-cells")
    ranked = placed.withColumn("_r", F.row_number().over(Window.partitionBy("_cell").orderBy("_pd"))).where(F.col("_r") <= k)
    # one row a pivot, at most ``max_pivots``
    for r in placed.groupBy("_cell").agg(F.min("_pd").alias("low"), F.max("_pd").alias("high")).join(
            ranked.groupBy("_cell").agg(F.collect_list("_pd").alias("near")), "_cell").collect():
        cells.learn(r["_cell"], r["low"], r["high"], r["near"])
    sent = asked.sparkSession.sparkContext.broadcast(cells)

    def visit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for row, cell, away, bound in sent.value.visits(pdf[features].to_numpy(float)):
                yield pdf.iloc[row].assign(_cell=cell.astype(np.int32), _td=away, _bound=bound)

    visitors = materialise(asked.mapInPandas(visit, T.StructType([*asked.schema.fields, *T.StructType.fromDDL(
        "_cell int, _td double, _bound double").fields])), "neighbours-visits")
    chunk = max(cell_rows, 1)
    sizes = materialise(placed.groupBy("_cell").agg(F.ceil(F.count("*") / (4 * chunk)).alias("_ta")).join(
        visitors.groupBy("_cell").agg(F.ceil(F.count("*") / (4 * chunk)).alias("_va")), "_cell"), "neighbours-sizes")
    left = _chunked(visitors, sizes, "_va", "_ta", "_a")
    right = _chunked(placed, sizes, "_ta", "_va", "_b")

    def compare(_, visiting: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        if len(visiting) and len(here):
            here = here.sort_values("_pd", kind="stable")
            y, labels, copies, away = (here[c].to_numpy() for c in (features, "_label", "_n", "_pd"))
            x, td, bound, ids = (visiting[c].to_numpy() for c in (features, "_td", "_bound", "_id"))
            first, last = np.searchsorted(away, td - bound, "left"), np.searchsorted(away, td + bound, "right")
            for i in range(len(x)):
                lo, hi = int(first[i]), int(last[i])
                if lo < hi:
                    d = _distances(x[i:i + 1], y[lo:hi])[0]
                    best = np.lexsort((labels[lo:hi], d))[:k]
                    for column, values in zip(out, (np.repeat(ids[i:i + 1], len(best)), d[best], labels[lo:hi][best],
                                                    copies[lo:hi][best], np.full(len(best), hi - lo)), strict=True):
                        column.append(values)
        names = ["_id", "_d", "_label", "_n", "_compared"]
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in zip(names, out, strict=True)})

    return left.groupBy("_cell", "_a", "_b").cogroup(right.groupBy("_cell", "_a", "_b")).applyInPandas(compare, found)


def knn_classify(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, row_id: str, k: int = 5,
                 cell_rows: int = CELL_ROWS, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """Majority label of the k nearest training rows (Euclidean), exact.

    Equally near rows count in the order of their labels; a tie of votes goes to the
    smaller label. Training rows with a missing feature or label are no
    neighbours; test rows with a missing feature, or without any training row, have
    no prediction. Copies of a training row each count.
    """
    before = Window.partitionBy("_id").orderBy("_d", "_label").rowsBetween(Window.unboundedPreceding, -1)
    ranked = candidates(train, test, features, label, row_id, k, cell_rows, max_pivots).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    votes = ranked.where(F.col("_before") < k).groupBy("_id", "_label").agg(
        F.sum(F.least(F.col("_n"), F.lit(k) - F.col("_before"))).alias("_v"))
    winner = votes.groupBy("_id").agg(F.max_by("_label", F.struct(F.col("_v"), -F.col("_label"))).alias("prediction"))
    return winner.withColumnRenamed("_id", row_id)
