"""Regression forests learnt level by level from binned rows in packed chunks.

MLlib keeps, for every row, how often each tree draws it and the node it has reached, which is 8 bytes a row and tree. Here a
row is its label and one byte a feature, stored once; draws come again from their seeds, and rows of equal bins (cells)
walk down the trees as one. What is learnt is what ``RandomForestRegressor`` describes: Poisson draws of the rows, at most
``maxBins`` bins a feature cut by a sample, a third of the features tried at each node, greatest drop of the variance.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from math import ceil, exp, factorial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from ..session import materialise, scratch_path

#: Rows of a chunk (which stay in a core's cache), rows of a stored part, and bytes of histograms that a task holds at most (one tree's at least).
CHUNK_ROWS, PART_ROWS, HISTOGRAM_BYTES = 1 << 17, 1 << 20, 64 << 20
#: Rows that the bins are cut by, as in MLlib (or the square of the number of bins).
SPLIT_ROWS = 10_000
#: A 32-bit draw makes one more of a row for each of these that it reaches: a Poisson number of mean 1.
_DRAWS = (np.cumsum([exp(-1) / factorial(k) for k in range(13)])[:12] * 2.0**32).astype(np.uint32)
_FINAL = 255  # no bin is beyond it
#: What ``Grown.errors`` knows.
METRICS = ("mse", "rmse", "mae", "r2")


def _seeded(*of: int) -> np.random.SFC64:
    return np.random.SFC64([x & 0xFFFFFFFFFFFFFFFF for x in of])


def draws(n: int, *of: int) -> np.ndarray:
    """How often a tree draws each of n rows."""
    raw = _seeded(*of).random_raw(n // 2 + 1).view(np.uint32)[:n]
    out = np.zeros(n, np.uint8)
    for limit in _DRAWS:
        out += (raw >= limit).view(np.uint8)
    return out


def thresholds(values: np.ndarray, splits: int) -> np.ndarray:
    """Where MLlib cuts a feature by a sample: between all values if they are few, else into parts of like numbers."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) <= splits:
        return middle
    cuts, stride, upto = [], len(values) / (splits + 1), np.cumsum(counts)
    target = stride
    for at in range(1, len(found)):
        if abs(upto[at - 1] - target) < abs(upto[at] - target):
            cuts.append(middle[at - 1])
            target += stride
    return np.array(cuts)


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    if np.isnan(x).any():
        raise ValueError("a forest cannot learn from features that are not numbers")
    return np.stack([np.searchsorted(c, x[:, f], "left").astype(np.uint8) for f, c in enumerate(cuts)], axis=1)


def _order(bins: np.ndarray) -> np.ndarray:
    """The first eight bins of each row as one number, in the order of their bytes."""
    padded = np.zeros((len(bins), 8), np.uint8)
    padded[:, :bins.shape[1]] = bins[:, :8]
    return padded.view(">u8").ravel().astype(np.uint64)


@dataclass
class Chunk:
    """Rows in the order of their bins: ``cells`` (a row a feature), where each cell's rows start, labels less their mean."""

    id: int
    cells: np.ndarray
    starts: np.ndarray
    y: np.ndarray

    def bagged(self, seed: int, tree: int, power: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Number of rows of each cell that a tree draws, and the sum of their labels (or of the squares)."""
        drawn = draws(len(self.y), seed, tree, self.id).astype(np.float64)
        counts = np.add.reduceat(drawn, self.starts)
        for _ in range(power):
            drawn *= self.y
        return counts, np.add.reduceat(drawn, self.starts)

    def walked(self, tree: Tree, places: np.ndarray, depths: Sequence[int]) -> Iterator[np.ndarray]:
        """The nodes that the cells of these places have reached at some depths, in rising order."""
        flat, size = self.cells.ravel(), self.cells.shape[1]
        offset, node, level = tree.feature * size, np.zeros(len(places), np.int64), 0
        for depth in depths:
            while level < min(depth, tree.level[-1]):
                at = offset.take(node)
                at += places
                right = flat.take(at) > tree.cut.take(node)
                node = tree.left.take(node)
                node += right
                level += 1
            yield node

    def reached(self, tree: Tree, places: np.ndarray) -> np.ndarray:
        """The nodes that they have reached at last."""
        return next(self.walked(tree, places, [tree.level[-1]]))


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Chunk]:
    for batch in batches:
        for id_, cells, starts, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield Chunk(id_, np.frombuffer(cells, np.uint8).reshape(width, -1), np.frombuffer(starts, np.int32), np.frombuffer(y))


@dataclass
class Tree:
    """Nodes in the order of their levels. A node that is not split leads to itself."""

    number: int
    feature: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.array([_FINAL], np.uint8))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    level: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    gain: np.ndarray = field(default_factory=lambda: np.array([-1.0]))
    count: np.ndarray = field(default_factory=lambda: np.zeros(1))
    total: np.ndarray = field(default_factory=lambda: np.zeros(1))
    squares: np.ndarray = field(default_factory=lambda: np.zeros(1))
    #: nodes that may be split next, and the features tried at each
    front: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    tried: np.ndarray | None = None

    def stripped(self) -> Tree:
        """What rows need to walk down, for the tasks."""
        return replace(self, gain=None, squares=None)

    def try_features(self, seed: int, width: int, k: int) -> None:
        order = np.random.Generator(_seeded(seed, self.number, -1, int(self.level[-1]))).random((len(self.front), width)).argsort(axis=1)
        self.tried = np.sort(order[:, :k], axis=1)

    def split(self, best: np.ndarray, depth: int, min_leaf: int) -> None:
        """Splits the nodes of the front as found (see ``_best``), whose parts are the next front."""
        if len(self.left) == 1:
            self.count, self.total = best[:, 3].copy(), best[:, 4].copy()
        found = best[:, 0] >= 0
        nodes, best, tried = self.front[found], best[found], self.tried[found]
        size, n = len(self.left), len(nodes)
        self.feature[nodes] = tried[np.arange(n), best[:, 0].astype(int)]
        self.cut[nodes], self.gain[nodes], self.left[nodes] = best[:, 1], best[:, 2], size + 2 * np.arange(n)
        level = self.level[-1] + 1
        parts = np.stack([best[:, 5:7], best[:, 3:5] - best[:, 5:7]], axis=1).reshape(-1, 2)
        self.feature = np.r_[self.feature, np.zeros(2 * n, np.int64)]
        self.cut = np.r_[self.cut, np.full(2 * n, _FINAL, np.uint8)]
        self.left = np.r_[self.left, size + np.arange(2 * n)]
        self.level = np.r_[self.level, np.full(2 * n, level)]
        self.gain = np.r_[self.gain, np.full(2 * n, -1.0)]
        self.count, self.total = np.r_[self.count, parts[:, 0]], np.r_[self.total, parts[:, 1]]
        new = np.arange(size, size + 2 * n)
        self.front = new[parts[:, 0] >= 2 * min_leaf] if level < depth else new[:0]

    def add_squares(self, squares: np.ndarray) -> None:
        """Sums of squares of the final nodes, added up to the root."""
        self.squares = squares
        for node in np.flatnonzero(self.cut != _FINAL)[::-1]:
            squares[node] = squares[self.left[node]] + squares[self.left[node] + 1]


_PARTIAL = "tree int, nodes binary, counts binary, sums binary"


def _partial(tree: int, nodes: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    blobs = [pa.array([x.tobytes()], pa.binary()) for x in (nodes.astype(np.int32), counts.astype(np.float64), sums)]
    return pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *blobs], ["tree", "nodes", "counts", "sums"])


def _histograms(trees: list[Tree], width: int, bins: int, seed: int):
    """Of the rows of a task: drawn rows and their labels' sums by node of the front, feature tried and bin."""

    trees = [t.stripped() for t in trees]

    def run(batches):
        k = trees[0].tried.shape[1]
        held = [np.zeros((2, len(t.front) * k * bins)) for t in trees]
        for chunk in _chunks(batches, width):
            flat, size = chunk.cells.ravel(), chunk.cells.shape[1]
            for tree, into in zip(trees, held, strict=True):
                counts, sums = chunk.bagged(seed, tree.number)
                slot = np.full(len(tree.left), -1)
                slot[tree.front] = np.arange(len(tree.front))
                at = np.flatnonzero(counts)
                node = slot.take(chunk.reached(tree, at))
                if (node < 0).any():
                    at, node = at[node >= 0], node[node >= 0]
                counts, sums = counts[at], sums[at]
                for j in range(k):
                    cell = (tree.tried[:, j] * size).take(node)
                    cell += at
                    index = (node * k + j) * bins
                    index += flat.take(cell)
                    into[0] += np.bincount(index, counts, into.shape[1])
                    into[1] += np.bincount(index, sums, into.shape[1])
        for tree, (counts, sums) in zip(trees, (h.reshape(2, -1, k * bins) for h in held), strict=True):
            met = np.flatnonzero(counts.any(axis=1))
            if len(met):
                yield _partial(tree.number, met, counts[met], sums[met])

    return run


def _squares(trees: list[Tree], width: int, seed: int):
    """Of the rows of a task: sums of the squared labels by node."""

    trees = [t.stripped() for t in trees]

    def run(batches):
        held = [np.zeros(len(t.left)) for t in trees]
        for chunk in _chunks(batches, width):
            for tree, into in zip(trees, held, strict=True):
                into += np.bincount(chunk.reached(tree, np.arange(chunk.cells.shape[1])), chunk.bagged(seed, tree.number, 2)[1], len(into))
        for tree, sums in zip(trees, held, strict=True):
            met = np.flatnonzero(sums)
            yield _partial(tree.number, met, np.zeros(0), sums[met])

    return run


def _best(counts: np.ndarray, sums: np.ndarray, min_leaf: int, least: float) -> np.ndarray:
    """The best split of each node: place of the feature tried (-1: none), last bin to the left, drop of the variance, and rows
    and sum of the node and of its left part."""
    nodes, k, bins = counts.shape
    counts, sums = counts.cumsum(axis=2), sums.cumsum(axis=2)
    n, s = counts[:, :1, -1:], sums[:, :1, -1:]
    left, right = counts[:, :, :-1], n - counts[:, :, :-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = (sums[:, :, :-1] ** 2 / left + (s - sums[:, :, :-1]) ** 2 / right - s**2 / n) / n
    gains[(left < min_leaf) | (right < min_leaf)] = -1.0
    gains = gains.reshape(nodes, -1)
    at = gains.argmax(axis=1)
    rows = np.arange(nodes)
    gain, j, b = gains[rows, at], at // (bins - 1), at % (bins - 1)
    return np.stack([np.where(gain > least, j, -1), b, gain, n[:, 0, 0], s[:, 0, 0], counts[rows, j, b], sums[rows, j, b]], axis=1)


def _merged(sizes: dict[int, tuple], finish):
    """Adds up what tasks found for each tree, and hands it to ``finish``."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for tree, nodes, counts, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                into = held.setdefault(tree, np.zeros((2, *sizes[tree])))
                at = np.frombuffer(nodes, np.int32)
                for part, blob in zip(into, (counts, sums), strict=True):
                    if blob:
                        part[at] += np.frombuffer(blob).reshape(len(at), *part.shape[1:])
        for tree, (counts, sums) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([finish(counts, sums).tobytes()], pa.binary())],
                                             ["tree", "found"])

    return run


@dataclass
class Grown:
    """Trees of a forest, which hold those of fewer trees and of less depth."""

    trees: list[Tree]
    cuts: list[np.ndarray]
    mean: float
    rows: int
    sample: np.ndarray

    def errors(self, learners: Sequence[RandomForestRegressor], held: DataFrame, metric: str) -> list[float]:
        """A metric of ``METRICS`` over these rows, of the forests of the learners' numbers of trees and depths."""
        trees, width = [t.stripped() for t in self.trees], len(self.cuts)
        wanted = [(x.getNumTrees(), x.getMaxDepth()) for x in learners]
        depths = sorted({d for _, d in wanted})

        def add_up(batches):
            n, total, squares, errors, sizes = 0, 0.0, 0.0, np.zeros(len(wanted)), np.zeros(len(wanted))
            for chunk in _chunks(batches, width):
                sums = {d: np.zeros(chunk.cells.shape[1]) for d in depths}
                repeats = np.diff(np.r_[chunk.starts, len(chunk.y)])
                for done, tree in enumerate(trees, 1):
                    for d, node in zip(depths, chunk.walked(tree, np.arange(chunk.cells.shape[1]), depths), strict=True):
                        sums[d] += (tree.total / tree.count).take(node)
                    for i, (number, d) in enumerate(wanted):
                        if number == done:
                            apart = chunk.y - np.repeat(sums[d] / number, repeats)
                            errors[i] += apart @ apart
                            sizes[i] += np.abs(apart).sum()
                n, total, squares = n + len(chunk.y), total + chunk.y.sum(), squares + chunk.y @ chunk.y
            yield pa.RecordBatch.from_arrays([pa.array([np.r_[n, total, squares, errors, sizes].tobytes()], pa.binary())], ["found"])

        stored = packed(_labelled(learners[0], held), self.cuts, self.sample, self.rows, self.mean, learners[0].getSeed())
        found = stored.coalesce(held.sparkSession.sparkContext.defaultParallelism).mapInArrow(add_up, "found binary").collect()
        n, total, squares, *rest = np.sum([np.frombuffer(r.found) for r in found], axis=0) if found else np.zeros(3 + 2 * len(wanted))
        with np.errstate(divide="ignore", invalid="ignore"):
            mse, mae = np.array(rest).reshape(2, -1) / n
            values = {"mse": mse, "rmse": np.sqrt(mse), "mae": mae, "r2": 1 - mse * n / (squares - total**2 / n)}[metric]
        return values.tolist()

    def model(self, learner: RandomForestRegressor, spark) -> RandomForestRegressionModel:
        """The forest of the learner's number of trees and depth, stored as MLlib stores it and read back."""
        depth, trees = learner.getMaxDepth(), self.trees[:learner.getNumTrees()]
        path = scratch_path(spark, "forest")
        spark.createDataFrame(pa.concat_tables([self._stored(t, depth) for t in trees])).write.parquet(f"{path}/data")
        set_, default = {}, {}
        for p in learner.params:
            if learner.isDefined(p):
                (set_ if learner.isSet(p) else default)[p.name] = learner.getOrDefault(p)

        def about(kind, uid, without=(), **more):
            return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000),
                               "sparkVersion": spark.version, "uid": uid,
                               "paramMap": {k: v for k, v in set_.items() if k not in without},
                               "defaultParamMap": {k: v for k, v in default.items() if k not in without}, **more})

        spark.createDataFrame([(about("RandomForestRegressionModel", learner.uid, numFeatures=len(self.cuts), numTrees=len(trees)),)],
                              "value string").coalesce(1).write.text(f"{path}/metadata")
        ensemble = ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")
        spark.createDataFrame([(t.number, about("DecisionTreeRegressionModel", f"{learner.uid}_{t.number}", ensemble), 1.0) for t in trees],
                              "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        return learner._copyValues(RandomForestRegressionModel.load(path))

    def _stored(self, tree: Tree, depth: int) -> pa.Table:
        kept = int(np.searchsorted(tree.level, depth, "right"))
        inner = (tree.cut[:kept] != _FINAL) & (tree.level[:kept] < depth)
        count, total, squares = tree.count[:kept], tree.total[:kept], tree.squares[:kept]
        impurity = np.maximum(squares / count - (total / count) ** 2, 0.0)
        label_sum = total + self.mean * count
        stats = np.stack([count, label_sum, squares + 2 * self.mean * total + self.mean**2 * count], axis=1)
        threshold = [self.cuts[f][c] for f, c in zip(tree.feature[:kept][inner], tree.cut[:kept][inner], strict=True)]
        split = pa.StructArray.from_arrays([
            pa.array(np.where(inner, tree.feature[:kept], -1), pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(inner)], pa.int32()), pa.array(threshold, pa.float64())),
            pa.array(np.full(kept, -1), pa.int32())], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
        child = np.where(inner, tree.left[:kept], -1)
        node = pa.StructArray.from_arrays([
            pa.array(np.arange(kept), pa.int32()), pa.array(label_sum / count), pa.array(impurity),
            pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * kept + 1, 3), pa.int32()), pa.array(stats.ravel())),
            pa.array(count.astype(np.int64)), pa.array(np.where(inner, tree.gain[:kept], -1.0)), pa.array(child, pa.int32()),
            pa.array(np.where(inner, child + 1, -1), pa.int32()), split],
            ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
        return pa.table({"treeID": pa.array(np.full(kept, tree.number), pa.int32()), "nodeData": node})


def packed(rows: DataFrame, cuts: list[np.ndarray], sample: np.ndarray, n: int, mean: float, seed: int) -> DataFrame:
    """Rows in chunks, dealt by their bins in parts of like size (a frequent cell may lie in several) and stored."""
    spark, width = rows.sparkSession, len(cuts)
    parts = spark.sparkContext.defaultParallelism
    parts *= ceil(n / (parts * PART_ROWS))
    ordered = np.sort(_order(binned(sample, cuts)))
    bounds = ordered[np.arange(1, parts) * len(ordered) // parts]

    def cut(batches):
        generator = np.random.Generator(_seeded(seed, -2, TaskContext.get().partitionId()))
        for batch in batches:
            bins = binned(np.asarray(batch.column(0).flatten()).reshape(-1, width), cuts)
            order = _order(bins)
            low, high = np.searchsorted(bounds, order, "left"), np.searchsorted(bounds, order, "right")
            part = low + (generator.random(len(bins)) * (high - low + 1)).astype(np.int64)
            ends = pa.py_buffer(np.arange(0, bins.size + 1, width, dtype=np.int32))
            blob = pa.Array.from_buffers(pa.binary(), len(bins), [None, ends, pa.py_buffer(np.ascontiguousarray(bins))])
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), blob, batch.column(1)], ["part", "bins", "y"])

    def packed_chunk(id_, bins, y):
        starts = np.flatnonzero(np.r_[True, (bins[1:] != bins[:-1]).any(axis=1)])
        blobs = [np.ascontiguousarray(bins[starts].T).tobytes(), starts.astype(np.int32).tobytes(), (y - mean).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([id_], pa.int64()), *(pa.array([b], pa.binary()) for b in blobs)],
                                          ["id", "cells", "starts", "y"])

    def pack(batches):
        place = TaskContext.get().partitionId() << 32
        kept, held = [], 0
        for batch in (b for b in batches if b.num_rows):
            column = batch.column(1)
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
            kept.append((np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(-1, width), np.asarray(batch.column(2))))
            held += len(column)
            if held >= CHUNK_ROWS:
                yield packed_chunk(place, *(np.concatenate(x) for x in zip(*kept, strict=True)))
                kept, held, place = [], 0, place + 1
        if held:
            yield packed_chunk(place, *(np.concatenate(x) for x in zip(*kept, strict=True)))

    dealt = rows.mapInArrow(cut, "part int, bins binary, y double").repartitionById(parts, "part").sortWithinPartitions("bins", "y")
    return materialise(dealt.mapInArrow(pack, "id bigint, cells binary, starts binary, y binary"), "forest-rows")


def _labelled(learner: RandomForestRegressor, dataset: DataFrame) -> DataFrame:
    return dataset.select(vector_to_array(learner.getFeaturesCol()).alias("x"), F.col(learner.getLabelCol()).cast("double").alias("y"))


def grow(learner: RandomForestRegressor, dataset: DataFrame) -> Grown:
    """The learner's trees on these rows."""
    spark, seed, depth = dataset.sparkSession, learner.getSeed(), learner.getMaxDepth()
    rows = _labelled(learner, dataset)
    known = rows.agg(F.count("*").alias("n"), F.avg("y").alias("mean"), F.var_pop("y").alias("spread"),
                     F.count_if(F.col("y").isNull() | F.isnan("y")).alias("unknown")).first()
    if not known.n or known.unknown:
        raise ValueError(f"a forest cannot learn from {known.n} rows, {known.unknown} of them without a label")
    enough = max(learner.getMaxBins() ** 2, SPLIT_ROWS)
    taken = rows.sample(enough / known.n, seed) if known.n > enough else rows
    sample = np.array([r.x for r in taken.select("x").collect()])
    cuts = [thresholds(values, min(learner.getMaxBins(), known.n) - 1) for values in sample.T]
    width, bins = len(cuts), max(1, *map(len, cuts)) + 1
    trees = [Tree(t) for t in range(learner.getNumTrees())]
    stored = packed(rows, cuts, sample, known.n, known.mean, seed).coalesce(spark.sparkContext.defaultParallelism)
    k, min_leaf, least = ceil(width / 3), learner.getMinInstancesPerNode(), 1e-12 * known.spread  # less is rounding

    def found(group, mapped, sizes, finish):
        partial = stored.mapInArrow(mapped, _PARTIAL).repartition(min(len(group), 2 * spark.sparkContext.defaultParallelism), "tree")
        return {r.tree: np.frombuffer(r.found) for r in partial.mapInArrow(_merged(sizes, finish), "tree int, found binary").collect()}

    for _ in range(max(1, depth)):
        left = [t for t in trees if len(t.front)]
        while left:
            group, used = [], 0
            while left and (not group or used + 16 * len(left[0].front) * k * bins <= HISTOGRAM_BYTES):
                used += 16 * len(left[0].front) * k * bins
                group.append(left.pop(0))
            for t in group:
                t.try_features(seed, width, k)
            sizes = {t.number: (len(t.front), k * bins) for t in group}
            best = found(group, _histograms(group, width, bins, seed), sizes,
                         lambda c, s: _best(c.reshape(len(c), k, -1), s.reshape(len(s), k, -1), min_leaf, least))
            for t in group:
                t.split(best[t.number].reshape(-1, 7).copy(), depth, min_leaf)
    sums = found(trees, _squares(trees, width, seed), {t.number: (len(t.left),) for t in trees}, lambda c, s: s)
    for t in trees:
        t.add_squares(sums[t.number].copy())
    return Grown(trees, cuts, known.mean, known.n, sample)


class Forest(RandomForestRegressor):
    """``RandomForestRegressor`` that learns here, and in MLlib where it is given settings that only MLlib knows."""

    def learns_here(self, dataset: DataFrame) -> bool:
        if self.getFeaturesCol() not in dataset.columns:
            return False
        attributes = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        return (not (self.isDefined(self.weightCol) and self.getWeightCol()) and "nominal" not in attributes and "binary" not in attributes
                and self.getOrDefault(self.minInfoGain) == 0 and self.getOrDefault(self.minWeightFractionPerNode) == 0
                and self.getSubsamplingRate() == 1 and self.getOrDefault(self.bootstrap) and self.getMaxBins() <= _FINAL
                and self.getFeatureSubsetStrategy() in ("auto", "onethird") and self.getNumTrees() > 1)

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        if not self.learns_here(dataset):
            return super()._fit(dataset)
        return grow(self, dataset).model(self, dataset.sparkSession)
