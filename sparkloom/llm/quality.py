"""Quality rules: gradient-boosted trees over document statistics, scored from flat numpy node arrays.

The trees are fitted on a bounded sample of labelled documents (logistic loss,
quantile bins). Chosen features are monotonic: a split that would turn the score
against the feature's direction is refused, and the values of later splits stay
on their side of the middle between the two children.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .common import map_texts, memory

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Fixed value: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Labelled documents that training uses at most: the documented bound.
SAMPLE_ROWS = 8000
#: feature -> direction of the quality score as the feature grows (0: free)
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": 0,
    "digit_share": 0, "stop_share": 0, "mean_line": 0, "distinct_share": 0, "long_word_share": 0, "punct_share": 0,
    "longest_word": 0, "end_mark_share": 0, "top_word_share": 0,
}


_TRAITS: dict[str, int] = memory("quality")


def _traits(word: str) -> int:
    """Bits of a word: starts upper case, holds a digit, ends in a mark, ends in a full stop or the like."""
    return (word[0].isupper() | any(c.isdigit() for c in word) << 1 | (not word[-1].isalnum()) << 2
            | (word[-1] in ".!?") << 3)


def _repeat_words(words: list[str], number: dict[str, int]) -> int:
    """Words that lie in a window of ``WINDOW`` words found twice or more, first included."""
    n = len(words) - WINDOW + 1
    if n < 2 or len(number) == len(words):
        return 0
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    code, radix = ids[:n], len(number) + 1
    for k in range(1, WINDOW):  # exact: codes are ranked anew before they could overflow
        if int(code.max()) + 1 > 2 ** 62 // radix:
            code = np.unique(code, return_inverse=True)[1]
        code = code * radix + ids[k:k + n]
    by = np.argsort(code, kind="stable")
    same = np.diff(code[by]) == 0
    if not same.any():
        return 0
    hit = by[np.r_[same, False] | np.r_[False, same]]
    step = np.zeros(len(words) + 1, np.int64)
    step[hit] += 1
    step[hit + WINDOW] -= 1
    return int((np.cumsum(step)[:-1] > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the features."""
    text = text or ""
    words = _WORDS.findall(text)
    n = len(words)
    symbols = sum(map(text.count, SYMBOLS))
    met: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if _WORDS.search(line):
            lines += 1
            if line in met:
                dup += 1
            met.add(line)
    count = Counter(words)
    if len(_TRAITS) > 200_000:
        _TRAITS.clear()
    for w in count:
        if w not in _TRAITS:
            _TRAITS[w] = _traits(w)
    often = np.fromiter(count.values(), np.int64, len(count))
    lengths = np.fromiter(map(len, count), np.int64, len(count))
    traits = np.fromiter(map(_TRAITS.__getitem__, count), np.int64, len(count))
    chars = int((often * lengths).sum())
    repeat = _repeat_words(words, dict(zip(count, range(len(count)), strict=True)))
    size, each = max(1, chars), max(1, n)
    upper, digit, mark, stop = (float((often * (traits >> k & 1)).sum()) / each for k in range(4))
    return [n, chars, symbols, dup, repeat], [
        float(np.log1p(n)), chars / each, symbols / size, dup / max(1, lines), repeat / each, upper, digit,
        float(often[lengths <= 3].sum()) / each, each / max(1, lines), len(count) / each,
        float(often[lengths > 12].sum()) / each, mark, float(lengths.max()) if n else 0.0, stop,
        float(often.max()) / each if n else 0.0]


class Trees:
    """Boosted trees in flat arrays: feature, threshold (go left if at most), left, right, value; roots in order."""

    def __init__(self, start: float):
        self.start, self.roots = start, []
        self.nodes: list[tuple[int, float, int, int, float]] = []
        self.flat: tuple[np.ndarray, ...] | None = None

    def flatten(self) -> Trees:
        cols = list(zip(*self.nodes, strict=True)) if self.nodes else [(), (), (), (), ()]
        self.flat = tuple(np.array(c, t) for c, t in zip(cols, (int, float, int, int, float), strict=True))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        if self.flat is None:
            self.flatten()
        feature, cut, left, right, value = self.flat
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                low = x[rows, np.maximum(feature[at], 0)] <= cut[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            out += value[at]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 80, depth: int = 4, rate: float = 0.15,
              bins: int = 48, ridge: float = 2.0, least: int = 8) -> Trees:
    """Boosting with logistic loss; ``directions`` holds 1, -1 or 0 per feature. One class only: a constant."""
    if not len(y) or y.min() == y.max():
        return Trees(6.0 if not len(y) or y.min() == 1 else -6.0).flatten()
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    out = Trees(float(np.log(y.mean() / (1 - y.mean()))))
    f_now = np.full(len(y), out.start)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        here = float(np.clip(total_g / (total_h + ridge), low, high))
        best = None
        if level < depth and len(rows) >= 2 * least:
            for f in range(x.shape[1]):
                k = len(cuts[f])
                if not k:
                    continue
                c = codes[rows, f]
                lg, lh, ln = (np.cumsum(np.bincount(c, v, k + 1))[:-1] for v in (g[rows], h[rows], None))
                rg, rh = total_g - lg, total_h - lh
                lv, rv = np.clip(lg / (lh + ridge), low, high), np.clip(rg / (rh + ridge), low, high)
                gain = lg * lv - 0.5 * (lh + ridge) * lv ** 2 + rg * rv - 0.5 * (rh + ridge) * rv ** 2
                fine = (ln >= least) & (len(rows) - ln >= least)
                if directions[f]:
                    fine &= (rv - lv) * directions[f] >= 0
                gain = np.where(fine, gain, -np.inf)
                at = int(gain.argmax())
                if gain[at] > -np.inf and (best is None or gain[at] > best[0]):
                    best = (gain[at], f, at, lv[at], rv[at])
        base = total_g * here - 0.5 * (total_h + ridge) * here ** 2
        node = len(out.nodes)
        out.nodes.append((-1, 0.0, node, node, rate * here))
        if best is not None and best[0] > base + 1e-9:
            _, f, at, lv, rv = best
            middle, go = (lv + rv) / 2, codes[rows, f] <= at
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)),
                      0: ((low, high), (low, high))}[directions[f]]
            left = grow(rows[go], g, h, level + 1, *bounds[0])
            right = grow(rows[~go], g, h, level + 1, *bounds[1])
            out.nodes[node] = (f, float(cuts[f][at]), left, right, 0.0)
        return node

    for _ in range(trees):
        p = 1 / (1 + np.exp(-f_now))
        out.roots.append(grow(np.arange(len(y)), y - p, p * (1 - p), 0, -np.inf, np.inf))
        one = Trees(0.0)
        one.nodes, one.roots = out.nodes, out.roots[-1:]
        f_now += one.flatten().margin(x)
    return out.flatten()


_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Train on at most ``sample_rows`` labelled documents, taken in the order of a hash of the id."""
    known = labels.where(labels["quality"].isNotNull() & labels["doc_id"].isNotNull()).select(
        labels["doc_id"].alias("k"), (labels["quality"] > 0).cast("int").alias("y")).distinct()
    chosen = [(r["k"], r["y"]) for r in known.orderBy(F.xxhash64("k"), "k", "y").limit(sample_rows).collect()]
    directions = list(FEATURES.values())
    if not chosen:
        return fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0), directions)
    picked = F.broadcast(docs.sparkSession.createDataFrame(chosen, "k bigint, y int"))
    rows = map_texts(docs.select(docs["doc_id"], docs["text"]).join(picked, docs["doc_id"] == picked["k"])
                     .select("k", "y", "text"), ["k", "y", "text"],
                     T.StructType.fromDDL("k bigint, y int, x array<double>"),
                     lambda kept, texts: [*kept, [statistics(t)[1] for t in texts]], "quality").collect()
    rows.sort(key=lambda r: (r["k"], r["y"], r["x"]))
    return fit_trees(np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES)),
                     np.array([r["y"] for r in rows], float), directions)


def rate_documents(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text",
                   cut: float = 0.5) -> DataFrame:
    """Per row: id, the base counts, base_failed, quality (0 to 1), kept.

    ``base_failed``: fewer than ``MIN_WORDS`` words, or over ``MAX_REPEAT_PERCENT``
    of the words in repeated windows; such a document is not kept, others are if
    ``quality`` reaches ``cut``. Null, empty and blank texts have no words and
    fail. One row per input row; other columns are ignored; an empty table gives
    no rows.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           *T.StructType.fromDDL(", ".join(f"{c} bigint" for c in _BASE)
                                                 + ", base_failed boolean, quality double, kept boolean").fields])

    def made(kept: list, texts: list) -> list:
        found = [statistics(t) for t in texts]
        p = model.probability(np.array([f for _, f in found]).reshape(-1, len(FEATURES)))
        base = np.array([b for b, _ in found], np.int64).reshape(-1, len(_BASE))
        failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])
        return [kept[0], *[base[:, i].tolist() for i in range(len(_BASE))], failed.tolist(), p.tolist(),
                (~failed & (p >= cut)).tolist()]

    return map_texts(docs, [id_col, text_col], schema, made, "quality")
