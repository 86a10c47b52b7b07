"""Toxicity by a subsequence string kernel, Nystroem landmarks and a linear support vector machine.

The kernel of two words is the gap-weighted number of common subsequences of
three characters (Lodhi et al., 2002): a subsequence weighs ``DECAY`` to the
power of its span, so letters put in between weaken a match but do not end it.
Landmarks are words of the labelled sentences; a word is described by its
normalised kernel with them, whitened by the landmarks' own kernel matrix, and a
support vector machine is trained on that. A sentence carries its document's
label; of a toxic document only the words that tell it apart are positive
examples, which later rounds choose by the machine itself.

The trained machine is a weight per subsequence: the sum over landmarks of their
dual weight and their subsequences. Scoring a word is then one pass over its own
subsequences, equal to kernel and whitening. A document's score is a logistic
regression on how many of its words lie how far on the wrong side.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import filter_texts, map_texts, memory

ORDER = 3
DECAY = 0.6
#: Subsequences may span as many characters.
SPAN = 6
#: Longer words are read in pieces of this length that overlap by half.
PIECE = 16
#: Documents of the labelled sample, toxic and clean: the documented bound of training.
TOXIC_ROWS = 2000
CLEAN_ROWS = 3000
LANDMARKS = 160
#: Word pieces whose subsequences are in memory together.
PIECES_AT_ONCE = 3000
CUT = 0.7
#: Wrong verdicts on clean documents weigh as much as this many on toxic ones when the cut is set.
CLEAN_COUNTS = 3
#: A gram tells if clean documents hold it at most this much as often as toxic ones.
RARER = 0.4
_CLASSES = 40
_TABLE = _CLASSES ** ORDER

_TOKEN = re.compile(r"[^\W_]+(?:[^\w\s]+[^\W_]+)*", re.UNICODE)
_LONE = re.compile(r"(?<![^\W_])[^\W_](?:[\s\W_]{1,3}[^\W_](?![^\W_])){2,}", re.UNICODE)


def units(text: str | None) -> Counter:
    """The words of a text, counted: lower case, marks inside a word dropped, runs of single letters joined."""
    low = (text or "").lower()
    out: Counter = Counter()
    for w, n in Counter(_TOKEN.findall(low)).items():
        if w.isalnum():
            out[w] += n
        else:
            parts = [x for x in re.split(r"[\W_]+", w) if x]
            for x in {"".join(parts), *parts}:
                out[x] += n
    for w in _LONE.findall(low):
        out[re.sub(r"[\W_]+", "", w)] += 1
    return out


def _codes(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pieces grouped by length: (character classes, the word each piece belongs to)."""
    by: dict[int, tuple[list[str], list[int]]] = {}
    for i, w in enumerate(words):
        w = f"^{w}$"
        for p in [w] if len(w) <= PIECE else [w[k:k + PIECE] for k in range(0, len(w) - PIECE // 2, PIECE // 2)]:
            texts, owner = by.setdefault(len(p), ([], []))
            texts.append(p)
            owner.append(i)
    out = []
    for n, (texts, owner) in by.items():
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
        # letters a-z, the two edges, and thirteen classes for everything else
        c = np.where((points >= 97) & (points <= 122), points - 97,
                     np.where(points == 94, 26, np.where(points == 36, 27, 28 + points % (_CLASSES - 28))))
        out.append((c.astype(np.int64), np.array(owner)))
    return out


def _subsequences(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all subsequences of three characters within ``SPAN`` and the weight of each place."""
    n = c.shape[1]
    places = [p for p in combinations(range(n), ORDER) if p[-1] - p[0] < SPAN]
    if not places:
        return np.zeros((len(c), 0), np.int64), np.zeros(0)
    at = np.array(places)
    return ((c[:, at[:, 0]] * _CLASSES + c[:, at[:, 1]]) * _CLASSES + c[:, at[:, 2]],
            DECAY ** (at[:, 2] - at[:, 0] + 1.0))


def _rows(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each piece's different subsequences with their summed weights, and the piece's norm; 0 weight marks a repeat."""
    code, weight = _subsequences(c)
    by = np.argsort(code, axis=1)
    code = np.take_along_axis(code, by, 1)
    weight = weight[by]
    if code.shape[1]:
        first = np.concatenate([np.ones((len(code), 1), bool), code[:, 1:] != code[:, :-1]], 1)
        total = np.cumsum(weight, 1)
        last = np.concatenate([first[:, 1:], np.ones((len(code), 1), bool)], 1)
        upto = np.where(last, total, 0)
        prior = np.maximum.accumulate(np.concatenate([np.zeros((len(code), 1)), upto[:, :-1]], 1), 1)
        weight = np.where(last, total - prior, 0)
    return code, weight, np.sqrt((weight ** 2).sum(1))


def _vectors(words: list[str], column: np.ndarray | None = None, width: int = _TABLE) -> np.ndarray:
    """Normalised subsequence vectors of words; with ``column`` only the subsequences that have one there."""
    out = np.zeros((len(words), width))
    for c, owner in _codes(words):
        code, weight, norm = _rows(c)
        weight = weight / np.maximum(norm, 1e-12)[:, None]
        at = code if column is None else column[code]
        for row in range(len(c)):
            has = at[row] >= 0
            np.add.at(out[owner[row]], at[row][has], weight[row][has])
    return out


def _columns(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The subsequences these words hold, in order, and the place of each subsequence among them (-1: none)."""
    used = np.unique(np.concatenate([_subsequences(c)[0].ravel() for c, _ in _codes(words)]))
    column = np.full(_TABLE, -1, np.int64)
    column[used] = np.arange(len(used))
    return used, column


def margins(words: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """The machine's margin of each word, the highest of its pieces."""
    best = np.full(len(words), -np.inf)
    for c, owner in _codes(words):
        for k in range(0, len(c), PIECES_AT_ONCE):
            code, weight, norm = _rows(c[k:k + PIECES_AT_ONCE])
            f = (table[code] * weight).sum(1) / np.maximum(norm, 1e-12) + bias
            np.maximum.at(best, owner[k:k + PIECES_AT_ONCE], f)
    return best


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 1000.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the support vectors; classes weigh alike in sum."""
    n, d = x.shape
    xb = np.hstack([x, np.ones((n, 1))])
    each = cost * np.where(y > 0, weight / max(1e-9, weight[y > 0].sum()), weight / max(1e-9, weight[y < 0].sum()))
    w, reg = np.zeros(d + 1), np.r_[np.ones(d), 1e-3]
    for _ in range(steps):
        m = 1 - y * (xb @ w)
        on = m > 0
        if not on.any():
            break
        a = xb[on] * each[on, None]
        new = np.linalg.solve(xb[on].T @ a + np.diag(reg), a.T @ y[on])
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w[:-1], float(w[-1])


def _different(bags: list[Mapping[str, int]]) -> list[Mapping[str, int]]:
    """The bags without near copies of earlier ones, so that the words of a copied text do not count again."""
    met: dict[tuple[int, int], list[int]] = {}
    kept = []
    for bag in bags:
        raw = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in bag), np.uint64, len(bag))
        low = [int(((raw * np.uint64(2654435761 + 2 * i * 97531) + np.uint64(i)) % np.uint64(4294967291)).min())
               for i in range(12)]
        near: dict[int, int] = {}
        for key in enumerate(low):
            for other in met.get(key, []):
                near[other] = near.get(other, 0) + 1
        if max(near.values(), default=0) < 4:
            for key in enumerate(low):
                met.setdefault(key, []).append(len(kept))
            kept.append(bag)
    return kept


class Bag(Mapping):
    """Counted words held in a tuple and an array, a fraction of a Counter's memory."""

    __slots__ = ("words", "counts")

    def __init__(self, words: tuple[str, ...], counts: array):
        self.words, self.counts = words, counts

    def __getitem__(self, word: str) -> int:
        try:
            return self.counts[self.words.index(word)]
        except ValueError:
            raise KeyError(word) from None

    def __iter__(self) -> Iterator[str]:
        return iter(self.words)

    def __len__(self) -> int:
        return len(self.words)

    def items(self):
        return zip(self.words, self.counts, strict=True)

    def values(self):
        return self.counts


def train(bags: list[tuple[Mapping[str, int], int]], landmarks: int = LANDMARKS, rounds: int = 2, seed: int = 5) -> dict:
    """Fit on (distinct words, label) of documents; returns table, bias, scale and middle of the score.

    With no toxic or no clean document in the sample nothing can be learnt: every
    score is then 0.
    """
    none = {"table": np.zeros(_TABLE), "bias": -1.0, "weights": np.zeros(_FEATURES + 1), "middle": 40.0}
    toxic = [b for b, y in bags if y == 1 and b]
    clean = [b for b, y in bags if y == 0 and b]
    if not toxic or not clean:
        return none
    rng = np.random.default_rng(seed)

    def grams(word: str) -> set[str]:
        w = f"^{word}$"
        return {w[i:i + n] for n in (4, 5, 6) for i in range(max(1, len(w) - n + 1))}

    def frequency(bag_list: list[Mapping[str, int]], among: set[str] | None = None) -> dict[str, int]:
        seen: dict[str, int] = {}
        for bag in bag_list:
            held = set().union(*map(grams, bag))
            for g in held if among is None else held & among:
                seen[g] = seen.get(g, 0) + 1
        return seen

    toxic, clean = _different(toxic), _different(clean)
    in_toxic = frequency(toxic)
    share = len(toxic) / (len(toxic) + len(clean))
    # log likelihood ratio against "as often in either kind"; chance alone among so many grams stays below the level
    level = np.log(len(in_toxic) + 1.0)
    # a gram reaches the level in clean documents only if it would without any
    in_toxic = {g: n for g, n in in_toxic.items() if n * np.log(1 / share) >= level}
    in_clean = frequency(clean, set(in_toxic))

    def surprise(n: int, c: int) -> float:
        p = n / (n + c)
        if p <= share or c * len(toxic) > RARER * n * len(clean):
            return 0.0
        return n * np.log(p / share) + (c * np.log((1 - p) / (1 - share)) if c else 0.0)

    value = {g: x for g, n in in_toxic.items() if (x := surprise(n, in_clean.get(g, 0))) >= level}

    def contrast(word: str) -> float:
        return max((value.get(g, 0.0) for g in grams(word)), default=0.0)

    told = {w: contrast(w) for w in set().union(*toxic)}
    often: dict[str, int] = {}
    for bag in clean:
        for word in bag:
            often[word] = often.get(word, 0) + 1
    ordinary = sorted(often)
    in_bags = Counter(w for bag in toxic for w in bag)
    harmless = {w for w in ordinary if often[w] * len(toxic) > RARER * in_bags[w] * len(clean)}
    positive: list[str] = []
    for bag in toxic:
        best = max((told[w] for w in bag if w not in harmless), default=0.0)
        if best > 0:
            positive += [w for w in bag if w not in harmless and told[w] >= 0.5 * best]
    if not positive:
        return none
    count: dict[str, int] = {}
    for w in positive:
        count[w] = count.get(w, 0) + 1
    ranked = sorted(count, key=lambda w: (-count[w], w))
    sample = [ordinary[i] for i in rng.permutation(len(ordinary))[:2500]]
    marks = ranked[: landmarks // 2]
    marks += sample[: landmarks - len(marks)]
    # subsequences of no landmark add nothing to a kernel with one
    used, column = _columns(marks)
    lv = _vectors(marks, column, len(used))
    values, vectors = np.linalg.eigh(lv @ lv.T)
    keep = values > 1e-8 * values.max()
    whole = lv.T @ (vectors[:, keep] / np.sqrt(values[keep]))
    del lv
    pos, neg = ranked[:1200], sample
    table, bias = np.zeros(_TABLE), 0.0
    for _ in range(rounds + 1):
        words = pos + neg
        x = _project(words, whole, column)
        y = np.r_[np.ones(len(pos)), -np.ones(len(neg))]
        weight = np.array([1.0 + count.get(v, 0) for v in pos] + [1.0 + often[v] for v in neg]) ** 0.5
        w, bias = _svm(x, y, weight)
        table = np.zeros(_TABLE)
        table[used] = whole @ w
        hard = margins(ordinary, table, bias)
        neg = sorted(set(sample) | {ordinary[i] for i in np.argsort(-hard)[:1500]})
        chosen: dict[str, int] = {}
        for bag in toxic:
            listed = sorted(w for w in bag if w not in harmless and told[w] > 0)
            if listed:
                m = margins(listed, table, bias)
                for i in np.flatnonzero(m >= max(0.0, 0.8 * m.max())) if m.max() > 0 else [int(m.argmax())]:
                    if m[i] > -0.2:
                        chosen[listed[i]] = chosen.get(listed[i], 0) + 1
        pos, count = (sorted(chosen, key=lambda v: (-chosen[v], v))[:1200], chosen) if chosen else (pos, count)
    # how the margins of a document's words add up to its score
    x = np.array([_evidence(b, dict(zip(b, margins(list(b), table, bias).tolist(), strict=True))) for b in toxic + clean])
    y = np.r_[np.ones(len(toxic)), np.zeros(len(clean))]
    weights = _logistic(x, y)
    z = np.hstack([x, np.ones((len(x), 1))]) @ weights
    cuts = np.unique(z)
    middles = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    low, high = np.sort(z[y == 0]), np.sort(z[y == 1])
    wrong = ((len(low) - np.searchsorted(low, middles)) / len(low) * CLEAN_COUNTS
             + np.searchsorted(high, middles) / len(high))
    best = middles[wrong <= wrong.min() + 1e-12]
    return {"table": table, "bias": bias, "weights": weights, "middle": float((best[0] + best[-1]) / 2)}


_FEATURES = 6


def _evidence(bag: Mapping[str, int], margin: dict[str, float]) -> list[float]:
    """What a document's words come to: highest margin, second highest, number and share above two levels."""
    if not bag:
        return [-1.0, -1.0, 0.0, 0.0, 0.0, 0.0]
    n = sum(bag.values())
    top = sorted(bag, key=lambda w: -margin[w])[:2]
    first = margin[top[0]]
    second = first if bag[top[0]] > 1 else margin[top[-1]] if len(top) > 1 else -1.0
    some = sum(k for w, k in bag.items() if margin[w] > 0)
    strong = sum(k for w, k in bag.items() if margin[w] > 0.6)
    return [first, second, float(np.log1p(some)), float(np.log1p(strong)), min(10.0, 100.0 * some / (n + 20)),
            min(10.0, 100.0 * strong / (n + 20))]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 60) -> np.ndarray:
    """Weights and intercept of a logistic regression with classes weighing alike."""
    xb = np.hstack([x, np.ones((len(x), 1))])
    each = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum())) * 1000
    w, reg = np.zeros(xb.shape[1]), np.r_[np.full(x.shape[1], ridge), 1e-4]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(xb @ w, -30, 30)))
        step = np.linalg.solve(xb.T @ (xb * (each * p * (1 - p) + 1e-9)[:, None]) + np.diag(reg),
                               xb.T @ (each * (y - p)) - reg * w)
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return w


def _project(words: list[str], whole: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Nystroem features of words."""
    return np.vstack([_vectors(words[k:k + 100], column, len(whole)) @ whole for k in range(0, len(words), 100)])


def to_score(bag: Counter, margin: dict[str, float], model: dict) -> float:
    """0 to 1, ``CUT`` at the middle found in training."""
    if not bag:
        return 0.0
    z = float(np.dot(model["weights"][:-1], _evidence(bag, margin)) + model["weights"][-1]) - model["middle"]
    return float(1 / (1 + np.exp(-np.clip(z + np.log(CUT / (1 - CUT)), -40, 40))))


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from: crc32 of the id's text leaves 1 on division by 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> dict:
    """Train on a bounded sample of labelled, not held-out documents, taken in the order of a hash of the id."""
    known = (labels.where(labels["toxic"].isNotNull() & labels["doc_id"].isNotNull()).where(~held_out(labels["doc_id"]))
             .select(labels["doc_id"].alias("k"), (labels["toxic"] > 0).cast("int").alias("y")).distinct())
    chosen = []
    for y, bound in ((1, toxic_rows), (0, clean_rows)):
        chosen += [(r["k"], y) for r in known.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(bound).collect()]
    if not chosen:
        return train([])
    picked = F.broadcast(docs.sparkSession.createDataFrame(chosen, "k bigint, y int"))
    schema = T.StructType.fromDDL("y int, words string")
    bags = map_texts(docs.select(docs["doc_id"], docs["text"]).join(picked, docs["doc_id"] == picked["k"])
                     .select("y", "text"), ["y", "text"], schema,
                     lambda kept, texts: [kept[0], [" ".join(f"{w} {n}" for w, n in units(t).items()) for t in texts]]).collect()
    # one string per word, however many documents hold it
    held = sorted(((r["y"], r["words"]) for r in bags), reverse=True)
    del bags
    one: dict[str, str] = {}
    counted = []
    while held:
        y, words = held.pop()
        parts = words.split(" ") if words else []
        counted.append((Bag(tuple(one.setdefault(w, w) for w in parts[::2]), array("q", map(int, parts[1::2]))), y))
    del one
    return train(counted)


_SEEN: dict[bytes, dict[str, float]] = memory("toxicity")


def _scorer(model: dict):
    """A function from texts to (score, worst word) of each; a worker keeps the margins of words it has met."""
    table, bias = model["table"].astype(np.float32), model["bias"]
    digest = hashlib.sha256(table.tobytes() + repr(bias).encode()).digest()

    def made(texts: list) -> tuple[list, list]:
        scores, worst = [], []
        seen = _SEEN.setdefault(digest, {})
        for k in range(0, len(texts), 512):
            bags = [units(t) for t in texts[k:k + 512]]
            if len(seen) > 300_000:
                seen.clear()
            new = sorted(set().union(*bags).difference(seen))
            for i in range(0, len(new), 20_000):
                seen.update(zip(new[i:i + 20_000], margins(new[i:i + 20_000], table, bias).tolist(), strict=True))
            for bag in bags:
                scores.append(to_score(bag, seen, model))
                worst.append(max(((seen[w], w) for w in bag), default=(0, None))[1])
        return scores, worst

    return made


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, score, predicted, worst_word.

    ``score`` weighs the margins of all words of the whole text; null, empty and
    wordless texts score 0. One row per input row; a null id is not held out;
    other columns are ignored; an empty table gives no rows.
    """
    scorer = _scorer(model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("score", T.DoubleType()), T.StructField("worst_word", T.StringType())])
    out = map_texts(docs, [id_col, text_col], schema, lambda kept, texts: [kept[0], *scorer(texts)], "toxicity")
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                      (F.col("score") >= CUT).cast("int").alias("predicted"), "worst_word")


def reject(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, all columns as they were; decided in the scan, nothing is shuffled."""
    scorer = _scorer(model)
    return filter_texts(docs, text_col, lambda texts: [s < CUT for s in scorer(texts)[0]], "toxicity")
