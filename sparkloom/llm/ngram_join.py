"""N-gram Jaccard self-join: MinHash bands find groups, full n-gram sets decide.

1. Every text becomes the set of its n-word shingles (64-bit hashes), a 128-bit
   fingerprint of that set and a MinHash signature cut into bands. Texts with one
   fingerprint are copies; one row per fingerprint goes on, with their number.
2. Rows are shuffled on (band, hash). A bucket ties its rows to the smallest one
   in it, never to each other, and the components of these ties are groups:
   any two texts that agree in a band are in one group.
3. A group is cut into pieces of at most ``PIECE`` texts on average. The full sets
   of a piece are compared by an inverted index; the piece is then packed into one
   row, and every pair of pieces of a group is one task group that compares the
   one's sets with the other's. Both return one row per text: its links and its
   root among them. So no pair is ever a row, and a group of any size is spread
   over many tasks.

Cost: comparing a group of m near copies ships each packed piece m / PIECE times;
the number of links of each is a figure over all pairs, so this cannot be avoided.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from .common import components, discard, likely, map_texts, memory, store

N_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
HASHES = 256
#: Texts of a piece of a group, and bytes of n-gram hashes that a piece holds at the mean: two pieces fit a worker and
#: take seconds to compare, so a group is shipped as seldom as memory allows.
PIECE = 1024
PIECE_BYTES = 8 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORDS: dict[str, int] = memory("ngram_join")


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective banding within ``hashes`` that meets ``recall`` at the threshold."""
    best = None
    for rows in range(1, hashes + 1):
        hit = threshold ** rows
        if hit < 1e-9:
            break
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding meets this recall with so few hashes")
    return best


def _word_hashes(words: list[str]) -> np.ndarray:
    if len(_WORDS) > 300_000:
        _WORDS.clear()
    for w in set(words).difference(_WORDS):
        _WORDS[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None, n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; a shorter text is one shingle, no words give none."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = _word_hashes(words)
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, np.uint64(k), np.uint64)
    for j in range(k):
        out = (out ^ h[j:len(h) - k + 1 + j]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _signature(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(x), 256):
        np.minimum(low, (x[None, i:i + 256] * a[:, None]).min(axis=1), out=low)
    return low


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """d: what a row is known by (its id and a digest of its text), x: the text."""
    text = F.coalesce(df[text_col], F.lit(""))
    return df.select(F.struct(df[id_col].alias("id"), F.xxhash64(text).alias("h")).alias("d"), text.alias("x"))


def _fingerprints(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """d, f1, f2 (fingerprint of the set), size, bands (hash per band)."""
    a = np.random.default_rng(20).integers(1, 2 ** 63, bands * rows, dtype=np.uint64) | np.uint64(1)

    def made(kept: list, texts: list) -> list[list]:
        out: list[list] = [[], [], [], []]
        for text in texts:
            x = shingles(text, n)
            d = xxhash.xxh3_128_intdigest(x.tobytes())
            keys = []
            if len(x):
                sig = _signature(x, a).reshape(bands, rows)
                keys = [xxhash.xxh3_64_intdigest(sig[i].tobytes(), seed=i) - 2 ** 63 for i in range(bands)]
            for column, value in zip(out, ((d >> 64) - 2 ** 63, (d & (2 ** 64 - 1)) - 2 ** 63, len(x), keys), strict=True):
                column.append(value)
        return [kept[0], *out]

    schema = T.StructType([docs.schema["d"], *T.StructType.fromDDL("f1 bigint, f2 bigint, size bigint, bands array<bigint>")])
    return map_texts(docs, ["d", "x"], schema, made, "ngram_join")


def _grouped_texts(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """The rows of ``placed`` with the text that stands for each."""
    # texts of no group are left out where they are read; repeated rows are made one before they are shuffled to their group
    texts = likely(docs, placed, "d").join(placed.select("d"), "d", "left_semi").groupBy("d").agg(F.first("x").alias("x"))
    return texts.join(placed, "d").select("root", "piece", "cuts", "rep", "copies", "x")


def _near(rep: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], threshold: float,
          split: int | None = None) -> pd.DataFrame:
    """Links and local roots of the sets that have a link: each with each, or those before ``split`` with the others."""
    size = np.array([len(s) for s in sets])
    flat, ends = np.concatenate(sets), np.cumsum(size)
    starts = ends - size
    _, local = np.unique(flat, return_inverse=True)
    links, texts = np.zeros(len(rep), np.int64), np.zeros(len(rep), np.int64)
    root = np.arange(len(rep))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    flag = np.zeros(len(flat), np.int32)
    for x in range(len(rep) - 1 if split is None else split):
        begin = x + 1 if split is None else split
        mine = local[starts[x]:ends[x]]
        flag[mine] = 1
        common = np.add.reduceat(flag[local[starts[begin]:]], starts[begin:] - starts[begin])
        flag[mine] = 0
        near = common >= threshold * (size[begin:] + size[x] - common) - 1e-9
        for y in (np.nonzero(near)[0] + begin).tolist():
            links[x] += copies[y]
            links[y] += copies[x]
            texts[x] += 1
            texts[y] += 1
            p, q = find(x), find(y)
            if p != q:
                # the root of a local class is its smallest number
                low, high = (p, q) if rep[p] < rep[q] else (q, p)
                root[high] = low
    linked = np.nonzero(texts)[0]
    return pd.DataFrame({"rep": rep[linked], "links": links[linked], "texts": texts[linked],
                         "top": rep[[find(int(x)) for x in linked]]})


#: What comparing sets returns per linked text, and a piece packed into one row for its meetings with other pieces.
_LINKS = "rep bigint, links bigint, texts bigint, top bigint"
_PACKED = "root bigint, piece int, cuts int, reps array<bigint>, copies array<bigint>, sizes array<int>, grams binary"


def _within(n: int, threshold: float):
    """Compare the texts of one piece; if its group has more pieces, pack their sets as well.

    Sets of near copies repeat each other, so a packed piece takes a fraction of
    the bytes of its sets, and only packed pieces are shipped to each other.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [shingles(x, n) for x in pdf["x"]]
        rep, copies = pdf["rep"].to_numpy(), pdf["copies"].to_numpy()
        out = _near(rep, copies, sets, threshold).assign(packed=None)
        cuts = int(pdf["cuts"].iloc[0])
        if cuts > 1:
            row = {"root": int(pdf["root"].iloc[0]), "piece": int(pdf["piece"].iloc[0]), "cuts": cuts,
                   "reps": rep.tolist(), "copies": copies.tolist(), "sizes": [len(s) for s in sets],
                   "grams": zstandard.ZstdCompressor().compress(np.concatenate(sets).tobytes())}
            blank = pd.DataFrame({"rep": [0], "links": [0], "texts": [0], "top": [0], "packed": [row]})
            out = pd.concat([out, blank], ignore_index=True) if len(out) else blank
        return out

    return run


def _across(threshold: float):
    """Compare two packed pieces of a group with each other."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        reps, copies, sets = [], [], []
        for r in pdf.itertuples():
            flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(r.grams), np.uint64)
            sets.extend(np.split(flat, np.cumsum(r.sizes)[:-1]))
            reps.append(np.asarray(r.reps, np.int64))
            copies.append(np.asarray(r.copies, np.int64))
        if len(reps) < 2:  # the other piece holds no text
            return pd.DataFrame({c: np.empty(0, np.int64) for c in ("rep", "links", "texts", "top")})
        return _near(np.concatenate(reps), np.concatenate(copies), sets, threshold, len(reps[0]))

    return run


def jaccard_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS,
                    threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> DataFrame:
    """One row per input row: id, class_id, n_copies, n_links, n_near_texts, is_kept.

    ``class_id`` is the smallest id of the documents joined by chains of links
    (Jaccard of the n-word shingle sets at the threshold or above), ``n_links`` the
    number of other documents linked to it, copies included, ``n_near_texts`` the
    number of different linked shingle sets, ``n_copies`` the documents with the
    same set. ``is_kept`` marks the document that stays: the one with the smallest
    id of its class (repeated rows of that id: all of them).

    Defined cases: words are lower-cased and parted by white space; a text of
    fewer than n words is one shingle; null, empty and blank texts have no shingle,
    link to nothing and are kept, class_id their own id. Rows with a null id take
    part; they are nobody's class_id unless all ids of the class are null. Other
    columns are ignored. An empty table gives no rows.
    """
    bands, rows = choose_bands(threshold, recall, hashes)
    docs = _texts(df, id_col, text_col)
    prints = store(_fingerprints(docs, n, bands, rows), "shingles")
    held = prints.where("size > 0")
    # a set is known by its fingerprint; its number among the sets is the first half, unless that is taken twice
    copies = held.groupBy("f1", "f2").agg(F.min("d.id").alias("first"), F.count("*").alias("copies"), F.min("d").alias("d"),
                                          F.min("size").alias("size"), F.first("bands").alias("bands"))
    sets = store(copies.select(F.col("f1").alias("rep"), "f2", "first", "d", "copies", "size", "bands"), "sets")

    keyed = sets.select("rep", F.explode("bands").alias("key"))  # the key's seed is the number of the band
    least = keyed.groupBy("key").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).where("b <> top")
    ties = keyed.join(least, "key").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    groups = store(components(ties, "ties"), "groups")

    member = groups.join(sets.select("rep", "d", "copies", "size"), groups["node"] == sets["rep"]).drop("node")
    sizes = member.groupBy("root").agg(F.count("*").alias("m"), F.sum("size").alias("grams_held"))
    cut = sizes.select("root", F.greatest(F.ceil(F.col("m") / PIECE), F.ceil(F.col("grams_held") * 8 / PIECE_BYTES))
                       .cast("int").alias("cuts"))
    placed = store(member.join(cut, "root").withColumn("piece", F.pmod(F.xxhash64("rep", F.lit(7)), "cuts").cast("int")),
                   "placed")
    # only texts of a group are cut into n-grams again: the n-grams of all texts would take more room than the texts
    first = store(_grouped_texts(docs, placed).groupBy("root", "piece").applyInPandas(
        _within(n, threshold), f"{_LINKS}, packed struct<{_PACKED}>"), "pieces")
    alike = [c.split()[0] for c in _LINKS.split(", ")]
    meetings = (first.where("packed IS NOT NULL").select("packed.*")
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).where("other <> piece")
                .select("root", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"),
                        "reps", "copies", "sizes", "grams"))
    compared = store(first.where("packed IS NULL").select(*alike).union(
        meetings.groupBy("root", "i", "j").applyInPandas(_across(threshold), _LINKS)), "links")
    discard(placed, first)
    linked = compared.groupBy("rep").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    roots = components(compared.where("rep <> top").select(F.col("rep").alias("a"), F.col("top").alias("b")), "classes")

    known = (sets.join(linked, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .select("rep", "f2", "first", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("root", "rep").alias("root")))
    known = store(known, "known")
    named = known.groupBy("root").agg(F.min("first").alias("class_id"))
    known = known.join(named, "root").withColumnRenamed("rep", "f1")
    out = prints.select(F.col("d.id").alias("doc"), "f1", "f2", "size").join(
        known.select("f1", "f2", "copies", "links", "texts", "class_id"), ["f1", "f2"], "left")
    alone = F.col("size") == 0
    return out.select(
        F.col("doc").alias(id_col),
        F.when(alone, F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("copies")).cast("bigint").alias("n_copies"),
        F.when(alone, F.lit(0)).otherwise(F.col("links") + F.col("copies") - 1).cast("bigint").alias("n_links"),
        F.when(alone, F.lit(0)).otherwise(F.col("texts")).cast("bigint").alias("n_near_texts"),
        (alone | F.col("doc").eqNullSafe(F.col("class_id"))).alias("is_kept"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``df`` that stay: one document of each class, all columns as they were.

    A row leaves only if its id is that of a document to drop, so rows with a null
    id stay. The smallest id of a class stays; repeated rows of that id stay
    together.
    """
    classes = jaccard_classes(df, id_col, text_col, **settings)
    gone = store(classes.where("NOT is_kept").select(id_col).where(F.col(id_col).isNotNull()).distinct(), "gone")
    kept = classes.where("is_kept").select(id_col).distinct()
    gone = gone.join(kept, id_col, "left_anti")
    return df.join(gone.select(F.col(id_col).alias("__gone")), df[id_col] == F.col("__gone"), "left_anti")
