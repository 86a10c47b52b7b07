"""Spelling variants: words of a corpus that lie one edit apart, found by probing generated edits against Bloom filters.

1. Words are counted over all texts; the vocabulary keeps those that are long and
   frequent enough, with a 64-bit hash that is a sum over (place, letter) pairs.
2. Every length has its own shard of a blocked Bloom filter: a word sets six bits
   in one block of 512. Blocks are built by a group-by on their words and sent to
   the tasks in slices of a fixed number of blocks, one job per slice, so what is
   broadcast does not grow with the vocabulary.
3. A task takes its vocabulary words, generates their edits as hashes (replaced
   letters that are greater than the old one, and deletions: each near pair has
   one edit from one of its words) and probes the shard of the edit's length.
4. Positives alone are shuffled, as hashes, to the vocabulary; the words that meet
   are compared letter by letter, so neither false positives of the filter nor
   equal hashes reach the result.
5. Each word's near words are counted and its form picked; roots come from
   pointer doubling, as a form is at least ``ratio`` times as frequent.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import discard, scratch_path, store

#: Letters of a run, and the share of runs that lose a letter.
RUN = r"[A-Za-zÀ-ÿ]+"
DROPPED_ONE_IN = 199
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: Words per block of 512 bits; blocks that are broadcast at once (64 bytes each).
WORDS_PER_BLOCK = 32
SLICE_BLOCKS = 1 << 17
#: Lengths from here on share a shard.
LONG = 256
#: Letters of distinct words that a counting task holds before it hands them on.
HELD_LETTERS = 1_500_000

_LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
_CHUNK = 8192


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def _part(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """What a letter at a place adds to the hash of its word."""
    return _mix((place << np.uint64(8)) + letter)


class Words:
    """A batch of words laid out letter by letter: letter, place in the word, number of the word."""

    def __init__(self, words: list[str]):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.size) - self.size
        self.letter = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.uint64)
        self.word = np.repeat(np.arange(len(words)), self.size)
        self.place = (np.arange(len(self.letter)) - self.start[self.word]).astype(np.uint64)
        self.part = _part(self.place, self.letter)
        self.hash = np.add.reduceat(self.part, self.start) if len(words) else np.empty(0, np.uint64)


class Shards:
    """Where each length's shard lies among the blocks: ``first`` block and number of ``blocks`` by length."""

    def __init__(self, words_by_length: dict[int, int]):
        self.blocks = np.zeros(LONG + 1, np.uint64)
        for length, n in words_by_length.items():
            self.blocks[length] = -(-n // WORDS_PER_BLOCK)
        self.first = np.cumsum(self.blocks) - self.blocks
        self.total = int(self.blocks.sum())

    def places(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """Two words of the filter and the three bits in each that stand for a hash."""
        at = np.minimum(lengths, LONG)
        block = self.first[at] + ((hashes >> np.uint64(32)) * self.blocks[at] >> np.uint64(32))
        bits = _mix(hashes)
        one = np.uint64(1)

        def part(shift: int) -> np.ndarray:
            return bits >> np.uint64(shift) & np.uint64(63)

        return (block * np.uint64(8) + (bits & np.uint64(7)), one << part(3) | one << part(9) | one << part(15),
                block * np.uint64(8) + (bits >> np.uint64(21) & np.uint64(7)),
                one << part(24) | one << part(30) | one << part(36))


def _arrow(df: DataFrame, made, schema: str) -> DataFrame:
    """``made(batch)`` returns the columns of the result as arrays."""
    fields = T.StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for columns in made(batch):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=fields)

    return df.mapInArrow(run, schema)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH) -> DataFrame:
    """(word, n) of the words with ``least`` letters or more; tasks add up what they meet before the shuffle."""
    runs = re.compile(RUN.replace("A-Z", "").replace("+", f"{{{least},}}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        letters = 0

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not text:
                    continue
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                # bytes.lower() knows the letters A-Z alone
                for word, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % DROPPED_ONE_IN == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least:
                            continue
                    if word not in held:
                        letters += len(word)
                    held[word] += n
                if letters >= HELD_LETTERS:
                    letters = 0
                    yield handed()
        if held:
            yield handed()

    return (docs.select(docs[id_col].alias("k"), docs[text_col].alias("t")).mapInArrow(run, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _vocabulary(counts: DataFrame, min_count: int) -> DataFrame:
    """word, n, size, h of the frequent words."""
    def made(batch: pa.RecordBatch) -> Iterator[list]:
        w = Words(batch.column(0).to_pylist())
        yield [batch.column(0), batch.column(1), w.size.astype(np.int32), w.hash.view(np.int64)]

    return _arrow(counts.where(F.col("n") >= min_count).select("word", "n"), made, "word string, n bigint, size int, h bigint")


def _filter_words(vocabulary: DataFrame, shards: Shards) -> DataFrame:
    """(slot, bits): the 64-bit words of all blocks that are not zero."""
    def made(batch: pa.RecordBatch) -> Iterator[list]:
        size, h = (c.to_numpy() for c in batch.columns)
        s1, m1, s2, m2 = shards.places(h.view(np.uint64), size)
        yield [np.r_[s1, s2].view(np.int64), np.r_[m1, m2].view(np.int64)]

    return (_arrow(vocabulary.select("size", "h"), made, "slot bigint, bits bigint")
            .groupBy("slot").agg(F.bit_or("bits").alias("bits")))


def edits(w: Words, least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Chunks of (number of the word, place, hash of the edit, its length) so that each near pair has one edit in all."""
    table = _part(np.arange(LONG, dtype=np.uint64)[:, None], _LETTERS[None, :])
    for i in range(0, len(w.letter), _CHUNK):
        s = slice(i, i + _CHUNK)
        place, letter, word = w.place[s], w.letter[s], w.word[s]
        row, new = np.nonzero(letter[:, None] < _LETTERS[None, :])
        at = place[row]
        part = table[np.minimum(at, np.uint64(LONG - 1)), new]
        far = np.flatnonzero(at >= LONG)
        part[far] = _part(at[far], _LETTERS[new[far]])
        base = w.hash[word] - w.part[s]
        yield word[row], at, base[row] + part, w.size[word[row]]
    # of a run of equal letters the first one is dropped
    first = np.r_[True, w.letter[1:] != w.letter[:-1]] if len(w.letter) else np.empty(0, bool)
    first |= w.place == 0
    before = np.cumsum(w.part) - w.part
    moved = np.where(w.place > 0, _part(w.place - np.uint64(1), w.letter), np.uint64(0))
    after = np.cumsum(moved)
    starts, ends = w.start[w.word], (w.start + w.size - 1)[w.word]
    h = before - before[starts] + after[ends] - after
    keep = np.flatnonzero(first & (w.size[w.word] > least))
    for i in range(0, len(keep), 1 << 19):
        k = keep[i:i + (1 << 19)]
        yield w.word[k], w.place[k], h[k], w.size[w.word[k]] - 1


def _positives(vocabulary: DataFrame, shards: Shards, label: str, least: int, slice_blocks: int) -> DataFrame:
    """(src, size, place, hit, hit_size): edits that the filter does not rule out, as hashes."""
    spark = vocabulary.sparkSession
    bits = store(_filter_words(vocabulary, shards), f"{label}-filter")
    path = scratch_path(spark, f"{label}-positives")
    schema = "src bigint, size int, place bigint, hit bigint, hit_size int"
    vocabulary.sparkSession.createDataFrame([], schema).write.parquet(path)
    for low in range(0, shards.total, slice_blocks):
        first, last = 8 * low, 8 * min(low + slice_blocks, shards.total)
        part = bits.where((F.col("slot") >= first) & (F.col("slot") < last)).toArrow()
        words = np.zeros(last - first, np.uint64)
        words[part.column(0).to_numpy() - first] = part.column(1).to_numpy().view(np.uint64)
        sent = spark.sparkContext.broadcast(words)

        def made(batch: pa.RecordBatch, first=first, last=last, sent=sent) -> Iterator[list]:
            w, held = Words(batch.column(0).to_pylist()), sent.value
            for word, place, h, size in edits(w, least):
                s1, m1, s2, m2 = shards.places(h, size)
                k = np.flatnonzero(shards.blocks[np.minimum(size, LONG)] > 0)
                k = k[(s1[k] >= first) & (s1[k] < last)]
                k = k[held[s1[k] - np.uint64(first)] & m1[k] == m1[k]]
                k = k[held[s2[k] - np.uint64(first)] & m2[k] == m2[k]]
                if len(k):
                    yield [w.hash[word[k]].view(np.int64), w.size[word[k]].astype(np.int32), place[k].view(np.int64),
                           h[k].view(np.int64), size[k].astype(np.int32)]

        _arrow(vocabulary.select("word"), made, schema).write.mode("append").parquet(path)
        sent.destroy()
    discard(bits)
    out = spark.read.schema(schema).parquet(path)
    out._stored_at = path
    return out


def near_words(vocabulary: DataFrame, label: str = "spelling", least: int = MIN_LENGTH,
               slice_blocks: int = SLICE_BLOCKS) -> DataFrame:
    """(word, n, near, near_n), both ways: pairs of the vocabulary (word, n, size, h) that differ by one edit."""
    sizes = vocabulary.groupBy(F.least("size", F.lit(LONG)).alias("l")).count().collect()  # one row a length, 251 at most
    shards = Shards({r["l"]: r["count"] for r in sizes})
    found = _positives(vocabulary, shards, label, least, slice_blocks)
    v = vocabulary.select("word", "n", "size", "h")
    target = v.select(F.col("word").alias("t"), F.col("n").alias("t_n"), F.col("h").alias("hit"), F.col("size").alias("hit_size"))
    source = v.select(F.col("word").alias("s"), F.col("n").alias("s_n"), F.col("h").alias("src"), "size")
    met = found.join(target, ["hit", "hit_size"]).join(source, ["src", "size"]).where(F.expr("""
        CASE WHEN size = hit_size THEN s <> t AND concat(substr(s, 1, CAST(place AS INT)), substr(t, CAST(place AS INT) + 1, 1),
                                                         substr(s, CAST(place AS INT) + 2)) = t
             ELSE concat(substr(s, 1, CAST(place AS INT)), substr(s, CAST(place AS INT) + 2)) = t END"""))
    pairs = store(met.select("s", "s_n", "t", "t_n"), f"{label}-pairs")
    discard(found)
    both = pairs.union(pairs.select("t", "t_n", "s", "s_n"))
    return both.toDF("word", "n", "near", "near_n")


def _roots(forms: DataFrame, label: str) -> DataFrame:
    """(word, root) of the words with a form: pointer doubling; forms grow in frequency, so there is no cycle."""
    now = store(forms.select("word", F.col("form").alias("root")), f"{label}-roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = store(now.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                         F.col("next").isNotNull().alias("more")), f"{label}-roots")
        discard(now)
        now = step
        if not now.where("more").head(1):
            return now.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO, slice_blocks: int = SLICE_BLOCKS) -> DataFrame:
    """Per frequent word: word, form, root, n, n_near, form_n.

    ``form`` is the near word with the largest n (ties: the smallest by code
    points) if that is ``ratio`` times the word's own n or more; ``root`` ends the
    chain of forms. Null and empty texts have no words; a null id counts as an
    empty string where an id decides which letter is dropped. Repeated rows count
    each time, words of any length are compared whole, and an empty table or one
    without frequent words gives no rows. Other columns are ignored.
    """
    if min_length < 2:
        raise ValueError("words need two letters at least")
    vocabulary = store(_vocabulary(word_counts(docs, id_col, text_col, min_length), min_count), "spelling-vocabulary")
    best = near_words(vocabulary, "spelling", min_length, slice_blocks).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("b"))
    named = store(vocabulary.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("b.m") >= ratio * F.col("n"), F.col("b.w")).alias("form"),
        F.when(-F.col("b.m") >= ratio * F.col("n"), -F.col("b.m")).alias("form_n")), "spelling-forms")
    roots = _roots(named.where(F.col("form").isNotNull()), "spelling")
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
