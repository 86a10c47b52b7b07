"""Byte-level BPE: encoding over a pair occurrence index, and decoding.

All words of a batch that were not met before are merged together. An index maps
each rank (a pair of symbols) to every place where the pair stands; ranks are
taken in ascending order from a heap, all places of a rank are merged at once,
and the lists of the pairs that arise beside them are extended. Since a pair
that holds a new symbol always ranks after the pair that made it, this equals
merging word by word.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame, types as T

from .common import map_texts, memory

#: Fixed value: the pattern that parts a text into words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a worker remembers before it starts afresh.
REMEMBER = 250_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files of byte-level tokenizers."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merges and special strings of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = {i: bytes(alphabet[c] for c in s) for s, i in model["vocab"].items() if s not in self.special}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        ids = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in merges], np.int64)
        self.right = np.array([ids[b] for _, b in merges], np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], np.int64)
        self.of_byte = np.array([ids[{b: c for c, b in alphabet.items()}[b]] for b in range(256)], np.int64)
        self.width = max(self.bytes) + 2
        key = self.left * self.width + self.right
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]
        self.split = regex.compile(PATTERN)
        # longest first, as the strings of special tokens are cut out before anything else
        parts = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, parts)) + ")") if parts else None

    def words(self, text: str) -> list[str]:
        """The text in words; a special string stands as an element of its own."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.split.findall(text)
        out = []
        for part in self.cut.split(text):
            out.extend([part] if part in self.special else self.split.findall(part))
        return out

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge (a negative symbol ends a word)."""
        key = np.where((a >= 0) & (b >= 0), a * self.width + b, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        raw = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        sym = self.of_byte[raw]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        sym[ends] = -1
        n = len(sym)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(places: np.ndarray, ranks: np.ndarray) -> None:
            found = ranks >= 0
            places, ranks = places[found], ranks[found]
            if not len(ranks):
                return
            by = np.argsort(ranks, kind="stable")
            places, ranks = places[by], ranks[by]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for r, p in zip(ranks[np.r_[0, cuts]].tolist(), np.split(places, cuts), strict=True):
                if r in index:
                    index[r].append(p)
                else:
                    index[r] = [p]
                    heapq.heappush(active, r)

        enter(np.arange(n - 1), self.rank(sym[:-1], sym[1:]))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            p = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            a, b, new = self.left[r], self.right[r], self.made[r]
            p = p[sym[p] == a]
            p = p[sym[after[p]] == b]
            if not len(p):
                continue
            if a == b:  # of a chain of equal symbols, every second pair from the left
                k = np.arange(len(p))
                first = np.r_[True, p[1:] != after[p[:-1]]]
                p = p[(k - np.maximum.accumulate(np.where(first, k, 0))) % 2 == 0]
            q = after[p]
            sym[p], sym[q] = new, -2
            after[p] = after[q]
            before[after[p]] = p
            back = before[p]
            there = back >= 0
            enter(back[there], self.rank(sym[back[there]], sym[p[there]]))
            enter(p, self.rank(sym[p], sym[after[p]]))
        starts = ends - lengths
        alive = np.flatnonzero(sym >= 0)
        return np.split(sym[alive], np.searchsorted(alive, starts[1:])) if len(words) else []


_LOADED: dict[str, Vocabulary] = memory("bpe")
_KNOWN: dict[str, dict[str, tuple[int, str, bytes]]] = memory("bpe")


def vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def learn(v: Vocabulary, known: dict, words: set[str]) -> None:
    """Add (number of ids, ids as text, decoded bytes) of new words to ``known``."""
    plain = [w for w in words if w not in v.special]
    for w, ids in zip(plain, v.merge([w.encode("utf-8", "surrogatepass") for w in plain]), strict=True):
        ids = ids.tolist()
        known[w] = (len(ids), ",".join(map(str, ids)), b"".join(map(v.bytes.__getitem__, ids)))
    for w in words & v.special.keys():
        known[w] = (1, str(v.special[w]), v.bytes[v.special[w]])


def encode(path: str, texts: list[str | None]) -> list[list[tuple[int, str, bytes]]]:
    """For each text its words as (number of ids, ids joined by commas, the bytes these ids decode to)."""
    v, known = vocabulary(path), _KNOWN.setdefault(path, {})
    if len(known) > REMEMBER:
        known.clear()
    parted = [v.words(t or "") for t in texts]
    new = set().union(*parted).difference(known)
    if new:
        learn(v, known, new)
    return [list(map(known.__getitem__, words)) for words in parted]


def slices(texts: list[str | None], size: int = 2 << 20) -> Iterator[list[str | None]]:
    """The texts in parts of about ``size`` characters, one text at least."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= size:
            yield texts[start:i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def roundtrip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              with_ids: bool = False) -> DataFrame:
    """Encode whole texts and decode the ids again: id, n_tokens, ids_sha256, decoded_sha256.

    ``with_ids`` adds ``ids`` (array) and ``decoded``. Ids equal those of the
    tokenizers library without added special tokens; strings of special tokens
    inside a text become their ids, as is its default. Bytes that are no UTF-8
    decode to U+FFFD. Null is the empty text: 0 ids and the digest of nothing.
    One row per input row, repeated rows included; other columns are ignored; an
    empty table gives no rows. ``path`` must be readable on every executor.
    """
    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("decoded", T.StringType())]

    def made(kept: list, texts: list) -> list[list]:
        count, ids, digest, lists, plain = [], [], [], [], []
        for part in slices(texts):
            for words in encode(path, part):
                joined = ",".join([w[1] for w in words])
                decoded = b"".join([w[2] for w in words]).decode("utf-8", "replace")
                count.append(sum([w[0] for w in words]))
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                digest.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    lists.append(list(map(int, joined.split(","))) if joined else [])
                    plain.append(decoded)
        return [kept[0], count, ids, digest] + ([lists, plain] if with_ids else [])

    return map_texts(df, [id_col, text_col], T.StructType(fields), made, "bpe")
