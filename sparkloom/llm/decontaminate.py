"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items.

Texts are lower-cased (A-Z) and every byte that is no word byte becomes one
space, so words stand between single spaces. A window is the string of its words
with a space on either side; the automaton over all windows finds every
occurrence in one pass over a document. Places of words map hits back to the
text.

The automaton is built in each Python worker from the windows, which go there in
the task's own data only after their size has been measured: up to ``MAX_BYTES``.
A larger benchmark is matched by a join on window digests instead, with the same
result.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .common import filter_texts, map_texts, memory, store

WINDOW = 10
#: Bytes of benchmark text up to which the automaton is used.
MAX_BYTES = 8 << 20

#: Each byte of a text: word bytes (A-Z lower-cased) as they are, others a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows(text: str | None, width: int = WINDOW) -> list[bytes]:
    """The windows of an item: ``width`` words each; a shorter item is one window, no words give none."""
    w = words(text)
    return [b" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))] if w else []


def automaton(items: list[tuple[object, str | None]], width: int):
    """The automaton over all windows, a window's value being (its length in words, the places of its items)."""
    owners: dict[bytes, set[int]] = {}
    for place, (_, text) in enumerate(items):
        for w in windows(text, width):
            owners.setdefault(w, set()).add(place)
    found = ahocorasick.Automaton()
    for w, own in owners.items():
        found.add_word((b" " + w + b" ").decode("latin-1"), (w.count(b" ") + 1, tuple(own)))
    if len(found):
        found.make_automaton()
    return found


_BUILT: dict[bytes, object] = memory("decontaminate")


def _automaton_of(items: list, width: int, digest: bytes):
    if digest not in _BUILT:
        _BUILT.clear()
        _BUILT[digest] = automaton(items, width)
    return _BUILT[digest]


def _hits(found, text: str | None) -> tuple[int, np.ndarray, set[int]]:
    """Number of words, which of them are hit, the items that occur."""
    w = words(text)
    if not w or not len(found):
        return len(w), np.zeros(0, bool), set()
    line = b" " + b" ".join(w) + b" "
    ends = list(found.iter(line.decode("latin-1")))
    if not ends:
        return len(w), np.zeros(0, bool), set()
    spaces = np.cumsum(np.frombuffer(line, np.uint8) == 32)
    step, items = np.zeros(len(w) + 1, np.int64), set()
    for end, (length, own) in ends:
        last = spaces[end] - 1
        step[last - length] += 1
        step[last] -= 1
        items.update(own)
    return len(w), np.cumsum(step)[:-1] > 0, items


def _spans(text: str, hit: np.ndarray) -> list[list[int]]:
    """Runs of hit words as [start, end) in code points of the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    found = list(_WORD.finditer(raw.translate(_FOLD)))
    point = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return [[int(point[found[a].start()]) - 1, int(point[found[b - 1].end() - 1])] for a, b in edge.reshape(-1, 2)]


def _digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def _held(items: DataFrame, item_id: str | None, item_text: str) -> DataFrame:
    name = items[item_id].cast("string") if item_id else F.lit(None).cast("string")
    return items.select(name.alias("i"), items[item_text].alias("t")).where("t is not null")


def _listed(items: DataFrame, item_id: str | None, item_text: str, max_bytes: int) -> list | None:
    """The items, sorted, where their measured size is within the bound."""
    held = _held(items, item_id, item_text)
    if (held.agg(F.sum(F.octet_length("t") + F.lit(32))).first()[0] or 0) > max_bytes:
        return None
    return sorted({(r["i"], r["t"]) for r in held.collect()}, key=lambda r: (r[0] is None, r[0] or "", r[1]))


FIELDS = ("n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
          "spans array<array<bigint>>")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", width: int = WINDOW,
                  max_bytes: int = MAX_BYTES) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    A document word inside any occurrence of an item window is hit; ``spans`` are
    the runs of hit words as [start, end) in code points of the original text.
    Null, empty and wordless texts have no words and no hit; such items have no
    window. Items with equal texts all count, repeated item rows count once, items
    with a null id hit but have no name and are not counted. One row per input
    row; other columns are ignored; an empty table gives no rows.
    """
    listed = _listed(items, item_id, item_text, max_bytes)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *T.StructType.fromDDL(FIELDS).fields])
    if listed is None:
        return _joined(docs, _held(items, item_id, item_text), id_col, text_col, width, schema)
    digest = hashlib.sha256(repr((width, listed)).encode()).digest()

    def made(kept: list, texts: list) -> list:
        found = _automaton_of(listed, width, digest)
        out: list[list] = [[] for _ in range(6)]
        for text in texts:
            n, hit, places = _hits(found, text)
            ids = {listed[p][0] for p in places} - {None}
            for column, value in zip(out, (n, int(hit.sum()), len(ids), _digest(list(ids)), bool(hit.any()),
                                           _spans(text, hit) if hit.any() else []), strict=True):
                column.append(value)
        return [kept[0], *out]

    return map_texts(docs, [id_col, text_col], schema, made, "decontaminate")


def _window_rows(df: DataFrame, key: str, text: str, width: int, widths: list[int] | None) -> DataFrame:
    """k, digest of the window, its first word and its width: of items (no widths), or of documents at the widths."""

    def made(kept: list, texts: list) -> list:
        out: list[list] = [[], [], [], []]
        for k, t in zip(kept[0].to_pylist(), texts, strict=True):
            w = words(t)
            for size in ([min(width, len(w))] if w else []) if widths is None else widths:
                for i in range(len(w) - size + 1):
                    out[0].append(k)
                    out[1].append(hashlib.md5(b" ".join(w[i:i + size])).digest())
                    out[2].append(i)
                    out[3].append(size)
        return out

    schema = T.StructType([T.StructField("k", df.schema[key].dataType),
                           *T.StructType.fromDDL("w binary, at int, width int").fields])
    return map_texts(df, [key, text], schema, made)


def _joined(docs: DataFrame, held: DataFrame, id_col: str, text_col: str, width: int,
            schema: T.StructType) -> DataFrame:
    """The same by a join on window digests; a document is known by a digest of its text."""
    owned = store(_window_rows(held, "i", "t", width, None).groupBy("w", "width").agg(
        F.collect_set("k").alias("ids")), "windows")
    widths = sorted(r["width"] for r in owned.select("width").distinct().collect())  # as many as a window has words
    keyed = docs.select(docs[id_col].alias("d"), docs[text_col].alias("x")).withColumn(
        "h", F.sha2(F.coalesce("x", F.lit("")), 256))
    rows = _window_rows(keyed.groupBy("h").agg(F.first("x").alias("x")), "h", "x", width, widths)
    met = rows.join(owned, ["w", "width"]).groupBy("k").agg(
        F.collect_set(F.struct("at", "width")).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("ids"))).alias("ids"))
    full = keyed.join(met, keyed["h"] == met["k"], "left").select(
        F.struct("d", "hits", F.array_sort(F.coalesce("ids", F.expr("cast(array() as array<string>)"))).alias("ids"))
        .alias("kept"), "x")

    def made(kept: list, texts: list) -> list:
        out: list[list] = [[] for _ in range(6)]
        for row, text in zip(kept[0].to_pylist(), texts, strict=True):
            hit = np.zeros(len(words(text)), bool)
            for r in row["hits"] or []:
                hit[r["at"]:r["at"] + r["width"]] = True
            ids = row["ids"]
            for column, value in zip(out, (len(hit), int(hit.sum()), len(ids), _digest(ids), bool(hit.any()),
                                           _spans(text, hit) if hit.any() else []), strict=True):
                column.append(value)
        return [kept[0].field("d"), *out]

    return map_texts(full, ["kept", "x"], schema, made)


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text: str = "text", width: int = WINDOW,
          max_bytes: int = MAX_BYTES) -> DataFrame:
    """The documents without a hit, all columns as they were; nulls and empty texts have no hit and stay."""
    listed = _listed(items, None, item_text, max_bytes)
    if listed is None:
        row = docs.withColumn("__row", F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]))
        found = contamination(row, items.withColumn("__none", F.lit(None).cast("string")), "__row", text_col, "__none",
                              item_text, width, max_bytes)
        return found.where("NOT contaminated").select(
            *[F.col("__row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])
    digest = hashlib.sha256(repr((width, listed)).encode()).digest()

    def keep(texts: list) -> list[bool]:
        found = _automaton_of(listed, width, digest)
        return [not _hits(found, t)[1].any() for t in texts]

    return filter_texts(docs, text_col, keep, "decontaminate")
