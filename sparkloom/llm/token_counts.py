"""Token counts by a transducer compiled from a byte-level BPE tokenizer.

Within a word, the tokenization of every prefix is fixed by its last token: the
longest vocabulary entry that ends there and may follow the last token of what is
before it. So a deterministic automaton over bytes can count tokens without
merging. Its state holds, for each suffix that a token could still grow from, how
many bytes it has, the last token before it and how many tokens ago that was; a
transition reads a byte and is annotated with the change of the token count
(which may be negative, as a longer token can swallow earlier ones). States with
equal content are one state, and transitions are compiled when first taken.

A text is cut into chunks at places where no word can go across (before the
blank of a word that follows a non-blank), so each chunk maps the start state to
the start state and a count; the maps are composed by a prefix scan.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from .bpe import Vocabulary, slices, vocabulary
from .common import map_texts, memory

CHUNK = 1 << 14
LIMIT = 512
#: States, transitions and words that a worker keeps before it compiles afresh.
MOST_STATES = 200_000
MOST_WORDS = 300_000


class Transducer:
    def __init__(self, v: Vocabulary):
        self.v = v
        self.ids = {b: i for i, b in v.bytes.items() if i not in set(v.special.values())}
        self.prefixes = {b[:k] for b in self.ids for k in range(1, len(b))}
        self.rank = {(int(a), int(b)): r for r, (a, b) in enumerate(zip(v.left, v.right, strict=True))}
        self.parts = {int(m): (int(a), int(b), r) for r, (a, b, m) in
                      enumerate(zip(v.left, v.right, v.made, strict=True))}
        self.may: dict[tuple[int, int], bool] = {}
        self.words: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        #: state -> its suffixes, longest first: (bytes, last token before them or -1, tokens since then)
        self.content: list[tuple] = [((b"", -1, 0),)]
        self.number: dict[tuple, int] = {self.content[0]: 0}
        self.step: dict[int, tuple[int, int]] = {}

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand after ``left``: no merge across the seam comes before those that made them."""
        known = self.may.get((left, right))
        if known is None:
            if len(self.may) > 500_000:
                self.may.clear()
            known = self.may[left, right] = self._follows(left, right)
        return known

    def _follows(self, left: int, right: int) -> bool:
        # the tokens at the seam over time: each side as the ranks at which its edge token came to be
        last, first = [(left, self.parts.get(left, (0, 0, -1))[2])], [(right, self.parts.get(right, (0, 0, -1))[2])]
        while last[-1][0] in self.parts:
            t = self.parts[last[-1][0]][1]
            last.append((t, self.parts.get(t, (0, 0, -1))[2]))
        while first[-1][0] in self.parts:
            t = self.parts[first[-1][0]][0]
            first.append((t, self.parts.get(t, (0, 0, -1))[2]))
        # walk forward in time; at any moment the edge tokens are a pair that must not merge before either grows
        i, j = len(last) - 1, len(first) - 1
        while True:
            r = self.rank.get((last[i][0], first[j][0]))
            # rank at which the edge of each side is taken up by its next merge
            up_left = last[i - 1][1] if i else 1 << 60
            up_right = first[j - 1][1] if j else 1 << 60
            # of equal ranks, the place further left merges first
            if r is not None and r < up_left and r <= up_right:
                return False
            if not i and not j:
                return True
            if up_left <= up_right:
                i -= 1
            else:
                j -= 1

    def advance(self, state: int, byte: int) -> tuple[int, int]:
        """Compile the transition: (next state, change of the token count)."""
        one = bytes([byte])
        longer, grown = [], None
        for suffix, before, ago in self.content[state]:
            s = suffix + one
            token = self.ids.get(s)
            if grown is None and token is not None and (before < 0 or self.follows(before, token)):
                grown = (token, 1 - ago)  # tokens before the suffix, and this one, against tokens up to now
            if s in self.prefixes:
                longer.append((s, before, ago))
        token, change = grown
        content = (*((s, before, ago + change) for s, before, ago in longer), (b"", token, 0))
        number = self.number.get(content)
        if number is None:
            number = self.number[content] = len(self.content)
            self.content.append(content)
        self.step[state << 8 | byte] = found = (number, change)
        return found

    def count(self, word: str) -> int:
        state = total = 0
        step = self.step
        for byte in word.encode("utf-8", "surrogatepass"):
            found = step.get(state << 8 | byte)
            if found is None:
                found = self.advance(state, byte)
            state = found[0]
            total += found[1]
        return total

    def chunk(self, text: str) -> int:
        """Tokens that a chunk emits from the start state to the start state."""
        known = self.words
        parts = self.v.split.findall(text)
        for w in set(parts).difference(known):
            known[w] = self.count(w)
        return sum(map(known.__getitem__, parts))


_SEAM = regex.compile(r"(?<=[^\s]) (?=\p{L})")


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """The text cut where no word goes across, in pieces of about ``size`` characters."""
    out, start = [], 0
    while len(text) - start > size:
        found = _SEAM.search(text, start + size)
        if found is None:
            break
        out.append(text[start:found.start()])
        start = found.start()
    out.append(text[start:])
    return out


_LOADED: dict[str, Transducer] = memory("token_counts")


def transducer(path: str) -> Transducer:
    if path not in _LOADED:
        _LOADED[path] = Transducer(vocabulary(path))
    made = _LOADED[path]
    if len(made.content) > MOST_STATES:
        made.reset()
    if len(made.words) > MOST_WORDS:
        made.words.clear()
    return made


def count_text(path: str, text: str | None) -> int:
    if not text:
        return 0
    made = transducer(path)
    v, special, parts = made.v, 0, [text]
    if v.cut is not None and any(s in text for s in v.special):
        pieces = v.cut.split(text)
        parts = [p for p in pieces if p not in v.special]
        special = len(pieces) - len(parts)
    maps = [made.chunk(c) for p in parts for c in chunks(p)]
    return int(np.cumsum(maps)[-1]) + special if maps else special


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit.

    Counts equal those of the tokenizers library without added special tokens;
    strings of special tokens inside a text count as one each, as is its default.
    Null and empty texts have no bytes and no tokens. One row per input row, other
    columns are ignored, an empty table gives no rows. ``path`` must be readable on
    every executor.
    """
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType),
                           *T.StructType.fromDDL("n_bytes bigint, n_tokens bigint").fields])

    def made(kept: list, texts: list) -> list:
        counts: list[int] = []
        for part in slices(texts):
            counts += [count_text(path, t) for t in part]
        return [kept[0], [len((t or "").encode("utf-8", "surrogatepass")) for t in texts], counts]

    return map_texts(df, [id_col, text_col], schema, made, "token_counts").withColumn("over_limit", F.col("n_tokens") > limit)
