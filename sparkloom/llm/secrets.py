"""Secret scan with corpus-wide ownership figures, in DataFrame functions only.

Places of matches: a marker is put round every match, the text is split at the
markers, and the lengths of the pieces add up to code-point offsets, block by
block, so that work does not grow with the square of the matches. The marker
character is first replaced in the text by another one of the same length that
no pattern takes, so offsets hold.

Every candidate value is counted corpus-wide by the distinct owners (sources) and
repositories (source and language) that hold it. A value of many owners, or of
several owners and many repositories, is a copied example; one that stays with
few, or with one owner in however many repositories, is taken for a live credential. Kinds
beyond the base ones are reported only where ownership says live. A private key is
one span from its first line to its last; its value is the body's own characters,
so that another wrapping or escaped line ends make no other key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import store


#: kind -> (pattern, group of the value, characters it needs). Base kinds are reported always.
BASE = {
    "assign": (r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
_BEGIN, _END = (rf"-----{edge} [A-Z ]*PRIVATE KEY-----" for edge in ("BEGIN", "END"))
#: What stands before the end line; of a key whose end line was cut off, the lines that can only be key.
_BODY = (rf"[^-]*+(?:-{{1,4}}[^-]++)*+(?={_END})"
         r"|(?:\\[nr]|[\s\"'])*+(?:[A-Za-z0-9+/]{40,}+=*+(?:\\[nr]|[\s\"'])*+)++(?:[A-Za-z0-9+/]++=*+\z)?+")
#: Published shapes of provider tokens and keys.
FURTHER = {
    "bearer": (r"(?i:bearer)\x20+([A-Za-z0-9+/_.=-]{16,})", 1, 16),
    "github": (r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 40),
    "private": (f"{_BEGIN}({_BODY})(?:{_END})?+", 1, 32),
}
#: kind -> what is no part of its value: between the characters of a key body, line ends, their escapes, quotes.
APART = {"private": r"\\[nrt]|[^A-Za-z0-9+/=]"}
KINDS = {**BASE, **FURTHER}
#: A value of more owners than this is a copied example, as is one of several owners and more repositories than this.
MAX_OWNERS = 3
MAX_REPOS = 6
#: Pieces of a text whose lengths are added up together.
BLOCK = 64

_MARK, _OTHER = "\ufdd0", "\ufdd1"
_SPAN = "struct<kind:int,start:int,end:int,value:string>"


def spans_of(text: Column, kind: str) -> Column:
    """Array of (kind number, start, end, value) of the leftmost non-overlapping matches that are long enough."""
    pattern, group, least = KINDS[kind]
    plain = F.translate(text, _MARK, _OTHER)
    pieces = F.split(F.regexp_replace(plain, f"({pattern})", f"{_MARK}$1{_MARK}"), _MARK, -1)
    number = list(KINDS).index(kind)
    none = F.expr(f"cast(array() as array<{_SPAN}>)")

    def span(piece: Column, end: Column) -> Column:
        value = F.regexp_extract(piece, pattern, group) if group else piece
        if kind in APART:
            value = F.regexp_replace(value, APART[kind], "")
        return F.struct(F.lit(number).alias("kind"), (end - F.char_length(piece)).alias("start"), end.alias("end"),
                        value.alias("value")).cast(_SPAN)

    def found(pieces: Column) -> Column:
        ends = _bound(F.transform(pieces, F.char_length), _running)
        placed = F.zip_with(pieces, ends, lambda p, e: F.struct(p.alias("p"), e.alias("e")))
        matches = F.filter(placed, lambda z, i: i % 2 == 1)  # every other piece is a match
        return F.filter(F.transform(matches, lambda z: span(z["p"], z["e"])), lambda s: F.char_length(s["value"]) >= least)

    return F.when(text.rlike(pattern), _bound(pieces, found)).otherwise(none)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, also where ``use`` reads it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def _running(lengths: Column) -> Column:
    """Running sums of an array, added up within blocks and from block to block."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))
    begin = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<array<int>>)").alias("sums"))

    def step(state: Column, block: Column) -> Column:
        sums = F.transform(block, lambda x, i: state["at"] + total(F.slice(block, 1, i + 1)))
        return F.struct((state["at"] + total(block)).alias("at"), F.concat(state["sums"], F.array(sums)).alias("sums"))

    return F.flatten(F.aggregate(blocks, begin, step, lambda s: s["sums"]))


def _candidates(df: DataFrame, id_col: str, text_col: str, owner_col: str, repo_cols: list[str]) -> DataFrame:
    """One row per input row that holds a candidate: id, text digest, owner, repository, spans."""
    text = F.coalesce(df[text_col], F.lit(""))
    found = df.select(
        df[id_col].alias("id"), _digest(df[text_col]).alias("h"), df[owner_col].cast("string").alias("owner"),
        F.to_json(F.struct(*[df[c] for c in repo_cols])).alias("repo"),
        F.concat(*[spans_of(text, k) for k in KINDS]).alias("spans"))
    return found.where(F.size("spans") > 0)


def _judged(held: DataFrame, max_owners: int, max_repos: int) -> DataFrame:
    """The candidates, one row each: id, h, kind, start, end, owners, repos, live."""
    one = held.select("id", "h", "owner", "repo", F.explode("spans").alias("s")).select(
        "id", "h", "owner", "repo", "s.kind", "s.start", "s.end", F.sha2("s.value", 256).alias("value"))
    place = one.groupBy("value", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = place.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    figures = owners.groupBy("value").agg(F.count("owner").alias("owners"), F.sum("repos").alias("repos"))
    live = (F.col("owners") <= max_owners) & ((F.col("owners") <= 1) | (F.col("repos") <= max_repos))
    return one.drop("owner", "repo").join(figures, "value").withColumn("live", live)


def secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
            repo_cols: tuple[str, ...] = ("source", "lang"), max_owners: int = MAX_OWNERS,
            max_repos: int = MAX_REPOS) -> DataFrame:
    """Per document: id, n_assign, n_access, n_hex, base_sha256, spans, n_live, live_spans, most_owners, most_repos.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then by
    kind as in ``KINDS``; ``base_sha256`` is the digest of the base ones alone.
    ``n_live`` counts the distinct places whose value has at most ``max_owners``
    owners and, if more than one, at most ``max_repos`` repositories; ``live_spans``
    lists them as [start, end). ``most_owners`` and ``most_repos`` are the greatest
    figures of a candidate of the document, 0 if there is none. Null is the empty text and
    has no span; a null owner is no owner, though its repository counts. One row per input row; rows that repeat
    id and text get the same figures; a null id is an id. An empty table gives no
    rows.
    """
    per = _found(df, id_col, text_col, owner_col, list(repo_cols), max_owners, max_repos)
    ids = df.select(df[id_col].alias("__id"), _digest(df[text_col]).alias("__h"))
    joined = ids.join(per, ids["__id"].eqNullSafe(per["id"]) & (ids["__h"] == per["h"]), "left")
    zero = [F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in BASE]
    return joined.select(
        F.col("__id").alias(id_col), *zero, F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_live", F.lit(0)).cast("bigint").alias("n_live"),
        F.coalesce("live_spans", F.expr("cast(array() as array<array<int>>)")).alias("live_spans"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("most_owners", "most_repos")])


def _digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _found(df: DataFrame, id_col: str, text_col: str, owner_col: str, repo_cols: list[str],
           max_owners: int, max_repos: int) -> DataFrame:
    """Figures of each (id, text digest) that has a span to report."""
    held = store(_candidates(df, id_col, text_col, owner_col, repo_cols), "candidates")
    judged = _judged(held, max_owners, max_repos)
    n_base = len(BASE)
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = F.when((F.col("kind") < n_base) | F.col("live"), F.struct("start", "kind", "end", "live"))
    per = judged.groupBy("id", "h").agg(F.array_sort(F.collect_set(shown)).alias("all"),
                                        F.max("owners").alias("most_owners"), F.max("repos").alias("most_repos"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(i: int) -> Column:
        return F.size(F.filter("all", lambda s: s["kind"] == i)).cast("bigint")

    base = F.filter("all", lambda s: s["kind"] < n_base)
    live = F.filter("all", lambda s: s["live"])
    return per.select("id", "h", *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
                      F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"),
                      F.size(live).cast("bigint").alias("n_live"),
                      F.transform(live, lambda s: F.array(s["start"], s["end"])).alias("live_spans"),
                      "most_owners", "most_repos")


def mask_live(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
              repo_cols: tuple[str, ...] = ("source", "lang"), length_col: str | None = "n_chars",
              mask: str = "[secret]", max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """All rows and columns, each live place in the text replaced by ``mask``; ``length_col`` follows the text.

    Overlapping places are masked as one. Rows without a live place are as they
    were, nulls included.
    """
    per = _found(df, id_col, text_col, owner_col, list(repo_cols), max_owners, max_repos).where("n_live > 0").select(
        F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("live_spans").alias("__live"))
    whole = df[text_col]
    joined = df.join(per, df[id_col].eqNullSafe(per["__id"]) & (_digest(whole) == per["__h"]), "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        out = F.when(span[0] >= state["at"],
                     F.concat(state["out"], F.substring(whole, state["at"] + 1, span[0] - state["at"]), F.lit(mask)))
        return F.struct(F.greatest(state["at"], span[1]).alias("at"), out.otherwise(state["out"]).alias("out"))

    cleaned = F.aggregate("__live", start, step,
                          lambda s: F.concat(s["out"], F.substring(whole, s["at"] + 1, F.char_length(whole) - s["at"])))
    untouched = F.col("__live").isNull()
    new = F.when(untouched, whole).otherwise(cleaned)
    return joined.select(*[
        new.alias(c) if c == text_col else
        F.when(untouched, df[c]).otherwise(F.char_length(new)).cast(df.schema[c].dataType).alias(c)
        if c == length_col else df[c] for c in df.columns])
