"""URL filters: rules by host and path first, boosted trees on lexical features for the rest.

The labelled URLs are those that a rule decides. Statistics of suffixes (of the
host: its last one, two and three labels; of the path: its first folder) are
counted over all URLs: how many have the suffix, how many of them a rule blocks.
They are written, so that their real size decides how they are joined. The trees
are fitted on a bounded sample of the labelled URLs with the same features.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import store
from .quality import Trees, fit_trees

#: Fixed values: (host and path, verdict).
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block")]
#: Labelled URLs that training uses at most: the documented bound.
SAMPLE_ROWS = 16_000
#: URLs without a label that a suffix statistic is filled up with, half of them blocked.
PRIOR = 20.0
SUFFIXES = ["suffix1", "suffix2", "suffix3", "folder"]
FEATURES = ["length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "host_digit_ratio", "entropy",
            "host_entropy", "parameters", "query_length", "hyphens", "escapes", "longest_part", "has_fragment",
            *(f"{s}_{what}" for s in SUFFIXES for what in ("count", "blocked"))]


def with_parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Add host and path: after the first ``://`` up to ``/``, ``?``, ``#``, and from there up to ``?`` or ``#``."""
    rest = F.regexp_extract(F.coalesce(df[url_col], F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.select("*", host.alias("host"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"))


def rule_of(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; of equally long ones the first in code-point order."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, _, folder = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{folder}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def _share(text: str) -> float:
    return sum("0" <= c <= "9" for c in text) / max(1, len(text))


def lexical(url: str | None, host: str, path: str) -> list[float]:
    url = url or ""
    query = url.partition("#")[0].partition("?")[2]
    return [len(url), len(host), len(path), sum(map(bool, path.split("/"))), host.count(".") + 1 if host else 0, _share(url),
            _share(host), _entropy(url), _entropy(host), sum(map(bool, query.split("&"))), len(query), url.count("-"),
            url.count("%"), max(map(len, path.split("/"))), "#" in url]


def judged(pages: DataFrame, id_col: str, url_col: str, rules: list[tuple[str, str]]) -> DataFrame:
    """k (the id), url, host, path, rule, says (the rule's verdict or null) and the suffixes."""
    df = with_parts(pages.select(pages[id_col].alias("k"), pages[url_col].alias("url")))
    host, path = F.col("host"), F.col("path")
    rule, says = rule_of(rules, host, path)
    labels = F.split(host, r"\.")

    def suffix(n: int) -> Column:
        return F.when(F.size(labels) >= n, F.substring_index(host, ".", -n))

    return df.select("*", rule.alias("rule"), says.alias("says"), *(suffix(n).alias(f"suffix{n}") for n in (1, 2, 3)),
                     F.when(F.size(F.split(path, "/")) > 2, F.split(path, "/")[1]).alias("folder"))


def suffix_statistics(urls: DataFrame, name: str) -> DataFrame:
    """(suffix, n, n_labelled, n_blocked) over all URLs that have one, added up in the tasks first."""
    return store(urls.where(F.col(name).isNotNull()).groupBy(name).agg(
        F.count("*").alias(f"{name}_n"), F.count("says").alias(f"{name}_l"),
        F.count_if(F.col("says") == "block").alias(f"{name}_b")), f"url-{name}")


def _described(urls: DataFrame, statistics: dict[str, DataFrame]) -> DataFrame:
    """The rows with ``s``, the statistics of their suffixes in the order of ``FEATURES``."""
    for name, one in statistics.items():
        urls = urls.join(one, name, "left")
    return urls.withColumn("s", F.array(*(
        c for name in SUFFIXES for c in (
            F.log1p(F.coalesce(f"{name}_n", F.lit(0))),
            (F.coalesce(f"{name}_b", F.lit(0)) + PRIOR / 2) / (F.coalesce(f"{name}_l", F.lit(0)) + PRIOR)))))


def _features(batch: pa.RecordBatch) -> np.ndarray:
    """Of a batch that has url, host, path and s."""
    texts = (batch.column(c).to_pylist() for c in ("url", "host", "path"))
    rows = [lexical(*t) + s for *t, s in zip(*texts, batch.column("s").to_pylist(), strict=True)]
    return np.array(rows, float).reshape(-1, len(FEATURES))


def _narrow(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, "url", "host", "path", "s", "says", "rule")


def fit(described: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees for "a rule blocks it", on at most ``sample_rows`` labelled URLs in the order of a hash of the URL."""
    known = described.where(F.col("says").isNotNull()).orderBy(F.xxhash64("url"), "url").limit(sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(_features(batch)), pa.list_(pa.float64())),
                                                  pa.array([s == "block" for s in batch.column("says").to_pylist()])],
                                                 names=["x", "y"])

    rows = sorted((r["x"], r["y"]) for r in known.mapInArrow(run, "x array<double>, y boolean").collect())
    x = np.array([r[0] for r in rows]).reshape(-1, len(FEATURES))
    return fit_trees(x, np.array([r[1] for r in rows], float), [0] * len(FEATURES))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] = RULES,
                sample_rows: int = SAMPLE_ROWS, cut: float = 0.5) -> DataFrame:
    """Per row: id, host, path, rule, verdict (allow or block), blocked (the trees' probability).

    The verdict is the rule's; without a rule, block if ``blocked`` reaches
    ``cut``. A null URL and one without ``://`` have an empty host and path, no
    rule and the features of an empty text. One row per input row, repeated ones
    too; URLs of any length are read whole; an empty table gives no rows; without
    labelled URLs, or with allowed ones alone, nothing is blocked by the trees.
    Other columns are ignored.
    """
    urls = judged(pages, id_col, url_col, rules)
    described = _described(urls, {name: suffix_statistics(urls, name) for name in SUFFIXES})
    model = fit(_narrow(described), sample_rows)
    if not model.nodes and model.start > 0 and not urls.where(F.col("says") == "block").head(1):
        model = fit_trees(np.zeros((1, len(FEATURES))), np.zeros(1), [0] * len(FEATURES))
    kind = pages.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), *T.StructType.fromDDL(
        "host string, path string, rule string, verdict string, blocked double").fields])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = model.probability(_features(batch))
                says = [s or ("block" if q >= cut else "allow")
                        for s, q in zip(batch.column("says").to_pylist(), p.tolist(), strict=True)]
                columns = [batch.column(c) for c in ("k", "host", "path", "rule")]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip([*columns, pa.array(says), pa.array(p)], out, strict=True)], schema=out)

    return _narrow(described, "k").mapInArrow(run, schema)
