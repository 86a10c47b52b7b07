"""One query per operator over its whole table, and the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import pin_runtime_conf
from . import (bpe, decontaminate, licenses, negatives, ngram_join, quality, secrets, spelling, suffix_dedup, token_counts,
               toxicity, url_filter, warc)
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(pin_runtime_conf(spark), sf_dir, "documents")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op3_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.roundtrip(documents(spark, sf_dir), tokenizer_path())


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.rate_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_path())


def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(pin_runtime_conf(spark), sf_dir, "pages"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(documents(spark, sf_dir)).drop("live_spans")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(pin_runtime_conf(spark), sf_dir, "embeddings"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(pin_runtime_conf(spark), sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_license_scan, op3_bpe_roundtrip, op4_quality_rules, op5_toxicity, op6_decontamination,
    op7_token_counts, op8_arc_to_warc, op9_secret_scan, op10_suffix_dedup, op11_spelling_variants, op12_hard_negatives,
    op13_url_filter)}


def _license_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.KNOWN.items())
    return f"""
WITH known AS (SELECT min(id) AS license_id, sha256({licenses.canonical_sql('body')}) AS digest
               FROM (VALUES {rows}) AS v(id, body) GROUP BY 2),
forms AS (SELECT doc_id, {licenses.canonical_sql('text')} AS form FROM documents)
SELECT doc_id, sha256(form) AS canonical_sha256,
       CAST(CASE WHEN form = '' THEN 0 ELSE length(form) - length(replace(form, ' ', '')) + 1 END AS BIGINT) AS n_words,
       license_id
FROM forms LEFT JOIN known ON sha256(form) = digest"""


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS size,
              array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win
       FROM b, unnest(range(1, greatest(2, len(w) - 8))) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT r, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win
       FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS u(i) WHERE len(w) >= size),
met AS (SELECT r, i, dw.size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM met, unnest(range(i, i + size)) AS u(p) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM met GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""

# crc32 of a key and a word byte by byte; its table of 256 entries comes from the polynomial
_SPELLING_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT b::BIGINT AS b, b::BIGINT AS v, 0 AS i FROM range(256) AS t(b)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i + 1 FROM steps WHERE i < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM steps WHERE i = 8),
runs AS (SELECT doc_id, translate(u.r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
         FROM documents, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS u(r)),
met AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (SELECT run, c, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
            lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)) AS k
          FROM met),
hashed AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, k),
             lambda s, x: xor(s >> 8, t[CAST(xor(s & 255, x) AS BIGINT) + 1])), 4294967295::BIGINT) AS h FROM bytes, crc),
kept AS (SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, c
         FROM hashed),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM kept WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (SELECT DISTINCT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT cut.word, v.word, v.n FROM cut JOIN v ON cut.rest = v.word
         UNION SELECT v.word, cut.word, cut.n FROM cut JOIN v ON cut.rest = v.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(m := -other_n, w := other)) AS b FROM near GROUP BY word),
named AS (SELECT word, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
                 CASE WHEN -b.m >= 5 * n THEN b.w END AS form, CASE WHEN -b.m >= 5 * n THEN CAST(-b.m AS BIGINT) END AS form_n
          FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at, form AS next FROM named
         UNION ALL SELECT walk.word, named.word, named.form FROM walk JOIN named ON walk.next = named.word)
SELECT named.word, named.form, walk.at AS root, n, n_near, form_n FROM named JOIN walk ON named.word = walk.word AND next IS NULL"""

_NEGATIVES_SQL = """
WITH raw AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
             WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(v, lambda x: CAST(floor(256 * x) AS BIGINT)) AS q
      FROM raw WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (SELECT DISTINCT a.vec_id AS anchor_id, a.label AS mine, b.label AS label, b.vec_id AS vec_id,
               CAST(coalesce(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])), 0) AS BIGINT) AS score
        FROM r a JOIN r b ON a.vec_id % 100 = 0),
p AS (SELECT anchor_id, mine, vec_id AS positive_id, score AS positive_score FROM met WHERE mine = label AND anchor_id <> vec_id
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id
             ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN met ON met.anchor_id = p.anchor_id AND met.label <> p.mine
        AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT * FROM n WHERE rank <= 5"""

ORACLES: dict[str, str] = {"op2_license_scan": _license_sql(), "op6_decontamination": _DECONTAMINATION_SQL,
                           "op11_spelling_variants": _SPELLING_SQL, "op12_hard_negatives": _NEGATIVES_SQL}
