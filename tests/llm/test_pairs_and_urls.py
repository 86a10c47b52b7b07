"""Spelling variants, hard negatives and the URL filter against brute force and odd inputs."""

import random
import re
import zlib
from collections import Counter, defaultdict
from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from sparkloom.llm import common, negatives, ngram_join, spelling, url_filter
from sparkloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- spelling variants

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_force(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(ASCII)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            n[word[:h % len(word)] + word[h % len(word) + 1:] if h % 199 == 0 else word] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    found = {w: [x for x in n if abs(len(x) - len(w)) < 2 and near(w, x)] for w in n}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(found[w]), n.get(form[w])))
    return out


@pytest.fixture(scope="module")
def spelt():
    """Chains of forms, ties, doubled letters, long words and a key that holds a third of the rows."""
    rng = random.Random(5)
    words = []
    for base in ("letter", "lettter", "lettèr", "better", "aaaaaa", "aaaaaaa", "straße", "grossen", "x" * 300, "y" + "x" * 300):
        for w in {base, base[:-1] + "z", base[:2] + base[3:], base + base[-1], "q" + base, base[:3] + "÷" + base[3:]}:
            words += [w] * rng.choice([1, 4, 5, 6, 30, 200])
    words += ["center"] * 5 + ["centre"] * 25 + ["centrez"] * 125 + ["CENTREZE"] * 640 + ["cénter"] * 5 + ["conter"] * 5
    words += ["kernel"] * 1990
    rng.shuffle(words)
    rows = [(i % 400, " ".join(words[i::400])) for i in range(400)]
    return [*rows, rows[0], (None, "letter better"), (1, None), (2, ""), (3, "  \n"), (4, "12 345 éé"), (5, "kernel," * 30)]


def texts(spark, rows):
    return spark.createDataFrame([(k, t, 1, "n") for k, t in rows], "doc_id bigint, text string, n int, word string")


@pytest.mark.parametrize("slice_blocks", [1 << 17, 2])
def test_variants_equal_force(spark, spelt, slice_blocks):
    got = spelling.variants(texts(spark, spelt), slice_blocks=slice_blocks)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = got.collect()
    assert {tuple(r) for r in got} == variants_by_force(spelt) and len(got) == len({r.word for r in got})
    assert any(r.root != r.form for r in got if r.form)


def test_variants_of_the_driver_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert {tuple(r) for r in QUERIES["op11_spelling_variants"](spark, SF).collect()} == variants_by_force(rows)


def test_variants_of_nothing(spark):
    assert spelling.variants(texts(spark, [])).count() == 0
    assert spelling.variants(texts(spark, [(1, None), (2, "few words")])).count() == 0


def test_edits_reach_every_neighbour_once():
    """Each near pair has one edit from one of its words, at any place and in long words too."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 9))) for _ in range(300)] + ["ab" * 400, "ab" * 399 + "a"]
    words = sorted(set(words))
    w = spelling.Words(words)
    number = {h: i for i, h in enumerate(w.hash.tolist())}
    met = Counter()
    for word, _, h, size in spelling.edits(w, 6):
        for a, x, s in zip(word.tolist(), h.tolist(), size.tolist(), strict=True):
            if x in number and len(words[number[x]]) == s:
                met[frozenset((a, number[x]))] += 1
    expected = {frozenset((i, j)) for i in range(len(words)) for j in range(i) if near(words[i], words[j])}
    assert met == dict.fromkeys(expected, 1)


def test_filter_misses_no_word_and_little_else(spark):
    rng = np.random.default_rng(4)
    h, size = rng.integers(0, 2 ** 64, 20_000, np.uint64), rng.integers(6, 300, 20_000)
    shards = spelling.Shards(Counter(np.minimum(size, spelling.LONG).tolist()))
    held = np.zeros(8 * shards.total, np.uint64)
    for slot, bits in zip(*(np.concatenate(x) for x in ((p[0], p[2]), (p[1], p[3]))), strict=True) if (
            p := shards.places(h, size)) else ():
        held[slot] |= bits
    other = rng.integers(0, 2 ** 64, 20_000, np.uint64)

    def share(x):
        s1, m1, s2, m2 = shards.places(x, size)
        return ((held[s1] & m1 == m1) & (held[s2] & m2 == m2)).mean()

    assert share(h) == 1 and share(other) < 0.01


# ---------------------------------------------------------------- hard negatives

def negatives_by_force(rows):
    kept = set()
    for key, vector, label in rows:
        if key is None or label is None or vector is None or not all(x is not None and isfinite(x) for x in vector):
            continue
        label = int(np.fmod(label + 1, 10)) if key % 7 == 0 else label
        kept.add((key, label, tuple(floor(256 * x) for x in vector)))
    out = Counter()
    for a, mine, q in kept:
        if a % 100:
            continue
        score = {(sum(x * y for x, y in zip(q, v, strict=False)), b, label == mine) for b, label, v in kept}
        positives = sorted((-s, b) for s, b, same in score if same and b != a)[:5]
        for p, b in positives:
            fit = sorted((-s, c) for s, c, same in score if not same and 80 * -p <= 100 * s <= 100 * -p)[:5]
            out.update((a, b, r + 1, c, -p, -s) for r, (s, c) in enumerate(fit))
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "vec_id bigint, embedding array<float>, label int, score int")


@pytest.fixture(scope="module")
def odd_vectors():
    rng = np.random.default_rng(8)
    rows = []
    centre = rng.normal(size=(10, 12)) * 0.3
    for i in range(900):
        label = int(rng.integers(0, 3)) if i % 3 else 0
        v = np.round(centre[label] + rng.normal(size=12) * (0.3 if i % 5 else 0), 1)  # ties and repeated vectors
        rows.append((i, [float(x) for x in v.astype(np.float32)], label))
    v = rows[100][1]
    rows += [rows[200], rows[305], (300, v, 1), (300, rows[8][1], 1), (901, None, 1), (902, [nan, *v[1:]], 1), (903, [inf, *v[1:]], 0),
             (904, [None, *v[1:]], 2), (905, v, None), (None, v, 1), (906, [], 1), (907, v[:5], 1), (908, [*v, 9.0], 2),
             (1000, [], 0), (1100, [0.0] * 12, 2), (1200, [-x for x in v], 0),
             *((1300 + i, [float(np.float32(x * size)) for x in v], label)  # sums beyond what a double holds exactly
               for i, (size, label) in enumerate([(1.5e6, 1), (1.5e6, 0), (1.45e6, 1), (1.3e6, 2)]))]
    return rows


@pytest.mark.parametrize("slice_bytes", [4 << 20, 400])
def test_negatives_equal_force(spark, odd_vectors, slice_bytes, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 1 << 12)
    got = negatives.hard_negatives(vectors(spark, odd_vectors).repartition(5), slice_bytes=slice_bytes)
    expected = negatives_by_force(odd_vectors)
    assert len(expected) > 100
    assert Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                   for r in got.collect()) == expected


def test_huge_components_take_no_part(spark, odd_vectors):
    small = odd_vectors[:300]
    huge = [(2000 + i, [3e30 if i else -3e38] * 12, i % 2) for i in range(3)]
    same = [negatives.hard_negatives(vectors(spark, r)).orderBy("anchor_id", "positive_id", "rank").collect()
            for r in (small, small + huge)]
    assert same[0] == same[1] and same[0]


def test_negatives_of_nothing(spark):
    for rows in ([], [(1, [1.0], 1)], [(100, None, None)], [(100, [1.0], 1)], [(100, [1.0], 1), (101, [1.0], 1)], [(100, [], 1)]):
        assert negatives.hard_negatives(vectors(spark, rows)).count() == 0


def test_bounds_hold_and_leave_rows_out():
    """Every integer score lies within its bounds, which rule most rows of other clusters out."""
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 16))
    q = np.floor(256 * (centre[rng.integers(0, 6, 3000)] + rng.normal(size=(3000, 16)) * 0.15))
    norm = np.sqrt((q * q).sum(1))
    angles = negatives._angles(q, norm, centre / np.linalg.norm(centre, axis=1)[:, None])
    a = negatives.Anchors.__new__(negatives.Anchors)
    a.norm, a.angles = norm[:60], angles[:60]
    low, high = a.bounds(slice(0, 60), norm, angles)
    score = q[:60] @ q.T
    assert (low <= score).all() and (score <= high).all()
    best = np.sort(score, axis=1)[:, -300]
    assert (high < 0.8 * best[:, None]).mean() > 0.4


# ---------------------------------------------------------------- URL filter

URLS = [None, "", "no scheme.com/en/", "https://a.com", "https://A.COM/", "http://com/x", "https://xcom/", "https://a.b.Example.com/en/1?x=/q",
        "http://example.com/en/", "http://example.com/en", "http://example.com/EN/", "https://www.example.com/en/9#a?b", "https://m.www.example.com/en/9",
        "https://www.example.com/fr/", "ftp://x.net/es/1", "//x.net/es/", "://net/fr/1", "https://y.net/fr", "https://y.net?/fr/", "https://y.net#/fr/",
        "https://z.org/en/://com/", "https://com:80/", "https://ünï.com/é", "x\ny://q.net/fr/a\nb?c", "https://.com/", "https://" + "a" * 5000 + ".org/1"]


def judged_by_force(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    host = host.translate(ASCII)
    best = (None, None)
    for rule, says in url_filter.RULES:
        name, folder = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + folder) and len(rule) > len(best[0] or ""):
            best = (rule, says)
    return host, path, *best


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate(urls)],
                                 "page_id bigint, url string, host string, path string, rule string")


def test_rules_by_force(spark):
    got = url_filter.filter_urls(pages(spark, URLS * 2)).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path, rule, says = judged_by_force(URLS[r.page_id % len(URLS)])
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id % len(URLS)]
        assert r.verdict == (says or ("block" if r.blocked >= 0.5 else "allow")) and 0 <= r.blocked <= 1


def test_rules_on_the_driver_table(spark):
    url = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op13_url_filter"](spark, SF).collect()
    assert {r.page_id: (r.host, r.path, r.rule) for r in got} == {k: judged_by_force(u)[:3] for k, u in url.items()}
    assert all(r.verdict == (judged_by_force(url[r.page_id])[3] or r.verdict) for r in got)


def test_trees_learn_labelled_urls(spark):
    """Trained on two thirds of the labelled URLs, the trees judge the others as the rules do."""
    urls = url_filter.judged(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), "page_id", "url", url_filter.RULES)
    train = urls.withColumn("says", F.when(F.crc32("url") % 3 != 1, F.col("says")))
    described = url_filter._described(train, {s: url_filter.suffix_statistics(train, s) for s in url_filter.SUFFIXES})
    model = url_filter.fit(url_filter._narrow(described))
    held = described.where(F.crc32("url") % 3 == 1).join(urls.select("k", F.col("says").alias("truth")), "k").where(
        "truth IS NOT NULL").toArrow().combine_chunks().to_batches()[0]
    p, truth = model.probability(url_filter._features(held)), np.array(held.column("truth").to_pylist()) == "block"
    caught, left = (p[truth] >= 0.5).mean(), (p[~truth] < 0.5).mean()
    print(f"held out: {truth.sum()} blocked, caught {caught:.3f}; {(~truth).sum()} allowed, left alone {left:.3f}")
    assert caught >= 0.9 and left >= 0.9


def test_statistics_count_every_url(spark):
    urls = url_filter.judged(pages(spark, URLS), "page_id", "url", url_filter.RULES)
    force = defaultdict(lambda: [0, 0, 0])
    for u in URLS:
        host, _, _, says = judged_by_force(u)
        if host:
            one = force[host.split(".")[-1]]
            one[0] += 1
            one[1] += says is not None
            one[2] += says == "block"
    assert {r[0]: list(r)[1:] for r in url_filter.suffix_statistics(urls, "suffix1").collect() if r[0]} == {
        k: v for k, v in force.items() if k}


def test_urls_of_nothing_and_without_labels(spark):
    assert url_filter.filter_urls(pages(spark, [])).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages(spark, ["http://a.org/1", None])).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.filter_urls(pages(spark, ["http://a.com/1", None])).collect()} == {"allow"}


# ---------------------------------------------------------------- memories of Python workers

def test_an_operator_empties_the_memories_of_others():
    one, more, other = common.memory("one"), common.memory("one"), common.memory("other")
    for held in (one, more, other):
        held["word"] = 1
    common.forget_others("one")
    assert one and more and not other


def test_mapped_texts_leave_the_memories_of_their_operator_alone(spark):
    docs = spark.createDataFrame([(i, "a text") for i in range(20)], "k int, text string").coalesce(1)

    def met(kept, texts):
        held = ngram_join._WORDS
        found = len(held)
        held.update(dict.fromkeys(texts, 1))
        return [kept[0], [found] * len(texts)]

    def most(operator):
        schema = T.StructType.fromDDL("k int, n int")
        return common.map_texts(docs, ["k", "text"], schema, met, operator).agg(F.max("n")).first()[0]

    assert [most("bpe"), most("bpe")] == [0, 0]
    assert most("ngram_join") <= 1


def test_texts_of_no_group_are_not_shuffled(spark):
    docs = spark.range(4000).selectExpr("named_struct('id', id, 'h', xxhash64(id)) AS d", "concat('text ', id) AS x")
    placed = docs.where("d.id % 100 = 0").selectExpr(
        "d", "d.id AS root", "0 AS piece", "1 AS cuts", "d.id AS rep", "1L AS copies").unionByName(
        spark.sql("SELECT named_struct('id', CAST(NULL AS bigint), 'h', 5L) AS d, 7L AS root, 0 AS piece, 1 AS cuts, 7L AS rep, 1L AS copies"))
    docs = docs.unionByName(spark.sql("SELECT named_struct('id', CAST(NULL AS bigint), 'h', 5L) AS d, 'no id' AS x"))
    assert 40 <= common.likely(docs, placed, "d").count() <= 45
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for groups of any size
    try:
        plan = ngram_join._grouped_texts(docs, placed)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    found = ngram_join._grouped_texts(docs.union(docs), placed).select("rep", "x").collect()
    assert len(found) == 41
    assert {(r.rep, r.x) for r in found} == {(i, f"text {i}") for i in range(0, 4000, 100)} | {(7, "no id")}
