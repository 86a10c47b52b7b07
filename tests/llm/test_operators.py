"""The operators of ``sparkloom.llm`` against brute force, exact round trips, held-out rows and odd inputs."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from check import compare, connect, types_match
from sparkloom.llm import (bpe, decontaminate, licenses, ngram_join, quality, secrets, suffix_dedup, token_counts,
                           toxicity, warc)
from sparkloom.llm.queries import ORACLES, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, texts, schema=DOCS):
    rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, schema)


def words_of(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies of one text, shared passages, odd and repeated rows."""
    rng = random.Random(11)
    base = words_of(rng, 120)
    passage = words_of(rng, 60)
    out = [base] * 4
    for _ in range(40):
        w = base.split()
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        out.append(" ".join(w))
    out += [words_of(rng, rng.randrange(1, 90)) for _ in range(40)]
    out += [words_of(rng, 20) + " " + passage + " " + words_of(rng, 9) for _ in range(5)]
    out += [None, None, "", "   ", "\n", "a", "a b", "a  b", "é" * 300, "é" * 299, "ab" * 400, "abc" * 150,
            "token = abcdef password: x secret: token: abcdefgh", "AKIA" + "Z9" * 9, "f" * 30 + " AKIA1 " + "0" * 24]
    rows = list(enumerate(out))
    return [*rows, rows[3], rows[50], (None, base), (None, "a b")]


def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- n-gram Jaccard join

def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes_by_force(rows, threshold=0.8):
    sets = [grams(t) for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            least[find(i)].append(d)
    return Counter((d, min(least[find(i)], default=None) if sets[i] else d, links[i])
                   for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("piece", [128, 7])
def test_jaccard_classes(spark, texts, monkeypatch, piece):
    monkeypatch.setattr(ngram_join, "PIECE", piece)
    found = ngram_join.jaccard_classes(frame(spark, texts)).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in found) == classes_by_force(texts)


def test_bands_meet_the_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.9995, 256)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9995 and bands * rows <= 256


def test_keep_one_keeps_columns_and_one_of_each_class(spark, texts):
    docs = frame(spark, texts).withColumn("links", F.lit(1)).withColumn("root", F.lit("r"))
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    wanted = classes_by_force(texts)
    stay = {d for d, c, _ in wanted if d is not None and d == c}
    ids = Counter(r.doc_id for r in kept.collect())
    assert {d for d in ids if d is not None} == stay and ids[None] == 2


def test_jaccard_of_nothing(spark):
    assert ngram_join.jaccard_classes(empty(spark)).count() == 0
    assert ngram_join.keep_one(frame(spark, [(1, None), (2, "")])).count() == 2


# ---------------------------------------------------------------- licences

def test_license_variants_match(spark):
    mit = licenses.KNOWN["MIT"]
    variants = ["The year line\n", "Copyright (c) 2020 Some One\n\n" + mit, mit.upper(), mit.replace(",", " ;"),
                "© 1999 X. All rights reserved.\n" + mit.replace(" ", "\n"), mit + " more", None, ""]
    found = {r.doc_id: r.license_id for r in licenses.scan(frame(spark, list(enumerate(variants)))).collect()}
    assert [found[i] for i in range(len(variants))] == [None, "MIT", "MIT", "MIT", "MIT", None, None, None]


def test_whole_license_files(spark):
    """Files as repositories hold them: titles, holders without a year, filled-in places, other list marks."""
    folder = Path(licenses.__file__).parent / "license_texts"
    known = {p.name[:-4]: p.read_text() for p in folder.iterdir()} | {k: licenses.KNOWN[k] for k in ("MIT", "ISC", "0BSD", "Zlib")}
    mit, bsd, apache = known["MIT"], known["BSD-3-Clause"], known["Apache-2.0"]
    files = [(k, t) for k, t in sorted(known.items())] + [
        ("MIT", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + mit), ("MIT", "The MIT License (MIT)\r\n\r\nCopyright Some Body\r\n\r\n" + mit.replace("\n", "\r\n")),
        ("MIT", "# The MIT License\n\nCopyright Org and other contributors, https://org.example/\n\n" + mit),
        ("ISC", "ISC License\n\nCopyright (c) 2020, A\n\n" + known["ISC"]), ("ISC", "The ISC License\n\nCopyright (c) A and Contributors\n\n" + known["ISC"].replace("and/or", "and")),
        ("0BSD", "BSD Zero Clause License\n\nCopyright (C) 2006 by A <a@b.c>\n\n" + known["0BSD"]),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2011, A\nAll rights reserved.\n\n" + bsd[bsd.index("Redistribution"):]),
        ("BSD-3-Clause", "Copyright 2011 B\n\n" + re.sub(r"the\s+copyright\s+holder\s+nor", "B Corp. nor", bsd[bsd.index("Redistribution"):].replace("1. R", "* R").replace("2. R", "* R").replace("3. N", "* N"))),
        ("BSD-2-Clause", "BSD 2-Clause License\n\n" + known["BSD-2-Clause"]),
        ("Apache-2.0", apache[:apache.index("   APPENDIX")]), ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2019 A")), ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "The A Authors")),
        ("GPL-2.0", known["GPL-2.0"].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA")),
        (None, "MIT License\n"), (None, "MIT License\n\nCopyright X\n"), (None, "MIT License\n\nCopyright X\n\n" + mit + "\nand more"), (None, "Some prose\n\n" + mit), (None, "\n" * 5000)]
    found = {r.doc_id: r.license_id for r in licenses.scan(frame(spark, [(i, t) for i, (_, t) in enumerate(files)])).collect()}
    assert [(k, t[:40]) for i, (k, t) in enumerate(files) if found[i] != k] == []


def test_license_spellings_and_empty(spark):
    a = frame(spark, [(1, "Licence: use whilst you favour it"), (2, "license use while you favor it")])
    assert len({r.canonical_sha256 for r in licenses.scan(a).collect()}) == 1
    assert licenses.scan(empty(spark)).count() == 0


# ---------------------------------------------------------------- BPE and token counts

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def odd_texts():
    rng = random.Random(3)
    alphabet = "ab c  \n\t'tsdre12é ñ　中\U0001f600\x00\x85​﻿=-_.\r"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    return out + ["", None, "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "a" * 5000, " " * 77, "they'll can't'S"]


def test_bpe_equals_the_library(spark, library):
    rows = list(enumerate(odd_texts())) + [(0, "again"), (None, "no id")]
    found = bpe.roundtrip(frame(spark, rows), tokenizer_path(), with_ids=True).collect()
    wanted = Counter()
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        wanted[d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
               hashlib.sha256(text.encode()).hexdigest(), tuple(ids), text] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids), r.decoded)
                   for r in found) == wanted


def test_token_counts_equal_the_library(spark, library, monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK", 50)
    rows = list(enumerate(odd_texts())) + [(0, "again"), (None, "no id " * 600)]
    found = token_counts.token_counts(frame(spark, rows), tokenizer_path()).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == Counter(
        (d, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512)
        for d, t in rows)


def test_chunks_do_not_cut_words(library):
    text = " ".join(words_of(random.Random(1), 3000).split())
    parts = token_counts.chunks(text, 100)
    assert len(parts) > 50 and "".join(parts) == text
    assert sum(len(library.encode(p, add_special_tokens=False).ids) for p in parts) == len(
        library.encode(text, add_special_tokens=False).ids)


def test_token_queries_of_nothing(spark):
    assert bpe.roundtrip(empty(spark), tokenizer_path()).count() == 0
    assert token_counts.token_counts(empty(spark), tokenizer_path()).count() == 0


# ---------------------------------------------------------------- quality

def base_by_force(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {k for i in range(len(words) - 4) if n[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def test_quality_base(spark, texts):
    rows = texts + [(900, "a b c d e f " * 40), (901, "x\nx\n \ny # y\nx"), (902, "one two three four five " * 2)]
    model = quality.fit_trees(quality.np.zeros((0, len(quality.FEATURES))), quality.np.zeros(0), [0] * 15)
    found = quality.rate_documents(frame(spark, rows), model).collect()
    got = Counter((r.doc_id, *(r[c] for c in quality._BASE), r.base_failed, r.kept) for r in found)
    wanted = Counter()
    for d, t in rows:
        b = base_by_force(t)
        failed = b[0] < 10 or 100 * b[4] > 20 * b[0]
        wanted[(d, *b, failed, not failed)] += 1
    assert got == wanted


def test_trees_learn_and_are_monotonic():
    np = quality.np
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(3000) < 0.1)).astype(float)
    model = quality.fit_trees(x, y, [-1, 0, 1], trees=30)
    assert ((model.probability(x) > 0.5) == (x[:, 0] < 0.5)).mean() > 0.98
    for f, sign in ((0, -1), (2, 1)):
        for row in x[:40]:
            line = np.repeat(row[None], 60, 0)
            line[:, f] = np.linspace(0, 1, 60)
            assert (np.diff(model.probability(line)) * sign >= -1e-12).all()


def test_quality_on_labelled_rows(spark):
    rows = {r.doc_id: r.kept for r in QUERIES["op4_quality_rules"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    right = sum(rows[r.doc_id] == bool(r.quality) for r in labels)
    assert right >= 0.9 * len(labels)


# ---------------------------------------------------------------- toxicity

def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.7) for d, r in rows.items())
    held = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r.doc_id].held_out]
    clean, toxic = [r for r in held if not r.toxic], [r for r in held if r.toxic]
    assert sum(rows[r.doc_id].predicted for r in clean) <= 0.03 * len(clean)
    assert sum(rows[r.doc_id].predicted for r in toxic) >= 0.85 * len(toxic)


def test_toxicity_reads_gapped_words(spark):
    rng = random.Random(4)
    docs = [Counter(words_of(rng, 60).split()) for _ in range(300)]
    bags = [(d, 0) for d in docs[:200]] + [(d + Counter(["blargous", "blarg"]), 1) for d in docs[200:]]
    model = toxicity.train(bags)
    scored = toxicity.score(frame(spark, [(0, words_of(rng, 50) + " bl.arg.ous!"), (1, words_of(rng, 50)),
                                          (2, None), (3, ""), (4, "b l a r g o u s"), (5, "...")]), model)
    found = {r.doc_id: r.score for r in scored.collect()}
    assert found[0] >= 0.7 > found[1] and found[4] >= 0.7 and found[2] == found[3] == found[5] == 0
    kept = toxicity.reject(frame(spark, [(0, "the blargous"), (1, None), (2, words_of(rng, 50))]), model)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_toxicity_learns_from_the_whole_sample(spark, monkeypatch):
    docs = spark.range(16000).select(F.col("id").alias("doc_id"), F.concat(F.lit("an be an w"), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    monkeypatch.setattr(toxicity, "train", lambda bags: bags)
    bags = toxicity.fit(docs, labels)
    assert Counter(y for _, y in bags) == {1: 2000, 0: 3000}
    bag = bags[0][0]
    assert dict(bag.items()) == dict(bag) and bag["an"] == 2 and sum(bag.values()) == 4 and bag.get("none") is None


def test_kernel_on_columns_of_landmarks():
    """Vectors cut to what landmarks hold give the kernel of the whole ones; small eigenvalues are no noise."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé1") for _ in range(rng.randrange(1, 30))) for _ in range(60)] + ["", "a"]
    used, column = toxicity._columns(words[:20])
    whole, cut = toxicity._vectors(words), toxicity._vectors(words, column, len(used))
    assert abs(whole @ whole[:20].T - cut @ cut[:20].T).max() < 1e-12
    assert len(used) < 20 * 300 and cut.shape == (62, len(used))


def test_toxicity_without_examples(spark):
    model = toxicity.train([])
    assert [r.predicted for r in toxicity.score(frame(spark, [(1, "any words")]), model).collect()] == [0]
    assert toxicity.score(empty(spark), model).count() == 0


def test_kernel_by_force():
    from itertools import combinations

    def kernel(a, b):
        def sums(w):
            out = defaultdict(float)
            for p in combinations(range(len(w)), 3):
                if p[-1] - p[0] < toxicity.SPAN:
                    out["".join(w[i] for i in p)] += toxicity.DECAY ** (p[-1] - p[0] + 1)
            return out
        x, y = sums(f"^{a}$"), sums(f"^{b}$")
        dot = sum(v * y[k] for k, v in x.items())
        return dot / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5

    words = ["stupid", "stuupid", "s1tupid", "other", "aa", "banana"]
    v = toxicity._vectors(words).astype(float)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(float(v[i] @ v[j]) - kernel(a, b)) < 1e-5


# ---------------------------------------------------------------- decontamination

@pytest.fixture(scope="module")
def items():
    rng = random.Random(11)
    words_of(rng, 120)
    passage = words_of(rng, 60)
    return [(1, passage), (2, "a b"), (3, ""), (4, None), (5, "A, B!"), (None, "a b"), (1, passage), (6, "--")]


def test_decontamination_paths_agree_with_force(spark, texts, items):
    docs, bench = frame(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(t):
        return pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    wanted = Counter()
    for d, t in texts:
        w, hit, ids = words(t), set(), set()
        for i, it in items:
            iw = words(it)
            for k in range(max(1, len(iw) - 9)) if iw else []:
                win = iw[k:k + 10]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        ids |= {str(i)} if i is not None else set()
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        wanted[d, len(w), len(hit), len(ids), digest, bool(hit)] += 1
    for bound in (1 << 20, 0):
        found = decontaminate.contamination(docs, bench, max_bytes=bound).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                       for r in found) == wanted
        kept = decontaminate.clean(docs, bench, max_bytes=bound)
        assert kept.columns == docs.columns and kept.count() == sum(n for k, n in wanted.items() if not k[-1])


def test_spans_point_into_the_original(spark):
    docs = frame(spark, [(1, "Ünï, Alpha -- BETA! gamma")])
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id bigint, text string")
    row = decontaminate.contamination(docs, bench).first()
    assert row.spans == [[5, 18]] and "Ünï, Alpha -- BETA! gamma"[5:18] == "Alpha -- BETA"
    assert decontaminate.contamination(empty(spark), bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).first().n_items == 0


# ---------------------------------------------------------------- archives

def test_warc_roundtrip(spark):
    pages = [(1, "http://a/ b", "x"), (2, None, None), (3, "http://c", "x"), (4, "http://d", "é\r\n\r\nWARC/1.0\n"),
             (5, "http://e", "é\r\n\r\nWARC/1.0\n"), (6, "f", ""), (1, "http://a", "x"), (7, "g", "y" * 100_000)]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id bigint, url string, html string, first string")
    for least in (0, 1):
        found = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                        for r in warc.roundtrip(df, min_bytes=least).collect())
        wanted = Counter()
        for i, _, html in pages:
            raw = (html or "").encode()
            first = min(k for k, _, h in pages if (h or "") == (html or ""))
            again = len(raw) >= least and first != i
            wanted[i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                   "revisit" if again else "response", first if again else None] += 1
        assert found == wanted
    assert warc.roundtrip(df.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_headers(version):
    records = [("http://a b/", "20010203040506", b"one\ntwo\n"), ("u", "20010203040507", b"")]
    found = list(warc.read_arc(warc.write_arc(records, version)))
    assert [(r["URL"], r["Archive-date"], r["content"]) for r in found] == [
        ("http://a%20b/", records[0][1], records[0][2]), ("u", records[1][1], b"")]
    with pytest.raises(ValueError):
        list(warc.read_arc(warc.write_arc(records, version)[:-9]))


# ---------------------------------------------------------------- secrets

def base_spans(text):
    rules = [("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6),
             ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile(r"[0-9a-f]+"), 0, 24)]
    out = []
    for n, (kind, rx, group, least) in enumerate(rules):
        out += [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for m in rx.finditer(text or "")
                if len(m.group(group)) >= least]
    return sorted(out)


def test_secret_base_spans(spark, texts):
    rng = random.Random(8)
    parts = ["token", "Secret", "api_key", "APIKEY", "password", "=", ": ", " ", "'", '"', "abc", "0f" * 13, "AKIA",
             "ABCD1234EFGH5678", "é\U0001f600", "﷐", "﷑", "\n", "passwd = abcdefg", "$1", "\\"]
    rows = texts + [(1000 + k, "".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for k in range(300)]
    found = secrets.secrets(frame(spark, rows)).collect()
    wanted = Counter()
    for d, t in rows:
        s = base_spans(t)
        n = Counter(x[1] for x in s)
        wanted[d, n[0], n[1], n[2], hashlib.sha256(",".join(x[2] for x in s).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found) == wanted


def test_ownership_parts_examples_from_live_ones(spark):
    shared, own = "AKIA" + "EXAMPLE1" * 2, "AKIA" + "LIVE0001" * 2
    rows = [(i, f"key {shared} end", "en", f"owner{i}", 5) for i in range(6)]
    rows += [(9, f"é {own} and {shared} {own}", "en", "owner1", 5), (10, None, "en", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: r for r in secrets.secrets(docs).collect()}
    assert found[0].n_live == 0 and found[0].n_access == 1 and found[9].n_live == 2 and found[9].n_access == 3
    masked = {r.doc_id: r for r in secrets.mask_live(docs).collect()}
    assert masked[9].text == f"é [secret] and {shared} [secret]" and masked[9].n_chars == len(masked[9].text)
    assert masked[0].text == rows[0][1] and masked[0].n_chars == 5 and masked[10].text is None and len(masked) == 8
    assert secrets.secrets(empty(spark)).count() == 0


def key_text(seed, kind="RSA ", width=64):
    body = base64.b64encode(random.Random(seed).randbytes(600)).decode()
    lines = "\n".join(body[i:i + width] for i in range(0, len(body), width))
    return f"-----BEGIN {kind}PRIVATE KEY-----\n{lines}\n-----END {kind}PRIVATE KEY-----"


def test_private_keys_of_many_sources(spark):
    """Keys are told apart by their bodies: one header in many sources makes no example of them."""
    shared, sealed = key_text(99), key_text(7).replace("KEY-----\n", "KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0F\n\n", 1)
    cut = key_text(8).rsplit("\n", 1)[0]
    wrapped = [shared, key_text(99, width=76), key_text(99, "").replace("\n", "\\n"), shared.replace("\n", "\n  "), shared]
    rows = [(i, f"é one {key_text(i)} end", "en", f"s{i}", 0) for i in range(6)]
    rows += [(10 + i, f"an example {t} here", "en", f"s{i}", 0) for i, t in enumerate(wrapped)]
    rows += [(20, f"a {sealed} b", "en", "s1", 0), (21, f"a {cut}", "en", "s2", 0),
             (22, f"{key_text(30)} {key_text(31)}", "en", "s3", 0),
             (23, "-----BEGIN RSA PRIVATE KEY----- is a header line", "en", "s4", 0), (24, "-----BEGIN RSA PRIVATE KEY-----" * 3000, "en", "s5", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: r for r in secrets.secrets(docs).collect()}
    masked = {r.doc_id: r.text for r in secrets.mask_live(docs).collect()}
    for i in range(6):
        assert found[i].spans == f"private:6:{6 + len(key_text(i))}" and found[i].n_live == 1
        assert masked[i] == "é one [secret] end"
    for i, t in enumerate(wrapped):
        assert found[10 + i].spans == "" and masked[10 + i] == f"an example {t} here"
    assert (masked[20], masked[21], masked[22]) == ("a [secret] b", "a [secret]", "[secret] [secret]")
    assert masked[23] == rows[-2][1] and masked[24] == rows[-1][1]


def test_many_matches_and_long_keys(spark):
    """Sixteen thousand matches in one text; a key of five thousand lines; a body with five thousand hyphen groups."""
    many = " ".join(f"{k:024x}" for k in range(16_000))
    body = "\n".join(base64.b64encode(random.Random(k).randbytes(48)).decode() for k in range(5_000))
    hyphens = "Comment: " + "a-b" * 5_000 + "\n" + "Q" * 64
    edge = "-----{} PRIVATE KEY-----"
    rows = [(1, many), (2, f"{edge.format('BEGIN')}\n{body}\n{edge.format('END')} after"), (3, f"{edge.format('BEGIN')}\n{body} after"),
            (4, f"{edge.format('BEGIN')}\n{hyphens}\n{edge.format('END')} after")]
    begun = time.time()
    found = {r.doc_id: r for r in secrets.secrets(frame(spark, rows)).collect()}
    assert time.time() - begun < 30
    assert found[1].n_hex == 16_000 and found[1].base_sha256 == hashlib.sha256(
        ",".join(x[2] for x in base_spans(many)).encode()).hexdigest()
    for i in (2, 4):
        assert found[i].spans == f"private:0:{len(rows[i - 1][1]) - len(' after')}"
    assert found[3].spans.startswith("private:0:") and int(found[3].spans.split(":")[2]) >= len(rows[2][1]) - len(" after")


def judged_by_force(rows, max_owners=secrets.MAX_OWNERS, max_repos=secrets.MAX_REPOS):
    """Per row: spans, live places, most owners, most repositories."""
    kinds = {k: (re.compile(p.replace("\\z", "\\Z")), g, n) for k, (p, g, n) in secrets.KINDS.items()}
    held, owners, repos = [], defaultdict(set), defaultdict(set)
    for doc, text, lang, source, _ in rows:
        mine = []
        for number, (kind, (rx, group, least)) in enumerate(kinds.items()):
            for m in rx.finditer(text or ""):
                value = m.group(group)
                if kind in secrets.APART:
                    value = re.sub(secrets.APART[kind], "", value)
                if len(value) >= least:
                    mine.append((m.start(), number, m.end(), kind, value))
                    repos[value].add((source, lang))
                    if source is not None:
                        owners[value].add(source)
        held.append((doc, mine))
    out = Counter()
    for doc, mine in held:
        def live(v):
            return len(owners[v]) <= max_owners and (len(owners[v]) <= 1 or len(repos[v]) <= max_repos)
        shown = sorted(x for x in mine if x[3] in secrets.BASE or live(x[4]))
        out[doc, ",".join(f"{k}:{a}:{b}" for a, _, b, k, _ in shown), sum(live(x[4]) for x in shown),
            max((len(owners[x[4]]) for x in mine), default=0), max((len(repos[x[4]]) for x in mine), default=0)] += 1
    return out


def verdicts(found):
    return Counter((r.doc_id, r.spans, r.n_live, r.most_owners, r.most_repos) for r in found.collect())


def test_ownership_by_force_on_the_driver_table(spark):
    sf = SF.replace("0.001", "0.01")  # the smallest table with secrets in it
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = QUERIES["op9_secret_scan"](spark, sf)
    assert verdicts(found) == judged_by_force(rows) and found.where("spans <> ''").count() > 0


def test_owners_and_repositories_decide_together(spark):
    """One owner's key in many repositories is live; two owners' in many is an example; also bearer and provider tokens."""
    alone, both = "ghp_" + "A1" * 18, "ghp_" + "B2" * 18
    rows = [(i, f"use {alone} now", f"l{i}", "one", 0) for i in range(9)]
    rows += [(20 + i, f"use {both} now", f"l{i // 2}", f"o{i % 2}", 0) for i in range(8)]
    rows += [(40, "Authorization: Bearer " + "x.Y_z-" * 4, "en", "two", 0), (41, "bearer short", "en", "two", 0),
             (42, "ghs_" + "c" * 36, None, None, 0), (43, "gho_" + "c" * 35, "en", "two", 0)]
    found = secrets.secrets(spark.createDataFrame(rows, DOCS))
    assert verdicts(found) == judged_by_force(rows)
    by = {r.doc_id: r for r in found.collect()}
    assert by[0].spans == "github:4:44" and by[0].most_repos == 9 and by[20].spans == "" and by[20].most_owners == 2
    assert by[40].spans == "bearer:15:46" and by[41].spans == "" and by[42].spans == "github:0:40,hex:4:40" and by[43].spans == "hex:4:39"


def test_secret_scan_runs_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = secrets.secrets(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---------------------------------------------------------------- repeated strings

def removed_by_force(rows, length):
    where = Counter()
    raws = [(t or "").encode() for _, t in rows]
    for raw in raws:
        where.update(raw[i:i + length] for i in range(len(raw) - length + 1))
    out = Counter()
    for (d, _), raw in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if where[raw[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[d, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("length, gram", [(200, 40), (30, 8)])
def test_repeats_are_removed(spark, texts, length, gram):
    found = suffix_dedup.remove_repeats(frame(spark, texts), length=length, gram=gram).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == removed_by_force(
        texts, length)


def test_repeats_on_the_driver_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = QUERIES["op10_suffix_dedup"](spark, SF).collect()
    assert Counter(tuple(r) for r in found) == removed_by_force(rows, 200)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


# ---------------------------------------------------------------- queries and pipeline

@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    df, con = QUERIES[name](spark, SF), connect(SF)
    assert compare(df, con, ORACLES[name]) is None and types_match(df, con, ORACLES[name]) == []


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
    ids = {r.doc_id for r in docs.collect()}
    found = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in found} <= ids and len(found) > 0.5 * len(ids)
