"""Sharding, quality, mixing, licences and language ID against brute force or SQL."""
import hashlib
import math
import re
import struct
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricewise.llm import langid, licenses, mixing, quality, sharding

BLANK = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(BLANK, text or "") if w]


def sql(query, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toArrow())
    return [tuple(r) for r in con.execute(query).fetchall()]


# sharding

def position(x, n, seed):
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def h(k, v):
        first = xxhash.xxh64_intdigest(struct.pack("<q", seed * sharding.ROUNDS + k), 42)
        out = xxhash.xxh64_intdigest(struct.pack("<q", v), first)
        return out - 2**64 if out >= 2**63 else out

    while True:
        left, right = x % a, x // a
        for k in range(sharding.ROUNDS):
            if k % 2 == 0:
                left = (left + h(k, right) % a) % a
            else:
                right = (right + h(k, left) % b) % b
        x = left + right * a
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 26, 1023])
def test_permutation(spark, n):
    got = [r[0] for r in spark.range(n).selectExpr(sharding.permute_sql("id", n, 20)).collect()]
    assert got == [position(i, n, 20) for i in range(n)]
    assert sorted(got) == list(range(n))


def test_shards(docs, no_docs):
    rows = sharding.shard(docs).collect()
    texts = docs.collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert (r.law, r.grown_shard) == ("rows", None)
        slots[r.shard].append(r.slot)
    sizes = [len(slots[k]) for k in range(40)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shard(docs.repartition(7)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert sharding.shard(no_docs).count() == 0


def test_written_shards(docs, tmp_path):
    some = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    sharding.write_shards(some, sharding.shard(some, shards=4), str(tmp_path / "s"))
    back = docs.sparkSession.read.parquet(str(tmp_path / "s"))
    assert back.count() == some.count() and back.select("shard").distinct().count() == 4


# quality

def base_counts(text):
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_counts(spark, docs, no_docs):
    odd = ["a b c a b c", "x x x x", "a\n\n a\na", "## a <b>|", "l1\nl2\nl1\n" * 5, "é ü 日 é ü 日"]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    rows = quality.judge(more).collect()
    want = Counter((r.doc_id, *base_counts(r.text)) for r in more.collect())
    assert Counter((r.doc_id, *(r[c] for c in quality.BASE)) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality.judge(no_docs).count() == 0
    assert quality.keep_good(no_docs).columns == no_docs.columns


def test_fit_is_expectation_maximisation(spark):
    rng = np.random.default_rng(2)
    votes = []
    for _ in range(400):
        good = rng.random() < 0.8
        votes.append([int(0 if rng.random() < 0.2 else (1 if rng.random() < (0.95 if good else 0.35) else -1)) for _ in quality.RULES])
    prior, good, bad = quality.fit(spark.createDataFrame([(v,) for v in votes], "v array<int>"))
    v = np.array(votes)
    p, g, b = 0.8, np.full(7, 0.9), np.full(7, 0.5)
    for _ in range(quality.ROUNDS):
        logs = math.log(p / (1 - p)) + ((v == 1) * np.log(g / (1 - b)) + (v == -1) * np.log((1 - g) / b)).sum(axis=1)
        q = 1 / (1 + np.exp(-logs))
        p = min(0.95, max(0.05, q.mean()))
        g = np.clip((8 + ((v == 1) * q[:, None]).sum(axis=0)) / (10 + ((v != 0) * q[:, None]).sum(axis=0)), 0.6, 0.999)
        b = np.clip((8 + ((v == -1) * (1 - q)[:, None]).sum(axis=0)) / (10 + ((v != 0) * (1 - q)[:, None]).sum(axis=0)), 0.05, 0.999)
    assert prior == pytest.approx(p) and good == pytest.approx(list(g)) and bad == pytest.approx(list(b))


def test_quality_on_labels(spark):
    """Held-out: labels play no part in the fit."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    judged = quality.judge(docs).join(labels, "doc_id").collect()
    right = sum(r.kept == bool(r.quality) for r in judged)
    assert right / len(judged) > 0.85
    kept = quality.keep_good(docs)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.judge(docs).where("kept").collect()}


# mixing

def test_mix_matches_sql(docs, no_docs):
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = Counter(tuple(r) for r in mixing.mix(unique).collect())
    assert got == Counter(sql(mixing.ORACLE_SQL, documents=unique))
    assert mixing.mix(no_docs).count() == 0


def test_mix_spends_each_budget(docs):
    rows = mixing.mix(docs).collect()
    by = defaultdict(lambda: [0, 0.0, 0])
    for r in rows:
        assert r.taken <= 3 * r.size
        by[r.source_size, r.target][0] += r.taken
    assert len(rows) == docs.count()
    for (size, target), (taken, _, _) in by.items():
        assert target <= 3 * size + 1e-6 and abs(taken - target) <= 3
    out = mixing.draw(docs)
    assert out.columns == docs.columns
    assert sum(len(words(r.text)) for r in out.collect()) > 0


def test_targets_reshare_what_is_above_the_cap(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 0, None: 50}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    capped, want = set(), {}
    while True:
        level = (1560 - sum(3 * sizes[s] for s in capped)) / sum(w for s, w in weights.items() if s not in capped)
        want = {s: 3.0 * sizes[s] if s in capped else weights[s] * level for s in sizes}
        above = {s for s in sizes if s not in capped and want[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    assert got == pytest.approx(want)


# licences

def test_scan(spark, docs, no_docs):
    mit = licenses.KNOWN["MIT"]
    rows = [(1, "Copyright (c) 2020 A. Person\n\n" + mit.upper()), (2, None), (3, "* Released under the  MIT Licence!\nmore"),
            (4, mit + " and more"), (5, mit.replace("\n\n", " ").replace(",", "")), (6, "(c) 2001 X"), (7, licenses.KNOWN["ISC"])]
    mine = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.license_id, r.notices) for r in licenses.scan(mine, licenses.known(spark)).collect()}
    assert got == {1: ("MIT", ""), 2: (None, ""), 3: (None, "MIT notice"), 4: (None, ""), 5: ("MIT", "MIT"), 6: (None, ""), 7: ("ISC", "")}
    both = mine.unionByName(docs.select("doc_id", "text"))
    assert Counter(map(tuple, licenses.scan(both, licenses.known(spark)).collect())) == Counter(sql(licenses.oracle_sql(), documents=both))
    assert licenses.scan(no_docs, licenses.known(spark)).count() == 0
    assert licenses.scan(mine, licenses.known(spark).limit(0)).where("license_id is not null").count() == 0


def test_ordinary_licence_files(spark):
    """Files as projects have them: titles, copyright lines without a year, other wrapping, list marks and holders."""
    texts = {}
    for k, v in licenses.texts():
        texts.setdefault(k, v)
    body = texts["MIT"]
    short = lambda t: textwrap.fill(" ".join(t.split()), 60)
    bsd = texts["BSD-3-Clause"].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ").replace("the copyright holder nor", "Acme Inc. nor")
    apache = texts["Apache-2.0"]
    files = [("MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + body, "MIT"), ("The MIT License (MIT)\r\n\r\nCopyright Jane Doe\r\n\r\n" + body, "MIT"),
             ("Copyright Jane Doe\nCopyright © 2021 John\n\n" + short(body), "MIT"), ("ISC License\n\nCopyright Jane\n" + texts["ISC"], "ISC"),
             (bsd.replace("<year>", "2020"), "BSD-3-Clause"), (short(texts["BSD-2-Clause"].split("<owner>")[1]), "BSD-2-Clause"),
             (apache.replace("[yyyy] [name of copyright owner]", "2020 Acme").replace("     ", ""), "Apache-2.0"),
             (apache.split("APPENDIX")[0], "Apache-2.0"), ("\n".join(apache.strip().split("\n")[3:]), "Apache-2.0"),
             (body + "\nNot for commercial use.", None), ("No use is permitted under this license.\n" + body, None), ("MIT License\n\nCopyright Jane", None)]
    files += [(texts[k], k) for k in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense", "Zlib", "BSL-1.0", "0BSD")]
    mine = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(files)], "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in licenses.scan(mine, licenses.known(spark)).collect()}
    assert got == {i: k for i, (_, k) in enumerate(files)}
    long = spark.createDataFrame([(1, "copyright x\n" * 200_000)], "doc_id long, text string")
    assert licenses.scan(long, licenses.known(spark)).first().license_id is None


# language ID

def cell(a, b, c):
    return ((a << 16 | b << 8 | c) * 2654435761 & 0xFFFFFFFF) >> 16


def test_trigrams():
    texts = ["Ab  c1É", "", "x", "zz é"]
    raw = [t.encode() for t in texts]
    off = np.r_[0, np.cumsum([len(r) for r in raw])]
    cells, at = langid.trigrams(np.frombuffer(b"".join(raw), np.uint8), off)
    for t, a, b in zip(texts, at, at[1:]):
        low = re.sub(rb"[^a-z\x80-\xff]+", b" ", t.lower().encode())
        if len(low) and a < b:
            assert cells[a:b].tolist() == [cell(*low[i:i + 3]) for i in range(len(low) - 2)]
    assert np.diff(at).tolist() == [6 - 1 + 0, 0, 0, 3]


def test_languages_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    held_out = docs.where("doc_id % 2 = 0")
    model = langid.fit(docs.where("doc_id % 2 = 1"))
    scored = langid.score(held_out, model, "text", "ll").withColumn("none", F.lit(None).cast("string"))
    fused = langid.fuse(scored, len(model[0]) + 1, "ll", "none", "none", "source", "none")
    rows = fused.withColumn("found", langid.decide(fused, model[0], "posterior")[0]).select("lang", "found").collect()
    assert sum(r.lang == r.found for r in rows) / len(rows) > 0.98
    got = langid.identify_pages(pages, model).collect()
    assert len(got) == pages.count() and sum(r.lang == r.declared for r in got) / len(got) > 0.98


def test_evidence_is_fused(spark):
    """Posterior of each row against the formulas in plain Python."""
    rows = [(k, [-1.0 - k % 3, -2.0, -9.0], ["x", "y", None][k % 3], "h" if k < 8 else None, "d", "s") for k in range(12)]
    frame = spark.createDataFrame(rows, "id int, ll array<double>, declared string, host string, domain string, suffix string")
    got = {r.id: r.posterior for r in langid.fuse(frame, 3, "ll", "declared", "suffix", "host", "domain").collect()}
    soft = lambda x: np.exp(np.array(x) - max(x)) / np.exp(np.array(x) - max(x)).sum()
    p = {r[0]: soft(r[1]) for r in rows}
    total = sum(p.values())
    sums = lambda i, v: sum(p[r[0]] for r in rows if r[i] == v)
    for r in rows:
        like = [np.zeros(3) if r[i] is None else np.log((sums(i, r[i]) - p[r[0]] + 0.5) / (total + 1)) for i in (2, 5)]
        prior = (total + 1) / (total.sum() + 3)
        for i in (4, 3):
            if r[i] is not None:
                rest = sums(i, r[i]) - p[r[0]]
                prior = (rest + langid.KAPPA * prior) / (rest.sum() + langid.KAPPA)
        assert got[r[0]] == pytest.approx(list(soft(np.array(r[1]) + like[0] + like[1] + np.log(prior))))


def test_language_edge_cases(spark, docs, no_docs):
    known = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(known)
    pages = spark.createDataFrame([(1, "http://a.b.de/x", '<html lang="de"><p>Der die das und ist</p>'), (1, None, None), (None, "", ""),
                                   (2, "no url", "<p>12345 ???</p>")], "page_id long, url string, html string")
    assert langid.identify_pages(pages, model).count() == 4
    assert langid.identify_pages(pages.limit(0), model).count() == 0
    empty = langid.fit(no_docs)
    assert langid.identify_pages(pages, empty).where("lang is not null").count() == 0
    kept = langid.keep_known(known)
    assert kept.columns == known.columns and kept.count() == known.count()
    assert langid.keep_known(no_docs).columns == no_docs.columns
    assert langid.keep_known(docs).columns == docs.columns
    foreign = known.unionByName(spark.createDataFrame([(10**7, "これは日本語の文章です。" * 20, None, "src0", 0)], known.schema))
    assert langid.keep_known(foreign).where("doc_id = 10000000").count() == 0


def test_rare_languages_are_found(spark):
    """Languages of few labelled rows make models too, and tables with only such ones are not rejected whole."""
    known = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = {r.lang for r in known.select("lang").distinct().collect()}
    few = known.where("doc_id % 2 = 1").withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("doc_id"))).where("k <= 5")
    for train, test in ((known, known), (few, known.where("doc_id % 2 = 0"))):
        model = langid.fit(train)
        assert set(model[0]) == labels
        scored = langid.score(test, model, "text", "ll").withColumn("none", F.lit(None).cast("string"))
        fused = langid.fuse(scored, len(model[0]) + 1, "ll", "none", "none", "source", "none")
        rows = fused.withColumn("found", langid.decide(fused, model[0], "posterior")[0]).select("lang", "found").collect()
        for lang in labels:
            of = [r.found for r in rows if r.lang == lang]
            assert sum(f == lang for f in of) / len(of) > 0.8
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert {r.lang for r in langid.identify_pages(pages, langid.fit(known)).collect()} >= labels


def test_key_is_the_digest_of_id_and_text(docs):
    for r in docs.withColumn("k", mixing.mix_key("doc_id", "text")).collect():
        raw = f"mix:{'' if r.doc_id is None else r.doc_id}:{r.text or ''}"
        assert r.k == hashlib.md5(raw.encode()).hexdigest()
