"""WARC round trips and the embedding join against brute force."""
import gzip
import io
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from pricewise.llm import embeddings, warc
from pricewise.session import ensure_checkpoint_dir

COLS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.fixture(scope="module")
def pages(spark):
    html = "<p>é" + "x" * 200 + "</p>"
    rows = [(5, "http://a/1", html), (3, "http://a/2\nX: y", html), (9, None, html), (1, "u", None), (2, "u", ""), (4, "u", "short"),
            (6, "u", "short"), (7, "", "z" * 99), (8, "", "z" * 99), (10, "u", "y" * 100), (11, "u", "y" * 100),
            (12, "u", "\r\n\r\nWARC/1.1\r\n" * 20), (13, "u", "long " * 300_000), (None, "u", html)]
    return spark.createDataFrame([(*r, "a", 1) for r in rows], "page_id long, url string, html string, digest string, id int").repartition(3)


def test_round_trip(spark, pages):
    back = warc.archive_and_read(pages).cache()
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    assert Counter(map(tuple, back.select(COLS).collect())) == Counter(con.execute(warc.ORACLE_SQL).fetchall())
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    for r in back.collect():
        assert (bytes(r.payload) == html[r.page_id]) if r.record_type == "response" else r.payload is None
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_any_url_and_any_id(spark):
    ids = ["a\r\nb", "", "<urn:page:x>", " ", "é%0A", None, "9"]
    rows = [(k, "http://x/" + "y" * 3_000_000 if k == "9" else "http://x", f"payload {k!r} " * 20) for k in ids]
    rows += [(f"copy of {k!r}", "u", f"payload {k!r} " * 20) for k in ids]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    back = {(r.page_id, r.record_type, r.refers_to): r for r in warc.archive_and_read(pages).collect()}
    want = set()
    for k in ids:
        first = min(x for x in (k, f"copy of {k!r}") if x is not None)
        want |= {(x, "response" if x == first else "revisit", None if x == first else first) for x in (k, f"copy of {k!r}")}
    assert set(back) == want
    assert len(back["9", "response", None].target_uri) > 3_000_000


def test_volumes_are_plain_warc(spark, pages, monkeypatch):
    folder = ensure_checkpoint_dir(spark) + "/warc-test-plain"
    vols = warc.write_archives(pages, folder).collect()
    assert sum(v.n_records for v in vols) == pages.count()
    for v in vols:
        raw = open(v.path.removeprefix("file:"), "rb").read()
        assert len(list(warc.records(io.BytesIO(raw)))) == v.n_records + 1
        assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def some_members(n=5):
    return [warc.page_record(str(k), f"http://x/{k}", (f"page {k} " * 50000).encode(), "0" * 64, "7") if k % 2 else
            warc.member({"WARC-Type": "warcinfo"}, b"x" * k * 100000) for k in range(n)]


def test_reader_works_at_any_piece_size(monkeypatch):
    raw = b"".join(some_members())
    want = list(warc.records(io.BytesIO(raw)))
    assert [len(r.block) for r in want][::2] == [0, 200000, 400000]
    for piece in (1, 7, 1000):
        monkeypatch.setattr(warc, "PIECE", piece)
        if piece > 1 or len(raw) < 10000:
            assert list(warc.records(io.BytesIO(raw))) == want


def test_damage_is_reported():
    good = warc.member({"WARC-Type": "warcinfo"}, b"hello")
    flat = bytearray(gzip.decompress(good))
    flat[flat.index(b"hello")] ^= 1
    cases = {good[:-3]: "ends inside", gzip.compress(bytes(flat)): "wrong block digest", gzip.compress(b"WARC/1.1\r\n\r\n"): "Content-Length",
             gzip.compress(gzip.decompress(good) + b"x"): "goes on", gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nab"): "shorter",
             good + b"junk": "record 1", gzip.compress(b"HTTP/1.1\r\n\r\n"): "not a WARC"}
    for raw, said in cases.items():
        with pytest.raises(ValueError, match=said):
            list(warc.records(io.BytesIO(raw)))
    assert list(warc.records(io.BytesIO(b""))) == []
    assert zlib.decompress(good, 31)


# vectors

def brute(ids, x, cos):
    x = np.asarray(x, np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= cos
    np.fill_diagonal(near, False)
    u, v = np.nonzero(near)
    root = embeddings._roots(len(x), u, v, np.arange(len(x)))
    low = {r: min(i for i, s in zip(ids, root) if s == r) for r in set(root.tolist())}
    return {i: (int(n), low[int(r)], i == low[int(r)]) for i, n, r in zip(ids, near.sum(axis=1), root)}


@pytest.mark.parametrize("dim, chunk", [(64, 1 << 14), (64, 40), (6, 50), (20, 30)])
def test_links_match_brute_force(spark, monkeypatch, dim, chunk):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(200, dim))
    near = [x[rng.integers(0, 200, 150)] + rng.normal(size=(150, dim)) * s for s in (0.1, 0.4, 0.5)]
    group = x[0] + rng.normal(size=(80, dim)) * 0.2
    x = np.vstack([x, *near, group, x[:30], x[:10] * 3.5]).astype(np.float32)
    ids = rng.permutation(len(x)).tolist()
    frame = spark.createDataFrame([(i, v.tolist(), 0, "n") for i, v in zip(ids, x)], "vec_id long, embedding array<float>, label int, node string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(frame.repartition(3)).collect()}
    assert got == brute(ids, x, 0.9)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]),
            (9, [2.0, 0.1]), (10, [-1.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (11, [3e38, 0.0]), (12, [1e-38, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = Counter(map(tuple, embeddings.near_vectors(frame).collect()))
    linked = {1: 2, 2: 1, 9: 1, None: 1, 11: 1, 12: 1}
    want = Counter()
    for i, n in linked.items():
        want[i, 6, 1, i == 1] += n
    for i in (3, 4, 5, 6, 7, 8, 10):
        want[i, 0, i, True] += 1
    assert got == want
    assert embeddings.near_vectors(frame.limit(0)).count() == 0
    assert embeddings.near_vectors(frame.where("vec_id in (3, 5)")).count() == 2
