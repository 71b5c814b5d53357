"""The Jaccard join against brute force over all pairs."""
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricewise.llm import jaccard, ragged
from pricewise.llm.common import components


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """[(id, n, component)] of rows [(id, text)]."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(s), low.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def test_components_match_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in jaccard.jaccard_components(docs).collect()]
    assert Counter(got) == Counter(brute(rows))


def test_frequent_shingles_index_in_pairs(docs, monkeypatch):
    # every shingle counts as frequent, so that links come from combinations alone
    monkeypatch.setattr(jaccard, "_frequency_codes", lambda d: (np.full(jaccard.CELLS, 9, np.uint8), 3))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in jaccard.jaccard_components(docs).collect()]
    assert Counter(got) == Counter(brute(rows))


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=3), st.sets(st.integers(0, 60), min_size=3), st.integers(0, 255), st.randoms())
def test_linked_sets_share_a_signature(a, b, frequent, rng):
    codes = np.random.default_rng(rng.randint(0, 99)).integers(0, 255, jaccard.CELLS, dtype=np.uint8)
    a, b = (ragged.mix(np.array(sorted(x), np.uint64)) for x in (a, b))
    both = len(np.intersect1d(a, b))
    if 100 * both >= 75 * (len(a) + len(b) - both) and both < max(len(a), len(b)):
        (x, p), (y, q) = (jaccard.signatures(s, codes, min(frequent, 254)) for s in (a, b))
        _, i, j = np.intersect1d(x, y, return_indices=True)
        assert len(i) and (7 * np.minimum(p[i], q[j]).max() >= 3 * (len(a) + len(b)))


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(1)
    for n in (3, 10, 100, 1000):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.unique(np.r_[a[n // 9:], rng.integers(0, 2**63, n // 9, dtype=np.uint64)])
        import pyarrow as pa
        batch = pa.RecordBatch.from_pydict({"a": [1], "b": [2], "n": [len(a)], "m": [len(b)],
                                            "pa": [jaccard.parity(a)], "pb": [jaccard.parity(b)]})
        kept = next(jaccard._close([batch])).num_rows
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            assert kept == 1


def test_words_and_shingles_of_slices():
    import pyarrow as pa
    texts = ["A b\x0bc", None, "", " x ", "a b c", "one two three four five six"]
    data, off = ragged.text_bytes(pa.array(texts))
    h, at = ragged.word_hashes(data, off)
    assert np.diff(at).tolist() == [3, 0, 0, 1, 3, 6]
    assert (h[0:3] == h[4:7]).all()
    assert [len(s) for s in ragged.shingle_hashes(data, off)] == [1, 0, 0, 1, 1, 2]


def test_one_document_of_each_component_stays(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    full = brute(rows)
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns
    with_words = sorted((r.doc_id for r in kept.collect() if shingles(r.text) and r.doc_id is not None))
    assert with_words == sorted({c for d, n, c in full if n and c is not None})
    unnamed = [r.text for r in kept.collect() if r.doc_id is None]
    assert unnamed == ["x " * 30]
    assert sum(not shingles(r.text) for r in kept.collect()) == sum(not shingles(t) for _, t in rows)


def test_empty_tables(no_docs):
    assert jaccard.jaccard_components(no_docs).count() == 0
    assert jaccard.drop_near_copies(no_docs).columns == no_docs.columns
    assert jaccard.drop_near_copies(no_docs).count() == 0


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (9, 8), (5, 5)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)], []])
def test_connected_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    root = {}
    for a, b in edges:
        if a != b:
            x, y = {n for n in root if root[n] == root.get(a, a)} | {a}, {n for n in root if root[n] == root.get(b, b)} | {b}
            root |= dict.fromkeys(x | y, min(x | y))
    assert {r.node: r.root for r in components(frame).collect()} == root


def test_one_id_with_several_texts_loses_none(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(1, a), (1, b), (2, a), (3, b), (4, c), (None, c + " more"), (None, "n " * 9), (None, "n " * 9), (1, ""), (1, None)]
    kept = jaccard.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, a), (1, b), (4, c), (None, "n " * 9), (1, ""), (1, None)], key=str)


@pytest.mark.parametrize("seed", [0, 1])
def test_remaining_pairs_are_all_that_share_a_signature(spark, seed):
    rng = np.random.default_rng(seed)
    size, part = {e: int(rng.integers(80, 120)) for e in range(60)}, {e: int(rng.choice([100, 100, 101, 200 + e])) for e in range(60)}
    rows = {(int(s), e, size[e], size[e] - int(rng.integers(0, 30)), part[e]) for e in range(60) for s in rng.choice(40, rng.integers(1, 25), False)}
    # what a set can still share falls along its signatures, in an order of theirs
    place = rng.permutation(40).tolist()
    rows = [(s, e, n, n - place[s] // 2, p) for s, e, n, _, p in rows]
    left = spark.createDataFrame(rows, "sig long, entity long, n int, most int, part long").repartition(3)
    found = Counter((min(r.a, r.b), max(r.a, r.b)) for r in jaccard._remaining(left).collect())
    near = lambda x, y: 4 * min(x[2], y[2]) >= 3 * max(x[2], y[2])
    must = {(x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and x[4] != y[4] and near(x, y)
            and 7 * min(x[3], y[3]) >= 3 * (x[2] + y[2])}
    assert must == set(found) and len(must) > 100
    assert all(part[a] != part[b] for a, b in found)
    assert sum(found.values()) < 0.9 * len([1 for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and x[4] != y[4]])


def test_a_group_of_near_copies_takes_few_pairs(spark, monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    rows = [(d, " ".join(f"x{d}" if k in at else w for k, w in enumerate(base)))
            for d in range(300) for at in [set(rng.choice(120, rng.integers(0, 5), False).tolist())]]
    verify, joined, seen, edges = jaccard._verify, jaccard.components, [], []
    monkeypatch.setattr(jaccard, "_verify", lambda pairs, sets: (seen.append(pairs.count()), verify(pairs, sets))[1])
    monkeypatch.setattr(jaccard, "components", lambda links: (edges.append(links.count()), joined(links))[1])
    # the words of all are frequent, those of one text rare
    codes = np.zeros(jaccard.CELLS, np.uint8)
    for s in ragged.shingle_hashes(*ragged.text_bytes(pa.array([" ".join(base)]))):
        codes[(s & np.uint64(jaccard.CELLS - 1)).astype(np.int64)] = 200
    monkeypatch.setattr(jaccard, "_frequency_codes", lambda d: (codes, 100))
    got = [tuple(r) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert Counter(got) == Counter(brute(rows))
    # each text is verified against a few, and each link joins components in one round only
    assert sum(seen) < 4 * len(rows) and sum(edges) < 2 * len(rows)
