"""Operators 11 to 13 against plain restatements, and their defined cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pricewise.llm import chat, negatives, resample

CHAT = "conv_id long, turn long, role string, text string, ids string, mask int, place long, conv int"


@pytest.fixture(scope="module")
def vocabulary():
    return chat.ChatVocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def turns():
    rng = random.Random(3)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[", "<", "\\", "/s>", "ok ", "é好", "<\\/s>", "[\\\\INST]", "[ROLE]", "<|endoftext|>", "\n"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", "tool", "[/ROLE]", "", None])
            text = rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randint(1, 30)))])
            rows.append((conv, turn, role, text))
    rows += [(50, None, "user", "first"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a"), (50, 1, "system", "z"),
             (None, 0, "user", "no id"), (None, 1, "assistant", "</s>"), (60, 0, "user", "x" * 300_000 + " " * 300_000),
             (60, 1, "assistant", "[ANS]" * 50_000)]
    rows += [(70, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(3000)]
    return rows


def digests(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=key)
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        out[conv] = (len(mine), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_reads_back(spark, vocabulary):
    rows = turns()
    table = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], CHAT).repartition(5)
    formatted = chat.format_chat(table, vocabulary)
    want = digests(rows)
    once = {r[0]: tuple(r)[1:5] for r in chat.read_back(formatted, vocabulary, in_order=True).collect()}
    assert once == want
    # and from the turns dealt anew; the rendered text alone can be parsed
    dealt = formatted.repartition(7, "place")
    again = {r["conv"]: r for r in chat.read_back(dealt, vocabulary).collect()}
    assert {k: tuple(r)[1:5] for k, r in again.items()} == want
    by_conv = {}
    for r in formatted.where("conv < 41").orderBy("conv", "place").collect():
        by_conv.setdefault(r["conv"], []).append(r)
    for conv, parts in by_conv.items():
        ids = np.array([i for p in parts for i in p["ids"]])
        text = vocabulary.bytes_of(ids)[0].decode()
        assert len(text) == again[conv]["formatted_chars"]
        assert [p["start"] for p in parts] == np.cumsum([0, *(len(p["ids"]) for p in parts)])[:-1].tolist()
        assert [p["place"] for p in parts] == list(range(len(parts)))
        found = re.findall(r"\[INST\](.*?)\[/INST\]|\[SYS\](.*?)\[/SYS\]|\[ANS\](.*?)</s>|\[ROLE\](.*?)\[/ROLE\](.*?)\[/TURN\]", text, re.S)
        assert len(found) == len(parts) and text.startswith("<s>")
        mask = np.array([m for p in parts for m in p["mask"]], bool)
        assert not np.isin(ids[mask], list(vocabulary.mark.values())).any()


def test_chat_escape_is_reversible(vocabulary):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "ANS]", "|endoftext|>", "a"]) for _ in range(rng.randint(0, 12)))
        held = vocabulary.escape(text)
        assert vocabulary.unescape(held) == text
        assert not any(m in held for m in chat.MARKS) and "<|endoftext|>" not in held


def test_chat_empty(spark, vocabulary):
    none = chat.format_chat(spark.createDataFrame([], CHAT), vocabulary)
    assert chat.read_back(none, vocabulary).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def draw(docs, targets, percent=10, least=20):
    buckets = lambda t: [zlib.crc32(w.encode()) % 10000 for w in WORD.findall(lower(t))]
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for text in docs:
        np.add.at(s, buckets(text[1]), 1)
    for text in targets:
        np.add.at(t, buckets(text), 1)
    S, T = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log((int(b) + 1) * (S + 10000) / ((int(a) + 1) * (T + 10000)))) for a, b in zip(s, t)]
    rows = []
    for k, text in docs:
        b = buckets(text)
        weight = sum(gain[x] for x in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append((k, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[:len(able) * percent // 100]
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)] + [(*r, None) for r in able[len(drawn):] + [r for r in rows if r[1] < least]], key=str)


@pytest.mark.parametrize("block, bits, percent", [(15, 11, 10), (3, 2, 60), (2, 5, 100)])
def test_resample(spark, docs, texts, block, bits, percent):
    targets = [None, "", "the and ing", texts[0]]
    table = docs.unionByName(docs.where("doc_id < 30").withColumn("doc_id", F.col("doc_id") * -2**40))
    found = resample.resample(table, spark.createDataFrame([(t, 1) for t in targets], "text string, item_id int"),
                              block=block, bits=bits, percent=percent)
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert sorted(map(tuple, found.collect()), key=str) == draw(rows, targets, percent)


def test_resample_empty(spark, no_docs, docs):
    target = spark.createDataFrame([], "text string")
    assert resample.resample(no_docs, target).count() == 0
    assert resample.resample(docs, target).count() == docs.count()
    few = docs.where("doc_id < 2 OR text IS NULL")
    assert resample.resample(few, target, percent=100, least=1, bits=3, block=1).where("rank IS NOT NULL").count() \
        == few.where("text IS NOT NULL").count()


def test_checksums_of_long_and_odd_words():
    text = ["é" * 40 + " A1-b", "", "x" * 5000, "Ab\x00cd", "[]", "z"]
    data = np.frombuffer("".join(text).encode(), np.uint8)
    off = np.r_[0, np.cumsum([len(t.encode()) for t in text])]
    bucket, at = resample.word_buckets(data, off, 2**32)
    want = [[zlib.crc32(w.encode()) for w in WORD.findall(lower(t))] for t in text]
    assert [bucket[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def mined(rows, anchors, low=50, high=95, n_pos=5, n_neg=3):
    out = []
    ints = [(k, [math.floor(256 * x) for x in v], label) for k, v, label in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [r for r in ints if sum(x * x for x in r[1]) < 2**62]
    order = lambda s, k: (-s, k is None, k or 0)
    for a, (ka, va, la) in enumerate(ints):
        if not anchors(ka):
            continue
        score = [sum(x * y for x, y in zip(va, v)) for _, v, _ in ints]
        pos = sorted((j for j in range(len(ints)) if j != a and ints[j][2] == la), key=lambda j: order(score[j], ints[j][0]))[:n_pos]
        for p in pos:
            neg = sorted((j for j in range(len(ints)) if ints[j][2] != la and low * score[p] <= 100 * score[j] <= high * score[p]),
                         key=lambda j: order(score[j], ints[j][0]))[:n_neg]
            out += [(ka, ints[p][0], k + 1, ints[j][0], score[p], score[j]) for k, j in enumerate(neg)]
    return sorted(out, key=str)


def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 12)) / 3
    rows = [(k, (base[k % 6] + rng.normal(size=12) * 0.2).tolist(), int(rng.integers(0, 4))) for k in range(400)]
    rows += [(400 + k, base[0].tolist(), k % 3) for k in range(150)]  # copies with several labels
    rows += [rows[0], rows[400], (600, None, 1), (601, [], 1), (602, [1.0, None], 2), (603, [math.nan] * 12, 1), (604, [math.inf] * 12, 1),
             (605, base[1].tolist(), None), (None, base[2].tolist(), 3), (None, base[2].tolist(), 1), (606, [0.0] * 12, 2), (607, [2.0] * 3, 2),
             (608, [1e7] * 12, 1), (609, [-1e7] * 11 + [3e7], 2), (610, [1e30] * 12, 2), (620, [9e6] * 12, 2), (630, [7e6] * 12, 1)]
    return rows


@pytest.mark.parametrize("anchor_chunk, row_chunk", [(1 << 13, 1 << 13), (7, 60)])
def test_hard_negatives(spark, monkeypatch, anchor_chunk, row_chunk):
    monkeypatch.setattr(negatives, "TILE", 1000)
    rows = vectors()
    table = spark.createDataFrame([(*r, 1, "s") for r in rows], "vec_id long, embedding array<double>, label int, score int, positives string")
    found = negatives.mine(table.repartition(6), F.col("vec_id") % 10 == 0, anchor_chunk=anchor_chunk, row_chunk=row_chunk)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows, lambda k: k is not None and k % 10 == 0)
    assert len(want) > 100
    assert sorted(map(tuple, found.collect()), key=str) == want


def test_scores_are_exact():
    rng = np.random.default_rng(9)
    for size, dim in ((3, 5), (300, 64), (2**20, 700), (2**26, 300), (2**28, 30)):
        x, y = rng.integers(-size, size, (20, dim)), rng.integers(-size, size, (30, dim))
        x[0], y[0] = size, -size
        bound = max(sum(int(v) ** 2 for v in r) for r in [*x, *y])
        moduli = negatives.primes(bound)
        got = negatives.Residues(x, moduli).scores(negatives.Residues(y, moduli))
        assert (got == x.astype(object) @ y.astype(object).T).all()


def test_hard_negatives_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(none, F.col("vec_id") % 50 == 0).count() == 0
    alone = spark.createDataFrame([(50, [1.0], 1)], none.schema)
    assert negatives.mine(alone, F.col("vec_id") % 50 == 0).count() == 0
