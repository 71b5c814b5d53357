"""Both tokenizers against their libraries."""
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pricewise.llm import pieces, token_counts

ODD = ["Hello's don't I'M", "a<|endoftext|>b <|startoftext|>", "ΑΣ ΑΣΣ", "x\x1cy\x1f z", "½²١", "İ", "é a", "<|ENDOFTEXT|>", "", "  ",
       "a" * 700, "the " * 300 + "!!!!" * 100, "日本語 한국어 🎉👩‍👩‍👧", " " * 50 + "x" + " " * 37, "<s>a</s>", "<0x0A>", "\x00b퟿", "a\n\nb"]
ALPHABET = "aAbBsStTrRe.!1²½é́Σ日\n\t\x1c​  "


@pytest.fixture(scope="module")
def many():
    rng = random.Random(3)
    return ODD + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + [
        "".join(rng.choice("ab the \n") for _ in range(rng.randint(90, 300))) for _ in range(100)]


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.WordBpe(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_counts_are_the_librarys(many, vocabulary, texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    xs = many + [x or "" for x in texts]
    want = [len(e.ids) for e in t.encode_batch(xs, add_special_tokens=False)]
    assert token_counts.Counter(vocabulary).count(xs) == want


def test_counts_with_little_room_for_words_seen(many, vocabulary, monkeypatch):
    want = token_counts.Counter(vocabulary).count(many)
    monkeypatch.setattr(token_counts, "KEPT", 50)
    counter = token_counts.Counter(vocabulary)
    assert [n for k in range(0, len(many), 7) for n in counter.count(many[k:k + 7])] == want


def test_count_query(docs, no_docs, vocabulary):
    got = token_counts.count_tokens(docs, vocabulary)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(((r.doc_id, len((r.text or "").encode()), n := len(t.encode(r.text or "", add_special_tokens=False).ids), n > 2048)
                   for r in docs.collect()), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert token_counts.count_tokens(no_docs, vocabulary).count() == 0


def test_ids_without_dropout_are_the_librarys(many, model):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    flat, at = pieces.Encoder(model, 0.0, 7).encode(many)
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == sp.encode(many)


def _naive(model, unit, key, drop):
    """One unit by plain search for the best candidate that isn't skipped."""
    from pricewise.llm.bpe import _skipped
    sym = [(int(model.char[ord(c)]), k, k + 1) for k, c in enumerate(unit)]
    table = {(int(k) >> 32, int(k) & 0xFFFFFFFF): (int(r), int(m)) for k, r, m in zip(model.merges.key, model.merges.rank, model.merges.made)}
    while True:
        best = None
        for k, ((a, s, m), (b, _, e)) in enumerate(zip(sym, sym[1:])):
            hit = table.get((a, b)) if a >= 0 and b >= 0 else None
            if hit and (best is None or hit[0] < best[0]) and not _skipped(key, *(np.array([x]) for x in (s, m, e)), drop)[0]:
                best = (hit[0], k, hit[1])
        if best is None:
            return [s for s, _, _ in sym]
        k = best[1]
        sym[k:k + 2] = [(best[2], sym[k][1], sym[k + 1][2])]


def test_dropout_skips_candidates_by_keyed_hash(model):
    units = [" thingstone", " reththeing", "aaaa", " x", " " * 9, " antidisestablishment", " " + "the" * 40]
    keys = np.arange(7, dtype=np.uint64) * np.uint64(977)
    flat, at = model.encode_units(units, keys, 0.3)
    for k, (u, a, b) in enumerate(zip(units, at, at[1:])):
        assert flat[a:b].tolist() == _naive(model, u, keys[k], 0.3), u


def test_dropout_varies_and_decodes(many, model):
    xs = many + ["▁a ▁▁ b▁"] + [" ".join(["interesting", "thing"] * 200)]
    flat, at = pieces.Encoder(model, 0.2, 7).encode(xs)
    again, _ = pieces.Encoder(model, 0.2, 7).encode(xs)
    other, _ = pieces.Encoder(model, 0.2, 8).encode(xs)
    assert flat.tolist() == again.tolist() != other.tolist()
    for x, a, b in zip(xs, at, at[1:]):
        assert model.decode(flat[a:b])[1:].tobytes().decode() == x
    whole = flat[at[-2]:at[-1]].tolist()
    plain, _ = pieces.Encoder(model, 0.0, 7).encode(xs[-1:])
    assert len(whole) > len(plain) and len(set(map(tuple, [whole[:6], whole[6:12], whole[12:18]]))) > 1


def test_each_occurrence_is_drawn_anew(model):
    """Ids are those of plain search keyed by text and position; segmentations of a word go on growing."""
    text = " ".join(["interesting thingstone a", "x" * 120] * 30)
    flat, at = pieces.Encoder(model, 0.3, 7).encode([text])
    units = pieces._UNIT.findall(f" {text}")
    keys = pieces.mix(np.arange(len(units), dtype=np.uint64) + np.uint64(pieces.xxhash.xxh64_intdigest(text.encode(), 7)))
    assert flat.tolist() == [i for u, k in zip(units, keys) for i in _naive(model, u, k, 0.3)]
    one = " ".join(["interesting"] * 2000)
    flat, at = pieces.Encoder(model, 0.3, 7).encode([one, one + " end"])
    seen, word = [], []
    for i in flat[at[0]:at[1]].tolist():
        if word and model.decode(np.array([i]))[:1].tobytes() == b" ":
            seen.append(tuple(word))
            word = []
        word.append(i)
    assert len(set(seen)) > 10 and len(seen) == 1999
    assert flat[at[0]:at[0] + 1000].tolist() != flat[at[1]:at[1] + 1000].tolist()


def test_encode_and_decode_frames(docs, no_docs, model):
    rows = pieces.tokenize(docs, model).collect()
    assert all(r.lossless for r in rows)
    assert {(r.ids is None) for r in rows if r.n_tokens} == {False}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all((r.ids is None) == (texts[r.doc_id] is None) for r in rows if r.doc_id is not None)
    out = pieces.add_ids(docs, model)
    assert out.columns == [*docs.columns, "_ids"]
    assert pieces.tokenize(no_docs, model).count() == 0
