"""Token counts under a lower-casing BPE vocabulary with word ends (operator 9).

Texts split at white space, which no token crosses. Each distinct word of a slice
of texts is normalised and cut into pre-tokens, and the distinct pre-tokens are
merged together as ragged arrays (:mod:`pricewise.llm.bpe`): every sequence applies
its own lowest-rank pair in the same step, and the symbols left are counted. A
document's count is the sum over its words. Counts of words seen are kept from one
slice to the next, up to ``KEPT`` words in a task.

The vocabulary is read once, on the driver, from a path, and sent to the tasks
(49,000 merges); nothing of it is in this repository.

Defined cases: a null counts as empty, with 0 tokens; special tokens inside a text
count one each, as the library has it by default; texts of any length are counted
whole; repeated rows, ties and extra columns make no difference; an empty table gives
no rows.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.llm.bpe import Merges, merge
from pricewise.llm.ragged import slices, text_bytes

KEPT = 800_000
SLICE = 4_000_000  # bytes of text whose words are looked up together
#: The vocabulary's pattern of pre-tokens, and Unicode's white space.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = regex.compile(f"[^{SPACE}]+")
_PRE = regex.compile(PRE_TOKEN.replace(r"\s", SPACE))


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it is printable,
    else the next one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    """The vocabulary: merges, and the symbols of bytes inside and at the end of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = Merges([ids[a] for a, _ in pairs], [ids[b] for _, b in pairs], range(len(pairs)),
                             [ids[a + b] for a, b in pairs])
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int32)
        self.last = np.array([ids[c + end] for c in letters], np.int32)
        self.special = [t["content"] for t in spec["added_tokens"]]

    def count(self, pre_tokens: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        raw = [p.encode() for p in pre_tokens]
        off = np.r_[0, np.cumsum([len(r) for r in raw], dtype=np.int64)]
        data = np.frombuffer(b"".join(raw), np.uint8)
        flat = self.inner[data]
        flat[off[1:] - 1] = self.last[data[off[1:] - 1]]
        return np.diff(merge(flat, off, self.merges)[1])


class Counter:
    """Token counts of texts, with the counts of words seen."""

    def __init__(self, vocabulary: WordBpe):
        self.vocabulary, self.seen = vocabulary, {}
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special)))

    def _learn(self, words: set[str]) -> None:
        cut, every = {}, {}
        for w in words:
            # one letter at a time, without the final form that lower() gives a sigma
            low = unicodedata.normalize("NFC", w).replace("Σ", "σ").lower()
            cut[w] = _PRE.findall(low)
            every.update(dict.fromkeys(cut[w]))
        if len(self.seen) + len(words) > KEPT:
            self.seen = {}
        n = dict(zip(every, self.vocabulary.count(list(every)).tolist())) if every else {}
        for w, parts in cut.items():
            self.seen[w] = sum(map(n.__getitem__, parts))

    def count(self, texts: list[str]) -> list[int]:
        found, extra = [], []
        for t in texts:
            extra.append(0)
            if "<|" in t:
                t, extra[-1] = self.special.subn(" ", t)
            found.append(_WORD.findall(t))
        new = {w for words in found for w in words if w not in self.seen}
        if new:
            missing = new if len(self.seen) + len(new) <= KEPT else {w for words in found for w in words}
            self._learn(missing)
        return [sum(map(self.seen.__getitem__, words)) + k for words, k in zip(found, extra)]


def count_tokens(docs: DataFrame, vocabulary: WordBpe, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """Per row: the id, n_bytes, n_tokens, over_limit."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField(id_col, plain.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches):
        counter = Counter(held.value)
        for batch in batches:
            text = batch.column("text").fill_null("")
            _, off = text_bytes(text)
            n = []
            for i, j in slices(off, SLICE):
                n += counter.count(text.slice(i, j - i).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(off)), pa.array(n, pa.int64())], names=schema.names)

    return plain.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
