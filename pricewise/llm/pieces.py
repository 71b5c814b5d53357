"""SentencePiece encoding with seeded merge-dropout, and decoding (operator 7).

A text is cut before each run of blanks, which no piece crosses. Each distinct unit
of a slice of texts goes through the merge agenda of :mod:`pricewise.llm.bpe`: at
each step a unit takes its best-scored candidate (the leftmost of equals). A
candidate, the join of two neighbouring spans, is skipped with probability
``dropout`` by a hash of the seed, the document's text, the unit's position in it and
the three bounds, so each occurrence of a word is drawn anew and a rerun gives the same
ids. An occurrence of which no candidate of the plain agenda is skipped has the plain
segmentation, which is kept; all others are merged one by one.
With dropout 0 the ids are those of the library.

Characters outside the vocabulary become byte pieces. So does U+2581, which the
library would decode as a blank: any text decodes to itself.

The model is read once, on the driver, from a path, and sent to the tasks.

Defined cases: a null text has null ids and decodes to null; an empty one has none;
texts of any length are encoded whole (units of over 96 characters through a heap);
equal texts have equal ids; extra columns stay; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.llm.bpe import LONG, Merges, below, merge
from pricewise.llm.common import fresh
from pricewise.llm.ragged import U64, mix, slices, text_bytes

DROPOUT = 0.1
SEED = 7
KEPT = 150_000
SLICE = 1_000_000
TOGETHER = 1 << 14
_UNIT = re.compile(" +[^ \n]*|[^ \n]+|\n")
_MARK = "▁"


class Pieces:
    """Pieces of a BPE model with byte fallback: merges, ids of characters, bytes of ids."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        plain = {sp.id_to_piece(i): i for i in range(n)
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        score = {i: sp.get_score(i) for i in plain.values()}
        place = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        rows = [(plain[p[:k]], plain[p[k:]], place[score[i]], i) for p, i in plain.items()
                for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain]
        self.merges = Merges(*zip(*rows))
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        # characters: their piece, a byte piece, or (negative) the character itself
        self.char = -1 - np.arange(0x110000, dtype=np.int32)
        self.char[:128] = self.byte[:128]
        for p, i in plain.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.char[ord(" ")] = plain[_MARK]
        self.char[ord(_MARK)] = -1 - ord(_MARK)
        raw = [b""] * n
        for p, i in plain.items():
            raw[i] = p.replace(_MARK, " ").encode()
        for b in range(256):
            raw[self.byte[b]] = bytes([b])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_off = np.r_[0, np.cumsum([len(r) for r in raw])]

    def encode_units(self, units: list[str], keys: np.ndarray | None, drop: float, agenda: list | None = None
                     ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, flat, and offsets."""
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        off = np.r_[0, np.cumsum(list(map(len, units)), dtype=np.int64)]
        flat, off = merge(self.char[chars], off, self.merges, keys, drop, agenda)
        odd = np.flatnonzero(flat < 0)
        if len(odd):  # these become the bytes of the character
            as_bytes = [self.byte[list(chr(-1 - c).encode())] for c in flat[odd].tolist()]
            size = np.ones(len(flat), np.int64)
            size[odd] = [len(b) for b in as_bytes]
            at = np.r_[0, np.cumsum(size)]
            out = np.repeat(flat, size)
            for k, b in zip(odd.tolist(), as_bytes):
                out[at[k]:at[k + 1]] = b
            flat, off = out, at[off]
        return flat, off

    def decode(self, flat: np.ndarray) -> np.ndarray:
        """The bytes of a run of ids, its first blank included."""
        return gather(self.raw, self.raw_off, flat)[0]


def gather(flat: np.ndarray, off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given rows of a ragged array, one after another, and their offsets."""
    size = off[rows + 1] - off[rows]
    at = np.r_[0, np.cumsum(size)]
    return flat[np.repeat(off[rows] - at[:-1], size) + np.arange(at[-1])], at


def scatter(out: np.ndarray, at: np.ndarray, rows: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
    """Put rows of sizes ``size``, one after another in ``flat``, where rows ``rows`` of the
    ragged array with offsets ``at`` lie."""
    begin = np.cumsum(size) - size
    out[np.repeat(at[rows] - begin, size) + np.arange(len(flat))] = flat


class Growing:
    """A ragged array that rows are added to; room is doubled, so adding costs what is
    added."""

    def __init__(self, dtype):
        self._flat, self._off, self.n = np.empty(1 << 12, dtype), np.zeros(1 << 10, np.int64), 0

    def add(self, flat: np.ndarray, off: np.ndarray) -> None:
        have, n = int(self._off[self.n]), len(off) - 1
        if have + len(flat) > len(self._flat):
            self._flat = np.r_[self._flat[:have], np.empty(have + 2 * len(flat), self._flat.dtype)]
        if self.n + n + 1 > len(self._off):
            self._off = np.r_[self._off[:self.n + 1], np.empty(self.n + 2 * n, np.int64)]
        self._flat[have:have + len(flat)] = flat
        self._off[self.n + 1:self.n + n + 1] = off[1:] + have
        self.n += n

    @property
    def flat(self) -> np.ndarray:
        return self._flat[:self._off[self.n]]

    @property
    def off(self) -> np.ndarray:
        return self._off[:self.n + 1]


class Encoder:
    """Ids of texts, with the plain segmentations and agendas of units seen."""

    def __init__(self, pieces: Pieces, drop: float, seed: int):
        self.pieces, self.drop, self.seed = pieces, drop, seed
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.units: list[str] = []
        self.plain, self.met, self.long = Growing(np.int32), Growing(U64), Growing(bool)

    def _learn(self, new: list[str]) -> None:
        agenda: list | None = [] if self.drop else None
        # a long unit nearly always has a candidate skipped: with dropout it is only merged by occurrence
        self.plain.add(*self.pieces.encode_units(["" if self.drop and len(u) > LONG else u for u in new], None, 0.0, agenda))
        if self.drop:
            rows = np.concatenate([r for r, _ in agenda] or [np.zeros(0, np.int64)])
            order = np.argsort(rows, kind="stable")
            self.met.add(np.concatenate([p for _, p in agenda] or [np.zeros(0, U64)])[order],
                         np.r_[0, np.cumsum(np.bincount(rows, minlength=len(new)))])
            self.long.add(np.array([len(u) > LONG for u in new]), np.arange(len(new) + 1))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and offsets."""
        if self.plain.n > KEPT:
            self._forget()
        codes, counts, keys, known = [], [], [], self.place
        size = len(self.units)
        for t in texts:
            units = _UNIT.findall(f" {t}") if t else []
            for u in set(units).difference(known):
                known[u] = len(self.units)
                self.units.append(u)
            codes += map(known.__getitem__, units)
            counts.append(len(units))
            if self.drop:
                keys.append(mix(np.arange(len(units), dtype=U64) + U64(xxhash.xxh64_intdigest(t.encode(), self.seed))))
        for a in range(size, len(self.units), TOGETHER):
            self._learn(self.units[a:a + TOGETHER])
        rows, sizes, parts = np.array(codes, np.int64), np.zeros(len(codes), np.int64), []
        old = np.arange(len(rows))
        if self.drop and len(rows):
            key = np.concatenate(keys)
            fresh_ = self.long.flat[rows]
            for a in range(0, len(rows), TOGETHER):  # a unit meets several candidates
                met, at = gather(self.met.flat, self.met.off, rows[a:a + TOGETHER])
                total = np.r_[0, np.cumsum(below(met + np.repeat(key[a:a + TOGETHER], np.diff(at)), self.drop))]
                fresh_[a:a + TOGETHER] |= total[at[1:]] > total[at[:-1]]
            anew, old = np.flatnonzero(fresh_), np.flatnonzero(~fresh_)
            for a in range(0, len(anew), TOGETHER):  # the matrices of a merge are many times the units
                now = anew[a:a + TOGETHER]
                more, more_off = self.pieces.encode_units([self.units[k] for k in rows[now].tolist()], key[now], self.drop)
                parts.append((now, more, np.diff(more_off)))
        kept, at = gather(self.plain.flat, self.plain.off, rows[old])
        parts.append((old, kept, np.diff(at)))
        for now, _, n in parts:
            sizes[now] = n
        at = np.r_[0, np.cumsum(sizes)]
        out = np.empty(at[-1], np.int32)
        for now, flat, n in parts:
            scatter(out, at, now, flat, n)
        return out, at[np.r_[0, np.cumsum(counts, dtype=np.int64)]]


def encode(docs: DataFrame, pieces: Pieces, text_col: str = "text", out: str = "ids", dropout: float = DROPOUT,
           seed: int = SEED) -> DataFrame:
    """The frame with one more column, the ids of the text."""
    held = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches):
        pa.default_memory_pool().release_unused()  # what earlier tasks of this worker held
        encoder = Encoder(held.value, dropout, seed)
        for batch in batches:
            text = batch.column(text_col)
            _, off = text_bytes(text)
            for i, j in slices(off, SLICE):
                part = text.slice(i, j - i)
                flat, at = encoder.encode(part.fill_null("").to_pylist())
                at = pa.array(at, pa.int32(), mask=np.r_[part.is_null().to_numpy(zero_copy_only=False), False])
                ids = pa.ListArray.from_arrays(at, pa.array(flat))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), ids], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, pieces: Pieces, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with one more column, the text that the ids stand for."""
    held = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        for batch in batches:
            texts = []
            for k in range(batch.num_rows):
                one = batch.column(ids_col)[k]
                if not one.is_valid:
                    texts.append(None)
                    continue
                texts.append(held.value.decode(one.values.to_numpy())[1:].tobytes().decode("utf-8"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def tokenize(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Per row: the id, n_tokens, ids, and whether they decode to the text."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    both = decode(encode(plain, pieces, **how), pieces)
    return both.select(F.col("id").alias(id_col), F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids",
                       F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def add_ids(docs: DataFrame, pieces: Pieces, text_col: str = "text", **how) -> DataFrame:
    """The frame with token ids in a new column ``ids``."""
    name, = fresh(docs, "ids")
    return encode(docs, pieces, text_col, name, **how)
