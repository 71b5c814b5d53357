"""Importance resampling towards a target distribution (operator 12).

**Weights.** Features of a text are its words, hashed into ``BUCKETS`` buckets. Counts
over all documents and over all target texts give each bucket a gain, the logarithm of
the ratio of its smoothed shares; a document's weight is the floored mean of the gains
of its features. Bytes, words and checksums of a slice of texts are numpy arrays: the
checksums advance one byte of every word at a time. What is gathered is one number per
bucket, whatever the size of the tables.

**Draw.** A document's score is its weight plus Gumbel noise from a digest of its id;
the highest scores are a sample without replacement in proportion to the weights. They
are found by sorting all documents with enough words.

**Sort.** A radix sort from the least to the most significant digit over the composite
key (score downwards, id upwards). Rows hold a position; 2**BLOCK positions in a row
are a block. A pass counts (block, digit), adds the counts up in order of (digit,
block), in two levels, to the first position of every (block, digit), and sends each
row there, behind the rows of its digit that stand before it in its block. A block is
a bounded group whatever the keys: no task sees more than a block, equal keys spread
like others, and the rows are compared with none. The last positions are the ranks.
Digits have at most ``BITS`` bits, as many as the ranges of scores and ids need.

Defined cases: a null or empty text has no features and weight 0; ids are integers,
a null one hashes as empty text and comes last in a tie; rows that agree in id and
score take ranks of their own, in the order of the table's files; texts of any length
are counted whole; extra columns are ignored; an empty table gives no rows, an empty
target draws by its smoothed shares.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.llm.common import materialize
from pricewise.llm.ragged import slices, text_bytes
from pricewise.session import drop_stage

BUCKETS = 10_000
SEED = 2024
LEAST = 20
PERCENT = 10
BLOCK = 15
BITS = 11
LONG = 64  # words of more bytes have their checksums one by one

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1).astype(np.uint32)
    return crc


_CRC = _crc_table()


def word_buckets(data: np.ndarray, off: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word, and for each text the range of its words (offsets)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    data = _LOWER[data]
    word = np.zeros(n + 2, bool)
    word[1:-1] = _WORD[data]
    begins, ends = word[1:-1] & ~word[:-2], word[1:-1] & ~word[2:]
    inner = off[(off > 0) & (off < n)]
    begins[inner] = word[1:-1][inner]
    ends[inner - 1] = word[1:-1][inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    size = end - start
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(-size, kind="stable")
    high = int(np.searchsorted(-size[order], -LONG, side="left"))  # those longer than LONG
    for k in order[:high].tolist():
        out[k] = zlib.crc32(data[start[k]:end[k]])
    order = order[high:]
    at, falling = start[order], -size[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(int(-falling[0]) if len(order) else 0):
        m = int(np.searchsorted(falling, -k, side="left"))  # words with a byte k
        crc[:m] = _CRC[(crc[:m] ^ data[at[:m] + k]) & 0xFF] ^ (crc[:m] >> 8)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out.astype(np.int64) % buckets, np.searchsorted(start, off)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, off = text_bytes(batch.column(0))
            for i, j in slices(off):
                total += np.bincount(word_buckets(data[off[i]:off[j]], off[i:j + 1] - off[i], buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = texts.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in rows.toPandas().itertuples(index=False):  # as many as buckets at most
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold logarithm of each bucket's smoothed shares, target to source."""
    s_all, t_all, m = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + m) / ((s + 1) * (t_all + m))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def noise(label: str, seed: int = SEED) -> int:
    """Gumbel noise of an id, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{label}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """Per row: id, n_features, weight, score."""
    held = docs.sparkSession.sparkContext.broadcast(gain)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        gain = held.value
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            sizes, weights = [], []
            for i, j in slices(off):
                bucket, at = word_buckets(data[off[i]:off[j]], off[i:j + 1] - off[i], len(gain))
                n = np.diff(at)
                total = np.r_[0, np.cumsum(gain[bucket])]
                sizes.append(n)
                weights.append((total[at[1:]] - total[at[:-1]]) // np.maximum(n, 1))
            n, weight = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sizes, weights))
            luck = np.array([noise("" if k is None else str(k), seed) for k in batch.column("id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(weight), pa.array(weight + luck)],
                                             names=["id", "n_features", "weight", "score"])

    return plain.mapInArrow(run, "id long, n_features long, weight long, score long")


def _digits(above: int, bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the digits that hold numbers from 0 to ``above``."""
    need = above.bit_length()
    passes = -(-need // bits)
    width = -(-need // max(passes, 1))
    return [(k * width, min(width, need - k * width)) for k in range(passes)]


class Digit(NamedTuple):
    """One digit of a column's distance from the end that comes first."""

    column: str
    falls: bool
    low: int
    high: int
    null: int  # the number that stands for a null
    shift: int
    width: int

    def of(self, table) -> np.ndarray:
        col = table.column(self.column)
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        value = col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.uint64)  # differences wrap as they should
        value = np.uint64(self.high % 2**64) - value if self.falls else value - np.uint64(self.low % 2**64)
        value[col.is_null().to_numpy(zero_copy_only=False)] = self.null
        return ((value >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)).astype(np.uint16)

    def counter(self, block: int):
        def count(batches):
            for batch in batches:
                cell, n = np.unique((batch.column("at").to_numpy() >> block << self.width) | self.of(batch), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell >> self.width), pa.array(cell & ((1 << self.width) - 1)), pa.array(n)],
                                                 names=["block", "digit", "n"])
        return count

    def dealer(self, names: list[str]):
        def deal(mine, first):
            mine = mine.take(pa.array(np.argsort(mine.column("at").to_numpy(), kind="stable")))
            d = self.of(mine)
            order = np.argsort(d, kind="stable")  # of 16-bit numbers: by counting
            n = np.bincount(d, minlength=1 << self.width)
            to = np.zeros(1 << self.width, np.int64)
            to[first.column("digit").to_numpy()] = first.column("first").to_numpy()
            at = np.empty(len(d), np.int64)
            at[order] = np.arange(len(d)) + np.repeat(to - np.cumsum(n) + n, n)
            return mine.set_column(mine.column_names.index("at"), "at", pa.array(at)).select(names)
        return deal


def radix_order(rows: DataFrame, key: list[tuple[str, bool]], block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """``rows``, a stage with a column ``at`` of different numbers of 0 or more, with
    ``at`` from 0 on in order of the key: long columns, the most significant first, and
    whether they fall. Nulls come last. Rows that agree keep their order in ``at``. The
    stage is removed."""
    ends = rows.agg(*[f(c).alias(f"{f.__name__}_{c}") for c, _ in key for f in (F.min, F.max)],
                    *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c, _ in key]).first()
    if ends[f"max_{key[0][0]}"] is None:
        return rows
    passes = []
    for column, falls in reversed(key):
        low, high = ends[f"min_{column}"] or 0, ends[f"max_{column}"] or 0
        # one number above all others stands for nulls
        above = high - low + (1 if ends[f"null_{column}"] else 0)
        passes += [Digit(column, falls, low, high, above, *d) for d in _digits(above, bits)]
    schema = rows.schema
    for d in passes or [Digit(key[0][0], False, 0, 0, 0, 0, 1)]:
        count, deal = d.counter(block), d.dealer(schema.names)
        cells = rows.mapInArrow(count, "block long, digit long, n long").groupBy("block", "digit").agg(F.sum("n").alias("n"))
        cells = materialize(cells, "radix-cells")
        before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        base = cells.groupBy("digit").agg(F.sum("n").alias("n")).select(  # 2**BITS rows at most
            F.col("digit").alias("d"), before(Window.orderBy("digit")).alias("base"))
        first = cells.withColumn("inside", before(Window.partitionBy("digit").orderBy("block"))) \
            .join(F.broadcast(base), F.col("digit") == F.col("d")).selectExpr("block", "digit", "base + inside AS first")
        dealt = rows.withColumn("block", F.expr(f"shiftright(at, {block})")).groupBy("block") \
            .cogroup(first.groupBy("block")).applyInArrow(deal, schema)
        done = materialize(dealt, "radix")
        drop_stage(cells)
        drop_stage(rows)
        rows = done
    return rows


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             buckets: int = BUCKETS, least: int = LEAST, percent: int = PERCENT, seed: int = SEED,
             block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """Per row: the id, n_features, weight, score, rank (null: not drawn)."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    rows = materialize(scored(docs, gain, id_col, text_col, seed), "scored")
    enough = F.col("n_features") >= least
    able = materialize(rows.where(enough).withColumn("at", F.monotonically_increasing_id()), "able")
    drawn = able.count() * percent // 100
    order = radix_order(able, [("score", True), ("id", False)], block, bits)
    out = order.withColumn("rank", F.when(F.col("at") < drawn, F.col("at") + 1)).drop("at") \
        .unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast(T.LongType())))
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


#: Checksums of the distinct words, byte by byte.
ORACLE_SQL = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) t(i))),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
dw AS (SELECT r, unnest(words) AS w FROM d),
tw AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM benchmark),
every AS (SELECT w FROM dw UNION SELECT w FROM tw),
bytes AS (
  SELECT w, list_transform(range(strlen(w)), lambda k: CAST('0x' || substr(hex(encode(w)), CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT)) AS bs
  FROM every),
b AS (
  SELECT w, CAST(xor(list_reduce(list_prepend(4294967295, bs),
    lambda c, x: xor(tab[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS INTEGER) AS bucket
  FROM bytes CROSS JOIN crc),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN b USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM tw JOIN b USING (w) GROUP BY bucket),
a AS (SELECT (SELECT count(*) FROM dw) AS s_all, (SELECT count(*) FROM tw) AS t_all),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket) CROSS JOIN a),
f AS (
  SELECT r, count(*)::BIGINT AS n, (sum(gain) - (((sum(gain) % count(*)) + count(*)) % count(*))) // count(*) AS weight
  FROM dw JOIN b USING (w) JOIN g USING (bucket) GROUP BY r),
k AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
      AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN f USING (r)),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM k)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= (SELECT count(*) * 10 // 100 FROM k WHERE n_features >= 20) THEN place END AS rank
FROM o
"""
