"""Reproducible shuffle into shards (operator 2), in DataFrame functions only.

Rows get global numbers 0 to N-1; a keyed permutation of these numbers says where a
row goes: ``shard = position % shards``, ``slot = position div shards``. So shards
differ by one row at most, slots have no gaps, and both follow from the row number
alone.

**Numbers.** Rows fall into ``ceil(sqrt(N))`` buckets by a hash of their id; a row's
number is its rank within the bucket, in order of id, text checksum and size, plus
the rows of the buckets before. Only the bucket counts, sqrt(N) rows, are summed in
one place. The numbers don't depend on files or partitions.

**Permutation.** Four Feistel rounds over pairs (left of a, right of b) with
``a = ceil(sqrt(N))`` and ``b = ceil(N / a)``: a round adds a keyed hash of one half
to the other. It permutes a * b >= N numbers; one that lands at N or above is
permuted again until it is below (cycle walking). At most a * b - N < a numbers lie
outside, so that many steps always suffice.

Defined cases: a null text has size 16 and checksum 0; rows that agree in id,
checksum and size are interchangeable; a null id hashes like any other value; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.llm.common import materialize

SHARDS = 40
SEED = 20
ROUNDS = 4
HEADER = 16


def permute_sql(value: str, n: int, seed: int) -> str:
    """SQL for the position of the row number ``value`` among ``n``."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def once(x: str) -> str:
        pair = f"named_struct('l', ({x}) % {a}L, 'r', ({x}) div {a}L)"
        for k in range(ROUNDS):
            key = f"CAST({seed * ROUNDS + k} AS BIGINT)"
            if k % 2 == 0:
                body = f"named_struct('l', pmod(h.l + pmod(xxhash64({key}, h.r), {a}L), {a}L), 'r', h.r)"
            else:
                body = f"named_struct('l', h.l, 'r', pmod(h.r + pmod(xxhash64({key}, h.l), {b}L), {b}L))"
            pair = f"transform(array({pair}), h -> {body})[0]"
        return f"transform(array({pair}), h -> h.l + h.r * {a}L)[0]"

    first = once(value)
    if a * b == n:
        return first
    walk = f"aggregate(sequence(1, {a * b - n}), p, (x, k) -> IF(x < {n}L, x, {once('x')}))"
    return f"transform(array({first}), p -> IF(p < {n}L, p, {walk}))[0]"


def number_rows(rows: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """``rows`` (id, size, crc) with ``number``."""
    buckets = max(1, math.isqrt(max(n - 1, 0)) + 1)
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(buckets)))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("bucket").agg(F.count("*").alias("k")) \
        .withColumn("start", F.coalesce(F.sum("k").over(before), F.lit(0))).select("bucket", "start")
    within = Window.partitionBy("bucket").orderBy("id", "crc", "size")
    return placed.withColumn("rank", F.row_number().over(within)).join(starts, "bucket") \
        .withColumn("number", F.col("start") + F.col("rank") - 1).drop("bucket", "rank", "start")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per row: the id, size (bytes), text_crc32, law, shard, slot, grown_shard, and the
    row number."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + HEADER).cast("long").alias("size"),
                                   F.crc32(text).alias("crc")), "shard-rows")
    n = rows.count()
    return number_rows(rows, n, seed).withColumn("position", F.expr(permute_sql("number", n, seed))) \
        .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
                (F.col("position") % shards).cast("int").alias("shard"), F.expr(f"position div {shards}").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"), "number")


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """The rows in folders ``shard=k``, in order of their slots. Ids are unique here."""
    docs.join(placed.select(id_col, "shard", "slot"), id_col).repartition("shard") \
        .sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
