"""Mixing sources to target weights (operator 10).

Every document gets a hash-random key; within a source the mix takes documents in
key order until the source's budget is spent, in whole rounds over the source if
the budget exceeds it. Keys are uniform, so equal ranges of the key sort a source
into buckets of about sqrt(rows) documents each: sums per bucket and a running sum
over a source's buckets are the distributed prefix sums, and only the one bucket
in which a budget ends is sorted by key. A source with a third of all rows is as
many buckets as its size asks for, and no task holds a source whole.

Targets: all sources share the size of all documents by weight, at most ``cap``
times their own size; what is above goes to the others by weight. Ordered by
cap * size / weight, sources are capped one after another until the level per unit
of weight fits the rest.

Defined cases: a null text has size 0 and is never taken; null is a source of its
own, last in order; equal keys (repeated rows) are cut as one, each giving its
share, rounded down; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewise.llm.common import fresh, materialize, n_words

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"


def mix_key(id_col: str, text_col: str, seed: str = SEED) -> Column:
    """Hash-random key of a document: 32 hex digits, which sort as the numbers do."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), part(id_col), F.lit(":"), part(text_col)))


def targets(rows: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, n, source_size, target) of rows (source, size). One row per source."""
    sums = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))
    fill = Window.orderBy(F.expr(f"{cap} * source_size / weight"), "rank")
    before, every = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    none = F.lit(0)
    level = (F.sum("source_size").over(every) - cap * F.coalesce(F.sum("source_size").over(before), none)) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), none))
    return sums.withColumn("rank", F.row_number().over(order)) \
        .withColumn("weight", turn[(F.col("rank") - 1) % len(weights)]) \
        .withColumn("level", level).withColumn("place", F.row_number().over(fill)) \
        .withColumn("free", F.min(F.when(F.expr(f"{cap} * source_size > level * weight"), F.struct("place", "level"))).over(every)) \
        .selectExpr("source", "n", "source_size", f"""CASE WHEN free IS NULL OR place < free.place
            THEN CAST({cap} * source_size AS DOUBLE) ELSE weight * free.level END AS target""")


def cuts(rows: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """How to take each source, from rows (source, size, key): (source, source_size,
    target, rounds, cut_key, cut_rest, cut_size). Documents with a key below
    ``cut_key`` are taken once more than ``rounds`` times; those at it share
    ``cut_rest`` of their ``cut_size`` words."""
    goal = materialize(
        targets(rows, weights, cap)
        .withColumn("rounds", F.expr("IF(source_size = 0, 0L, CAST(floor(target / source_size) AS LONG))"))
        .withColumn("budget", F.expr("CAST(floor(target) AS LONG) - rounds * source_size"))
        .withColumn("buckets", F.expr("CAST(ceil(sqrt(n)) AS LONG)")), "goals")
    share = F.conv(F.substring("key", 1, 12), 16, 10).cast("double") / float(16 ** 12)
    placed = rows.where("size > 0").join(goal.select(F.col("source").alias("s"), "buckets"),
                                         F.col("source").eqNullSafe(F.col("s"))) \
        .select("source", "size", "key", F.floor(share * F.col("buckets")).alias("bucket"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words")) \
        .withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    ends = sums.join(goal.select(F.col("source").alias("s"), "budget"), F.col("source").eqNullSafe(F.col("s"))) \
        .where("before <= budget AND budget < before + words").select("s", F.col("bucket").alias("b"), "before", "budget")
    inside = placed.join(ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))) \
        .groupBy("s", "key", "before", "budget").agg(F.sum("size").alias("words"))
    sorted_ = Window.partitionBy("s").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    last = inside.withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(sorted_), F.lit(0))) \
        .where("before <= budget AND budget < before + words") \
        .selectExpr("s", "key AS cut_key", "budget - before AS cut_rest", "words AS cut_size")
    return goal.join(last, F.col("source").eqNullSafe(F.col("s")), "left") \
        .select("source", "source_size", "target", "rounds", "cut_key", "cut_rest", "cut_size")


#: Words taken of a document with ``size`` words and ``key``.
TAKEN = """rounds * {size} + CASE WHEN {key} < cut_key THEN {size}
    WHEN {key} = cut_key THEN CAST(floor(cut_rest * {size} / cut_size) AS LONG) ELSE 0L END"""


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       n_words(F.col(text_col)).alias("size"), mix_key(id_col, text_col, seed).alias("key"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """Per row: the id, size, source_size, target and taken (words)."""
    rows = materialize(_sized(docs, id_col, text_col, source_col, seed), "mix-rows")
    plan = cuts(rows, weights, cap).withColumnRenamed("source", "s")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.expr(TAKEN.format(size="size", key="key")).alias("taken"))


def draw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all columns. Texts
    stay whole: the one at a source's cut is in if at least half of it is."""
    rows = materialize(_sized(docs, id_col, text_col, source_col, seed), "mix-rows")
    plan = cuts(rows, weights, cap)
    size, key, s, times, *extra = fresh(docs, "size", "key", "s", "times", *[c for c in plan.columns if c != "source"])
    plan = plan.withColumnsRenamed(dict(zip([c for c in plan.columns if c != "source"], extra)) | {"source": s})
    taken = TAKEN
    for old, new in zip([c for c in ("source_size", "target", "rounds", "cut_key", "cut_rest", "cut_size")], extra):
        taken = taken.replace(old, new)
    sized = docs.withColumn(size, n_words(F.col(text_col))).withColumn(key, mix_key(id_col, text_col, seed)).where(F.col(size) > 0)
    return sized.join(plan, F.col(source_col).eqNullSafe(F.col(s))) \
        .withColumn(times, F.expr(f"CAST(floor(({taken.format(size=size, key=key)}) / {size} + 0.5) AS INT)")) \
        .where(F.col(times) > 0) \
        .withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key,
    CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM s),
x AS (SELECT *, CASE (k - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM w),
l AS (SELECT *, row_number() OVER p AS place, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER q, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER q, 0))::DOUBLE AS level
  FROM x WINDOW p AS (ORDER BY 3 * source_size / weight, k),
    q AS (ORDER BY 3 * source_size / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min(place) AS place, arg_min(level, place) AS level FROM l WHERE 3 * source_size > level * weight),
g AS (SELECT source, source_size, CASE WHEN f.place IS NULL OR l.place < f.place
    THEN CAST(3 * source_size AS DOUBLE) ELSE weight * f.level END AS target FROM l CROSS JOIN f),
r AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS rounds FROM g),
b AS (SELECT *, CAST(floor(target) AS BIGINT) - rounds * source_size AS budget FROM r),
u AS (SELECT d.doc_id, d.size, d.key, b.source_size, b.target, b.rounds, b.budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  CAST(rounds * size + greatest(0, least(size, budget - before)) AS BIGINT) AS taken
FROM u
"""
