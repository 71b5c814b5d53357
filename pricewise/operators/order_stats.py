"""Order statistics and running totals over a whole table, without one task that holds it.

* :func:`quantiles`: exact selection. The wanted ranks lie in intervals of values; a pass
  counts the rows of each interval in equal steps and keeps the steps with a wanted
  rank, until a step holds one value. A pass is one grouped aggregate of a few numbers.
* :func:`in_order`: running totals along a global order. Rows are dealt to ranges of the
  order; each range adds up its own, from the total of the ranges before it on. Only the
  ranges' totals, one row each, are summed in one place.
* :func:`running_median`: the median of the values of all rows up to each row. Rows are
  cut into about sqrt(n) chunks along the order and, by rank of value, into as many
  buckets of equal size. Within a chunk of m rows the median moves by at most m / 2
  places among the values before it, so of those a chunk needs only the 2 m nearest
  the middle. Counts by (chunk, bucket) say which buckets hold them: a chunk's task gets
  a few times m rows, whatever the table.
"""

from __future__ import annotations

import math
from bisect import insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.frames import UNBOUNDED
from pricewise.session import drop_stage, materialize

STEPS = 512


def quantiles(df: DataFrame, value: str | Column, probs: Sequence[float], steps: int = STEPS) -> list[float | None]:
    """The exact quantiles of a column, linear between neighbours as pandas and
    ``percentile`` have them; NULL and NaN count as missing (P6)."""
    v = F.col("v")
    rows = materialize(df.select((F.col(value) if isinstance(value, str) else value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)"),
                       "values")
    n, low, high = rows.agg(F.count("v"), F.min("v"), F.max("v")).first()
    spots = [(n - 1) * p for p in probs]
    found: dict[int, float] = {}
    # (lowest, highest, rows before, wanted ranks)
    open_ = [(low, high, 0, sorted({r for h in spots for r in (math.floor(h), math.ceil(h))}))] if n else []
    while open_:
        for lo, hi, _, ranks in open_:
            if lo == hi:
                found.update(dict.fromkeys(ranks, lo))
        open_ = [o for o in open_ if o[0] != o[1]]
        if not open_:
            break
        step = None
        for k, (lo, hi, _, _) in enumerate(open_):
            half = 1 if math.isfinite(hi - lo) else 2  # the distance of two finite values need not be finite
            at = F.least(F.lit(steps - 1), F.floor((v / half - lo / half) / (hi / half - lo / half) * steps)) + k * steps
            step = F.when(v.between(lo, hi), at) if step is None else step.when(v.between(lo, hi), at)
        counts = rows.groupBy(step.alias("step")).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")) \
            .where("step IS NOT NULL").orderBy("step").collect()  # ``steps`` rows for each interval at most
        closer = []
        for k, (_, _, before, ranks) in enumerate(open_):
            for r in (c for c in counts if c["step"] // steps == k):
                mine = [x for x in ranks if before <= x < before + r["n"]]
                if mine:
                    closer.append((r["lo"], r["hi"], before, mine))
                before += r["n"]
        open_ = closer
    drop_stage(rows)
    return [found[math.floor(h)] + (found[math.ceil(h)] - found[math.floor(h)]) * (h - math.floor(h)) if n else None for h in spots]


#: A total order of rows: columns, and whether each falls.
Order = Sequence[tuple[str, bool]]


def _sorted(order: Order) -> list[Column]:
    return [F.desc(c) if falls else F.asc(c) for c, falls in order]


def in_order(df: DataFrame, order: Order, sums: dict[str, Column], parts: int | None = None) -> DataFrame:
    """``df`` with running totals of ``sums`` along a total order of its rows, each row
    included, and ``<name>_all``, the totals of the table. ``parts``: ranges the order
    is cut into (by default as many as shuffle partitions)."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(df.repartitionByRange(parts, *_sorted(order)).withColumn("_range", F.spark_partition_id()), "ranges")
    own = dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_o{n}") for n, c in sums.items()])
    before, every = Window.orderBy("_range").rowsBetween(UNBOUNDED, -1), Window.partitionBy()
    # one row a range
    start = own.select("_range", *[F.coalesce(F.sum(f"_o{n}").over(before), F.lit(0)).alias(f"_b{n}") for n in sums],
                       *[F.sum(f"_o{n}").over(every).alias(f"{n}_all") for n in sums])
    w = Window.partitionBy("_range").orderBy(*_sorted(order)).rowsBetween(UNBOUNDED, 0)
    return dealt.withColumns({n: F.sum(c).over(w) for n, c in sums.items()}).join(F.broadcast(start), "_range") \
        .withColumns({n: F.col(n) + F.col(f"_b{n}") for n in sums}).drop("_range", *[f"_b{n}" for n in sums])


def _medians(rows: pd.DataFrame) -> pd.DataFrame:
    """Running medians of one chunk: its own rows in order, and of the values before it
    those nearest the middle."""
    mine = rows[rows["before"].isna()].sort_values("pos")
    held = rows[rows["before"].notna()]
    kept = sorted(zip(held["rank"], held["value"]))
    below, n = (int(held["below"].iloc[0]), int(held["before"].iloc[0])) if len(held) else (0, 0)
    out = []
    for rank, value in zip(mine["rank"], mine["value"]):
        if not math.isnan(value):
            insort(kept, (rank, value))
            n += 1
        if n:
            lower, upper = (n - 1) // 2 - below, n // 2 - below
            out.append((kept[lower][1] + kept[upper][1]) / 2)
        else:
            out.append(None)
    return pd.DataFrame({"pos": mine["pos"], "median": pd.Series(out, index=mine.index, dtype="float64")})


def running_median(df: DataFrame, order: Order, value: str, out: str, size: int | None = None) -> DataFrame:
    """``df`` with the median of ``value`` over all rows up to and including the row
    along a total order (missing values don't count; NULL before the first). ``size``:
    rows a chunk, by default the root of the number of rows."""
    df = materialize(df.withColumn("_id", F.monotonically_increasing_id()), "rows")
    known = F.col(value).isNotNull() & ~F.isnan(value)
    plain = df.select("_id", *[F.col(c).alias(f"_k{k}") for k, (c, _) in enumerate(order)], F.when(known, F.col(value).cast("double")).alias("_v"))
    rows = in_order(plain, [*((f"_k{k}", falls) for k, (_, falls) in enumerate(order))], {"pos": F.lit(1)}) \
        .select("_id", "_v", (F.col("pos") - 1).alias("pos"))
    rows = materialize(rows, "placed")
    ranks = in_order(rows.where("_v IS NOT NULL"), [("_v", False), ("pos", False)], {"rank": F.lit(1)}).selectExpr("_id", "rank - 1 AS rank")
    rows = materialize(rows.join(ranks, "_id", "left"), "ranked")
    n = rows.count()
    m = size or max(1, math.isqrt(max(n - 1, 0)) + 1)
    chunks = max(1, -(-n // m))
    rows = rows.select("_id", "pos", F.col("_v").alias("value"), "rank", F.expr(f"pos div {m}").alias("chunk"), F.expr(f"rank div {m}").alias("bucket"))
    members = rows.where("rank IS NOT NULL")
    # values before each chunk, by bucket: chunks x buckets cells, about as many as rows
    grid = members.select("bucket").distinct().select("bucket", F.explode(F.expr(f"sequence(0L, {chunks - 1}L)")).alias("chunk"), F.lit(0).alias("n"))
    cells = members.select("bucket", "chunk", F.lit(1).alias("n")).unionByName(grid).groupBy("bucket", "chunk").agg(F.sum("n").alias("n"))
    cells = cells.withColumn("n", F.coalesce(F.sum("n").over(Window.partitionBy("bucket").orderBy("chunk").rowsBetween(UNBOUNDED, -1)), F.lit(0)))
    along, whole = Window.partitionBy("chunk").orderBy("bucket"), Window.partitionBy("chunk")
    cells = cells.withColumn("upto", F.sum("n").over(along.rowsBetween(UNBOUNDED, 0))).withColumn("before", F.sum("n").over(whole))
    near = cells.where(f"n > 0 AND upto > before div 2 - {m} AND upto - n < before div 2 + {m} + 1")
    near = near.withColumn("below", F.min(F.col("upto") - F.col("n")).over(whole)).select(F.col("chunk").alias("to"), "bucket", "before", "below")
    earlier = members.join(near, "bucket").where("chunk < to").select(F.col("to").alias("chunk"), "pos", "rank", "value", "before", "below")
    own = rows.select("chunk", "pos", F.col("rank").cast("long").alias("rank"), "value", F.lit(None).cast("long").alias("before"), F.lit(None).cast("long").alias("below"))
    medians = own.unionByName(earlier).groupBy("chunk").applyInPandas(_medians, "pos long, median double")
    return df.join(rows.select("_id", "pos").join(medians, "pos").select("_id", F.col("median").alias(out)), "_id").drop("_id")
