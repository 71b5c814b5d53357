"""Totals over value ranges and counts of better rows, for groups of any size.

**Ranges.** The total over the rows of a group whose value lies in [lo, hi] is the
running total up to hi less that before lo. Rows and range ends are stacked in order
of value and summed up in one pass (:func:`range_totals`).

**Better rows in a range** is a count in two dimensions: value in [lo, hi], rank
smaller than the row's own. With the rows of a group numbered in order of rank, the
numbers below q are a sum of blocks, one for each bit set in q: bit b gives the block
of 2**b numbers that ends where the lower bits of q begin. So each row is stacked once
for every block that it can be counted in (a bit of its number that is 0) and each
range once for every bit of q, and the blocks are groups of range totals like any
other: n log n rows, whatever the values.

**Large groups.** A group of more than ``limit`` rows is cut at quantiles of its values
(:func:`cut_points`), so it is many window partitions. Each adds up its own rows; what
stands before it is the running total over the cuts' totals, a few rows for each
group. Smaller groups are one partition, and where none is large no cut is made. The
results do not depend on ``limit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.frames import UNBOUNDED
from pricewise.session import materialize

LIMIT = 200_000


def cut_points(rows: DataFrame, part: Sequence[str], axes: dict[str, Column], limit: int = LIMIT) -> DataFrame | None:
    """(part, _rows, an array for each of ``axes``) of the groups with more than ``limit``
    rows: values at which to cut the group into about equal parts of at most that many.
    None if there is no such group."""
    sizes = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)
    sizes = materialize(sizes, "large-groups")
    most = sizes.agg(F.max("_rows")).first()[0]
    if most is None:
        return None
    parts = -(-most // limit)
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    return materialize(
        rows.join(sizes, list(part)).groupBy(*part, "_rows")
        .agg(*[F.array_distinct(F.percentile_approx(axis, shares, F.lit(max(10_000, 20 * parts)))).alias(name) for name, axis in axes.items()]),
        "cut-points")


def with_cuts(rows: DataFrame, part: Sequence[str], cuts: DataFrame | None) -> DataFrame:
    """``rows`` with the cut points of their group: NULL where it is not cut."""
    return rows if cuts is None else rows.join(cuts, list(part), "left")


def chunk(value: Column, points: str) -> Column:
    """The part of a group that a value belongs to; equal values share one."""
    return F.coalesce(F.size(F.filter(F.col(points), lambda p: p < value)), F.lit(0))


def running(rows: DataFrame, keys: Sequence[str], order: Sequence, sums: dict[str, Column], points: str | None, value: Column) -> DataFrame:
    """``rows`` with running totals: of ``sums`` over the rows of their keys up to and
    including the row, in the given order, which begins with ``value``. ``points`` names
    the cut points of large groups, if there are any."""
    if points is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(UNBOUNDED, 0)
        return rows.withColumns({n: F.sum(c).over(w) for n, c in sums.items()})
    rows = rows.withColumn("_chunk", chunk(value, points))
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(UNBOUNDED, 0)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(UNBOUNDED, -1)
    carried = rows.where(F.col(points).isNotNull()).groupBy(*keys, "_chunk").agg(*[F.sum(c).alias(f"_b{n}") for n, c in sums.items()]) \
        .select(*keys, "_chunk", *[F.coalesce(F.sum(f"_b{n}").over(before), F.lit(0)).alias(f"_b{n}") for n in sums])
    return rows.withColumns({n: F.sum(c).over(w) for n, c in sums.items()}).join(carried, [*keys, "_chunk"], "left") \
        .withColumns({n: F.col(n) + F.coalesce(f"_b{n}", F.lit(0)) for n in sums}).drop("_chunk", *[f"_b{n}" for n in sums])


def range_totals(population: DataFrame, probes: DataFrame, part: Sequence[str], values: Sequence[str], points: str | None = None,
                 carry: Sequence[str] = ()) -> DataFrame:
    """For each ``_id`` of ``probes`` (_id, part, lo, hi, carry): the sums of ``values`` over
    the rows of ``population`` (part, x, values) of its group with x in [lo, hi]; all its
    rows are added up. 0 where there are none. An id whose group or range is NULL has NULL
    sums."""
    extra = [points] if points else []
    known = F.lit(True)
    for c in part:
        known = known & F.col(c).isNotNull()
    # 0: before the rows of equal value, 1: a row, 2: after them
    rows = population.where(known & F.col("x").isNotNull()).select(
        *part, *extra, F.col("x").cast("double").alias("x"), F.lit(1).alias("_kind"), *[F.coalesce(F.col(v).cast("double"), F.lit(0.0)).alias(v) for v in values])
    ends = F.array(F.struct(F.col("lo").cast("double").alias("x"), F.lit(0).alias("_kind")),
                   F.struct(F.col("hi").cast("double").alias("x"), F.lit(2).alias("_kind")))
    if points is not None:  # one row for equal values of a large group
        rows = rows.groupBy(*part, *extra, "x", "_kind").agg(*[F.sum(v).alias(v) for v in values])
    cols = dict.fromkeys(["_id", *carry, *part, *extra])
    both = probes.where(known & F.col("lo").isNotNull() & F.col("hi").isNotNull()).select(*cols, F.inline(ends))
    stacked = both.unionByName(rows, allowMissingColumns=True)
    sums = {f"_s{k}": F.coalesce(F.col(v), F.lit(0.0)) for k, v in enumerate(values)}
    ran = running(stacked, part, ["x", "_kind"], sums, points, F.col("x")).where("_kind <> 1")
    sign = F.col("_kind") - 1
    out = ran.groupBy("_id", *carry).agg(*[F.sum(sign * F.col(f"_s{k}")).alias(v) for k, v in enumerate(values)])
    lost = probes.where(~(known & F.col("lo").isNotNull() & F.col("hi").isNotNull())).select(
        "_id", *carry, *[F.lit(None).cast("double").alias(v) for v in values])
    return out.unionByName(lost)


def ranked(rows: DataFrame, part: Sequence[str], rank: str, points: str | None = None) -> DataFrame:
    """``rows`` (with ``_id``) with ``_place``, their number from 0 on in order of rank in
    their group, ``_below``, how many have a smaller rank, and ``_bits``, the bits of the
    largest number. NULL without a rank."""
    known = F.col(rank).isNotNull()
    rows = rows.withColumn("_one", known.cast("long"))
    keys = list(part)
    if points is not None:
        rows = rows.withColumn("_chunk", F.when(known, chunk(F.col(rank), points)).otherwise(0))
        keys.append("_chunk")
    w = Window.partitionBy(*keys)
    rows = rows.withColumns({"_place": F.row_number().over(w.orderBy(F.asc_nulls_last(rank), "_id")) - 1,
                             "_below": F.rank().over(w.orderBy(F.asc_nulls_last(rank))) - 1, "_n": F.sum("_one").over(w)})
    if points is not None:
        # the parts of a large group, added up in order
        every = Window.partitionBy(*part)
        before = every.orderBy("_chunk").rowsBetween(UNBOUNDED, -1)
        parts = rows.where(F.col(points).isNotNull()).groupBy(*keys).agg(F.sum("_one").alias("_k")).select(
            *keys, F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_b"), F.sum("_k").over(every).alias("_all"))
        rows = rows.join(parts, keys, "left").withColumns({
            "_place": F.col("_place") + F.coalesce("_b", F.lit(0)), "_below": F.col("_below") + F.coalesce("_b", F.lit(0)),
            "_n": F.coalesce("_all", "_n")}).drop("_b", "_all", "_chunk")
    bits = F.when(F.col("_n") > 1, F.length(F.bin(F.col("_n") - 1))).otherwise(0)
    return rows.withColumns({"_bits": F.when(known, bits), "_place": F.when(known, F.col("_place")),
                             "_below": F.when(known, F.col("_below"))}).drop("_one", "_n")


def _blocks(bits_set: bool) -> str:
    number, bit = ("_below", 1) if bits_set else ("_place", 0)
    block = f"shiftright({number}, b)" + (" - 1" if bits_set else "")
    return (f"transform(filter(IF(_bits > 0, sequence(0, _bits - 1), array()), b -> (shiftright({number}, b) & 1) = {bit}), "
            f"b -> named_struct('_level', b, '_block', CAST({block} AS LONG)))")


def better_events(rows: DataFrame, part: Sequence[str], carry: Sequence[str] = (), extra: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(population, probes) of :func:`range_totals` over part, _level, _block that add up,
    in column ``better``, the rows of each range that have a smaller rank. ``rows`` come
    from :func:`ranked` and have x, lo, hi."""
    population = rows.select(*part, *extra, "x", F.lit(1.0).alias("better"), F.inline(F.expr(_blocks(False))))
    probes = rows.select("_id", *carry, *part, *extra, "lo", "hi", F.inline(F.expr(_blocks(True))))
    return population, probes
