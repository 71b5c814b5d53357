"""Parity rules shared by every operator.

All helpers return Columns built from built-in functions, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """x/0 is NULL instead of an error (ANSI) or inf (pandas)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def np_round(c: ColumnOrName, digits: int = 0) -> Column:
    """NumPy rounding, ties to even, at `digits` decimals."""
    scale = float(10 ** digits)
    if digits == 0:
        return F.rint(col(c))
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def md10(md: ColumnOrName) -> Column:
    """Discount level as an integer number of tenths (0..10)."""
    return F.rint(col(md) * F.lit(10.0)).cast("int")


def md1(md: ColumnOrName) -> Column:
    """Discount rounded to one decimal, as a double (md10 / 10)."""
    return md10(md) / F.lit(10.0)


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN is a missing value."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def day_number(date_col: ColumnOrName) -> Column:
    """Days since 1970-01-01; the ordering key of every calendar-day frame."""
    return F.unix_date(col(date_col))


def sum0(c: ColumnOrName) -> Column:
    """Sum of nothing (or of NULLs) is 0, as in pandas."""
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def pct_rank_avg(value: str, partition: Sequence[str], ascending: bool = True) -> Column:
    """Pandas rank(pct=True, method='average').

    (min rank + (ties - 1) / 2) / number of non-null values; NULL stays NULL.
    Three window functions over the same keys (and, for ties, the value).
    """
    v = F.col(value)
    order = v.asc_nulls_last() if ascending else v.desc_nulls_last()
    w_rank = Window.partitionBy(*partition).orderBy(order)
    w_ties = Window.partitionBy(*partition, value)
    w_all = Window.partitionBy(*partition)
    avg_rank = F.rank().over(w_rank) + (F.count(F.lit(1)).over(w_ties) - 1) / 2.0
    return F.when(v.isNotNull(), avg_rank / F.count(v).over(w_all))


def right_closed_bins(c: ColumnOrName, edges: Sequence[float | Column],
                      labels: Sequence) -> Column:
    """P10: pandas.cut with right-closed bins (e0, e1], (e1, e2], ...;
    values outside the edges are NULL."""
    c = col(c)
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        lo_c = lo if isinstance(lo, Column) else F.lit(lo)
        hi_c = hi if isinstance(hi, Column) else F.lit(hi)
        cond = (c > lo_c) & (c <= hi_c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def grouped_with_median(df: DataFrame, keys: Sequence[str], median_of: str, sums: Sequence[str],
                        median_out: str | None = None) -> DataFrame:
    """Exact median (linear interpolation of the two middle values, as pandas
    and ``percentile``) together with sums, per group.

    Rows are first combined to (group, value) counts with a hash aggregate
    (map-side combine, so a hot group travels as its distinct values only);
    the median is then read from the running count over the group's
    distinct values. Faster than the object aggregate of ``percentile`` and
    bounded per group by the number of distinct values."""
    median_out = median_out or median_of
    v = F.col(median_of)
    per = (df.groupBy(*keys, median_of)
           .agg(*[F.sum(c).alias(c) for c in sums],
                F.sum(F.when(v.isNotNull(), 1).otherwise(0)).alias("_c")))
    w_run = Window.partitionBy(*keys).orderBy(median_of).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(*keys)
    per = (per.withColumn("_cum", F.sum("_c").over(w_run))
              .withColumn("_n", F.sum("_c").over(w_all)))
    lo = F.floor((F.col("_n") + 1) / 2)
    hi = F.ceil((F.col("_n") + 1) / 2)
    ok = v.isNotNull()
    return (per.groupBy(*keys)
            .agg(*[F.sum(c).alias(c) for c in sums],
                 ((F.min(F.when(ok & (F.col("_cum") >= lo), v))
                   + F.min(F.when(ok & (F.col("_cum") >= hi), v))) / 2.0).alias(median_out)))
