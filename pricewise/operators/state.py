"""Running features from a saved state.

A state holds, for each key, what all days up to one day add up to: counts and sums,
largest and smallest values. States of disjoint days merge by the same aggregates, so an
increment is merged in without its history. A feature of later rows is read from the
state, as one row dated on its last day, and the days since: rows of the history before
that day are not read. A state whose last day is the day that a feature may look back to
gives the features of a forecast day alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.frames import gate_on_spine, lookback, spine
from pricewise.operators import timefeatures as tf

#: How the columns of a state merge.
MERGE = {"n_rows": F.sum, "n_inseason": F.sum, "v_max": F.max, "v_min": F.min, "v_sum": F.sum, "v_n": F.sum,
         "md_sum": F.sum, "md_days": F.sum, "q_max": F.max}


def md_days(rows: DataFrame, level: str) -> DataFrame:
    """One row per (level, md, date): what it adds to the state of the (level, md)."""
    return rows.groupBy(level, "md10", "sales_date").agg(F.avg("sales_qty").alias("v_max"), F.count(F.lit(1)).alias("n_rows")) \
        .withColumns({"v_min": F.col("v_max"), "v_sum": F.col("v_max"), "v_n": F.col("n_rows")})


def days(rows: DataFrame, level: str) -> DataFrame:
    """One row per (level, date): what it adds to the state of the level."""
    return rows.groupBy(level, "sales_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.when(F.col("inseason_flag1") == "Y", 1).otherwise(0)).alias("n_inseason"),
        F.avg("md10").alias("md_sum"), F.lit(1).cast("long").alias("md_days"), tf.sum0("sales_qty").alias("q_max"))


def state_of(daily: DataFrame, keys: Sequence[str], upto: str) -> DataFrame:
    """The state of daily rows up to a day, dated on that day."""
    cols = [c for c in daily.columns if c in MERGE]
    seen = daily.filter(F.col("sales_date") <= F.lit(upto).cast("date"))
    return seen.groupBy(*keys).agg(*[MERGE[c](c).alias(c) for c in cols]).withColumn("sales_date", F.lit(upto).cast("date"))


def merge(old: DataFrame, new: DataFrame, keys: Sequence[str], upto: str) -> DataFrame:
    """The state of the days of both, dated on the last of them. The days are disjoint."""
    cols = [c for c in old.columns if c in MERGE]
    return old.unionByName(new.select(old.columns)).groupBy(*keys).agg(*[MERGE[c](c).alias(c) for c in cols]) \
        .withColumn("sales_date", F.lit(upto).cast("date")).select(old.columns)


def read(targets: DataFrame, state: DataFrame, since: DataFrame, keys: Sequence[str], lag: int) -> DataFrame:
    """``targets`` with the state's columns as of their date - lag. ``since`` holds the daily
    rows after the state's day."""
    cols = [c for c in state.columns if c in MERGE]
    return lookback(targets, state.unionByName(since.select(state.columns)), keys, "sales_date", {f"{c}_": MERGE[c](c) for c in cols},
                    lag=lag, value_cols=cols).withColumnsRenamed({f"{c}_": c for c in cols})


def days_on_market(rows: DataFrame, state: DataFrame, level: str) -> DataFrame:
    """W11 of rows after the state's day."""
    got = read(rows.select(level, "sales_date"), state, days(rows, level), [level], 0)
    return got.select(level, "sales_date", F.col("n_rows").alias("num_days_on_mkt"), F.col("n_inseason").cast("long").alias("num_days_on_mkt_inseason"))


def historic_md_avg(targets: DataFrame, state: DataFrame, since: DataFrame, level: str) -> DataFrame:
    """W9 of (level, sales_date) targets after the state's day."""
    got = read(targets, state, since, [level], 1)
    return got.select(level, "sales_date", (F.try_divide("md_sum", "md_days") / 10.0).alias("hist_md_avg"))


def same_md_history(targets: DataFrame, state: DataFrame, since: DataFrame, spine_df: DataFrame, level: str, shift: int) -> DataFrame:
    """W7 of (level, md10, sales_date) targets whose date - shift is not before the state's
    day."""
    got = gate_on_spine(read(targets, state, since, [level, "md10"], shift), spine_df, "sales_date", shift)
    cols = {"same_md_hist_max_aps": F.col("v_max"), "same_md_hist_min_aps": F.col("v_min"), "same_md_hist_mean_aps": F.try_divide("v_sum", "v_n")}
    return got.select(level, "md10", "sales_date", *[F.when(F.col("_on_spine"), c).alias(n) for n, c in cols.items()])


def last_complete_windows(rows: DataFrame, spine_df: DataFrame, level: str, specs: Sequence[tuple[int, str]], name_fmt: str) -> DataFrame:
    """W1 as of the last row: for each level and window length N, the stats of daily mean
    qty over its last N spine dates in a row that all have a value. ``spine_df`` numbers
    the dates. Days in a row share a run (number less position), so each level's last
    long enough run is found by grouping; only its N days are read for the stats."""
    daily = tf.daily_by_key(rows, [level]).where("_v IS NOT NULL") \
        .join(F.broadcast(spine_df), F.col("sales_date") == F.col("spine_date")).select(level, "spine_idx", "_v")
    run = F.col("spine_idx") - F.row_number().over(Window.partitionBy(level).orderBy("spine_idx"))
    daily = daily.withColumn("_run", run)
    runs = daily.groupBy(level, "_run").agg(F.count(F.lit(1)).alias("_days"), F.max("spine_idx").alias("_end"))
    lengths = sorted({n for n, _ in specs})
    ends = runs.groupBy(level).agg(*[F.max(F.when(F.col("_days") >= n, F.col("_end"))).alias(f"_e{n}") for n in lengths])
    inside = {n: F.col("spine_idx").between(F.col(f"_e{n}") - (n - 1), F.col(f"_e{n}")) for n in lengths}
    kept = daily.join(ends, level).withColumns({f"_v{n}": F.when(i, F.col("_v")) for n, i in inside.items()})
    return kept.groupBy(level).agg(*[tf._stat(stat, f"_v{n}").alias(name_fmt.format(n=n, stat=stat)) for n, stat in specs])


def spine_until(rows: DataFrame, upto: str) -> DataFrame:
    """The numbered dates of the rows up to a day (calendar-bounded)."""
    return spine(rows.filter(F.col("sales_date") <= F.lit(upto).cast("date")))


