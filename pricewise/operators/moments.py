"""Retail-moment (big promotion) history features (SURVEY 2.3-2.5: A4, J3,
J4, J12, J13, W19-W21, P-23).

Moments are few (a handful of events a year), so after the first
aggregation every table here is at (product, gender, event) grain. History
over earlier events is a window over the event number per product - no
self-join of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.frames import UNBOUNDED
from pricewise.functions.rules import grouped_with_median, np_round, pct_rank_avg, safe_div
from pricewise.operators.ingest import daily_inventory


def style_dimension(sales: DataFrame, attrs: DataFrame, platform: str) -> DataFrame:
    """(style_cd, division, gender_group) of the products sold on a platform, from the
    attributes and the sales' two key columns."""
    sold = sales.filter(F.col("platform") == platform).select("prod_code").distinct()
    return attrs.join(sold, "prod_code", "left_semi").select(F.col("style_number").alias("style_cd"), "division", "gender_group").distinct()


def prepare_moments(rm_sales: DataFrame, styles: DataFrame, rm_calendar: DataFrame, inv: DataFrame,
                    store_platform: dict, platform: str, division: str, level: str = "prod_code") -> DataFrame:
    """rm_data_prepare: RM sales of one platform -> J3 style gender/division
    -> division filter -> A4 per (level, date, gender) -> J4 calendar ->
    lagged inventory -> rm_md, year -> W19 rank / top-10 -> W20 day-1 ratio."""
    r = (rm_sales.filter(F.col("platform") == platform)
         .withColumn("style_cd", F.substring("prod_code", 1, 6)))
    r = r.join(styles.filter(F.col("division") == division), "style_cd")
    r = (grouped_with_median(r, [level, "sales_date", "gender_group"], "MSRP", ["sales_qty", "sales_amt"])
         .withColumnRenamed("sales_qty", "rm_sales_qty").withColumnRenamed("sales_amt", "rm_sales_amt"))
    # the RM calendar is a few days a year: broadcast
    r = r.join(F.broadcast(rm_calendar), "sales_date", "left")
    i = daily_inventory(inv, store_platform, 1).filter(F.col("platform") == platform)
    if level == "style_cd":
        i = i.withColumn("style_cd", F.substring("prod_code", 1, 6))
    i = i.groupBy(level, "sales_date").agg(F.sum("inv_qty").alias("rm_inv_qty"))
    r = (r.join(i, [level, "sales_date"], "left")
         .withColumn("rm_md", np_round(safe_div(safe_div("rm_sales_amt", "rm_sales_qty"), "MSRP"), 1))
         .withColumn("year", F.year("sales_date")))
    return moment_day1_ratio(moment_sales_rank(r, level), level)


def moment_sales_rank(rm: DataFrame, level: str) -> DataFrame:
    """Percent rank (descending, average ties) of total RM qty within
    (gender, RM number); top-10% flag. Joined back with gender in the key (Q12)."""
    tot = (rm.filter(F.col("number").isNotNull())
           .groupBy(level, "gender_group", "number").agg(F.sum("rm_sales_qty").alias("_s")))
    rk = (tot.withColumn("rm_qty_rank", pct_rank_avg("_s", ["gender_group", "number"], ascending=False))
          .withColumn("rm_top_10_flag", F.when(F.col("rm_qty_rank") < 0.1, 1).otherwise(0))
          .drop("_s"))
    return rm.join(rk, [level, "gender_group", "number"], "left")


def moment_day1_ratio(rm: DataFrame, level: str) -> DataFrame:
    """Day-1 qty / inventory attached to every day of that RM."""
    w = Window.partitionBy(level, "gender_group", "number")
    ratio = F.when(F.col("day_number") == 1, safe_div("rm_sales_qty", "rm_inv_qty"))
    return rm.withColumn("rm_qty_inv_adv",
                         F.when(F.col("number").isNotNull(), F.max(ratio).over(w)))


def previous_moment(rm: DataFrame, level: str) -> DataFrame:
    """Per (level, gender, RM number): qty sum, mean md, last date, max
    rank and ratio; those of number - 1 attached to each row; interval in
    days; flag qty > 0."""
    per = (rm.groupBy(level, "gender_group", "number")
           .agg(F.sum("rm_sales_qty").alias("last_rm_sales_qty"), F.avg("rm_md").alias("last_rm_md"),
                F.max("sales_date").alias("sku_in_last_rm_max_date"),
                F.max("rm_qty_rank").alias("last_rm_qty_rank"),
                F.max("rm_qty_inv_adv").alias("last_rm_qty_inv_adv"))
           .withColumn("number", F.col("number") + 1))
    out = rm.join(per, [level, "gender_group", "number"], "left")
    return (out.withColumn("last_rm_interval",
                           F.datediff("sales_date", "sku_in_last_rm_max_date").cast("double"))
            .withColumn("last_rm_flag", F.when(F.col("last_rm_sales_qty") > 0, 1).otherwise(0)))


def same_moment_last_year(rm: DataFrame, level: str) -> DataFrame:
    """Same RM name one year earlier: day-1 rows get last year's day-1
    qty sum, later days the mean qty of last year's later days; both get last
    year's mean md; flag qty > 0. Rows without a day number are dropped."""
    k = [level, "rm_name", "year"]
    day1 = (rm.filter(F.col("day_number") == 1).groupBy(*k)
            .agg(F.sum("rm_sales_qty").alias("_q1")))
    later = (rm.filter(F.col("day_number") > 1).groupBy(*k)
             .agg(F.avg("rm_sales_qty").alias("_q2")))
    md = rm.groupBy(*k).agg(F.avg("rm_md").alias("last_same_rm_md"))
    prev = [F.col(c) for c in k[:-1]] + [(F.col("year") + 1).alias("year")]
    x = (rm.filter(F.col("day_number").isNotNull())
         .join(day1.select(*prev, "_q1"), k, "left")
         .join(later.select(*prev, "_q2"), k, "left")
         .join(md.select(*prev, "last_same_rm_md"), k, "left"))
    q = F.when(F.col("day_number") == 1, F.col("_q1")).otherwise(F.col("_q2"))
    return (x.withColumn("last_same_rm_qty", q)
            .withColumn("last_same_rm_flag", F.when(F.col("last_same_rm_qty") > 0, 1).otherwise(0))
            .drop("_q1", "_q2"))


def moment_history(rm: DataFrame, level: str) -> DataFrame:
    """Over earlier RM numbers of the product: distinct count, mean of
    per-RM qty, mean md of rows, any top-10, any hot (day-1 ratio > 1), and
    days since the latest earlier hot RM row (Q5, two passes)."""
    per = (rm.filter(F.col("number").isNotNull()).groupBy(level, "number")
           .agg(F.sum("rm_sales_qty").alias("_q"), F.sum("rm_md").alias("_ms"), F.count("rm_md").alias("_mc"),
                F.max("rm_top_10_flag").alias("_top"),
                F.max(F.when(F.col("rm_qty_inv_adv") > 1, 1).otherwise(0)).alias("_hot"),
                F.max(F.when(F.col("rm_qty_inv_adv") > 1, F.col("sales_date"))).alias("_hot_date")))
    w = Window.partitionBy(level).orderBy("number").rangeBetween(UNBOUNDED, -1)
    hist = per.select(level, "number",
                      F.count("number").over(w).alias("hist_rm_count"),
                      F.avg("_q").over(w).alias("hist_rm_qty"),
                      F.try_divide(F.sum("_ms").over(w), F.sum("_mc").over(w)).alias("hist_rm_md"),
                      F.max("_top").over(w).alias("hist_top_10_flag"),
                      F.max("_hot").over(w).alias("hist_hot_flag"),
                      F.max("_hot_date").over(w).alias("_last_hot"))
    out = rm.join(hist, [level, "number"], "left")
    return (out.withColumn("hist_hot_interval", F.datediff("sales_date", "_last_hot").cast("double"))
            .drop("_last_hot"))


def days_from_moment(df: DataFrame, season_moment: DataFrame) -> DataFrame:
    """P-23: is_rm = the date is some season's RM start; days_since_rm = days
    from the RM start of the row's season (NULL when the season has none).
    ``season_moment`` (season1, rm_start) is one row per season: broadcast."""
    starts = F.broadcast(season_moment.select(F.col("rm_start").alias("_rs")).distinct()
                         .withColumn("is_rm", F.lit(1)))
    x = df.join(starts, F.col("sales_date") == F.col("_rs"), "left").drop("_rs").fillna(0, subset=["is_rm"])
    x = x.join(F.broadcast(season_moment), "season1", "left")
    return x.withColumn("days_since_rm", F.datediff("sales_date", "rm_start").cast("double")).drop("rm_start")


#: The feature table's columns.
FEATURES = ["last_rm_flag", "last_rm_sales_qty", "last_rm_md", "last_rm_qty_rank", "last_rm_qty_inv_adv",
            "last_rm_interval", "last_same_rm_flag", "last_same_rm_qty", "last_same_rm_md",
            "hist_rm_count", "hist_rm_qty", "hist_rm_md", "hist_top_10_flag", "hist_hot_flag"]


def moment_features(rm: DataFrame, level: str, cols: Sequence[str] = FEATURES) -> DataFrame:
    """The chain of moment features: J12 -> J13 -> W21 -> feature columns."""
    x = moment_history(same_moment_last_year(previous_moment(rm, level), level), level)
    return x.select(level, "sales_date", "gender_group", *cols)
