"""Season sell-through.

The rank of a product's season-to-date qty is taken among every product of
the (season, gender) that has sold so far, so it needs a product x date
grid. The grid is built by a broadcast of the (season, gender) date spine -
bounded by the calendar - against each product's first sale, so each
product row expands into at most the days of one season and nothing is
shuffled for the expansion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.frames import UNBOUNDED
from pricewise.functions.rules import np_round, pct_rank_avg, safe_div


def season_sell_through(df: DataFrame, broad_inv: DataFrame, lead: int, level: str,
                        gender: str = "gender_group") -> DataFrame:
    """Running season qty per product within (season, gender), on the
    (season, gender) spine from the product's first sale, read lead days
    later; its percent rank per date (descending, 2 decimals); and
    sell-through = qty / (broad inventory + qty), 2 decimals. Keyed by
    (level, sales_date) where sales_date = spine date + lead.

    ``broad_inv`` (A3) has (level, sales_date, broad_inv_qty) already moved
    forward by lead days."""
    g = ["season1", gender]
    daily = (df.groupBy(*g, level, "sales_date")
             .agg(F.coalesce(F.sum("sales_qty"), F.lit(0.0)).alias("_q")))
    spine = F.broadcast(df.select(*g, F.col("sales_date").alias("_t")).distinct())
    firsts = daily.groupBy(*g, level).agg(F.min("sales_date").alias("_first"))
    grid = (firsts.join(spine, g).filter(F.col("_t") >= F.col("_first"))
            .join(daily.withColumnRenamed("sales_date", "_t"), g + [level, "_t"], "left"))
    run = Window.partitionBy(*g, level).orderBy("_t").rowsBetween(UNBOUNDED, 0)
    grid = grid.withColumn("sn_cum_qty", F.sum(F.coalesce(F.col("_q"), F.lit(0.0))).over(run))
    grid = grid.withColumn("sn_cum_qty_rank",
                           np_round(pct_rank_avg("sn_cum_qty", g + ["_t"], ascending=False), 2))
    out = (grid.select(level, F.date_add("_t", lead).alias("sales_date"), "sn_cum_qty", "sn_cum_qty_rank")
           .join(broad_inv.select(level, "sales_date", "broad_inv_qty"), [level, "sales_date"], "left"))
    st = safe_div("sn_cum_qty", F.col("broad_inv_qty") + F.col("sn_cum_qty"))
    return out.withColumn("sn_to_date_st", np_round(st, 2)).drop("broad_inv_qty")


def saturation_score(df: DataFrame, days_col: str = "days_from_season_begins") -> DataFrame:
    """P-24: (180 or 90) x sell-through / days since season begin / 0.65."""
    return (df.withColumn("st_saturate_180", safe_div(F.col("sn_to_date_st") * 180.0, days_col) / 0.65)
            .withColumn("st_saturate_90", safe_div(F.col("sn_to_date_st") * 90.0, days_col) / 0.65))
