"""Shared building blocks of the registered plans: the data master and the
feature base over the fixture views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.functions.rules import md1, md10
from pricewise.operators import ingest
from pricewise.sources import stages
from pricewise.sources.fixtures import STORE_PLATFORM, RetailViews

PLATFORM = "MAIN"          # the platform the model is built for
DIVISION = "FOOTWEAR"      # the division the features are built for
LEAD = 32                  # days between forecast and sale (reference default)
SHIFT = LEAD               # shift of the rolling / history features: nothing inside the lead gap
FCST_DATE = "2001-09-09"   # forecast day of the registered plans (a retail-moment start)
FCST_SEASON = "FA2001"     # its season
FCST_TRAFFIC = 5000000     # planned site traffic for the forecast day (P-19)


def views(spark: SparkSession, sf_dir: str) -> RetailViews:
    return RetailViews(spark, sf_dir)


def master(v: RetailViews, platform: str = PLATFORM, lag_days: int = 1) -> DataFrame:
    """Daily data master: one row per (platform, date, SKU, season, flag)."""
    return ingest.data_master(v.sales_trans(), v.attributes(), v.inventory(),
                              STORE_PLATFORM, platform, lag_days)


def sku_base(v: RetailViews, division: str = DIVISION) -> DataFrame:
    """Master rows of one division at SKU level, with the 1-decimal md, its
    integer key md10, the style code and the competitor group: a stage by month, written
    once an application."""
    return _sku_stage(v, division).drop(stages.MONTH)


def _sku_stage(v: RetailViews, division: str) -> DataFrame:
    return stages.stored(v.spark, f"sku-{division}", v.inputs(), lambda: _sku_rows(v, division), "sales_date")


def _sku_rows(v: RetailViews, division: str) -> DataFrame:
    m = master(v).filter(F.col("division") == division)
    return (m.withColumn("style_cd", F.substring("prod_code", 1, 6))
            .withColumn("md10", md10("md"))
            .withColumn("md1", md1("md"))
            .withColumn("grp", F.concat(F.col("gc_category"), F.lit("_"), F.col("gender_group"))))


def style_base(v: RetailViews, division: str = DIVISION) -> DataFrame:
    """A5 style rollup of the SKU base: per (date, style, season, flag) sums of
    qty / amount / inventory and mean md; attributes of the best-selling SKU."""
    from pricewise.operators.timefeatures import style_rollup
    s = style_rollup(sku_base(v, division), attrs=v.attributes())
    return s.withColumn("md10", md10("md")).withColumn("md1", md1("md"))


def stored_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage of :func:`sku_base`, with its months."""
    return _sku_stage(views(spark, sf_dir), DIVISION)


def stored_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales transactions as a stage by month of sale."""
    return views(spark, sf_dir).stored_sales()


def stored_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory as a stage by month of EOP date."""
    v = views(spark, sf_dir)
    return stages.stored(spark, "inventory", v.inputs(), v.inventory, "eop_dt")
