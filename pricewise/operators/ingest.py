"""Ingest and data-master operators (SURVEY 2.1, 2.2, 2.4: S1-S4, S10, S11,
S13, P-9, P-16, P-17, A1-A3, A11-A13, J1, J2).

All are plain ``DataFrame -> DataFrame`` functions. Aggregations are
map-side combined by Spark (partial + final hash aggregate), so a hot
product never has to travel as raw rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.rules import grouped_with_median, np_round, safe_div
from pricewise.sources.fixtures import map_column
from pricewise.sources.stages import MONTH, in_months, on_dates

SALES_KEYS = ["platform", "season1", "inseason_flag1", "prod_code", "size_cd", "sales_date", "MSRP"]
DAILY_KEYS = ["platform", "sales_date", "prod_code", "season1", "inseason_flag1"]


def scan_sales_window(sales: DataFrame, after: str | None = None, upto: str | None = None,
                      exclude_platform: str | None = None,
                      keys: Sequence[str] = SALES_KEYS) -> DataFrame:
    """Sales with date in (after, upto], one platform excluded, summed by keys. Of a
    stage by month, only the window's months are read."""
    if MONTH in sales.columns:
        sales = in_months(sales, after, upto)
    cond = F.lit(True)
    if after is not None:
        cond &= F.col("sales_date") > F.lit(after).cast("date")
    if upto is not None:
        cond &= F.col("sales_date") <= F.lit(upto).cast("date")
    if exclude_platform is not None:
        cond &= F.col("platform") != F.lit(exclude_platform)
    return (sales.filter(cond).groupBy(*keys)
            .agg(F.sum("sales_qty").alias("sales_qty"), F.sum("sales_amt").alias("sales_amt")))


def scan_inventory_window(inv: DataFrame, upto: str, lead: int, stores: Sequence[str], after: str | None = None) -> DataFrame:
    """Inventory rows with EOP date in (after - 1 - lead, upto - 1 - lead], those known
    1 + lead days before the sales of the window (after, upto], and store in a list;
    without ``after``, of the day ``upto`` alone. Of a stage by month, only the window's
    months are read."""
    day = dt.date.fromisoformat
    last = day(upto) - dt.timedelta(days=1 + lead)
    first = last if after is None else day(after) - dt.timedelta(days=lead)
    if MONTH in inv.columns:
        inv = in_months(inv, first.isoformat(), last.isoformat())
    return inv.filter(F.col("eop_dt").between(F.lit(first), F.lit(last)) & F.col("store_nm").isin(list(stores)))


def scan_moment_sales(sales: DataFrame, rm_dates: DataFrame,
                      exclude_platform: str | None = None,
                      keys: Sequence[str] = ("platform", "season1", "inseason_flag1",
                                             "prod_code", "sales_date", "MSRP")) -> DataFrame:
    """Sales on retail-moment dates, grouped. The date list is a
    calendar-bounded dimension, so it is broadcast into a left-semi join."""
    s = sales if exclude_platform is None else sales.filter(F.col("platform") != exclude_platform)
    if MONTH in s.columns:  # a stage by month: months without a moment aren't read
        s = on_dates(s, rm_dates)
    else:
        s = s.join(F.broadcast(rm_dates.select("sales_date").distinct()), "sales_date", "left_semi")
    return (s.groupBy(*keys)
            .agg(F.sum("sales_qty").alias("sales_qty"), F.sum("sales_amt").alias("sales_amt")))


def daily_sku_sales(sales: DataFrame, platform: str | None = None) -> DataFrame:
    """A1: per (platform, date, product, season, flag): sum qty, sum amount,
    median MSRP (sizes collapse)."""
    s = sales if platform is None else sales.filter(F.col("platform") == platform)
    return grouped_with_median(s, DAILY_KEYS, "MSRP", ["sales_qty", "sales_amt"])


def markdown_rate(df: DataFrame, out: str = "md") -> DataFrame:
    """P-9: md = round(amount / qty / MSRP, 2), capped at 1 (NULL stays NULL)."""
    raw = np_round(safe_div(safe_div("sales_amt", "sales_qty"), "MSRP"), 2)
    return df.withColumn(out, F.when(raw > 1.0, F.lit(1.0)).otherwise(raw))


def daily_inventory(inv: DataFrame, store_platform: dict, lag_days: int = 1,
                    keys: Sequence[str] = ("platform", "prod_code"),
                    value: str = "eop_qty", out: str = "inv_qty") -> DataFrame:
    """A2 + J2 preparation: platform from the store dictionary, sales_date =
    EOP date + lag, summed per (platform, product, date)."""
    return (inv.withColumn("platform", map_column(F.col("store_nm"), store_platform))
            .withColumn("sales_date", F.date_add("eop_dt", lag_days))
            .groupBy(*keys, "sales_date").agg(F.sum(value).alias(out)))


def broad_inventory(inv: DataFrame, store_platform: dict, platform: str, lag_days: int,
                    level: str = "prod_code") -> DataFrame:
    """A3: on hand + in transit + warehouse transit by (platform, level, date),
    dates moved forward by ``lag_days``."""
    x = (inv.withColumn("platform", map_column(F.col("store_nm"), store_platform))
         .filter(F.col("platform") == platform)
         .withColumn("sales_date", F.date_add("eop_dt", lag_days)))
    if level == "style_cd":
        x = x.withColumn("style_cd", F.substring("prod_code", 1, 6))
    return (x.groupBy("platform", level, "sales_date")
            .agg(F.sum("eop_qty").alias("inv_qty"),
                 F.sum("in_transit_qty").alias("in_transit_qty"),
                 F.sum("warehouse_transit_qty").alias("warehouse_transit_qty"))
            .withColumn("broad_inv_qty",
                        F.col("inv_qty") + F.col("in_transit_qty") + F.col("warehouse_transit_qty")))


def join_lagged_inventory(daily: DataFrame, inv_daily: DataFrame,
                          keys: Sequence[str] = ("platform", "sales_date", "prod_code")) -> DataFrame:
    """Left join of lagged inventory on (platform, date, product)."""
    return daily.join(inv_daily, list(keys), "left")


def join_attributes(df: DataFrame, attrs: DataFrame, key: str = "prod_code") -> DataFrame:
    """Left join of product attributes. The attribute table grows with the
    catalog, not with sales, but no broadcast is forced: AQE broadcasts it when
    its measured size is under the threshold."""
    return df.join(attrs, key, "left")


def data_master(sales: DataFrame, attrs: DataFrame, inv: DataFrame, store_platform: dict,
                platform: str, lag_days: int = 1) -> DataFrame:
    """The daily data master: A1 -> J1 -> P-9 -> J2. One row per (platform, date,
    product, season, flag)."""
    daily = daily_sku_sales(sales, platform)
    master = markdown_rate(join_attributes(daily, attrs))
    inv_daily = daily_inventory(inv, store_platform, lag_days).filter(F.col("platform") == platform)
    return join_lagged_inventory(master, inv_daily)


def dedup_distinct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop exact duplicates on the real columns (Q8)."""
    return (df if cols is None else df.select(*cols)).distinct()


def dedup_keep_ordered(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row per key in a total order (P11). Callers pass a
    full tie-break so the result is deterministic."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def season_rank(season: F.Column, first_year: int = 0) -> F.Column:
    """P-17: rank of a season in the ordered list SP, SU, FA, HO of the years
    from first_year on, by arithmetic, with no last year; the short form SP18
    is widened to SP2018 first. NULL when it is no season (Q14)."""
    s = F.when(F.length(season) == 4,
               F.concat(F.substring(season, 1, 2), F.lit("20"), F.substring(season, 3, 2))
               ).otherwise(season)
    pos = F.array_position(F.array(*[F.lit(p) for p in ["SP", "SU", "FA", "HO"]]),
                           F.substring(s, 1, 2))
    yr = F.substring(s, 3, 4).try_cast("int")
    rank = (yr - first_year) * 4 + pos - 1
    return F.when(pos > 0, rank.cast("int"))


def season_bounds(calendar: DataFrame, date_col: str = "cal_date", season_col: str = "season") -> DataFrame:
    """First and last calendar date per season."""
    return (calendar.groupBy(F.col(season_col).alias("season1"))
            .agg(F.min(date_col).alias("season_start"), F.max(date_col).alias("season_end")))


def increment_bounds(master: DataFrame, date_col: str = "sales_date") -> DataFrame:
    """High-water mark of a table (one row)."""
    return master.agg(F.max(date_col).alias("data_to_date"))


def append_increment(master: DataFrame, increment: DataFrame) -> DataFrame:
    """Align the increment to the master's columns and append."""
    return master.unionByName(increment.select(*master.columns))


def append_forecast_day(master: DataFrame, plan: DataFrame, attrs: DataFrame, fcst_date: str) -> DataFrame:
    """Planned products for one future day (qty, amount, inventory NULL)
    joined with attributes and appended to the master."""
    rows = (join_attributes(plan, attrs)
            .withColumn("sales_qty", F.lit(None).cast("double"))
            .withColumn("sales_amt", F.lit(None).cast("double"))
            .withColumn("inv_qty", F.lit(None).cast("double"))
            .withColumn("sales_date", F.lit(fcst_date).cast("date")))
    return master.unionByName(rows, allowMissingColumns=True)


def traffic_total(traffic: DataFrame, stores: Sequence[str]) -> DataFrame:
    """Total traffic over a list of sub-platforms by date."""
    return (traffic.filter(F.col("store_nm").isin(list(stores)))
            .groupBy("sales_date").agg(F.sum("site_traffic").alias("site_traffic")))



def join_site_traffic(df: DataFrame, traffic: DataFrame, stores: Sequence[str]) -> DataFrame:
    """Daily total traffic of the sub-platforms, left-joined on date. One
    row per day (calendar-bounded), so it is broadcast."""
    return df.join(F.broadcast(traffic_total(traffic, stores)), "sales_date", "left")


def join_style_traffic(df: DataFrame, style_traffic: DataFrame) -> DataFrame:
    """Mean style traffic per (style, date), left-joined."""
    t = style_traffic.groupBy("style_cd", "sales_date").agg(F.avg("style_traffic").alias("style_traffic"))
    return df.join(t, ["style_cd", "sales_date"], "left")


def join_natural(df: DataFrame, other: DataFrame, how: str = "left") -> DataFrame:
    """Join on all common columns (e.g. is_rm / is_preheat flags by date)."""
    common = [c for c in df.columns if c in other.columns]
    return df.join(other, common, how)


def join_feature_table(df: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the columns both sides have (except the keys), then
    left-join the feature table on the keys."""
    keep = [c for c in features.columns if c in set(keys) or c not in df.columns]
    return df.join(features.select(*keep), list(keys), "left")
