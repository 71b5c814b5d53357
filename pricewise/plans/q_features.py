"""Registered plans: the assembled feature table at style and SKU level."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewise.operators import features as ft
from pricewise.operators import ingest
from pricewise.plans import base
from pricewise.plans.catalog import register
from pricewise.plans.q_time import W2_SPECS, W3_SPECS, W4_SPECS, rolling_ctes
from pricewise.session import materialize
from pricewise.sources.stages import MONTH, in_months
from pricewise.sources.fixtures import STORE_PLATFORM

LEAD, SHIFT = base.LEAD, base.SHIFT
STORES = sorted(k for k, v in STORE_PLATFORM.items() if v == base.PLATFORM)
BASE = ["sales_date", "season1", "inseason_flag1", "md10", "sales_qty", "sales_amt", "MSRP", "gender_group", "gc_category"]


def feature_rows(spark, sf_dir, level):
    """Every base row of the level with its features."""
    v = base.views(spark, sf_dir)
    sku = base.sku_base(v)
    if level == "prod_code":
        rows = sku
    else:
        from pricewise.functions.rules import md1, md10
        from pricewise.operators.timefeatures import style_rollup
        rows = materialize(style_rollup(sku, attrs=v.attributes()).withColumn("md10", md10("md")).withColumn("md1", md1("md")), "style_rows")
    # J2, second form: the stock that is known 1 + lead days before the sale
    inv = ingest.daily_inventory(v.inventory(), STORE_PLATFORM, 1 + LEAD).filter(F.col("platform") == base.PLATFORM)
    if level == "style_cd":
        inv = inv.join(sku.select("prod_code").distinct(), "prod_code", "left_semi").withColumn("style_cd", F.substring("prod_code", 1, 6))
    inv = inv.groupBy(level, "sales_date").agg(F.sum("inv_qty").alias("lead_inv_qty"))
    return ft.modeling_features(rows, level, SHIFT, LEAD, inv, v.traffic(), STORES)


def _features(spark, sf_dir, level):
    out = feature_rows(spark, sf_dir, level)
    names = [f.format(n=n, stat=s) for specs, f in ROLLING for n, s in specs]
    return out.select(level, *BASE, *names, *REST)


ROLLING = ((W2_SPECS, "past_{n}_{stat}_aps"), (W3_SPECS, "past_{n}_{stat}_mdaps"), (W4_SPECS, "past_{n}_full_price_{stat}_aps"))
REST = ["same_md_hist_max_aps", "same_md_hist_min_aps", "same_md_hist_mean_aps", "hist_md_avg",
        "hist_max_qty", "num_days_on_mkt", "num_days_on_mkt_inseason", "lead_inv_qty", "same_md_hist_frequency", "inv_qty_rank",
        "site_traffic"]


def _sql(table: str, level: str) -> str:
    rolls = ",\n".join(rolling_ctes(specs, SHIFT, fmt, where, table, level, out) for (specs, fmt), where, out in zip(
        ROLLING, ("TRUE", "round_even(md1, 0) <= 0.9", "round_even(md1, 0) > 0.9"), ("r2", "r3", "r4")))
    cols = ", ".join(f"{o}.{f.format(n=n, stat=s)}" for (specs, f), o in zip(ROLLING, ("r2", "r3", "r4")) for n, s in specs)
    stores = ", ".join(f"'{s}'" for s in STORES)
    own = "i.prod_code" if level == "prod_code" else "substr(i.prod_code, 1, 6)"
    only = "" if level == "prod_code" else "AND i.prod_code IN (SELECT prod_code FROM sku)"
    return f"""
WITH {rolls},
sp AS (SELECT DISTINCT sales_date AS d FROM {table}),
dm AS (SELECT {level}, md10, sales_date, avg(sales_qty) AS v, count(*) AS n FROM {table} GROUP BY 1, 2, 3),
w7 AS (SELECT t.{level}, t.md10, t.sales_date,
    CASE WHEN g.d IS NOT NULL THEN max(s.v) END AS same_md_hist_max_aps,
    CASE WHEN g.d IS NOT NULL THEN min(s.v) END AS same_md_hist_min_aps,
    CASE WHEN g.d IS NOT NULL THEN sum(s.v) / sum(s.n) END AS same_md_hist_mean_aps
  FROM dm t LEFT JOIN dm s ON s.{level} = t.{level} AND s.md10 = t.md10 AND s.sales_date <= t.sales_date - {SHIFT}
  LEFT JOIN sp g ON g.d = t.sales_date - {SHIFT} GROUP BY t.{level}, t.md10, t.sales_date, g.d),
dq AS (SELECT {level}, sales_date, avg(md10) AS m, coalesce(sum(sales_qty), 0) AS q FROM {table} GROUP BY 1, 2),
w9 AS (SELECT t.{level}, t.sales_date, avg(s.m) / 10.0 AS hist_md_avg
  FROM dq t LEFT JOIN dq s ON s.{level} = t.{level} AND s.sales_date < t.sales_date GROUP BY 1, 2),
w18 AS (SELECT t.{level}, t.sales_date, CASE WHEN g.d IS NOT NULL THEN max(s.q) END AS hist_max_qty
  FROM dq t LEFT JOIN dq s ON s.{level} = t.{level} AND s.sales_date <= t.sales_date - {LEAD}
  LEFT JOIN sp g ON g.d = t.sales_date - {LEAD} GROUP BY t.{level}, t.sales_date, g.d),
w11 AS (SELECT a.{level}, a.sales_date, count(*) AS num_days_on_mkt,
    CAST(sum(CASE WHEN b.inseason_flag1 = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS num_days_on_mkt_inseason
  FROM {table} a JOIN {table} b ON a.{level} = b.{level} AND b.sales_date <= a.sales_date GROUP BY 1, 2),
w5 AS (SELECT a.{level}, a.sales_date, a.md10, count(*) AS same_md_hist_frequency
  FROM {table} a JOIN {table} b ON a.{level} = b.{level} AND a.md10 = b.md10 AND b.sales_date <= a.sales_date GROUP BY 1, 2, 3),
inv AS (SELECT {own} AS {level}, i.eop_dt + {1 + LEAD} AS sales_date, sum(i.eop_qty) AS lead_inv_qty
  FROM inventory i WHERE i.store_nm <> '4-NOT SPECIFIED' {only} GROUP BY 1, 2),
tr AS (SELECT sales_date, CAST(sum(site_traffic) AS BIGINT) AS site_traffic FROM traffic WHERE store_nm IN ({stores}) GROUP BY 1),
j AS (SELECT t.*, inv.lead_inv_qty FROM {table} t LEFT JOIN inv ON inv.{level} = t.{level} AND inv.sales_date = t.sales_date),
rk AS (SELECT {level}, sales_date, round_even((rank() OVER (PARTITION BY sales_date, gender_group ORDER BY lead_inv_qty DESC)
      + (count(*) OVER (PARTITION BY sales_date, gender_group, lead_inv_qty) - 1) / 2.0)
      / count(*) OVER (PARTITION BY sales_date, gender_group), 2) AS inv_qty_rank
  FROM j WHERE lead_inv_qty IS NOT NULL AND gender_group IS NOT NULL)
SELECT j.{level}, {", ".join("j." + c for c in BASE)}, {cols},
  w7.same_md_hist_max_aps, w7.same_md_hist_min_aps, w7.same_md_hist_mean_aps,
  w9.hist_md_avg, w18.hist_max_qty, w11.num_days_on_mkt, w11.num_days_on_mkt_inseason, j.lead_inv_qty,
  w5.same_md_hist_frequency, rk.inv_qty_rank, tr.site_traffic
FROM j
LEFT JOIN r2 ON r2.{level} = j.{level} AND r2.sales_date = j.sales_date
LEFT JOIN r3 ON r3.{level} = j.{level} AND r3.sales_date = j.sales_date
LEFT JOIN r4 ON r4.{level} = j.{level} AND r4.sales_date = j.sales_date
LEFT JOIN w7 ON w7.{level} = j.{level} AND w7.md10 = j.md10 AND w7.sales_date = j.sales_date
LEFT JOIN w9 ON w9.{level} = j.{level} AND w9.sales_date = j.sales_date
LEFT JOIN w18 ON w18.{level} = j.{level} AND w18.sales_date = j.sales_date
LEFT JOIN w11 ON w11.{level} = j.{level} AND w11.sales_date = j.sales_date
LEFT JOIN w5 ON w5.{level} = j.{level} AND w5.md10 = j.md10 AND w5.sales_date = j.sales_date
LEFT JOIN rk ON rk.{level} = j.{level} AND rk.sales_date = j.sales_date
LEFT JOIN tr ON tr.sales_date = j.sales_date"""


@register("modeling_features_style", sql=_sql("style", "style_cd"))
def modeling_features_style(spark, sf_dir):
    """J8 + P-26 + J10: the feature table at style level, from one stored stage."""
    return _features(spark, sf_dir, "style_cd")


@register("modeling_features_sku", sql=_sql("sku", "prod_code"))
def modeling_features_sku(spark, sf_dir):
    """J8 + P-26 + J10: the feature table at SKU level, from one stored stage."""
    return _features(spark, sf_dir, "prod_code")


# ------------------------------------------------------------ one forecast day
DAY = base.FCST_DATE
DAY_STYLES = f"""
  SELECT sales_date, style_cd, season1, inseason_flag1, sales_qty, sales_amt, md10, md1, MSRP, gender_group, gc_category
  FROM style WHERE sales_date < DATE '{DAY}'
  UNION ALL
  SELECT DATE '{DAY}', style_number, '{base.FCST_SEASON}', 'Y', NULL, NULL, CAST(round_even(10 * m, 0) AS INTEGER), round_even(10 * m, 0) / 10,
         CAST(100 + CAST(style_number AS INTEGER) AS DOUBLE), gender_group, gc_category
  FROM (SELECT style_number, gender_group, gc_category, 0.5 + (CAST(style_number AS INTEGER) % 5) / 10.0 AS m,
               row_number() OVER (PARTITION BY style_number ORDER BY prod_code DESC) AS rn
        FROM attributes WHERE division = '{base.DIVISION}') a WHERE rn = 1"""


def day_plan(attrs):
    """The planned products of the forecast day: md and price by brand."""
    brand = F.col("style_number").cast("int")
    return attrs.select("prod_code", (F.lit(0.5) + (brand % 5).cast("double") / 10.0).alias("md"), (F.lit(100.0) + brand).alias("MSRP"))


def day_rows(spark, sf_dir):
    """S13 at style level: (history before the forecast day, its planned rows)."""
    from pricewise.functions.rules import md1, md10
    from pricewise.operators.timefeatures import style_rollup
    v = base.views(spark, sf_dir)
    sku = base.stored_sku(spark, sf_dir)
    history = in_months(sku, last=DAY).drop(MONTH).filter(F.col("sales_date") < F.lit(DAY).cast("date"))
    attrs = v.attributes().filter(F.col("division") == base.DIVISION)
    planned = ingest.append_forecast_day(history.limit(0), day_plan(attrs), attrs, DAY) \
        .withColumns({"season1": F.lit(base.FCST_SEASON), "inseason_flag1": F.lit("Y"), "style_cd": F.col("style_number"),
                      "grp": F.concat(F.col("gc_category"), F.lit("_"), F.col("gender_group"))})

    def styles(rows):
        return style_rollup(rows).withColumn("md10", md10("md")).withColumn("md1", md1("md"))
    none = F.lit(None).cast("double")
    return materialize(styles(history), "history"), materialize(styles(planned).withColumns({"sales_qty": none, "sales_amt": none}), "planned")


def day_feature_rows(spark, sf_dir):
    """The planned rows of the forecast day with all features."""
    v = base.views(spark, sf_dir)
    history, planned = day_rows(spark, sf_dir)
    stock = ingest.scan_inventory_window(base.stored_inventory(spark, sf_dir), DAY, LEAD, STORES)
    skus = v.attributes().filter(F.col("division") == base.DIVISION).select("prod_code")
    stock = ingest.daily_inventory(stock, STORE_PLATFORM, 1 + LEAD).join(skus, "prod_code", "left_semi") \
        .groupBy(F.substring("prod_code", 1, 6).alias("style_cd")).agg(F.sum("inv_qty").alias("lead_inv_qty"))
    return ft.forecast_features(history, planned, "style_cd", DAY, SHIFT, LEAD, stock, v.traffic(), STORES)


@register("forecast_day_features", sql=_sql("style_f", "style_cd") + f"\nWHERE j.sales_date = DATE '{DAY}'", extra_views={"style_f": DAY_STYLES})
def forecast_day_features(spark, sf_dir):
    """S13 + M9's features: those of one future day, from states as of the days they may
    look back to; equal to the feature table of the history and the planned rows."""
    names = [f.format(n=n, stat=s) for specs, f in ROLLING for n, s in specs]
    return day_feature_rows(spark, sf_dir).select("style_cd", *BASE, *names, *REST)
