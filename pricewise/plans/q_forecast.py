"""Registered plans: the rows of a forecast day, and the resampled training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewise.operators import competition as cp
from pricewise.operators import ingest
from pricewise.operators import modeling as md
from pricewise.plans import base
from pricewise.plans.catalog import register
from pricewise.plans.q_features import day_plan
from pricewise.sources.fixtures import STORE_PLATFORM

LEAD, DAY = base.LEAD, base.FCST_DATE
KEEP_SINCE, UNDER, UPPER, SEED = "1998-06-01", 0.5, 0.3, 82


@register("forecast_day_rows", sql=f"""
WITH u AS (
  SELECT prod_code, sales_date, md, MSRP, gender_group, sales_qty, sales_amt FROM sku
  UNION ALL
  SELECT prod_code, DATE '{DAY}', CAST(0.5 AS DOUBLE) + CAST(CAST(style_number AS INTEGER) % 5 AS DOUBLE) / 10,
         CAST(100 + CAST(style_number AS INTEGER) AS DOUBLE), gender_group, NULL, NULL
  FROM attributes WHERE division = '{base.DIVISION}'),
inv AS (SELECT prod_code, eop_dt + {1 + LEAD} AS sales_date, sum(eop_qty) AS lead_inv_qty
        FROM inventory WHERE store_nm <> '4-NOT SPECIFIED' GROUP BY 1, 2)
SELECT u.prod_code, u.sales_date, u.md, u.MSRP, u.gender_group,
  CASE WHEN u.sales_date = DATE '{DAY}' THEN round_even(u.MSRP * u.md, 0)
       ELSE round_even(u.sales_amt / u.sales_qty, 0) END AS AUR,
  CASE WHEN u.sales_date <= DATE '{DAY}' - {LEAD} THEN u.sales_qty END AS sales_qty,
  inv.lead_inv_qty
FROM u LEFT JOIN inv ON inv.prod_code = u.prod_code AND inv.sales_date = u.sales_date""")
def forecast_day_rows(spark, sf_dir):
    """S13 + P-10 / P-11 on the forecast day + J2 at 1 + lead + P-21: the history and
    the planned products of one future day, ready for the features."""
    v = base.views(spark, sf_dir)
    attrs = v.attributes().filter(F.col("division") == base.DIVISION)
    rows = ingest.append_forecast_day(base.sku_base(v), day_plan(attrs), attrs, DAY)
    rows = md.mask_recent_labels(cp.aur(rows, DAY), DAY, LEAD)
    inv = (ingest.daily_inventory(v.inventory(), STORE_PLATFORM, 1 + LEAD).filter(F.col("platform") == base.PLATFORM)
           .select("prod_code", "sales_date", F.col("inv_qty").alias("lead_inv_qty")))
    return md.join_checked(rows, inv, ["prod_code", "sales_date"]).select(
        "prod_code", "sales_date", "md", "MSRP", "gender_group", "AUR", "sales_qty", "lead_inv_qty")


def _share(k: int) -> str:
    text = f"md5('{k}|' || style_cd || '|' || CAST(sales_date AS VARCHAR))"
    return f"(CAST('0x' || substr({text}, 1, 8) AS BIGINT) / 4294967296.0)"


@register("resample_rows", sql=f"""
WITH r AS (SELECT style_cd, sales_date, sales_qty, sales_date IN (SELECT sales_date FROM rm_calendar) AS rm FROM style)
SELECT style_cd, sales_date, sales_qty FROM r WHERE rm OR sales_date >= DATE '{KEEP_SINCE}'
UNION ALL SELECT style_cd, sales_date, sales_qty FROM r
  WHERE NOT (rm OR sales_date >= DATE '{KEEP_SINCE}') AND {_share(SEED)} < {UNDER}
UNION ALL SELECT style_cd, sales_date, sales_qty FROM r WHERE rm AND {_share(SEED + 1)} < {UPPER}""")
def resample_rows(spark, sf_dir):
    """M1: retail-moment and recent rows whole, a share of the others, more of the moments."""
    v = base.views(spark, sf_dir)
    rows = base.style_base(v).select("style_cd", "sales_date", "sales_qty")
    return md.resample_rows(rows, v.rm_calendar(), KEEP_SINCE, UNDER, UPPER, SEED, ["style_cd", "sales_date"])
