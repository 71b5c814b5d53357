"""Registered plans: ingest, master, dimensions, simple aggregates (S, P, A, F ids)."""

from __future__ import annotations

from pricewise.functions import scalars
from pricewise.operators import ingest
from pricewise.plans import base
from pricewise.plans.catalog import register
from pricewise.sources.fixtures import STORE_PLATFORM

MASTER_COLS = ["platform", "sales_date", "prod_code", "season1", "inseason_flag1", "sales_qty",
               "sales_amt", "MSRP", "style_number", "division", "gender_group", "gc_category",
               "model", "class_platform", "power_item", "color_desc", "md", "inv_qty"]


@register("daily_sku_sales", sql="SELECT * FROM master")
def daily_sku_sales(spark, sf_dir):
    """Flagship: S1 -> A1 -> J1 -> P-9 -> J2 (daily data master, MAIN)."""
    return base.master(base.views(spark, sf_dir)).select(*MASTER_COLS)


MAIN_STORES = [s for s, p in STORE_PLATFORM.items() if p == base.PLATFORM]


@register("site_traffic", sql=f"""
SELECT m.prod_code, m.sales_date,
       CASE WHEN m.sales_date = DATE '{base.FCST_DATE}' THEN {base.FCST_TRAFFIC} ELSE t.site_traffic END AS site_traffic
FROM master m
LEFT JOIN (SELECT sales_date, CAST(sum(site_traffic) AS BIGINT) AS site_traffic FROM traffic
           WHERE store_nm IN ({', '.join(f"'{s}'" for s in MAIN_STORES)}) GROUP BY sales_date) t
  ON t.sales_date = m.sales_date""")
def site_traffic(spark, sf_dir):
    """A20 + J6 + P-19: daily traffic of the platform's stores joined to the
    master; the planned figure replaces it on the forecast day."""
    v = base.views(spark, sf_dir)
    x = ingest.join_site_traffic(base.master(v), v.traffic(), MAIN_STORES)
    x = scalars.override_on_date(x, "site_traffic", base.FCST_DATE, base.FCST_TRAFFIC)
    return x.select("prod_code", "sales_date", "site_traffic")


AFTER, UPTO = "1999-08-15", "1999-10-20"


@register("data_master_window", sql=f"""
WITH s AS (SELECT platform, season1, inseason_flag1, prod_code, size_cd, sales_date, MSRP, sum(sales_qty) AS sales_qty, sum(sales_amt) AS sales_amt
           FROM sales_trans WHERE sales_date > DATE '{AFTER}' AND sales_date <= DATE '{UPTO}' AND platform <> 'SIDE' GROUP BY ALL),
d AS (SELECT platform, sales_date, prod_code, season1, inseason_flag1, sum(sales_qty) AS sales_qty, sum(sales_amt) AS sales_amt,
             median(MSRP) AS MSRP FROM s GROUP BY ALL),
i AS (SELECT prod_code, eop_dt + {1 + base.LEAD} AS sales_date, sum(eop_qty) AS inv_qty FROM inventory
      WHERE store_nm IN ({', '.join(f"'{s}'" for s in MAIN_STORES)}) GROUP BY ALL)
SELECT d.platform, d.sales_date, d.prod_code, d.season1, d.inseason_flag1, d.sales_qty, d.sales_amt, d.MSRP,
  least(round_even(d.sales_amt / d.sales_qty / d.MSRP, 2), 1.0) AS md, a.division, a.gender_group, i.inv_qty
FROM d LEFT JOIN attributes a USING (prod_code) LEFT JOIN i ON i.prod_code = d.prod_code AND i.sales_date = d.sales_date""")
def data_master_window(spark, sf_dir):
    """S1 + S2 -> A1 -> J1 -> P-9 -> J2: the data master of an increment's dates, with the
    stock known 1 + lead days before, from stages by month of which only the window's
    months are read."""
    v = base.views(spark, sf_dir)
    sales = ingest.scan_sales_window(base.stored_sales(spark, sf_dir), AFTER, UPTO, "SIDE")
    stock = ingest.scan_inventory_window(base.stored_inventory(spark, sf_dir), UPTO, base.LEAD, MAIN_STORES, AFTER)
    x = ingest.data_master(sales, v.attributes(), stock, STORE_PLATFORM, base.PLATFORM, 1 + base.LEAD)
    return x.select("platform", "sales_date", "prod_code", "season1", "inseason_flag1", "sales_qty", "sales_amt", "MSRP", "md", "division",
                    "gender_group", "inv_qty")
