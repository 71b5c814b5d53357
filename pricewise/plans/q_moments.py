"""Registered plans: retail-moment history (S4, A4, J3, J4, J12, J13,
W19-W21) and season sell-through (W17, A3, P-22, P-24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewise.operators import ingest
from pricewise.operators import inventory as invops
from pricewise.operators import moments as mo
from pricewise.plans import base
from pricewise.plans.catalog import register
from pricewise.sources.fixtures import STORE_PLATFORM

LEAD = base.LEAD

RM_CTES = """rms AS (SELECT platform, season1, inseason_flag1, prod_code, sales_date, MSRP,
                   sum(sales_qty) AS sales_qty, sum(sales_amt) AS sales_amt
            FROM sales_trans WHERE sales_date IN (SELECT sales_date FROM rm_calendar)
            GROUP BY platform, season1, inseason_flag1, prod_code, sales_date, MSRP),
div AS (SELECT DISTINCT style_number AS style_cd, division, gender_group FROM master),
r1 AS (SELECT r.prod_code, r.sales_date, d.gender_group, r.sales_qty, r.sales_amt, r.MSRP
       FROM rms r LEFT JOIN div d ON substr(r.prod_code, 1, 6) = d.style_cd
       WHERE r.platform = 'MAIN' AND d.division = 'FOOTWEAR'),
r2 AS (SELECT prod_code, sales_date, gender_group, sum(sales_qty) AS rm_sales_qty,
              sum(sales_amt) AS rm_sales_amt, median(MSRP) AS MSRP
       FROM r1 GROUP BY prod_code, sales_date, gender_group),
inv1 AS (SELECT prod_code, CAST(eop_dt + 1 AS DATE) AS sales_date, sum(eop_qty) AS rm_inv_qty
         FROM inventory WHERE store_nm <> '4-NOT SPECIFIED' GROUP BY 1, 2),
r3 AS (SELECT r2.*, c.rm_name, c.number, c.day_number, i.rm_inv_qty,
              round_even(r2.rm_sales_amt / r2.rm_sales_qty / r2.MSRP, 1) AS rm_md,
              CAST(year(r2.sales_date) AS INTEGER) AS year
       FROM r2 LEFT JOIN rm_calendar c ON c.sales_date = r2.sales_date
       LEFT JOIN inv1 i ON i.prod_code = r2.prod_code AND i.sales_date = r2.sales_date),
tot AS (SELECT prod_code, gender_group, number, sum(rm_sales_qty) AS s FROM r3
        WHERE number IS NOT NULL GROUP BY 1, 2, 3),
rk AS (SELECT prod_code, gender_group, number,
              (rank() OVER (PARTITION BY gender_group, number ORDER BY s DESC)
               + (count(*) OVER (PARTITION BY gender_group, number, s) - 1) / 2.0)
              / count(s) OVER (PARTITION BY gender_group, number) AS rm_qty_rank FROM tot),
adv AS (SELECT prod_code, gender_group, number, max(rm_sales_qty / rm_inv_qty) AS rm_qty_inv_adv
        FROM r3 WHERE day_number = 1 GROUP BY 1, 2, 3),
rm AS (SELECT r3.*, rk.rm_qty_rank,
              CASE WHEN rk.rm_qty_rank IS NULL THEN NULL WHEN rk.rm_qty_rank < 0.1 THEN 1 ELSE 0 END AS rm_top_10_flag,
              adv.rm_qty_inv_adv
       FROM r3 LEFT JOIN rk ON r3.prod_code = rk.prod_code AND r3.gender_group = rk.gender_group
                            AND r3.number = rk.number
       LEFT JOIN adv ON r3.prod_code = adv.prod_code AND r3.gender_group = adv.gender_group
                    AND r3.number = adv.number)"""

RM_COLS = ["prod_code", "sales_date", "gender_group", "rm_sales_qty", "rm_sales_amt", "MSRP", "rm_name",
           "number", "day_number", "rm_inv_qty", "rm_md", "year", "rm_qty_rank", "rm_top_10_flag",
           "rm_qty_inv_adv"]


def _rm(spark, sf_dir, level="prod_code"):
    v = base.views(spark, sf_dir)
    rm_sales = ingest.scan_moment_sales(base.stored_sales(spark, sf_dir), v.rm_calendar())
    return mo.prepare_moments(rm_sales, mo.style_dimension(v.sales_trans(), v.attributes(), base.PLATFORM), v.rm_calendar(), v.inventory(),
                              STORE_PLATFORM, base.PLATFORM, base.DIVISION, level)


@register("moment_sales_rank", sql=f"WITH {RM_CTES}\nSELECT {', '.join(RM_COLS)} FROM rm")
def moment_sales_rank(spark, sf_dir):
    """S4 + J3 + A4 + J4 + W19 + W20: RM daily sales per SKU and gender with
    calendar, inventory, md, qty rank, top-10 flag and day-1 ratio."""
    return _rm(spark, sf_dir).select(*RM_COLS)


@register("previous_moment", sql=f"""WITH {RM_CTES},
per AS (SELECT prod_code, gender_group, number + 1 AS number, sum(rm_sales_qty) AS last_rm_sales_qty,
               avg(rm_md) AS last_rm_md, max(sales_date) AS mx, max(rm_qty_rank) AS last_rm_qty_rank,
               max(rm_qty_inv_adv) AS last_rm_qty_inv_adv
        FROM rm GROUP BY prod_code, gender_group, number)
SELECT rm.prod_code, rm.sales_date, rm.gender_group, p.last_rm_sales_qty, p.last_rm_md, p.last_rm_qty_rank,
       p.last_rm_qty_inv_adv, CAST(date_diff('day', p.mx, rm.sales_date) AS DOUBLE) AS last_rm_interval,
       CASE WHEN p.last_rm_sales_qty > 0 THEN 1 ELSE 0 END AS last_rm_flag
FROM rm LEFT JOIN per p ON rm.prod_code = p.prod_code AND rm.gender_group = p.gender_group
                       AND rm.number = p.number""")
def previous_moment(spark, sf_dir):
    """Results of the previous RM (number - 1) of the same SKU and gender."""
    return mo.previous_moment(_rm(spark, sf_dir), "prod_code").select(
        "prod_code", "sales_date", "gender_group", "last_rm_sales_qty", "last_rm_md", "last_rm_qty_rank",
        "last_rm_qty_inv_adv", "last_rm_interval", "last_rm_flag")


@register("same_moment_last_year", sql=f"""WITH {RM_CTES},
d1 AS (SELECT prod_code, rm_name, year + 1 AS year, sum(rm_sales_qty) AS q1 FROM rm
       WHERE day_number = 1 GROUP BY prod_code, rm_name, year),
d2 AS (SELECT prod_code, rm_name, year + 1 AS year, avg(rm_sales_qty) AS q2 FROM rm
       WHERE day_number > 1 GROUP BY prod_code, rm_name, year),
mdy AS (SELECT prod_code, rm_name, year + 1 AS year, avg(rm_md) AS last_same_rm_md FROM rm
        GROUP BY prod_code, rm_name, year),
x AS (SELECT rm.prod_code, rm.sales_date, rm.gender_group,
             CASE WHEN rm.day_number = 1 THEN d1.q1 ELSE d2.q2 END AS last_same_rm_qty, mdy.last_same_rm_md
      FROM rm
      LEFT JOIN d1 ON rm.prod_code = d1.prod_code AND rm.rm_name = d1.rm_name AND rm.year = d1.year
      LEFT JOIN d2 ON rm.prod_code = d2.prod_code AND rm.rm_name = d2.rm_name AND rm.year = d2.year
      LEFT JOIN mdy ON rm.prod_code = mdy.prod_code AND rm.rm_name = mdy.rm_name AND rm.year = mdy.year
      WHERE rm.day_number IS NOT NULL)
SELECT *, CASE WHEN last_same_rm_qty > 0 THEN 1 ELSE 0 END AS last_same_rm_flag FROM x""")
def same_moment_last_year(spark, sf_dir):
    """The same RM one year earlier (day-1 total / later-day mean, mean md)."""
    return mo.same_moment_last_year(_rm(spark, sf_dir), "prod_code").select(
        "prod_code", "sales_date", "gender_group", "last_same_rm_qty", "last_same_rm_md", "last_same_rm_flag")


@register("moment_history", sql=f"""WITH {RM_CTES},
per AS (SELECT prod_code, number, sum(rm_sales_qty) AS q, sum(rm_md) AS ms, count(rm_md) AS mc,
               max(rm_top_10_flag) AS top, max(CASE WHEN rm_qty_inv_adv > 1 THEN 1 ELSE 0 END) AS hot,
               max(CASE WHEN rm_qty_inv_adv > 1 THEN sales_date END) AS hd
        FROM rm WHERE number IS NOT NULL GROUP BY prod_code, number),
h AS (SELECT a.prod_code, a.number, count(b.number) AS hist_rm_count, avg(b.q) AS hist_rm_qty,
             sum(b.ms) / sum(b.mc) AS hist_rm_md, max(b.top) AS hist_top_10_flag, max(b.hot) AS hist_hot_flag,
             max(b.hd) AS lh
      FROM per a LEFT JOIN per b ON b.prod_code = a.prod_code AND b.number < a.number
      GROUP BY a.prod_code, a.number)
SELECT rm.prod_code, rm.sales_date, rm.gender_group, h.hist_rm_count, h.hist_rm_qty, h.hist_rm_md,
       h.hist_top_10_flag, h.hist_hot_flag, CAST(date_diff('day', h.lh, rm.sales_date) AS DOUBLE) AS hist_hot_interval
FROM rm LEFT JOIN h ON rm.prod_code = h.prod_code AND rm.number = h.number""")
def moment_history(spark, sf_dir):
    """History over earlier RMs of the SKU (count, mean qty / md, top-10, hot)."""
    return mo.moment_history(_rm(spark, sf_dir), "prod_code").select(
        "prod_code", "sales_date", "gender_group", "hist_rm_count", "hist_rm_qty", "hist_rm_md",
        "hist_top_10_flag", "hist_hot_flag", "hist_hot_interval")


@register("season_sell_through", sql=f"""
WITH d AS (SELECT season1, gender_group, style_cd, sales_date, coalesce(sum(sales_qty), 0) AS q
           FROM style GROUP BY season1, gender_group, style_cd, sales_date),
sp AS (SELECT DISTINCT season1, gender_group, sales_date AS t FROM style),
f AS (SELECT season1, gender_group, style_cd, min(sales_date) AS f FROM d GROUP BY 1, 2, 3),
g AS (SELECT f.season1, f.gender_group, f.style_cd, sp.t FROM f
      JOIN sp ON sp.season1 = f.season1 AND sp.gender_group = f.gender_group AND sp.t >= f.f),
c AS (SELECT g.*, (SELECT sum(d.q) FROM d WHERE d.season1 = g.season1 AND d.gender_group = g.gender_group
                     AND d.style_cd = g.style_cd AND d.sales_date <= g.t) AS cum FROM g),
r AS (SELECT c.*, round_even((rank() OVER (PARTITION BY season1, gender_group, t ORDER BY cum DESC)
                   + (count(*) OVER (PARTITION BY season1, gender_group, t, cum) - 1) / 2.0)
                   / count(cum) OVER (PARTITION BY season1, gender_group, t), 2) AS rk FROM c),
bi AS (SELECT substr(prod_code, 1, 6) AS style_cd, CAST(eop_dt + {LEAD} AS DATE) AS sales_date,
              sum(eop_qty) + sum(in_transit_qty) + sum(warehouse_transit_qty) AS broad_inv_qty
       FROM inventory WHERE store_nm <> '4-NOT SPECIFIED' GROUP BY 1, 2),
o AS (SELECT s.style_cd, s.sales_date, s.season1, r.cum AS sn_cum_qty, r.rk AS sn_cum_qty_rank,
             round_even(r.cum / (bi.broad_inv_qty + r.cum), 2) AS sn_to_date_st,
             date_diff('day', b.season_start, s.sales_date) AS days_from_season_begins
      FROM (SELECT DISTINCT style_cd, sales_date, season1 FROM style) s
      LEFT JOIN r ON r.style_cd = s.style_cd AND r.t + {LEAD} = s.sales_date
      LEFT JOIN bi ON bi.style_cd = s.style_cd AND bi.sales_date = s.sales_date
      LEFT JOIN bounds b ON b.season1 = s.season1)
SELECT *, sn_to_date_st * 180.0 / NULLIF(days_from_season_begins, 0) / 0.65 AS st_saturate_180,
          sn_to_date_st * 90.0 / NULLIF(days_from_season_begins, 0) / 0.65 AS st_saturate_90
FROM o""")
def season_sell_through(spark, sf_dir):
    """W17 + A3 + P-24: season-to-date qty, its rank, sell-through and saturation (style level)."""
    v = base.views(spark, sf_dir)
    s = base.style_base(v)
    bi = ingest.broad_inventory(v.inventory(), STORE_PLATFORM, base.PLATFORM, LEAD, level="style_cd")
    st = invops.season_sell_through(s, bi, LEAD, "style_cd")
    bounds = ingest.season_bounds(v.season_calendar())
    rows = (s.select("style_cd", "sales_date", "season1").distinct()
            .join(st, ["style_cd", "sales_date"], "left")
            .join(F.broadcast(bounds.select("season1", "season_start")), "season1", "left")
            .withColumn("days_from_season_begins",
                        F.datediff("sales_date", "season_start").cast("long"))
            .drop("season_start"))
    return invops.saturation_score(rows)
