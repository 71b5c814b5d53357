"""Registered plans: price-band competitors, as-of same-md history,
competitive position, inventory rank (J14-J18, W14-W16, P-10-P-14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewise.functions import scalars as sc
from pricewise.operators import competition as cp
from pricewise.operators import ingest
from pricewise.operators import timefeatures as tf
from pricewise.plans import base
from pricewise.plans.catalog import register
from pricewise.plans.q_time import W4_SPECS, rolling_ctes

LEAD = base.LEAD
SHIFT = base.SHIFT

# SKU rows with unit price and band (SQL side of P-10 / P-12)
SKUB = """skub AS (
  SELECT s.*, s.sales_amt / s.sales_qty AS md_price,
         CASE WHEN s.sales_amt / s.sales_qty < 2000 THEN s.sales_amt / s.sales_qty - 100
              ELSE s.sales_amt / s.sales_qty - 300 END AS lo,
         CASE WHEN s.sales_amt / s.sales_qty < 2000 THEN s.sales_amt / s.sales_qty + 100
              ELSE s.sales_amt / s.sales_qty + 300 END AS hi
  FROM sku s)"""


def _sku(spark, sf_dir):
    return cp.unit_price(base.sku_base(base.views(spark, sf_dir)))


@register("price_band_competitors", sql=f"""
WITH {SKUB},
d AS (SELECT style_cd, sales_date, grp, md10, md_price, lo, hi FROM
        (SELECT *, row_number() OVER (PARTITION BY style_cd, sales_date ORDER BY md10, prod_code) AS rn FROM skub) z
      WHERE rn = 1)
SELECT x.style_cd, x.sales_date, count(y.style_cd) AS num_styles_in_group,
       CAST(sum(CASE WHEN y.md10 < 10 THEN 1 ELSE 0 END) AS BIGINT) AS num_styles_on_sale_in_group,
       CAST(sum(CASE WHEN y.md10 < x.md10 THEN 1 ELSE 0 END) AS BIGINT) AS num_styles_lower_MD_in_group
FROM d x LEFT JOIN d y ON y.sales_date = x.sales_date AND y.grp = x.grp AND y.md_price BETWEEN x.lo AND x.hi
GROUP BY x.style_cd, x.sales_date""")
def price_band_competitors(spark, sf_dir):
    """Styles in the group and price band on the same date (all / on sale / lower md)."""
    return cp.price_band_competitors(_sku(spark, sf_dir))


@register("inventory_advantage", sql=f"""
WITH {SKUB},
own AS (SELECT prod_code, sales_date, count(*) AS n, min(inv_qty) AS inv, min(md_price) AS p, min(md1) AS m
        FROM skub GROUP BY prod_code, sales_date),
band AS (SELECT x.prod_code, x.sales_date, sum(y.inv_qty) AS si, sum(y.md_price * y.inv_qty) AS sa,
                sum(y.md10 * y.inv_qty) / 10.0 AS sm
         FROM skub x JOIN skub y ON y.sales_date = x.sales_date - {LEAD} AND y.grp = x.grp
                                AND y.md_price BETWEEN x.lo AND x.hi
         GROUP BY x.prod_code, x.sales_date)
SELECT x.prod_code, x.sales_date,
  CASE WHEN b.si > 0 AND o.n = 1 THEN o.inv / b.si END AS inv_adv,
  CASE WHEN b.si > 0 AND o.n = 1 THEN o.inv * o.p / b.sa END AS AUR_inv_adv,
  CASE WHEN b.si > 0 AND o.n = 1 THEN o.inv * o.m / b.sm END AS md_inv_adv
FROM skub x
LEFT JOIN own o ON o.prod_code = x.prod_code AND o.sales_date = x.sales_date - {LEAD}
LEFT JOIN band b ON b.prod_code = x.prod_code AND b.sales_date = x.sales_date""")
def inventory_advantage(spark, sf_dir):
    """Inventory shares in the price band, lead days back."""
    return cp.inventory_advantage(_sku(spark, sf_dir), LEAD)


def _asof_sql(source: str) -> str:
    return f"""
WITH {SKUB.replace("skub AS (", "skub AS MATERIALIZED (")},
src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prod_code, md10, sales_date
                                                    ORDER BY sales_amt) AS rn FROM skub WHERE {source}) z WHERE rn = 1),
t AS (SELECT prod_code, md10, sales_date, grp, lo, hi, sales_date - {LEAD} AS probe FROM skub),
-- the population by (date, group, price): what the bands are summed over
pop AS MATERIALIZED (SELECT sales_date, grp, md_price, sum(inv_qty) AS si, sum(md_price * inv_qty) AS sa, sum(md10 * inv_qty) AS sm
        FROM skub GROUP BY sales_date, grp, md_price),
a AS MATERIALIZED (SELECT t.*, s.sales_date AS ad, s.sales_qty AS aq, s.inv_qty AS ainv, s.md_price AS ap, s.md1 AS am
      FROM t ASOF LEFT JOIN src s ON t.prod_code = s.prod_code AND t.md10 = s.md10 AND t.probe >= s.sales_date),
band AS (SELECT a.prod_code, a.sales_date, sum(y.si) AS si, sum(y.sa) AS sa, sum(y.sm) / 10.0 AS sm
         FROM a JOIN pop y ON y.sales_date = a.ad AND y.grp = a.grp AND y.md_price BETWEEN a.lo AND a.hi
         GROUP BY a.prod_code, a.sales_date)
SELECT a.prod_code, a.sales_date, CAST(a.md10 AS DOUBLE) / 10 AS md1, a.aq AS aps_last_md,
       date_diff('day', a.ad, a.probe) AS interval_after_last_md,
       CASE WHEN b.si > 0 THEN a.ainv / b.si END AS inv_adv_last_md,
       CASE WHEN b.si > 0 THEN a.ainv * a.ap / b.sa END AS AUR_inv_adv_last_md,
       CASE WHEN b.si > 0 THEN a.ainv * a.am / b.sm END AS md_inv_adv_last_md
FROM a LEFT JOIN band b ON a.prod_code = b.prod_code AND a.sales_date = b.sales_date"""


@register("asof_last_same_md", sql=_asof_sql("TRUE"))
def asof_last_same_md(spark, sf_dir):
    """J16 + J17: last sale at the same md (as-of, lead days back) and its band shares."""
    return cp.asof_last_same_md(_sku(spark, sf_dir), LEAD)


@register("asof_last_same_md_off_moments", sql=_asof_sql("sales_date NOT IN (SELECT sales_date FROM rm_calendar)"))
def asof_last_same_md_off_moments(spark, sf_dir):
    """P-4 + J16 + J17: the last sale at the same md off the retail moments."""
    return cp.asof_last_same_md(_sku(spark, sf_dir), LEAD, exclude=base.views(spark, sf_dir).rm_calendar())


@register("competitor_days_same_md", sql=f"""
WITH {SKUB},
c AS (SELECT s.*, b.season1 AS cal_season FROM skub s
      JOIN bounds b ON s.sales_date BETWEEN b.season_start AND b.season_end)
SELECT x.prod_code, x.sales_date, CAST(x.md10 AS DOUBLE) / 10 AS md1,
  (SELECT count(DISTINCT y.sales_date) FROM c y
    WHERE y.cal_season = x.cal_season AND y.grp = x.grp AND y.md10 = x.md10 AND y.prod_code <> x.prod_code
      AND y.sales_date < x.sales_date - {LEAD} AND y.md_price BETWEEN x.lo AND x.hi) AS num_days_comp_this_md_inseason
FROM c x""")
def competitor_days_same_md(spark, sf_dir):
    """In-season days a competitor had this md inside the row's band."""
    v = base.views(spark, sf_dir)
    return cp.competitor_days_same_md(_sku(spark, sf_dir), ingest.season_bounds(v.season_calendar()), LEAD)


#: W15's base rows: their attributes and past-7 full-price APS.
COMPETING = {"style_cd": ("style", []), "prod_code": ("sku", ["base_color"])}


def _competing_sql(level: str) -> str:
    table, more = COMPETING[level]
    g = ["sales_date", "gender_group", "gc_category"]
    calls = [("", g, "MSRP", "md", "AUR", True),
             ("", g, "AUR", "MSRP", "past_7_aps", False),
             ("platform", g + ["class_platform"], "AUR", "MSRP", "past_7_aps", False),
             ("pc", g + ["power_item"], "AUR", "MSRP", "past_7_aps", False),
             ("Model", g + ["model"], "AUR", "MSRP", "past_7_aps", False)]
    if level == "prod_code":
        calls.append(("color", g + ["base_color"], "AUR", "MSRP", "past_7_aps", False))
    colour = "substr(s.prod_code, length(s.prod_code) - 2, 1) AS base_color," if more else ""
    ctes = [rolling_ctes(W4_SPECS, SHIFT, "past_{n}_full_price_{stat}_aps", "round_even(md1, 0) > 0.9", table, level),
            f"""cb AS MATERIALIZED (SELECT row_number() OVER () AS r, s.{level}, s.sales_date, s.gender_group, s.gc_category, s.class_platform, {colour}
       coalesce(s.power_item, 'non-power-franchise') AS power_item, s.model, s.MSRP, s.inv_qty,
       s.md1, round_even(s.sales_amt / s.sales_qty, 0) AS AUR,
       coalesce(r.past_7_full_price_avg_aps, 0) AS past_7_aps
  FROM {table} s LEFT JOIN roll r ON s.{level} = r.{level} AND s.sales_date = r.sales_date)"""]
    sel = []
    for i, (name, cols, price, mdc, rank, asc) in enumerate(calls):
        w = "md1" if mdc == "md" else mdc
        on = " AND ".join(f"y.{c} = x.{c}" for c in cols)
        cmp = "<" if asc else ">"
        pre = f"same_{name}_{price}"
        ctes.append(f"""c{i} AS (
  SELECT x.r, x.{level}, x.sales_date,
         CASE WHEN avg(y.{w} * y.inv_qty) > 0 THEN x.{w} * x.inv_qty / avg(y.{w} * y.inv_qty) ELSE 999.0 END
           AS {pre}_{mdc}_competitiveness,
         count(*) AS {pre}_comp_cnt,
         round_even(sum(CASE WHEN y.{rank} {cmp} x.{rank} THEN 1 ELSE 0 END) / count(*), 2) AS {pre}_{rank}_rank
  FROM cb x JOIN cb y ON {on} AND abs(y.{price} - x.{price}) <= 100
  GROUP BY x.r, x.{level}, x.sales_date, x.{w}, x.inv_qty, x.{rank})""")
        sel.append(f"c{i}.* EXCLUDE (r, {level}, sales_date)")
    joins = "\n".join(f"JOIN c{i} ON c{i}.r = c0.r" for i in range(1, len(calls)))
    return ("WITH " + ",\n".join(ctes) +
            f"\nSELECT c0.{level}, c0.sales_date, {', '.join(sel)}\nFROM c0\n{joins}")


COMPETING_SQL = _competing_sql("style_cd")


def competing_rows(rows, level):
    """Base rows with what W15 compares: price paid and past-7 full-price APS."""
    rows = cp.aur(rows)
    w4 = tf.rolling_full_price(rows, level, SHIFT).select(level, "sales_date", F.col("past_7_full_price_avg_aps").alias("past_7_aps"))
    return rows.join(w4, [level, "sales_date"], "left")


def _competing(rows, level):
    x = cp.competing_features(competing_rows(rows, level), level)
    return x.select(level, "sales_date", *[c for c in x.columns if c.startswith("same_")])


@register("competitive_position", sql=COMPETING_SQL)
def competitive_position(spark, sf_dir):
    """W14 + W15: competitiveness, competitor count and rank position in five
    competitor groups (style level; past-7 full-price APS from W4)."""
    return _competing(base.style_base(base.views(spark, sf_dir)), "style_cd")


@register("competitive_position_sku", sql=_competing_sql("prod_code"))
def competitive_position_sku(spark, sf_dir):
    """W15 at SKU level: the five groups and that of equal base colour."""
    return _competing(base.sku_base(base.views(spark, sf_dir)).withColumn("base_color", sc.base_color()), "prod_code")


@register("inventory_rank", sql="""
SELECT prod_code, sales_date,
  CASE WHEN inv_qty IS NOT NULL THEN round_even(
    (rank() OVER (PARTITION BY sales_date, gender_group ORDER BY inv_qty DESC NULLS LAST)
     + (count(*) OVER (PARTITION BY sales_date, gender_group, inv_qty) - 1) / 2.0)
    / count(inv_qty) OVER (PARTITION BY sales_date, gender_group), 2) END AS inv_qty_rank
FROM sku""")
def inventory_rank(spark, sf_dir):
    """Inventory percent rank within (date, gender), descending."""
    return cp.inventory_rank(base.sku_base(base.views(spark, sf_dir))).select(
        "prod_code", "sales_date", "inv_qty_rank")
