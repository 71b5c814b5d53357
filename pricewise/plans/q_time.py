"""Registered plans: season aggregates and time-window features (A5-A10,
W1-W13, W18, J19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewise.operators import ingest
from pricewise.operators import timefeatures as tf
from pricewise.plans import base
from pricewise.plans.catalog import register
from pricewise.sources.fixtures import season_of

LEAD = base.LEAD
SHIFT = base.SHIFT
FIRST_YEAR = 1990   # the season ordinals count from SP1990


def _sku(spark, sf_dir):
    return base.sku_base(base.views(spark, sf_dir))


def _style(spark, sf_dir):
    return base.style_base(base.views(spark, sf_dir))


def _bounds(spark, sf_dir):
    return ingest.season_bounds(base.views(spark, sf_dir).season_calendar())


STYLE_COLS = ["sales_date", "style_cd", "season1", "inseason_flag1", "sales_qty", "sales_amt",
              "inv_qty", "md", "platform", "MSRP", "prod_code", "style_number", "division",
              "gender_group", "gc_category", "model", "class_platform", "power_item", "color_desc", "grp"]


@register("style_rollup_by_amount", sql="""
SELECT g.*, b.gender_group, b.gc_category, b.season1 FROM (
  SELECT sales_date, style_cd, inseason_flag1, sum(sales_qty) AS sales_qty, sum(sales_amt) AS sales_amt, coalesce(sum(inv_qty), 0) AS inv_qty,
         median(MSRP) AS MSRP, round_even(sum(round_even(md * 100, 0)) / count(md) / 100.0 * 10, 0) / 10 AS md1
  FROM sku GROUP BY 1, 2, 3) g
JOIN (SELECT *, row_number() OVER (PARTITION BY sales_date, style_cd, inseason_flag1 ORDER BY sales_amt DESC, prod_code DESC) AS rn FROM sku) b
  ON b.rn = 1 AND b.sales_date = g.sales_date AND b.style_cd = g.style_cd AND b.inseason_flag1 = g.inseason_flag1""")
def style_rollup_by_amount(spark, sf_dir):
    """A5, second form: by (date, style, flag), median MSRP, attributes of the largest amount."""
    return tf.style_rollup_by_amount(base.sku_base(base.views(spark, sf_dir)))


@register("style_rollup", sql=f"SELECT {', '.join(STYLE_COLS)} FROM style")
def style_rollup(spark, sf_dir):
    """A5 + O2: style-level daily rollup with the best-selling SKU's attributes."""
    return _style(spark, sf_dir).select(*STYLE_COLS)


@register("sku_count_in_style", sql="""
SELECT r.season1, r.sales_date, r.style_cd, sn.same_style_sku_num_sn, dt.same_style_sku_num_dt
FROM (SELECT DISTINCT season1, sales_date, style_cd FROM sku) r
JOIN (SELECT season1, style_cd, count(DISTINCT prod_code) AS same_style_sku_num_sn FROM sku GROUP BY 1, 2) sn
  ON r.season1 = sn.season1 AND r.style_cd = sn.style_cd
JOIN (SELECT sales_date, style_cd, count(DISTINCT prod_code) AS same_style_sku_num_dt FROM sku GROUP BY 1, 2) dt
  ON r.sales_date = dt.sales_date AND r.style_cd = dt.style_cd""")
def sku_count_in_style(spark, sf_dir):
    """SKUs per style this season / this date."""
    sku = _sku(spark, sf_dir)
    rows = sku.select("season1", "sales_date", "style_cd").distinct()
    return (rows.join(tf.sku_count_in_style(sku, "season"), ["season1", "style_cd"])
            .join(tf.sku_count_in_style(sku, "date"), ["sales_date", "style_cd"]))


@register("season_bounds", sql="SELECT season1, season_start, season_end FROM bounds")
def season_bounds(spark, sf_dir):
    """First / last calendar day per season."""
    return _bounds(spark, sf_dir)


@register("seasons_to_date", sql="""
SELECT t.prod_code, t.season1,
  (SELECT count(DISTINCT s.season1) FROM sku s
    WHERE s.prod_code = t.prod_code AND s.sales_date <= b.season_end) AS num_seasons,
  (SELECT NULLIF(count(DISTINCT s.season1), 0) FROM sku s
    WHERE s.prod_code = t.prod_code AND s.sales_date <= b.season_end AND s.inseason_flag1 = 'Y') AS num_inseasons
FROM (SELECT DISTINCT prod_code, season1 FROM sku) t JOIN bounds b ON t.season1 = b.season1""")
def seasons_to_date(spark, sf_dir):
    """A7 + A8: distinct seasons (and in-season seasons) sold up to each season's end."""
    sku, bounds = _sku(spark, sf_dir), _bounds(spark, sf_dir)
    a7 = tf.seasons_to_date(sku, bounds)
    a8 = tf.seasons_to_date(sku, bounds, inseason_only=True)
    a8 = a8.withColumn("num_inseasons", F.when(F.col("num_inseasons") > 0, F.col("num_inseasons")))
    return a7.join(a8, ["prod_code", "season1"])


def first_in_season(*keys: str) -> str:
    """SQL for the first row of the keys in each calendar season: the keys, the
    row's season1, and its date d."""
    k = ", ".join(keys)
    of_x = ", ".join(f"x.{c}" for c in keys)
    return f"""(SELECT {k}, season1, min(sales_date) AS d FROM
    (SELECT {of_x}, x.season1, x.sales_date,
            row_number() OVER (PARTITION BY {of_x}, b.season1 ORDER BY x.sales_date, x.season1) AS rn
     FROM sku x JOIN bounds b ON x.sales_date BETWEEN b.season_start AND b.season_end) z
  WHERE rn = 1 GROUP BY {k}, season1)"""


@register("first_dates", sql=f"""
SELECT s.prod_code, s.sales_date, s.md1, f.first_sales_date, i.d AS inseason_1st_day, m.d AS this_md_first_day
FROM sku s
LEFT JOIN (SELECT prod_code, min(sales_date) AS first_sales_date FROM sku GROUP BY 1) f
  ON s.prod_code = f.prod_code
LEFT JOIN {first_in_season("prod_code")} i ON s.prod_code = i.prod_code AND s.season1 = i.season1
LEFT JOIN {first_in_season("prod_code", "md10")} m
  ON s.prod_code = m.prod_code AND s.md10 = m.md10 AND s.season1 = m.season1""")
def first_dates(spark, sf_dir):
    """A10: first sale date; first in-season day; first day at this md in season."""
    sku, bounds = _sku(spark, sf_dir), _bounds(spark, sf_dir)
    d = tf.first_dates(sku, bounds)
    return (sku.select("prod_code", "sales_date", "md1", "md10", "season1")
            .join(d["first_sales_date"], "prod_code", "left")
            .join(d["inseason_1st_day"], ["prod_code", "season1"], "left")
            .join(d["this_md_first_day"], ["prod_code", "md10", "season1"], "left")
            .select("prod_code", "sales_date", "md1", "first_sales_date", "inseason_1st_day",
                    "this_md_first_day"))


@register("first_14d_sales", sql=f"""
SELECT r.prod_code, r.sales_date, r.season1,
  CASE WHEN r.sales_date BETWEEN rb.season_start AND rb.season_start + {13 + LEAD} THEN NULL
       ELSE e.first_14d_APS END AS first_14d_APS,
  CASE WHEN r.sales_date BETWEEN rb.season_start AND rb.season_start + {13 + LEAD} THEN NULL
       ELSE e.first_14d_avg_md END AS first_14d_avg_md
FROM (SELECT DISTINCT prod_code, sales_date, season1 FROM sku) r
LEFT JOIN bounds rb ON r.sales_date BETWEEN rb.season_start AND rb.season_end
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prod_code, season1 ORDER BY season_start) AS rn FROM (
  SELECT s.prod_code, s.season1, b.season_start,
         sum(s.sales_qty) / max(date_diff('day', f.d, b.season_start + 14)) AS first_14d_APS,
         avg(s.md1) AS first_14d_avg_md
  FROM sku s JOIN bounds b ON s.sales_date BETWEEN b.season_start AND b.season_start + 13
  LEFT JOIN {first_in_season("prod_code")} f ON f.prod_code = s.prod_code AND f.season1 = s.season1
  GROUP BY s.prod_code, s.season1, b.season_start) y) z WHERE rn = 1) e
  ON r.prod_code = e.prod_code AND r.season1 = e.season1""")
def first_14d_sales(spark, sf_dir):
    """A9 + P-20: first-14-day APS and md per (product, season), masked in the gap days."""
    return tf.first_14d_sales(_sku(spark, sf_dir), _bounds(spark, sf_dir), LEAD)


@register("days_on_market", sql="""
SELECT a.prod_code, a.sales_date, count(*) AS num_days_on_mkt,
       CAST(sum(CASE WHEN b.inseason_flag1 = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS num_days_on_mkt_inseason
FROM sku a JOIN sku b ON a.prod_code = b.prod_code AND b.sales_date <= a.sales_date
GROUP BY a.prod_code, a.sales_date""")
def days_on_market(spark, sf_dir):
    """On-market days to date, and in-season ones."""
    return tf.days_on_market(_sku(spark, sf_dir))


@register("inseason_md_stats", sql=f"""
SELECT a.prod_code, a.sales_date, a.md1,
  (SELECT avg(b.sales_qty) FROM sku b WHERE b.prod_code = a.prod_code AND b.md10 = a.md10
     AND b.sales_date >= s.season_start AND b.sales_date <= a.sales_date - {LEAD}) AS inseason_APS_this_md,
  (SELECT count(*) FROM sku b WHERE b.prod_code = a.prod_code AND b.md10 = a.md10
     AND b.sales_date >= s.season_start AND b.sales_date <= a.sales_date - {LEAD}) AS num_days_this_md_inseason
FROM sku a JOIN bounds s ON a.sales_date BETWEEN s.season_start AND s.season_end""")
def inseason_md_stats(spark, sf_dir):
    """W10 + W12: in-season APS and day count at this md up to date - lead."""
    return tf.inseason_md_window(_sku(spark, sf_dir), _bounds(spark, sf_dir), LEAD)


def _rank_sql(season_expr: str) -> str:
    y0 = FIRST_YEAR
    return (f"((CAST(substr({season_expr}, 3, 4) AS INTEGER) - {y0}) * 4 + "
            f"CASE substr({season_expr}, 1, 2) WHEN 'SP' THEN 0 WHEN 'SU' THEN 1 "
            f"WHEN 'FA' THEN 2 WHEN 'HO' THEN 3 END)")


_DATE_RANK = f"((year({{d}}) - {FIRST_YEAR}) * 4 + quarter({{d}}) - 1)"


@register("same_md_frequency", sql=f"""
SELECT a.style_cd, a.sales_date, a.md1,
  (SELECT count(*) FROM style b WHERE b.style_cd = a.style_cd AND b.md10 = a.md10
     AND b.sales_date <= a.sales_date) AS same_md_hist_frequency,
  CASE WHEN EXISTS (SELECT 1 FROM style c WHERE {_DATE_RANK.format(d='c.sales_date')} = {_rank_sql('a.season1')} - 1)
       THEN (SELECT count(*) FROM style b WHERE b.style_cd = a.style_cd AND b.md10 = a.md10
               AND b.sales_date <= a.sales_date)
          - (SELECT count(*) FROM style b WHERE b.style_cd = a.style_cd AND b.md10 = a.md10
               AND {_DATE_RANK.format(d='b.sales_date')} <= {_rank_sql('a.season1')} - 1)
  END AS same_md_inseason_freq
FROM style a""")
def same_md_frequency(spark, sf_dir):
    """W5 + W6: running count at this md, and its in-season part (style level)."""
    s = _style(spark, sf_dir)
    s = (s.withColumn("season_rank", ingest.season_rank(F.col("season1"), FIRST_YEAR))
         .withColumn("cal_rank", ingest.season_rank(season_of(F.col("sales_date")), FIRST_YEAR)))
    s = tf.inseason_md_frequency(tf.same_md_frequency(s, "style_cd"), "style_cd", "season_rank", "cal_rank")
    return s.select("style_cd", "sales_date", "md1", "same_md_hist_frequency", "same_md_inseason_freq")


@register("same_md_history", sql=f"""
WITH daily AS (SELECT style_cd, md10, sales_date, avg(sales_qty) AS v, count(*) AS n
               FROM style GROUP BY style_cd, md10, sales_date),
     sp AS (SELECT DISTINCT sales_date AS d FROM style)
SELECT t.style_cd, t.md10, t.sales_date,
  CASE WHEN g.d IS NOT NULL THEN max(s.v) END AS same_md_hist_max_aps,
  CASE WHEN g.d IS NOT NULL THEN min(s.v) END AS same_md_hist_min_aps,
  CASE WHEN g.d IS NOT NULL THEN sum(s.v) / sum(s.n) END AS same_md_hist_mean_aps
FROM daily t
LEFT JOIN daily s ON s.style_cd = t.style_cd AND s.md10 = t.md10 AND s.sales_date <= t.sales_date - {SHIFT}
LEFT JOIN sp g ON g.d = t.sales_date - {SHIFT}
GROUP BY t.style_cd, t.md10, t.sales_date, g.d""")
def same_md_history(spark, sf_dir):
    """Running max / min / mean APS at this md, shifted (style level)."""
    return tf.same_md_history(_style(spark, sf_dir), "style_cd", SHIFT)


@register("inseason_previous_aps", sql=f"""
WITH t AS (SELECT DISTINCT style_cd, md10, sales_date FROM style),
     sd AS (SELECT DISTINCT sales_date AS d, season1 FROM style)
SELECT t.style_cd, t.md10, t.sales_date,
  (SELECT sum(b.sales_qty) / NULLIF(count(*), 0) FROM style b
    WHERE b.style_cd = t.style_cd AND b.md10 = t.md10 AND b.season1 = sd.season1
      AND b.sales_date <= t.sales_date - {SHIFT}) AS inseason_previous_md_aps
FROM t LEFT JOIN sd ON sd.d = t.sales_date - {SHIFT}""")
def inseason_previous_aps(spark, sf_dir):
    """In-season running APS at this md, shifted, season of date - shift (Q6)."""
    return tf.inseason_previous_aps(_style(spark, sf_dir), "style_cd", SHIFT)


@register("historic_md_avg", sql="""
WITH daily AS (SELECT style_cd, sales_date, avg(md10) AS v FROM style GROUP BY style_cd, sales_date)
SELECT t.style_cd, t.sales_date, avg(s.v) / 10.0 AS hist_md_avg
FROM daily t LEFT JOIN daily s ON s.style_cd = t.style_cd AND s.sales_date < t.sales_date
GROUP BY t.style_cd, t.sales_date""")
def historic_md_avg(spark, sf_dir):
    """Mean of past daily md, today excluded (style level)."""
    return tf.historic_md_avg(_style(spark, sf_dir), "style_cd")


@register("historic_max_qty", sql=f"""
WITH daily AS (SELECT style_cd, sales_date, coalesce(sum(sales_qty), 0) AS v FROM style GROUP BY 1, 2),
     sp AS (SELECT DISTINCT sales_date AS d FROM style)
SELECT t.style_cd, t.sales_date, CASE WHEN g.d IS NOT NULL THEN max(s.v) END AS hist_max_qty
FROM daily t
LEFT JOIN daily s ON s.style_cd = t.style_cd AND s.sales_date <= t.sales_date - {LEAD}
LEFT JOIN sp g ON g.d = t.sales_date - {LEAD}
GROUP BY t.style_cd, t.sales_date, g.d""")
def historic_max_qty(spark, sf_dir):
    """Running max of daily qty, lead days back (style level)."""
    return tf.historic_max_qty(_style(spark, sf_dir), "style_cd", LEAD)


def rolling_ctes(specs, shift, name_fmt, where="TRUE", table="style", level="style_cd", out="roll"):
    """DuckDB oracle for W1 as CTEs ending in ``out``: window over the spine
    ordinal, then one ASOF join per window length (last complete window at or
    before date - shift), NULL unless date - shift is a spine date."""
    ns = sorted({n for n, _ in specs})
    fn = {"max": "max", "min": "min", "std": "stddev_samp", "median": "median", "avg": "avg"}
    p = out + "_"
    parts = [f"""{p}src AS (SELECT * FROM {table} WHERE {where}),
{p}sp AS (SELECT sales_date, row_number() OVER (ORDER BY sales_date) AS idx
       FROM (SELECT DISTINCT sales_date FROM {p}src) x),
{p}dd AS (SELECT d.{level}, d.sales_date, d.v, sp.idx
       FROM (SELECT {level}, sales_date, avg(sales_qty) AS v FROM {p}src GROUP BY 1, 2) d
       JOIN {p}sp sp ON d.sales_date = sp.sales_date),
{p}tg AS (SELECT DISTINCT {level}, sales_date, sales_date - {shift} AS probe FROM {table})"""]
    for n in ns:
        cols = ", ".join(f"{fn[s]}(v) OVER w AS {name_fmt.format(n=n, stat=s)}" for m, s in specs if m == n)
        parts.append(f"""{p}r{n} AS (SELECT {level}, sales_date AS d{n}, {cols}, count(v) OVER w AS c
  FROM {p}dd WINDOW w AS (PARTITION BY {level} ORDER BY idx RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)),
{p}f{n} AS (SELECT * FROM {p}r{n} WHERE c = {n})""")
    sel = ", ".join(
        f"CASE WHEN g.sales_date IS NOT NULL THEN f{n}.{name_fmt.format(n=n, stat=s)} END AS {name_fmt.format(n=n, stat=s)}"
        for n, s in specs)
    joins = "\n".join(f"ASOF LEFT JOIN {p}f{n} f{n} ON tg.{level} = f{n}.{level} AND tg.probe >= f{n}.d{n}"
                      for n in ns)
    parts.append(f"""{out} AS (SELECT tg.{level}, tg.sales_date, {sel}
FROM {p}tg tg LEFT JOIN {p}sp g ON g.sales_date = tg.probe
{joins})""")
    return ",\n".join(parts)


def _rolling_sql(specs, shift, name_fmt, where="TRUE"):
    return f"WITH {rolling_ctes(specs, shift, name_fmt, where)}\nSELECT * FROM roll"


W2_SPECS = [(n, s) for n in (1, 3, 7, 14, 21, 28) for s in tf.STATS if n > 1 or s == "avg"]
W3_SPECS = [(n, s) for n in (2, 7, 14) for s in ("max", "min", "std", "avg")]
W4_SPECS = [(n, s) for n in (7, 14) for s in ("std", "avg")]


@register("rolling_all_prices", sql=_rolling_sql(W2_SPECS, SHIFT, "past_{n}_{stat}_aps"))
def rolling_all_prices(spark, sf_dir):
    """W1 + W2 + J19: 26 rolling APS stats over the spine, shifted and filled (style level)."""
    return tf.rolling_all_prices(_style(spark, sf_dir), "style_cd", SHIFT)


@register("rolling_markdown_only",
          sql=_rolling_sql(W3_SPECS, SHIFT, "past_{n}_{stat}_mdaps", "round_even(md1, 0) <= 0.9"))
def rolling_markdown_only(spark, sf_dir):
    """Rolling stats on marked-down rows (Q1 rule of the reference)."""
    return tf.rolling_markdown_only(_style(spark, sf_dir), "style_cd", SHIFT)


@register("rolling_full_price",
          sql=_rolling_sql(W4_SPECS, SHIFT, "past_{n}_full_price_{stat}_aps", "round_even(md1, 0) > 0.9"))
def rolling_full_price(spark, sf_dir):
    """Rolling stats on full-price rows."""
    return tf.rolling_full_price(_style(spark, sf_dir), "style_cd", SHIFT)


@register("markdown_rounds", sql="""
WITH b AS (SELECT style_cd, season1, inseason_flag1, sales_date, md10,
                  md10 - lag(md10) OVER (PARTITION BY style_cd, season1, inseason_flag1 ORDER BY sales_date) AS d
           FROM style WHERE md1 < 1),
c AS (SELECT *, CASE WHEN d IS NOT NULL AND d <> 0 THEN 1 ELSE 0 END AS nw FROM b),
r AS (SELECT *, sum(nw) OVER (PARTITION BY style_cd, season1, inseason_flag1 ORDER BY sales_date
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_round FROM c)
SELECT style_cd, inseason_flag1, sales_date,
       CAST(sum(1 - nw) OVER (PARTITION BY style_cd, season1, inseason_flag1, cum_round ORDER BY sales_date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS round_days,
       CASE WHEN nw = 1 THEN d / 10.0 ELSE 0.0 END AS md_diff,
       CAST(cum_round AS BIGINT) AS cum_round
FROM r""")
def markdown_rounds(spark, sf_dir):
    """Markdown round number and day in round (style level)."""
    return tf.markdown_rounds(_style(spark, sf_dir), "style_cd")


# ------------------------------------------------- retail-moment dates excluded
OFF = "sales_date NOT IN (SELECT sales_date FROM rm_calendar)"


def _moments(spark, sf_dir):
    return base.views(spark, sf_dir).rm_calendar()


@register("rolling_all_prices_off_moments", sql=_rolling_sql(W2_SPECS, SHIFT, "past_{n}_{stat}_aps", OFF))
def rolling_all_prices_off_moments(spark, sf_dir):
    """P-4 + W2: rolling stats over the dates off the retail moments; all rows are targets."""
    return tf.rolling_all_prices(_style(spark, sf_dir), "style_cd", SHIFT, _moments(spark, sf_dir))


@register("same_md_history_off_moments", sql=f"""
WITH every AS (SELECT DISTINCT style_cd, md10, sales_date FROM style),
     daily AS (SELECT style_cd, md10, sales_date, avg(sales_qty) AS v, count(*) AS n
               FROM style WHERE {OFF} GROUP BY style_cd, md10, sales_date),
     sp AS (SELECT DISTINCT sales_date AS d FROM style WHERE {OFF})
SELECT t.style_cd, t.md10, t.sales_date,
  CASE WHEN g.d IS NOT NULL THEN max(s.v) END AS same_md_hist_max_aps,
  CASE WHEN g.d IS NOT NULL THEN min(s.v) END AS same_md_hist_min_aps,
  CASE WHEN g.d IS NOT NULL THEN sum(s.v) / sum(s.n) END AS same_md_hist_mean_aps
FROM every t
LEFT JOIN daily s ON s.style_cd = t.style_cd AND s.md10 = t.md10 AND s.sales_date <= t.sales_date - {SHIFT}
LEFT JOIN sp g ON g.d = t.sales_date - {SHIFT}
GROUP BY t.style_cd, t.md10, t.sales_date, g.d""")
def same_md_history_off_moments(spark, sf_dir):
    """P-4 + W7: running APS at this md off the retail moments; all rows are targets."""
    return tf.same_md_history(_style(spark, sf_dir), "style_cd", SHIFT, _moments(spark, sf_dir))


@register("inseason_previous_aps_off_moments", sql=f"""
WITH t AS (SELECT DISTINCT style_cd, md10, sales_date FROM style),
     src AS (SELECT * FROM style WHERE {OFF}),
     sd AS (SELECT DISTINCT sales_date AS d, season1 FROM src)
SELECT t.style_cd, t.md10, t.sales_date,
  (SELECT sum(b.sales_qty) / NULLIF(count(*), 0) FROM src b
    WHERE b.style_cd = t.style_cd AND b.md10 = t.md10 AND b.season1 = sd.season1
      AND b.sales_date <= t.sales_date - {SHIFT}) AS inseason_previous_md_aps
FROM t LEFT JOIN sd ON sd.d = t.sales_date - {SHIFT}""")
def inseason_previous_aps_off_moments(spark, sf_dir):
    """P-4 + W8: in-season APS at this md off the retail moments; all rows are targets."""
    return tf.inseason_previous_aps(_style(spark, sf_dir), "style_cd", SHIFT, _moments(spark, sf_dir))


@register("inseason_md_stats_off_moments", sql=f"""
SELECT a.prod_code, a.sales_date, a.md1,
  (SELECT avg(b.sales_qty) FROM sku b WHERE b.prod_code = a.prod_code AND b.md10 = a.md10 AND b.{OFF}
     AND b.sales_date >= s.season_start AND b.sales_date <= a.sales_date - {LEAD}) AS inseason_APS_this_md,
  (SELECT count(*) FROM sku b WHERE b.prod_code = a.prod_code AND b.md10 = a.md10
     AND b.sales_date >= s.season_start AND b.sales_date <= a.sales_date - {LEAD}) AS num_days_this_md_inseason
FROM sku a JOIN bounds s ON a.sales_date BETWEEN s.season_start AND s.season_end""")
def inseason_md_stats_off_moments(spark, sf_dir):
    """P-4 + W10 + W12: the mean off the retail moments; the day count over all rows."""
    return tf.inseason_md_window(_sku(spark, sf_dir), _bounds(spark, sf_dir), LEAD, exclude=_moments(spark, sf_dir))
