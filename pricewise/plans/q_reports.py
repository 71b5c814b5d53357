"""Registered plans: scalar features, price buckets, day differences, the
data profile, date-window refresh and forecast reports (F1-F3, P-5, P-11 -
P-14, P-22, P-23, P-28, S10-S12, M6, A15-A18, W22, W23, O3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pricewise.functions import scalars as sc
from pricewise.functions.frames import spine
from pricewise.operators import competition as cp
from pricewise.operators import ingest
from pricewise.operators import modeling as md
from pricewise.operators import moments as mo
from pricewise.operators import reports as rp
from pricewise.operators import state as st
from pricewise.operators import timefeatures as tf
from pricewise.plans import base
from pricewise.plans.catalog import register
from pricewise.plans.q_competition import COMPETING_SQL, competing_rows
from pricewise.plans.q_ingest import MASTER_COLS
from pricewise.plans.q_time import first_in_season, rolling_ctes
from pricewise.session import materialize
from pricewise.sources.fixtures import season_of
from pricewise.sources.stages import MONTH, in_months
from pricewise.streaming import increment as inc

SHIFT = base.SHIFT


@register("color_features", sql="""
WITH lex AS (SELECT list(color) AS lx FROM color_lexicon),
x AS (SELECT s.prod_code, s.sales_date, lower(s.color_desc) AS low,
             string_split(lower(s.color_desc), '/') AS parts FROM sku s),
y AS (SELECT x.*, string_split_regex(parts[1], '[- ]') AS w0, string_split_regex(parts[2], '[- ]') AS w1 FROM x)
SELECT prod_code, sales_date, substr(prod_code, length(prod_code) - 2, 1) AS base_color,
  CASE WHEN len(w0) > 1 THEN array_to_string(list_sort(list_distinct(list_intersect(w0, lx))), ' ') ELSE low END
    AS major_color_desc,
  CASE WHEN len(w1) > 1 THEN array_to_string(list_sort(list_distinct(list_intersect(w1, lx))), ' ') ELSE low END
    AS minor_color_desc
FROM y, lex""")
def color_features(spark, sf_dir):
    """Base colour and major / minor colour words from the lexicon."""
    v = base.views(spark, sf_dir)
    x = sc.with_color_features(base.sku_base(v), v.color_lexicon())
    return x.select("prod_code", "sales_date", "base_color", "major_color_desc", "minor_color_desc")


@register("price_buckets", sql="""
WITH a AS (SELECT style_cd, sales_date, MSRP, round_even(sales_amt / sales_qty, 0) AS AUR FROM style),
m AS (SELECT min(MSRP) AS mn, max(MSRP) AS mx, max(AUR) AS amx FROM a)
SELECT a.style_cd, a.sales_date, a.AUR,
  CASE WHEN MSRP > 0 AND MSRP <= 300 THEN 300 WHEN MSRP > 300 AND MSRP <= 500 THEN 500
       WHEN MSRP > 500 AND MSRP <= 700 THEN 700 WHEN MSRP > 700 AND MSRP <= 1000 THEN 1000
       WHEN MSRP > 1000 AND MSRP <= m.mx THEN 3000 END AS price_band,
  CASE WHEN AUR > 0 AND AUR <= 200 THEN 200 WHEN AUR > 200 AND AUR <= 400 THEN 400
       WHEN AUR > 400 AND AUR <= 600 THEN 600 WHEN AUR > 600 AND AUR <= 800 THEN 800
       WHEN AUR > 800 AND AUR <= 1000 THEN 1000 WHEN AUR > 1000 AND AUR <= m.amx THEN 3000 END AS AUR_band,
  (MSRP - m.mn) / (m.mx - m.mn) AS MSRP_pos
FROM a, m""")
def price_buckets(spark, sf_dir):
    """P-11 + P-13 + P-14: AUR, right-closed MSRP / AUR bands, MSRP position."""
    x = sc.price_buckets(cp.aur(base.style_base(base.views(spark, sf_dir))))
    return x.select("style_cd", "sales_date", "AUR", "price_band", "AUR_band", "MSRP_pos")


@register("days_since_columns", sql=f"""
WITH f AS (SELECT prod_code, min(sales_date) AS first_sales_date FROM sku GROUP BY 1),
i AS (SELECT prod_code, season1, d AS inseason_1st_day FROM {first_in_season("prod_code")} q),
m AS (SELECT prod_code, md10, season1, d AS this_md_first_day FROM {first_in_season("prod_code", "md10")} q),
rs AS (SELECT ((CASE quarter(sales_date) WHEN 1 THEN 'SP' WHEN 2 THEN 'SU' WHEN 3 THEN 'FA' ELSE 'HO' END)
               || CAST(year(sales_date) AS VARCHAR)) AS season1, sales_date AS rm_start
       FROM rm_calendar WHERE rm_name = '99' AND day_number = 1)
SELECT s.prod_code, s.sales_date,
  date_diff('day', i.inseason_1st_day, s.sales_date) AS days_from_inseason_1st_day,
  date_diff('day', f.first_sales_date, s.sales_date) AS days_from_hist_1st_day,
  date_diff('day', m.this_md_first_day, s.sales_date) AS days_from_this_md_first_day,
  date_diff('day', b.season_start, s.sales_date) AS days_from_season_begins,
  CASE WHEN s.sales_date IN (SELECT rm_start FROM rs) THEN 1 ELSE 0 END AS is_rm,
  CAST(date_diff('day', rs.rm_start, s.sales_date) AS DOUBLE) AS days_since_rm
FROM sku s
LEFT JOIN f ON f.prod_code = s.prod_code
LEFT JOIN i ON i.prod_code = s.prod_code AND i.season1 = s.season1
LEFT JOIN m ON m.prod_code = s.prod_code AND m.md10 = s.md10 AND m.season1 = s.season1
LEFT JOIN bounds b ON b.season1 = s.season1
LEFT JOIN rs ON rs.season1 = s.season1""")
def days_since_columns(spark, sf_dir):
    """P-22 + P-23: day differences to first days and season / RM starts."""
    v = base.views(spark, sf_dir)
    sku = base.sku_base(v)
    bounds = ingest.season_bounds(v.season_calendar())
    d = tf.first_dates(sku, bounds)
    x = (sku.join(d["first_sales_date"], "prod_code", "left")
         .join(d["inseason_1st_day"], ["prod_code", "season1"], "left")
         .join(d["this_md_first_day"], ["prod_code", "md10", "season1"], "left"))
    x = sc.days_since_columns(x, bounds)
    rm = v.rm_calendar().filter((F.col("rm_name") == "99") & (F.col("day_number") == 1))
    season_rm = rm.select(season_of(F.col("sales_date")).alias("season1"), F.col("sales_date").alias("rm_start"))
    x = mo.days_from_moment(x, season_rm)
    return x.select("prod_code", "sales_date", "days_from_inseason_1st_day", "days_from_hist_1st_day",
                    "days_from_this_md_first_day", "days_from_season_begins", "is_rm", "days_since_rm")


_PROFILE_COLS = [c for c in MASTER_COLS]


@register("null_profile", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate FROM master"
    for c in _PROFILE_COLS))
def null_profile(spark, sf_dir):
    """P-28: null rate per column of the data master (one pass + unpivot)."""
    m = base.master(base.views(spark, sf_dir)).select(*_PROFILE_COLS)
    return md.null_rates(m)


FILTER_SEASONS = ["FA1999", "FA2000", "SU2001", "FA2001"]
P5_DROP = ["platform", "color_desc", "sales_amt", "division", "style_number", "season1"]
P5_KEEP = [c for c in MASTER_COLS if c not in P5_DROP]


@register("filter_modeling_rows", sql=f"""
SELECT {', '.join(P5_KEEP)} FROM master
WHERE season1 IN ({', '.join(f"'{s}'" for s in FILTER_SEASONS)}) AND inseason_flag1 = 'Y'
  AND sales_date NOT IN (SELECT sales_date FROM rm_calendar) AND md <= 0.95""")
def filter_modeling_rows(spark, sf_dir):
    """P-5: training seasons, in-season only, RM dates removed, md <= 0.95, columns dropped."""
    v = base.views(spark, sf_dir)
    x = md.filter_modeling_rows(base.master(v).select(*MASTER_COLS), FILTER_SEASONS, v.rm_calendar(),
                                drop=P5_DROP)
    return x.select(*P5_KEEP)


REFRESH_FROM = "2000-01-01"


@register("refresh_days_on_market", sql="""
SELECT a.prod_code, a.sales_date, count(*) AS num_days_on_mkt,
       CAST(sum(CASE WHEN b.inseason_flag1 = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS num_days_on_mkt_inseason
FROM sku a JOIN sku b ON a.prod_code = b.prod_code AND b.sales_date <= a.sales_date
GROUP BY a.prod_code, a.sales_date""")
def refresh_days_on_market(spark, sf_dir):
    """S10 + S11 + S12: a feature table saved before the increment (dates before the
    high-water mark) and the state saved with it; the new window's features come from
    that state and the window's rows alone, and are spliced in. Equals a full
    recompute."""
    sku = base.stored_sku(spark, sf_dir)
    stock = _before(sku)
    old = tf.days_on_market(stock)
    mark = ingest.increment_bounds(stock).first()["data_to_date"].isoformat()
    saved = materialize(st.state_of(st.days(stock, "prod_code"), ["prod_code"], mark), "state")
    new = st.days_on_market(_since(sku, mark), saved, "prod_code")
    return inc.replace_date_window(old, new, REFRESH_FROM)


def _before(sku):
    return in_months(sku, last=REFRESH_FROM).drop(MONTH).filter(F.col("sales_date") < F.lit(REFRESH_FROM).cast("date"))


def _since(sku, day):
    """Rows after a day, from the months since only."""
    return in_months(sku, first=day).drop(MONTH).filter(F.col("sales_date") > F.lit(day).cast("date"))


@register("refresh_md_history", sql=f"""
WITH d AS (SELECT prod_code, md10, sales_date, avg(sales_qty) AS v, count(*) AS n FROM sku GROUP BY 1, 2, 3),
day AS (SELECT prod_code, sales_date, avg(md10) AS m FROM sku GROUP BY 1, 2),
sp AS (SELECT DISTINCT sales_date AS g FROM sku)
SELECT t.prod_code, t.md10, t.sales_date, CASE WHEN g IS NOT NULL THEN max(s.v) END AS same_md_hist_max_aps,
  CASE WHEN g IS NOT NULL THEN min(s.v) END AS same_md_hist_min_aps, CASE WHEN g IS NOT NULL THEN sum(s.v) / sum(s.n) END AS same_md_hist_mean_aps,
  any_value(h.hist_md_avg) AS hist_md_avg
FROM d t LEFT JOIN d s ON s.prod_code = t.prod_code AND s.md10 = t.md10 AND s.sales_date <= t.sales_date - {SHIFT}
LEFT JOIN sp ON sp.g = t.sales_date - {SHIFT}
LEFT JOIN (SELECT prod_code, sales_date, avg(m) OVER (PARTITION BY prod_code ORDER BY sales_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) / 10.0
           AS hist_md_avg FROM day) h ON h.prod_code = t.prod_code AND h.sales_date = t.sales_date
WHERE t.sales_date >= DATE '{REFRESH_FROM}' GROUP BY t.prod_code, t.md10, t.sales_date, g""")
def refresh_md_history(spark, sf_dir):
    """S10 + W7 + W9 of an increment: states as of the high-water mark, and of ``SHIFT`` days
    before it, give the new window's features with no rows of the history but those of
    the last ``SHIFT`` days. The later state is the earlier one merged with the days
    between."""
    sku = base.stored_sku(spark, sf_dir)
    stock, key = _before(sku), ["prod_code", "md10"]
    mark = ingest.increment_bounds(stock).first()["data_to_date"]
    early, mark = (mark - dt.timedelta(days=SHIFT)).isoformat(), mark.isoformat()
    saved_md = materialize(st.state_of(st.md_days(stock, "prod_code"), key, early), "state")
    first = st.state_of(st.days(stock, "prod_code"), ["prod_code"], early)
    later = st.days(_since(sku, early).filter(F.col("sales_date") <= F.lit(mark).cast("date")), "prod_code")
    saved = materialize(st.merge(first, st.state_of(later, ["prod_code"], mark), ["prod_code"], mark), "state")
    recent, new = _since(sku, early), _since(sku, mark)
    dates = spine(sku)  # a date each: calendar-bounded
    md = st.same_md_history(new.select(*key, "sales_date").distinct(), saved_md, st.md_days(recent, "prod_code"), dates, "prod_code", SHIFT)
    avg = st.historic_md_avg(new.select("prod_code", "sales_date").distinct(), saved, st.days(new, "prod_code"), "prod_code")
    return md.join(avg, ["prod_code", "sales_date"], "left")


LATE = "sales_date < DATE '2000-01-01' AND style_cd IN ('000012', '000031') AND day(sales_date) < 4"


@register("competing_features_late_rows", sql=COMPETING_SQL)
def competing_features_late_rows(spark, sf_dir):
    """S14 + S15: competitor features cached before late rows came; only the (date, group)
    cells they touch are computed anew. Equals a full recompute."""
    rows = materialize(competing_rows(base.style_base(base.views(spark, sf_dir)), "style_cd"), "competing-rows")
    cells = ["sales_date", "gender_group", "gc_category"]
    keys = ["style_cd", "sales_date", "season1", "inseason_flag1"]

    def compute(x):
        return cp.competing_features(x, "style_cd")
    done = compute(rows.filter(f"NOT ({LATE})"))
    names = [c for c in done.columns if c.startswith("same_")]
    cached = materialize(done.select(*keys, *cells[1:], *names), "cached")
    known = rows.dropna(subset=cells)
    return inc.reuse_cells(known, cached, keys, cells, compute).select("style_cd", "sales_date", *names)


@register("cached_rows_check", sql=f"""
WITH g AS (SELECT * FROM style WHERE gc_category IS NOT NULL)
SELECT sales_date, count(*) AS rows, count(*) FILTER (NOT ({LATE})) AS cached FROM g GROUP BY sales_date HAVING rows <> cached""")
def cached_rows_check(spark, sf_dir):
    """S15's check: dates on which late rows make the cache and the data differ."""
    rows = base.style_base(base.views(spark, sf_dir)).filter("gc_category IS NOT NULL").select("style_cd", "sales_date")
    rows = materialize(rows, "late-rows")
    return inc.rows_in_window_count_check(rows, rows.filter(f"NOT ({LATE})"))


_NUMERIC = ["sales_qty", "sales_amt", "MSRP", "md", "inv_qty"]


@register("describe_profile", sql="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS p25,
  median({c}) AS p50, quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM master""" for c in _NUMERIC))
def describe_profile(spark, sf_dir):
    """P-28: counts, moments and exact quartiles of the data master's numeric columns."""
    return md.describe(base.master(base.views(spark, sf_dir)), _NUMERIC)


# --------------------------------------------------------------- reports
SCORED = rolling_ctes([(7, "avg")], SHIFT, "past_{n}_{stat}_aps") + """,
sc AS (SELECT s.*, round_even(s.sales_amt / s.sales_qty, 0) AS AUR,
              round_even(r.past_7_avg_aps, 0) AS predict_sales_qty
       FROM style s JOIN roll r ON r.style_cd = s.style_cd AND r.sales_date = s.sales_date
       WHERE r.past_7_avg_aps IS NOT NULL),
m AS (SELECT sc.*, round_even(predict_sales_qty, 0) * AUR AS fcst_amt, sales_qty * AUR AS real_amt,
             abs(round_even(predict_sales_qty, 0) / sales_qty - 1) AS MAPE,
             abs(predict_sales_qty - sales_qty) / sales_qty AS MAPE_qty,
             coalesce(abs(round_even(predict_sales_qty, 0) / sales_qty - 1) <= {thr}, false) AS within
      FROM sc)"""


def _scored(spark, sf_dir):
    """Scored table of a baseline forecast (rounded past-7-day APS, shifted):
    the report operators' input, derived from the data."""
    s = cp.aur(base.style_base(base.views(spark, sf_dir)))
    r = tf.rolling_sales_stats(s, s, "style_cd", [(7, "avg")], SHIFT)
    return (s.join(r, ["style_cd", "sales_date"])
            .withColumn("predict_sales_qty", F.rint("past_7_avg_aps"))
            .filter(F.col("predict_sales_qty").isNotNull()))


A15_SQL = """
SELECT gender_group, sum(predict_sales_qty) AS tot_qty, sum(predict_sales_qty * AUR) AS tot_rev,
  sum(CASE WHEN md > 0.8 THEN 1 ELSE 0 END) / count(*) AS full_price_share,
  sum(CASE WHEN md > 0.8 THEN predict_sales_qty ELSE 0 END) / sum(predict_sales_qty) AS full_price_qty_share,
  sum(CASE WHEN md > 0.8 THEN predict_sales_qty * AUR ELSE 0 END) / sum(predict_sales_qty * AUR) AS full_price_amt_share,
  CAST(GROUPING(gender_group) AS INTEGER) AS is_total
FROM sc GROUP BY ROLLUP (gender_group) HAVING GROUPING(gender_group) = 1 OR gender_group IS NOT NULL"""


@register("forecast_summary", sql="WITH " + SCORED.format(thr=0.3) + A15_SQL)
def forecast_summary(spark, sf_dir):
    """Forecast totals and full-price shares, overall and by gender."""
    return rp.forecast_summary(_scored(spark, sf_dir))


A16_SQL = """
SELECT gender_group, gc_category, sum(fcst_amt) AS fcst_amt, sum(real_amt) AS real_amt,
  sum(round_even(predict_sales_qty, 0)) AS predict_sales_qty, sum(sales_qty) AS sales_qty,
  CAST(GROUPING(gc_category) AS INTEGER) AS by_gender,
  sum(fcst_amt) / sum(real_amt) - 1 AS mape_amt,
  sum(round_even(predict_sales_qty, 0)) / sum(sales_qty) - 1 AS mape_qty
FROM m GROUP BY GROUPING SETS ((gender_group), (gender_group, gc_category))
HAVING gender_group IS NOT NULL AND (GROUPING(gc_category) = 1 OR gc_category IS NOT NULL)"""


@register("error_by_group", sql="WITH " + SCORED.format(thr=0.33) + A16_SQL)
def error_by_group(spark, sf_dir):
    """M6 + A16: forecast versus real by gender and by gender x category."""
    return rp.error_by_group(rp.forecast_metrics(_scored(spark, sf_dir), 0.33))


A17_SQL = """
SELECT CASE WHEN within THEN 'within' ELSE 'outside' END AS bucket, sum(real_amt) AS real_amt,
       sum(sales_qty) AS sales_qty, CAST(count(style_cd) AS DOUBLE) AS n_rows
FROM m GROUP BY 1
UNION ALL
SELECT 'share', sum(CASE WHEN within THEN real_amt ELSE 0 END) / sum(real_amt),
       sum(CASE WHEN within THEN sales_qty ELSE 0 END) / sum(sales_qty),
       sum(CASE WHEN within THEN 1.0 ELSE 0 END) / count(style_cd)
FROM m"""


@register("accuracy_share", sql="WITH " + SCORED.format(thr=0.33) + A17_SQL)
def accuracy_share(spark, sf_dir):
    """Amount / qty / rows within the 0.33 error limit, and their share."""
    return rp.accuracy_share(rp.forecast_metrics(_scored(spark, sf_dir), 0.33))


@register("weighted_accuracy", sql="WITH " + SCORED.format(thr=0.3) + """
SELECT median(MAPE_qty) AS median_mape,
       sum(CASE WHEN MAPE_qty <= 0.3 THEN sales_qty ELSE 0 END) / sum(sales_qty) AS qty_share_within,
       sum(CASE WHEN MAPE_qty <= 0.3 THEN 1 ELSE 0 END) / count(*) AS row_share_within
FROM m""")
def weighted_accuracy(spark, sf_dir):
    """Median error and shares within 0.3."""
    return rp.weighted_accuracy(rp.forecast_metrics(_scored(spark, sf_dir), 0.3))


W22_SQL = """,
a AS (SELECT style_cd, sum(sales_qty) AS sales_qty, sum(predict_sales_qty) AS predict_sales_qty
      FROM m GROUP BY style_cd),
b AS (SELECT *, abs(predict_sales_qty / sales_qty - 1) AS MAPE FROM a)
SELECT *, sum(sales_qty) OVER w / sum(sales_qty) OVER () AS cum_prct,
       median(MAPE) OVER w AS median_mape,
       CAST(sum(sales_qty) OVER w / sum(sales_qty) OVER () <= 0.3 AS INTEGER) AS in_top_share
FROM b WINDOW w AS (ORDER BY sales_qty DESC, style_cd ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@register("cumulative_share", sql="WITH " + SCORED.format(thr=0.33) + W22_SQL)
def cumulative_share(spark, sf_dir):
    """W22 + W23 + O3: top-30% styles by qty, running share and running median error."""
    return rp.cumulative_share(rp.forecast_metrics(_scored(spark, sf_dir), 0.33), "style_cd")


@register("top_share_medians", sql="WITH " + SCORED.format(thr=0.33) + """,
r AS (SELECT MAPE, sum(sales_qty) OVER w / sum(sales_qty) OVER () AS p FROM m
      WINDOW w AS (ORDER BY sales_qty DESC, style_cd, sales_date, season1, inseason_flag1 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
a AS (SELECT style_cd, sum(sales_qty) AS sales_qty, sum(predict_sales_qty) AS predict_sales_qty FROM m GROUP BY style_cd),
b AS (SELECT abs(predict_sales_qty / sales_qty - 1) AS MAPE, sum(sales_qty) OVER w / sum(sales_qty) OVER () AS p FROM a
      WINDOW w AS (ORDER BY sales_qty DESC, style_cd ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT 'row' AS grain, count(*) AS n_rows, median(MAPE) AS median_mape FROM r WHERE p <= 0.3
UNION ALL SELECT 'product', count(*), median(MAPE) FROM b WHERE p <= 0.3""")
def top_share_medians(spark, sf_dir):
    """W22 at row grain + O3: median error of the top 30% of qty, by rows and by styles."""
    return rp.top_share_medians(rp.forecast_metrics(_scored(spark, sf_dir), 0.33), "style_cd",
                                ["style_cd", "sales_date", "season1", "inseason_flag1"])


PROBS = ", ".join(f"{i}.0 / 15" for i in range(16))


def _bin_sql(v: str) -> str:
    return f"CASE WHEN {v} > e[1] - 0.001 AND {v} <= e[len(e)] THEN greatest(1, len(list_filter(e, lambda x: x < {v}))) END"


@register("confusion_matrix", sql="WITH " + SCORED.format(thr=0.33) + f""",
ed AS (SELECT list_sort(list_distinct(quantile_cont(round_even(sales_qty, 0), [{PROBS}]))) AS e FROM sc),
bn AS (SELECT CAST({_bin_sql("round_even(sales_qty, 0)")} AS INTEGER) AS real_bin, CAST({_bin_sql("predict_sales_qty")} AS INTEGER) AS pred_bin
       FROM sc CROSS JOIN ed),
ct AS (SELECT real_bin, pred_bin, count(*) AS count FROM bn WHERE real_bin IS NOT NULL AND pred_bin IS NOT NULL GROUP BY 1, 2)
SELECT *, sum(CASE WHEN real_bin = pred_bin THEN count ELSE 0 END) OVER () / sum(count) OVER () AS diag_share FROM ct""")
def confusion_matrix(spark, sf_dir):
    """A19 on the baseline forecast: 15 quantile bins of real qty against the forecast's."""
    return rp.confusion_matrix(_scored(spark, sf_dir), "sales_qty", "predict_sales_qty", 15)


# ------------------------------------------------------------ one report set
def _long_sql(report: str, source: str, one: str, two: str, values) -> str:
    return "\nUNION ALL ".join(f"SELECT '{report}' AS report, {one} AS group_1, {two} AS group_2, '{v}' AS metric, CAST({v} AS DOUBLE) AS value FROM {source}"
                               for v in values)


@register("evaluate_forecast", sql="WITH " + SCORED.format(thr=0.33) + f""",
s15 AS ({A15_SQL})
{_long_sql("summary", "s15", "CASE WHEN is_total = 1 THEN 'total' ELSE gender_group END", "NULL", rp.SUMMARY)}""")
def evaluate_forecast(spark, sf_dir):
    """M10 of a real forecast: A15 in long form, on the baseline's scored table."""
    return rp.evaluate_report(_scored(spark, sf_dir), True, "style_cd", _ROW_KEYS)


_ROW_KEYS = ["style_cd", "sales_date", "season1", "inseason_flag1"]
_W22_BODY = W22_SQL[W22_SQL.index("SELECT *, sum"):]


@register("evaluate_report", sql="WITH " + SCORED.format(thr=0.33) + f""",
s16 AS ({A16_SQL}), s17 AS ({A17_SQL}){W22_SQL[:W22_SQL.index("SELECT *, sum")].rstrip()}, s22 AS ({_W22_BODY}),
r AS (SELECT MAPE, sum(sales_qty) OVER w / sum(sales_qty) OVER () AS p FROM m
      WINDOW w AS (ORDER BY sales_qty DESC, style_cd, sales_date, season1, inseason_flag1 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s3 AS (SELECT 'row' AS grain, median(MAPE) AS median_mape FROM r WHERE p <= 0.3
       UNION ALL SELECT 'product', median(MAPE) FROM s22 WHERE in_top_share = 1)
{_long_sql("error", "s16", "gender_group", "gc_category", rp.ERRORS)}
UNION ALL {_long_sql("accuracy", "s17", "bucket", "NULL", rp.ACCURACY)}
UNION ALL {_long_sql("product", "s22", "style_cd", "NULL", rp.PRODUCTS)}
UNION ALL {_long_sql("top_share", "s3", "grain", "NULL", ["median_mape"])}""")
def evaluate_report(spark, sf_dir):
    """M10 of a back-test: M6 + A16 + A17 + W22 + W23 + O3 in long form, on the baseline's
    scored table."""
    return rp.evaluate_report(_scored(spark, sf_dir), False, "style_cd", _ROW_KEYS)
