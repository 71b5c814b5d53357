"""States, stages by month, late data and the one-day forecast."""
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pricewise.functions.frames import spine
from pricewise.operators import ingest
from pricewise.operators import modeling as md
from pricewise.operators import state as st
from pricewise.operators import timefeatures as tf
from pricewise.plans import base, q_model
from pricewise.sources import stages
from pricewise.streaming import increment as inc

SF = "/root/testdata/sf0.001"
D0 = dt.date(2020, 1, 1)


def _sales(spark, seed=1, days=60):
    rng = random.Random(seed)
    rows = [(p, D0 + dt.timedelta(days=d), rng.choice("YN"), rng.choice([8, 9, 10]), float(rng.randint(1, 30)))
            for d in range(days) if d not in (31, 40) for p in "abc" for _ in range(rng.choice([0, 1, 1, 2]))]
    return spark.createDataFrame(rows, "style_cd string, sales_date date, inseason_flag1 string, md10 int, sales_qty double")


def _close(a, b):
    return (a is None and b is None) or a == b or abs(a - b) < 1e-9


def _same(got, want):
    got, want = (sorted(map(tuple, x.collect()), key=str) for x in (got, want))
    assert len(got) == len(want) and all(_close(a, b) for x, y in zip(got, want) for a, b in zip(x, y))


def test_states_give_the_features_of_a_full_recompute(spark):
    rows, cut, shift = _sales(spark), "2020-02-05", 7
    new = rows.filter(F.col("sales_date") > cut)
    daily, md_daily = st.days(rows, "style_cd"), st.md_days(rows, "style_cd")
    saved = st.state_of(daily, ["style_cd"], cut)
    since = F.col("sales_date") > cut
    _same(st.days_on_market(new, saved, "style_cd"), tf.days_on_market(rows, "style_cd").filter(since))
    _same(st.historic_md_avg(new.select("style_cd", "sales_date").distinct(), saved, daily.filter(since), "style_cd"),
          tf.historic_md_avg(rows, "style_cd").filter(since))
    early = (dt.date.fromisoformat(cut) - dt.timedelta(days=shift)).isoformat()
    _same(st.same_md_history(new.select("style_cd", "md10", "sales_date").distinct(), st.state_of(md_daily, ["style_cd", "md10"], early),
                             md_daily.filter(F.col("sales_date") > early), spine(rows), "style_cd", shift),
          tf.same_md_history(rows, "style_cd", shift).filter(since))
    # merged in three steps it is the same state
    merged = st.state_of(daily, ["style_cd"], "2020-01-10")
    for a, b in (("2020-01-10", "2020-01-11"), ("2020-01-11", cut)):
        merged = st.merge(merged, st.state_of(daily.filter(F.col("sales_date") > a), ["style_cd"], b), ["style_cd"], b)
    _same(merged, saved)


def test_last_complete_windows(spark):
    rows, day, shift = _sales(spark, 4), dt.date(2020, 2, 25), 5
    known = rows.filter(F.col("sales_date") <= day - dt.timedelta(days=shift))
    specs = [(n, s) for n in (1, 2, 3, 7, 28) for s in ("avg", "max", "std", "median") if n > 1 or s == "avg"]
    targets = spark.createDataFrame([(p, day) for p in "abcd"], "style_cd string, sales_date date")
    want = tf.rolling_sales_stats(rows.filter(F.col("sales_date") < day), targets, "style_cd", specs, shift).drop("sales_date")
    got = st.last_complete_windows(known, spine(known), "style_cd", specs, "past_{n}_{stat}_aps")
    _same(targets.select("style_cd").join(got, "style_cd", "left"), want)


def test_only_the_months_of_a_window_are_read(spark, tmp_path):
    sales = base.stored_sales(spark, SF)
    plan = ingest.scan_sales_window(sales, "1999-08-15", "1999-10-20")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_no" in plan and ">= 199908)" in plan and "<= 199910)" in plan
    stock = ingest.scan_inventory_window(base.stored_inventory(spark, SF), "1999-10-20", 32, ["1-URGENT"], "1999-08-15")
    plan = stock._jdf.queryExecution().executedPlan().toString()
    assert ">= 199907)" in plan and "<= 199909)" in plan
    first, last = stock.agg(F.min("eop_dt"), F.max("eop_dt")).first()
    assert dt.date(1999, 7, 14) <= first < last <= dt.date(1999, 9, 17)
    moments = base.views(spark, SF).rm_calendar()
    plan = ingest.scan_moment_sales(sales, moments)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*month_no#\d+ IN(SET)? ", plan)
    plain = ingest.scan_moment_sales(base.views(spark, SF).sales_trans(), moments)
    _same(ingest.scan_moment_sales(sales, moments).drop("season1"), plain.drop("season1"))
    assert stages.in_months(sales).count() == base.views(spark, SF).sales_trans().count()


def test_late_rows_touch_their_cells_only(spark):
    rows = spark.createDataFrame([(k, D0 + dt.timedelta(days=k % 4), "xyz"[k % 3] if k % 7 else None) for k in range(60)], "id int, sales_date date, g string")
    late = rows.filter("id IN (5, 17, 28)")

    def compute(x):
        return x.withColumn("n", F.count("*").over(st.Window.partitionBy("sales_date", "g")))
    asked = []
    cached = compute(rows.join(late, "id", "left_anti").select(rows.columns).unionByName(
        spark.createDataFrame([(99, D0, "gone")], rows.schema)))
    got = inc.reuse_cells(rows, cached, ["id"], ["sales_date", "g"], lambda x: (asked.append(x.count()), compute(x))[1])
    _same(got, compute(rows))
    cells = {(r.sales_date, r.g) for r in late.collect()}
    assert asked == [sum((r.sales_date, r.g) in cells for r in rows.collect())]
    check = {r.sales_date: (r.rows, r.cached) for r in inc.rows_in_window_count_check(rows, cached).collect()}
    count = {t: {r.sales_date: r["count"] for r in x.groupBy("sales_date").count().collect()} for t, x in (("rows", rows), ("cached", cached))}
    assert check == {d: (n, count["cached"][d]) for d, n in count["rows"].items() if n != count["cached"][d]} and len(check) >= 1


def test_describe(spark):
    df = spark.createDataFrame([(1.0, None, 1), (2.0, None, 1), (4.0, None, 7), (float("nan"), None, None)], "a double, b double, c int")
    got = {r.column_name: tuple(r)[1:] for r in md.describe(df, ["a", "b", "c"]).collect()}
    assert got["b"] == (0, *[None] * 7)
    assert got["a"][:2] == (3, 7 / 3) and got["a"][3:] == (1.0, 1.5, 2.0, 3.0, 4.0) and got["a"][2] == pytest.approx(1.5275252)
    assert got["c"][3:] == (1.0, 1.0, 1.0, 4.0, 7.0)


def test_one_day_forecast(spark):
    scored = q_model.forecast_one_day(spark, SF).collect()
    assert len(scored) == 25 and all(r.sales_date == dt.date(2001, 9, 9) and r.predict >= 0 for r in scored)
    for r in scored:
        want = None if r.past_3_median_aps is None else round(r.past_3_median_aps * r.predict)
        assert r.predict_sales_qty == want
    known = [r.predict_sales_qty for r in scored if r.predict_sales_qty is not None]
    totals = [r["value"] for r in q_model.evaluate_one_day(spark, SF).collect() if r.group_1 == "total" and r.metric == "tot_qty"]
    assert totals == [sum(known) if known else None]
