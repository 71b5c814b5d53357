"""Inputs that a fixed list, bound or switch would drop, and the parity rules on
NULL keys and sums of nothing."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricewise.operators import competition as cp
from pricewise.operators import ingest
from pricewise.operators import modeling as md
from pricewise.operators import reports as rp
from pricewise.operators import timefeatures as tf
from pricewise.streaming import increment as inc

D = dt.date(2020, 1, 15)


def test_many_categories_can_be_fitted(spark):
    for n in (100, 400):
        df = spark.range(1200).select(F.concat(F.lit("c"), F.col("id") % n).alias("c"), (F.col("id") % n).cast("double").alias("x"),
                                      F.log1p(F.col("id") % 3).alias("label"))
        model, _ = md.fit_trees(df.withColumn("id", F.monotonically_increasing_id()), ["x"], ["c"], ["id"], max_iter=2, max_depth=3)
        assert model.transform(df).where("prediction is null").count() == 0


def test_categories_are_encoded_alike_at_any_size(spark):
    """Also among many values, one value in 40 of high labels is told from its neighbours in frequency."""
    for n in (100, 2000):
        df = spark.range(30 * n).select(F.concat(F.lit("c"), F.col("id") % n).alias("c"), F.lit(0.0).alias("x"),
                                        F.when(F.col("id") % n % 40 == 7, 9.0).otherwise(0.0).alias("label"))
        model, _ = md.fit_trees(df.withColumn("id", F.monotonically_increasing_id()), ["x"], ["c"], ["id"], max_iter=1, max_depth=3, step=1.0)
        off = model.transform(df).agg(F.max(F.abs(F.col("prediction") - F.col("label")))).first()[0]
        assert off < 0.5
        new = df.limit(1).withColumn("c", F.lit("new"))
        assert model.transform(new).where("prediction is not null").count() == 1


def test_split_follows_the_key(spark):
    df = spark.range(1000).withColumn("d", F.lit(1))
    a = md.split_by_key(df.repartition(3), ["id"], 0.75, 82)
    b = md.split_by_key(df.repartition(7, "id"), ["id"], 0.75, 82)
    ids = [{r.id for r in x.collect()} for x in (*a, *b)]
    assert ids[0] == ids[2] and ids[1] == ids[3] and not ids[0] & ids[1] and 700 < len(ids[0]) < 800


def test_season_rank_has_no_last_year(spark):
    df = spark.createDataFrame([("SP2045",), ("HO2044",), ("FA18",), ("XX2000",), (None,)], "s string")
    got = [r[0] for r in df.select(ingest.season_rank(F.col("s"), 1990)).collect()]
    assert got == [55 * 4, 54 * 4 + 3, 28 * 4 + 2, None, None]


def _styles(spark, rows):
    return spark.createDataFrame([(s, D, g, m, f"{s}-1", p) for s, g, m, p in rows],
                                 "style_cd string, sales_date date, grp string, md10 int, prod_code string, md_price double")


def test_lower_md_counts_any_level(spark):
    df = _styles(spark, [("a", "g", 9, 500.0), ("b", "g", -1, 520.0), ("c", "g", 25, 450.0), ("d", "g", 9, 700.0)])
    got = {r.style_cd: tuple(r)[2:] for r in cp.price_band_competitors(df).collect()}
    assert got == {"a": (3, 2, 1), "b": (3, 2, 0), "c": (3, 2, 2), "d": (1, 1, 0)}


def test_rows_without_group_or_price_have_no_competitors(spark):
    df = _styles(spark, [("a", None, 5, 500.0), ("b", None, 5, 500.0), ("c", "g", 5, None), ("d", "g", 5, 500.0)])
    got = {r.style_cd: tuple(r)[2:] for r in cp.price_band_competitors(df).collect()}
    assert got == {"a": (0, 0, 0), "b": (0, 0, 0), "c": (0, 0, 0), "d": (1, 1, 0)}


def test_band_against_all_pairs(spark):
    import random
    rng = random.Random(4)
    rows = [(f"s{k}", rng.choice("gh"), rng.randint(-2, 11), rng.choice([1900.0, 1950.5, 2000.0, 2050.0, 2299.5, 150.0, 249.9])) for k in range(60)]
    got = {r.style_cd: tuple(r)[2:] for r in cp.price_band_competitors(_styles(spark, rows)).collect()}
    for s, g, m, p in rows:
        half = 100 if p < 2000 else 300
        band = [x for x in rows if x[1] == g and p - half <= x[3] <= p + half]
        assert got[s] == (len(band), sum(x[2] < 10 for x in band), sum(x[2] < m for x in band))


def test_a_busy_day_of_one_group(spark):
    df = spark.range(100_000).select(F.format_string("s%d", "id").alias("style_cd"), F.lit(D).alias("sales_date"), F.lit("g").alias("grp"),
                                     (F.col("id") % 11).cast("int").alias("md10"), F.lit("p").alias("prod_code"),
                                     (F.col("id") % 5000).cast("double").alias("md_price"))
    top = cp.price_band_competitors(df).agg(F.max("num_styles_in_group"), F.count("*")).first()
    assert tuple(top) == (20 * 601, 100_000)


def test_band_width_may_have_decimals(spark):
    df = spark.createDataFrame([("a", 10.0, 1.0), ("b", 10.5, 1.0), ("c", 11.0, 1.0), (None, 10.0, 1.0)], "g string, MSRP double, AUR double") \
        .withColumn("k", F.when(F.col("g").isNotNull(), F.lit("x"))).withColumn("md1", F.lit(1.0)).withColumn("inv_qty", F.lit(1.0))
    got = {r.g: r.same__MSRP_comp_cnt for r in cp.competitive_position(df, ["k"], rng=0.5).collect()}
    assert got == {"a": 2, "b": 3, "c": 2}


def test_ranks_need_a_key(spark):
    df = spark.createDataFrame([(D, "x", 1.0), (D, "x", 3.0), (D, None, 2.0)], "sales_date date, gender_group string, inv_qty double")
    assert {(r.gender_group, r.inv_qty_rank) for r in cp.inventory_rank(df).collect()} == {("x", 1.0), ("x", 0.5), (None, None)}


def test_duplicate_right_keys_fail_when_the_join_runs(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    plan = md.join_checked(left, spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string"), ["k"])
    with pytest.raises(Exception, match="duplicate keys"):
        plan.collect()
    good = md.join_checked(left, spark.createDataFrame([(1, "x")], "k int, w string"), ["k"])
    assert sorted(map(tuple, good.collect())) == [(1, "a", "x"), (2, "b", None)]


def _days(spark, days):
    return spark.createDataFrame([(d, v) for d, v in days], "sales_date date, v int")


@pytest.mark.parametrize("end", [None, "2020-01-20"])
def test_window_on_disk_is_the_window_in_memory(spark, tmp_path, end):
    day = lambda k: dt.date(2020, 1, k)
    old = _days(spark, [(day(k), k) for k in (1, 10, 12, 20, 25)])
    new = _days(spark, [(day(12), 99), (day(26), 98), (day(1), 97)])
    path = str(tmp_path / "t")
    inc.write_date_window(old, path)
    inc.write_date_window(new, path, "2020-01-10", end)
    want = inc.replace_date_window(old, new, "2020-01-10", end)
    assert sorted(map(tuple, spark.read.parquet(path).select("sales_date", "v").collect())) == sorted(map(tuple, want.collect()))


def test_lowest_edge_counts(spark):
    rows = [(float(r), p) for r, p in [(0, 0.0)] * 6 + [(1, 1.0), (2, 2.0), (3, 3.0), (4, 1.0), (5, 1.0), (6, 0.0)]]
    cm = rp.confusion_matrix(spark.createDataFrame(rows, "y double, predict double"), "y", "predict", 15).collect()
    assert sum(r["count"] for r in cm) == 12
    assert sum(r["count"] for r in cm if r.pred_bin == 1) >= 7


def test_sums_of_nothing_are_zero(spark):
    sku = spark.createDataFrame([(D, "s", "SP2020", "Y", "p", None, None, None, None, "g")],
                                "sales_date date, style_cd string, season1 string, inseason_flag1 string, prod_code string, sales_qty double, "
                                "sales_amt double, inv_qty double, md double, grp string")
    assert tuple(tf.style_rollup(sku).select("sales_qty", "sales_amt", "inv_qty", "md").first()) == (0.0, 0.0, 0.0, None)
    scored = spark.createDataFrame([("g", 1.0, 2.0, 0.5, 4.0)], "gender_group string, predict_sales_qty double, AUR double, md double, sales_qty double")
    r = rp.forecast_summary(scored).where("is_total = 1").first()
    assert (r.full_price_qty_share, r.full_price_amt_share) == (0.0, 0.0)


def test_first_days_take_the_season_of_the_row(spark):
    bounds = spark.createDataFrame([("FA2019", dt.date(2019, 7, 1), dt.date(2019, 12, 31)), ("SP2020", dt.date(2020, 1, 1), dt.date(2020, 6, 30))],
                                   "season1 string, season_start date, season_end date")
    df = spark.createDataFrame([("p", "FA2019", dt.date(2020, 1, 5), 10.0, 9, 0.9), ("p", "SP2020", dt.date(2020, 1, 9), 4.0, 9, 0.9),
                                ("q", "SP2020", dt.date(2020, 1, 3), 6.0, 9, 0.9)],
                               "prod_code string, season1 string, sales_date date, sales_qty double, md10 int, md1 double")
    first = {tuple(r) for r in tf.first_dates(df, bounds)["inseason_1st_day"].collect()}
    assert first == {("p", "FA2019", dt.date(2020, 1, 5)), ("q", "SP2020", dt.date(2020, 1, 3))}
    late = df.unionByName(df.withColumn("sales_date", F.lit(dt.date(2020, 6, 1))))
    got = {(r.prod_code, r.season1): r.first_14d_APS for r in tf.first_14d_sales(late, bounds, 5).where("sales_date = '2020-06-01'").collect()}
    assert got == {("p", "FA2019"): 1.0, ("p", "SP2020"): None, ("q", "SP2020"): 0.5}


def test_scratch_folder_is_for_local_runs_only(spark, monkeypatch):
    from pricewise import session
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)

    class Context:
        master = "spark://somewhere"

    class Session:
        sparkContext = Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
