"""Date-window refresh: splicing a recomputed window gives the full recompute;
cached rows are reused inside the cached range."""
import datetime as dt

from pyspark.sql import functions as F

from pricewise.operators import timefeatures as tf
from pricewise.streaming import increment as inc


def _rows(spark):
    d0 = dt.date(2020, 1, 1)
    rows = [(p, d0 + dt.timedelta(days=i), "Y" if i % 3 else "N") for p in ("a", "b") for i in range(0, 30, 2)]
    return spark.createDataFrame(rows, "prod_code string, sales_date date, inseason_flag1 string")


def test_replace_window_equals_full_recompute(spark):
    df = _rows(spark)
    old = tf.days_on_market(df.filter(F.col("sales_date") < "2020-01-15"))
    new = tf.days_on_market(df)
    spliced = inc.replace_date_window(old, new, "2020-01-15", "2020-12-31")
    assert sorted(spliced.collect()) == sorted(new.collect())


def test_reuse_cached_inside_range(spark):
    df = _rows(spark)
    full = tf.days_on_market(df)
    cached = full.filter(F.col("sales_date") <= "2020-01-10")
    out = inc.reuse_cached(df.select("prod_code", "sales_date", "inseason_flag1"), cached,
                           ["prod_code", "sales_date"],
                           lambda rows: rows.join(tf.days_on_market(df), ["prod_code", "sales_date"]))
    got = sorted((r.prod_code, r.sales_date, r.num_days_on_mkt) for r in out.collect())
    exp = sorted((r.prod_code, r.sales_date, r.num_days_on_mkt) for r in full.collect())
    assert got == exp
