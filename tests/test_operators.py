"""Operators on small hand-made frames, checked against brute-force pandas
re-statements of the reference semantics (spine gaps, band edges, rounds)."""
import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pricewise.functions.scalars import color_words
from pricewise.operators import competition as cp
from pricewise.operators import timefeatures as tf

D0 = dt.date(2020, 1, 1)


def _frame(spark, rows):
    pdf = pd.DataFrame(rows, columns=["style_cd", "sales_date", "sales_qty", "md1"])
    pdf["md10"] = (pdf["md1"] * 10).round().astype(int)
    return pdf, spark.createDataFrame(pdf)


def _rows(seed=3, n_days=40, products=("a", "b", "c")):
    rng = np.random.default_rng(seed)
    out = []
    for d in range(n_days):
        if d in (7, 8, 20):      # spine gaps: nobody sold
            continue
        for p in products:
            if rng.random() < 0.7:
                out.append((p, D0 + dt.timedelta(days=d), float(rng.integers(1, 20)),
                            float(rng.choice([0.6, 0.8, 1.0]))))
    return out


def test_rolling_matches_crosstab_semantics(spark):
    pdf, df = _frame(spark, _rows())
    n, shift = 3, 5
    got = (tf.rolling_sales_stats(df, df, "style_cd", [(n, "avg"), (n, "max")], shift)
           .toPandas().set_index(["style_cd", "sales_date"]).sort_index())
    # reference form: crosstab on the spine, rolling(N), shift by calendar days, ffill, stack
    pdf["sales_date"] = pd.to_datetime(pdf["sales_date"])
    ct = pd.crosstab(pdf["sales_date"], pdf["style_cd"], values=pdf["sales_qty"], aggfunc="mean")
    for stat in ("avg", "max"):
        r = ct.rolling(n).mean() if stat == "avg" else ct.rolling(n).max()
        exp = r.shift(shift, freq="D").ffill().stack()
        for (p, d), row in got.iterrows():
            key = (pd.Timestamp(d), p)
            e = exp.get(key, np.nan)
            g = row[f"past_{n}_{stat}_aps"]
            assert (np.isnan(e) and pd.isna(g)) or abs(e - g) < 1e-9, (p, d, e, g)


def test_same_md_history_matches_cummax(spark):
    pdf, df = _frame(spark, _rows(seed=5))
    shift = 4
    got = tf.same_md_history(df, "style_cd", shift).toPandas()
    pdf["sales_date"] = pd.to_datetime(pdf["sales_date"])
    ct = pd.crosstab(pdf["sales_date"], [pdf["style_cd"], pdf["md10"]], values=pdf["sales_qty"], aggfunc="mean")
    exp = ct.cummax().shift(shift, freq="D").ffill().stack().stack()
    for _, row in got.iterrows():
        e = exp.get((pd.Timestamp(row.sales_date), row.md10, row.style_cd), np.nan)
        g = row.same_md_hist_max_aps
        assert (np.isnan(e) and pd.isna(g)) or abs(e - g) < 1e-9


def test_markdown_rounds_sequence(spark):
    mds = [0.8, 0.8, 0.6, 0.6, 0.6, 0.8, 0.8]
    rows = [("s", D0 + dt.timedelta(days=i), "SP2020", "Y", 1.0, m, int(round(m * 10))) for i, m in enumerate(mds)]
    df = spark.createDataFrame(rows, "style_cd string, sales_date date, season1 string, inseason_flag1 string, "
                                     "sales_qty double, md1 double, md10 int")
    got = tf.markdown_rounds(df, "style_cd").orderBy("sales_date").collect()
    assert [r.cum_round for r in got] == [0, 0, 1, 1, 1, 2, 2]
    assert [r.round_days for r in got] == [1, 2, 0, 1, 2, 0, 1]
    assert [round(r.md_diff, 6) for r in got] == [0, 0, -0.2, 0, 0, 0.2, 0]


def test_price_band_edges(spark):
    # prices exactly on the band edge are inside; from 2000 the band is +/- 300
    rows = [("s1", "p1", 1000.0, 10), ("s2", "p2", 1100.0, 8), ("s3", "p3", 1100.01, 6),
            ("s4", "p4", 2000.0, 10), ("s5", "p5", 2300.0, 9), ("s6", "p6", 1850.0, 7)]
    df = spark.createDataFrame([(s, p, D0, "g", pr, m) for s, p, pr, m in rows],
                               "style_cd string, prod_code string, sales_date date, grp string, "
                               "md_price double, md10 int")
    got = {r.style_cd: r for r in cp.price_band_competitors(df).collect()}
    assert got["s1"].num_styles_in_group == 2          # 1000 and 1100 (edge); 1100.01 outside
    assert got["s4"].num_styles_in_group == 3          # 2000 +/- 300: 1850, 2000, 2300
    assert got["s4"].num_styles_on_sale_in_group == 2  # md < 1 among them
    assert got["s4"].num_styles_lower_MD_in_group == 2  # md 0.9 and 0.7 below 1.0


def test_color_words_cases(spark):
    lex = ["red", "blue", "white"]
    cases = {"Red Bolt/White": ("red", "red bolt/white"),
             "blue-red-red/x y": ("blue red", ""),
             "solo": ("solo", "solo"),
             "black gold/white-red": ("", "red white")}
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    lx = F.array(*[F.lit(w) for w in lex])
    got = {r.d: (r.a, r.b) for r in df.select("d", color_words(F.col("d"), lx, 0).alias("a"),
                                               color_words(F.col("d"), lx, 1).alias("b")).collect()}
    assert got == cases
