"""Parity rules P1, P2, P7, P10 against pandas / NumPy on hand-made values."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pricewise.functions.rules import np_round, pct_rank_avg, right_closed_bins, safe_div


def test_np_round_ties_to_even(spark):
    vals = [0.125, 0.135, 2.5, 3.5, -0.5, 0.615, 1.005, 0.45]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(np_round("x", 2)).collect()]
    assert got == [float(v) for v in np.round(vals, 2)]
    got0 = [r[0] for r in df.select(np_round("x", 0)).collect()]
    assert got0 == [float(v) for v in np.round(vals, 0)]


def test_safe_div_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [None, None, 1.5, None]


def test_pct_rank_matches_pandas_average_ties(spark):
    rows = [("g1", 5.0), ("g1", 3.0), ("g1", 3.0), ("g1", None), ("g1", 9.0), ("g2", 1.0), ("g2", 1.0)]
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    df = spark.createDataFrame(rows, "g string, v double")
    for asc in (True, False):
        exp = pdf.groupby("g")["v"].rank(pct=True, ascending=asc).tolist()
        got = (df.withColumn("i", F.monotonically_increasing_id())
               .withColumn("r", pct_rank_avg("v", ["g"], ascending=asc)).orderBy("i").collect())
        for e, r in zip(exp, got):
            assert (np.isnan(e) and r["r"] is None) or abs(e - r["r"]) < 1e-12


def test_right_closed_bins_edges(spark):
    vals = [0.0, 1.0, 300.0, 300.5, 1000.0, 2500.0, 2600.0]
    pdf = pd.cut(pd.Series(vals), [0, 300, 500, 700, 1000, 2500], labels=[300, 500, 700, 1000, 3000])
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(right_closed_bins("x", [0, 300, 500, 700, 1000, 2500],
                                                    [300, 500, 700, 1000, 3000])).collect()]
    exp = [None if pd.isna(v) else int(v) for v in pdf]
    assert got == exp
