"""Exact selection, running totals and running medians of whole tables."""
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricewise.operators import order_stats as os_


def _values(kind, n=700):
    rng = random.Random(kind)
    make = {"even": lambda: rng.random(), "ties": lambda: float(rng.randint(0, 4)), "heavy": lambda: math.exp(rng.gauss(0, 9)) * rng.choice([-1, 1]),
            "huge": lambda: rng.choice([1.7e308, -1.7e308, 5e-324, 0.0, 1.0]), "one": lambda: 3.25, "whole": lambda: float(rng.randint(-2**53, 2**53))}[kind]
    return [make() for _ in range(n)]


@pytest.mark.parametrize("kind", ["even", "ties", "heavy", "huge", "one", "whole"])
def test_quantiles_are_exact(spark, kind):
    values = _values(kind)
    df = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "x double").repartition(3)
    probs = [0, 0.1, 1 / 3, 0.5, 0.77, 1]
    kept = sorted(values)
    want = [kept[math.floor(h)] + (kept[math.ceil(h)] - kept[math.floor(h)]) * (h - math.floor(h)) for h in ((len(kept) - 1) * p for p in probs)]
    assert os_.quantiles(df, "x", probs, steps=8) == want


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (math.nan,)], "x double")
    assert os_.quantiles(df, "x", [0.5, 1]) == [None, None]
    assert os_.quantiles(df.limit(0), "x", [0.5]) == [None]
    assert os_.quantiles(spark.createDataFrame([(2.0,)], "x double"), "x", [0.0, 0.5]) == [2.0, 2.0]


def test_running_totals_along_an_order(spark):
    rng = random.Random(2)
    rows = [(k, float(rng.randint(0, 5)), rng.randint(1, 9)) for k in range(500)]
    df = spark.createDataFrame(rows, "id int, q double, n int").repartition(4)
    got = {r.id: (r.s, r.s_all) for r in os_.in_order(df, [("q", True), ("id", False)], {"s": F.col("n")}, parts=7).collect()}
    total, want = 0, {}
    for k, _, n in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += n
        want[k] = total
    assert got == {k: (v, total) for k, v in want.items()}


@pytest.mark.parametrize("size", [None, 1, 7, 1000])
@pytest.mark.parametrize("kind", ["even", "ties", "rising", "falling", "gaps"])
def test_running_median_is_pandas_expanding(spark, kind, size):
    rng = random.Random(7)
    n = 90 if size == 1 else 300
    value = {"even": lambda k: rng.random(), "ties": lambda k: float(rng.randint(0, 3)), "rising": float, "falling": lambda k: -float(k),
             "gaps": lambda k: None if k < 20 or rng.random() < 0.4 else rng.random()}[kind]
    rows = [(k, float(n - k // 3), value(k)) for k in range(n)]
    df = spark.createDataFrame(rows, "id int, q double, e double").repartition(5)
    got = {r.id: r.m for r in os_.running_median(df, [("q", True), ("id", False)], "e", "m", size=size).collect()}
    want = pd.Series([r[2] for r in rows], dtype=float).expanding().median()
    assert len(got) == n
    for k, w in enumerate(want):
        assert (got[k] is None and np.isnan(w)) or got[k] == w, k


def test_empty(spark):
    df = spark.createDataFrame([], "id int, q double, e double")
    assert os_.running_median(df, [("q", True), ("id", False)], "e", "m").count() == 0
    assert os_.in_order(df, [("q", True)], {"s": F.col("e")}).count() == 0
