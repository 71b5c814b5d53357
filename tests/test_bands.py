"""Price-band features on groups of any size, against plain loops."""
import datetime as dt
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewise.operators import bands
from pricewise.operators import competition as cp

D = dt.date(2020, 1, 15)


def _rows(n, seed=1, groups="ghi"):
    """Mostly one group, with ties, NULL prices and NULL ranks."""
    rng = random.Random(seed)
    return [(f"s{k}", D, rng.choice(groups) if rng.random() < 0.2 else "g", rng.choice([500.0, 600.0, 1950.5, rng.uniform(10, 2600), None]),
             rng.choice([None, 3.0, 7.5, float(rng.randint(0, 40))]), rng.choice([0.5, 0.9, 1.0]), rng.choice([None, 0.0, 10.0, 35.0])) for k in range(n)]


SCHEMA = "style_cd string, sales_date date, g string, AUR double, r double, md1 double, inv_qty double"


@pytest.mark.parametrize("limit", [bands.LIMIT, 40])
@pytest.mark.parametrize("ascending", [True, False])
def test_positions_in_cut_groups(spark, limit, ascending):
    rows = [*_rows(400), ("none", D, None, 500.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.style_cd: tuple(r)[7:] for r in cp.competitive_position(df, ["g"], "x", "AUR", "r", ascending=ascending, limit=limit).collect()}
    assert set(got) == {r[0] for r in rows if r[2]}
    for s, _, g, p, rank, md, inv in rows[:-1]:
        near = [x for x in rows if x[2] == g and p is not None and x[3] is not None and abs(x[3] - p) <= 100]
        weights = [x[5] * x[6] for x in near if x[6] is not None]
        mean = sum(weights) / len(weights) if weights else 0
        better = sum(x[4] is not None and rank is not None and (x[4] < rank if ascending else x[4] > rank) for x in near)
        competitiveness, count, place = got[s]
        assert count == len(near) and place == (np.round(better / len(near), 2) if near else None), s
        want = 999.0 if not mean > 0 else None if inv is None else md * inv / mean
        assert (competitiveness is None and want is None) or abs(competitiveness - want) < 1e-9, s


@pytest.mark.parametrize("limit", [bands.LIMIT, 25])
def test_band_counts_and_sums_in_cut_groups(spark, limit):
    rng = random.Random(3)
    rows = [(f"s{k}", f"p{k}", D, rng.choice(["g", "g", "g", "h", None]), rng.choice([None, 500.0, rng.uniform(100, 2700)]), rng.randint(5, 10),
             float(rng.randint(0, 9))) for k in range(300)]
    df = spark.createDataFrame(rows, "style_cd string, prod_code string, sales_date date, grp string, md_price double, md10 int, inv_qty double") \
        .withColumn("md1", F.col("md10") / 10.0)
    got = {r.style_cd: tuple(r)[2:] for r in cp.price_band_competitors(df, limit=limit).collect()}
    probes = df.select("style_cd", "grp", F.col("sales_date").alias("_pdate"), F.col("md_price").alias("_pprice"))
    sums = {r.style_cd: r for r in cp.band_sums(df, probes, limit=limit).collect()}
    assert len(got) == len(sums) == 300
    for s, _, _, g, p, md, _ in rows:
        half = 100 if p is not None and p < 2000 else 300
        band = [x for x in rows if None not in (g, p, x[4]) and x[3] == g and p - half <= x[4] <= p + half]
        assert got[s] == (len(band), sum(x[5] < 10 for x in band), sum(x[5] < md for x in band))
        if None in (g, p):
            assert sums[s]["_s_inv"] is None
        else:
            assert sums[s]["_s_inv"] == sum(x[6] for x in band) and sums[s]["_s_md"] == sum(x[5] * x[6] for x in band) / 10
            assert abs(sums[s]["_s_aur"] - sum(x[4] * x[6] for x in band)) < 1e-6


def test_one_busy_group_is_many_even_parts(spark):
    """A third of the parts' rows is far from one part, and the work grows with the rows."""
    df = spark.range(100_000).select(F.format_string("s%d", "id").alias("style_cd"), F.lit(D).alias("sales_date"), F.lit("g").alias("g"),
                                     (F.pmod(F.xxhash64("id"), F.lit(300_000)) / 100.0).alias("AUR"), F.lit(1.0).alias("md1"), F.lit(1.0).alias("inv_qty"),
                                     (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1.0).alias("r"))
    cuts = bands.cut_points(df, ["g"], {"by": F.col("AUR")}, 5000)
    parts = sorted(r["count"] for r in bands.with_cuts(df, ["g"], cuts).groupBy(bands.chunk(F.col("AUR"), "by")).count().collect())
    assert len(parts) == 20 and parts[-1] <= 2 * parts[len(parts) // 2]
    times = []
    for n in (25_000, 100_000):
        began = time.time()
        top = cp.competitive_position(df.limit(n).where("true"), ["g"], "", "AUR", "r", limit=5000).agg(
            F.max("same__AUR_comp_cnt"), F.max("same__AUR_r_rank"), F.count("*")).first()
        times.append(time.time() - began)
        assert top[2] == n and 0.05 * n < top[0] < 0.1 * n and top[1] == 1.0
    assert times[1] < 10 * times[0]


def test_days_of_other_products(spark):
    """The nearest price may be the probe's own, on one row or several."""
    rng = random.Random(8)
    bounds = spark.createDataFrame([("SP2020", dt.date(2020, 1, 1), dt.date(2020, 3, 31)), ("SU2020", dt.date(2020, 4, 1), dt.date(2020, 6, 30))],
                                   "season1 string, season_start date, season_end date")
    rows = [(rng.choice("abc"), dt.date(2020, 3, 1) + dt.timedelta(days=rng.randint(0, 70)), rng.choice(["g", "g", None]), rng.choice([8, 9]),
             rng.choice([500.0, 590.0, 600.0, 680.0, 1999.0, 2290.0, 2300.0])) for _ in range(400)]
    df = spark.createDataFrame(rows, "prod_code string, sales_date date, grp string, md10 int, md_price double")
    got = sorted(tuple(r) for r in cp.competitor_days_same_md(df, bounds, 5).collect())
    want = []
    for p, d, g, md, price in rows:
        half = 100 if price < 2000 else 300
        season = d < dt.date(2020, 4, 1)
        days = {x[1] for x in rows if g is not None and x[0] != p and x[2] == g and x[3] == md and (x[1] < dt.date(2020, 4, 1)) == season
                and x[1] < d - dt.timedelta(days=5) and price - half <= x[4] <= price + half}
        want.append((p, d, md / 10, len(days)))
    assert got == sorted(want) and max(w[3] for w in want) > 3
