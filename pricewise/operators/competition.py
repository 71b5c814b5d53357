"""Competitor features inside price bands.

Price-band counts and sums are range totals (:mod:`pricewise.operators.bands`): running
totals over the rows and range ends of a (date, group) in order of price, with large
groups cut into parts. Counts of rows that are better in a band (a lower md in J14, a
better rank in W14) are such totals too, over blocks of the rank order. No pairs of
rows are formed and no list of a frame's rows.
A row without a group or price is in no band (P3): its counts are 0, its sums NULL.
J18 asks for each probe and earlier day for the nearest price of another product from
the band's lower edge on: one row per probe and day in one sorted pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.frames import UNBOUNDED
from pricewise.functions.rules import day_number, np_round, pct_rank_avg, safe_div
from pricewise.operators import bands
from pricewise.session import materialize

NARROW, WIDE, WIDE_FROM = 100.0, 300.0, 2000.0   # band half-widths; wide band from price 2000


def unit_price(df: DataFrame, fcst_date: str | None = None, out: str = "md_price") -> DataFrame:
    """P-10: price paid per unit; MSRP x md on the forecast day."""
    paid = safe_div("sales_amt", "sales_qty")
    if fcst_date is not None:
        paid = F.when(F.col("sales_date") == F.lit(fcst_date).cast("date"),
                      F.col("MSRP") * F.col("md")).otherwise(paid)
    return df.withColumn(out, paid)


def aur(df: DataFrame, fcst_date: str | None = None, out: str = "AUR") -> DataFrame:
    """P-11: AUR = unit price rounded to 0 decimals (NumPy rounding)."""
    return unit_price(df, fcst_date, out).withColumn(out, np_round(out, 0))


def price_band_bounds(df: DataFrame, price: str = "md_price") -> DataFrame:
    """P-12: band = price -/+ 100 below 2000, else -/+ 300."""
    half = F.when(F.col(price) < WIDE_FROM, F.lit(NARROW)).otherwise(F.lit(WIDE))
    return (df.withColumn("comp_price_low", F.col(price) - half)
            .withColumn("comp_price_high", F.col(price) + half))


# ------------------------------------------------------------------ J14
def price_band_competitors(df: DataFrame, key: str = "style_cd", group: str = "grp", limit: int = bands.LIMIT) -> DataFrame:
    """One row per (key, date) with the lowest md (ties: smaller product
    code); counts of keys on the same date and group priced inside the row's
    band: all, on sale (md < 1), at a lower md than the row (itself included)."""
    w1 = Window.partitionBy(key, "sales_date").orderBy("md10", "prod_code")
    d = (df.withColumn("_rn", F.row_number().over(w1)).filter("_rn = 1")
         .select(key, "sales_date", group, "md10", "md_price").withColumn("_id", F.monotonically_increasing_id()))
    d = price_band_bounds(materialize(d, "band-rows")).withColumnsRenamed({"md_price": "x", "comp_price_low": "lo", "comp_price_high": "hi"})
    part, out = ["sales_date", group], ["_n", "_sale", "better"]
    cuts = bands.cut_points(d.where(F.col(group).isNotNull()), part, {"_by_x": F.col("x"), "_by_rank": F.col("md10").cast("double")}, limit)
    by_x, by_rank = ("_by_x", "_by_rank") if cuts is not None else (None, None)
    extra = ["_by_x"] if cuts is not None else []
    d = bands.with_cuts(d, part, cuts).withColumns({"_level": F.lit(-1), "_block": F.lit(0).cast("long"), "_n": F.lit(1.0),
                                                    "_sale": (F.col("md10") < 10).cast("double")})
    # rows without a price are in no band, so they need no place in the order of md either
    better, below = bands.better_events(
        bands.ranked(d.drop("_level", "_block").where(F.col(group).isNotNull() & F.col("x").isNotNull()), part, "md10", by_rank),
        part, [key], extra)
    spot = [*part, "_level", "_block", *extra]
    sums = bands.range_totals(d.select(*spot, "x", "_n", "_sale").unionByName(better, allowMissingColumns=True),
                              d.select("_id", key, *spot, "lo", "hi").unionByName(below), [*part, "_level", "_block"], out, by_x, [key, "sales_date"])
    return sums.select(key, "sales_date", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(n) for c, n in (
        ("_n", "num_styles_in_group"), ("_sale", "num_styles_on_sale_in_group"), ("better", "num_styles_lower_MD_in_group"))])


# ------------------------------------------------------ band sums
def band_sums(population: DataFrame, probes: DataFrame, group: str = "grp", limit: int = bands.LIMIT) -> DataFrame:
    """Sum population inventory values over the probe's band on the probe's
    date and group. ``probes`` has (probe columns..., _pdate, grp, _pprice);
    ``population`` has (sales_date, grp, md_price, inv_qty, md1)."""
    part, values = ["_pdate", group], ["_s_inv", "_s_aur", "_s_md"]
    probes = materialize(probes.withColumn("_id", F.monotonically_increasing_id()), "probes")
    pop = materialize(population.where(F.col(group).isNotNull() & F.col("md_price").isNotNull()).select(
        F.col("sales_date").alias("_pdate"), group, F.col("md_price").alias("x"), F.col("inv_qty").alias("_s_inv"),
        (F.col("md_price") * F.col("inv_qty")).alias("_s_aur"), (F.rint(F.col("md1") * 10.0) * F.col("inv_qty")).alias("_s_md")), "population")
    ends = price_band_bounds(probes, "_pprice").select("_id", *part, F.col("comp_price_low").alias("lo"), F.col("comp_price_high").alias("hi"),
                                                       F.col("_pprice").alias("x"))
    cuts = bands.cut_points(pop.select(*part, "x").unionByName(ends.where(F.col(group).isNotNull() & F.col("_pdate").isNotNull()).select(*part, "x")),
                            part, {"_by_x": F.col("x")}, limit)
    sums = bands.range_totals(bands.with_cuts(pop, part, cuts), bands.with_cuts(ends, part, cuts), part, values,
                              None if cuts is None else "_by_x")
    # md x inventory is added up in tenths, so exactly
    return probes.join(sums, "_id").withColumn("_s_md", F.col("_s_md") / 10.0).drop("_id")


def _shares(own_inv: Column, own_price: Column, own_md: Column, prefix: str, suffix: str) -> list[Column]:
    ok = F.col("_s_inv") > 0
    return [F.when(ok, safe_div(own_inv, "_s_inv")).alias(f"{prefix}inv_adv{suffix}"),
            F.when(ok, safe_div(own_inv * own_price, "_s_aur")).alias(f"{prefix}AUR_inv_adv{suffix}"),
            F.when(ok, safe_div(own_inv * own_md, "_s_md")).alias(f"{prefix}md_inv_adv{suffix}")]


def inventory_advantage(df: DataFrame, lead: int, level: str = "prod_code", group: str = "grp") -> DataFrame:
    """At date - lead, own inventory / sum over the group's rows inside
    the row's band; the same for price x inv and md x inv (Q2: md x inv in
    the numerator). Only if the sum is > 0 and the product has exactly one
    row at date - lead. Looks back over the full history (Q3)."""
    w_own = Window.partitionBy(level).orderBy(day_number("sales_date")).rangeBetween(-lead, -lead)
    x = df.select(level, "sales_date", group, "md_price",
                  F.count(F.lit(1)).over(w_own).alias("_own_n"),
                  F.first("inv_qty").over(w_own).alias("_own_inv"),
                  F.first("md_price").over(w_own).alias("_own_price"),
                  F.first("md1").over(w_own).alias("_own_md"))
    probes = x.withColumn("_pdate", F.date_sub("sales_date", lead)).withColumn("_pprice", F.col("md_price"))
    s = band_sums(df, probes, group)
    one = F.col("_own_n") == 1
    cols = _shares(F.when(one, F.col("_own_inv")), F.col("_own_price"), F.col("_own_md"), "", "")
    return s.select(level, "sales_date", *cols)


# ------------------------------------------------------------ J16 / J17
def asof_last_same_md(df: DataFrame, lead: int, level: str = "prod_code", group: str = "grp",
                      exclude: DataFrame | None = None) -> DataFrame:
    """J16 + J17: the last row of the product at the same md on or before
    date - lead (optionally off the excluded dates): its qty and the days
    since; then, on that as-of date, its inventory shares over the group's
    rows inside the current row's band."""
    src = df
    if exclude is not None:
        src = src.join(F.broadcast(exclude.select("sales_date").distinct()), "sales_date", "left_anti")
    # one source row per (product, md, date): the smallest amount is last in the reference order
    w_one = Window.partitionBy(level, "md10", "sales_date").orderBy("sales_amt")
    src = (src.withColumn("_rn", F.row_number().over(w_one)).filter("_rn = 1")
           .select(level, "md10", "sales_date",
                   F.struct(F.col("sales_date").alias("d"), F.col("sales_qty").alias("q"),
                            F.col("inv_qty").alias("inv"), F.col("md_price").alias("p"),
                            F.col("md1").alias("m")).alias("_last")))
    tgt = df.select(level, "md10", "sales_date", group, "md_price").withColumn("_t", F.lit(True))
    u = tgt.unionByName(src.withColumn("_t", F.lit(False)), allowMissingColumns=True)
    w = (Window.partitionBy(level, "md10").orderBy(day_number("sales_date"))
         .rangeBetween(UNBOUNDED, -lead))
    x = u.withColumn("_asof", F.last("_last", ignorenulls=True).over(w)).filter("_t")
    x = x.select(level, "md10", "sales_date", group, "md_price", "_asof",
                 F.col("_asof.q").alias("aps_last_md"),
                 F.datediff(F.date_sub("sales_date", lead), F.col("_asof.d")).cast("long")
                 .alias("interval_after_last_md"))
    probes = (x.withColumn("_pdate", F.col("_asof.d")).withColumn("_pprice", F.col("md_price")))
    s = band_sums(df, probes, group)
    return s.select(level, "sales_date", (F.col("md10") / 10.0).alias("md1"), "aps_last_md",
                    "interval_after_last_md",
                    *_shares(F.col("_asof.inv"), F.col("_asof.p"), F.col("_asof.m"), "", "_last_md"))


# ------------------------------------------------------------------ J18
def competitor_days_same_md(df: DataFrame, bounds: DataFrame, lead: int, level: str = "prod_code",
                            group: str = "grp") -> DataFrame:
    """Distinct dates of the row's calendar season, strictly before
    date - lead, on which another product of the group had this md and a
    price inside the row's band. 0 when none.

    For each probe and earlier day of its season, the lowest price of another product
    from the band's lower edge on decides: the day counts if that is within the upper
    edge. Prices of a (day, group, md) and the probes' lower edges are stacked in
    descending order, so the last price seen is the next one upwards; a price carries
    the next one of a different product too, for when it is the probe's own."""
    from pricewise.operators.timefeatures import with_calendar_season
    cal = with_calendar_season(df, bounds).filter(F.col("cal_season").isNotNull()).select(
        level, "sales_date", "md10", "cal_season", "season_start", group, "md_price")
    cal = materialize(cal.withColumn("_id", F.monotonically_increasing_id()), "season-rows")
    spot = ["cal_season", group, "md10", "_day"]
    cand = (cal.where(F.col(group).isNotNull() & F.col("md_price").isNotNull())
            .groupBy("cal_season", group, "md10", F.col("sales_date").alias("_day"), F.col("md_price").alias("_x"))
            .agg(F.min(level).alias("_low"), F.max(level).alias("_high")))
    # a price of one product only continues the run of prices of that product
    up, down = Window.partitionBy(*spot).orderBy("_x"), Window.partitionBy(*spot).orderBy(F.desc("_x"))
    starts = ~F.coalesce((F.lag("_low").over(up) == F.col("_low")) & (F.lag("_high").over(up) == F.col("_high"))
                         & (F.col("_low") == F.col("_high")), F.lit(False))
    other = F.last(F.when(F.col("_starts"), F.col("_x")), ignorenulls=True).over(down.rowsBetween(UNBOUNDED, -1))
    cand = cand.withColumn("_starts", starts).withColumn("_other", other) \
        .select(*spot, "_x", F.struct("_x", "_low", "_high", "_other").alias("_next"))
    days = F.sequence("season_start", F.date_sub("sales_date", lead + 1))
    probes = price_band_bounds(cal).where((F.date_sub("sales_date", lead + 1) >= F.col("season_start")) & F.col(group).isNotNull()) \
        .select("_id", level, "cal_season", group, "md10", F.explode(days).alias("_day"), F.col("comp_price_low").alias("_x"),
                F.col("comp_price_high").alias("_hi"))
    w = Window.partitionBy(*spot).orderBy(F.desc("_x"), F.asc_nulls_first("_id")).rowsBetween(UNBOUNDED, 0)
    near = probes.unionByName(cand, allowMissingColumns=True).withColumn("_next", F.last("_next", ignorenulls=True).over(w)) \
        .where("_id IS NOT NULL")
    own = (F.col("_next._low") == F.col(level)) & (F.col("_next._high") == F.col(level))
    found = F.when(own, F.col("_next._other")).otherwise(F.col("_next._x"))
    counts = near.where(found <= F.col("_hi")).groupBy("_id").agg(F.count(F.lit(1)).alias("_c"))
    return cal.select("_id", level, "sales_date", "md10").join(counts, "_id", "left").select(
        level, "sales_date", (F.col("md10") / 10.0).alias("md1"), F.coalesce("_c", F.lit(0)).cast("long").alias("num_days_comp_this_md_inseason"))


# ------------------------------------------------------------ W14 - W16
@dataclass
class Position:
    """One call of W14: a group, the price that ranges are on, and what is compared."""

    group: Sequence[str]
    name: str = ""
    price: str = "MSRP"
    rank: str = "AUR"
    md: str = "md1"
    inv: str = "inv_qty"
    ascending: bool = True
    label: str | None = None

    def columns(self) -> list[str]:
        pre = f"same_{self.name}_{self.price}"
        return [f"{pre}_{self.label or self.md}_competitiveness", f"{pre}_comp_cnt", f"{pre}_{self.rank}_rank"]


def positions(df: DataFrame, calls: Sequence[Position], rng: float = 100.0, limit: int = bands.LIMIT) -> DataFrame:
    """W14 for several calls at once: the rows with a group in every call (P3), and for
    each call, among rows of the group within +/- rng of the row's price: weight (md x
    inv) / mean weight (999 when the mean is not > 0), row count, and position = rows
    with a strictly better rank value / count (2 decimals; ascending: smaller is
    better). A row without a price is in no range: 999, 0 and NULL.

    The calls' rows are stacked, so all of them take one pass."""
    rows = df.dropna(subset=sorted({c for call in calls for c in call.group}))
    rows = materialize(rows.withColumn("_id", F.monotonically_increasing_id()), "position-rows")
    part, spot = ["_call", "_group"], ["_call", "_group", "_level", "_block"]
    each = None
    for k, call in enumerate(calls):
        rank = F.col(call.rank).cast("double")
        weight = (F.col(call.md) * F.col(call.inv)).cast("double")
        one = rows.select(
            "_id", F.lit(k).alias("_call"), F.to_json(F.struct(*call.group)).alias("_group"), F.col(call.price).cast("double").alias("x"),
            (rank if call.ascending else -rank).alias("_rank"), weight.alias("_w"), F.when(weight.isNotNull(), 1.0).alias("_nw"))
        each = one if each is None else each.unionByName(one)
    each = each.where("x IS NOT NULL").withColumns({"lo": F.col("x") - rng, "hi": F.col("x") + rng})
    cuts = bands.cut_points(each, part, {"_by_x": F.col("x"), "_by_rank": F.col("_rank")}, limit)
    by_x, by_rank, extra = ("_by_x", "_by_rank", ["_by_x"]) if cuts is not None else (None, None, [])
    each = bands.with_cuts(each, part, cuts)
    better, below = bands.better_events(bands.ranked(each, part, "_rank", by_rank), part, [], extra)
    whole = each.withColumns({"_level": F.lit(-1), "_block": F.lit(0).cast("long"), "_n": F.lit(1.0)})
    sums = bands.range_totals(whole.select(*spot, *extra, "x", "_n", "_w", "_nw").unionByName(better, allowMissingColumns=True),
                              whole.select("_id", *spot, *extra, "lo", "hi").unionByName(below), spot, ["_n", "_w", "_nw", "better"], by_x, ["_call"])
    wide = sums.groupBy("_id").agg(*[F.max(F.when(F.col("_call") == k, F.col(c))).alias(f"{c}{k}")
                                     for k in range(len(calls)) for c in ("_n", "_w", "_nw", "better")])
    out = rows.join(wide, "_id", "left")
    new = {}
    for k, call in enumerate(calls):
        mean = safe_div(f"_w{k}", f"_nw{k}")
        names = call.columns()
        new[names[0]] = F.when(mean > 0, F.col(call.md) * F.col(call.inv) / mean).otherwise(F.lit(999.0))
        new[names[1]] = F.coalesce(F.col(f"_n{k}"), F.lit(0.0)).cast("long")
        new[names[2]] = np_round(safe_div(f"better{k}", f"_n{k}"), 2)
    return out.select(*df.columns, *[c.alias(n) for n, c in new.items()])


def competitive_position(df: DataFrame, group_cols: Sequence[str], grp_name: str = "",
                         price_col: str = "MSRP", rank_col: str = "AUR", md_col: str = "md1",
                         inv_col: str = "inv_qty", rng: float = 100.0, ascending: bool = True,
                         md_label: str | None = None, limit: int = bands.LIMIT) -> DataFrame:
    """One call of :func:`positions`."""
    return positions(df, [Position(list(group_cols), grp_name, price_col, rank_col, md_col, inv_col, ascending, md_label)], rng, limit)


def competing_features(df: DataFrame, level: str, rank_fill: str = "past_7_aps", limit: int = bands.LIMIT) -> DataFrame:
    """The reference's competitor calls, group = date + gender + category
    (+ platform class / power item / model / base colour for SKUs), range 100."""
    g = ["sales_date", "gender_group", "gc_category"]
    x = df.fillna({"power_item": "non-power-franchise", rank_fill: 0.0})
    groups = [("", g), ("platform", g + ["class_platform"]), ("pc", g + ["power_item"]), ("Model", g + ["model"])]
    if level == "prod_code":
        groups.append(("color", g + ["base_color"]))
    return positions(x, [Position(g, label="md"), *[Position(cols, name, "AUR", rank_fill, "MSRP", ascending=False) for name, cols in groups]],
                     limit=limit)


def inventory_rank(df: DataFrame, keys: Sequence[str] = ("sales_date", "gender_group"),
                   value: str = "inv_qty") -> DataFrame:
    """Percent rank of inventory within (date, gender), descending,
    2 decimals (P7 average ties); NULL without a key (P3)."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return df.withColumn("inv_qty_rank", F.when(known, np_round(pct_rank_avg(value, list(keys), ascending=False), 2)))
