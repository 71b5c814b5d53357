"""Time features by product and discount level (SURVEY 2.4, 2.5: A5-A10,
W1-W13, W18, J19).

Every operator pre-aggregates to one row per (key, day) before its window,
so a window partition holds at most one row per calendar day of one key:
a hot product costs days, not transactions. Dimensions joined here (spine,
season calendar) are bounded by the calendar and broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.frames import UNBOUNDED, gate_on_spine, last_value, lookback, spine
from pricewise.functions.rules import day_number, grouped_with_median, md1, sum0

ATTR_COLS = ["platform", "MSRP", "prod_code", "style_number", "division", "gender_group",
             "gc_category", "model", "class_platform", "power_item", "color_desc", "grp"]


# --------------------------------------------------------------- A5 / A6
def style_rollup(sku: DataFrame, attr_cols: Sequence[str] = ATTR_COLS, attrs: DataFrame | None = None) -> DataFrame:
    """A5 + O2: per (date, style, season, flag) sums of qty / amount /
    inventory (all-NULL sums are 0, P4), mean md; attributes and MSRP of the
    best-selling SKU (most qty, then the larger product code). With the attribute
    table ``attrs`` (prod_code, ...) only the SKU's code travels with the sums; its
    attributes are joined after."""
    keys = ["sales_date", "style_cd", "season1", "inseason_flag1"]
    later = [] if attrs is None else [c for c in attrs.columns if c in attr_cols and c != "prod_code"]
    later += ["grp"] if {"gc_category", "gender_group"} <= set(later) else []
    cols = [c for c in attr_cols if c in sku.columns and c not in later]
    best = F.max_by(F.struct(*cols), F.struct("sales_qty", "prod_code"))
    agg = (sku.groupBy(*keys)
           .agg(sum0("sales_qty").alias("sales_qty"), sum0("sales_amt").alias("sales_amt"),
                sum0("inv_qty").alias("inv_qty"),
                # mean md from integer hundredths: an exact sum, so the 1-decimal
                # md key does not depend on summation order
                (F.sum(F.rint(F.col("md") * 100.0)) / F.count("md") / 100.0).alias("md"),
                best.alias("_best")))
    out = agg.select(*keys, "sales_qty", "sales_amt", "inv_qty", "md",
                     *[F.col(f"_best.{c}").alias(c) for c in cols])
    if attrs is None:
        return out
    out = out.join(attrs.select("prod_code", *[c for c in later if c != "grp"]), "prod_code", "left")
    if "grp" in later:
        out = out.withColumn("grp", F.concat(F.col("gc_category"), F.lit("_"), F.col("gender_group")))
    return out.select(*keys, "sales_qty", "sales_amt", "inv_qty", "md", *[c for c in attr_cols if c in cols or c in later])


def style_rollup_by_amount(sku: DataFrame, attr_cols: Sequence[str] = ("gender_group", "gc_category", "season1")) -> DataFrame:
    """A5, second form: per (date, style, flag), whatever the season, sums of qty / amount /
    inventory, median MSRP, mean md rounded to one decimal; attributes and season of the
    SKU with the largest amount (then the larger product code)."""
    keys = ["sales_date", "style_cd", "inseason_flag1"]
    sums = grouped_with_median(sku.withColumn("_md", F.rint(F.col("md") * 100.0)).withColumn("_one", F.col("md").isNotNull().cast("int")),
                               keys, "MSRP", ["sales_qty", "sales_amt", "inv_qty", "_md", "_one"])
    best = sku.groupBy(*keys).agg(F.max_by(F.struct(*attr_cols), F.struct("sales_amt", "prod_code")).alias("_best"))
    zero = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("sales_qty", "sales_amt", "inv_qty")]
    return sums.join(best, keys).select(*keys, *zero, "MSRP", md1(F.try_divide("_md", "_one") / 100.0).alias("md1"),
                                        *[F.col(f"_best.{c}").alias(c) for c in attr_cols])


def sku_count_in_style(sku: DataFrame, time_scope: str = "season") -> DataFrame:
    """Distinct SKUs per style per season ("sn") or per date ("dt")."""
    scope, tag = ("season1", "sn") if time_scope == "season" else ("sales_date", "dt")
    return (sku.groupBy(scope, "style_cd")
            .agg(F.countDistinct("prod_code").alias(f"same_style_sku_num_{tag}")))


# ------------------------------------------------------- season windows
def with_calendar_season(df: DataFrame, bounds: DataFrame, date_col: str = "sales_date") -> DataFrame:
    """Attach the calendar season whose [start, end] holds the date.

    The season bounds (A13) are expanded to one row per calendar day
    (bounded by the calendar) and broadcast, so the lookup is an equi hash
    join on the day instead of a range (nested-loop) join."""
    days = bounds.select(F.col("season1").alias("cal_season"), "season_start", "season_end",
                         F.explode(F.sequence("season_start", "season_end")).alias("_cal_day"))
    return (df.join(F.broadcast(days), F.col(date_col) == F.col("_cal_day"), "left")
            .drop("_cal_day"))


def seasons_to_date(df: DataFrame, bounds: DataFrame, level: str = "prod_code",
                    inseason_only: bool = False, out: str | None = None) -> DataFrame:
    """For each (product, season of its rows), the number of distinct
    seasons the product sold in up to that season's last calendar day.

    Each (product, season value) enters once at its first date; a running
    count over the day frame up to the season end gives the answer."""
    out = out or ("num_inseasons" if inseason_only else "num_seasons")
    src = df.filter(F.col("inseason_flag1") == "Y") if inseason_only else df
    firsts = src.groupBy(level, F.col("season1").alias("_sv")).agg(F.min("sales_date").alias("sales_date"))
    targets = (df.select(level, "season1").distinct()
               .join(F.broadcast(bounds.select("season1", "season_end")), "season1")
               .withColumnRenamed("season_end", "sales_date"))
    res = lookback(targets, firsts, [level], "sales_date", {out: F.count("_sv")}, lag=0,
                   value_cols=["_sv"])
    return res.select(level, "season1", out)


def first_dates(df: DataFrame, bounds: DataFrame, level: str = "prod_code") -> dict[str, DataFrame]:
    """A10: first sale date per product; first row of the product inside each
    calendar season; first row inside the season at each md level. The season of
    a first row is the row's own, which need not be the calendar's; of several
    calendar seasons whose first row has one season, the earliest date counts."""
    cal = with_calendar_season(df, bounds).filter(F.col("cal_season").isNotNull() & F.col(level).isNotNull())

    def first(keys, out):
        row = F.min(F.struct("sales_date", "season1"))
        return (cal.groupBy(*keys, "cal_season").agg(row.alias("_f"))
                .groupBy(*keys, F.col("_f.season1").alias("season1")).agg(F.min("_f.sales_date").alias(out)))
    return {
        "first_sales_date": df.groupBy(level).agg(F.min("sales_date").alias("first_sales_date")),
        "inseason_1st_day": first([level], "inseason_1st_day"),
        "this_md_first_day": first([level, "md10"], "this_md_first_day"),
    }


def first_14d_sales(df: DataFrame, bounds: DataFrame, lead: int, level: str = "prod_code") -> DataFrame:
    """A9 + P-20: over the first 14 days of each season, sum of
    qty / (start + 14 - in-season first day) and mean md per (product, season of
    the row); rows dated from season start to start + 13 + lead get NULL. Rows of
    one season in the first days of two calendar seasons each divide by their own
    days; the earlier calendar season's value counts."""
    firsts = first_dates(df, bounds, level)["inseason_1st_day"]
    # first 14 days of each season, one row per day: an equi join on the day
    days14 = bounds.select(F.col("season1").alias("_s"), "season_start",
                           F.explode(F.sequence("season_start", F.date_add("season_start", 13))).alias("_d14"))
    early = (df.join(F.broadcast(days14), F.col("sales_date") == F.col("_d14"))
             .drop("_d14")
             .join(firsts, [level, "season1"], "left")
             .withColumn("_days", F.datediff(F.date_add("season_start", 14), "inseason_1st_day")))
    agg = (early.groupBy(level, "season1", "season_start")
           # the day count is constant here: divide the exact sum once
           .agg(F.try_divide(sum0("sales_qty"), F.max("_days")).alias("first_14d_APS"),
                F.avg("md1").alias("first_14d_avg_md"))
           .groupBy(level, "season1")
           .agg(F.min(F.struct("season_start", "first_14d_APS", "first_14d_avg_md")).alias("_a"))
           .select(level, "season1", "_a.first_14d_APS", "_a.first_14d_avg_md"))
    rows = df.select(level, "sales_date", "season1").distinct().join(agg, [level, "season1"], "left")
    masked = with_calendar_season(rows, bounds)
    in_gap = ((F.col("sales_date") >= F.col("season_start"))
              & (F.col("sales_date") <= F.date_add("season_start", 13 + lead)))
    return masked.select(level, "sales_date", "season1",
                         *[F.when(in_gap, F.lit(None).cast("double")).otherwise(F.col(c)).alias(c)
                           for c in ["first_14d_APS", "first_14d_avg_md"]])


# --------------------------------------------------- calendar-day windows
def days_on_market(df: DataFrame, level: str = "prod_code") -> DataFrame:
    """Rows of the product up to and including the date; and those with
    flag Y."""
    w = Window.partitionBy(level).orderBy(day_number("sales_date")).rangeBetween(UNBOUNDED, 0)
    return df.select(level, "sales_date",
                     F.count(F.lit(1)).over(w).alias("num_days_on_mkt"),
                     F.sum(F.when(F.col("inseason_flag1") == "Y", 1).otherwise(0)).over(w)
                     .cast("long").alias("num_days_on_mkt_inseason"))


def inseason_md_window(df: DataFrame, bounds: DataFrame, lead: int, level: str = "prod_code",
                       exclude: DataFrame | None = None) -> DataFrame:
    """W10 + W12: inside the calendar season of the row, at the row's md and
    product, up to date - lead: mean qty (rows off the excluded dates only)
    and number of rows."""
    cal = with_calendar_season(df, bounds).filter(F.col("cal_season").isNotNull())
    if exclude is not None:
        ex = F.broadcast(exclude.select(F.col("sales_date").alias("_xd")).distinct()
                         .withColumn("_excl", F.lit(True)))
        cal = cal.join(ex, F.col("sales_date") == F.col("_xd"), "left").drop("_xd")
    else:
        cal = cal.withColumn("_excl", F.lit(None).cast("boolean"))
    w = (Window.partitionBy(level, "md10", "cal_season").orderBy(day_number("sales_date"))
         .rangeBetween(UNBOUNDED, -lead))
    keep = F.col("_excl").isNull()
    return cal.select(level, "sales_date", "md1",
                      F.avg(F.when(keep, F.col("sales_qty"))).over(w).alias("inseason_APS_this_md"),
                      F.count(F.lit(1)).over(w).alias("num_days_this_md_inseason"))


def same_md_frequency(df: DataFrame, level: str) -> DataFrame:
    """Running count of (product, md) rows up to and including the date."""
    w = Window.partitionBy(level, "md10").orderBy(day_number("sales_date")).rangeBetween(UNBOUNDED, 0)
    return df.withColumn("same_md_hist_frequency", F.count(F.lit(1)).over(w))


def inseason_md_frequency(df: DataFrame, level: str, rank_col: str, cal_rank_col: str) -> DataFrame:
    """W6 (after W5): W5 minus the count at the end of the previous season
    rank; NULL when the previous season has no dates in the data.

    ``rank_col`` is the rank of the row's season, ``cal_rank_col`` the rank of
    the calendar season of its date. Counting rows with calendar rank <= r-1
    is a running count over the rank order with frame (unbounded, -1)."""
    src = df.select(level, "md10", F.col(cal_rank_col).alias("_r"), F.lit(1).alias("_n"))
    tgt = df.withColumn("_r", F.col(rank_col)).withColumn("_n", F.lit(None).cast("int"))
    u = tgt.withColumn("_t", F.lit(True)).unionByName(
        src.withColumn("_t", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(level, "md10").orderBy("_r").rangeBetween(UNBOUNDED, -1)
    prev = F.coalesce(F.sum("_n").over(w), F.lit(0))
    ranks = F.broadcast(df.select(F.col(cal_rank_col).alias("_pr")).distinct()
                        .withColumn("_has_prev", F.lit(True)))
    res = (u.withColumn("_prev", prev).filter("_t")
           .join(ranks, F.col("_r") - 1 == F.col("_pr"), "left"))
    return res.withColumn(
        "same_md_inseason_freq",
        F.when(F.col("_has_prev"), F.col("same_md_hist_frequency") - F.col("_prev"))
    ).drop("_r", "_n", "_t", "_prev", "_pr", "_has_prev")


# --------------------------------------------------------- as-of / spine
def daily_by_key(df: DataFrame, keys: Sequence[str], value: str = "sales_qty", how: str = "mean") -> DataFrame:
    """Pre-aggregate to one row per (keys, date) as the reference's crosstab does."""
    aggs = {"mean": F.avg(value), "sum": sum0(value), "count": F.count(F.lit(1))}
    out = df.groupBy(*keys, "sales_date").agg(aggs[how].alias("_v"), F.count(F.lit(1)).alias("_n"))
    return out


def off_dates(df: DataFrame, exclude: DataFrame | None) -> DataFrame:
    """P-4: the rows whose date isn't in ``exclude`` (sales_date; calendar-bounded)."""
    if exclude is None:
        return df
    return df.join(F.broadcast(exclude.select("sales_date").distinct()), "sales_date", "left_anti")


def same_md_history(df: DataFrame, level: str, shift: int, exclude: DataFrame | None = None) -> DataFrame:
    """Per (product, md) running max / min / mean of daily mean qty up to
    date - shift; mean divides by the row count (Q13). NULL unless
    date - shift is a spine date. One row per (product, md, date); rows on
    excluded dates keep their place but give no value, nor a spine date."""
    daily = daily_by_key(df, [level, "md10"])
    if exclude is not None:
        days = F.broadcast(exclude.select("sales_date").distinct().withColumn("_off", F.lit(True)))
        on = F.col("_off").isNull()
        daily = (daily.join(days, "sales_date", "left")
                 .withColumn("_v", F.when(on, F.col("_v"))).withColumn("_n", F.when(on, F.col("_n"))))
    sp = spine(off_dates(df, exclude))
    w = (Window.partitionBy(level, "md10").orderBy(day_number("sales_date"))
         .rangeBetween(UNBOUNDED, -shift))
    res = daily.select(level, "md10", "sales_date",
                       F.max("_v").over(w).alias("same_md_hist_max_aps"),
                       F.min("_v").over(w).alias("same_md_hist_min_aps"),
                       F.try_divide(F.sum("_v").over(w), F.sum("_n").over(w)).alias("same_md_hist_mean_aps"))
    res = gate_on_spine(res, sp, "sales_date", shift)
    cols = ["same_md_hist_max_aps", "same_md_hist_min_aps", "same_md_hist_mean_aps"]
    return res.select(level, "md10", "sales_date",
                      *[F.when(F.col("_on_spine"), F.col(c)).alias(c) for c in cols])


def inseason_previous_aps(df: DataFrame, level: str, shift: int, exclude: DataFrame | None = None) -> DataFrame:
    """Per (product, md) running mean qty inside one season, read at
    date - shift; the season is that of the spine date date - shift (Q6).
    One row per (product, md, date) of the data; NULL when date - shift is
    not a spine date (its season is then unknown). Rows on excluded dates are
    targets only."""
    src = (off_dates(df, exclude).groupBy(level, "md10", "season1", "sales_date")
           .agg(F.sum("sales_qty").alias("_q"), F.count(F.lit(1)).alias("_n")))
    season_of_day = F.broadcast(off_dates(df, exclude).select(F.col("sales_date").alias("_sd"),
                                          F.col("season1").alias("_sseason")).distinct())
    targets = (df.select(level, "md10", "sales_date").distinct()
               .join(season_of_day, F.date_sub("sales_date", shift) == F.col("_sd"), "left")
               .drop("_sd").withColumnRenamed("_sseason", "season1"))
    res = lookback(targets, src, [level, "md10", "season1"], "sales_date",
                   {"inseason_previous_md_aps":
                    lambda w: F.try_divide(F.sum("_q").over(w), F.sum("_n").over(w))},
                   lag=shift, value_cols=["_q", "_n"])
    return res.select(level, "md10", "sales_date", "inseason_previous_md_aps")


def historic_md_avg(df: DataFrame, level: str) -> DataFrame:
    """Mean of past daily mean md, today excluded. Summed in integer
    tenths (md10) so the result does not depend on summation order."""
    daily = daily_by_key(df, [level], value="md10")
    w = Window.partitionBy(level).orderBy(day_number("sales_date")).rangeBetween(UNBOUNDED, -1)
    return daily.select(level, "sales_date", (F.avg("_v").over(w) / 10.0).alias("hist_md_avg"))


def historic_max_qty(df: DataFrame, level: str, lead: int) -> DataFrame:
    """Running max of daily summed qty up to date - lead; NULL unless
    date - lead is a spine date. One row per (product, date) of the data."""
    daily = daily_by_key(df, [level], how="sum")
    w = Window.partitionBy(level).orderBy(day_number("sales_date")).rangeBetween(UNBOUNDED, -lead)
    res = gate_on_spine(daily.select(level, "sales_date", F.max("_v").over(w).alias("_m")),
                        spine(df), "sales_date", lead)
    return res.select(level, "sales_date", F.when(F.col("_on_spine"), F.col("_m")).alias("hist_max_qty"))


# ------------------------------------------------------------ W1 - W4
STATS = ("max", "min", "std", "median", "avg")


def _stat(name: str, c: str):
    return {"max": F.max(c), "min": F.min(c), "std": F.stddev_samp(c),
            "median": F.percentile(F.col(c), 0.5), "avg": F.avg(c), "sum": F.sum(c),
            "count": F.count(c)}[name]


def rolling_sales_stats(df: DataFrame, targets: DataFrame, level: str, specs: Sequence[tuple[int, str]],
                        shift: int, name_fmt: str = "past_{n}_{stat}_aps") -> DataFrame:
    """Stats of daily mean qty over the last N spine dates (P8:
    NULL unless all N spine dates have a value), read at date - shift with
    forward fill over calendar days, NULL unless date - shift is on the spine.

    ``df`` is the (possibly filtered) frame that defines the spine and the
    values; ``targets`` are the (level, sales_date) rows that receive them."""
    sp = spine(df)
    daily = (daily_by_key(df, [level])
             .join(F.broadcast(sp), F.col("sales_date") == F.col("spine_date")).drop("spine_date"))
    cols = {}
    for n, stat in specs:
        w = Window.partitionBy(level).orderBy("spine_idx").rangeBetween(-(n - 1), 0)
        full = F.count("_v").over(w) == n
        cols[name_fmt.format(n=n, stat=stat)] = F.when(full, _stat(stat, "_v").over(w))
    rolled = daily.select(level, "sales_date", *[v.alias(f"_r_{k}") for k, v in cols.items()])
    filled = lookback(targets.select(level, "sales_date").distinct(), rolled, [level], "sales_date",
                      {k: last_value(f"_r_{k}") for k in cols}, lag=shift,
                      value_cols=[f"_r_{k}" for k in cols])
    filled = gate_on_spine(filled, sp, "sales_date", shift)
    return filled.select(level, "sales_date",
                         *[F.when(F.col("_on_spine"), F.col(k)).alias(k) for k in cols])


def rolling_all_prices(df: DataFrame, level: str, shift: int, exclude: DataFrame | None = None) -> DataFrame:
    """W1 for N in 1, 3, 7, 14, 21, 28 and max / min / std / median / avg
    (N = 1: avg only) on all rows: 26 columns. Excluded dates aren't on the spine;
    their rows are targets only."""
    specs = [(n, s) for n in (1, 3, 7, 14, 21, 28) for s in STATS if n > 1 or s == "avg"]
    return rolling_sales_stats(off_dates(df, exclude), df, level, specs, shift)


def md_split(df: DataFrame, marked_down: bool, rule: str = "reference") -> DataFrame:
    """P-6 / Q1: marked-down rows or full-price rows. ``reference`` keeps the
    reference's 0-decimal rounding (round(md) <= 0.9 keeps md <= 0.5);
    ``intent`` uses md <= 0.9."""
    key = F.rint("md1") if rule == "reference" else F.col("md1")
    return df.filter(key <= 0.9) if marked_down else df.filter(key > 0.9)


def rolling_markdown_only(df: DataFrame, level: str, shift: int, rule: str = "reference") -> DataFrame:
    """W1 for N in 2, 7, 14 and max / min / std / avg on marked-down rows."""
    specs = [(n, s) for n in (2, 7, 14) for s in ("max", "min", "std", "avg")]
    return rolling_sales_stats(md_split(df, True, rule), df, level, specs, shift,
                               name_fmt="past_{n}_{stat}_mdaps")


def rolling_full_price(df: DataFrame, level: str, shift: int, rule: str = "reference") -> DataFrame:
    """W1 for N in 7, 14 and std / avg on full-price rows."""
    specs = [(n, s) for n in (7, 14) for s in ("std", "avg")]
    return rolling_sales_stats(md_split(df, False, rule), df, level, specs, shift,
                               name_fmt="past_{n}_full_price_{stat}_aps")


# ----------------------------------------------------------------- W13
def markdown_rounds(df: DataFrame, level: str) -> DataFrame:
    """On md < 1 rows per (level, season, flag) in date order: md change
    versus the previous row, round number (running count of changes), day in
    round (0 on the day a later round begins; round 0 starts at 1)."""
    g = [level, "season1", "inseason_flag1"]
    b = df.filter(F.col("md1") < 1).select(*g, "sales_date", "md10")
    w = Window.partitionBy(*g).orderBy("sales_date")
    run = w.rowsBetween(UNBOUNDED, 0)
    diff = F.col("md10") - F.lag("md10").over(w)
    b = (b.withColumn("_d", diff)
         .withColumn("_new", F.coalesce(F.col("_d") != 0, F.lit(False)).cast("int"))
         .withColumn("md_diff", F.when(F.col("_new") == 1, F.col("_d") / 10.0).otherwise(F.lit(0.0)))
         .withColumn("cum_round", F.sum("_new").over(run).cast("long")))
    w2 = Window.partitionBy(*g, "cum_round").orderBy("sales_date").rowsBetween(UNBOUNDED, 0)
    b = b.withColumn("round_days", F.sum(1 - F.col("_new")).over(w2).cast("long"))
    return b.select(level, "inseason_flag1", "sales_date", "round_days", "md_diff", "cum_round")
