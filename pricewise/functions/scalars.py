"""Scalar column functions.

Built-in expressions only (string, array and higher-order functions), so
they run inside whole-stage codegen; no Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.rules import right_closed_bins
from pricewise.session import materialize


def style_code(prod_code: str = "prod_code") -> Column:
    """first 6 characters of the product code."""
    return F.substring(prod_code, 1, 6)


def base_color(prod_code: str = "prod_code") -> Column:
    """third character from the end of the product code."""
    return F.substring(prod_code, -3, 1)


def color_words(desc: Column, lexicon: Column, pos: int) -> Column:
    """lower-case; split by "/" and take part ``pos``; split it by space
    or hyphen; with several words keep the lexicon words, distinct, sorted,
    joined by a space; otherwise (one word, or no such part) the whole
    lower-cased description (Q4)."""
    low = F.lower(desc)
    part = F.get(F.split(low, "/"), pos)
    words = F.split(part, "[- ]")
    picked = F.array_join(F.array_sort(F.array_distinct(F.array_intersect(words, lexicon))), " ")
    return F.when(part.isNotNull() & (F.size(words) > 1), picked).otherwise(low)


def with_color_features(df: DataFrame, lexicon: DataFrame, desc: str = "color_desc",
                        word: str = "color") -> DataFrame:
    """F2 + F3 for every row: base colour and major / minor colour words. The words of
    the distinct descriptions are joined with the lexicon, so the work is that of the
    catalog, not of the rows, and the lexicon may be of any size."""
    low = F.lower(desc)
    texts = df.select(F.col(desc).alias("_desc")).where("_desc IS NOT NULL").distinct()
    parts = texts.select("_desc", F.posexplode(F.slice(F.split(F.lower("_desc"), "/"), 1, 2)).alias("_pos", "_part")) \
        .withColumn("_words", F.split("_part", "[- ]")).where(F.size("_words") > 1)
    found = parts.select("_desc", "_pos", F.explode(F.array_distinct("_words")).alias("_word")) \
        .join(lexicon.select(F.col(word).alias("_word")).distinct(), "_word", "left_semi") \
        .groupBy("_desc", "_pos").agg(F.array_join(F.array_sort(F.collect_set("_word")), " ").alias("_picked"))
    picked = parts.select("_desc", "_pos").join(found, ["_desc", "_pos"], "left").groupBy("_desc").agg(
        *[F.max(F.when(F.col("_pos") == k, F.coalesce("_picked", F.lit("")))).alias(c) for k, c in enumerate(("_major", "_minor"))])
    return (df.join(picked, F.col(desc) == F.col("_desc"), "left")
            .withColumn("base_color", base_color())
            .withColumn("major_color_desc", F.coalesce("_major", low))
            .withColumn("minor_color_desc", F.coalesce("_minor", low))
            .drop("_desc", "_major", "_minor"))


def season_text(season: Column) -> Column:
    """season prefix (SP / SU / FA / HO)."""
    return F.substring(season, 1, 2)


# Price bucket edges and labels (right-closed, P-13).
MSRP_EDGES = [0, 300, 500, 700, 1000]
MSRP_LABELS = [300, 500, 700, 1000, 3000]
AUR_EDGES = [0, 200, 400, 600, 800, 1000]
AUR_LABELS = [200, 400, 600, 800, 1000, 3000]


def price_buckets(df: DataFrame) -> DataFrame:
    """P-13 + P-14: right-closed MSRP and AUR bands whose last edge is the
    frame maximum, and MSRP position (MSRP - min) / (max - min). The three numbers
    are read first, from a stage of the frame, and enter the plan as constants."""
    df = materialize(df, "priced")
    low, high, most = (F.lit(v).cast("double") for v in df.agg(F.min("MSRP"), F.max("MSRP"), F.max("AUR")).first())
    return (df.withColumn("price_band", right_closed_bins("MSRP", MSRP_EDGES + [high], MSRP_LABELS))
            .withColumn("AUR_band", right_closed_bins("AUR", AUR_EDGES + [most], AUR_LABELS))
            .withColumn("MSRP_pos", F.try_divide(F.col("MSRP") - low, high - low)))


def fill_missing(df: DataFrame, defaults: dict) -> DataFrame:
    """P-18: default values for NULL attributes / features."""
    return df.fillna(defaults)


def override_on_date(df: DataFrame, column: str, date: str, value) -> DataFrame:
    """P-19: replace a column's value on one date (e.g. planned site traffic)."""
    return df.withColumn(column, F.when(F.col("sales_date") == F.lit(date).cast("date"), F.lit(value))
                         .otherwise(F.col(column)))


def days_since_columns(df: DataFrame, season_start: DataFrame,
                       pairs: Sequence[tuple[str, str]] = (
                           ("days_from_inseason_1st_day", "inseason_1st_day"),
                           ("days_from_hist_1st_day", "first_sales_date"),
                           ("days_from_this_md_first_day", "this_md_first_day"))) -> DataFrame:
    """P-22: day differences to the in-season first day, the first sale, the
    first day at this md, and the season begin (season -> start date from a
    broadcast dimension; unmapped seasons give NULL, Q14)."""
    x = df.join(F.broadcast(season_start.select("season1", F.col("season_start").alias("season_begin_date"))),
                "season1", "left")
    for out, c in pairs:
        if c in x.columns:
            x = x.withColumn(out, F.datediff("sales_date", c).cast("long"))
    return x.withColumn("days_from_season_begins", F.datediff("sales_date", "season_begin_date").cast("long"))


def pivot_daily(df: DataFrame, level: str, value: str = "sales_qty", how: str = "mean",
                columns: Sequence[str] | None = None) -> DataFrame:
    """Date x product crosstab as a user-facing report. ``columns``
    fixes the pivot values (no extra pass to find them)."""
    agg = {"mean": F.avg, "sum": F.sum, "count": F.count}[how]
    g = df.groupBy("sales_date").pivot(level, list(columns) if columns else None)
    return g.agg(agg(value))


def unpivot_long(wide: DataFrame, id_col: str, value_name: str, var_name: str) -> DataFrame:
    """Wide matrix back to long rows, NULL cells dropped."""
    cols = [c for c in wide.columns if c != id_col]
    return wide.unpivot([id_col], cols, var_name, value_name).filter(F.col(value_name).isNotNull())


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """A21 ``first`` aggregate with a defined order: min_by / row_number."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
