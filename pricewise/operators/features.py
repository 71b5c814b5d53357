"""The feature table: every per-day feature joined to the base rows of one level
(SURVEY 2.3: J8, J10, P-26 over W1-W5, W7, W9, W11, W16, W18, J2, J6).
W8 is left out: on a day with rows of two seasons it has two rows per key (Q6).

The caller passes base rows that are stored once (``session.materialize``), so the
features read that stage and not the fact tables again. Each part has one row per
key, which the join checks as it runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.frames import spine
from pricewise.operators import competition as cp
from pricewise.operators import ingest
from pricewise.operators import modeling as md
from pricewise.operators import state as st
from pricewise.operators import timefeatures as tf


def attach(rows: DataFrame, part: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns that both have are taken from ``part``; a second row of a key in
    ``part`` is an error."""
    return md.join_checked(md.drop_overlapping_columns(rows, part, keys), part, keys)


def modeling_features(rows: DataFrame, level: str, shift: int, lead: int, inventory: DataFrame,
                      traffic: DataFrame, stores: Sequence[str]) -> DataFrame:
    """One row per (level, date) of ``rows`` with the rolling, same-md and history
    features, inventory as known 1 + lead days before the sale, its rank, and site
    traffic. ``inventory`` has (level, sales_date, lead_inv_qty)."""
    day, day_md = [level, "sales_date"], [level, "md10", "sales_date"]
    out = rows
    for part, keys in (
            (tf.rolling_all_prices(rows, level, shift), day),
            (tf.rolling_markdown_only(rows, level, shift), day),
            (tf.rolling_full_price(rows, level, shift), day),
            (tf.same_md_history(rows, level, shift), day_md),
            (tf.historic_md_avg(rows, level), day),
            (tf.historic_max_qty(rows, level, lead), day),
            (tf.days_on_market(rows, level), day),
            (inventory, day)):
        out = attach(out, part, keys)
    out = tf.same_md_frequency(out, level)
    out = cp.inventory_rank(out, ["sales_date", "gender_group"], "lead_inv_qty")
    return ingest.join_site_traffic(out, traffic, stores).withColumn("site_traffic", F.col("site_traffic").cast("long"))


def forecast_features(history: DataFrame, day_rows: DataFrame, level: str, day: str, shift: int, lead: int, inventory: DataFrame,
                      traffic: DataFrame, stores: Sequence[str]) -> DataFrame:
    """M9: :func:`modeling_features` of the rows of one day, after ``history`` (rows before
    it), from states as of the days that the features may look back to: no window runs
    over the history. ``inventory`` has (level, lead_inv_qty) known for the day."""
    before, known, led = ((dt.date.fromisoformat(day) - dt.timedelta(days=k)).isoformat() for k in (1, shift, lead))
    seen = history.filter(F.col("sales_date") <= F.lit(known).cast("date"))
    out, key, md_key = day_rows, [level], [level, "md10"]

    def on_spine(rows, part, keys, cols, upto):
        """Columns of ``part``, NULL unless the day looked back to is a date of ``rows``."""
        there = rows.filter(F.col("sales_date") == F.lit(upto).cast("date")).isEmpty()
        return attach(out, part.select(*keys, *[(F.lit(None).cast("double") if there else F.col(c)).alias(c) for c in cols]), keys)

    for rows, specs, names in ((seen, _specs((1, 3, 7, 14, 21, 28), tf.STATS), "past_{n}_{stat}_aps"),
                               (tf.md_split(seen, True), _specs((2, 7, 14), ("max", "min", "std", "avg")), "past_{n}_{stat}_mdaps"),
                               (tf.md_split(seen, False), _specs((7, 14), ("std", "avg")), "past_{n}_full_price_{stat}_aps")):
        part = st.last_complete_windows(rows, spine(rows), level, specs, names)
        out = on_spine(rows, part, key, [c for c in part.columns if c != level], known)
    md = st.state_of(st.md_days(history, level), md_key, before)
    md_known = st.state_of(st.md_days(seen, level), md_key, known).select(
        *md_key, F.col("v_max").alias("same_md_hist_max_aps"), F.col("v_min").alias("same_md_hist_min_aps"),
        F.try_divide("v_sum", "v_n").alias("same_md_hist_mean_aps"))
    out = on_spine(seen, md_known, md_key, md_known.columns[2:], known)
    daily = st.days(history, level)
    q = st.state_of(daily, key, led).select(level, F.col("q_max").alias("hist_max_qty"))
    out = on_spine(history, q, key, ["hist_max_qty"], led)
    days = st.state_of(daily, key, before).select(level, (F.try_divide("md_sum", "md_days") / 10.0).alias("hist_md_avg"), "n_rows", "n_inseason")
    out = attach(attach(out, days, key), md.select(*md_key, F.col("n_rows").alias("_same_md")), md_key)
    own, own_md = Window.partitionBy(level), Window.partitionBy(*md_key)
    flagged = F.sum(F.when(F.col("inseason_flag1") == "Y", 1).otherwise(0)).over(own)
    out = out.withColumns({"num_days_on_mkt": F.coalesce("n_rows", F.lit(0)) + F.count(F.lit(1)).over(own),
                           "num_days_on_mkt_inseason": F.coalesce("n_inseason", F.lit(0)) + flagged,
                           "same_md_hist_frequency": F.coalesce("_same_md", F.lit(0)) + F.count(F.lit(1)).over(own_md)}) \
        .drop("n_rows", "n_inseason", "_same_md")
    out = cp.inventory_rank(attach(out, inventory, key), ["sales_date", "gender_group"], "lead_inv_qty")
    return ingest.join_site_traffic(out, traffic, stores).withColumn("site_traffic", F.col("site_traffic").cast("long"))


def _specs(lengths: Sequence[int], stats: Sequence[str]) -> list[tuple[int, str]]:
    return [(n, s) for n in lengths for s in stats if n > 1 or s == "avg"]
