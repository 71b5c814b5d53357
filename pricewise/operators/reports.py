"""Forecast metrics and reports (SURVEY 2.4-2.6, 2.11: M6, A15-A19,
W22, W23, O3).

Group reports use grouping sets so one aggregation pass gives the total
and the per-group rows. Medians, quantile edges, running shares and running medians
come from :mod:`pricewise.operators.order_stats`: no task orders a whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.functions.rules import np_round, safe_div
from pricewise.operators.order_stats import in_order, quantiles, running_median
from pricewise.session import materialize

PRED = "predict_sales_qty"


def forecast_metrics(scored: DataFrame, threshold: float = 0.3, pred: str = PRED) -> DataFrame:
    """M6: amounts and errors of a scored table (rows with a forecast)."""
    p = np_round(pred, 0)
    return (scored.filter(F.col(pred).isNotNull())
            .withColumn("fcst_amt", p * F.col("AUR"))
            .withColumn("real_amt", F.col("sales_qty") * F.col("AUR"))
            .withColumn("MAPE", F.abs(safe_div(p, "sales_qty") - 1))
            .withColumn("MAPE_qty", safe_div(F.abs(F.col(pred) - F.col("sales_qty")), "sales_qty"))
            .withColumn("within", F.coalesce(F.col("MAPE") <= threshold, F.lit(False)))
            .withColumn("predict_minus_real", safe_div(F.col(pred) - F.col("sales_qty"), "sales_qty")))


def forecast_summary(scored: DataFrame, by: str = "gender_group", full_price_md: float = 0.8,
                     pred: str = PRED) -> DataFrame:
    """Total qty and revenue of the forecast, share of full-price rows,
    qty and revenue; overall (is_total = 1, also of no rows) and per group. Rows without
    a group count in the total only (P3). The total adds up the groups' sums."""
    rev = F.col(pred) * F.col("AUR")
    full = F.col("md") > full_price_md
    sums = {"tot_qty": F.col(pred), "tot_rev": rev, "_rows": F.lit(1), "_full": F.when(full, 1).otherwise(0),
            "_full_qty": F.when(full, F.col(pred)).otherwise(0.0), "_full_rev": F.when(full, rev).otherwise(0.0)}
    groups = scored.filter(F.col(pred).isNotNull()).groupBy(by).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    total = groups.agg(*[F.sum(n).alias(n) for n in sums]).withColumn("is_total", F.lit(1))
    out = groups.filter(F.col(by).isNotNull()).withColumn("is_total", F.lit(0)).unionByName(total, allowMissingColumns=True)
    return out.select(by, "tot_qty", "tot_rev", safe_div("_full", "_rows").alias("full_price_share"),
                      safe_div("_full_qty", "tot_qty").alias("full_price_qty_share"),
                      safe_div("_full_rev", "tot_rev").alias("full_price_amt_share"), "is_total")


def error_by_group(metrics: DataFrame, g1: str = "gender_group", g2: str = "gc_category",
                   pred: str = PRED) -> DataFrame:
    """Sums of forecast / real qty and amount and their ratio - 1, by
    gender and by gender x category (grouping sets); groups without a key are
    dropped (P3)."""
    sums = [F.sum("fcst_amt").alias("fcst_amt"), F.sum("real_amt").alias("real_amt"),
            F.sum(np_round(pred, 0)).alias(pred), F.sum("sales_qty").alias("sales_qty")]
    g = metrics.groupingSets([[g1], [g1, g2]], g1, g2).agg(*sums, F.grouping(g2).cast("int").alias("by_gender"))
    g = g.filter(F.col(g1).isNotNull() & ((F.col("by_gender") == 1) | F.col(g2).isNotNull()))
    return (g.withColumn("mape_amt", safe_div("fcst_amt", "real_amt") - 1)
            .withColumn("mape_qty", safe_div(pred, "sales_qty") - 1))


def accuracy_share(metrics: DataFrame, key: str = "style_cd") -> DataFrame:
    """Amount, qty and row count of rows within / outside the error
    threshold, plus a share row (within / total)."""
    cols = ["real_amt", "sales_qty", "n_rows"]
    g = (metrics.groupBy(F.col("within").alias("_w"))
         .agg(F.sum("real_amt").alias("real_amt"), F.sum("sales_qty").alias("sales_qty"),
              F.count(key).cast("double").alias("n_rows")))
    # the table is read once: two rows, gathered into one, give all three
    one = g.agg(*[F.sum(F.when(F.col("_w") == w, F.col(c))).alias(f"{t}_{c}") for w, t in ((True, "w"), (False, "o")) for c in cols],
                *[F.sum(c).alias(f"t_{c}") for c in cols],
                *[F.max(F.col("_w") == w).alias(f"has_{t}") for w, t in ((True, "w"), (False, "o"))])

    def row(name, there, make):
        return F.struct(F.lit(name).alias("bucket"), *[make(c).alias(c) for c in cols], there.alias("_there"))
    rows = F.array(row("within", F.coalesce("has_w", F.lit(False)), lambda c: F.col(f"w_{c}")),
                   row("outside", F.coalesce("has_o", F.lit(False)), lambda c: F.col(f"o_{c}")),
                   row("share", F.lit(True), lambda c: safe_div(F.coalesce(f"w_{c}", F.lit(0.0)), f"t_{c}")))
    return one.select(F.inline(rows)).filter("_there").drop("_there")


def weighted_accuracy(metrics: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Median error; qty-weighted and row share of rows with error <= threshold. The
    median is selected exactly, without one task that holds the errors."""
    metrics = materialize(metrics.select("MAPE_qty", "sales_qty"), "errors")
    median = quantiles(metrics, "MAPE_qty", [0.5])[0]
    ok = F.col("MAPE_qty") <= threshold
    return metrics.agg(F.lit(median).cast("double").alias("median_mape"),
                       safe_div(F.sum(F.when(ok, F.col("sales_qty")).otherwise(0.0)), F.sum("sales_qty")).alias("qty_share_within"),
                       (F.sum(F.when(ok, 1).otherwise(0)) / F.count(F.lit(1))).alias("row_share_within"))


def _by_product(metrics: DataFrame, level: str, pred: str) -> DataFrame:
    return metrics.groupBy(level).agg(F.sum("sales_qty").alias("sales_qty"), F.sum(pred).alias(pred)) \
        .withColumn("MAPE", F.abs(safe_div(pred, "sales_qty") - 1))


def running_share(rows: DataFrame, keys: Sequence[str], out: str = "cum_prct") -> DataFrame:
    """Running share of the total qty in descending qty order (ties by ``keys``, which
    tell rows apart); a row without qty has none (it comes last and adds nothing)."""
    ran = in_order(rows, [("sales_qty", True), *((k, False) for k in keys)], {"_ran": F.coalesce("sales_qty", F.lit(0.0))})
    return ran.withColumn(out, F.when(F.col("sales_qty").isNotNull(), safe_div("_ran", "_ran_all"))).drop("_ran", "_ran_all")


def cumulative_share(metrics: DataFrame, level: str, share: float = 0.3, pred: str = PRED) -> DataFrame:
    """W22 + W23 + O3: per product: qty, forecast, error; running share of
    total qty in descending qty order (ties by key); running median of the
    error; flag of the smallest top set reaching ``share``. Products are ordered in
    ranges and chunks, never in one task."""
    a = running_median(_by_product(metrics, level, pred), [("sales_qty", True), (level, False)], "MAPE", "median_mape")
    return running_share(a, [level]).withColumn("in_top_share", (F.col("cum_prct") <= share).cast("int"))


def top_share_medians(metrics: DataFrame, level: str, keys: Sequence[str], share: float = 0.3, pred: str = PRED) -> DataFrame:
    """W22 + O3: the median error of the rows that make up the first ``share`` of total
    qty, in descending order: one row for table rows (told apart by ``keys``), one for
    products (``level``)."""
    out = []
    metrics = materialize(metrics.select(*dict.fromkeys([*keys, level, "sales_qty", "MAPE", pred])), "metrics")  # ordered in ranges twice
    for grain, rows, by in (("row", metrics.select(*keys, "sales_qty", "MAPE"), keys), ("product", _by_product(metrics, level, pred), [level])):
        top = materialize(running_share(rows, by).where(F.col("cum_prct") <= share).select("MAPE"), "top-share")
        out.append((grain, top.count(), quantiles(top, "MAPE", [0.5])[0]))
    return metrics.sparkSession.createDataFrame(out, "grain string, n_rows long, median_mape double")


#: The numbers of each part of the report set.
SUMMARY = ["tot_qty", "tot_rev", "full_price_share", "full_price_qty_share", "full_price_amt_share"]
ERRORS = ["fcst_amt", "real_amt", PRED, "sales_qty", "mape_amt", "mape_qty"]
ACCURACY = ["real_amt", "sales_qty", "n_rows"]
PRODUCTS = ["sales_qty", PRED, "MAPE", "cum_prct", "median_mape"]


def _long(df: DataFrame, report: str, one, two, values: Sequence[str]) -> DataFrame:
    """(report, group_1, group_2, metric, value) of a report's numbers."""
    named = df.select(F.lit(report).alias("report"), one.cast("string").alias("group_1"), two.cast("string").alias("group_2"),
                      *[F.col(v).cast("double").alias(v) for v in values])
    return named.unpivot(["report", "group_1", "group_2"], list(values), "metric", "value")


def evaluate_report(scored: DataFrame, is_forecast: bool, level: str, keys: Sequence[str], by: str = "gender_group",
                    by2: str = "gc_category", threshold: float = 0.33, share: float = 0.3, pred: str = PRED) -> DataFrame:
    """The report set of a scored table, in long form. Of a real forecast: A15. Of a
    back-test: errors by group (A16), accuracy (A17), products with running share and
    running median error (W22, W23), median errors of the top share (O3). ``keys`` tell
    the table's rows apart."""
    none = F.lit(None)
    if is_forecast:
        group = F.when(F.col("is_total") == 1, F.lit("total")).otherwise(F.col(by))
        return _long(forecast_summary(scored, by, pred=pred), "summary", group, none, SUMMARY)
    metrics = materialize(forecast_metrics(scored, threshold, pred), "metrics")
    return _long(error_by_group(metrics, by, by2, pred), "error", F.col(by), F.col(by2), ERRORS) \
        .unionByName(_long(accuracy_share(metrics, level), "accuracy", F.col("bucket"), none, ACCURACY)) \
        .unionByName(_long(cumulative_share(metrics, level, share, pred), "product", F.col(level), none, PRODUCTS)) \
        .unionByName(_long(top_share_medians(metrics, level, keys, share, pred), "top_share", F.col("grain"), none, ["median_mape"]))


def confusion_matrix(scored: DataFrame, real: str, predicted: str, bins: int = 15) -> DataFrame:
    """edges = quantiles of the rounded real boost (duplicates dropped);
    real and predicted boosts are cut on the same right-closed edges, the lowest
    of which is open a thousandth below, so that a boost equal to it is in the
    first bin; counts per (real bin, predicted bin) and the diagonal share."""
    x = materialize(scored.select(F.rint(real).alias("_rb"), F.col(predicted).alias("_pb")), "boosts")
    edges = sorted({e for e in quantiles(x, "_rb", [i / bins for i in range(bins + 1)]) if e is not None})
    if not edges:
        edges = [0.0]  # no real boost: no rows

    def bin_of(c):
        # index i such that e[i-1] < v <= e[i], with e[0] lowered
        v = F.col(c)
        i = sum(((v > e).cast("int") for e in edges[1:]), (v > edges[0]).cast("int"))
        return F.when((v > edges[0] - 0.001) & (v <= edges[-1]), F.greatest(F.lit(1), i))

    cm = (x.select(bin_of("_rb").alias("real_bin"), bin_of("_pb").alias("pred_bin"))
          .filter(F.col("real_bin").isNotNull() & F.col("pred_bin").isNotNull())
          .groupBy("real_bin", "pred_bin").count())
    w = Window.partitionBy()  # (bins + 1) ** 2 rows at most
    return cm.withColumn("diag_share", F.sum(F.when(F.col("real_bin") == F.col("pred_bin"), F.col("count"))
                                              .otherwise(0)).over(w) / F.sum("count").over(w))
