"""Model pipeline on Spark MLlib (SURVEY 2.2, 2.11: P-5, P-7, P-21, P-25 -
P-28, M1-M10).

Boosted trees are trained with ``GBTRegressor`` (distributed histogram
training). It is the same task as the reference's leaf-wise tree library,
not the same numbers: trees grow by level, and missing values are encoded as
a sentinel the trees can split on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, TargetEncoder, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.functions.rules import np_round, safe_div
from pricewise.operators.order_stats import in_order
from pricewise.session import drop_stage, materialize

MISSING = -999.0
ROWS_A_TASK = 50_000


# ------------------------------------------------------------ filters
def filter_modeling_rows(df: DataFrame, seasons: Sequence[str] | None = None, rm_dates: DataFrame | None = None,
                         off_season_remove: bool = True, full_price_remove: bool = True,
                         max_md: float = 0.95, drop: Sequence[str] = ()) -> DataFrame:
    """P-5: seasons in a list (else a season-prefix column is added), in-season
    rows only, RM dates removed (broadcast anti join), md <= 0.95; drop
    the listed columns."""
    x = df.filter(F.col("season1").isin(list(seasons))) if seasons else \
        df.withColumn("season", F.substring("season1", 1, 2))
    if off_season_remove:
        x = x.filter(F.col("inseason_flag1") == "Y")
    if rm_dates is not None:
        x = x.join(F.broadcast(rm_dates.select("sales_date").distinct()), "sales_date", "left_anti")
    if full_price_remove:
        x = x.filter(F.col("md") <= max_md)
    return x.drop(*[c for c in drop if c in x.columns])


def mask_recent_labels(df: DataFrame, fcst_date: str, lead: int, label: str = "sales_qty") -> DataFrame:
    """P-21: the label is NULL after forecast date - lead."""
    cut = F.date_sub(F.lit(fcst_date).cast("date"), lead)
    return df.withColumn(label, F.when(F.col("sales_date") > cut, F.lit(None).cast("double"))
                         .otherwise(F.col(label)))


def boost_label(df: DataFrame, numer: str, denom: str | None, out: str = "label") -> DataFrame:
    """P-27 + P-7: y = numer / denom (or numer); rows with NULL / inf y are
    dropped; label = log(y + 1)."""
    y = safe_div(numer, denom) if denom else F.col(numer).cast("double")
    return (df.withColumn("y", y).filter(F.col("y").isNotNull() & ~F.isnan("y"))
            .withColumn(out, F.log1p("y")))


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P-28: one row per column with its null rate (one aggregation pass,
    then unpivot)."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return one.unpivot([], cols, "column_name", "null_rate")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P-28, the other half: per numeric column the count, mean, standard deviation, least
    and largest value and exact quartiles. All columns are one table of (column, value,
    count); running counts along it give every quartile, so no task holds a column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column_name", "value")
    counts = materialize(long.where("value IS NOT NULL AND NOT isnan(value)").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    sums = counts.groupBy("column_name").agg(F.sum("n").alias("count"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"),
                                             F.min("value").alias("min"), F.max("value").alias("max"))
    ran = in_order(counts, [("column_name", False), ("value", False)], {"upto": F.col("n")}).drop("upto_all") \
        .join(F.broadcast(sums), "column_name")  # a row a column
    # the running count begins anew with each column
    start = ran.groupBy("column_name").agg(F.min(F.col("upto") - F.col("n")).alias("_start"))
    ran = ran.join(F.broadcast(start), "column_name").withColumn("upto", F.col("upto") - F.col("_start"))

    def at(p: float):
        h = (F.col("count") - 1) * p
        lower, upper = (F.min(F.when(F.col("upto") > f(h), F.col("value"))) for f in (F.floor, F.ceil))
        return lower + (upper - lower) * F.max(h - F.floor(h))
    out = ran.groupBy("column_name").agg(
        *[F.first(c).alias(c) for c in ("count", "mean", "min", "max")],
        F.sqrt(F.try_divide(F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), F.lit(2.0))), F.max("count") - 1)).alias("std"),
        *[at(p).alias(name) for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))])
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    return names.join(out, "column_name", "left").select("column_name", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", "p25",
                                                         "p50", "p75", "max")


def prune_sparse_columns(df: DataFrame, threshold: float = 0.98, keep: Sequence[str] = ()) -> DataFrame:
    """P-25: drop columns whose null rate >= threshold. The rates are one
    small row (one value per column) read on the driver."""
    cand = [c for c in df.columns if c not in set(keep)]
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cand]).first()
    dropped = [c for c in cand if row[c] is not None and row[c] >= threshold]
    return df.drop(*dropped)


def drop_overlapping_columns(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P-26: drop from ``left`` the columns ``right`` also has, except the keys."""
    return left.drop(*[c for c in right.columns if c in left.columns and c not in set(keys)])


def join_checked(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that fails if right keys are not unique (the row count
    would change). The check is part of the plan: keys are counted over the
    partitioning that the join uses, and a second row of a key raises an error
    when the query runs."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    once = F.assert_true(n == 1, F.lit("right side of the left join has duplicate keys; row count would change"))
    checked = right.withColumn("_once", once).filter("_once IS NULL").drop("_once")
    return left.join(checked, list(keys), "left")


# ------------------------------------------------------------ sampling
def resample_rows(df: DataFrame, rm_dates: DataFrame, keep_since: str, under: float, upper: float,
                  seed: int = 82, keys: Sequence[str] | None = None) -> DataFrame:
    """M1: keep RM rows and rows since ``keep_since`` whole, sample the others
    at ``under``, and add an extra sample of RM rows at ``upper``. Which rows are
    drawn follows from a hash of their ``keys`` (all columns by default), not from
    files or partitions."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys or df.columns]

    def share(k: int):
        return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(k)), *text)), 1, 8), 16, 10).cast("double") / float(16 ** 8)
    rm = F.broadcast(rm_dates.select("sales_date").distinct().withColumn("_rm", F.lit(True)))
    x = df.join(rm, "sales_date", "left").fillna(False, subset=["_rm"])
    keep = F.col("_rm") | (F.col("sales_date") >= F.lit(keep_since).cast("date"))
    out = (x.filter(keep)
           .unionByName(x.filter(~keep & (share(seed) < under)))
           .unionByName(x.filter(F.col("_rm") & (share(seed + 1) < upper))))
    return out.drop("_rm")


# ------------------------------------------------------------ training
def feature_split(df: DataFrame, exclude: Sequence[str]) -> tuple[list[str], list[str]]:
    """M2: numeric and text columns by schema, keys and label excluded."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in set(exclude):
            continue
        if isinstance(f.dataType, T.NumericType | T.BooleanType):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    return num, cat


def encoders(num: Sequence[str], cat: Sequence[str], smoothing: float = 20.0) -> Pipeline:
    """M2: index categories (unknown kept), encode each by its smoothed mean label (a
    grouped aggregate, the same for any number of values; unknown ones get the mean of
    all), assemble."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in cat]
    mean = [TargetEncoder(inputCols=[f"{c}__idx" for c in cat], outputCols=[f"{c}__mean" for c in cat], labelCol="label",
                          targetType="continuous", smoothing=smoothing, handleInvalid="keep")] if cat else []
    # "+ 0" drops the column's mark as a category, which the encoder leaves on it
    plain = SQLTransformer(statement=", ".join(["SELECT *", *(f"`{c}__mean` + 0 AS `{c}__num`" for c in cat)]) + " FROM __THIS__")
    vec = VectorAssembler(inputCols=list(num) + [f"{c}__num" for c in cat], outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[*idx, *mean, plain, vec])


def fit_trees(train: DataFrame, num: Sequence[str], cat: Sequence[str], keys: Sequence[str], max_iter: int = 900,
              max_depth: int = 6, step: float = 0.07, seed: int = 82, bins: int = 255, min_leaf: int = 20,
              held_out: float = 0.1, tolerance: float = 0.01, first: int = 25) -> tuple[PipelineModel, list[float]]:
    """M2 + M4: (model, held-out loss after each round tried). Boosted trees at the
    reference's rate, with its number of rounds as the upper limit; a level-wise depth
    of 6 has up to 64 leaves, the nearest to its 45. ``bins`` and ``min_leaf`` are the
    defaults of its library.

    Stop rule: a share of the training rows, by a hash of ``keys``, is held out. Rounds
    double from ``first`` on as long as that betters the held-out squared loss by
    ``tolerance`` of it at least; the last number that did is the model's. (A longer
    run begins with the trees of the shorter one, so all runs have one loss curve.)"""
    fit, held = split_by_key(train, keys, 1 - held_out, seed + 1)
    prepared = encoders(num, cat).fit(fit)
    # the boosting reads its rows once a level and round: they are stored as vectors
    fit, held = (materialize(prepared.transform(x).select("features", "label"), "training_rows") for x in (fit, held))
    # a job per level and round: no more tasks than the rows are worth
    few = fit.coalesce(1 + fit.count() // ROWS_A_TASK)

    def run(rounds: int):
        model = GBTRegressor(featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=max_depth, stepSize=step, seed=seed,
                             maxBins=bins, minInstancesPerNode=min_leaf, lossType="squared").fit(few)
        return model, [] if held.isEmpty() else model.evaluateEachIteration(held, "squared")

    model, loss = run(min(first, max_iter))
    rounds = len(loss)
    while loss and rounds < max_iter:
        longer, loss = run(min(2 * rounds, max_iter))
        if loss[-1] > loss[rounds - 1] * (1 - tolerance):
            break
        model, rounds = longer, len(loss)
    for rows in (fit, held):
        drop_stage(rows)
    return PipelineModel([*prepared.stages, model]), loss


def split_by_key(df: DataFrame, keys: Sequence[str], train_ratio: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """M3: (train, test) by a hash of the key columns, so the split is the same
    however the rows lie in files or partitions."""
    share = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 30)) / float(1 << 30)
    return df.filter(share < train_ratio), df.filter(share >= train_ratio)


def encode_missing(df: DataFrame, num: Sequence[str]) -> DataFrame:
    """Missing numeric values, NaN among them (P6) -> sentinel (trees split on it)."""
    return df.fillna(MISSING, subset=list(num))


def score_forecast(model: PipelineModel, df: DataFrame, denom: str | None) -> DataFrame:
    """M5: predict = max(exp(prediction) - 1, 0); forecast qty = denom x
    predict rounded (or predict itself)."""
    out = model.transform(df).withColumn("predict", F.greatest(F.expm1("prediction"), F.lit(0.0)))
    qty = np_round(F.col(denom) * F.col("predict"), 0) if denom else F.col("predict")
    return out.withColumn("predict_sales_qty", qty)


def feature_importance(model: PipelineModel, num: Sequence[str], cat: Sequence[str]) -> list[tuple[str, float]]:
    """M4: feature importances, largest first (a short list, one per feature)."""
    gbt = model.stages[-1]
    names = list(num) + list(cat)
    imp = gbt.featureImportances.toArray()
    return sorted(zip(names, imp.tolist()), key=lambda t: -t[1])


def train_evaluate(df: DataFrame, path: str, level: str, numer: str, denom: str | None, train_ratio: float = 0.75,
                   seed: int = 82, exclude: Sequence[str] = ("sales_date",), **params) -> DataFrame:
    """M8: label, sparse-column pruning, split, fit (M2-M4), and under ``path`` the model
    (M7), its held-out loss by round, and the test rows as scored by the model read back
    (M5). Returns the scored table."""
    # many passes follow (null rates, encoders, split, boosting): cut the
    # lineage once into the checkpoint folder instead of recomputing windows
    rows = materialize(boost_label(df, numer, denom), "model_table")
    x = prune_sparse_columns(rows, 0.98, keep=[level, "sales_date", "label", "y", numer] + ([denom] if denom else []))
    excl = set(exclude) | {level, "label", "y", numer}
    num, cat = feature_split(x, list(excl))
    x = encode_missing(x, num)
    train, test = split_by_key(x, [level, "sales_date"], train_ratio, seed)
    model, loss = fit_trees(train, num, cat, [level, "sales_date"], seed=seed, **params)
    spark = df.sparkSession
    save_model(model, f"{path}/model")
    rounds = model.stages[-1].getNumTrees
    spark.createDataFrame([(k, v, k <= rounds) for k, v in enumerate(loss, 1)], "round int, held_out_loss double, kept boolean").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/loss")
    score_forecast(load_model(f"{path}/model"), test, denom).drop("features").write.mode("overwrite").parquet(f"{path}/scored")
    drop_stage(rows)
    return spark.read.parquet(f"{path}/scored")


def save_model(model: PipelineModel, path: str) -> None:
    """M7: persist the fitted pipeline (feature list included in its stages)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> tuple[list[str], list[str]]:
    """M7: the numeric and text columns a fitted pipeline reads."""
    vec = next(s for s in model.stages if isinstance(s, VectorAssembler))
    cat = [s.getInputCol() for s in model.stages if isinstance(s, StringIndexerModel)]
    return [c for c in vec.getInputCols() if c not in {f"{x}__num" for x in cat}], cat


def forecast_one_day(model: PipelineModel, features: DataFrame, fcst_date: str, denom: str | None) -> DataFrame:
    """M9: rows of the forecast date, encoded as in training, scored. A row without a
    denominator has a predicted boost but no quantity."""
    day = features.filter(F.col("sales_date") == F.lit(fcst_date).cast("date"))
    if denom is None:
        return score_forecast(model, encode_missing(day, model_features(model)[0]), None)
    scored = score_forecast(model, encode_missing(day.withColumn("_denom", F.col(denom)), model_features(model)[0]), denom)
    return scored.withColumn(denom, F.col("_denom")).withColumn(
        "predict_sales_qty", F.when(F.col("_denom").isNotNull(), F.col("predict_sales_qty"))).drop("_denom")
