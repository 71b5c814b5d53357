"""Registered plans: model training and scoring (P-5, P-7, P-21, P-25, P-27, M1-M5,
M7-M10, A19). No SQL oracle: boosted-tree training is iterative, so the driver records
a rows-only check."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions import scalars
from pricewise.operators import competition as cp
from pricewise.operators import modeling as md
from pricewise.operators import reports as rp
from pricewise.plans import base
from pricewise.plans.catalog import register
from pricewise.plans.q_features import day_feature_rows, feature_rows
from pricewise.session import path_exists, stage_path
from pricewise.sources.fixtures import read_table

#: The reference's settings, its dates moved to the fixture's years.
SEASONS = ["FA1999", "FA2000", "SU2001", "FA2001"]
KEEP_SINCE, UNDER, UPPER, SEED, RATIO = "2001-04-01", 0.75, 0.15, 82, 0.99
NUMER, DENOM = "sales_qty", "past_3_median_aps"
#: Not known before the sale, or a key.
UNKNOWN = ["sales_amt", "inv_qty", "md", "md10", "grp", "prod_code", "platform", "style_number", "division", "color_desc"]


def training_rows(spark, sf_dir) -> DataFrame:
    """The feature table at style level, as the reference trains on it: rows of the
    training seasons (P-5, its other filters off), labels after forecast date - lead
    masked (P-21), and resampled (M1)."""
    x = md.filter_modeling_rows(cp.aur(feature_rows(spark, sf_dir, "style_cd")), SEASONS, off_season_remove=False,
                                full_price_remove=False, drop=UNKNOWN)
    x = md.mask_recent_labels(x, base.FCST_DATE, base.LEAD)
    rm = base.views(spark, sf_dir).rm_calendar()
    return md.resample_rows(x, rm, KEEP_SINCE, UNDER, UPPER, SEED, ["style_cd", "sales_date"])


def trained(spark, sf_dir) -> str:
    """The folder of the model, its loss and its scored test rows: trained once an
    application and set of input files, then read."""
    files = sorted(read_table(spark, sf_dir, "lineitem").inputFiles())
    path = stage_path(spark, "model-" + hashlib.md5("|".join(files).encode()).hexdigest())
    if not path_exists(spark, f"{path}/scored/_SUCCESS"):
        md.train_evaluate(training_rows(spark, sf_dir), path, "style_cd", NUMER, DENOM, RATIO, SEED)
    return path


@register("train_boosted_trees")
def train_boosted_trees(spark, sf_dir):
    """M8: sales boost (qty / past-3 median APS) -> log1p label (P-7, P-27), sparse columns
    pruned (P-25), 99 / 1 split by key (M3), boosted trees (M2, M4), stored and read back
    (M7); the test rows scored (M5: predict >= 0, forecast qty = denominator x boost)."""
    return spark.read.parquet(f"{trained(spark, sf_dir)}/scored").select(
        "style_cd", "sales_date", NUMER, DENOM, "prediction", "predict", "predict_sales_qty")


@register("training_loss")
def training_loss(spark, sf_dir):
    """M4: squared held-out loss of the label after each round tried, and whether the
    stored model keeps the round."""
    return spark.read.parquet(f"{trained(spark, sf_dir)}/loss")


@register("boost_confusion_matrix")
def boost_confusion_matrix(spark, sf_dir):
    """A19 on the stored scored test rows: 15 quantile bins of the real boost, the
    predicted boost cut on the same edges, counts and diagonal share."""
    scored = spark.read.parquet(f"{trained(spark, sf_dir)}/scored").withColumn("y", F.try_divide(NUMER, DENOM))
    return rp.confusion_matrix(scored, "y", "predict", 15)


def forecast_rows(spark, sf_dir):
    """The planned rows of the forecast day as the model reads them: features from states,
    planned traffic (P-19), the reference's filter (P-5)."""
    x = scalars.override_on_date(day_feature_rows(spark, sf_dir), "site_traffic", base.FCST_DATE, base.FCST_TRAFFIC)
    return md.filter_modeling_rows(cp.aur(x, base.FCST_DATE), SEASONS, off_season_remove=False, full_price_remove=False)


@register("forecast_one_day")
def forecast_one_day(spark, sf_dir):
    """M9: the planned products of the forecast day, scored by the stored model; forecast
    qty = denominator x predicted boost, NULL without a denominator."""
    model = md.load_model(f"{trained(spark, sf_dir)}/model")
    scored = md.forecast_one_day(model, forecast_rows(spark, sf_dir), base.FCST_DATE, DENOM)
    return scored.select("style_cd", "sales_date", "gender_group", "gc_category", "md", "AUR", DENOM, "predict", "predict_sales_qty")


@register("evaluate_one_day")
def evaluate_one_day(spark, sf_dir):
    """M9 + M10: the report set of the forecast day."""
    return rp.evaluate_report(forecast_one_day(spark, sf_dir), True, "style_cd", ["style_cd", "sales_date"])
