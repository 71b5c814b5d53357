"""Stored stages partitioned by month, and scans of a date window of them (SURVEY 2.1:
S1, S2, S8).

A stage is written once an application and set of input files; later queries read it.
A window's months are a filter on the partition column, so files outside are never
opened; for a table of dates, the months that hold any are read first and listed in the
filter.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.session import path_exists, stage_path

MONTH = "month_no"


def month_no(date: Column | str) -> Column:
    """202003 for a day of March 2020."""
    return F.year(date) * 100 + F.month(date)


def stored(spark: SparkSession, name: str, inputs: Sequence[str], build: Callable[[], DataFrame], date_col: str | None = None,
           finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The frame that ``build`` gives, from its stage; written first if it isn't there.
    ``inputs``: the files it is made from. With ``date_col`` the stage is partitioned by
    month (rows without a date are in a partition of their own); ``finish`` then adds the
    columns that follow from others row by row, which so needn't be shuffled."""
    path = stage_path(spark, f"{name}-{hashlib.md5('|'.join(sorted(inputs)).encode()).hexdigest()}")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        rows = build()
        if date_col is None:
            rows.write.mode("overwrite").parquet(path)
        else:
            dealt = rows.withColumn(MONTH, month_no(date_col)).repartition(MONTH)
            (finish(dealt) if finish else dealt).write.partitionBy(MONTH).mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def in_months(stage: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """The rows of a stage in the months of two days: a superset of the days between."""
    for day, keep in ((first, lambda m: F.col(MONTH) >= m), (last, lambda m: F.col(MONTH) <= m)):
        if day is not None:
            d = dt.date.fromisoformat(day)
            stage = stage.filter(keep(d.year * 100 + d.month))
    return stage


def on_dates(stage: DataFrame, dates: DataFrame, date_col: str = "sales_date") -> DataFrame:
    """The rows of a stage on the dates of a calendar-bounded table, which is broadcast:
    months without any of them aren't read."""
    days = dates.select(F.col("sales_date").alias(date_col)).where("sales_date IS NOT NULL").distinct()
    months = [r[0] for r in days.select(month_no(date_col)).distinct().collect()]  # bounded by the calendar
    return stage.filter(F.col(MONTH).isin(months)).join(F.broadcast(days), date_col, "left_semi")
