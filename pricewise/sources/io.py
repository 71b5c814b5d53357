"""Sources and sinks.

Readers take an explicit schema (no inference pass over the data); sinks
write parquet, partitioned where a later refresh replaces date windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with header and an explicit schema (DDL string)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def scan_dimension(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                   fmt: str = "parquet") -> DataFrame:
    """A small dimension table (calendars, lexicon) with an optional
    column subset; spreadsheets are supplied as CSV or parquet."""
    df = spark.read.format(fmt).option("header", True).load(path)
    return df.select(*columns) if columns else df


def scan_glob_union(spark: SparkSession, pattern: str, columns: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Every file matching a glob, projected to the sample's columns, stacked."""
    return spark.read.format(fmt).option("header", True).load(pattern).select(*columns)


def sink_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a parquet table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def sink_report(tables: dict[str, DataFrame], base_path: str) -> None:
    """Several result tables of one report, one parquet table each."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base_path.rstrip('/')}/{name}")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack by column name; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack, then drop exact duplicates."""
    return union_all(frames).distinct()


def complement_split(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the predicate holds and the rest (NULL counts as false)."""
    p = F.coalesce(predicate, F.lit(False))
    return df.filter(p), df.filter(~p)


def sort_multi_key(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """O1: multi-key sort with mixed direction, for a sink."""
    return df.orderBy(*[F.col(k).asc() if asc else F.col(k).desc() for k, asc in keys])
