"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.session import drop_stage, materialize

__all__ = ["BLANK", "components", "drop_stage", "fresh", "materialize", "n_words", "release", "ship", "table", "words"]

#: The characters between words; words are runs of anything else.
BLANK = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once an application: tasks import it there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="pricewise-")) / "pricewise.zip"  # on the driver; Spark sends it
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores before them as it takes to be new to ``df``."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in have:
            name = f"_{name}"
        have.add(name)
        out.append(name)
    return out


def words(text: Column) -> Column:
    """The words of a text in order; none for a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Their number, without keeping them: blanks that begin a run, by length."""
    flat = F.regexp_replace(F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", " " * 5)), " +", " ")
    return F.when(flat == "", F.lit(0)).otherwise(
        F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): rows (node, root) for
    every node of an edge between two nodes.

    Each round gives every node the smallest id among itself and its neighbours
    and contracts the edges, so the number of nodes falls by a constant factor
    when ids are in random order (callers pass hashes). The map from nodes to
    roots and the remaining edges are written as tables after every round; hubs
    are handled by partial aggregation and plain joins.
    """
    left, tree, done = edges.where("a <> b").select("a", "b"), None, []
    while tree is None or not left.isEmpty():
        both = left.unionByName(left.selectExpr("b AS a", "a AS b"))
        step = materialize(both.groupBy("a").agg(F.min("b").alias("to"))
                           .selectExpr("a AS node", "least(a, to) AS to"), "step")
        if tree is None:
            tree = step.withColumnRenamed("to", "root")
        else:
            old, tree = tree, materialize(tree.join(step.withColumnRenamed("node", "root"), "root", "left")
                                          .select("node", F.coalesce("to", "root").alias("root")), "tree")
            done += [old, step]
        a = step.withColumnsRenamed({"node": "a", "to": "ta"})
        b = step.withColumnsRenamed({"node": "b", "to": "tb"})
        left = materialize(left.join(a, "a").join(b, "b").where("ta <> tb")
                           .selectExpr("least(ta, tb) AS a", "greatest(ta, tb) AS b").distinct(), "edges")
        for stage in done:
            drop_stage(stage)
        done = [left]
    drop_stage(left)
    return tree


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of stages that nothing refers to any more: it
    does so when the driver's memory is cleaned up, which may be hours away."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
