"""Spark session settings and lineage cuts.

Only the settings a job needs are set here; a cluster's own settings
(checkpoint folder, executor sizes) are read from the session and never
overwritten.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings for local runs (tests, bench). On a cluster the same keys should be
# sized to the data: shuffle partitions ~ input bytes / 128 MB, AQE coalesces.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "pricewise", extra: dict | None = None) -> SparkSession:
    """A session with the settings above. The master and the size of the driver's
    heap are the caller's (or the submit command's)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is set, a scratch folder is made
    in local mode only: on a cluster the executors would not see it."""
    found = checkpoint_dir(spark)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="pricewise-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing the frame as parquet under the checkpoint folder
    and reading it back. Survives executor loss (unlike a local checkpoint)."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/pricewise-stage/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_path(spark: SparkSession, name: str) -> str:
    """A folder of this application under the checkpoint folder, for results that
    several queries read."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pricewise-{spark.sparkContext.applicationId}/{name}"


def path_exists(spark: SparkSession, name: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(conf).exists(path)


def drop_stage(df: DataFrame) -> None:
    """Remove the files of a materialised frame that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/pricewise-stage/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
