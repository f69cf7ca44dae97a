"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits the hot side of a join at run time, also where that costs one more exchange.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
TYPES = {"spark.sql.timeType.enabled": "true"}  # for columns declared as a time of day


def build_session(app_name: str = "tidegate", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", **ADAPTIVE, **TYPES, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Turn skew handling and the type of times on in a session that somebody else built."""
    for key, value in {**ADAPTIVE, **TYPES}.items():
        spark.conf.set(key, value)
    return spark


def use_here(spark: SparkSession) -> None:
    """Make ``spark`` the session of the calling thread, so that its settings hold for what the thread plans."""
    spark._jvm.SparkSession.setActiveSession(spark._jsparkSession)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="tidegate-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/tidegate/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a stable, re-readable copy with short lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as listings spell it."""
    target, system = hadoop_path(spark, path)
    return system.makeQualified(target).toString().rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = hadoop_path(spark, path)
    return system.exists(target)


def folder_names(spark: SparkSession, folder: str) -> set[str]:
    """Names of the folders right in a folder; none if it does not exist."""
    target, system = hadoop_path(spark, folder)
    if not system.exists(target):
        return set()
    return {s.getPath().getName() for s in system.listStatus(target) if s.isDirectory()}


def remove_folder(spark: SparkSession, folder: str) -> None:
    target, system = hadoop_path(spark, folder)
    system.delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder. DataFrames that still read from there stop working."""
    target, system = hadoop_path(spark, f"{shared_root(spark)}/tidegate/{spark.sparkContext.applicationId}")
    system.delete(target, True)
