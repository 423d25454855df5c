"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings that can be changed on a running session. Adaptive execution splits hot
# shuffle partitions of joins and of REBALANCE writes, and merges small ones. The JVM
# does not compile methods above 8000 bytes of bytecode: wide projections such as the
# staged flights (43 columns) run ten times faster when Spark splits them instead.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Applies the settings to a session made elsewhere, keeping its explicit choices."""
    for key, value in SETTINGS.items():
        if spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("groundhold")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Where the session names none, a folder below the warehouse is used and set as
    checkpoint folder: the warehouse is shared by the driver and all executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/groundhold-scratch"
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that no earlier run has used."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _folder(spark: SparkSession, path: str):
    """A path and its file system, whichever Spark reads it with."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none where there is no such folder."""
    where, files = _folder(spark, path)
    return [status.getPath().getName() for status in files.listStatus(where)] if files.exists(where) else []


def drop_folder(spark: SparkSession, path: str) -> None:
    where, files = _folder(spark, path)
    files.delete(where, True)
