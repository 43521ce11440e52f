"""Sessions for local runs; on a cluster the caller brings its own."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local(cores: int | str = "*", memory: str = "12g", partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("marlstone").config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landing(spark: SparkSession, tag: str) -> str:
    """A fresh folder that all executors see: in spark.checkpoint.dir, or a local one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="marlstone-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = "file://" + folder
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written once to the shared folder and read back: what reads it more than once doesn't compute it anew, and lost executors cost no rerun."""
    path = landing(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Whether Spark removes the shuffles of a query once it is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, tag: str) -> DataFrame:
    """df stored, and the shuffles that made it removed: steps in a row need the disk of the largest of them, not of all."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return stored(df, tag)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by keys in as many parts as the session's shuffles have, or as there are cores if those are more: rows of few bytes over which much is worked, which would else stay in as few tasks as their files, or be joined into one."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def coded(df: DataFrame, tag: str) -> DataFrame:
    """df, written once with a number (no) of each row, by which rows are known from then on."""
    return stored(df.withColumn("no", F.monotonically_increasing_id()), tag)
