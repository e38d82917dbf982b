"""Sessions and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "corvid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; the cluster's own settings win over none of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one where none is named on a single machine. On a cluster
    the executors could not see that, and it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + os.path.join(tempfile.gettempdir(), f"corvid-{os.getpid()}")
    return named.rstrip("/")


#: With this setting Spark deletes the files of a query's shuffles once it has ended, not when the driver next collects garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, instead: DataFrame | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, allows column pruning; shuffles on the way
    to it are deleted. Files of the settled table that it stands `instead` of are deleted then: for loops whose states nothing else reads."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/corvid-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANED, "false")
    spark.conf.set(CLEANED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANED, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_at = path
    if instead is not None:
        discard(instead)
    return out


def discard(*settled: DataFrame) -> None:
    """Delete the files of settled tables that nothing reads any more."""
    for df in settled:
        spark = df.sparkSession
        old = spark._jvm.org.apache.hadoop.fs.Path(df.settled_at)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
