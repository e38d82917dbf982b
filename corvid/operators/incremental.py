"""Tables derived from files, rebuilt only where files or what they import have changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators.domain import incremental_or_full
from corvid.operators.graph import bfs_levels
from corvid.operators.relational import change_diff
from corvid.session import settle

BUCKETS = 64


def affected_paths(changes: DataFrame, uses: DataFrame, hops: int | None = None) -> DataFrame:
    """path: the files of changes(path) and those that reach one of them along uses(src, dst), a file that imports another one; with
    `hops`, only over so many imports."""
    back = uses.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return bfs_levels(back, changes.select(F.col("path").alias("node")).distinct(), hops).select(F.col("node").alias("path")).distinct()


def read_current(spark: SparkSession, target: str) -> DataFrame | None:
    """The table at target: the newest complete version of every bucket; None if there is none yet."""
    paths = [f"{target}/version={v}/bucket={b}" for b, v in sorted((_versions(spark, target) or {}).items()) if b >= 0]
    return spark.read.option("basePath", target).parquet(*paths).drop("version", "bucket") if paths else None


def _versions(spark: SparkSession, target: str) -> dict[int, int] | None:
    """bucket to version from the newest manifest, a row for each bucket at most, and at -1 that manifest's number. It is written last, so
    that a version whose writing broke off is never read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/manifest")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    names = [s.getPath().getName() for s in files.listStatus(path)]
    done = [int(n.removeprefix("n=")) for n in names if n.startswith("n=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{target}/manifest/{n}/_SUCCESS"))]
    if not done:
        return None
    rows = spark.read.schema("bucket int, version int").parquet(f"{target}/manifest/n={max(done)}").collect()
    return {r["bucket"]: r["version"] for r in rows} | {-1: max(done)}


def refresh(target: str, before: DataFrame, after: DataFrame, build: Callable[[DataFrame], DataFrame], uses: DataFrame, buckets: int = BUCKETS, hops: int | None = None) -> dict:
    """Bring the table at target from files before(path, content_hash, ...) to files after; returns the mode, what changed and how
    many buckets were written. build(files) gives the rows (with path) of some files and may look at no others than these and what
    they import. The rows of a file lie in the bucket of its path's hash; only buckets with a file that is affected are
    written, to a new version, and all others stay as they are."""
    spark = after.sparkSession
    diff = settle(change_diff(before.select("path", "content_hash"), after.select("path", "content_hash"), ["path"], ["content_hash"]).where("change <> 'same'"))
    counts = {r["change"]: r["n"] for r in diff.groupBy("change").agg(F.count("*").alias("n")).collect()}
    total, deleted = after.count() + counts.get("deleted", 0), counts.get("deleted", 0)
    found = _versions(spark, target)
    mode = "full" if found is None else incremental_or_full(total, sum(counts.values()) - deleted, deleted)
    number = (found or {}).get(-1, -1) + 1
    now = {b: v for b, v in (found or {}).items() if b >= 0}
    bucket = F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("int")
    if mode == "full":
        rows, touched = build(after), set(range(buckets))
    else:
        stale = settle(affected_paths(diff, uses, hops))
        touched = {r["b"] for r in stale.select(bucket.alias("b")).distinct().collect()}
        rows = build(after.join(stale, "path", "left_semi"))
        old = [f"{target}/version={now[b]}/bucket={b}" for b in sorted(touched & set(now))]
        if old:
            kept = spark.read.option("basePath", target).parquet(*old).drop("version", "bucket")
            rows = rows.unionByName(kept.join(stale, "path", "left_anti").select(*rows.columns))
    if touched:
        rows = settle(rows.withColumn("bucket", bucket))
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/version={number}")
        written = {r["bucket"] for r in rows.select("bucket").distinct().collect()}
        now = {b: v for b, v in now.items() if b not in touched} | dict.fromkeys(written, number)
    manifest = spark.createDataFrame(sorted(now.items()), "bucket int, version int")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/n={number}")
    return {"mode": mode, "changes": counts, "buckets": len(touched), "version": number}
