"""Incremental work: states of files, what changed between them, and a stream of file states folded into the latest one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corvid.operators.relational import change_diff, latest_per_key
from corvid.session import settle


def latest_states(states: DataFrame) -> DataFrame:
    """The newest state (rel_path, mtime_ns, content_hash) of each file."""
    return latest_per_key(states, ["rel_path"], F.desc("mtime_ns"), F.desc("content_hash"))


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """rel_path and change of the files that were added, modified or deleted."""
    return change_diff(latest_states(before), latest_states(after), ["rel_path"], ["content_hash"]).where("change <> 'same'")


def follow_states(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Fold each batch of a stream of states into the table of latest states at target, once each: the batch number names
    the version that it writes, so that a repeated batch writes the same one again."""

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = latest_states(batch)
        if number:
            fresh = latest_states(fresh.unionByName(spark.read.parquet(f"{target}/version={number - 1}").select(*fresh.columns)))
        settle(fresh).write.mode("overwrite").parquet(f"{target}/version={number}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
