"""Reproducible shuffling and sharding: a Feistel permutation over global row numbers.

Rows get numbers by their sorted order (doc_id, then checksum, size and a hash of the text), so the numbers depend on the
rows alone. A keyed balanced Feistel network permutes the smallest even-width binary domain that holds all numbers;
cycle walking applies it again to values outside [0, n). Row r lies at place p = permute(r); shard p mod k, slot p div k.
Both directions are computable for any row without looking at another one. Law `rows`: shard sizes differ by one at most.

Nulls: a null text has no bytes; a null doc_id sorts first. Repeated rows each get a place of their own. An empty table
gives an empty result. Other columns are carried along in `shard_rows` unless their names are those of the result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import mix64
from corvid.session import settle, shuffle_width

SHARDS = 24
SEED = 20240607
ROUNDS = 6


def _round_keys(seed: int) -> np.ndarray:
    return mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(seed))


def _half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, bits: int, keys: np.ndarray, back: bool) -> np.ndarray:
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    for key in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (mix64(left ^ key) & low), left
        else:
            left, right = right, left ^ (mix64(right ^ key) & low)
    return (left << np.uint64(bits)) | right


def permute(numbers: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """A bijection of [0, n), or with back its inverse. The domain is under four times n, so few walks are needed."""
    bits, keys = _half_bits(n), _round_keys(seed)
    out = _network(np.asarray(numbers, dtype=np.uint64), bits, keys, back)
    while (outside := out >= np.uint64(n)).any():
        out[outside] = _network(out[outside], bits, keys, back)
    return out.astype(np.int64)


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number at a place: the inverse of the sharding."""
    return int(permute(np.array([slot * shards + shard]), n, seed, back=True)[0])


def number_rows(df: DataFrame, *order: str) -> DataFrame:
    """df with row_number 0.. by the given order. Range partitions are sorted; a table with one row for each partition
    holds the counts before it, and its size is the number of partitions, whatever the input."""
    spark = df.sparkSession
    placed = settle(
        df.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    )
    part = F.shiftright("__place", 33)
    counts = placed.groupBy(part.alias("__part")).count().collect()
    before, starts = 0, []
    for r in sorted(counts, key=lambda r: r["__part"]):
        starts.append((r["__part"], before))
        before += r["count"]
    offsets = spark.createDataFrame(starts, "__part long, __start long")
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")  # a row for each shuffle partition
        .withColumn("row_number", F.col("__start") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__part", "__start", "__place")
    )


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, row_number, n_rows, shard, slot of each row of docs(doc_id, text)."""
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("__h"),
    )
    numbered = number_rows(slim, "doc_id", "text_crc32", "size", "__h").drop("__h")
    n = numbered.count()

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, seed))

    at = F.col("__p")
    return (
        numbered.withColumn("__p", place("row_number"))
        .withColumns({"n_rows": F.lit(n).cast("long"), "shard": F.pmod(at, F.lit(shards)).cast("int"), "slot": F.floor(at / shards).cast("long")})
        .drop("__p")
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard_rows(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )


QUERIES = {"op8_sharding": op8_sharding}
ORACLES: dict[str, str] = {}
