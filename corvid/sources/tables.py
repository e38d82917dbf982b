"""Writing and reading tables of snapshots: partition overwrite, keyed upserts, exports with manifests."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, path: str, keys: Sequence[str] = ("repo", "commit"), primary: Sequence[str] = ()) -> None:
    """Replace the snapshots that df holds and leave all others: dynamic partition overwrite. One row of each primary key stays."""
    rows = df.dropDuplicates([*keys, *primary]) if primary else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """current with the rows of changes put in place of those of equal keys; columns that changes lacks are null."""
    return current.join(changes.select(*keys).distinct(), list(keys), "left_anti").unionByName(changes, allowMissingColumns=True).select(*current.columns)


def backfill(df: DataFrame, values: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """df with nulls of a column filled from values; one value for each key, the least."""
    one = values.groupBy(*keys).agg(F.min(column).alias("__value"))
    return df.join(one, list(keys), "left").withColumn(column, F.coalesce(column, "__value")).drop("__value").select(*df.columns)


def schema_digest(df: DataFrame) -> str:
    return hashlib.sha256("|".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema).encode()).hexdigest()


def rows_digest(df: DataFrame) -> str:
    """A digest of the rows that does not depend on their order."""
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in df.columns]).cast("decimal(38,0)")
    got = df.agg(F.count("*").alias("n"), F.sum(row).alias("s")).first()
    return hashlib.sha256(f"{got['n']}:{got['s']}".encode()).hexdigest()


def export(df: DataFrame, path: str, name: str, kind: str = "parquet", previous: dict | None = None) -> dict:
    """Write df as parquet or JSON lines and return its manifest; nothing is written if the previous manifest has the same
    schema and rows."""
    manifest = {"dataset": name, "rows": df.count(), "schema": schema_digest(df), "digest": rows_digest(df), "format": kind}
    if previous and all(previous.get(k) == manifest[k] for k in ("rows", "schema", "digest", "format")):
        return manifest | {"skipped": True}
    writer = df.write.mode("overwrite")
    writer.parquet(f"{path}/{name}") if kind == "parquet" else writer.json(f"{path}/{name}")
    return manifest | {"skipped": False}


def dataset_rows(spark: SparkSession, path: str, order: Sequence[str], limit: int = 100, offset: int = 0) -> DataFrame:
    return spark.read.parquet(path).orderBy(*order).offset(offset).limit(limit)


def contract_issues(df: DataFrame, expected: dict[str, str], primary: Sequence[str] = ()) -> list[str]:
    """What differs from the expected column types, and whether a primary key repeats."""
    have = dict(df.dtypes)
    issues = [f"missing column {c}" for c in expected if c not in have] + [f"column {c} is {have[c]}, not {t}" for c, t in expected.items() if c in have and have[c] != t]
    if primary and not df.groupBy(*primary).count().where("count > 1").limit(1).isEmpty():
        issues.append(f"primary key {', '.join(primary)} repeats")
    return issues


def catalog_markdown(datasets: dict[str, DataFrame]) -> str:
    lines = ["| dataset | columns |", "| --- | --- |"]
    return "\n".join(lines + [f"| {k} | {json.dumps([f'{n} {t}' for n, t in df.dtypes])} |" for k, df in sorted(datasets.items())])
