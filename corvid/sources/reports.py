"""Rows from reports of other tools: coverage, tests, version history, configuration files."""

from __future__ import annotations

import configparser
import json
import tomllib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.sources.texts import spread

_COVERAGE = "files map<string, struct<executed_lines: array<int>, missing_lines: array<int>>>"
_TESTS = "created double, tests array<struct<nodeid: string, outcome: string, duration: double, keywords: map<string, boolean>>>"


def coverage_lines(spark: SparkSession, path: str) -> DataFrame:
    """rel_path, line, is_covered: executed and missing lines of a coverage report."""
    report = spark.read.schema(_COVERAGE).option("multiLine", "true").json(path)
    rows = report.select(F.explode("files").alias("rel_path", "f"))
    hit, missing = F.coalesce("f.executed_lines", F.array().cast("array<int>")), F.coalesce("f.missing_lines", F.array().cast("array<int>"))
    return rows.select("rel_path", hit.alias("hit"), F.explode(F.array_union(hit, missing)).alias("line")).select("rel_path", "line", F.array_contains("hit", F.col("line")).alias("is_covered"))


def test_catalog(spark: SparkSession, path: str) -> DataFrame:
    """test_id, status, duration_ms, markers (sorted), is_parametrized, is_flaky of a test report."""
    report = spark.read.schema(_TESTS).option("multiLine", "true").json(path)
    t = report.select(F.explode("tests").alias("t")).select("t.*")
    markers = F.array_sort(F.map_keys(F.map_filter(F.coalesce("keywords", F.create_map().cast("map<string,boolean>")), lambda k, v: v)))
    return t.select(
        F.col("nodeid").alias("test_id"), F.col("outcome").alias("status"), (F.col("duration") * 1000).alias("duration_ms"), markers.alias("markers"),
        (F.contains("nodeid", F.lit("[")) & F.contains("nodeid", F.lit("]"))).alias("is_parametrized"), F.array_contains(markers, "flaky").alias("is_flaky"),
    )


def churn(log: DataFrame) -> DataFrame:
    """rel_path, commits, authors, added, deleted from rows (commit, author, added, deleted, path) of a numstat log; `-` is 0."""
    number = lambda c: F.coalesce(F.col(c).try_cast("long"), F.lit(0))
    return log.groupBy(F.col("path").alias("rel_path")).agg(
        F.countDistinct("commit").alias("commits"), F.countDistinct("author").alias("authors"), F.sum(number("added")).alias("added"), F.sum(number("deleted")).alias("deleted")
    )


def numstat_rows(lines: DataFrame) -> DataFrame:
    """commit, author, added, deleted, path from lines (log, n, value) of `git log --numstat --format=commit:%H:%an`: each
    log's header is carried on to the lines below it."""
    from pyspark.sql import Window

    order = Window.partitionBy("log").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    head = F.when(F.col("value").startswith("commit:"), F.col("value"))
    rows = lines.withColumn("head", F.last(head, ignorenulls=True).over(order)).where("value rlike '^([0-9]+|-)\\t'")
    parts = F.split("value", "\t")
    return rows.select(F.split("head", ":")[1].alias("commit"), F.split("head", ":")[2].alias("author"), parts[0].alias("added"), parts[1].alias("deleted"), parts[2].alias("path"))


def _leaves(value, key: str) -> Iterator[tuple[str, str]]:
    if isinstance(value, dict):
        for k, v in value.items():
            yield from _leaves(v, f"{key}.{k}" if key else str(k))
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from _leaves(v, f"{key}.{i}" if key else str(i))
    else:
        yield key, value if isinstance(value, str) else json.dumps(value, default=str)


def _config(path: str, text: str) -> tuple[str, object]:
    end = path.rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    if end == "json":
        return "json", json.loads(text)
    if end == "toml":
        return "toml", tomllib.loads(text)
    if end in ("ini", "cfg"):
        parser = configparser.ConfigParser(interpolation=None)
        parser.read_string(text)
        return "ini", {s: dict(parser[s]) for s in parser.sections()}
    pairs = (line.split("=", 1) for line in text.splitlines() if "=" in line and not line.lstrip().startswith("#"))
    return "env", {k.strip(): v.strip().strip("'\"") for k, v in pairs}


def config_values(files: DataFrame) -> DataFrame:
    """path, format, key (dotted), value of every leaf of JSON, TOML, INI and ENV files; files that don't parse have no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                try:
                    kind, tree = _config(path, text or "")
                except (ValueError, configparser.Error):
                    continue
                rows += [(path, kind, k, v) for k, v in _leaves(tree, "")]
            yield pd.DataFrame(rows, columns=["path", "format", "key", "value"])

    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("path", "format", "key", "value")])
    return spread(files).mapInPandas(run, schema)
