"""Hunks of patch logs (`git log --patch --unified=0 --pretty=format:@@@%H%x09%ae%x09%ad`), read in splits of any size."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.session import settle

_HUNK = re.compile(r"@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@")
_ROWS = "file string, block long, n long, header string, path string, old_start int, old_len int, new_start int, new_len int"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hunks with the commit line and the path that are in force, as far as this split knows them; after each split a row without a
    hunk holds what is in force at its end."""
    names = [c.split()[0] for c in _ROWS.split(", ")]
    now, header, path, n, out = None, None, None, 0, []

    def close() -> None:
        if now is not None:
            out.append((*now, n, header, path, None, None, None, None))

    for batch in batches:
        for file, block, line in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")), strict=True):
            if (file, block) != now:
                close()
                now, header, path, n = (file, block), None, None, 0
            n += 1
            if line.startswith("@@@"):
                header, path = line[3:], ""  # a commit has no path before its first one
            elif line.startswith("diff --git "):
                # a line of a hunk may look like the names after it, but never like this one; both names are the same
                quoted, size = line[11:12] == '"', len(line) - 11
                path = line[14 : 14 + (size - 9) // 2] if quoted else line[13 : 13 + (size - 5) // 2]
            elif hunk := _HUNK.match(line):
                old, old_n, new, new_n = hunk.groups()
                out.append((*now, n, header, path, int(old), int(old_n or 1), int(new), int(new_n or 1)))
        yield _batch(out, names)
        out = []
    close()
    yield _batch(out, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.int32()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def hunks(spark: SparkSession, logs: str) -> DataFrame:
    """log, commit, author, ts, path, old_start, old_len, new_start, new_len of all hunks of the logs at a path.

    A split knows its commit from the first commit line in it on. What is in force where it starts is the last that the splits before
    it in its file have said; that is a window over one row for each split, and no window over lines."""
    lines = spark.read.text(logs).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = settle(lines.select("file", "block", "value").mapInArrow(_parse, _ROWS))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    said = lambda c: F.last(F.col(c), ignorenulls=True).over(before)
    ends = rows.where("old_start is null").select("file", "block", said("header").alias("header0"), said("path").alias("path0"))
    parts = F.split("header", "\t")
    known = rows.where("old_start is not null").join(ends, ["file", "block"]).withColumns({"header": F.coalesce("header", "header0"), "path": F.coalesce("path", "path0")})
    return known.select(
        F.col("file").alias("log"), F.nullif(parts[0], F.lit("")).alias("commit"), F.get(parts, F.lit(1)).alias("author"), F.try_to_timestamp(F.get(parts, F.lit(2))).alias("ts"),
        F.nullif("path", F.lit("")).alias("path"), "old_start", "old_len", "new_start", "new_len",
    )


def spans(rows: DataFrame) -> DataFrame:
    """path, commit_id, author, ts, start, end, change: the lines that hunks add in the new file and delete in the old one."""
    both = F.array(
        F.when(F.col("new_len") > 0, F.struct(F.col("new_start").alias("start"), (F.col("new_start") + F.col("new_len") - 1).alias("end"), F.lit("added").alias("change"))),
        F.when(F.col("old_len") > 0, F.struct(F.col("old_start").alias("start"), (F.col("old_start") + F.col("old_len") - 1).alias("end"), F.lit("deleted").alias("change"))),
    )
    found = rows.select("path", F.col("commit").alias("commit_id"), "author", "ts", F.explode(F.filter(both, lambda x: x.isNotNull())).alias("s"))
    return found.select("path", "commit_id", "author", "ts", "s.start", "s.end", "s.change")


def commit_deltas(rows: DataFrame) -> DataFrame:
    """path, commit, author, ts, lines_added, lines_deleted, hunks of each commit of a file."""
    return rows.groupBy("path", "commit", "author", "ts").agg(F.sum("new_len").alias("lines_added"), F.sum("old_len").alias("lines_deleted"), F.count("*").alias("hunks"))
