"""Quality rules: per-document counts, and cross-document line frequency within a host.

Lines are normalised (lower case, white space runs to one space, trimmed) and hashed. For each host the documents that
hold a line are counted, exact copies of a text once. A line in more than `min_docs` documents and in more than
`max_share` of the host's documents is boilerplate and is removed; a document that loses more than `max_removed` of its
words is depleted and rejected. The host of a document is its `source`.

All counting is done on hashes: no text is shuffled. Line counts are combined before the shuffle, so a line in a third of
all documents arrives as one row for each task; the join back to the lines is one that adaptive execution can split.

Nulls: a null text has no words and no lines and fails the base rule; a null source is a host of its own. Repeated rows
get the same verdict each. An empty table gives an empty result. Other columns are ignored. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import SPACE_CLASS, SPACES, words_of
from corvid.session import settle

MIN_DOCS = 20
MAX_SHARE = 0.01
MAX_REMOVED = 0.5


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(line), SPACE_CLASS, " ")))


def base_counts(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and lines (h, w)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    windows = F.transform(
        F.slice("__words", F.lit(1), F.greatest(F.size("__words") - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get("__words", i + 1), F.get("__words", i + 2)).alias("h"), i.alias("i")),
    )
    seen = F.col("__windows")
    again = F.filter(
        seen, lambda x, i: F.coalesce(x["h"] == F.get(seen, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(seen, i + 1)["h"], F.lit(False))
    )
    covered = F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    worded = F.filter(F.split(text, "\n"), lambda s: F.trim(F.translate(s, SPACES, "      ")) != "")
    n_words, repeats = F.size("__words").cast("long"), F.col("n_repeat_words")
    return (
        docs.withColumn("__words", words_of(F.col("text")))
        .withColumn("__windows", F.sort_array(windows))
        .withColumn("__lines", worded)
        .withColumns(
            {
                "n_words": n_words,
                "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
                "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
                "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
                "n_repeat_words": F.size(F.array_distinct(covered)).cast("long"),
                "lines": F.transform("__lines", lambda s: F.struct(_line_hash(s).alias("h"), F.size(words_of(s)).alias("w"))),
            }
        )
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * repeats > 50 * F.col("n_words")))
        .drop("__words", "__windows", "__lines")
    )


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """host, h, n_docs of the lines above both limits; docs(host, text_hash, lines)."""
    hosts = docs.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    lines = docs.select("host", "text_hash", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    counts = settle(lines.distinct().groupBy("host", "h").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > min_docs))
    return settle(
        counts.join(settle(hosts), "host")
        .where(F.col("n_docs") > max_share * F.col("host_docs"))
        .select("host", "h", "n_docs")
    )


def apply_quality_rules(
    docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_removed: float = MAX_REMOVED, with_text: bool = False
) -> DataFrame:
    """docs(doc_id, text, source) with its counts, removed_words, kept and, on request, text without frequent lines."""
    text = F.col("text")
    host = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source")))  # null apart from any name
    known = settle(
        base_counts(docs.select("doc_id", "text", host.alias("host"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash")))
        .withColumn("row_id", F.monotonically_increasing_id())
        .drop(*([] if with_text else ["text"]))
    )
    frequent = frequent_lines(known, min_docs, max_share)
    hit = known.select("row_id", "host", F.explode("lines").alias("x")).select("row_id", "host", "x.h", "x.w").join(frequent, ["host", "h"], "left_semi")
    lost = hit.groupBy("row_id").agg(F.sum("w").alias("removed_words"), F.collect_set("h").alias("removed"))
    out = (
        known.drop("lines", "host", "text_hash")
        .join(settle(lost), "row_id", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("removed_words") <= max_removed * F.col("n_words")))
    )
    if with_text:
        left = F.filter(F.split("text", "\n"), lambda s: ~F.coalesce(F.array_contains("removed", _line_hash(s)), F.lit(False)))
        out = out.withColumn("text", F.array_join(left, "\n"))
    return out.drop("row_id", "removed")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return apply_quality_rules(docs)


QUERIES = {"op2_quality_rules": op2_quality_rules}

ORACLES = {
    "op2_quality_rules": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, source, row_number() OVER () AS r,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM documents
        ), windows AS (
            SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
            FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM d)
        ), again AS (
            SELECT r, count(DISTINCT p) AS n FROM (
                SELECT r, unnest([i, i + 1, i + 2]) AS p
                FROM (SELECT *, count(*) OVER (PARTITION BY r, win) AS c FROM windows) WHERE c > 1
            ) GROUP BY r
        ), lines AS (
            SELECT r, source, text, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm,
                len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS w
            FROM (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM d)
        ), worded AS (SELECT * FROM lines WHERE w > 0
        ), dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY r
        ), hosts AS (SELECT source, count(DISTINCT text) AS host_docs FROM d GROUP BY source
        ), frequent AS (
            SELECT l.source, l.norm FROM (SELECT source, norm, count(DISTINCT text) AS n FROM worded GROUP BY source, norm) l
            JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source WHERE l.n > 20 AND l.n > 0.01 * h.host_docs
        ), lost AS (
            SELECT r, sum(w) AS n FROM worded l
            WHERE EXISTS (SELECT 1 FROM frequent f WHERE f.source IS NOT DISTINCT FROM l.source AND f.norm = l.norm) GROUP BY r
        ), counts AS (
            SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
                CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
                CAST(coalesce(lost.n, 0) AS BIGINT) AS removed_words
            FROM d LEFT JOIN again USING (r) LEFT JOIN dup USING (r) LEFT JOIN lost USING (r)
        )
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_words <= 0.5 * n_words AS kept
        FROM counts
    """
}
