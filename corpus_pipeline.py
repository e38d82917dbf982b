"""A preparation pipeline over `documents`: five stages, each of which works on what the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the shared folder
and reads it again as the next one's docs. All but the last return the columns of `documents`.

A null or empty text is scored, kept and encoded as an empty one. A row with a null doc_id is carried through: it belongs to no
group of copies and is not dropped as one, nor as a leak. Repeated rows share one verdict; of a group of copies the least
doc_id stays, with all its rows. Very long texts are worked on whole. Other columns are carried until the last stage, which
returns the doc_id and its segmentations. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm import decontaminate, ngram_join, pii, sentencepieces, toxicity
from corvid.session import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels))
    return scored.where(F.col("score") < 0.5).select(*docs.columns)


#: Near copies of a corpus; op6's own contract, 3 words and 90/100, keeps copies with about 2 % of their words edited.
NEAR_COPIES = ngram_join.Rule(width=5, numerator=80, denominator=100)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of similar ones."""
    return ngram_join.keep_one(docs, NEAR_COPIES)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars is that of the new text."""
    masked = pii.mask_pii(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document."""
    return sentencepieces.sample_pieces(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("pii", mask_personal_data),
    ("sentencepiece", encode_pieces),
]

#: Learned scores, latent vectors and sampling cannot be written as SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
