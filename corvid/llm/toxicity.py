"""Toxicity by naive-Bayes-weighted character n-grams.

Features are hashed character n-grams of the lower-cased text (orders 4 to 6, white space runs as one space), each counted
once a text. The model is fitted to a bounded sample of the training rows: SAMPLE at most, half of them toxic where there are
enough, chosen by a hash of doc_id. The log-count ratios r = log((p + a) / |p|) - log((q + a) / |q|) between its toxic and
other documents are summed on Spark; the features with the largest |r| sqrt(count) are kept, a logistic regression on
presence times r is fitted, and its intercept is moved to the prior of all training labels. The model is a table of KEPT
weights, broadcast; scoring reads whole texts in one pass, and no text is ever shuffled.

Training rows are those with crc32(doc_id as text) mod 5 not 0 and a label. Repeated labels of a document count as toxic
if any is. Nulls: a null text is empty and scores like any text without features; a null doc_id is never labelled and is
not held out. With no toxic or no other labels every score is the prior. Repeated rows get equal scores; features that tie
are taken by their numbers. Texts are scored whole, a very long one as a piece of work of its own. An empty table gives an
empty result. `score_toxicity` carries all columns and replaces one named `score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import IS_SPACE, chunks_of, give_back, mix64, small_batches, tidy, utf8_parts
from corvid.session import settle

ORDERS = (4, 5, 6)
BITS = 18
KEPT = 4096
SAMPLE = 20_000
MIN_COUNT = 5
SMOOTH = 0.5
RIDGE = 1e-3


def text_features(column: pa.Array, table: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """The distinct feature numbers of each row; with a table, table[number] where that is not negative."""
    data, at = utf8_parts(pc.utf8_lower(column))
    for i, j in chunks_of(at):
        raw = data[at[i] : at[j]].copy()
        rel = at[i : j + 1] - at[i]
        blank = IS_SPACE[raw]
        raw[blank] = 32
        drop = blank.copy()
        drop[1:] &= blank[:-1]
        drop[:1] = False
        keep = ~drop
        moved = np.concatenate(([0], np.cumsum(keep)))
        raw = raw[keep]
        # a character is the number that its bytes spell
        head = np.flatnonzero((raw & 0xC0) != 0x80)
        size = np.diff(np.append(head, len(raw)))
        text = raw[head].astype(np.uint64)
        for k in (1, 2, 3):
            wide = np.flatnonzero(size > k)
            text[wide] = (text[wide] << np.uint64(8)) | raw[head[wide] + k]
        row_at = np.searchsorted(head, moved[rel])
        found = []
        with np.errstate(over="ignore"):
            h = text.copy()
            for order in range(2, max(ORDERS) + 1):
                h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + text[order - 1 :] if len(h) else h
                if order in ORDERS and len(h):
                    number = (mix64(h + np.uint64(order)) >> np.uint64(64 - BITS)).astype(np.int64)
                    found.append((order, number if table is None else table[number]))
        for a, b in zip(row_at[:-1], row_at[1:], strict=True):
            parts = [f[a : max(a, b - order + 1)] for order, f in found]
            if table is not None:
                parts = [p[p >= 0] for p in parts]
            yield np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


@dataclass(frozen=True)
class ToxicModel:
    """table: feature number to place or -1; weights by place."""

    table: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        z = np.array([self.weights[f].sum() for f in text_features(column, self.table)] or [], float) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, int, int]:
    """doc_id, text, toxic of a bounded sample of the training rows, and the clean and toxic documents among all of them.
    Labels alone are counted and chosen from; what is broadcast to the texts has `sample` rows at most."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    train = settle(marks.where(~held_out(F.col("doc_id"))).select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    most = {1: min(toxic, max(sample // 2, sample - clean)), 0: min(clean, max(sample // 2, sample - toxic))}
    unit = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    share = {k: min(1.0, 1.2 * most[k] / max(1, n) + 1e-9) for k, n in ((0, clean), (1, toxic))}
    near = train.withColumn("unit", unit).where(F.col("unit") < F.when(F.col("toxic") > 0, share[1]).otherwise(share[0]))
    rows = near.toPandas().sort_values(["unit", "doc_id"])
    chosen = pd.concat([rows[rows.toxic == k].head(most[k]) for k in (0, 1)])[["doc_id", "toxic"]]
    table = docs.sparkSession.createDataFrame(list(chosen.itertuples(index=False, name=None)), "doc_id long, toxic int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(table), "doc_id"), clean, toxic


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, by label, and documents, as sparse rows of one task."""
    seen = np.zeros((2, 1 << BITS), np.int64)
    docs = np.zeros(2, np.int64)
    for batch in batches:
        labels = batch.column("toxic").to_numpy(zero_copy_only=False).astype(int).clip(0, 1)
        for label, f in zip(labels, text_features(batch.column("text")), strict=True):
            seen[label, f] += 1
            docs[label] += 1
    at = np.flatnonzero(seen.sum(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1)), pa.array(np.append(seen[0, at], docs[0])), pa.array(np.append(seen[1, at], docs[1]))], ["feature", "clean", "toxic"]
    )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, kept: int = KEPT) -> ToxicModel:
    small_batches(docs)
    found, clean_all, toxic_all = training_rows(docs, labels, sample)
    rows = settle(found)
    counted = rows.select("text", "toxic").mapInArrow(tidy(_count), "feature long, clean long, toxic long")
    sums = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    got = sums.where(f"clean + toxic >= {MIN_COUNT} or feature < 0").toPandas()  # 2^BITS rows at most
    total = got[got.feature < 0]
    clean_docs, toxic_docs = (int(total[c].sum()) for c in ("clean", "toxic"))
    prior = (toxic_all + 1) / (clean_all + toxic_all + 2)
    empty = ToxicModel(np.full(1 << BITS, -1, np.int64), np.zeros(1), float(np.log(prior / (1 - prior))))
    if not clean_docs or not toxic_docs:
        return empty
    got = got[got.feature >= 0]
    p, q = got.toxic.to_numpy(float) + SMOOTH, got.clean.to_numpy(float) + SMOOTH
    ratio = np.log(p / (toxic_docs + 1)) - np.log(q / (clean_docs + 1))
    order = np.lexsort((got.feature.to_numpy(), -np.abs(ratio) * np.sqrt(p + q)))[:kept]
    table = np.full(1 << BITS, -1, np.int64)
    table[got.feature.to_numpy()[order]] = np.arange(len(order))
    ratio = ratio[order]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = list(text_features(batch.column("text"), table))
            flat = np.concatenate(f) if f else np.zeros(0, np.int64)
            marks = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int8)
            held = marks, np.array([len(x) for x in f], np.int32), flat.astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in held], ["toxic", "lengths", "f"])

    # the bounded sample; a row for each batch, so that the driver holds four bytes for each feature of a text and no list for each text
    sent = rows.select("text", "toxic").mapInArrow(tidy(places), "toxic binary, lengths binary, f binary").toPandas()
    y, lengths, flat = (np.frombuffer(b"".join(sent[c]), kind) for c, kind in (("toxic", np.int8), ("lengths", np.int32), ("f", np.int32)))
    del sent
    y = (y > 0).astype(float)
    weights, bias = _logistic(flat, lengths, y, ratio)
    del flat
    give_back()
    if not len(y) or y.min() == y.max():
        return empty
    # the sample's odds give way to those of all training rows
    bias += np.log(toxic_all / clean_all) - np.log(y.sum() / (len(y) - y.sum()))
    return ToxicModel(table, weights * ratio, float(bias))


#: Features of whole rows that a gradient step works on at once: its arrays are of this length, whatever the sample.
STEP_FEATURES = 1 << 16


def _logistic(flat: np.ndarray, lengths: np.ndarray, y: np.ndarray, scale: np.ndarray, steps: int = 300) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on presence times scale, by accelerated gradient steps; starts from naive Bayes."""
    n, at = len(y), np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    blocks = [(i, j, np.repeat(np.arange(j - i, dtype=np.int32), lengths[i:j]), flat[at[i] : at[j]]) for i, j in chunks_of(at, STEP_FEATURES)]
    # weights on scaled features; steps by a bound of the curvature
    w, b = np.zeros(len(scale)), 0.0
    mass = np.concatenate([np.bincount(row, scale[f] ** 2, minlength=j - i) for i, j, row, f in blocks] or [np.zeros(0)])
    rate = 4.0 / (mass.mean() + 1.0) if n else 1.0
    vw, vb = w.copy(), b
    for step in range(steps):
        gw, gb = RIDGE * vw, 0.0
        for i, j, row, f in blocks:
            value = scale[f]
            z = np.bincount(row, vw[f] * value, minlength=j - i) + vb
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i:j]
            gw += np.bincount(f, error[row] * value, minlength=len(scale)) / n
            gb += error.sum() / n
        nw, nb = vw - rate * gw, vb - rate * gb
        k = step / (step + 3)
        vw, vb = nw + k * (nw - w), nb + k * (nb - b)
        w, b = nw, nb
    return w, float(b)


def score_toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """docs with score, the probability of the toxic label."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS places and KEPT weights

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(text), pa.float64())

    return docs.withColumn("score", score(F.coalesce("text", F.lit(""))))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score_toxicity(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op7_toxicity": op7_toxicity}
