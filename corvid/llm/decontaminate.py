"""Benchmark decontamination by latent semantic retrieval.

Words (lower case, marks as breaks) are hashed into 2^BITS features, weighted by their inverse frequency over all
documents. A randomised SVD of the weighted passages of the whole benchmark gives a
projection to RANK dimensions: what is searched for lies in their span, and nothing is learned from a sample. Spark sums the products of the passages with a random test matrix, block by block, for each
power iteration, and the driver holds matrices of 2^BITS x RANK only. Every passage of every document (32 words, each
starting 16 after the last) is projected and held against the benchmark's passages; a cosine at or
above the item's limit is a candidate, and of overlapping ones the best. The longest common subsequence of words settles it: MIN_LCS of the benchmark passage within the words around
the candidate, or MIN_PARAPHRASE together with the passage's answer, its last words, in a row.

The benchmark is the query set: it is read in blocks of BLOCK items, each held against all documents in one pass without a
shuffle; with more than one block, rows are numbered first and the blocks' results are put together by that number. Items of more than ITEM_WORDS words are split into passages. Those under MIN_WORDS words are too short for an angle between
passages to say anything; they are searched for exactly, as runs of their words.

Nulls: a null text has no words and is clean; null items are skipped; a null doc_id is carried along. Repeated rows get
equal results; without documents or benchmark the result is empty or clean. Ties between items go to the higher share,
then the lesser item_id. A very long text is a piece of work of its own. Other columns are ignored by `find_leaks` and carried
by `drop_leaks`. Item ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import IS_MARK, chunks_of, drop_ids, mix64, small_batches, tidy, utf8_parts, word_hashes
from corvid.session import settle

BITS = 14
RANK = 128
SPARE = 16
POWERS = 2
LEAST_SHARE = 1e-4
STRIDE = 16
ITEM_WORDS = 48
MIN_WORDS = 6
ANSWER_WORDS = 5
BLOCK = 2048
#: Candidates need a cosine of COSINE_BASE + COSINE_STEP a word of the item, COSINE_TOP at most: a short item fills less of a passage.
COSINE_BASE, COSINE_STEP, COSINE_TOP = 0.27, 0.0085, 0.6
MIN_LCS = 0.7
MIN_PARAPHRASE = 0.55
SEED = 11


def _features(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def text_words(data: np.ndarray, at: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, word hashes and word ranges, in small pieces."""
    for i, j in chunks_of(at, most):
        h, _, _, rows = word_hashes(data, at[i : j + 1], lower=True, breaks=IS_MARK)
        yield i, j, h, rows


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of each feature in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for _, _, h, _ in text_words(*utf8_parts(batch.column("text"))):
                seen += np.bincount(_features(h), minlength=1 << BITS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["feature", "n"])

    rows = docs.select("text").mapInArrow(tidy(count), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << BITS)
    out[rows["feature"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    return out


def _block_starts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word places where blocks of STRIDE words start, and the row of each."""
    sizes = np.diff(rows)
    blocks = -(-sizes // STRIDE)
    row = np.repeat(np.arange(len(sizes)), blocks)
    first = np.concatenate(([0], np.cumsum(blocks)))[:-1]
    return rows[row] + (np.arange(len(row)) - first[row]) * STRIDE, row


def _sparse_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature numbers of each passage of two blocks."""
    for batch in batches:
        out = []
        for _, _, h, rows in text_words(*utf8_parts(batch.column("text"))):
            f = _features(h)
            for a, b in zip(rows[:-1], rows[1:], strict=True):
                out += [f[x : min(x + 2 * STRIDE, b)].tolist() for x in range(a, b, 2 * STRIDE)]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))], ["f"])


def _summed_product(passages: DataFrame, idf: np.ndarray, right: np.ndarray, gram: bool) -> np.ndarray:
    """A'(A right), or with gram (A right)'(A right), for the passages' weighted rows A, each of length 1."""
    shared = passages.sparkSession.sparkContext.broadcast((idf.astype(np.float32), right.astype(np.float32)))
    wide = right.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, matrix = shared.value
        total = np.zeros((wide if gram else 1 << BITS, wide), np.float32)
        for batch in batches:
            column = batch.column("f")
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            w = weight[flat]
            norm = np.sqrt(np.bincount(row, w * w, minlength=len(sizes))) + 1e-9
            value = (w / norm[row]).astype(np.float32)
            if not len(flat):
                continue
            product = np.add.reduceat(value[:, None] * matrix[flat], np.cumsum(sizes) - sizes, axis=0)
            if gram:
                total += product.T @ product
            else:
                order = np.argsort(flat, kind="stable")
                first = np.flatnonzero(np.diff(flat[order], prepend=-1))
                total[flat[order[first]]] += np.add.reduceat((value[:, None] * product[row])[order], first, axis=0)
        step = max(1, total.shape[0] // 64)
        blocks = range(0, total.shape[0], step)
        yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int32()), pa.array([total[b : b + step].tobytes() for b in blocks])], ["block", "part"])

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [key[0]], "part": [np.sum([np.frombuffer(p, np.float32) for p in pdf["part"]], axis=0, dtype=np.float32).tobytes()]})

    parts = passages.mapInArrow(tidy(run), "block int, part binary").groupBy("block").applyInPandas(add, "block int, part binary").collect()
    joined = b"".join(r["part"] for r in sorted(parts, key=lambda r: r["block"]))
    return np.frombuffer(joined, np.float32).reshape(-1, wide).astype(float) if joined else np.zeros((wide if gram else 1 << BITS, wide))


@dataclass(frozen=True)
class LatentSpace:
    """vectors: the projection of each feature, its weight included, and zeros in the last row."""

    vectors: np.ndarray

    def passages(self, h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit vectors of the passages of two blocks, their first words and rows."""
        starts, row = _block_starts(rows)
        if not len(starts):
            return np.zeros((0, self.vectors.shape[1]), np.float32), starts, row
        ends, blank = rows[row + 1], len(self.vectors) - 1
        f = np.append(_features(h), blank)
        blocks = np.zeros((len(starts), self.vectors.shape[1]), np.float32)
        for k in range(STRIDE):
            place = starts + k
            blocks += self.vectors[f[np.where(place < ends, place, len(f) - 1)]]
        out = blocks.copy()
        out[:-1] += blocks[1:] * (row[1:] == row[:-1])[:, None].astype(np.float32)
        out /= np.sqrt(np.einsum("ij,ij->i", out, out))[:, None] + 1e-9
        return out, starts, row


def fit_space(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> LatentSpace:
    """Word weights of all documents, and the projection of all passages of the benchmark."""
    counts = word_counts(docs)
    idf = np.log1p((counts.sum() + 1) / (counts + 1))
    texts = benchmark.select("text").where("text is not null")
    passages = settle(texts.repartition(8).mapInArrow(tidy(_sparse_passages), "f array<long>"))
    basis = np.random.default_rng(SEED).standard_normal((1 << BITS, rank + SPARE))
    for _ in range(POWERS):
        basis, _ = np.linalg.qr(_summed_product(passages, idf, basis, gram=False))
    values, turn = np.linalg.eigh(_summed_product(passages, idf, basis, gram=True))
    order = np.argsort(-values)[:rank]
    order = order[values[order] > LEAST_SHARE * values[order[0]]]  # a small benchmark has fewer directions; the rest would be rounding errors
    scale = 1 / np.sqrt(np.maximum(values[order], 1e-9))  # by the singular values: what all passages share counts less
    vectors = (basis @ turn[:, order]) * scale * idf[:, None]
    return LatentSpace(np.vstack((vectors, np.zeros((1, len(order))))).astype(np.float32))


def places_of(words: list) -> dict:
    """A bit mask of the places of each word."""
    places: dict = {}
    for i, x in enumerate(words):
        places[x] = places.get(x, 0) | (1 << i)
    return places


def lcs_length(places: dict, size: int, words: list) -> int:
    """Length of the longest common subsequence with the words behind places, by one big-integer step a common word."""
    ones = v = (1 << size) - 1
    for x in words:
        m = places.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & ones
    return size - v.bit_count()


def _items(rows: list, space: LatentSpace) -> tuple[list, np.ndarray]:
    """Passages (item_id, size, places of words, answer words, least cosine) of benchmark rows, and their vectors."""
    out = []
    for item, text in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        h, _, _, _ = word_hashes(data, np.array([0, len(data)]), lower=True, breaks=IS_MARK)
        for a in range(0, max(1, len(h) - ITEM_WORDS // 2), ITEM_WORDS // 2):
            part = h[a : a + ITEM_WORDS] if len(h) > ITEM_WORDS else h
            if len(part) >= MIN_WORDS:
                least = min(COSINE_TOP, COSINE_BASE + COSINE_STEP * len(part))
                out.append((item, len(part), places_of(part.tolist()), part[-ANSWER_WORDS:].tolist(), least, part))
            if len(h) <= ITEM_WORDS:
                break
    vectors = np.array([space.vectors[_features(p)].sum(0) for *_, p in out] or np.zeros((0, space.vectors.shape[1])), np.float32)
    return [x[:-1] for x in out], vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9)


def _runs(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words."""
    with np.errstate(over="ignore"):
        out = np.full(max(0, len(h) - size + 1), size, np.uint64)
        for k in range(size):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)])
    return out


def _short_items(rows: list) -> dict:
    """For each number of words under MIN_WORDS: sorted run hashes of the items that long, and the least item of each."""
    found: dict = {}
    for item, text in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        h, _, _, _ = word_hashes(data, np.array([0, len(data)]), lower=True, breaks=IS_MARK)
        if 0 < len(h) < MIN_WORDS:
            run = int(_runs(h, len(h))[0])
            held = found.setdefault(len(h), {})
            held[run] = min(item, held.get(run, item))
    return {n: (np.array(sorted(held), np.uint64), [held[r] for r in sorted(held)]) for n, held in found.items()}


def _has_run(words: list, run: list) -> bool:
    return any(words[i : i + len(run)] == run for i in range(len(words) - len(run) + 1))


def search(docs: DataFrame, benchmark: DataFrame, space: LatentSpace, min_lcs: float = MIN_LCS) -> DataFrame:
    """docs(doc_id, text, ...) without text, with item_id (null: clean), lcs_share, cosine, answer_found of the best match."""
    spark = docs.sparkSession
    wanted = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    n_blocks = max(1, -(-wanted.count() // BLOCK))
    if n_blocks > 1:  # a settled number of each row: ids may repeat or be null
        docs = settle(docs.withColumn("__row", F.monotonically_increasing_id()))
    out = None
    for block in range(n_blocks):
        rows = [(r["item_id"], r["text"]) for r in wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block).collect()]
        shared = spark.sparkContext.broadcast((space, *_items(sorted(rows), space), _short_items(sorted(rows))))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model, items, vectors, short = shared.value
            least = np.array([x[4] for x in items], np.float32)
            for batch in batches:
                best: list = [None] * batch.num_rows
                for i, _, h, ranges in text_words(*utf8_parts(batch.column("text"))):
                    for size, (runs, ids) in short.items():
                        mine = _runs(h, size)
                        at = np.minimum(np.searchsorted(runs, mine), len(runs) - 1)
                        for p in np.flatnonzero(runs[at] == mine).tolist():
                            r = int(np.searchsorted(ranges, p, "right")) - 1
                            got = (1.0, -ids[at[p]], 1.0, True)
                            if p + size <= ranges[r + 1] and (best[i + r] is None or got > best[i + r]):
                                best[i + r] = got
                    if not len(h) or not items:
                        continue
                    passages, starts, row = model.passages(h, ranges)
                    cosines = passages @ vectors.T
                    found_p, found_k = np.nonzero(cosines >= least)
                    # of overlapping passages, the one that fits better
                    own = cosines[found_p, found_k]
                    before, after = np.maximum(found_p - 1, 0), np.minimum(found_p + 1, len(row) - 1)
                    best_one = (own >= cosines[before, found_k]) | (row[before] != row[found_p])
                    best_one &= (own >= cosines[after, found_k]) | (row[after] != row[found_p])
                    for p, k in zip(found_p[best_one].tolist(), found_k[best_one].tolist(), strict=True):
                        item, size, places, answer, _ = items[k]
                        r = int(row[p])
                        a = max(int(ranges[r]), int(starts[p]) - size // 2)
                        b = min(int(ranges[r + 1]), int(starts[p]) + 2 * STRIDE + size // 2)
                        near = h[a:b].tolist()
                        share = lcs_length(places, size, near) / size
                        if share < MIN_PARAPHRASE:
                            continue
                        found = _has_run(near, answer)
                        if share >= min_lcs or found:
                            got = (share, -item, float(cosines[p, k]), found)
                            if best[i + r] is None or got > best[i + r]:
                                best[i + r] = got
                columns = [
                    pa.array([None if x is None else -x[1] for x in best], pa.int64()),
                    pa.array([None if x is None else x[0] for x in best], pa.float64()),
                    pa.array([None if x is None else x[2] for x in best], pa.float64()),
                    pa.array([None if x is None else x[3] for x in best], pa.bool_()),
                ]
                kept = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, "item_id", "lcs_share", "cosine", "answer_found"])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
        found = docs.mapInArrow(tidy(run), f"{fields}, item_id long, lcs_share double, cosine double, answer_found boolean")
        out = found if out is None else out.unionByName(found)
    if n_blocks > 1:  # the best block of each row
        keys = [f.name for f in docs.schema if f.name not in ("text", "__row")]
        score = F.struct("lcs_share", (-F.col("item_id")).alias("order"), "cosine", "answer_found")
        best = F.max(F.when(F.col("item_id").isNotNull(), score)).alias("b")
        out = out.groupBy("__row").agg(*(F.first(k).alias(k) for k in keys), best).select(
            *keys, (-F.col("b.order")).alias("item_id"), "b.lcs_share", "b.cosine", "b.answer_found"
        )
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, item_id, lcs_share, cosine, answer_found of each row of docs(doc_id, text)."""
    small_batches(docs)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = search(slim, benchmark, fit_space(slim, benchmark))
    return found.withColumn("contaminated", F.col("item_id").isNotNull())


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold a benchmark passage."""
    leaks = settle(find_leaks(docs, benchmark).where("contaminated").select("doc_id").distinct())
    return drop_ids(docs, leaks)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op9_decontaminate": op9_decontaminate}
