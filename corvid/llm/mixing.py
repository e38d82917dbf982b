"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree over blocks.

The documents of a source, in a seeded order, are one long row of words that is cut into blocks of BLOCK words; a document that
crosses a border is divided there, as when sequences are packed. A source's target in words is met by passes over its blocks,
each in an order of its own (a keyed permutation), whole passes first and then the first blocks of one more, the last of them
in part. So the words taken are the target, rounded down to a word, and no document is used more often than passes begun.

The output shards are the leaves of a binary tree. At its root stand the quotas, blocks by source; each inner node deals its
blocks to its two sides without replacement, in proportion to their shards, so that quotas stay exact and every shard is a
random mixture. A split is seeded by its node alone: a shard walks from the root to its leaf and knows its quotas and what the
shards before it draw, without talking to any other. It then draws its own stretch of each source's permuted blocks, and
the stretches are disjoint. `order_key` shuffles the pieces within a shard.

No text is moved: rows carry sizes and positions, and `with_texts` cuts the words out at the end. Running sums over a source
come from sorted range partitions and one row for each partition and source, so that a source with a third of all rows is
spread like any other. Weights and sizes by source are a table of the length of the mixture's recipe, at most MAX_SOURCES.

Nulls: a null text has no words; a null source is a source of its own, the last one. Repeated rows are rows of their own and
documents without words are in no piece. Very long texts are divided into blocks. Columns other than doc_id, text and source
are ignored. An empty table gives an empty result; where no document has a word, all targets are 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import words_of
from corvid.llm.sharding import permute
from corvid.session import settle, shuffle_width

SHARDS = 64
BLOCK = 512  # words
SEED = 11
MAX_REPEATS = 3
MAX_SOURCES = 100_000
MAX_BLOCKS = 500_000_000  # blocks grow beyond BLOCK words where a corpus has more
DRAWS = 1 << 14  # draws in one row


def targets(sizes: list[int], weights: list[float], most: float = MAX_REPEATS) -> list[float]:
    """Words of each source: shares by weight, none above `most` times its size, what is cut off shared again by weight."""
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if unit * weights[i] > most * sizes[i]}
        for i in over or open_:
            out[i] = most * sizes[i] if over else unit * weights[i]
        open_ -= over or open_
        left = float(sum(sizes)) - sum(out[i] for i in range(len(sizes)) if i not in open_)
    return out


def _seed(*parts: int) -> int:
    return zlib.crc32(":".join(map(str, parts)).encode()) | 1 << 32


def draws_of(size: int, target: int, block: int, source: int, seed: int = SEED) -> int:
    """How many blocks meet a target: whole passes, then as many of the next pass's blocks as hold the rest."""
    if not size:
        return 0
    blocks, rest = -(-size // block), target % size
    full = target // size * blocks
    if not rest:
        return full
    # the source's last block may be short; before it comes in the pass, all blocks are full
    place = int(permute(np.array([blocks - 1]), blocks, _seed(seed, source, target // size), back=True)[0])
    short = size - (blocks - 1) * block
    return full + (-(-rest // block) if rest <= place * block else max(place + 1, -(-(rest + block - short) // block)))


def blocks_at(first: int, n: int, size: int, target: int, block: int, source: int, seed: int = SEED) -> pd.DataFrame:
    """The blocks of draws first ... first + n - 1 of a source: draw, block and the words taken from its start."""
    blocks = -(-size // block)
    draw = np.arange(first, first + n)
    turn = draw // blocks
    at = np.empty(n, np.int64)
    for e in np.unique(turn):
        here = turn == e
        at[here] = permute(draw[here] % blocks, blocks, _seed(seed, source, int(e)))
    words = np.where(at == blocks - 1, size - (blocks - 1) * block, block)
    last = target // size * blocks
    if (part := draw >= last).any():  # of the pass that isn't whole
        place = int(permute(np.array([blocks - 1]), blocks, _seed(seed, source, target // size), back=True)[0])
        k = draw[part] - last
        before = k * block - np.where(k > place, block - (size - (blocks - 1) * block), 0)
        words[part] = np.minimum(words[part], target % size - before)
    return pd.DataFrame({"draw": draw, "block": at, "take": words})


def shard_quotas(shard: int, shards: int, quotas: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """First draw and draws of a shard by source, along its path through the splitting tree."""
    low, high, have, before = 0, shards, quotas.astype(np.int64), np.zeros(len(quotas), np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        total = int(have.sum())
        draw = np.random.default_rng([seed, low, high])
        # what falls beside the blocks that don't divide evenly is decided by the node's own seed too
        exact = total * (middle - low)
        side = exact // (high - low) + (draw.random() < exact % (high - low) / (high - low))
        left = draw.multivariate_hypergeometric(have, int(side), method="marginals") if total else have
        if shard < middle:
            high, have = middle, left
        else:
            low, have, before = middle, have - left, before + left
    return before, have


def lay_out(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """row (a number of its own), doc_id, source, size, start: each document's words in its source's row of words."""
    spark = docs.sparkSession
    slim = docs.select(
        "doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"), F.xxhash64("doc_id", F.lit(seed)).alias("h"), F.xxhash64("text").alias("t")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows with sums within the partition. The partition's number comes from the task that sorted it."""
        part, row, now, total = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            sources, sizes = batch.column("source").to_pylist(), batch.column("size").to_numpy()
            starts = np.empty(len(sizes), np.int64)
            for k, (s, n) in enumerate(zip(sources, sizes.tolist(), strict=True)):
                if s != now or row + k == 0:
                    now, total = s, 0
                starts[k] = total
                total += n
            rows = (part << 33) + row + np.arange(len(sizes))
            row += len(sizes)
            cols = {c: batch.column(c) for c in ("doc_id", "source", "size")} | {"row": pa.array(rows), "part": pa.array(np.full(len(rows), part, np.int32)), "local": pa.array(starts)}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    order = ["source", "h", "doc_id", "size", "t"]
    kind = dict(docs.dtypes)["doc_id"]
    sums = settle(
        slim.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
        .mapInArrow(run, f"doc_id {kind}, source string, size long, row long, part int, local long")
    )
    totals = sums.groupBy("part", "source").agg(F.sum("size").alias("n")).collect()  # a row for each partition, and for each source
    before: dict[str | None, int] = {}
    starts = []
    for r in sorted(totals, key=lambda r: r["part"]):
        starts.append((r["part"], r["source"], before.get(r["source"], 0)))
        before[r["source"]] = before.get(r["source"], 0) + r["n"]
    table = spark.createDataFrame(starts, "p int, s string, base long")
    on = (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))
    return sums.join(F.broadcast(table), on).select("row", "doc_id", "source", "size", (F.col("base") + F.col("local")).alias("start"))


def recipe(laid: DataFrame, weights: dict[str | None, float] | None = None) -> pd.DataFrame:
    """source, source_size, weight, target, block of each source; without weights they are 1, 2, 3, 1, ... in code-point order, null
    last."""
    rows = laid.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"a mixture has {MAX_SOURCES} sources at most")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["n"] for r in rows]
    shares = [weights[r["source"]] if weights else 1.0 + k % 3 for k, r in enumerate(rows)]
    block = max(BLOCK, -(-MAX_REPEATS * sum(sizes) // MAX_BLOCKS))
    return pd.DataFrame({
        "source": pd.Series([r["source"] for r in rows], dtype=object), "number": range(len(rows)), "source_size": sizes,
        "weight": shares, "target": targets(sizes, shares), "block": block,
    })


def mix(laid: DataFrame, plan: pd.DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mixture in pieces: row, doc_id, source, first (word of the document), words, shard, draw, order_key."""
    spark = laid.sparkSession
    size, goal, block = plan["source_size"].to_numpy(), np.floor(plan["target"].to_numpy()).astype(np.int64), int(plan["block"].max() if len(plan) else BLOCK)
    quotas = np.array([draws_of(int(s), int(g), block, k, seed) for k, (s, g) in enumerate(zip(size, goal, strict=True))], np.int64)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard in pdf["id"]:
                first, n = shard_quotas(int(shard), shards, quotas, seed)
                used = np.flatnonzero(n)
                yield pd.DataFrame({"shard": int(shard), "number": used, "first": first[used], "n": n[used]})

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                got = blocks_at(r.first, r.n, int(size[r.number]), int(goal[r.number]), block, r.number, seed)
                got.insert(0, "number", r.number)
                got.insert(0, "shard", r.shard)
                yield got

    width = shuffle_width(spark)
    dealt = spark.range(shards, numPartitions=min(shards, width)).mapInPandas(deal, "shard int, number int, first long, n long")
    runs = dealt.select(
        "shard", "number", "first", "n", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1).cast("long"), F.lit(DRAWS).cast("long"))).alias("k")
    ).select("shard", "number", (F.col("first") + F.col("k")).alias("first"), F.least(F.lit(DRAWS).cast("long"), F.col("n") - F.col("k")).alias("n"))
    drawn = runs.repartition(width).mapInPandas(draw, "shard int, number int, draw long, block long, take long")
    numbers = spark.createDataFrame([(s, int(k)) for s, k in zip(plan["source"], plan["number"], strict=True)], "s string, number int")
    end = F.col("start") + F.col("size")
    pieces = (
        laid.where("size > 0")
        .join(F.broadcast(numbers), F.col("source").eqNullSafe(F.col("s")))  # a row for each source
        .select("*", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))).alias("block"))
        .withColumn("from", F.greatest(F.col("start"), F.col("block") * block))
        .withColumn("to", F.least(end, (F.col("block") + 1) * block))
    )
    words = F.least("to", F.col("block") * block + F.col("take")) - F.col("from")
    return (
        pieces.join(drawn.hint("merge"), ["number", "block"])  # what Python makes of few rows looks small to the planner and isn't
        .select("row", "doc_id", "source", (F.col("from") - F.col("start")).alias("first"), words.alias("words"), "shard", "draw")
        .where("words > 0")
        .withColumn("order_key", F.xxhash64("shard", "source", "draw", "row", "first", F.lit(seed)))
    )


def with_texts(pieces: DataFrame, docs: DataFrame) -> DataFrame:
    """pieces with text: the piece's words joined by one space. docs(doc_id, text) must have distinct ids; rows are placed by shard
    and order_key, so that a shard's pieces are shuffled in the order of the files."""
    words = F.slice(words_of(F.col("__text")), (F.col("first") + 1).cast("int"), F.col("words").cast("int"))
    texts = docs.select("doc_id", F.col("text").alias("__text"))
    joined = pieces.join(texts, "doc_id").withColumn("text", F.array_join(words, " ")).drop("__text")
    return joined.repartitionByRange(shuffle_width(docs.sparkSession), "shard", "order_key").sortWithinPartitions("shard", "order_key")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    laid = settle(lay_out(docs))
    plan = recipe(laid)
    taken = mix(laid, plan).groupBy("row").agg(F.sum("words").alias("taken"))
    rows = [(s, int(n), float(t)) for s, n, t in zip(plan["source"], plan["source_size"], plan["target"], strict=True)]
    table = spark.createDataFrame(rows, "s string, source_size long, target double")
    return (
        laid.join(taken, "row", "left")
        .join(F.broadcast(table), F.col("source").eqNullSafe(F.col("s")))  # a row for each source
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "source", "start")
    )


QUERIES = {"op11_mixing": op11_mixing}
