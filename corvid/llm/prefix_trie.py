"""Conversation prefix trie: which first turns conversations share, and what sharing them saves.

A conversation's turns are chained into digests: node 0 is the root, node d is the hash of node d-1 and of turn d, so that
two conversations meet in a node exactly if their first d turns are equal. Every prefix is exploded into a row and the rows
are grouped by (depth, digest). Subtree sums explode each node to its ancestors and add up. To all ancestors that would be the
square of the depth; instead a node goes to those in its block of FAN depths, and the heads of the blocks form a smaller
tree that is summed in the same way. A trie no deeper than FAN is one block: every node to every ancestor.

Texts are hashed where they are read and never shuffled; a conversation is gathered as 40 bytes a turn. Members and sums
are combined before they are shuffled, so that a node of all conversations is one row for each task. The ids that end in a
node are written as text in sorted chunks and then hashed as a stream, so a node of very many copies needs no memory for them.

Nulls: a null role or text is empty, a null turn sorts first; rows with a null conv_id belong to no conversation and are left
out. Rows of a conversation that tie in turn are taken by the hash of role and text; repeated rows are turns of their own.
Very long texts count whole. A conversation without turns is a member of the root. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.session import settle, shuffle_width

FAN = 32
ROOT = hashlib.sha256(b"").digest()[:16]
CHUNK = 1 << 18  # characters of ids in one row


def gather_turns(rows: DataFrame) -> DataFrame:
    """conv_id, turns(turn, digest, size) in order; size is that of the text in bytes."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turn = F.struct("turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    return rows.where("conv_id is not null").select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _chain(fan: int):
    """Blocks of each conversation's chain of node ids. Level l has the nodes at depths that fan^l divides; before is the
    node that precedes a block on its level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("conv_id", "n_turns", "level", "block", "ids", "sizes", "before")}
            turns = batch.column("turns")
            flat = turns.flatten()
            digests, lengths = flat.field("digest").to_pylist(), flat.field("size").to_pylist()
            at = 0
            for conv, n in zip(batch.column("conv_id").to_pylist(), turns.value_lengths().to_pylist(), strict=True):
                ids = [ROOT]
                for d in digests[at : at + n]:
                    ids.append(hashlib.sha256(ids[-1] + d).digest()[:16])
                sizes = [0, *lengths[at : at + n]]
                at += n
                level = 0
                while level == 0 or len(ids) > 1:
                    for k in range(0, len(ids), fan):
                        for name, value in zip(out, (conv, n, level, k // fan, ids[k : k + fan], sizes[k : k + fan], ids[k - 1] if k else None), strict=True):
                            out[name].append(value)
                    ids, sizes, level = ids[::fan], [], level + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["conv_id"], pa.int64()), pa.array(out["n_turns"], pa.int64()), pa.array(out["level"], pa.int32()),
                    pa.array(out["block"], pa.int64()), pa.array(out["ids"], pa.list_(pa.binary())), pa.array(out["sizes"], pa.list_(pa.int64())),
                    pa.array(out["before"], pa.binary()),
                ],
                list(out),
            )

    return run


def subtree_sums(levels: list[DataFrame], values: DataFrame, names: list[str], fan: int = FAN) -> DataFrame:
    """For each id of values(id, *names) the sums over its subtree. levels[l] has id, prev (the node before it on level l, null
    for the root) and up (the nodes of its block from the head to itself)."""

    def total(df: DataFrame) -> DataFrame:
        return df.groupBy("id").agg(*[F.sum(n).alias(n) for n in names])

    def spread(level: DataFrame, own: DataFrame) -> DataFrame:
        return total(level.join(own, "id").select(F.explode("up").alias("id"), *names))

    own = [values]
    for level in levels[:-1]:
        own.append(settle(total(level.join(own[-1], "id").select(F.col("up")[0].alias("id"), *names))))
    sums = spread(levels[-1], own[-1])
    for level, mine in zip(levels[-2::-1], own[-2::-1], strict=True):
        below = settle(sums).join(level.select("id", "prev"), "id").where("prev is not null").select(F.col("prev").alias("id"), *names)
        sums = spread(level, total(mine.select("id", *names).unionByName(below)))
    return sums


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, conv_id) to chunks of comma-joined numbers; seq is the number of a chunk in its partition."""
    seq, now, held, size = 0, None, [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([seq], pa.int64()), pa.array([",".join(held)])], ["id", "seq", "chunk"])

    for batch in batches:
        for node, conv in zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if held and (node != now or size > CHUNK):
                yield out()
                seq, held, size = seq + 1, [], 0
            now, text = node, str(conv)
            held.append(text)
            size += len(text) + 1
    if held:
        yield out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in the order of (id, part, seq) to one hash a node."""
    now, state = None, hashlib.sha256()
    for batch in batches:
        done = []
        for node, chunk in zip(batch.column("id").to_pylist(), batch.column("chunk").to_pylist(), strict=True):
            if node != now:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(chunk.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["id", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["id", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """id, ends_sha256 over the ascending conv_ids of ends(id, conv_id)."""
    width = shuffle_width(ends.sparkSession)
    chunks = (
        ends.repartitionByRange(width, "id", "conv_id").sortWithinPartitions("id", "conv_id")
        .mapInArrow(_texts, "id binary, seq long, chunk string").withColumn("part", F.spark_partition_id())
    )
    return chunks.repartition(width, "id").sortWithinPartitions("id", "part", "seq").select("id", "chunk").mapInArrow(_digests, "id binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, fan: int = FAN) -> DataFrame:
    """Nodes of the trie over convs(conv_id, turns(digest, size)), a row each with id, depth, parent, conv_id, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    slim = convs.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))
    schema = "conv_id long, n_turns long, level int, block long, ids array<binary>, sizes array<long>, before binary"
    chains = settle(slim.mapInArrow(_chain(fan), schema))
    prefixes = chains.where("level = 0").select(
        "conv_id", "n_turns", "block", F.posexplode(F.arrays_zip("ids", "sizes")).alias("pos", "x")
    ).select("conv_id", "n_turns", (F.col("block") * fan + F.col("pos")).alias("depth"), F.col("x.ids").alias("id"), F.col("x.sizes").alias("size"))
    nodes = settle(prefixes.groupBy("depth", "id").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size")))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0

    def on_level(level: int) -> DataFrame:
        """The nodes at depths that fan^level divides, each with its place in the chain of its smallest member."""
        step = fan**level
        place = F.floor(F.col("depth") / step)
        mine = nodes.where(F.col("depth") % step == 0).select(
            "id", F.col("conv_id").alias("__conv"), F.floor(place / fan).alias("__block"), (place % fan).cast("int").alias("pos")
        )
        blocks = chains.where(F.col("level") == level).select(F.col("conv_id").alias("__conv"), F.col("block").alias("__block"), "ids", "before")
        placed = mine.join(blocks, ["__conv", "__block"], "left")  # the root's smallest member may have no chain on a higher level
        return placed.select(
            "id", F.when(F.col("pos") > 0, F.get("ids", F.col("pos") - 1)).otherwise(F.col("before")).alias("prev"),
            F.coalesce(F.slice("ids", F.lit(1), F.col("pos") + 1), F.array("id")).alias("up"),
        )

    levels = [settle(on_level(0))]
    while fan ** len(levels) <= deepest:
        levels.append(settle(on_level(len(levels))))
    parents = levels[0].select("id", F.col("prev").alias("parent"))
    children = parents.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    known = settle(nodes.join(parents, "id").join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    values = known.select("id", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    sums = subtree_sums(levels, values, ["n_leaves", "saved_tokens"], fan)
    ends = end_digests(prefixes.where("depth = n_turns").select("id", "conv_id"))
    above = known.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # a row for each parent that has children goes back to its children through the two joins below
    of_parent = known.join(above.withColumn("__h", F.xxhash64("parent")), (known["parent"] == above["parent"]) & (F.xxhash64(known["parent"]) == F.col("__h")), "left")
    return (
        of_parent.drop(above["parent"]).drop("__h")
        .join(sums, "id").join(ends, "id", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
        .select("id", "depth", "parent", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    )


def lead_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % 9).cast("int")


def rebuild(convs: DataFrame) -> DataFrame:
    """Each conversation of convs(conv_id, turns) with its first h turns replaced by those of conversation conv_id - conv_id % 5."""
    heads = convs.select(F.col("conv_id").alias("__base"), F.slice("turns", 1, 8).alias("lead"))
    h = lead_length(F.col("conv_id"))
    none = F.slice("turns", F.lit(1), F.lit(0))
    return (
        convs.withColumn("__base", F.col("conv_id") - F.col("conv_id") % 5)
        .join(heads, "__base", "left")
        .select(
            "conv_id",
            F.concat(F.slice(F.coalesce("lead", none), F.lit(1), h), F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns"),
        )
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return prefix_trie(rebuild(settle(gather_turns(rows)))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


QUERIES = {"op13_prefix_trie": op13_prefix_trie}

#: CRC-32 by its polynomial, bit by bit, over the digits of a number.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

ORACLES = {
    "op13_prefix_trie": f"""
        WITH turns AS (
            SELECT conv_id, turn, sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                strlen(coalesce(text, '')) AS s
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT conv_id, list({{'k': k, 's': s}} ORDER BY turn NULLS FIRST, k) AS l, {_CRC} % 9 AS h FROM turns GROUP BY conv_id
        ), rebuilt AS (
            SELECT a.conv_id, list_concat(coalesce(b.l, [])[1:a.h], a.l[a.h + 1:]) AS l
            FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5
        ), prefixes AS (
            SELECT conv_id, d AS depth, len(l) AS n, array_to_string(list_transform(l[1:d], lambda x: x.k), '') AS key,
                CASE WHEN d > 0 THEN l[d].s ELSE 0 END AS s
            FROM (SELECT conv_id, l, unnest(range(len(l) + 1)) AS d FROM rebuilt)
        ), nodes AS (
            SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(s) AS s,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
            FROM prefixes GROUP BY key, depth
        ), kids AS (
            SELECT p.key, count(*) AS c FROM nodes p JOIN nodes k ON k.depth = p.depth + 1 AND left(k.key, 64 * CAST(p.depth AS INT)) = p.key GROUP BY p.key
        ), valued AS (
            SELECT n.*, coalesce(c, 0) AS n_children FROM nodes n LEFT JOIN kids USING (key)
        ), above AS (
            SELECT left(key, 64 * CAST(a AS INT)) AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * s) AS saved_tokens
            FROM (SELECT *, unnest(range(depth + 1)) AS a FROM valued) GROUP BY 1
        )
        SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(a.n_leaves AS BIGINT) AS n_leaves,
            CAST(a.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
        FROM valued v JOIN above a USING (key) LEFT JOIN nodes p ON v.depth > 0 AND p.key = left(v.key, 64 * CAST(v.depth - 1 AS INT))
    """
}
