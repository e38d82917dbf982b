"""N-gram Jaccard join over count vectors in an R-tree, with exact routing.

A document's set is its distinct shingles of rule.width words, as 64-bit hashes; sets are linked from a Jaccard similarity of
rule.numerator / rule.denominator. The contract of op6 is RULE: 3 words, 90/100. Hash bits deal the shingles of a set into groups; the
counts of the groups are a point, and for two sets the summed minima of their coordinates bound the overlap from above. An
R-tree holds points with the coordinate-wise maxima of each node, in levels: a node whose summed minima with a query lie below
the overlap that the threshold asks for is skipped with all below it, and surviving pairs are verified on the sets themselves.
Points travel with the rows, so that pairs of step 3 meet the bound before any text is moved.

One tree over all documents would be a single task and, in so many dimensions, would prune little near its root, so rows
are routed to small trees first:

1. Texts are range-partitioned by (their least shingle hash, doc_id). In each partition a tree of leaders is built for each
   least hash; a document that verifies against a leader is linked to it, any other becomes a leader. Ranges split a hot
   key over tasks. A tree holds LEADERS leaders at most: what is missed here is found in step 3.
2. Components of these links.
3. Exact routing: shingles are put in one order for all documents, the rarer first (by a count sketch of fixed size over
   the whole corpus; any order gives right results). The first shingle that two linked sets share lies among the first
   |A| - o + 1 of the one and |B| - o + 1 of the other, where o is the overlap that the threshold asks of their sizes, so
   that only these few are exchanged, and a pair meets only where both places allow it. Edits make rare shingles, which
   come first: copies that differ too much don't meet, however many they are. Shingles are counted with the components
   of their documents, so that those within one component cost nothing more. Bitmaps of fixed size (no cap: collisions
   only let more through) select the shingles that components share and the texts that are to be verified. Twice each
   document is held against one document of each shingle, the one that shares most with others; then, where components
   are still apart, against all of the others.

No pair of one component is expanded and none between components is lost, up to 64-bit collisions of hashes.

Nulls: a document without words or text has an empty set, no links and is its own component; a null doc_id is never linked
and has a null component. Rows with one doc_id count as one node. Ids are whole numbers. Which of equally near documents a
row meets first changes no component. A very long text is a piece of work of its own. Other columns are ignored by
`similar_components` and carried by `keep_one`. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import bitmap_has, bitmap_of, chunks_of, drop_ids, in_bitmap, join_skewed, mix64, small_batches, tidy, utf8_parts, word_hashes
from corvid.operators.components import connected_components
from corvid.session import settle, shuffle_width

NUMERATOR, DENOMINATOR = 90, 100
POINT_DIMS = 32
LEADERS = 64
SKETCH_BITS = 20


class Rule(NamedTuple):
    """Words of a shingle, and the least Jaccard similarity of linked sets."""

    width: int = 3
    numerator: int = NUMERATOR
    denominator: int = DENOMINATOR


RULE = Rule()


# --- sets, points, signatures ---------------------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int = RULE.width) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row, lower-cased."""
    for i, j in chunks_of(at):
        h, _, _, rows = word_hashes(data, at[i : j + 1], lower=True)
        with np.errstate(over="ignore"):
            n = max(0, len(h) - width + 1)
            grams = h[:n] * np.uint64(0x9E3779B97F4A7C15)
            for k in range(1, width):
                grams = mix64((grams if k == 1 else grams * np.uint64(0xD6E8FEB86659FD93)) + h[k : k + n])
            for a, b in zip(rows[:-1], rows[1:], strict=True):
                if b - a >= width:
                    yield np.unique(grams[a : b - width + 1])
                elif b > a:
                    one = np.uint64(int(b - a))
                    for x in h[a:b]:
                        one = mix64(np.array([one * np.uint64(0xA0761D6478BD642F) + x], np.uint64))[0]
                    yield np.array([one], np.uint64)
                else:
                    yield h[:0]


def point_of(u: np.ndarray) -> np.ndarray:
    return np.bincount((mix64(u) & np.uint64(POINT_DIMS - 1)).astype(np.int64), minlength=POINT_DIMS).astype(np.int32)


def linked(inter: int, a: int, b: int, rule: Rule = RULE) -> bool:
    return rule.denominator * inter >= rule.numerator * (a + b - inter)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def overlap_needed(a, b, rule: Rule = RULE):
    """The least overlap of linked sets of these sizes."""
    return -((-rule.numerator * (a + b)) // (rule.numerator + rule.denominator))


def leading(u: np.ndarray, counts: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """The first shingles of a set in the order of (count class, hash), as many as a linked set may first share."""
    keep = len(u) - (-(-rule.numerator * len(u) // rule.denominator)) + 1
    order = np.argsort(counts[_cells(u)], kind="stable")  # u is sorted: equal classes stay in the order of hashes
    return u[order[:keep]].view(np.int64)


def _cells(u: np.ndarray) -> np.ndarray:
    return (mix64(u ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


class _Box:
    """A node: its entries (boxes, or numbers of sets in a leaf), their coordinate-wise maxima and their least sizes."""

    __slots__ = ("leaf", "entries", "high", "least")

    def __init__(self, leaf: bool, entries: list, high: np.ndarray, least: np.ndarray) -> None:
        self.leaf, self.entries, self.high, self.least = leaf, entries, high, least


class CountTree:
    """An R-tree over count vectors. Summed minima with the maxima of a box bound the overlap with every set below it, so
    that a box whose bound lies under the overlap that the threshold asks for is skipped with all that it holds."""

    WIDTH = 8

    def __init__(self, rule: Rule = RULE) -> None:
        self.rule = rule
        self.sets: list[np.ndarray] = []
        self.names: list = []
        self.root = _Box(True, [], np.zeros((0, POINT_DIMS), np.int32), np.zeros(0, np.int64))

    def find(self, u: np.ndarray, point: np.ndarray) -> int:
        """An entry that is linked with u, or -1."""
        share = self.rule.numerator / (self.rule.numerator + self.rule.denominator) - 1e-9
        stack = [self.root]
        while stack:
            box = stack.pop()
            near = np.flatnonzero(np.minimum(box.high, point).sum(1) >= share * (len(u) + box.least)).tolist()
            if not box.leaf:
                stack += [box.entries[k] for k in near]
                continue
            for k in near:
                other = self.sets[box.entries[k]]
                if linked(overlap(u, other), len(u), len(other), self.rule):
                    return box.entries[k]
        return -1

    def add(self, name, u: np.ndarray, point: np.ndarray) -> None:
        self.sets.append(u)
        self.names.append(name)
        path, box = [], self.root
        while not box.leaf:  # into the box that grows least
            k = int((np.maximum(box.high, point).sum(1) - box.high.sum(1)).argmin())
            box.high[k] = np.maximum(box.high[k], point)
            box.least[k] = min(box.least[k], len(u))
            path.append((box, k))
            box = box.entries[k]
        box.entries.append(len(self.sets) - 1)
        box.high, box.least = np.vstack((box.high, point)), np.append(box.least, len(u))
        while len(box.entries) > self.WIDTH:  # halves by the widest coordinate, up to the root
            order = np.argsort(box.high[:, int(np.ptp(box.high, axis=0).argmax())], kind="stable")
            halves = [_Box(box.leaf, [box.entries[i] for i in o], box.high[o], box.least[o]) for o in np.array_split(order, 2)]
            high, least = np.array([x.high.max(0) for x in halves]), np.array([x.least.min() for x in halves])
            if not path:
                self.root = _Box(False, halves, high, least)
                return
            parent, k = path.pop()
            parent.entries[k : k + 1] = halves
            parent.high = np.vstack((parent.high[:k], high, parent.high[k + 1 :]))
            parent.least = np.concatenate((parent.least[:k], least, parent.least[k + 1 :]))
            box = parent


# --- Spark steps -----------------------------------------------------------------------------------------------------


def _least_hash(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8_parts(batch.column("text"))
            sets = [(len(u), int(mix64(u).min()) >> 1 if len(u) else 0) for u in shingle_sets(data, at, rule.width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array([s[0] for s in sets], pa.int64()), pa.array([s[1] for s in sets], pa.int64())],
                ["doc_id", "text", "n", "least"],
            )

    return run


def _lead(rule: Rule):
    """Rows sorted by (least, doc_id): doc_id, n, its leader or itself, whether the sets are equal, and its point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree = None, CountTree(rule)
        for batch in batches:
            data, at = utf8_parts(batch.column("text"))
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("least").to_pylist()
            rows = []
            for doc, least, u in zip(ids, keys, shingle_sets(data, at, rule.width), strict=True):
                if least != key:
                    key, tree = least, CountTree(rule)
                if doc is None or not len(u):
                    rows.append((doc, len(u), doc, False, None))
                    continue
                point = point_of(u)
                found = tree.find(u, point)
                if found < 0:
                    if len(tree.sets) < LEADERS:
                        tree.add(doc, u, point)
                    rows.append((doc, len(u), doc, False, point.tobytes()))
                else:
                    other = tree.sets[found]
                    rows.append((doc, len(u), tree.names[found], len(other) == len(u) and bool((other == u).all()) and doc != tree.names[found], point.tobytes()))
            kinds = [("doc_id", pa.int64()), ("n", pa.int64()), ("leader", pa.int64()), ("equal", pa.bool_()), ("point", pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, (_, t) in enumerate(kinds)], [k for k, _ in kinds])

    return run


def count_classes(docs: DataFrame, rule: Rule = RULE):
    """A broadcast sketch: for each of 2^SKETCH_BITS cells, which hashes share, the binary logarithm of their number of
    documents, in quarters. Its size does not depend on the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SKETCH_BITS, np.int32)
        for batch in batches:
            for u in shingle_sets(*utf8_parts(batch.column("text")), rule.width):
                np.add.at(seen, _cells(u), 1)
        blocks = seen.reshape(64, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(64), pa.int32()), pa.array([b.tobytes() for b in blocks])], ["block", "counts"])

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SKETCH_BITS) // 64, np.int64)
        for part in pdf["counts"]:
            total += np.frombuffer(part, np.int32)
        return pd.DataFrame({"block": [key[0]], "classes": [np.minimum(4 * np.log2(total + 1), 255).astype(np.uint8).tobytes()]})

    rows = docs.select("text").mapInArrow(tidy(count), "block int, counts binary").groupBy("block").applyInPandas(add, "block int, classes binary").collect()
    classes = np.zeros((64, (1 << SKETCH_BITS) // 64), np.uint8)
    for r in rows:
        classes[r["block"]] = np.frombuffer(r["classes"], np.uint8)
    return docs.sparkSession.sparkContext.broadcast(classes.tobytes())


def _firsts(classes, rule: Rule, bitmap=None):
    """doc_id, n and the leading shingles with their places; with a bitmap, those whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.frombuffer(classes.value, np.uint8)
        bits = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            data, at = utf8_parts(batch.column("text"))
            ids, sizes, lengths, parts, places = [], [], [], [], []
            for doc, u in zip(batch.column("doc_id").to_pylist(), shingle_sets(data, at, rule.width), strict=True):
                if doc is None or not len(u):
                    continue
                first = leading(u, counts, rule)
                place = np.arange(len(first), dtype=np.int32)
                if bits is not None:
                    keep = bitmap_has(bits, first)
                    first, place = first[keep], place[keep]
                if len(first):
                    ids.append(doc)
                    sizes.append(len(u))
                    lengths.append(len(first))
                    parts.append(first)
                    places.append(place)
            ends = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x) if x else np.zeros(0, t))) for x, t in ((parts, np.int64), (places, np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "shingles", "places"])

    return run


_FIRSTS = "doc_id long, n long, shingles array<long>, places array<int>"


def within_bound(points: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose summed coordinate minima reach the overlap that the threshold asks for; points(doc_id, n, point)."""
    share = rule.numerator / (rule.numerator + rule.denominator) - 1e-9

    @F.pandas_udf("boolean")
    def reaches(pa_: pd.Series, pb: pd.Series, n: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(c), np.int32).reshape(-1, POINT_DIMS) for c in (pa_, pb))
        return pd.Series(np.minimum(x, y).sum(1) >= share * n.to_numpy())

    ends = [points.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("point").alias(f"p{c}")) for c in "ab"]
    return pairs.join(ends[0], "a").join(ends[1], "b").where(reaches("pa", "pb", F.col("na") + F.col("nb"))).select("a", "b").distinct()


def _verify(docs: DataFrame, points: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) of doc_ids that are linked, by the sets of their texts; only texts of pairs within the bound move."""
    pairs = settle(within_bound(points, pairs, rule))
    ids = settle(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    chosen = bitmap_of(ids, "doc_id")

    texts = docs.where("doc_id is not null").where(in_bitmap(chosen, "doc_id")).join(ids, "doc_id", "left_semi").select("doc_id", "text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (shingle_sets(*utf8_parts(batch.column(c)), rule.width) for c in ("ta", "tb"))
            ok = [bool(len(x)) and linked(overlap(x, y), len(x), len(y), rule) for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
    both = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
    return settle(both.select("a", "b", "ta", "tb").mapInArrow(tidy(check), "a long, b long"))


def _placed(component: DataFrame, of: DataFrame, name: str = "doc_id", to: str = "component") -> DataFrame:
    """of with the component of the node in column name: the node itself where it has no link yet."""
    c = component.select(F.col("node").alias(name), F.col("component").alias(to))
    return of.join(c, name, "left").withColumn(to, F.coalesce(to, F.col(name)))


def _merged(component: DataFrame, links: DataFrame) -> DataFrame:
    """component(node, component) after the links (a, b): only the components that they touch are joined anew."""
    ends = _placed(component, _placed(component, links, "a", "ca"), "b", "cb")
    joined = settle(connected_components(ends.select("ca", "cb"), "ca", "cb"))
    moved = join_skewed(component, joined.select(F.col("node").alias("component"), F.col("component").alias("to")), "component")
    alone = joined.join(component.select("node"), "node", "left_anti")
    return moved.select("node", F.coalesce("to", "component").alias("component")).unionByName(alone.select("node", "component"))


def similar_components(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of docs(doc_id, text)."""
    small_batches(docs)
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = docs.mapInArrow(tidy(_least_hash(rule)), "doc_id long, text string, n long, least long")
    ranged = keyed.repartitionByRange(2 * shuffle_width(spark), "least", "doc_id").sortWithinPartitions("least", "doc_id")
    led = settle(ranged.select("doc_id", "text", "least").mapInArrow(tidy(_lead(rule)), "doc_id long, n long, leader long, equal boolean, point binary"))
    links = led.where("leader <> doc_id").select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    component = settle(connected_components(links, "a", "b"))

    # leading shingles of every different set, with the component of its document; equal sets are with their leader already
    classes = count_classes(docs, rule)
    skip = led.groupBy("doc_id").agg(F.min("equal").alias("equal")).where("equal").select("doc_id")
    firsts = _placed(component, docs.mapInArrow(tidy(_firsts(classes, rule)), _FIRSTS).select("doc_id", "shingles").join(skip, "doc_id", "left_anti"))
    ends = firsts.select(F.explode("shingles").alias("shingle"), "component").groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    shared = settle(ends.where("lo <> hi").select("shingle"))
    bits = bitmap_of(shared, "shingle")
    again = docs.mapInArrow(tidy(_firsts(classes, rule, bits)), _FIRSTS).join(skip, "doc_id", "left_anti")
    flat = again.select("doc_id", "n", F.explode(F.arrays_zip("shingles", "places")).alias("x")).select("doc_id", "n", F.col("x.shingles").alias("shingle"), F.col("x.places").alias("place"))
    members = settle(flat.join(shared, "shingle", "left_semi").distinct())
    # a document that shares more of its shingles is nearer to the middle of its group: the first to be held against
    members = settle(members.join(members.groupBy("doc_id").agg(F.count("*").alias("shares")), "doc_id"))
    need = F.ceil(F.lit(rule.numerator) * (F.col("n") + F.col("na")) / (rule.numerator + rule.denominator) - 1e-9)
    may_meet = (F.col("place") <= F.col("n") - need) & (F.col("pa") <= F.col("na") - need)
    checked = None
    for whole in (False, False, True):
        now = settle(_placed(component, members))
        if whole:
            other = now.select("shingle", F.col("doc_id").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("place").alias("pa"))
            met = now.join(other, "shingle").where((F.col("ca") < F.col("component")) & may_meet)
        else:
            best = now.groupBy("shingle").agg(F.max(F.struct("shares", (-F.col("doc_id")).alias("least"), "component", "n", "place")).alias("p"))
            other = settle(best.select("shingle", (-F.col("p.least")).alias("a"), F.col("p.component").alias("ca"), F.col("p.n").alias("na"), F.col("p.place").alias("pa")))
            met = now.join(other, "shingle").where((F.col("ca") != F.col("component")) & may_meet)
        pairs = met.select(F.least("a", "doc_id").alias("a"), F.greatest("a", "doc_id").alias("b")).distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = settle(pairs)
        checked = pairs if checked is None else checked.unionByName(pairs)
        fresh = _verify(docs, led.where("point is not null"), pairs, rule) if not pairs.isEmpty() else pairs
        if fresh.isEmpty():
            continue
        component = settle(_merged(component, fresh))
    return _placed(component, led.select("doc_id", F.col("n").alias("n_shingles"))).withColumnRenamed("component", "component_id")


def keep_one(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """docs without the documents that are not the least of their component; one row of each repeated doc_id's equal rows stays as it is."""
    found = similar_components(docs.select("doc_id", "text"), rule)
    gone = settle(found.where("component_id <> doc_id").select("doc_id").distinct())
    return drop_ids(docs, gone)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op6_ngram_join": op6_ngram_join}
