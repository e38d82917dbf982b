"""Control flow and data flow of functions as tables: reaching definitions, data-flow edges, measures of control-flow graphs.

A graph is named by its function (any columns `on`); its blocks are numbers from 0, the entry. All functions are worked on at once:
a round of a fixpoint is one join over all of them, and rounds end with the deepest function. What depends on the order of
visits (components, dominators, path counts) is a small kernel on the blocks and edges of one function."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import kernels as K
from corvid.session import settle, shuffle_width

MOST_PATHS = 1000
LONGEST = 50


def reaching_definitions(edges: DataFrame, defs: DataFrame, on: Sequence[str]) -> DataFrame:
    """on, block, symbol, def_block: the definitions that reach the start of each block, of edges(on, src, dst) and
    defs(on, block, symbol). A definition goes on through blocks that don't define its symbol anew. Each round sends only
    what was new in the last one."""
    on = list(on)
    links = settle(edges.select(*on, "src", "dst").distinct())
    made = settle(defs.select(*on, "block", "symbol").distinct())
    out = made.select(*on, F.col("block").alias("src"), "symbol", F.col("block").alias("def_block"))
    key = [*on, "block", "symbol", "def_block"]
    front = settle(out.join(links, [*on, "src"]).select(*on, F.col("dst").alias("block"), "symbol", "def_block").distinct())
    known, rounds = front, 0
    while not front.isEmpty():
        through = front.join(made, [*on, "block", "symbol"], "left_anti").withColumnRenamed("block", "src")
        sent = through.join(links, [*on, "src"]).select(*on, F.col("dst").alias("block"), "symbol", "def_block").distinct()
        front = settle(sent.join(known, key, "left_anti"))
        known, rounds = known.unionByName(front), rounds + 1
        if rounds % 8 == 0:
            known = settle(known)
    return settle(known)


def data_flow(edges: DataFrame, symbols: DataFrame, on: Sequence[str]) -> DataFrame:
    """on, src_block, dst_block, symbol, kind, via_phi, uses: from definitions to uses. symbols(on, block, place, symbol,
    is_def) are the names that the statements of a block write and read; of one statement the reads come first. A read of what an
    earlier statement of its block wrote is `intra-block`; any other read has a `data-flow` edge from each block whose
    definition reaches it, via_phi where these are several. Reads of what nothing defines have none."""
    on = list(on)
    defs, uses = symbols.where("is_def"), symbols.where("not is_def")
    first = defs.groupBy(*on, "block", "symbol").agg(F.min("place").alias("first"))
    seen = uses.join(first, [*on, "block", "symbol"], "left").withColumn("local", F.coalesce(F.col("first") < F.col("place"), F.lit(False)))
    inside = seen.where("local").groupBy(*on, "block", "symbol").agg(F.count("*").alias("uses"))
    inside = inside.select(*on, F.col("block").alias("src_block"), F.col("block").alias("dst_block"), "symbol", F.lit("intra-block").alias("kind"), F.lit(False).alias("via_phi"), "uses")
    reach = reaching_definitions(edges, defs, on)
    several = reach.groupBy(*on, "block", "symbol").agg((F.count("*") > 1).alias("via_phi"))
    outside = seen.where("not local").groupBy(*on, "block", "symbol").agg(F.count("*").alias("uses"))
    flow = outside.join(reach, [*on, "block", "symbol"]).join(several, [*on, "block", "symbol"])
    return inside.unionByName(flow.select(*on, F.col("def_block").alias("src_block"), F.col("block").alias("dst_block"), "symbol", F.lit("data-flow").alias("kind"), "via_phi", "uses"))


def _strong(blocks: list[int], after: dict[int, list[int]], before: dict[int, list[int]]) -> dict[int, int]:
    """The least block of each block's strong component: forward in postorder, then backward."""
    order, seen = [], set()
    for root in blocks:
        stack = [] if root in seen else [(root, iter(after[root]))]
        seen.add(root)
        while stack:
            v, rest = stack[-1]
            w = next((w for w in rest if w not in seen), None)
            if w is None:
                order.append(v)
                stack.pop()
            else:
                seen.add(w)
                stack.append((w, iter(after[w])))
    home: dict[int, int] = {}
    for root in reversed(order):
        if root not in home:
            part, todo = [root], [root]
            home[root] = root
            while todo:
                for u in before[todo.pop()]:
                    if u not in home:
                        home[u] = root
                        part.append(u)
                        todo.append(u)
            home.update(dict.fromkeys(part, min(part)))
    return home


def _longest(steps: set[tuple[int, int]]) -> int:
    """Edges on the longest path of an acyclic graph."""
    into, after = defaultdict(int), defaultdict(list)
    for a, b in steps:
        into[b] += 1
        after[a].append(b)
    level = {v: 0 for v in after if not into[v]}
    todo = list(level)
    for v in todo:
        for w in after[v]:
            level[w] = max(level.get(w, 0), level[v] + 1)
            into[w] -= 1
            if not into[w]:
                todo.append(w)
    return max(level.values(), default=0)


def _paths(after: dict[int, list[int]], before: dict[int, list[int]], starts: list[int], targets: list[int], most: int, longest: int) -> int:
    found = 0
    for target in targets:
        left, queue = {target: 0}, [target]
        for v in queue:
            for u in before[v]:
                if u not in left:
                    left[u] = left[v] + 1
                    queue.append(u)
        for start in starts:
            if start == target or start not in left:
                continue
            path, stack = {start}, [(start, iter(after[start]))]
            while stack and found < most:
                v, rest = stack[-1]
                w = next((w for w in rest if w not in path and w in left and len(stack) + left[w] <= longest), None)
                if w is None:
                    stack.pop()
                    path.discard(v)
                elif w == target:
                    found += 1
                else:
                    path.add(w)
                    stack.append((w, iter(after[w])))
    return found


def _graph(edges: list) -> tuple[list[tuple[int, int]], dict[int, list[int]], dict[int, list[int]]]:
    after, before = defaultdict(list), defaultdict(list)
    pairs = sorted({(e["src"], e["dst"]) for e in edges})
    for s, t in pairs:
        after[s].append(t)
        before[t].append(s)
    return pairs, after, before


def _packed(links: DataFrame, marks: DataFrame, on: list[str]) -> DataFrame:
    """A row for each function: its edges (src, dst) and its marked blocks (block, is_start, is_end) as arrays, whose size is that of the
    function."""
    edge = F.struct(F.col("src").cast("int").alias("src"), F.col("dst").cast("int").alias("dst"))
    mark = F.struct(F.col("block").cast("int").alias("block"), "is_start", "is_end")
    rows = links.select(*on, edge.alias("e"), F.lit(None).cast("struct<block:int,is_start:boolean,is_end:boolean>").alias("m"))
    rows = rows.unionByName(marks.select(*on, F.lit(None).cast("struct<src:int,dst:int>").alias("e"), mark.alias("m")))
    packed = rows.groupBy(*on).agg(F.collect_list("e").alias("edges"), F.collect_list("m").alias("marks"))
    return packed.repartition(shuffle_width(links.sparkSession), *on)


def _kinds(df: DataFrame, on: list[str]) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*on).schema.fields)


def simple_path_counts(edges: DataFrame, ends: DataFrame, on: Sequence[str], most: int = MOST_PATHS, longest: int = LONGEST) -> DataFrame:
    """on, paths: simple paths from the starts to the ends of ends(on, block, is_start, is_end), of at most `longest` edges; counting
    ends at `most` for each function. A search goes only where an end can still be reached in the edges that are left."""
    on = list(on)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for edges, marks in zip(pdf["edges"], pdf["marks"], strict=True):
                _, after, before = _graph(edges)
                starts, targets = (sorted({m["block"] for m in marks if m[c]}) for c in ("is_start", "is_end"))
                found.append(_paths(after, before, starts, targets, most, longest))
            yield pdf[on].assign(paths=found)

    return _packed(edges, ends, on).mapInPandas(count, f"{_kinds(edges, on)}, paths long")


def block_measures(links: DataFrame, marks: DataFrame, on: Sequence[str]) -> DataFrame:
    """on, block, component (least block of its strong component), in_loop, distance and depth (from the entry; null where it doesn't
    lead), frontier, and for the function longest_path and paths: a kernel for each function of links(on, src, dst) and marks(on,
    block, is_start, is_end), all of its blocks. A join's predecessors climb the dominator tree up to the join's own
    dominator, and all that they pass have the join in their frontier."""
    on = list(on)

    names = ("block", "component", "in_loop", "distance", "depth", "frontier", "longest_path", "paths")

    def measure(edges: list, marks: list) -> list[tuple]:
        pairs, after, before = _graph(edges)
        blocks, starts, targets = (sorted({m["block"] for m in marks if c is None or m[c]}) for c in (None, "is_start", "is_end"))
        home = _strong(blocks, after, before)
        size = Counter(home[v] for v in blocks)
        entry = starts[0] if starts else None
        far, queue = ({}, []) if entry is None else ({entry: 0}, [entry])
        for v in queue:
            for w in after[v]:
                if w not in far:
                    far[w] = far[v] + 1
                    queue.append(w)
        idom, depth = ({}, {}) if entry is None else K.immediate_dominators(pairs, entry)
        front = defaultdict(set)
        for s, t in pairs:
            while s in idom and t in idom and s != idom[t]:
                front[s].add(t)
                s = idom[s]
        cyclic = max(size.values(), default=1) > 1
        longest = _longest({(home[a], home[b]) for a, b in pairs if home[a] != home[b] and (cyclic or a in far)})
        paths = _paths(after, before, starts[:1], targets, MOST_PATHS, LONGEST)
        return [(v, home[v], size[home[v]] > 1, far.get(v), depth.get(v), len(front[v]), longest, paths) for v in blocks]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [measure(e, m) for e, m in zip(pdf["edges"], pdf["marks"], strict=True)]
            keys = pdf[on].loc[pdf.index.repeat([len(r) for r in rows])].reset_index(drop=True)
            values = pd.DataFrame([x for r in rows for x in r], columns=names).astype({"distance": "Int64", "depth": "Int64"})
            yield pd.concat([keys, values], axis=1)

    schema = f"{_kinds(links, on)}, block int, component int, in_loop boolean, distance long, depth long, frontier long, longest_path long, paths long"
    return _packed(links, marks, on).mapInPandas(run, schema)


def flow_metrics(blocks: DataFrame, edges: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows by function and rows by block of blocks(on, block, kind) and edges(on, src, dst, kind); blocks has all ends of edges.

    By function: blocks, edges (distinct), has_cycles, components (strong), longest_path (edges; from the entry, or over the
    condensation where there is a cycle), mean_distance from the entry, branching_mean, branching_max, linear_share,
    dominator_height, frontier_mean, frontier_max, loops, largest_loop, unreachable, loop_headers (targets of back edges),
    edges of each kind, paths (entry to exit). By block: in_degree, out_degree, is_branch, is_join, depth (in the dominator
    tree), frontier, distance, component, in_loop."""
    on = list(on)
    blocks, edges = settle(blocks.select(*on, F.col("block").cast("int").alias("block"), "kind")), settle(edges.select(*on, F.col("src").cast("int").alias("src"), F.col("dst").cast("int").alias("dst"), "kind"))
    links = settle(edges.select(*on, "src", "dst").distinct())
    out = links.groupBy(*on, F.col("src").alias("block")).agg(F.count("*").alias("out_degree"))
    into = links.groupBy(*on, F.col("dst").alias("block")).agg(F.count("*").alias("in_degree"))
    marks = blocks.select(*on, "block", (F.col("kind") == "entry").alias("is_start"), (F.col("kind") == "exit").alias("is_end"))
    measured = block_measures(links, marks, on)
    by_block = settle(
        measured.join(out, [*on, "block"], "left").join(into, [*on, "block"], "left").na.fill(0, ["out_degree", "in_degree"])
        .withColumns({"is_branch": F.col("out_degree") > 1, "is_join": F.col("in_degree") > 1})
    )
    one = by_block.groupBy(*on).agg(
        F.count("*").alias("blocks"), F.countDistinct("component").alias("components"), F.avg("distance").alias("mean_distance"),
        F.coalesce(F.avg(F.when(F.col("out_degree") > 0, F.col("out_degree"))), F.lit(0.0)).alias("branching_mean"), F.max("out_degree").alias("branching_max"),
        F.avg(F.when((F.col("out_degree") == 1) & (F.col("in_degree") == 1), 1.0).otherwise(0.0)).alias("linear_share"), F.max("depth").alias("dominator_height"),
        F.avg("frontier").alias("frontier_mean"), F.max("frontier").alias("frontier_max"), F.countDistinct(F.when(F.col("in_loop"), F.col("component"))).alias("loops"),
        F.count_if(F.col("distance").isNull()).alias("unreachable"), F.max("in_loop").alias("has_cycles"), F.max("longest_path").alias("longest_path"), F.max("paths").alias("paths"),
    )
    largest = by_block.where("in_loop").groupBy(*on, "component").agg(F.count("*").alias("n")).groupBy(*on).agg(F.max("n").alias("largest_loop"))
    kinds = edges.groupBy(*on).agg(
        F.countDistinct(F.when(F.col("kind") == "back", F.col("dst"))).alias("loop_headers"),
        *[F.count_if(F.col("kind") == k).alias(f"{k}_edges") for k in ("true", "false", "back", "exception", "fallthrough", "loop", "jump")],
    )
    by_function = one
    for more in (links.groupBy(*on).agg(F.count("*").alias("edges")), kinds, largest):
        by_function = by_function.join(more, on, "left")
    return by_function.na.fill(0), by_block
