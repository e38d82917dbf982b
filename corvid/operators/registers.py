"""Sizes of all neighbourhoods of a graph by slices of their HyperLogLog registers. Registers at different places never meet in a union, so a
task takes some of them for all nodes through all rounds: no sketch travels, and nothing of a round is written."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators.graph import nodes_of
from corvid.operators.ranges import numbered
from corvid.session import settle

#: Every task holds the graph, at four bytes for each edge and twenty for each node; larger graphs go by `measures.neighbourhoods`.
MOST_EDGES, MOST_NODES = 1 << 26, 1 << 23
#: Tasks at most, and bytes of registers that one works on at once.
TASKS, SLICE_BYTES = 32, 1 << 27
#: Edges in a row that is sent, places in a row of results, rows of registers united at once, edges of a node that is united alone.
PACKED, PLACES, ROWS, HUB = 1024, 1 << 16, 8192, 1024
#: Nodes whose small sets are listed at once.
SOURCES = 4096

POWERS = 0.5 ** np.arange(65)


def most_listed(lg: int) -> int:
    """Sets of so many members at most are listed and counted, as `Sketches` counts their coupons."""
    return 7 if lg < 8 else 3 * (1 << lg >> 3) >> 2


class _Graph:
    """The edges to each node, from sorted keys near << 32 | far."""

    def __init__(self, keys: np.ndarray, n: int) -> None:
        self.n, self.far, self.count = n, np.empty(len(keys), np.int32), np.zeros(n, np.int64)
        for k in range(0, len(keys), 1 << 22):
            part = keys[k : k + (1 << 22)]
            self.far[k : k + len(part)] = part & 0xFFFFFFFF
            low, high = int(part[0] >> 32), int(part[-1] >> 32)
            self.count[low : high + 1] += np.bincount((part >> 32) - low, minlength=high - low + 1)
        self.first = np.cumsum(self.count) - self.count
        self.whole = self._ordered(np.flatnonzero(self.count), self.first, self.count)

    def _ordered(self, rows: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = rows[np.argsort(-count[rows], kind="stable")]
        return rows, first[rows], count[rows]

    def from_(self, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nodes with edges from the moved ones, by descending number of them, where those begin in a list, their numbers, the list."""
        if len(moved) * 4 > self.n:
            return *self.whole, self.far
        held = np.zeros(self.n, bool)
        held[moved] = True
        picks = np.flatnonzero(held[self.far])
        near = np.searchsorted(self.first + self.count, picks, "right")
        rows, first, count = np.unique(near, return_index=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        return rows[order], first[order], count[order], self.far[picks]


def _united(state: np.ndarray, rows: np.ndarray, first: np.ndarray, count: np.ndarray, far: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows that grow, and what they become. Rows come by descending count, so that those with a j-th edge are the first ones."""
    hubs = int(np.searchsorted(-count, -HUB, "left"))
    for r, f, k in zip(rows[:hubs], first[:hubs], count[:hubs], strict=True):
        new = state[r]
        for i in range(f, f + k, ROWS):
            new = np.maximum(new, state.take(far[i : min(i + ROWS, f + k)], axis=0).max(axis=0))
        if (new != state[r]).any():
            yield np.array([r]), new[None, :]
    for i in range(hubs, len(rows), ROWS):
        r, f, k = rows[i : i + ROWS], first[i : i + ROWS], count[i : i + ROWS]
        old = state.take(r, axis=0)
        new = old.copy()
        for j, m in enumerate(np.searchsorted(-k, -np.arange(k[0]), "left").tolist()):
            np.maximum(new[:m], state.take(far[f[:m] + j], axis=0), out=new[:m])
        grew = (new != old).any(axis=1)
        yield r[grew], new[grew]


def _slice(graph: _Graph, place: np.ndarray, register: np.ndarray, value: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """level, places, and by how much their sums of 2^-register and numbers of zeros have changed in the round, for `width` registers."""
    state = np.zeros((graph.n, width), np.uint8)
    state[place, register] = value
    sums, zeros = np.full(graph.n, float(width)), np.full(graph.n, width)
    moved, level = place, 0
    found = [(place, state[place])]
    while len(moved):
        for rows, new in found:
            state[rows] = new
            s, z = POWERS[new].sum(axis=1), (new == 0).sum(axis=1)
            yield level, rows, s - sums[rows], z - zeros[rows]
            sums[rows], zeros[rows] = s, z
        level += 1
        found = list(_united(state, *graph.from_(moved)))
        moved = np.concatenate([r for r, _ in found] or [place[:0]])


def _inside(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return held[np.minimum(np.searchsorted(held, keys), len(held) - 1)] == keys


def _listed(graph: _Graph, sources: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """level, places, sizes, places whose sets have more than `most` members from this round on. A round looks at a source's edges some at
    a time and stops once they lead beyond that; a node of more edges than that does so alone."""
    n, level = graph.n, 0
    held = front = np.arange(len(sources)) * n + sources
    size, over = np.ones(len(sources), np.int64), np.zeros(len(sources), bool)
    while len(front):
        level += 1
        s, v = np.divmod(front, n)
        k, was, before = graph.count[v], size.copy(), over.copy()
        over[s[k > most]] = True
        begun = np.cumsum(k) - k
        piece = (begun - begun[np.searchsorted(s, s)]) // (2 * most)
        fresh = []
        for p in range(int(piece.max()) + 1):
            pick = (piece == p) & ~over[s]
            kept = k[pick]
            at = np.arange(kept.sum()) + np.repeat(graph.first[v[pick]] - (np.cumsum(kept) - kept), kept)
            keys = np.unique(np.repeat(s[pick], kept) * n + graph.far[at])
            keys = keys[~_inside(held, keys)]
            if len(keys):
                held = np.sort(np.concatenate([held, keys]), kind="stable")
                size += np.bincount(keys // n, minlength=len(size))
                over |= size > most
                fresh.append(keys)
        left, beyond = (size > was) & ~over, over & ~before
        yield level, sources[left], size[left], sources[beyond]
        held = held[~over[held // n]]
        front = np.sort(np.concatenate(fresh or [front[:0]]))
        front = front[~over[front // n]]


def _work(lg: int, n: int, m: int, tasks: int, width: int):
    """Rows of chunk, level, kind, places and values: what a task's registers (kind 0) and its share of listed sets (1: sizes, 2: no longer
    listed) have changed."""

    def rows(level: int, kind: int, places: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple]:
        cuts = np.flatnonzero(np.diff(places // PLACES)) + 1
        for x, y in zip([0, *cuts], [*cuts, len(places)], strict=True):
            if y > x:
                yield int(places[x]) // PLACES, level, kind, places[x:y].astype("<i4").tobytes(), a[x:y].astype("<f8").tobytes(), b[x:y].astype("<i4").tobytes()

    def batch(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], ["chunk", "level", "kind", "places", "a", "b"])

    def found(graph: _Graph, nodes: np.ndarray, task: int) -> Iterator[tuple]:
        sums, zeros = defaultdict(lambda: np.zeros(n)), defaultdict(lambda: np.zeros(n, np.int32))
        place, register, value = nodes >> 32, nodes >> 8 & 0xFFFFFF, nodes & 0xFF
        for low in range(task * width, 1 << lg, tasks * width):
            here = (register >= low) & (register < low + width)
            for level, at, s, z in _slice(graph, place[here], register[here] - low, value[here], width):
                if level < 64:  # the levels of most graphs are added up, those of long paths have few nodes each
                    sums[level][at] += s
                    zeros[level][at] += z.astype(np.int32)
                else:
                    order = np.argsort(at)
                    yield from rows(level, 0, at[order], s[order], z[order])
        for level, s in sums.items():
            at = np.flatnonzero(s)
            yield from rows(level, 0, at, s[at], zeros[level][at])
        sums.clear(), zeros.clear()
        most, own = most_listed(lg), np.arange(task, n, tasks)
        for k in range(0, len(own), SOURCES):
            for level, at, size, beyond in _listed(graph, own[k : k + SOURCES], most):
                yield from rows(level, 1, at, size, size)
                yield from rows(level, 2, beyond, beyond, beyond)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, filled, task = np.empty(m, np.int64), [], 0, None
        for part in batches:
            task = part.column("task")[0].as_py() if len(part) else task
            links = part.column("links").flatten().to_numpy()
            keys[filled : filled + len(links)] = links
            filled += len(links)
            nodes.append(part.column("nodes").flatten().to_numpy().copy())
        if task is None:
            return
        keys.sort()
        graph = _Graph(keys, n)
        del keys
        held: list[tuple] = []
        for row in found(graph, np.concatenate(nodes), task):
            held.append(row)
            if sum(len(r[3]) for r in held[-64:]) > 1 << 22 or len(held) >= 1024:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    return run


def estimate(sums: np.ndarray, zeros: np.ndarray, registers: int) -> np.ndarray:
    """Members of the sets, from the sums of 2^-register and the numbers of registers without any (Ertl's improved raw estimator)."""
    x = zeros / registers
    sigma, y = x.copy(), 1.0
    for _ in range(64):
        x = x * x
        sigma += x * y
        y += y
    return registers * registers / (2 * np.log(2)) / (sums - zeros + registers * sigma)


def _sizes(lg: int, n: int):
    """What `measures.neighbourhoods` gives of each node, by place, from the rows of a chunk of places."""
    registers, most = 1 << lg, most_listed(lg)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict = defaultdict(lambda: defaultdict(list))
        for part in batches:
            for chunk, level, *row in zip(*(part.column(c).to_pylist() for c in ("chunk", "level", "kind", "places", "a", "b")), strict=True):
                chunks[chunk][level].append(row)
        for chunk, levels in chunks.items():
            low = chunk * PLACES
            width = min(PLACES, n - low)
            sums, zeros, listed, over = np.full(width, float(registers)), np.full(width, registers), np.ones(width), np.zeros(width, bool)
            size, distance, harmonic, last = np.ones(width), np.zeros(width), np.zeros(width), np.zeros(width, np.int32)
            for level in sorted(levels):
                hit = np.zeros(width, bool)
                for kind, places, a, b in levels.pop(level):
                    at = np.frombuffer(places, "<i4") - low
                    hit[at] = True
                    if kind == 0:
                        sums[at] += np.frombuffer(a, "<f8")
                        zeros[at] += np.frombuffer(b, "<i4")
                    elif kind == 1:
                        listed[at] = np.frombuffer(a, "<f8")
                    else:
                        over[at] = True
                if level:
                    at = np.flatnonzero(hit)
                    now = np.where(over[at], np.maximum(np.rint(estimate(sums[at], zeros[at], registers)), most + 1), listed[at])
                    more = np.maximum(now - size[at], 0)
                    size[at] += more
                    distance[at] += level * more
                    harmonic[at] += more / level
                    last[at[more > 0]] = level
            columns = {"place": np.arange(low, low + width, dtype=np.int32), "reached": size - 1, "distance_sum": distance, "harmonic": harmonic, "last": last}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    return run


def sliced_neighbourhoods(edges: DataFrame, lg: int, inbound: bool = True) -> DataFrame | None:
    """The columns of `measures.neighbourhoods`; none for graphs beyond MOST_EDGES or MOST_NODES.

    Each task receives the graph once and takes its registers of all nodes through all rounds, then lists the sets of its share of
    nodes as far as these are counted exactly. What leaves it are changes of sums by node and round, which the tasks of the
    next step add up for their nodes."""
    spark = edges.sparkSession
    far, near = ("src", "dst") if inbound else ("dst", "src")
    links = settle(edges.where("src is not null and dst is not null and src <> dst").select(F.col(far).alias("far"), F.col(near).alias("near")).distinct())
    nodes = nodes_of(edges).where("node is not null")
    m = links.count()
    if m > MOST_EDGES:
        return None
    placed, n = numbered(nodes, ["node"])
    if n > MOST_NODES:
        return None
    homes = settle(placed.select("node", F.col("__place").alias("place")))
    ends = [homes.select(F.col("node").alias(c), F.col("place").alias(f"p{c}")) for c in ("near", "far")]
    key = F.shiftleft("pnear", 32) + F.col("pfar")
    packed = links.join(ends[0], "near").join(ends[1], "far").select(key.alias("x")).groupBy(F.pmod(F.xxhash64("x"), F.lit(-(-m // PACKED) or 1))).agg(F.collect_list("x").alias("links"))
    hashed, rest = F.xxhash64("node"), F.shiftrightunsigned(F.xxhash64("node"), lg)
    value = 65 - lg - F.length(F.bin(rest))
    start = F.shiftleft("place", 32) + F.shiftleft(hashed.bitwiseAND(F.lit((1 << lg) - 1)), 8) + value
    begun = homes.select(start.cast("long").alias("x"), F.floor(F.col("place") / PACKED).alias("k")).groupBy("k").agg(F.collect_list("x").alias("nodes"))
    none = F.array().cast("array<bigint>")
    tasks = max(1, min(TASKS, spark.sparkContext.defaultParallelism))
    room = min(SLICE_BYTES // max(n, 1), (1 << lg) // (4 * tasks))
    width = 1 << max(min(lg, 4), room.bit_length() - 1)
    sent = settle(packed.select("links", none.alias("nodes")).unionByName(begun.select(none.alias("links"), "nodes")))
    dealt = sent.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), "links", "nodes").repartitionById(tasks, "task")
    changes = dealt.mapInArrow(_work(lg, n, m, tasks, width), "chunk int, level int, kind int, places binary, a binary, b binary")
    sizes = changes.repartitionById(max(1, -(-n // PLACES)), "chunk").mapInArrow(_sizes(lg, n), "place int, reached double, distance_sum double, harmonic double, last int")
    return settle(homes.join(sizes, "place").drop("place"))
