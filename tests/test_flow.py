import random
from collections import Counter

from corvid.operators import flow
from corvid.sources import call_sites, python_flow

CODE = '''
import os, click, requests as rq
from fastapi import FastAPI
from dataclasses import dataclass
from pydantic import BaseModel
app = FastAPI()

@app.get("/x")
def handler(n):
    if n:
        return 1
    for i in n:
        if i:
            break
        rq.get(os.path.join("a", i))
    return 2

@click.command()
def cli():
    global STATE
    while True:
        print(1)

@dataclass
class A:
    x: int
    ys: list[int] = None

class B(BaseModel):
    z: "str | None"

class C:
    pass
'''


def test_flow(spark):
    files = spark.createDataFrame([("m.py", CODE), ("bad.py", "def ("), ("none.py", None)], "path string, text string")
    edges = {(r["src"], r["dst"], r["kind"]) for r in python_flow.flow_edges(files).where("qualname = 'handler'").collect()}
    assert {k for *_, k in edges} == {"true", "false", "fallthrough", "loop", "back", "jump"}
    stats = {r["qualname"]: (r["blocks"], r["loops"]) for r in python_flow.flow_stats(files).collect()}
    assert stats["cli"] == (6, 1) and stats["handler"][1] == 1
    got = {(r["qualname"], r["effect"], r["target"]) for r in call_sites.effects(call_sites.facts(files)).collect()}
    assert got == {("handler", "io", "app.get"), ("handler", "io", "rq.get"), ("cli", "io", "print"), ("cli", "global", "STATE")}
    rows = {(r["qualname"], r["framework"], r["method"], r["route"]) for r in python_flow.entrypoints(files).collect()}
    assert rows == {("handler", "fastapi", "GET", "/x"), ("cli", "click", None, "cli")}
    models = {(r["qualname"], r["kind"], r["field"], r["is_required"], r["is_many"]) for r in python_flow.data_models(files).collect()}
    assert models == {("A", "dataclass", "x", True, False), ("A", "dataclass", "ys", False, True), ("B", "pydantic", "z", False, False)}


FLOW = '''
def f(a, n):
    x = a
    for x in x:
        if x:
            y = x
        else:
            continue
        x = x + y
    while n:
        try:
            n = g(x)
        except E:
            return y
    else:
        y = 0
    if n:
        return x
    else:
        raise y
    return x + y

def g(): pass
'''


def test_blocks_edges_and_data_flow_of_a_function(spark):
    """Blocks by hand: 0 entry; 1 x = a; 2 head of for; 3 its exit; 4 its body; 5 if; 6 else; 7 join; 8 head of while; 9 its exit;
    10 its body, which ends in the handler's return; 11 else of while; 12 if; 13 else; 14 join that nothing leads to; 15 exit."""
    files = spark.createDataFrame([("m.py", FLOW)], "path string, text string")
    blocks = {r["block"]: r for r in python_flow.blocks(files).where("qualname = 'f'").collect()}
    kinds = [blocks[k]["kind"] for k in sorted(blocks)]
    assert kinds == ["entry", "body", "loop_head", "loop_exit", "body", "body", "body", "body", "loop_head", "loop_exit", "body", "body", "body", "body", "body", "exit"]
    got = {(r["src"], r["dst"], r["kind"]) for r in python_flow.flow_edges(files).where("qualname = 'f'").collect()}
    assert got == {
        (0, 1, "fallthrough"), (1, 2, "fallthrough"), (2, 4, "loop"), (4, 5, "true"), (4, 6, "false"), (6, 2, "jump"), (5, 7, "fallthrough"), (7, 2, "back"), (2, 3, "false"),
        (3, 8, "fallthrough"), (8, 10, "loop"), (8, 11, "false"), (11, 9, "fallthrough"), (9, 12, "true"), (9, 13, "false"),
    }
    flow = {(r["src_block"], r["dst_block"], r["symbol"], r["kind"], r["via_phi"], r["uses"]) for r in python_flow.data_flow(files).where("qualname = 'f'").collect()}
    # x of the for head is written by it before its iterable is read
    assert flow == {
        (2, 2, "x", "intra-block", False, 1), (2, 4, "x", "data-flow", False, 1), (2, 5, "x", "data-flow", False, 1), (2, 7, "x", "data-flow", False, 1), (5, 7, "y", "data-flow", False, 1),
        (2, 10, "x", "data-flow", False, 1), (2, 12, "x", "data-flow", False, 1), (11, 13, "y", "data-flow", False, 1), (5, 10, "y", "data-flow", False, 1),
    }


def _random_flow(rng, fn):
    n = rng.randint(3, 9)
    edges = sorted({(rng.randrange(n), rng.randrange(1, n)) for _ in range(rng.randint(2, 2 * n))} | {(0, 1)})
    symbols = [(fn, rng.randrange(n), rng.randrange(3), rng.choice("xyz"), rng.random() < 0.4) for _ in range(3 * n)]
    return n, edges, symbols


def _reaches(edges, symbols, fn, symbol, source, target):
    """Whether some walk leads from source to target without a definition of the symbol on the way."""
    blocked = {b for f, b, _, s, d in symbols if f == fn and s == symbol and d}
    seen, todo = set(), [source]
    while todo:
        v = todo.pop()
        for a, b in edges:
            if a == v and b not in seen:
                seen.add(b)
                if b not in blocked:
                    todo.append(b)
    return target in seen


def test_data_flow_against_walks(spark):
    rng, edges, symbols, graphs = random.Random(8), [], [], {}
    for fn in range(30):
        n, own, names = _random_flow(rng, fn)
        graphs[fn] = own
        edges += [(fn, a, b) for a, b in own]
        symbols += names
    want = Counter()
    for fn, b, place, s, d in symbols:
        if d:
            continue
        if any(f == fn and c == b and t == s and w and p < place for f, c, p, t, w in symbols):
            want[fn, b, b, s, "intra-block"] += 1
        else:
            for c in {c for f, c, _, t, w in symbols if f == fn and t == s and w}:
                if _reaches(graphs[fn], symbols, fn, s, c, b):
                    want[fn, c, b, s, "data-flow"] += 1
    got = flow.data_flow(spark.createDataFrame(edges, "fn int, src int, dst int"), spark.createDataFrame(symbols, "fn int, block int, place int, symbol string, is_def boolean"), ["fn"]).collect()
    assert {(r["fn"], r["src_block"], r["dst_block"], r["symbol"], r["kind"]): r["uses"] for r in got} == want
    several = Counter((k[0], k[2], k[3]) for k in want if k[4] == "data-flow")
    assert all(r["via_phi"] == (r["kind"] == "data-flow" and several[r["fn"], r["dst_block"], r["symbol"]] > 1) for r in got)


def _simple_paths(edges, v, end, seen):
    return 1 if v == end else sum(_simple_paths(edges, w, end, seen | {w}) for a, w in edges if a == v and w not in seen)


def test_metrics_of_random_functions(spark):
    rng, blocks, edges, graphs = random.Random(9), [], [], {}
    for fn in range(25):
        n, own, _ = _random_flow(rng, fn)
        graphs[fn] = n, own
        blocks += [(fn, b, "entry" if b == 0 else "exit" if b == n - 1 else "body") for b in range(n)]
        edges += [(fn, a, b, rng.choice(["true", "back", "loop"])) for a, b in own] * 2
    rows, by_block = flow.flow_metrics(spark.createDataFrame(blocks, "fn int, block int, kind string"), spark.createDataFrame(edges, "fn int, src int, dst int, kind string"), ["fn"])
    per = {(r["fn"], r["block"]): r for r in by_block.collect()}
    for r in rows.collect():
        n, own = graphs[r["fn"]]
        reach = {v: {w for w in range(n) if _walk(own, v, w)} for v in range(n)}
        loops = {frozenset(w for w in range(n) if w == v or (w in reach[v] and v in reach[w])) for v in range(n)}
        cycles = [c for c in loops if len(c) > 1]
        assert (r["blocks"], r["edges"], r["components"], r["loops"], r["largest_loop"]) == (n, len(own), len(loops), len(cycles), max(map(len, cycles), default=0))
        assert r["has_cycles"] == bool(cycles) and r["unreachable"] == n - len(reach[0] | {0})
        assert r["paths"] == _simple_paths(own, 0, n - 1, {0})
        assert r["loop_headers"] == len({b for f, _, b, k in edges if f == r["fn"] and k == "back"})
        home = {v: c for c in loops for v in c}
        steps = {(home[a], home[b]) for a, b in own if home[a] != home[b] and (cycles or a in reach[0] | {0})}

        def longest(c, steps=steps):
            return max((1 + longest(b) for a, b in steps if a == c), default=0)

        assert r["longest_path"] == max((longest(c) for c in loops), default=0)
        # w dominates v if v can't be reached without it
        ok = lambda v, w: v == w or not _walk([e for e in own if w not in e], 0, v) or w == 0
        met = sorted(reach[0] | {0})
        doms = {v: {w for w in met if ok(v, w) and (v != 0 or w == 0)} for v in met}
        for v in met:
            assert per[r["fn"], v]["depth"] == len(doms[v]) - 1
            front = {t for s, t in own if s in met and v in doms[s] and not (v in doms[t] and v != t) and t != 0}
            assert per[r["fn"], v]["frontier"] == len(front)
        assert per[r["fn"], 0]["distance"] == 0 and r["mean_distance"] > 0


def _walk(edges, v, w):
    seen, todo = set(), [v]
    while todo:
        x = todo.pop()
        for a, b in edges:
            if a == x and b not in seen:
                seen.add(b)
                todo.append(b)
    return w in seen


def test_path_counts_end_at_their_bounds(spark):
    ladder = [(0, 3 * k, 3 * k + d) for k in range(15) for d in (1, 2)] + [(0, 3 * k + d, 3 * k + 3) for k in range(15) for d in (1, 2)]
    line = [(1, k, k + 1) for k in range(60)]
    ends = spark.createDataFrame([(0, 0, True, False), (0, 45, False, True), (1, 0, True, False), (1, 60, False, True), (2, 5, True, True)], "fn int, block int, is_start boolean, is_end boolean")
    got = flow.simple_path_counts(spark.createDataFrame(ladder + line, "fn int, src int, dst int"), ends, ["fn"])
    assert {r["fn"]: r["paths"] for r in got.collect()} == {0: 1000, 1: 0, 2: 0}
