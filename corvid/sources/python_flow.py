"""Control flow, entry points and data models of Python files, as rows; one parse each, in mapInPandas."""

from __future__ import annotations

import ast
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import flow
from corvid.session import settle
from corvid.sources.python_ast import _FUNCTION, _dotted, _walk, parse_rows
from corvid.sources.texts import distinct_texts, to_files

BLOCKS = "path string, qualname string, block int, kind string, label string, start_line int, end_line int, statements int, in_degree int, out_degree int"
EDGES = "path string, qualname string, src int, dst int, kind string"
SYMBOLS = "path string, qualname string, block int, place int, symbol string, is_def boolean"
ENTRYPOINTS = "path string, qualname string, framework string, kind string, method string, route string, line int"
MODELS = "path string, qualname string, kind string, field string, type string, is_required boolean, is_many boolean"

# Verbs of web frameworks, bases of data models and types of many values.
VERBS = ("get", "post", "put", "delete", "patch", "head", "options")
MODEL_BASES = {"BaseModel": "pydantic", "TypedDict": "typed_dict", "Protocol": "protocol", "Model": "django", "Base": "orm", "DeclarativeBase": "orm"}
MANY = ("list", "set", "tuple", "sequence", "iterable", "frozenset")


class _Flow:
    """Blocks and edges of one function: an entry, blocks of statements that run in a row, an exit. Conditions, targets and iterables
    belong to the block that control branches from. Returns and raises end a block without an edge; try, handlers, else and
    finally run in a row; a with statement is a statement like any other."""

    def __init__(self, node: ast.FunctionDef | ast.AsyncFunctionDef):
        self.kinds: list[tuple[str, str]] = []
        self.blocks: list[list[ast.AST]] = []
        self.lines: list[list[int]] = []
        self.edges: list[tuple[int, int, str]] = []
        self.loops: list[tuple[int, int]] = []
        first = self.block("entry"), self.block("body")
        self.lines[0] = [node.lineno, node.lineno]
        self.link(*first, "fallthrough")
        last = self.run(node.body, first[1])
        end = self.block("exit")
        self.lines[end] = [node.end_lineno, node.end_lineno]
        self.link(last, end, "fallthrough")

    def block(self, kind: str, label: str = "") -> int:
        n = len(self.blocks)
        self.kinds.append((kind, label or f"{kind}:{n}"))
        self.blocks.append([])
        self.lines.append([])
        return n

    def link(self, src: int | None, dst: int, kind: str) -> None:
        if src is not None:
            self.edges.append((src, dst, kind))

    def reach(self, now: int, node: ast.AST) -> None:
        """The lines of a block run from its first statement to the last one met in it."""
        self.lines[now] = [self.lines[now][0] if self.lines[now] else node.lineno, node.end_lineno]

    def run(self, body: list[ast.stmt], now: int | None) -> int | None:
        """The block where control goes on behind the statements; None if it never does."""
        for s in body:
            now = self.block("body") if now is None else now  # code that nothing leads to
            self.reach(now, s)
            if isinstance(s, ast.If):
                now = self.branch(s, now)
            elif isinstance(s, (ast.For, ast.AsyncFor, ast.While)):
                now = self.loop(s, now)
            elif isinstance(s, ast.Try):
                for part in (s.body, *(h.body for h in s.handlers), s.orelse, s.finalbody):
                    now = self.run(part, now)
            else:
                self.blocks[now].append(s)
                if isinstance(s, (ast.Break, ast.Continue)) and self.loops:
                    self.link(now, self.loops[-1][isinstance(s, ast.Break)], "jump")
                now = None if isinstance(s, (ast.Return, ast.Raise, ast.Break, ast.Continue)) else now
        return now

    def branch(self, s: ast.If, now: int) -> int:
        self.blocks[now].append(s.test)
        ends = []
        for part, kind in ((s.body, "true"), (s.orelse, "false")):
            if part:
                first = self.block("body", f"if_{kind}")
                self.link(now, first, kind)
                ends.append((self.run(part, first), "fallthrough"))
            else:
                ends.append((now, kind))
        join = self.block("body", "if_join")
        for end, kind in ends:
            self.link(end, join, kind)
        return join

    def loop(self, s: ast.For | ast.AsyncFor | ast.While, now: int) -> int:
        head, after = self.block("loop_head"), self.block("loop_exit")
        self.link(now, head, "fallthrough")
        self.blocks[head] += [s.test] if isinstance(s, ast.While) else [s.target, s.iter]
        self.loops.append((head, after))
        body = self.block("body", "loop_body")
        self.link(head, body, "loop")
        self.link(self.run(s.body, body), head, "back")
        if s.orelse:
            other = self.block("body", "loop_else")
            self.link(head, other, "false")
            self.link(self.run(s.orelse, other), after, "fallthrough")
        else:
            self.link(head, after, "false")
        self.loops.pop()
        return after


def _flows(tree: ast.AST):
    for node, name, *_ in _walk(tree):
        if isinstance(node, _FUNCTION):
            yield node, name, _Flow(node)


def _block_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    out = []
    for _, name, g in _flows(tree):
        into, out_of = Counter(e[1] for e in g.edges), Counter(e[0] for e in g.edges)
        for i, b in enumerate(g.blocks):
            start, end = g.lines[i] or (None, None)
            out.append((path, name, i, *g.kinds[i], start, end, len(b), into[i], out_of[i]))
    return out


def _edge_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    return [(path, name, *e) for _, name, g in _flows(tree) for e in g.edges]


def _symbol_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    """Names that statements write (parameters of inner functions included) and read."""
    out = []
    for _, name, g in _flows(tree):
        for i, b in enumerate(g.blocks):
            for place, s in enumerate(b):
                for n in ast.walk(s):
                    if isinstance(n, ast.arg):
                        out.append((path, name, i, place, n.arg, True))
                    elif isinstance(n, ast.Name) and not isinstance(n.ctx, ast.Del):
                        out.append((path, name, i, place, n.id, isinstance(n.ctx, ast.Store)))
    return out


def _aliases(tree: ast.AST) -> dict[str, str]:
    found = {}
    for n in ast.walk(tree):
        if isinstance(n, ast.Import):
            found |= {(a.asname or a.name.split(".")[0]): (a.name if a.asname else a.name.split(".")[0]) for a in n.names}
        elif isinstance(n, ast.ImportFrom) and n.module:
            found |= {(a.asname or a.name): f"{n.module}.{a.name}" for a in n.names}
    return found


def _literal(call: ast.Call, at: int, keyword: str) -> str | None:
    node = next((k.value for k in call.keywords if k.arg == keyword), call.args[at] if len(call.args) > at else None)
    return str(node.value) if isinstance(node, ast.Constant) else None


def _entry_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    names, makers = _aliases(tree), {}
    for n in ast.walk(tree):  # what the variables that decorate were made of
        if isinstance(n, ast.Assign) and isinstance(n.value, ast.Call) and (made := _dotted(n.value.func)):
            makers |= {t.id: made.rpartition(".")[2] for t in n.targets if isinstance(t, ast.Name)}
    out = []
    for node, name, *_ in _walk(tree):
        if not isinstance(node, _FUNCTION):
            continue
        for d in node.decorator_list:
            call = d if isinstance(d, ast.Call) else ast.Call(func=d, args=[], keywords=[])
            dotted = _dotted(call.func) or ""
            base, _, verb = dotted.rpartition(".")
            maker, library = makers.get(base, ""), names.get(base.split(".")[0] if base else verb, "")
            row = None
            if verb in VERBS and maker in ("FastAPI", "APIRouter"):
                row = ("fastapi", "route", verb.upper(), _literal(call, 0, "path"))
            elif verb == "on_event" and maker == "FastAPI":
                row = ("fastapi", "event", None, _literal(call, 0, "event_type"))
            elif verb == "route" and (maker in ("Flask", "Blueprint") or library == "flask"):
                methods = next((k.value for k in call.keywords if k.arg == "methods"), None)
                first = methods.elts[0].value if isinstance(methods, (ast.List, ast.Tuple)) and methods.elts and isinstance(methods.elts[0], ast.Constant) else "GET"
                row = ("flask", "route", first, _literal(call, 0, "rule"))
            elif verb in ("command", "group") and (library.startswith("click") or maker in ("Group", "Typer") or library.startswith("typer")):
                row = ("typer" if maker == "Typer" or library.startswith("typer") else "click", "command", None, _literal(call, 0, "name") or node.name)
            elif verb in ("scheduled_job", "cron", "interval"):
                row = ("schedule", "cron", verb, _literal(call, 0, "trigger"))
            elif verb in ("shared_task", "task") and (maker == "Celery" or library.startswith("celery")):
                row = ("celery", "task", None, _literal(call, 9, "name") or node.name)
            elif verb in ("dag", "task") and library.startswith("airflow"):
                row = ("airflow", verb, None, _literal(call, 9, f"{verb}_id") or node.name)
            elif verb in ("route", "add_route", "add_url_rule"):
                row = ("generic", "route", None, _literal(call, 0, "path"))
            if row:
                out.append((path, name, *row, node.lineno))
    return out


def _model_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    out = []
    for node, name, *_ in _walk(tree):
        if not isinstance(node, ast.ClassDef):
            continue
        bases = [(_dotted(b) or "").rpartition(".")[2] for b in node.bases]
        decorated = any("dataclass" in ast.unparse(d) for d in node.decorator_list)
        kind = "dataclass" if decorated else next((MODEL_BASES[b] for b in bases if b in MODEL_BASES), "generic_class")
        fields = [s for s in node.body if isinstance(s, ast.AnnAssign) and isinstance(s.target, ast.Name)]
        for s in fields:
            type_ = ast.unparse(s.annotation)
            out.append((path, name, kind, s.target.id, type_, s.value is None and "Optional" not in type_ and "None" not in type_, any(m in type_.lower() for m in MANY)))
        if not fields and kind != "generic_class":
            out.append((path, name, kind, None, None, None, None))
    return out


def blocks(files: DataFrame) -> DataFrame:
    return parse_rows(files, _block_rows, BLOCKS)


def flow_edges(files: DataFrame) -> DataFrame:
    return parse_rows(files, _edge_rows, EDGES)


def flow_symbols(files: DataFrame) -> DataFrame:
    return parse_rows(files, _symbol_rows, SYMBOLS)


def data_flow(files: DataFrame) -> DataFrame:
    """path, qualname, src_block, dst_block, symbol, kind, via_phi, uses of all functions."""
    texts = settle(distinct_texts(files))
    return to_files(files, settle(flow.data_flow(flow_edges(texts), flow_symbols(texts), ["path", "qualname"])))


def flow_metrics(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    texts = settle(distinct_texts(files))
    by_function, by_block = flow.flow_metrics(blocks(texts), flow_edges(texts), ["path", "qualname"])
    return to_files(files, settle(by_function)), to_files(files, by_block)


def flow_stats(files: DataFrame) -> DataFrame:
    """path, qualname, blocks, edges, branches (blocks with two ways on or more), loops, linear blocks' share."""
    b, loops = blocks(files), flow_edges(files).where("kind = 'loop'").groupBy("path", "qualname").agg(F.count("*").alias("loops"))
    stats = b.groupBy("path", "qualname").agg(
        F.count("*").alias("blocks"), F.sum("out_degree").alias("edges"), F.count_if(F.col("out_degree") >= 2).alias("branches"),
        F.avg(F.when((F.col("out_degree") == 1) & (F.col("in_degree") == 1), 1.0).otherwise(0.0)).alias("linear_share"),
    )
    return stats.join(loops, ["path", "qualname"], "left").na.fill(0, ["loops"])


def entrypoints(files: DataFrame) -> DataFrame:
    return parse_rows(files, _entry_rows, ENTRYPOINTS)


def data_models(files: DataFrame) -> DataFrame:
    return parse_rows(files, _model_rows, MODELS)
