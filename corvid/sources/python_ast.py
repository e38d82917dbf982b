"""Facts of Python source files as rows: one parse for each file, in mapInPandas over (path, text) tables."""

from __future__ import annotations

import ast
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.ids import module_name
from corvid.sources.texts import by_text

FUNCTIONS = (
    "path string, qualname string, kind string, start_line int, end_line int, n_params int, n_annotated int, returns_annotated boolean, is_async boolean, "
    "complexity int, loc int, logical_loc int, max_depth int, n_returns int, n_raises int, n_yields int, decorators array<string>, has_docstring boolean"
)
CALLS = "path string, caller string, callee string, line int, col int, is_method boolean"
IMPORTS = "path string, module string, name string, alias string, level int, line int"
NODES = "path string, node_type string, qualname string, parent string, line int, end_line int, depth int"
CONFIG = "path string, format string, key string, value string"

_BRANCHES = (ast.If, ast.For, ast.While, ast.Try, ast.With, ast.IfExp)
_FUNCTION = (ast.FunctionDef, ast.AsyncFunctionDef)


def read_files(spark: SparkSession, root: str, glob: str = "*.py") -> DataFrame:
    """path (below root) and text of the files below a folder."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    below = F.regexp_replace("path", "^.*?" + re.escape(root.rstrip("/").split("://")[-1]) + "/", "")
    return raw.select(below.alias("path"), F.decode("content", F.lit("UTF-8")).alias("text"))


def _walk(tree: ast.AST) -> Iterator[tuple[ast.AST, str, str, int]]:
    """Definitions with their qualified name, that of the parent and the depth, in source order."""
    stack = [(tree, "", 0)]
    while stack:
        node, scope, depth = stack.pop()
        for child in reversed(list(ast.iter_child_nodes(node))):
            if isinstance(child, (*_FUNCTION, ast.ClassDef)):
                stack.append((child, f"{scope}.{child.name}" if scope else child.name, depth + 1))
            else:
                stack.append((child, scope, depth + 1))
        if isinstance(node, (*_FUNCTION, ast.ClassDef)):
            yield node, scope, scope.rpartition(".")[0], depth


def _complexity(node: ast.AST) -> int:
    """1, one for each branch, and one less than the operands of each boolean operation; nested functions count."""
    found = list(ast.walk(node))
    return 1 + sum(isinstance(n, _BRANCHES) for n in found) + sum(len(n.values) - 1 for n in found if isinstance(n, ast.BoolOp))


def _own(node: ast.AST) -> Iterator[ast.AST]:
    """What a function holds, without what lies in functions, lambdas and classes inside it."""
    stack = list(ast.iter_child_nodes(node))
    while stack:
        n = stack.pop()
        yield n
        if not isinstance(n, (*_FUNCTION, ast.Lambda, ast.ClassDef)):
            stack += ast.iter_child_nodes(n)


def _depth(node: ast.AST) -> int:
    most, stack = 0, [(node, 0)]
    while stack:
        n, d = stack.pop()
        most = max(most, d)
        stack += [(c, d + isinstance(c, (ast.If, ast.For, ast.While, ast.Try, ast.With))) for c in ast.iter_child_nodes(n)]
    return most


def _mapped(rows_of, columns: str):
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                try:
                    tree = ast.parse(text or "")
                except (SyntaxError, ValueError):  # a file that is no Python has no rows
                    continue
                rows += rows_of(path, tree, text or "")
            yield pd.DataFrame(rows, columns=names)

    return run


def parse_rows(files: DataFrame, rows_of, columns: str) -> DataFrame:
    """The rows of all files; each distinct text is parsed once."""
    return by_text(files, lambda texts: texts.mapInPandas(_mapped(rows_of, columns), columns))


def _function_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    lines, out = text.split("\n"), []
    for node, name, parent, _ in _walk(tree):
        if not isinstance(node, _FUNCTION):
            continue
        args = [a for a in (*node.args.posonlyargs, *node.args.args, *node.args.kwonlyargs, node.args.vararg, node.args.kwarg) if a is not None and a.arg not in ("self", "cls")]
        body = lines[node.lineno - 1 : node.end_lineno]
        inner = list(_own(node))
        out.append(
            (path, name, "method" if parent else "function", node.lineno, node.end_lineno, len(args), sum(a.annotation is not None for a in args), node.returns is not None,
             isinstance(node, ast.AsyncFunctionDef), _complexity(node), len(body), sum(bool(s.strip()) and not s.strip().startswith("#") for s in body), _depth(node),
             sum(isinstance(n, ast.Return) for n in inner), sum(isinstance(n, ast.Raise) for n in inner), sum(isinstance(n, (ast.Yield, ast.YieldFrom)) for n in inner),
             [ast.unparse(d) for d in node.decorator_list], ast.get_docstring(node) is not None)
        )
    return out


def _dotted(node: ast.AST) -> str | None:
    parts = []
    while isinstance(node, ast.Attribute):
        parts.append(node.attr)
        node = node.value
    return ".".join([node.id, *reversed(parts)]) if isinstance(node, ast.Name) else None


def _call_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    out, seen = [], set()
    inner_first = sorted(((n, q) for n, q, *_ in _walk(tree) if isinstance(n, _FUNCTION)), key=lambda x: -x[0].lineno)
    for node, name in [*inner_first, (tree, "<module>")]:
        for n in ast.walk(node):
            if isinstance(n, ast.Call) and id(n) not in seen:
                seen.add(id(n))
                if callee := _dotted(n.func):
                    out.append((path, name, callee, n.lineno, n.col_offset, "." in callee))
    return out


def _import_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    out = []
    for n in ast.walk(tree):
        if isinstance(n, ast.Import):
            out += [(path, a.name, None, a.asname, 0, n.lineno) for a in n.names]
        elif isinstance(n, ast.ImportFrom):
            out += [(path, n.module or "", a.name, a.asname, n.level, n.lineno) for a in n.names]
    return out


def _node_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    return [(path, "Module", "", None, 1, len(text.split("\n")), 0)] + [(path, type(n).__name__, q, p, n.lineno, n.end_lineno, d) for n, q, p, d in _walk(tree)]


def functions(files: DataFrame) -> DataFrame:
    """A row for each function and method, with sizes, complexity, typedness and counts of exits."""
    rows = parse_rows(files, _function_rows, FUNCTIONS)
    full = (F.col("n_params") > 0) & (F.col("n_annotated") == F.col("n_params")) & F.col("returns_annotated")
    kind = F.when(full, "typed").when((F.col("n_annotated") == 0) & ~F.col("returns_annotated"), "untyped").otherwise("partial")
    return rows.withColumn("typedness", kind).withColumn("module", module_name(F.col("path")))


def calls(files: DataFrame) -> DataFrame:
    return parse_rows(files, _call_rows, CALLS)


def imports(files: DataFrame) -> DataFrame:
    """Imports with `target`, the absolute module: relative ones are resolved against the file's package."""
    rows = parse_rows(files, _import_rows, IMPORTS).withColumn("here", module_name(F.col("path")))
    parts = F.split("here", r"\.")
    base = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - F.col("level"), F.lit(0))), ".")
    joined = F.when(F.col("level") == 0, F.col("module")).otherwise(F.concat_ws(".", F.nullif(base, F.lit("")), F.nullif(F.col("module"), F.lit(""))))
    return rows.withColumn("target", joined).drop("here")


def nodes(files: DataFrame) -> DataFrame:
    return parse_rows(files, _node_rows, NODES)


def import_edges(files: DataFrame) -> DataFrame:
    """src, dst modules of this tree: `from package import module` counts as an edge to the module."""
    known = files.select(module_name(F.col("path")).alias("m")).distinct()
    rows = imports(files).withColumn("src", module_name(F.col("path")))
    tries = rows.select("src", F.explode(F.array(F.col("target"), F.concat_ws(".", "target", "name"), F.concat_ws(".", "target", F.lit("__init__")))).alias("dst"))
    return tries.join(known, F.col("dst") == F.col("m"), "left_semi").where("src <> dst").distinct()


def resolve_calls(call_rows: DataFrame, function_rows: DataFrame, import_rows: DataFrame) -> DataFrame:
    """Each call with its callee's path and qualname and how it was resolved, in this order: a function of the same file, an
    attribute of one, an imported name, any function of that simple name if there is just one; else unresolved."""
    f = function_rows.select("path", "qualname", "module")
    c = call_rows.withColumn("call_id", F.xxhash64("path", "caller", "callee", "line", "col"))
    last = F.substring_index("callee", ".", -1)
    local = c.join(f.select("path", F.col("qualname").alias("q")), "path").where(F.col("q") == F.col("callee")).select("call_id", "path", "q", F.lit(1).alias("rank"), F.lit("local_name").alias("how"), F.lit(0.8).alias("confidence"))
    attr = c.where("is_method").join(f.select("path", F.col("qualname").alias("q")), "path").where(F.substring_index("q", ".", -1) == last).select("call_id", "path", "q", F.lit(2).alias("rank"), F.lit("local_attr").alias("how"), F.lit(0.75).alias("confidence"))
    names = import_rows.select(F.col("path"), F.coalesce("alias", "name").alias("callee"), "target", "name").where("callee is not null")
    alias = c.join(names, ["path", "callee"]).join(f.select(F.col("module").alias("target"), F.col("qualname").alias("name"), F.col("path").alias("p2")), ["target", "name"]).select("call_id", F.col("p2").alias("path"), F.col("name").alias("q"), F.lit(3).alias("rank"), F.lit("import_alias").alias("how"), F.lit(0.7).alias("confidence"))
    single = f.groupBy(F.substring_index("qualname", ".", -1).alias("simple")).agg(F.count("*").alias("n"), F.first("path").alias("p2"), F.first("qualname").alias("q")).where("n = 1")
    anywhere = c.join(single, last == F.col("simple")).select("call_id", F.col("p2").alias("path"), "q", F.lit(4).alias("rank"), F.lit("global_name").alias("how"), F.lit(0.6).alias("confidence"))
    best = local.unionByName(attr).unionByName(alias).unionByName(anywhere).groupBy("call_id").agg(F.min(F.struct("rank", "path", "q", "how", "confidence")).alias("b"))
    return c.join(best, "call_id", "left").select(
        "path", "caller", "callee", "line", "col", F.col("b.path").alias("callee_path"), F.col("b.q").alias("callee_qualname"),
        F.coalesce("b.how", F.lit("unresolved")).alias("resolved_via"), F.coalesce("b.confidence", F.lit(0.0)).alias("confidence"),
    )
