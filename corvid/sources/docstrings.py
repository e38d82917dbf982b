"""Docstrings and sizes of Python files: texts with their sections, nodes and depths, shares of annotations."""

from __future__ import annotations

import ast
import inspect
import itertools
import json
import re
import textwrap

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.ids import module_name
from corvid.operators import relational as R
from corvid.sources.python_ast import _FUNCTION, _walk, parse_rows

DOCS = "path string, qualname string, kind string, line int, end_line int, raw string, parsed string"
PARSED = "struct<short: string, long: string, params: array<struct<name: string, type: string, text: string, `default`: string>>, returns: struct<type: string, text: string>, raises: array<struct<type: string, text: string>>, examples: array<string>>"
FILES = "path string, nodes long, functions long, classes long, depths long, max_depth int, complexity long, parameters long, annotated long, returns_annotated long, untyped_defs long"

# Titles of sections and names of fields by what they hold.
TITLES = {
    "params": ("args", "arguments", "params", "parameters", "keyword args", "keyword arguments", "attributes"),
    "returns": ("returns", "return", "yields", "yield"),
    "raises": ("raises", "raise", "exceptions", "except"),
    "examples": ("example", "examples"),
}
FIELDS = {"params": ("param", "parameter", "arg", "argument", "key", "keyword", "attribute"), "returns": ("return", "returns", "yield", "yields"), "raises": ("raises", "raise", "except", "exception")}

_KIND = {t: kind for kind, titles in TITLES.items() for t in titles}
_FIELD = re.compile(r"^:(\w+)(?:\s+([^:]*))?:\s*(.*)$")
_DEFAULT = re.compile(r"(?i)defaults to (\S+?)\.?(?:\s|$)")


def _param(name: str, type_: str | None, text: str) -> dict:
    found = _DEFAULT.search(text)
    return {"name": name, "type": type_ or None, "text": text or None, "default": found and found[1]}


def _fields(lines: list[str]) -> tuple[int, dict]:
    """Fields like `:param int x: text`, each up to the next one; a type may have a field of its own."""
    out: dict = {"params": [], "raises": [], "examples": []}
    types, at = {}, next((i for i, s in enumerate(lines) if _FIELD.match(s)), len(lines))
    groups: list[list[str]] = []
    for s in lines[at:]:
        if _FIELD.match(s) or not groups:
            groups.append([])
        groups[-1].append(s)
    for g in groups:
        name, arg, first = _FIELD.match(g[0]).groups()
        text = "\n".join(x.strip() for x in [first, *g[1:]]).strip()
        words = (arg or "").split()
        if name in FIELDS["params"] and words:
            out["params"].append(_param(words[-1], " ".join(words[:-1]), text))
        elif name in FIELDS["returns"]:
            out["returns"] = {"type": arg, "text": text or None}
        elif name in FIELDS["raises"]:
            out["raises"].append({"type": arg, "text": text or None})
        elif name in ("type", "rtype"):
            types[arg] = text
    for p in out["params"]:
        p["type"] = p["type"] or types.get(p["name"])
    if None in types:
        out["returns"] = (out.get("returns") or {"text": None}) | {"type": types[None]}
    return at, out


def _entries(body: list[str]) -> list[tuple[str, str]]:
    """The lines of least indentation, each with what is indented below it."""
    out: list[tuple[str, list[str]]] = []
    for s in textwrap.dedent("\n".join(body)).split("\n"):
        if s.strip() and not s[0].isspace():
            out.append((s.strip(), []))
        elif out:
            out[-1][1].append(s.strip())
    return [(head, "\n".join(rest).strip()) for head, rest in out]


def _sections(lines: list[str], underlined: bool) -> tuple[int, dict]:
    """Titled sections: `Args:` with indented entries `name (type): text`, or a title above dashes with entries `name : type` and the
    text indented below."""

    def title(i: int) -> str | None:
        s = lines[i].strip().lower()
        if underlined:
            return s if i + 1 < len(lines) and re.fullmatch(r"-{3,}", lines[i + 1].strip()) else None
        return s[:-1] if s.endswith(":") and s[:-1] in _KIND and not lines[i][:1].isspace() else None

    out: dict = {"params": [], "raises": [], "examples": []}
    starts = [i for i in range(len(lines)) if title(i) is not None]
    for i, end in zip(starts, [*starts[1:], len(lines)], strict=False):
        kind, body = _KIND.get(title(i)), lines[i + 1 + underlined : end]
        if not underlined:  # a titled section ends where the indentation does
            body = list(itertools.takewhile(lambda s: not s.strip() or s[0].isspace(), body))
        if kind == "examples":
            out[kind] += [t] if (t := textwrap.dedent("\n".join(body)).strip()) else []
            continue
        for head, below in _entries(body) if kind else []:
            if underlined:
                name, _, type_ = (x.strip() for x in head.partition(" : "))
                text = below
            else:
                name, colon, first = head.partition(":")
                name, text = (name.strip(), f"{first.strip()}\n{below}".strip()) if colon else ("", f"{head}\n{below}".strip())
                typed = re.fullmatch(r"(\S+)\s*\((.*)\)", name)
                name, type_ = typed.groups() if typed else (name, "")
                type_ = type_.removesuffix(", optional")
            if kind == "params":
                out[kind].append(_param(name, type_, text))
            elif kind == "raises":
                out[kind].append({"type": name or None, "text": text or None})
            elif "returns" not in out:
                out["returns"] = {"type": (type_ or name) or None, "text": text or None}
    return (starts[0] if starts else len(lines)), out


def parsed(raw: str) -> dict:
    """The parts of a docstring in that of three styles which finds most of them: fields, titled sections, underlined sections, the
    first among equals. The short text is the first line, the long one what follows up to the first part."""
    lines = inspect.cleandoc(raw).split("\n")
    tried = [_fields(lines), _sections(lines, False), _sections(lines, True)]
    at, out = max(tried, key=lambda t: sum(len(t[1][k]) for k in ("params", "raises", "examples")) + ("returns" in t[1]))
    short, _, rest = "\n".join(lines[:at]).strip().partition("\n")
    return {"short": short or None, "long": rest.strip() or None, "returns": None} | out


def _doc_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    out = []
    for node, name, parent, _ in [(tree, "", "", 0), *_walk(tree)]:
        if raw := ast.get_docstring(node, clean=False):
            kind = "module" if node is tree else "class" if isinstance(node, ast.ClassDef) else "method" if parent else "function"
            out.append((path, name, kind, getattr(node, "lineno", None), getattr(node, "end_lineno", None), raw, json.dumps(parsed(raw))))
    return out


def docstrings(files: DataFrame) -> DataFrame:
    """path, module, qualname (empty for the module), kind, line, end_line, raw, short, long, params, returns, raises, examples: a row for each
    module, class and function of files(path, text) that has a docstring. Files that are no Python have none."""
    rows = parse_rows(files, _doc_rows, DOCS).withColumn("p", F.from_json("parsed", PARSED))
    return rows.select("path", module_name(F.col("path")).alias("module"), "qualname", "kind", "line", "end_line", "raw", "p.*")


def contract_docs(docs: DataFrame) -> DataFrame:
    """path, qualname, param_docs, return_doc as contracts read them: a name that is documented twice keeps its last text."""
    last = F.filter("params", lambda p, i: ~F.exists(F.slice("params", i + 2, F.size("params")), lambda q: q["name"] == p["name"]))
    return docs.where("kind in ('function', 'method')").select("path", "qualname", F.map_from_entries(F.transform(last, lambda p: F.struct(p["name"], F.coalesce(p["text"], F.lit(""))))).alias("param_docs"), F.col("returns.text").alias("return_doc"))


def _file_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    seen, stack = [], [(tree, 1)]
    while stack:
        node, depth = stack.pop()
        seen.append((node, depth))
        stack += [(c, depth + 1) for c in ast.iter_child_nodes(node)]
    functions = [n for n, _ in seen if isinstance(n, _FUNCTION)]
    args = [[a for a in (*n.args.posonlyargs, *n.args.args, *n.args.kwonlyargs) if a.arg not in ("self", "cls")] for n in functions]
    typed = [all(a.annotation for a in own) and n.returns is not None for n, own in zip(functions, args, strict=True)]
    branches = (ast.If, ast.For, ast.While, ast.Try, ast.With, ast.AsyncWith, ast.AsyncFor)
    depths = [d for _, d in seen]
    row = (
        path, len(seen), len(functions), sum(isinstance(n, ast.ClassDef) for n, _ in seen), sum(depths), max(depths), sum(isinstance(n, branches) for n, _ in seen),
        sum(map(len, args)), sum(a.annotation is not None for own in args for a in own), sum(n.returns is not None for n in functions), typed.count(False),
    )
    return [row]


def file_metrics(files: DataFrame) -> DataFrame:
    """path, module, nodes, functions, classes, avg_depth, max_depth, complexity (branching statements), params_ratio, returns_ratio,
    untyped_defs of each file of files(path, text) that is Python. Depths count from 1 at the module; a share of nothing is 1."""
    rows = parse_rows(files, _file_rows, FILES)
    share = lambda a, b: F.coalesce(R.ratio(F.col(a), F.col(b)), F.lit(1.0))
    return rows.select(
        "path", module_name(F.col("path")).alias("module"), "nodes", "functions", "classes", (F.col("depths") / F.col("nodes")).alias("avg_depth"), "max_depth", "complexity",
        share("annotated", "parameters").alias("params_ratio"), share("returns_annotated", "functions").alias("returns_ratio"), "untyped_defs",
    )
