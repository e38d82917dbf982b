"""Contracts of Python functions: preconditions from asserts and guards, what is raised, which parameters and results may be None.

One parse of a file gives facts as rows; docstrings, annotations and the confidence are joined and added up by Spark."""

from __future__ import annotations

import ast
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.sources.python_ast import _FUNCTION, _walk, parse_rows

FACTS = "path string, qualname string, place int, fact string, kind string, name string, value string, source string, line int"
# Marks of types that admit None, and starts of names of predicates.
NULLABLE = ("optional", "none", "|none")
PREDICATES = ("is_", "has_", "should_")
MOST = 64


def _target(node: ast.AST | None) -> str | None:
    return node.id if isinstance(node, ast.Name) else node.attr if isinstance(node, ast.Attribute) else None


def _number(node: ast.AST) -> int | None:
    """An integer literal; True and False count as 1 and 0."""
    sign = 1
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
        node, sign = node.operand, -1
    return sign * int(node.value) if isinstance(node, ast.Constant) and isinstance(node.value, int) else None


def _may_be_none(node: ast.AST) -> bool:
    """None itself, and whatever is no literal: comparing with a name or a call is taken for a comparison with None."""
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
        return not (isinstance(node.operand, ast.Constant) and isinstance(node.operand.value, (int, float)))
    return node.value is None if isinstance(node, ast.Constant) else not isinstance(node, (ast.List, ast.Tuple, ast.Dict))


def _condition(test: ast.AST, holds: bool, names: set[str]) -> tuple[str, str, object] | None:
    """kind, parameter and value of what a test demands of a parameter: of an assert (holds), or of a guard before a raise."""
    if isinstance(test, ast.UnaryOp) and isinstance(test.op, ast.Not):
        return _condition(test.operand, not holds, names)
    if isinstance(test, ast.Call):
        if isinstance(test.func, ast.Name) and test.func.id == "isinstance" and len(test.args) > 1 and holds and _target(test.args[0]):
            return "instance_of", _target(test.args[0]), ast.unparse(test.args[1])
        return None
    if not isinstance(test, ast.Compare):
        name = _target(test)
        return ("truthy" if holds else "falsey", name, None) if name in names else None
    if len(test.ops) != 1:
        return None
    op, left, right = test.ops[0], test.left, test.comparators[0]
    if isinstance(left, ast.Call) and isinstance(left.func, ast.Name) and left.func.id == "len":
        name, least = _target(left.args[0] if left.args else None), _number(right)
        fits = isinstance(op, (ast.Gt, ast.GtE) if holds else (ast.Eq, ast.LtE, ast.Lt))
        return ("len_gt", name, max(0, least)) if fits and name in names and least is not None else None
    name = _target(left)
    if name not in names:
        return None
    if _may_be_none(right) and isinstance(op, (ast.IsNot, ast.NotEq) if holds else (ast.Is, ast.Eq)):
        return "non_null", name, None
    if isinstance(right, ast.Constant) and isinstance(right.value, (int, float)) and isinstance(op, (ast.Gt, ast.GtE) if holds else (ast.Lt, ast.LtE)):
        return "ge", name, right.value
    return None


def _exception(node: ast.AST | None) -> str | None:
    if isinstance(node, ast.Call):
        return _exception(node.func)
    if isinstance(node, ast.Attribute):
        base = _exception(node.value)
        return f"{base}.{node.attr}" if base else node.attr
    return node.id if isinstance(node, ast.Name) else None


def _fact_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    out = []
    for node, name, *_ in _walk(tree):
        if not isinstance(node, _FUNCTION):
            continue
        a, rows = node.args, []
        args = [x for x in (*a.posonlyargs, *a.args, *a.kwonlyargs, a.vararg, a.kwarg) if x is not None and x.arg not in ("self", "cls")]
        names = {x.arg for x in args}
        add = lambda fact, kind, what=None, value=None, source=None, line=None, rows=rows: rows.append((fact, kind, what, value, source, line))
        add("function", "return", None, ast.unparse(node.returns) if node.returns else None, None, node.end_lineno)
        for x in args:
            add("param", "param", x.arg, ast.unparse(x.annotation) if x.annotation else None)
        stack: list[ast.AST] = [node]
        while stack:  # depth first, in source order; nested functions count
            n = stack.pop()
            stack += reversed(list(ast.iter_child_nodes(n)))
            found, source = None, "assert"
            if isinstance(n, ast.Assert):
                found = _condition(n.test, True, names)
            elif isinstance(n, ast.If) and any(isinstance(s, ast.Raise) for s in n.body):
                found = _condition(n.test, False, names)
            elif isinstance(n, ast.Raise):
                first = n.exc.args[0] if isinstance(n.exc, ast.Call) and n.exc.args else None
                said = first.value if isinstance(first, ast.Constant) and isinstance(first.value, str) else None
                add("raise", _exception(n.exc) or "Exception", None, said, "raise", n.lineno)
            elif isinstance(n, ast.Return) and (n.value is None or (isinstance(n.value, ast.Constant) and n.value.value is None)):
                add("none", "return", None, None, None, n.lineno)
            if found:
                kind, what, value = found
                # what a negation turns an assert into reads as a guard, and the reverse
                holds = isinstance(n, ast.Assert)
                test = n.test
                while isinstance(test, ast.UnaryOp) and isinstance(test.op, ast.Not):
                    test, holds = test.operand, not holds
                add("pre", kind, what, None if value is None else value if isinstance(value, str) else json.dumps(value), source if holds else "guard", n.lineno)
        out += [(path, name, i, *r) for i, r in enumerate(rows)]
    return out


def contract_facts(files: DataFrame) -> DataFrame:
    return parse_rows(files, _fact_rows, FACTS)


def _nullable(kind):
    """Whether a type admits None."""
    low = F.lower(F.regexp_replace(kind, " ", ""))
    return F.exists(F.array(*[F.lit(m) for m in NULLABLE]), lambda m: F.contains(low, m))


def function_contracts(files: DataFrame, docs: DataFrame | None = None, most: int = MOST) -> DataFrame:
    """path, qualname, preconditions, postconditions, raises (arrays, the first `most` in source order), param_nullability (map),
    return_nullability, confidence of each function. docs(path, qualname, param_docs map, return_doc), if given, are what docstrings
    say of parameters and results: they outweigh annotations of parameters, and count for results that have none. The confidence is
    0.3 each for types, a docstring, and conditions or raises."""
    key = ["path", "qualname"]
    facts = contract_facts(files)
    of = lambda fact, value: F.slice(F.transform(F.sort_array(F.collect_list(F.when(F.col("fact") == fact, value))), lambda x: x["v"]), 1, most)
    item = F.struct("place", F.struct("kind", F.col("name").alias("param"), "value", "source", "line").alias("v"))
    thrown = F.struct("place", F.struct(F.col("kind").alias("exception"), F.col("value").alias("message"), "line").alias("v"))
    typed = F.col("value").isNotNull()
    rows = facts.groupBy(*key).agg(
        of("pre", item).alias("preconditions"), of("raise", thrown).alias("raises"), F.max(F.when(F.col("fact") == "function", F.col("value"))).alias("returns"),
        F.max(F.when(F.col("fact") == "function", F.col("line"))).alias("end_line"), F.max((F.col("fact") == "none").cast("int")).alias("none"),
        F.collect_list(F.when(F.col("fact") == "param", F.struct(F.col("name").alias("name"), F.col("value").alias("type")))).alias("params"),
        F.max((typed & F.col("fact").isin("function", "param")).cast("int")).alias("typed"),
    )
    if docs is None:
        rows = rows.withColumns({"param_docs": F.lit(None).cast("map<string,string>"), "return_doc": F.lit(None).cast("string"), "has_doc": F.lit(False)})
    else:
        said = docs.groupBy(*key).agg(F.first("param_docs").alias("param_docs"), F.first("return_doc").alias("return_doc"), F.lit(True).alias("has_doc"))
        rows = rows.join(said, key, "left").withColumn("has_doc", F.coalesce("has_doc", F.lit(False)))

    def of_param(p):
        hint = F.lower(F.coalesce(F.try_element_at("param_docs", p["name"]), F.lit("")))
        has = lambda *w: F.exists(F.array(*[F.lit(x) for x in w]), lambda x: F.contains(hint, x))
        by_type = F.when(p["type"].isNull(), "unknown").when(_nullable(p["type"]), "nullable").otherwise("non_null")
        return F.when(has("optional", "may be none"), "nullable").when(has("required", "must not be none"), "non_null").otherwise(by_type)

    doc = F.lower("return_doc")
    result = F.when(F.col("returns").isNotNull(), F.when(_nullable(F.col("returns")), "nullable").otherwise("non_null")).when(
        F.contains(doc, F.lit("none")) | F.contains(doc, F.lit("null")) | (F.col("none") == 1), "nullable"
    )
    last = F.substring_index("qualname", ".", -1)
    predicate = F.contains(F.lower("returns"), F.lit("bool")) | (F.col("returns").isNotNull() & F.exists(F.array(*[F.lit(p) for p in PREDICATES]), lambda p: F.startswith(last, p)))
    post = lambda when, kind: F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit("return").alias("param"), F.lit("type_hint").alias("source"), F.col("end_line").alias("line")))
    out = rows.withColumn("return_nullability", result)
    return out.select(
        *key, "preconditions", F.filter(F.array(post(F.col("return_nullability") == "non_null", "non_null"), post(predicate, "returns_bool_predicate")), lambda x: x.isNotNull()).alias("postconditions"),
        "raises", F.map_from_entries(F.transform("params", lambda p: F.struct(p["name"], of_param(p)))).alias("param_nullability"), "return_nullability",
        ((F.col("typed") + F.col("has_doc").cast("int") + ((F.size("preconditions") > 0) | (F.size("raises") > 0)).cast("int")) * 3 / 10).alias("confidence"),
    )
