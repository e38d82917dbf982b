"""What functions do with data models, and which models the fields of models refer to.

A parse of a file emits events by place in the order of a visit: names that may be models, variables that may hold one, assignments.
Which names are models, which model a variable holds at a place, and which candidate is the only one is settled by joins over
all files at once."""

from __future__ import annotations

import ast
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.sources.python_ast import _FUNCTION, _dotted, _mapped, _walk, parse_rows
from corvid.sources.texts import spread

EVENTS = "path string, qualname string, place int, event string, variable string, name string, usage string, line int"
FIELDS = "path string, qualname string, field string, type string, place int, rank int, symbol string, module string, name string"
# What methods of models, managers and sessions do.
METHODS = {
    "serialize": ("dict", "json", "model_dump", "model_dump_json", "asdict", "astuple", "values", "values_list", "to_dict"),
    "update": ("update", "save", "commit", "refresh", "refresh_from_db"),
    "validate": ("validate", "model_validate", "full_clean"),
    "delete": ("delete", "remove"),
    "read": ("get", "filter", "filter_by", "all", "first", "one", "one_or_none", "scalar_one", "scalar_one_or_none", "query", "select", "join", "where"),
    "create": ("create", "add", "merge", "bulk_create"),
}
RESULTS = ("first", "one", "scalar_one", "first_or_none")
MANY = ("list", "set", "tuple", "sequence")


def _usage(method: str) -> str | None:
    return next((kind for kind, names in METHODS.items() if method in names), None)


def _called(node: ast.AST | None) -> str | None:
    """The dotted name of a name, an attribute or a call; what can't be named before a dot is left out."""
    if isinstance(node, ast.Call):
        return _called(node.func)
    if isinstance(node, ast.Attribute):
        owner = _called(node.value)
        return f"{owner}.{node.attr}" if owner else node.attr
    return node.id if isinstance(node, ast.Name) else None


class _Events:
    """Events of one function in the order of a visit: `bind` gives variables a name's model, `name` and `variable` are uses."""

    def __init__(self, node: ast.AST):
        self.rows: list[tuple] = []
        self.place = 0
        for child in ast.iter_child_nodes(node):
            self.visit(child)

    def add(self, event: str, variable: str | None, name: str | None, usage: str | None, line: int) -> None:
        if (variable if event != "name" else name) and (event == "variable" or name):
            self.rows.append((self.place, event, variable, name, usage, line))

    def uses(self, name: str | None, usage: str, line: int) -> None:
        self.add("name", None, name, usage, line)

    def held(self, node: ast.AST, usage: str, line: int) -> None:
        if isinstance(node, ast.Name):
            self.add("variable", node.id, None, usage, line)

    def visit(self, node: ast.AST) -> None:
        self.place += 1
        if isinstance(node, (ast.Assign, ast.AnnAssign)) and isinstance(node.value, ast.Call):
            self.assign(node.targets if isinstance(node, ast.Assign) else [node.target], node.value)
        elif isinstance(node, ast.Call):
            self.call(node)
        elif isinstance(node, ast.Attribute):
            self.held(node.value, "update" if isinstance(node.ctx, ast.Store) else "read", node.lineno)
        elif isinstance(node, ast.Delete):
            for target in node.targets:
                self.held(target.value if isinstance(target, ast.Attribute) else target, "delete", target.lineno)
        for child in ast.iter_child_nodes(node):
            self.visit(child)

    def assign(self, targets: list[ast.expr], value: ast.Call) -> None:
        func, names = value.func, [t.id for t in targets if isinstance(t, ast.Name)]
        name, usage = _called(func), "create"
        if isinstance(func, ast.Attribute):
            usage = _usage(func.attr) or usage
            if isinstance(func.value, ast.Attribute) and func.value.attr == "objects":
                name = _called(func.value.value)
        self.give(names, name, usage, value.lineno)
        inner = func.value if isinstance(func, ast.Attribute) else None
        if isinstance(inner, ast.Call) and (func.attr in RESULTS or (isinstance(inner.func, ast.Attribute) and inner.func.attr in ("query", "select"))):
            for arg in inner.args:
                self.give(names, _called(arg), "read", value.lineno)

    def give(self, names: list[str], name: str | None, usage: str, line: int) -> None:
        self.uses(name, usage, line)
        for variable in names:
            self.add("bind", variable, name, None, line)
        self.place += 1

    def call(self, node: ast.Call) -> None:
        func = node.func
        self.uses(_called(func), "create", node.lineno)
        if isinstance(func, ast.Attribute):
            usage, base = _usage(func.attr), func.value
            if usage:
                self.held(base, usage, node.lineno)
                if isinstance(base, ast.Attribute) and base.attr == "objects":
                    self.uses(_called(base.value), usage, node.lineno)
            if isinstance(base, ast.Name):
                for arg in node.args:
                    if func.attr in ("add", "merge", "delete"):
                        self.uses(_called(arg) if isinstance(arg, ast.Call) else None, "create", node.lineno)
                        self.held(arg, "delete", arg.lineno)
                    elif func.attr in ("query", "select", "join"):
                        self.uses(_called(arg), "read", node.lineno)
        elif isinstance(func, ast.Name) and func.id == "dict" and node.args:
            self.held(node.args[0], "serialize", node.lineno)
        for arg in node.args:
            self.held(arg, "serialize", arg.lineno)
            if isinstance(arg, ast.Call):
                self.uses(_called(arg.func), "create", arg.lineno)


def _event_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    out = []
    for node, name, *_ in _walk(tree):
        if not isinstance(node, _FUNCTION):
            continue
        a = node.args
        for arg in (*a.posonlyargs, *a.args, *a.kwonlyargs, a.vararg, a.kwarg):
            if arg is not None and arg.annotation is not None and arg.arg not in ("self", "cls"):
                words = re.sub(r"[^A-Za-z0-9_.]", " ", ast.unparse(arg.annotation)).split()
                out += [(path, name, k - len(words), "seed", arg.arg, w, None, node.lineno) for k, w in enumerate(words)]
        out += [(path, name, *r) for r in _Events(node).rows]
    return out


def usage_events(files: DataFrame) -> DataFrame:
    return parse_rows(files, _event_rows, EVENTS)


def resolve_names(names: DataFrame, models: DataFrame) -> DataFrame:
    """name, model_id of the names(name) that are models(model_id, module, name): by qualified name, then by it in lower case, by simple
    name, by the last dotted part, and by these two in lower case; of several the first model_id."""
    full = F.concat_ws(".", "module", "name")
    known = models.select("model_id", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("key")) for k, c in (("q", full), ("ql", F.lower(full)), ("s", F.col("name")), ("sl", F.lower("name")))])).alias("x"))
    known = known.groupBy("x.kind", "x.key").agg(F.min("model_id").alias("model_id"), F.max("model_id").alias("last"))
    n, last = F.col("name"), F.substring_index("name", ".", -1)
    tries = (("q", n), ("ql", F.lower(n)), ("s", n), ("s", last), ("sl", F.lower(n)), ("sl", F.lower(last)))
    asked = names.select("name").distinct().select("name", F.posexplode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("key")) for k, c in tries])).alias("rank", "t"))
    met = asked.select("name", "rank", "t.kind", "t.key").join(known, ["kind", "key"])
    # a qualified name that two models share is the later one's, a simple one the first one's
    return met.groupBy("name").agg(F.min_by(F.when(F.col("kind").isin("q", "ql"), F.col("last")).otherwise(F.col("model_id")), "rank").alias("model_id"))


def model_usage(files: DataFrame, models: DataFrame, examples: int = 5) -> DataFrame:
    """path, qualname, model_id, usage, lines (the first `examples`), uses of each kind of use that a function makes of a model.

    A variable holds the model of the last assignment before a place that named one; parameters start with the first model that
    their annotation names. Events that name no model fall out of the joins before variables are looked up."""
    events = usage_events(files)
    known = resolve_names(events.where("name is not null"), models)
    named = events.where("event <> 'variable'").join(known, "name")
    key = ["path", "qualname", "variable"]
    seeds = named.where("event = 'seed'").groupBy(*key).agg(F.min_by("model_id", "place").alias("model_id")).withColumn("from", F.lit(-1))
    binds = named.where("event = 'bind'").groupBy(*key, F.col("place").alias("from")).agg(F.max("model_id").alias("model_id"))
    held = seeds.select(*key, "from", "model_id").unionByName(binds.select(*key, "from", "model_id"))
    looked = events.where("event = 'variable'").join(held, key).where(F.col("from") < F.col("place"))
    by_variable = looked.groupBy("path", "qualname", "place", "usage", "line", "variable").agg(F.max_by("model_id", "from").alias("model_id"))
    uses = named.where("event = 'name'").select("path", "qualname", "model_id", "usage", "line").unionByName(by_variable.select("path", "qualname", "model_id", "usage", "line"))
    return uses.distinct().groupBy("path", "qualname", "model_id", "usage").agg(F.slice(F.sort_array(F.collect_set("line")), 1, examples).alias("lines"), F.count("*").alias("uses"))


def _symbols(node: ast.AST) -> list[str]:
    """Names in an annotation, in order; quoted ones are read too."""
    if isinstance(node, ast.Name):
        return [node.id]
    if isinstance(node, ast.Attribute):
        return [name] if (name := _dotted(node)) else []
    if isinstance(node, ast.Subscript):
        return _symbols(node.value) + _symbols(node.slice)
    if isinstance(node, ast.BinOp) and isinstance(node.op, ast.BitOr):
        return _symbols(node.left) + _symbols(node.right)
    if isinstance(node, (ast.Tuple, ast.List, ast.Set)):
        return [s for e in node.elts for s in _symbols(e)]
    if isinstance(node, ast.Constant) and isinstance(node.value, str):
        try:
            return _symbols(ast.parse(node.value, mode="eval").body)
        except SyntaxError:
            return []
    return []


def _field_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    """For each name in a field's type, in order, the modules where it may be defined: where it was imported from, as it is written, in
    this file, and (null) anywhere."""
    module = re.sub(r"\.py$", "", path).replace("/", ".")
    origin, aliases = {}, {}
    for n in ast.walk(tree):
        if isinstance(n, ast.ImportFrom):
            base = module.split(".")[: -n.level] if n.level else []
            origin |= {a.asname or a.name: ".".join([*base, *([n.module] if n.module else [])]) for a in n.names}
        elif isinstance(n, ast.Import):
            aliases |= {a.asname or a.name: a.name for a in n.names}
    out = []
    for node, name, *_ in _walk(tree):
        if not isinstance(node, ast.ClassDef):
            continue
        for s in node.body:
            if isinstance(s, ast.AnnAssign) and isinstance(s.target, ast.Name):
                for place, symbol in enumerate(_symbols(s.annotation)):
                    head, *rest = symbol.split(".")
                    if not rest:
                        guesses = [origin.get(head), module, None]
                    else:
                        base = aliases.get(head) or origin.get(head)
                        guesses = [".".join([base, *rest[:-1]]) if base else None, ".".join([head, *rest[:-1]]), module, None]
                    guesses = [g for g in guesses[:-1] if g is not None] + [None]
                    out += [(path, name, s.target.id, ast.unparse(s.annotation), place, k, symbol, g, rest[-1] if rest else head) for k, g in enumerate(guesses)]
    return out


def model_relationships(files: DataFrame, models: DataFrame) -> DataFrame:
    """path, qualname, field, symbol, target (model_id), multiplicity of the fields whose type names one of models(model_id, module,
    name): the first name that has a model in a module where it may come from, or that only one model has (in any case of letters, if
    none has it as written)."""
    rows = spread(files).mapInPandas(_mapped(_field_rows, FIELDS), FIELDS)
    exact = models.groupBy("module", "name").agg(F.max("model_id").alias("there"))
    only = models.groupBy("name").agg(F.count("*").alias("n"), F.min("model_id").alias("one"))
    lower = models.groupBy(F.lower("name").alias("low")).agg(F.count("*").alias("nl"), F.min("model_id").alias("one_low"))
    met = rows.join(exact, ["module", "name"], "left").join(only, "name", "left").withColumn("low", F.lower("name")).join(lower, "low", "left")
    anywhere = F.when(F.col("n").isNotNull(), F.when(F.col("n") == 1, F.col("one"))).when(F.col("nl") == 1, F.col("one_low"))
    target = F.when(F.col("module").isNotNull(), F.col("there")).otherwise(anywhere)
    found = met.withColumn("target", target).where("target is not null")
    many = F.exists(F.array(*[F.lit(m) for m in MANY]), lambda m: F.contains(F.lower("type"), m))
    best = found.groupBy("path", "qualname", "field", "type").agg(F.min_by(F.struct("symbol", "target"), F.struct("place", "rank")).alias("b"))
    return best.select("path", "qualname", "field", "b.symbol", "b.target", F.when(many, "many").otherwise("one").alias("multiplicity"))
