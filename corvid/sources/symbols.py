"""Symbol occurrences of index files: JSON payloads unnested, definitions, uses across files, names for known functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators.selection import is_definition, is_reference

_DOCUMENTS = "array<struct<relative_path: string, occurrences: array<struct<symbol: string, symbol_roles: int, `range`: array<int>>>>>"


def occurrences(payloads: DataFrame) -> DataFrame:
    """path (with /), document and place (numbers), symbol, roles, line (from 1, null without a range) of payloads(name, text): an object
    with `documents` or a list of them. Text that is no such JSON, documents without a path and occurrences without a symbol have no
    rows; missing roles are 0. `name` orders the payloads of one index."""
    listed = F.coalesce(F.from_json("text", f"struct<documents: {_DOCUMENTS}>")["documents"], F.from_json("text", _DOCUMENTS))
    docs = payloads.select("name", F.posexplode(listed).alias("document", "d"))
    rows = docs.where("d.relative_path <> ''").select("name", "document", F.translate("d.relative_path", "\\", "/").alias("path"), F.posexplode("d.occurrences").alias("place", "o"))
    return rows.where("o.symbol <> ''").select(
        "name", "document", "place", "path", F.col("o.symbol").alias("symbol"), F.coalesce("o.symbol_roles", F.lit(0)).alias("roles"), (F.get("o.range", F.lit(0)) + 1).alias("line")
    )


def definition_paths(rows: DataFrame) -> DataFrame:
    """symbol, def_path: the path of a symbol's first definition, in the order of payloads, documents and occurrences."""
    made = rows.where(is_definition(F.col("roles")))
    return made.groupBy("symbol").agg(F.min_by("path", F.struct("name", "document", "place")).alias("def_path"))


def symbol_uses(rows: DataFrame, modules: DataFrame) -> DataFrame:
    """symbol, def_path, use_path, same_file, same_module: each use of a symbol in a file once, for symbols that have a definition;
    modules(path, module). The symbols that very many files use are met by a join that adaptive execution can split."""
    uses = rows.where(is_reference(F.col("roles"))).select("symbol", F.col("path").alias("use_path")).distinct()
    known = [modules.groupBy(F.col("path").alias(p)).agg(F.min("module").alias(m)) for p, m in (("def_path", "def_module"), ("use_path", "use_module"))]
    met = uses.join(definition_paths(rows), "symbol").join(known[0], "def_path", "left").join(known[1], "use_path", "left")
    return met.select(
        "symbol", "def_path", "use_path", (F.col("def_path") == F.col("use_path")).alias("same_file"), F.coalesce(F.col("def_module") == F.col("use_module"), F.lit(False)).alias("same_module")
    )


def use_definitions(uses: DataFrame) -> DataFrame:
    """use_path, def_paths: where the symbols that a file uses are defined."""
    return uses.groupBy("use_path").agg(F.sort_array(F.collect_set("def_path")).alias("def_paths"))


def module_edges(uses: DataFrame, modules: DataFrame) -> DataFrame:
    """src, dst, weight: symbols that two modules share, by definition and use, without directions and loops."""
    a, b = modules.select(F.col("path").alias("def_path"), F.col("module").alias("a")), modules.select(F.col("path").alias("use_path"), F.col("module").alias("b"))
    met = uses.join(a, "def_path").join(b, "use_path").where("a <> b")
    return met.groupBy(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).agg(F.count("*").alias("weight"))


def function_edges(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """src, dst, weight between functions: a symbol defined on the first line of one function of spans(path, function_id, first, last)
    and referred to inside another one. The innermost function around a use counts."""
    named = rows.where(is_definition(F.col("roles"))).join(spans, (rows["path"] == spans["path"]) & (rows["line"] == spans["first"]))
    defined = named.groupBy("symbol").agg(F.min_by("function_id", F.struct("name", "document", "place")).alias("dst"))
    band = lambda c: F.floor(c / 256)
    wide = spans.select(F.col("path").alias("p"), "function_id", "first", "last", F.explode(F.sequence(band(F.col("first")), band(F.greatest("first", "last")))).alias("band"))
    used = rows.where(is_reference(F.col("roles"))).withColumn("b", band(F.col("line")))
    inside = used.join(wide, (used["path"] == wide["p"]) & (used["b"] == wide["band"]) & used["line"].between(wide["first"], wide["last"]))
    around = inside.groupBy("name", "document", "place", "symbol").agg(F.min_by("function_id", F.struct(F.col("last") - F.col("first"), "function_id")).alias("src"))
    return around.join(defined, "symbol").where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))


def symbols_of_functions(rows: DataFrame, functions: DataFrame) -> DataFrame:
    """functions(path, start_line, ...) with symbol: that of the last definition listed for its first line."""
    made = rows.where(is_definition(F.col("roles")) & F.col("line").isNotNull())
    one = made.groupBy("path", F.col("line").alias("start_line")).agg(F.max_by("symbol", F.struct("name", "document", "place")).alias("symbol"))
    return functions.join(one, ["path", "start_line"], "left").select(*functions.columns, "symbol")
