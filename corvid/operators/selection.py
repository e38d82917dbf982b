"""Picking rows: spans by preference, first and capped rows of a group, induced and trimmed graphs, lists with a fallback."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.operators.components import connected_components
from corvid.operators.graph import nodes_of
from corvid.operators.ranges import numbered
from corvid.session import settle


def induced(edges: DataFrame, allowed: DataFrame) -> DataFrame:
    """The edges (src, dst, ...) between nodes of allowed(node)."""
    ends = [allowed.select(F.col("node").alias(c)).distinct() for c in ("src", "dst")]
    return edges.join(ends[0], "src", "left_semi").join(ends[1], "dst", "left_semi").select(*edges.columns)


def named_like(full: Column, asked: Column) -> Column:
    """Whether a qualified name is the asked one, or ends in a dot and the asked one's last part."""
    return (full == asked) | F.endswith(full, F.concat(F.lit("."), F.substring_index(asked, ".", -1)))


#: Bands of a level are so many times as wide as those of the level below.
FAN = 16


def best_span(lookups: DataFrame, spans: DataFrame, on: Sequence[str], width: int = 256) -> DataFrame:
    """Each of lookups(on, lookup_id, start, end, name) with span_id and step of the span of spans(on, span_id, first, last,
    span_name) that fits best: 1 the same lines and a like name, 2 the same lines, 3 a like name and the first line inside, 4
    the first line inside, 5 the same first line. A null end is the start; without a name steps 1 and 3 are left out. Within a step
    the first span of the file wins, by first line, then by span_id. Without any, nulls.

    Lines are cut into bands of `width` lines, of FAN times as many, and so on. A span has rows at one level, where it touches FAN + 1
    bands at most, and a lookup has a row for its first line at each level that spans are at. So a lookup meets the spans around it and not
    all of its file, and a long span has no more rows than a short one. Candidates are compared by a running minimum, before the shuffle too."""
    end, name = F.coalesce("end", "start"), F.when(F.col("name") != "", F.col("name"))
    same, like = (F.col("start") == F.col("first")) & (end == F.col("last")), F.coalesce(named_like(F.col("span_name"), name), F.lit(False))
    inside = F.col("start").between(F.col("first"), F.col("last"))
    step = F.when(same & like, 1).when(same, 2).when(inside & like, 3).when(inside, 4).when(F.col("start") == F.col("first"), 5)
    long = (F.greatest("first", "last") - F.col("first") + 1) / (FAN * width)
    placed = settle(spans.where("first is not null").withColumn("__level", F.greatest(F.ceil(F.log(float(FAN), long)), F.lit(0)).cast("int")))
    levels = [r[0] for r in placed.select("__level").distinct().collect()]  # at most one for each factor of FAN in the longest span
    band = lambda c: F.floor(c / (width * F.pow(F.lit(float(FAN)), F.col("__level"))))
    banded = placed.select("*", F.explode(F.sequence(band(F.col("first")), band(F.greatest("first", "last")))).alias("__band"))
    asked = lookups.withColumn("__level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("__band", band(F.col("start")))
    met = asked.join(banded, [*on, "__level", "__band"]).withColumn("step", step).where("step is not null")
    best = met.groupBy("lookup_id").agg(F.min(F.struct("step", "first", "span_id")).alias("b"))
    return lookups.join(best, "lookup_id", "left").select(*lookups.columns, F.col("b.span_id").alias("span_id"), F.col("b.step").alias("step"))


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ascending order columns, as a combined minimum: no key is sorted in one task."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")).select(*keys, "__row.*").select(*df.columns)


def capped(findings: DataFrame, rule: str, order: Sequence[str], most: int) -> DataFrame:
    """The first `most` rows of each rule (a report); Spark limits each group before it shuffles."""
    ranked = findings.withColumn("__rank", F.row_number().over(Window.partitionBy(rule).orderBy(*order)))
    return ranked.where(F.col("__rank") <= most).drop("__rank")


def severity(rule: Column, given: Column, overrides: Mapping[str, str]) -> Column:
    """The severity of a finding: the override of its rule, else that of `*`, else the given one."""
    out = F.lit(overrides["*"]) if "*" in overrides else given
    for name, level in overrides.items():
        if name != "*":
            out = F.when(rule == name, level).otherwise(out)
    return out


def clamp_offset(offset: Column) -> Column:
    """0 for null and negative offsets."""
    return F.greatest(F.coalesce(offset, F.lit(0)), F.lit(0))


def is_definition(roles: Column) -> Column:
    """Bit 1. A row may be a definition and a reference at once."""
    return F.coalesce(roles, F.lit(0)).bitwiseAND(F.lit(1)) != 0


def is_reference(roles: Column) -> Column:
    """Import, write or read access: bits 2, 4 and 8."""
    return F.coalesce(roles, F.lit(0)).bitwiseAND(F.lit(14)) != 0


def dependency_risk(level: Column, criticality: Column) -> Column:
    """Severity times criticality, which is 1 unless known."""
    weight = F.when(level == "critical", 4.0).when(level == "high", 3.0).when(level == "medium", 2.0).when(level == "low", 1.0).otherwise(0.5)
    return weight * F.coalesce(criticality, F.lit(1.0))


def unresolved_calls(calls: DataFrame, caller: str, callee: str) -> DataFrame:
    """caller, unresolved: its calls without a known callee; callers without any are left out."""
    return calls.where(F.col(callee).isNull() & F.col(caller).isNotNull()).groupBy(caller).agg(F.count("*").alias("unresolved"))


def known_or_all(values: Column, known: Column) -> Column:
    """The values that are known, or all of them if none is; nulls go."""
    given = F.filter(values, lambda v: v.isNotNull())
    kept = F.array_intersect(given, known)
    return F.when(F.size(kept) > 0, kept).otherwise(given)


def common_prefix(names: Column, most: int = 3) -> Column:
    """The longest run of dotted parts that all names start with, `most` parts of it; empty if there is none."""
    parts = F.transform(names, lambda n: F.split(n, r"\."))
    run = lambda a, b: F.filter(
        F.transform(F.sequence(F.lit(1), F.least(F.size(a), F.size(b))), lambda k: F.slice(a, 1, k)), lambda s: s == F.slice(b, 1, F.size(s))
    )
    shared = F.aggregate(parts, parts[0], lambda acc, p: F.coalesce(F.element_at(F.concat(F.array(F.array().cast("array<string>")), F.when((F.size(acc) > 0) & (F.size(p) > 0), run(acc, p)).otherwise(F.array(F.array().cast("array<string>")))), -1), F.array().cast("array<string>")))
    return F.array_join(F.slice(shared, 1, most), ".")


def trimmed(nodes: DataFrame, most: int, seed: int) -> DataFrame:
    """`most` of the nodes(node): sorted by their text and taken from place `seed` (modulo their number) round."""
    placed, n = numbered(nodes.select("node", F.col("node").cast("string").alias("__text")), ["__text"])
    return placed.where(F.pmod(F.col("__place") - seed, F.lit(max(n, 1))) < most).select("node")


def trimmed_graph(edges: DataFrame, max_nodes: int | None = None, max_edges: int | None = None, seed: int = 0) -> tuple[DataFrame, dict]:
    """Nodes and edges within budgets, and what was cut: the edges between the nodes of `trimmed`, and of these `max_edges`,
    sorted by the texts of their ends and taken from place `seed` round. A report of a graph too large to show."""
    nodes = settle(nodes_of(edges))
    before = {"nodes_before": nodes.count(), "edges_before": edges.count()}
    left = edges
    if max_nodes is not None and before["nodes_before"] > max_nodes:
        nodes = settle(trimmed(nodes, max_nodes, seed))
        left = induced(edges, nodes)
    placed, n = numbered(left, [F.col("src").cast("string"), F.col("dst").cast("string"), F.col("src"), F.col("dst")])
    if max_edges is not None and n > max_edges:
        placed = placed.where(F.pmod(F.col("__place") - seed, F.lit(n)) < max_edges)
    kept = settle(placed.drop("__place"))
    after = {"nodes_after": nodes.count(), "edges_after": min(n, n if max_edges is None else max_edges)}
    return kept, before | after | {"truncated": after["nodes_after"] < before["nodes_before"] or after["edges_after"] < before["edges_before"]}


def graph_stats(name: str, edges: DataFrame) -> DataFrame:
    """One row: graph, nodes, edges (distinct, directed), density, mean_degree, components (weak), loops, reciprocal edges."""
    links = settle(edges.select("src", "dst").distinct())
    nodes = links.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    parts = connected_components(links)
    joined = parts.agg(F.countDistinct("component").alias("c"), F.count("*").alias("k"))
    back = links.where("src <> dst").join(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_semi")
    n, m = F.col("nodes"), F.col("edges")
    return (
        nodes.agg(F.count("*").alias("nodes"))
        .crossJoin(links.agg(F.count("*").alias("edges"), F.count_if(F.col("src") == F.col("dst")).alias("loops")))  # one row each
        .crossJoin(joined)
        .crossJoin(back.agg(F.count("*").alias("reciprocal")))
        .select(
            F.lit(name).alias("graph"), n, m, F.when(n > 1, m / (n * (n - 1))).otherwise(0.0).alias("density"), F.when(n > 0, 2 * m / n).otherwise(0.0).alias("mean_degree"),
            (F.col("c") + n - F.col("k")).alias("components"), "loops", "reciprocal",
        )
    )
