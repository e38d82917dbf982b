"""Relational operators that code-analysis tables need, over any tables: each is a plain DataFrame expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.session import settle


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is 0 or null."""
    return F.when(whole != 0, part.cast("double") / whole)


def band_join(left: DataFrame, right: DataFrame, on: Sequence[str], start: str, end: str, point: str, width: int = 0, how: str = "left") -> DataFrame:
    """left spans joined to right points with start <= point <= coalesce(end, start) and equal `on` columns.

    With width > 0 both sides get the number of the band that a point falls into (a span: every band it touches), so that
    few `on` values don't make few, large join keys. Rows of left without a point stay under how='left': with bands, the
    pairs are found first and then joined to all spans by a number of each row.
    """
    if width and how == "left":
        rows = left.withColumn("__span", F.monotonically_increasing_id())
        rows = settle(rows)  # a number that another run of the plan may not change
        pairs = band_join(rows, right, on, start, end, point, width, "inner")
        held = pairs.select(F.col("l.__span").alias("__span"), *[F.col(f"r.{c}").alias(f"__r_{c}") for c in right.columns])
        wide = rows.join(held, "__span", "left")
        return wide.select(F.struct(*left.columns).alias("l"), F.struct(*[F.col(f"__r_{c}").alias(c) for c in right.columns]).alias("r"))

    stop = F.coalesce(F.col(f"l.{end}"), F.col(f"l.{start}"))
    inside = (F.col(f"r.{point}") >= F.col(f"l.{start}")) & (F.col(f"r.{point}") <= stop)
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in on]
    if not width or how != "inner":
        cond = inside
        for c in same:
            cond = cond & c
        return left.alias("l").join(right.alias("r"), cond, how)
    first, last = F.floor(F.col(start) / width), F.floor(F.coalesce(F.col(end), F.col(start)) / width)
    spans = left.where(F.coalesce(F.col(end), F.col(start)) >= F.col(start)).withColumn("__band", F.explode(F.sequence(first, last)))
    points = right.withColumn("__band", F.floor(F.col(point) / width))
    cond = inside & (F.col("l.__band") == F.col("r.__band"))
    for c in same:
        cond = cond & c
    return spans.alias("l").join(points.alias("r"), cond, "inner")


def interval_join(left: DataFrame, right: DataFrame, a: tuple[str, str], b: tuple[str, str], width: int) -> DataFrame:
    """Pairs of rows whose closed ranges (columns a of left, b of right) meet, each pair once: both sides are dealt to the
    bands of `width` that they touch, and a pair counts in the first band that both touch."""
    bands = lambda c: F.explode(F.sequence(F.floor(F.col(c[0]) / width), F.floor(F.col(c[1]) / width)))
    spans = left.where(F.col(a[0]) <= F.col(a[1])).withColumn("__band", bands(a))
    others = right.where(F.col(b[0]) <= F.col(b[1])).withColumn("__band", bands(b))
    first = F.floor(F.greatest(F.col(a[0]), F.col(b[0])) / width)
    met = spans.join(others, "__band").where((F.col(a[0]) <= F.col(b[1])) & (F.col(a[1]) >= F.col(b[0])) & (F.col("__band") == first))
    return met.drop("__band")


def overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Lines that two closed ranges share, 0 if none; null where an end is null (greatest and least skip nulls)."""
    known = start_a.isNotNull() & end_a.isNotNull() & start_b.isNotNull() & end_b.isNotNull()
    return F.when(known, F.greatest(F.lit(0), F.least(end_a, end_b) - F.greatest(start_a, start_b) + 1))


def mode_per_group(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """The most frequent value of a column for each group, ties to the smallest; nulls don't count."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).count()
    best = F.min(F.struct((-F.col("count")).alias("n"), F.col(column).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.v").alias(name))


def ordered_structs(df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """For each group its rows as an array of structs, sorted by the fields in turn."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__rank = 1").drop("__rank")


def change_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """keys and change (added, deleted, modified, same) between two states, by a hash of the values."""
    digest = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(v).cast("string"), F.lit("\x00")) for v in values]), 256)
    old = before.select(*keys, digest.alias("__old"))
    new = after.select(*keys, digest.alias("__new"))
    kind = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "deleted").when(F.col("__old") != F.col("__new"), "modified")
    return old.join(new, list(keys), "full_outer").select(*keys, kind.otherwise("same").alias("change"))


def share_of_total(df: DataFrame, keys: Sequence[str], part: str, amount: str, least: float) -> DataFrame:
    """keys, part, amount, share of the keys' total and whether it is at least `least`. Two grouped sums, no window: a hot
    key is summed on the map side."""
    parts = df.groupBy(*keys, part).agg(F.sum(amount).alias("amount"))
    totals = parts.groupBy(*keys).agg(F.sum("amount").alias("__total"))
    share = ratio(F.col("amount"), F.col("__total"))
    return parts.join(totals, list(keys)).select(*keys, part, "amount", share.alias("share"), (share >= least).alias("is_primary"))


def fan_counts(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """node, fan_out, fan_in (distinct), calls_out, calls_in (raw) of every node on an edge, 0 where it has none."""
    out = edges.groupBy(F.col(src).alias("node")).agg(F.countDistinct(dst).alias("fan_out"), F.count("*").alias("calls_out"))
    into = edges.groupBy(F.col(dst).alias("node")).agg(F.countDistinct(src).alias("fan_in"), F.count("*").alias("calls_in"))
    return out.join(into, "node", "full_outer").na.fill(0, ["fan_out", "fan_in", "calls_out", "calls_in"])


def pivot_counts(df: DataFrame, keys: Sequence[str], column: str, values: dict[str, str]) -> DataFrame:
    """For each group a count of rows for each listed value, in one pass."""
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(column) == v, 1).otherwise(0)).alias(name) for name, v in values.items()])


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows; order must end in a unique tie-breaker for a stable answer."""
    return df.orderBy(*order).limit(k)


def page(df: DataFrame, limit: int, offset: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def clamp_limit(limit: int | None, default: int = 50, most: int = 500) -> tuple[int, list[str]]:
    """The limit to apply and messages: a missing one is the default, a large one is cut, a negative one refused."""
    if limit is None:
        return default, []
    if limit < 0:
        return 0, ["limit_invalid"]
    return (most, ["limit_clamped"]) if limit > most else (limit, [])


def exclude(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)
