"""Scores and buckets as column expressions. The weights and thresholds are fixed values of the measured quantities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """value times 10^digits, rounded half away from zero and divided again, as SQL engines round binary fractions. F.round rounds the shortest
    decimal form, and the two part where a tie such as 0.9740625 came out of divisions as a value just below it."""
    return F.round(value * 10.0**digits) / 10.0**digits


def hotspot(commits: Column, authors: Column, churn: Column, complexity: Column) -> Column:
    cx = F.log1p(F.greatest(complexity.cast("double"), F.lit(0.0)) + 1)
    return 0.4 * F.log1p(commits) + 0.3 * F.log1p(authors) + 0.2 * F.log1p(churn) + 0.1 * cx


def risk(coverage: Column, level: Column, has_errors: Column, hotspot_score: Column) -> Column:
    """Missing coverage counts as none."""
    bucket = F.when(level == "high", 0.4).when(level == "medium", 0.2).otherwise(0.0)
    errors = F.when(has_errors, 0.2).otherwise(0.0)
    hot = F.when(hotspot_score > 0, 0.1).otherwise(0.0)
    return F.coalesce(0.4 * (F.lit(1.0) - coverage), F.lit(0.4)) + bucket + errors + hot


def risk_level(score: Column) -> Column:
    return F.when(score >= 0.7, "high").when(score >= 0.4, "medium").otherwise("low")


def complexity_bucket(complexity: Column) -> Column:
    return F.when(complexity <= 5, "low").when(complexity <= 10, "medium").otherwise("high")


def churn(added: Column, deleted: Column, loc: Column) -> Column:
    return F.least((added + deleted) / F.greatest(loc.cast("double"), F.lit(1.0)) / 10, F.lit(1.0))


def stability(age_days: Column, churn_score: Column, commits: Column, window_days: int = 365) -> Column:
    """In this order: no age; new and hot; neither new nor hot with few commits; churning; old and hot; else stable."""
    hot = (churn_score >= 0.5) | (commits >= 5)
    new = age_days <= 30
    return (
        F.when(age_days.isNull(), F.when(churn_score > 0, "new_hot").otherwise("unknown"))
        .when(new & hot, "new_hot")
        .when(~new & ~hot & (commits <= 2), "stable")
        .when(churn_score >= 0.2, "churning")
        .when((age_days > window_days) & hot, "legacy_hot")
        .otherwise("stable")
    )


def flakiness(flaky: Column, xfail: Column, network: Column, heavy: Column, filesystem: Column, slow: Column) -> Column:
    parts = ((flaky, 0.6), (xfail, 0.2), (network, 0.15), (heavy, 0.1), (filesystem, 0.05), (slow, 0.1))
    total = F.lit(0.0)
    for flag, weight in parts:
        total = total + F.when(flag, weight).otherwise(0.0)
    return F.least(total, F.lit(1.0))


def importance(*shares: Column) -> Column:
    """The mean of those shares that are there, 1 at most; null if none is."""
    known = F.filter(F.array(*shares), lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(known) > 0, F.least(total / F.size(known), F.lit(1.0)))


def purity_confidence(parsed: Column, unresolved: Column) -> Column:
    return F.when(~parsed, 0.0).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - F.least(0.1 * unresolved, F.lit(0.7))))


def dependency_risk(severity: Column, mode: Column, calls: Column) -> Column:
    """The severity if set; writing is high; many calls or reading medium; else low."""
    return F.coalesce(severity, F.when(mode.isin("admin", "write"), "high").when((calls > 10) | (mode == "read"), "medium").otherwise("low"))


def test_status(total: Column, failing: Column, passing: Column) -> Column:
    return F.when(F.coalesce(total, F.lit(0)) == 0, "untested").when(failing > 0, "some_failing").when(passing == total, "all_passing").otherwise("unknown")


def block_index(block_id: Column) -> Column:
    """The integer after the last `block`, null if there is none."""
    return F.when(F.contains(block_id, F.lit("block")), F.substring_index(block_id, "block", -1).try_cast("int"))


def tags_of(json_text: Column) -> Column:
    """A JSON list of strings, or what is no list as a list of itself; null as no tags."""
    return F.coalesce(F.from_json(json_text, "array<string>"), F.when(json_text.isNotNull(), F.array(json_text)), F.array().cast("array<string>"))


def glob_pattern(glob: str) -> str:
    """A regular expression for rlike with the meaning of a shell glob (*, ?, [..])."""
    import fnmatch

    return fnmatch.translate(glob)
