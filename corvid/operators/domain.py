"""Tables and views of code analysis, composed of the generic operators. Every function takes and returns DataFrames; all
tables carry `repo` and `commit`, and joins on them keep snapshots apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.functions import scores
from corvid.functions.ids import subsystem_id
from corvid.operators import relational as R

SNAPSHOT = ["repo", "commit"]
BAND = 256  # lines; a long file is many join keys


def function_coverage(functions: DataFrame, lines: DataFrame) -> DataFrame:
    """functions(repo, commit, path, function_id, start_line, end_line) with executable and covered lines, their ratio and
    the reason where a function is not tested; lines(repo, commit, path, line, is_executable, is_covered)."""
    joined = R.band_join(functions, lines, [*SNAPSHOT, "path"], "start_line", "end_line", "line", BAND)
    runs, hit = F.col("r.is_executable"), F.col("r.is_covered")
    out = joined.groupBy("l.repo", "l.commit", "l.path", "l.function_id").agg(F.count_if(runs).alias("executable_lines"), F.count_if(runs & hit).alias("covered_lines"))
    reason = F.when(F.col("executable_lines") == 0, "no_executable_code").when(F.col("covered_lines") == 0, "no_tests").otherwise("")
    return out.withColumn("coverage_ratio", R.ratio(F.col("covered_lines"), F.col("executable_lines"))).withColumn("untested_reason", reason)


def test_edges(functions: DataFrame, contexts: DataFrame) -> DataFrame:
    """repo, commit, test_id, function_id, covered_lines, coverage_ratio: contexts(repo, commit, path, line, test_id) that lie in functions."""
    met = R.band_join(functions, contexts, [*SNAPSHOT, "path"], "start_line", "end_line", "line", BAND, "inner")
    size = F.coalesce(F.col("l.end_line"), F.col("l.start_line")) - F.col("l.start_line") + 1
    counted = met.groupBy("l.repo", "l.commit", "r.test_id", "l.function_id").agg(F.countDistinct("r.line").alias("covered_lines"), F.max(size).alias("__size"))
    return counted.withColumn("coverage_ratio", R.ratio(F.col("covered_lines"), F.col("__size"))).drop("__size")


def function_tests(edges: DataFrame, catalog: DataFrame) -> DataFrame:
    """function_id, tests, failing and passing tests, the dominant status (ties to the first) and the rolled-up one."""
    joined = edges.join(catalog.select(*SNAPSHOT, "test_id", "status"), [*SNAPSHOT, "test_id"], "left")
    which = lambda s: F.countDistinct(F.when(F.col("status").isin(*s), F.col("test_id")))
    counts = joined.groupBy(*SNAPSHOT, "function_id").agg(F.countDistinct("test_id").alias("tests"), which(("failed", "error")).alias("failing"), which(("passed",)).alias("passing"))
    dominant = R.mode_per_group(joined, [*SNAPSHOT, "function_id"], "status", "dominant_status")
    return counts.join(dominant, [*SNAPSHOT, "function_id"], "left").withColumn("test_status", scores.test_status(F.col("tests"), F.col("failing"), F.col("passing")))


def hotspots(files: DataFrame, churn: DataFrame) -> DataFrame:
    """files(path, complexity) with the hotspot score of their history churn(rel_path, commits, authors, added, deleted)."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    joined = files.join(churn.withColumnRenamed("rel_path", "path"), "path", "left")
    return joined.withColumn("score", scores.hotspot(zero("commits"), zero("authors"), zero("added") + zero("deleted"), zero("complexity")))


def risk_factors(functions: DataFrame, coverage: DataFrame, tests: DataFrame, diagnostics: DataFrame, spots: DataFrame) -> DataFrame:
    """functions(repo, commit, path, function_id, complexity) with coverage, tests, static errors, hotspot, risk and its parts."""
    key = [*SNAPSHOT, "function_id"]
    wide = (
        functions.join(coverage.select(*key, "coverage_ratio", "untested_reason"), key, "left")
        .join(tests.select(*key, "tests", "test_status"), key, "left")
        .join(diagnostics.groupBy("path").agg(F.sum("errors").alias("errors")), "path", "left")
        .join(spots.select("path", F.col("score").alias("hotspot")), "path", "left")
    )
    bucket = scores.complexity_bucket(F.col("complexity"))
    has_errors, hot = F.coalesce(F.col("errors") > 0, F.lit(False)), F.coalesce("hotspot", F.lit(0.0))
    scored = wide.withColumn("complexity_bucket", bucket).withColumn("risk_score", scores.risk(F.col("coverage_ratio"), bucket, has_errors, hot))
    return scored.withColumn("risk_level", scores.risk_level(F.col("risk_score"))).withColumn("test_status", F.coalesce("test_status", F.lit("untested")))


def file_profile(risk: DataFrame) -> DataFrame:
    return risk.groupBy(*SNAPSHOT, "path").agg(
        F.count("*").alias("functions"), F.avg("risk_score").alias("mean_risk"), F.max("risk_score").alias("max_risk"), F.sum("complexity").alias("complexity"),
        *[F.count_if(F.col("risk_level") == x).alias(f"{x}_risk_functions") for x in ("high", "medium", "low")],
        F.count_if(F.col("test_status") == "untested").alias("untested_functions"),
    )


def module_profile(files: DataFrame, modules: DataFrame, imports: DataFrame) -> DataFrame:
    """Files rolled up to modules(repo, commit, path, module, tags) with fan counts of imports(src, dst)."""
    fan = R.fan_counts(imports, "src", "dst").withColumnRenamed("node", "module")
    rolled = modules.join(files, [*SNAPSHOT, "path"], "left").groupBy(*SNAPSHOT, "module").agg(
        F.count("*").alias("files"), F.coalesce(F.sum("functions"), F.lit(0)).alias("functions"), F.max("max_risk").alias("max_risk"), F.coalesce(F.sum("high_risk_functions"), F.lit(0)).alias("high_risk_functions")
    )
    return rolled.join(fan, "module", "left").na.fill(0, ["fan_in", "fan_out", "calls_in", "calls_out"])


def call_graph_enriched(calls: DataFrame, functions: DataFrame, risk: DataFrame) -> DataFrame:
    """Each call edge with names and risk of both ends; a callee that is not known leaves nulls."""
    facts = functions.select("function_id", "qualname", "path").join(risk.select("function_id", "risk_level", "risk_score"), "function_id", "left")

    def end(role: str) -> DataFrame:
        return facts.select(*[F.col(c).alias(f"{role}_{c}" if c != "function_id" else f"{role}_id") for c in facts.columns])

    return calls.join(end("caller"), "caller_id", "left").join(end("callee"), "callee_id", "left")


def test_profile(tests: DataFrame, edges: DataFrame, risk: DataFrame, slow_ms: float = 2000.0) -> DataFrame:
    """tests(repo, commit, test_id, status, duration_ms, markers, uses_*) with reach, flakiness and importance; maxima are those of the snapshot."""
    reach = edges.join(risk.select(*SNAPSHOT, "function_id", "risk_score"), [*SNAPSHOT, "function_id"], "left").groupBy(*SNAPSHOT, "test_id").agg(
        F.countDistinct("function_id").alias("functions_covered"), F.sum("coverage_ratio").alias("weighted_degree"), F.sum("risk_score").alias("risk_covered")
    )
    most = reach.groupBy(*SNAPSHOT).agg(*[F.max(c).alias(f"max_{c}") for c in ("functions_covered", "weighted_degree", "risk_covered")])
    wide = tests.join(reach, [*SNAPSHOT, "test_id"], "left").join(most, SNAPSHOT, "left")
    mark = lambda name: F.exists("markers", lambda m: F.contains(F.lower(m), F.lit(name)))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    flaky = scores.flakiness(mark("flaky"), F.col("status").isin("xfail", "xpass"), flag("uses_network"), flag("uses_db") | flag("uses_subprocess"), flag("uses_fs"), F.col("duration_ms") > slow_ms)
    share = [R.ratio(F.col(c), F.col(f"max_{c}")) for c in ("functions_covered", "weighted_degree", "risk_covered")]
    return wide.withColumn("flakiness_score", flaky).withColumn("importance_score", scores.importance(*share)).drop("max_functions_covered", "max_weighted_degree", "max_risk_covered")


def affinity_edges(imports: DataFrame, symbols: DataFrame, config: DataFrame, weights: tuple[float, float, float] = (1.0, 0.5, 0.3)) -> DataFrame:
    """src < dst, weight of modules: imports and shared symbols by fixed weights, and for each configuration key of k modules
    the third weight over k - 1 for each pair of them."""
    sizes = config.groupBy("key").agg(F.countDistinct("module").alias("k")).where("k > 1")
    uses = config.select("key", "module").distinct().join(sizes, "key")
    pairs = uses.select("key", "k", F.col("module").alias("src")).join(uses.select("key", F.col("module").alias("dst")), "key").where("src < dst")
    edge = lambda df, w: df.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), w.alias("weight")).where("src <> dst")
    parts = [edge(imports, F.lit(weights[0])), edge(symbols, F.lit(weights[1])), edge(pairs, F.lit(weights[2]) / (F.col("k") - 1))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def subsystems(labels: DataFrame, modules: DataFrame) -> DataFrame:
    """subsystem_id, name, modules of each label(repo, commit, module, label); the name is the most frequent first tag, else the label."""
    tagged = labels.join(modules.select(*SNAPSHOT, "module", F.get("tags", F.lit(0)).alias("tag")), [*SNAPSHOT, "module"], "left")
    names = R.mode_per_group(tagged, [*SNAPSHOT, "label"], "tag", "tag_name")
    rows = labels.groupBy(*SNAPSHOT, "label").agg(F.array_sort(F.collect_set("module")).alias("modules"))
    return rows.join(names, [*SNAPSHOT, "label"], "left").select(
        *SNAPSHOT, subsystem_id(F.col("repo"), F.col("modules")).alias("subsystem_id"), F.coalesce("tag_name", "label").alias("name"), "modules", F.size("modules").alias("module_count")
    )


def subsystem_agreement(membership: DataFrame, communities: DataFrame) -> DataFrame:
    """subsystem_id, modules, disagreeing modules and 1 - their share: a module disagrees if its community is not its subsystem's most frequent one."""
    joined = membership.join(communities, "module", "left")
    main = R.mode_per_group(joined, ["subsystem_id"], "community", "main")
    rows = joined.join(main, "subsystem_id", "left").groupBy("subsystem_id").agg(
        F.count("*").alias("modules"), F.count_if(F.col("community").isNotNull() & (F.col("community") != F.col("main"))).alias("disagreements")
    )
    return rows.withColumn("agreement", 1 - R.ratio(F.col("disagreements"), F.col("modules")))


def function_history(functions: DataFrame, hunks: DataFrame, now: Column, window_days: int = 365) -> DataFrame:
    """functions(path, function_id, start_line, end_line) with commits, authors, changed lines, churn and stability from
    hunks(path, commit_id, author, ts, start, end): each hunk counts the lines that it shares with the function. Both are dealt to the
    bands of lines that they touch, and a pair counts in the first one that they share."""
    band = lambda c: F.floor(F.col(c) / BAND)
    f = functions.select("path", "function_id", "start_line", "end_line", F.explode(F.sequence(band("start_line"), F.greatest(band("start_line"), band("end_line")))).alias("__band"))
    h = hunks.where("start <= end").select("path", "commit_id", "author", "ts", "start", "end", F.explode(F.sequence(band("start"), band("end"))).alias("__band"))
    shared = R.overlap(F.col("start"), F.col("end"), F.col("start_line"), F.col("end_line"))
    met = f.join(h, ["path", "__band"]).where((F.col("start") <= F.col("end_line")) & (F.col("end") >= F.col("start_line")) & (F.col("__band") == F.floor(F.greatest("start", "start_line") / BAND)))
    counted = met.groupBy("path", "function_id", "start_line", "end_line").agg(
        F.countDistinct("commit_id").alias("commits"), F.countDistinct("author").alias("authors"), F.sum(shared).alias("changed_lines"),
        F.min_by("commit_id", F.struct("ts", "commit_id")).alias("first_commit"), F.max_by("commit_id", F.struct("ts", "commit_id")).alias("last_commit"), F.min("ts").alias("first_ts"),
    )
    key = ["path", "function_id", "start_line", "end_line"]
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key]
    joined = functions.select(*key).alias("a").join(counted.alias("b"), same[0] & same[1] & same[2] & same[3], "left")
    zero = lambda c: F.coalesce(F.col(f"b.{c}"), F.lit(0).cast("long")).alias(c)
    rows = joined.select(*[F.col(f"a.{c}").alias(c) for c in key], zero("commits"), zero("authors"), zero("changed_lines"), "b.first_commit", "b.last_commit", "b.first_ts")
    age = F.datediff(now, F.col("first_ts"))
    score = scores.churn(F.col("changed_lines"), F.lit(0), F.col("end_line") - F.col("start_line") + 1)
    return rows.withColumn("age_days", age).withColumn("churn_score", score).withColumn("stability", scores.stability(age, score, F.col("commits"), window_days))


def tags_for_paths(files: DataFrame, rules: list[dict]) -> DataFrame:
    """files(path, ...) with tags: a rule's exact matches win; else any include and no exclude; sorted, each once."""
    found = []
    for rule in rules:
        hit = lambda name: [F.col("path").rlike(scores.glob_pattern(g)) for g in rule.get(name, ())]  # noqa: B023, E731
        any_of = lambda cs: F.lit(False) if not cs else F.exists(F.array(*cs), lambda x: x)
        exact = F.col("path").isin(*rule["matches"]) if rule.get("matches") else F.lit(False)
        found.append(F.when(exact | (any_of(hit("includes")) & ~any_of(hit("excludes"))), F.lit(rule["tag"])))
    kept = F.filter(F.array(*found), lambda t: t.isNotNull()) if found else F.array().cast("array<string>")
    return files.withColumn("tags", F.array_sort(F.array_distinct(kept)))


def incremental_or_full(total: int, changed: int, deleted: int, least: int = 20, share: float = 0.7) -> str:
    """Small trees and small changes are taken file by file; otherwise everything is read again."""
    return "full" if total >= least and ((changed + deleted) / total >= share or deleted / total >= share) else "incremental"
