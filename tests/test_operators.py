from collections import defaultdict

import hashlib

from pyspark.sql import functions as F

from corvid.functions import ids, scores
from corvid.operators import graph as G
from corvid.operators import kernels as K
from corvid.operators import relational as R
from corvid.operators.components import connected_components
from corvid.plans import relational


def edges(spark, pairs, weight=1):
    return spark.createDataFrame([(a, b, weight) for a, b in pairs], "src long, dst long, weight long")


def test_band_join_widths_agree(spark):
    spans = spark.createDataFrame([("f", 1, 5), ("f", 10, None), ("g", 3, 30), ("h", 7, 2)], "path string, start int, end int")
    points = spark.createDataFrame([("f", i) for i in range(1, 12)] + [("g", 30), ("g", 31), ("h", 5)], "path string, line int")
    plain = R.band_join(spans, points, ["path"], "start", "end", "line", how="inner").select("l.path", "start", "line")
    bands = R.band_join(spans, points, ["path"], "start", "end", "line", width=4, how="inner").select("l.path", "start", "line")
    assert sorted(plain.collect()) == sorted(bands.collect()) and plain.count() == 7
    left = R.band_join(spans, points, ["path"], "start", "end", "line").groupBy("l.path", "start").agg(F.count("r.line").alias("n"))
    assert {(r["path"], r["start"]): r["n"] for r in left.collect()} == {("f", 1): 5, ("f", 10): 1, ("g", 3): 1, ("h", 7): 0}


def test_clamp_limit():
    assert R.clamp_limit(None) == (50, []) and R.clamp_limit(-1) == (0, ["limit_invalid"]) and R.clamp_limit(501) == (500, ["limit_clamped"])


def test_components_chain_star_and_empty(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 3)]
    df = spark.createDataFrame(chain, "src long, dst long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}
    assert connected_components(df.where("false")).count() == 0


def test_strong_components_and_layers(spark):
    e = edges(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 6), (5, 7)])
    got = {r["node"]: (r["component"], r["layer"]) for r in G.simple_layers(e.where("src <> dst")).collect()}
    assert got == {1: (1, 0), 2: (1, 0), 3: (1, 0), 4: (4, 1), 5: (4, 1), 7: (7, 2)}


def test_core_numbers(spark):
    got = {r["node"]: r["core"] for r in G.core_numbers(edges(spark, [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5)])).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 1, 5: 1}


def test_betweenness_of_a_path(spark):
    got = {r["node"]: round(r["betweenness"], 6) for r in K.betweenness(edges(spark, [(1, 2), (2, 3), (3, 4)])).collect()}
    assert got == {1: 0.0, 2: round(2 / 6, 6), 3: round(2 / 6, 6), 4: 0.0}


def test_articulation_and_bridges(spark):
    e = edges(spark, [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (5, 6), (4, 6)]).withColumn("graph", F.lit("g"))
    got = K.articulation(e).collect()
    assert {r["node"] for r in got if r["is_articulation"]} == {3, 4} and {r["node"] for r in got if r["is_bridge_end"]} == {3, 4}


def test_dominance_of_a_diamond(spark):
    e = spark.createDataFrame([(1, 0, 1), (1, 0, 2), (1, 1, 3), (1, 2, 3), (1, 3, 4), (1, 9, 3)], "graph long, src long, dst long")
    got = {r["node"]: (r["idom"], r["depth"], r["distance"]) for r in K.dominance(e).collect()}
    assert got == {0: (0, 0, 0), 1: (0, 1, 1), 2: (0, 1, 1), 3: (0, 1, 2), 4: (3, 2, 3), 9: (None, None, None)}


def test_dominance_of_many_equal_graphs(spark, monkeypatch):
    """Many graphs in a batch, of few different edge lists, with and without room to keep them; repeated edges and order don't matter."""
    shapes = [[(0, 1), (1, 2), (0, 2)], [(0, 1), (1, 2)], [(0, 1), (2, 1), (5, 6)]]
    rows = [(g, *p) for g in range(60) for p in shapes[g % 3] + shapes[g % 3][:1]]
    e = spark.createDataFrame(rows, "graph long, src int, dst int").repartition(5)
    wants = [{(0, 0, 0, 0), (1, 0, 1, 1), (2, 0, 1, 1)}, {(0, 0, 0, 0), (1, 0, 1, 1), (2, 1, 2, 2)}, {(0, 0, 0, 0), (1, 0, 1, 1), (2, None, None, None), (5, None, None, None), (6, None, None, None)}]
    for room in (K.KEPT_EDGES, 0):
        monkeypatch.setattr(K, "KEPT_EDGES", room)
        got = defaultdict(set)
        for r in K.dominance(e).collect():
            got[r["graph"]].add((r["node"], r["idom"], r["depth"], r["distance"]))
        assert got == {g: wants[g % 3] for g in range(60)}


def test_label_propagation_two_cliques(spark):
    e = edges(spark, [(1, 2), (2, 3), (1, 3), (4, 5), (5, 6), (4, 6), (3, 4)], 1).withColumn("graph", F.lit("g"))
    got = {r["node"]: r["label"] for r in K.label_propagation(e).collect()}
    assert got[1] == got[2] and got[5] == got[6]


def test_ids(spark):
    row = spark.createDataFrame([("r", "c", "python", "a/b.py", "function", "a.b.f", 3, 9), ("r", "c", "python", "a/b.py", "function", "a.b.f", 3, None)], "r string, c string, l string, p string, k string, q string, s int, e int")
    got = row.select(ids.goid(*[F.col(x) for x in "rclpkqse"]).alias("g"), ids.urn(F.col("r"), F.col("p"), F.col("l"), F.col("k"), F.col("q"), F.col("s"), F.col("e")).alias("u"), ids.module_name(F.col("p")).alias("m")).collect()
    want = int.from_bytes(hashlib.blake2b(b"r:c:python:a/b.py:function:a.b.f:3:9", digest_size=16).digest(), "big") % (10**38 - 1)
    assert int(got[0]["g"]) == want and got[0]["u"] == "goid:r/a/b.py#python:function:a.b.f?s=3&e=9" and got[1]["u"].endswith("?s=3") and got[0]["m"] == "a.b"


def test_scores(spark):
    one = spark.range(1)
    got = one.select(
        scores.risk(F.lit(None).cast("double"), F.lit("high"), F.lit(True), F.lit(1.0)).alias("r"), scores.risk_level(F.lit(0.4)).alias("l"),
        scores.importance(F.lit(None).cast("double"), F.lit(0.5)).alias("i"), scores.importance(F.lit(None).cast("double")).alias("n"),
        scores.block_index(F.lit("f:block12")).alias("b"), scores.tags_of(F.lit("no json")).alias("t"), scores.stability(F.lit(None).cast("int"), F.lit(0.0), F.lit(1)).alias("s"),
    ).first()
    assert (round(got["r"], 6), got["l"], got["i"], got["n"], got["b"], got["t"], got["s"]) == (1.1, "medium", 0.5, None, 12, ["no json"], "unknown")


def test_ties_of_divided_values_are_rounded_away_from_zero(spark):
    got = spark.range(1).select(F.lit(3117.0).alias("changed"), F.lit(16).alias("commits")).select(scores.rounded(scores.churn(F.col("changed"), F.lit(0), F.col("commits") * 20), 6)).first()[0]
    assert got == 0.974063  # 3117 / 320 / 10 is 0.9740625
    values = spark.createDataFrame([(-0.25,), (0.25,), (None,)], "v double").select(scores.rounded(F.col("v"), 1)).collect()
    assert [r[0] for r in values] == [-0.3, 0.3, None]


def test_old_and_hot_customers_are_those_of_the_sql(spark, tmp_path):
    """Five small orders, the last of them 20 to 400 days before 1999 or of no date: the SQL's window is 90 days."""
    import datetime

    import duckdb

    days = (20, 31, 90, 91, 200, 365, 366, 400)
    rows = [(10 * c + k, c, price, datetime.datetime(1999, 1, 1) - datetime.timedelta(days=day + 30 * k)) for c, (day, price) in enumerate((d, p) for d in days for p in (9000.0, 300000.0)) for k in range(5)]
    rows += [(1000 + 10 * c + k, 100 + c, price, None) for c, (n, price) in enumerate(((1, 9000.0), (1, 60000.0), (1, 300000.0), (5, 9000.0))) for k in range(n)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    got = {tuple(r) for r in relational.churn_stability(spark, str(tmp_path)).collect()}
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
        want = set(db.execute(relational.ORACLES["churn_stability"]).fetchall())
    assert got == want and sum(r[2] == "legacy_hot" for r in want) == 5
