"""The style tree with and without lists of names: hosts whose class names say nothing, few pages, odd rows; a plain count."""

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from corvid.llm import html_extract

WORDS = random.Random(1)


def prose(n):
    return " ".join("".join(WORDS.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n))


def soup(menu, body, foot):
    return f'<html><body><div class="q7"><div class="z1">{menu}</div></div><div class="k3"><p>{body}</p><div class="w9">Share this now</div></div><span class="t2">{foot}</span></body></html>'


def test_names_that_say_nothing(spark):
    """No tag, role or name tells menus from texts here: only the tree does."""
    bodies = [prose(40) for _ in range(40)]
    rows = [(i, f"http://soup.example/{i}", soup("Home Products About", b, "All rights reserved")) for i, b in enumerate(bodies)]
    rows += [(100, "http://single.example/1", soup("Home", "one page only", "All rights reserved"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for names in (True, False):
        got = {r["page_id"]: r["text"] for r in html_extract.extract_text(df, names).collect()}
        assert all(got[i] == b for i, b in enumerate(bodies)), names
        assert got[100] == "Home one page only Share this now All rights reserved"  # nothing to compare it with


def test_pages_of_the_tables_need_no_names(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    with_names = {(r["page_id"], r["url"]): r["text"] for r in html_extract.extract_text(pages).collect()}
    without = {(r["page_id"], r["url"]): r["text"] for r in html_extract.extract_text(pages, names=False).collect()}
    assert with_names == without and all(with_names.values())


def test_low_nodes_against_a_plain_count(spark):
    rnd = random.Random(3)
    pages = []
    for i in range(60):
        host = f"h{i % 2}.example"
        boxes = "".join(f'<div class="c{k}">{rnd.choice(("same", "same", prose(2))) if k < 4 else prose(3)}</div>' for k in range(rnd.randrange(3, 8)))
        pages.append((i, f"http://{host}/{i}", f"<body>{boxes}<p>{prose(4)}</p></body>"))
    pages += [pages[0], (70, None, "<p>x</p>"), (71, "http://h0.example/n", None)]
    seen = defaultdict(Counter)
    for host, html in {((u or "").split("/")[2] if u else "", h or "") for _, u, h in pages}:
        for path, styles, own in html_extract.parse(html)[0]:
            seen[host, path, 0][styles] += 1
            seen[host, path, 1][" ".join(own.split())] += 1
    want = defaultdict(set)
    for host, path, kind in seen:
        if kind == 0:
            entropy = []
            for k in (0, 1):
                n = seen[host, path, k]
                m = sum(n.values())
                entropy.append(-sum(c / m * math.log(c / m) for c in n.values()) / math.log(m) if m > 1 else 1.0)
            decay = 0.9 ** len(seen[host, path, 0])
            if (m * ((1 - decay) * entropy[0] + decay * entropy[1]) + 4) / (m + 4) < 0.3:
                want[host].add(html_extract._code(path))
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", html_extract.host_of(F.col("url")))
    got = {r["host"]: set(r["low"]) for r in html_extract.low_nodes(df).collect()}
    assert got == dict(want) and sum(map(len, got.values())) >= 3


def test_odd_pages(spark):
    long = "<p>" + "word " * 200_000 + "</p>"
    rows = [(1, "http://a.b/", long), (1, "http://a.b/", long), (None, None, None), (2, "no scheme", "<p>a&amp;b\n c</p>"), (3, "http://a.b/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("x"), "low": F.lit(1), "text": F.lit("t"), "n_chars": F.lit(0)})
    got = sorted((str(r["page_id"]), r["n_chars"]) for r in html_extract.extract_text(df).collect())
    assert got == [("1", 999_999), ("1", 999_999), ("2", 5), ("3", 0), ("None", 0)]
    assert html_extract.extract_text(df.where("false")).count() == 0
