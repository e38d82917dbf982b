"""Copies of one page are no evidence of a template."""

from corvid.llm import html_extract


def test_mirrored_pages_keep_their_text(spark):
    body = "".join(f"<p>paragraph {i} of the story</p>" for i in range(10))
    pages = [(i, "http://mirror/", f"<body>{body}</body>") for i in range(1000)]
    pages += [(2000 + i, "http://one/", "<body><div class=b>one story</div></body>") for i in range(12)]
    pages += [(3000 + i, f"http://site/{i}", f"<body><div class=a>Always the same</div><div class=b>story {i % 20}</div></body>") for i in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html_extract.extract_text(df).collect()}
    assert len(got) == len(pages)
    assert {got[i] for i in range(1000)} == {" ".join(f"paragraph {i} of the story" for i in range(10))}
    assert {got[2000 + i] for i in range(12)} == {"one story"}
    assert all(got[3000 + i] == f"story {i % 20}" for i in range(60))
