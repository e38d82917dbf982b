"""Main text of web pages by a site style tree.

Pages of a host are merged: elements with the same chain of (tag, class) names from the root are one node of the host's
tree. A node's presentation importance is the entropy of its child styles over the node's occurrences, its content
importance that of its own texts, both relative to the largest entropy possible; with l child styles and a decay g they
are combined as (1 - g^l) presentation + g^l content. What m occurrences say is shrunk towards 1, as if PRIOR more had been
of full importance, so that a node met a few times is judged like any other, only with less weight. Texts of nodes that
look alike on all pages (low importance) are removed from each page of the host.

Priors settle what entropy can't. Elements that by tag or role are menus, headers, footers, sidebars, forms or scripts are
never text. Where a page has an `article` or `main`, its text is there, and headings, paragraphs, lists and tables in it
stay whatever the tree says, so that many copies of one article don't erase it; other boxes in it are the tree's to judge.
Class names that say so (NOISE_NAME) mark adverts, notices and comments whose texts differ from page to page, which no
entropy can tell from an article; `names=False` does without them.

Copies of a page count once for its host: equal pages say nothing on what its pages share.

The tree is never gathered: occurrences are counted for each task, host, node and value, then summed; the low nodes of a
host, a part of its template met on many of its pages, are joined to its pages, which are parsed a second time instead of
being stored.

Nulls: a null html is an empty page, with empty text; a null url belongs to the empty host. Repeated rows give equal
results, an empty table an empty one; other columns are ignored. A very long page is a batch of its own, parsed in one
pass. Ties can't occur: each node is judged alone. Unclosed, crossed and unknown tags close as browsers close them, roughly.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import bitmap_of, in_bitmap, join_skewed, small_batches
from corvid.llm.host_reputation import host_of
from corvid.session import settle

PRIOR = 4.0
MIN_IMPORTANCE = 0.3
DECAY = 0.9

# Element and class names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr img".split()
)
NOISE_TAGS = frozenset("head nav footer aside form button select option dialog menu svg object audio video canvas map".split())
NOISE_NAME = re.compile(
    r"^(?:ads?|adverts?|advertisement|adsbygoogle|ad[-_].*|.*[-_]ads?|banner|sponsor(?:ed)?|promo(?:tion)?|nav|navbar|navigation|menu|main-?menu|breadcrumbs?|"
    r"sidebar|side-?bar|aside|widget|footer|foot|header|masthead|site-?header|page-?header|site-?footer|page-?footer|cookies?(?:[-_].*)?|consent|notices?|alert|gdpr|popup|modal|overlay|"
    r"comments?|comment[-_].*|.*[-_]comments?|respond|disqus.*|replies|share|sharing|social|share[-_].*|social[-_].*|related|related[-_].*|recommended|newsletter|subscribe|signup|login|search|search-?form|pagination|pager|skip-?link)$",
    re.I,
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
MAIN_TAGS = frozenset(("article", "main"))
#: Boxes without a meaning of their own; in an article they may hold what the site adds to each.
BOXES = frozenset("div section span ul ol table center".split())
#: An opening tag closes an open one of these, up to the nearest of the bounds.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOUNDS = frozenset("ul ol dl table body article main section div".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def _code(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) >> 1


class _Node:
    __slots__ = ("tag", "path", "noise", "named", "main", "children", "own")

    def __init__(self, tag: str, path: str, noise: bool, named: bool, main: bool):
        self.tag, self.path, self.noise, self.named, self.main = tag, path, noise, named, main
        self.children: list[str] = []
        self.own: list[str] = []


def parse(page: str) -> tuple[list[tuple[str, str, str]], list[tuple[_Node, str]]]:
    """Elements outside noise as (path, child styles, own text), and blocks as (owner, text) in page order."""
    root = _Node("", "", False, False, False)
    stack, nodes, blocks = [root], [], []
    run: list[str] = []
    owner = root
    at, n = 0, len(page)
    raw_end: re.Match | None

    def flush() -> None:
        nonlocal run
        if run:
            text = _SPACE.sub(" ", _html.unescape("".join(run))).strip(" ")
            run = []
            if text:
                blocks.append((owner, text))

    def close(upto: int) -> None:
        while len(stack) > upto:
            node = stack.pop()
            if not node.noise:
                nodes.append((node.path, "|".join(node.children), "".join(node.own)))

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            node = stack[-1]
            if not node.noise:
                piece = page[at:lt]
                if not run:
                    owner = node
                run.append(piece)
                node.own.append(piece)
            at = lt
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?", "</>"), at):
            end = page.find(">", at)
            at = n if end < 0 else end + 1
            continue
        tag = _TAG.match(page, at) or _LOOSE_TAG.match(page, at)
        if not tag:
            node = stack[-1]
            if page.startswith("</", at) or re.match(r"<[a-zA-Z]", page[at : at + 2]):  # a tag that never ends
                break
            if not node.noise:
                if not run:
                    owner = node
                run.append("<")
            at += 1
            continue
        at = tag.end()
        name = tag[2].lower()
        if name not in INLINE:
            flush()
        if tag[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    close(k)
                    break
                if name in INLINE and stack[k].tag not in INLINE:
                    break
            continue
        if name not in INLINE:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p" or stack[k].tag in CLOSES.get(name, ()):
                    close(k)
                    if name not in CLOSES:
                        break
                elif stack[k].tag in BOUNDS:
                    break
        parent = stack[-1]
        names = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(tag[3])} if "=" in tag[3] else {}
        words = names.get("class", "").split()
        style = name + "".join("." + w for w in words)
        if not parent.children or parent.children[-1] != style:
            parent.children.append(style)
        if name in VOID:
            continue
        if name in RAW:
            raw_end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            at = n if raw_end is None else raw_end.end()
            continue
        if tag[3].endswith("/") and name not in ("p", "div", "b", "i", "span", "a"):
            continue
        noise = (
            parent.noise
            or name in NOISE_TAGS
            or (name == "header" and not parent.main)
            or names.get("role", "").lower() in NOISE_ROLES
        )
        labels = (*words, names.get("id", ""))
        named = parent.named or (name not in MAIN_TAGS and name not in ("html", "body") and any(NOISE_NAME.match(w) for w in labels if w))
        stack.append(_Node(name, f"{parent.path}/{style}", noise, named, parent.main or name in MAIN_TAGS or names.get("role", "").lower() == "main"))
    flush()
    close(0)
    return nodes, blocks


def _occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of (host, node, kind, value) for each batch: kind 0 child styles, 1 own text."""
    for pdf in batches:
        seen: Counter = Counter()
        for host, page in zip(pdf["host"], pdf["html"], strict=True):
            for path, styles, own in parse(page or "")[0]:
                node = _code(path)
                seen[host, node, 0, _code(styles)] += 1
                seen[host, node, 1, _code(_SPACE.sub(" ", own).strip(" "))] += 1
        yield pd.DataFrame([(*k, c) for k, c in seen.items()], columns=["host", "node", "kind", "value", "n"])


def distinct_pages(pages: DataFrame) -> DataFrame:
    """host, html of each different page of a host once. Only pages whose hash occurs more than once are shuffled, one
    of each task."""
    keyed = pages.select("host", F.coalesce("html", F.lit("")).alias("html")).withColumn("page", F.xxhash64("host", "html"))
    repeated = bitmap_of(settle(keyed.groupBy("page").agg(F.count("*").alias("n")).where("n > 1").select("page")), "page")
    marked = keyed.withColumn("__again", in_bitmap(repeated, "page"))
    once = marked.where("__again").groupBy("host", "page").agg(F.first("html").alias("html"))
    return marked.where("not __again").select("host", "html").unionByName(once.select("host", "html"))


def low_nodes(pages: DataFrame, prior: float = PRIOR, min_importance: float = MIN_IMPORTANCE, decay: float = DECAY) -> DataFrame:
    """host, low: the nodes of each host's tree that look alike on its pages."""
    counts = distinct_pages(pages).mapInPandas(_occurrences, "host string, node long, kind int, value long, n long")
    values = counts.groupBy("host", "node", "kind", "value").agg(F.sum("n").alias("n"))
    m = F.sum("n")
    entropy = F.when(m > 1, 1 - F.sum(F.col("n") * F.log("n")) / m / F.log(m)).otherwise(1.0)
    kinds = values.groupBy("host", "node", "kind").agg(entropy.alias("importance"), F.count("*").alias("l"), m.alias("m"))
    pick = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    share = F.pow(F.lit(decay), pick(0, "l"))
    nodes = kinds.groupBy("host", "node").agg(((1 - share) * pick(0, "importance") + share * pick(1, "importance")).alias("importance"), F.max("m").alias("m"))
    shrunk = (F.col("m") * F.col("importance") + prior) / (F.col("m") + prior)
    return nodes.where(shrunk < min_importance).groupBy("host").agg(F.collect_list("node").alias("low"))


def stays(owner: _Node, low: frozenset, has_main: bool, names: bool) -> bool:
    """Whether a block belongs to the main text."""
    if (names and owner.named) or (has_main and not owner.main):
        return False
    return (owner.main and owner.tag not in BOXES) or _code(owner.path) not in low


def _texts(names: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for page, nodes in zip(pdf["html"], pdf["low"], strict=True):
                blocks = parse(page or "")[1]
                has_main = any(owner.main and not (names and owner.named) for owner, _ in blocks)
                low = frozenset(() if nodes is None else nodes)
                texts.append(" ".join(text for owner, text in blocks if stays(owner, low, has_main, names)))
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts})

    return run


def extract_text(pages: DataFrame, names: bool = True) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages(page_id, url, html)."""
    small_batches(pages)
    placed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    low = settle(low_nodes(placed))
    return (
        join_skewed(placed, low, "host")
        .select(F.col("page_id").cast("string"), "url", "html", "low")  # as text: pandas has no null integers
        .mapInPandas(_texts(names), "page_id string, url string, text string")
        .withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType))
        .withColumn("n_chars", F.length("text").cast("long"))
    )


def op3_html_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


QUERIES = {"op3_html_style_tree": op3_html_style_tree}
