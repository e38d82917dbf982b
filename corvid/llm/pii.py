"""Personal data: fixed patterns, and identifiers found by bootstrapping the contexts in which those occur.

Base kinds (email, ip, card, phone) are found by regular expressions, as spans of code points. Their positions come from
the lengths of matches and of the pieces between them. The base spans are seeds of the method, and so are strings that have
the form of a credential (SECRET); each seed, and each other candidate (a word with a digit, or a value behind a key and a
sign), is an instance; what stands around it makes lexical patterns: two words before; one before and one after; the word
before and the signs between (`token = "`); the word before and the instance's character shape. On the graph of distinct
pattern-instance edges Spark alternates, for each kind, between scoring patterns (the mean score of their instances,
smoothed, with a least number of positive instances) and scoring instances (the noisy-or of their good patterns), and adds
new instances with a high score to those known, until a round finds nothing new. They, and the credential-like seeds that good patterns
reach, become spans of kind `ctx`: a lone string of that form is no find, one in a context of several is.

Only mentions are shuffled, never texts. Edges are made distinct before they are counted, and joins have their own
exchanges on both sides, so that adaptive execution can split a hot instance or pattern. Patterns see
CONTEXT_CHARS characters on each side, as far as the second match from there; instances may have any length.

Nulls: a null text is empty; a null id is carried. Repeated rows give equal results, and ties have no order to settle. An
empty table gives an empty result. A very long text is one row of work, in time in proportion to its length. `mask_pii`
carries all other columns, whatever their names; `find_pii` replaces columns named `base` or `spans`. DataFrame functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import join_skewed, let_in
from corvid.session import settle

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns, written so that no search is quadratic and no repetition recurses without bound: an email may
# start where a run of its characters starts or where the last match ended; a card is a whole run of 14 to 19 digits.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-](?:[A-Za-z0-9.-](?<!\.(?![A-Za-z0-9-])))*",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that a text must pass before its pattern is tried.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
SEPARATORS = r"\x20\x09-\x0D=:\"'(){}\[\]<>,;|"
CANDIDATE = rf"(?<![^{SEPARATORS}])[^{SEPARATORS}0-9]*+[0-9][^{SEPARATORS}]*+"
#: A value without a digit behind a word, a sign and perhaps a quotation mark.
VALUE = rf"(?<=[^{SEPARATORS}][=:]|[^{SEPARATORS}]\x20[=:]|[^{SEPARATORS}]\x20?[=:]\x20|[^{SEPARATORS}]\x20?[=:]\x20?[\"'])[^{SEPARATORS}0-9]{{4,}}+(?![^{SEPARATORS}])"
# Forms of credentials. Hexadecimal digests and keys; prefixed keys of public services; signed web tokens.
SECRET = (
    r"^(?:(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}"
    r"|sk-[0-9A-Za-z_-]{20,}|eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,})$"
)
CONTEXT_CHARS = 96

MIN_SUPPORT = 3
MIN_PATTERN = 0.75
MIN_INSTANCE = 0.7

_SPAN = "array<struct<start:int,end:int,hit:string,left:string,right:string>>"
BLOCK = 128  # spans whose places are summed at once


def spans_of(text: Column, pattern: str) -> Column:
    """start, end (code points, end exclusive) and hit of each match, leftmost and not overlapping, and left and right, what
    stands around it: two matches and the pieces between them, CONTEXT_CHARS at most. Places are running sums of the lengths
    of matches and pieces, by blocks, so that the work is nearly in proportion to the matches."""

    def around(p: Column, i: Column, step: int) -> Column:
        places = [("gaps", 0), ("hits", -1), ("gaps", -1), ("hits", -2), ("gaps", -2)] if step < 0 else [("gaps", 1), ("hits", 1), ("gaps", 2), ("hits", 2), ("gaps", 3)]
        cut = F.right if step < 0 else F.left
        parts = [cut(F.get(p[name], i + k), F.lit(CONTEXT_CHARS)) for name, k in places]
        return cut(F.concat_ws("", *(parts[::-1] if step < 0 else parts)), F.lit(CONTEXT_CHARS))

    def sized(p: Column) -> Column:
        return F.transform(
            p["hits"],
            lambda h, i: F.struct(F.length(F.get(p["gaps"], i)).alias("gap"), F.length(h).alias("len"), h.alias("hit"), around(p, i, -1).alias("left"), around(p, i, 1).alias("right")),
        )

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["len"]
        return F.struct(F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["hit"], x["left"], x["right"]))).alias("out"), end.alias("at"))

    def join(acc: Column, x: Column) -> Column:
        moved = F.transform(x["out"], lambda y: F.struct((y["start"] + acc["at"]).alias("start"), (y["end"] + acc["at"]).alias("end"), y["hit"], y["left"], y["right"]))
        return F.struct(F.concat(acc["out"], moved).alias("out"), (acc["at"] + x["at"]).alias("at"))

    zero = F.struct(F.array().cast(_SPAN).alias("out"), F.lit(0).alias("at"))

    def placed(all_: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int"))
        blocks = F.transform(starts, lambda k: F.aggregate(F.slice(all_, k * BLOCK + 1, F.lit(BLOCK)), zero, add))
        return F.when(F.size(all_) > 0, F.aggregate(blocks, zero, join)["out"]).otherwise(F.array().cast(_SPAN))

    pieces = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"))
    return let_in(let_in(pieces, sized), placed)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        digits = _digits(hit)
        chars = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
        value = F.transform(chars, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5)).cast("int"))
        return F.length(digits).between(14, 19) & (F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0)
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """kind, rank, start, end, hit of all base spans by start, then kind."""
    found = []
    for rank, kind in enumerate(KINDS):
        hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])
        spans = F.filter(spans_of(text, PATTERNS[kind]), lambda x: _valid(kind, x["hit"]))
        shaped = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["hit"], x["left"], x["right"]))
        found.append(F.when(hint, shaped).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,hit:string,left:string,right:string>>")))
    return F.sort_array(F.concat(*found))


def candidates(text: Column, base: Column) -> Column:
    """Words with a digit and values behind a key, stripped of marks at their ends, outside the base spans."""

    def strip(x: Column) -> Column:
        head = F.length(F.regexp_extract(x["hit"], "^[^A-Za-z0-9]*", 0))
        tail = F.length(F.regexp_extract(x["hit"], "[^A-Za-z0-9]*$", 0))
        core = F.substr(x["hit"], head + 1, F.length(x["hit"]) - head - tail)
        left, right = F.concat(x["left"], F.substr(x["hit"], F.lit(1), head)), F.concat(F.right(x["hit"], tail), x["right"])
        return F.struct((x["start"] + head).alias("start"), (x["end"] - tail).alias("end"), core.alias("hit"), left.alias("left"), right.alias("right"))

    none = F.array().cast(_SPAN)
    words = F.when(text.rlike("[0-9]"), F.transform(spans_of(text, CANDIDATE), strip)).otherwise(none)
    values = F.when(text.rlike("[=:]"), F.transform(spans_of(text, VALUE), strip)).otherwise(none)
    sized = F.filter(F.concat(words, values), lambda x: x["start"] < x["end"])
    return F.filter(sized, lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))


def _shape(hit: Column) -> Column:
    for pattern, sign in (("[0-9]+", "9"), (r"\p{Lu}+", "A"), (r"\p{L}+", "a"), ("(?:[Aa]9|9[Aa])[Aa9]*", "x")):
        hit = F.regexp_replace(hit, pattern, sign)
    return hit


def _contexts(left: Column, hit: Column, right: Column) -> Column:
    """Hashes of the patterns around a span: two words before it; one before and one after; the word before with the signs
    between; the word before with the shape of the span."""
    before, after = F.lower(left), F.lower(right)
    two = F.regexp_extract(before, rf"([^{SEPARATORS}]+)[{SEPARATORS}]+([^{SEPARATORS}]+)[{SEPARATORS}]*$", 0)
    words = F.filter(F.split(two, rf"[{SEPARATORS}]+"), lambda w: w != "")
    next_word = F.regexp_extract(after, rf"^[{SEPARATORS}.]*([^{SEPARATORS}]+)", 1)
    word = F.regexp_extract(before, rf"([^{SEPARATORS}]+)[{SEPARATORS}]*$", 1)
    signs = F.regexp_replace(F.regexp_extract(before, rf"[^{SEPARATORS}]([{SEPARATORS}]+)$", 1), r"[\x20\x09-\x0D]+", "")
    return F.filter(
        F.array(
            F.when(F.size(words) == 2, F.xxhash64(F.lit(2), words[0], words[1])),
            F.when((word != "") & (next_word != ""), F.xxhash64(F.lit(1), word, next_word)),
            F.when((word != "") & signs.rlike("[=:]"), F.xxhash64(F.lit(0), word, signs)),
            F.when(word != "", F.xxhash64(F.lit(3), word, _shape(hit))),
        ),
        lambda p: p.isNotNull(),
    )


def mentions_of(docs: DataFrame, keep_text: bool) -> DataFrame:
    """Each row of docs with __row, __base (spans) and __mentions (start, end, kind or null, instance, patterns)."""

    def mention(x: Column, kind: Column) -> Column:
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), kind.alias("kind"), F.xxhash64(F.lower(x["hit"])).alias("instance"),
            _contexts(x["left"], x["hit"], x["right"]).alias("patterns"),
        )

    secret = lambda x: F.when(x["hit"].rlike(SECRET), "secret")
    found = (
        docs.withColumn("__t", F.coalesce("text", F.lit("")))
        .withColumn("__base", base_spans(F.col("__t")))
        .withColumn("__free", candidates(F.col("__t"), F.col("__base")))
        .withColumn("__mentions", F.concat(F.transform("__base", lambda x: mention(x, x["kind"])), F.transform("__free", lambda x: mention(x, secret(x)))))
        .withColumn("__row", F.monotonically_increasing_id())
    )
    return settle(found.drop("__t", "__free", *([] if keep_text else ["text"])))


def discover(
    mentions: DataFrame, rounds: int | None = None, min_support: int = MIN_SUPPORT, min_pattern: float = MIN_PATTERN, min_instance: float = MIN_INSTANCE
) -> DataFrame:
    """instance, score of the unseen instances and credential-like seeds found through good patterns;
    mentions(instance, kind, patterns). Rounds go on until nothing new is found, or as many as asked for."""
    edges = settle(mentions.select("instance", F.explode("patterns").alias("pattern")).distinct())
    seeds = settle(mentions.where("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0)))
    sizes = settle(edges.groupBy("pattern").agg(F.count("*").alias("n")))
    scored, done = seeds, 0
    while True:
        known = join_skewed(edges, scored, "instance", "inner")
        good = join_skewed(
            settle(known.groupBy("pattern", "kind").agg(F.sum("score").alias("mass"), F.count("*").alias("support")).where(F.col("support") >= min_support)),
            sizes, "pattern", "inner",
        ).select("pattern", "kind", (F.col("mass") / (F.col("n") + 0.5)).alias("weight")).where(F.col("weight") >= min_pattern)
        reached = join_skewed(edges, settle(good), "pattern", "inner").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("weight"))))).alias("score"))
        reached = settle(reached.where(F.col("score") >= min_instance))
        done += 1
        # by the rows and not by the score, which rounds to a seed's 1 for the surest; an instance keeps its first kinds
        fresh = settle(reached.join(scored.select("instance").distinct(), "instance", "left_anti"))
        scored = scored.unionByName(fresh)
        if fresh.isEmpty() or done == rounds:
            break
    found = scored.join(seeds.select("instance").distinct(), "instance", "left_anti")
    sure = reached.join(seeds.where("kind = 'secret'").select("instance"), "instance", "left_semi")
    return found.unionByName(sure.select(found.columns)).groupBy("instance").agg(F.max("score").alias("score"))


def _found_spans(docs: DataFrame, keep_text: bool, **limits: float) -> DataFrame:
    """docs with its columns but the text as `kept`, the text if asked for, and __base and __spans: arrays of (start, rank, end, kind) by
    start, then kind."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(None).cast("int").alias("none")]
    rows = mentions_of(docs.select("text", F.struct(*others).alias("kept")), keep_text)
    flat = rows.select("__row", F.explode("__mentions").alias("m")).select("__row", "m.*")
    found = settle(discover(flat, **limits).select("instance"))
    hits = join_skewed(flat.where("kind is null or kind = 'secret'"), found, "instance", "inner")
    more = settle(
        hits.groupBy("__row").agg(
            F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.lit("ctx").alias("kind"))).alias("__more")
        )
    )
    slim = F.transform("__base", lambda x: F.struct(x["start"], x["rank"], x["end"], x["kind"]))
    kind = "array<struct<start:int,rank:int,end:int,kind:string>>"
    return (
        rows.drop("__mentions")
        .join(more, "__row", "left")
        .withColumn("__base", slim.cast(kind))
        .withColumn("__spans", F.sort_array(F.concat("__base", F.coalesce(F.col("__more").cast(kind), F.array().cast(kind)))))
        .drop("__row", "__more")
    )


def find_pii(docs: DataFrame, keep_text: bool = False, **limits: float) -> DataFrame:
    """Each row of docs with base and spans: arrays of (start, rank, end, kind), those of the fixed patterns and all, by
    start, then kind."""
    docs = docs.drop("base", "spans")
    names = [c for c in docs.columns if c != "text"]
    text = [F.col("text")] if keep_text else []
    return _found_spans(docs, keep_text, **limits).select(*[F.col("kept")[c].alias(c) for c in names], *text, F.col("__base").alias("base"), F.col("__spans").alias("spans"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def mask_pii(docs: DataFrame, **limits: float) -> DataFrame:
    """docs with each span of text replaced by its kind in angle brackets; overlapping spans become the first one's kind."""

    def step(acc: Column, x: Column) -> Column:
        piece = F.concat(acc["out"], F.substr("text", acc["at"] + 1, x["start"] - acc["at"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))
        return F.struct(F.when(x["start"] >= acc["at"], piece).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], x["end"]).alias("at"))

    masked = F.aggregate(
        "__spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
        lambda acc: F.concat(acc["out"], F.substr("text", acc["at"] + 1, F.length("text"))),
    )
    text = F.when(F.size("__spans") > 0, masked).otherwise(F.col("text")).alias("text")
    return _found_spans(docs, True, **limits).select(*[text if c == "text" else F.col("kept")[c].alias(c) for c in docs.columns])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs)
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_found"),
    )


QUERIES = {"op10_pii": op10_pii}
