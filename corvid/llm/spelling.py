"""Spelling variants: words one edit apart, each with the much more frequent word that it may be a form of.

Two words that differ by one inserted, deleted or replaced code point share one half: of the word that isn't the longer one,
either the left half stands at the start of the other or the right half at its end. So every word is cut into two segments.
A shard's Aho-Corasick automaton holds the segments of its words, all words that may contain one are scanned with it, and a
hit counts if the segment stands at its own offset and the lengths differ by one at most, the longer word being the scanned
one. The rest of the two words is then verified to differ by exactly one edit: by 64-bit keys of the scanned word with
one code point left out, and byte by byte where keys agree. Keys are sorted, so that a segment that very many words share
does not cost a comparison for each two of them.

A word can hold a segment at its start only if it has the segment's first GRAM code points, so shards are made by the first
and by the last GRAM code points of words. A shard above LIMIT words is dealt anew, by whole segments and word lengths, and one
that is still too large by blocks: a cell holds the segments of one block and scans another. So a cell has 2 LIMIT words at
most, however often a beginning or an ending occurs. It adds up what it found for each word before anything is shuffled;
pairs are never written.

Words are in Latin-1 inside, a byte for each code point. Nulls: a null text has no words; a null doc_id has the empty text
form. Repeated rows count again. Runs of letters of any length are whole words. Ties between forms of equal n go to the
first in code-point order. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import LOWER, chunks_of, join_skewed, mix64, small_batches, utf8_parts
from corvid.session import settle, shuffle_width

LEAST = 7  # code points of a word
GRAM = LEAST // 2
LIMIT = 50_000
FOLD = 10  # times a word's n that its form has at least
DAMAGE = 31

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def latin_runs(raw: np.ndarray, rel: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF in rows of UTF-8 with offsets rel: the rows' Latin-1 bytes, A-Z lowered, where
    letters of two bytes have become one; start, end and row of each run."""
    lead = raw == 0xC3
    second = np.zeros(len(raw), bool)
    second[1:] = lead[:-1]
    latin = LOWER[raw]
    latin[second] += 0x40
    letter = _LETTER[raw] | second
    keep = ~lead
    rows = np.concatenate(([0], np.cumsum(keep)))[rel]
    latin, letter = latin[keep], letter[keep]
    n = len(latin)
    first = np.zeros(n + 1, bool)
    first[rows] = True
    before = first[:n].copy()
    before[1:] |= ~letter[:-1]
    after = first[1:].copy()
    after[:-1] |= ~letter[1:]
    start, end = np.flatnonzero(letter & before), np.flatnonzero(letter & after) + 1
    return latin, start, end, np.searchsorted(rows, start, "right") - 1


def run_checksums(latin: np.ndarray, start: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 of each run's UTF-8 after a text whose CRC-32 is state."""
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(-size, kind="stable")
    short = order[size[order] <= 64]
    for k in order[: len(order) - len(short)]:
        out[k] = zlib.crc32(latin[start[k] : start[k] + size[k]].tobytes().decode("latin-1").encode(), int(state[k]))
    register = ~state[short]
    at, sizes = start[short], size[short]
    for j in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -j, "left"))  # sizes above j
        byte = latin[at[:live] + j]
        r = register[:live]
        wide = byte >= 0x80
        if wide.any():
            r = np.where(wide, _CRC[(r ^ 0xC3) & 0xFF] ^ (r >> 8), r)
            byte = np.where(wide, byte - 0x40, byte)
        register[:live] = _CRC[(r ^ byte) & 0xFF] ^ (r >> 8)
    out[short] = ~register
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = utf8_parts(batch.column("text"))
        ids = batch.column("key").to_pylist()
        found = []
        for i, j in chunks_of(at):
            latin, start, end, row = latin_runs(data[at[i] : at[j]], at[i : j + 1] - at[i])
            size = end - start
            long = size >= LEAST
            start, size, row = start[long], size[long], row[long]
            state = np.array([zlib.crc32(f"{d}:".encode()) for d in ids[i:j]], np.uint32)[row]
            crc = run_checksums(latin, start, size, state)
            hurt = crc % DAMAGE == 0
            gone = start + crc % size.astype(np.uint32)
            whole = ~hurt | (size > LEAST)
            start, size, hurt, gone = start[whole], size[whole], hurt[whole], gone[whole]
            offsets = np.concatenate(([0], np.cumsum(size)))
            flat = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
            stay = np.ones(len(flat), bool)
            stay[offsets[:-1][hurt] + gone[hurt] - start[hurt]] = False
            offsets = np.concatenate(([0], np.cumsum(size - hurt))).astype(np.int32)
            found.append(pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(latin[flat[stay]].tobytes())]))
        counts = pa.chunked_array(found, pa.binary()).value_counts()
        yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], ["word", "n"])


def count_words(docs: DataFrame) -> DataFrame:
    """word (Latin-1), n of the words of docs(doc_id, text) that occur twice or more."""
    small_batches(docs)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n >= 2")


# --- one shard ------------------------------------------------------------------------------------------------------------


def _segment(word: str, side: int, m: int) -> str:
    """What a word has where a word of m code points has its segment of a side."""
    return word[: m // 2] if side == 0 else word[len(word) - (m - m // 2) :]


def scan(words: list[str], sides: np.ndarray, held: np.ndarray, scanned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word: whether another word of its length has the same segment, one of the two being held; and whether a held word
    shorter by one has a segment that stands at its place in this word."""
    same, shorter = np.zeros(len(words), bool), np.zeros(len(words), bool)
    for side in (0, 1):
        mine = np.flatnonzero(sides == side)
        holders = Counter((len(words[k]), _segment(words[k], side, len(words[k]))) for k in mine[held[mine]])
        automaton = ahocorasick.Automaton()
        for _, segment in holders:
            automaton.add_word(segment, segment)
        if not holders:
            continue
        automaton.make_automaton()
        met = set()
        for k in mine[scanned[mine]]:
            word = words[k]
            n = len(word)
            for end, segment in automaton.iter(word):
                size = len(segment)
                if end != (size - 1 if side == 0 else n - 1):
                    continue
                for m, hit in ((n, same), (n - 1, shorter)):
                    if size == (m // 2 if side == 0 else m - m // 2) and holders[m, segment] > (m == n and held[k]):
                        hit[k] = True
                        met.add((m, segment))
        for k in mine[held[mine]]:
            n = len(words[k])
            same[k] |= (n, _segment(words[k], side, n)) in met
    return same, shorter


class _Class:
    """The words of one side and one length: their bytes, and sums by which a key is had for each with one code point left out."""

    def __init__(self, rows: np.ndarray, words: list[bytes], cells: np.ndarray):
        self.rows, self.m = rows, len(words[rows[0]])
        self.bytes = np.frombuffer(b"".join(words[k] for k in rows), np.uint8).reshape(len(rows), self.m)
        self.cell = cells[rows].view(np.uint64)
        place = np.arange(self.m, dtype=np.uint64) << np.uint64(8)
        zero = np.zeros((len(rows), 1), np.uint64)
        with np.errstate(over="ignore"):
            self.left = np.hstack([zero, np.cumsum(mix64(self.bytes + place + np.uint64(1 << 40)), 1, dtype=np.uint64)])
            moved = mix64(self.bytes[:, 1:] + place[:-1] + np.uint64(1 << 40))[:, ::-1]
            self.right = np.hstack([np.cumsum(moved, 1, dtype=np.uint64)[:, ::-1], zero])

    def whole(self) -> np.ndarray:
        return mix64(self.left[:, -1] ^ self.cell)

    def without(self, a: int, b: int) -> np.ndarray:
        """Keys of the words without code point a, a + 1 ... b - 1."""
        with np.errstate(over="ignore"):
            return mix64((self.left[:, a:b] + self.right[:, a:b]) ^ self.cell[:, None])


def _steps(a: int, b: int, rows: int) -> Iterator[tuple[int, int]]:
    """[a, b) in blocks of about a million keys."""
    step = max(1, (1 << 20) // max(1, rows))
    for i in range(a, b, step):
        yield i, min(b, i + step)


def _replaced(c: _Class, side: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in c that differ in one code point of the half that isn't the segment."""
    for i, j in _steps(c.m // 2, c.m, len(c.rows)) if side == 0 else _steps(0, c.m // 2, len(c.rows)):
        with np.errstate(over="ignore"):
            keys = mix64(c.without(i, j) + np.arange(i, j, dtype=np.uint64)).ravel()
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        for shift in range(1, len(keys)):  # a group has a word for each code point at most
            at = np.flatnonzero(keys[shift:] == keys[:-shift])
            if not len(at):
                break
            x, y = order[at] // (j - i), order[at + shift] // (j - i)
            true = (c.bytes[x] != c.bytes[y]).sum(1) == 1
            yield x[true], y[true]


def _inserted(short: _Class, long: _Class, side: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in short and long, the latter with one code point more, in the half that isn't the short one's segment. Of
    equal neighbours the first counts as inserted, so that a pair is met on one side and once."""
    keys = short.whole()
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    half = short.m // 2
    for i, j in _steps(half, long.m, len(long.rows)) if side == 0 else _steps(0, half, len(long.rows)):
        wanted = long.without(i, j)
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[place] == wanted
        cols = np.arange(i, j)
        hit &= (cols == 0) | (long.bytes[:, cols] != long.bytes[:, np.maximum(cols - 1, 0)])
        y, at = np.nonzero(hit)
        x = order[place[y, at]]
        left = np.arange(short.m) + (np.arange(short.m) >= (at + i)[:, None])
        true = (long.bytes[y[:, None], left] == short.bytes[x]).all(1)
        yield x[true], y[true]


def near_in_shard(words: list[bytes], n: np.ndarray, sides: np.ndarray, cells: np.ndarray, held: np.ndarray, scanned: np.ndarray) -> dict[int, tuple[int, int]]:
    """For row numbers with near words: how many were found here, and the row of the best of them. Of two words of one length a
    held one gets a scanned one; of two others, the shorter being held and the longer scanned, each gets the other."""
    same, shorter = scan([w.decode("latin-1") for w in words], sides, held, scanned)
    sizes = np.array([len(w) for w in words], np.int64)
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=lambda k: (-n[k], words[k]))] = np.arange(len(words))
    to, by = [], []

    def of(side: int, m: int, which: np.ndarray) -> _Class | None:
        rows = np.flatnonzero((sides == side) & (sizes == m) & which)
        return _Class(rows, words, cells) if len(rows) else None

    for side in (0, 1):
        for m in np.unique(sizes[sides == side]):
            if (c := of(side, m, same)) is not None:
                for x, y in _replaced(c, side):
                    for a, b in ((c.rows[x], c.rows[y]), (c.rows[y], c.rows[x])):
                        met = held[a] & scanned[b]
                        to.append(a[met])
                        by.append(b[met])
            long, short = of(side, m, shorter), of(side, m - 1, held)
            if long is not None and short is not None:
                for x, y in _inserted(short, long, side):
                    to += [short.rows[x], long.rows[y]]
                    by += [long.rows[y], short.rows[x]]
    if not to:
        return {}
    to, by = np.concatenate(to), np.concatenate(by)
    order = np.lexsort((rank[by], to))
    to, by = to[order], by[order]
    first = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else np.zeros(0, np.int64)
    many = np.diff(np.append(first, len(to)))
    return {int(to[f]): (int(k), int(by[f])) for f, k in zip(first, many, strict=True)}


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a partition: some cells of 2 LIMIT rows at most."""
    full = [b for b in batches if len(b)]
    if not full:
        return
    table = pa.Table.from_batches(full)
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    got = near_in_shard(words, n, *[table.column(c).to_numpy() for c in ("side", "cell", "held", "scanned")])
    best = [b for _, b in got.values()]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([words[k] for k in got], pa.binary()), pa.array([c for c, _ in got.values()], pa.int64()),
            pa.array([words[b] for b in best], pa.binary()), pa.array(n[best] if best else [], pa.int64()),
        ],
        ["word", "n_near", "form", "form_n"],
    )


# --- all words --------------------------------------------------------------------------------------------------------------


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """word, n_near and the most frequent near word (form, form_n) of each of words(word, n) that has one; words are distinct and
    have LEAST code points or more."""
    routes = words.select("word", "n", F.explode(F.array(
        *[F.struct(F.lit(side).alias("side"), F.substring("word", at, GRAM).alias("gram")) for side, at in ((0, 1), (1, -GRAM))]
    )).alias("r")).select("word", "n", "r.side", "r.gram")
    every = F.lit(True)
    counts = settle(routes.groupBy("side", "gram").agg(F.count("*").alias("size")))
    large = counts.where(F.col("size") > limit).select("side", "gram", every.alias("large"))
    marked = settle(routes.join(large, ["side", "gram"], "left"))
    cool = marked.where("large is null").select("word", "n", "side", F.xxhash64("side", "gram").alias("cell"), every.alias("held"), every.alias("scanned"))
    # large shards: to the words with the same segment, and to those for which this word is the longer one
    half, length = F.floor(F.col("m") / 2).cast("int"), F.octet_length("word")
    ways = F.filter(F.array(F.struct(length.alias("m"), every.alias("held")), F.struct((length - 1).alias("m"), F.lit(False).alias("held"))), lambda w: w["m"] >= LEAST)
    hot = marked.where("large").select("word", "n", "side", F.explode(ways).alias("w")).select("word", "n", "side", "w.m", "w.held")
    segment = F.when(F.col("side") == 0, F.substring("word", F.lit(1), half)).otherwise(F.substring("word", half - F.col("m"), F.col("m") - half))
    hot = settle(hot.withColumn("segment", segment))
    blocks = hot.groupBy("side", "m", "segment").agg(F.ceil(F.count("*") / limit).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    as_held = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.col("own").alias("i"), k.alias("j"), every.alias("held"), (k == F.col("own")).alias("scanned")))
    as_scanned = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(k.alias("i"), F.col("own").alias("j"), F.lit(False).alias("held"), every.alias("scanned")))
    cells = F.when(F.col("held"), F.concat(as_held, F.filter(as_scanned, lambda c: c["i"] != F.col("own")))).otherwise(as_scanned)
    split = (
        hot.join(blocks, ["side", "m", "segment"])
        .withColumn("own", own)
        .select("word", "n", "side", "m", "segment", F.explode(cells).alias("c"))
        .select("word", "n", "side", F.xxhash64("side", "m", "segment", "c.i", "c.j").alias("cell"), "c.held", "c.scanned")
    )
    rows = counts.agg(F.sum(F.when(F.col("size") > limit, 2 * F.col("size")).otherwise(F.col("size")))).first()[0] or 0
    dealt = cool.unionByName(split).repartition(max(shuffle_width(words.sparkSession), -(-rows // limit)), "cell")
    found = dealt.mapInArrow(_shard, "word binary, n_near long, form binary, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.form").alias("form"), (-F.col("b.m")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root of forms(word, form): the end of the chain of forms, by doubling the steps. n grows FOLD times by each form,
    so that a chain of counts below 2^63 has 18 steps at most, and five rounds end it."""
    now = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        step = settle(join_skewed(now, on, "root").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")))
        now = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return now


def spelling_variants(words: DataFrame, fold: int = FOLD, limit: int = LIMIT) -> DataFrame:
    """words(word, n) with form, root, n_near, form_n."""
    near = near_words(words, limit).withColumnsRenamed({"form": "__form", "form_n": "__form_n"})
    fits = F.col("__form_n") >= fold * F.col("n")
    known = settle(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, F.col("__form")).alias("form"), F.when(fits, F.col("__form_n")).alias("form_n"),
        )
    )
    return known.join(roots(known.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = spelling_variants(settle(count_words(docs)))
    text = {c: F.decode(c, "ISO-8859-1") for c in ("word", "form", "root")}
    return out.withColumns(text).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {"op12_spelling": op12_spelling}

ORACLES = {
    "op12_spelling": """
        WITH RECURSIVE crc AS (
            SELECT list(t ORDER BY k) AS tbl FROM (SELECT k, list_reduce(list_prepend(k, range(8)),
                lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS t FROM range(256) r(k))
        ), runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents)
            WHERE length(run) >= 7 GROUP BY 1, 2
        ), hashed AS (
            SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
                    string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                    lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, unicode(ch)::BIGINT - 64] END))),
                lambda s, b: xor(tbl[(xor(s, b) & 255) + 1], s >> 8)), 4294967295) AS h
            FROM runs, crc
        ), words AS (
            SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
                SELECT c, CASE WHEN h % 31 = 0 THEN substring(run, 1, CAST(h % length(run) AS INT)) || substring(run, CAST(h % length(run) AS INT) + 2)
                    ELSE run END AS word FROM hashed)
            WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
        ), spots AS (
            SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
        ), cut AS (
            SELECT word, n, i, substring(word, 1, CAST(i AS INT) - 1) AS l, substring(word, CAST(i AS INT) + 1) AS r FROM spots
        ), near AS (
            SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
            UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.l || c.r
            UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.l || c.r
        ), best AS (
            SELECT near.word, count(*) AS n_near, first(other ORDER BY w.n DESC, other) AS other, max(w.n) AS other_n
            FROM near JOIN words w ON w.word = other GROUP BY near.word
        ), formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
                CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
            FROM words w LEFT JOIN best USING (word)
        ), steps AS (
            SELECT word, word AS at, 0 AS k FROM formed
            UNION ALL SELECT s.word, f.form, k + 1 FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NOT NULL
        )
        SELECT f.word, f.form, arg_max(s.at, s.k) AS root, f.n, f.n_near, f.form_n FROM formed f JOIN steps s USING (word) GROUP BY ALL
    """
}
