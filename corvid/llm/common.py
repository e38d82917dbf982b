"""Helpers shared by the operators: word splitting in Spark and in numpy, row keys, joins under skew."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words of a text, in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def let_in(value: Column, body) -> Column:
    """body(value), with value computed once even where body uses it often or inside another lambda."""
    return F.transform(F.array(value), body)[0]


def join_skewed(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join on key plus its hash. The second key makes Spark shuffle both sides for the join itself, even where the
    right side is already grouped by key, and adaptive execution can then split the partition of a hot key."""
    salt = "__key_hash"
    out = left.withColumn(salt, F.xxhash64(key)).join(right.withColumn(salt, F.xxhash64(key)), [key, salt], how)
    return out.drop(salt)


# --- numpy side -----------------------------------------------------------------------------------------------------

_MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INV = pow(_MULT, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Every ASCII character that is no letter or digit.
IS_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _tables or len(_tables["p"]) < n:
        with np.errstate(over="ignore"):
            for name, m in (("p", _MULT), ("i", _INV)):
                table = np.full(n, m, dtype=np.uint64)
                table[0] = 1
                _tables[name] = np.cumprod(table, dtype=np.uint64)
    return _tables["p"], _tables["i"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def utf8_parts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without copying it; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, kind)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), at.astype(np.int64)


def chunks_of(at: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes each; one longer row is a range of its own."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j
        i = j


def word_hashes(data: np.ndarray, at: np.ndarray, lower: bool = False, breaks: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For rows with byte offsets at: a 64-bit hash of every word, byte start and end of each, and the word range of each row.
    breaks marks the bytes between words."""
    base = int(at[0])
    raw = data[base : int(at[-1])]
    n = len(raw)
    rel = at - base
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(at), np.int64)
    space = breaks[raw]
    inside = ~space
    first = np.zeros(n + 1, bool)  # of a row's bytes, and beyond the last
    first[rel] = True
    before = first[:n].copy()
    before[1:] |= space[:-1]
    after = first[1:]
    after[:-1] |= space[1:]
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    power, inverse = _powers(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((LOWER[raw] if lower else raw).astype(np.uint64) * power[:n] + power[:n], out=total[1:])
        h = mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return h, start, end, np.searchsorted(start, rel)


# --- Arrow batches ----------------------------------------------------------------------------------------------------

BATCH_ROWS = 500
BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df, with Arrow batches of few rows and bytes for its session: rows of this subpackage are whole texts, and a batch of
    them is held by Spark and by Python at once. One longer row is a batch of its own."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def give_back() -> None:
    """What this Python worker has freed goes back to the system. Spark keeps idle workers, which would hold it beside those of later stages."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run for mapInArrow, after which its worker gives back what it has freed."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


# --- bitmaps of fixed size --------------------------------------------------------------------------------------------

BITMAP_BITS = 25


def bitmap_slots(values: np.ndarray) -> np.ndarray:
    return (mix64(np.ascontiguousarray(values).view(np.uint64)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def bitmap_has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = bitmap_slots(values)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bitmap_of(df: DataFrame, column: str):
    """A broadcast bitmap of 2^BITMAP_BITS bits (4 MB whatever the input) with the bits of a long column set. It selects
    what a join may need before the join shuffles it; equal bits of other values only let more rows through."""

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
        for pdf in batches:
            at = bitmap_slots(pdf.iloc[:, 0].to_numpy(np.int64))
            np.bitwise_or.at(words, at >> 3, (1 << (at & 7)).astype(np.uint8))
        blocks = words.reshape(-1, 4096)
        used = np.flatnonzero(blocks.any(1))
        yield pd.DataFrame({"block": used.astype(np.int32), "bits": [blocks[b].tobytes() for b in used]})

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [key[0]], "bits": [np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in pdf["bits"]], axis=0).tobytes()]})

    marked = df.select(column).where(F.col(column).isNotNull()).coalesce(64).mapInPandas(mark, "block int, bits binary")
    words = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for row in marked.groupBy("block").applyInPandas(merge, "block int, bits binary").collect():
        words.reshape(-1, 4096)[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return df.sparkSession.sparkContext.broadcast(words.tobytes())


def in_bitmap(bitmap, column: str) -> Column:
    """True where the bit of a long column is set; null counts as 0."""

    @F.pandas_udf("boolean")
    def has(values: pd.Series) -> pd.Series:
        return pd.Series(bitmap_has(np.frombuffer(bitmap.value, np.uint8), values.to_numpy(np.int64)))

    return has(F.coalesce(F.col(column).cast("long"), F.lit(0)))


def drop_ids(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is in gone(doc_id). Rows whose bit is not set stay without a shuffle; of the
    others, which are mostly those that go, the join decides. A null doc_id stays."""
    bits = bitmap_of(gone, "doc_id")
    marked = docs.withColumn("__hit", in_bitmap(bits, "doc_id"))
    rest = marked.where("__hit").join(gone.select("doc_id").hint("merge"), "doc_id", "left_anti")
    return marked.where("not __hit").select(*docs.columns).unionByName(rest.select(*docs.columns))
