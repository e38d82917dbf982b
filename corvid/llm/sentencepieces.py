"""SentencePiece encoding by sampling without replacement, and decoding.

The lattice of a text has a node for each place and an edge for each vocabulary piece that fits there; characters outside
the vocabulary are edges of byte pieces. Pieces never run over the start of a word (white space, then anything else), so
the lattice of a text is the chain of the lattices of its words; it falls apart as well between any two ASCII characters
that no piece holds side by side. Pieces weigh 1 / (rank + 2) ** ALPHA, their rank being
that of their merge. The forward sums of a lattice give the exact log-mass of what lies behind each node, and with them as
the heuristic a perturbed A* search pops segmentations in the order of their Gumbel-perturbed log-probabilities: the best
one of a region is drawn by walking the lattice back from the end; what the region holds besides it is split by the first
place of difference, and the value of each part is a Gumbel number truncated at the region's value. The first K popped
are a sample of K distinct segmentations without replacement. Each comes with its log-probability, its perturbed value and
its inclusion score: the log of the probability that it exceeds the next value in the queue.

All random numbers are hashes of (row key, sample, word, step), so that a row's result depends on nothing but its key and
text. Lattices of words are built for all new words of a piece of work at once. Those of words met a second time are kept
for the task, about CACHE_EDGES edges at most; the others go with their piece of work, so that texts of rare words take no
more room than others. The model file (its path is a parameter) is read by the driver; it may not exceed MAX_MODEL bytes.

Nulls and empty texts have one segmentation, of no pieces. A text with fewer than K segmentations gets all it has. Of equal
perturbed values the part found first is popped first. A very long text is a piece of work of its own, and its arrays grow
with it. Repeated rows get equal results, an empty table an empty one. Only the key column is carried; a key column named
like one of the result's is an error. Decoding returns the text exactly; `decode_pieces` refuses to replace a column.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import BITMAP_BITS, bitmap_has, bitmap_slots, mix64, small_batches, tidy, utf8_parts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_MODEL = 16 << 20
K = 2
ALPHA = 1.0
LONGEST = 16
CACHE_EDGES = 1_000_000
GROUP_CELLS = 1 << 18
WORK_BYTES = 1 << 18

SPACE = 0x2581  # the mark that stands for a space in pieces
OWN_MARK = 0x110000  # stands for that mark where a text holds it itself
FIRST_BYTE = 3  # number of the piece of byte 0
BYTE_LOG = -16.0
LEAST_LOG = -600.0  # sums of products above this stay in the range of doubles
NEAR = -60.0  # places with less log-mass than this before them are looked at only if the others leave too little
MOST_LUCK = 37.5  # no Gumbel number lies further above its place: its uniform number has 53 bits

_MULT = np.uint64(0xD1342543DE82EF95)
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _tables or len(_tables["p"]) < n:
        inverse = np.uint64(pow(int(_MULT), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for name, m in (("p", _MULT), ("i", inverse)):
                t = np.full(n, m, np.uint64)
                t[0] = 1
                _tables[name] = np.cumprod(t, dtype=np.uint64)
    return _tables["p"], _tables["i"]


def _prefix(codes: np.ndarray) -> np.ndarray:
    power, _ = _powers(len(codes) + 1)
    out = np.zeros(len(codes) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)], out=out[1:])
    return out


def _span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64((prefix[end] - prefix[start]) * _powers(len(prefix))[1][start] + (end - start).astype(np.uint64))


class Vocabulary:
    """Hashes, numbers and log-weights of the pieces of a model and of all their beginnings."""

    def __init__(self, proto: bytes, alpha: float = ALPHA):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = processor.get_piece_size()
        ids = np.array([i for i in range(size) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))])
        pieces = [processor.id_to_piece(int(i)) for i in ids]
        if any(chr(SPACE) in p.lstrip(chr(SPACE)) for p in pieces) or max(map(len, pieces)) > LONGEST:
            raise ValueError("pieces must keep to words and to LONGEST characters")
        rank = np.array([-processor.get_score(int(i)) for i in ids])
        rank[rank > size] = size
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        # which ASCII characters may stand side by side within a piece; a lattice falls apart where they may not
        self.joins = np.ones((129, 129), bool)
        self.joins[:128, :128] = False
        kinds = np.minimum(codes, 128)
        within = np.ones(len(codes) - 1, bool)
        sizes = np.array([len(p) for p in pieces])
        within[np.cumsum(sizes)[:-1] - 1] = False
        self.joins[kinds[:-1][within], kinds[1:][within]] = True
        # a beginning that is no piece has number -1; a search along a text ends where no beginning is left
        owner = np.repeat(np.arange(len(pieces)), sizes)
        starts = (np.cumsum(sizes) - sizes)[owner]
        upto = np.arange(len(codes)) + 1
        hashes, whole = _span_hash(_prefix(codes), starts, upto), upto - starts == sizes[owner]
        order = np.lexsort((~whole, hashes))
        order = order[np.diff(hashes[order], prepend=hashes[order[0]] - np.uint64(1)) != 0]
        self.hash = hashes[order]
        self.id = np.where(whole, ids[owner], -1)[order].astype(np.int64)
        self.log = (-alpha * np.log(rank + 2))[owner[order]]
        # a direct table over the top bits: place of the first hash that may be equal
        self.bits = 20
        edges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.first = np.append(np.searchsorted(self.hash, edges), len(self.hash)).astype(np.int32)
        # the bytes of each piece, for decoding
        plain = {int(i): p.replace(chr(SPACE), " ").encode() for i, p in zip(ids, pieces, strict=True)}
        spelt = [bytes([i - FIRST_BYTE]) if processor.is_byte(i) else plain.get(i, b"") for i in range(size)]
        self.spelling = np.frombuffer(b"".join(spelt), np.uint8)
        self.spelt_at = np.concatenate(([0], np.cumsum([len(x) for x in spelt])))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, or -1."""
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        out = np.full(len(h), -1, np.int64)
        left = np.flatnonzero(at < end)  # few: most spans begin no piece
        at, end, h = at[left], end[left], h[left]
        while len(left):
            same = self.hash[at] == h
            out[left[same]] = at[same]
            at = at + 1
            more = ~same & (at < end)
            left, at, end, h = left[more], at[more], end[more], h[more]
        return out

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the texts of ids[bounds[i]:bounds[i+1]], and where each begins; the mark before the first word goes."""
        sizes = np.diff(self.spelt_at)[ids]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        data = self.spelling[np.arange(ends[-1]) + np.repeat(self.spelt_at[ids] - ends[:-1], sizes)]
        at = ends[bounds]
        some = at[:-1] < at[1:]
        keep = np.ones(len(data), bool)
        keep[at[:-1][some]] = data[at[:-1][some]] != 0x20
        moved = np.concatenate(([0], np.cumsum(keep)))
        return data[keep], moved[at]


_vocabularies: dict = {}


def vocabulary_of(proto: bytes, alpha: float) -> Vocabulary:
    """The vocabulary of a model, made once by a Python worker; it holds the last one only."""
    key = (hash(proto), len(proto), alpha)
    if key not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[key] = Vocabulary(proto, alpha)
    return _vocabularies[key]


class Lattices:
    """Edges of the lattices of the words of a piece of work and of those kept, grouped by the node that they lead to."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.known, self.known_last = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes of kept words, sorted, and their last nodes
        self.met = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)  # which hashes were met; equal bits of others only keep more
        self.nodes = self.edges = self.kept_nodes = self.kept_edges = 0
        self.room = {"high": np.zeros(0, np.uint64), "back": np.zeros(0, np.int32), "piece": np.zeros(0, np.int32), "log": np.zeros(0), "is_first": np.zeros(0, bool)}
        self._views()

    def _views(self) -> None:
        n = self.edges
        self.high = self.room["high"][:n]  # node << 32 plus the cumulated probability, 32 bits
        self.back, self.piece, self.log = self.room["back"][:n], self.room["piece"][:n], self.room["log"][:n]
        self.is_first = self.room["is_first"][: self.nodes]

    def _append(self, name: str, at: int, values: np.ndarray) -> None:
        """Values put behind the first `at` ones; room grows by halves, so that adding words does not copy all others."""
        held = self.room[name]
        if at + len(values) > len(held):
            self.room[name] = np.empty((at + len(values)) * 3 // 2, held.dtype)
            self.room[name][:at] = held[:at]
        self.room[name][at : at + len(values)] = values

    def lasts(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last nodes of the different words among spans of codes, and the number of the word of each span."""
        if self.kept_edges > CACHE_EDGES:
            self.clear()
        self.nodes, self.edges = self.kept_nodes, self.kept_edges
        h, first, number, times = np.unique(_span_hash(prefix, start, end), return_index=True, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.known, h)
        last = np.full(len(h), -1, np.int64)
        old = np.flatnonzero(at < len(self.known))
        old = old[self.known[at[old]] == h[old]]
        last[old] = self.known_last[at[old]]
        new = np.flatnonzero(last < 0)
        again = (times[new] > 1) | bitmap_has(self.met, h[new])
        slots = bitmap_slots(h[new])
        np.bitwise_or.at(self.met, slots >> 3, (1 << (slots & 7)).astype(np.uint8))
        for part, stay in ((new[again], True), (new[~again], False)):
            if len(part):
                last[part] = self._add(codes, start[first[part]], end[first[part]], prefix)
            if stay and len(part):
                where = np.searchsorted(self.known, h[part])
                self.known, self.known_last = np.insert(self.known, where, h[part]), np.insert(self.known_last, where, last[part])
                self.kept_nodes, self.kept_edges = self.nodes, self.edges
        self._views()
        return last, number

    def _add(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        """Last nodes of the lattices of words, made in groups of like size: log-weights by (word, place, length) and forward
        sums by place."""
        order = np.argsort(end - start, kind="stable")
        start, size = start[order], (end - start)[order]
        base = self.nodes + np.concatenate(([0], np.cumsum(size + 1)[:-1]))
        parts: list = []
        i = 0
        while i < len(size):
            width = int(size[i]) + 2  # a group holds words of about one size
            j = max(i + 1, min(int(np.searchsorted(size, width, "left")), i + max(1, GROUP_CELLS // (width * (LONGEST + 1)))))
            parts.append(self._group(codes, start[i:j], size[i:j], base[i:j], prefix))
            i = j
        high, back, piece, log = (np.concatenate([x[c] for x in parts]) for c in range(4))
        total = int((size + 1).sum())
        marks = np.zeros(total, bool)
        marks[base - self.nodes] = True
        for name, values in (("high", high), ("back", back), ("piece", piece), ("log", log)):
            self._append(name, self.edges, values)
        self._append("is_first", self.nodes, marks)
        self.edges += len(high)
        self.nodes += total
        out = np.empty(len(order), np.int64)
        out[order] = base + size
        return out

    def _group(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray, base: np.ndarray, prefix: np.ndarray) -> tuple:
        most = int(size[-1])
        word = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
        at, room = start[word] + place, size[word] - place
        found: list = []  # by length: places, numbers and log-weights of the pieces
        alive = np.arange(len(word))
        for n in range(1, LONGEST + 1):
            if n > 1:
                alive = alive[room[alive] >= n]
            k = self.vocabulary.find(_span_hash(prefix, at[alive], at[alive] + n))
            here, k = alive[k >= 0], k[k >= 0]
            number = self.vocabulary.id[k]
            whole = number >= 0
            found.append((here[whole], number[whole], self.vocabulary.log[k[whole]]))
            if n == 1 and len(found[0][0]) < len(alive):  # characters that are no piece become bytes
                odd = np.setdiff1d(alive, found[0][0], assume_unique=True)
                code = codes[at[odd]].astype(np.int64)
                code[code == OWN_MARK] = SPACE
                weights = BYTE_LOG * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
                found[0] = tuple(np.concatenate(x) for x in zip(found[0], (odd, np.where(code < 0x80, FIRST_BYTE + code, -1 - code), weights), strict=True))
            alive = here
            if not len(alive):
                break
        here, ids, log = (np.concatenate([x[c] for x in found]) for c in range(3))
        length = np.repeat(np.arange(1, len(found) + 1), [len(x[0]) for x in found])
        # each character is an edge, so that their product bounds a word's mass: where it can't underflow, no logarithms are needed
        safe = np.bincount(word[here], np.where(length == 1, log, 0.0), minlength=len(size)) > LEAST_LOG
        share = np.empty(len(here))
        for plain in (True, False):
            some = np.flatnonzero(safe == plain)
            if len(some):
                at = np.full(len(size), -1)
                at[some] = np.arange(len(some))
                of = at[word[here]]
                mine = np.flatnonzero(of >= 0)
                share[mine] = self._shares(of[mine], place[here[mine]] + length[mine], length[mine], log[mine], len(some), most, plain)
        end = place[here] + length
        order = np.argsort((base[word[here]] + end) * (LONGEST + 1) + length, kind="stable")
        tail, share = (base[word[here]] + end)[order], share[order]
        first = np.diff(tail, prepend=-1) != 0
        chance = np.exp(share)
        cumulated = np.cumsum(chance)
        before = (cumulated - chance)[first][np.cumsum(first) - 1]
        scaled = np.minimum(np.rint((cumulated - before) * 2.0**32), 2.0**32).astype(np.uint64)
        scaled[np.append(first[1:], True)] = 1 << 32
        return (tail.astype(np.uint64) << np.uint64(32)) + scaled, tail - length[order], ids[order], share

    def _shares(self, word: np.ndarray, end: np.ndarray, length: np.ndarray, log: np.ndarray, words: int, most: int, plain: bool) -> np.ndarray:
        """Log of the share that each edge (word, end, length, log-weight) has in the mass of its end."""
        longest = int(length.max())
        weight = np.full((most + 1, longest + 1, words), 0.0 if plain else -np.inf)  # words last: neighbouring words are neighbouring reads
        weight[end, length, word] = np.exp(log) if plain else log
        mass = np.full((most + 1, words), 0.0 if plain else -np.inf)
        mass[0] = 1.0 if plain else 0.0
        with np.errstate(invalid="ignore", divide="ignore"):
            for p in range(1, most + 1):
                n = min(p, longest)
                if plain:
                    np.einsum("ij,ij->j", weight[p, 1 : n + 1], mass[p - n : p][::-1], out=mass[p])
                    continue
                value = weight[p, 1 : n + 1] + mass[p - n : p][::-1]
                top = value.max(0)
                value -= top
                mass[p] = np.where(np.isinf(top), -np.inf, top + np.log(np.exp(value, out=value).sum(0)))
        if plain:
            return np.minimum(np.log(mass[end - length, word] * weight[end, length, word] / mass[end, word]), 0.0)
        return np.minimum(mass[end - length, word] + log - mass[end, word], 0.0)

    def walk(self, node: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Drawn edges from each node back to the first node of its word: flat, and the number of edges of each."""
        order = np.argsort(node, kind="stable")  # equal words together: neighbouring reads
        now, keys, who = node[order], key[order], order
        live = ~self.is_first[now]
        now, keys, who = now[live], keys[live], who[live]
        steps: list = []
        count = np.zeros(len(node), np.int64)
        with np.errstate(over="ignore"):
            step = 0
            while len(who):
                draw = mix64(keys + np.uint64(step) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
                edge = np.searchsorted(self.high, (now.astype(np.uint64) << np.uint64(32)) + draw, "right")
                steps.append((who, edge))
                count[who] += 1
                now = self.back[edge]
                live = ~self.is_first[now]
                now, keys, who = now[live], keys[live], who[live]
                step += 1
        at = np.cumsum(count) - count
        flat = np.zeros(int(count.sum()), np.int64)
        for step, (who, edge) in enumerate(steps):
            flat[at[who] + step] = edge
        return flat, count


def _uniform(key: np.ndarray) -> np.ndarray:
    return ((mix64(key) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def _token_keys(row_key: np.ndarray, sample: int, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(row_key ^ mix64((token.astype(np.uint64) << np.uint64(8)) + np.uint64(sample)))


def _split(
    lattices: Lattices, edges: np.ndarray, at: np.ndarray, value: np.ndarray, key: np.ndarray, start: np.ndarray, rest_at_start: np.ndarray, k: int
) -> tuple[list, np.ndarray]:
    """For segmentations edges[at[i]:at[i+1]] with perturbed values: the values of the parts of their regions by place of
    first difference, as arrays of places and values that hold the k largest at least, and their log-probabilities. Places
    come later in the text the less mass they have, and a value is MOST_LUCK above it at most, so few places matter."""
    log = lattices.log[edges]
    size = np.diff(at)
    total = np.concatenate(([0.0], np.cumsum(log)))
    before = total[:-1] - np.repeat(total[at[:-1]], size)

    def values(row: np.ndarray, flat: np.ndarray) -> np.ndarray:
        rest = -np.expm1(log[flat])
        given = (flat - at[row] == start[row]) & ~np.isnan(rest_at_start[row])
        rest[given] = rest_at_start[row[given]]
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            exponential = -np.log(_uniform(key[row] + (flat - at[row]).astype(np.uint64)))
            out = -np.logaddexp(-value[row], np.log(exponential) - before[flat] - np.log(rest))
        out[rest <= 1e-12] = -np.inf
        return out

    near = before >= NEAR
    near[at[:-1][size > 0]] = True
    flat = np.flatnonzero(near)
    row = np.searchsorted(at, flat, "right") - 1
    kept = flat - at[row] >= start[row]
    flat, row = flat[kept], row[kept]
    got = values(row, flat)
    ends = np.searchsorted(row, np.arange(len(size) + 1)).tolist()
    parts = []
    for i in range(len(size)):
        places, found = flat[ends[i] : ends[i + 1]] - at[i], got[ends[i] : ends[i + 1]]
        if size[i] and (len(found) <= k or np.partition(found, -k)[-k] < NEAR + MOST_LUCK):
            places = np.arange(int(start[i]), int(size[i]))
            found = values(np.full(len(places), i), at[i] + places)
        parts.append((places, found))
    return parts, total[at[1:]] - total[at[:-1]]


def _alternatives(lattices: Lattices, taken: np.ndarray, barred: list, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each edge taken, one into the same node, none of those barred, drawn by its probability; the mass of all others."""
    node = (lattices.high[taken] - np.uint64(1)) >> np.uint64(32)
    a = np.searchsorted(lattices.high, node << np.uint64(32), "right")
    size = np.searchsorted(lattices.high, (node + np.uint64(1)) << np.uint64(32), "right") - a
    at = np.concatenate(([0], np.cumsum(size)))
    weight = np.exp(lattices.log[np.arange(at[-1]) + np.repeat(a - at[:-1], size)])
    held = np.array([len(x) for x in barred])
    weight[np.concatenate(barred) + np.repeat(at[:-1] - a, held)] = 0.0
    sums = np.concatenate(([0.0], np.cumsum(weight)))
    total = sums[at[1:]] - sums[at[:-1]]
    place = np.clip(np.searchsorted(sums, sums[at[:-1]] + u * total, "right") - 1, at[:-1], at[1:] - 1)
    return a + place - at[:-1], np.maximum(total - weight[place], 0.0)


def _work(lattices: Lattices, texts: list[str], keys: np.ndarray, k: int) -> list[tuple[int, int, np.ndarray, float, float, float]]:
    """(row, sample, piece numbers, log-probability, perturbed value, log-inclusion) of the samples of some texts."""
    raw = np.frombuffer("".join(" " + t for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    raw[raw == SPACE] = OWN_MARK
    raw[raw == 0x20] = SPACE
    row_at = np.concatenate(([0], np.cumsum(sizes)))
    space = raw == SPACE
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    kinds = np.minimum(raw, 128).astype(np.intp)
    begins[1:] |= ~lattices.vocabulary.joins.ravel()[kinds[:-1] * 129 + kinds[1:]]
    begins[row_at[:-1]] = True
    start = np.flatnonzero(begins)
    end = np.append(start[1:], len(raw))
    prefix = _prefix(raw)
    lasts, number = lattices.lasts(raw, start, end, prefix)
    words_at = np.searchsorted(start, row_at)
    nodes = lasts[number]
    row = np.repeat(np.arange(len(texts)), np.diff(words_at))
    token = np.arange(len(nodes)) - words_at[row]
    flat, count = lattices.walk(nodes, _token_keys(keys[row], 0, token))
    n = len(texts)
    with np.errstate(over="ignore"):
        seeds = mix64(keys + np.uint64(0xABCDEF))
    edges, owner = flat, np.repeat(token, count)
    at = np.concatenate(([0], np.cumsum(count)))[words_at]
    rows, value = np.arange(n), -np.log(-np.log(_uniform(seeds)))
    start, barred_mass, barred = np.zeros(n, np.int64), np.full(n, np.nan), [[] for _ in range(n)]
    rounds: list = []  # what each sample popped: edges, words, bounds, rows
    queue: list[list] = [[] for _ in range(n)]  # of each row: (values of parts, their places, sample, place of its edges, start, barred)
    out: list = []
    for sample in range(k):
        with np.errstate(over="ignore"):
            key = mix64(seeds[rows] + np.uint64(1000 * sample + 11))
        parts, log = _split(lattices, edges, at, value, key, start, barred_mass, k)
        rounds.append((edges, owner, at))
        for i, r in enumerate(rows.tolist()):
            a, b = int(at[i]), int(at[i + 1])
            out.append((r, sample, a, b, float(log[i]), float(value[i])))
            queue[r].append((parts[i][1], parts[i][0], sample, a, int(start[i]), barred[i]))
        if sample == k - 1:
            break
        popped: list = []  # row, value, sample and place of the region's edges, place of difference, barred edges
        for r in rows.tolist():
            tops = [float(q[0].max()) if len(q[0]) else -np.inf for q in queue[r]]
            j = int(np.argmax(tops))
            if tops[j] == -np.inf or not texts[r]:
                continue
            found, places, of, a, first, held = queue[r][j]
            best = int(found.argmax())
            place = int(places[best])
            found[best] = -np.inf
            popped.append((r, tops[j], of, a, place, [*(held if place == first else []), int(rounds[of][0][a + place])]))
        if not popped:
            break
        rows, value, start = (np.array([x[c] for x in popped]) for c in (0, 1, 4))
        barred = [x[5] for x in popped]
        with np.errstate(over="ignore"):
            u = _uniform(mix64(seeds[rows] + np.uint64(1000 * sample + 7)))
        edge, barred_mass = _alternatives(lattices, np.array([x[-1] for x in barred]), barred, u)
        split = np.array([int(rounds[of][1][a + place]) for _, _, of, a, place, _ in popped])  # the word of the difference
        count = words_at[rows + 1] - words_at[rows] - split
        ends = np.concatenate(([0], np.cumsum(count)))
        word = np.arange(ends[-1]) + np.repeat(split - ends[:-1], count)
        start_node = nodes[np.repeat(words_at[rows], count) + word]
        start_node[ends[:-1]] = lattices.back[edge]
        tail, tail_count = lattices.walk(start_node, _token_keys(np.repeat(keys[rows], count), sample + 1, word))
        tail_owner = np.repeat(word, tail_count)
        bounds = np.concatenate(([0], np.cumsum(tail_count)))[ends].tolist()
        pieces, owners = [], []
        for i, (_, _, of, a, place, _) in enumerate(popped):
            pieces += (rounds[of][0][a : a + place], edge[i : i + 1], tail[bounds[i] : bounds[i + 1]])
            owners += (rounds[of][1][a : a + place], split[i : i + 1], tail_owner[bounds[i] : bounds[i + 1]])
        edges, owner = np.concatenate(pieces), np.concatenate(owners)
        at = np.concatenate(([0], np.cumsum(start + 1 + np.diff(bounds))))
    # the value that comes next in each queue bounds the sample
    follow = [max((float(q[0].max()) if len(q[0]) else -np.inf) for q in found) for found in queue]
    numbers = [_numbers(lattices, *r) for r in rounds]
    done = []
    for r, sample, a, b, log, got in out:
        x = log - follow[r]
        inclusion = 0.0 if x > 3.5 else (float(np.log(-np.expm1(-np.exp(x)))) if x > -30 else x)
        flat, bounds = numbers[sample]
        ids = flat[bounds[a] : bounds[b]] if texts[r] else flat[:0]
        done.append((r, sample, ids, log if texts[r] else 0.0, got, inclusion if texts[r] else 0.0))
    return done


def _numbers(lattices: Lattices, edges: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece numbers in the order of the texts, and where those of each edge's place begin. A word's edges are drawn from
    its end and are turned round; a character that is no piece gives its bytes."""
    n = len(edges)
    turn = np.diff(owner, prepend=-1) != 0
    turn[at[:-1][at[:-1] < n]] = True
    first = np.flatnonzero(turn)
    size = np.diff(np.append(first, n))
    piece = lattices.piece[edges[np.repeat(2 * first + size - 1, size) - np.arange(n)]]
    odd = np.flatnonzero(piece < 0)
    if not len(odd):
        return piece, np.arange(n + 1)
    wide = [chr(-1 - c).encode("utf-8", "surrogatepass") for c in piece[odd].tolist()]
    sizes = np.ones(n, np.int64)
    sizes[odd] = [len(w) for w in wide]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    out = np.repeat(piece, sizes)
    for k, w in zip(odd.tolist(), wide, strict=True):
        out[bounds[k] : bounds[k + 1]] = [FIRST_BYTE + b for b in w]
    return out, bounds


def read_model(path: str = MODEL) -> bytes:
    proto = Path(path).read_bytes()
    if len(proto) > MAX_MODEL:
        raise ValueError(f"{path} has {len(proto)} bytes; at most {MAX_MODEL} are sent to executors")
    return proto


_FIELDS = "sample int, n_pieces int, log_prob double, perturbed double, log_inclusion double, ids array<int>"


def sample_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, alpha: float = ALPHA, model: str = MODEL, check: bool = False
) -> DataFrame:
    """A row for each row of docs and sampled segmentation: the key column, sample, n_pieces, log_prob, perturbed,
    log_inclusion and ids; with check also decoded_equal, whether decoding the ids gave back every byte. Narrow: no shuffle."""
    fields = _FIELDS + (", decoded_equal boolean" if check else "")
    names = [f.split(" ")[0] for f in fields.split(", ")]
    if key in names:
        raise ValueError(f"the key column may not be named {key}")
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(shared.value, alpha)
        lattices = Lattices(vocabulary)
        for batch in batches:
            data, at = utf8_parts(batch.column("text"))
            texts = batch.column("text").to_pylist()
            keys = batch.column("row_key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            i = 0
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(at, at[i] + WORK_BYTES, "right")) - 1)
                got = _work(lattices, texts[i:j], keys[i:j], k)
                rows = np.array([i + g[0] for g in got])
                flat = np.concatenate([g[2] for g in got]).astype(np.int32)
                lengths = np.array([len(g[2]) for g in got], np.int32)
                bounds = np.concatenate(([0], np.cumsum(lengths)))
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))
                columns = [batch.column("key").take(pa.array(rows)), pa.array([g[1] for g in got], pa.int32()), pa.array(lengths)]
                columns += [pa.array([g[c] for g in got], pa.float64()) for c in (3, 4, 5)] + [lists]
                if check:
                    back, ends = vocabulary.decode(flat, bounds)
                    same = [np.array_equal(back[a:b], data[at[r] : at[r + 1]]) for r, a, b in zip(rows.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                    columns.append(pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, ["key", *names])
                i = j

    kind = docs.schema[key].dataType.simpleString()
    ready = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(key)).alias("row_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return ready.mapInArrow(tidy(run), f"key {kind}, {fields}").withColumnRenamed("key", key)


def decode_pieces(encoded: DataFrame, ids: str = "ids", model: str = MODEL, into: str = "decoded") -> DataFrame:
    """encoded with the text of each row's piece numbers; a null list gives a null text."""
    if into in encoded.columns:
        raise ValueError(f"column {into} exists already")
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(model))

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        sizes = np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)  # a null list has no elements
        data, at = vocabulary_of(shared.value, ALPHA).decode(flat, np.concatenate(([0], np.cumsum(sizes))))
        texts = [data[a:b].tobytes().decode(errors="replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return pa.array([t if x.is_valid else None for t, x in zip(texts, column, strict=True)], pa.string())

    return encoded.withColumn(into, decode(F.col(ids)))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), check=True)


QUERIES = {"op1_sentencepiece": op1_sentencepiece}
