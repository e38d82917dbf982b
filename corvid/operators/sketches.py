"""Unions of many HyperLogLog sketches inside a task, on the published images of Spark's `hll_sketch_agg`: small sets hold the hashes
of their members (coupons), larger ones a register of a byte for each of 2^lg places."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Coupons held back before they are merged, rows of registers worked on at once.
HELD, ROWS = 1 << 20, 1 << 10


class Sketches:
    """The unions at positions 0 to size - 1. Registers are zeros that take memory once they are written; a set of coupons becomes
    registers beyond three quarters of 2^(lg - 3), as in Spark's own unions, so that estimates are theirs."""

    def __init__(self, lg: int, size: int) -> None:
        self.lg, self.k = lg, 1 << lg
        self.most = 7 if lg < 8 else 3 * (self.k >> 3) >> 2
        self.registers = np.zeros((size, self.k), np.uint8)
        self.dense = np.zeros(size, bool)
        self.coupons, self.waiting, self.n_waiting = np.zeros(0, np.uint64), [], 0

    def add(self, image: bytes, at: np.ndarray) -> None:
        """Unite a sketch with those at distinct positions."""
        mode = image[7] & 3
        if mode == 2:
            self._raise(np.frombuffer(image, np.uint8, self.k, 40), at)
            self.dense[at] = True
            return
        held = np.frombuffer(image, np.uint32, offset=12 if mode else 8)
        held = held[held != 0]
        full = self.dense[at]
        if full.any():
            row = np.zeros(self.k, np.uint8)
            np.maximum.at(row, held & np.uint32(self.k - 1), (held >> np.uint32(26)).astype(np.uint8))
            self._raise(row, at[full])
            at = at[~full]
        held = held.astype(np.uint64)
        for i in range(0, len(at), ROWS):
            self.waiting.append(((at[i : i + ROWS].astype(np.uint64) << np.uint64(32))[:, None] | held).ravel())
            self.n_waiting += len(self.waiting[-1])
            if self.n_waiting > max(HELD, len(self.coupons) // 2):
                self._merge()

    def _raise(self, row: np.ndarray, at: np.ndarray) -> None:
        for i in range(0, len(at), ROWS):
            part = at[i : i + ROWS]
            self.registers[part] = np.maximum(self.registers[part], row)

    def _merge(self) -> None:
        found = np.sort(np.concatenate([self.coupons, *self.waiting]))
        found = found[np.concatenate(([True], found[1:] != found[:-1]))[: len(found)]]
        at = (found >> np.uint64(32)).astype(np.int64)
        self.dense |= np.bincount(at, minlength=len(self.dense)) > self.most
        full = self.dense[at]
        value = (found[full] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        np.maximum.at(self.registers.reshape(-1), at[full] * self.k + (value & (self.k - 1)), (value >> 26).astype(np.uint8))
        self.coupons, self.waiting, self.n_waiting = found[~full], [], 0

    def images(self, at: np.ndarray) -> Iterator[bytes]:
        """The unions at the positions, in their order."""
        if self.waiting:
            self._merge()
        places, n = self.coupons >> np.uint64(32), len(at)
        low, high = np.searchsorted(places, at.astype(np.uint64)), np.searchsorted(places, at.astype(np.uint64), "right")
        coupons = (self.coupons & np.uint64(0xFFFFFFFF)).astype("<u4")
        powers = 0.5 ** np.arange(64)
        for i in range(0, n, ROWS):
            part = at[i : i + ROWS]
            rows = self.registers[part[self.dense[part]]]
            sums = [np.where(np.arange(64) < 32, powers, 0)[rows].sum(axis=1), np.where(np.arange(64) < 32, 0, powers)[rows].sum(axis=1)]
            facts = zip(rows, *sums, (rows == 0).sum(axis=1), strict=True)
            for j, p in enumerate(part, i):
                yield self._full(*next(facts)) if self.dense[p] else self._small(coupons[low[j] : high[j]])

    def _small(self, coupons: np.ndarray) -> bytes:
        n = len(coupons)
        if n < 8:
            return bytes([2, 1, 7, self.lg, 3, 8, n, 8]) + coupons.tobytes()
        table = max(5, int(np.ceil(np.log2(4 * n / 3))))
        return bytes([3, 1, 7, self.lg, table, 8, 0, 9]) + np.array([n], "<i4").tobytes() + coupons.tobytes()

    def _full(self, row: np.ndarray, low: float, high: float, zeros: int) -> bytes:
        return bytes([10, 1, 7, self.lg, 0, 16, 0, 10]) + np.array([0, low, high], "<f8").tobytes() + np.array([zeros, 0], "<i4").tobytes() + row.tobytes()

