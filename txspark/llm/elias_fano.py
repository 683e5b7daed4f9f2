"""Elias-Fano sequences, and a trie of n-grams whose levels are such sequences, in memory-mapped files."""

from __future__ import annotations

import io
import json
import mmap

import numpy as np

#: Values whose bits are spread out at a time.
PART = 1 << 16
#: Low bits of a value that eight bytes hold from any bit on.
MOST_LOW = 56


class EliasFano:
    """A non-decreasing sequence of integers below ``universe``: low bits packed, high parts in unary, about
    2 + log2(universe / n) bits each."""

    def __init__(self, n: int, low_bits: int, lows: np.ndarray, highs: np.ndarray):
        self.n, self.low_bits, self.lows, self.highs = n, low_bits, lows, highs

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = min(max(0, (int(universe) // max(n, 1)).bit_length() - 1), MOST_LOW)
        places = np.arange(low_bits, dtype=np.uint64)
        bits = np.zeros((n, low_bits), np.uint8)
        for at in range(0, n, PART):
            bits[at : at + PART] = (values[at : at + PART, None] >> places) & np.uint64(1)
        lows = np.append(np.packbits(bits.ravel(), bitorder="little"), np.zeros(8, np.uint8))
        unary = np.zeros(n + (int(universe) >> low_bits) + 1, np.uint8)
        unary[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        return cls(n, low_bits, lows, np.packbits(unary, bitorder="little"))

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at.astype(np.int64) * self.low_bits
        window = self.lows[(bit >> 3)[:, None] + np.arange(8)]
        return (np.ascontiguousarray(window).view("<u8").ravel() >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def _starts(self) -> np.ndarray:
        """For each value of the high part, the number of elements below it (select on the zeros of the unary part)."""
        zeros = np.flatnonzero(np.unpackbits(self.highs, bitorder="little") == 0)
        return zeros - np.arange(len(zeros))

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(np.arange(self.n))

    def access(self, at: np.ndarray) -> np.ndarray:
        """The values at some places (select on the ones of the unary part)."""
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))
        return ((ones[at] - at).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(at)

    def successor(self, queries: np.ndarray, first: np.ndarray | None = None, end: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each query the place of the first element that is not smaller, and whether it is equal; among the places from ``first`` to
        ``end``, if given.

        The high part gives a run of elements with equal high parts, in which the low bits are searched by bisection.
        """
        queries = queries.astype(np.uint64)
        if not self.n:
            return np.zeros(len(queries), np.int64), np.zeros(len(queries), bool)
        ends = np.minimum(self._starts(), self.n)
        high = np.minimum(queries >> np.uint64(self.low_bits), np.uint64(len(ends) - 1)).astype(np.int64)
        want = queries & np.uint64((1 << self.low_bits) - 1)
        lo, hi = np.where(high > 0, ends[high - 1], 0), ends[high]
        if first is not None:
            lo, hi = np.maximum(lo, first), np.minimum(hi, end)
        last = hi.copy()
        for _ in range(int(np.max(hi - lo, initial=0)).bit_length()):
            open_ = lo < hi
            mid = (lo + hi) >> 1
            less = open_ & (self._low(np.minimum(mid, self.n - 1)) < want)
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        inside = lo < last
        return lo, inside & (self._low(np.minimum(lo, self.n - 1)) == want) & (high == (queries >> np.uint64(self.low_bits)).astype(np.int64))

    def parts(self) -> tuple[dict, list[np.ndarray]]:
        return {"n": self.n, "low_bits": self.low_bits}, [self.lows, self.highs]


class NgramTrie:
    """A trie of word tuples. Level k holds, for each node of level k - 1 in order, its successors in the order of their ids.

    A level is two monotone sequences: pointers, the place of the first successor of each node, and the successors' ids, each plus its
    node's place times the number of ids. A successor is searched in the range that its context's pointers give. Each full tuple has a quantised value.
    """

    def __init__(self, vocabulary: EliasFano, pointers: list[EliasFano], levels: list[EliasFano], values: np.ndarray):
        self.vocabulary, self.pointers, self.levels, self.values = vocabulary, pointers, levels, values

    @classmethod
    def build(cls, columns: list[np.ndarray], values: np.ndarray) -> NgramTrie:
        """``columns``: the words of the tuples as 64-bit integers, first words first; tuples are sorted and distinct."""
        words = np.unique(np.concatenate(columns)) if len(values) else np.zeros(0, np.uint64)
        size = max(len(words), 1)
        pointers, levels, parent, nodes = [], [], np.zeros(len(values), np.uint64), 1
        for column in columns:
            key = parent * np.uint64(size) + np.searchsorted(words, column).astype(np.uint64)
            new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
            levels.append(EliasFano.build(key[new], nodes * size))
            starts = np.searchsorted(parent[new], np.arange(nodes + 1, dtype=np.uint64))
            pointers.append(EliasFano.build(starts, int(new.sum()) + 1))
            parent = (np.cumsum(new) - 1).astype(np.uint64)
            nodes = int(new.sum())
        return cls(EliasFano.build(words, 1 << 64), pointers, levels, values)

    def find(self, columns: list[np.ndarray]) -> np.ndarray:
        """The place of each tuple among the stored ones, or -1."""
        size = np.uint64(max(self.vocabulary.n, 1))
        at, found = np.zeros(len(columns[0]), np.int64), np.ones(len(columns[0]), bool)
        for column, pointers, level in zip(columns, self.pointers, self.levels, strict=True):
            if not level.n:
                return np.full(len(at), -1)
            distinct, back = np.unique(column, return_inverse=True)
            ids, known = self.vocabulary.successor(distinct)
            found &= known[back]
            node = np.where(found, at, 0)
            begin, end = pointers.access(node).astype(np.int64), pointers.access(node + 1).astype(np.int64)
            at, hit = level.successor(node.astype(np.uint64) * size + np.where(found, ids[back], 0).astype(np.uint64), begin, end)
            found &= hit
        return np.where(found, at, -1)

    def write(self, file: io.BufferedIOBase) -> None:
        """A line of JSON with the lengths, then all arrays one after the other."""
        sequences = [self.vocabulary, *self.pointers, *self.levels]
        arrays = [a for s in sequences for a in s.parts()[1]]
        head = {"sequences": [s.parts()[0] for s in sequences], "lengths": [len(a) for a in arrays], "values": len(self.values), "kind": self.values.dtype.str}
        file.write(json.dumps(head).encode() + b"\n")
        for a in [*arrays, self.values]:
            file.write(a.tobytes())
        file.flush()

    @classmethod
    def open(cls, file: io.BufferedRandom) -> NgramTrie:
        """Map a written trie into memory; its levels are read as they are searched."""
        view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        head = json.loads(view[: view.find(b"\n")])
        at, arrays = view.find(b"\n") + 1, []
        for length in head["lengths"]:
            arrays.append(np.frombuffer(view, np.uint8, length, at))
            at += length
        sequences = [EliasFano(s["n"], s["low_bits"], *arrays[2 * k : 2 * k + 2]) for k, s in enumerate(head["sequences"])]
        half = len(sequences) // 2
        return cls(sequences[0], sequences[1 : half + 1], sequences[half + 1 :], np.frombuffer(view, head["kind"], head["values"], at))
