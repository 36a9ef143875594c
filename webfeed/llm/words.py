"""Vectorised words, word hashes and shingles of Arrow text columns (numpy, used inside tasks).

A word is a maximal run of bytes that are ASCII letters or digits (A-Z lower-cased)
or belong to a non-ASCII character: the pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
after lower-casing A-Z. Null text counts as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text handled at a time, so that work arrays stay a few MB whatever the batch holds.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def constants(n: int, salt: int) -> np.ndarray:
    """``n`` odd 64-bit constants, the same in every process."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) | np.uint64(1)


def is_word_byte() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = True
    table[0x80:] = True
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows (nulls are empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) \
        else np.zeros(1, np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES):
    """Row ranges of about ``size`` bytes each (at least one row)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, min(hi, n)
        lo = hi


class Hasher:
    """Word boundaries and 64-bit word hashes; holds its lookup tables, so make one per task."""

    def __init__(self):
        self.word, self.lower = is_word_byte(), lower_table()
        self.byte = constants(256, 1)
        self._power = self._inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._power) < n:
            size = max(n, CHUNK_BYTES + 1)
            for name, base in (("_power", _BASE), ("_inverse", _BASE_INVERSE)):
                seq = np.full(size, base, np.uint64)
                seq[0] = 1
                setattr(self, name, np.cumprod(seq))
        return self._power, self._inverse

    def spans(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends (bytes) of all words, and the first word's index of each row (n + 1 values)."""
        inside = self.word[raw]
        before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[1:-1]
        before[edges[edges < len(raw)]] = False
        after[edges[edges > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, offsets)

    def hashes(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word (equal words, equal hashes) and the first word's index of each row."""
        starts, ends, first = self.spans(raw, offsets)
        return self.hash_spans(self.lower[raw], starts, ends), first

    def hash_spans(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Polynomial hash of the bytes of each span, whatever its position."""
        power, inverse = self._powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.byte[raw] * power[:len(raw)], out=total[1:])
        return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def row_chunks(hasher: Hasher, col: pa.Array, size: int = CHUNK_BYTES):
    """(first row, word hashes, word offsets by row) for chunks of a text column."""
    raw, offsets = text_bytes(col)
    for lo, hi in chunks(offsets, size):
        part = offsets[lo:hi + 1]
        yield lo, *hasher.hashes(raw[part[0]:part[-1]], part - part[0])


def windows(words: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive entries (runs over row ends included)."""
    n = max(0, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for j, c in enumerate(constants(size, salt)):
        h += words[j:j + n] * c
    return mix(h)


def shingles(words: np.ndarray, first: np.ndarray, size: int, salt: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, sorted, and their offsets by row.

    A row of fewer than ``size`` words (but at least one) has one shingle: all its words.
    """
    rows = len(first) - 1
    n = np.diff(first)
    many = np.maximum(n - size + 1, 0)
    total = int(many.sum())
    row = np.repeat(np.arange(rows), many)
    at = np.arange(total) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[:-1], many)
    found = windows(words, size, salt)[at] if total else np.zeros(0, np.uint64)
    few = np.flatnonzero((n > 0) & (n < size))
    if len(few):
        c = constants(size, salt + 1)
        short = np.zeros(len(few), np.uint64)
        for j in range(size - 1):
            has = n[few] > j
            short[has] += words[first[few[has]] + j] * c[j]
        row = np.concatenate([row, few])
        found = np.concatenate([found, mix(short + n[few].astype(np.uint64))])
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    row, found = row[new], found[new]
    return found, np.searchsorted(row, np.arange(rows + 1))


def groups(batches, keys: list[str]):
    """Whole groups of consecutive rows with equal ``keys`` (rows come sorted by them), several at a time."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not len(b):
            continue
        change = np.zeros(len(b), bool)
        for k in keys:
            x = b.column(k).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        last = int(np.flatnonzero(change)[-1]) if change.any() else 0
        same = held and all(held[-1].column(k)[len(held[-1]) - 1].equals(b.column(k)[0]) for k in keys)
        if held and not same:
            yield pa.Table.from_batches(held)
            held = []
        if last:
            yield pa.Table.from_batches([*held, b.slice(0, last)])
            held = []
        held.append(b.slice(last))
    if held:
        yield pa.Table.from_batches(held)


class BitFilter:
    """Bits that remember 64-bit hashes: no hash is missed, few others pass while there are bits enough."""

    #: Bits of the smallest and of the largest filter (64 MB), and for each hash.
    SIZE, MOST, EACH, PROBES = 1 << 25, 1 << 29, 16, 3

    def __init__(self, bits: np.ndarray):
        self.table = bits

    @classmethod
    def size_for(cls, hashes: int) -> int:
        """Bits, a power of two, for a number of hashes; beyond MOST a fuller filter lets more others pass."""
        size = cls.SIZE
        while size < cls.MOST and size < cls.EACH * hashes:
            size *= 2
        return size

    @staticmethod
    def places(h: np.ndarray, probe: int, size: int) -> np.ndarray:
        return mix(h + np.uint64(probe)) % np.uint64(size)

    @classmethod
    def empty(cls, size: int = SIZE) -> np.ndarray:
        return np.zeros(size // 8, np.uint8)

    @staticmethod
    def set_bits(bits: np.ndarray, at: np.ndarray) -> None:
        np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    @classmethod
    def add(cls, bits: np.ndarray, h: np.ndarray) -> None:
        for probe in range(cls.PROBES):
            cls.set_bits(bits, cls.places(h, probe, 8 * len(bits)))

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Places in ``h`` of hashes that may have been added."""
        left = np.arange(len(h))
        for probe in range(self.PROBES):
            at = self.places(h[left], probe, 8 * len(self.table))
            left = left[(self.table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        return left


def filter_places(size: int, slices: int):
    """Task: a column ``hash`` of longs -> the places of their bits, packed by slice of the filter."""
    width = size // slices

    def task(batches):
        for b in batches:
            h = b.column("hash").to_numpy().view(np.uint64)
            at = np.sort(np.concatenate([BitFilter.places(h, probe, size) for probe in range(BitFilter.PROBES)]))
            cut = np.searchsorted(at, np.arange(slices + 1, dtype=np.uint64) * np.uint64(width))
            some = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)),
                 pa.array([(at[cut[s]:cut[s + 1]] - np.uint64(s * width)).astype(np.uint32).tobytes() for s in some], pa.binary())],
                names=["slice", "places"])
    return task


def filter_slices(size: int, slices: int):
    """Task: packed places, each slice's in one task -> the bits of every slice."""
    def task(batches):
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for s, places in zip(b.column("slice").to_pylist(), b.column("places"), strict=True):
                if s not in found:
                    found[s] = BitFilter.empty(size // slices)
                BitFilter.set_bits(found[s], np.frombuffer(places.as_buffer(), np.uint32).astype(np.uint64))
        for s, bits in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([bits.tobytes()], pa.binary())],
                                             names=["slice", "bits"])
    return task
