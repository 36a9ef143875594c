"""Benchmark decontamination by spaced-seed hashing, tolerant of substituted words.

A seed is a fixed mask laid over consecutive words; only the words under its ones are hashed, so a
substitution under a zero does not disturb it. Seeds of test items and of training documents are
joined; every joined pair of places gives a diagonal (document place minus item place), and along each
diagonal the words are compared one by one. A document overlaps an item where some ``WINDOW``
consecutive words (all of the item, if it is shorter) agree in at least ``AGREE`` of their places.

The masks together hit every window of 12 to 20 words with as many substitutions as ``AGREE`` allows,
wherever these are (the tests try all of them), so no overlap is missed.

Items of ``MIN_EXACT_WORDS`` to 11 words overlap where all their words stand in a row: their one seed hashes
every word. A character of a script written without spaces is a word of its own here.

Documents keep only seeds that a bit filter of the test seeds (a fixed number of bits, whatever the
benchmark's size) lets through; what it lets through wrongly is removed by the join. The join is a
broadcast of the test seeds where their count allows it, else a shuffle; results are the same.

Edge cases: null texts are empty; items of fewer words than ``MIN_EXACT_WORDS`` are trivial and match
nothing; rows that agree in doc_id and text are one document, items that agree in item_id and
text one item; null ids are values like any other; repeated ids with other texts are other documents or
items, reported under their id; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfeed.llm import words as W
from webfeed.llm.tables import bit_filter, keep_columns, table, text_hashes, with_key, written

#: Ones are the word places that are hashed.
MASKS = ("1111000101", "10000011111", "110010001101", "11100111", "111101001")
WINDOW, AGREE, MIN_ITEM_WORDS = 20, 0.8, 12
#: Items from here to MIN_ITEM_WORDS are found word by word; shorter ones are trivial.
MIN_EXACT_WORDS = 3
# First and last code points of scripts without spaces (three bytes each), with their signs.
UNSPACED = [(0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3000, 0x312F),
            (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xA980, 0xA9DF),
            (0xA9E0, 0xA9FF), (0xAA00, 0xAADF), (0xF900, 0xFAFF), (0xFF00, 0xFFEF)]
#: Test seeds that may be sent to every task (24 bytes each).
BROADCAST_SEEDS = 1_000_000


class CharHasher(W.Hasher):
    """Words as elsewhere, but every character of a script without spaces is one."""

    def __init__(self):
        super().__init__()
        self.unspaced = np.zeros(1 << 16, bool)
        for lo, hi in UNSPACED:
            self.unspaced[lo:hi + 1] = True

    def spans(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts, ends, first = super().spans(raw, offsets)
        at = np.flatnonzero((raw >= 0xE0) & (raw != 0xE2))
        if not len(at):
            return starts, ends, first
        a, b, c = (np.append(raw, np.zeros(2, np.uint8))[at + i].astype(np.int64) for i in range(3))
        three = (a < 0xF0) & self.unspaced[(a & 0xF) << 12 | (b & 0x3F) << 6 | c & 0x3F]
        four = (a == 0xF0) & (b >= 0xA0)  # planes 2 and 3: ideographs
        cuts = np.unique(np.concatenate([at[three], at[three] + 3, at[four], at[four] + 4]))
        span = np.searchsorted(starts, cuts, side="right") - 1
        cuts = cuts[(starts[span] < cuts) & (cuts < ends[span])]
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
        return starts, ends, np.searchsorted(starts, offsets)


def seeds(words: np.ndarray, first: np.ndarray, masks: tuple[str, ...], salt: int = 41):
    """(seed hashes, row, place in the row) of every mask at every place where it fits in its row."""
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][rows] if len(rows) else first[:0]
    for number, mask in enumerate(masks):
        n = max(0, len(words) - len(mask) + 1)
        ones = [i for i, c in enumerate(mask) if c == "1"]
        h = np.zeros(n, np.uint64)
        for c, i in zip(W.constants(len(ones), salt + number), ones, strict=True):
            h += words[i:i + n] * c
        at = np.flatnonzero(np.arange(n) + len(mask) <= end[:n])
        yield W.mix(h[at]), rows[at], at - first[rows[at]]


def _whole(words: np.ndarray, first: np.ndarray, n: int):
    """Seeds of every run of ``n`` words."""
    return next(seeds(words, first, ("1" * n,), 60 + n))


def _item_seeds(batches):
    hasher = CharHasher()
    for b in batches:
        item = b.column("item").to_numpy()
        for lo, hashes, first in W.row_chunks(hasher, b.column("text")):
            n = np.diff(first)
            found = [(x, n >= MIN_ITEM_WORDS) for x in seeds(hashes, first, MASKS)]
            found += [(_whole(hashes, first, k), n == k) for k in range(MIN_EXACT_WORDS, MIN_ITEM_WORDS) if (n == k).any()]
            for (h, row, at), wanted in found:
                on = wanted[row]
                h, row, at = h[on], row[on], at[on]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(item[lo + row]), pa.array(at.astype(np.int32))],
                    names=["seed", "item", "place"])


def _item_words(batches):
    hasher = CharHasher()
    for b in batches:
        out = []
        for _, hashes, first in W.row_chunks(hasher, b.column("text")):
            out += [hashes[a:z].tobytes() for a, z in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("item"), b.column("item_id"), pa.array(out, pa.binary())],
                                         names=["item", "item_id", "item_words"])


def _hit_docs(bits, short: list[int]):
    """Task: documents with seeds that the filter lets through -> their words and those seeds.

    ``short``: numbers of words of the items that are found word by word; of their seeds a document's first place counts.
    """
    def task(batches):
        known = W.BitFilter(np.frombuffer(bits.value, np.uint8))
        hasher = CharHasher()
        for b in batches:
            for lo, hashes, first in W.row_chunks(hasher, b.column("text")):
                found = []
                for h, row, at in seeds(hashes, first, MASKS):
                    on = known.holds(h)
                    found.append((h[on], row[on], at[on]))
                for n in short:
                    h, row, at = _whole(hashes, first, n)
                    on = known.holds(h)
                    on = on[np.lexsort((at[on], h[on], row[on]))]
                    new = np.ones(len(on), bool)
                    new[1:] = (h[on[1:]] != h[on[:-1]]) | (row[on[1:]] != row[on[:-1]])
                    found.append((h[on[new]], row[on[new]], at[on[new]]))
                h, row, at = (np.concatenate(x) for x in zip(*found, strict=True))
                if not len(h):
                    continue
                order = np.argsort(row, kind="stable")
                h, row, at = h[order], row[order], at[order]
                some, cut = np.unique(row, return_index=True)
                offsets = pa.array(np.append(cut, len(row)).astype(np.int32))
                hits = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(at.astype(np.int32))], names=["seed", "at"]))
                pick = pa.array(lo + some)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).take(pick) for c in ("doc_id", "k1", "k2")),
                     pa.array([hashes[first[r]:first[r + 1]].tobytes() for r in some], pa.binary()), hits],
                    names=["doc_id", "k1", "k2", "words", "hits"])
    return task


def _compare(window: int, agree: float):
    """Task: document words, item words and a diagonal -> the agreeing stretch, if there is one."""
    def task(batches):
        for b in batches:
            keep, best, lo, hi = [], [], [], []
            words, items = b.column("words"), b.column("item_words")
            for r, diag in enumerate(b.column("diagonal").to_pylist()):
                doc = np.frombuffer(words[r].as_buffer(), np.uint64)
                item = np.frombuffer(items[r].as_buffer(), np.uint64)
                w = min(window, len(item))
                a, z = max(0, diag), min(len(doc), diag + len(item))
                if z - a < w:
                    continue
                same = np.concatenate([[0], np.cumsum(doc[a:z] == item[a - diag:z - diag])])
                count = same[w:] - same[:-w]
                need = math.ceil(agree * w - 1e-9) if len(item) >= MIN_ITEM_WORDS else w
                good = np.flatnonzero(count >= need)
                if len(good):
                    keep.append(r)
                    best.append(int(same[good[-1] + w] - same[good[0]]))
                    lo.append(a + int(good[0]))
                    hi.append(a + int(good[-1]) + w)
            pick = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(pick) for c in ("doc_id", "k1", "k2", "item_id")), pa.array(best, pa.int64()),
                 pa.array(lo, pa.int64()), pa.array(hi, pa.int64())],
                names=["doc_id", "k1", "k2", "item_id", "n_equal", "first_word", "end_word"])
    return task


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, agree: float = AGREE,
             broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """(doc_id, k1, k2, item_id, n_equal, first_word, end_word): every document and item that overlap.

    Words count from 0; the stretch is that of the diagonal with the most equal words.
    """
    spark = docs.sparkSession
    h1, h2 = text_hashes(F.col("text"))
    items = written(spark, benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                                            F.coalesce("text", F.lit("")).alias("text"), h1.alias("k1"), h2.alias("k2"))
                    .dropDuplicates(["item_id", "k1", "k2"])
                    .select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "items")
    words = written(spark, items.mapInArrow(_item_words, "item long, item_id long, item_words binary")
                    .where(F.length("item_words") >= 8 * MIN_EXACT_WORDS), "item-words")
    n_words = (F.length("item_words") / 8).cast("int").alias("n")
    short = sorted(r["n"] for r in words.select(n_words).where(F.col("n") < MIN_ITEM_WORDS).distinct().collect())
    long_enough = items.join(words.select("item"), "item", "left_semi")
    test = written(spark, long_enough.mapInArrow(_item_seeds, "seed long, item long, place int"), "item-seeds")
    sent = spark.sparkContext.broadcast(bit_filter(test.select(F.col("seed").alias("hash")).distinct()))
    hit = written(spark, with_key(docs).mapInArrow(
        _hit_docs(sent, short), "doc_id long, k1 long, k2 long, words binary, hits array<struct<seed: long, at: int>>"), "hits")
    if test.count() <= broadcast_seeds:
        test = F.broadcast(test)
    near = hit.select("doc_id", "k1", "k2", F.inline("hits")).join(test, "seed") \
        .select("doc_id", "k1", "k2", "item", (F.col("at") - F.col("place")).alias("diagonal")).distinct()
    hit = hit.select("doc_id", "k1", "k2", "words").dropDuplicates(["doc_id", "k1", "k2"])
    n, d = near.alias("n"), hit.alias("d")
    same = (F.col("n.k1") == F.col("d.k1")) & (F.col("n.k2") == F.col("d.k2")) \
        & F.col("n.doc_id").eqNullSafe(F.col("d.doc_id"))
    pairs = n.join(d, same).select("d.doc_id", "d.k1", "d.k2", "words", "item", "diagonal").join(words, "item")
    found = pairs.select("doc_id", "k1", "k2", "words", "item_id", "item_words", "diagonal").mapInArrow(
        _compare(window, agree),
        "doc_id long, k1 long, k2 long, item_id long, n_equal long, first_word long, end_word long")
    best = F.max(F.struct("n_equal", (-F.col("first_word")).alias("a"), (-F.col("end_word")).alias("z"))).alias("b")
    return found.groupBy("doc_id", "k1", "k2", "item_id").agg(best).select(
        "doc_id", "k1", "k2", "item_id", F.col("b.n_equal").alias("n_equal"), (-F.col("b.a")).alias("first_word"),
        (-F.col("b.z")).alias("end_word"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``docs`` without the documents that overlap any benchmark item."""
    return keep_columns(docs, overlaps(docs, benchmark, **parameters), "left_anti")


def op1_decontaminate(spark, sf_dir):
    """Every document of ``documents`` with every item of ``benchmark`` that it overlaps."""
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_equal", "first_word", "end_word").distinct()
