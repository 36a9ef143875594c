"""Repeated passages by sparse suffix arrays.

Suffixes are kept only at anchors: words where a hashed run of ``GRAM`` words is the smallest of some
``MIN_WORDS - GRAM + 1`` consecutive runs (leftmost, if equal). Every stretch of ``MIN_WORDS`` words has
the anchor of its own smallest run, at the same place in every copy, so two copies always meet there.

Suffixes that share their run are sorted by the words to the right; comparing neighbours gives the
lengths of common prefixes, and the stretches of the order where these reach a length are intervals of
the suffix array. Within an interval the match is extended to the left by comparing hashes of the words
there. A suffix is thus found to repeat exactly where ``MIN_WORDS`` words around its anchor occur at
another place, and the union over anchors is every word that lies in a repeated stretch of that length.

Anchors whose whole surroundings (all words that can matter) occur several times are counted first, and
only one of each kind takes part in sorting; a passage in a third of all documents is a few kinds.
Runs with more than ``SORT_MOST`` kinds of surroundings are not sorted in one task: their stretches are
compared by hash in a shuffle, with the same result.

Edge cases: null texts are empty; texts of fewer than ``MIN_WORDS`` words have no anchors and no spans;
rows that agree in doc_id and text are copies of each other like any others; null doc_ids are values
(``first_id`` leaves them out); other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webfeed.llm import words as W
from webfeed.llm.tables import bit_filter, table, with_key, written

MIN_WORDS, GRAM = 50, 8
SORT_MOST = 100_000
#: Anchors whose surroundings a task holds at a time.
AT_ONCE = 1 << 14
_PLACE = np.uint64((1 << 24) - 1)


def anchors(grams: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """Places selected in the rows of ``grams``: the smallest gram of every ``window`` in a row, leftmost if equal."""
    n = len(grams)
    if n < window:
        return np.zeros(0, np.int64)
    place = np.arange(n, dtype=np.uint64)
    least = (grams & ~_PLACE) | (place & _PLACE)
    width = 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if window > width:
        least = np.minimum(least[:width - window], least[window - width:])
    count = np.maximum(np.diff(first) - window + 1, 0)
    starts = np.arange(int(count.sum())) + np.repeat(first[:-1] - (np.cumsum(count) - count), count)
    found = (least[starts] & _PLACE).astype(np.int64)
    low = starts & int(_PLACE)
    return np.unique(starts - low + found + (found < low) * (1 << 24))


class Surroundings:
    """Anchors of text chunks with the words around them."""

    def __init__(self, min_words: int, gram: int):
        self.hasher, self.gram, self.side = W.Hasher(), gram, min_words - gram

    def __call__(self, col: pa.Array):
        """(first row, row, place in the row, run hash, left words, right words, words by row) for each chunk.

        Left words go outwards; places outside the text are 0.
        """
        for lo, hashes, first in W.row_chunks(self.hasher, col):
            n = np.diff(first)
            count = np.maximum(n - self.gram + 1, 0)
            at = np.arange(int(count.sum())) + np.repeat(first[:-1] - (np.cumsum(count) - count), count)
            grams = W.windows(hashes, self.gram, 51)[at] if len(at) else np.zeros(0, np.uint64)
            found = anchors(grams, np.concatenate([[0], np.cumsum(count)]), self.side + 1)
            place = at[found]
            row = np.searchsorted(first, place, side="right") - 1
            short = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

            def around(offsets, pick, place=place, row=row, first=first, short=short):
                q = place[pick, None] + offsets[None, :]
                ok = (q >= first[:-1][row[pick]][:, None]) & (q < first[1:][row[pick]][:, None])
                return np.where(ok, short[np.clip(q, 0, max(0, len(short) - 1))], np.uint32(0))

            yield lo, row, place - first[row], grams[found], around, n

    def parts(self, around, run: np.ndarray, pick: np.ndarray):
        """(places in ``run``, left words, right words, hash of the surroundings) of some anchors at a time."""
        for lo in range(0, len(pick), AT_ONCE):
            part = pick[lo:lo + AT_ONCE]
            left = around(-1 - np.arange(self.side), part)
            right = around(self.gram + np.arange(self.side), part)
            yield part, left, right, W.mix(run[part] + W.mix(_prefix_hashes(left)[:, -1]) * np.uint64(3)
                                           + W.mix(_prefix_hashes(right)[:, -1]) * np.uint64(5))


def _prefix_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, 2, ... words of each row."""
    out = np.zeros((len(words), words.shape[1] + 1), np.uint64)
    for j in range(words.shape[1]):
        out[:, j + 1] = W.mix(out[:, j] + words[:, j].astype(np.uint64) + np.uint64(j + 1 << 33))
    return out


def _anchor_hash(doc_id: pa.Array, k1: np.ndarray, place: np.ndarray) -> np.ndarray:
    known = doc_id.fill_null(0).to_numpy().view(np.uint64)
    return W.mix(W.mix(known + np.uint64(1)) ^ k1.view(np.uint64)) + W.mix(place.view(np.uint64))


def _anchor_lists(min_words: int, gram: int):
    """Task: texts -> the anchors of each: run, surroundings (as hashes) and place."""
    def task(batches):
        get = Surroundings(min_words, gram)
        for b in batches:
            for lo, row, place, run, around, n in get(b.column("text")):
                kind = np.zeros(len(run), np.uint64)
                for part, _, _, value in get.parts(around, run, np.arange(len(run))):
                    kind[part] = value
                some, cut = np.unique(row, return_index=True)
                if not len(some):
                    continue
                pick = pa.array(lo + some)
                lists = [pa.ListArray.from_arrays(pa.array(np.append(cut, len(row)).astype(np.int32)), pa.array(x))
                         for x in (run.view(np.int64), kind.view(np.int64), place)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).take(pick) for c in ("doc_id", "k1", "k2")), pa.array(n[some]), *lists],
                    names=["doc_id", "k1", "k2", "n_words", "run", "kind", "place"])
    return task


def _repeated_anchors(bits):
    """Task: anchor lists -> a row for every anchor whose run passes the filter of repeated runs."""
    def task(batches):
        known = W.BitFilter(np.frombuffer(bits.value, np.uint8))
        for b in batches:
            lists = [b.column(c) for c in ("run", "kind", "place")]
            row = lists[0].value_parent_indices().to_numpy()
            run, kind, place = (x.flatten() for x in lists)
            on = known.holds(run.to_numpy().view(np.uint64))
            pick, at = pa.array(row[on]), pa.array(on)
            yield pa.RecordBatch.from_arrays(
                [run.take(at), kind.take(at), place.take(at),
                 *(b.column(c).take(pick) for c in ("doc_id", "k1", "k2", "n_words"))],
                names=["run", "kind", "place", "doc_id", "k1", "k2", "n_words"])
    return task


def _contexts(min_words: int, gram: int, bits):
    """Task: texts -> left and right words of the anchors that the filter lets through."""
    def task(batches):
        known = W.BitFilter(np.frombuffer(bits.value, np.uint8))
        get = Surroundings(min_words, gram)
        for b in batches:
            k1 = b.column("k1").to_numpy()
            for lo, row, place, run, around, _ in get(b.column("text")):
                docs = b.column("doc_id").take(pa.array(lo + row))
                on = known.holds(_anchor_hash(docs, k1[lo + row], place))
                for part, left, right, kind in get.parts(around, run, on):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(run[part].view(np.int64)), pa.array(kind.view(np.int64)), docs.take(pa.array(part)),
                         pa.array([x.tobytes() for x in left], pa.binary()),
                         pa.array([x.astype(">u4").tobytes() for x in right], pa.binary())],
                        names=["run", "kind", "doc_id", "left", "right"])
    return task


def _hash_anchors(batches):
    for b in batches:
        h = _anchor_hash(b.column("doc_id"), b.column("k1").to_numpy(), b.column("place").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["hash"])


def _words_of(t: pa.Table, side: int) -> tuple[np.ndarray, np.ndarray]:
    left = np.frombuffer(b"".join(t["left"].to_pylist()), np.uint32).reshape(t.num_rows, side)
    right = np.frombuffer(b"".join(t["right"].to_pylist()), ">u4").reshape(t.num_rows, side).astype(np.uint32)
    return left, right


def _match(min_words: int, gram: int):
    """Task: suffixes sorted by run and right words -> how far each repeats, left and right of its anchor."""
    side = min_words - gram

    def task(batches):
        for t in W.groups(batches, ["run"]):
            run, kind = t["run"].to_numpy(), t["kind"].to_numpy()
            new = np.unique(np.stack([run, kind], 1), axis=0, return_index=True)[1]
            t = t.take(pa.array(np.sort(new)))  # the filter may let a kind through more than once
            if t.num_rows < 2:
                continue
            run, kind = t["run"].to_numpy(), t["kind"].to_numpy()
            left, right = _words_of(t, side)
            n_left, n_right = (left > 0).sum(1), (right > 0).sum(1)
            # Common words to the right of neighbours in the suffix order.
            common = np.zeros(len(run), np.int64)
            common[1:] = np.cumprod(right[1:] == right[:-1], axis=1).sum(1)
            common[1:][run[1:] != run[:-1]] = -1
            common[0] = -1
            outwards = _prefix_hashes(left)
            none = np.iinfo(np.int64).max
            ids = t["doc_id"].fill_null(none).to_numpy()
            low = np.full(len(run), none)
            most = np.full(len(run), -1)
            least = np.full(len(run), side + 1)
            for a in range(side + 1):  # a words to the left, the run, side - a words to the right
                interval = np.cumsum(common < side - a).astype(np.uint64)
                at = np.flatnonzero((n_left >= a) & (n_right >= side - a))
                h = W.mix(outwards[at, a] + W.mix(interval[at]))
                order = np.lexsort((ids[at], h))
                at, h = at[order], h[order]
                head = np.ones(len(h), bool)
                head[1:] = h[1:] != h[:-1]
                start = np.flatnonzero(head)
                size = np.diff(np.append(start, len(h)))
                group = np.repeat(np.arange(len(start)), size)
                twice = size[group] > 1
                me = at[twice]
                most[me] = np.maximum(most[me], a)
                least[me] = np.minimum(least[me], a)
                low[me] = np.minimum(low[me], ids[at[start[group[twice]]]])
            got = np.flatnonzero(most >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(run[got]), pa.array(kind[got]), pa.array(most[got]), pa.array(min_words - least[got]),
                 pa.array(low[got], mask=low[got] == none)],
                names=["run", "kind", "before", "after", "first_id"])
    return task


def _stretches(min_words: int, gram: int):
    """Task: suffixes of runs with very many kinds -> a hash for every stretch around the anchor."""
    side = min_words - gram

    def task(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            if not t.num_rows:
                continue
            run, kind = t["run"].to_numpy(), t["kind"].to_numpy()
            left, right = _words_of(t, side)
            out, onwards = _prefix_hashes(left), _prefix_hashes(right)
            for a in range(side + 1):
                on = np.flatnonzero(((left > 0).sum(1) >= a) & ((right > 0).sum(1) >= side - a))
                h = W.mix(out[on, a] + W.mix(onwards[on, side - a]) + np.uint64(a))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(run[on]), pa.array(kind[on]), pa.array(np.full(len(on), a, np.int64)),
                     pa.array(h.view(np.int64)), t["doc_id"].combine_chunks().take(pa.array(on))],
                    names=["run", "kind", "a", "h", "doc_id"])
    return task


_EXTENT = "run long, kind long, before long, after long, first_id long"


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM,
                   sort_most: int = SORT_MOST) -> DataFrame:
    """(doc_id, k1, k2, first_word, end_word, first_id): the stretches of each row's text that repeat elsewhere.

    Every word of a span lies in ``min_words`` consecutive words that occur at another place, in another
    row or the same one; spans that touch are one. ``first_id``: the smallest doc_id that holds ``min_words``
    words of the span (it may be the row's own).
    """
    spark = docs.sparkSession
    keyed = with_key(docs)
    listed = written(spark, keyed.mapInArrow(
        _anchor_lists(min_words, gram), "doc_id long, k1 long, k2 long, n_words long, run array<long>, "
        "kind array<long>, place array<long>"), "anchors")
    runs = listed.select(F.explode("run").alias("run")).groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = spark.sparkContext.broadcast(bit_filter(runs.select(F.col("run").alias("hash"))))
    found = listed.mapInArrow(_repeated_anchors(repeated), "run long, kind long, place long, doc_id long, k1 long, "
                                                           "k2 long, n_words long")
    spot = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "k1", "k2", "place")  # null ids last
    kinds = written(spark, found.groupBy("run", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.min(spot).alias("low")), "kinds")
    several = written(spark, kinds.groupBy("run").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "several")
    contested = written(spark, kinds.join(several, "run").select(
        "run", "kind", "c", "low.doc_id", "low.k1", "low.place"), "contested")
    wanted = spark.sparkContext.broadcast(bit_filter(
        contested.select("doc_id", "k1", "place").mapInArrow(_hash_anchors, "hash long")))
    context = keyed.mapInArrow(_contexts(min_words, gram, wanted),
                               "run long, kind long, doc_id long, left binary, right binary")
    big = several.where(F.col("c") > sort_most).select("run")
    huge = not big.isEmpty()
    if huge:
        context = written(spark, context, "contexts")
    usual = context.join(big, "run", "left_anti") if huge else context
    extents = usual.repartition("run").sortWithinPartitions("run", "right", "left") \
        .mapInArrow(_match(min_words, gram), _EXTENT)
    if huge:
        each = context.join(big, "run", "left_semi").dropDuplicates(["run", "kind"]).mapInArrow(
            _stretches(min_words, gram), "run long, kind long, a long, h long, doc_id long")
        shared = each.groupBy("run", "a", "h").agg(
            F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("one")).where("n > 1")
        extents = extents.union(each.join(shared, ["run", "a", "h"]).groupBy("run", "kind").agg(
            F.max("a").alias("before"), (min_words - F.min("a")).alias("after"), F.min("one").alias("first_id")))
    extents = written(spark, extents, "extents")
    # Whole surroundings repeat where a kind occurs several times; else what the sorting found does.
    side = min_words - gram
    often = F.col("n") > 1
    told = written(spark, kinds.join(extents, ["run", "kind"], "left").where(often | F.col("before").isNotNull()).select(
        "run", "kind", F.when(often, F.lit(side)).otherwise(F.col("before")).alias("before"),
        F.when(often, F.lit(min_words)).otherwise(F.col("after")).alias("after"),
        F.least("low.doc_id", "first_id").alias("first_id")), "told")  # Spark can split a kind that very many share
    # Rows that agree in doc_id and text have the same spans: these are found once, and given to every row.
    spans = found.join(told, ["run", "kind"]).select(
        "doc_id", "k1", "k2", (F.col("place") - F.least("place", "before")).alias("a"),
        F.least(F.col("place") + F.col("after"), "n_words").alias("z"), "first_id").distinct()
    row = Window.partitionBy("doc_id", "k1", "k2").orderBy("a", "z")
    islands = spans.withColumn("reach", F.max("z").over(row.rowsBetween(Window.unboundedPreceding, -1))) \
        .withColumn("island", F.sum(F.when(F.col("a") <= F.col("reach"), 0).otherwise(1)).over(row))
    merged = written(spark, islands.groupBy("doc_id", "k1", "k2", "island").agg(
        F.min("a").alias("first_word"), F.max("z").alias("end_word"), F.min("first_id").alias("first_id")).drop("island"),
        "islands")
    row, of = listed.alias("row"), merged.alias("of")
    same = (F.col("row.k1") == F.col("of.k1")) & (F.col("row.k2") == F.col("of.k2")) \
        & F.col("row.doc_id").eqNullSafe(F.col("of.doc_id"))
    return row.join(of, same).select("of.*")


def op2_suffix_dedup(spark, sf_dir):
    """Every repeated passage of at least 50 words in ``documents``: document, word range, first holder."""
    return repeated_spans(table(spark, sf_dir, "documents")).select("doc_id", "first_word", "end_word", "first_id")


ORACLE_SQL = f"""
    WITH d AS MATERIALIZED (
        SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    s AS MATERIALIZED (
        SELECT rid, doc_id, i, hash(array_to_string(w[i + 1:i + {MIN_WORDS}], ' ')) AS h
        FROM (SELECT *, unnest(range(0, len(w) - {MIN_WORDS - 1})) AS i FROM d)),
    g AS (SELECT h, min(doc_id) AS low FROM s GROUP BY h HAVING count(*) > 1),
    r AS (SELECT rid, doc_id, i, low,
                 i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= {MIN_WORDS} AS goes_on
          FROM s JOIN g USING (h)),
    n AS (SELECT *, count(*) FILTER (WHERE goes_on IS NOT TRUE)
                    OVER (PARTITION BY rid ORDER BY i ROWS UNBOUNDED PRECEDING) AS span FROM r)
    SELECT doc_id, min(i) AS first_word, max(i) + {MIN_WORDS} AS end_word, min(low) AS first_id
    FROM n GROUP BY rid, doc_id, span"""
