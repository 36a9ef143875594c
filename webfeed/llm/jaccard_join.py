"""N-gram Jaccard join with Bayesian pruning of MinHash candidates and exact verification.

Documents are sets of hashed runs of five words. Equal sets are one class member from the start (a
representative with a number of copies). Representatives that share a band of MinHash values are
compared a few values at a time; a pair is dropped as soon as the posterior probability (uniform
prior) that its similarity reaches the threshold falls below ``TOLERANCE``. What remains links
representatives into candidate groups; inside each group every pair is then counted exactly on the
whole sets, in blocks of bounded size, so a group of any size is spread over tasks and no pair is
ever a row. Each document gets its class and its number of links.

Candidates: 32 bands of 4 values miss a pair at similarity 0.8 with probability 5e-8, and less above.

Edge cases: null text is empty; a text without words has no set, is linked to nothing and is its own
class; a text of one to four words is one run; rows that agree in doc_id and text count as copies of
each other, and one of them stays; null doc_ids come last when a class chooses its document; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfeed.llm import words as W
from webfeed.llm.tables import bit_filter, components, keep_columns, table, with_key, written

NGRAM, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
TOLERANCE = 1e-6
#: MinHash values compared between two looks at the posterior.
STEP = 16
#: Representatives of a bucket, and of a candidate group, that one task compares with as many others.
BUCKET_BLOCK, GROUP_BLOCK = 1024, 256
#: Pairs whose MinHash values are compared at a time.
PAIRS = 1 << 16


def least_matches(threshold: float, tolerance: float, total: int, step: int) -> list[tuple[int, int]]:
    """(values compared, matches needed to go on): posterior P(s >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(step, total + 1, step):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component, for edges between rows."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, label[a], low)
        label = label[label]
        if np.array_equal(label[a], label[b]):
            break
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def _fixed(col: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype).reshape(len(col), width)


def _sets(ngram: int, values: int):
    """Task: keys and text -> keys, fingerprint and size of the shingle set, MinHash values."""
    def task(batches):
        hasher = W.Hasher()
        factor, shift = W.constants(values, 11), W.constants(values, 12)
        for batch in batches:
            n = len(batch)
            size = np.zeros(n, np.int64)
            prints = np.zeros((2, n), np.uint64)
            full = np.zeros((n, values), np.uint32)
            for lo, hashes, first in W.row_chunks(hasher, batch.column("text")):
                found, at = W.shingles(hashes, first, ngram)
                rows, count = len(first) - 1, np.diff(at)
                size[lo:lo + rows] = count
                some = np.flatnonzero(count)
                if not len(some):
                    continue
                starts = at[:-1][some]
                for p, salt in enumerate((21, 22)):
                    prints[p, lo + some] = np.add.reduceat(W.mix(found + W.constants(1, salt)[0]), starts)
                for v in range(values):
                    h = (found * factor[v] + shift[v]) >> np.uint64(32)
                    full[lo + some, v] = np.minimum.reduceat(h.astype(np.uint32), starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("k1"), batch.column("k2"), pa.array(size),
                 pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)),
                 pa.array([r.tobytes() for r in full], pa.binary())],
                names=["doc_id", "k1", "k2", "size", "f1", "f2", "minhash"])
    return task


def _bands(bands: int, rows: int):
    def task(batches):
        for b in batches:
            m = _fixed(b.column("minhash"), np.uint32, bands * rows).astype(np.uint64)
            rep = b.column("rep").to_numpy()
            c = W.constants(rows, 31)
            bucket = np.empty((bands, len(rep)), np.uint64)
            for k in range(bands):
                h = np.full(len(rep), k, np.uint64)
                for j in range(rows):
                    h = W.mix(h + m[:, k * rows + j] * c[j])
                bucket[k] = h
            yield pa.RecordBatch.from_arrays([pa.array(bucket.ravel().view(np.int64)), pa.array(np.tile(rep, bands))],
                                             names=["bucket", "rep"])
    return task


def _signatures(values: int):
    """Task: MinHash values cut to 16 bits, enough to compare them."""
    def task(batches):
        for b in batches:
            m = _fixed(b.column("minhash"), np.uint32, values).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("size"),
                                              pa.array([r.tobytes() for r in m], pa.binary())],
                                             names=["rep", "size", "sig"])
    return task


def _starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """First rows of the groups of a table, and its length."""
    change = np.zeros(t.num_rows, bool)
    change[0] = True
    for k in keys:
        x = t[k].to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(change), t.num_rows)


_BLOCK_KEYS = ["bucket", "bi", "bj"]


def _block_pairs(start: int, end: int, own: np.ndarray, bi: int, bj: int):
    """The pairs that a block (bi, bj) answers for, within a block or across two, some ``PAIRS`` at a time."""
    a = b = np.arange(start, end)
    if bi != bj:
        a, b = a[own[start:end] == bi], a[own[start:end] == bj]
    step = max(1, PAIRS // max(1, len(b)))
    for lo in range(0, len(a), step):
        part = a[lo:lo + step]
        i, j = np.repeat(part, len(b)), np.tile(b, len(part))
        if bi == bj:
            i, j = i[j > i], j[j > i]
        yield i, j


def _prune(threshold: float, looks: list[tuple[int, int]], values: int):
    """Task: blocks of a bucket -> edges between representatives that the posterior keeps."""
    def task(batches):
        for t in W.groups(batches, _BLOCK_KEYS):
            cut = _starts(t, _BLOCK_KEYS)
            rep, size, own = (t[c].to_numpy() for c in ("rep", "size", "own"))
            bi, bj = t["bi"].to_numpy(), t["bj"].to_numpy()
            sig = _fixed(t["sig"].combine_chunks(), np.uint16, values)
            keep: list[tuple[np.ndarray, np.ndarray]] = []
            todo: list[tuple[np.ndarray, np.ndarray]] = []
            n = 0

            def compare(i, j, sig=sig, size=size, keep=keep):
                near = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
                i, j = i[near], j[near]
                matches, done = np.zeros(len(i), np.int16), 0
                for look, least in looks:
                    matches = matches + (sig[i, done:look] == sig[j, done:look]).sum(1, dtype=np.int16)
                    on = matches >= least
                    i, j, matches, done = i[on], j[on], matches[on], look
                keep.append((i, j))

            for s, e in zip(cut[:-1], cut[1:], strict=True):
                two = e - s == 2 and bi[s] == bj[s]
                for pairs in [(np.array([s]), np.array([s + 1]))] if two else _block_pairs(s, e, own, bi[s], bj[s]):
                    todo.append(pairs)
                    n += len(pairs[0])
                    if n >= PAIRS:
                        compare(*(np.concatenate(x) for x in zip(*todo, strict=True)))
                        todo, n = [], 0
            if todo:
                compare(*(np.concatenate(x) for x in zip(*todo, strict=True)))
            i, j = (np.concatenate(x) for x in zip(*keep, strict=True))
            root = _roots(t.num_rows, i, j)
            moved = np.flatnonzero(root != np.arange(t.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array(rep[moved]), pa.array(rep[root[moved]])], names=["a", "b"])
    return task


def _verify(threshold: float):
    """Task: blocks of a candidate group with whole sets -> links and one root per representative."""
    def task(batches):
        for t in W.groups(batches, _BLOCK_KEYS):
            cut = _starts(t, _BLOCK_KEYS)
            rep, copies, own = (t[c].to_numpy() for c in ("rep", "copies", "own"))
            bi, bj = t["bi"].to_numpy(), t["bj"].to_numpy()
            blobs = t["shingles"]
            out: list[tuple] = []
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                sets = [np.frombuffer(blobs[r].as_buffer(), np.uint64) for r in range(s, e)]
                sizes = np.array([len(x) for x in sets])
                column = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
                row = np.repeat(np.arange(e - s), sizes)
                shared = column[2][column[1]] > 1
                new = np.cumsum(column[2] > 1) - 1
                row, col = row[shared], new[column[1][shared]]
                order = np.argsort(col, kind="stable")
                row, col = row[order], col[order]
                both = np.zeros((e - s, e - s), np.float64)
                width = 4096
                for lo in range(0, int(new[-1]) + 1 if len(new) else 0, width):
                    a, b = np.searchsorted(col, (lo, lo + width))
                    m = np.zeros((e - s, width), np.float32)
                    m[row[a:b], col[a:b] - lo] = 1
                    both += m @ m.T
                linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
                np.fill_diagonal(linked, False)
                if bi[s] != bj[s]:
                    linked &= own[s:e, None] != own[None, s:e]
                i, j = np.nonzero(np.triu(linked))
                root = _roots(e - s, i, j)
                has = np.flatnonzero(linked.any(1))
                out.append((rep[s:e][has], (linked * copies[None, s:e]).sum(1)[has], rep[s:e][root[has]]))
            r, n, to = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(n.astype(np.int64)), pa.array(to)],
                                             names=["rep", "links", "root"])
    return task


def _blocked(rows: DataFrame, size: str, block: int) -> DataFrame:
    """Rows of a bucket given to the block pairs that need them: one for a bucket of up to ``block`` rows."""
    nb = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("rep"), nb).cast("int")
    spread = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), nb - 1)))
    out = spread.withColumns({"bi": F.least("own", "other"), "bj": F.greatest("own", "other")}).drop("other", size)
    return out.repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj")


def _key_hash(doc_id: pa.Array, k1: np.ndarray) -> np.ndarray:
    known = doc_id.fill_null(0).to_numpy().view(np.uint64)
    return W.mix(known + np.uint64(1)) ^ W.mix(k1.view(np.uint64))


def _wanted_sets(ngram: int, bits):
    """Task: keys and text -> shingle sets of the rows whose key the filter lets through."""
    def task(batches):
        known = W.BitFilter(np.frombuffer(bits.value, np.uint8))
        hasher = W.Hasher()
        for batch in batches:
            on = known.holds(_key_hash(batch.column("doc_id"), batch.column("k1").to_numpy()))
            part = batch.take(pa.array(on))
            for lo, hashes, first in W.row_chunks(hasher, part.column("text")):
                found, at = W.shingles(hashes, first, ngram)
                blobs = [found[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).slice(lo, len(blobs)) for c in ("doc_id", "k1", "k2")),
                     pa.array(blobs, pa.binary())], names=["doc_id", "k1", "k2", "shingles"])
    return task


def _key_hashes(batches):
    for b in batches:
        h = _key_hash(b.column("doc_id"), b.column("k1").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["hash"])


def jaccard_classes(docs: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD,
                    bands: int = BANDS, rows: int = ROWS, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, k1, k2, class_id, n_links, stays) of every row.

    ``n_links``: other rows whose similarity reaches ``threshold``; ``class_id``: smallest doc_id
    of the documents linked directly or through others; ``stays``: the one row key kept of the class.
    """
    spark = docs.sparkSession
    values = bands * rows
    keyed = with_key(docs)
    sets = written(spark, keyed.mapInArrow(
        _sets(ngram, values), "doc_id long, k1 long, k2 long, size long, f1 long, f2 long, minhash binary"), "sets")
    key = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "k1", "k2")  # null ids last
    with_set = sets.where("size > 0")
    reps = written(spark, with_set.groupBy("f1", "f2").agg(
        F.min(key).alias("key"), F.count(F.lit(1)).alias("copies"),
        F.first("size").alias("size"), F.first("minhash").alias("minhash"))
        .select(F.monotonically_increasing_id().alias("rep"), "f1", "f2", "key", "size", "copies", "minhash"), "reps")
    banded = written(spark, reps.mapInArrow(_bands(bands, rows), "bucket long, rep long"), "bands")
    # What is joined to many rows of one key is written first: Spark can then split a hot key's rows.
    full = written(spark, banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    sig = reps.mapInArrow(_signatures(values), "rep long, size long, sig binary")
    members = banded.join(full, "bucket").join(sig, "rep")
    edges = _blocked(members, "n", BUCKET_BLOCK).mapInArrow(
        _prune(threshold, least_matches(threshold, tolerance, values, STEP), values), "a long, b long")
    groups = written(spark, components(spark, edges, "a", "b")
                     .withColumnsRenamed({"node": "rep", "label": "bucket"}), "components")
    sizes = written(spark, groups.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "sizes")
    groups = groups.join(sizes, "bucket")
    wanted = written(spark, groups.join(reps.select("rep", "key", "copies"), "rep")
                     .select("rep", "bucket", "n", "copies", "key.doc_id", "key.k1", "key.k2"), "groups")
    # Only the sets of representatives in groups are shuffled; the filter spares the other texts.
    bits = spark.sparkContext.broadcast(bit_filter(wanted.select("doc_id", "k1").mapInArrow(_key_hashes, "hash long")))
    own = keyed.mapInArrow(_wanted_sets(ngram, bits), "doc_id long, k1 long, k2 long, shingles binary")
    blobs = own.join(wanted.withColumnRenamed("doc_id", "d"), ["k1", "k2"]) \
        .where(F.col("doc_id").eqNullSafe(F.col("d"))).dropDuplicates(["rep"]) \
        .select("rep", "bucket", "n", "copies", "shingles")
    verified = written(spark, _blocked(blobs, "n", GROUP_BLOCK).mapInArrow(
        _verify(threshold), "rep long, links long, root long"), "verified")
    links = verified.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(spark, verified, "rep", "root").withColumnsRenamed({"node": "rep"})
    labelled = written(spark, reps.select("rep", "f1", "f2", "key", "copies").join(classes, "rep", "left").join(
        links, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "labelled")
    best = written(spark, labelled.groupBy("label").agg(F.min("key").alias("first")), "classes")
    by_set = labelled.join(best, "label").select(
        "f1", "f2", "first", F.col("first.doc_id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = sets.select("doc_id", "k1", "k2", "f1", "f2", "size").join(by_set, ["f1", "f2"], "left")
    alone = F.col("size") == 0
    return linked.select(
        "doc_id", "k1", "k2", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        (alone | (F.col("first") == key)).alias("stays"))


def keep_one_per_class(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` without near copies: of every class the row with the smallest key stays, once."""
    return keep_columns(docs, jaccard_classes(docs, **parameters).where("stays"), "left_semi", once=True)


def op8_jaccard_join(spark, sf_dir):
    """Class and number of links of every document of ``documents``."""
    return jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


ORACLE_SQL = f"""
    WITH RECURSIVE d AS MATERIALIZED (
        SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    s AS MATERIALIZED (
        SELECT DISTINCT rid, array_to_string(w[i:i + {NGRAM - 1}], ' ') AS run
        FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - {NGRAM - 2}, least(len(w) + 1, 2)))) AS i FROM d)),
    n AS MATERIALIZED (SELECT rid, count(*) AS n FROM s GROUP BY 1),
    p AS MATERIALIZED (
        SELECT a, b FROM (SELECT x.rid AS a, y.rid AS b, count(*) AS shared FROM s AS x
                          JOIN s AS y ON x.run = y.run AND x.rid <> y.rid GROUP BY 1, 2)
        JOIN n AS na ON na.rid = a JOIN n AS nb ON nb.rid = b
        WHERE shared >= {THRESHOLD} * (na.n + nb.n - shared) - 1e-9),
    r(a, b) AS (SELECT rid, rid FROM d UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
    c AS (SELECT r.a AS rid, min(doc_id) AS class_id FROM r JOIN d ON d.rid = r.b GROUP BY 1),
    l AS (SELECT a AS rid, count(*) AS links FROM p GROUP BY 1)
    SELECT doc_id, class_id, CAST(coalesce(links, 0) AS BIGINT) AS n_links
    FROM d JOIN c USING (rid) LEFT JOIN l USING (rid)"""
