"""Removal of repeated line runs by a suffix array over line ids (distributed prefix doubling).

Lines get ids; the suffixes of a document's line sequence are ordered by prefix doubling: the name of
a suffix at level k orders it by its first ``2^k`` lines, and the next level names pairs of names
(``2^k`` lines apart) in their sorted order. Only suffixes whose prefix occurs again go on, so the
levels shrink quickly. Equal names are the intervals of the suffix array whose common prefix reaches
that length; a block of any length is the overlap of two names of the greatest level that fits.

A line goes when it lies in a run of lines, of at least ``min_words`` words together, that also occurs
earlier (in the order of row key and line number, in another document or the same one; the two may
overlap). It is enough to test, for every line, the shortest such run that starts there and the
shortest that ends there: any longer repeated run is a union of those. A run of short lines is thus
removed only together with enough of its neighbours.

Edge cases: null text is empty: one line without words, which alone never goes; rows that agree in
doc_id and text are one document and lose the same lines; null doc_ids come first; other columns are
ignored (the filtering stage keeps them); empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webfeed.llm.tables import OWN, table, text_hashes, with_key, written
from webfeed.session import new_scratch_path

#: Words that a repeated run must have.
MIN_WORDS = 4
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
_POS = "struct(dn, idx)"


def _named(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows whose ``by`` values occur at several positions, named in sorted order."""
    groups = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1")  # a position has one row
    names = groups.orderBy(*by).select(*by, F.monotonically_increasing_id().alias("name"))
    return rows.join(names, by).drop(*by)


def _words(line: str, most: int) -> Column:
    """Words of column ``line``, counted up to ``most``.

    A run has enough words as soon as one of its lines has, so counts above ``min_words`` change no run. The pattern
    of the first words never goes back over what it has read, so it takes linear time.
    """
    first = F.regexp_extract(line, f"(?:{_BETWEEN}+{_WORD}+){{0,{max(most, 1)}}}+", 0)
    return F.regexp_count(first, F.lit(_WORD))


def _repeated_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, k1, k2, idx, name, words) of lines that occur again; ``words`` counts up to ``min_words``."""
    spark = docs.sparkSession
    lines = with_key(docs).select("doc_id", "k1", "k2", F.posexplode(F.split("text", "\n")).alias("idx", "line")) \
        .select("doc_id", "k1", "k2", "idx", F.xxhash64("line").alias("l1"), F.xxhash64(F.lit(7), "line").alias("l2"),
                _words("line", min_words).alias("words"))
    pos = F.struct("doc_id", "k1", "k2", "idx")
    groups = lines.groupBy("l1", "l2").agg(F.min(pos).alias("first"), F.max(pos).alias("last")).where("first < last")
    names = groups.orderBy("l1", "l2").select("l1", "l2", F.monotonically_increasing_id().alias("name"))
    found = lines.join(names, ["l1", "l2"]).select("doc_id", "k1", "k2", "idx", "name", "words") \
        .dropDuplicates(["doc_id", "k1", "k2", "idx"])
    return written(spark, found, "lines")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, k1, k2, idx): the lines to remove, by row key and line number from 0."""
    spark = docs.sparkSession
    lines = _repeated_lines(docs, min_words)
    keys = written(spark, lines.select("doc_id", "k1", "k2").distinct().orderBy("doc_id", "k1", "k2")
                   .withColumn("dn", F.monotonically_increasing_id()), "line-docs")
    same = (F.col("n.k1") == F.col("l.k1")) & (F.col("n.k2") == F.col("l.k2")) \
        & F.col("n.doc_id").eqNullSafe(F.col("l.doc_id"))
    first = written(spark, lines.alias("l").join(keys.alias("n"), same).select("dn", "idx", "name", "words"),
                    "level")
    # Consecutive repeated lines, with the words before each: the shortest runs that have enough words.
    blocks = written(spark, _shortest_runs(first.select("dn", "idx", "words"), min_words), "runs")
    names = _levels(spark, first.drop("words"))
    # A block is two overlapping prefixes of the level that fits; one longer than the last level's
    # prefixes reach does not repeat.
    at = F.col("idx") + F.col("len") - F.col("size")
    named = blocks.withColumn("k", F.length(F.bin("len")) - 1) \
        .withColumn("size", F.expr("shiftleft(1, k)")).withColumn("at", at) \
        .join(names.select("k", "dn", "idx", F.col("name").alias("n1")), ["k", "dn", "idx"]) \
        .join(names.select("k", "dn", F.col("idx").alias("at"), F.col("name").alias("n2")), ["k", "dn", "at"]) \
        .select("dn", "idx", "len", "k", "n1", "n2")
    by = ["k", "len", "n1", "n2"]
    named = written(spark, named, "blocks")
    # Written, so that the join has two plain shuffles and Spark can split a run that very many share.
    earliest = written(spark, named.groupBy(*by).agg(F.min(F.expr(_POS)).alias("first")), "earliest")
    runs = named.join(earliest, by).where(F.col("first") < F.expr(_POS))
    gone = runs.select("dn", F.explode(F.sequence("idx", F.col("idx") + F.col("len") - 1)).alias("idx")).distinct()
    return gone.join(keys, "dn").select("doc_id", "k1", "k2", "idx")


def _levels(spark: SparkSession, first: DataFrame) -> DataFrame:
    """(k, dn, idx, name): the names of all levels, from that of single lines; a folder of one table for each."""
    folder = new_scratch_path(spark, "levels")
    schema = T.StructType(list(first.schema.fields)).add("k", "integer")
    first.write.parquet(f"{folder}/k=0")
    k, more = 0, True
    while more:
        # The level is a column of the data, so that every round has the same plan and generated code.
        below = spark.read.schema(schema).option("basePath", folder).parquet(f"{folder}/k={k}")
        after = F.col("idx") - F.expr("shiftleft(1, k)")
        pairs = below.select("dn", "idx", F.col("name").alias("n1")).join(
            below.select("dn", after.alias("idx"), F.col("name").alias("n2")), ["dn", "idx"])
        k += 1
        seen = Observation()
        _named(pairs, ["n1", "n2"]).select(*first.columns).observe(seen, F.count(F.lit(1)).alias("n")) \
            .write.parquet(f"{folder}/k={k}")
        more = seen.get["n"] > 0
    return spark.read.schema(schema).parquet(folder)


def _shortest_runs(words: DataFrame, min_words: int) -> DataFrame:
    """(dn, idx, len): of repeated lines in a row, the shortest runs of ``min_words`` words from each start and end."""
    def task(batches):
        import numpy as np
        import pyarrow as pa

        tail: dict = {}
        for batch in batches:
            cols = [np.concatenate([tail.get(c, np.zeros(0, np.int64)), batch.column(c).to_numpy().astype(np.int64)])
                    for c in ("dn", "idx", "words")]
            dn, idx, w = cols
            if not len(dn):
                continue
            hold = int(np.searchsorted(dn == dn[-1], True))  # the last document may go on
            tail = {c: x[hold:] for c, x in zip(("dn", "idx", "words"), cols, strict=True)}
            if hold:
                yield runs(dn[:hold], idx[:hold], w[:hold])
        if len(tail.get("dn", ())):
            yield runs(tail["dn"], tail["idx"], tail["words"])

    def runs(dn, idx, w):
        import numpy as np
        import pyarrow as pa

        n = len(dn)
        new = np.ones(n, bool)
        new[1:] = (dn[1:] != dn[:-1]) | (idx[1:] != idx[:-1] + 1)
        first = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        end = np.append(first[1:], n)[run]
        total = np.concatenate([[0], np.cumsum(w)])
        stop = np.searchsorted(total, total[:-1] + min_words, side="left")  # from each start
        start = np.searchsorted(total, total[1:] - min_words, side="right") - 1  # to each end
        a = np.flatnonzero(stop <= end)
        b = np.flatnonzero((start >= first[run]) & (total[1:] >= min_words))
        lo = np.concatenate([a, start[b]])
        length = np.concatenate([stop[a] - a, b + 1 - start[b]])
        both = np.unique(np.stack([lo, length], 1), axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(dn[both[:, 0]]), pa.array(idx[both[:, 0]].astype(np.int32)),
             pa.array(both[:, 1].astype(np.int32))], names=["dn", "idx", "len"])

    return words.repartition("dn").sortWithinPartitions("dn", "idx") \
        .mapInArrow(task, "dn long, idx int, len int")


def dedup_line_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with three columns more: __wf_lines (array of all lines), __wf_gone (numbers of those to remove) and
    __wf_kept (the text that stays)."""
    gone = repeated_runs(docs, min_words).groupBy("doc_id", "k1", "k2").agg(F.collect_list("idx").alias("gone")) \
        .select(F.col("doc_id").alias(OWN + "g0"), F.col("k1").alias(OWN + "g1"), F.col("k2").alias(OWN + "g2"),
                F.col("gone").alias(OWN + "gone"))
    k1, k2 = text_hashes(F.col("text"))
    left = docs.withColumns({OWN + "k1": k1, OWN + "k2": k2,
                             OWN + "lines": F.split(F.coalesce("text", F.lit("")), "\n")})
    on = (F.col(OWN + "k1") == F.col(OWN + "g1")) & (F.col(OWN + "k2") == F.col(OWN + "g2")) \
        & F.col("doc_id").cast("long").eqNullSafe(F.col(OWN + "g0"))
    both = left.join(gone, on, "left").drop(*[OWN + c for c in ("k1", "k2", "g0", "g1", "g2")])
    # Kept numbers by a hashed difference, so long documents take linear time.
    kept = F.array_except(F.sequence(F.lit(0), F.size(OWN + "lines") - 1), F.col(OWN + "gone"))
    text = F.array_join(F.transform(kept, lambda i: F.col(OWN + "lines")[i]), "\n")
    return both.withColumn(OWN + "kept", F.when(F.col(OWN + "gone").isNull(), F.col("text")).otherwise(text))


def without_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated line runs removed from ``text``; a document that keeps no line is dropped.

    ``n_chars``, where it exists, is set to the new length of a text that changed.
    """
    found = dedup_line_runs(docs, min_words)
    gone = F.col(OWN + "gone")
    found = found.where(gone.isNull() | (F.size(gone) < F.size(OWN + "lines")))
    for field in docs.schema.fields:
        if field.name == "n_chars" and isinstance(field.dataType, T.IntegralType):
            found = found.withColumn("n_chars", F.when(gone.isNull(), F.col("n_chars"))
                                     .otherwise(F.length(OWN + "kept").cast(field.dataType)))
    return found.withColumn("text", F.col(OWN + "kept")) \
        .select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])


def op3_line_dedup(spark, sf_dir):
    """Lines, removed lines and digest of the kept text of every document of ``documents``."""
    found = dedup_line_runs(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.size(OWN + "lines").cast("long").alias("n_lines"),
        F.coalesce(F.size(OWN + "gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.md5(F.coalesce(OWN + "kept", F.lit(""))).alias("kept_md5"))


ORACLE_SQL = f"""
    WITH l AS MATERIALIZED (
        SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS idx FROM documents),
    n AS MATERIALIZED (SELECT *, len(regexp_extract_all(line, '{_WORD}')) AS words FROM l),
    p AS (SELECT b.doc_id, b.idx, b.words, a.doc_id AS other, b.idx - a.idx AS diag
          FROM n AS a JOIN n AS b ON a.line = b.line AND (a.doc_id, a.idx) < (b.doc_id, b.idx)),
    i AS (SELECT *, idx - row_number() OVER (PARTITION BY doc_id, other, diag ORDER BY idx) AS run FROM p),
    r AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, other, diag, run) AS total FROM i),
    g AS (SELECT DISTINCT doc_id, idx FROM r WHERE total >= {MIN_WORDS})
    SELECT l.doc_id, count(*) AS n_lines, count(g.idx) AS n_removed,
           md5(coalesce(string_agg(l.line, chr(10) ORDER BY l.idx) FILTER (WHERE g.idx IS NULL), '')) AS kept_md5
    FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.idx = l.idx GROUP BY l.doc_id"""
