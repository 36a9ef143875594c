"""Source divergence audit by three-dimensional cube partitioning.

Every language keeps the terms that at least ``MIN_DOCS`` of its documents hold. Each (lang, source) group,
and each language as a whole, gives each kept term the smoothed share ``p = 1 + floor(SCALE * (count + 1) /
(N + V))`` (``N``: the group's occurrences of kept terms, ``V``: kept terms), and the divergence of a group
from another is the sum over terms of ``floor((p - q)^2 / q)``. All arithmetic is exact, on integers.

The work is a cube per language: groups x groups x terms. Groups and terms are dealt to blocks by hash; a
task owns a cell (group block, group block, term block), to which the two slices (group block, term block)
are replicated, and computes the partial sums of all ordered pairs of its groups. A second aggregation adds
them up along the term axis. A slice is replicated once per group block, its sums shrink to one row a pair, a
cell holds two slices of bounded size, whatever the size of the language, of a group or of the vocabulary.

A term is a run of ASCII letters (A-Z lower-cased) and non-ASCII characters. Edge cases: null text, lang and
source are empty strings, which are values like others; rows that repeat a doc_id or a whole row are
documents of their own; a group without kept terms takes part with ``N = 0``; a language without kept terms
has divergences 0 between its groups and no term rows; a language of one source has no pairs; ties go to the
smaller item (bytes); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webfeed.llm import words as W
from webfeed.llm.tables import table, written

MIN_DOCS, SCALE, TERM_RANKS = 3, 1_000_000_000, 200
#: Groups and terms of a block; the hash deals them, so a block may hold a few more.
GROUP_BLOCK, TERM_BLOCK = 32, 16384
#: Text whose terms are counted before they leave a task.
COUNT_BYTES = 8 << 20


def _letters() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[0x41:0x5B] = inside[0x61:0x7B] = inside[0x80:] = True
    return inside


def _counts(batches):
    """Task: (lang, source, text) -> occurrences of each term, and documents that hold it, by group."""
    h = W.Hasher()
    h.word = _letters()
    for b in batches:
        raw, offsets = W.text_bytes(b.column("text"))
        for lo, hi in W.chunks(offsets, COUNT_BYTES):
            at = offsets[lo:hi + 1] - offsets[lo]
            part = raw[offsets[lo]:offsets[hi]]
            starts, ends, first = h.spans(part, at)
            if not len(starts):
                continue
            ends = np.concatenate([[0], np.cumsum(ends - starts)])
            kind = np.int32 if ends[-1] < 2 ** 31 else np.int64
            found = (pa.StringArray if kind is np.int32 else pa.LargeStringArray).from_buffers(
                len(starts), pa.py_buffer(ends.astype(kind)), pa.py_buffer(h.lower[part][h.word[part]])) \
                .dictionary_encode()
            terms = found.dictionary
            row = np.repeat(np.arange(hi - lo), np.diff(first))
            held, n = np.unique(row * len(terms) + found.indices.to_numpy(), return_counts=True)
            row, term = np.divmod(held, len(terms))
            names = [b.column(c).slice(lo, hi - lo).dictionary_encode() for c in ("lang", "source")]
            lang, source = (x.indices.to_numpy().astype(np.int64) for x in names)
            group = lang * len(names[1].dictionary) + source
            mine, back, df = np.unique(group[row] * len(terms) + term, return_inverse=True, return_counts=True)
            total = np.bincount(back, weights=n).astype(np.int64)
            group, term = np.divmod(mine, len(terms))
            lang, source = np.divmod(group, len(names[1].dictionary))
            yield pa.RecordBatch.from_arrays(
                [names[0].dictionary.take(pa.array(lang)), names[1].dictionary.take(pa.array(source)),
                 terms.take(pa.array(term)).cast(pa.string()), pa.array(total), pa.array(df.astype(np.int64))],
                names=["lang", "source", "term", "n", "df"])


def _share(n: Column, total: Column, v: Column, scale: int) -> Column:
    """1 + floor(scale * (n + 1) / (total + v)), exact beyond 64 bits."""
    over = F.lit(scale).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", over, (total + v).cast("decimal(20,0)"))


def _term_ranks(slices: DataFrame, groups: DataFrame, vocabulary: DataFrame, scale: int, most: int) -> DataFrame:
    """Part ``term``: the terms that a group holds more often than its language."""
    rows = slices.join(groups.select("lang", "source", "total", "v"), ["lang", "source"]) \
        .join(vocabulary.select("lang", F.col("total").alias("all")), "lang") \
        .select("lang", "source", F.col("term").alias("item"),
                _share(F.col("n"), F.col("total"), F.col("v"), scale).alias("p"),
                _share(F.col("of_lang"), F.col("all"), F.col("v"), scale).alias("q")).where("p > q") \
        .select("lang", "source", F.lit("term").alias("part"), "item",
                F.expr("((p - q) * (p - q)) div q").alias("value"))
    return _ranked(rows).where(F.col("rank") <= most)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def _cell(t: pa.Table) -> pa.Table:
    """One cell: the rows of two slices (one, on the diagonal) -> partial divergences of all ordered pairs.

    Rows with ``idx`` -1 name a group: its share of a term that it does not hold, and the block's terms.
    """
    group, idx, p = (t[c].to_numpy() for c in ("gid", "idx", "p"))
    side = group >> 32
    name = idx < 0
    size = int(t["terms"].to_numpy()[name].max(initial=0))
    seen = np.unique(idx[~name])

    def dense(block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        named = np.flatnonzero(name & (side == block))
        named = named[np.argsort(group[named])]
        shares = np.repeat(p[named][:, None], len(seen), 1)
        held = np.flatnonzero(~name & (side == block))
        shares[np.searchsorted(group[named], group[held]), np.searchsorted(seen, idx[held])] = p[held]
        return group[named], p[named], shares

    blocks = [int(t["a"][0].as_py()), int(t["b"][0].as_py())]
    sides = {x: dense(x) for x in set(blocks)}
    out = [[], [], []]
    for a, b in {(blocks[0], blocks[1]), (blocks[1], blocks[0])}:
        (ga, pa_, xa), (gb, pb, xb) = sides[a], sides[b]
        for i in range(len(ga)):
            value = ((xa[i] - xb) ** 2 // xb).sum(1) + (size - len(seen)) * ((pa_[i] - pb) ** 2 // pb)
            other = gb != ga[i]
            out[0].append(np.full(int(other.sum()), ga[i]))
            out[1].append(gb[other])
            out[2].append(value[other])
    flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
    return pa.table([pa.array([t["lang"][0].as_py()] * len(flat[0]), pa.string()), *map(pa.array, flat)],
                    names=["lang", "g", "h", "value"])


def _pair_ranks(slices: DataFrame, groups: DataFrame, scale: int) -> DataFrame:
    """Part ``pair``: divergences of every group from the other groups of its language."""
    named = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sizes = slices.groupBy("lang", "block").agg(F.countDistinct("idx").alias("terms"))
    names = named.join(sizes, ["lang", "block"], "left").select(
        "lang", "block", "gid", "gblocks", F.lit(-1).cast("long").alias("idx"),
        F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("v"), scale)).otherwise(F.lit(1))
        .cast("long").alias("p"), F.coalesce("terms", F.lit(0)).cast("long").alias("terms"))
    held = slices.join(groups, ["lang", "source"]).select(
        "lang", "block", "gid", "gblocks", "idx",
        _share(F.col("n"), F.col("total"), F.col("v"), scale).cast("long").alias("p"), F.lit(0).cast("long").alias("terms"))
    mine = F.shiftright("gid", 32)
    cells = names.union(held).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("gblocks") - 1))).select(
        "lang", F.least(mine, "x").alias("a"), F.greatest(mine, "x").alias("b"), "block", "gid", "idx", "p", "terms")
    sums = cells.groupBy("lang", "a", "b", "block").applyInArrow(_cell, "lang string, g long, h long, value long") \
        .groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    rows = sums.join(groups.select("lang", F.col("gid").alias("g"), "source"), ["lang", "g"]) \
        .join(groups.select("lang", F.col("gid").alias("h"), F.col("source").alias("item")), ["lang", "h"]) \
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return _ranked(rows)


def _blocks(n: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / F.lit(size))).cast("long")


def _numbered(rows: DataFrame, name: str, block: str, at: str) -> DataFrame:
    """``rows`` with their place (from 0) among the rows of their block, in the order of ``name``."""
    order = Window.partitionBy("lang", block).orderBy(name)
    return rows.withColumn(at, (F.row_number().over(order) - 1).cast("long"))


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, scale: int = SCALE, term_ranks: int = TERM_RANKS,
                group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): see the module."""
    spark = docs.sparkSession
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = written(spark, read.mapInArrow(_counts, "lang string, source string, term string, n long, df long")
                     .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "counts")
    kept = written(spark, counts.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"), F.sum("df").alias("df"))
                   .where(F.col("df") >= min_docs).drop("df"), "kept")
    vocabulary = written(spark, kept.groupBy("lang").agg(
        F.sum("of_lang").alias("total"), F.count(F.lit(1)).alias("v")), "vocabulary")
    placed = kept.join(vocabulary.select("lang", _blocks(F.col("v"), term_block).alias("blocks")), "lang") \
        .withColumn("block", F.pmod(F.xxhash64("term"), "blocks"))
    placed = written(spark, _numbered(placed, "term", "block", "idx").drop("blocks"), "placed")
    slices = written(spark, counts.drop("df").join(placed, ["lang", "term"]), "slices")
    every = read.select("lang", "source").distinct()
    many = written(spark, every.groupBy("lang").agg(_blocks(F.count(F.lit(1)), group_block).alias("gblocks")), "langs")
    totals = slices.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = every.join(totals, ["lang", "source"], "left").join(many, "lang") \
        .join(vocabulary.select("lang", "v"), "lang", "left") \
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"),
                "gblocks", F.pmod(F.xxhash64("source"), "gblocks").alias("gblock")) \
        .withColumn("blocks", _blocks(F.col("v"), term_block))
    groups = written(spark, _numbered(groups, "source", "gblock", "at").withColumn(
        "gid", F.shiftleft("gblock", 32) + F.col("at")).drop("gblock", "at"), "groups")
    out = ["lang", "source", "part", "item", "value", "rank"]
    return _pair_ranks(slices, groups, scale).select(out) \
        .union(_term_ranks(slices, groups, vocabulary, scale, term_ranks).select(out))


def op11_source_divergence(spark, sf_dir):
    """Divergence of every source of ``documents`` from the others of its language, and the terms that mark it."""
    return divergences(table(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
    WITH d AS MATERIALIZED (
        SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    t AS MATERIALIZED (SELECT rid, lang, source, term, count(*) AS n
                       FROM (SELECT rid, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
    k AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM t GROUP BY lang, term HAVING count(*) >= {MIN_DOCS}),
    l AS MATERIALIZED (SELECT lang, sum(n) AS total, count(*) AS v FROM k GROUP BY lang),
    g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
    c AS MATERIALIZED (SELECT t.lang, source, term, sum(t.n) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
    gn AS MATERIALIZED (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
                        FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
    p AS MATERIALIZED (
        SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
               1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 1) // (gn.total + l.v) AS p,
               1 + {SCALE}::HUGEINT * (k.n + 1) // (l.total + l.v) AS q
        FROM gn JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
    pair AS (
        SELECT a.lang, a.source, b.source AS item,
               coalesce(s.value, 0) AS value
        FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
                   FROM p AS x JOIN p AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) AS s
          ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    f AS (SELECT lang, source, 'pair' AS part, item, value FROM pair
          UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM r WHERE part = 'pair' OR rank <= {TERM_RANKS}"""
