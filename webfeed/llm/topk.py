"""Exact top-k inner-product search as a Voronoi kNN join.

Data and queries are grouped by the nearest of a bounded set of pivots. A summary
of each cell (pivot distance range, greatest distance) bounds every score in it:
``q.x <= q.p + |q| * max|x - p|``. Each query is first solved in its own cell,
which gives a lower bound of its k-th score; it is then sent only to those cells
whose upper bound reaches that score, solved there locally, and the lists merged.
The data and the queries of a cell are cut into blocks of bounded rows, and every
pair of blocks is a task's group, so a hot cell or a vector repeated over a third
of all rows is spread over many tasks.

Edge cases: a vector that is null, empty-of-type, or holds null or non-finite
components takes no part, nor does a row whose id is null; vectors meet only
vectors of their own length; ties go to the smaller id. Rows that repeat an id are
queries and candidates of their own: every query row has a list, and misses one
row of its own id and vector, itself. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webfeed.llm.tables import table, written

#: Pivots: a bounded sample of the data, the only thing sent to every task.
PIVOTS = 128
#: Rows of a data block and of a query block, which one task solves together; queries multiplied at a time.
BLOCK_ROWS, QUERY_ROWS, AT_ONCE = 4096, 16384, 1024


def _scaled(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(id, v): components as floor(scale * x); rows that can take part only."""
    v = F.col(vector)
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.where(F.col(vec_id).isNotNull() & v.isNotNull() & ok) \
        .select(F.col(vec_id).cast("long").alias("id"),
                F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(col), dim)


def _top(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) of one query, ties to the smaller id; without the first of the rows ``own``."""
    if len(own):
        scores, ids = np.delete(scores, own[0]), np.delete(ids, own[0])
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= cut
        scores, ids = scores[near], ids[near]
    best = np.lexsort((ids, -scores))[:k]
    return scores[best], ids[best]


_HIT = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_HIT_SQL = "q long, query_id long, vec_id long, score long"


def _solver(k: int):
    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        """One data block against one block of the queries sent to its cell."""
        if not left.num_rows or not right.num_rows:
            return _HIT.empty_table()
        ids = right["id"].to_numpy()
        by_id = np.argsort(ids, kind="stable")
        dim = len(right["v"][0])
        data = _matrix(right["v"].combine_chunks(), dim)
        peak = np.abs(data).max(initial=0)
        out = [[], [], [], []]
        for lo in range(0, left.num_rows, AT_ONCE):
            part = left.slice(lo, AT_ONCE)
            q = _matrix(part["v"].combine_chunks(), dim)
            if peak * np.abs(q).max(initial=0) * dim < 2 ** 53:  # then float64 sums are exact integers
                scores = (q @ data.T).astype(np.int64)
            else:
                scores = q.astype(np.int64) @ data.T.astype(np.int64)
            asked = part["id"].to_numpy()
            a, b = (np.searchsorted(ids, asked, side, sorter=by_id) for side in ("left", "right"))
            for at, (number, row) in enumerate(zip(part["q"].to_pylist(), scores, strict=True)):
                same = by_id[a[at]:b[at]]
                s, i = _top(row, ids, same[(data[same] == q[at]).all(1)], k)
                out[0].append(np.full(len(s), number, np.int64))
                out[1].append(np.full(len(s), asked[at], np.int64))
                out[2].append(i)
                out[3].append(s)
        return pa.table([np.concatenate(x) for x in out], schema=_HIT)
    return solve


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query (Spark limits the groups before the shuffle)."""
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("vec_id"))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def voronoi_top_k(data: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id",
                  vector: str = "embedding", scale: int = 256, pivots: int = PIVOTS,
                  block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest integer inner products of every query.

    Exact: pivots only steer which cells a query visits. See the module for edge cases.
    """
    spark = data.sparkSession
    x = _scaled(data, vec_id, vector, scale)
    q = _scaled(queries, vec_id, vector, scale)
    # Pivots: those rows whose hashed id is smallest, a top-k with bounded state.
    rows = x.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    sites: dict[int, np.ndarray] = {}
    for dim in {len(r["v"]) for r in rows}:
        sites[dim] = np.unique(np.array([r["v"] for r in rows if len(r["v"]) == dim], np.float64)
                               .reshape(-1, dim), axis=0)
    sent = spark.sparkContext.broadcast(sites)

    def assign(batches):
        for b in batches:
            col = b.column("v")
            lens = np.diff(col.offsets.to_numpy()) if len(col) else np.zeros(0, int)
            cell, dist, norm = np.zeros(len(col), np.int32), np.zeros(len(col)), np.zeros(len(col))
            for dim in np.unique(lens):
                at = np.flatnonzero(lens == dim)
                m = _matrix(col.take(pa.array(at)), int(dim))
                norm[at] = np.sqrt((m * m).sum(1))
                p = sent.value.get(int(dim))
                if p is not None and dim:
                    d2 = ((p * p).sum(1)[None, :] - 2 * (m @ p.T)) + (m * m).sum(1)[:, None]
                    cell[at] = d2.argmin(1)
                    dist[at] = np.sqrt(np.maximum(d2.min(1), 0))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), col, pa.array(lens.astype(np.int32)), pa.array(cell), pa.array(dist),
                 pa.array(norm)], names=["id", "v", "dim", "cell", "dist", "norm"])

    shape = "id long, v array<long>, dim int, cell int, dist double, norm double"
    placed = written(spark, x.mapInArrow(assign, shape), "cells")
    asked = written(spark, q.mapInArrow(assign, shape).withColumn("q", F.monotonically_increasing_id()), "asked")
    # One summary row per cell: bounded by the number of pivots and vector lengths.
    cells = {(r["dim"], r["cell"]): (r["n"], r["radius"]) for r in placed.groupBy("dim", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius")).collect()}
    blocks = {key: -(-n // block_rows) for key, (n, _) in cells.items()}
    n_blocks = spark.createDataFrame([(d, c, b) for (d, c), b in blocks.items()] or [(-1, -1, 1)],
                                     "dim int, cell int, n int")
    def dealt(rows: DataFrame, number: str, by: list[str], own: str, other: str) -> DataFrame:
        """Rows in a block of their own side, by hash, with one copy for each block of the other side."""
        return rows.withColumn(own, F.pmod(F.xxhash64(*by), F.col(number)).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col("n_queries" if number == "n" else "n") - 1))) \
            .drop("n", "n_queries")

    solve = _solver(k)

    def local(routed: DataFrame) -> DataFrame:
        """Every (query, cell) pair solved: each block of a cell's data against each block of its queries."""
        sizes = routed.groupBy("dim", "cell").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(query_rows)).cast("int").alias("n_queries")) \
            .join(F.broadcast(n_blocks), ["dim", "cell"])  # a row for each cell
        sizes = F.broadcast(sizes)
        keys = ["dim", "cell", "block", "query_block"]
        left = dealt(routed.join(sizes, ["dim", "cell"]), "n_queries", ["q"], "query_block", "block")
        right = dealt(placed.join(sizes, ["dim", "cell"]), "n", ["id", "v"], "block", "query_block").select("id", "v", *keys)
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(solve, _HIT_SQL)

    home = written(spark, _best(local(asked.select("q", "id", "v", "dim", "cell")), k), "home")
    floor = home.where(F.col("rank") == k).select("q", F.col("score").alias("floor"))

    def route(batches):
        """The other cells whose upper bound reaches the k-th score found at home."""
        for b in batches:
            out: list[tuple[np.ndarray, np.ndarray]] = []
            lens = b.column("dim").to_numpy()
            home_cell, norm = b.column("cell").to_numpy(), b.column("norm").to_numpy()
            least = b.column("floor").cast(pa.float64()).fill_null(-np.inf).to_numpy()
            for dim in np.unique(lens):
                there = [(c, r) for (d, c), (_, r) in cells.items() if d == dim]
                if not there:
                    continue
                at = np.flatnonzero(lens == dim)
                ids, radius = np.array([c for c, _ in there]), np.array([r for _, r in there])
                p = sent.value.get(int(dim))
                if p is None or not dim:
                    bound = np.full((len(at), len(ids)), np.inf)
                else:
                    m = _matrix(b.column("v").take(pa.array(at)), int(dim))
                    bound = m @ p[ids].T + norm[at, None] * radius[None, :]
                    bound += 1e-9 * (1 + np.abs(bound))  # rounding never hides a cell
                go = (bound >= least[at, None]) & (ids[None, :] != home_cell[at, None])
                i, j = np.nonzero(go)
                out.append((at[i], ids[j]))
            if out:
                i, c = (np.concatenate(z) for z in zip(*out, strict=True))
                i = pa.array(i)
                yield pa.RecordBatch.from_arrays(
                    [b.column("q").take(i), b.column("id").take(i), b.column("v").take(i), b.column("dim").take(i),
                     pa.array(c.astype(np.int32))], names=["q", "id", "v", "dim", "cell"])

    routed = asked.join(floor, "q", "left").mapInArrow(route, "q long, id long, v array<long>, dim int, cell int")
    routed = written(spark, routed, "routed")
    far = local(routed)
    best = _best(home.drop("rank").union(far), k)
    return best.select("query_id", "rank", "vec_id", "score")


def op10_voronoi_top_k(spark, sf_dir):
    """Every row whose vec_id is divisible by 50, against all rows of ``embeddings``."""
    data = table(spark, sf_dir, "embeddings")
    return voronoi_top_k(data, data.where("vec_id % 50 = 0"))


ORACLE_SQL = """
    WITH x AS (
        SELECT vec_id, [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
    s AS (
        SELECT q.vec_id AS query_id, x.vec_id,
               CAST(list_sum([a[1] * a[2] FOR a IN list_zip(x.v, q.v)]) AS BIGINT) AS score
        FROM x AS q JOIN x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id AND len(x.v) = len(q.v))
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= 5"""
