"""Nearest neighbours with a forest of hash prefixes (LSH Forest).

In every tree a vector's label is a long hash string, one bit per random hyperplane, and
the tree is the sorted array of the labels. A query descends to the longest prefixes it
shares and then ascends in all trees at once, one bit at a time, until the ranges of the
arrays with its prefix hold enough candidates; these are compared exactly. Prefixes thus
have the length that the data around each query asks for.

Rows are dealt by hash into blocks of bounded size; each block holds its own sorted arrays
and meets the queries in bounded portions. A first pass counts the candidates per prefix
length, which add up over blocks and trees to the level a query ascends to; a second pass
compares the candidates at that level. Crowded directions or equal vectors load no block
more than another. Of equal vectors only the k + 1 smallest ids can be among anyone's k
nearest, so only those go on. Hyperplanes are random; a bounded sample gives the centre.

Candidates per query are a share of all rows: the given vectors have no cluster structure
(the tenth neighbour is at about 0.8 of the usual distance), and a fixed number would lose recall as rows grow.

Defined results: vectors that are NULL, zero or hold NULL, NaN or infinite components take
no part, nor do rows without an id or of another dimension than most. Repeated rows count once; of several
vectors with one id the smallest, component by component, stands for it. A query whose ascent finds
fewer than k rows is compared with all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

#: Trees, bits of a hash string, and the candidates to ascend to, as a share of all rows counted over all trees.
TREES, BITS, SHARE = 64, 32, 0.75
BLOCK_ROWS, QUERY_ROWS, SAMPLE_ROWS = 8192, 1024, 4096
SEED = 20170


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) that take part, one row per id."""
    v = F.col("vector")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return (np.concatenate(flat) if flat else np.empty(0)).reshape(-1, dim)


class _Trees:
    """Sorted hash arrays of one block."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray):
        self.centre = centre
        planes = np.random.default_rng(SEED).standard_normal((len(centre), TREES * BITS))
        self.planes = planes
        codes = self.codes(vectors)
        self.order = [np.argsort(codes[:, t], kind="stable") for t in range(TREES)]
        self.sorted = [codes[o, t] for t, o in enumerate(self.order)]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros((len(vectors), TREES), np.int64)
        bit = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for a in range(0, len(vectors), 1024):
            side = ((vectors[a:a + 1024] - self.centre) @ self.planes > 0).reshape(-1, TREES, BITS)
            out[a:a + 1024] = side @ bit
        return out

    def ranges(self, codes: np.ndarray, tree: int, level) -> tuple[np.ndarray, np.ndarray]:
        """The range of the sorted array that shares the first ``level`` bits with each code."""
        free = BITS - np.asarray(level)
        low = (codes[:, tree] >> free) << free
        return np.searchsorted(self.sorted[tree], low), np.searchsorted(self.sorted[tree], low + (1 << free))


def _count(dim: int, centre: np.ndarray):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        counts = np.zeros((queries.num_rows, BITS + 1), np.int64)
        if rows.num_rows and queries.num_rows:
            trees = _Trees(_matrix(rows.column("vector"), dim), centre)
            codes = trees.codes(_matrix(queries.column("vector"), dim))
            for t in range(TREES):
                for level in range(BITS + 1):
                    low, high = trees.ranges(codes, t, level)
                    counts[:, level] += high - low
        return pa.table({"query_id": queries.column("vec_id"), "counts": pa.array(list(counts), pa.list_(pa.int64()))})

    return run


def _compare(dim: int, centre: np.ndarray, k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_v, out_d = [], [], []
        if rows.num_rows and queries.num_rows:
            vectors, ids = _matrix(rows.column("vector"), dim), rows.column("vec_id").to_numpy()
            asked, own = _matrix(queries.column("vector"), dim), queries.column("vec_id").to_numpy()
            level = queries.column("level").to_numpy()
            trees = _Trees(vectors, centre)
            codes = trees.codes(asked)
            bounds = [trees.ranges(codes, t, level) for t in range(TREES)]
            for q in range(len(own)):
                near = np.zeros(len(ids), bool)
                for t, (low, high) in enumerate(bounds):
                    near[trees.order[t][low[q]:high[q]]] = True
                at = np.flatnonzero(near & (ids != own[q]))
                distance = np.sqrt(((vectors[at] - asked[q]) ** 2).sum(1))
                if len(at) > k:
                    close = distance <= np.partition(distance, k - 1)[k - 1]
                    at, distance = at[close], distance[close]
                best = np.lexsort((ids[at], distance))[:k]
                out_q.append(np.full(len(best), own[q]))
                out_v.append(ids[at][best])
                out_d.append(distance[best])
        cat = lambda parts, t: pa.array(np.concatenate(parts) if parts else np.empty(0, t))
        return pa.table({"query_id": cat(out_q, np.int64), "vec_id": cat(out_v, np.int64), "score": cat(out_d, np.float64)})

    return run


def nearest(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every query, by Euclidean distance.

    ``queries`` has the same columns as ``df``; a row is no candidate for a query of its id.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows, asked = usable(df, id_col, vector_col), usable(queries, id_col, vector_col)
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = sizes["dim"]
    rows, asked = rows.filter(F.size("vector") == dim), asked.filter(F.size("vector") == dim)
    equal = Window.partitionBy("vector").orderBy("vec_id")
    rows = stored(rows.withColumn("copy", F.row_number().over(equal)).filter(F.col("copy") <= k + 1).drop("copy"), "ann-rows")
    asked = stored(asked, "ann-queries")
    n, n_asked = rows.count(), asked.count()
    sample = rows.orderBy(F.xxhash64("vec_id")).limit(SAMPLE_ROWS).select("vector").toArrow()
    centre = _matrix(sample.column("vector"), dim).mean(0)

    blocks, portions = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_asked // QUERY_ROWS))
    dealt = rows.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block"),
                        F.explode(F.sequence(F.lit(0), F.lit(portions - 1))).alias("portion"))
    portioned = asked.withColumn("portion", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(portions)).cast("int"))
    everywhere = lambda q: q.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    meet = lambda q, f, schema: (dealt.groupBy("block", "portion").cogroup(
        everywhere(q).groupBy("block", "portion")).applyInArrow(f, schema))

    counts = meet(portioned, _count(dim, centre), "query_id bigint, counts array<bigint>")
    enough = max(1, int(share * n))
    levels = (counts.select("query_id", F.posexplode("counts").alias("level", "n")).groupBy("query_id", "level").agg(F.sum("n").alias("n"))
              .groupBy("query_id").agg(F.coalesce(F.max(F.when(F.col("n") >= enough, F.col("level"))), F.lit(0)).cast("long").alias("level")))
    levels = stored(levels, "ann-levels")
    schema = "query_id bigint, vec_id bigint, score double"
    found = stored(meet(portioned.join(levels, portioned["vec_id"] == levels["query_id"]).drop("query_id"), _compare(dim, centre, k), schema), "ann-found")
    # the same rows from several trees are one candidate: whoever found too few others asks every row
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).select(F.col("query_id").alias("vec_id"))
    short = stored(portioned.join(full, "vec_id", "left_anti").withColumn("level", F.lit(0).cast("long")), "ann-short")
    if not short.isEmpty():
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(
            meet(short.select("vec_id", "vector", "portion", "level"), _compare(dim, centre, k), schema))
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
