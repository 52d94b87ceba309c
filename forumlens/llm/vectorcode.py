"""Vector codes by product quantisation, with assignments pruned by pivots (LAESA).

A vector of whole numbers is cut into equal consecutive parts; every part position has a
codebook and a part is replaced by the index of the nearest entry. Finding it by LAESA: the
distances of every part to a few fixed pivots are computed once and stored with it; in each
round only the distances from pivots to the present entries are new. By the triangle
inequality |d(part, pivot) - d(pivot, entry)| bounds d(part, entry) from below; entries are
visited in the order of their bounds and a part stops where the bound exceeds its best exact
distance. Distances that decide are exact, squared, in whole numbers; ties go to the lower
index. Pivots are entries of the first codebook chosen one by one, each farthest, in sum,
from those before it.

The codebook starts as the vectors of the smallest ids. A round assigns all parts and puts
every entry at floor(sum / count) of its parts; sums are added up per task before they are
shuffled, ENTRIES x dimension of them, so an entry or a vector that holds most rows loads no
task. What reaches the driver has that size too. Vectors are never shuffled.

Defined results: vectors that are NULL, empty, or hold NULL or non-finite components are
dropped. Of an id with several vectors the smallest, component by component, is a first
entry; all its rows are coded. NULL ids are coded and are no first entries; with no ids at
all codes are NULL. A vector of another length than most, or with components so large that
sums of squares leave 64 bits (2^19 at 64 dimensions), keeps its row with NULL code and error.
A length that the parts do not divide is filled up with zeros. Extra columns stay; columns
named like results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, small_batches, stored

PARTS, ENTRIES, ROUNDS, PIVOTS, SCALE = 16, 64, 2, 4, 256
_ROWS = 1024


@dataclass
class Codebooks:
    """Entries (parts, entries, width) and pivots (parts, pivots, width), whole numbers."""

    entries: np.ndarray
    pivots: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def whole(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Components as floor(256 x), in equal parts (n, parts, width)."""
    n, dim = vectors.shape
    width = -(-dim // parts)
    out = np.zeros((n, parts * width), np.int64)
    out[:, :dim] = np.floor(vectors.astype(np.float64) * SCALE)
    return out.reshape(n, parts, width)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances (n, m) of rows of two matrices of whole numbers."""
    out = np.zeros((len(a), len(b)), np.int64)
    for w in range(a.shape[1]):
        out += (a[:, w, None] - b[None, :, w]) ** 2
    return out


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Entries of each part position that lie far from one another."""
    out = []
    for book in entries:
        far = np.sqrt(_squared(book, book).astype(np.float64))
        chosen, total = [0], far[0].copy()
        while len(chosen) < min(count, len(book)):
            total[chosen] = -1
            chosen.append(int(total.argmax()))
            total = np.where(total < 0, total, total + far[chosen[-1]])
        out.append(book[chosen])
    return np.stack(out)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(n, parts, pivots), once for every part."""
    return np.stack([np.sqrt(_squared(x[:, p], pivots[p]).astype(np.float64)) for p in range(len(pivots))], 1)


def assign(x: np.ndarray, to_pivots: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest entry (n, parts), its squared distance, and the number of exact distances per vector."""
    n, parts, _ = x.shape
    index, best = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
    tried = np.zeros(n, np.int64)
    for p in range(parts):
        book = books.entries[p]
        from_pivots = np.sqrt(_squared(books.pivots[p], book).astype(np.float64))
        bound = np.zeros((n, len(book)))
        for k in range(from_pivots.shape[0]):
            one, two = to_pivots[:, p, k, None], from_pivots[None, k]
            # rounding of the roots is far below this margin: no entry is ruled out by it
            np.maximum(bound, np.abs(one - two) - 1e-9 * (one + two), out=bound)
        order = np.argsort(bound, 1, kind="stable")
        own, found, live = np.full(n, len(book)), np.full(n, np.iinfo(np.int64).max), np.arange(n)
        for k in range(len(book)):
            e = order[live, k]
            go = bound[live, e] ** 2 <= found[live]
            live, e = live[go], e[go]
            if not len(live):
                break
            tried[live] += 1
            d = ((x[live, p] - book[e]) ** 2).sum(1)
            better = (d < found[live]) | ((d == found[live]) & (e < own[live]))
            found[live[better]], own[live[better]] = d[better], e[better]
        index[:, p], best[:, p] = own, found
    return index, best, tried


# ---- over Spark


def _lists(column: pa.Array, shape: tuple) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(shape)


def _list_of(values: np.ndarray) -> pa.Array:
    values = values.reshape(len(values), -1)
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], pa.array(values.reshape(-1)))


def _prepare(parts: int, pivots: np.ndarray, at: int, names: list[str]):
    """Whole components and pivot distances in place of the vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                x = whole(_lists(part.column(at), (part.num_rows, -1)), parts)
                rest = [c for i, c in enumerate(part.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, _list_of(x), _list_of(pivot_distances(x, pivots))], names=names)

    return run


def _read(batch: pa.RecordBatch, books: Codebooks) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    parts, _, width = books.entries.shape
    for a in range(0, batch.num_rows, _ROWS):
        part = batch.slice(a, _ROWS)
        yield (part, _lists(part.column(part.num_columns - 2), (part.num_rows, parts, width)),
               _lists(part.column(part.num_columns - 1), (part.num_rows, parts, -1)))


def _sums(books: Codebooks):
    """Per task and entry: number and sums of the parts assigned to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.entries.shape
        total, count = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, x, d in _read(batch, books):
                index, _, _ = assign(x, d, books)
                for p in range(parts):
                    np.add.at(total[p], index[:, p], x[:, p])
                    count[p] += np.bincount(index[:, p], minlength=entries)
        p, e, w = np.nonzero(np.broadcast_to(count[:, :, None] > 0, total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(w), pa.array(total[p, e, w]), pa.array(count[p, e])],
                                         names=["part", "entry", "place", "total", "n"])

    return run


def _codes(books: Codebooks, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x, d in _read(batch, books):
                index, best, tried = assign(x, d, books)
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], _list_of(index.astype(np.int32)), pa.array(best.sum(1)), pa.array(tried)], names=names)

    return run


def _first_entries(rows: DataFrame, id_col: str, vector: str, parts: int, entries: int) -> np.ndarray | None:
    """Parts of the vectors of the smallest ids, at most ``entries`` of them."""
    ids = rows.select(id_col).filter(F.col(id_col).isNotNull()).distinct().orderBy(id_col).limit(entries)
    chosen = sorted(r[0] for r in ids.collect())
    if not chosen:
        return None
    found = rows.filter(F.col(id_col).isin(chosen)).groupBy(id_col).agg(F.min(vector).alias("_v")).orderBy(id_col).collect()
    return np.ascontiguousarray(whole(np.array([r["_v"] for r in found], np.float64), parts).transpose(1, 0, 2))


def compressed(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
               rounds: int = ROUNDS, pivots: int = PIVOTS) -> tuple[DataFrame, Codebooks | None]:
    """Coded rows and the final codebooks.

    Rows have the columns of ``df`` without the vector, ``code`` (entry per part), ``error``
    (sum of squared distances) and ``exact_distances`` (evaluated in the last assignment).
    """
    spark = df.sparkSession
    small_batches(spark)
    kept = [c for c in df.columns if c.lower() not in (vector_col.lower(), "code", "error", "exact_distances")]
    vector, ints, far = fresh(df.select(*kept), "_vector", "_whole", "_far")
    v = F.col(vector)
    rows = df.select(*kept, F.col(vector_col).cast("array<double>").alias(vector)).filter(
        v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    uncoded = lambda r: r.select(*kept, F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"),
                                 F.lit(None).cast("long").alias("exact_distances"))
    size = rows.groupBy(F.size(v).alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if size is None:
        return uncoded(rows), None
    largest = isqrt((1 << 62) // size["dim"]) // 2 // SCALE - 1
    usual = (F.size(v) == size["dim"]) & ~F.exists(v, lambda x: F.abs(x) > largest)
    first = _first_entries(rows.filter(usual), id_col, vector, parts, entries)
    if first is None:
        return uncoded(rows), None
    books = Codebooks(first, choose_pivots(first, pivots))

    fields = [rows.schema[c] for c in kept]
    ready = T.StructType([*fields, T.StructField(ints, T.ArrayType(T.LongType())), T.StructField(far, T.ArrayType(T.DoubleType()))])
    ready_rows = stored(rows.filter(usual).mapInArrow(_prepare(parts, books.pivots, len(kept), ready.names), ready), "vectorcode-rows")
    for _ in range(rounds):
        sums = (ready_rows.select(ints, far).mapInArrow(_sums(books), "part bigint, entry bigint, place bigint, total bigint, n bigint")
                .groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")))
        after = books.entries.copy()
        for r in sums.toLocalIterator():  # parts x entries x width rows at most
            after[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
        books = Codebooks(after, books.pivots)
    coded = T.StructType([*fields, T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType()),
                          T.StructField("exact_distances", T.LongType())])
    return ready_rows.mapInArrow(_codes(books, coded.names), coded).unionByName(uncoded(rows.filter(~usual))), books
