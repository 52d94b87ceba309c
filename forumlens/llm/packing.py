"""Best-fit packing into sequences of several permitted lengths.

Texts are cut into pieces of at most the largest permitted length. Pieces of equal length
are interchangeable, so the plan is made on the histogram of lengths, whose size is bounded
by the largest length and not by the data: best-fit decreasing with multiplicities. Lengths
are placed from the longest down; each goes into the open bins with the least room that
still hold it. Where no open bin does, bins of the least cost are opened: every permitted
size is priced by its cost per token, filled with this length and with what the remaining
histogram could still add. In the end every bin shrinks to the smallest permitted size that
holds its contents. Ranges of equal bins are one entry of the plan throughout.

Spark numbers the pieces of each length, spread over ``BLOCKS`` parts of it, so a length
that a third of all pieces have is no single task; the piece's number gives its bin.

Defined results: a NULL or empty text is one piece of length 0 without a bin; repeated rows
are packed separately; bins hold whole pieces and never more than their size.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

SIZES = (1024, 2048, 4096, 8192, 16384)
BLOCKS = 1024


def attention_cost(size: int) -> float:
    """Cost of a sequence: one unit per token and a term that grows with the square of the length."""
    return size + size * size / 65536


@dataclass
class Plan:
    """Placements by (length, first number) and bins by first id, as sorted arrays."""

    key: np.ndarray  # length << 40 | number of the first piece placed
    per_bin: np.ndarray
    first_bin: np.ndarray
    offset: np.ndarray
    bin_start: np.ndarray
    bin_size: np.ndarray


def _filled(size: int, length: int, count: int, shorter: list[int], left: dict[int, int]) -> int:
    """Tokens that a new bin of this size would hold: pieces of this length, then the longest of the rest that fit."""
    n = min(size // length, count)
    room = size - n * length
    used: dict[int, int] = defaultdict(int)
    at = bisect_left(shorter, room + 1) - 1
    while room and at >= 0:
        v = shorter[at]
        if v > room or left[v] <= used[v]:
            at = min(at - 1, bisect_left(shorter, room + 1) - 1)
            continue
        k = min(room // v, left[v] - used[v])
        used[v] += k
        room -= k * v
    return size - room


def plan(histogram: dict[int, int], sizes: tuple[int, ...] = SIZES, cost=attention_cost) -> Plan:
    """Variable-capacity best-fit decreasing over a histogram of lengths (all within the largest size)."""
    sizes = tuple(sorted(sizes))
    left = {n: c for n, c in histogram.items() if n > 0 and c > 0}
    lengths = sorted(left)
    rooms: list[int] = []  # amounts of room that some open bins have
    bins: dict[int, list[tuple[int, int, int]]] = {}  # room: ranges (first bin, bins, tokens in each)
    placed, closed = [], []
    next_bin = 0

    def put(first: int, n: int, used: int, room: int) -> None:
        if not room:
            closed.append((first, n, used))
        elif room in bins:
            bins[room].append((first, n, used))
        else:
            insort(rooms, room)
            bins[room] = [(first, n, used)]

    while lengths:
        length = lengths.pop()
        count, number = left.pop(length), 0
        while count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                size = min((s for s in sizes if s >= length),
                           key=lambda s: (cost(s) / _filled(s, length, count, lengths, left), s))
                put(next_bin, -(-count // (size // length)), 0, size)
                next_bin += -(-count // (size // length))
                continue
            room = rooms[at]
            first, n, used = bins[room].pop()
            if not bins[room]:
                del bins[room]
                rooms.pop(at)
            per = min(room // length, count)
            take = min(n, count // per)
            placed.append((length, number, per, first, used))
            put(first, take, used + per * length, room - per * length)
            if n > take:
                put(first + take, n - take, used, room)
            number += take * per
            count -= take * per
    for room, ranges in bins.items():
        closed += ranges
    closed = sorted(r for r in closed if r[2])
    placed.sort()
    cols = list(zip(*placed)) or [()] * 5
    return Plan((np.array(cols[0], np.int64) << 40) | np.array(cols[1], np.int64), *(np.array(c, np.int64) for c in cols[2:]),
                np.array([r[0] for r in closed], np.int64),
                np.array([next(s for s in sizes if s >= r[2]) for r in closed], np.int64))


def _look_up(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Plan(*shared.value)
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            bin_id, offset, size = (np.zeros(len(length), np.int64) for _ in range(3))
            some = length > 0
            if some.any():
                at = np.searchsorted(p.key, (length[some] << 40) | number[some], "right") - 1
                within = number[some] - (p.key[at] & ((1 << 40) - 1))
                bin_id[some] = p.first_bin[at] + within // p.per_bin[at]
                offset[some] = p.offset[at] + within % p.per_bin[at] * length[some]
                size[some] = p.bin_size[np.searchsorted(p.bin_start, bin_id[some], "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("piece"), batch.column("start"), batch.column("length"),
                 *(pa.array(v, mask=~some) for v in (bin_id, offset, size))],
                names=["doc_id", "piece", "start", "length", "bin_id", "bin_offset", "bin_size"])

    return run


def packed(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None, sizes: tuple[int, ...] = SIZES,
           cost=attention_cost) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, bin_offset, bin_size) of every piece of every row.

    ``length`` measures a row in tokens; the default is the bytes of ``text``, for byte-level
    models. ``start`` is the piece's place in its document, ``bin_offset`` in its bin.
    """
    spark = docs.sparkSession
    small_batches(spark)
    most = max(sizes)
    total = F.coalesce((F.octet_length("text") if length is None else length).cast("long"), F.lit(0).cast("long"))
    cut = docs.select(F.col(id_col).alias("doc_id"), total.alias("total"))
    pieces = (cut.select("doc_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(
        F.lit(0).cast("long"), F.expr(f"(total - 1) div {most}")))).alias("piece"))
        .select("doc_id", "piece", (F.col("piece") * most).alias("start"),
                F.least(F.lit(most).cast("long"), F.col("total") - F.col("piece") * most).alias("length"))
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BLOCKS))))
    pieces = stored(pieces, "packing-pieces")
    counts = pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")).drop("n")
    # at most one row per length up to the largest size
    made = plan({r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}, sizes, cost)
    shared = spark.sparkContext.broadcast(astuple(made))
    order = Window.partitionBy("length", "block").orderBy("doc_id", "piece")
    numbered = (pieces.withColumn("at", F.row_number().over(order)).join(before, ["length", "block"])
                .withColumn("number", F.col("before") + F.col("at") - 1).select("doc_id", "piece", "start", "length", "number"))
    kind = docs.schema[id_col].dataType.simpleString()
    return numbered.mapInArrow(_look_up(shared), f"doc_id {kind}, piece bigint, start bigint, length bigint, "
                                                 "bin_id bigint, bin_offset bigint, bin_size bigint")


def fill_share(bins: DataFrame) -> float:
    """Share of the opened sequences' tokens that are in use."""
    row = (bins.filter("bin_id is not null").groupBy("bin_id").agg(F.sum("length").alias("used"), F.max("bin_size").alias("size"))
           .agg(F.sum("used").alias("used"), F.sum("size").alias("size")).first())
    return row.used / row.size if row.size else math.nan
