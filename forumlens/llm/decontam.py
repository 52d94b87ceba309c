"""Benchmark decontamination by greedy string tiling.

Runs of ``least`` words that a document shares with a benchmark item are its seeds. Seeds are
joined on their hash; a bitmap of the benchmark's seeds, of fixed size whatever the
benchmark's, keeps other runs out of the shuffle. Every (document, item) pair whose seeds
could cover the threshold is then tiled: Karp-Rabin hashes find the common runs, and the
longest run of unmarked words is marked in both texts, again and again, down to ``least``
words. As tiles may stand in any order, a passage with its sentences rearranged is covered
like the original. An item is leaked where tiles cover the threshold share of its words.

Equal texts are tiled once. Nothing but words on common runs travels: a tile cannot reach
beyond the runs of consecutive seeds, so whole texts are read but not shuffled.

Defined results: items of fewer than ``least`` words cannot be found (NULL and empty items
among them); NULL and empty documents are clean; repeated rows are reported as often as they
stand there; a repeated item is reported under each of its ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FILTER_BITS, fresh, maybe_in, rows_not_of, small_batches, stored, text_blocks, window_hashes, word_hashes

#: Words of the shortest tile, and the share of an item's words that tiles must cover.
LEAST_WORDS, COVERAGE = 5, 0.5


def _run_length(p: np.ndarray, t: np.ndarray, i: int, j: int) -> int:
    """Equal words from (i, j) on, compared in blocks of doubling size."""
    most, k, step = min(len(p) - i, len(t) - j), 0, 16
    while k < most:
        end = min(most, k + step)
        same = p[i + k:i + end] == t[j + k:j + end]
        if not same.all():
            return k + int(same.argmin())
        k, step = end, step * 2
    return most


def common_runs(p: np.ndarray, t: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of at least ``least`` words: (-length, place in p, place in t).

    Karp-Rabin hashes of ``least`` words name the places where a run can start. Places of one
    hash are kept apart by the word before them: equal words before two places mean that the
    run started earlier, so a word that repeats without end gives one run per diagonal and
    not one per pair of places.
    """
    hp, ht = window_hashes(p, least), window_hashes(t, least)
    places: dict[int, dict[int, list[int]]] = {}
    for j in np.flatnonzero(np.isin(ht, hp)).tolist():
        places.setdefault(int(ht[j]), {}).setdefault(int(t[j - 1]) if j else -1, []).append(j)
    runs = []
    for i, h in enumerate(hp.tolist()):
        before = int(p[i - 1]) if i else -2
        for other, starts in places.get(h, {}).items():
            if other != before:
                for j in starts:
                    if (k := _run_length(p, t, i, j)) >= least:
                        runs.append((-k, i, j))
    return runs


def _free_pieces(free: np.ndarray, i: int, j: int, least: int) -> Iterator[tuple[int, int, int]]:
    """Runs of true values in a part of the run (i, j), as runs of their own."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if b - a >= least:
            yield a - b, i + a, j + a


def tile(pattern: np.ndarray, text: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: (length, place in pattern, place in text), longest first.

    Maximal runs wait in a queue by length (equal ones by place). The longest is marked if
    all of it is free; what is left of one that was partly marked goes back with its new length.
    """
    tiles: list[tuple[int, int, int]] = []
    free_p, free_t, left = np.ones(len(pattern), bool), np.ones(len(text), bool), len(pattern)
    queue = common_runs(pattern, text, least)
    heapq.heapify(queue)
    while queue and left >= least:
        k, i, j = heapq.heappop(queue)
        free = free_p[i:i - k] & free_t[j:j - k]
        if free.all():
            free_p[i:i - k] = free_t[j:j - k] = False
            left += k
            tiles.append((-k, i, j))
        else:
            for piece in _free_pieces(free, i, j, least):
                heapq.heappush(queue, piece)
    return tiles


def _items(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, seeds = [], []
            for text in batch.column("text").to_pylist():
                hashes, _ = word_hashes([text])
                tokens.append(hashes.view(np.int64))
                seeds.append(window_hashes(hashes, least).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(tokens, pa.list_(pa.int64())), pa.array(seeds, pa.list_(pa.int64()))],
                                             names=["item", "tokens", "seeds"])

    return run


def _seeded_runs(least: int, bitmap):
    """Of each text, the maximal runs of words all of whose seeds may be in the benchmark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            keys, texts = batch.column("key").to_numpy(), batch.column("text").to_pylist()
            for a, b in text_blocks(texts):
                hashes, sizes = word_hashes(texts[a:b])
                ends = np.cumsum(sizes)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                seeds = window_hashes(hashes, least)
                n = len(seeds)
                if not n:
                    continue
                slot = seeds % np.uint64(FILTER_BITS)
                hit = (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
                hit = (hit == 1) & (np.arange(n) + least <= ends[owner[:n]])
                at = np.flatnonzero(hit)
                if not len(at):
                    continue
                new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])]))
                last = np.concatenate([at[new[1:] - 1], at[-1:]])
                first = at[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a + owner[first]]), pa.array(first - (ends - sizes)[owner[first]]),
                     pa.array([hashes[x:y + least].view(np.int64) for x, y in zip(first, last)], pa.list_(pa.int64())),
                     pa.array([seeds[x:y + 1].view(np.int64) for x, y in zip(first, last)], pa.list_(pa.int64()))],
                    names=["key", "start", "tokens", "seeds"])

    return run


def _tile_pairs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pattern, runs in zip(batch.column("tokens").to_pylist(), batch.column("runs").to_pylist()):
                pattern = np.array(pattern, np.int64).view(np.uint64)
                text, marks = [], []
                for n, part in enumerate(sorted(runs, key=lambda r: r["start"])):
                    text += [*part["tokens"], n]  # a value that is no word's hash keeps runs apart
                    marks += [0] * len(part["tokens"]) + [1]
                text = np.array(text, np.int64).view(np.uint64)
                tiles = tile(pattern, text, least)
                out.append((sum(k for k, _, _ in tiles) / len(pattern), len(tiles), max((k for k, _, _ in tiles), default=0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("item_key"), *(pa.array(list(c), t) for c, t in zip(
                    zip(*out), (pa.float64(), pa.int64(), pa.int64())))] if out else
                [batch.column("key"), batch.column("item_key"), pa.array([], pa.float64()), pa.array([], pa.int64()), pa.array([], pa.int64())],
                names=["key", "item_key", "coverage", "n_tiles", "longest"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
          least: int = LEAST_WORDS, coverage: float = COVERAGE) -> DataFrame:
    """(key, item, coverage, n_tiles, longest): items leaked into texts; key is xxhash64 of the text."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = benchmark.schema[item_col].dataType.simpleString()
    items = stored(benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
                   .mapInArrow(_items(least), f"item {kind}, tokens array<bigint>, seeds array<bigint>")
                   .filter(F.size("seeds") > 0).withColumn("item_key", F.xxhash64("tokens")), "decontam-items")
    once = items.groupBy("item_key").agg(F.any_value("tokens").alias("tokens"), F.any_value("seeds").alias("seeds"))
    # a seed counts at every place of the item it stands at: each tiled word lies in the ``least`` words of such a place
    seeds = (once.select("item_key", F.size("tokens").alias("n_words"), F.explode("seeds").alias("seed"))
             .groupBy("item_key", "seed").agg(F.count(F.lit(1)).alias("places"), F.any_value("n_words").alias("n_words")))

    # the hash is unsigned in Python: its low bits are the same
    slot = F.expr(f"seed & {FILTER_BITS - 1}L")
    words = (seeds.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).collect())  # at most FILTER_BITS / 64 rows
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words:
        bits[row.word] = row.bits
    bitmap = spark.sparkContext.broadcast(bits.view(np.uint64))

    runs = stored(docs.filter(F.col(text_col).isNotNull()).select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
                  .mapInArrow(_seeded_runs(least, bitmap), "key bigint, start bigint, tokens array<bigint>, seeds array<bigint>")
                  .dropDuplicates(["key", "start"]), "decontam-runs")
    shared = runs.select("key", F.explode("seeds").alias("seed")).distinct().join(seeds, "seed")
    pairs = (shared.groupBy("key", "item_key").agg(F.sum("places").alias("n"), F.max("n_words").alias("n_words"))
             .filter(F.col("n") * least >= F.lit(coverage) * F.col("n_words")).select("key", "item_key"))
    by_text = runs.groupBy("key").agg(F.collect_list(F.struct("start", "tokens")).alias("runs"))  # of one text
    tiled = (pairs.join(by_text, "key").join(once.select("item_key", "tokens"), "item_key").select("key", "item_key", "runs", "tokens")
             .mapInArrow(_tile_pairs(least), "key bigint, item_key bigint, coverage double, n_tiles bigint, longest bigint")
             .filter(F.col("coverage") >= coverage))
    return stored(tiled.join(items.select("item_key", "item"), "item_key")
                  .select("key", "item", "coverage", "n_tiles", "longest"), "decontam-leaks")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest): one row per document and benchmark item leaked into it."""
    found = leaks(docs, benchmark, text_col, **options)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"))
    marked, flag = maybe_in(keyed, ["key"], found)
    return marked.filter(flag).join(found, "key").select("doc_id", F.col("item").alias("item_id"), "coverage", "n_tiles", "longest")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` into which no benchmark item leaked, with all columns."""
    (key,) = fresh(docs, "_text_key")
    bad = leaks(docs, benchmark, text_col, **options).select(F.col("key").alias(key)).distinct()
    return rows_not_of(docs.withColumn(key, F.xxhash64(text_col)), key, bad).drop(key)
