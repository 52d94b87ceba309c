"""What the operators share: stored stages, words and shingles, filters by id, connected components."""

from __future__ import annotations

import gc
import re
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: Words a shingle takes, and the similarity from which two texts are near duplicates.
SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Bits of the id filter: its size, 2 MB, is the same for any input; a full filter only saves nothing.
FILTER_BITS = 1 << 24
_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once by bytes as well as by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


# ---- stored stages


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the folder all executors share and read it back.

    Later stages read finished files, so a lost executor repeats its own tasks only, and a
    relation that feeds several branches is the same in all of them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose results are stored; it does so when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Delete the files of a stored relation that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Working names for columns of ours that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


# ---- words and shingles, vectorised over a batch of texts


class _WordHashes(dict):
    """64-bit hash by word; forgotten when it holds 50,000 words (7 MB), since workers live through many stages."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 50_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal bits in, equal bits out, all of them spread."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _WORD.findall(text.lower()) if text else []


def word_hashes(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in one array, and the number of words of each text."""
    parts, sizes = [], []
    for text in texts:
        found = words(text)
        parts.append(np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found)))
        sizes.append(len(found))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.array(sizes, np.int64)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` values; entry i is the run that starts at i."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = (out + hashes[k:k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return mix(out)


def shingles(texts: Iterable[str | None], width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, shingle hash) of all texts, in text order; fewer words than ``width`` make one shingle."""
    hashes, sizes = word_hashes(texts)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    all_windows = window_hashes(hashes, width)
    inside = np.arange(len(all_windows)) + width <= starts[owner[:len(all_windows)] + 1]
    doc, value = owner[:len(all_windows)][inside], all_windows[inside]
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        own = np.array([window_hashes(hashes[starts[i]:starts[i + 1]], int(sizes[i]))[0] for i in short], np.uint64)
        doc, value = np.concatenate([doc, short]), np.concatenate([value, own])
        order = np.argsort(doc, kind="stable")
        doc, value = doc[order], value[order]
    return doc, value


def text_blocks(texts: list, most: int = 1 << 20, rows: int = 256) -> Iterator[tuple[int, int]]:
    """Ranges of a batch with about ``most`` characters and at most ``rows`` texts; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and (size + n > most or i - start >= rows):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


# ---- arrays


def running_total(values: Column, block: int = 256) -> Column:
    """Running sums of an array; by blocks, so that appending stays cheap for long arrays."""
    zero = F.array(F.lit(0))
    add = lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x)
    n = F.size(values)
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(block)), lambda s: F.slice(values, s + 1, block))
    sums = F.transform(blocks, lambda b: F.slice(F.aggregate(b, zero, add), 2, block))
    starts = F.aggregate(sums, zero, lambda acc, b: F.array_append(acc, F.element_at(acc, -1) + F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0))))
    return F.flatten(F.zip_with(sums, F.slice(starts, 1, F.size(sums)), lambda b, s: F.transform(b, lambda x: x + s)))


# ---- filters by id


def _slot(keys: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))


def maybe_in(df: DataFrame, keys: list[str], ids: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a boolean column: false only where the key is surely not in ``ids``.

    A bitmap of fixed size is broadcast (at most FILTER_BITS / 64 rows, whatever the input),
    so that wide rows without a partner need no shuffle.
    """
    flag, slot, word, bits = fresh(df, "_maybe", "_slot", "_word", "_bits")
    bitmap = (ids.select(_slot([F.col(k) for k in keys]).alias(slot))
              .groupBy(F.shiftright(slot, 6).alias(word))
              .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST({slot} % 64 AS INT))")).alias(bits)))
    marked = (df.withColumn(slot, _slot([df[k] for k in keys])).withColumn(word, F.shiftright(slot, 6))
              .join(F.broadcast(bitmap), word, "left")
              .withColumn(flag, F.expr(f"coalesce(shiftright({bits}, CAST({slot} % 64 AS INT)) & 1L, 0L) = 1L")))
    return marked.select(*[marked[c] for c in df.columns], marked[flag]), flag


def rows_of(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is in ``ids``; only rows that pass the filter are shuffled."""
    marked, flag = maybe_in(df, [key], ids)
    return marked.filter(flag).drop(flag).join(ids.select(key).distinct(), key, "left_semi").select(*df.columns)


def rows_not_of(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is not in ``ids``, NULL keys included; only possible hits are shuffled."""
    marked, flag = maybe_in(df, [key], ids)
    sure = marked.filter(~F.col(flag)).drop(flag)
    rest = marked.filter(flag).drop(flag).join(ids.select(key).distinct(), key, "left_anti").select(*df.columns)
    return sure.unionByName(rest)


def joined_by_id(df: DataFrame, key: str, facts: DataFrame) -> DataFrame:
    """Left join with ``facts`` (one row per key); rows surely without facts are not shuffled."""
    marked, flag = maybe_in(df, [key], facts)
    added = [c for c in facts.columns if c != key]
    sure = marked.filter(~F.col(flag)).drop(flag).select("*", *[F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in added])
    rest = marked.filter(flag).drop(flag).join(facts, key, "left").select(*df.columns, *added)
    return sure.unionByName(rest)


# ---- facts of groups that may hold any share of the rows

#: Groups that are broadcast in ``joined_by_group``.
LARGE_GROUPS = 1000


def joined_by_group(rows: DataFrame, keys: list[str], groups: DataFrame, size: str) -> DataFrame:
    """Left join of ``rows`` with ``groups`` (one row per key, NULL keys included; ``size`` is its number of rows).

    The ``LARGE_GROUPS`` largest groups are broadcast, and only rows of other groups are
    shuffled: whatever share of the rows one key has, no task receives it. ``rows`` is read
    twice and should be stored.
    """
    hit, = fresh(rows, "_hit")
    mine = fresh(rows, *(f"_key_{k}" for k in keys))
    named = groups.select(*[F.col(k).alias(m) for k, m in zip(keys, mine)], *[c for c in groups.columns if c not in keys])
    large = stored(named.orderBy(F.desc(size), *mine).limit(LARGE_GROUPS).withColumn(hit, F.lit(True)), "large-groups")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(m)) for k, m in zip(keys, mine)])
    added = [c for c in groups.columns if c not in keys]
    first = rows.join(F.broadcast(large), same, "left")
    small = named.join(F.broadcast(large.select(*[F.col(m).alias(f"{m}_") for m in mine])),
                       reduce(lambda a, b: a & b, [F.col(m).eqNullSafe(F.col(f"{m}_")) for m in mine]), "left_anti")
    rest = first.filter(F.col(hit).isNull()).select(*rows.columns).join(small, same, "left")
    return first.filter(F.col(hit)).select(*rows.columns, *added).unionByName(rest.select(*rows.columns, *added))


# ---- connected components


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node it is linked to.

    Alternating large-star and small-star steps, each a minimum per node and a join, until
    the edges no longer change; every step is stored. Rounds grow with the logarithm of the
    longest chain, and no node's links are gathered anywhere.
    """
    links = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        after = stored(small, name)
        now = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(links)
        links = after
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
