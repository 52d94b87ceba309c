"""MinHash near-duplicates by thrown darts (DartMinHash) and banded joins.

Every shingle owns a strip of the plane (weight x rank) on which darts fall as a Poisson
process seeded by the shingle alone; darts within the shingle's weight and below a rank
limit are hit, each names one of K coordinates, and the earliest dart per coordinate is the
signature. Two weighted sets agree at a coordinate with probability equal to their weighted
Jaccard similarity, and the work is one hash per shingle plus about K ln K darts per text.

Texts with equal shingle sets are one node from the start. Nodes that share a band are
candidates: each meets the smallest node of the bucket, every candidate pair is verified on
the exact shingle sets, and only pairs of a bucket that are still in different classes meet
afterwards. Classes are the connected components of verified links.

Defined results: a text without words is in no class but its own, unless another text is
equal to it; NULL and empty texts are always alone. Repeated rows share a class; a class
whose doc_ids are all NULL has a NULL class_id. Extra columns are kept by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (SHINGLE_WORDS, SIMILARITY, components, discard, fresh, mix, release, rows_not_of, rows_of, shingles, small_batches,
                     stored, text_blocks)

#: 24 bands of 5: a pair at 0.8 shares a band with probability 0.99993, at 0.9 with 1 - 5e-10.
BANDS, BAND_ROWS = 24, 5
_U = 1.0 / (1 << 53)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * _U


def _darts(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, limit: np.ndarray):
    """(owner, rank, id) of the darts that hit each element's region below its owner's rank limit.

    The weight axis is cut at powers of two; each cell has its own process along the rank
    axis, so that elements of different weight share the darts of the cells they have in common.
    """
    out = []
    cell = 0
    live = np.arange(len(element))
    while len(live):
        low, high = (0.0, 1.0) if cell == 0 else (float(2 ** (cell - 1)), float(2 ** cell))
        seed = mix(element[live] + np.uint64((0xA24BAED4963EE407 * (cell + 1)) & (2 ** 64 - 1)))
        rank = np.zeros(len(live))
        rows, step = live, 0
        while len(rows):
            step += 1
            arrival = mix(seed + np.uint64((0x9FB21C651E98DF25 * step) & (2 ** 64 - 1)))
            rank = rank - np.log(_uniform(arrival)) / (high - low)
            on = rank <= limit[owner[rows]]
            rows, rank, seed, arrival = rows[on], rank[on], seed[on], arrival[on]
            place = low + (high - low) * _uniform(mix(arrival + np.uint64(1)))
            hit = place < weight[rows]
            out.append((owner[rows][hit], rank[hit], mix(arrival + np.uint64(2))[hit]))
        cell += 1
        live = live[weight[live] > high]
    return tuple(map(np.concatenate, zip(*out))) if out else (np.empty(0, np.int64), np.empty(0), np.empty(0, np.uint64))


def dart_signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """The (n, k) signatures of n weighted sets, given as rows (owner, element, weight); zero where a set is empty."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(owner, weight, n)
    todo = np.flatnonzero(total > 0)
    throws = k * (np.log(k) + 5.0)
    while len(todo):
        limit = np.zeros(n)
        limit[todo] = throws / total[todo]
        inside = limit[owner] > 0
        who, rank, dart = _darts(owner[inside], element[inside], weight[inside], limit)
        at = who * k + (dart % np.uint64(k)).astype(np.int64)
        order = np.lexsort((dart, rank, at))
        at, dart = at[order], dart[order]
        first = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.empty(0, bool)
        out.reshape(-1)[at[first]] = mix(dart[first]) | np.uint64(1)
        todo = todo[(out[todo] == 0).any(axis=1)]
        out[todo] = 0
        throws *= 2
    return out


def _sets(texts: list, width: int, weights: str):
    """Distinct (owner, shingle, weight) of a batch, sorted by owner and shingle."""
    owner, value = shingles(texts, width)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])]) if len(owner) else np.empty(0, bool)
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(owner)]])).astype(np.float64)
    return owner[at], value[at], count if weights == "count" else np.ones(len(at))


def _node_keys(texts: list, owner: np.ndarray, value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Hash of each shingle set; of the text itself where there is no word."""
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
    key = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = slice(starts[i], starts[i + 1])
        raw = value[own].tobytes() + weight[own].tobytes() or (text or "").encode("utf-8", "surrogatepass")
        key[i] = xxhash.xxh64_intdigest(raw, int(starts[i + 1] > starts[i])) - (1 << 63)
    return key


def _alone(texts: list) -> pa.Array:
    return pa.array([not (t and t.strip()) for t in texts], pa.bool_())


def _describe(width: int, bands: int, rows: int, weights: str):
    k = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_blocks(texts):
                part = texts[a:b]
                owner, value, weight = _sets(part, width, weights)
                sig = dart_signatures(owner, value, weight, b - a, k)
                band = np.zeros((b - a, bands), np.uint64)
                for r in range(rows):
                    band = mix(band * np.uint64(31) + sig[:, r::rows])
                band = mix(band + np.arange(bands, dtype=np.uint64))
                size = np.bincount(owner, minlength=b - a)
                key = _node_keys(part, owner, value, weight)
                flat = pa.array(band[size > 0].reshape(-1).view(np.int64))
                offsets = np.concatenate([[0], np.cumsum(np.where(size > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(key), _alone(part), pa.ListArray.from_arrays(offsets, flat)],
                    names=["doc_id", "node", "alone", "bands"])

    return run


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
              bands: int = BANDS, rows: int = BAND_ROWS, weights: str = "set") -> DataFrame:
    """(doc_id, node, alone, bands) of every row: the hash of its shingle set and of its bands.

    ``weights``: "set" gives every shingle the weight 1 (plain Jaccard), "count" its number
    of occurrences (weighted Jaccard).
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _describe(width, bands, rows, weights), f"doc_id {kind}, node bigint, alone boolean, bands array<bigint>")


def _shingle_rows(width: int, weights: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in text_blocks(texts):
                owner, value, weight = _sets(texts[a:b], width, weights)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=b - a))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_node_keys(texts[a:b], owner, value, weight)),
                     pa.ListArray.from_arrays(offsets, pa.array(value.view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(weight))], names=["node", "items", "weights"])

    return run


def _similar(threshold: float):
    """Keep the pairs whose (weighted) Jaccard similarity is at least the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            lists = []
            for c in ("items_a", "weights_a", "items_b", "weights_b"):
                col = batch.column(c)
                lists.append((col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)))
            for i in range(batch.num_rows):
                ia, wa, ib, wb = (v[o[i]:o[i + 1]] for o, v in lists)
                at = np.searchsorted(ib.view(np.uint64), ia.view(np.uint64))
                at[at == len(ib)] = 0
                same = ib[at] == ia
                common = np.minimum(wa[same], wb[at[same]]).sum()
                keep[i] = common >= threshold * (wa.sum() + wb.sum() - common) - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return run


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose exact similarity reaches the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"), F.col("weights").alias("weights_a"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"), F.col("weights").alias("weights_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "items_a", "weights_a", "items_b", "weights_b").mapInArrow(
        _similar(threshold), "a bigint, b bigint")


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY,
                      width: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = BAND_ROWS,
                      weights: str = "set") -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, alone) of every row, and (node, root, class_id) of every node that is not alone."""
    described_rows = stored(described(docs, id_col, text_col, width, bands, rows, weights), "neardup-rows")
    members = described_rows.filter("not alone")
    nodes = stored(members.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands")), "neardup-nodes")

    buckets = nodes.filter(F.size("bands") > 0).select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    crowded = stored(buckets.join(shared, "bucket"), "neardup-buckets")
    star = stored(crowded.filter("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct(), "neardup-star")
    wanted = stored(star.select(F.col("a").alias("node")).union(star.select("b")).distinct()
                    .join(nodes.select("node", "doc_id"), "node"), "neardup-wanted")

    # one text per node that has a candidate: the first by id; its whole shingle set is stored once
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = rows_of(given, "doc_id", wanted).unionByName(given.filter("doc_id is null"))
    sets = stored(texts.select("text").mapInArrow(_shingle_rows(width, weights), "node bigint, items array<bigint>, weights array<double>")
                  .join(wanted.select("node"), "node", "left_semi").groupBy("node")
                  .agg(F.any_value("items").alias("items"), F.any_value("weights").alias("weights")), "neardup-sets")

    links = stored(verified(star, sets, threshold), "neardup-links")
    classes = stored(components(links), "neardup-classes")

    release(docs.sparkSession)
    # nodes of buckets that still hold several classes meet again: first in finer buckets of two
    # bands, with both ends of each, then wherever their rarest shingles leave room for the threshold
    star_pairs = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    unsure = stored(_mixed(crowded, classes).select("node", "root").distinct().join(nodes.select("node", "bands"), "node"), "neardup-unsure")
    fine = unsure.select("node", "root", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.element_at("bands", i), F.element_at("bands", i + 1)))).alias("bucket"))
    ends = fine.groupBy("bucket").agg(F.min(F.struct("node", "root")).alias("low"), F.max(F.struct("node", "root")).alias("high"))
    closer = (fine.join(ends, "bucket").select("node", "root", F.explode(F.array("low", "high")).alias("end")).filter("root <> end.root")
              .select(F.least("node", "end.node").alias("a"), F.greatest("node", "end.node").alias("b")).distinct()
              .join(star_pairs, ["a", "b"], "left_anti"))
    closer = stored(closer, "neardup-closer")
    links = stored(links.unionByName(verified(closer, sets, threshold)), "neardup-links")
    classes = stored(components(links), "neardup-classes")
    open_nodes = _mixed(crowded, classes).select("node", "root").distinct()
    cross = (_prefix_pairs(open_nodes, sets, threshold)
             .join(star_pairs.unionByName(closer), ["a", "b"], "left_anti"))
    more = stored(verified(cross, sets, threshold), "neardup-more")
    roots = classes if more.isEmpty() else stored(components(links.unionByName(more)), "neardup-roots")

    named = nodes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    classes_of = stored(named.join(smallest, "root").select("node", "root", "class_id"), "neardup-result")
    for df in {id(df): df for df in (crowded, star, wanted, sets, unsure, closer, links, classes, more, roots)}.values():
        discard(df)
    return described_rows.drop("bands"), classes_of


def _mixed(crowded: DataFrame, classes: DataFrame) -> DataFrame:
    """(bucket, node, low, root) of the buckets of three or more whose nodes are in different classes."""
    labelled = (crowded.filter("n > 2").join(classes, "node", "left")
                .select("bucket", "node", "low", F.coalesce("root", "node").alias("root")))
    mixed = labelled.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("bucket")
    return labelled.join(mixed, "bucket")


def _prefix_pairs(open_nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of nodes of different classes that can reach the threshold; none that does is missed.

    Shingles stand from rare to frequent. Two sets that reach the threshold share one within
    the first places, and from the first that they share there must be enough left in both.
    """
    tokens = (open_nodes.join(sets, "node").select("node", "root", F.explode(F.arrays_zip("items", "weights")).alias("s"))
              .select("node", "root", F.explode(F.sequence(F.lit(1), F.col("s.weights").cast("int"))).alias("copy"), "s.items")
              .select("node", "root", F.xxhash64("items", "copy").alias("token")))
    tokens = stored(tokens, "neardup-tokens")
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    # tokens of one node only come first and join nothing: only their number counts
    ranked = (tokens.join(often, "token", "left").groupBy("node", "root")
              .agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.when(F.col("often").isNotNull(), F.struct("often", "token")))).alias("shared"))
              .select("node", "root", "n", (F.col("n") - F.size("shared")).alias("own"), F.posexplode("shared").alias("at", "t"))
              .select("node", "root", "n", F.col("t.token").alias("token"), (F.col("n") - F.col("own") - F.col("at")).alias("left"))
              .filter(F.col("left") >= F.ceil(F.lit(threshold) * F.col("n") - 1e-9)))
    ranked = stored(ranked, "neardup-prefixes")
    one, two = (ranked.select("token", F.col("node").alias(x), F.col("root").alias(f"root_{x}"), F.col("n").alias(f"n_{x}"), F.col("left").alias(f"left_{x}"))
                for x in ("a", "b"))
    enough = F.lit(threshold / (1 + threshold)) * (F.col("n_a") + F.col("n_b")) - 1e-9
    return (one.join(two, (one["token"] == two["token"]) & (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b"))
                     & (F.least("left_a", "left_b") >= enough)).select("a", "b").distinct())


def _with_nodes(width: int, weights: str, names: list[str], text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for a, b in text_blocks(texts):
                part = texts[a:b]
                owner, value, weight = _sets(part, width, weights)
                columns = [c.slice(a, b - a) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(_node_keys(part, owner, value, weight)), _alone(part)], names=names)

    return run


def with_nodes(df: DataFrame, text_col: str, node: str, alone: str, width: int, weights: str) -> DataFrame:
    """``df`` with the node of every row, computed from its text."""
    schema = T.StructType([*df.schema.fields, T.StructField(node, T.LongType()), T.StructField(alone, T.BooleanType())])
    return df.mapInArrow(_with_nodes(width, weights, schema.names, df.columns.index(text_col)), schema)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: (doc_id, class_id); class_id is the smallest doc_id of its near-duplicate class."""
    rows, classes = duplicate_classes(docs, id_col, text_col, **options)
    alone = rows.filter("alone").select(F.col("doc_id"), F.col("doc_id").alias("class_id"))
    return rows.filter("not alone").join(classes, "node").select("doc_id", "class_id").unionByName(alone)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                 weights: str = "set", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the smallest doc_id stays.

    Of repeated rows with that doc_id, or of a class without ids, one stays; texts that are
    alone stay. All columns are kept. Rows that surely stay are not shuffled.
    """
    rows, classes = duplicate_classes(docs, id_col, text_col, width=width, weights=weights, **options)
    placed = rows.filter("not alone").join(classes, "node")
    repeated = stored(rows.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                      .select(F.col("doc_id").alias(id_col)), "neardup-repeated")
    gone = stored(placed.filter("doc_id <> class_id").select(F.col("doc_id").alias(id_col)).unionByName(repeated).distinct(),
                  "neardup-gone")
    clean = rows_not_of(docs.filter(F.col(id_col).isNotNull()), id_col, gone)
    # ids that are NULL or repeated say nothing about a row: its node decides
    node, alone, rank, root, named = fresh(docs, "_node", "_alone", "_rank", "_root", "_class")
    unsure = with_nodes(rows_of(docs, id_col, repeated).unionByName(docs.filter(F.col(id_col).isNull())),
                        text_col, node, alone, width, weights)
    of = classes.select(F.col("node").alias(node), F.col("root").alias(root), F.col("class_id").alias(named))
    chosen = (unsure.filter(~F.col(alone)).join(of, node).filter(F.col(id_col).eqNullSafe(F.col(named)))
              .withColumn(rank, F.row_number().over(Window.partitionBy(root).orderBy(node))).filter(F.col(rank) == 1))
    return clean.unionByName(chosen.select(*docs.columns)).unionByName(unsure.filter(alone).select(*docs.columns))
