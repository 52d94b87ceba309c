"""Exact removal of repeated byte strings by distributed prefix doubling.

Every position of a document has a name for the prefix that starts there. Names double:
the name for 2h bytes is the pair of the names for h bytes at the position and h further on
(1, 2, 4, … 32, 64, then 64 + 36 for the threshold of 100). A name is a 64-bit fingerprint of
the pair in place of its rank, so names of all documents agree, and there is no sort of
(position, rank) pairs and no reranking.

Sorting every position at 32 bytes would shuffle about twenty times the input. A string of 100 bytes is
represented by one of its 69 inner positions, the one with the smallest 32-byte name
(the leftmost of equals). Equal strings choose equal positions, so no repetition is lost,
and neighbouring strings mostly choose the same one: a run of them is one row, named also by
its whole context (at most 168 bytes). Rows are grouped by the hash of their name; those with
equal names and contexts repeat each other run by run. Only where contexts of one name differ,
the runs' first occurrences are sorted at 100 bytes, string by string, within the group.

Rows are dealt by name; equal names within a block of text are settled before, so that
a passage which a third of all documents hold arrives once per block. Rows travel as packed
arrays, and no group grows with the number of copies in a block.

Order of occurrences: smaller doc_id, then earlier start. NULL ids come last; rows with
equal ids (repeated rows) follow each other by the hash of their text. NULL and empty texts
have no bytes. Equality is that of 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, release, small_batches, stored

THRESHOLD, SEED = 100, 32
_INSIDE = THRESHOLD - SEED + 1
#: Bytes that one task holds: of text in a block, and of text that belongs to one group.
BLOCK_BYTES, GROUP_BYTES = 2 << 20, 8 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_PACKED = "slot int, settled boolean, names binary, contexts binary, seqs binary, starts binary, widths binary"
_FOUND = "part int, open boolean, seqs binary, starts binary, widths binary"


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * _A
    out += b
    out *= _B
    out ^= out >> np.uint64(32)
    return out


def names(data: np.ndarray) -> np.ndarray:
    """Names of all 32-byte prefixes, by doubling."""
    h = mix(np.arange(1, 257, dtype=np.uint64) * _A)[data]
    step = 1
    while step < SEED:
        h = _pair(h[:-step], h[step:])
        step *= 2
    return h


def threshold_names(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Names of the 100-byte prefixes at some positions, from the names of 32 bytes."""
    last = THRESHOLD - 2 * SEED
    return _pair(_pair(h[at], h[at + SEED]), _pair(h[at + last], h[at + last + SEED]))


def _chosen(h: np.ndarray) -> np.ndarray:
    """For every string of 100 bytes, its inner position with the smallest name, the leftmost of equals."""
    value, offset, width = h, np.zeros(len(h), np.uint8), 1
    while width < _INSIDE:
        step = min(width, _INSIDE - width)
        later = value[step:] < value[:-step]
        offset = np.where(later, offset[step:] + np.uint8(step), offset[:-step])
        value = np.minimum(value[:-step], value[step:])
        width += step
    return np.arange(len(offset)) + offset


def _blocks(seqs: np.ndarray, texts: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, first byte of each piece, its document, its place there); long texts in overlapping pieces."""
    parts, who, base, size = [], [], [], 0
    for seq, text in zip(seqs, texts):
        raw = np.frombuffer(text or b"", np.uint8)
        for a in range(0, max(0, len(raw) - THRESHOLD + 1), BLOCK_BYTES):
            piece = raw[a:a + BLOCK_BYTES + THRESHOLD - 1]
            if parts and size + len(piece) > BLOCK_BYTES:
                yield _block(parts, who, base)
                parts, who, base, size = [], [], [], 0
            parts.append(piece)
            who.append(seq)
            base.append(a)
            size += len(piece)
    if parts:
        yield _block(parts, who, base)


def _block(parts, who, base):
    sizes = np.array([len(p) for p in parts])
    return np.concatenate(parts), np.cumsum(sizes) - sizes, np.array(who, np.int64), np.array(base, np.int64)


def _packed(slot: np.ndarray, cols: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """Rows grouped by slot, each group as byte strings."""
    order = np.argsort(slot, kind="stable")
    slot, cols = slot[order], [c[order] for c in cols]
    cuts = np.flatnonzero(np.diff(slot)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(slot)]):
        if b > a:
            yield int(slot[a]), [c[a:b].tobytes() for c in cols]


def _part(seq: np.ndarray, groups: int) -> np.ndarray:
    return (seq ^ (seq >> 7)) % groups


def _same_as_before(*cols: np.ndarray) -> np.ndarray:
    out = np.ones(len(cols[0]), bool)
    out[:1] = False
    for c in cols:
        out[1:] &= c[1:] == c[:-1]
    return out


def _rows(groups: int, name, context, seq, start, width) -> list[tuple]:
    """Settle repetitions within the block; deal the rest by name."""
    order = np.lexsort((start, seq, context, name))
    name, context, seq, start, width = (c[order] for c in (name, context, seq, start, width))
    again = _same_as_before(name, context)
    # in order of position again: what lies beside each other is alike and travels compressed
    once = np.flatnonzero(~again)
    once = once[np.lexsort((start[once], seq[once]))]
    out = [(slot, False, *blobs) for slot, blobs in _packed((name[once] % np.uint64(groups)).astype(np.int64), [
        c[once] for c in (name, context, seq, start, width)])]
    if again.any():
        out += [(slot, True, b"", b"", *blobs) for slot, blobs in _packed(_part(seq[again], groups), [
            c[again] for c in (seq, start, width)])]
    return out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)] if rows else
                                      [pa.array([], f.type) for f in schema], schema=schema)


_PACKED_ARROW = pa.schema([("slot", pa.int32()), ("settled", pa.bool_()), *((n, pa.binary()) for n in ("names", "contexts", "seqs", "starts", "widths"))])
_FOUND_ARROW = pa.schema([("part", pa.int32()), ("open", pa.bool_()), *((n, pa.binary()) for n in ("seqs", "starts", "widths"))])


def _runs(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, first, who, base in _blocks(batch.column("seq").to_numpy(), batch.column("bytes").to_pylist()):
                h = names(data)
                at = _chosen(h)
                inside = np.zeros(len(at) + 1, np.int8)
                np.add.at(inside, first, 1)
                np.add.at(inside, np.append(first[1:], len(data)) - THRESHOLD + 1, -1)
                inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
                change = at[1:] != at[:-1]
                low = np.flatnonzero(inside & np.concatenate([[True], change | ~inside[:-1]]))
                high = np.flatnonzero(inside & np.concatenate([change | ~inside[1:], [True]]))
                context = mix(_pair(threshold_names(h, low), threshold_names(h, high)) + (high - low).astype(np.uint64))
                owner = np.searchsorted(first, low, "right") - 1
                start = (low - first[owner] + base[owner]).astype(np.int32)
                yield _batch(_rows(groups, h[at[low]], context, who[owner], start, (high - low).astype(np.uint8)), _PACKED_ARROW)

    return run


def _unpacked(table: pa.Table, columns: dict[str, type]) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(table.column(n).to_pylist()), t) for n, t in columns.items()]


def _settled(groups: int, table: pa.Table) -> list[tuple]:
    done = table.filter(table.column("settled"))
    return [(slot, False, *blobs) for slot, blobs in _merged(groups, *_unpacked(done, {"seqs": np.int64, "starts": np.int32, "widths": np.uint8}))]


def _merged(groups: int, seq, start, width):
    return _packed(_part(seq, groups), [seq, start, width])


def _compare_runs(groups: int):
    """Of one group of names: repeated runs, and first occurrences of contexts whose name has others (open)."""
    def run(table: pa.Table) -> pa.Table:
        rows = _settled(groups, table)
        name, context, seq, start, width = _unpacked(table.filter(pc.invert(table.column("settled"))), {
            "names": np.uint64, "contexts": np.uint64, "seqs": np.int64, "starts": np.int32, "widths": np.uint8})
        order = np.lexsort((start, seq, context, name))
        name, context, seq, start, width = (c[order] for c in (name, context, seq, start, width))
        again = _same_as_before(name, context)
        same_name = _same_as_before(name)
        group = np.cumsum(~same_name) - 1
        contexts = np.bincount(group, ~again) if len(group) else np.empty(0)
        unsure = ~again & (contexts[group] > 1) if len(group) else again
        rows += [(slot, False, *blobs) for slot, blobs in _merged(groups, seq[again], start[again], width[again])]
        rows += [(slot, True, *blobs) for slot, blobs in _merged(groups, seq[unsure], start[unsure], width[unsure])]
        return pa.Table.from_batches([_batch(rows, _FOUND_ARROW)])

    return run


def _open_strings(groups: int):
    """The 100-byte names of the strings in open runs, for the texts of one part."""
    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        seq, start, width = _unpacked(found, {"seqs": np.int64, "starts": np.int32, "widths": np.uint8})
        order = np.argsort(seq, kind="stable")
        seq, start, width = seq[order], start[order], width[order]
        rows = []
        ids, raw = texts.column("seq").to_numpy(), texts.column("bytes")
        low, high = np.searchsorted(seq, ids, "left"), np.searchsorted(seq, ids, "right")
        name, who, place = [], [], []
        size = 0
        for i in range(len(ids)):
            if high[i] > low[i]:
                data = np.frombuffer(raw[i].as_py(), np.uint8)
                n = width[low[i]:high[i]].astype(np.int64) + 1
                at = np.repeat(start[low[i]:high[i]].astype(np.int64) - np.cumsum(n) + n, n) + np.arange(n.sum())
                name.append(_names_at(data, at))
                who.append(np.full(len(at), ids[i]))
                place.append(at.astype(np.int32))
                size += len(at)
            if name and (size > BLOCK_BYTES // 4 or i == len(ids) - 1):
                name, who, place = map(np.concatenate, (name, who, place))
                rows += _rows(groups, name, np.zeros(len(name), np.uint64), who, place, np.zeros(len(name), np.uint8))
                name, who, place, size = [], [], [], 0
        if name:
            name, who, place = map(np.concatenate, (name, who, place))
            rows += _rows(groups, name, np.zeros(len(name), np.uint64), who, place, np.zeros(len(name), np.uint8))
        return pa.Table.from_batches([_batch(rows, _PACKED_ARROW)])

    return run


def _names_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """100-byte names at some positions of a text, piece by piece."""
    out = np.empty(len(at), np.uint64)
    for a in range(0, len(data), BLOCK_BYTES):
        own = (at >= a) & (at < a + BLOCK_BYTES)
        if own.any():
            out[own] = threshold_names(names(data[a:a + BLOCK_BYTES + THRESHOLD - 1]), at[own] - a)
    return out


def _compare_strings(groups: int):
    def run(table: pa.Table) -> pa.Table:
        rows = _settled(groups, table)
        name, seq, start = _unpacked(table.filter(pc.invert(table.column("settled"))), {
            "names": np.uint64, "seqs": np.int64, "starts": np.int32})
        order = np.lexsort((start, seq, name))
        again = order[_same_as_before(name[order])]
        rows += [(slot, False, *blobs) for slot, blobs in _merged(groups, seq[again], start[again], np.zeros(len(again), np.uint8))]
        return pa.Table.from_batches([_batch(rows, _FOUND_ARROW)])

    return run


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _cut(id_type: pa.DataType):
    """Union of the repeated strings of every text of one part, and the bytes that are left."""
    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        seq, start, width = _unpacked(found, {"seqs": np.int64, "starts": np.int32, "widths": np.uint8})
        order = np.argsort(seq, kind="stable")
        seq, start, width = seq[order], start[order], width[order]
        ids, raw = texts.column("seq").to_numpy(), texts.column("bytes")
        low, high = np.searchsorted(seq, ids, "left"), np.searchsorted(seq, ids, "right")
        sizes, spans, kept = [], [], []
        for i in range(len(ids)):
            data = raw[i].as_py() or b""
            sizes.append(len(data))
            if high[i] == low[i]:
                spans.append([])
                kept.append(data)
                continue
            depth = np.zeros(len(data) + 1, np.int64)
            np.add.at(depth, start[low[i]:high[i]], 1)
            np.add.at(depth, start[low[i]:high[i]].astype(np.int64) + width[low[i]:high[i]] + THRESHOLD, -1)
            covered = np.concatenate([[0], (np.cumsum(depth[:-1]) > 0).astype(np.int8), [0]])
            edge = np.diff(covered)
            spans.append([{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
            kept.append(np.frombuffer(data, np.uint8)[covered[1:-1] == 0].tobytes())
        return pa.table({"doc_id": texts.column("doc_id").cast(id_type), "n_bytes": pa.array(sizes, pa.int64()),
                         "spans": pa.array(spans, pa.list_(_SPAN)), "kept": pa.array(kept, pa.binary())})

    return run


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the maximal byte ranges of repeated strings in each row's text, and the bytes left."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.encode(F.coalesce(text_col, F.lit("")), "UTF-8").alias("bytes"))
    state = (rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("bytes")).alias("size"))
             .agg(F.max("n").alias("most"), F.sum("size").alias("size"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first())
    whole = docs.schema[id_col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    if whole and not state.nulls and (state.most or 1) == 1:
        rows = rows.withColumn("seq", F.col("doc_id").cast("long"))
    else:  # number the rows in their order; ranges of a sort keep it over many tasks
        rows = stored(rows.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("bytes"))
                      .withColumn("seq", F.monotonically_increasing_id()), "suffix-rows")
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (state.size or 0) // GROUP_BYTES) | 1
    texts = rows.withColumn("part", F.expr(f"CAST(pmod(seq ^ shiftright(seq, 7), {groups}L) AS INT)"))

    runs = stored(rows.select("seq", "bytes").mapInArrow(_runs(groups), _PACKED).groupBy("slot")
                  .applyInArrow(_compare_runs(groups), _FOUND), "suffix-runs")
    release(spark)
    strings = texts.groupBy("part").cogroup(runs.filter("open").groupBy("part")).applyInArrow(_open_strings(groups), _PACKED)
    more = stored(strings.groupBy("slot").applyInArrow(_compare_strings(groups), _FOUND), "suffix-strings")
    release(spark)
    found = runs.filter("not open").unionByName(more)
    id_type = docs.select(F.col(id_col).alias("doc_id")).limit(0).toArrow().schema.field("doc_id").type
    kind = docs.schema[id_col].dataType.simpleString()
    return texts.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(
        _cut(id_type), f"doc_id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")


def removal_digest(found: DataFrame) -> DataFrame:
    """Counts of removed bytes and spans, and the digest of what is left."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
