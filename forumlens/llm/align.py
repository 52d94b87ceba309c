"""Alignment of two tokenizers' tokens by diagonal run skipping.

Both tokenizers encode the same bytes, so the byte offsets at which their tokens end are two
rising arrays. Where both have an offset, the text is cut: the tokens between two cuts are a
group. Most groups are one token of each, and such groups come in runs, along which the two
arrays stay equal at a fixed shift of their indexes. A run is skipped by exponential probing:
blocks of 1, 2, 4, ... ends are compared at the present shift, and the block that differs is
narrowed down by halves to the end of the run. What follows is an irregular group, resolved
by stepping the array that is behind until both meet; then the shift is renewed.

The last tokens of a group end together: one link. Of two tokens that end together the
shorter is a suffix of the longer, so the pairs that can ever be linked are bounded by the
vocabularies alone (``Vocabularies.most_pairs``, some hundred thousand), however large the
corpus. Their counts are therefore added up per task before the shuffle and broadcast.

A is a byte-level vocabulary of the tokenizers library, B a model of sentencepiece; both come
to the tasks as a broadcast of their files, which only the driver has to have. Where A's ids
stand in the order of its merges and a text has Latin letters only, tiktoken applies the same
merges from the same file.

Defined results: a NULL or empty text, and one whose tokens of either side do not join to
space + text, has no tokens and no groups. Special tokens' strings are ordinary text. Repeated rows are
aligned, and counted, one by one. Extra columns stay; columns named like results are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import small_batches, stored, text_blocks

A_FILE, B_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
TOKENS = ("a_ids", "b_ids", "a_sizes", "b_sizes")
#: Links a task holds before it adds them up, and rows it unpacks at once.
_HELD, _ROWS = 1 << 20, 256
_NONE = np.zeros(0, np.int32)
_LOADED: dict = {}
#: How a byte-level vocabulary of this kind splits text before merging (fixed value).
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Finds what is neither ASCII nor a sign or letter of the Latin blocks: elsewhere the two libraries might follow different
#: versions of Unicode, so such texts go to A's own library.
_OLD_LETTERS_ONLY = re.compile("[^\t\n\r\x20-\x7e\u00a1-\u024f]")


def _bytes_of_letters() -> dict[str, int]:
    """Letter by which a byte-level vocabulary writes each byte: itself where it is printable, else one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _follows_its_ids(a: bytes) -> dict[bytes, int] | None:
    """Bytes of the tokens by id, if A's merges stand in the order of the ids they make; else None.

    Then merging by pairs and merging by the id of the result are the same, and tiktoken,
    which does the latter, reads the vocabulary several times faster.
    """
    model = json.loads(a)["model"]
    ids, letters = model["vocab"], _bytes_of_letters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(ids.get(x + y) != 256 + k for k, (x, y) in enumerate(pairs)) or any(ids.get(c, 256) > 255 for c in letters):
        return None
    return {bytes(letters[c] for c in t): i for t, i in ids.items() if i < 256 + len(pairs)}


class Vocabularies:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, a: bytes, b: bytes):
        self._a, self._whole_a = a, None
        ranks = _follows_its_ids(a)
        self.fast = ranks and tiktoken.Encoding("a", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        letters = _bytes_of_letters()
        described = json.loads(a)
        names = {i: t for t, i in described["model"]["vocab"].items()} | {t["id"]: t["content"] for t in described.get("added_tokens", ())}
        self.a_bytes = [bytes(letters[c] for c in t) if t and all(c in letters for c in t) else t.encode()
                        for t in (names.get(i, "") for i in range(max(names) + 1))]
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        # "id," and "id|" of A and "id," and "id;" of B, filled up with zero bytes, for the written form of groups
        self.written = np.array([f"{i}{end}" for size, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for end in ends
                                 for i in range(size)], "S")

    def kinds(self) -> list[str]:
        """Number formats of the packed ids of A and B and of both sides' group sizes."""
        return ["<u2" if len(v) <= 1 << 16 else "<u4" for v in (self.a_bytes, self.b_bytes)] + ["<u4", "<u4"]

    @property
    def a(self) -> Tokenizer:
        """A by its own library, built when a text needs it."""
        if self._whole_a is None:
            self._whole_a = Tokenizer.from_str(self._a.decode())
            self._whole_a.encode_special_tokens = True
            self._whole_a.no_truncation()
            self._whole_a.no_padding()
        return self._whole_a

    def a_ids(self, text: str) -> list[int] | None:
        """Ids of A for space + text; None if they do not give it back, which bytes merged by rank always do."""
        if self.fast and not _OLD_LETTERS_ONLY.search(text):
            return self.fast.encode_ordinary(" " + text)
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        return ids if b"".join(map(self.a_bytes.__getitem__, ids)) == (" " + text).encode() else None

    def most_pairs(self) -> int:
        """Bound on the pairs of ids that can end together: each token with the suffixes of it that the other side has."""
        def suffixes(tokens, others):
            known: dict[bytes, int] = {}
            for o in others:
                known[o] = known.get(o, 0) + 1
            return sum(known.get(t[k:], 0) for t in tokens for k in range(len(t)))

        return suffixes(self.a_bytes, self.b_bytes) + suffixes(self.b_bytes, self.a_bytes)

    def encoded(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B, none where either does not give back space + text."""
        if text:
            a, b = self.a_ids(text), self.b.encode(text)
            if a is not None and b"".join(map(self.b_bytes.__getitem__, b)) == (" " + text).encode():
                return np.array(a, np.int32), np.array(b, np.int32)
        return _NONE, _NONE


def loaded(files) -> Vocabularies:
    """Vocabularies of a broadcast (A's file, B's file); a worker builds them once."""
    a, b = files.value
    key = hashlib.sha256(a + b).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabularies(a, b)
    return _LOADED[key]


def diagonal_groups(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Sizes, in tokens of each side, of the groups between common ends; both arrays rise and end at the same offset."""
    a_sizes: list[int] = []
    b_sizes: list[int] = []
    i = j = 0
    n, m = len(a), len(b)
    while i < n:
        if a[i] == b[j]:
            run, step = 1, 1
            while i + run < n and a[i + run:i + run + step] == b[j + run:j + run + step]:
                run += step
                step *= 2
            while step > 1:
                step >>= 1
                if a[i + run:i + run + step] == b[j + run:j + run + step]:
                    run += step
            run = min(run, n - i, m - j)
            a_sizes += (ones := [1] * run)
            b_sizes += ones
            i += run
            j += run
            continue
        first_a, first_b = i, j
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        j += 1
        a_sizes.append(i - first_a)
        b_sizes.append(j - first_b)
    return a_sizes, b_sizes


# ---- over Spark


def _ints(rows: list) -> pa.Array:
    sizes = np.fromiter(map(len, rows), np.int32, len(rows))
    flat = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else _NONE
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(flat))


def _packed(rows: list, kind: str) -> pa.Array:
    return pa.array([np.asarray(r, kind).tobytes() for r in rows], pa.binary())


def _align(files, text_at: int, names: list[str], packed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = loaded(files)
        for batch in batches:
            texts = batch.column(text_at)
            for low, high in text_blocks(texts.to_pylist(), 1 << 18):
                out: list[list] = [[], [], [], []]
                for text in texts.slice(low, high - low).to_pylist():
                    a, b = v.encoded(text)
                    groups = diagonal_groups(np.cumsum(v.a_sizes[a]).tolist(), np.cumsum(v.b_sizes[b]).tolist()) if len(a) else ([], [])
                    for column, value in zip(out, (a, b, *groups)):
                        column.append(value)
                done = list(map(_packed, out, v.kinds())) if packed else list(map(_ints, out))
                yield pa.RecordBatch.from_arrays([*(c.slice(low, high - low) for c in batch.columns), *done], names=names)

    return run


def shared_files(spark: SparkSession, a_file: str = A_FILE, b_file: str = B_FILE):
    """Both vocabulary files as a broadcast."""
    files = []
    for path in (a_file, b_file):
        with open(path, "rb") as f:
            files.append(f.read())
    return spark.sparkContext.broadcast(tuple(files))


def aligned(docs: DataFrame, files, text_col: str = "text", packed: bool = False) -> DataFrame:
    """``docs`` with the ids of both sides and the sizes of the groups they are cut into.

    Arrays of int, or, ``packed``, the same numbers as bytes: half the size on disk, and the
    JVM passes them on as they are.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(*TOKENS)
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, kind) for c in TOKENS)])
    return docs.mapInArrow(_align(files, docs.columns.index(text_col), schema.names, packed), schema)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, _ROWS):
            yield batch.slice(a, _ROWS)


class _Batch:
    """The four arrays of a batch, flat, with the index of the first token and group of every row."""

    def __init__(self, batch: pa.RecordBatch, v: Vocabularies):
        columns = [batch.column(c) for c in TOKENS]
        if pa.types.is_binary(columns[0].type):
            self.flat = [np.frombuffer(b"".join(c.to_pylist()), k).astype(np.int32) for c, k in zip(columns, v.kinds())]
            sizes = [pc.binary_length(c).to_numpy(zero_copy_only=False) // np.dtype(k).itemsize for c, k in zip(columns, v.kinds())]
        else:
            self.flat = [c.flatten().to_numpy(zero_copy_only=False) for c in columns]
            sizes = [c.value_lengths().to_numpy(zero_copy_only=False) for c in columns]
        self.starts = [np.concatenate([[0], np.cumsum(n)]) for n in sizes]
        self.a, self.b, self.a_sizes, self.b_sizes = self.flat
        self.a_ends, self.b_ends = np.cumsum(self.a_sizes), np.cumsum(self.b_sizes)

    def links(self) -> np.ndarray:
        """One number per link: A's id above B's."""
        return self.a[self.a_ends - 1].astype(np.int64) << 32 | self.b[self.b_ends - 1]


def _count(files):
    """Counts of the links of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = loaded(files)
        pairs, counts, waiting, held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def add() -> tuple[np.ndarray, np.ndarray]:
            seen = pc.value_counts(pa.array(np.concatenate([np.empty(0, np.int64), *waiting])))
            new, n = seen.field(0).to_numpy(), seen.field(1).to_numpy()
            both, at = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            return both, np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)

        for batch in _parts(batches):
            waiting.append(_Batch(batch, v).links())
            held += len(waiting[-1])
            if held >= _HELD:
                pairs, counts = add()
                waiting, held = [], 0
        pairs, counts = add()
        yield pa.RecordBatch.from_arrays([pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(counts)],
                                         names=["a_id", "b_id", "n"])

    return run


def link_counts(rows: DataFrame, files) -> DataFrame:
    """(a_id, b_id, n): links of every pair of ids over all rows of ``aligned``."""
    return (rows.select(*TOKENS).mapInArrow(_count(files), "a_id int, b_id int, n bigint")
            .groupBy("a_id", "b_id").agg(F.sum("n").alias("n")))


@dataclass
class LinkTable:
    """Counts of the linked pairs, sorted by pair, and whether each is the highest of its B id."""

    pairs: np.ndarray
    counts: np.ndarray
    best: np.ndarray


def link_table(counts: DataFrame, most: int) -> LinkTable:
    """Counts on the driver, as the broadcast needs them; ``most`` is the bound that the vocabularies set."""
    table = counts.select("a_id", "b_id", "n").limit(most + 1).toArrow()
    if table.num_rows > most:
        raise ValueError(f"more than {most} pairs of ids: the rows were not aligned with these vocabularies")
    a, b, n = (table.column(c).to_numpy() for c in ("a_id", "b_id", "n"))
    pairs = a.astype(np.int64) << 32 | b
    order = np.argsort(pairs)
    highest = np.zeros(int(b.max()) + 1 if len(b) else 0, np.int64)
    np.maximum.at(highest, b, n)
    return LinkTable(pairs[order], n[order], (n == highest[b])[order])


def written_groups(v: Vocabularies, t: _Batch, row: int) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of the groups of one row."""
    (a0, b0, g0), (a1, b1, g1) = ((t.starts[0][k], t.starts[1][k], t.starts[2][k]) for k in (row, row + 1))
    if a0 == a1:
        return b""
    a, b, a_sizes, b_sizes = t.a[a0:a1], t.b[b0:b1], t.a_sizes[g0:g1], t.b_sizes[g0:g1]
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[a_ends - 1] = last_b[b_ends - 1] = True
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.repeat(b_ends - b_sizes, a_sizes)] = a + len(v.a_bytes) * last_a
    order[np.arange(len(b)) + np.repeat(a_ends, b_sizes)] = b + 2 * len(v.a_bytes) + len(v.b_bytes) * last_b
    return v.written[order].tobytes().replace(b"\0", b"")[:-1]


def _digest(files, table, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, counts = loaded(files), table.value
        pairs = pa.array(counts.pairs)
        for batch in _parts(batches):
            t = _Batch(batch, v)
            at = pc.index_in(pa.array(t.links()), pairs).to_numpy(zero_copy_only=False)
            per_row = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[t.starts[2]])
            n_a, n_b, n_groups = (np.diff(t.starts[k]) for k in range(3))
            hashes = [hashlib.sha256(s).hexdigest() if (s := written_groups(v, t, i)) else "" for i in range(batch.num_rows)]
            columns = [n_a, n_b, n_groups, n_groups, per_row(counts.best[at]), per_row(counts.counts[at])]
            rest = [batch.column(c) for c in batch.schema.names if c not in TOKENS]
            yield pa.RecordBatch.from_arrays([*rest, *(pa.array(c.astype(np.int64)) for c in columns), pa.array(hashes, pa.string())], names=names)

    return run


def alignment_digest(rows: DataFrame, files, counts: DataFrame) -> DataFrame:
    """Per row of ``aligned``: numbers of tokens, groups and links, how its links stand in the corpus, and the hash of its groups."""
    spark = rows.sparkSession
    v = Vocabularies(*files.value)
    table = spark.sparkContext.broadcast(link_table(counts, v.most_pairs()))
    added = {"n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(), "n_best": T.LongType(),
             "count_sum": T.LongType(), "groups_sha256": T.StringType()}
    kept = [f for f in rows.schema.fields if f.name not in added and f.name not in TOKENS]
    schema = T.StructType([*kept, *(T.StructField(k, t) for k, t in added.items())])
    return rows.select(*[f.name for f in kept], *TOKENS).mapInArrow(_digest(files, table, schema.names), schema)


def aligned_corpus(docs: DataFrame, text_col: str = "text", a_file: str = A_FILE, b_file: str = B_FILE):
    """Aligned rows without their texts, stored, and the vocabularies they were aligned with."""
    files = shared_files(docs.sparkSession, a_file, b_file)
    return stored(aligned(docs, files, text_col, packed=True).drop(text_col), "aligned"), files
