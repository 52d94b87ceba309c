"""Token counts that survive edits.

A text is split into pre-tokens, which the merges of a byte-level BPE vocabulary never
cross; its token count is the sum of theirs. Each document keeps a segment tree: leaves are
runs of about ``LEAF`` pre-tokens with their numbers of code points and tokens, inner nodes
the sums. ``counted`` encodes texts once and gives the leaves as columns, to be stored beside
the text; ``edited`` takes stored trees and edits and gives the trees afterwards, so a
document is encoded in full once in its life. Inner nodes are sums of leaves and are not stored. An edit is located by descending the tree. Encoding starts again at the first leaf
that the edit, with two code points of context before it, can have changed, and stops where a
pre-token boundary meets the boundary of an untouched leaf; from there on everything is as
before, since no pre-token depends on what stands before its start. Sums are renewed on
the paths of the changed leaves only.

Edits of a document apply in order, each to the text as the edits before it left it:
replace ``size`` code points at ``start`` by ``text``.

Defined results: a NULL text counts as empty and has 0 tokens; edits beyond the end act at
the end; NULL parts of an edit count as 0 or empty; repeated rows are counted separately.
Leaves that do not fit their text (their code points do not add up to its length) are built anew. Extra
columns stay; columns named like results are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's tokenizer splits text before merging (fixed value).
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 64
EDITS = "array<struct<start:bigint,size:bigint,text:string>>"


class Counter(dict):
    """Tokens of a pre-token by the given ranks (lines of a vocabulary file); forgotten when it holds 100,000 pre-tokens."""

    def __init__(self, vocabulary: bytes):
        super().__init__()
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("counter", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(PRE_TOKENS).findall

    def __missing__(self, piece: str) -> int:
        if len(self) >= 100_000:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n


_LOADED: dict[int, Counter] = {}


def loaded(vocabulary) -> Counter:
    """The counter of a broadcast vocabulary file; a worker builds it once."""
    key = hash(vocabulary.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Counter(vocabulary.value)
    return _LOADED[key]


class Tree:
    """Segment tree over the leaves of one text: node 1 is the root, leaf i is node ``width + i``."""

    def __init__(self, text: str, counter: Counter, leaves: tuple[np.ndarray, np.ndarray] | None = None):
        self.text, self.counter, self.encoded = text, counter, 0
        if leaves is None or len(leaves[0]) != len(leaves[1]) or leaves[0].sum() != len(text):
            leaves = self._leaves(text)
        self._build(*leaves)

    def stored_leaves(self) -> tuple[list[int], list[int]]:
        """Code points and tokens of the leaves that are not empty."""
        own = self.sums[self.width:self.width + self.leaves]
        own = own[own[:, 0] > 0]
        return own[:, 0].tolist(), own[:, 1].tolist()

    def _leaves(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        pieces = self.counter.split(text)
        cuts = np.arange(0, len(pieces), LEAF)
        if not len(cuts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
        tokens = np.fromiter(map(self.counter.__getitem__, pieces), np.int64, len(pieces))
        self.encoded += len(text)
        return np.add.reduceat(chars, cuts), np.add.reduceat(tokens, cuts)

    def _build(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves = len(chars)
        self.width = 1 << max(0, int(self.leaves - 1).bit_length()) if self.leaves else 1
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width:self.width + self.leaves] = np.stack([chars, tokens], 1) if self.leaves else 0
        level = self.width
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level:2 * level:2] + self.sums[level + 1:2 * level:2]
            level = half

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, place of its first code point) of the leaf that holds ``place``."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if place >= before + self.sums[node, 0]:
                before += int(self.sums[node, 0])
                node += 1
        return min(node - self.width, max(0, self.leaves - 1)), before

    def edit(self, start: int, size: int, text: str) -> None:
        length = len(self.text)
        start = min(max(start, 0), length)
        size = min(max(size, 0), length - start)
        new = self.text[:start] + text + self.text[start + size:]
        if not self.leaves:
            self.text = new
            self._build(*self._leaves(new))
            return
        first, restart = self.leaf_at(max(0, min(start - 2, length - 1)))
        delta = len(text) - size
        # extend the re-encoded region leaf by leaf until a boundary of its pre-tokens meets an old one
        last, old_end = first, restart + int(self.sums[self.width + first, 0])
        while old_end < start + size and last + 1 < self.leaves:
            last += 1
            old_end += int(self.sums[self.width + last, 0])
        while True:
            # the pattern looks two code points ahead: the region is split with the text after it in view
            view = new[restart:old_end + delta + 2]
            goal, at, pieces = old_end + delta - restart, 0, []
            for piece in self.counter.split(view):
                if at >= goal:
                    break
                pieces.append(piece)
                at += len(piece)
            if at == goal or last + 1 >= self.leaves:
                break
            last += 1
            old_end += int(self.sums[self.width + last, 0])
        if last + 1 >= self.leaves:
            pieces = self.counter.split(new[restart:])
        self.encoded += sum(map(len, pieces))
        self.text = new
        self._replace(first, last + 1, pieces)

    def _replace(self, first: int, after: int, pieces: list[str]) -> None:
        """Spread pre-tokens over the leaves [first, after); only a region that outgrew them rebuilds the tree."""
        slots = after - first
        chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
        tokens = np.fromiter(map(self.counter.__getitem__, pieces), np.int64, len(pieces))
        if len(pieces) <= 4 * LEAF * slots:
            each = max(1, -(-len(pieces) // slots))
            for i in range(slots):
                own = slice(i * each, (i + 1) * each)
                self.sums[self.width + first + i] = chars[own].sum(), tokens[own].sum()
            low, high = (self.width + first) // 2, (self.width + after - 1) // 2
            while low:
                self.sums[low:high + 1] = self.sums[2 * low:2 * high + 2:2] + self.sums[2 * low + 1:2 * high + 3:2]
                low, high = low // 2, high // 2
            return
        cuts = np.arange(0, len(pieces), LEAF)
        old = self.sums[self.width:self.width + self.leaves]
        new = np.stack([np.add.reduceat(chars, cuts), np.add.reduceat(tokens, cuts)], 1)
        both = np.concatenate([old[:first], new, old[after:]])
        self._build(both[:, 0], both[:, 1])


TREE = {"leaf_chars": T.ArrayType(T.LongType()), "leaf_tokens": T.ArrayType(T.LongType()), "n_tokens": T.LongType()}
EDITED = {**TREE, "n_tokens_before": T.LongType(), "n_chars_reencoded": T.LongType()}


def _rows(batch: pa.RecordBatch, names: list[str], added: dict[str, list], kinds: dict) -> pa.RecordBatch:
    arrow = {T.LongType(): pa.int64(), T.StringType(): pa.string()}
    new = {c: pa.array(v, arrow.get(kinds[c], pa.list_(pa.int64()))) for c, v in added.items()}
    return pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], names=names)


def _build_trees(vocabulary, text_col: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(vocabulary)
        for batch in batches:
            out: dict[str, list] = {c: [] for c in TREE}
            for text in batch.column(text_col).to_pylist():
                tree = Tree(text or "", counter)
                for c, v in zip(TREE, (*tree.stored_leaves(), tree.tokens)):
                    out[c].append(v)
            yield _rows(batch, names, out, TREE)

    return run


def _edit_trees(vocabulary, text_col: str, edits_col: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(vocabulary)
        kinds = {text_col: T.StringType(), **EDITED}
        for batch in batches:
            out: dict[str, list] = {c: [] for c in kinds}
            columns = [batch.column(c).to_pylist() for c in (text_col, "leaf_chars", "leaf_tokens", edits_col)]
            for text, chars, tokens, edits in zip(*columns):
                tree = Tree(text or "", counter, (np.array(chars or [], np.int64), np.array(tokens or [], np.int64)))
                before = tree.tokens
                for e in edits or ():
                    tree.edit(e["start"] or 0, e["size"] or 0, e["text"] or "")
                for c, v in zip(kinds, (tree.text, *tree.stored_leaves(), tree.tokens, before, tree.encoded)):
                    out[c].append(v)
            yield _rows(batch, names, out, kinds)

    return run


def _vocabulary(spark: SparkSession, path: str):
    """The file as a broadcast: only the driver has to have it."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _schema(df: DataFrame, added: dict) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(c, t) for c, t in added.items())])


def counted(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with the leaves of every text's tree and its tokens; store it, and edit from there."""
    small_batches(docs.sparkSession)
    docs = docs.drop(*EDITED)
    schema = _schema(docs, TREE)
    return docs.mapInArrow(_build_trees(_vocabulary(docs.sparkSession, vocabulary), text_col, schema.names), schema)


def edited(trees: DataFrame, text_col: str = "text", edits_col: str = "edits", vocabulary: str = VOCABULARY) -> DataFrame:
    """Trees of ``counted`` after the edits in ``edits_col``: new texts, leaves and tokens, without the edits.

    ``n_tokens_before`` are the tokens before the edits, ``n_chars_reencoded`` the code
    points that were encoded for them.
    """
    small_batches(trees.sparkSession)
    trees = trees.withColumn(edits_col, F.col(edits_col).cast(EDITS)).drop("n_tokens", "n_tokens_before", "n_chars_reencoded")
    out = _schema(trees.drop(edits_col, "leaf_chars", "leaf_tokens"), EDITED)
    return trees.mapInArrow(_edit_trees(_vocabulary(trees.sparkSession, vocabulary), text_col, edits_col, out.names), out)


def with_edits(docs: DataFrame, log: DataFrame, id_col: str = "doc_id", edits_as: str = "edits") -> DataFrame:
    """``docs`` with the edits of an edit log (doc_id, edit_no, start, size, text) gathered per document, in order.

    A column of ``docs`` named ``edits_as`` is replaced.
    """
    docs = docs.drop(edits_as)
    (ident,) = fresh(docs, "_edited_id")
    gathered = (log.groupBy(F.col(id_col).alias(ident)).agg(F.array_sort(F.collect_list(F.struct("edit_no", "start", "size", "text"))).alias(edits_as))
                .withColumn(edits_as, F.transform(edits_as, lambda e: F.struct(e["start"], e["size"], e["text"]))))
    return docs.join(gathered, docs[id_col] == gathered[ident], "left").drop(ident)
