import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import rows
from forumlens.llm import align
from forumlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RESULTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """Tokens and groups straight from the definition."""

    def __init__(self):
        self.a = Tokenizer.from_file(align.A_FILE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=align.B_FILE)
        raw = {}
        spare = 256
        for byte in range(256):
            if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
                raw[chr(byte)] = byte
            else:
                raw[chr(spare)] = byte
                spare += 1
        self.raw = raw

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.raw[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    def groups(self, text):
        a, b = self.tokens(text)
        ends_a, ends_b = np.cumsum([len(x) for _, x in a]), np.cumsum([len(x) for _, x in b])
        cuts = sorted(set(ends_a) & set(ends_b))
        out = [([], []) for _ in cuts]
        for side, tokens, ends in ((0, a, ends_a), (1, b, ends_b)):
            for (i, _), e in zip(tokens, ends):
                out[bisect_left(cuts, e)][side].append(i)
        return out


def expected(data):
    """Results per row of (doc_id, text) from the definition."""
    plain, count = Plain(), Counter()
    groups = [plain.groups(text) for _, text in data]
    for g in groups:
        count.update((a[-1], b[-1]) for a, b in g)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (doc_id, _), g in zip(data, groups):
        links = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                    sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def test_query_equals_the_definition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    data = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: tuple(r)[:1] + tuple(r[c] for c in RESULTS) for r in QUERIES["op11_diagonal_alignment"](spark, SF).collect()}
    assert len(got) == len(data)
    assert got == {r[0]: r for r in expected(data)}


def test_edge_texts(spark):
    data = [(1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "a<|endoftext|>b </s> <unk> <0x41>"), (6, "▁odd"), (7, "tab\tline\n\né\U0001F600\u0000x"),
            (8, "word " * 30_000), (8, "word " * 3), (8, "word " * 3), (None, "x"), (9, "ﬁ Å"), (10, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa")]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("n_a", F.lit("old")).withColumn("a_sizes", F.lit(1)).withColumn("extra", F.lit(7))
    done, files = align.aligned_corpus(docs)
    out = align.alignment_digest(done, files, align.link_counts(done, files))
    assert out.columns == ["doc_id", "extra", *RESULTS]
    short = [(i, t) for i, t in data if not t or len(t) < 1000]
    got = [r for r in rows(out.drop("extra")) if r[1] < 1000]
    # counts go over all rows: the long text adds links of its own, so it is compared without them here
    keep = lambda r: (*r[:5], r[7])
    assert [keep(r) for r in got] == [keep(r) for r in expected(short)]
    empty = docs.limit(0)
    done, files = align.aligned_corpus(empty)
    assert align.alignment_digest(done, files, align.link_counts(done, files)).count() == 0


def test_counts_with_ties_and_repeats(spark):
    data = [(1, "alpha beta gamma"), (1, "alpha beta gamma"), (2, "Gamma gamma unbelievable"), (3, "unbelievable tokenization"), (4, None)]
    done, files = align.aligned_corpus(spark.createDataFrame(data, "doc_id long, text string"))
    assert rows(align.alignment_digest(done, files, align.link_counts(done, files))) == expected(data)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=40, unique=True), st.lists(st.integers(1, 60), max_size=40, unique=True))
def test_groups_of_any_two_arrays(a, b):
    a, b = sorted({*a, 61}), sorted({*b, 61})
    a_sizes, b_sizes = align.diagonal_groups(a, b)
    cuts = sorted(set(a) & set(b))
    assert [a[i - 1] for i in np.cumsum(a_sizes)] == cuts == [b[i - 1] for i in np.cumsum(b_sizes)]
    assert sum(a_sizes) == len(a) and sum(b_sizes) == len(b)


_V = []


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" \t\n\r'sdtmlvre 0123ÀÿĀɏ¼²ªº\xa0\x85\x1c\u3000α")), max_size=60))
def test_both_libraries_give_the_same_ids(text):
    if not _V:
        with open(align.A_FILE, "rb") as a, open(align.B_FILE, "rb") as b:
            _V.append(align.Vocabularies(a.read(), b.read()))
    v = _V[0]
    assert v.fast and v.a_ids(text) == v.a.encode(" " + text, add_special_tokens=False).ids


def test_long_equal_stretches():
    a = list(range(1, 10_001))
    b = [v for v in a if v % 1000 or v == 10_000]
    a_sizes, b_sizes = align.diagonal_groups(a, b)
    assert a_sizes.count(2) == 9 and set(b_sizes) == {1} and sum(a_sizes) == len(a)


def test_arrays_and_packed_numbers_are_the_same(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, None), (3, "Gamma unbelievable tokenization")], "doc_id long, text string")
    files = align.shared_files(spark)
    plain = align.aligned(docs, files).drop("text")
    first = plain.filter("doc_id = 1").first()
    assert sum(first.a_sizes) == len(first.a_ids) and sum(first.b_sizes) == len(first.b_ids) and len(first.a_sizes) == len(first.b_sizes)
    packed, _ = align.aligned_corpus(docs)
    counts = align.link_counts(plain, files)
    assert rows(counts) == rows(align.link_counts(packed, files))
    assert rows(align.alignment_digest(plain, files, counts)) == rows(align.alignment_digest(packed, files, counts))


def test_pairs_are_bounded_by_the_vocabularies(spark):
    v = align.Vocabularies(*align.shared_files(spark).value)
    assert v.most_pairs() < 1_000_000
    done, files = align.aligned_corpus(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    for r in align.link_counts(done, files).collect():
        a, b = v.a_bytes[r.a_id], v.b_bytes[r.b_id]
        assert a.endswith(b) or b.endswith(a)
