import hashlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from forumlens.llm import tokencount
from forumlens.llm.common import stored
from forumlens.llm.queries import QUERIES


def fresh_counter():
    with open(tokencount.VOCABULARY, "rb") as f:
        return tokencount.Counter(f.read())


def test_trees_follow_random_edits(monkeypatch):
    monkeypatch.setattr(tokencount, "LEAF", 4)
    rng = random.Random(6)
    counter = fresh_counter()
    full = lambda text: len(counter.encoding.encode_ordinary(text))
    parts = ["a", " b", "  ", "\n", "\n\n ", "don't", "'ll", "12", " 345", "!?", "é", "\U0001F600", " word", "\t", " the quick", "s", "'"]
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        tree = tokencount.Tree(text, counter)
        for _ in range(rng.randint(1, 12)):
            start, size = rng.randint(0, len(text) + 3), rng.choice([0, 0, 1, 2, 5, 30])
            new = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 1, 2, 40])))
            tree.edit(start, size, new)
            text = text[:start] + new + text[start + size:]
            assert tree.text == text and tree.tokens == full(text)
            assert tree.sums[1, 0] == len(text)


def test_small_edits_touch_little():
    counter = fresh_counter()
    tree = tokencount.Tree("some words and more words " * 4000, counter)
    before = tree.encoded
    for place in (10, 50_000, 99_000):
        tree.edit(place, 3, "new")
    assert tree.encoded - before < 5000


@pytest.mark.parametrize("folder", [SF_DIR, "/root/testdata/sf0.01"])
def test_query_equals_full_counts_before_and_after(spark, folder):
    counter = fresh_counter()
    full = lambda text: len(counter.encoding.encode_ordinary(text))
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    hashes = docs.select("doc_id", "text", *[F.xxhash64("doc_id", F.lit(k)).alias(f"h{k}") for k in range(1, 5)])
    want = {}
    for r in hashes.collect():
        n, text = len(r.text), r.text
        for start, size, new in ((r.h1 % (n + 1), r.h2 % 40, ""), (r.h3 % (n + 1), 0, r.text[:25]), (r.h4 % (n + 1), 12, f" [edit {r.doc_id}] ")):
            start = min(start, len(text))
            text = text[:start] + new + text[start + size:]
        want[r.doc_id] = (full(r.text), full(text), len(text), hashlib.sha256(text.encode()).hexdigest())
    got = QUERIES["op10_edit_aware_tokens"](spark, folder).collect()
    assert {r.doc_id: (r.n_tokens, r.n_tokens_edited, r.n_chars_edited, r.text_sha256) for r in got} == want
    # of long texts little is encoded again
    long = [r for r in got if r.n_chars > 5000]
    assert long and sum(r.n_chars_reencoded for r in long) < 0.4 * sum(r.n_chars for r in long)


def test_stored_trees_go_through_many_rounds_without_a_full_encoding(spark):
    counter = fresh_counter()
    docs = spark.createDataFrame([(1, "some words and more words " * 2000), (2, "short")], "doc_id long, text string").withColumn("leaf_chars", F.lit("old"))
    trees = stored(tokencount.counted(docs), "test-trees")
    for k in range(3):
        trees = stored(tokencount.edited(trees.withColumn("edits", F.expr(f"array(named_struct('start', {7000 * k}L, 'size', 3L, 'text', 'new part'))"))), "test-trees")
        for r in trees.collect():
            assert r.n_tokens == len(counter.encoding.encode_ordinary(r.text)) == sum(r.leaf_tokens) and len(r.text) == sum(r.leaf_chars)
            assert r.n_chars_reencoded < 3000
    wrong = trees.withColumn("text", F.lit("other text"))
    assert [r.n_tokens for r in tokencount.edited(wrong.withColumn("edits", F.lit(None))).collect()] == [2, 2]


def test_edit_logs_and_edge_rows(spark):
    docs = spark.createDataFrame([(1, "Hello world, hello"), (2, None), (3, ""), (None, "abc"), (4, "same"), (4, "same"), (5, "word " * 40_000)],
                                 "doc_id long, text string")
    log = spark.createDataFrame([(1, 2, 0, 5, "Bye"), (1, 1, 5, 6, ""), (2, 1, 0, 0, "new text"), (3, 1, 7, 9, None), (4, 1, None, None, "x"),
                                 (5, 1, 100_000, 4, "sword"), (9, 1, 0, 0, "nobody")], "doc_id long, edit_no long, start long, size long, text string")
    recounted = lambda d: tokencount.edited(tokencount.with_edits(stored(tokencount.counted(d), "test-trees"), log))
    got = rows(recounted(docs.withColumn("edits", F.lit("old"))).select("doc_id", "text", "n_tokens_before", "n_tokens"))
    counter = fresh_counter()
    full = lambda text: len(counter.encoding.encode_ordinary(text))
    assert [r[:2] for r in got[:6]] == [(None, "abc"), (1, "Bye, hello"), (2, "new text"), (3, ""), (4, "xsame"), (4, "xsame")]
    assert all(r[3] == full(r[1]) for r in got) and got[6][2] == full("word " * 40_000)
    assert recounted(docs.limit(0)).count() == 0
