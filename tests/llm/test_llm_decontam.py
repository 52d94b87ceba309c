import random
import time

import numpy as np

from conftest import SF_DIR, rows
from forumlens.llm import common, decontam

DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def greedy(p, t, least):
    """The definition: mark the longest common run of unmarked words, again and again."""
    free_p, free_t, tiles = [True] * len(p), [True] * len(t), []
    while True:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and free_p[i + k] and free_t[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return tiles
        k, i, j = best
        free_p[i:i + k], free_t[j:j + k] = [False] * k, [False] * k
        tiles.append(best)


def test_tiles_are_those_of_the_definition():
    rng = random.Random(2)
    for n in range(1200):
        words, least = rng.choice([1, 2, 3, 8]), rng.choice([1, 2, 3, 5])
        p = [rng.randint(0, words) for _ in range(rng.randint(0, 25))]
        t = [rng.randint(0, words) for _ in range(rng.randint(0, 40))]
        assert decontam.tile(np.array(p, np.uint64), np.array(t, np.uint64), least) == greedy(p, t, least), (n, p, t, least)


def test_one_word_without_end_costs_about_its_length():
    p, t = np.full(801, 7, np.uint64), np.full(80_000, 7, np.uint64)
    start = time.perf_counter()
    assert decontam.tile(p, t) == [(801, 0, 0)]
    p[400], t[50_000] = 8, 8
    assert decontam.tile(p, t) == [(801, 0, 49_600)]
    assert time.perf_counter() - start < 5


A = "alpha beta gamma delta epsilon zeta"
B = "one two three four five six seven"
C = "red green blue black white pink grey"


def test_reordered_passages_and_edge_rows(spark):
    items = spark.createDataFrame([(1, f"{A} {B} {C}"), (2, None), (3, ""), (4, "too few words"), (5, f"{A} {B} {C}"),
                                   (None, "x1 x2 x3 x4 x5 x6")], ITEM)
    docs = [(1, f"start {C} middle {A}, and: {B.upper()}!"), (2, f"only {A} of it"), (3, None), (4, ""), (5, "too few words here"),
            (6, f"{A} {B} {C}"), (6, f"{A} {B} {C}"), (None, f"{A} {B} {C}"), (7, "x1 x2 x3 x4 x5 x6 " * 3000)]
    df = spark.createDataFrame(docs, DOC)
    got = rows(decontam.contaminated(df, items).select("doc_id", "item_id", "coverage"))
    assert got == [(None, 1, 1.0), (None, 5, 1.0), (1, 1, 1.0), (1, 5, 1.0), (6, 1, 1.0), (6, 1, 1.0), (6, 5, 1.0), (6, 5, 1.0), (7, None, 1.0)]
    left = decontam.decontaminated(df.selectExpr("*", "text AS _text_key", "1 AS key"), items)
    assert left.columns == ["doc_id", "text", "_text_key", "key"] and [r[0] for r in rows(left)] == [2, 3, 4, 5]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, A)], DOC), spark.createDataFrame([], ITEM)
    assert decontam.contaminated(docs, items).count() == 0 and decontam.decontaminated(docs, items).count() == 1
    assert decontam.contaminated(docs.limit(0), spark.createDataFrame([(1, A)], ITEM)).count() == 0


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    want = []
    texts = [(r.doc_id, common.words(r.text)) for r in docs.collect()]
    for item in items.collect():
        p = common.words(item.text)
        runs = {tuple(p[k:k + 5]) for k in range(len(p) - 4)}
        for d, t in texts:
            near = [k for k in range(len(t) - 4) if tuple(t[k:k + 5]) in runs]
            if near:
                covered = sum(k for k, _, _ in greedy(p, t[near[0]:near[-1] + 5], 5)) / len(p)
                want += [(d, item.item_id)] if covered >= 0.5 else []
    assert rows(decontam.contaminated(docs, items).select("doc_id", "item_id")) == sorted(want)


def test_items_that_repeat_themselves_are_found(spark):
    line = "aa bb cc dd ee ff gg hh ii jj"
    items = [" ".join([line] * 12), " ".join(["one"] * 30), f"{A} {A} {A} {B}"]
    docs = [f"before {items[0]} after", f"so {items[1]} it is", f"{line} and no more", "one " * 12 + "two", f"{A}. {A}", " ".join([line] * 6)]
    want = [(d, i) for d, text in enumerate(docs) for i, item in enumerate(items)
            if sum(k for k, _, _ in greedy(common.words(item), common.words(text), 5)) >= 0.5 * len(common.words(item))]
    assert want == [(0, 0), (1, 1), (5, 0)]
    df, benchmark = spark.createDataFrame(list(enumerate(docs)), DOC), spark.createDataFrame(list(enumerate(items)), ITEM)
    assert rows(decontam.contaminated(df, benchmark).select("doc_id", "item_id")) == want
    assert [r[0] for r in rows(decontam.decontaminated(df, benchmark))] == [2, 3, 4]
