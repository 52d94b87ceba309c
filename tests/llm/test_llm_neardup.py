import random
from collections import Counter, defaultdict

import numpy as np

from conftest import SF_DIR, rows
from forumlens.llm import common, neardup

KIND = "doc_id long, text string"


def sets_of(texts):
    out = []
    for text in texts:
        w = common.words(text)
        out.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else None)
    return out


def brute(data, least=0.8):
    """Class by row: links of exact similarity, then components; equal texts without words are linked too."""
    shingles = sets_of(t for _, t in data)
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = defaultdict(list)
    for i, s in enumerate(shingles):
        if s is None:
            if data[i][1] and data[i][1].strip():
                where[data[i][1]].append(i)
            continue
        near = Counter(j for x in s for j in where[x])
        for x in s:
            where[x].append(i)
        for j, n in near.items():
            if n / (len(s) + len(shingles[j]) - n) >= least:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    for group in [v for k, v in where.items() if isinstance(k, str)]:
        for i in group:
            parent[find(i)] = find(group[0])
    ids = defaultdict(list)
    for i, (d, _) in enumerate(data):
        ids[find(i)].append(d)
    return [(d, min((x for x in ids[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(data)]


def key(r):
    return tuple((v is not None, v) for v in r)


def test_classes_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    assert rows(neardup.near_duplicates(docs)) == sorted(brute([tuple(r) for r in docs.collect()]), key=key)


def drifting(n, seed):
    """Copies of one text that drift apart: similarities on both sides of the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(90)]
    out = []
    for i in range(n):
        words = list(out[rng.randrange(len(out))].split()) if out and rng.random() < 0.7 else list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 10 ** 6)}"
        out.append(" ".join(words))
    return [(i, t) for i, t in enumerate(out)]


def test_a_large_family_loses_no_link(spark):
    data = drifting(250, 3)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(data, KIND).repartition(3)).collect()}
    assert got == dict(brute(data))


EDGE = [(1, None), (2, ""), (3, "  "), (4, "one two"), (5, "one two"), (6, "!!!"), (7, "!!!"), (8, "???"), (None, "one two"),
        (9, "a b c d e f g"), (9, "a b c d e f g"), (None, "q w e r t y"), (None, "q w e r t y"), (10, "long " * 50_000)]


def test_edge_rows(spark):
    docs = spark.createDataFrame(EDGE, KIND)
    assert rows(neardup.near_duplicates(docs)) == sorted(brute(EDGE), key=key)
    kept = neardup.deduplicated(docs.selectExpr("*", "doc_id AS node", "text AS _node"))
    assert kept.columns == ["doc_id", "text", "node", "_node"]
    assert [r[:2] for r in rows(kept)] == sorted(
        [(1, None), (2, ""), (3, "  "), (4, "one two"), (6, "!!!"), (8, "???"), (9, "a b c d e f g"), (None, "q w e r t y"),
         (10, "long " * 50_000)], key=key)


def test_empty_table(spark):
    docs = spark.createDataFrame([], KIND)
    assert neardup.near_duplicates(docs).count() == 0 and neardup.deduplicated(docs).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    item = np.arange(1, 301, dtype=np.uint64) * np.uint64(7919)
    a = rng.integers(1, 9, 300).astype(float)
    b = np.where(rng.random(300) < 0.7, a, rng.integers(1, 9, 300)).astype(float)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    sig = neardup.dart_signatures(np.repeat([0, 1], 300), np.concatenate([item, item]), np.concatenate([a, b]), 2, 2000)
    assert (sig != 0).all() and abs((sig[0] == sig[1]).mean() - truth) < 0.04
    alone = neardup.dart_signatures(np.zeros(300, int), item, a, 1, 2000)
    assert (alone[0] == sig[0]).all()  # a set's signature does not depend on its batch
