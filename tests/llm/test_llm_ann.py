import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from forumlens.llm import ann
from forumlens.llm.queries import QUERIES


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), d[i]) for i in order]
    return out


def test_recall_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, x = e.vec_id.values, np.stack(e.embedding.values).astype(float)
    want = brute(ids, x, [i for i in ids if i % 100 == 0], 10)
    got = {}
    for r in QUERIES["op1_hash_forest"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        for _, v, s in found:
            assert s == np.sqrt(((x[list(ids).index(v)] - x[list(ids).index(q)]) ** 2).sum())


def test_ties_edge_vectors_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (200, None), (300, [2.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = rows(ann.nearest(df, df.filter(F.col("vec_id") % 100 == 0), 3).select("query_id", "rank", "vec_id"))
    assert got == [(100, 1, 1), (100, 2, 2), (100, 3, 300), (300, 1, 1), (300, 2, 2), (300, 3, 100)]


def test_many_equal_vectors_and_few_candidates(spark):
    data = [(i, [1.0, 2.0]) for i in range(60)] + [(100 + i, [3.0 + i, 1.0]) for i in range(3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = rows(ann.nearest(df, df.filter("vec_id IN (0, 40)"), 4).select("query_id", "vec_id"))
    assert got == [(0, 1), (0, 2), (0, 3), (0, 4), (40, 0), (40, 1), (40, 2), (40, 3)]
    two = df.filter("vec_id IN (0, 100)")
    assert rows(ann.nearest(two, two.filter("vec_id = 0"), 4).select("query_id", "rank", "vec_id")) == [(0, 1, 100)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_recall_at_the_production_share(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x = np.stack(e.embedding.values).astype(float)
    assert not hasattr(ann, "LEAST") and ann.TREES * 11 < ann.SHARE * len(x)  # no floor decides at this size
    # more rows than are given: Gaussian vectors of the same mean and covariance
    n = 10_000
    y = np.random.default_rng(3).multivariate_normal(x.mean(0), np.cov(x.T), n)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "vec_id long, embedding array<double>")
    want = brute(range(n), y, range(0, n, 500), 10)
    got = {(r.query_id, r.vec_id) for r in ann.nearest(df, df.filter(F.col("vec_id") % 500 == 0), 10).collect()}
    hits = sum((q, v) in got for q, near in want.items() for v, _ in near)
    assert hits >= 0.92 * 200


def test_recall_on_few_rows(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    ids, x = e.vec_id.values, np.stack(e.embedding.values).astype(float)
    assert len(ids) < 940
    df = spark.createDataFrame(e[["vec_id", "embedding"]])
    want = brute(ids, x, [i for i in ids if i % 20 == 0], 10)
    got = {(r.query_id, r.vec_id) for r in ann.nearest(df, df.filter(F.col("vec_id") % 20 == 0), 10).collect()}
    hits = sum((q, v) in got for q, near in want.items() for v, _ in near)
    print("recall", hits / sum(map(len, want.values())))
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_an_id_with_two_vectors_is_the_smaller_one(spark):
    df = spark.createDataFrame([(1, [5.0, 5.0]), (1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 9.0])], "vec_id long, embedding array<double>")
    got = rows(ann.nearest(df, df.filter("vec_id = 1"), 3).select("query_id", "rank", "vec_id", "score"))
    assert got == [(1, 1, 2, 1.0), (1, 2, 3, np.sqrt(82.0))]
