import hashlib
from fractions import Fraction
from math import floor

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from forumlens.llm import vectorcode
from forumlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(data, parts=16, entries=64, rounds=2):
    """(id, code, error) of rows (id, vector) and the codebooks, in exact arithmetic."""
    kept = [(i, [floor(Fraction(float(x)) * 256) for x in v]) for i, v in data]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    first = sorted({i for i, _ in kept})[:entries]
    by_id = {}
    for i, v in kept:
        by_id[i] = min(by_id.get(i, v), v)
    books = [[cut(by_id[i], p) for i in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v in kept:
                own.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else e for k, e in enumerate(books[p])]
    out = []
    for i, v in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, [k for _, k in found], sum(d for d, _ in found)))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want, digest = brute([(r.vec_id, r.embedding) for r in table])
    label = {r.vec_id: r.label for r in table}
    sums = {}
    for i, _, e in want:
        sums[label[i]] = sums.get(label[i], 0) + e
    expected = sorted((i, "".join(f"{k:02x}" for k in c), e, sums[label[i]], digest) for i, c, e in want)
    got = QUERIES["op12_laesa_codes"](spark, SF)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert rows(got) == expected


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(3, [1.0, -0.001, 2.0], 1), (1, [0.5, 0.5, 0.5], None), (1, [0.25, 0.5, 0.5], None), (1, [0.5, 0.5, 0.5], None), (2, None, 1), (4, [], 1),
            (5, [nan, 1.0, 1.0], 1), (6, [inf, 1.0, 1.0], 1), (7, [None, 1.0, 1.0], 1), (8, [1.0, 2.0], 2), (9, [1e300, 0.0, 0.0], 2), (None, [1.0, 0.0, 2.0], 3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("error", F.lit("old")).withColumn("extra", F.lit(1))
    out, books = vectorcode.compressed(df, parts=2, entries=64)
    assert out.columns == ["vec_id", "label", "extra", "code", "error", "exact_distances"]
    got = rows(out.select("vec_id", "code", "error"))
    good = [(i, [*v, 0.0]) for i, v, _ in data if i in (1, 3)]
    want, digest = brute([*good, (99, [1.0, 0.0, 2.0, 0.0])], 2, 2)
    assert books.digest() == digest and books.entries.shape == (2, 2, 2)
    assert [(i, list(c), e) for i, c, e in got if c is not None] == sorted([(None if i == 99 else i, c, e) for i, c, e in want], key=lambda r: ((r[0] is not None, r[0]), r[1:]))
    assert [(i, e) for i, c, e in got if c is None] == [(8, None), (9, None)]


def test_nothing_to_code(spark):
    df = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    for rows_ in (df, df.limit(0)):
        out, books = vectorcode.compressed(rows_)
        assert out.count() == 0 and books is None
    out, books = vectorcode.compressed(spark.createDataFrame([(None, [1.0], 1)], "vec_id long, embedding array<float>, label int"))
    assert books is None and rows(out.select("vec_id", "code", "error")) == [(None, None, None)]


def test_pivots_prune_and_never_change_the_answer():
    rng = np.random.default_rng(5)
    x = rng.integers(-400, 400, (500, 4, 4))
    x[::7] = x[0]
    entries = np.ascontiguousarray(x[:64].transpose(1, 0, 2))
    books = vectorcode.Codebooks(entries, vectorcode.choose_pivots(entries, 4))
    index, best, tried = vectorcode.assign(x, vectorcode.pivot_distances(x, books.pivots), books)
    for p in range(4):
        d = ((x[:, p, None].astype(object) - entries[p][None].astype(object)) ** 2).sum(-1).astype(np.int64)
        assert (index[:, p] == d.argmin(1)).all() and (best[:, p] == d.min(1)).all()
    assert tried.mean() < 4 * 64 / 2
