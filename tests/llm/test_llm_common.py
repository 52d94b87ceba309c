import random

from pyspark.sql import functions as F

from conftest import rows
from forumlens.llm import common


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_components_of_nothing(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_running_total_over_blocks(spark):
    values = list(range(1, 30))
    df = spark.createDataFrame([(values,), ([],), ([7],)], "v array<int>")
    got = [r.t for r in df.select(common.running_total(F.col("v"), block=4).alias("t")).collect()]
    assert got == [[sum(values[:k + 1]) for k in range(29)], [], [7]]


def test_rows_by_id_keep_null_keys_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (None, "c", 2), (2, "d", 3)], "id long, _slot string, _maybe int")
    ids = spark.createDataFrame([(2,), (2,), (9,)], "id long")
    assert rows(common.rows_of(df, "id", ids)) == [(2, "b", 1), (2, "d", 3)]
    assert rows(common.rows_not_of(df, "id", ids)) == [(None, "c", 2), (1, "a", 0)]
    facts = spark.createDataFrame([(2, "x")], "id long, more string")
    assert rows(common.joined_by_id(df, "id", facts)) == [(None, "c", 2, None), (1, "a", 0, None), (2, "b", 1, "x"), (2, "d", 3, "x")]
