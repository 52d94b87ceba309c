import random
import statistics

import pytest
from pyspark.sql import functions as F

from forumlens.operators import ranking as rk
from forumlens.operators import relational as rel
from forumlens.operators.ranking import Rank
from conftest import rows


def test_dedup_keeps_newest_then_ties(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 1), (1, 2, 9), (2, None, 3), (2, 0, 4)], "id int, t int, s int")
    assert rows(rel.dedup_latest(df, ["id"], ["t"], ["s"])) == [(1, 2, 9), (2, 0, 4)]


def test_dedup_drops_copies_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = rel.dedup_latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 or "WindowGroupLimit" in plan


def test_explode_normalises_and_marks_repeats(spark):
    df = spark.createDataFrame([(1, "Python|python |C++"), (2, ""), (3, None), (4, "a|| |b"), (5, " x y | X Y")],
                               "id int, tags_clean string")
    got = rows(rel.explode_tags(df, ["id"], mark_first=True))
    assert got == [(1, "c++", True), (1, "python", False), (1, "python", True), (4, "a", True), (4, "b", True),
                   (5, "x y", False), (5, "x y", True)]
    assert rows(rel.explode_tags(df, ["id"])) == [(i, t) for i, t, _ in got]


def test_orphans_include_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "c int, k int")
    parent = spark.createDataFrame([(10,), (None,)], "k int")
    assert rows(rel.orphans(child, parent, "k").select("c")) == [(2,), (3,)]
    assert rel.orphan_count(child, parent, "k").first()["n"] == 2
    assert rel.orphan_count(parent.filter("k = 10"), parent, "k").first()["n"] == 0


@pytest.mark.parametrize("interpolate", [True, False])
def test_grouped_median_against_brute_force(spark, interpolate):
    rng = random.Random(3)
    data = [(g, float(rng.choice([1, 2, 2, 7, 9, 11]))) for g in "abcde" for _ in range(rng.randint(1, 30))]
    df = spark.createDataFrame(data + [("a", None)], "g string, v double")
    expect = {}
    for g in "abcde":
        values = [v for k, v in data if k == g]
        expect[g] = statistics.median(values) if interpolate else statistics.median_low(values)
    got = {r["g"]: r["median"] for r in rel.grouped_median(df, "g", "v", interpolate=interpolate).collect()}
    assert got == expect


def test_minmax_of_constant_column_is_null(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, v double")
    assert rows(rel.minmax(df, {"n": "v"}).select("id", "n")) == [(1, None), (2, None)]


SPECS = [Rank("r", "rank", "v"), Rank("d", "dense_rank", "v"), Rank("p", "percent_rank", "v", descending=False),
         Rank("n", "row_number", "v"), Rank("b", "row_number", "v", within="g"),
         Rank("t4", "ntile", "v", tiles=4), Rank("t100", "ntile", "v", descending=False, tiles=100)]


def skewed(spark, n):
    """A third of the rows share one value; some are NULL."""
    rng = random.Random(n)
    data = []
    for i in range(n):
        v = 7.0 if i % 3 == 0 else (None if i % 50 == 1 else float(rng.randint(-20, 60)))
        data.append((i, v, rng.choice("xyz")))
    return spark.createDataFrame(data, "id int, v double, g string")


@pytest.mark.parametrize("n", [1, 3, 57, 2000])
@pytest.mark.parametrize("lookup", [0, 10_000])
def test_distributed_ranks_equal_windows(spark, n, lookup):
    df = skewed(spark, n)
    plain = rk.with_ranks(df, SPECS, ["id"], one_task=True)
    spread = rk.with_ranks(df, SPECS, ["id"], small_lookup=lookup)
    assert plain.columns == spread.columns
    assert rows(plain) == rows(spread)


def test_distributed_number_moves_no_row_to_a_single_task(spark):
    numbered = rk.global_row_number(skewed(spark, 500), [("v", True), ("id", False)])
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    # only the per-block totals are brought together
    assert len(single) <= 1
    assert sorted(r["row_number"] for r in numbered.collect()) == list(range(1, 501))


def test_hot_value_spreads_in_the_shuffled_lookup(spark):
    df = skewed(spark, 2000)
    ranks = rk.value_ranks(df, "v")
    out = rk.attach_ranks(df, ranks, "v", 2000, {"rank": "place"}, small_lookup=0)
    assert out.count() == 2000 and out.filter("place IS NULL").count() == 0
    assert out.filter("v = 7.0").select("place").distinct().count() == 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan.split("Join LeftOuter", 1)[1].splitlines()[0]


def test_ntile_of_matches_definition(spark):
    for total, tiles in [(10, 4), (3, 10), (100, 100), (7, 1)]:
        df = spark.range(1, total + 1).select("id", rk.ntile_of(F.col("id"), total, tiles).alias("mine"))
        df.createOrReplaceTempView("numbers")
        theirs = spark.sql(f"SELECT id, mine, ntile({tiles}) OVER (ORDER BY id) AS t FROM numbers")
        assert theirs.filter("mine <> t").count() == 0


def test_distinct_and_estimate_hold_one_sketch_per_key(spark):
    """Each sketch counts pairs that were combined before; a sketch per pair would need 3 KB for every user of a tag."""
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("a", None), ("b", None), (None, 3)], "tag string, user long")
    got = rel.distinct_and_estimate(df, "tag", "user")
    assert rows(got) == [(None, 1, 1), ("a", 2, 2), ("b", 0, 0)]
    steps = got._jdf.queryExecution().sparkPlan().toString().splitlines()
    by_pair = [s for s in steps if "keys=[tag" in s and "user" in s.split("keys=[")[1].split("]")[0]]
    assert by_pair and not any("approx_count_distinct" in s for s in by_pair)
