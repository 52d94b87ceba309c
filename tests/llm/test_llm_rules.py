import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from crosscheck import compare, connection
from forumlens.llm import rules
from forumlens.llm.queries import ORACLE, QUERIES

KIND = "doc_id long, text string, lang string, source string"


def plain(text):
    """Base measures from their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    threes = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(threes)
    covered = {i + k for i, t in enumerate(threes) if often[t] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    assert compare(QUERIES["op13_adaptive_rules"](spark, folder), connection(folder), ORACLE["op13_adaptive_rules"]) == ""


def test_measures_of_edge_texts(spark):
    texts = [None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "a a a a a", "x\nx\n\nx\n y", "   x # \U0001F600|", "l1\r\nl1\r\n", "w " * 30_000,
             "a b c d a b c e a b", "same line here\n" * 3]
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], KIND)
    got = {r.doc_id: tuple(r.quality[m] for m in rules.MEASURES) for r in rules.measured(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=60), min_size=1, max_size=150))
def test_measures_of_any_text(spark, texts):
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], KIND)
    got = {r.doc_id: tuple(r.quality[m] for m in rules.MEASURES) for r in rules.measured(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_sketches_merge_and_bound_the_error(spark):
    df = spark.createDataFrame([(v,) for v in [*range(2000), 10 ** 6, 123_456_789]], "v long")
    for r in df.select("v", rules.bucket_floor(rules.bucket(F.col("v"))).alias("low"), rules.bucket(F.col("v")).alias("b")).collect():
        assert r.low <= r.v and r.v - r.low <= r.v / 64
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = rules.measured(docs.select("doc_id", "text", "lang", "source"))
    keys = ["lang", "source"]
    parts = rules.sketched(whole.filter("doc_id % 2 = 0"), keys).unionByName(rules.sketched(whole.filter("doc_id % 2 = 1"), keys))
    assert rows(rules.merged(parts, keys)) == rows(rules.sketched(whole, keys))


def _text(i, extra=""):
    return " ".join(f"word{(i * 7 + k * k) % 9973}x{k}" for k in range(80)) + extra


def test_groups_set_their_own_thresholds(spark):
    # one source is full of symbols by nature, the other is not
    data = [(i, _text(i, " # | " * 40), "en", "tables") for i in range(400)] + [(1000 + i, _text(i), "en", "prose") for i in range(400)]
    data += [(5000, _text(1, " # | " * 40), "en", "prose"), (5001, _text(2), "en", "tables"), (5002, _text(3), None, None), (None, _text(4), "en", "prose"),
             (5003, "too short", "en", "prose"), (5004, None, None, "prose"), (5005, "a b c " * 50, "en", "prose")]
    df = spark.createDataFrame(data, KIND).withColumn("quality", F.lit("own")).withColumn("kept", F.lit(3)).withColumn("N", F.lit(1))
    out = rules.filtered(df)
    assert out.columns == df.columns
    kept = {r.doc_id for r in out.collect()}
    assert kept == {i for i, *_ in data} - {5000, 5003, 5004, 5005}


def test_history_is_merged_and_empty_tables_pass(spark):
    df = spark.createDataFrame([(i, _text(i), "en", "s") for i in range(5)] + [(9, _text(9, " #" * 60), "en", "s")], KIND)
    past = rules.sketched(rules.measured(spark.createDataFrame([(i, _text(i, " #" * 60 * (i % 2)), "en", "s") for i in range(600)], KIND)), ["lang", "source"])
    assert {r.doc_id for r in rules.filtered(df).collect()} == {0, 1, 2, 3, 4}
    assert {r.doc_id for r in rules.filtered(df, history=past).collect()} == {0, 1, 2, 3, 4, 9}
    assert rules.filtered(df.limit(0)).count() == 0 and rules.filtered(df.limit(0).select("doc_id", "text")).count() == 0
