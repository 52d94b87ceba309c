from pyspark.sql import functions as F

from conftest import rows
from forumlens.llm import langid
from forumlens.llm.queries import QUERIES

KIND = "doc_id long, text string, lang string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op3_kernel_language"](spark, "/root/testdata/sf0.01")
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    both = got.join(docs, "doc_id").filter("held_out")
    right, n, low, high = both.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 150 and right / n >= 0.98 and 0 <= low and high <= 1


def test_edge_rows(spark):
    data = [(1, "the cat and the dog sat there", "en"), (2, "der hund und die katze sind hier", "de"), (None, "the cat and the dog", None),
            (3, None, "en"), (4, "", "de"), (5, "123 !? \U0001F600", "en"), (6, "the cat and the dog sat there", "en"),
            (7, "und die katze " * 20_000, None), (8, "\U00020000\U00020001", None)]
    docs = spark.createDataFrame(data, KIND)
    model = langid.train(docs)
    assert model.languages == ["de", "en"]
    got = {(r.doc_id, r.lang_pred) for r in langid.classified(docs.withColumn("bits", F.lit(1)), model).collect()}
    assert got >= {(1, "en"), (2, "de"), (None, "en"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (7, "de")}
    assert {r.score for r in langid.classified(docs, model).filter("lang_pred = 'und'").collect()} == {0.0}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], KIND)
    assert rows(langid.classified(docs, langid.train(docs)).select("lang_pred", "score")) == [("und", 0.0)]
    empty = docs.limit(0)
    assert langid.classified(empty, langid.train(empty)).count() == 0


def test_the_sample_has_its_bound_and_every_language(spark):
    data = [(i, f"text number {i} of many", "xx") for i in range(300)] + [(1000, "the only one", "yy")]
    model = langid.train(spark.createDataFrame(data, KIND), sample_rows=10)
    assert model.languages == ["xx", "yy"] and len(model.landmarks) <= 10


def test_labelled_rows_without_ids_train_and_names_may_clash(spark):
    data = [(None, "the cat and the dog sat there", "en"), (None, "der hund und die katze sind hier", "de")] * 3
    docs = spark.createDataFrame(data, KIND)
    model = langid.train(docs)
    assert model.languages == ["de", "en"]
    clash = docs.withColumn("score", F.lit("old")).withColumn("LANG_PRED", F.lit(7))
    got = langid.classified(clash, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert got.filter("lang = lang_pred").count() == 6
