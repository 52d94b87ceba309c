import corpus_pipeline
from conftest import SF_DIR, rows
from forumlens.llm.common import stored
from forumlens.llm.queries import QUERIES

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_apply_their_operators_decisions(spark):
    """Each stage's rows against the operator's own result on the stage's input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF_DIR), f"test-{name}")
        if name != "packing":
            assert out.columns == docs.columns
        if name == "near_duplicates":
            from forumlens.llm import neardup
            firsts = neardup.near_duplicates(docs).filter("doc_id = class_id").select("doc_id")
            assert rows(out.select("doc_id")) == rows(firsts)
        if name == "benchmark_leaks":
            from forumlens.llm import decontam
            bad = {r.doc_id for r in decontam.contaminated(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).collect()}
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - bad
        if name == "personal_data":
            from forumlens.llm import pii
            assert out.count() == docs.count() and out.filter("n_chars <> length(text)").count() == 0
            left = pii.personal_data(out).filter("size(base) > 0")
            assert left.count() == 0
        if name == "packing":
            assert out.select("doc_id").distinct().count() == docs.count()
        docs = out


def test_edge_rows_pass_every_stage(spark):
    data = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the cat sat on the mat and slept", "en", None, 1),
            (3, "the cat sat on the mat and slept", "en", "s", 1), (3, "the cat sat on the mat and slept", "en", "s", 1),
            (4, "mail me at a@b.com if the cat is there", "en", "s", None), (5, "und der hund war da " * 9000, "de", "s", 1)]
    docs = spark.createDataFrame(data, KIND).selectExpr("*", "text AS _key", "1 AS node", "lang AS _lang")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, SF_DIR), f"test-{name}")
        if k == 0:
            assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 3, 3, 4, 5]
        if k == 1:
            assert sorted(r.doc_id for r in docs.collect()) == [3, 4, 5]
        if k == 3:
            assert "mail me at [EMAIL] if the cat is there" in {r.text for r in docs.collect()}
    assert docs.filter("doc_id = 5").count() == 11


def test_empty_table(spark):
    docs = spark.createDataFrame([], KIND)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), f"test-{name}")
    assert docs.count() == 0


def test_registered_queries_name_every_operator():
    assert sorted({int(k[2:].split("_")[0]) for k in QUERIES}) == list(range(1, 14))
