"""Joins of stored buckets move no row of them."""

import uuid

from pyspark.sql import functions as F

from forumlens.plans import facts
from forumlens.sources.bucketed import beside, write_bucketed
from conftest import rows


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_neither_staged_table_is_shuffled(spark, root):
    tag = uuid.uuid4().hex
    answers = spark.range(300).select(F.col("id").alias("answer_id"), (F.col("id") % 70).alias("question_id"))
    questions = spark.range(60).select(F.col("id").alias("question_id"), F.when(F.col("id") % 2 == 0, F.col("id") + 70).alias("accepted_answer_id"))
    a = write_bucketed(answers, f"{root}/a", f"bucketed_a_{tag}", "question_id", 4)
    q = write_bucketed(questions, f"{root}/q", f"bucketed_q_{tag}", "question_id", 4)
    joined = facts.join_answers_questions(a.hint("merge"), q)
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows(joined.select("answer_id", "question_accepted_answer_id")) == rows(
        facts.join_answers_questions(answers, questions).select("answer_id", "question_accepted_answer_id"))


def test_only_the_change_set_is_dealt_to_the_buckets(spark, root):
    name = f"bucketed_t_{uuid.uuid4().hex}"
    target = spark.range(500).select("id", (F.col("id") * 2).alias("old"))
    write_bucketed(target, f"{root}/t", name, "id", 4)
    change = spark.createDataFrame([(3, 1), (499, 1), (1000, 1)], "id long, new int")
    joined = beside(spark, name, change, "id", "full_outer")
    assert plan_of(joined).count("Exchange hashpartitioning") == 1
    assert joined.count() == 501 and joined.filter("new is not null and old is not null").count() == 2
