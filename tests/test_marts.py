import datetime as dt

from pyspark.sql import functions as F

from forumlens.plans import kpis, marts
from conftest import rows


def day(s):
    return dt.date.fromisoformat(s)


def questions(spark, values):
    """(id, user, timestamp, tags, score, views, answers)"""
    data = [(i, u, dt.datetime.fromisoformat(t), tags, s, v, a) for i, u, t, tags, s, v, a in values]
    df = spark.createDataFrame(data, "question_id long, user_id long, creation_timestamp timestamp_ntz, "
                                     "tags_clean string, score long, view_count long, answer_count long")
    return df.withColumns({"creation_date": F.to_date("creation_timestamp"),
                           "has_accepted_answer": F.col("answer_count") > 1,
                           "engagement_score": F.col("score") * 2.0})


def answers(spark, values):
    """(id, question, user, timestamp, accepted, score)"""
    data = [(i, q, u, dt.datetime.fromisoformat(t), f, s) for i, q, u, t, f, s in values]
    df = spark.createDataFrame(data, "answer_id long, question_id long, user_id long, "
                                     "creation_timestamp timestamp_ntz, accepted_answer_flag long, score long")
    return df.withColumn("creation_date", F.to_date("creation_timestamp"))


def test_growth_compares_with_last_present_year(spark):
    fq = questions(spark, [(1, 1, "2010-01-01", "a|b", 1, 10, 0), (2, 1, "2010-05-01", "a", 3, 10, 2),
                           (3, 2, "2012-01-01", "A ", 5, 10, 1), (4, 2, "2009-01-01", "a", 5, 10, 1)])
    got = {(r["tag_name"], r["question_year"]): r for r in marts.tag_growth(fq).collect()}
    assert set(got) == {("a", 2010), ("b", 2010), ("a", 2012)}
    later = got["a", 2012]
    assert later["prior_year_question_count"] == 2 and later["yoy_growth_rate_pct"] == -50.0
    assert later["cumulative_question_count"] == 3 and later["growth_classification"] == "Strong Decline"
    first = got["a", 2010]
    assert first["distinct_contributors"] == 1 and first["avg_score"] == 2.0
    assert first["growth_classification"] == "New/Baseline" and first["answer_rate_pct"] == 50.0


def test_repeated_tag_counts_one_question(spark):
    fq = questions(spark, [(1, 1, "2010-01-01", "a|a", 1, 10, 0), (2, 2, "2010-01-01", "a", 4, 10, 0)])
    r = marts.tag_growth(fq).first()
    assert r["question_count"] == 2 and r["avg_score"] == 2.0
    assert marts.tag_answer_stats(fq, 1).first()["total_questions"] == 2


def test_latency_from_midnight_or_exact(spark):
    fq = questions(spark, [(1, 1, "2020-01-01 10:00:00", "a", 1, 1, 1), (2, 1, "2020-01-01 10:00:00", "a", 1, 1, 0)])
    fa = answers(spark, [(11, 1, 5, "2020-01-01 12:30:00", 0, 1), (12, 1, 5, "2020-01-03 10:00:00", 1, 1)])
    faithful = {r["question_id"]: r for r in marts.question_latency(fq, fa).collect()}
    exact = {r["question_id"]: r for r in marts.question_latency(fq, fa, use_timestamps=True).collect()}
    assert faithful[1]["hours_to_first_answer"] == -10.0 and faithful[1]["hours_to_accepted_answer"] == 38.0
    assert exact[1]["hours_to_first_answer"] == 2.5 and exact[1]["hours_to_accepted_answer"] == 48.0
    assert faithful[2]["hours_to_first_answer"] is None
    r = marts.answer_latency(fq, fa, 1, exact=True).first()
    assert r["avg_hours_to_first_answer"] == -10.0 and r["median_hours_to_first_answer"] is None
    assert r["questions_with_answers"] == 1 and r["answer_rate_pct"] == 50.0


def test_exact_and_approximate_latency_agree_on_all_else(spark):
    from forumlens.catalog.base import Inputs
    from conftest import SF_DIR
    x = Inputs(spark, SF_DIR).keep("stg_questions", "fact_answers")
    a = marts.answer_latency(x.fact_questions, x.fact_answers, 10, exact=True).drop("median_hours_to_first_answer")
    b = marts.answer_latency(x.fact_questions, x.fact_answers, 10).drop("median_hours_to_first_answer")
    assert rows(a) == rows(b) and a.count() > 0


def test_retention_kinds_add_up(spark):
    activity = spark.createDataFrame(
        [(1, day("2020-01-05"), 1, 0, 1, 1.0), (1, day("2020-01-20"), 0, 1, 1, 3.0),
         (1, day("2020-02-05"), 1, 0, 1, 1.0), (1, day("2020-04-05"), 1, 0, 1, 1.0),
         (2, day("2020-02-07"), 0, 2, 2, 1.0), (-1, day("2020-02-07"), 5, 5, 10, 1.0)],
        "user_id long, activity_date date, questions_posted long, answers_posted long, total_posts long, "
        "engagement_score double")
    got = {r["activity_month"].month: r.asDict() for r in marts.contributor_retention(activity).collect()}
    assert set(got) == {1, 2, 4}
    assert got[2]["total_active_contributors"] == 2 and got[2]["retained_contributors"] == 1
    assert got[2]["month_over_month_retention_pct"] == 100.0 and got[2]["net_new_contributors"] == 1
    assert got[4]["returned_contributors"] == 1 and got[4]["retained_contributors"] == 0
    assert got[1]["month_over_month_retention_pct"] is None
    for r in got.values():
        assert r["new_contributors"] + r["retained_contributors"] + r["returned_contributors"] == \
            r["total_active_contributors"]


def test_contributors_need_an_answer_and_a_profile(spark):
    fq = questions(spark, [(1, 1, "2020-01-01", "a", 4, 10, 1), (2, 3, "2020-01-01", "a", 4, 10, 1)])
    fa = answers(spark, [(11, 1, 1, "2020-02-01", 1, 3), (12, 1, 2, "2020-02-01", 0, 3), (13, 1, 1, "2020-03-09", 0, 0)])
    users = spark.createDataFrame([(1, "one", 100, "Beginner", day("2019-12-31"), 5, True),
                                   (3, "three", 100, "Beginner", day("2019-12-31"), 5, True)],
                                  "user_id long, display_name string, reputation long, reputation_bucket string, "
                                  "account_creation_date_date date, account_age_days long, is_active boolean")
    got = marts.top_contributors(fa, fq, users, "2020-04-30").collect()
    assert [r["user_id"] for r in got] == [1]
    r = got[0]
    assert r["active_months"] == 2 and r["acceptance_rate_pct"] == 50.0
    assert r["activity_consistency_pct"] == 50.0 and r["contribution_score"] == 6 + 5 + 1 + 1.5


def test_trending_with_equal_volumes_has_no_score(spark):
    fq = questions(spark, [(1, 1, "2010-01-01", "a|b", 1, 10, 0), (2, 1, "2011-05-01", "a", 3, 10, 2)])
    tags = spark.createDataFrame([("a", "Other")], "tag_name string, tag_category string")
    got = rows(marts.trending(marts.tag_growth(fq), tags, min_questions=1).select("tag_name", "tag_category",
                                                                                  "popularity_score"))
    assert got == [("a", "Other", None), ("b", None, None)]


def test_health_of_silent_community(spark):
    inputs = spark.createDataFrame([("a", 0.0, 0.0, None, None, None)],
                                   "tag_name string, answer_rate_pct double, acceptance_rate_pct double, "
                                   "avg_hours_to_first_answer double, yoy_growth_rate_pct double, avg_engagement double")
    r = marts.health_scores(inputs).first()
    assert r["speed_score"] == 0.0 and r["growth_score"] == 50.0 and r["community_health_score"] == 10.0


def test_top_k_ties_go_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 3.0)], "tag_name string, v double")
    assert [r["tag_name"] for r in kpis.top_k(df, "v", 3).collect()] == ["d", "a", "b"]
