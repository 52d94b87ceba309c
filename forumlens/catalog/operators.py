"""Joins, aggregations, windows and ranking as queries over the facts."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import month_diff, month_of
from ..functions.numbers import pct, ratio, rnd
from ..operators import ranking as rk
from ..operators import relational as rel
from ..operators.ranking import Rank
from ..plans import dimensions, facts, kpis, marts
from ..session import stored
from ..sources import fixtures as fx
from ..sources.bucketed import beside, write_bucketed
from .base import Inputs, big, query, r, share

# ----------------------------------------------------------------------- joins
query("join_answers_questions", """
SELECT answer_id, a.question_id, q.accepted_answer_id AS question_accepted_answer_id
FROM x_stg_a a LEFT JOIN x_stg_q q ON q.question_id = a.question_id""")(
    lambda x: facts.join_answers_questions(x.stg_answers, x.stg_questions).select(
        "answer_id", "question_id", "question_accepted_answer_id"))



def _bucketed(x: Inputs, df, key: str, name: str):
    """A relation stored in eight buckets of a key, under a name of its own."""
    path = x.scratch(name)
    return write_bucketed(df, path, path.rsplit("/", 1)[-1].replace("-", "_"), key, 8)


@query("join_answers_questions_bucketed", """
SELECT answer_id, a.question_id, q.accepted_answer_id AS question_accepted_answer_id
FROM x_stg_a a LEFT JOIN x_stg_q q ON q.question_id = a.question_id""")
def join_bucketed(x: Inputs):
    """The same from staging stored in buckets of the question: neither side is shuffled."""
    answers = _bucketed(x, x.stg_answers.select("answer_id", "question_id"), "question_id", "bucketed-answers")
    questions = _bucketed(x, x.stg_questions.select("question_id", "accepted_answer_id"), "question_id", "bucketed-questions")
    return facts.join_answers_questions(answers.hint("merge"), questions).select("answer_id", "question_id", "question_accepted_answer_id")


query("accepted_flag", """
SELECT answer_id, CAST(EXISTS (SELECT 1 FROM x_stg_q q WHERE q.question_id = a.question_id
  AND q.accepted_answer_id = a.answer_id) AS BIGINT) AS accepted_answer_flag FROM x_stg_a a""")(
    lambda x: facts.join_answers_questions(x.stg_answers, x.stg_questions).select(
        "answer_id", facts.accepted_flag().alias("accepted_answer_flag")))

query("orphans", """
SELECT answer_id, a.question_id FROM x_fa a LEFT JOIN x_fq q ON q.question_id = a.question_id
WHERE q.question_id IS NULL""")(
    lambda x: rel.orphans(x.fact_answers.select("answer_id", "question_id"), x.fact_questions, "question_id"))

_COMBINED = f"""
SELECT coalesce(a.user_id, q.user_id) AS user_id, coalesce(total_answers, 0) AS total_answers,
  coalesce(accepted_answers, 0) AS accepted_answers, coalesce(avg_answer_score, 0) AS avg_answer_score,
  coalesce(total_answer_score, 0) AS total_answer_score,
  coalesce(total_questions_asked, 0) AS total_questions_asked,
  coalesce(avg_question_score, 0) AS avg_question_score,
  coalesce(total_views_generated, 0) AS total_views_generated, first_answer_date, latest_answer_date,
  coalesce(active_months, 0) AS active_months
FROM (SELECT user_id, count(*) AS total_answers, {big("sum(accepted_answer_flag)")} AS accepted_answers,
    {r("avg(score)", 2)} AS avg_answer_score, {big("sum(score)")} AS total_answer_score,
    min(creation_date) AS first_answer_date, max(creation_date) AS latest_answer_date,
    count(DISTINCT date_trunc('month', creation_date)) AS active_months
  FROM x_fa WHERE user_id > 0 GROUP BY user_id) a
FULL JOIN (SELECT user_id, count(*) AS total_questions_asked, {r("avg(score)", 2)} AS avg_question_score,
    {big("sum(view_count)")} AS total_views_generated FROM x_fq WHERE user_id > 0 GROUP BY user_id) q
  ON a.user_id = q.user_id"""

query("contributor_full_outer", _COMBINED)(
    lambda x: marts.contributor_combined(x.keep("stg_questions").fact_answers, x.fact_questions))

query("contributor_profile_join", f"""
SELECT c.user_id, display_name, reputation, total_answers, total_questions_asked
FROM ({_COMBINED}) c JOIN x_du u ON u.user_id = c.user_id""")(
    lambda x: marts.contributor_combined(x.keep("stg_questions").fact_answers, x.fact_questions)
    .join(x.dim_user.select("user_id", "display_name", "reputation"), "user_id")
    .select("user_id", "display_name", "reputation", "total_answers", "total_questions_asked"))

_MONTHS = f"""
SELECT user_id, CAST(date_trunc('month', activity_date) AS DATE) AS activity_month,
  {big("sum(questions_posted)")} AS monthly_questions, {big("sum(answers_posted)")} AS monthly_answers,
  {big("sum(total_posts)")} AS total_monthly_posts, max(engagement_score) AS peak_daily_engagement
FROM x_ua WHERE user_id > 0 GROUP BY ALL"""

_COHORT = f"""
SELECT *, CASE WHEN months_since_first_activity = 0 THEN 'New'
    WHEN date_diff('month', prior_active_month, activity_month) = 1 THEN 'Retained'
    ELSE 'Returned' END AS contributor_type
FROM (SELECT m.*, min(activity_month) OVER u AS cohort_month,
    lag(activity_month) OVER o AS prior_active_month, lead(activity_month) OVER o AS next_active_month,
    date_diff('month', min(activity_month) OVER u, activity_month) AS months_since_first_activity
  FROM ({_MONTHS}) m WINDOW u AS (PARTITION BY user_id), o AS (PARTITION BY user_id ORDER BY activity_month))"""

query("cohort_join", f"""
SELECT m.user_id, m.activity_month, f.cohort_month FROM ({_MONTHS}) m
JOIN (SELECT user_id, min(activity_month) AS cohort_month FROM ({_MONTHS}) GROUP BY user_id) f
  ON f.user_id = m.user_id""")(
    lambda x: marts.cohort_months(x.keep("stg_questions").user_activity).select("user_id", "activity_month", "cohort_month"))

query("cohort_months", _COHORT)(lambda x: marts.cohort_months(x.keep("stg_questions").user_activity))

query("lag_lead_dates", f"""
SELECT user_id, activity_month, prior_active_month, next_active_month FROM ({_COHORT})""")(
    lambda x: marts.cohort_months(x.keep("stg_questions").user_activity).select(
        "user_id", "activity_month", "prior_active_month", "next_active_month"))

query("contributor_type", f"""
SELECT contributor_type, months_since_first_activity, count(*) AS n FROM ({_COHORT}) GROUP BY ALL""")(
    lambda x: marts.cohort_months(x.keep("stg_questions").user_activity)
    .groupBy("contributor_type", "months_since_first_activity").agg(F.count("*").alias("n")))

query("tag_dim_lookup", """
SELECT t.question_id, t.tag_name, d.tag_category FROM x_tagged t LEFT JOIN x_dt d ON d.tag_name = t.tag_name""")(
    lambda x: _tag_lookup(x))


def _tag_lookup(x: Inputs):
    fq = x.keep("fact_questions").fact_questions
    return rel.explode_tags(fq, ["question_id"]).join(
        x.dim_tag.select("tag_name", "tag_category"), "tag_name", "left")


query("question_first_answer_join", """
SELECT q.question_id, f.first_answer_date, f.accepted_answer_date FROM x_fq q LEFT JOIN (
  SELECT question_id, min(creation_date) AS first_answer_date,
    min(creation_date) FILTER (accepted_answer_flag = 1) AS accepted_answer_date
  FROM x_fa GROUP BY question_id) f ON f.question_id = q.question_id""")(
    lambda x: x.fact_questions.select("question_id").join(
        rel.first_event(x.fact_answers, "question_id", "creation_date", F.col("accepted_answer_flag") == 1,
                        "first_answer_date", "accepted_answer_date"), "question_id", "left"))

query("merge_join", """
SELECT coalesce(e.id, s.id) AS id, e.score AS old_score, s.score AS new_score
FROM x_early_q e FULL JOIN x_src_q s ON s.id = e.id""")(
    lambda x: fx.questions_earlier(x.spark, x.sf_dir).select("id", F.col("score").alias("old_score"))
    .join(x.src_questions.select("id", F.col("score").alias("new_score")), "id", "full_outer"))



@query("merge_join_bucketed", """
SELECT coalesce(e.id, s.id) AS id, e.score AS old_score, s.score AS new_score
FROM x_early_q e FULL JOIN x_src_q s ON s.id = e.id""")
def merge_join_bucketed(x: Inputs):
    """The same with the target stored in buckets of its key: only the change set is dealt to them."""
    old = fx.questions_earlier(x.spark, x.sf_dir).select("id", F.col("score").alias("old_score"))
    path = x.scratch("bucketed-target")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    write_bucketed(old, path, name, "id", 8)
    return beside(x.spark, name, x.src_questions.select("id", F.col("score").alias("new_score")), "id", "full_outer")


query("scalar_subquery", """
SELECT question_id, score FROM x_fq
WHERE year(creation_date) = (SELECT max(year(creation_date)) - 1 FROM x_fq)""")(
    lambda x: _last_full_year(x))


def _last_full_year(x: Inputs):
    fq = x.fact_questions
    newest = rel.one_row(fq, y=F.max(F.year("creation_date")))["y"]
    return fq.filter(F.year("creation_date") == newest - 1).select("question_id", "score")


# ---------------------------------------------------------------- aggregations
query("explode_tags", "SELECT question_id, tag_name FROM x_tagged")(
    lambda x: rel.explode_tags(x.fact_questions, ["question_id"]))

query("distinct_tags", "SELECT DISTINCT tag_name FROM x_tagged")(
    lambda x: dimensions.distinct_tags(x.fact_questions))

query("count_star", """
SELECT quality_tier, count(*) AS n, count(accepted_answer_id) AS with_accepted FROM x_fq GROUP BY 1""")(
    lambda x: x.fact_questions.groupBy("quality_tier").agg(
        F.count("*").alias("n"), F.count("accepted_answer_id").alias("with_accepted")))

query("count_distinct", """
SELECT tag_name, count(DISTINCT question_id) AS questions, count(DISTINCT user_id) AS askers
FROM x_tagged GROUP BY 1""")(
    lambda x: rel.explode_tags(x.fact_questions, ["question_id", "user_id"]).groupBy("tag_name").agg(
        F.count_distinct("question_id").alias("questions"), F.count_distinct("user_id").alias("askers")))

query("count_distinct_approx", """
SELECT tag_name, count(DISTINCT user_id) AS askers, true AS estimate_is_close FROM x_tagged GROUP BY 1""")(
    lambda x: rel.distinct_and_estimate(rel.explode_tags(x.fact_questions, ["user_id"]), "tag_name", "user_id").select(
        "tag_name", F.col("n_distinct").alias("askers"),
        (F.abs(F.col("estimate") - F.col("n_distinct")) <= F.col("n_distinct") * 0.1).alias("estimate_is_close")))

query("count_if", """
SELECT tag_name, count(*) FILTER (answer_count = 0) AS unanswered, count(*) FILTER (answer_count > 0) AS answered,
  count(*) FILTER (has_accepted_answer) AS accepted FROM x_tagged GROUP BY 1""")(
    lambda x: rel.explode_tags(x.fact_questions, ["answer_count", "has_accepted_answer"])
    .groupBy("tag_name").agg(
        F.count_if(F.col("answer_count") == 0).alias("unanswered"),
        F.count_if(F.col("answer_count") > 0).alias("answered"),
        F.count_if("has_accepted_answer").alias("accepted")))

query("sum_avg_min_max", f"""
SELECT user_id, {big("sum(view_count)")} AS views, {r("avg(score)", 2)} AS avg_score,
  min(creation_date) AS first_day, max(creation_date) AS last_day FROM x_fq GROUP BY 1""")(
    lambda x: x.fact_questions.groupBy("user_id").agg(
        F.sum("view_count").alias("views"), rnd(F.avg("score"), 2).alias("avg_score"),
        F.min("creation_date").alias("first_day"), F.max("creation_date").alias("last_day")))

query("conditional_aggregate", f"""
SELECT question_id, {big("sum(CASE WHEN score > 0 THEN 1 ELSE 0 END)")} AS upvoted,
  min(CASE WHEN accepted_answer_flag = 1 THEN creation_date END) AS accepted_day,
  {r("avg(CASE WHEN score >= 0 THEN score END)", 2)} AS avg_nonnegative FROM x_fa GROUP BY 1""")(
    lambda x: x.fact_answers.groupBy("question_id").agg(
        F.sum(F.when(F.col("score") > 0, 1).otherwise(0)).alias("upvoted"),
        F.min(F.when(F.col("accepted_answer_flag") == 1, F.col("creation_date"))).alias("accepted_day"),
        rnd(F.avg(F.when(F.col("score") >= 0, F.col("score"))), 2).alias("avg_nonnegative")))

query("approx_median", """
SELECT tag_name, quantile_disc(view_count, 0.5) AS median_views FROM x_tagged GROUP BY 1""")(
    # the sketch keeps groups of up to its accuracy whole, so here it gives the exact element
    lambda x: rel.explode_tags(x.fact_questions, ["view_count"]).groupBy("tag_name").agg(
        F.percentile_approx("view_count", 0.5, 10000).alias("median_views")))

query("exact_median", """
SELECT tag_name, CAST(quantile_cont(view_count, 0.5) AS DOUBLE) AS median_views FROM x_tagged GROUP BY 1""")(
    lambda x: rel.grouped_median(rel.explode_tags(x.fact_questions, ["view_count"]), "tag_name",
                                 "view_count", "median_views"))

query("having_min_volume", """
SELECT tag_name, count(*) AS questions FROM x_tagged GROUP BY 1 HAVING count(*) >= 500""")(
    lambda x: rel.explode_tags(x.fact_questions).groupBy("tag_name").agg(F.count("*").alias("questions"))
    .filter("questions >= 500"))

query("duplicate_keys", """
SELECT id, count(*) AS occurrence_count FROM x_raw_a GROUP BY 1 HAVING count(*) > 1""")(
    lambda x: rel.duplicate_keys(x.raw_answers, ["id"]))

query("global_extremes", """
SELECT min(creation_date) AS earliest, max(creation_date) AS latest, count(*) AS n FROM x_fa""")(
    lambda x: x.fact_answers.agg(F.min("creation_date").alias("earliest"),
                                 F.max("creation_date").alias("latest"), F.count("*").alias("n")))

query("first_per_group", """
SELECT question_id, min(creation_timestamp) AS first_at,
  min(creation_timestamp) FILTER (accepted_answer_flag = 1) AS first_flagged_at FROM x_fa GROUP BY 1""")(
    lambda x: rel.first_event(x.fact_answers, "question_id", "creation_timestamp",
                              F.col("accepted_answer_flag") == 1))

# --------------------------------------------------------------------- windows
query("dedup_latest", """
SELECT id, parent_id, last_activity_date, score FROM x_raw_a QUALIFY row_number() OVER (PARTITION BY id
  ORDER BY last_activity_date DESC, score DESC, parent_id DESC) = 1""")(
    lambda x: rel.dedup_latest(x.raw_answers.select("id", "parent_id", "last_activity_date", "score"), ["id"],
                               ["last_activity_date"], ["score", "parent_id"]))

_YEARS = "SELECT tag_name, year(creation_date) AS y, count(*) AS n FROM x_tagged GROUP BY ALL"


def _tag_years(x: Inputs):
    return (rel.explode_tags(x.fact_questions, ["creation_date"])
            .groupBy("tag_name", F.year("creation_date").cast("long").alias("y"))
            .agg(F.count("*").alias("n")))


query("lag_growth", f"""
SELECT tag_name, y, n, prior, {share("n - prior", "prior")} AS growth_pct
FROM (SELECT *, lag(n) OVER (PARTITION BY tag_name ORDER BY y) AS prior FROM ({_YEARS}))""")(
    lambda x: marts.yoy(_tag_years(x), "tag_name", "y", "n", "prior", "growth_pct"))

query("running_total", f"""
SELECT tag_name, y, n, CAST(sum(n) OVER (PARTITION BY tag_name ORDER BY y ROWS UNBOUNDED PRECEDING) AS BIGINT)
  AS so_far FROM ({_YEARS})""")(
    lambda x: _tag_years(x).withColumn("so_far", F.sum("n").over(
        W.partitionBy("tag_name").orderBy("y").rowsBetween(W.unboundedPreceding, 0))))

query("rank_per_year", f"""
SELECT tag_name, y, n, rank() OVER (PARTITION BY y ORDER BY n DESC) AS place FROM ({_YEARS})""")(
    lambda x: _tag_years(x).withColumn(
        "place", F.rank().over(W.partitionBy("y").orderBy(F.col("n").desc())).cast("long")))

_ACTIVE = """SELECT CAST(date_trunc('month', creation_date) AS DATE) AS activity_month,
  count(DISTINCT user_id) AS users FROM x_fq GROUP BY 1"""


def _active_users(x: Inputs):
    return x.fact_questions.groupBy(month_of("creation_date").alias("activity_month")).agg(
        F.count_distinct("user_id").alias("users"))


query("lag_over_aggregate", f"""
SELECT activity_month, users, lag(users) OVER (ORDER BY activity_month) AS users_before FROM ({_ACTIVE})""")(
    lambda x: _active_users(x).withColumn("users_before", F.lag("users").over(W.orderBy("activity_month"))))

query("rolling_average", f"""
SELECT activity_month, users, {r('''avg(users) OVER (ORDER BY activity_month
  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)''', 0)} AS rolling FROM ({_ACTIVE})""")(
    lambda x: _active_users(x).withColumn("rolling", rnd(
        F.avg("users").over(W.orderBy("activity_month").rowsBetween(-2, 0)), 0)))

# A limit of zero forces the joins that large lookups take on these small tables.
FORCED = {"small_lookup": 0}

_USERS = "SELECT user_id, reputation, reputation_bucket FROM x_stg_u"


def _users(x: Inputs):
    return x.stg_users.select("user_id", "reputation", "reputation_bucket")


query("rank_in_bucket", f"""
SELECT user_id, reputation_bucket, row_number() OVER (PARTITION BY reputation_bucket
  ORDER BY reputation DESC, user_id) AS rank_within_bucket FROM ({_USERS})""")(
    lambda x: rk.with_ranks(_users(x), [Rank("rank_within_bucket", "row_number", "reputation",
                                             within="reputation_bucket")], ["user_id"], **FORCED)
    .drop("reputation"))

_VOLUME = "SELECT question_id, view_count, score FROM x_fq"


def _volume(x: Inputs):
    return x.fact_questions.select("question_id", "view_count", "score")


query("global_rank", f"""
SELECT question_id, rank() OVER (ORDER BY view_count DESC) AS by_views,
  rank() OVER (ORDER BY score DESC) AS by_score FROM ({_VOLUME})""")(
    lambda x: rk.with_ranks(_volume(x), [Rank("by_views", "rank", "view_count"),
                                         Rank("by_score", "rank", "score")], ["question_id"])
    .select("question_id", "by_views", "by_score"))

query("global_dense_rank", f"""
SELECT question_id, dense_rank() OVER (ORDER BY score DESC) AS by_score FROM ({_VOLUME})""")(
    lambda x: rk.with_ranks(_volume(x), [Rank("by_score", "dense_rank", "score")], ["question_id"])
    .select("question_id", "by_score"))

query("ntile_percent_rank", f"""
SELECT user_id, {r("percent_rank() OVER (ORDER BY reputation) * 100", 2)} AS pct_rank,
  ntile(4) OVER o AS quartile, ntile(10) OVER o AS decile, ntile(100) OVER o AS percentile
FROM ({_USERS}) WINDOW o AS (ORDER BY reputation, user_id)""")(
    lambda x: rk.with_ranks(_users(x), [
        Rank("pct_rank", "percent_rank", "reputation", descending=False),
        Rank("quartile", "ntile", "reputation", descending=False, tiles=4),
        Rank("decile", "ntile", "reputation", descending=False, tiles=10),
        Rank("percentile", "ntile", "reputation", descending=False, tiles=100)], ["user_id"])
    .drop("reputation", "reputation_bucket"))

query("distributed_rank", f"""
SELECT question_id, rank() OVER (ORDER BY score DESC) AS place, dense_rank() OVER (ORDER BY score DESC) AS step,
  row_number() OVER (ORDER BY score DESC, question_id) AS number,
  ntile(100) OVER (ORDER BY score DESC, question_id) AS tile,
  {r("percent_rank() OVER (ORDER BY view_count) * 100", 2)} AS pct_rank FROM ({_VOLUME})""")(
    lambda x: rk.with_ranks(_volume(x), [
        Rank("place", "rank", "score"), Rank("step", "dense_rank", "score"),
        Rank("number", "row_number", "score"), Rank("tile", "ntile", "score", tiles=100),
        Rank("pct_rank", "percent_rank", "view_count", descending=False)], ["question_id"], **FORCED)
    .drop("view_count", "score"))

query("minmax_normalise", f"""
SELECT question_id, {r('''(view_count - min(view_count) OVER ()) * CAST(100 AS DOUBLE)
  / nullif(max(view_count) OVER () - min(view_count) OVER (), 0)''', 2)} AS norm_views FROM x_fq""")(
    lambda x: rel.minmax(x.fact_questions.select("question_id", "view_count"), {"norm_views": "view_count"})
    .drop("view_count"))

# ------------------------------------------------------------- sort and top-k
query("ordered_output", "SELECT tag_name, y, n FROM (" + _YEARS + ")")(
    lambda x: _tag_years(x).orderBy(F.col("y").desc(), F.col("n").desc(), "tag_name"))

query("top_k", f"SELECT question_id, view_count FROM ({_VOLUME}) ORDER BY view_count DESC, question_id LIMIT 25")(
    lambda x: kpis.top_k(x.fact_questions.select("question_id", "view_count"), "view_count", 25,
                         tie="question_id"))
