"""Marts and KPI reports as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import contribution_score, knowledge_gap
from ..operators.relational import explode_tags
from ..plans import kpis, marts
from ..session import stored
from ..sources import fixtures as fx
from .base import GROWTH_SQL, HEALTH_SQL, RELATIONS, TREND_SQL, Inputs, big, query, r, share
from .operators import _COHORT, _COMBINED

# The checking engine evaluates each relation once, so the marts can build on one another.
RELATIONS["x_growth"] = f"""
SELECT question_year, tag_name, question_count, prior_year_question_count,
  {share("question_count - prior_year_question_count", "prior_year_question_count")} AS yoy_growth_rate_pct,
  distinct_contributors, prior_year_contributors,
  {share("distinct_contributors - prior_year_contributors", "prior_year_contributors")}
    AS contributor_growth_rate_pct,
  avg_score, avg_views, avg_engagement, answered_questions,
  {share("answered_questions", "question_count")} AS answer_rate_pct, cumulative_question_count,
  rank_by_volume_in_year
FROM (SELECT *, lag(question_count) OVER h AS prior_year_question_count,
    lag(distinct_contributors) OVER h AS prior_year_contributors,
    {big("sum(question_count) OVER (h ROWS UNBOUNDED PRECEDING)")} AS cumulative_question_count,
    rank() OVER (PARTITION BY question_year ORDER BY question_count DESC) AS rank_by_volume_in_year
  FROM (SELECT year(creation_date) AS question_year, tag_name, count(DISTINCT question_id) AS question_count,
      count(DISTINCT user_id) AS distinct_contributors, {r("avg(score)", 2)} AS avg_score,
      {r("avg(view_count)", 0)} AS avg_views, {r("avg(engagement_score)", 4)} AS avg_engagement,
      count(*) FILTER (answer_count > 0) AS answered_questions
    FROM x_tagged WHERE year(creation_date) >= {fx.MIN_YEAR} GROUP BY ALL)
  WINDOW h AS (PARTITION BY tag_name ORDER BY question_year))"""

_GROWTH_CLASS = GROWTH_SQL.format("yoy_growth_rate_pct")
RELATIONS["x_m1"] = f"SELECT *, {_GROWTH_CLASS} AS growth_classification FROM x_growth"


def _held(expr: str) -> str:
    return f"least(greatest(coalesce({expr}, 0), -100), 200)"


def _scaled(col: str) -> str:
    return r(f"({col} - min({col}) OVER ()) * CAST(100 AS DOUBLE) / nullif(max({col}) OVER () - min({col}) OVER (), 0)", 2)


RELATIONS["x_norm"] = f"""
SELECT g.*, tag_category, {_scaled("question_count")} AS norm_volume, {_scaled("avg_engagement")} AS norm_engagement,
  {r(f"({_held('yoy_growth_rate_pct')} + 100) * CAST(100 AS DOUBLE) / 300", 2)} AS norm_growth,
  {r(f"({_held('contributor_growth_rate_pct')} + 100) * CAST(100 AS DOUBLE) / 300", 2)} AS norm_contributor_growth
FROM x_growth g LEFT JOIN x_dt d ON d.tag_name = g.tag_name
WHERE question_year = (SELECT max(question_year) - 1 FROM x_growth) AND question_count >= 100"""

_POPULAR = r("CAST(0.4 AS DOUBLE) * norm_volume + CAST(0.3 AS DOUBLE) * norm_growth + CAST(0.2 AS DOUBLE) * "
             "norm_engagement + CAST(0.1 AS DOUBLE) * norm_contributor_growth", 2)

RELATIONS["x_m2"] = f"""
SELECT tag_name, tag_category, popularity_score, question_count, yoy_growth_rate_pct, avg_engagement,
  contributor_growth_rate_pct, distinct_contributors, answer_rate_pct, rank_by_volume_in_year, popularity_rank,
  rank() OVER (PARTITION BY tag_category ORDER BY popularity_score DESC NULLS LAST) AS rank_within_category,
  {TREND_SQL.format("popularity_rank")} AS trend_tier
FROM (SELECT *, rank() OVER (ORDER BY popularity_score DESC NULLS LAST) AS popularity_rank
  FROM (SELECT *, {_POPULAR} AS popularity_score FROM x_norm))"""

RELATIONS["x_gaps"] = f"""
SELECT *, {share("unanswered_questions", "total_questions")} AS unanswered_pct,
  {share("accepted_answer_questions", "total_questions")} AS acceptance_rate_pct,
  {share("answered_questions", "total_questions")} AS answer_rate_pct,
  {r('''CAST(total_views AS DOUBLE) / 1000000 * (CAST(100 AS DOUBLE) * unanswered_questions
     / nullif(total_questions, 0))''', 2)} AS knowledge_gap_score
FROM (SELECT tag_name, count(DISTINCT question_id) AS total_questions,
    count(*) FILTER (answer_count = 0) AS unanswered_questions, count(*) FILTER (answer_count > 0) AS answered_questions,
    count(*) FILTER (has_accepted_answer) AS accepted_answer_questions,
    {r("avg(answer_count)", 2)} AS avg_answers_per_question, {r("avg(score)", 2)} AS avg_question_score,
    {r("avg(view_count)", 0)} AS avg_view_count, count(DISTINCT user_id) AS distinct_askers,
    {big("sum(view_count)")} AS total_views
  FROM x_tagged GROUP BY tag_name HAVING count(DISTINCT question_id) >= 50)"""

RELATIONS["x_m3"] = """
SELECT *, rank() OVER (ORDER BY unanswered_questions DESC) AS rank_by_unanswered_count,
  rank() OVER (ORDER BY unanswered_questions / CAST(total_questions AS DOUBLE) DESC) AS rank_by_unanswered_pct
FROM x_gaps"""

_CONTRIB = r("CAST(3 AS DOUBLE) * total_answers + CAST(5 AS DOUBLE) * accepted_answers + CAST(0.01 AS DOUBLE) * "
             "reputation + CAST(0.5 AS DOUBLE) * total_answer_score", 2)

RELATIONS["x_profiles"] = f"""
SELECT u.user_id, display_name, reputation, reputation_bucket, account_creation_date_date, account_age_days,
  is_active, c.* EXCLUDE (user_id), {share("accepted_answers", "total_answers")} AS acceptance_rate_pct,
  {share("active_months", f"date_diff('month', account_creation_date_date, DATE '{fx.AS_OF}')")}
    AS activity_consistency_pct,
  {_CONTRIB} AS contribution_score
FROM ({_COMBINED}) c JOIN x_du u ON u.user_id = c.user_id WHERE total_answers > 0"""

RELATIONS["x_m4"] = """
SELECT *, rank() OVER (ORDER BY accepted_answers DESC) AS rank_by_accepted_answers,
  rank() OVER (ORDER BY total_answers DESC) AS rank_by_total_answers,
  rank() OVER (ORDER BY reputation DESC) AS rank_by_reputation,
  dense_rank() OVER (ORDER BY contribution_score DESC) AS rank_by_contribution_score,
  ntile(10) OVER t AS contributor_decile, ntile(100) OVER t AS contributor_percentile_bucket
FROM x_profiles WINDOW t AS (ORDER BY total_answers DESC, user_id)"""

RELATIONS["x_m5"] = f"""
SELECT activity_month, total_active_contributors, new_contributors, retained_contributors,
  returned_contributors, avg_posts_per_contributor, total_posts,
  {share("retained_contributors", "lag(total_active_contributors) OVER m")} AS month_over_month_retention_pct,
  new_contributors - (lag(total_active_contributors) OVER m - retained_contributors) AS net_new_contributors,
  {r("avg(total_active_contributors) OVER (m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", 0)}
    AS rolling_3m_avg_contributors
FROM (SELECT activity_month, count(DISTINCT user_id) AS total_active_contributors,
    count(*) FILTER (contributor_type = 'New') AS new_contributors,
    count(*) FILTER (contributor_type = 'Retained') AS retained_contributors,
    count(*) FILTER (contributor_type = 'Returned') AS returned_contributors,
    {r("avg(total_monthly_posts)", 2)} AS avg_posts_per_contributor,
    {big("sum(total_monthly_posts)")} AS total_posts FROM ({_COHORT}) GROUP BY 1)
WINDOW m AS (ORDER BY activity_month)"""


def _latency(day_or_time: str) -> str:
    def hours(event):
        return r(f"date_sub('minute', q.creation_timestamp, CAST({event} AS TIMESTAMP)) / CAST(60 AS DOUBLE)", 2)
    return f"""
SELECT q.question_id, q.creation_date AS question_date, q.tags_clean, first_answer_date, accepted_answer_date,
  {hours("first_answer_date")} AS hours_to_first_answer, {hours("accepted_answer_date")} AS hours_to_accepted_answer
FROM x_fq q LEFT JOIN (SELECT question_id, min({day_or_time}) AS first_answer_date,
    min({day_or_time}) FILTER (accepted_answer_flag = 1) AS accepted_answer_date FROM x_fa GROUP BY 1) a
  ON a.question_id = q.question_id WHERE q.tags_clean <> ''"""


def _latency_by_tag(rows: str) -> str:
    h, a = "hours_to_first_answer", "hours_to_accepted_answer"
    return f"""
SELECT tag_name, total_questions, questions_with_answers, {r("mean_hours", 2)} AS avg_hours_to_first_answer,
  {r("middle", 2)} AS median_hours_to_first_answer, {r("mean_accepted", 2)} AS avg_hours_to_accepted_answer,
  {r("least_hours", 2)} AS min_hours_to_first_answer, {r("most_hours", 2)} AS max_hours_to_first_answer,
  {share("questions_with_answers", "total_questions")} AS answer_rate_pct,
  rank() OVER (ORDER BY mean_hours ASC NULLS FIRST) AS rank_fastest_community
FROM (SELECT lower(trim(part)) AS tag_name, count(*) AS total_questions, count({h}) AS questions_with_answers,
    avg({h}) AS mean_hours, avg({a}) AS mean_accepted, quantile_cont({h}, 0.5) FILTER ({h} >= 0) AS middle,
    min({h}) FILTER ({h} > 0) AS least_hours, max({h}) FILTER ({h} < 10000) AS most_hours
  FROM (SELECT *, unnest(string_split(tags_clean, '|')) AS part FROM ({rows})) WHERE trim(part) <> ''
  GROUP BY 1 HAVING count(*) >= 100)"""


RELATIONS["x_latency"] = _latency("creation_date")
RELATIONS["x_latency_exact"] = _latency("creation_timestamp")
RELATIONS["x_m6"] = _latency_by_tag("FROM x_latency")

RELATIONS["x_scores"] = f"""
SELECT g.tag_name, tag_category, total_questions, g.answer_rate_pct, acceptance_rate_pct, unanswered_pct,
  avg_hours_to_first_answer, median_hours_to_first_answer, yoy_growth_rate_pct, contributor_growth_rate_pct,
  avg_engagement, distinct_contributors, question_count AS annual_questions, rank_by_volume_in_year,
  CAST(least(coalesce(g.answer_rate_pct, 0), 100) AS DOUBLE) AS response,
  CAST(least(coalesce(acceptance_rate_pct, 0), 100) AS DOUBLE) AS acceptance,
  greatest(0, 100 - least(100, coalesce(avg_hours_to_first_answer, 100) * (CAST(100 AS DOUBLE) / 72))) AS speed,
  least(100, greatest(0, 50 + coalesce(yoy_growth_rate_pct, 0) / CAST(2 AS DOUBLE))) AS growth,
  least(100, greatest(0, coalesce(avg_engagement, 0) * 10)) AS engagement
FROM x_gaps g LEFT JOIN (SELECT tag_name, avg_hours_to_first_answer, median_hours_to_first_answer FROM x_m6) l
    ON l.tag_name = g.tag_name
  LEFT JOIN (SELECT * EXCLUDE (answer_rate_pct) FROM x_growth
    WHERE question_year = year(DATE '{fx.AS_OF}') - 1) y ON y.tag_name = g.tag_name
  LEFT JOIN x_dt d ON d.tag_name = g.tag_name
WHERE total_questions >= 100"""

_HEALTH = r("CAST(0.25 AS DOUBLE) * response + CAST(0.25 AS DOUBLE) * acceptance + CAST(0.2 AS DOUBLE) * speed + "
            "CAST(0.2 AS DOUBLE) * growth + CAST(0.1 AS DOUBLE) * engagement", 2)

RELATIONS["x_m7"] = f"""
SELECT * EXCLUDE (response, acceptance, speed, growth, engagement), {r("response", 2)} AS response_rate_score,
  {r("acceptance", 2)} AS acceptance_rate_score, {r("speed", 2)} AS speed_score, {r("growth", 2)} AS growth_score,
  {r("engagement", 2)} AS engagement_score,
  {HEALTH_SQL.format("community_health_score")} AS health_classification,
  rank() OVER (ORDER BY community_health_score DESC NULLS LAST) AS health_rank
FROM (SELECT *, {_HEALTH} AS community_health_score FROM x_scores)"""

# ------------------------------------------------------------------------ marts
query("mart_tag_growth", "FROM x_m1")(lambda x: marts.tag_growth(x.fact_questions, fx.MIN_YEAR))
query("growth_classification", "SELECT question_year, tag_name, growth_classification FROM x_m1")(
    lambda x: marts.tag_growth(x.fact_questions, fx.MIN_YEAR).select(
        "question_year", "tag_name", "growth_classification"))

query("mart_trending_technologies", "FROM x_m2")(lambda x: marts.trending(x.keep("fact_questions", "growth").growth, x.dim_tag))
query("trend_tier", "SELECT tag_name, popularity_rank, trend_tier FROM x_m2")(
    lambda x: marts.trending(x.keep("fact_questions", "growth").growth, x.dim_tag).select("tag_name", "popularity_rank", "trend_tier"))


def _normalised(x: Inputs):
    latest = marts.analysis_slice(x.keep("fact_questions", "growth").growth, x.dim_tag)
    return marts.normalised_metrics(stored(latest))


_NORM = ["norm_volume", "norm_growth", "norm_engagement", "norm_contributor_growth"]
query("normalised_metrics", f"SELECT tag_name, {', '.join(_NORM)} FROM x_norm")(
    lambda x: _normalised(x).select("tag_name", *_NORM))
query("popularity_score", f"SELECT tag_name, {_POPULAR} AS popularity_score FROM x_norm")(
    lambda x: _normalised(x).select("tag_name", marts.popularity_score().alias("popularity_score")))

query("mart_unanswered_questions", "FROM x_m3")(lambda x: marts.unanswered(x.fact_questions))
query("knowledge_gap_score", "SELECT tag_name, knowledge_gap_score FROM x_gaps")(
    lambda x: marts.tag_answer_stats(x.fact_questions).select(
        "tag_name", knowledge_gap().alias("knowledge_gap_score")))

query("mart_top_contributors", "FROM x_m4")(
    lambda x: marts.top_contributors(x.keep("stg_questions").fact_answers, x.fact_questions, x.dim_user, fx.AS_OF))
query("mart_top_contributors_distributed", "FROM x_m4")(
    lambda x: marts.top_contributors(x.keep("stg_questions").fact_answers, x.fact_questions, x.dim_user, fx.AS_OF,
                                     small_lookup=0))
query("contributor_combined", _COMBINED)(lambda x: marts.contributor_combined(x.keep("stg_questions").fact_answers, x.fact_questions))
query("contribution_score", "SELECT user_id, contribution_score FROM x_profiles")(
    lambda x: marts.contributor_combined(x.keep("stg_questions").fact_answers, x.fact_questions).filter("total_answers >= 1")
    .join(x.dim_user.select("user_id", "reputation"), "user_id")
    .select("user_id", contribution_score().alias("contribution_score")))
query("activity_consistency", "SELECT user_id, activity_consistency_pct FROM x_profiles")(
    lambda x: marts.contributor_profiles(marts.contributor_combined(x.keep("stg_questions").fact_answers, x.fact_questions),
                                         x.dim_user, fx.AS_OF).select("user_id", "activity_consistency_pct"))

query("mart_contributor_retention", "FROM x_m5")(lambda x: marts.contributor_retention(x.keep("stg_questions").user_activity))
query("mart_contributor_retention_bitmaps", "FROM x_m5")(
    lambda x: marts.retention_of_bitmaps(stored(marts.month_bitmaps(x.keep("stg_questions").user_activity))))
query("retention_of_events", """
SELECT user_id, CAST(date_trunc('month', activity_date) AS DATE) AS activity_month,
  CAST(sum(questions_posted) AS BIGINT) AS monthly_questions, CAST(sum(answers_posted) AS BIGINT) AS monthly_answers,
  CAST(sum(total_posts) AS BIGINT) AS total_monthly_posts FROM x_activity WHERE user_id > 0 GROUP BY ALL""")(
    lambda x: marts.monthly_activity(x.src_activity).drop("peak_daily_engagement"))

query("question_latency", "FROM x_latency")(lambda x: marts.question_latency(x.keep("stg_questions").fact_questions, x.fact_answers))
query("question_latency_exact", "FROM x_latency_exact")(
    lambda x: marts.question_latency(x.keep("stg_questions").fact_questions, x.fact_answers, use_timestamps=True))
query("mart_answer_latency", "FROM x_m6")(
    lambda x: marts.answer_latency(x.keep("stg_questions").fact_questions, x.fact_answers, exact=True))
query("mart_answer_latency_exact_times", _latency_by_tag("FROM x_latency_exact"))(
    lambda x: marts.answer_latency(x.keep("stg_questions").fact_questions, x.fact_answers, exact=True, use_timestamps=True))
query("mart_answer_latency_approx", _latency_by_tag("FROM x_latency").replace("quantile_cont", "quantile_disc"))(lambda x: marts.answer_latency(x.keep("stg_questions").fact_questions, x.fact_answers))


def _health_parts(x: Inputs):
    fq = x.keep("stg_questions").fact_questions
    return (marts.tag_answer_stats(fq), marts.tag_latency_stats(fq, x.fact_answers, exact=True),
            x.growth, x.dim_tag, fx.AS_OF)


query("mart_community_health", "FROM x_m7")(lambda x: marts.community_health(*_health_parts(x)))
query("health_classification", "SELECT tag_name, health_classification FROM x_m7")(
    lambda x: marts.community_health(*_health_parts(x)).select("tag_name", "health_classification"))
query("health_star_join", """
SELECT tag_name, tag_category, total_questions, answer_rate_pct, avg_hours_to_first_answer, yoy_growth_rate_pct,
  annual_questions FROM x_scores""")(
    lambda x: marts.health_inputs(*_health_parts(x)).select(
        "tag_name", "tag_category", "total_questions", "answer_rate_pct", "avg_hours_to_first_answer",
        "yoy_growth_rate_pct", "annual_questions"))
query("community_health_score", f"SELECT tag_name, {_HEALTH} AS community_health_score FROM x_scores")(
    lambda x: marts.health_scores(marts.health_inputs(*_health_parts(x))).select(
        "tag_name", "community_health_score"))

# --------------------------------------------------------------------- sketches
@query("distinct_askers_by_sketch", """
SELECT tag_name, year(creation_date) AS question_year, count(DISTINCT user_id) AS exact, true AS within_bound FROM x_tagged GROUP BY 1, 2
UNION ALL SELECT tag_name, NULL, count(DISTINCT user_id), true FROM x_tagged GROUP BY 1""")
def askers_by_sketch(x: Inputs):
    """Exact distinct askers of every tag and year, and of all time, and whether united monthly sketches are within four standard errors."""
    fq = x.keep("fact_questions").fact_questions
    sketches = stored(marts.asker_sketches(fq))
    pairs = explode_tags(fq.withColumn("question_year", F.year("creation_date").cast("long")), ["question_year", "user_id"])
    exact = pairs.groupBy("tag_name", "question_year").agg(F.count_distinct("user_id").alias("exact")).unionByName(
        pairs.groupBy("tag_name").agg(F.count_distinct("user_id").alias("exact")).withColumn("question_year", F.lit(None).cast("long")))
    year = F.year("month").cast("long").alias("question_year")
    guess = marts.distinct_askers(sketches, year).unionByName(
        marts.distinct_askers(sketches).withColumn("question_year", F.lit(None).cast("long")))
    both = exact.join(guess.withColumnsRenamed({"tag_name": "_tag", "question_year": "_year"}),
                      (F.col("tag_name") == F.col("_tag")) & F.col("question_year").eqNullSafe(F.col("_year")), "left")
    error = 4 * 1.04 / 2 ** (marts.HLL_LOG / 2)
    return both.select("tag_name", "question_year", "exact", F.coalesce(
        F.abs(F.col("distinct_askers") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * error), F.lit(False)).alias("within_bound"))


@query("median_latency_by_sketch", """
SELECT tag_name, count(hours_to_first_answer) FILTER (hours_to_first_answer >= 0) AS n, true AS within_bound
FROM (SELECT *, lower(trim(part)) AS tag_name FROM (SELECT *, unnest(string_split(tags_clean, '|')) AS part FROM x_latency) WHERE trim(part) <> '')
GROUP BY 1 HAVING count(hours_to_first_answer) FILTER (hours_to_first_answer >= 0) > 0""")
def latency_by_sketch(x: Inputs):
    """Whether the median from merged monthly sketches stands within 3 % of the middle rank of every tag's exact values."""
    latency = stored(marts.question_latency(x.keep("stg_questions").fact_questions, x.fact_answers))
    guess = marts.median_hours(stored(marts.latency_sketches(latency)))
    values = explode_tags(latency.filter("hours_to_first_answer >= 0"), ["hours_to_first_answer"])
    h, m = F.col("hours_to_first_answer"), F.col("median_hours")
    ranked = values.join(F.broadcast(guess), "tag_name", "left").groupBy("tag_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(h < m).alias("below"), F.count_if(h <= m).alias("upto"))
    return ranked.select("tag_name", "n", ((F.col("below") <= F.col("n") * 0.53 + 1) & (F.col("upto") >= F.col("n") * 0.47 - 1)).alias("within_bound"))


# ------------------------------------------------------------------------- KPIs
query("kpi_01_platform_overview", f"""
SELECT (SELECT count(DISTINCT question_id) FROM x_fq) AS total_questions,
  (SELECT count(DISTINCT answer_id) FROM x_fa) AS total_answers,
  (SELECT count(DISTINCT user_id) FROM x_du WHERE user_id > 0) AS total_registered_users,
  (SELECT count(DISTINCT user_id) FROM x_du WHERE user_id > 0 AND is_active) AS active_users_last_365_days,
  (SELECT count(DISTINCT tag_name) FROM x_dt) AS total_distinct_technologies,
  (SELECT {share("count_if(answer_count > 0)", "count(*)")} FROM x_fq) AS platform_answer_rate_pct,
  (SELECT {share("count_if(has_accepted_answer)", "count(*)")} FROM x_fq) AS platform_acceptance_rate_pct,
  (SELECT {r("avg(engagement_score)", 2)} FROM x_fq) AS avg_question_engagement_score,
  (SELECT max(creation_date) FROM x_fq) AS last_question_date,
  (SELECT max(creation_date) FROM x_fa) AS last_answer_date,
  TIMESTAMP '{fx.AS_OF} 00:00:00' AS report_generated_at""")(
    lambda x: kpis.platform_overview(x.keep("stg_questions").fact_questions, x.fact_answers, x.dim_user, x.dim_tag, fx.AS_OF))

_LATEST = "question_year = (SELECT max(question_year) - 1 FROM x_m1)"
_G = "tag_name, question_year, question_count, prior_year_question_count, yoy_growth_rate_pct, growth_classification"
query("kpi_02_fastest_growing", f"""
SELECT {_G} FROM x_m1 WHERE {_LATEST} AND yoy_growth_rate_pct IS NOT NULL
ORDER BY yoy_growth_rate_pct DESC, tag_name LIMIT 10""")(lambda x: kpis.fastest_growing(x.keep("growth").growth))
query("kpi_03_declining", f"""
SELECT {_G} FROM x_m1 WHERE {_LATEST} AND yoy_growth_rate_pct < 0
ORDER BY yoy_growth_rate_pct, tag_name LIMIT 10""")(lambda x: kpis.declining(x.keep("growth").growth))
query("kpi_04_highest_engagement", f"""
SELECT tag_name, question_year, avg_engagement, question_count, answer_rate_pct FROM x_m1 WHERE {_LATEST}
ORDER BY avg_engagement DESC, tag_name LIMIT 10""")(lambda x: kpis.highest_engagement(x.keep("growth").growth))
query("kpi_05_highest_unanswered", """
SELECT tag_name, total_questions, unanswered_questions, unanswered_pct, knowledge_gap_score FROM x_gaps
ORDER BY unanswered_pct DESC, tag_name LIMIT 10""")(
    lambda x: kpis.highest_unanswered(marts.tag_answer_stats(x.fact_questions)))
query("kpi_06_top_contributors", """
SELECT user_id, display_name, reputation, total_answers, accepted_answers, contribution_score,
  rank_by_contribution_score FROM x_m4 ORDER BY contribution_score DESC, user_id LIMIT 10""")(
    lambda x: kpis.leading_contributors(
        marts.top_contributors(x.keep("stg_questions").fact_answers, x.fact_questions, x.dim_user, fx.AS_OF)))
query("kpi_07_healthiest", """
SELECT tag_name, community_health_score, health_classification, health_rank FROM x_m7
ORDER BY health_rank, tag_name LIMIT 10""")(lambda x: kpis.healthiest(marts.community_health(*_health_parts(x))))
query("kpi_08_retention_trend", """
SELECT activity_month, total_active_contributors, retained_contributors, month_over_month_retention_pct,
  rolling_3m_avg_contributors FROM x_m5""")(
    lambda x: kpis.retention_trend(marts.contributor_retention(x.keep("stg_questions").user_activity)))
query("kpi_09_emerging", """
SELECT tag_name, min(question_year) AS first_year, CAST(sum(question_count) AS BIGINT) AS total_questions FROM x_m1
GROUP BY 1 HAVING min(question_year) > (SELECT max(question_year) FROM x_m1) - 7""")(
    lambda x: kpis.emerging(x.keep("growth").growth, years=7))
query("kpi_10_losing_popularity", """
SELECT tag_name, question_year, question_count, yoy_growth_rate_pct, prior_growth_rate_pct FROM (
  SELECT *, lag(yoy_growth_rate_pct) OVER (PARTITION BY tag_name ORDER BY question_year) AS prior_growth_rate_pct
  FROM x_m1) WHERE yoy_growth_rate_pct < 0 AND prior_growth_rate_pct < 0""")(
    lambda x: kpis.losing_popularity(x.keep("growth").growth))
