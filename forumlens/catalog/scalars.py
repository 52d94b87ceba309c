"""Predicates, classifications, scalar functions and score formulas as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar, labels, numbers, text
from ..operators.merge import changed
from ..plans import staging
from ..sources import fixtures as fx
from ..sources import ingest as ing
from .base import (ENGAGE_A, ENGAGE_Q, TAGS_SQL, Inputs, REP, ACCOUNT_AGE_SQL, REPUTATION_SQL, REPUTATION_STEP_SQL, big, category_sql,
                   in_time, query, r, share, tier_sql)

query("null_defaults", """
SELECT id, coalesce(owner_user_id, -1) AS owner_user_id, coalesce(favorite_count, 0) AS favorite_count,
  coalesce(view_count, 0) AS view_count, coalesce(title, 'Untitled Question') AS title FROM x_raw_q""")(
    lambda x: x.raw_questions.select(
        "id", numbers.whole("owner_user_id", -1).alias("owner_user_id"),
        numbers.whole("favorite_count", 0).alias("favorite_count"),
        numbers.whole("view_count", 0).alias("view_count"),
        F.coalesce("title", F.lit("Untitled Question")).alias("title")))

query("validity_filter_questions", f"""
SELECT id, creation_date, score, view_count FROM x_raw_q
WHERE {in_time(fx.AS_OF)} AND coalesce(view_count, 0) >= 0 AND coalesce(score, 0) > -10000""")(
    lambda x: staging.valid(x.raw_questions, staging.question_rules(fx.FLOOR, fx.AS_OF)).select(
        "id", "creation_date", "score", "view_count"))

query("validity_filter_answers", f"""
SELECT id, parent_id, creation_date, score FROM x_raw_a
WHERE {in_time(fx.AS_OF)} AND parent_id IS NOT NULL AND coalesce(score, 0) > -10000""")(
    lambda x: staging.valid(x.raw_answers, staging.answer_rules(fx.FLOOR, fx.AS_OF)).select(
        "id", "parent_id", "creation_date", "score"))

query("validity_filter_users", f"""
SELECT id, reputation, creation_date FROM x_raw_u
WHERE id > 0 AND {in_time(fx.AS_OF)} AND {REP} BETWEEN 1 AND 2000000""")(
    lambda x: staging.valid(x.raw_users, staging.user_rules(fx.FLOOR, fx.AS_OF)).select(
        "id", "reputation", "creation_date"))

query("trim_text", """
SELECT id, trim(coalesce(title, 'Untitled Question')) AS title FROM x_raw_q""")(
    lambda x: x.raw_questions.select("id", text.text_or("title", "Untitled Question").alias("title")))

query("answered_flags", """
SELECT id, coalesce(answer_count > 0, false) AS is_answered,
  accepted_answer_id IS NOT NULL AS has_accepted_answer FROM x_raw_q""")(
    lambda x: staging.answered_flags(x.raw_questions).select("id", "is_answered", "has_accepted_answer"))

query("score_sentiment", """
SELECT id, score, CASE sign(coalesce(score, 0)) WHEN 1 THEN 'positive' WHEN 0 THEN 'neutral'
  ELSE 'negative' END AS score_sentiment FROM x_raw_a""")(
    lambda x: x.raw_answers.select("id", "score", labels.score_sentiment("score").alias("score_sentiment")))

query("reputation_bucket", f"""
SELECT id, {REPUTATION_SQL.format(REP)} AS reputation_bucket,
  {big(REPUTATION_STEP_SQL.format(REP))} AS reputation_bucket_ordinal FROM x_raw_u""")(
    lambda x: x.raw_users.select("id", labels.reputation_bucket("reputation").alias("reputation_bucket"),
                                 labels.reputation_ordinal("reputation").alias("reputation_bucket_ordinal")))

query("is_active_flag", f"""
SELECT id, coalesce(date_diff('day', CAST(last_access_date AS DATE), DATE '{fx.AS_OF}') < 366, false)
  AS is_active FROM x_raw_u""")(
    lambda x: x.raw_users.select("id", labels.is_active("last_access_date", fx.AS_OF).alias("is_active")))

query("account_age_days", f"""
SELECT id, date_diff('day', CAST(creation_date AS DATE), DATE '{fx.AS_OF}') AS account_age_days
FROM x_raw_u""")(
    lambda x: x.raw_users.select(
        "id", calendar.age_days(F.to_date("creation_date"), fx.AS_OF).alias("account_age_days")))

query("account_age_bucket", f"""
SELECT user_id, account_age_days,
  {ACCOUNT_AGE_SQL.format("account_age_days")}
  AS account_age_bucket FROM x_stg_u""")(
    lambda x: x.stg_users.select("user_id", "account_age_days",
                                 labels.account_age_bucket("account_age_days").alias("account_age_bucket")))

query("quality_tier", f"SELECT id, score, {tier_sql()} AS quality_tier FROM x_raw_q")(
    lambda x: x.raw_questions.select("id", "score", labels.quality_tier("score").alias("quality_tier")))

query("tag_category", f"SELECT DISTINCT tag_name, {category_sql('tag_name')} AS tag_category FROM x_tagged")(
    lambda x: x.dim_tag.select("tag_name", "tag_category"))

query("score_bounds_clamp", """
SELECT id, CAST(CASE WHEN score IS NULL OR score < -5 THEN CASE WHEN score IS NULL THEN 0 ELSE -5 END
  WHEN score > 20 THEN 20 ELSE score END AS DOUBLE) AS bounded,
  CAST(CASE WHEN coalesce(favorite_count, 0) > 3 THEN 3 ELSE coalesce(favorite_count, 0) END AS DOUBLE)
  AS capped FROM x_raw_q""")(
    lambda x: x.raw_questions.select("id", numbers.clamp("score", -5, 20).alias("bounded"),
                                     numbers.clamp("favorite_count", hi=3).alias("capped")))

query("null_safe_change", """
SELECT e.id, coalesce(e.score <> s.score, false) OR coalesce(e.favorite_count <> s.favorite_count, false)
  OR e.accepted_answer_id IS DISTINCT FROM s.accepted_answer_id AS has_changed
FROM x_early_q e JOIN x_src_q s ON s.id = e.id""")(
    lambda x: _changes(x))


def _changes(x: Inputs):
    cols = ["id", "score", "favorite_count", "accepted_answer_id"]
    old = fx.questions_earlier(x.spark, x.sf_dir).select(*[F.col(c).alias("t_" + c) for c in cols])
    new = x.src_questions.select(*[F.col(c).alias("s_" + c) for c in cols])
    return old.join(new, F.col("t_id") == F.col("s_id")).select(
        F.col("t_id").alias("id"),
        changed(["score", "favorite_count"], ["accepted_answer_id"]).alias("has_changed"))


query("between_filter", """
SELECT question_id, creation_date FROM x_fq
WHERE creation_date >= DATE '1998-03-01' AND creation_date <= DATE '1998-03-31'""")(
    lambda x: x.fact_questions.filter(F.col("creation_date").between("1998-03-01", "1998-03-31"))
    .select("question_id", "creation_date"))

# --------------------------------------------------------------- text and tags
query("tags_clean", f"SELECT id, {TAGS_SQL} AS tags_clean FROM x_raw_q")(
    lambda x: x.raw_questions.select("id", text.tags_clean("tags").alias("tags_clean")))

query("tag_count", f"SELECT id, {big(f'len(string_split({TAGS_SQL}, chr(124)))')} AS tag_count FROM x_raw_q")(
    lambda x: x.raw_questions.select("id", text.tag_count(text.tags_clean("tags")).alias("tag_count")))

query("primary_tag", f"SELECT id, string_split({TAGS_SQL}, '|')[1] AS primary_tag FROM x_raw_q")(
    lambda x: x.raw_questions.select("id", text.primary_tag(text.tags_clean("tags")).alias("primary_tag")))

query("text_functions", """
SELECT id, lower(trim(display_name)) AS handle, concat('user-', CAST(id AS VARCHAR)) AS label
FROM x_raw_u""")(
    lambda x: x.raw_users.select("id", text.normal_tag("display_name").alias("handle"),
                                 F.concat(F.lit("user-"), F.col("id").cast("string")).alias("label")))

query("cast_functions", """
SELECT id, CAST(score AS DOUBLE) AS score_float, CAST(score AS VARCHAR) AS score_text,
  CAST(creation_date AS DATE) AS creation_day, nullif(score, 0) AS score_or_null FROM x_raw_q""")(
    lambda x: x.raw_questions.select(
        "id", F.col("score").cast("double").alias("score_float"), F.col("score").cast("string").alias("score_text"),
        F.to_date("creation_date").alias("creation_day"), F.nullif("score", F.lit(0).cast("long")).alias("score_or_null")))

# ------------------------------------------------------------------- calendar
query("date_parts", """
SELECT id, year(creation_date) AS y, month(creation_date) AS m, quarter(creation_date) AS q,
  day(creation_date) AS d, CAST(strftime(creation_date, '%U') AS BIGINT) AS week_sunday,
  weekofyear(creation_date) AS week_iso, dayofweek(creation_date) + 1 AS weekday,
  CAST(strftime(creation_date, '%Y%m%d') AS BIGINT) AS date_key,
  CAST(date_trunc('month', creation_date) AS DATE) AS month_start FROM x_raw_q""")(
    lambda x: x.raw_questions.withColumn("c", F.to_date("creation_date")).select(
        "id", F.year("c").cast("long").alias("y"), F.month("c").cast("long").alias("m"),
        F.quarter("c").cast("long").alias("q"), F.dayofmonth("c").cast("long").alias("d"),
        calendar.week_from_sunday("c").alias("week_sunday"), F.weekofyear("c").cast("long").alias("week_iso"),
        F.dayofweek("c").cast("long").alias("weekday"), calendar.date_key("c").alias("date_key"),
        calendar.month_of("c").alias("month_start")))

query("date_format_labels", """
SELECT id, strftime(creation_date, '%B %b %A %a %Y-%m') AS label FROM x_raw_q""")(
    lambda x: x.raw_questions.select(
        "id", F.date_format(F.to_date("creation_date"), "MMMM MMM EEEE E yyyy-MM").alias("label")))

query("date_add_sub", """
SELECT id, CAST(creation_date AS DATE) + 2 AS plus_two, CAST(creation_date AS DATE) - 2 AS minus_two,
  date_diff('day', CAST(creation_date AS DATE), CAST(last_activity_date AS DATE)) AS days_open FROM x_raw_q""")(
    lambda x: x.raw_questions.withColumn("c", F.to_date("creation_date")).select(
        "id", F.date_add("c", 2).alias("plus_two"), F.date_sub("c", 2).alias("minus_two"),
        F.datediff(F.to_date("last_activity_date"), "c").cast("long").alias("days_open")))

query("month_diff", """
SELECT id, date_diff('month', CAST(creation_date AS DATE), CAST(last_activity_date AS DATE)) AS months
FROM x_raw_q""")(
    lambda x: x.raw_questions.select(
        "id", calendar.month_diff(F.col("last_activity_date"), F.col("creation_date")).alias("months")))

query("hours_between", f"""
SELECT a.id, {r("date_sub('minute', q.creation_date, a.creation_date) / CAST(60 AS DOUBLE)", 2)} AS hours
FROM x_raw_a a JOIN x_raw_q q ON q.id = a.parent_id""")(
    lambda x: x.raw_answers.select("id", "parent_id", F.col("creation_date").alias("answered_at"))
    .join(x.raw_questions.select(F.col("id").alias("parent_id"), F.col("creation_date").alias("asked_at")),
          "parent_id")
    .select("id", calendar.hours_between("asked_at", "answered_at").alias("hours")))

query("numeric_functions", f"""
SELECT id, {r("ln(view_count + 1)", 4)} AS log_views, {r("view_count / CAST(7 AS DOUBLE)", 2)} AS sevenths,
  least(score, comment_count) AS low, greatest(score, comment_count) AS high FROM x_raw_q""")(
    lambda x: x.raw_questions.select(
        "id", numbers.rnd(F.ln(F.col("view_count") + 1), 4).alias("log_views"),
        numbers.rnd(F.col("view_count") / F.lit(7.0), 2).alias("sevenths"),
        F.least("score", "comment_count").alias("low"), F.greatest("score", "comment_count").alias("high")))

query("ratio_pct", f"SELECT id, {share('score', 'comment_count')} AS score_per_comment_pct FROM x_raw_q")(
    lambda x: x.raw_questions.select("id", numbers.pct("score", "comment_count").alias("score_per_comment_pct")))

# ------------------------------------------------------------------- formulas
query("question_engagement", f"SELECT id, {ENGAGE_Q} AS engagement_score FROM x_raw_q")(
    lambda x: x.raw_questions.select("id", numbers.question_engagement().alias("engagement_score")))

query("answer_engagement", f"SELECT id, {ENGAGE_A} AS engagement_score FROM x_raw_a")(
    lambda x: x.raw_answers.select("id", numbers.answer_engagement().alias("engagement_score")))

query("run_identifier", """
SELECT count(*) AS rows_stamped, CAST(1 AS BIGINT) AS identifiers FROM x_raw_q""")(
    # one identifier per run, the same on every row
    lambda x: ing.ingest(x.src_questions, ing.QUESTIONS, fx.AS_OF).agg(
        F.count("*").alias("rows_stamped"), F.count_distinct("_batch_id").alias("identifiers")))
