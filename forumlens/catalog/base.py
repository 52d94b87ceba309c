"""Registry, shared inputs of the queries, and the SQL relations the cross-checks build on."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import dimensions, facts, marts, staging
from ..session import shared_folder, stored
from ..sources import fixtures as fx
from ..sources import ingest as ing

BATCH = "check-run"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Inputs:
    """The layers over one set of tables, built lazily within one query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def scratch(self, name: str) -> str:
        return f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, *names: str) -> "Inputs":
        """Store the named relations once; whatever is derived later reads the stored copy."""
        for name in names:
            self.__dict__[name] = stored(getattr(self, name))
        return self

    # sources
    @cached_property
    def src_questions(self):
        return fx.questions(self.spark, self.sf_dir)

    @cached_property
    def src_answers(self):
        return fx.answers(self.spark, self.sf_dir)

    @cached_property
    def src_users(self):
        return fx.users(self.spark, self.sf_dir)

    @cached_property
    def src_activity(self):
        return fx.activity(self.spark, self.sf_dir)

    # raw
    @cached_property
    def raw_questions(self):
        return ing.ingest(self.src_questions, ing.QUESTIONS, fx.AS_OF, batch_id=BATCH)

    @cached_property
    def raw_answers(self):
        return ing.ingest(self.src_answers, ing.ANSWERS, fx.AS_OF, batch_id=BATCH)

    @cached_property
    def raw_users(self):
        return ing.ingest(self.src_users, ing.USERS, fx.AS_OF, batch_id=BATCH)

    # staging
    @cached_property
    def stg_questions(self):
        return staging.clean_questions(self.raw_questions, fx.AS_OF, fx.FLOOR)

    @cached_property
    def stg_answers(self):
        return staging.clean_answers(self.raw_answers, fx.AS_OF, fx.FLOOR)

    @cached_property
    def stg_users(self):
        return staging.clean_users(self.raw_users, fx.AS_OF, fx.FLOOR)

    # star schema
    @cached_property
    def dim_user(self):
        return dimensions.build_dim_user(self.stg_users, fx.AS_OF)

    @cached_property
    def dim_tag(self):
        return dimensions.build_dim_tag(self.fact_questions, fx.AS_OF)

    @cached_property
    def dim_date(self):
        return dimensions.calendar_columns(dimensions.spine_covering(self.fact_questions, "creation_date"))

    @cached_property
    def fact_questions(self):
        return facts.build_fact_questions(self.stg_questions)

    @cached_property
    def fact_answers(self):
        return facts.build_fact_answers(self.stg_answers, self.stg_questions)

    @cached_property
    def user_activity(self):
        return facts.build_user_activity(self.fact_questions, self.fact_answers)

    @cached_property
    def growth(self):
        return marts.tag_growth(self.fact_questions, fx.MIN_YEAR)


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under ``name`` with its cross-check."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_relations(sql)
        return fn
    return add


# ------------------------------------------------------------------ SQL helpers

def r(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def share(num: str, den: str, digits: int = 2) -> str:
    return r(f"CAST(100 AS DOUBLE) * ({num}) / NULLIF(CAST({den} AS DOUBLE), 0)", digits)


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def plain_source(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql)


# Fixed values as the published scripts state them, written out here apart from the engine's own.
REPUTATION_SQL = """CASE WHEN {0} < 500 THEN 'Beginner' WHEN {0} < 3000 THEN 'Intermediate' WHEN {0} < 10000 THEN 'Advanced'
  WHEN {0} < 50000 THEN 'Expert' ELSE 'Elite' END"""
REPUTATION_STEP_SQL = "CASE WHEN {0} < 500 THEN 1 WHEN {0} < 3000 THEN 2 WHEN {0} < 10000 THEN 3 WHEN {0} < 50000 THEN 4 ELSE 5 END"
ACCOUNT_AGE_SQL = """CASE WHEN {0} < 365 THEN 'New (< 1 year)' WHEN {0} < 1095 THEN 'Established (1-3 years)'
  WHEN {0} < 2555 THEN 'Veteran (3-7 years)' ELSE 'Long-term (7+ years)' END"""
GROWTH_SQL = """CASE WHEN {0} IS NULL THEN 'New/Baseline' WHEN {0} >= 50 THEN 'Explosive Growth' WHEN {0} >= 20 THEN 'Strong Growth'
  WHEN {0} >= 5 THEN 'Moderate Growth' WHEN {0} >= -5 THEN 'Stable' WHEN {0} >= -20 THEN 'Moderate Decline' ELSE 'Strong Decline' END"""
HEALTH_SQL = "CASE WHEN {0} >= 75 THEN 'Thriving' WHEN {0} >= 50 THEN 'Healthy' WHEN {0} >= 25 THEN 'Developing' ELSE 'At Risk' END"
TREND_SQL = """CASE WHEN {0} <= 10 THEN 'Top 10' WHEN {0} <= 25 THEN 'Top 25' WHEN {0} <= 50 THEN 'Top 50' WHEN {0} <= 100 THEN 'Top 100'
  ELSE 'Emerging' END"""
CATEGORY_SQL = """CASE
  WHEN {0} IN ('python', 'r', 'julia', 'matlab', 'scala', 'haskell', 'erlang') THEN 'Data/Scientific'
  WHEN {0} IN ('javascript', 'typescript', 'coffeescript', 'elm', 'purescript') THEN 'Web Frontend'
  WHEN {0} IN ('java', 'c#', 'kotlin', 'swift', 'objective-c', 'dart') THEN 'Application'
  WHEN {0} IN ('c', 'c++', 'rust', 'go', 'assembly', 'fortran') THEN 'Systems'
  WHEN {0} IN ('sql', 'mysql', 'postgresql', 'oracle', 'sqlite', 'bigquery', 'mongodb', 'redis', 'cassandra', 'elasticsearch') THEN 'Data/Database'
  WHEN {0} IN ('docker', 'kubernetes', 'terraform', 'ansible', 'jenkins', 'github-actions', 'aws', 'gcp', 'azure') THEN 'DevOps/Cloud'
  WHEN {0} IN ('react', 'angular', 'vue.js', 'svelte', 'next.js', 'gatsby') THEN 'Web Framework'
  WHEN {0} IN ('django', 'flask', 'fastapi', 'spring', 'rails', 'laravel', 'express', 'nestjs') THEN 'Backend Framework'
  WHEN {0} IN ('machine-learning', 'deep-learning', 'tensorflow', 'pytorch', 'scikit-learn', 'keras', 'nlp', 'computer-vision') THEN 'AI/ML'
  WHEN {0} IN ('android', 'ios', 'react-native', 'flutter', 'xamarin') THEN 'Mobile'
  ELSE 'Other' END"""


def columns(contract, missing: set[str] = frozenset()) -> str:
    """The contract's columns, those absent from the fixture as typed NULL."""
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    return ", ".join(
        f"CAST(NULL AS {kinds[f.dataType.simpleString()]}) AS {f.name}" if f.name in missing else f.name
        for f in contract.fields)


def with_relations(sql: str) -> str:
    """Prefix ``sql`` with the relations it names, directly or through others."""
    wanted: set[str] = set()

    def visit(text):
        for name in RELATIONS:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                visit(RELATIONS[name])
    visit(sql)
    # relations are declared in dependency order
    parts = [f"{n} AS ({RELATIONS[n]})" for n in RELATIONS if n in wanted]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql


from ..sources import schemas  # noqa: E402

Q_ABSENT = {f.name for f in schemas.POST.fields} - {
    "id", "title", "accepted_answer_id", "answer_count", "comment_count", "favorite_count", "creation_date",
    "last_activity_date", "owner_user_id", "post_type_id", "score", "view_count", "tags"}
A_ABSENT = {f.name for f in schemas.POST.fields} - {
    "id", "parent_id", "creation_date", "last_activity_date", "owner_user_id", "post_type_id", "score",
    "comment_count"}
U_ABSENT = {"about_me", "age", "website_url"}


def stamp_sql(source: str, load: str = "initial_load", at: str = fx.AS_OF, batch: str = BATCH) -> str:
    return (f"TIMESTAMP '{at} 00:00:00' AS _ingested_at, '{source}' AS _source_table, "
            f"'{batch}' AS _batch_id, '{load}' AS _load_type")


def raw_sql(kind: str, src: str, load: str = "initial_load", at: str = fx.AS_OF, batch: str = BATCH,
            since: str | None = None) -> str:
    contract, absent, source, rule, active = {
        "questions": (schemas.POST, Q_ABSENT, "posts_questions", "post_type_id = 1", "last_activity_date"),
        "answers": (schemas.POST, A_ABSENT, "posts_answers", "post_type_id = 2 AND parent_id IS NOT NULL",
                    "last_activity_date"),
        "users": (schemas.USER, U_ABSENT, "users", "id > 0", "last_access_date"),
    }[kind]
    later = f" AND {active} > TIMESTAMP '{since} 00:00:00'" if since else ""
    return (f"SELECT {columns(contract, absent)}, {stamp_sql(source, load, at, batch)} FROM {src} "
            f"WHERE {rule} AND id IS NOT NULL AND creation_date <= TIMESTAMP '{at} 00:00:00'{later}")


def ties(names) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in names)


def in_time(at: str) -> str:
    return f"creation_date BETWEEN TIMESTAMP '{fx.FLOOR} 00:00:00' AND TIMESTAMP '{at} 00:00:00'"


TAGS_SQL = "regexp_replace(replace(coalesce(tags, ''), '><', '|'), '[<>]', '', 'g')"


def stg_questions_sql(raw: str, at: str = fx.AS_OF) -> str:
    return f"""
SELECT id AS question_id, trim(coalesce(title, 'Untitled Question')) AS title,
  coalesce(owner_user_id, -1) AS owner_user_id, creation_date, CAST(creation_date AS DATE) AS question_date,
  last_activity_date, last_edit_date, year(creation_date) AS question_year,
  month(creation_date) AS question_month, quarter(creation_date) AS question_quarter,
  coalesce(score, 0) AS score, coalesce(view_count, 0) AS view_count,
  coalesce(answer_count, 0) AS answer_count, coalesce(comment_count, 0) AS comment_count,
  coalesce(favorite_count, 0) AS favorite_count, accepted_answer_id,
  coalesce(answer_count > 0, false) AS is_answered, accepted_answer_id IS NOT NULL AS has_accepted_answer,
  {TAGS_SQL} AS tags_clean, {big(f"len(string_split({TAGS_SQL}, '|'))")} AS tag_count,
  _ingested_at, _batch_id, TIMESTAMP '{at} 00:00:00' AS _staged_at
FROM (SELECT * FROM {raw} QUALIFY row_number() OVER (PARTITION BY id ORDER BY
  {ties(("last_activity_date", "_ingested_at") + staging.QUESTION_TIES)}) = 1)
WHERE {in_time(at)} AND coalesce(view_count, 0) >= 0 AND coalesce(score, 0) > -10000"""


def stg_answers_sql(raw: str, at: str = fx.AS_OF) -> str:
    return f"""
SELECT id AS answer_id, parent_id AS question_id, coalesce(owner_user_id, -1) AS owner_user_id,
  creation_date, CAST(creation_date AS DATE) AS answer_date, last_activity_date, last_edit_date,
  year(creation_date) AS answer_year, month(creation_date) AS answer_month,
  quarter(creation_date) AS answer_quarter, coalesce(score, 0) AS score,
  coalesce(comment_count, 0) AS comment_count, accepted_answer_id IS NOT NULL AS is_accepted_flag,
  CASE sign(coalesce(score, 0)) WHEN 1 THEN 'positive' WHEN 0 THEN 'neutral' ELSE 'negative' END
    AS score_sentiment, _ingested_at, _batch_id, TIMESTAMP '{at} 00:00:00' AS _staged_at
FROM (SELECT * FROM {raw} QUALIFY row_number() OVER (PARTITION BY id ORDER BY
  {ties(("last_activity_date", "_ingested_at") + staging.ANSWER_TIES)}) = 1)
WHERE {in_time(at)} AND parent_id IS NOT NULL AND coalesce(score, 0) > -10000"""


REP = "coalesce(reputation, 1)"


def stg_users_sql(raw: str, at: str = fx.AS_OF) -> str:
    return f"""
SELECT id AS user_id, trim(coalesce(display_name, 'Anonymous')) AS display_name,
  creation_date AS account_creation_date, CAST(creation_date AS DATE) AS account_creation_date_date,
  last_access_date, {big(f"DATE '{at}' - CAST(creation_date AS DATE)")} AS account_age_days,
  {REP} AS reputation, coalesce(up_votes, 0) AS up_votes, coalesce(down_votes, 0) AS down_votes,
  coalesce(views, 0) AS profile_views, trim(coalesce(location, 'Unknown')) AS location,
  {REPUTATION_SQL.format(REP)} AS reputation_bucket,
  {big(REPUTATION_STEP_SQL.format(REP))} AS reputation_bucket_ordinal,
  coalesce(DATE '{at}' - CAST(last_access_date AS DATE) <= 365, false) AS is_active,
  _ingested_at, _batch_id, TIMESTAMP '{at} 00:00:00' AS _staged_at
FROM (SELECT * FROM {raw} QUALIFY row_number() OVER (PARTITION BY id ORDER BY
  {ties(("last_access_date", "_ingested_at") + staging.USER_TIES)}) = 1)
WHERE id > 0 AND {in_time(at)} AND {REP} BETWEEN 1 AND 2000000"""


def tier_sql(score: str = "score") -> str:
    return (f"CASE WHEN {score} >= 10 THEN 'High Quality' WHEN {score} > 0 THEN 'Good' "
            f"WHEN {score} = 0 THEN 'Neutral' WHEN {score} < 0 THEN 'Low Quality' END")


def key_sql(d: str) -> str:
    return big(f"strftime({d}, '%Y%m%d')")


ENGAGE_Q = r("2 * coalesce(score, 0) + ln(coalesce(view_count, 0) + 1) + CAST(1.5 AS DOUBLE) * "
             "coalesce(answer_count, 0) + 2 * coalesce(favorite_count, 0)", 4)
ENGAGE_A = r("3 * coalesce(score, 0) + CAST(0.5 AS DOUBLE) * coalesce(comment_count, 0)", 4)


def fact_questions_sql(stg: str) -> str:
    return f"""
SELECT question_id, {key_sql("question_date")} AS date_key, coalesce(owner_user_id, -1) AS user_id,
  question_date AS creation_date, creation_date AS creation_timestamp, last_activity_date, score,
  view_count, answer_count, comment_count, favorite_count, is_answered, has_accepted_answer,
  accepted_answer_id, tags_clean, tag_count, string_split(tags_clean, '|')[1] AS primary_tag,
  {tier_sql()} AS quality_tier, {ENGAGE_Q} AS engagement_score, _ingested_at, _batch_id FROM {stg}"""


def fact_answers_sql(stg_a: str, stg_q: str) -> str:
    return f"""
SELECT answer_id, a.question_id, coalesce(a.owner_user_id, -1) AS user_id,
  {key_sql("answer_date")} AS date_key, answer_date AS creation_date,
  a.creation_date AS creation_timestamp, a.last_activity_date, a.score, a.comment_count,
  {big("coalesce(q.accepted_answer_id = answer_id, false)")} AS accepted_answer_flag,
  {tier_sql("a.score")} AS quality_tier, score_sentiment,
  {ENGAGE_A.replace("coalesce(score", "coalesce(a.score").replace("(comment_count", "(a.comment_count")}
    AS engagement_score, a._ingested_at, a._batch_id
FROM {stg_a} a LEFT JOIN {stg_q} q ON q.question_id = a.question_id"""


def dim_user_sql(stg: str, at: str = fx.AS_OF) -> str:
    return f"""
SELECT user_id, display_name, account_creation_date, account_creation_date_date, last_access_date,
  account_age_days, {ACCOUNT_AGE_SQL.format("account_age_days")}
  AS account_age_bucket, reputation, reputation_bucket, reputation_bucket_ordinal, up_votes, down_votes,
  profile_views, location, is_active, _staged_at AS dim_updated_at FROM {stg}
UNION ALL SELECT -1, 'Anonymous/Deleted User', TIMESTAMP '2008-01-01 00:00:00', DATE '2008-01-01',
  TIMESTAMP '2008-01-01 00:00:00', 0, 'New (< 1 year)', 1, 'Beginner', 1, 0, 0, 0, 'Unknown', false,
  TIMESTAMP '{at} 00:00:00'"""


def category_sql(tag: str) -> str:
    return CATEGORY_SQL.format(tag)


def tag_rows(table: str) -> str:
    return (f"(SELECT * EXCLUDE (part), lower(trim(part)) AS tag_name FROM (SELECT *, "
            f"unnest(string_split(tags_clean, '|')) AS part FROM {table} WHERE tags_clean <> '') "
            f"WHERE trim(part) <> '')")


# Relations of the cross-checks, in dependency order. Names start with "x_" so that they
# cannot be mistaken for a given table.
RELATIONS: dict[str, str] = {
    "x_src_q": plain_source(fx.QUESTIONS),
    "x_src_a": plain_source(fx.ANSWERS),
    "x_src_u": plain_source(fx.USERS),
    "x_activity": f"""SELECT user_id, activity_date, questions_posted, answers_posted, total_posts,
        engagement_score FROM ({plain_source(fx.ACTIVITY)})""",
    "x_early_q": plain_source(fx.QUESTIONS_EARLIER.replace("{src}", "x_src_q")),
    "x_early_a": plain_source(fx.ANSWERS_EARLIER.replace("{src}", "x_src_a")),
    "x_early_u": plain_source(fx.USERS_EARLIER.replace("{src}", "x_src_u")),
    "x_raw_q": raw_sql("questions", "x_src_q"),
    "x_raw_a": raw_sql("answers", "x_src_a"),
    "x_raw_u": raw_sql("users", "x_src_u"),
    "x_stg_q": stg_questions_sql("x_raw_q"),
    "x_stg_a": stg_answers_sql("x_raw_a"),
    "x_stg_u": stg_users_sql("x_raw_u"),
    "x_fq": fact_questions_sql("x_stg_q"),
    "x_fa": fact_answers_sql("x_stg_a", "x_stg_q"),
    "x_du": dim_user_sql("x_stg_u"),
    "x_tagged": tag_rows("x_fq"),
    "x_dt": f"SELECT DISTINCT tag_name, {category_sql('tag_name')} AS tag_category, "
            f"TIMESTAMP '{fx.AS_OF} 00:00:00' AS dim_created_at FROM x_tagged",
    "x_ua": f"""SELECT user_id, creation_date AS activity_date, {big("sum(q)")} AS questions_posted,
        {big("sum(a)")} AS answers_posted, count(*) AS total_posts, {r("sum(engagement_score)", 4)}
        AS engagement_score FROM (
          SELECT user_id, creation_date, 1 AS q, 0 AS a, engagement_score FROM x_fq
          UNION ALL SELECT user_id, creation_date, 0, 1, engagement_score FROM x_fa)
        GROUP BY user_id, creation_date""",
}
