"""Question-and-answer sources derived from the order tables.

An order is a question, its line items are the answers, customers are the users. The same
SQL text runs in Spark and in the checking engine; ``{orders}`` and the like are replaced
by DataFrames here and by table names there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from . import schemas
from .schemas import conform

AS_OF = "2002-01-01"          # the clock of the fixture
SNAPSHOT = "2000-01-01"       # an earlier load, for incremental runs
FLOOR = "1995-06-01"
MIN_YEAR = 1995

QUESTIONS = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('  Order ', o_orderpriority, ' ') END AS title,
  CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 10 + 1 END AS accepted_answer_id,
  coalesce(n.answer_count, 0) AS answer_count,
  CAST(o_orderkey % 4 AS BIGINT) AS comment_count,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 5 AS BIGINT) END AS favorite_count,
  o_orderdate + (o_orderkey % 1440) * INTERVAL 1 MINUTE AS creation_date,
  o_orderdate + (o_orderkey % 400 + 1) * INTERVAL 1 DAY AS last_activity_date,
  CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE o_custkey END AS owner_user_id,
  CAST(1 AS BIGINT) AS post_type_id,
  CAST(o_orderkey % 61 AS BIGINT) - 20 AS score,
  CAST(floor(o_totalprice) AS BIGINT) AS view_count,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('<',
    CASE c_mktsegment WHEN 'BUILDING' THEN 'python' WHEN 'AUTOMOBILE' THEN 'javascript'
      WHEN 'MACHINERY' THEN 'c++' WHEN 'HOUSEHOLD' THEN 'sql' ELSE 'docker' END,
    '><', replace(lower(substr(o_orderpriority, 3)), ' ', '-'),
    '><', replace(lower(n_name), '_', '-'), '>') END AS tags
FROM {orders}
LEFT JOIN {customer} ON o_custkey = c_custkey
LEFT JOIN {nation} ON c_nationkey = n_nationkey
LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_linenumber) AS answer_count
           FROM {lineitem} GROUP BY l_orderkey) n ON n.l_orderkey = o_orderkey
"""

ANSWERS = """
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS parent_id,
  l_shipdate + (l_partkey % 1440) * INTERVAL 1 MINUTE AS creation_date,
  l_shipdate + (l_partkey % 30 + 1) * INTERVAL 1 DAY AS last_activity_date,
  l_suppkey AS owner_user_id, CAST(2 AS BIGINT) AS post_type_id,
  CAST(l_quantity AS BIGINT) - 10 AS score,
  CAST(l_linenumber % 3 AS BIGINT) AS comment_count
FROM {lineitem}
"""

USERS = """
SELECT c_custkey AS id, c_name AS display_name,
  CAST(floor(c_acctbal) AS BIGINT) * 10 AS reputation,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE n_name END AS location,
  o.first_order AS creation_date, o.last_order AS last_access_date,
  CAST(c_custkey % 11 AS BIGINT) AS up_votes, CAST(c_custkey % 3 AS BIGINT) AS down_votes,
  CAST(c_custkey % 101 AS BIGINT) AS views
FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
           FROM {orders} GROUP BY o_custkey) o ON o_custkey = c_custkey
"""

ACTIVITY = """
SELECT user_id, CAST(ts AS DATE) AS activity_date,
  count(CASE WHEN event_type = 'click' THEN 1 END) AS questions_posted,
  count(CASE WHEN event_type <> 'click' THEN 1 END) AS answers_posted,
  count(*) AS total_posts, sum(value) AS engagement_score
FROM {events} GROUP BY user_id, CAST(ts AS DATE)
"""

# The sources as they stood at SNAPSHOT: later activity has not happened yet.
QUESTIONS_EARLIER = """
SELECT id, title, comment_count, favorite_count, creation_date, owner_user_id, post_type_id, tags,
  CASE WHEN last_activity_date > CAST('2000-01-01' AS TIMESTAMP) THEN NULL
       ELSE accepted_answer_id END AS accepted_answer_id,
  answer_count,
  CASE WHEN last_activity_date > CAST('2000-01-01' AS TIMESTAMP) THEN score - 2
       ELSE score END AS score,
  view_count,
  least(last_activity_date, CAST('2000-01-01' AS TIMESTAMP)) AS last_activity_date
FROM {src} WHERE creation_date <= CAST('2000-01-01' AS TIMESTAMP)
"""

ANSWERS_EARLIER = """
SELECT id, parent_id, creation_date, owner_user_id, post_type_id, comment_count,
  CASE WHEN last_activity_date > CAST('2000-01-01' AS TIMESTAMP) THEN score - 1
       ELSE score END AS score,
  least(last_activity_date, CAST('2000-01-01' AS TIMESTAMP)) AS last_activity_date
FROM {src} WHERE creation_date <= CAST('2000-01-01' AS TIMESTAMP)
"""

USERS_EARLIER = """
SELECT id, display_name, location, creation_date, up_votes, down_votes, views,
  CASE WHEN last_access_date > CAST('2001-01-01' AS TIMESTAMP) THEN reputation - 5
       ELSE reputation END AS reputation,
  least(last_access_date, CAST('2000-01-01' AS TIMESTAMP)) AS last_access_date
FROM {src} WHERE creation_date <= CAST('2000-01-01' AS TIMESTAMP)
"""

# Sources for whole runs, as they stood at a given day: every user is valid, every answer belongs to a question before it,
# and activity after that day has not happened. A fortnight lies between the two days.
RUN_FIRST, RUN_NOW = "2001-07-20", "2001-08-03"
RUN_QUESTIONS = """
SELECT id, title, comment_count, favorite_count, creation_date, owner_user_id, post_type_id, tags, answer_count, view_count,
  CASE WHEN last_activity_date <= CAST('{at}' AS TIMESTAMP) THEN accepted_answer_id END AS accepted_answer_id,
  CASE WHEN last_activity_date <= CAST('{at}' AS TIMESTAMP) THEN score ELSE score - 2 END AS score,
  CASE WHEN last_activity_date <= CAST('{at}' AS TIMESTAMP) THEN last_activity_date ELSE creation_date END AS last_activity_date
FROM {src} WHERE creation_date >= CAST('1995-06-01' AS TIMESTAMP) AND creation_date <= CAST('{at}' AS TIMESTAMP)
"""
RUN_ANSWERS = """
SELECT a.id, a.parent_id, a.creation_date, a.owner_user_id, a.post_type_id, a.comment_count,
  CASE WHEN a.last_activity_date <= CAST('{at}' AS TIMESTAMP) THEN a.score ELSE a.score - 1 END AS score,
  CASE WHEN a.last_activity_date <= CAST('{at}' AS TIMESTAMP) THEN a.last_activity_date ELSE a.creation_date END AS last_activity_date
FROM (SELECT id, parent_id, post_type_id, min(creation_date) AS creation_date, min(owner_user_id) AS owner_user_id,
        min(comment_count) AS comment_count, min(score) AS score, max(last_activity_date) AS last_activity_date
      FROM {src} GROUP BY id, parent_id, post_type_id) a
JOIN {questions} q ON q.id = a.parent_id AND q.creation_date <= a.creation_date
WHERE q.creation_date >= CAST('1995-06-01' AS TIMESTAMP) AND a.creation_date <= CAST('{at}' AS TIMESTAMP)
"""
RUN_USERS = """
SELECT id, display_name, location, creation_date, up_votes, down_votes, views,
  CASE WHEN last_access_date <= CAST('{at}' AS TIMESTAMP) THEN greatest(reputation, 10) ELSE greatest(reputation, 10) - 5 END AS reputation,
  CASE WHEN last_access_date <= CAST('{at}' AS TIMESTAMP) THEN last_access_date ELSE creation_date END AS last_access_date
FROM (SELECT * EXCEPT (creation_date), greatest(creation_date, CAST('1995-06-01' AS TIMESTAMP)) AS creation_date FROM {src}) u
WHERE creation_date <= CAST('{at}' AS TIMESTAMP)
"""


_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is taken from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _run(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{n: read_table(spark, sf_dir, n) for n in names})


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_run(spark, sf_dir, QUESTIONS, "orders", "customer", "nation", "lineitem"), schemas.POST)


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_run(spark, sf_dir, ANSWERS, "lineitem"), schemas.POST)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_run(spark, sf_dir, USERS, "customer", "nation", "orders"), schemas.USER)


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, ACTIVITY, "events")


def _ntz(sql: str) -> str:
    return sql.replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")


def questions_earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(spark.sql(_ntz(QUESTIONS_EARLIER), src=questions(spark, sf_dir)), schemas.POST)


def answers_earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(spark.sql(_ntz(ANSWERS_EARLIER), src=answers(spark, sf_dir)), schemas.POST)


def users_earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(spark.sql(_ntz(USERS_EARLIER), src=users(spark, sf_dir)), schemas.USER)


def run_sources(spark: SparkSession, sf_dir: str, at: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Questions, answers and users of a whole run at a day."""
    def sql(text, **named):
        return spark.sql(_ntz(text.replace("{at}", at)), **named)

    asked, answered, people = questions(spark, sf_dir), answers(spark, sf_dir), users(spark, sf_dir)
    return (conform(sql(RUN_QUESTIONS, src=asked), schemas.POST), conform(sql(RUN_ANSWERS, src=answered, questions=asked), schemas.POST),
            conform(sql(RUN_USERS, src=people), schemas.USER))
