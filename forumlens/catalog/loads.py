"""Incremental loads and the streaming upsert as queries.

The target is the load at the earlier snapshot, the change set what happened since.
"""

from __future__ import annotations

import re
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.merge import merge_into_table, merge_upsert, newest_versions, read_watermark, watermark
from ..operators.relational import dedup_latest
from ..plans import dimensions, facts, incremental as inc, marts, refresh, staging
from ..plans.quality import Bounds
from ..session import stored
from ..sources import fixtures as fx
from ..sources import ingest as ing
from ..sources import schemas
from ..sources import tables
from ..streaming.upsert import Repeats, stream_upsert
from . import marts as _mart_relations  # noqa: F401  (declares x_m1)
from .base import (RELATIONS, BATCH, Inputs, dim_user_sql, fact_answers_sql, fact_questions_sql, query, r,
                   raw_sql, stg_answers_sql, stg_questions_sql, stg_users_sql)

FIRST = "first-run"
T0, T1 = fx.SNAPSHOT, fx.AS_OF


# ------------------------------------------------------------ cross-check merge
# Fixed values as the published scripts state them, apart from the engine's own: key, compared, compared null-safe, overwritten.
_LOADED = "_ingested_at _batch_id _load_type"
_RULES = {
    "raw_questions": ("id", "score answer_count view_count favorite_count last_activity_date", "accepted_answer_id",
                      f"score answer_count view_count favorite_count accepted_answer_id last_activity_date last_edit_date {_LOADED}"),
    "raw_answers": ("id", "score last_activity_date", "", f"score last_activity_date last_edit_date {_LOADED}"),
    "raw_users": ("id", "reputation up_votes down_votes last_access_date", "",
                  f"reputation up_votes down_votes last_access_date location {_LOADED}"),
    "stg_questions": ("question_id", "score answer_count view_count", "accepted_answer_id",
                      "score answer_count view_count favorite_count accepted_answer_id is_answered has_accepted_answer last_activity_date _staged_at"),
    "stg_answers": ("answer_id", "score comment_count last_activity_date", "", "score comment_count score_sentiment last_activity_date last_edit_date _staged_at"),
    "stg_users": ("user_id", "reputation up_votes down_votes last_access_date location is_active", "",
                  "reputation reputation_bucket reputation_bucket_ordinal up_votes down_votes profile_views last_access_date location is_active "
                  "account_age_days _staged_at"),
    "dim_user": ("user_id", "reputation is_active location", "",
                 "reputation reputation_bucket reputation_bucket_ordinal reputation_percentile_pct account_age_days account_age_bucket is_active "
                 "location last_access_date dim_updated_at"),
    "fact_questions": ("question_id", "score answer_count view_count", "",
                       "score answer_count view_count favorite_count has_accepted_answer accepted_answer_id is_answered engagement_score quality_tier"),
    "fact_answers": ("answer_id", "score comment_count accepted_answer_flag", "",
                     "score comment_count accepted_answer_flag quality_tier score_sentiment engagement_score last_activity_date"),
}


def merge_sql(target: str, source: str, cols: list[str], table: str, extra_target: tuple[str, ...] = (),
              span: str | None = None, action: bool = True) -> str:
    """Full outer join with a CASE per column; written apart from the Spark operator."""
    key, compare, null_safe, overwrite = _RULES[table]
    overwrite = overwrite.split()
    differ = " OR ".join([f"coalesce(t.{c} <> s.{c}, false)" for c in compare.split()]
                         + [f"t.{c} IS DISTINCT FROM s.{c}" for c in null_safe.split()])

    def old(c):
        return "NULL" if c in extra_target else f"t.{c}"
    picked = ", ".join(
        f"CASE WHEN _a = 'INSERT' {'OR _a = ' + chr(39) + 'UPDATE' + chr(39) if c in overwrite else ''} "
        f"THEN s_{c} ELSE t_{c} END AS {c}" for c in cols)
    both = ", ".join(f"{old(c)} AS t_{c}, s.{c} AS s_{c}" for c in cols)
    on = f"t.{key} = s.{key}" + (f" AND {span}" if span else "")
    return (f"SELECT {picked}{', _a AS _action' if action else ''} FROM (SELECT {both}, "
            f"CASE WHEN t.{key} IS NULL THEN 'INSERT' WHEN s.{key} IS NOT NULL AND ({differ}) "
            f"THEN 'UPDATE' ELSE 'KEEP' END AS _a FROM {target} t FULL JOIN {source} s ON {on})")


_META = ["_ingested_at", "_source_table", "_batch_id", "_load_type"]
_POST = schemas.POST.names + _META
_USER = schemas.USER.names + _META

RELATIONS["x_raw_q0"] = raw_sql("questions", "x_early_q", at=T0, batch=FIRST)
RELATIONS["x_raw_a0"] = raw_sql("answers", "(SELECT * FROM x_early_a)", at=T0, batch=FIRST)
RELATIONS["x_raw_u0"] = raw_sql("users", "x_early_u", at=T0, batch=FIRST)
RELATIONS["x_chg_q"] = raw_sql("questions", "x_src_q", "incremental_load", T1, BATCH, T0)
RELATIONS["x_chg_a"] = (
    raw_sql("answers", "x_src_a", "incremental_load", T1, BATCH, T0)
    + " QUALIFY row_number() OVER (PARTITION BY id ORDER BY last_activity_date DESC, comment_count DESC, "
      "creation_date DESC, owner_user_id DESC, parent_id DESC, score DESC) = 1")
RELATIONS["x_chg_u"] = raw_sql("users", "x_src_u", "incremental_load", T1, BATCH, T0)
# answers repeat in the source, so the first load is reduced to one copy as well
RELATIONS["x_one_a0"] = (
    "SELECT * FROM x_raw_a0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY last_activity_date DESC, "
    "comment_count DESC, creation_date DESC, owner_user_id DESC, parent_id DESC, score DESC) = 1")
RELATIONS["x_raw_q1"] = merge_sql("x_raw_q0", "x_chg_q", _POST, "raw_questions")
RELATIONS["x_raw_a1"] = merge_sql("x_one_a0", "x_chg_a", _POST, "raw_answers")
RELATIONS["x_raw_u1"] = merge_sql("x_raw_u0", "x_chg_u", _USER, "raw_users")
RELATIONS["x_stg_q0"] = stg_questions_sql("x_raw_q0", T0)
RELATIONS["x_stg_a0"] = stg_answers_sql("x_one_a0", T0)
RELATIONS["x_stg_u0"] = stg_users_sql("x_raw_u0", T0)
RELATIONS["x_stg_qc"] = stg_questions_sql(f"(SELECT * FROM x_raw_q1 WHERE _ingested_at > DATE '{T0}')", T1)
RELATIONS["x_stg_ac"] = stg_answers_sql(f"(SELECT * FROM x_raw_a1 WHERE _ingested_at > DATE '{T0}')", T1)
RELATIONS["x_stg_uc"] = stg_users_sql(f"(SELECT * FROM x_raw_u1 WHERE _ingested_at > DATE '{T0}')", T1)


class Loads:
    """Targets and change sets of an incremental run."""

    def __init__(self, x: Inputs):
        s, d = x.spark, x.sf_dir
        self.x = x
        self.q0 = ing.ingest(fx.questions_earlier(s, d), ing.QUESTIONS, T0, batch_id=FIRST)
        answers = ing.ingest(fx.answers_earlier(s, d), ing.ANSWERS, T0, batch_id=FIRST)
        self.a0 = dedup_latest(answers, ["id"], ["last_activity_date"],
                               ["comment_count", "creation_date", "owner_user_id", "parent_id", "score"])
        self.u0 = ing.ingest(fx.users_earlier(s, d), ing.USERS, T0, batch_id=FIRST)

    def changes(self, feed, source):
        return inc.raw_changes(source, feed, T0, T1, BATCH)

    def questions(self):
        return merge_upsert(self.q0, self.changes(ing.QUESTIONS, self.x.src_questions), inc.RAW_QUESTIONS,
                            check=False)

    def answers(self):
        return merge_upsert(self.a0, self.changes(ing.ANSWERS, self.x.src_answers), inc.RAW_ANSWERS, check=False)

    def users(self, feed=ing.USERS):
        return merge_upsert(self.u0, self.changes(feed, self.x.src_users), inc.RAW_USERS, check=False)


@query("read_watermark", f"""
SELECT 'filled' AS name, coalesce(max(_ingested_at), TIMESTAMP '2008-01-01 00:00:00') AS watermark FROM x_raw_q0
UNION ALL SELECT 'empty', coalesce(max(_ingested_at), TIMESTAMP '2008-01-01 00:00:00') FROM x_raw_q0 WHERE id < 0""")
def read_marks(x: Inputs):
    q0 = Loads(x).q0
    named = watermark(q0, "_ingested_at").select(F.lit("filled").alias("name"), "watermark")
    empty = watermark(q0.filter("id < 0"), "_ingested_at").select(F.lit("empty").alias("name"), "watermark")
    return named.unionByName(empty)


query("merge_upsert", "SELECT id, score, view_count, last_activity_date, _load_type, _action FROM x_raw_q1")(
    lambda x: Loads(x).questions().select("id", "score", "view_count", "last_activity_date", "_load_type",
                                          "_action"))


@query("merge_raw_questions", "FROM x_raw_q1")
def merge_raw_questions(x: Inputs):
    loads = Loads(x)
    q0 = stored(loads.q0)
    mark = read_watermark(q0, "_ingested_at")
    return merge_upsert(q0, inc.raw_changes(x.src_questions, ing.QUESTIONS, mark, T1, BATCH), inc.RAW_QUESTIONS)


query("merge_raw_answers", "FROM x_raw_a1")(
    lambda x: merge_upsert(Loads(x).a0, Loads(x).changes(ing.ANSWERS, x.src_answers), inc.RAW_ANSWERS))

query("merge_raw_users", "SELECT *, CAST(NULL AS BIGINT) AS account_id FROM x_raw_u1")(
    # the change set brings a column that the first load did not have
    lambda x: Loads(x).users(ing.USERS_WITH_ACCOUNT))

# Stored merges on what the in-memory queries above leave out: repeated and NULL keys, columns that appear later.
_ANSWER = "id, parent_id, score, last_activity_date, _load_type, _batch_id"
RELATIONS["x_gap_a0"] = f"""
SELECT CASE WHEN id % 97 = 0 THEN NULL ELSE id END AS id, parent_id,
  CASE WHEN comment_count = 1 THEN coalesce(n.score, o.score) ELSE o.score END AS score,
  last_activity_date, _load_type, _batch_id
FROM x_raw_a0 o LEFT JOIN (SELECT id AS nid, score FROM x_chg_a) n ON n.nid = o.id"""


RELATIONS["x_gap_hit"] = """
SELECT t.*, s.id IS NOT NULL AND (t.score <> s.score OR t.last_activity_date <> s.last_activity_date) AS u,
  s.score AS ns, s.last_activity_date AS na, s._load_type AS nl, s._batch_id AS nb
FROM x_gap_a0 t LEFT JOIN x_chg_a s ON s.id = t.id"""
RELATIONS["x_gap_new"] = f"SELECT {_ANSWER} FROM x_chg_a s WHERE NOT EXISTS (SELECT 1 FROM x_gap_a0 t WHERE t.id = s.id)"


@query("merge_table_answers", f"""
SELECT *, (SELECT count(*) FROM x_gap_new) AS inserted, (SELECT CAST(count_if(u) AS BIGINT) FROM x_gap_hit) AS updated FROM (
  SELECT id, parent_id, CASE WHEN u THEN ns ELSE score END AS score,
    CASE WHEN u THEN na ELSE last_activity_date END AS last_activity_date,
    CASE WHEN u THEN nl ELSE _load_type END AS _load_type, CASE WHEN u THEN nb ELSE _batch_id END AS _batch_id FROM x_gap_hit
  UNION ALL FROM x_gap_new)""")
def merge_table_answers(x: Inputs):
    """The whole stored table after a merge: some copies of a key changed, some not; NULL keys; new keys."""
    root, s, d = x.scratch("answers"), x.spark, x.sf_dir
    change = Loads(x).changes(ing.ANSWERS, x.src_answers)
    newer = change.select(F.col("id").alias("nid"), F.col("score").alias("ns"))
    old = ing.ingest(fx.answers_earlier(s, d), ing.ANSWERS, T0, batch_id=FIRST).join(newer, F.col("id") == F.col("nid"), "left")
    score = F.when(F.col("comment_count") == 1, F.coalesce("ns", "score")).otherwise(F.col("score"))
    key = F.when(F.col("id") % 97 != 0, F.col("id"))
    tables.store(old.withColumns({"score": score, "id": key}).drop("nid", "ns"), root, "raw", "raw_answers")
    done = merge_into_table(root, "raw", "raw_answers", change, replace(inc.RAW_ANSWERS, version_by=None))
    return tables.read_layer(s, root, "raw", "raw_answers", _ANSWER.split(", ")).withColumns(
        {"inserted": F.lit(done.inserted).cast("long"), "updated": F.lit(done.updated).cast("long")})


@query("merge_table_users", """
SELECT s.id, CASE WHEN t.id IS NULL OR s.u THEN s.reputation ELSE t.reputation END AS reputation,
  CASE WHEN t.id IS NULL OR s.u THEN s._load_type ELSE t._load_type END AS _load_type,
  CASE WHEN t.id IS NULL THEN s.id * 10 END AS account_id
FROM (SELECT c.*, coalesce(c.reputation <> o.reputation OR c.up_votes <> o.up_votes OR c.down_votes <> o.down_votes
        OR c.last_access_date <> o.last_access_date, false) AS u
      FROM x_chg_u c LEFT JOIN x_raw_u0 o ON o.id = c.id) s LEFT JOIN x_raw_u0 t ON t.id = s.id
UNION ALL SELECT id, reputation, _load_type, NULL FROM x_raw_u0 WHERE id NOT IN (SELECT id FROM x_chg_u)""")
def merge_table_users(x: Inputs):
    """Two stored merges bring a column that the first load lacks; other folders keep their files."""
    root, loads = x.scratch("users"), Loads(x)
    tables.store(loads.u0, root, "raw", "raw_users")
    change = loads.changes(ing.USERS_WITH_ACCOUNT, x.src_users).withColumn("account_id", F.col("id") * 10)
    for part in (F.col("id") % 2 == 0, F.col("id") % 2 == 1):
        merge_into_table(root, "raw", "raw_users", change.filter(part), replace(inc.RAW_USERS, version_by=None))
    return tables.read_layer(x.spark, root, "raw", "raw_users", ["id", "reputation", "_load_type", "account_id"])


STG_Q_COLS = """question_id title owner_user_id creation_date question_date last_activity_date last_edit_date
question_year question_month question_quarter score view_count answer_count comment_count favorite_count
accepted_answer_id is_answered has_accepted_answer tags_clean tag_count _ingested_at _batch_id _staged_at""".split()
STG_A_COLS = """answer_id question_id owner_user_id creation_date answer_date last_activity_date last_edit_date
answer_year answer_month answer_quarter score comment_count is_accepted_flag score_sentiment _ingested_at _batch_id
_staged_at""".split()
STG_U_COLS = """user_id display_name account_creation_date account_creation_date_date last_access_date
account_age_days reputation up_votes down_votes profile_views location reputation_bucket reputation_bucket_ordinal
is_active _ingested_at _batch_id _staged_at""".split()
FACT_Q_COLS = """question_id date_key user_id creation_date creation_timestamp last_activity_date score view_count
answer_count comment_count favorite_count is_answered has_accepted_answer accepted_answer_id tags_clean tag_count
primary_tag quality_tier engagement_score _ingested_at _batch_id""".split()
FACT_A_COLS = """answer_id question_id user_id date_key creation_date creation_timestamp last_activity_date score
comment_count accepted_answer_flag quality_tier score_sentiment engagement_score _ingested_at _batch_id""".split()
USER_COLS = """user_id display_name account_creation_date account_creation_date_date last_access_date
account_age_days account_age_bucket reputation reputation_bucket reputation_bucket_ordinal up_votes down_votes
profile_views location is_active dim_updated_at""".split()
RANK_COLS = ("reputation_percentile_pct", "reputation_quartile", "rank_within_bucket")


def _staged(target, merged, clean, rule):
    changes = clean(inc.staged_since(merged.drop("_action"), T0), T1, fx.FLOOR)
    return merge_upsert(clean(target, T0, fx.FLOOR), changes, rule, check=False)


RELATIONS["x_stg_q1"] = merge_sql("x_stg_q0", "x_stg_qc", STG_Q_COLS, "stg_questions")
RELATIONS["x_stg_a1"] = merge_sql("x_stg_a0", "x_stg_ac", STG_A_COLS, "stg_answers")
RELATIONS["x_stg_u1"] = merge_sql("x_stg_u0", "x_stg_uc", STG_U_COLS, "stg_users")


def _stg_questions(x: Inputs):
    loads = Loads(x)
    return _staged(loads.q0, loads.questions(), staging.clean_questions, inc.STG_QUESTIONS)


query("merge_stg_questions", "FROM x_stg_q1")(_stg_questions)


@query("merge_stg_answers", "FROM x_stg_a1")
def merge_stg_answers(x: Inputs):
    loads = Loads(x)
    return _staged(loads.a0, loads.answers(), staging.clean_answers, inc.STG_ANSWERS)


@query("merge_stg_users", "FROM x_stg_u1")
def merge_stg_users(x: Inputs):
    loads = Loads(x)
    return _staged(loads.u0, loads.users(), staging.clean_users, inc.STG_USERS)


RELATIONS["x_du0"] = dim_user_sql("x_stg_u0", T0)
RELATIONS["x_ranked_u"] = f"""
SELECT d.*, {r("percent_rank() OVER (ORDER BY reputation) * 100", 2)} AS reputation_percentile_pct,
  ntile(4) OVER (ORDER BY reputation, user_id) AS reputation_quartile,
  row_number() OVER (PARTITION BY reputation_bucket ORDER BY reputation DESC, user_id) AS rank_within_bucket
FROM (SELECT * FROM x_du WHERE user_id <> -1) d"""


@query("scd1_dim_user", merge_sql("x_du0", "x_ranked_u", USER_COLS + list(RANK_COLS), "dim_user", RANK_COLS))
def scd1_dim_user(x: Inputs):
    old = dimensions.build_dim_user(staging.clean_users(Loads(x).u0, T0, fx.FLOOR), T0)
    return inc.scd1_dim_user(old, x.stg_users)


# window of the fact merge: a year before the snapshot and two months after it
FACT_AT, FACT_BACK, FACT_FROM = "2000-03-01", 425, "1999-01-01"
RELATIONS["x_fq0"] = fact_questions_sql("x_stg_q0")
RELATIONS["x_fqc"] = fact_questions_sql(
    f"(SELECT * FROM x_stg_q WHERE question_date BETWEEN DATE '{FACT_FROM}' AND DATE '{FACT_AT}')")
RELATIONS["x_fa0"] = fact_answers_sql("x_stg_a0", "x_stg_q0")
RELATIONS["x_fac"] = fact_answers_sql(
    f"(SELECT * FROM x_stg_a WHERE answer_date BETWEEN DATE '{FACT_FROM}' AND DATE '{FACT_AT}')", "x_stg_q")
_SPAN = f"t.creation_date BETWEEN DATE '{FACT_FROM}' AND DATE '{FACT_AT}'"


@query("merge_fact_questions", merge_sql("x_fq0", "x_fqc", FACT_Q_COLS, "fact_questions", span=_SPAN))
def merge_fact_questions(x: Inputs):
    old = facts.build_fact_questions(staging.clean_questions(Loads(x).q0, T0, fx.FLOOR))
    return inc.merge_fact_questions(old, x.stg_questions, FACT_AT, FACT_BACK)


@query("merge_fact_answers", merge_sql("x_fa0", "x_fac", FACT_A_COLS, "fact_answers", span=_SPAN))
def merge_fact_answers(x: Inputs):
    loads = Loads(x)
    old = facts.build_fact_answers(staging.clean_answers(loads.a0, T0, fx.FLOOR),
                                   staging.clean_questions(loads.q0, T0, fx.FLOOR))
    recent = inc.fact_window(x.stg_answers, "answer_date", FACT_AT, FACT_BACK)
    fresh = facts.build_fact_answers(recent, x.stg_questions)
    return merge_upsert(old, fresh, inc.FACT_ANSWERS, F.col("creation_date").between(FACT_FROM, FACT_AT),
                        check=False)


@query("merge_dim_tag", """
SELECT coalesce(o.tag_name, n.tag_name) AS tag_name, coalesce(o.tag_category, n.tag_category) AS tag_category,
  CASE WHEN o.tag_name IS NULL THEN 'INSERT' ELSE 'KEEP' END AS _action
FROM (SELECT DISTINCT d.* FROM x_dt d JOIN x_tagged t ON t.tag_name = d.tag_name
      WHERE t.creation_date < DATE '1996-01-01' AND t.primary_tag = 'python') o
FULL JOIN x_dt n ON n.tag_name = o.tag_name""")
def merge_dim_tag(x: Inputs):
    fq = x.keep("fact_questions").fact_questions
    early = fq.filter((F.col("creation_date") < "1996-01-01") & (F.col("primary_tag") == "python"))
    merged = merge_upsert(dimensions.build_dim_tag(early, T0), dimensions.build_dim_tag(fq, T1), inc.DIM_TAG)
    return merged.select("tag_name", "tag_category", "_action")


@query("merge_user_activity", """
SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.activity_date, n.activity_date) AS activity_date,
  coalesce(n.questions_posted, o.questions_posted) AS questions_posted,
  coalesce(n.answers_posted, o.answers_posted) AS answers_posted,
  CASE WHEN o.user_id IS NULL THEN 'INSERT' WHEN n.questions_posted <> o.questions_posted
    OR n.answers_posted <> o.answers_posted OR n.e <> o.e THEN 'UPDATE' ELSE 'KEEP' END AS _action
FROM (SELECT user_id, creation_date AS activity_date, CAST(0 AS BIGINT) AS questions_posted,
        count(*) AS answers_posted, CAST(ROUND(CAST(sum(engagement_score) AS DECIMAL(28,8)), 4) AS DOUBLE) AS e
      FROM x_fa GROUP BY ALL) o
FULL JOIN (SELECT *, engagement_score AS e FROM x_ua) n
  ON n.user_id = o.user_id AND n.activity_date = o.activity_date""")
def merge_user_activity(x: Inputs):
    """Activity known from answers only, then from both kinds of posts."""
    x.keep("stg_questions", "fact_answers")
    fq, fa = x.fact_questions, x.fact_answers
    known = fq.filter(F.lit(False))
    old = inc.activity_keyed(facts.build_user_activity(known, fa))
    new = inc.activity_keyed(facts.build_user_activity(fq, fa))
    return merge_upsert(old, new, inc.USER_ACTIVITY).select(
        "user_id", "activity_date", "questions_posted", "answers_posted", "_action")


# ---------------------------------------------------------------- whole run
_TOLERATED = ("DQ-007", "DQ-008", "DQ-009", "DQ-012")
RUN = refresh.Settings(floor=fx.FLOOR, min_year=fx.MIN_YEAR, tolerated_checks=_TOLERATED, bounds=Bounds(floor=fx.FLOOR))


@query("full_rebuild", "FROM x_m1")
def full_rebuild(x: Inputs):
    """All layers written; growth computed from the stored facts."""
    root = x.scratch("rebuild")
    sources = refresh.Sources(x.src_questions, x.src_answers, x.src_users)
    refresh.full_rebuild(x.spark, sources, root, T1, RUN, with_marts=False)
    return marts.tag_growth(tables.read_layer(x.spark, root, "warehouse", "fact_questions"), fx.MIN_YEAR)


@query("run_incremental", "FROM x_m1")
def run_incremental(x: Inputs):
    """First load at the snapshot, then one incremental run: the same growth as a full rebuild."""
    root = x.scratch("incremental")
    s, d = x.spark, x.sf_dir
    early = refresh.Sources(fx.questions_earlier(s, d), fx.answers_earlier(s, d), fx.users_earlier(s, d))
    refresh.full_rebuild(s, early, root, T0, RUN, with_marts=False)
    now = refresh.Sources(x.src_questions, x.src_answers, x.src_users)
    inc.run_incremental(s, now, root, T1, RUN, with_marts=False)
    return marts.tag_growth(tables.read_layer(s, root, "warehouse", "fact_questions"), fx.MIN_YEAR)


@query("stream_upsert", "SELECT * EXCLUDE (_action) FROM x_raw_q1")
def stream(x: Inputs):
    """The change set arrives as files; the table ends up as after the batch merge."""
    root = x.scratch("stream")
    q0 = Loads(x).q0
    tables.store(q0, root, "raw", "raw_questions")
    landing = f"{root}/landing"
    changes = inc.raw_changes(x.src_questions, ing.QUESTIONS, T0, T1, BATCH)
    changes.write.parquet(landing)
    incoming = (x.spark.readStream.schema(changes.schema).parquet(landing))
    run = stream_upsert(incoming, root, "raw", "raw_questions", inc.RAW_QUESTIONS,
                        ["last_activity_date", "_ingested_at"], f"{root}/progress")
    run.awaitTermination()
    return newest_versions(tables.read_layer(x.spark, root, "raw", "raw_questions", q0.columns), inc.RAW_QUESTIONS)


#: Rows of a change set for every file that a part of it is dealt to.
ROWS_PER_FILE = 1_000_000


@query("stream_upsert_late", "SELECT * EXCLUDE (_action) FROM x_raw_q1")
def stream_late(x: Inputs):
    """One part per trigger: older versions before and after newer ones, a replayed part, and a restart in between.

    A part is one file, or the same number of files for every part where that would be too many rows for the task that writes it.
    """
    root, s = x.scratch("late"), x.spark
    q0 = Loads(x).q0
    tables.store(q0, root, "raw", "raw_questions")
    changes = stored(inc.raw_changes(x.src_questions, ing.QUESTIONS, T0, T1, BATCH))
    older = changes.withColumns({"score": F.col("score") - 7, "last_activity_date": F.col("last_activity_date") - F.expr("INTERVAL 1 DAY"),
                                 "_ingested_at": F.col("_ingested_at") - F.expr("INTERVAL 1 DAY")}).filter(f"last_activity_date > TIMESTAMP_NTZ '{T0} 00:00:00'")
    part = lambda df, k: df.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == k)
    landing, files = f"{root}/landing", 1 + changes.count() // ROWS_PER_FILE

    def run(*parts):
        for df in parts:
            (df.coalesce(1) if files == 1 else df.repartition(files)).write.mode("append").parquet(landing)
        incoming = s.readStream.schema(changes.schema).option("maxFilesPerTrigger", files).parquet(landing)
        stream_upsert(incoming, root, "raw", "raw_questions", inc.RAW_QUESTIONS, ["last_activity_date", "_ingested_at"], f"{root}/progress",
                      repeats=Repeats(("last_activity_date",), "_ingested_at")).awaitTermination()

    run(part(older, 0), part(changes, 1), part(changes, 0))
    run(part(older, 1), part(changes, 0), part(changes, 2))
    return newest_versions(tables.read_layer(s, root, "raw", "raw_questions", q0.columns), inc.RAW_QUESTIONS)


# -------------------------------------------------- whole runs, nothing left out
# All relations again over the sources of a run: "y_" at its day, "z_" at the first load.
def _again(prefix: str, at: str) -> None:
    sources = {"src_q": fx.RUN_QUESTIONS.replace("{src}", "x_src_q"),
               "src_a": fx.RUN_ANSWERS.replace("{src}", "x_src_a").replace("{questions}", "x_src_q"),
               "src_u": fx.RUN_USERS.replace("{src}", "x_src_u").replace("EXCEPT (", "EXCLUDE (")}
    for name, text in sources.items():
        RELATIONS[prefix + name] = text.replace("{at}", at)
    for name, text in _PLAIN.items():
        if name[2:] not in sources:
            RELATIONS[prefix + name[2:]] = re.sub(r"\bx_(\w+)", rf"{prefix}\1", text).replace(fx.AS_OF, at)


_PLAIN = {n: t for n, t in RELATIONS.items() if n.startswith("x_")}
_again("y_", fx.RUN_NOW)
_again("z_", fx.RUN_FIRST)

# table -> (layer, relation, columns by kind: n number, s text, d day, b flag); load columns and ages follow the run that wrote a row
_WHOLE = {
    "stg_questions": ("staging", "y_stg_q", "n:question_id n:owner_user_id d:question_date s:title n:score n:view_count n:answer_count "
                      "n:favorite_count n:accepted_answer_id b:is_answered b:has_accepted_answer s:tags_clean n:tag_count"),
    "stg_answers": ("staging", "y_stg_a", "n:answer_id n:question_id n:owner_user_id d:answer_date n:score n:comment_count s:score_sentiment"),
    "stg_users": ("staging", "y_stg_u", "n:user_id s:display_name d:account_creation_date_date n:reputation s:reputation_bucket s:location b:is_active"),
    "dim_user": ("warehouse", "y_du", "n:user_id s:display_name n:reputation s:reputation_bucket n:reputation_bucket_ordinal s:location b:is_active"),
    "dim_tag": ("warehouse", "y_dt", "s:tag_name s:tag_category"),
    "fact_questions": ("warehouse", "y_fq", "n:question_id n:date_key n:user_id d:creation_date n:score n:view_count n:answer_count n:favorite_count "
                       "b:is_answered b:has_accepted_answer n:accepted_answer_id s:tags_clean s:primary_tag s:quality_tier n:engagement_score"),
    "fact_answers": ("warehouse", "y_fa", "n:answer_id n:question_id n:user_id n:date_key d:creation_date n:score n:comment_count "
                     "n:accepted_answer_flag s:quality_tier s:score_sentiment n:engagement_score"),
    "fact_user_activity": ("warehouse", "y_ua", "n:user_id d:activity_date n:questions_posted n:answers_posted n:total_posts n:engagement_score"),
    "mart_tag_growth": ("marts", "y_m1", "n:question_year s:tag_name n:question_count n:prior_year_question_count n:yoy_growth_rate_pct "
                        "n:distinct_contributors n:prior_year_contributors n:contributor_growth_rate_pct n:avg_score n:avg_views n:avg_engagement "
                        "n:answered_questions n:answer_rate_pct n:cumulative_question_count n:rank_by_volume_in_year s:growth_classification"),
    "mart_trending_technologies": ("marts", "y_m2", "s:tag_name s:tag_category n:popularity_score n:question_count n:yoy_growth_rate_pct "
                                   "n:rank_by_volume_in_year n:popularity_rank n:rank_within_category s:trend_tier"),
    "mart_unanswered_questions": ("marts", "y_m3", "s:tag_name n:total_questions n:unanswered_questions n:answered_questions "
                                  "n:accepted_answer_questions n:avg_answers_per_question n:avg_question_score n:avg_view_count n:distinct_askers "
                                  "n:total_views n:unanswered_pct n:acceptance_rate_pct n:answer_rate_pct n:knowledge_gap_score "
                                  "n:rank_by_unanswered_count n:rank_by_unanswered_pct"),
    "mart_top_contributors": ("marts", "y_m4", "n:user_id s:display_name n:reputation b:is_active n:total_answers n:accepted_answers n:avg_answer_score "
                              "n:total_answer_score n:total_questions_asked n:avg_question_score n:total_views_generated d:first_answer_date "
                              "d:latest_answer_date n:active_months n:acceptance_rate_pct n:activity_consistency_pct n:contribution_score "
                              "n:rank_by_accepted_answers n:rank_by_total_answers n:rank_by_reputation n:rank_by_contribution_score "
                              "n:contributor_decile n:contributor_percentile_bucket"),
    "mart_contributor_retention": ("marts", "y_m5", "d:activity_month n:total_active_contributors n:new_contributors n:retained_contributors "
                                   "n:returned_contributors n:avg_posts_per_contributor n:total_posts n:month_over_month_retention_pct "
                                   "n:net_new_contributors n:rolling_3m_avg_contributors"),
    "mart_answer_latency": ("marts", "y_m6", "s:tag_name n:total_questions n:questions_with_answers n:avg_hours_to_first_answer "
                            "n:median_hours_to_first_answer n:avg_hours_to_accepted_answer n:min_hours_to_first_answer n:max_hours_to_first_answer "
                            "n:answer_rate_pct n:rank_fastest_community"),
    "mart_community_health": ("marts", "y_m7", "s:tag_name s:tag_category n:total_questions n:answer_rate_pct n:acceptance_rate_pct n:unanswered_pct "
                              "n:avg_hours_to_first_answer n:yoy_growth_rate_pct n:avg_engagement n:annual_questions n:response_rate_score "
                              "n:acceptance_rate_score n:speed_score n:growth_score n:engagement_score n:community_health_score "
                              "s:health_classification n:health_rank"),
}


# whether a user was active lately follows the run that last changed the user
_BY_RUN = {"stg_users", "dim_user", "mart_top_contributors"}


def _columns(table: str, daily: bool) -> list[tuple[str, str]]:
    named = [tuple(c.split(":")) for c in _WHOLE[table][2].split()]
    return [c for c in named if not (daily and table in _BY_RUN and c[1] == "is_active")]


def _sums_sql(daily: bool = False) -> str:
    """(table_name, column_name, n_rows, n_values, total) of every column: numbers in ten-thousandths, texts by length, days from 1970."""
    value = {"n": "CAST(round(CAST({c} AS DOUBLE) * 10000) AS HUGEINT)", "s": "length({c})", "d": "CAST({c} AS DATE) - DATE '1970-01-01'",
             "b": "CAST({c} AS INTEGER)"}
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_values, "
        f"CAST(coalesce(sum({value[kind].format(c=c)}), 0) AS BIGINT) AS total FROM {relation}"
        for table, (_, relation, _) in _WHOLE.items() for kind, c in _columns(table, daily))


#: A total beyond a BIGINT is told in units of this and a rest.
UNIT = 10 ** 18


def column_sums(table: str, df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """The same of one table, in one pass over it.

    A total that no BIGINT holds, where the SQL has no answer, is told whole in two rows: units of 10^18, and the rest.
    """
    value = {"n": lambda c: F.round(F.col(c).cast("double") * 10000).cast("decimal(38,0)"), "s": lambda c: F.length(c),
             "d": lambda c: F.datediff(F.to_date(c), F.lit("1970-01-01")), "b": lambda c: F.col(c).cast("int")}
    one = df.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count(c).alias("n_values"),
                                    F.coalesce(F.sum(value[kind](c)), F.lit(0)).cast("decimal(38,0)").alias("whole")) for kind, c in columns]).alias("v"))
    fits, unit = F.col("whole").try_cast("long"), F.lit(UNIT).cast("decimal(38,0)")
    part = lambda name, total: F.struct(name.alias("column_name"), total.alias("total"))
    split = F.array(part(F.concat("column_name", F.lit(" in units of 10^18")), F.call_function("div", F.col("whole"), unit)),
                    part(F.concat("column_name", F.lit(" rest of 10^18")), (F.col("whole") % unit).cast("long")))
    parts = F.when(fits.isNotNull(), F.array(part(F.col("column_name"), fits))).otherwise(split)
    return (one.select(F.explode("v").alias("v")).select("v.*").select("n_rows", "n_values", F.explode(parts).alias("p"))
            .select(F.lit(table).alias("table_name"), "p.column_name", "n_rows", "n_values", "p.total"))


def _sums(x: Inputs, root: str, daily: bool = False):
    """The same from the stored tables."""
    return reduce(DataFrame.unionByName, [
        column_sums(table, tables.read_layer(x.spark, root, layer, table), _columns(table, daily)) for table, (layer, _, _) in _WHOLE.items()])


_DIFFERS = {"stg_questions": ("y_stg_q", "z_stg_q", "question_id", "score answer_count view_count accepted_answer_id"),
            "stg_answers": ("y_stg_a", "z_stg_a", "answer_id", "score comment_count last_activity_date"),
            "stg_users": ("y_stg_u", "z_stg_u", "user_id", "reputation up_votes down_votes last_access_date location"),
            "fact_questions": ("y_fq", "z_fq", "question_id", "score answer_count view_count"),
            "fact_answers": ("y_fa", "z_fa", "answer_id", "score comment_count accepted_answer_flag")}
# what the audit log says of every merge: rows that are new, and rows that differ from the first load
_AUDIT_SQL = " UNION ALL ".join(
    f"SELECT 'audit of {table}', v.column_name, (SELECT count(*) FROM {now}), v.n, v.n FROM (SELECT 'inserted' AS column_name, count(*) FILTER (b.{key} IS NULL) AS n "
    f"FROM {now} a LEFT JOIN {then} b ON b.{key} = a.{key} UNION ALL SELECT 'updated', count(*) FROM {now} a JOIN {then} b ON b.{key} = a.{key} "
    f"WHERE {' OR '.join(f'a.{c} IS DISTINCT FROM b.{c}' for c in columns.split())}) v" for table, (now, then, key, columns) in _DIFFERS.items())
WHOLE_RUN = refresh.Settings(floor=fx.FLOOR, min_year=fx.MIN_YEAR, bounds=Bounds(floor=fx.FLOOR), exact_median=True)


@query("full_rebuild_whole", _sums_sql())
def full_rebuild_whole(x: Inputs):
    """Every stored table and mart of a rebuild that passes all twelve checks, column by column."""
    root = x.scratch("rebuild")
    refresh.full_rebuild(x.spark, refresh.Sources(*fx.run_sources(x.spark, x.sf_dir, fx.RUN_NOW)), root, fx.RUN_NOW, WHOLE_RUN)
    return _sums(x, root)


@query("run_incremental_whole", f"{_sums_sql(True)} UNION ALL {_AUDIT_SQL}")
def run_incremental_whole(x: Inputs):
    """The same after a first load and one daily run with the published window, and what its audit log says."""
    root, s = x.scratch("incremental"), x.spark
    refresh.full_rebuild(s, refresh.Sources(*fx.run_sources(s, x.sf_dir, fx.RUN_FIRST)), root, fx.RUN_FIRST, WHOLE_RUN)
    log = inc.run_incremental(s, refresh.Sources(*fx.run_sources(s, x.sf_dir, fx.RUN_NOW)), root, fx.RUN_NOW, WHOLE_RUN)
    sizes = [tables.read_layer(s, root, _WHOLE[t][0], t).agg(F.lit(t).alias("step_name"), F.count(F.lit(1)).alias("n_rows")) for t in _DIFFERS]
    told = log.join(F.broadcast(reduce(DataFrame.unionByName, sizes)), "step_name").select(
        F.concat(F.lit("audit of "), F.col("step_name")).alias("table_name"), "n_rows",
        F.expr("stack(2, 'inserted', rows_inserted, 'updated', rows_updated) AS (column_name, total)"))
    return _sums(x, root, True).unionByName(told.select("table_name", "column_name", "n_rows", F.col("total").alias("n_values"), "total"))
