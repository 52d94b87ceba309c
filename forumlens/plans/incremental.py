"""Daily incremental run: change sets by high-water mark, merged layer by layer.

Every merge of staging and of the facts tells the rows it inserted or changed, with their
values before and after, and the next layer takes those: facts from changed staged rows,
ranks, activity and the sums behind the marts from changed facts. A change reaches all of
them however old the post is. The published look-back window is taken along with it.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import Moment, as_python_date, day, ntz, settled
from ..operators.keyfilter import near_keys
from ..operators.merge import MergeResult, MergeRule, merge_into_table, merge_upsert, read_feed, read_watermark
from ..operators.relational import dedup_latest
from ..session import scratch, stored
from ..sources import ingest as ing
from ..sources import tables
from . import aggregates, dimensions, facts, refresh, staging

_LOAD = ("_ingested_at", "_batch_id", "_load_type")

# Which columns decide that a row changed and which are overwritten.
RAW_QUESTIONS = MergeRule(
    "id", ("score", "answer_count", "view_count", "favorite_count", "last_activity_date"),
    ("score", "answer_count", "view_count", "favorite_count", "accepted_answer_id", "last_activity_date",
     "last_edit_date", *_LOAD), ("accepted_answer_id",), version_by="_ingested_at")
RAW_ANSWERS = MergeRule(
    "id", ("score", "last_activity_date"), ("score", "last_activity_date", "last_edit_date", *_LOAD),
    version_by="_ingested_at")
RAW_USERS = MergeRule(
    "id", ("reputation", "up_votes", "down_votes", "last_access_date"),
    ("reputation", "up_votes", "down_votes", "last_access_date", "location", *_LOAD), version_by="_ingested_at")
STG_QUESTIONS = MergeRule(
    "question_id", ("score", "answer_count", "view_count"),
    ("score", "answer_count", "view_count", "favorite_count", "accepted_answer_id", "is_answered",
     "has_accepted_answer", "last_activity_date", "_staged_at"), ("accepted_answer_id",))
DIM_USER = MergeRule(
    "user_id", ("reputation", "is_active", "location"),
    ("reputation", "reputation_bucket", "reputation_bucket_ordinal", "reputation_percentile_pct",
     "account_age_days", "account_age_bucket", "is_active", "location", "last_access_date",
     "dim_updated_at"))
FACT_QUESTIONS = MergeRule(
    "question_id", ("score", "answer_count", "view_count"),
    ("score", "answer_count", "view_count", "favorite_count", "has_accepted_answer", "accepted_answer_id",
     "is_answered", "engagement_score", "quality_tier"))

# The same treatment for the tables the daily script leaves out; rules are our own.
STG_ANSWERS = MergeRule(
    "answer_id", ("score", "comment_count", "last_activity_date"),
    ("score", "comment_count", "score_sentiment", "last_activity_date", "last_edit_date", "_staged_at"))
STG_USERS = MergeRule(
    "user_id", ("reputation", "up_votes", "down_votes", "last_access_date", "location", "is_active"),
    ("reputation", "reputation_bucket", "reputation_bucket_ordinal", "up_votes", "down_votes",
     "profile_views", "last_access_date", "location", "is_active", "account_age_days", "_staged_at"))
DIM_TAG = MergeRule("tag_name", ("tag_category",), ("tag_category",))
FACT_ANSWERS = MergeRule(
    "answer_id", ("score", "comment_count", "accepted_answer_flag"),
    ("score", "comment_count", "accepted_answer_flag", "quality_tier", "score_sentiment",
     "engagement_score", "last_activity_date"))
USER_ACTIVITY = MergeRule(
    "activity_key", ("questions_posted", "answers_posted", "engagement_score"),
    ("questions_posted", "answers_posted", "total_posts", "engagement_score"))


def raw_changes(source: DataFrame, feed: ing.Feed, watermark: str, as_of: Moment = None,
                batch_id: str | None = None) -> DataFrame:
    """Source rows active after the mark, stamped as an incremental load, newest copy per id."""
    rows = ing.ingest(source, feed, as_of, "incremental_load", batch_id, since=watermark)
    rest = [c for c in feed.contract.names if c not in ("id", feed.activity)]
    return dedup_latest(rows, ["id"], [feed.activity], rest)


def staged_since(raw: DataFrame, watermark: str) -> DataFrame:
    return raw.filter(F.col("_ingested_at") > ntz(watermark))


def window_start(as_of: Moment, lookback_days: int) -> dt.date:
    return as_python_date(as_of) - dt.timedelta(days=lookback_days)


def fact_window(staged: DataFrame, date_column: str, as_of: Moment, lookback_days: int) -> DataFrame:
    """Staging rows whose date lies in the look-back window, both ends included."""
    return staged.filter(F.col(date_column).between(day(window_start(as_of, lookback_days)), day(as_of)))


def merge_fact_questions(fact: DataFrame, stg_questions: DataFrame, as_of: Moment = None,
                         lookback_days: int = 2) -> DataFrame:
    """Recompute the window and merge it; only target rows of the window may match."""
    fresh = facts.build_fact_questions(fact_window(stg_questions, "question_date", as_of, lookback_days))
    span = F.col("creation_date").between(day(window_start(as_of, lookback_days)), day(as_of))
    return merge_upsert(fact, fresh, FACT_QUESTIONS, span)


def scd1_dim_user(dim: DataFrame, stg_users: DataFrame, rule: MergeRule = DIM_USER) -> DataFrame:
    """Overwrite changed users in place, ranking columns included; new users are added."""
    return merge_upsert(dim, dimensions.ranked_users(stg_users), rule)


def activity_keyed(activity: DataFrame) -> DataFrame:
    """User and day as one text key."""
    return activity.withColumn("activity_key", F.concat_ws(
        "|", F.col("user_id").cast("string"), F.col("activity_date").cast("string")))


def run_incremental(spark: SparkSession, sources: refresh.Sources, root: str, as_of: Moment = None,
                    settings: refresh.Settings = refresh.Settings(), batch_id: str | None = None,
                    with_marts: bool = True) -> DataFrame:
    """Bring every stored table up to ``as_of`` and log one audit row per step.

    The clock and the batch id are settled once, so that a run over midnight is one run. A
    step that fails leaves a FAILED row with its message and ends the run.
    """
    as_of, batch_id = settled(as_of), batch_id or str(uuid.uuid4())
    log_path = tables.table_path(root, "raw", "pipeline_audit_log")
    steps: list[tuple[str, MergeResult, str | None]] = []
    doing = ["start"]

    def log(*more: dict) -> DataFrame:
        return tables.append_audit_log(spark, log_path, *[{
            "run_id": batch_id, "step_name": table, "rows_processed": result.processed, "rows_inserted": result.inserted,
            "rows_updated": result.updated, "watermark_used": dt.datetime.fromisoformat(mark) if mark else None}
            for table, result, mark in steps], *more)

    try:
        with scratch(spark):
            _run_steps(spark, sources, root, as_of, settings, batch_id, with_marts, steps, doing)
    except Exception as error:
        log({"run_id": batch_id, "step_name": doing[-1], "status": "FAILED", "error_message": str(error)[:1000]})
        raise
    return log()


def feed_path(root: str, table: str) -> str:
    """Where changes of a table wait for the next layer."""
    return tables.table_path(root, "changes", table)


def newest_told(feed: DataFrame, key: str) -> DataFrame:
    """Changed rows with their present values; of a key that changed in several runs the last."""
    rows = feed.drop("_action", "_old")
    return dedup_latest(rows, [key], ["_staged_at", "_ingested_at"])


def with_window(told: DataFrame, window: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Changed rows and those of the look-back window, each key once.

    ``known`` holds the keys of ``told``, from where they are read without computing its rows again.
    """
    return told.unionByName(window.join(known.select(key), key, "left_anti"))


def answers_of_moved_marks(spark: SparkSession, root: str, question_feed: DataFrame) -> DataFrame:
    """Staged answers that a question began or ceased to accept.

    Ids come from the feed; which months hold them is found on two narrow columns.
    """
    old, new = F.col("_old.accepted_answer_id"), F.col("accepted_answer_id")
    moved = question_feed.filter(F.col("_old").isNull() | ~old.eqNullSafe(new))
    ids = stored(moved.select(F.explode(F.array(old, new)).alias("answer_id")).filter("answer_id IS NOT NULL").distinct())
    staged = tables.read_layer(spark, root, "staging", "stg_answers", keep_partition=True)
    part = tables.PARTITIONS["stg_answers"][0]
    hit = lambda df: near_keys(df, "answer_id", ids).join(ids, "answer_id", "left_semi")
    months = [r[0] for r in hit(staged.select("answer_id", part)).select(part).distinct().collect()]
    return hit(staged.filter(F.col(part).isin(months)).drop(part))


def _run_steps(spark, sources, root, as_of, settings, batch_id, with_marts, steps, doing) -> None:
    def read(layer, table, **kw):
        return tables.read_layer(spark, root, layer, table, **kw)

    def merge(layer, table, rows, rule, mark=None, feed=None):
        doing.append(table)
        steps.append((table, merge_into_table(root, layer, table, rows, rule, feed=feed), mark))

    feeds = [(ing.QUESTIONS, sources.questions, RAW_QUESTIONS, "stg_questions"),
             (ing.ANSWERS, sources.answers, RAW_ANSWERS, "stg_answers"),
             (ing.USERS_WITH_ACCOUNT, sources.users, RAW_USERS, "stg_users")]
    for feed, source, rule, staged in feeds:
        # the newest load day holds the latest load time, so only its folder is read
        newest = tables.newest_folder(spark, root, "raw", feed.table)
        last = read("raw", feed.table, between=(newest, newest)) if newest else read("staging", staged)
        mark = read_watermark(last, "_ingested_at")
        merge("raw", feed.table, raw_changes(source, feed, mark, as_of, batch_id), rule, mark)

    # a mark left over from a run that broke off: its changes are still told, what it added up is not known
    running = feed_path(root, "_running")
    broken = tables.exists(spark, running)
    tables.touch(spark, running)
    cleaners = [("stg_questions", "raw_questions", staging.clean_questions, STG_QUESTIONS),
                ("stg_answers", "raw_answers", staging.clean_answers, STG_ANSWERS),
                ("stg_users", "raw_users", staging.clean_users, STG_USERS)]
    for table, raw, clean, rule in cleaners:
        mark = read_watermark(read("staging", table), "_staged_at")
        # load days before the mark cannot hold newer rows, so their folders stay closed
        fresh = staged_since(read("raw", raw, between=(mark, as_of)), mark)
        merge("staging", table, clean(fresh, as_of, settings.floor), rule, mark, feed_path(root, table))

    def told(table):
        return read_feed(spark, feed_path(root, table), read("staging", table).schema)

    users = stored(newest_told(told("stg_users"), "user_id"))
    if broken:
        tables.delete(spark, tables.table_path(root, aggregates.LAYER, aggregates.REPUTATION.table))
    counts = aggregates.add_users(spark, root, feed_path(root, "stg_users"))
    merge("warehouse", "dim_user", dimensions.ranked_users(users, read("staging", "stg_users"), counts), DIM_USER)

    span = (window_start(as_of, settings.lookback_days), as_python_date(as_of))
    window = lambda table, date: fact_window(read("staging", table, between=span), date, as_of, settings.lookback_days)
    feed_q, feed_a, recent = told("stg_questions"), told("stg_answers"), window("stg_answers", "answer_date")
    recent_q = stored(with_window(newest_told(feed_q, "question_id"), window("stg_questions", "question_date"), "question_id", feed_q))
    recent_a = with_window(newest_told(feed_a, "answer_id"), recent, "answer_id", feed_a)
    known = feed_a.select("answer_id").unionByName(recent.select("answer_id"))
    recent_a = stored(with_window(recent_a, answers_of_moved_marks(spark, root, feed_q), "answer_id", known))
    merge("warehouse", "dim_tag", dimensions.build_dim_tag(recent_q, as_of), DIM_TAG)
    # one folder per run: what a fact merge tells is added once
    question_feed, answer_feed = (f"{feed_path(root, t)}/{batch_id}" for t in ("fact_questions", "fact_answers"))
    merge("warehouse", "fact_questions", facts.build_fact_questions(recent_q), FACT_QUESTIONS, feed=question_feed)
    # an answer may belong to any question: of those only the ones that accept it are needed
    accepting = near_keys(read("staging", "stg_questions", columns=["question_id", "accepted_answer_id"]), "accepted_answer_id", recent_a, "answer_id")
    merge("warehouse", "fact_answers", facts.build_fact_answers(recent_a, accepting), FACT_ANSWERS, feed=answer_feed)
    doing.append("fact_user_activity")
    if broken:
        fq, fa = read("warehouse", "fact_questions"), read("warehouse", "fact_answers")
        tables.store(facts.build_user_activity(fq, fa), root, "warehouse", "fact_user_activity")
        if aggregates.exists(spark, root):
            aggregates.rebuild(spark, root, as_of)
    else:
        aggregates.add_changes(spark, root, question_feed, answer_feed, as_of)
    tables.delete(spark, feed_path(root, "").rstrip("/"))

    doing.append("quality_gate")
    refresh.check_warehouse(spark, root, as_of, settings)
    if with_marts:
        doing.append("marts")
        refresh.refresh_marts(spark, root, as_of, settings)
    doing.append("retention")
    for feed, *_ in feeds:
        tables.drop_expired(spark, root, feed.table, as_of=as_of)
