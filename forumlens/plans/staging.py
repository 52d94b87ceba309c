"""Staging layer: newest copy per id, defaults, derived columns, validity rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels, text
from ..functions.calendar import Moment, age_days, ntz
from ..functions.numbers import pct, whole
from ..operators.relational import dedup_latest, one_row

FLOOR = "2008-01-01"
MIN_SCORE = -10000
REPUTATION_RANGE = (1, 2_000_000)

# Every column used downstream takes part in the tie-break, so equal copies may be swapped freely.
QUESTION_TIES = ("creation_date", "score", "view_count", "answer_count", "comment_count", "favorite_count",
                 "accepted_answer_id", "owner_user_id", "last_edit_date", "title", "tags", "_batch_id")
ANSWER_TIES = ("creation_date", "score", "comment_count", "owner_user_id", "parent_id", "accepted_answer_id",
               "last_edit_date", "_batch_id")
USER_TIES = ("creation_date", "reputation", "up_votes", "down_votes", "views", "display_name", "location",
             "_batch_id")


def date_range(column: str, floor: Moment, as_of: Moment) -> Column:
    return (F.col(column) >= ntz(floor)) & (F.col(column) <= ntz(as_of))


def question_rules(floor: Moment, as_of: Moment) -> list[Column]:
    return [date_range("creation_date", floor, as_of), whole("view_count", 0) >= 0,
            whole("score", 0) > MIN_SCORE]


def answer_rules(floor: Moment, as_of: Moment) -> list[Column]:
    return [date_range("creation_date", floor, as_of), F.col("parent_id").isNotNull(),
            whole("score", 0) > MIN_SCORE]


def user_rules(floor: Moment, as_of: Moment) -> list[Column]:
    return [F.col("id") > 0, date_range("creation_date", floor, as_of),
            whole("reputation", 1).between(*REPUTATION_RANGE)]


def valid(df: DataFrame, rules: list[Column]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, rules))


def answered_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_answered": F.coalesce(F.col("answer_count") > 0, F.lit(False)),
        "has_accepted_answer": F.col("accepted_answer_id").isNotNull(),
    })


def _date_parts(prefix: str, column: str = "creation_date") -> list[Column]:
    c = F.col(column)
    return [F.year(c).cast("long").alias(f"{prefix}_year"), F.month(c).cast("long").alias(f"{prefix}_month"),
            F.quarter(c).cast("long").alias(f"{prefix}_quarter")]


def _moment(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(column)


def clean_questions(raw: DataFrame, as_of: Moment = None, floor: Moment = FLOOR) -> DataFrame:
    newest = dedup_latest(raw.select("id", "last_activity_date", "_ingested_at", *QUESTION_TIES),
                          ["id"], ["last_activity_date", "_ingested_at"], QUESTION_TIES)
    rows = answered_flags(valid(newest, question_rules(floor, as_of)))
    tags = text.tags_clean("tags")
    return rows.select(
        whole("id").alias("question_id"),
        text.text_or("title", "Untitled Question").alias("title"),
        whole("owner_user_id", -1).alias("owner_user_id"),
        _moment("creation_date"),
        F.to_date("creation_date").alias("question_date"),
        _moment("last_activity_date"), _moment("last_edit_date"),
        *_date_parts("question"),
        *[whole(c, 0).alias(c) for c in ("score", "view_count", "answer_count", "comment_count",
                                         "favorite_count")],
        whole("accepted_answer_id").alias("accepted_answer_id"),
        "is_answered", "has_accepted_answer",
        tags.alias("tags_clean"), text.tag_count(tags).alias("tag_count"),
        "_ingested_at", "_batch_id", ntz(as_of).alias("_staged_at"))


def clean_answers(raw: DataFrame, as_of: Moment = None, floor: Moment = FLOOR) -> DataFrame:
    newest = dedup_latest(raw.select("id", "last_activity_date", "_ingested_at", *ANSWER_TIES),
                          ["id"], ["last_activity_date", "_ingested_at"], ANSWER_TIES)
    return valid(newest, answer_rules(floor, as_of)).select(
        whole("id").alias("answer_id"),
        whole("parent_id").alias("question_id"),
        whole("owner_user_id", -1).alias("owner_user_id"),
        _moment("creation_date"),
        F.to_date("creation_date").alias("answer_date"),
        _moment("last_activity_date"), _moment("last_edit_date"),
        *_date_parts("answer"),
        whole("score", 0).alias("score"),
        whole("comment_count", 0).alias("comment_count"),
        F.col("accepted_answer_id").isNotNull().alias("is_accepted_flag"),
        labels.score_sentiment("score").alias("score_sentiment"),
        "_ingested_at", "_batch_id", ntz(as_of).alias("_staged_at"))


def clean_users(raw: DataFrame, as_of: Moment = None, floor: Moment = FLOOR) -> DataFrame:
    newest = dedup_latest(raw.select("id", "last_access_date", "_ingested_at", *USER_TIES),
                          ["id"], ["last_access_date", "_ingested_at"], USER_TIES)
    return valid(newest, user_rules(floor, as_of)).select(
        whole("id").alias("user_id"),
        text.text_or("display_name", "Anonymous").alias("display_name"),
        F.col("creation_date").cast("timestamp_ntz").alias("account_creation_date"),
        F.to_date("creation_date").alias("account_creation_date_date"),
        _moment("last_access_date"),
        age_days(F.to_date("creation_date"), as_of).alias("account_age_days"),
        whole("reputation", 1).alias("reputation"),
        whole("up_votes", 0).alias("up_votes"), whole("down_votes", 0).alias("down_votes"),
        whole("views", 0).alias("profile_views"),
        text.text_or("location", "Unknown").alias("location"),
        labels.reputation_bucket("reputation").alias("reputation_bucket"),
        labels.reputation_ordinal("reputation").alias("reputation_bucket_ordinal"),
        labels.is_active("last_access_date", as_of).alias("is_active"),
        "_ingested_at", "_batch_id", ntz(as_of).alias("_staged_at"))


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per raw table: size, date range, NULL keys, last load."""
    def summary(name, df):
        owner = "owner_user_id" if "owner_user_id" in df.columns else "id"
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.min("creation_date").alias("earliest_record"),
            F.max("creation_date").alias("latest_record"),
            F.count_if(F.col("id").isNull()).alias("null_ids"),
            F.count_if(F.col(owner).isNull()).alias("null_user_ids"),
            F.max("_ingested_at").alias("last_ingested_at"))
    parts = [summary(name, df) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def retention_report(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Share of raw rows that reached staging; 95 to 100 is normal, below 90 is not."""
    def compare(name, staged, raw):
        counted = staged.agg(F.count("*").alias("staging_rows"))
        raw_rows = one_row(raw, n=F.count("*"))["n"]
        return (counted.withColumn("raw_rows", raw_rows)
                .select(F.lit(name).alias("comparison"), "staging_rows", "raw_rows",
                        pct("staging_rows", "raw_rows").alias("retention_pct")))
    return reduce(DataFrame.unionByName, [compare(n, s, r) for n, (s, r) in pairs.items()])
