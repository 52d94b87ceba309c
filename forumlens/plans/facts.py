"""Question, answer and user-activity facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels, text
from ..functions.calendar import date_key
from ..functions.numbers import answer_engagement, fixed_sum, question_engagement


def build_fact_questions(stg_questions: DataFrame) -> DataFrame:
    return stg_questions.select(
        "question_id",
        date_key("question_date").alias("date_key"),
        F.coalesce("owner_user_id", F.lit(-1).cast("long")).alias("user_id"),
        F.col("question_date").alias("creation_date"),
        F.col("creation_date").alias("creation_timestamp"),
        "last_activity_date", "score", "view_count", "answer_count", "comment_count", "favorite_count",
        "is_answered", "has_accepted_answer", "accepted_answer_id", "tags_clean", "tag_count",
        text.primary_tag("tags_clean").alias("primary_tag"),
        labels.quality_tier("score").alias("quality_tier"),
        question_engagement().alias("engagement_score"),
        "_ingested_at", "_batch_id")


def join_answers_questions(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """Answers with the accepted answer id of their question (NULL without a question).

    Only questions that have an accepted answer can change the result, so the others are
    left out before the shuffle.
    """
    accepted = questions.filter(F.col("accepted_answer_id").isNotNull()).select(
        "question_id", F.col("accepted_answer_id").alias("question_accepted_answer_id"))
    return answers.join(accepted, "question_id", "left")


def accepted_flag(answer_id: str = "answer_id", accepted: str = "question_accepted_answer_id"):
    return F.when(F.col(accepted) == F.col(answer_id), F.lit(1)).otherwise(F.lit(0)).cast("long")


def build_fact_answers(stg_answers: DataFrame, stg_questions: DataFrame) -> DataFrame:
    """Answer facts; the accepted flag is looked up by question and answer id together.

    The pair is unique per answer, so a question with very many answers still spreads
    over all tasks, which a join on the question alone would not do.
    """
    accepted = stg_questions.filter(F.col("accepted_answer_id").isNotNull()).select(
        "question_id", F.col("accepted_answer_id").alias("answer_id"),
        F.col("accepted_answer_id").alias("question_accepted_answer_id"))
    return stg_answers.join(accepted, ["question_id", "answer_id"], "left").select(
        "answer_id", "question_id",
        F.coalesce("owner_user_id", F.lit(-1).cast("long")).alias("user_id"),
        date_key("answer_date").alias("date_key"),
        F.col("answer_date").alias("creation_date"),
        F.col("creation_date").alias("creation_timestamp"),
        "last_activity_date", "score", "comment_count",
        accepted_flag().alias("accepted_answer_flag"),
        labels.quality_tier("score").alias("quality_tier"),
        "score_sentiment",
        answer_engagement().alias("engagement_score"),
        "_ingested_at", "_batch_id")


def build_user_activity(fact_questions: DataFrame, fact_answers: DataFrame) -> DataFrame:
    """One row per user and day with posts and summed engagement."""
    def posts(df, questions, answers):
        return df.select("user_id", F.col("creation_date").alias("activity_date"),
                         F.lit(questions).cast("long").alias("q"), F.lit(answers).cast("long").alias("a"),
                         "engagement_score")
    both = posts(fact_questions, 1, 0).unionByName(posts(fact_answers, 0, 1))
    return both.groupBy("user_id", "activity_date").agg(
        F.sum("q").alias("questions_posted"), F.sum("a").alias("answers_posted"),
        F.count("*").alias("total_posts"),
        (fixed_sum("engagement_score", 4) / 10000.0).alias("engagement_score"))
