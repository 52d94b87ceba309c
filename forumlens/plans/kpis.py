"""KPI reports over facts and marts. Ties in top-k lists go by name or id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import Moment, ntz
from ..functions.numbers import fixed_mean, fixed_sum, pct, rnd
from ..operators.relational import one_row


def top_k(df: DataFrame, by: str, k: int = 10, descending: bool = True, tie: str = "tag_name") -> DataFrame:
    """The first ``k`` rows; Spark keeps k rows per task and merges them."""
    order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(order, F.col(tie)).limit(k)


def platform_overview(fact_questions: DataFrame, fact_answers: DataFrame, dim_user: DataFrame,
                      dim_tag: DataFrame, as_of: Moment = None) -> DataFrame:
    """One row about the whole platform, from one aggregate per table."""
    users = (dim_user.filter(F.col("user_id") > 0).groupBy("user_id")
             .agg(F.max("is_active").alias("is_active")))
    people = one_row(users, known=F.count("*"), active=F.count_if("is_active"))
    tags = one_row(dim_tag.select("tag_name").distinct(), n=F.count("tag_name"))
    answers = one_row(fact_answers, n=F.count_distinct("answer_id"), last=F.max("creation_date"))
    questions = fact_questions.agg(
        F.count_distinct("question_id").alias("total_questions"), F.count("*").alias("_rows"),
        F.count_if(F.col("answer_count") > 0).alias("_answered"),
        F.count_if("has_accepted_answer").alias("_accepted"),
        fixed_sum("engagement_score", 4).alias("_engagement"),
        F.count("engagement_score").alias("_scored"),
        F.max("creation_date").alias("last_question_date"))
    return questions.select(
        "total_questions", answers["n"].alias("total_answers"),
        people["known"].alias("total_registered_users"),
        people["active"].alias("active_users_last_365_days"),
        tags["n"].alias("total_distinct_technologies"),
        pct("_answered", "_rows").alias("platform_answer_rate_pct"),
        pct("_accepted", "_rows").alias("platform_acceptance_rate_pct"),
        rnd(fixed_mean("_engagement", "_scored", 4), 2).alias("avg_question_engagement_score"),
        "last_question_date", answers["last"].alias("last_answer_date"), ntz(as_of).alias("report_generated_at"))


def _analysis_year(growth: DataFrame):
    """The year before the newest one in the mart."""
    return one_row(growth, y=F.max("question_year"))["y"] - 1


_GROWTH = ["tag_name", "question_year", "question_count", "prior_year_question_count",
           "yoy_growth_rate_pct", "growth_classification"]


def fastest_growing(growth: DataFrame, k: int = 10) -> DataFrame:
    year = growth.filter((F.col("question_year") == _analysis_year(growth))
                         & F.col("yoy_growth_rate_pct").isNotNull())
    return top_k(year.select(*_GROWTH), "yoy_growth_rate_pct", k)


def declining(growth: DataFrame, k: int = 10) -> DataFrame:
    year = growth.filter((F.col("question_year") == _analysis_year(growth))
                         & (F.col("yoy_growth_rate_pct") < 0))
    return top_k(year.select(*_GROWTH), "yoy_growth_rate_pct", k, descending=False)


def highest_engagement(growth: DataFrame, k: int = 10) -> DataFrame:
    year = growth.filter(F.col("question_year") == _analysis_year(growth))
    return top_k(year.select("tag_name", "question_year", "avg_engagement", "question_count",
                             "answer_rate_pct"), "avg_engagement", k)


def highest_unanswered(unanswered_mart: DataFrame, k: int = 10) -> DataFrame:
    return top_k(unanswered_mart.select("tag_name", "total_questions", "unanswered_questions",
                                        "unanswered_pct", "knowledge_gap_score"), "unanswered_pct", k)


def leading_contributors(contributors: DataFrame, k: int = 10) -> DataFrame:
    return top_k(contributors.select("user_id", "display_name", "reputation", "total_answers",
                                     "accepted_answers", "contribution_score",
                                     "rank_by_contribution_score"),
                 "contribution_score", k, tie="user_id")


def healthiest(health: DataFrame, k: int = 10) -> DataFrame:
    return top_k(health.select("tag_name", "community_health_score", "health_classification",
                               "health_rank"), "health_rank", k, descending=False)


def retention_trend(retention: DataFrame) -> DataFrame:
    return retention.select("activity_month", "total_active_contributors", "retained_contributors",
                            "month_over_month_retention_pct", "rolling_3m_avg_contributors"
                            ).orderBy("activity_month")


def emerging(growth: DataFrame, years: int = 3) -> DataFrame:
    """Tags whose first year is among the last ``years`` years."""
    newest = one_row(growth, y=F.max("question_year"))["y"]
    per_tag = growth.groupBy("tag_name").agg(
        F.min("question_year").alias("first_year"), F.sum("question_count").alias("total_questions"))
    return per_tag.filter(F.col("first_year") > newest - years).orderBy(
        F.col("total_questions").desc(), "tag_name")


def losing_popularity(growth: DataFrame) -> DataFrame:
    """Tag-years with a decline that follows a decline in the previous present year."""
    history = W.partitionBy("tag_name").orderBy("question_year")
    return (growth.withColumn("prior_growth_rate_pct", F.lag("yoy_growth_rate_pct").over(history))
            .filter("yoy_growth_rate_pct < 0 AND prior_growth_rate_pct < 0")
            .select("tag_name", "question_year", "question_count", "yoy_growth_rate_pct",
                    "prior_growth_rate_pct")
            .orderBy("tag_name", "question_year"))
