"""Data-quality checks: each returns the violating rows, so no rows means the check passed."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import Moment, day
from ..operators.relational import duplicate_keys, orphan_count, orphans

# Identifiers, categories and names that reports must show.
CHECKS = {
    "DQ-001": ("Duplicate Primary Keys", "fact_questions: duplicate question_id"),
    "DQ-002": ("Duplicate Primary Keys", "fact_answers: duplicate answer_id"),
    "DQ-003": ("Null Foreign Keys", "fact_questions: null user_id or date_key"),
    "DQ-004": ("Null Foreign Keys", "fact_answers: null user_id, question_id, or date_key"),
    "DQ-005": ("Invalid Dates", "fact_questions: creation_date out of valid range"),
    "DQ-006": ("Invalid Dates", "fact_answers: creation_date out of valid range"),
    "DQ-007": ("Missing Dimension Records", "fact_answers: question_id not in fact_questions"),
    "DQ-008": ("Missing Dimension Records", "fact_questions: user_id not in dim_user"),
    "DQ-009": ("Referential Integrity", "fact_questions: date_key not in dim_date"),
    "DQ-010": ("Range Validation", "dim_user: reputation outside valid range [1, 2000000]"),
    "DQ-011": ("Range Validation", "fact_questions: score below plausible minimum (-1000)"),
    "DQ-012": ("Data Freshness", "fact_questions: latest record older than 7 days"),
}


@dataclass(frozen=True)
class Bounds:
    """Limits of the range checks."""

    floor: Moment = "2008-01-01"
    min_score: int = -1000
    reputation: tuple[int, int] = (1, 2_000_000)
    max_age_days: int = 7


def _any_null(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def _bad_date(bounds: Bounds, as_of: Moment) -> Column:
    return (F.col("creation_date") < day(bounds.floor)) | (F.col("creation_date") > day(as_of))


def _stale(latest: str, bounds: Bounds, as_of: Moment) -> Column:
    return F.datediff(day(as_of), F.col(latest)) > bounds.max_age_days


def _bad_reputation(bounds: Bounds) -> Column:
    lo, hi = bounds.reputation
    return (F.col("reputation") < lo) | (F.col("reputation") > hi)


def violations(check_id: str, rows: DataFrame, key: str | None, count: str | None = None) -> DataFrame:
    category, name = CHECKS[check_id]
    return rows.select(
        F.lit(check_id).alias("check_id"), F.lit(category).alias("check_category"),
        F.lit(name).alias("check_name"),
        (F.col(key) if key else F.lit(None)).cast("long").alias("key"),
        (F.col(count) if count else F.lit(1)).cast("long").alias("occurrence_count"))


def duplicate_questions(fq: DataFrame) -> DataFrame:
    return violations("DQ-001", duplicate_keys(fq, ["question_id"]), "question_id", "occurrence_count")


def duplicate_answers(fa: DataFrame) -> DataFrame:
    return violations("DQ-002", duplicate_keys(fa, ["answer_id"]), "answer_id", "occurrence_count")


def null_keys_questions(fq: DataFrame) -> DataFrame:
    return violations("DQ-003", fq.filter(_any_null("user_id", "date_key")), "question_id")


def null_keys_answers(fa: DataFrame) -> DataFrame:
    return violations("DQ-004", fa.filter(_any_null("user_id", "question_id", "date_key")), "answer_id")


def dates_questions(fq: DataFrame, as_of: Moment = None, bounds: Bounds = Bounds()) -> DataFrame:
    return violations("DQ-005", fq.filter(_bad_date(bounds, as_of)), "question_id")


def dates_answers(fa: DataFrame, as_of: Moment = None, bounds: Bounds = Bounds()) -> DataFrame:
    return violations("DQ-006", fa.filter(_bad_date(bounds, as_of)), "answer_id")


def orphan_answers(fa: DataFrame, fq: DataFrame) -> DataFrame:
    return violations("DQ-007", orphans(fa.select("answer_id", "question_id"), fq, "question_id"), "answer_id")


def missing_users(fq: DataFrame, dim_user: DataFrame) -> DataFrame:
    return violations("DQ-008", orphans(fq.select("question_id", "user_id"), dim_user, "user_id"), "question_id")


def missing_date_keys(fq: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The calendar is a few thousand rows whatever the facts hold, so it is broadcast."""
    return violations("DQ-009", orphans(fq.select("question_id", "date_key"), F.broadcast(dim_date),
                                        "date_key"), "question_id")


def bad_reputation(dim_user: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    return violations("DQ-010", dim_user.filter(_bad_reputation(bounds)), "user_id")


def bad_scores(fq: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    return violations("DQ-011", fq.filter(F.col("score") < bounds.min_score), "question_id")


def freshness(fq: DataFrame, as_of: Moment = None, bounds: Bounds = Bounds()) -> DataFrame:
    """At most one row; an empty table has no latest date and passes."""
    latest = fq.agg(F.max("creation_date").alias("latest_date"))
    return violations("DQ-012", latest.filter(_stale("latest_date", bounds, as_of)), None)


def all_violations(fq: DataFrame, fa: DataFrame, dim_user: DataFrame, dim_date: DataFrame,
                   as_of: Moment = None, bounds: Bounds = Bounds()) -> DataFrame:
    """Every violating row of the twelve checks."""
    parts = [duplicate_questions(fq), duplicate_answers(fa), null_keys_questions(fq), null_keys_answers(fa),
             dates_questions(fq, as_of, bounds), dates_answers(fa, as_of, bounds), orphan_answers(fa, fq),
             missing_users(fq, dim_user), missing_date_keys(fq, dim_date), bad_reputation(dim_user, bounds),
             bad_scores(fq, bounds), freshness(fq, as_of, bounds)]
    return reduce(DataFrame.unionByName, parts).select(
        "check_id", "check_category", "check_name", "occurrence_count")


def row_checks(table: str, as_of: Moment = None, bounds: Bounds = Bounds()) -> dict[str, Column]:
    """Aggregates that count the violations of the checks on single rows of a table, by check."""
    latest = F.datediff(day(as_of), F.max("creation_date")) > bounds.max_age_days
    known = {
        "fact_questions": {"DQ-003": F.count_if(_any_null("user_id", "date_key")), "DQ-005": F.count_if(_bad_date(bounds, as_of)),
                           "DQ-011": F.count_if(F.col("score") < bounds.min_score), "DQ-012": F.when(latest, 1).otherwise(0)},
        "fact_answers": {"DQ-004": F.count_if(_any_null("user_id", "question_id", "date_key")),
                         "DQ-006": F.count_if(_bad_date(bounds, as_of))},
        "dim_user": {"DQ-010": F.count_if(_bad_reputation(bounds))},
    }
    return {check: test.cast("long") for check, test in known[table].items()}


def failing_rows(fq: DataFrame, fa: DataFrame, dim_user: DataFrame, dim_date: DataFrame, as_of: Moment = None,
                 bounds: Bounds = Bounds(), counted_before: dict[str, int] | None = None) -> DataFrame:
    """Number of violations per check, one row each.

    Row conditions on one table are counted in one pass over it, or taken from
    ``counted_before`` where the tables were written with ``row_checks``; key lookups count
    rows per key before they are shuffled.
    """
    def counted(df, table):
        tests = row_checks(table, as_of, bounds)
        if counted_before is not None:
            return df.sparkSession.createDataFrame([(c, counted_before[c]) for c in tests], "check_id string, failing_rows long")
        return df.agg(*[t.alias(c) for c, t in tests.items()]).unpivot([], list(tests), "check_id", "failing_rows")

    def named(check_id, df):
        return df.select(F.lit(check_id).alias("check_id"), F.col("n").alias("failing_rows"))

    def duplicates(df, key):
        return duplicate_keys(df, [key]).agg(F.count("*").alias("n"))

    parts = [
        counted(fq, "fact_questions"), counted(fa, "fact_answers"), counted(dim_user, "dim_user"),
        named("DQ-001", duplicates(fq, "question_id")),
        named("DQ-002", duplicates(fa, "answer_id")),
        named("DQ-007", orphan_count(fa, fq, "question_id")),
        named("DQ-008", orphan_count(fq, dim_user, "user_id")),
        named("DQ-009", orphan_count(fq, F.broadcast(dim_date), "date_key")),
    ]
    return reduce(DataFrame.unionByName, parts)


def with_catalogue(counts: DataFrame) -> DataFrame:
    """All known checks with their counts; a check without violations has zero and passes."""
    from ..sources.tables import inline_catalogue
    known = inline_catalogue(counts.sparkSession, ["check_id", "check_category", "check_name"],
                             [(i, c, n) for i, (c, n) in CHECKS.items()])
    # twelve rows on either side
    joined = known.join(F.broadcast(counts), "check_id", "left")
    failing = F.coalesce("failing_rows", F.lit(0))
    return joined.select("check_id", "check_category", "check_name", failing.alias("failing_rows"),
                         F.when(failing > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"))


def failures_first(report: DataFrame) -> DataFrame:
    return report.orderBy(F.when(F.col("failing_rows") > 0, 0).otherwise(1), "check_id")


def dq_report(fq: DataFrame, fa: DataFrame, dim_user: DataFrame, dim_date: DataFrame,
              as_of: Moment = None, bounds: Bounds = Bounds(), counted_before: dict[str, int] | None = None) -> DataFrame:
    counts = failing_rows(fq, fa, dim_user, dim_date, as_of, bounds, counted_before)
    return failures_first(with_catalogue(counts))


class QualityGateError(RuntimeError):
    """Checks failed; the marts must not be written."""

    def __init__(self, failed: dict[str, int]):
        super().__init__(f"data quality checks failed: {failed}")
        self.failed = failed


def dq_gate(report: DataFrame, ignore: tuple[str, ...] = ()) -> None:
    """Raise if any check that is not ignored has failed (twelve rows at most are read)."""
    failed = {r["check_id"]: r["failing_rows"] for r in report.filter("status = 'FAIL'").collect()
              if r["check_id"] not in ignore}
    if failed:
        raise QualityGateError(failed)
