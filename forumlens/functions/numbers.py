"""Arithmetic helpers and the weighted score formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole(c: Column | str, default: int | None = None) -> Column:
    """64-bit integer, with an optional replacement for NULL."""
    out = col(c).cast("long")
    return out if default is None else F.coalesce(out, F.lit(default).cast("long"))


def rnd(c: Column | str, digits: int) -> Column:
    """Half-away-from-zero rounding of a double, done in decimal so 0.285 gives 0.29."""
    return F.round(col(c).cast("decimal(28,8)"), digits).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """Floating division; NULL for a zero denominator."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    return rnd(ratio(F.lit(100.0) * col(num), den), digits)


def clamp(c: Column | str, lo: float | None = None, hi: float | None = None,
          default: float = 0.0) -> Column:
    """NULL becomes ``default``, then the value is held inside [lo, hi]."""
    out = F.coalesce(col(c).cast("double"), F.lit(float(default)))
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return out


def fixed_sum(c: Column | str, digits: int) -> Column:
    """Exact integer sum of a double already rounded to ``digits`` places.

    Summing scaled integers makes the result independent of the order in which tasks
    finish, so ranks built on an average do not move when a task is retried.
    """
    return F.sum(F.rint(col(c) * F.lit(float(10 ** digits))).cast("long"))


def fixed_mean(total: Column | str, n: Column | str, digits: int) -> Column:
    """Mean from a ``fixed_sum`` and a count."""
    return ratio(total, n) / F.lit(float(10 ** digits))


def question_engagement(score="score", views="view_count", answers="answer_count",
                        favorites="favorite_count") -> Column:
    """2·score + ln(views + 1) + 1.5·answers + 2·favorites, four decimals."""
    return rnd(whole(score, 0) * 2.0 + F.ln(whole(views, 0) + 1)
               + whole(answers, 0) * 1.5 + whole(favorites, 0) * 2.0, 4)


def answer_engagement(score="score", comments="comment_count") -> Column:
    """3·score + 0.5·comments, four decimals."""
    return rnd(whole(score, 0) * 3.0 + whole(comments, 0) * 0.5, 4)


def growth_norm(growth: Column | str) -> Column:
    """Growth percentage held to [-100, 200] and mapped onto 0..100."""
    return rnd((clamp(growth, -100, 200) + 100.0) * 100.0 / 300.0, 2)


def popularity_score(volume="norm_volume", growth="norm_growth", engagement="norm_engagement",
                     contributors="norm_contributor_growth") -> Column:
    return rnd(col(volume) * 0.40 + col(growth) * 0.30 + col(engagement) * 0.20
               + col(contributors) * 0.10, 2)


def knowledge_gap(views="total_views", unanswered="unanswered_questions",
                  total="total_questions") -> Column:
    return rnd(col(views).cast("double") / 1_000_000.0 * ratio(F.lit(100.0) * col(unanswered), total), 2)


def contribution_score(answers="total_answers", accepted="accepted_answers",
                       reputation="reputation", answer_score="total_answer_score") -> Column:
    return rnd(col(answers) * 3.0 + col(accepted) * 5.0 + col(reputation) * 0.01
               + col(answer_score) * 0.5, 2)


def speed_score(hours: Column | str) -> Column:
    """100 for an immediate answer, 0 from 72 hours on; unknown counts as 100 hours."""
    spent = F.least(F.lit(100.0), F.coalesce(col(hours), F.lit(100.0)) * (100.0 / 72.0))
    return F.greatest(F.lit(0.0), F.lit(100.0) - spent)


def health_score(response="response_rate_score", acceptance="acceptance_rate_score",
                 speed="speed_score", growth="growth_score", engagement="engagement_score") -> Column:
    return rnd(col(response) * 0.25 + col(acceptance) * 0.25 + col(speed) * 0.20
               + col(growth) * 0.20 + col(engagement) * 0.10, 2)
