"""Threshold and list classifications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col, whole

# Labels and bounds that stored results must carry.
REPUTATION_BELOW = ((500, "Beginner"), (3000, "Intermediate"), (10000, "Advanced"), (50000, "Expert"))
REPUTATION_TOP = "Elite"
ACCOUNT_AGE_BELOW = ((365, "New (< 1 year)"), (1095, "Established (1-3 years)"),
                     (2555, "Veteran (3-7 years)"))
ACCOUNT_AGE_TOP = "Long-term (7+ years)"
GROWTH_FROM = ((50, "Explosive Growth"), (20, "Strong Growth"), (5, "Moderate Growth"),
               (-5, "Stable"), (-20, "Moderate Decline"))
HEALTH_FROM = ((75, "Thriving"), (50, "Healthy"), (25, "Developing"))
TREND_UP_TO = ((10, "Top 10"), (25, "Top 25"), (50, "Top 50"), (100, "Top 100"))
TAG_CATEGORIES = {
    "Data/Scientific": ("python", "r", "julia", "matlab", "scala", "haskell", "erlang"),
    "Web Frontend": ("javascript", "typescript", "coffeescript", "elm", "purescript"),
    "Application": ("java", "c#", "kotlin", "swift", "objective-c", "dart"),
    "Systems": ("c", "c++", "rust", "go", "assembly", "fortran"),
    "Data/Database": ("sql", "mysql", "postgresql", "oracle", "sqlite", "bigquery", "mongodb",
                      "redis", "cassandra", "elasticsearch"),
    "DevOps/Cloud": ("docker", "kubernetes", "terraform", "ansible", "jenkins", "github-actions",
                     "aws", "gcp", "azure"),
    "Web Framework": ("react", "angular", "vue.js", "svelte", "next.js", "gatsby"),
    "Backend Framework": ("django", "flask", "fastapi", "spring", "rails", "laravel", "express",
                          "nestjs"),
    "AI/ML": ("machine-learning", "deep-learning", "tensorflow", "pytorch", "scikit-learn",
              "keras", "nlp", "computer-vision"),
    "Mobile": ("android", "ios", "react-native", "flutter", "xamarin"),
}

Rules = Sequence[tuple[Column, str | int | bool]]


def case_bucket(rules: Rules, otherwise=None) -> Column:
    """First rule that holds decides the label."""
    out = None
    for condition, label in rules:
        out = F.when(condition, F.lit(label)) if out is None else out.when(condition, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def below(c: Column | str, bounds, otherwise) -> Column:
    return case_bucket([(col(c) < bound, label) for bound, label in bounds], otherwise)


def at_least(c: Column | str, bounds, otherwise=None) -> Column:
    return case_bucket([(col(c) >= bound, label) for bound, label in bounds], otherwise)


def score_sentiment(score: Column | str) -> Column:
    s = whole(score, 0)
    return case_bucket([(s > 0, "positive"), (s == 0, "neutral")], "negative")


def reputation_bucket(reputation: Column | str) -> Column:
    return below(whole(reputation, 1), REPUTATION_BELOW, REPUTATION_TOP)


def reputation_ordinal(reputation: Column | str) -> Column:
    steps = [(bound, i) for i, (bound, _) in enumerate(REPUTATION_BELOW, start=1)]
    return below(whole(reputation, 1), steps, len(steps) + 1).cast("long")


def account_age_bucket(days: Column | str) -> Column:
    return below(days, ACCOUNT_AGE_BELOW, ACCOUNT_AGE_TOP)


def quality_tier(score: Column | str) -> Column:
    """NULL score has no tier."""
    s = col(score)
    return case_bucket([(s >= 10, "High Quality"), (s >= 1, "Good"), (s == 0, "Neutral"),
                        (s < 0, "Low Quality")])


def growth_class(growth: Column | str) -> Column:
    return F.when(col(growth).isNull(), F.lit("New/Baseline")).otherwise(
        at_least(growth, GROWTH_FROM, "Strong Decline"))


def health_class(score: Column | str) -> Column:
    return at_least(score, HEALTH_FROM, "At Risk")


def trend_tier(rank: Column | str) -> Column:
    return case_bucket([(col(rank) <= bound, label) for bound, label in TREND_UP_TO], "Emerging")


def tag_category(tag: Column | str, table=TAG_CATEGORIES, otherwise="Other") -> Column:
    return case_bucket([(col(tag).isin(*names), label) for label, names in table.items()], otherwise)


def is_active(last_seen: Column | str, as_of, days: int = 365) -> Column:
    from .calendar import age_days
    return F.coalesce(age_days(F.to_date(col(last_seen)), as_of) <= days, F.lit(False))


def contributor_type(months_since_first: Column | str, months_since_prior: Column | str) -> Column:
    return case_bucket([(col(months_since_first) == 0, "New"),
                        (col(months_since_prior) == 1, "Retained")], "Returned")
