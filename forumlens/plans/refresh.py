"""Full rebuild of all layers on disk."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.calendar import Moment, settled
from ..session import scratch
from ..sources import ingest as ing
from ..sources import tables
from . import aggregates, dimensions, facts, marts, quality, staging


@dataclass(frozen=True)
class Settings:
    """Everything a run may vary; defaults are the published rules."""

    floor: Moment = staging.FLOOR
    min_year: int = 2010
    trending_min_questions: int = 100
    unanswered_min_questions: int = 50
    latency_min_questions: int = 100
    health_min_questions: int = 100
    exact_median: bool = False
    bounds: quality.Bounds = field(default_factory=quality.Bounds)
    tolerated_checks: tuple[str, ...] = ()
    lookback_days: int = 2


@dataclass(frozen=True)
class Sources:
    questions: DataFrame
    answers: DataFrame
    users: DataFrame


def refresh_marts(spark: SparkSession, root: str, as_of: Moment = None,
                  settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Compute the seven marts from the stored sums, which are built first where there are none, and small tables."""
    def wh(table, columns=None):
        return tables.read_layer(spark, root, "warehouse", table, columns)

    def keep(name, df):
        out[name] = tables.store(marts.refreshed(df, as_of), root, "marts", name)
        return out[name]

    s, out = settings, {}
    if not aggregates.exists(spark, root):
        aggregates.rebuild(spark, root, as_of)
    tags = wh("dim_tag")
    growth = keep("mart_tag_growth", aggregates.growth(spark, root, s.min_year))
    keep("mart_trending_technologies", marts.trending(growth, tags, None, s.trending_min_questions))
    gaps = keep("mart_unanswered_questions", aggregates.gaps(spark, root, s.unanswered_min_questions))
    keep("mart_top_contributors", aggregates.contributors(spark, root, wh("dim_user"), as_of))
    keep("mart_contributor_retention", aggregates.retention(spark, root))
    latency = keep("mart_answer_latency", aggregates.latency(spark, root, s.latency_min_questions, s.exact_median))
    keep("mart_community_health",
         marts.community_health(gaps, latency, growth, tags, as_of, s.health_min_questions))
    return out


def check_warehouse(spark: SparkSession, root: str, as_of: Moment = None,
                    settings: Settings = Settings(), counted_before: dict[str, int] | None = None) -> DataFrame:
    """Quality report over the stored warehouse; raises if a check fails.

    ``counted_before`` holds the row checks that were counted while the tables were written.
    """
    def wh(table):
        return tables.read_layer(spark, root, "warehouse", table)
    report = quality.dq_report(wh("fact_questions"), wh("fact_answers"), wh("dim_user"), wh("dim_date"),
                               as_of, settings.bounds, counted_before)
    quality.dq_gate(report, settings.tolerated_checks)
    return report


def full_rebuild(spark: SparkSession, sources: Sources, root: str, as_of: Moment = None,
                 settings: Settings = Settings(), with_marts: bool = True, batch_id: str | None = None) -> None:
    """Raw, staging, dimensions, facts, quality gate, marts; one clock and one batch id for all of it."""
    as_of, batch_id = settled(as_of), batch_id or str(uuid.uuid4())
    with scratch(spark):
        _rebuild(spark, sources, root, as_of, settings, with_marts, batch_id)


def _rebuild(spark, sources, root, as_of, settings, with_marts, batch_id) -> None:
    def st(layer, table, df, in_place=False):
        return tables.store(df, root, layer, table, in_place=in_place)

    def checked(table, df, in_place=False):
        """Stored, with the row checks of the table counted on the way."""
        out, counts = tables.store_with(df, root, "warehouse", table, quality.row_checks(table, as_of, settings.bounds), in_place=in_place)
        found.update(counts)
        return out

    found: dict[str, int] = {}

    def load(feed, source):
        # a load is one folder, that of its day
        return st("raw", feed.table, ing.ingest(source, feed, as_of, batch_id=batch_id), in_place=True)

    raw_q, raw_a = load(ing.QUESTIONS, sources.questions), load(ing.ANSWERS, sources.answers)
    raw_u = load(ing.USERS, sources.users)
    stg_q = st("staging", "stg_questions", staging.clean_questions(raw_q, as_of, settings.floor))
    stg_a = st("staging", "stg_answers", staging.clean_answers(raw_a, as_of, settings.floor))
    stg_u = st("staging", "stg_users", staging.clean_users(raw_u, as_of, settings.floor))
    st("warehouse", "dim_date", dimensions.build_dim_date(spark, start=min(str(settings.floor)[:10],
                                                                             dimensions.CALENDAR[0])))
    checked("dim_user", dimensions.build_dim_user(stg_u, as_of))
    st("warehouse", "dim_tag", dimensions.build_dim_tag(stg_q, as_of))
    # sums and waiting changes of an earlier state
    for old in (aggregates.LAYER, "changes"):
        tables.delete(spark, tables.table_path(root, old, "").rstrip("/"))
    # a question's fact lies in the same month as its staged row
    fq = checked("fact_questions", facts.build_fact_questions(stg_q), in_place=True)
    fa = checked("fact_answers", facts.build_fact_answers(stg_a, stg_q))
    st("warehouse", "fact_user_activity", facts.build_user_activity(fq, fa))
    check_warehouse(spark, root, as_of, settings, found)
    if with_marts:
        refresh_marts(spark, root, as_of, settings)


def publish_all(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Make every stored table queryable by SQL as ``layer.table``."""
    contents = {
        "raw": ["raw_questions", "raw_answers", "raw_users"],
        "staging": ["stg_questions", "stg_answers", "stg_users"],
        "warehouse": ["dim_date", "dim_user", "dim_tag", "fact_questions", "fact_answers",
                      "fact_user_activity"],
        "marts": ["mart_tag_growth", "mart_trending_technologies", "mart_unanswered_questions",
                  "mart_top_contributors", "mart_contributor_retention", "mart_answer_latency",
                  "mart_community_health"],
    }
    tables.ensure_layers(spark, root, prefix=prefix)
    return [tables.publish(spark, root, layer, t, prefix) for layer, names in contents.items()
            for t in names if tables.exists(spark, tables.table_path(root, layer, t))]
