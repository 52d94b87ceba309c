"""Registered queries against their SQL on the small tables (all of them: tests/crosscheck.py)."""

import pytest

import __spark_entry__ as contract
from conftest import SF_DIR
from crosscheck import compare, connection

SAMPLE = ["ingest_raw_answers", "stg_questions", "stg_answers", "stg_users", "dim_date", "dim_user", "dim_tag",
          "fact_questions", "fact_answers", "fact_user_activity", "dq_report", "merge_raw_questions",
          "merge_stg_questions", "scd1_dim_user", "merge_fact_questions", "distributed_rank",
          "ntile_percent_rank", "mart_tag_growth", "mart_unanswered_questions", "mart_top_contributors",
          "mart_contributor_retention", "mart_answer_latency", "mart_community_health",
          "kpi_01_platform_overview", "kpi_10_losing_popularity", "stream_upsert", "stream_upsert_late",
          "mart_contributor_retention_bitmaps", "distinct_askers_by_sketch", "join_answers_questions_bucketed",
          "merge_join_bucketed", "recluster_layer"]


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


@pytest.mark.parametrize("name", SAMPLE)
def test_equals_sql(spark, con, name):
    assert compare(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name]) == ""


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
