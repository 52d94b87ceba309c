import datetime as dt

from pyspark.sql import functions as F

from forumlens.plans import incremental, refresh, staging
from forumlens.plans.refresh import Settings, Sources
from forumlens.sources import ingest as ing
from forumlens.sources import schemas, tables
from conftest import rows


def ts(s):
    return dt.datetime.fromisoformat(s)


def posts(spark, values, kind):
    """(id, parent, owner, created, active, score, tags, answers, accepted)"""
    data = [(i, p, o, ts(c), ts(a), s, t, n, acc, kind) for i, p, o, c, a, s, t, n, acc in values]
    return spark.createDataFrame(data, "id long, parent_id long, owner_user_id long, creation_date timestamp_ntz, "
                                       "last_activity_date timestamp_ntz, score long, tags string, answer_count long, "
                                       "accepted_answer_id long, post_type_id long")


def people(spark, values):
    data = [(i, n, ts(c), ts(a), r) for i, n, c, a, r in values]
    return spark.createDataFrame(data, "id long, display_name string, creation_date timestamp_ntz, "
                                       "last_access_date timestamp_ntz, reputation long")


Q = [(1, None, 1, "2020-01-02 08:00", "2020-01-02 08:00", 1, "<a><b>", 1, None),
     (2, None, 2, "2020-01-03 09:00", "2020-01-03 09:00", 0, "<a>", 0, None),
     (3, None, None, "2020-02-10 09:00", "2020-02-10 09:00", 4, None, 1, None)]
A = [(11, 1, 2, "2020-01-02 10:00", "2020-01-02 10:00", 2, None, None, None),
     (13, 3, 1, "2020-02-11 10:00", "2020-02-11 10:00", 1, None, None, None)]
U = [(1, " ann ", "2019-01-01 00:00", "2020-02-01 00:00", 100), (2, None, "2019-06-01 00:00", "2020-02-01 00:00", 700)]


def at(values, when, column=3):
    return [v for v in values if v[column] <= when]


LOOSE = Settings(min_year=2019, trending_min_questions=1, unanswered_min_questions=1, latency_min_questions=1,
                 health_min_questions=1, exact_median=True, tolerated_checks=("DQ-012",), lookback_days=60)
TABLES = {"staging": ["stg_questions", "stg_answers", "stg_users"],
          "warehouse": ["fact_questions", "fact_answers", "fact_user_activity"]}


def content(spark, root, layer, table):
    df = tables.read_layer(spark, root, layer, table)
    # ages follow the clock of the run that last touched a user
    return rows(df.drop("_ingested_at", "_batch_id", "_staged_at", "account_age_days"))


def test_slices_equal_full_rebuild(spark, tmp_path):
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")

    def sources(until):
        return Sources(posts(spark, at(Q, until), 1), posts(spark, at(A, until), 2), people(spark, U))
    refresh.full_rebuild(spark, sources("2020-03-01"), whole, "2020-03-01", LOOSE, with_marts=False)
    refresh.full_rebuild(spark, sources("2020-01-15"), parts, "2020-01-15", LOOSE, with_marts=False)
    log = incremental.run_incremental(spark, sources("2020-03-01"), parts, "2020-03-01", LOOSE, with_marts=True)
    for layer, names in TABLES.items():
        for name in names:
            assert content(spark, whole, layer, name) == content(spark, parts, layer, name), name
    logged = {r["step_name"]: (r["rows_inserted"], r["rows_updated"]) for r in log.collect()}
    assert logged["raw_questions"] == (1, 0) and logged["fact_answers"] == (1, 0)
    # marts of both roots agree
    ours = refresh.refresh_marts(spark, whole, "2020-03-01", LOOSE)
    for name, mart in ours.items():
        theirs = tables.read_layer(spark, parts, "marts", name)
        assert rows(mart.drop("account_age_days")) == rows(theirs.drop("account_age_days")), name
    again = incremental.run_incremental(spark, sources("2020-03-01"), parts, "2020-03-02", LOOSE, with_marts=False)
    new = again.filter("rows_inserted + rows_updated > 0").count()
    assert new == log.filter("rows_inserted + rows_updated > 0").count()


def test_ingest_guards_and_conversion(spark):
    df = posts(spark, [(1, None, 1, "2020-01-01", "2020-01-01", 1, "<a>", 0, None),
                       (None, None, 1, "2020-01-01", "2020-01-01", 1, "<a>", 0, None),
                       (3, None, 1, "2030-01-01", "2030-01-01", 1, "<a>", 0, None)], 1)
    df = df.unionByName(df.withColumn("post_type_id", F.lit(2).cast("long")))
    df = df.withColumn("score", F.lit("12x"))
    raw = ing.ingest(df, ing.QUESTIONS, "2020-06-01", batch_id="b")
    got = raw.collect()
    assert raw.columns == schemas.POST.names + schemas.METADATA.names
    assert [(r["id"], r["score"], r["_batch_id"], r["_load_type"]) for r in got] == [(1, None, "b", "initial_load")]
    assert ing.ingest(df, ing.ANSWERS, "2020-06-01").count() == 0
    users = people(spark, [(-1, "x", "2020-01-01", "2020-01-01", 1), (0, "x", "2020-01-01", "2020-01-01", 1),
                           (5, "x", "2020-01-01", "2020-01-01", 1)])
    assert [r["id"] for r in ing.ingest(users, ing.USERS, "2020-06-01").collect()] == [5]


def test_one_batch_id_per_run(spark):
    df = posts(spark, Q, 1)
    assert ing.ingest(df, ing.QUESTIONS, "2020-06-01").select("_batch_id").distinct().count() == 1


def test_staging_rules_apply_to_the_newest_copy(spark):
    values = [(1, None, 1, "2020-01-01", "2020-01-01", 5, "<a>", 0, None),
              (1, None, 1, "2020-01-01", "2020-01-02", -10000, "<a>", 0, None),
              (2, None, 1, "2020-01-01", "2020-01-01", -9999, None, None, 7),
              (3, None, 1, "2007-12-31 23:59", "2020-01-01", 1, "<a>", 0, None)]
    got = staging.clean_questions(ing.ingest(posts(spark, values, 1), ing.QUESTIONS, "2020-06-01"), "2020-06-01")
    r = got.collect()
    assert [q["question_id"] for q in r] == [2]
    assert r[0]["is_answered"] is False and r[0]["has_accepted_answer"] is True and r[0]["tag_count"] == 1
    assert r[0]["title"] == "Untitled Question"


def test_reputation_limits(spark):
    values = [(i, "n", "2020-01-01", "2020-01-01", r) for i, r in
              enumerate([0, 1, 2_000_000, 2_000_001, None], start=1)]
    got = staging.clean_users(ing.ingest(people(spark, values), ing.USERS, "2020-06-01"), "2020-06-01")
    assert rows(got.select("user_id", "reputation")) == [(2, 1), (3, 2_000_000), (5, 1)]


def test_layers_are_queryable_by_sql(spark, root):
    sources = Sources(posts(spark, Q, 1), posts(spark, A, 2), people(spark, U))
    refresh.full_rebuild(spark, sources, root, "2020-03-01", LOOSE, with_marts=True)
    names = refresh.publish_all(spark, root, "sqltest_")
    assert len(names) == 19
    refresh.publish_all(spark, root, "sqltest_")
    n = spark.sql("SELECT count(*) AS n FROM sqltest_warehouse.fact_questions f "
                  "JOIN sqltest_warehouse.dim_date d USING (date_key)").first()["n"]
    assert n == 3
    assert "mart_refreshed_at" in spark.table("sqltest_marts.mart_tag_growth").columns
