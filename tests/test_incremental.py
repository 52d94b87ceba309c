"""A run after changes of any age equals a rebuild, and touches what changed."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forumlens.operators.keyfilter import near_keys
from forumlens.plans import aggregates, dimensions, incremental, marts, refresh, staging
from forumlens.plans.refresh import Sources
from forumlens.sources import ingest as ing
from forumlens.sources import tables
from conftest import rows
from test_loads import LOOSE, people, posts

FIRST, SECOND, THIRD = "2021-06-01", "2021-06-03", "2021-06-05"
Q = [(1, None, 1, "2019-01-02 08:00", "2019-01-02 08:00", 1, "<a><b>", 1, None),
     (2, None, 2, "2019-05-03 09:00", "2019-05-03 09:00", 0, "<a><a>", 0, None),
     (3, None, None, "2020-02-10 09:00", "2020-02-10 09:00", 4, None, 1, None),
     (4, None, 1, "2020-02-11 09:00", "2020-02-11 09:00", 4, "<c>", 2, 42),
     (5, None, 2, "2021-05-30 09:00", "2021-05-30 09:00", 7, "<d>", 1, None)]
A = [(11, 1, 2, "2019-01-02 10:00", "2019-01-02 10:00", 2, None, None, None),
     (41, 4, 2, "2020-02-12 10:00", "2020-02-12 10:00", 2, None, None, None),
     (42, 4, 3, "2020-03-12 10:00", "2020-03-12 10:00", 2, None, None, None),
     (31, 3, 1, "2020-02-11 10:00", "2020-02-11 10:00", 1, None, None, None),
     (51, 5, 1, "2021-05-31 10:00", "2021-05-31 10:00", 1, None, None, None)]
U = [(1, "ann", "2019-01-01 00:00", "2021-06-01 00:00", 100), (2, None, "2019-01-01 00:00", "2021-05-01 00:00", 700),
     (3, "cy", "2019-01-01 00:00", "2021-05-01 00:00", 100)]

# years after it was asked, question 1 gets another score and 4 accepts another answer; an old answer changes; new posts and a new user
Q2 = [(1, None, 1, "2019-01-02 08:00", "2021-06-02 08:00", 9, "<a><b>", 2, None),
      (4, None, 1, "2020-02-11 09:00", "2021-06-02 09:00", 5, "<c>", 2, 41),
      (6, None, 4, "2021-06-02 09:00", "2021-06-02 09:00", 7, "<e><a>", 0, None)]
A2 = [(11, 1, 2, "2019-01-02 10:00", "2021-06-02 10:00", 20, None, None, None),
      (12, 1, 4, "2021-06-02 06:00", "2021-06-02 06:00", 1, None, None, None)]
U2 = [(1, "ann", "2019-01-01 00:00", "2021-06-02 00:00", 900), (4, "dee", "2021-06-01 12:00", "2021-06-02 00:00", 100)]
# and then one question only
Q3 = [(5, None, 2, "2021-05-30 09:00", "2021-06-04 09:00", 8, "<d>", 1, None)]


def upto(base, *changes):
    out = {v[0]: v for v in base}
    for change in changes:
        out.update({v[0]: v for v in change})
    return list(out.values())


def state(spark, root):
    """Everything that a later reader sees, without load columns and ages, which follow the run that wrote a row."""
    out = {}
    drop = ["_ingested_at", "_batch_id", "_staged_at", "dim_created_at", "account_age_days", "account_age_bucket", "last_activity_date",
            "mart_refreshed_at", "computed_at"]
    names = {"warehouse": ["fact_questions", "fact_answers", "fact_user_activity", "dim_tag"], "aggregates": ["agg_tag_user", "agg_tag_latency",
             "agg_user_posts", "agg_reputation", "tag_years", "tag_totals"]}
    names["marts"] = ["mart_tag_growth", "mart_trending_technologies", "mart_unanswered_questions", "mart_top_contributors",
                      "mart_contributor_retention", "mart_answer_latency", "mart_community_health"]
    for layer, tables_ in names.items():
        for t in tables_:
            if tables.exists(spark, tables.table_path(root, layer, t)):
                df = tables.read_layer(spark, root, layer, t)
                out[t] = rows(df.select(*sorted(c for c in df.columns if c not in drop)))
    return out


def sources(spark, q, a, u):
    return Sources(posts(spark, q, 1), posts(spark, a, 2), people(spark, u))


@pytest.fixture(scope="module")
def second(spark):
    return sources(spark, upto(Q, Q2), upto(A, A2), upto(U, U2))


TWO_DAYS = replace(LOOSE, lookback_days=2)


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory, second):
    """A rebuild on the second day, and what it stored."""
    root = str(tmp_path_factory.mktemp("whole"))
    refresh.full_rebuild(spark, second, root, SECOND, TWO_DAYS)
    return root, state(spark, root)


def compare(ours, theirs):
    assert set(theirs) <= set(ours)
    for name in theirs:
        assert ours[name] == theirs[name], name


def test_changes_outside_the_window_reach_everything(spark, tmp_path, second, whole):
    parts = str(tmp_path)
    refresh.full_rebuild(spark, sources(spark, Q, A, U), parts, FIRST, TWO_DAYS)
    log = incremental.run_incremental(spark, second, parts, SECOND, TWO_DAYS)
    compare(state(spark, parts), whole[1])
    done = {r["step_name"]: (r["rows_processed"], r["rows_inserted"], r["rows_updated"]) for r in log.collect()}
    # four answers: the new one, the changed one, and both whose question accepts another
    assert done["fact_questions"] == (3, 1, 2) and done["fact_answers"] == (4, 1, 3)
    assert not tables.exists(spark, incremental.feed_path(parts, "_running"))

    # only tags of the questions that changed were computed again
    at = {r["tag_name"]: str(r["computed_at"])[:10] for r in tables.read_layer(spark, parts, "aggregates", "tag_totals").collect()}
    assert at == {"a": SECOND, "b": SECOND, "c": SECOND, "d": FIRST, "e": SECOND}
    third = sources(spark, upto(Q, Q2, Q3), upto(A, A2), upto(U, U2))
    incremental.run_incremental(spark, third, parts, THIRD, TWO_DAYS)
    at = {r["tag_name"]: str(r["computed_at"])[:10] for r in tables.read_layer(spark, parts, "aggregates", "tag_totals").collect()}
    assert at == {"a": SECOND, "b": SECOND, "c": SECOND, "d": THIRD, "e": SECOND}
    score = {r["question_id"]: r["score"] for r in tables.read_layer(spark, parts, "warehouse", "fact_questions").collect()}
    assert score == {1: 9, 2: 0, 3: 4, 4: 5, 5: 8, 6: 7}
    years = {r["tag_name"]: r["avg_score"] for r in aggregates.growth(spark, parts, 2021).collect()}
    assert years == {"d": 8.0, "e": 7.0, "a": 7.0}


def test_a_run_after_one_that_broke_off(spark, tmp_path, second, whole, monkeypatch):
    parts = str(tmp_path)
    refresh.full_rebuild(spark, sources(spark, Q, A, U), parts, FIRST, TWO_DAYS)

    def stop(*args):
        aggregates.add(spark, parts, aggregates.ACTIVITY, aggregates.activity_rows(
            *(tables.read_layer(spark, parts, "warehouse", t) for t in ("fact_questions", "fact_answers"))))
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(aggregates, "add_changes", stop)
        with pytest.raises(RuntimeError):
            incremental.run_incremental(spark, second, parts, SECOND, TWO_DAYS)
    assert tables.exists(spark, incremental.feed_path(parts, "_running"))
    incremental.run_incremental(spark, second, parts, SECOND, TWO_DAYS)
    compare(state(spark, parts), whole[1])


def test_sums_equal_marts_from_facts(spark, whole):
    root = whole[0]
    fq, fa, du = (tables.read_layer(spark, root, "warehouse", t) for t in ("fact_questions", "fact_answers", "dim_user"))
    same = lambda a, b: rows(a.select(*b.columns)) == rows(b)
    assert same(aggregates.growth(spark, root, 2019), marts.tag_growth(fq, 2019))
    assert same(aggregates.gaps(spark, root, 1), marts.unanswered(fq, 1))
    assert same(aggregates.latency(spark, root, 1, True), marts.answer_latency(fq, fa, 1, exact=True))
    assert same(aggregates.latency(spark, root, 1, False), marts.answer_latency(fq, fa, 1))
    assert same(aggregates.contributors(spark, root, du, SECOND), marts.top_contributors(fa, fq, du, SECOND))


def test_user_ranks_equal_windows_over_all_users(spark):
    n = 9000
    raw = spark.range(n).select((F.col("id") * 3 + 1).alias("id"), F.lit("n").alias("display_name"), F.lit("2020-01-01").cast("timestamp_ntz").alias("creation_date"),
                                F.lit("2020-01-01").cast("timestamp_ntz").alias("last_access_date"),
                                F.when(F.col("id") % 3 == 0, 1).otherwise(1 + F.col("id") * 7919 % 5000).cast("long").alias("reputation"))
    users = staging.clean_users(ing.ingest(raw, ing.USERS, "2020-06-01"), "2020-06-01")
    plain = dimensions.user_attributes(users).withColumns({
        "reputation_percentile_pct": F.round(F.percent_rank().over(W.orderBy("reputation")).cast("decimal(28,8)") * 100, 2).cast("double"),
        "reputation_quartile": F.ntile(4).over(W.orderBy("reputation", "user_id")).cast("long"),
        "rank_within_bucket": F.row_number().over(W.partitionBy("reputation_bucket").orderBy(F.desc("reputation"), "user_id")).cast("long")})
    want = plain.select("user_id", "reputation_quartile", "rank_within_bucket")
    got = dimensions.ranked_users(users)
    assert rows(got.select(*want.columns)) == rows(want)
    some = users.filter("user_id % 101 = 1")
    few = dimensions.ranked_users(some, users, dimensions.reputation_counts(users))
    assert rows(few) == rows(got.join(some.select("user_id"), "user_id", "left_semi").select(*few.columns))
    assert few.count() == some.count() > 50


def test_rows_without_a_partner_are_not_shuffled(spark):
    table = spark.range(100_000).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    changes = spark.createDataFrame([(i,) for i in (3, 4, 99_999, 200_000, None)], "c int")
    near = near_keys(table, "k", changes, "c")
    got = {r["k"] for r in near.collect()}
    assert {3, 4, 99_999} <= got and len(got) < 30 and None not in got
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert near_keys(table, "k", changes.filter("c is null"), "c").count() == 0
    assert near_keys(table.limit(0), "k", changes, "c").count() == 0


def test_changed_rows_are_computed_once_beside_the_window(spark):
    """The window is held against the keys of the feed, not against the newest rows found once more."""
    load = "timestamp '2021-01-0{} 00:00:00' AS _staged_at, timestamp '2021-01-01 00:00:00' AS _ingested_at"
    row = lambda k, v, d: spark.sql(f"SELECT {k}L AS k, {v} AS v, {load.format(d)}, 'UPDATE' AS _action, CAST(NULL AS INT) AS _old")
    feed = row(1, 10, 1).unionByName(row(1, 11, 2)).unionByName(row(2, 20, 1))
    window = row(2, 0, 1).unionByName(row(3, 30, 1)).drop("_action", "_old")
    both = incremental.with_window(incremental.newest_told(feed, "k"), window, "k", feed)
    assert rows(both.select("k", "v")) == [(1, 11), (2, 20), (3, 30)]
    assert both._jdf.queryExecution().optimizedPlan().toString().count("Window [") <= 1
