import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from forumlens.operators import merge as mg
from forumlens.operators.merge import MergeRule
from forumlens.sources import tables
from conftest import rows

RULE = MergeRule("id", ("score",), ("score", "note"), ("best",))


def target(spark):
    return spark.createDataFrame([(1, 5, None, "t"), (2, None, 8, "t"), (3, 7, 1, "t"), (4, 0, 0, "t")],
                                 "id long, score long, best long, note string")


def source(spark):
    return spark.createDataFrame([(1, 6, None, "s"), (2, 9, 8, "s"), (3, 7, None, "s"), (9, 1, 1, "s")],
                                 "id long, score long, best long, note string")


EXPECT = [(1, 6, None, "s", "UPDATE"),   # ordinary change
          (2, None, 8, "t", "KEEP"),     # NULL against a value is no change
          (3, 7, 1, "s", "UPDATE"),      # null-safe column changed; it is not overwritten itself
          (4, 0, 0, "t", "KEEP"), (9, 1, 1, "s", "INSERT")]


def test_merge_semantics(spark):
    assert rows(mg.merge_upsert(target(spark), source(spark), RULE)) == rows(
        spark.createDataFrame(EXPECT, "id long, score long, best long, note string, _action string"))


def test_second_merge_changes_nothing(spark):
    rule = MergeRule("id", ("score",), ("score", "note", "best"), ("best",))
    once = mg.merge_upsert(target(spark), source(spark), rule).drop("_action")
    twice = mg.merge_upsert(once, source(spark), rule)
    assert twice.filter("_action <> 'KEEP'").count() == 0
    assert rows(twice.drop("_action")) == rows(once)


def test_null_and_repeated_keys(spark):
    kind = "id long, score long, best long, note string"
    old = spark.createDataFrame([(None, 1, 1, "keep me"), (1, 5, 1, "a"), (1, 4, 1, "b")], kind)
    new = spark.createDataFrame([(None, 9, 9, "new"), (1, 5, 1, "c")], kind)
    assert rows(mg.merge_upsert(old, new, RULE).drop("best")) == [
        (None, 1, "keep me", "KEEP"), (None, 9, "new", "INSERT"), (1, 5, "a", "KEEP"), (1, 5, "c", "UPDATE")]


def test_duplicate_source_keys_raise(spark):
    with pytest.raises(mg.DuplicateKeyError):
        mg.merge_upsert(target(spark), source(spark).union(source(spark)), RULE)


def test_range_limits_matching(spark):
    got = {r["id"]: r["_action"] for r in mg.merge_upsert(
        target(spark), source(spark).filter("id <> 1"), RULE, F.col("id") > 1).collect()}
    assert got == {1: "KEEP", 2: "KEEP", 3: "UPDATE", 4: "KEEP", 9: "INSERT"}


def test_new_columns_are_added(spark):
    wide = source(spark).withColumn("extra", F.lit("x"))
    got = {r["id"]: r["extra"] for r in mg.merge_upsert(target(spark), wide, RULE).collect()}
    assert got == {1: None, 2: None, 3: None, 4: None, 9: "x"}


def test_watermark_default_for_empty_table(spark):
    empty = spark.createDataFrame([], "t timestamp_ntz")
    assert mg.read_watermark(empty, "t") == "2008-01-01 00:00:00"


FACT = MergeRule("question_id", ("score",), ("score",))


def fact(spark, values):
    data = [(i, dt.date.fromisoformat(d), s) for i, d, s in values]
    return spark.createDataFrame(data, "question_id long, creation_date date, score long").withColumn(
        "user_id", F.lit(1).cast("long"))


def files(root, month):
    folder = f"{root}/warehouse/fact_questions/month_start={month}"
    return sorted(f for f in os.listdir(folder) if f.endswith(".parquet")) if os.path.isdir(folder) else None


def test_only_changed_folders_are_rewritten(spark, root):
    tables.store(fact(spark, [(1, "2020-01-05", 1), (2, "2020-02-05", 1), (3, "2020-03-05", 1)]), root,
                 "warehouse", "fact_questions")
    before = {m: files(root, m) for m in ("2020-01-01", "2020-02-01", "2020-03-01")}
    change = fact(spark, [(1, "2020-01-05", 1), (2, "2020-02-05", 4), (7, "2020-04-01", 2)])
    result = mg.merge_into_table(root, "warehouse", "fact_questions", change, FACT)
    assert (result.inserted, result.updated, result.processed) == (1, 1, 3)
    assert files(root, "2020-03-01") == before["2020-03-01"]
    assert files(root, "2020-02-01") != before["2020-02-01"]
    back = tables.read_layer(spark, root, "warehouse", "fact_questions", ["question_id", "score"])
    assert rows(back) == [(1, 1), (2, 4), (3, 1), (7, 2)]
    again = mg.merge_into_table(root, "warehouse", "fact_questions", change, FACT)
    assert (again.inserted, again.updated) == (0, 0)


def raw(spark, values):
    return spark.createDataFrame([(i, s, dt.datetime.fromisoformat(d)) for i, s, d in values],
                                 "id long, score long, _ingested_at timestamp_ntz").withColumn("parent_id", F.lit(0).cast("long"))


MOVING = MergeRule("id", ("score",), ("score", "_ingested_at"))


def test_rows_move_between_load_days_and_empty_folders_go(spark, root):
    tables.store(raw(spark, [(1, 1, "2020-01-01"), (2, 1, "2020-01-02"), (3, 1, "2020-01-02")]), root, "raw", "raw_answers")
    mg.merge_into_table(root, "raw", "raw_answers", raw(spark, [(1, 2, "2020-01-03"), (2, 5, "2020-01-03"),
                                                                (8, 8, "2020-01-03")]), MOVING)
    back = tables.read_layer(spark, root, "raw", "raw_answers", ["id", "score"])
    assert rows(back) == [(1, 2), (2, 5), (3, 1), (8, 8)]
    left = sorted(f for f in os.listdir(f"{root}/raw/raw_answers") if f.startswith("load_day="))
    assert left == ["load_day=2020-01-02", "load_day=2020-01-03"]
    assert tables.newest_folder(spark, root, "raw", "raw_answers") == "2020-01-03"


def test_repeated_target_keys_lose_no_new_rows(spark, root):
    tables.store(raw(spark, [(1, 1, "2020-01-01")] * 3), root, "raw", "raw_answers")
    done = mg.merge_into_table(root, "raw", "raw_answers", raw(spark, [(1, 1, "2020-01-03"), (2, 1, "2020-01-03"),
                                                                       (3, 1, "2020-01-03")]), MOVING)
    assert (done.inserted, done.updated) == (2, 0)
    assert rows(tables.read_layer(spark, root, "raw", "raw_answers", ["id"])) == [(1,), (1,), (1,), (2,), (3,)]


def test_every_copy_of_a_key_is_updated(spark, root):
    tables.store(raw(spark, [(1, 5, "2020-01-01"), (1, 4, "2020-01-02"), (None, 7, "2020-01-02")]), root, "raw", "raw_answers")
    done = mg.merge_into_table(root, "raw", "raw_answers", raw(spark, [(1, 5, "2020-01-03"), (2, 1, "2020-01-03"),
                                                                       (3, 1, "2020-01-03")]), MOVING)
    assert (done.inserted, done.updated) == (2, 1)
    assert rows(tables.read_layer(spark, root, "raw", "raw_answers", ["id", "score"])) == [
        (None, 7), (1, 5), (1, 5), (2, 1), (3, 1)]


def test_columns_that_appear_later_are_kept(spark, root):
    wide = lambda values: raw(spark, values).withColumn("account_id", F.col("id") * 10)
    tables.store(raw(spark, [(1, 1, "2020-01-01")]), root, "raw", "raw_users")
    mg.merge_into_table(root, "raw", "raw_users", wide([(2, 1, "2020-01-02")]), MOVING)
    mg.merge_into_table(root, "raw", "raw_users", wide([(3, 1, "2020-01-03"), (1, 2, "2020-01-03")]), MOVING)
    assert rows(tables.read_layer(spark, root, "raw", "raw_users", ["id", "score", "account_id"])) == [
        (1, 2, None), (2, 1, 20), (3, 1, 30)]


def test_versions_go_to_their_own_folder(spark, root):
    rule = MergeRule("id", ("score",), ("score", "_ingested_at"), version_by="_ingested_at")
    tables.store(raw(spark, [(1, 1, "2020-01-01"), (1, 1, "2020-01-01"), (2, 1, "2020-01-01")]), root, "raw", "raw_answers")
    folder = f"{root}/raw/raw_answers/load_day=2020-01-01"
    before = sorted(os.listdir(folder))
    change = raw(spark, [(1, 1, "2020-01-03"), (2, 5, "2020-01-03"), (3, 8, "2020-01-03")])
    done = mg.merge_into_table(root, "raw", "raw_answers", change, rule)
    assert (done.inserted, done.updated) == (1, 1) and sorted(os.listdir(folder)) == before
    whole = tables.read_layer(spark, root, "raw", "raw_answers")
    assert rows(whole.select("id", "score")) == [(1, 1), (1, 1), (2, 1), (2, 5), (3, 8)]
    assert rows(mg.newest_versions(whole, rule).select("id", "score")) == [(1, 1), (1, 1), (2, 5), (3, 8)]
    again = mg.merge_into_table(root, "raw", "raw_answers", change, rule)
    assert (again.inserted, again.updated) == (0, 0)


def test_expiry_drops_whole_folders(spark, root):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 3, 1))],
                               "id long, _ingested_at timestamp_ntz")
    tables.store(df, root, "raw", "raw_questions")
    assert rows(tables.expire_partitions(df, "_ingested_at", 60, "2020-03-15").select("id")) == [(2,)]
    assert tables.drop_expired(spark, root, "raw_questions", 60, "2020-03-15") == ["load_day=2020-01-01"]
    assert rows(tables.read_layer(spark, root, "raw", "raw_questions", ["id"])) == [(2,)]


def test_late_copy_does_not_overwrite_a_newer_one(spark):
    rule = MergeRule("id", ("score",), ("score", "best"), only_if_newer="best")
    old = spark.createDataFrame([(1, 5, 20), (2, 5, 20)], "id long, score long, best long")
    new = spark.createDataFrame([(1, 9, 10), (2, 9, 30)], "id long, score long, best long")
    got = {r["id"]: (r["score"], r["_action"]) for r in mg.merge_upsert(old, new, rule).collect()}
    assert got == {1: (5, "KEEP"), 2: (9, "UPDATE")}


def test_reads_open_only_the_asked_folders(spark, root):
    tables.store(fact(spark, [(1, "2020-01-05", 1), (2, "2020-02-05", 1), (3, "2020-03-05", 1)]), root,
                 "warehouse", "fact_questions")
    one_month = tables.read_layer(spark, root, "warehouse", "fact_questions", ["question_id"],
                                  between=("2020-02-03", "2020-02-20"))
    assert len(one_month.inputFiles()) == 3 and rows(one_month) == [(2,)]
    plan = one_month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_start" in plan and "question_id:bigint>" in plan


def test_large_partition_is_written_by_several_tasks(spark, root):
    """One load day must not end up in one task."""
    df = spark.range(0, 200_000, 1, 4).select("id", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
                                              .alias("_ingested_at"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        tables.store(df, root, "raw", "raw_users")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes") if old is None else \
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    folder = f"{root}/raw/raw_users/load_day=2020-01-01"
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) > 1
    assert tables.read_layer(spark, root, "raw", "raw_users").count() == 200_000


def test_counts_arrive_with_the_write(spark, root):
    """No job of its own counts the rows of a merge, whatever they are; the counts equal those of the merged rows."""
    from forumlens.session import stored_with

    group = "merge-counts"
    spark.sparkContext.setJobGroup(group, "counts")
    try:
        merged, counts = stored_with(mg.merge_upsert(target(spark), source(spark), RULE, check=False), **mg.action_counts())
        n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        mg.merge_upsert(target(spark), source(spark), RULE, check=False).write.parquet(f"{root}/plain")
        assert n == len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) - n
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts == {"inserted": 1, "updated": 2}
    assert counts["updated"] == merged.filter("_action = 'UPDATE'").count()
    none, counts = stored_with(merged.filter("false"), **mg.action_counts())
    assert none.count() == 0 and counts == {"inserted": 0, "updated": 0}


def test_versions_without_a_change_are_not_shuffled(spark, root, monkeypatch):
    """Of an append-only table only rows that may have a partner among the changes reach the join."""
    seen, known = [], mg.near_keys
    monkeypatch.setattr(mg, "near_keys", lambda df, key, changes: seen.append((known(df, key, changes).count(), df.count())) or known(df, key, changes))
    tables.store(raw(spark, [(i, 1, "2020-01-01") for i in range(200)] + [(None, 1, "2020-01-01")]), root, "raw", "raw_answers")
    versions = MergeRule("id", ("score",), ("score", "_ingested_at"), version_by="_ingested_at")
    changes = raw(spark, [(5, 2, "2020-01-02"), (6, 1, "2020-01-02"), (900, 1, "2020-01-02"), (None, 3, "2020-01-02")])
    done = mg.merge_into_table(root, "raw", "raw_answers", changes, versions)
    assert (done.inserted, done.updated, done.processed) == (2, 1, 4)
    assert len(seen) == 1 and seen[0][0] <= 4 and seen[0][1] == 201


def test_rewritten_files_are_joined_once_for_the_feed_and_the_table(spark, root, monkeypatch):
    """What is told and what is written come from one join of the rewritten rows with the changes."""
    day = "2020-01-01"
    tables.store(raw(spark, [(i, 1, day) for i in range(20)] + [(3, 1, day), (None, 1, day)]), root, "raw", "raw_answers")
    changes = raw(spark, [(3, 2, day), (4, 1, day), (900, 1, day), (None, 3, day)])
    frame, how = type(changes), []
    known = frame.join
    monkeypatch.setattr(frame, "join", lambda df, other, on=None, kind=None: how.append(kind) or known(df, other, on, kind))
    done = mg.merge_into_table(root, "raw", "raw_answers", changes, MergeRule("id", ("score",), ("score",)), feed=f"{root}/feed")
    assert how.count("full_outer") + how.count("left_outer") == 1
    assert (done.inserted, done.updated, done.processed) == (2, 2, 4)
    now = rows(tables.read_layer(spark, root, "raw", "raw_answers", ["id", "score"]))
    assert now == [(None, 1), (None, 3), *sorted([(i, 2 if i == 3 else 1) for i in range(20)] + [(3, 2), (900, 1)])]
    told = rows(spark.read.parquet(f"{root}/feed").selectExpr("_action", "id", "score", "_old.score AS was"))
    assert told == [("INSERT", None, 3, None), ("INSERT", 900, 1, None), ("UPDATE", 3, 2, 1), ("UPDATE", 3, 2, 1)]
