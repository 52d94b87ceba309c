import datetime as dt

import pytest
from pyspark.sql import functions as F

from forumlens.plans import quality
from forumlens.plans.dimensions import build_dim_date
from forumlens.sources import tables

AS_OF = "2020-06-10"
FQ = "question_id long, user_id long, date_key long, creation_date date, score long"
FA = "answer_id long, question_id long, user_id long, date_key long, creation_date date"


def clean(spark):
    d = dt.date(2020, 6, 5)
    fq = spark.createDataFrame([(1, 1, 20200605, d, 3), (2, -1, 20200605, d, 0)], FQ)
    fa = spark.createDataFrame([(11, 1, 1, 20200605, d)], FA)
    users = spark.createDataFrame([(1, 10), (-1, 1)], "user_id long, reputation long")
    return fq, fa, users, build_dim_date(spark)


def failing(tables):
    counts = {r["check_id"]: r["failing_rows"] for r in quality.dq_report(*tables, AS_OF).collect()
              if r["status"] == "FAIL"}
    rows = quality.all_violations(*tables, AS_OF).groupBy("check_id").agg(F.count("*").alias("n")).collect()
    # the counting form and the row form must agree
    assert counts == {r["check_id"]: r["n"] for r in rows}
    return counts


def test_clean_layer_passes(spark):
    report = quality.dq_report(*clean(spark), AS_OF)
    assert report.count() == 12 and report.filter("status <> 'PASS'").count() == 0
    quality.dq_gate(report)


def test_each_fault_is_found(spark):
    fq, fa, users, days = clean(spark)
    d = dt.date(2020, 6, 5)
    bad_q = spark.createDataFrame([
        (1, 1, 20200605, d, 3), (5, None, 20200605, d, 0), (6, 1, 20070101, dt.date(2007, 1, 1), 0),
        (7, 1, 20200605, dt.date(2021, 1, 1), -1001), (8, 77, 20200605, d, -1000)], FQ)
    bad_a = spark.createDataFrame([(11, 1, 1, 20200605, d), (12, 99, 1, 20200605, dt.date(2007, 1, 1)),
                                   (13, None, 1, 20200605, d)], FA)
    bad_u = spark.createDataFrame([(5, 0), (6, 2_000_001), (7, 2_000_000)], "user_id long, reputation long")
    got = failing((fq.union(bad_q), fa.union(bad_a), users.union(bad_u), days))
    assert got == {"DQ-001": 1, "DQ-002": 1, "DQ-003": 1, "DQ-004": 1, "DQ-005": 2, "DQ-006": 1, "DQ-007": 2,
                   "DQ-008": 2, "DQ-009": 1, "DQ-010": 2, "DQ-011": 1}


def test_stale_and_empty_tables(spark):
    fq, fa, users, days = clean(spark)
    stale = fq.withColumn("creation_date", F.lit("2020-06-02").cast("date"))
    assert failing((stale, fa, users, days)) == {"DQ-012": 1}
    # an empty table has no newest row, so it is not stale; its answers are orphans
    assert failing((fq.filter("false"), fa, users, days)) == {"DQ-007": 1}


def test_gate_stops_and_names_failures(spark):
    fq, fa, users, days = clean(spark)
    report = quality.dq_report(fq.union(fq), fa, users, days, AS_OF)
    with pytest.raises(quality.QualityGateError) as stop:
        quality.dq_gate(report)
    assert stop.value.failed == {"DQ-001": 2}
    quality.dq_gate(report, ignore=("DQ-001",))
    assert report.first()["check_id"] == "DQ-001"


def test_row_checks_that_came_with_the_write(spark, root):
    fq, fa, users, days = clean(spark)
    d = dt.date(2020, 6, 5)
    fq = fq.union(spark.createDataFrame([(5, None, 20200605, d, 0), (7, 1, 20200605, dt.date(2021, 1, 1), -1001)], FQ))
    found, kept = {}, []
    for name, df in (("fact_questions", fq), ("fact_answers", fa), ("dim_user", users.withColumns({"account_creation_date_date": F.lit(d), "reputation_bucket": F.lit("any")}))):
        stored, counts = tables.store_with(df, root, "warehouse", name, quality.row_checks(name, AS_OF))
        found.update(counts)
        kept.append(stored)
    assert found == {"DQ-003": 1, "DQ-004": 0, "DQ-005": 1, "DQ-006": 0, "DQ-010": 0, "DQ-011": 1, "DQ-012": 0}
    again = quality.dq_report(*kept, days, AS_OF, counted_before=found)
    assert again.collect() == quality.dq_report(*kept, days, AS_OF).collect()
    # what was counted before is not scanned again: only the five key checks read the facts
    reads = [line.split("ReadSchema")[1] for line in again._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line]
    assert reads and not any(c in r for r in reads for c in ("score", "creation_date", "reputation"))
