"""Files clustered by two columns let a filter on either one skip most of them."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from forumlens.sources import tables
from forumlens.sources.clustering import cuts, in_boxes, interleaved, range_number, recluster


def spread(spark, n=40_000):
    """Two independent columns."""
    return spark.range(0, n, 1, 4).select("id", F.pmod(F.xxhash64("id"), F.lit(5000)).alias("user_id"),
                                          F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3000)).cast("int").alias("score"))


def opened(path, column, value):
    """Share of files whose statistics cannot rule out ``column = value``."""
    hit = total = 0
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= value <= stats.max
    return hit / total


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    got = {(r.a, r.b): r.z for r in df.select("a", "b", interleaved([F.col("a"), F.col("b")], 2).alias("z")).collect()}
    expected = {(a, b): (a >> 1) << 3 | (b >> 1) << 2 | (a & 1) << 1 | (b & 1) for a in range(4) for b in range(4)}
    assert got == expected


def test_range_numbers_count_the_cuts_below(spark):
    at = [-2.5, 0.0, 1.0, 7.0]
    values = [None, -9.0, -2.5, -1.0, 0.0, 0.5, 1.0, 6.0, 7.0, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(range_number(F.col("v"), at, 3)).collect()]
    assert got == [0 if v is None else sum(c <= v for c in at) for v in values]


@pytest.mark.parametrize("column, value", [("user_id", 2500), ("score", 1500)])
def test_a_filter_on_either_column_skips_most_files(spark, root, column, value):
    path = tables.table_path(root, "t", "plain")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        spread(spark).repartition(64).write.parquet(path)
        assert opened(path, column, value) > 0.9
        before = rows(spark.read.parquet(path))
        assert recluster(spark, root, "t", "plain", ["user_id", "score"]) == 64
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert rows(spark.read.parquet(path)) == before
    assert opened(path, column, value) < 0.3


def test_folders_of_a_range_are_rewritten_and_others_left(spark, root):
    df = spread(spark, 600).select((F.col("id")).alias("question_id"), "user_id", "score",
                                   F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("creation_date"))
    tables.store(df, root, "warehouse", "fact_questions")
    path = tables.table_path(root, "warehouse", "fact_questions")
    january = set(glob.glob(f"{path}/month_start=2020-01-01/*.parquet"))
    later = set(glob.glob(f"{path}/month_start=2020-0[23]-01/*.parquet"))
    assert recluster(spark, root, "warehouse", "fact_questions", between=("2020-01-01", "2020-01-31")) == len(january)
    assert not january & set(glob.glob(f"{path}/month_start=2020-01-01/*.parquet"))
    assert later == set(glob.glob(f"{path}/month_start=2020-0[23]-01/*.parquet"))
    assert rows(tables.read_layer(spark, root, "warehouse", "fact_questions")) == rows(df)


def test_nulls_texts_and_hot_values(spark, root):
    df = spark.createDataFrame([(None, None)] * 50 + [(7, "same")] * 200 + [(i, f"tag{i % 9}") for i in range(50)] + [(1, "")], "n int, t string")
    df.write.parquet(f"{root}/t/odd")
    assert all(len(v) < 256 for v in cuts(df, ["n", "t"]).values())
    recluster(spark, root, "t", "odd", ["n", "t"])
    assert rows(spark.read.parquet(f"{root}/t/odd")) == rows(df)


def test_an_empty_table_is_left_alone(spark, root):
    empty = spread(spark, 0)
    assert in_boxes(empty, ["user_id", "score"]).count() == 0
    tables.store(empty.withColumn("creation_date", F.current_date()), root, "warehouse", "fact_questions")
    assert recluster(spark, root, "warehouse", "fact_questions") == 0
