"""Sums of columns that no BIGINT holds."""

from pyspark.sql import functions as F

from forumlens.catalog import loads
from conftest import rows


def test_totals_beyond_a_bigint_are_whole(spark):
    first, n = 9 * 10 ** 11, 1200  # 9e15 in ten-thousandths each, 1.08e19 together: beyond 9.2e18
    df = spark.range(first, first + n).select("id", (-F.col("id")).alias("minus"), F.when(F.col("id") % 2 == 1, F.col("id") % 3).alias("few"), F.lit("ab").alias("name"))
    got = loads.column_sums("t", df, [("n", "id"), ("n", "minus"), ("n", "few"), ("s", "name")])
    assert dict(got.dtypes)["total"] == "bigint"
    told = {r[1]: r[2:] for r in rows(got)}
    assert set(told) == {"id in units of 10^18", "id rest of 10^18", "minus in units of 10^18", "minus rest of 10^18", "few", "name"}
    for c, sign in (("id", 1), ("minus", -1)):
        assert told[f"{c} in units of 10^18"][2] * loads.UNIT + told[f"{c} rest of 10^18"][2] == sign * sum(range(first, first + n)) * 10000
    few = [i % 3 for i in range(first, first + n) if i % 2]
    assert told["few"] == (n, len(few), sum(few) * 10000) and told["name"] == (n, n, 2 * n)


def test_totals_that_fit_stay_one_row(spark):
    df = spark.createDataFrame([(900000000000,), (None,)], "id long")
    assert rows(loads.column_sums("t", df, [("n", "id")])) == [("t", "id", 2, 1, 9 * 10 ** 15)]
    assert rows(loads.column_sums("t", df.limit(0), [("n", "id")])) == [("t", "id", 0, 0, 0)]
