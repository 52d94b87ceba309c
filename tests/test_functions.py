import datetime as dt

from pyspark.sql import functions as F

from forumlens.functions import calendar, labels, numbers, text
from conftest import rows


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_rounding_is_half_away_from_zero(spark):
    got = one(spark, a=numbers.rnd(F.lit(0.285), 2), b=numbers.rnd(F.lit(-0.285), 2), c=numbers.rnd(F.lit(2.5), 0))
    assert got == {"a": 0.29, "b": -0.29, "c": 3.0}


def test_ratio_by_zero_is_null(spark):
    assert one(spark, a=numbers.pct(F.lit(1), F.lit(0)))["a"] is None


def test_clamp_replaces_null_first(spark):
    null = F.lit(None).cast("double")
    got = one(spark, a=numbers.clamp(null, 1, 5), b=numbers.clamp(F.lit(9), 1, 5), c=numbers.clamp(null, hi=5))
    assert got == {"a": 1.0, "b": 5.0, "c": 0.0}


def test_month_boundaries_and_minutes(spark):
    d = lambda s: F.lit(s).cast("date")
    t = lambda s: F.lit(s).cast("timestamp_ntz")
    got = one(spark, months=calendar.month_diff(d("2020-02-01"), d("2020-01-31")),
              across=calendar.minutes_between(t("2020-01-01 00:00:50"), t("2020-01-01 00:01:10")),
              back=calendar.minutes_between(t("2020-01-01 10:00:30"), t("2020-01-01 00:00:00")))
    assert got == {"months": 1, "across": 0, "back": -600}


def test_sunday_weeks_over_whole_calendar(spark):
    from forumlens.plans.dimensions import build_dim_date
    days = build_dim_date(spark).select("full_date", "week_of_year", "iso_week", "day_of_week", "day_name",
                                        "year_quarter", "date_key").collect()
    assert len(days) == 10227
    for r in days:
        assert r["week_of_year"] == int(r["full_date"].strftime("%U"))
        assert r["iso_week"] == r["full_date"].isocalendar()[1]
        assert r["day_of_week"] == (r["full_date"].isoweekday() % 7) + 1
        assert r["day_name"] == r["full_date"].strftime("%A")
        assert r["date_key"] == int(r["full_date"].strftime("%Y%m%d"))


def test_tag_strings(spark):
    df = spark.createDataFrame([(1, "<a><b>"), (2, "<a>"), (3, ""), (4, None), (5, "<c++>")], "id int, tags string")
    clean = text.tags_clean("tags")
    got = rows(df.select("id", clean, text.tag_count(clean), text.primary_tag(clean)))
    # an untagged question has one empty tag
    assert got == [(1, "a|b", 2, "a"), (2, "a", 1, "a"), (3, "", 1, ""), (4, "", 1, ""), (5, "c++", 1, "c++")]


def test_strip_knows_all_white_space(spark):
    got = one(spark, a=text.stripped(F.lit("\t  x y \n")), b=text.text_or(F.lit(None).cast("string"), " d "))
    assert got == {"a": "x y", "b": "d"}


def test_bucket_edges(spark):
    reps = [0, 1, 499, 500, 2999, 3000, 9999, 10000, 49999, 50000]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(reps)] + [(99, None)], "i int, v long")
    got = [r[1:] for r in rows(df.select("i", labels.reputation_bucket("v"), labels.reputation_ordinal("v")))]
    names = ["Beginner"] * 3 + ["Intermediate"] * 2 + ["Advanced"] * 2 + ["Expert"] * 2 + ["Elite", "Beginner"]
    assert [g[0] for g in got] == names
    assert [g[1] for g in got] == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 1]
    ages = spark.createDataFrame([(d,) for d in (364, 365, 1094, 1095, 2554, 2555)], "d long")
    assert [r[1] for r in rows(ages.select("d", labels.account_age_bucket("d")))] == [
        "New (< 1 year)", "Established (1-3 years)", "Established (1-3 years)", "Veteran (3-7 years)",
        "Veteran (3-7 years)", "Long-term (7+ years)"]
    scores = spark.createDataFrame([(s,) for s in (-1, 0, 1, 9, 10)] + [(None,)], "s long")
    assert rows(scores.select("s", labels.quality_tier("s"))) == [
        (None, None), (-1, "Low Quality"), (0, "Neutral"), (1, "Good"), (9, "Good"), (10, "High Quality")]


def test_growth_class_edges(spark):
    df = spark.createDataFrame([(v,) for v in (None, 50.0, 49.9, 20.0, 5.0, 4.9, -5.0, -5.1, -20.0, -20.1)], "g double")
    got = {r[0]: r[1] for r in df.select("g", labels.growth_class("g")).collect()}
    assert got == {None: "New/Baseline", 50.0: "Explosive Growth", 49.9: "Strong Growth", 20.0: "Strong Growth",
                   5.0: "Moderate Growth", 4.9: "Stable", -5.0: "Stable", -5.1: "Moderate Decline",
                   -20.0: "Moderate Decline", -20.1: "Strong Decline"}


def test_active_within_a_year(spark):
    days = [dt.datetime(2001, 1, 1), dt.datetime(2000, 12, 31), None]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz")
    assert [r[0] for r in df.select(labels.is_active("d", "2002-01-01")).collect()] == [True, False, False]


def test_stable_key_is_non_negative_and_repeatable(spark):
    df = spark.range(5000).select(text.stable_key(F.col("id").cast("string")).alias("k"))
    assert df.filter("k < 0").count() == 0
    assert df.select("k").distinct().count() == 5000
