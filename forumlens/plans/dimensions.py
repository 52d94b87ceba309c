"""Date, user and tag dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.calendar import Moment, date_key, day, ntz, week_from_sunday
from ..functions.text import stable_key
from ..functions.numbers import rnd
from ..operators.keyfilter import near_keys
from ..operators.ranking import ntile_of
from ..operators.relational import explode_tags
from ..session import stored

# Calendar bounds, the launch day counted from, and the stand-in user.
CALENDAR = ("2008-01-01", "2035-12-31")
LAUNCH_DAY = "2008-07-31"
UNKNOWN_USER = {
    "user_id": -1, "display_name": "Anonymous/Deleted User", "account_creation_date": "2008-01-01",
    "account_creation_date_date": "2008-01-01", "last_access_date": "2008-01-01", "account_age_days": 0,
    "account_age_bucket": "New (< 1 year)", "reputation": 1, "reputation_bucket": "Beginner",
    "reputation_bucket_ordinal": 1, "up_votes": 0, "down_votes": 0, "profile_views": 0,
    "location": "Unknown", "is_active": False,
}

#: Users of equal reputation are counted per block of 2^ID_BLOCK_BITS ids.
ID_BLOCK_BITS = 12


def date_spine(spark: SparkSession, start: Moment = CALENDAR[0], end: Moment = CALENDAR[1]) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(F.explode(F.sequence(day(start), day(end))).alias("full_date"))


def spine_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date of a table."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).filter(F.col("lo").isNotNull())
    return ends.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))


def calendar_columns(spine: DataFrame, launch_day: Moment = LAUNCH_DAY) -> DataFrame:
    d = F.col("full_date")
    return spine.select(
        date_key(d).alias("date_key"), d,
        F.year(d).cast("long").alias("year"),
        F.quarter(d).cast("long").alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).cast("long").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short_name"),
        week_from_sunday(d).alias("week_of_year"),
        F.weekofyear(d).cast("long").alias("iso_week"),
        F.dayofmonth(d).cast("long").alias("day_of_month"),
        F.dayofweek(d).cast("long").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "E").alias("day_short_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.year(d).cast("long").alias("fiscal_year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.datediff(d, day(launch_day)).cast("long").alias("days_since_so_launch"))


def build_dim_date(spark: SparkSession, start: Moment = CALENDAR[0], end: Moment = CALENDAR[1],
                   launch_day: Moment = LAUNCH_DAY) -> DataFrame:
    return calendar_columns(date_spine(spark, start, end), launch_day)


def user_attributes(stg_users: DataFrame) -> DataFrame:
    return stg_users.select(
        "user_id", "display_name", "account_creation_date", "account_creation_date_date",
        "last_access_date", "account_age_days",
        labels.account_age_bucket("account_age_days").alias("account_age_bucket"),
        "reputation", "reputation_bucket", "reputation_bucket_ordinal", "up_votes", "down_votes",
        "profile_views", "location", "is_active", F.col("_staged_at").alias("dim_updated_at"))


def add_unknown_member(dim: DataFrame, defaults: dict = UNKNOWN_USER, as_of: Moment = None) -> DataFrame:
    """Append the literal row that facts without an owner point to."""
    def value(f):
        if f.name == "dim_updated_at":
            return ntz(as_of).alias(f.name)
        return F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name)
    extra = dim.sparkSession.range(1).select(*[value(f) for f in dim.schema.fields])
    return dim.unionByName(extra)


def build_dim_user(stg_users: DataFrame, as_of: Moment = None) -> DataFrame:
    return add_unknown_member(user_attributes(stg_users), as_of=as_of)


def reputation_counts(users: DataFrame) -> DataFrame:
    """Users per reputation and block of ids; combined before the shuffle, so a reputation that most users have is no hot key."""
    return users.groupBy("reputation_bucket", "reputation", F.shiftright("user_id", ID_BLOCK_BITS).alias("id_block")).agg(
        F.sum(F.col("_sign") if "_sign" in users.columns else F.lit(1)).alias("n"))


def ranked_users(stg_users: DataFrame, among: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """User attributes with percentile, quartile and rank inside the reputation bucket.

    Ranks are looked up: users with a lower (higher) reputation come from prefix sums over
    the counts per reputation, users before one of equal reputation from prefix sums over
    id blocks, and within a block of ids at most 2^ID_BLOCK_BITS users are numbered. Users
    are not sorted as a whole. ``among`` are all users where ``stg_users`` are only some of
    them, and ``counts`` their stored ``reputation_counts``.

    The one window without a key runs over distinct reputations, at most 2,000,000 by the
    rules of staging.
    """
    everyone = stg_users if among is None else among
    counts = counts if counts is not None else stored(reputation_counts(everyone))
    values = counts.groupBy("reputation_bucket", "reputation").agg(F.sum("n").alias("n"))
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    up = W.orderBy(F.col("reputation").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    down = W.partitionBy("reputation_bucket").orderBy(F.col("reputation").desc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    places = values.select(F.col("reputation").alias("_value"), F.coalesce(F.sum("n").over(up), F.lit(0)).alias("_lower"),
                           F.coalesce(F.sum("n").over(down), F.lit(0)).alias("_higher"))
    earlier = W.partitionBy("reputation").orderBy("id_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = (counts.select(F.col("reputation").alias("_value"), F.col("id_block").alias("_block"),
                            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")).join(places, "_value"))

    block = F.shiftright("user_id", ID_BLOCK_BITS)
    members = everyone.select("user_id", "reputation", block.alias("id_block"))
    if among is not None:
        wanted = stg_users.select("reputation", block.alias("id_block")).distinct()
        members = near_keys(members, "id_block", wanted).join(wanted, ["reputation", "id_block"], "left_semi")
    inside = members.withColumn("_at", F.row_number().over(W.partitionBy("reputation", "id_block").orderBy("user_id")))
    placed = inside.join(blocks, (inside["reputation"] == blocks["_value"]) & (inside["id_block"] == blocks["_block"])).select(
        F.col("user_id").alias("_user"), "_lower", "_higher", (F.col("_before") + F.col("_at")).alias("_tie"))
    return user_attributes(stg_users).join(placed, F.col("user_id") == F.col("_user")).withColumns({
        "reputation_percentile_pct": rnd(F.col("_lower") / F.lit(float(max(total - 1, 1))) * 100.0, 2),
        "reputation_quartile": ntile_of(F.col("_lower") + F.col("_tie"), total, 4),
        "rank_within_bucket": (F.col("_higher") + F.col("_tie")).cast("long"),
    }).drop("_user", "_lower", "_higher", "_tie")


def distinct_tags(posts: DataFrame) -> DataFrame:
    return explode_tags(posts).select("tag_name").distinct()


def build_dim_tag(posts: DataFrame, as_of: Moment = None) -> DataFrame:
    return distinct_tags(posts).select(
        stable_key("tag_name").alias("tag_key"), "tag_name",
        labels.tag_category("tag_name").alias("tag_category"),
        ntz(as_of).alias("dim_created_at"))


def dimension_report(tables: dict[str, tuple[DataFrame, str, str | None]]) -> DataFrame:
    """Rows, date range and NULL keys per dimension: name -> (table, key, date column or None)."""
    def summary(name, df, key, date):
        dates = [F.min(date), F.max(date)] if date else [F.lit(None).cast("date")] * 2
        return df.agg(F.lit(name).alias("dimension"), F.count("*").alias("row_count"),
                      dates[0].alias("min_date"), dates[1].alias("max_date"),
                      F.count_if(F.col(key).isNull()).alias("null_keys"))
    return reduce(DataFrame.unionByName, [summary(n, *spec) for n, spec in tables.items()])
