"""Deduplication, tag explosion, anti joins, grouped medians and one-row lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import rnd
from ..functions.text import stripped, tag_parts


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest row per key.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the
    shuffle, so a key with very many copies does not travel. ``tiebreak`` makes the
    choice among equals repeatable.
    """
    order = [F.col(c).desc_nulls_last() for c in (*order_by, *tiebreak)]
    newest = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(newest)).filter("_copy = 1").drop("_copy")


def explode_tags(df: DataFrame, keep: Sequence[str] = (), tags: str = "tags_clean",
                 mark_first: bool = False) -> DataFrame:
    """One row per post and tag: ``keep`` and ``tag_name``, lower-cased and stripped.

    A tag that a post names twice gives two rows; ``mark_first`` adds ``first_in_post``,
    true for one of them. The tag list is tidied as one string, which stays in compiled
    code where a function over array elements would not.
    """
    tagged = df.filter(F.col(tags).isNotNull() & (F.col(tags) != ""))
    text = F.lower(stripped(tags))
    spaced = F.regexp_replace(text, r"(?U)\s*\|\s*", "|")
    parts = tag_parts(F.when(text.rlike(r"(?U)\s"), spaced).otherwise(text))
    if not mark_first:
        rows = tagged.select(*keep, F.explode(parts).alias("tag_name"))
    else:
        listed = tagged.select(*keep, parts.alias("_parts"))
        placed = listed.select(*keep, "_parts", F.posexplode("_parts").alias("_at", "tag_name"))
        rows = placed.select(*keep, "tag_name", (F.array_position("_parts", F.col("tag_name"))
                                                 == F.col("_at") + 1).alias("first_in_post"))
    return rows.filter(F.col("tag_name") != "")


def orphans(child: DataFrame, parent: DataFrame, on: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is NULL or absent from the parent."""
    keys = parent.select(F.col(parent_key or on).alias(on))
    return child.join(keys, on, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, on: str, parent_key: str | None = None) -> DataFrame:
    """Number of orphan rows; child rows are counted per key before they are shuffled."""
    per_key = child.groupBy(on).agg(F.count("*").alias("n"))
    return orphans(per_key, parent, on, parent_key).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "occurrence_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def distinct_and_estimate(df: DataFrame, key: str, value: str, error: float = 0.02) -> DataFrame:
    """Distinct values per key, counted (``n_distinct``) and estimated by a sketch (``estimate``).

    Equal pairs are combined first, so a task holds one sketch per key. Beside a distinct
    count in one aggregation Spark would hold a sketch for every pair of key and value.
    """
    return df.select(key, value).distinct().groupBy(key).agg(
        F.count(value).alias("n_distinct"), F.approx_count_distinct(value, error).alias("estimate"))


def first_event(df: DataFrame, key: str, ts: str, flag: Column | None = None,
                first: str = "first_at", first_flagged: str = "first_flagged_at") -> DataFrame:
    """Earliest time per key, and the earliest among flagged rows."""
    aggregates = [F.min(ts).alias(first)]
    if flag is not None:
        aggregates.append(F.min(F.when(flag, F.col(ts))).alias(first_flagged))
    return df.groupBy(key).agg(*aggregates)


def one_row(df: DataFrame, **aggregates: Column) -> Column:
    """Aggregates of a whole table as a struct usable in another table's expressions.

    It is a scalar subquery: computed once and inlined, with no join.
    """
    return df.agg(F.struct(*[c.alias(n) for n, c in aggregates.items()]).alias("_one")).scalar()


def minmax(df: DataFrame, columns: dict[str, str], digits: int = 2) -> DataFrame:
    """Each source column mapped to 0..100 over the whole table, under its new name."""
    bounds = {}
    for source in columns.values():
        bounds[f"{source}_lo"] = F.min(source)
        bounds[f"{source}_hi"] = F.max(source)
    ends = one_row(df, **bounds)

    def scaled(source):
        lo, hi = ends[f"{source}_lo"].cast("double"), ends[f"{source}_hi"].cast("double")
        return rnd((F.col(source) - lo) * 100.0 / F.nullif(hi - lo, F.lit(0.0)), digits)

    return df.withColumns({new: scaled(source) for new, source in columns.items()})


def middle_value(value: str, weight: Column, upto: Column, total: Column,
                 interpolate: bool = True) -> Column:
    """Median as an aggregate over (value, weight) rows with their running weight.

    The two middle positions coincide when the total is odd; without interpolation the
    lower one is taken.
    """
    low = F.floor((total + 1) / 2)
    high = F.floor((total + 2) / 2) if interpolate else low
    counted = weight > 0
    return (F.min(F.when(counted & (upto >= low), F.col(value)))
            + F.min(F.when(counted & (upto >= high), F.col(value)))) / 2.0


def with_running_weight(df: DataFrame, key: str, value: str, weight: Column) -> DataFrame:
    """``df`` with ``_w``, its running sum ``_upto`` in the order of values, and the group's ``_total``.

    Rows are range-sorted on (key, value), so a large group lies in several tasks; what a
    task adds up is one row per task and group, and sums before a task come from those.
    """
    from .ranking import sorted_blocks

    blocks = sorted_blocks(df.withColumn("_w", weight), [(key, False), (value, False)])
    parts = blocks.groupBy(F.col(key).alias("_key"), F.col("_block").alias("_part")).agg(F.sum("_w").alias("_sum"))
    group = W.partitionBy("_key")
    before = group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("_key", "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
                         F.sum("_sum").over(group).alias("_total"))
    inside = W.partitionBy(key, "_block").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    return (blocks.withColumn("_inside", F.sum("_w").over(inside))
            .join(parts, blocks[key].eqNullSafe(F.col("_key")) & (F.col("_block") == F.col("_part")))
            .withColumn("_upto", F.col("_before") + F.col("_inside"))
            .drop("_key", "_part", "_before", "_inside", "_block", "_at"))


def grouped_median(df: DataFrame, key: str, value: str, name: str = "median",
                   interpolate: bool = True) -> DataFrame:
    """Exact median per key.

    Equal values are counted before the shuffle and a running count over many tasks finds
    the middle, so no task holds all the values of a large group.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    placed = with_running_weight(counts, key, value, F.col("_n"))
    return placed.groupBy(key).agg(
        middle_value(value, F.col("_n"), F.col("_upto"), F.col("_total"), interpolate).alias(name))
