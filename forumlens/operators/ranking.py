"""Ranks over a whole table without putting the whole table in one task.

A window with an order but no partition moves every row to a single task. Here the rows
(or, for ranks, the distinct values) are range-sorted over many tasks and stored; the
number of a row is then its place within its task plus the row count of earlier tasks.
Those counts have one row per task, so they are bounded by the partition count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import rnd
from ..session import stored

# A table of ranks up to this many distinct values is small enough to broadcast.
SMALL_LOOKUP = 500_000
_INDEX_BITS = 33


def _order(terms: list[tuple[str, bool]]) -> list[Column]:
    """(column, descending) pairs; NULL is the smallest value, as in both sort directions."""
    return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_first() for c, down in terms]


def sorted_blocks(df: DataFrame, terms: list[tuple[str, bool]]) -> DataFrame:
    """``df`` range-sorted and stored, with ``_block`` and place in block ``_at``."""
    place = F.monotonically_increasing_id()
    rows = stored(df.orderBy(*_order(terms)).withColumn("_place", place))
    return (rows.withColumn("_block", F.shiftright("_place", _INDEX_BITS))
            .withColumn("_at", F.col("_place").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)))
            .drop("_place"))


def _earlier(blocks: DataFrame, **totals: Column) -> DataFrame:
    """Per block, the totals over all earlier blocks (one row per sort task)."""
    per_block = blocks.groupBy("_block").agg(*[c.alias(n) for n, c in totals.items()])
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    return per_block.select("_block", *[
        F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in totals])


def global_row_number(df: DataFrame, terms: list[tuple[str, bool]], name: str = "row_number") -> DataFrame:
    """Consecutive numbers from 1 in the given order, which should be total."""
    blocks = sorted_blocks(df, terms)
    offsets = F.broadcast(_earlier(blocks, _rows=F.count("*")))
    return (blocks.join(offsets, "_block")
            .withColumn(name, (F.col("_rows") + F.col("_at") + 1).cast("long"))
            .drop("_block", "_at", "_rows"))


def value_ranks(df: DataFrame, column: str, descending: bool = True) -> DataFrame:
    """One row per distinct value: ``n`` rows, ``rank``, ``dense_rank``.

    Counting equal values first means a value shared by a third of the rows is one row
    from there on.
    """
    values = df.groupBy(column).agg(F.count("*").alias("n"))
    blocks = sorted_blocks(values, [(column, descending)])
    offsets = F.broadcast(_earlier(blocks, _rows=F.sum("n"), _values=F.count("*")))
    before = W.partitionBy("_block").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(before), F.lit(0))
    return (blocks.withColumn("_inside", inside).join(offsets, "_block")
            .select(column, "n",
                    (F.col("_rows") + F.col("_inside") + 1).cast("long").alias("rank"),
                    (F.col("_values") + F.col("_at") + 1).cast("long").alias("dense_rank")))


def attach_ranks(df: DataFrame, ranks: DataFrame, column: str, total: int,
                 take: dict[str, str], small_lookup: int = SMALL_LOOKUP) -> DataFrame:
    """Bring per-value ranks back to the rows.

    Few values: broadcast. Many values: those held by more than a thousandth of the rows
    (at most a thousand of them) are broadcast; the others are joined by a shuffle in which
    rows already served carry a salt of their own, so that a hot value spreads over all
    tasks instead of meeting in one.
    """
    picked = ranks.select(F.col(column).alias("_value"), "n", *[F.col(s).alias(t) for s, t in take.items()])
    if picked.count() <= small_lookup:
        few = F.broadcast(picked.drop("n"))
        return df.join(few, df[column].eqNullSafe(few["_value"])).drop("_value")

    hot_from = max(total // 1000, 1)
    hot = picked.filter(F.col("n") > hot_from).select(
        F.col("_value").alias("_hot"), *[F.col(t).alias(f"_hot{t}") for t in take.values()])
    served = df.join(F.broadcast(hot), F.col(column).eqNullSafe(F.col("_hot")), "left")
    first = next(iter(take.values()))
    salt = F.when(F.col(f"_hot{first}").isNotNull(),
                  F.pmod(F.xxhash64(*df.columns), F.lit(1_000_003)) + 1).otherwise(F.lit(0))
    # zero for every value, written so that the planner keeps it as a join key
    cold = picked.filter(F.col("n") <= hot_from).withColumn("_zero", F.least(F.col("n"), F.lit(1)) - 1).drop("n")
    out = served.withColumn("_salt", salt).join(
        cold, F.col(column).eqNullSafe(F.col("_value")) & (F.col("_salt") == F.col("_zero")), "left")
    return out.select(*df.columns, *[F.coalesce(f"_hot{t}", t).alias(t) for t in take.values()])


def ntile_of(number: Column, total: int, tiles: int) -> Column:
    """Tile of a row number: the first ``total mod tiles`` tiles hold one row more."""
    size, extra = divmod(total, tiles)
    edge = extra * (size + 1)
    large = F.ceil(number / F.lit(size + 1))
    if size == 0:
        return large.cast("long")
    return F.when(number <= edge, large).otherwise(
        F.lit(extra) + F.ceil((number - edge) / F.lit(size))).cast("long")


@dataclass(frozen=True)
class Rank:
    """A ranking column: ``kind`` is rank, dense_rank, percent_rank (x100, two decimals),
    row_number or ntile. ``within`` restarts row_number per value of a column. Ties in row_number and ntile are settled by the table's ``tiebreak``."""

    name: str
    kind: str
    by: str
    descending: bool = True
    tiles: int = 0
    within: str | None = None


def _plain(df: DataFrame, spec: Rank, tiebreak: list[str]) -> Column:
    ties = [F.col(c).asc() for c in tiebreak]
    exact = _order([(spec.by, spec.descending)])
    if spec.kind == "rank":
        out = F.rank().over(W.orderBy(*exact))
    elif spec.kind == "dense_rank":
        out = F.dense_rank().over(W.orderBy(*exact))
    elif spec.kind == "percent_rank":
        return rnd(F.percent_rank().over(W.orderBy(*exact)) * 100.0, 2)
    elif spec.kind == "ntile":
        out = F.ntile(spec.tiles).over(W.orderBy(*exact, *ties))
    elif spec.within:
        out = F.row_number().over(W.partitionBy(spec.within).orderBy(*exact, *ties))
    else:
        out = F.row_number().over(W.orderBy(*exact, *ties))
    return out.cast("long")


def with_ranks(df: DataFrame, specs: list[Rank], tiebreak: list[str],
               one_task: bool = False, small_lookup: int = SMALL_LOOKUP) -> DataFrame:
    """Add ranking columns to a table of any size.

    The table is stored once. Ranks are computed on the ranked columns alone, by range
    sorts over many tasks, and joined to the rows in the end. ``one_task`` takes plain
    windows instead, which hold all rows in one task: for callers whose tables have a bound
    of their own (one row per tag).
    """
    base = stored(df.withColumn("_row", F.monotonically_increasing_id()))
    if one_task:
        return base.withColumns({s.name: _plain(base, s, tiebreak) for s in specs}).drop("_row")

    total = base.count()
    narrow = base.select(*dict.fromkeys(["_row", *tiebreak, *[s.by for s in specs], *[s.within for s in specs if s.within]]))
    out = narrow
    value_specs: dict[tuple[str, bool], list[Rank]] = {}
    number_specs: dict[tuple[str, bool, str | None], list[Rank]] = {}
    for s in specs:
        if s.kind in ("rank", "dense_rank", "percent_rank"):
            value_specs.setdefault((s.by, s.descending), []).append(s)
        else:
            number_specs.setdefault((s.by, s.descending, s.within), []).append(s)

    for (by, down, within), group in number_specs.items():
        terms = ([(within, False)] if within else []) + [(by, down)] + [(t, False) for t in tiebreak]
        numbered = global_row_number(out, terms, "_number")
        if within:
            sizes = stored(numbered.groupBy(F.col(within).alias("_within")).agg(F.min("_number").alias("_first")))
            if sizes.count() <= small_lookup:
                sizes = F.broadcast(sizes)
            numbered = numbered.join(sizes, numbered[within].eqNullSafe(F.col("_within"))).withColumn(
                "_number", F.col("_number") - F.col("_first") + 1).drop("_within", "_first")
        new = {s.name: (F.col("_number") if s.kind == "row_number"
                        else ntile_of(F.col("_number"), total, s.tiles)) for s in group}
        out = numbered.withColumns(new).drop("_number")

    for (by, down), group in value_specs.items():
        take = {"rank": "_rank", "dense_rank": "_dense"}
        out = attach_ranks(out, value_ranks(narrow, by, down), by, total, take, small_lookup)

        def final(s: Rank) -> Column:
            if s.kind == "percent_rank":
                return rnd((F.col("_rank") - 1) / F.lit(float(max(total - 1, 1))) * 100.0, 2)
            return F.col("_rank") if s.kind == "rank" else F.col("_dense")
        out = out.withColumns({s.name: final(s) for s in group}).drop("_rank", "_dense")

    return base.join(out.select("_row", *[s.name for s in specs]), "_row").select(*df.columns, *[s.name for s in specs])
