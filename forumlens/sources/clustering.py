"""Tables clustered by several columns at once.

A sort by two columns orders the first and scatters the second: its minimum and maximum
span nearly everything in every file, so a filter on it alone opens them all. Here every
column is cut into ``2 ** BITS`` ranges that hold about equally many rows, and rows are
ordered by the interleaved bits of their range numbers. Files and row groups are then
small boxes in all columns, and a filter on any one of them skips most.

Reclustering is upkeep, as a warehouse does it behind the scenes: daily writes stay cheap
and sorted by the first column, and folders that have settled are rewritten now and then.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import Moment
from . import tables

#: Bits of a range number; a column has at most 2 ** BITS - 1 cuts, which is all that reaches the driver.
BITS = 8
#: Bytes of a text that decide its place.
_TEXT_BYTES = 6


def ordered_number(column: Column, kind: T.DataType) -> Column:
    """A number in the order of the values: of texts the first bytes, of days and times their distance from 1970."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.substring(column.cast("binary"), 1, _TEXT_BYTES)
        return F.conv(F.rpad(F.hex(head), 2 * _TEXT_BYTES, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def cuts(df: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list[float]]:
    """For every column the values where ranges of about equally many rows begin, over all rows; NULLs are left out."""
    shares = F.array(*[F.lit(i / 2 ** bits) for i in range(1, 2 ** bits)])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    found = df.agg(*[F.percentile_approx(ordered_number(F.col(c), kinds[c]), shares, 10_000).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def range_number(value: Column, at: list[float], bits: int = BITS) -> Column:
    """How many cuts lie at or below ``value``, by bisection; NULL counts as below all."""
    if not at:
        return F.lit(0)
    padded = F.array(*[F.lit(v) for v in [*at, *[float("inf")] * (2 ** bits - 1 - len(at))]])
    steps = F.array(*[F.lit(2 ** b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda n, s: n + F.when(value >= F.get(padded, n + s - 1), s).otherwise(0))


def interleaved(numbers: list[Column], bits: int = BITS) -> Column:
    """One number from the bits of several, highest bits first."""
    parts = [F.shiftleft(F.shiftright(n, b).bitwiseAND(F.lit(1)).cast("long"), b * len(numbers) + len(numbers) - 1 - i)
             for b in range(bits) for i, n in enumerate(numbers)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def in_boxes(df: DataFrame, columns: list[str], within: list[str] = [], bits: int = BITS) -> DataFrame:
    """``df`` in tasks and order of its boxes (inside ``within``); ``df`` is read three times, so it should be stored.

    A value that very many rows share is split by the other columns and then by a hash of the row.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    at = cuts(df, columns, bits)
    numbered = df.withColumns({f"_n{i}": range_number(ordered_number(F.col(c), kinds[c]), at[c], bits) for i, c in enumerate(columns)})
    placed = numbered.withColumn("_box", interleaved([F.col(f"_n{i}") for i in range(len(columns))], bits))
    order = [*within, "_box", *columns]
    split = F.xxhash64(*[c for c, kind in kinds.items() if not isinstance(kind, (T.MapType, T.VariantType))])
    return (placed.repartitionByRange(*order, split).sortWithinPartitions(*order)
            .drop("_box", *[f"_n{i}" for i in range(len(columns))]))


def recluster(spark: SparkSession, root: str, layer: str, table: str, columns: list[str] | None = None,
              between: tuple[Moment, Moment] | None = None) -> int:
    """Rewrite the stored table (or the folders of ``between``) in boxes of its cluster columns; the number of files replaced.

    Rows stay as they are. New files are complete before the old ones go, as in a merge; an
    empty table or an empty range is left alone.
    """
    columns = columns or tables.CLUSTERS[table]
    part = tables.PARTITIONS[table][0] if table in tables.PARTITIONS else None
    if between and not part:
        raise ValueError(f"{table} has no partition folders to choose from")
    rows = tables.read_layer(spark, root, layer, table, between=between, keep_partition=True)
    old = rows.inputFiles() if not between else [
        r["f"] for r in rows.select(F.col("_metadata.file_path").alias("f")).distinct().toLocalIterator()]
    if not old:
        return 0
    writer = in_boxes(rows, columns, [part] if part else []).write.mode("append")
    (writer.partitionBy(part) if part else writer).parquet(tables.table_path(root, layer, table))
    for f in old:
        tables.delete(spark, f)
    return len(old)
