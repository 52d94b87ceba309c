"""Upserts: change detection, high-water marks, and merges that move little data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import Moment, as_python_date
from ..session import stored, stored_with
from .keyfilter import near_keys

EPOCH = "2008-01-01 00:00:00"


def read_watermark(df: DataFrame, column: str, default: str = EPOCH) -> str:
    """Largest value of a timestamp column as text, or the default for an empty table.

    Returned to the driver as one value so that later filters are literals and reach the scan.
    """
    top = df.agg(F.coalesce(F.max(column).cast("string"), F.lit(default)).alias("top"))
    return top.first()["top"]


def watermark(df: DataFrame, column: str, default: str = EPOCH) -> DataFrame:
    """The same as a one-row table."""
    return df.agg(F.coalesce(F.max(column).cast("timestamp_ntz"),
                             F.lit(default).cast("timestamp_ntz")).alias("watermark"))


def changed(columns: Sequence[str], null_safe: Sequence[str] = (), old: str = "t_", new: str = "s_") -> Column:
    """True when any column differs.

    An ordinary column with a NULL on either side counts as unchanged; a ``null_safe``
    column treats NULL as a value.
    """
    plain = [F.coalesce(F.col(old + c) != F.col(new + c), F.lit(False)) for c in columns]
    strict = [~F.col(old + c).eqNullSafe(F.col(new + c)) for c in null_safe]
    return reduce(lambda a, b: a | b, plain + strict)


@dataclass(frozen=True)
class MergeRule:
    """How one table takes changes: its key, what counts as a change, what is overwritten."""

    key: str
    compare: tuple[str, ...]
    overwrite: tuple[str, ...]
    compare_null_safe: tuple[str, ...] = ()
    only_if_newer: str | None = None
    # an append-only table takes changed rows as new versions, stamped by this column
    version_by: str | None = None

    def read_columns(self) -> list[str]:
        """Columns needed to decide what happens to a row."""
        newer = [self.only_if_newer] if self.only_if_newer else []
        return list(dict.fromkeys([self.key, *self.compare, *self.compare_null_safe, *newer]))

    def condition(self) -> Column:
        test = changed(self.compare, self.compare_null_safe)
        if self.only_if_newer:
            c = self.only_if_newer
            test = test & F.coalesce(F.col("s_" + c) >= F.col("t_" + c), F.lit(True))
        return test


class DuplicateKeyError(ValueError):
    """A change set names the same key twice, so the merge has no single answer."""


def reject_duplicate_keys(source: DataFrame, key: str) -> int:
    """Row count of the change set; raises if a key occurs twice (NULL keys match nothing and may repeat)."""
    per_key = source.groupBy(key).agg(F.count("*").alias("n"))
    most = F.max(F.when(F.col(key).isNotNull(), F.col("n")))
    seen = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), most.alias("most")).first()
    if (seen["most"] or 0) > 1:
        raise DuplicateKeyError(f"change set has more than one row for a {key}")
    return seen["rows"]


def evolve(df: DataFrame, like: DataFrame) -> DataFrame:
    """Add the columns of ``like`` that ``df`` lacks, as NULL."""
    new = {f.name: F.lit(None).cast(f.dataType) for f in like.schema.fields if f.name not in df.columns}
    return df.withColumns(new) if new else df


def _prefixed(df: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in (columns or df.columns)])


def merge_upsert(target: DataFrame, source: DataFrame, rule: MergeRule,
                 target_range: Column | None = None, check: bool = True, with_old: bool = False) -> DataFrame:
    """Target after the merge, with ``_action`` UPDATE, INSERT or KEEP per row.

    Every matched row that changed takes the rule's ``overwrite`` columns, unmatched source
    rows are inserted, everything else stays; a NULL key matches nothing on either side.
    Columns are matched by name and new ones are added. ``target_range`` limits which
    target rows may match. ``with_old`` adds ``_old``, the row as it was before an update.
    """
    if check:
        reject_duplicate_keys(source, rule.key)
    target = evolve(target, source)
    source = evolve(source, target)
    if target_range is not None:
        inside = F.coalesce(target_range, F.lit(False))
        outside = target.filter(~inside).withColumn("_action", F.lit("KEEP"))
        within = merge_upsert(target.filter(inside), source, rule, None, False, with_old)
        return within.unionByName(outside, allowMissingColumns=True)

    return _merged(target, source, rule, "full_outer", with_old)


def merge_kept(target: DataFrame, source: DataFrame, rule: MergeRule, target_range: Column | None = None, with_old: bool = False) -> DataFrame:
    """Target rows as ``merge_upsert`` leaves them, without inserts: source rows that match none are dropped in the join."""
    target = evolve(target, source)
    source = evolve(source, target)
    if target_range is None:
        return _merged(target, source, rule, "left_outer", with_old)
    inside = F.coalesce(target_range, F.lit(False))
    within = _merged(target.filter(inside), source, rule, "left_outer", with_old)
    return within.unionByName(target.filter(~inside).withColumn("_action", F.lit("KEEP")), allowMissingColumns=True)


def _merged(target: DataFrame, source: DataFrame, rule: MergeRule, how: str, with_old: bool) -> DataFrame:
    names = target.columns
    # marks of presence: a key may be NULL in a row that is there
    both = _prefixed(target, "t_").withColumn("_in_target", F.lit(True)).join(
        _prefixed(source, "s_").withColumn("_in_source", F.lit(True)),
        F.col("t_" + rule.key) == F.col("s_" + rule.key), how)
    action = (F.when(F.col("_in_target").isNull(), F.lit("INSERT"))
              .when(F.col("_in_source").isNotNull() & rule.condition(), F.lit("UPDATE"))
              .otherwise(F.lit("KEEP")))
    both = both.withColumn("_action", action)

    def final(c):
        if c in rule.overwrite:
            return F.when(F.col("_action") == "KEEP", F.col("t_" + c)).otherwise(F.col("s_" + c)).alias(c)
        return F.when(F.col("_action") == "INSERT", F.col("s_" + c)).otherwise(F.col("t_" + c)).alias(c)
    old = [F.when(F.col("_action") == "UPDATE", F.struct(*[F.col("t_" + c).alias(c) for c in names])).alias("_old")] if with_old else []
    return both.select(*[final(c) for c in names], "_action", *old)


def action_counts() -> dict[str, Column]:
    """Inserted and updated rows, to be counted while a merge is written."""
    return {"inserted": F.count_if(F.col("_action") == "INSERT"), "updated": F.count_if(F.col("_action") == "UPDATE")}


@dataclass
class MergeResult:
    inserted: int = 0
    updated: int = 0
    processed: int = 0
    partitions: list = field(default_factory=list)


def merge_into_table(root: str, layer: str, table: str, source: DataFrame, rule: MergeRule,
                     target_between: tuple[str, Moment, Moment] | None = None, feed: str | None = None) -> MergeResult:
    """Merge a change set into a stored table; a missing table is created from it.

    An append-only table (``version_by``) takes new and changed rows into the folder they
    belong to and nothing else is written. A partitioned table is first read for its key
    and compared columns only, which tells the files with changed rows (what is shuffled are
    rows that may have a partner); those files alone are read in full and replaced. An
    unpartitioned table is merged as a whole.

    ``feed`` names a folder to which every inserted and updated row is appended before the
    table changes: its final values, ``_action``, and ``_old``, the row before (NULL when inserted).
    """
    from ..sources import tables

    def tell(changes: DataFrame) -> None:
        if feed:
            changes.write.mode("append").parquet(feed)

    source = stored(source)
    rows = reject_duplicate_keys(source, rule.key)
    spark = source.sparkSession
    if not tables.exists(spark, tables.table_path(root, layer, table)):
        tell(_inserted(source))
        tables.store(source, root, layer, table)
        return MergeResult(inserted=rows, processed=rows)
    if rows == 0:
        return MergeResult()
    span = None
    if target_between:
        column, lo, hi = target_between
        span = F.col(column).between(F.lit(as_python_date(lo)), F.lit(as_python_date(hi)))
    if rule.version_by:
        return _append_versions(root, layer, table, source, rows, rule)
    if table in tables.PARTITIONS:
        return _merge_files(root, layer, table, source, rows, rule, span, target_between, tell if feed else None)

    target = tables.read_layer(spark, root, layer, table)
    merged, counts = stored_with(merge_upsert(target, source, rule, span, False, with_old=True), **action_counts())
    if counts["inserted"] or counts["updated"]:
        tell(merged.filter("_action <> 'KEEP'"))
        tables.store(merged.drop("_action", "_old"), root, layer, table)
    return MergeResult(counts["inserted"], counts["updated"], rows)


def _inserted(rows: DataFrame) -> DataFrame:
    """Rows as a feed tells them when they are new."""
    return rows.select("*", F.lit("INSERT").alias("_action"), F.lit(None).cast(rows.schema).alias("_old"))


def read_feed(spark, path: str, schema) -> DataFrame:
    """Changes told to a folder, for rows of ``schema``; none where there is no folder yet."""
    from pyspark.sql import types as T

    from ..sources import tables

    fields = T.StructType([*schema.fields, T.StructField("_action", T.StringType()), T.StructField("_old", schema)])
    return spark.read.schema(fields).parquet(path) if tables.exists(spark, path) else spark.createDataFrame([], fields)


def newest_versions(df: DataFrame, rule: MergeRule) -> DataFrame:
    """The newest version of every key of an append-only table; of copies in one load all stay. NULL keys stay."""
    newest = df.groupBy(rule.key).agg(F.max(rule.version_by).alias("_newest")).withColumnRenamed(rule.key, "_key")
    return (df.join(newest, F.col(rule.key).eqNullSafe(F.col("_key")))
            .filter(F.col(rule.key).isNull() | F.col(rule.version_by).eqNullSafe(F.col("_newest"))).select(*df.columns))


def _append_versions(root, layer, table, source, rows, rule) -> MergeResult:
    """Add source rows that no copy of the newest load equals."""
    from ..sources import tables

    spark = source.sparkSession
    target = evolve(tables.read_layer(spark, root, layer, table), source)
    full = evolve(source, target)
    columns = list(dict.fromkeys([*rule.read_columns(), rule.version_by]))
    # only versions whose key is among the changes, as far as a bitmap can tell, are shuffled
    pairs = _prefixed(near_keys(target, rule.key, full), "t_", columns).join(_prefixed(full, "s_", rule.read_columns()),
                                                  F.col("t_" + rule.key) == F.col("s_" + rule.key))
    state = (pairs.groupBy(F.col("s_" + rule.key).alias("_key"))
             .agg(F.max(F.struct(F.col("t_" + rule.version_by), (~rule.condition()).alias("same"))).alias("_last"))
             .select("_key", F.col("_last.same").alias("_same")))
    taken, counts = stored_with(full.join(state, F.col(rule.key) == F.col("_key"), "left").filter(F.col("_same").isNull() | ~F.col("_same")),
                                new=F.count_if(F.col("_same").isNull()), changed=F.count_if(F.col("_same").isNotNull()))
    if counts["new"] or counts["changed"]:
        # versions of one load go to one folder
        tables.append(taken.select(*target.columns), root, layer, table, in_place=True)
    return MergeResult(counts["new"], counts["changed"], rows)


def _merge_files(root, layer, table, source, rows, rule, span, target_between, tell) -> MergeResult:
    """Replace the files that hold changed rows; new rows become new files.

    Inserts are decided by an anti join on matched keys and updates row by row, so keys
    that the target repeats or lacks cannot mislead either count. New files are complete
    before old ones go: a stop in between leaves both copies and never loses a row.
    """
    from ..sources import tables

    spark = source.sparkSession
    everything = tables.read_layer(spark, root, layer, table, keep_partition=True, with_file="_file")
    target = evolve(everything, source)
    near = target
    if span is not None:
        near = tables.folders_between(near, table, *target_between[1:]).filter(span)
    full = evolve(source, target.drop("_file", tables.PARTITIONS[table][0]))
    # only rows whose key is among the changes, as far as a bitmap can tell, are shuffled
    pairs = (_prefixed(near_keys(near, rule.key, full), "t_", [*rule.read_columns(), "_file"])
             .join(_prefixed(full, "s_", rule.read_columns()), F.col("t_" + rule.key) == F.col("s_" + rule.key))
             .select(F.col("s_" + rule.key).alias("_key"), F.col("t__file").alias("_file"), rule.condition().alias("changed")))
    found, old = stored_with(pairs, updated=F.count_if("changed"))
    fresh, new = stored_with(full.join(found.select("_key").distinct(), F.col(rule.key) == F.col("_key"), "left_anti"),
                             inserted=F.count(F.lit(1)))
    # names of files that are about to be replaced
    dirty = [r["_file"] for r in found.filter("changed").select("_file").distinct().collect()]
    result = MergeResult(new["inserted"], old["updated"], rows)
    if not result.inserted and not result.updated:
        return result

    out, names = fresh, [c for c in target.columns if c not in ("_file", tables.PARTITIONS[table][0])]
    changes = _inserted(fresh.select(*names))
    if dirty:
        merged = merge_kept(tables.read_files(spark, root, layer, table, dirty), full, rule, span, with_old=tell is not None)
        if tell:
            # joined once: the feed and the new files are both taken from it
            merged = stored(merged)
            updated = merged.filter("_action = 'UPDATE'")
            changes = changes.unionByName(updated.select(*names, "_action", F.struct(*[F.col(f"_old.{c}").alias(c) for c in names]).alias("_old")))
        out = merged.drop("_action", "_old").unionByName(fresh, allowMissingColumns=True)
    if tell:
        tell(changes)
    result.partitions = tables.replace_files(spark, out, root, layer, table, dirty)
    return result
