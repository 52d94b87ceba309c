"""Layers on disk: namespaces, partitioned and clustered writes, reads, retention, audit."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import Moment, as_python_date, ntz
from ..session import smaller_pieces, watched
from . import schemas

# Namespaces of the warehouse and how long raw partitions are kept.
LAYERS = {
    "raw": "Source-faithful copies with load columns; partitions expire after 60 days",
    "staging": "Deduplicated, typed and enriched rows",
    "warehouse": "Star schema of dimensions and facts",
    "marts": "Aggregated tables for reporting",
    "aggregates": "Sums that changes are added to and marts are computed from",
}
RAW_RETENTION_DAYS = 60

# Tables too wide to rewrite as a whole: their partition column and what it is made of.
PARTITIONS = {
    "raw_questions": ("load_day", "_ingested_at", "day"),
    "raw_answers": ("load_day", "_ingested_at", "day"),
    "raw_users": ("load_day", "_ingested_at", "day"),
    "stg_questions": ("month_start", "question_date", "month"),
    "stg_answers": ("month_start", "answer_date", "month"),
    "stg_users": ("month_start", "account_creation_date_date", "month"),
    "dim_user": ("month_start", "account_creation_date_date", "month"),
    "fact_questions": ("month_start", "creation_date", "month"),
    "fact_answers": ("month_start", "creation_date", "month"),
    "fact_user_activity": ("month_start", "activity_date", "month"),
    "agg_tag_user": ("year_start", "period", "year"),
    "agg_tag_latency": ("year_start", "period", "year"),
    "agg_user_posts": ("year_start", "period", "year"),
    "agg_month_users": ("year_start", "period", "year"),
    "agg_tag_askers": ("year_start", "period", "year"),
}
CLUSTERS = {
    "raw_questions": ["id"], "raw_answers": ["id", "parent_id"], "raw_users": ["id"],
    "stg_questions": ["owner_user_id", "score"], "stg_answers": ["question_id", "owner_user_id"],
    "stg_users": ["reputation"], "dim_date": ["year", "month"], "dim_tag": ["tag_name"],
    "dim_user": ["reputation", "reputation_bucket"], "fact_questions": ["user_id", "score"],
    "fact_answers": ["question_id", "user_id"], "fact_user_activity": ["user_id"],
    "agg_tag_user": ["tag_name"], "agg_tag_latency": ["tag_name"], "agg_user_posts": ["user_id"],
    "tag_years": ["tag_name"], "tag_totals": ["tag_name"],
}
DESCRIPTIONS = {
    "raw_questions": "Question versions as loaded", "raw_answers": "Answer versions as loaded",
    "raw_users": "User versions as loaded", "stg_questions": "Newest valid version of each question",
    "stg_answers": "Newest valid version of each answer", "stg_users": "Newest valid version of each user",
    "dim_date": "Calendar", "dim_user": "Users with reputation ranks", "dim_tag": "Tags and their categories",
    "fact_questions": "One row per question", "fact_answers": "One row per answer",
    "fact_user_activity": "Posts per user and day", "mart_tag_growth": "Yearly growth per tag",
    "mart_trending_technologies": "Popularity of tags", "mart_unanswered_questions": "Open questions per tag",
    "mart_top_contributors": "Contribution per user", "mart_contributor_retention": "Contributors per month",
    "mart_answer_latency": "Hours to answers per tag", "mart_community_health": "Health score per tag",
}


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file as a mark."""
    fs, p = _path(spark, path)
    fs.create(p, True).close()


def save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep the table's columns beside its files: folders written earlier may lack newer ones."""
    fs, p = _path(spark, f"{path}/_columns.json")
    out = fs.create(p, True)
    out.write(bytearray(schema.json().encode()))
    out.close()


def saved_schema(spark: SparkSession, path: str) -> T.StructType | None:
    fs, p = _path(spark, f"{path}/_columns.json")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return T.StructType.fromJson(json.loads(text))


def _with_layout(schema: T.StructType, table: str) -> T.StructType:
    own = [f for f in schema.fields if table not in PARTITIONS or f.name != PARTITIONS[table][0]]
    return T.StructType([*own, *([T.StructField(PARTITIONS[table][0], T.DateType())] if table in PARTITIONS else [])])


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def ensure_layers(spark: SparkSession, root: str, names: dict[str, str] = LAYERS,
                  prefix: str = "") -> list[str]:
    """Create the layer databases if they are absent; safe to repeat."""
    made = []
    for name, text in names.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{name}` COMMENT '{text}' "
                  f"LOCATION '{root.rstrip('/')}/{name}' "
                  f"WITH DBPROPERTIES ('layer' = '{name}', 'managed_by' = 'analytics')")
        made.append(prefix + name)
    return made


def publish(spark: SparkSession, root: str, layer: str, table: str, prefix: str = "") -> str:
    """Make a stored table visible to SQL as ``layer.table``, with its present columns and folders.

    The table is external: declaring it again where columns were added touches no file.
    """
    name, path = f"`{prefix}{layer}`.`{table}`", table_path(root, layer, table)
    fields = _with_layout(saved_schema(spark, path) or spark.read.parquet(path).schema, table)
    if spark.catalog.tableExists(f"{prefix}{layer}.{table}") and spark.table(name).columns != fields.names:
        spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    layout = f"PARTITIONED BY (`{PARTITIONS[table][0]}`)" if table in PARTITIONS else ""
    about = DESCRIPTIONS.get(table, LAYERS.get(layer, "")).replace("'", "")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {layout} COMMENT '{about}' LOCATION '{path}'")
    if table in PARTITIONS:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")
    return name


def partition_value(table: str) -> Column | None:
    if table not in PARTITIONS:
        return None
    _, source, grain = PARTITIONS[table]
    return F.to_date(F.col(source)) if grain == "day" else F.trunc(F.col(source), grain)


def write_layer(df: DataFrame, path: str, partition_by: str | None = None,
                cluster_by: list[str] | None = None, mode: str = "overwrite",
                dynamic: bool = False, metrics: dict[str, Column] | None = None, in_place: bool = False) -> dict:
    """Store ``df`` as Parquet, partitioned and sorted.

    Rows are brought together per partition value by a rebalance, which lets the
    adaptive planner cut a large value (the first load is one single day) into
    several tasks and join small ones; a hash repartition would give it one task.
    ``dynamic`` replaces only the partitions present in ``df``. Returned are the values of
    ``metrics``, aggregates that are computed on the way.

    ``in_place`` is for rows that need not be brought together: all of them go to one
    folder, or they come from files that lie in the same folders. Then nothing is shuffled,
    and files are read in pieces small enough to be sorted in memory.
    """
    if in_place:
        with smaller_pieces(df.sparkSession):
            return _write(df, path, partition_by, cluster_by, mode, dynamic, metrics)
    spread = df.hint("rebalance", partition_by) if partition_by else df.hint("rebalance")
    return _write(spread, path, partition_by, cluster_by, mode, dynamic, metrics)


def _write(out, path, partition_by, cluster_by, mode, dynamic, metrics) -> dict:
    sort = [c for c in [partition_by, *(cluster_by or [])] if c]
    if sort:
        out = out.sortWithinPartitions(*sort)
    seen = None
    if metrics:
        out, seen = watched(out, metrics)
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return seen.get if seen else {}


def store(df: DataFrame, root: str, layer: str, table: str, dynamic: bool = False, in_place: bool = False) -> DataFrame:
    """Write a table in its standard layout and return the stored copy."""
    return store_with(df, root, layer, table, {}, dynamic, in_place)[0]


def store_with(df: DataFrame, root: str, layer: str, table: str, metrics: dict[str, Column],
               dynamic: bool = False, in_place: bool = False) -> tuple[DataFrame, dict]:
    """``store``, and aggregates of the rows that came along with the write."""
    path = table_path(root, layer, table)
    value = partition_value(table)
    part = PARTITIONS[table][0] if table in PARTITIONS else None
    out = df.withColumn(part, value) if part else df
    seen = write_layer(out, path, part, CLUSTERS.get(table), dynamic=dynamic and part is not None, metrics=metrics, in_place=in_place)
    save_schema(df.sparkSession, path, df.schema)
    return read_layer(df.sparkSession, root, layer, table, schema=df.schema), seen


def append(df: DataFrame, root: str, layer: str, table: str, in_place: bool = False) -> None:
    """Add rows to a table as new files; other files are not touched, new columns are noted."""
    path, value = table_path(root, layer, table), partition_value(table)
    part = PARTITIONS[table][0] if table in PARTITIONS else None
    write_layer(df.withColumn(part, value) if part else df, path, part, CLUSTERS.get(table), mode="append", in_place=in_place)
    known = saved_schema(df.sparkSession, path)
    if known is None or set(df.columns) - set(known.names):
        save_schema(df.sparkSession, path, df.schema)


def read_files(spark: SparkSession, root: str, layer: str, table: str, files: list[str]) -> DataFrame:
    """Some files of a table, without its layout column."""
    path = table_path(root, layer, table)
    schema = saved_schema(spark, path) or read_layer(spark, root, layer, table).schema
    return (spark.read.schema(_with_layout(schema, table)).option("basePath", path).parquet(*files)
            .drop(PARTITIONS[table][0] if table in PARTITIONS else ""))


def replace_files(spark: SparkSession, df: DataFrame, root: str, layer: str, table: str, old: list[str]) -> list:
    """Write ``df`` as new files, then delete ``old`` ones and folders that are left empty; the folders touched."""
    append(df, root, layer, table)
    folders = {f.rsplit("/", 1)[0] for f in old}
    for f in old:
        delete(spark, f)
    for folder in folders:
        fs, p = _path(spark, folder)
        if not any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(p)):
            fs.delete(p, True)
    return sorted(f.rsplit("=", 1)[-1] for f in folders)


def read_layer(spark: SparkSession, root: str, layer: str, table: str,
               columns: list[str] | None = None, between: tuple[Moment, Moment] | None = None,
               schema=None, keep_partition: bool = False, with_file: str | None = None) -> DataFrame:
    """A stored table without its layout column, with all columns it ever got.

    ``between`` (two days) restricts the partitions that are opened; callers filter the
    rows themselves. ``with_file`` adds the name of each row's file.
    """
    path = table_path(root, layer, table)
    schema = schema or saved_schema(spark, path)
    reader = spark.read.schema(_with_layout(schema, table)) if schema is not None else spark.read
    df = reader.parquet(path)
    if with_file:
        df = df.select("*", F.col("_metadata.file_path").alias(with_file))
    if table in PARTITIONS:
        if between is not None:
            df = folders_between(df, table, *between)
        if not keep_partition:
            df = df.drop(PARTITIONS[table][0])
    return df.select(*columns) if columns else df


def folders_between(df: DataFrame, table: str, lo: Moment, hi: Moment) -> DataFrame:
    """Only the partition folders that can hold days from ``lo`` to ``hi``."""
    part, _, grain = PARTITIONS[table]
    first, last = as_python_date(lo), as_python_date(hi)
    if grain in ("month", "year"):
        first = first.replace(day=1)
    if grain == "year":
        first = first.replace(month=1)
    return df.filter(F.col(part).between(F.lit(first), F.lit(last)))


def newest_folder(spark: SparkSession, root: str, layer: str, table: str) -> str | None:
    """Value of the last partition folder, from folder names alone."""
    part = PARTITIONS[table][0]
    base = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, layer, table))
    names = [f.getPath().getName() for f in base.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(base)]
    return max((n.split("=", 1)[1] for n in names if n.startswith(f"{part}=")), default=None)


def expire_partitions(df: DataFrame, ts_col: str, days: int = RAW_RETENTION_DAYS,
                      as_of: Moment = None) -> DataFrame:
    """Rows whose load day is at most ``days`` old."""
    oldest = as_python_date(as_of) - dt.timedelta(days=days)
    return df.filter(F.col(ts_col) >= ntz(oldest))


def drop_expired(spark: SparkSession, root: str, table: str, days: int = RAW_RETENTION_DAYS,
                 as_of: Moment = None) -> list[str]:
    """Delete whole raw partition folders past retention; returns what was removed.

    Only folder names are listed, so the cost depends on the number of days kept.
    """
    oldest = as_python_date(as_of) - dt.timedelta(days=days)
    part = PARTITIONS[table][0]
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(table_path(root, "raw", table))
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    removed = []
    if not fs.exists(base):
        return removed
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        if name.startswith(f"{part}=") and name.split("=", 1)[1] < oldest.isoformat():
            fs.delete(status.getPath(), True)
            removed.append(name)
    return sorted(removed)


def append_audit_log(spark: SparkSession, path: str, *runs: dict) -> DataFrame:
    """Append one row per step to the log, creating the log on first use.

    Absent fields are NULL; identity, time and status are filled in.
    """
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    common = {"run_id": str(uuid.uuid4()), "run_timestamp": now, "status": "SUCCESS"}
    rows = [tuple((common | run).get(n) for n in schemas.AUDIT_LOG.names) for run in runs]
    spark.createDataFrame(rows, schemas.AUDIT_LOG).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(schemas.AUDIT_LOG).parquet(path)


def inline_catalogue(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A constant relation of text columns."""
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
