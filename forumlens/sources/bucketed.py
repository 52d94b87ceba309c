"""Tables stored in buckets of a key, for joins that move no row.

Rows of equal keys lie in the same bucket of every table written with the same key type and
number of buckets, each bucket sorted by the key. A join of two such tables on that key
reads bucket against bucket; a change set joined with one is dealt to its buckets, and the
table stays where it is. Worth it for relations that are joined again and again and whose
keys are spread: a bucket is read by one task, however large a single key makes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Buckets of a table; a bucket should hold a few hundred megabytes.
BUCKETS = 64


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Store ``df`` at ``path`` in buckets of ``key`` and declare it as ``table``; the stored relation.

    One shuffle deals the rows to their buckets, so every bucket is one sorted file.
    """
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def beside(spark: SparkSession, table: str, rows: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with a bucketed table on its key; only ``rows`` are shuffled.

    Merge hints keep the planner from broadcasting or hashing either side: both stay sorted by bucket.
    """
    return spark.table(table).hint("merge").join(rows, key, how)
