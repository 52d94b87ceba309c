"""Session construction, the shared folder, and relations stored in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_OPEN: list[list[str]] = []  # paths of relations stored within each open ``scratch`` block


def build_session(app: str = "forumlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here assumes; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A folder of our own is made only for a local session that names none, and removed with
    it; a cluster session without the setting is an error, since executors could not read it back.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="forumlens-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to Parquet in the shared folder and go on from the files.

    Used where one relation feeds several branches, or where a value (a sampled range
    partitioning, a merge result) has to stay the same if a task is run again. Readers
    take only the columns they need; filters reach the files.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _OPEN:
        _OPEN[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def watched(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that its next action fills in on the way.

    To be written as it is: above the last shuffle every row is counted once, also where tasks ran again.
    """
    seen = Observation()
    return df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), seen


def stored_with(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stored``, and aggregates of the rows that came along with the write."""
    out, seen = watched(df, metrics)
    return stored(out), seen.get


#: Bytes of a file that a task reads where it sorts what it reads; the given setting counts where it is lower.
PIECE_BYTES = 32 << 20


@contextmanager
def smaller_pieces(spark: SparkSession) -> Iterator[None]:
    """Files are read in pieces of ``PIECE_BYTES`` inside the block, so that a task's sort does not spill."""
    name = "spark.sql.files.maxPartitionBytes"
    given = spark.conf.get(name)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given)
    spark.conf.set(name, str(min(size, PIECE_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(name, given)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete relations stored inside the block when it ends; for runs that leave nothing lazy behind."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
