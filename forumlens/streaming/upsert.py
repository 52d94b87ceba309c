"""Upserts from a stream of source rows.

Each micro-batch is reduced to the newest row per key and merged like a daily change set.
Batches that were merged are noted by number beside the stream's checkpoint, so a replayed
batch is skipped; one that stopped half-way is merged again, which changes nothing that was
done. A row older than what the table holds never overwrites it, whatever batch it comes in.

Sources that send rows again can have the repeats dropped before they are merged: the state
store keeps each (key, version) for as long as ``Repeats.delay`` says, counted by the arrival
time of rows, and forgets it then, so that state stays bounded however long the stream runs.
A repeat that comes later still merges to nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import MergeRule, merge_into_table
from ..operators.relational import dedup_latest
from ..session import scratch
from ..sources import tables


@dataclass(frozen=True)
class Repeats:
    """What makes two rows the same (with the rule's key), the arrival time by which state expires, and how long it is kept.

    Rows that arrive later than ``delay`` behind the newest arrival are dropped by the
    stream, so it has to cover the slowest sender.
    """

    same: tuple[str, ...]
    arrival: str
    delay: str = "7 days"


def without_repeats(stream: DataFrame, key: str, repeats: Repeats) -> DataFrame:
    """The stream without rows whose key and version came before, as long as the state remembers them."""
    timed = stream.withColumn("_arrival", F.col(repeats.arrival).cast("timestamp")).withWatermark("_arrival", repeats.delay)
    return timed.dropDuplicatesWithinWatermark([key, *repeats.same]).drop("_arrival")


def stream_upsert(stream: DataFrame, root: str, layer: str, table: str, rule: MergeRule,
                  order_by: Sequence[str], checkpoint: str,
                  prepare: Callable[[DataFrame], DataFrame] | None = None, repeats: Repeats | None = None) -> StreamingQuery:
    """Merge everything the stream has available into a stored table, then stop; started again, it goes on where it stopped."""
    if repeats:
        stream = without_repeats(stream, rule.key, repeats)
    newer = replace(rule, only_if_newer=rule.only_if_newer or order_by[0])

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        done = f"{checkpoint}/merged/{batch_id}"
        if tables.exists(spark, done):
            return
        ready = prepare(rows) if prepare else rows
        rest = [c for c in ready.columns if c not in (rule.key, *order_by)]
        with scratch(spark):
            merge_into_table(root, layer, table, dedup_latest(ready, [rule.key], order_by, rest), newer)
        tables.touch(spark, done)

    return (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
