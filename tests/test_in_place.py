"""Writes that need no shuffle: one folder, or rows that come from the same folders."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from forumlens.catalog import loads
from forumlens.session import PIECE_BYTES, smaller_pieces
from forumlens.sources import tables
from conftest import SF_DIR, rows


def _staged(spark, n=400):
    return spark.range(n).select((n - F.col("id")).alias("question_id"), (F.col("id") % 7).alias("user_id"), F.lit(1).cast("long").alias("score"),
                                 F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 90).cast("int")).alias("creation_date"))


def test_rows_in_place_are_not_shuffled(spark, root, monkeypatch):
    hints = []
    frame = type(spark.range(1))
    known = frame.hint
    monkeypatch.setattr(frame, "hint", lambda df, name, *a: hints.append(name) or known(df, name, *a))
    first = tables.store(_staged(spark), root, "warehouse", "fact_questions")
    assert hints == ["rebalance"]
    again = tables.store(first, f"{root}/again", "warehouse", "fact_questions", in_place=True)
    assert hints == ["rebalance"]
    assert rows(again) == rows(first) == rows(_staged(spark))
    months = lambda at: sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{at}/warehouse/fact_questions/month_start=*"))
    assert months(f"{root}/again") == months(root) == ["2020-01-01", "2020-02-01", "2020-03-01"]


def test_smaller_pieces_end_with_the_block(spark):
    name = "spark.sql.files.maxPartitionBytes"
    given = spark.conf.get(name)
    with pytest.raises(ValueError), smaller_pieces(spark):
        assert spark.conf.get(name) == str(PIECE_BYTES)
        raise ValueError
    assert spark.conf.get(name) == given


def test_late_parts_are_written_by_several_tasks(spark, monkeypatch):
    """A part too large for a task is dealt to several files, and the table ends up the same."""
    import __spark_entry__ as contract

    one = rows(contract.queries()["stream_upsert_late"](spark, SF_DIR).drop("_ingested_at", "_batch_id"))
    monkeypatch.setattr(loads, "ROWS_PER_FILE", 300)
    assert rows(contract.queries()["stream_upsert_late"](spark, SF_DIR).drop("_ingested_at", "_batch_id")) == one
