"""Raw layer: keep the source columns, drop unusable rows, stamp the load."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import Moment, ntz
from . import schemas

Guards = Callable[[Moment], Column]


def question_guards(as_of: Moment) -> Column:
    return (F.col("post_type_id") == 1) & F.col("id").isNotNull() & (F.col("creation_date") <= ntz(as_of))


def answer_guards(as_of: Moment) -> Column:
    return ((F.col("post_type_id") == 2) & F.col("id").isNotNull() & F.col("parent_id").isNotNull()
            & (F.col("creation_date") <= ntz(as_of)))


def user_guards(as_of: Moment) -> Column:
    """Non-positive ids are system accounts."""
    return (F.col("id") > 0) & (F.col("creation_date") <= ntz(as_of))


@dataclass(frozen=True)
class Feed:
    """A source table: its contract, row guards, and the column that shows activity."""

    table: str
    source: str
    contract: T.StructType
    guards: Guards
    activity: str


QUESTIONS = Feed("raw_questions", "posts_questions", schemas.POST, question_guards, "last_activity_date")
ANSWERS = Feed("raw_answers", "posts_answers", schemas.POST, answer_guards, "last_activity_date")
USERS = Feed("raw_users", "users", schemas.USER, user_guards, "last_access_date")
USERS_WITH_ACCOUNT = Feed("raw_users", "users", schemas.USER_WITH_ACCOUNT, user_guards, "last_access_date")


def stamp(df: DataFrame, source: str, load_type: str = "initial_load", as_of: Moment = None,
          batch_id: str | None = None) -> DataFrame:
    """The four load columns; one batch id names the whole run."""
    return df.withColumns({
        "_ingested_at": ntz(as_of),
        "_source_table": F.lit(source),
        "_batch_id": F.lit(batch_id or str(uuid.uuid4())),
        "_load_type": F.lit(load_type),
    })


def ingest(df: DataFrame, feed: Feed, as_of: Moment = None, load_type: str = "initial_load",
           batch_id: str | None = None, since: str | None = None) -> DataFrame:
    """Rows of ``df`` fit for the raw layer; ``since`` keeps only later activity."""
    rows = schemas.conform(df, feed.contract).filter(feed.guards(as_of))
    if since is not None:
        rows = rows.filter(F.col(feed.activity) > ntz(since))
    return stamp(rows, feed.source, load_type, as_of, batch_id)
