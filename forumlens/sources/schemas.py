"""Column contracts of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"long": T.LongType(), "string": T.StringType(), "double": T.DoubleType(),
          "boolean": T.BooleanType(), "timestamp": T.TimestampNTZType(), "date": T.DateType()}


def schema(text: str) -> T.StructType:
    """``"id long, title string"`` as a nullable struct (timestamps are zone-less)."""
    fields = [f.split() for f in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


POST = schema(
    "id long, title string, body string, accepted_answer_id long, answer_count long,"
    "comment_count long, community_owned_date timestamp, creation_date timestamp,"
    "favorite_count long, last_activity_date timestamp, last_edit_date timestamp,"
    "last_editor_display_name string, last_editor_user_id long, owner_display_name string,"
    "owner_user_id long, parent_id long, post_type_id long, score long, tags string,"
    "view_count long")

USER = schema(
    "id long, display_name string, about_me string, age string, creation_date timestamp,"
    "last_access_date timestamp, location string, reputation long, up_votes long,"
    "down_votes long, views long, website_url string")

USER_WITH_ACCOUNT = T.StructType(USER.fields + schema("account_id long").fields)

METADATA = schema("_ingested_at timestamp, _source_table string, _batch_id string, _load_type string")

AUDIT_LOG = schema(
    "run_id string, run_timestamp timestamp, step_name string, rows_processed long,"
    "rows_inserted long, rows_updated long, watermark_used timestamp, status string,"
    "error_message string")


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Exactly the contract's columns: absent ones as NULL, others converted.

    Text that does not parse becomes NULL instead of ending the load.
    """
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(field):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if have[field.name] == field.dataType:
            return F.col(field.name)
        if isinstance(have[field.name], T.StringType):
            return F.col(field.name).try_cast(field.dataType).alias(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in contract.fields])

