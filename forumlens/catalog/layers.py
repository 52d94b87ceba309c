"""Sources, sinks, staging, dimensions, facts and quality checks as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import dimensions, quality, refresh, staging
from ..plans.quality import Bounds, CHECKS
from ..session import stored
from ..sources import fixtures as fx
from ..sources import clustering, tables
from .base import Inputs, big, key_sql, query, share

# ------------------------------------------------------------------- raw layer
query("ingest_raw_questions", "SELECT * FROM x_raw_q")(lambda x: x.raw_questions)
query("ingest_raw_answers", "SELECT * FROM x_raw_a")(lambda x: x.raw_answers)
query("ingest_raw_users", "SELECT * FROM x_raw_u")(lambda x: x.raw_users)


@query("metadata_columns", f"""
SELECT id, TIMESTAMP '{fx.AS_OF} 00:00:00' AS _ingested_at, 'posts_questions' AS _source_table,
  'check-run' AS _batch_id, 'initial_load' AS _load_type FROM x_raw_q""")
def metadata_columns(x: Inputs):
    return x.raw_questions.select("id", "_ingested_at", "_source_table", "_batch_id", "_load_type")


@query("write_layer", "SELECT question_id, creation_date, score, engagement_score, tags_clean FROM x_fq")
def write_layer(x: Inputs):
    """Written partitioned by month and sorted, then read back."""
    back = tables.store(x.fact_questions, x.scratch("write"), "warehouse", "fact_questions")
    return back.select("question_id", "creation_date", "score", "engagement_score", "tags_clean")


@query("read_layer", """
SELECT user_id, count(*) AS posts, CAST(sum(score) AS BIGINT) AS total_score FROM x_fa
WHERE creation_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY user_id""")
def read_layer(x: Inputs):
    """A year of a stored fact: only its month folders are opened."""
    root = x.scratch("read")
    tables.store(x.fact_answers, root, "warehouse", "fact_answers")
    year = tables.read_layer(x.spark, root, "warehouse", "fact_answers", ["user_id", "creation_date", "score"],
                             between=("1998-01-01", "1998-12-31"))
    year = year.filter(F.col("creation_date").between("1998-01-01", "1998-12-31"))
    return year.groupBy("user_id").agg(F.count("*").alias("posts"), F.sum("score").alias("total_score"))


@query("recluster_layer", """
SELECT 'user' AS filtered_by, count(*) AS posts, CAST(sum(score) AS BIGINT) AS total_score FROM x_fa WHERE user_id = 7
UNION ALL SELECT 'question', count(*), CAST(sum(score) AS BIGINT) FROM x_fa WHERE question_id BETWEEN 100 AND 199
UNION ALL SELECT 'all', count(*), CAST(sum(score) AS BIGINT) FROM x_fa""")
def recluster_layer(x: Inputs):
    """Stored answers rewritten in boxes of question and user, then read by one column or the other."""
    root = x.scratch("recluster")
    tables.store(x.fact_answers, root, "warehouse", "fact_answers")
    clustering.recluster(x.spark, root, "warehouse", "fact_answers")
    posts = tables.read_layer(x.spark, root, "warehouse", "fact_answers", ["question_id", "user_id", "score"])
    some = {"user": F.col("user_id") == 7, "question": F.col("question_id").between(100, 199), "all": F.lit(True)}
    sums = [posts.filter(f).agg(F.lit(k).alias("filtered_by"), F.count("*").alias("posts"), F.sum("score").cast("long").alias("total_score"))
            for k, f in some.items()]
    return sums[0].unionByName(sums[1]).unionByName(sums[2]).select("filtered_by", "posts", "total_score")


@query("ensure_layers", """
SELECT 'fact_questions' AS table_name, count(*) AS row_count FROM x_fq
UNION ALL SELECT 'fact_answers', count(*) FROM x_fa""")
def ensure_layers(x: Inputs):
    """Layer databases created twice over, facts published and counted through SQL."""
    root = x.scratch("layers")
    prefix = "chk" + root[-12:] + "_"
    tables.store(x.fact_questions, root, "warehouse", "fact_questions")
    tables.store(x.fact_answers, root, "warehouse", "fact_answers")
    refresh.publish_all(x.spark, root, prefix)
    refresh.publish_all(x.spark, root, prefix)
    return x.spark.sql(f"""
        SELECT 'fact_questions' AS table_name, count(*) AS row_count FROM {prefix}warehouse.fact_questions
        UNION ALL SELECT 'fact_answers', count(*) FROM {prefix}warehouse.fact_answers""")


@query("expire_partitions", """
SELECT id, creation_date FROM x_raw_q WHERE creation_date >= DATE '2001-12-31' - 400""")
def expire_partitions(x: Inputs):
    """The source by day of creation, keeping 400 days."""
    return tables.expire_partitions(x.raw_questions, "creation_date", 400, "2001-12-31").select(
        "id", "creation_date")


query("add_unknown_member", "SELECT user_id, display_name, location, reputation FROM x_du")(
    lambda x: dimensions.add_unknown_member(dimensions.user_attributes(x.stg_users), as_of=fx.AS_OF)
    .select("user_id", "display_name", "location", "reputation"))


@query("date_spine", """
SELECT CAST(day AS DATE) AS full_date FROM (SELECT min(creation_date) AS lo, max(creation_date) AS hi
  FROM x_fq), unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS s(day)""")
def date_spine(x: Inputs):
    return dimensions.spine_covering(x.fact_questions, "creation_date")


@query("append_audit_log", """
SELECT 'load' AS step_name, (SELECT count(*) FROM x_raw_q) AS rows_processed,
  (SELECT count(*) FROM x_raw_q) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, 'SUCCESS' AS status
UNION ALL SELECT 'clean', (SELECT count(*) FROM x_raw_q), (SELECT count(*) FROM x_stg_q), 0, 'SUCCESS'""")
def append_audit_log(x: Inputs):
    path = x.scratch("audit")
    raw = stored(x.raw_questions.select("id", "last_activity_date", "_ingested_at", *staging.QUESTION_TIES))
    n = raw.count()
    kept = staging.clean_questions(raw, fx.AS_OF, fx.FLOOR).count()
    tables.append_audit_log(x.spark, path, {"step_name": "load", "rows_processed": n, "rows_inserted": n,
                                            "rows_updated": 0})
    log = tables.append_audit_log(x.spark, path, {"step_name": "clean", "rows_processed": n,
                                                  "rows_inserted": kept, "rows_updated": 0})
    return log.select("step_name", "rows_processed", "rows_inserted", "rows_updated", "status")


# --------------------------------------------------------------------- staging
query("stg_questions", "SELECT * FROM x_stg_q")(lambda x: x.stg_questions)
query("stg_answers", "SELECT * FROM x_stg_a")(lambda x: x.stg_answers)
query("stg_users", "SELECT * FROM x_stg_u")(lambda x: x.stg_users)


def _load_row(name: str, rel: str, owner: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count, min(creation_date) AS earliest_record,
  max(creation_date) AS latest_record, count(*) FILTER (id IS NULL) AS null_ids,
  count(*) FILTER ({owner} IS NULL) AS null_user_ids, max(_ingested_at) AS last_ingested_at FROM {rel}"""


_LOAD_SQL = " UNION ALL ".join([_load_row("raw_questions", "x_raw_q", "owner_user_id"),
                                _load_row("raw_answers", "x_raw_a", "owner_user_id"),
                                _load_row("raw_users", "x_raw_u", "id")])


@query("raw_load_report", _LOAD_SQL)
def raw_load_report(x: Inputs):
    return staging.load_report({"raw_questions": x.raw_questions, "raw_answers": x.raw_answers,
                                "raw_users": x.raw_users})


query("union_reports", _LOAD_SQL)(raw_load_report)


def _kept_row(name: str, stg: str, raw: str) -> str:
    return f"""SELECT '{name}' AS comparison, s AS staging_rows, n AS raw_rows, {share("s", "n")}
  AS retention_pct FROM (SELECT (SELECT count(*) FROM {stg}) AS s, (SELECT count(*) FROM {raw}) AS n)"""


@query("staging_retention_report", " UNION ALL ".join([
    _kept_row("stg_questions vs raw_questions", "x_stg_q", "x_raw_q"),
    _kept_row("stg_answers vs raw_answers", "x_stg_a", "x_raw_a"),
    _kept_row("stg_users vs raw_users", "x_stg_u", "x_raw_u")]))
def staging_retention_report(x: Inputs):
    return staging.retention_report({
        "stg_questions vs raw_questions": (x.stg_questions, x.raw_questions),
        "stg_answers vs raw_answers": (x.stg_answers, x.raw_answers),
        "stg_users vs raw_users": (x.stg_users, x.raw_users)})


# ------------------------------------------------------------------ dimensions
@query("dim_date", f"""
SELECT {key_sql("d")} AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter,
  'Q' || quarter(d) AS quarter_name, month(d) AS month, monthname(d) AS month_name,
  strftime(d, '%b') AS month_short_name, {big("strftime(d, '%U')")} AS week_of_year,
  weekofyear(d) AS iso_week, day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week,
  dayname(d) AS day_name, strftime(d, '%a') AS day_short_name, dayofweek(d) IN (0, 6) AS is_weekend,
  year(d) AS fiscal_year, strftime(d, '%Y-%m') AS year_month, year(d) || '-Q' || quarter(d) AS year_quarter,
  {big("d - DATE '2008-07-31'")} AS days_since_so_launch
FROM (SELECT CAST(s AS DATE) AS d FROM (SELECT min(creation_date) AS lo, max(creation_date) AS hi
  FROM x_fq), unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS g(s))""")
def dim_date(x: Inputs):
    """Calendar over the days the facts cover; the published one has fixed ends."""
    return x.dim_date


@query("dim_date_facts", """
SELECT year_quarter, day_name, is_weekend, count(*) AS questions, CAST(sum(score) AS BIGINT) AS total_score
FROM (SELECT year(creation_date) || '-Q' || quarter(creation_date) AS year_quarter,
        dayname(creation_date) AS day_name, dayofweek(creation_date) IN (0, 6) AS is_weekend, score FROM x_fq)
GROUP BY ALL""")
def dim_date_facts(x: Inputs):
    """Facts by calendar attributes, through the standard calendar table of fixed size."""
    calendar = dimensions.build_dim_date(x.spark, start="1995-01-01")
    return (x.fact_questions.join(F.broadcast(calendar), "date_key")
            .groupBy("year_quarter", "day_name", "is_weekend")
            .agg(F.count("*").alias("questions"), F.sum("score").alias("total_score")))


query("dim_user", "SELECT * FROM x_du")(lambda x: x.dim_user)
query("dim_tag", "SELECT * FROM x_dt")(lambda x: x.dim_tag.drop("tag_key"))
query("surrogate_key", """
SELECT count(*) AS tags, count(*) AS different_keys, CAST(0 AS BIGINT) AS negative_keys FROM x_dt""")(
    # the hash itself is ours; what must hold is one non-negative key per tag
    lambda x: x.dim_tag.agg(F.count("*").alias("tags"), F.count_distinct("tag_key").alias("different_keys"),
                            F.count_if(F.col("tag_key") < 0).alias("negative_keys")))


@query("dimension_report", """
SELECT 'dim_date' AS dimension, CAST(max(creation_date) - min(creation_date) + 1 AS BIGINT) AS row_count,
  min(creation_date) AS min_date, max(creation_date) AS max_date, CAST(0 AS BIGINT) AS null_keys FROM x_fq
UNION ALL SELECT 'dim_user', count(*), NULL, NULL, count(*) FILTER (user_id IS NULL) FROM x_du
UNION ALL SELECT 'dim_tag', count(*), NULL, NULL, count(*) FILTER (tag_name IS NULL) FROM x_dt""")
def dimension_report(x: Inputs):
    return dimensions.dimension_report({
        "dim_date": (x.dim_date, "date_key", "full_date"), "dim_user": (x.dim_user, "user_id", None),
        "dim_tag": (x.dim_tag, "tag_key", None)})


# ----------------------------------------------------------------------- facts
query("fact_questions", "SELECT * FROM x_fq")(lambda x: x.fact_questions)
query("fact_answers", "SELECT * FROM x_fa")(lambda x: x.fact_answers)
query("fact_user_activity", "SELECT * FROM x_ua")(lambda x: x.user_activity)

# --------------------------------------------------------------------- quality
# Limits chosen so that every check finds something in the fixture.
TIGHT = Bounds(floor="1996-01-01", min_score=-15, reputation=(1000, 90000), max_age_days=7)


def _violation(check_id: str, key: str, source: str, count: str = "1") -> str:
    category, name = CHECKS[check_id]
    return (f"SELECT '{check_id}' AS check_id, '{category}' AS check_category, '{name}' AS check_name, "
            f"CAST({key} AS BIGINT) AS key, CAST({count} AS BIGINT) AS occurrence_count FROM {source}")


def _undeduplicated_answers(x: Inputs):
    return x.raw_answers.select(F.col("id").alias("answer_id"))


def _without_defaults(df):
    """Facts as they would be without the stand-in user."""
    return df.withColumn("user_id", F.nullif("user_id", F.lit(-1).cast("long")))


_NO_USER = "(SELECT * REPLACE (nullif(user_id, -1) AS user_id) FROM {})"
_DQ_SQL = {
    "DQ-001": _violation("DQ-001", "question_id", "(SELECT question_id, count(*) AS n FROM x_fa "
                         "GROUP BY question_id HAVING n > 1)", "n"),
    "DQ-002": _violation("DQ-002", "id", "(SELECT id, count(*) AS n FROM x_raw_a GROUP BY id HAVING n > 1)", "n"),
    "DQ-003": _violation("DQ-003", "question_id", _NO_USER.format("x_fq") + " WHERE user_id IS NULL"),
    "DQ-004": _violation("DQ-004", "answer_id", "(SELECT answer_id, nullif(user_id, 0) AS user_id FROM x_fa) "
                         "WHERE user_id IS NULL"),
    "DQ-005": _violation("DQ-005", "question_id", "x_fq WHERE creation_date < DATE '1996-01-01' "
                         f"OR creation_date > DATE '{fx.AS_OF}'"),
    "DQ-006": _violation("DQ-006", "answer_id", "x_fa WHERE creation_date < DATE '1996-01-01' "
                         f"OR creation_date > DATE '{fx.AS_OF}'"),
    "DQ-007": _violation("DQ-007", "answer_id", "x_fa a LEFT JOIN x_fq q ON a.question_id = q.question_id "
                         "WHERE q.question_id IS NULL"),
    "DQ-008": _violation("DQ-008", "question_id", "x_fq q LEFT JOIN x_du u ON q.user_id = u.user_id "
                         "WHERE u.user_id IS NULL"),
    "DQ-009": _violation("DQ-009", "question_id", "x_fq WHERE creation_date < DATE '1998-01-01'"),
    "DQ-010": _violation("DQ-010", "user_id", "x_du WHERE reputation NOT BETWEEN 1000 AND 90000"),
    "DQ-011": _violation("DQ-011", "question_id", "x_fq WHERE score < -15"),
    "DQ-012": _violation("DQ-012", "NULL", "(SELECT max(creation_date) AS d FROM x_fq) "
                         f"WHERE DATE '{fx.AS_OF}' - d > 7"),
}

query("dq_001_dup_questions", _DQ_SQL["DQ-001"])(
    # answers hold a question several times, so they stand in for a damaged question fact
    lambda x: quality.duplicate_questions(x.fact_answers))
query("dq_002_dup_answers", _DQ_SQL["DQ-002"])(lambda x: quality.duplicate_answers(_undeduplicated_answers(x)))
query("dq_003_null_fk_questions", _DQ_SQL["DQ-003"])(
    lambda x: quality.null_keys_questions(_without_defaults(x.fact_questions)))
query("dq_004_null_fk_answers", _DQ_SQL["DQ-004"])(
    lambda x: quality.null_keys_answers(
        x.fact_answers.withColumn("user_id", F.nullif("user_id", F.lit(0).cast("long")))))
query("dq_005_dates_questions", _DQ_SQL["DQ-005"])(
    lambda x: quality.dates_questions(x.fact_questions, fx.AS_OF, TIGHT))
query("dq_006_dates_answers", _DQ_SQL["DQ-006"])(
    lambda x: quality.dates_answers(x.fact_answers, fx.AS_OF, TIGHT))
query("dq_007_orphan_answers", _DQ_SQL["DQ-007"])(
    lambda x: quality.orphan_answers(x.fact_answers, x.fact_questions))
query("dq_008_missing_users", _DQ_SQL["DQ-008"])(
    lambda x: quality.missing_users(x.fact_questions, x.dim_user))
query("dq_009_date_keys", _DQ_SQL["DQ-009"])(
    lambda x: quality.missing_date_keys(x.fact_questions, dimensions.build_dim_date(x.spark, "1998-01-01")))
query("dq_010_reputation", _DQ_SQL["DQ-010"])(lambda x: quality.bad_reputation(x.dim_user, TIGHT))
query("dq_011_scores", _DQ_SQL["DQ-011"])(lambda x: quality.bad_scores(x.fact_questions, TIGHT))
query("dq_012_freshness", _DQ_SQL["DQ-012"])(lambda x: quality.freshness(x.fact_questions, fx.AS_OF, TIGHT))


def _report_sql(counts: dict[str, str]) -> str:
    rows = []
    for check_id, (category, name) in CHECKS.items():
        n = counts.get(check_id, "0")
        rows.append(f"SELECT '{check_id}' AS check_id, '{category}' AS check_category, '{name}' AS check_name, "
                    f"CAST({n} AS BIGINT) AS failing_rows")
    return ("SELECT *, CASE WHEN failing_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ("
            + " UNION ALL ".join(rows) + ")")


_COUNTS = {i: f"(SELECT count(*) FROM ({_DQ_SQL[i]}))" for i in
           ("DQ-005", "DQ-006", "DQ-007", "DQ-008", "DQ-009", "DQ-010", "DQ-011", "DQ-012")}
_REPORT = _report_sql(_COUNTS)


def _report(x: Inputs):
    x.keep("stg_questions", "fact_answers", "dim_user")
    return x.fact_questions, x.fact_answers, x.dim_user, dimensions.build_dim_date(x.spark, "1998-01-01")


@query("dq_report", _REPORT)
def dq_report(x: Inputs):
    return quality.dq_report(*_report(x), fx.AS_OF, TIGHT)


@query("catalogue_left_join", _REPORT)
def catalogue_left_join(x: Inputs):
    """The same counts, sparse, from the violating rows themselves."""
    rows = quality.all_violations(*_report(x), fx.AS_OF, TIGHT)
    return quality.with_catalogue(rows.groupBy("check_id").agg(F.count("*").alias("failing_rows")))


query("conditional_sort", _REPORT)(dq_report)


@query("union_violations", "SELECT check_id, check_category, check_name, occurrence_count FROM ("
       + " UNION ALL ".join(_DQ_SQL[i] for i in _COUNTS) + ")")
def union_violations(x: Inputs):
    return quality.all_violations(*_report(x), fx.AS_OF, TIGHT)


@query("dq_gate", f"SELECT check_id, failing_rows FROM ({_REPORT}) WHERE status = 'FAIL'")
def dq_gate(x: Inputs):
    """What stopped the run, as the gate reports it."""
    report = stored(quality.dq_report(*_report(x), fx.AS_OF, TIGHT))
    try:
        quality.dq_gate(report)
    except quality.QualityGateError as stop:
        return report.filter(F.col("check_id").isin(list(stop.failed))).select("check_id", "failing_rows")
    return report.select("check_id", "failing_rows").filter("failing_rows > 0")


@query("inline_catalogue", "SELECT quality_tier, label, count(*) AS n FROM x_fq JOIN (VALUES "
       "('High Quality', 'top'), ('Good', 'fine'), ('Neutral', 'plain'), ('Low Quality', 'poor')) "
       "t(tier, label) ON tier = quality_tier GROUP BY ALL")
def inline_catalogue(x: Inputs):
    """A literal relation joined to the facts."""
    names = tables.inline_catalogue(x.spark, ["quality_tier", "label"], [
        ("High Quality", "top"), ("Good", "fine"), ("Neutral", "plain"), ("Low Quality", "poor")])
    return (x.fact_questions.join(F.broadcast(names), "quality_tier")
            .groupBy("quality_tier", "label").agg(F.count("*").alias("n")))
