"""Stored sums that marts are computed from, and how changes of the facts are added to them.

A fact's change feed holds every inserted and updated row with its values before and after.
The old row counts with sign -1, the new one with +1; grouped like the stored sums they are
what has to be added, and only the years (or months) they fall into are read and written.
Everything stored is a sum, a count, or the first or last of dates that never change, and
sums are of whole numbers: the result equals a rebuild from whole facts, exactly.

``agg_tag_user``     per year, tag and asker: questions, answer states, sums behind the means
``agg_tag_latency``  per year, tag and hours to the first answer: questions
``agg_user_posts``   per year, user and month: answers and questions
``agg_month_users``  per month and range of user ids: a bitmap of who posted, posts
``agg_tag_askers``   per tag and month: a sketch of the askers, posts
``agg_reputation``   per reputation and block of ids: users
``tag_years``, ``tag_totals``  per tag (and year), from the first; only tags that changed are recomputed

A mark beside the tables says that facts are changing. A run that finds it left over cannot
know what was added, and rebuilds the sums from whole facts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import Moment, month_of, ntz
from ..functions.numbers import fixed_sum, ratio, rnd
from ..operators.keyfilter import near_keys
from ..operators.merge import read_feed
from ..operators.relational import explode_tags
from ..session import stored
from ..sources import tables
from . import dimensions, marts

LAYER = "aggregates"
SIGN = "_sign"


@dataclass(frozen=True)
class Aggregate:
    """A stored table of sums: its keys, what is added up, and the count without which a row is gone."""

    table: str
    keys: tuple[str, ...]
    sums: tuple[str, ...]
    alive: str
    lows: tuple[str, ...] = ()
    highs: tuple[str, ...] = ()
    # what only ever grows: bitmaps and sketches are united; of a changed row nothing is taken away
    bitmaps: tuple[str, ...] = ()
    sketches: tuple[str, ...] = ()
    # sums kept as doubles of so many decimals
    fixed: dict[str, int] = field(default_factory=dict)
    layer: str = LAYER

    def combined(self, rows: DataFrame) -> DataFrame:
        def total(c):
            if c in self.fixed:
                return (fixed_sum(c, self.fixed[c]) / float(10 ** self.fixed[c])).alias(c)
            return F.sum(c).alias(c)
        return rows.groupBy(*self.keys).agg(*[total(c) for c in self.sums], *[F.min(c).alias(c) for c in self.lows],
                                            *[F.max(c).alias(c) for c in self.highs], *[F.bitmap_or_agg(c).alias(c) for c in self.bitmaps],
                                            *[F.hll_union_agg(c, True).alias(c) for c in self.sketches])

    def changed(self) -> Column:
        out = F.lit(False)
        for c in self.sums:
            out = out | (F.col(c) != 0)
        return out


_TAG_MEANS = ("score", "view_count", "answer_count")
TAG_USER = Aggregate("agg_tag_user", ("period", "tag_name", "user_id"), (
    "posts", "questions", "answered", "unanswered", "accepted", "engagement_sum", "engagement_n",
    *(f"{c}_{part}" for c in _TAG_MEANS for part in ("sum", "n"))), "posts")
TAG_LATENCY = Aggregate("agg_tag_latency", ("period", "tag_name", "hours_to_first_answer"), ("n", "a", "s", "c"), "n")
USER_POSTS = Aggregate("agg_user_posts", ("period", "user_id", "_month"), (
    "posts", "answers", "accepted", "score_sum", "score_n", "questions", "question_score_sum", "question_score_n", "views"),
    "posts", ("first_date",), ("last_date",))
ACTIVITY = Aggregate("fact_user_activity", ("user_id", "activity_date"), ("questions_posted", "answers_posted", "total_posts", "engagement_score"),
                     "total_posts", fixed={"engagement_score": 4}, layer="warehouse")
MONTH_USERS = Aggregate("agg_month_users", ("period", "activity_month", "bucket"), ("posts",), "posts", bitmaps=("users",))
TAG_ASKERS = Aggregate("agg_tag_askers", ("period", "tag_name", "month"), ("posts",), "posts", sketches=("askers",))
REPUTATION = Aggregate("agg_reputation", ("reputation_bucket", "reputation", "id_block"), ("n",), "n")


# ---- rows of the facts as sums


def signed(changes: DataFrame) -> DataFrame:
    """New rows of a change feed with sign 1 and the rows they replaced with sign -1."""
    names = [c for c in changes.columns if c not in ("_action", "_old")]
    new = changes.select(*names, F.lit(1).alias(SIGN))
    old = changes.filter("_old IS NOT NULL").select(*[F.col(f"_old.{c}").alias(c) for c in names], F.lit(-1).alias(SIGN))
    return new.unionByName(old)


def _with_sign(rows: DataFrame) -> DataFrame:
    return rows if SIGN in rows.columns else rows.withColumn(SIGN, F.lit(1))


def _count(test: Column) -> Column:
    return F.sum(F.when(test, F.col(SIGN)).otherwise(F.lit(0)))


def _sum_and_n(c: str, name: str | None = None) -> list[Column]:
    name = name or c
    return [F.coalesce(F.sum(F.col(c) * F.col(SIGN)), F.lit(0)).alias(f"{name}_sum"), _count(F.col(c).isNotNull()).alias(f"{name}_n")]


def tag_user_rows(fact_questions: DataFrame) -> DataFrame:
    rows = _with_sign(fact_questions).withColumn("period", F.trunc("creation_date", "year"))
    pairs = explode_tags(rows, ["period", "user_id", *_TAG_MEANS, "has_accepted_answer", "engagement_score", SIGN], mark_first=True)
    return pairs.groupBy("period", "tag_name", "user_id").agg(
        F.sum(SIGN).alias("posts"), _count(F.col("first_in_post")).alias("questions"),
        _count(F.col("answer_count") > 0).alias("answered"), _count(F.col("answer_count") == 0).alias("unanswered"),
        _count(F.col("has_accepted_answer")).alias("accepted"),
        F.coalesce(fixed_sum(F.col("engagement_score") * F.col(SIGN), 4), F.lit(0)).alias("engagement_sum"),
        _count(F.col("engagement_score").isNotNull()).alias("engagement_n"),
        *[c for name in _TAG_MEANS for c in _sum_and_n(name)])


def tag_latency_rows(fact_questions: DataFrame, fact_answers: DataFrame, sign: int = 1) -> DataFrame:
    latency = marts.question_latency(fact_questions, fact_answers).withColumns({
        "period": F.trunc("question_date", "year"), "answered": F.col("first_answer_date").isNotNull(), SIGN: F.lit(sign)})
    pairs = explode_tags(latency, ["period", "answered", "hours_to_first_answer", "hours_to_accepted_answer", SIGN])
    accepted = F.col("hours_to_accepted_answer")
    return pairs.groupBy("period", "tag_name", "hours_to_first_answer").agg(
        F.sum(SIGN).alias("n"), _count(F.col("answered")).alias("a"),
        F.coalesce(fixed_sum(accepted * F.col(SIGN), 2), F.lit(0)).alias("s"), _count(accepted.isNotNull()).alias("c"))


def user_post_rows(fact_questions: DataFrame, fact_answers: DataFrame) -> DataFrame:
    answers, questions = _with_sign(fact_answers), _with_sign(fact_questions)
    zero = F.lit(0).cast("long")
    one = answers.filter(F.col("user_id") > 0).select(
        "user_id", "creation_date", SIGN, F.lit(True).alias("is_answer"), F.col("accepted_answer_flag").alias("flag"), "score", zero.alias("seen"))
    two = questions.filter(F.col("user_id") > 0).select(
        "user_id", "creation_date", SIGN, F.lit(False).alias("is_answer"), zero.alias("flag"), "score", F.col("view_count").alias("seen"))
    both = one.unionByName(two).withColumns({
        "period": F.trunc("creation_date", "year"), "_month": month_of("creation_date"),
        "question_score": F.when(~F.col("is_answer"), F.col("score")), "score": F.when(F.col("is_answer"), F.col("score"))})
    dated = F.when(F.col("is_answer"), F.col("creation_date"))
    return both.groupBy("period", "user_id", "_month").agg(
        F.sum(SIGN).alias("posts"), _count(F.col("is_answer")).alias("answers"), F.sum(F.col("flag") * F.col(SIGN)).alias("accepted"),
        *_sum_and_n("score"), _count(~F.col("is_answer")).alias("questions"), *_sum_and_n("question_score"),
        F.coalesce(F.sum(F.col("seen") * F.col(SIGN)), F.lit(0)).alias("views"), F.min(dated).alias("first_date"), F.max(dated).alias("last_date"))


def activity_rows(fact_questions: DataFrame, fact_answers: DataFrame) -> DataFrame:
    def posts(df, questions, answers):
        sign = F.col(SIGN).cast("long")
        return _with_sign(df).select("user_id", F.col("creation_date").alias("activity_date"), (sign * questions).alias("questions_posted"),
                                     (sign * answers).alias("answers_posted"), sign.alias("total_posts"),
                                     (F.col("engagement_score") * sign).alias("engagement_score"))
    return ACTIVITY.combined(posts(fact_questions, 1, 0).unionByName(posts(fact_answers, 0, 1)))


def month_user_rows(activity: DataFrame) -> DataFrame:
    return marts.month_bitmaps(activity).withColumn("period", F.trunc("activity_month", "year"))


def tag_asker_rows(fact_questions: DataFrame) -> DataFrame:
    rows = _with_sign(fact_questions).withColumns({"period": F.trunc("creation_date", "year"), "month": month_of("creation_date")})
    return explode_tags(rows, ["period", "month", "user_id", SIGN]).groupBy("period", "tag_name", "month").agg(
        F.sum(SIGN).alias("posts"), F.hll_sketch_agg("user_id", marts.HLL_LOG).alias("askers"))


# ---- stored


def exists(spark: SparkSession, root: str) -> bool:
    return tables.exists(spark, tables.table_path(root, LAYER, "tag_totals"))


def add(spark: SparkSession, root: str, kind: Aggregate, delta: DataFrame) -> DataFrame:
    """Add signed sums to a stored table; the added rows that are not zero.

    Years or months without changes are neither read nor written.
    """
    delta = stored(kind.combined(delta).filter(kind.changed()))
    value = tables.partition_value(kind.table)
    if value is None:
        if not delta.isEmpty():
            known = tables.read_layer(spark, root, kind.layer, kind.table)
            both = kind.combined(known.unionByName(delta.select(*known.columns))).filter(F.col(kind.alive) > 0).select(*known.columns)
            tables.store(stored(both), root, kind.layer, kind.table)
        return delta
    spans = [r[0] for r in delta.select(value.alias("v")).distinct().collect()]  # calendar years or months
    if not spans:
        return delta
    part = tables.PARTITIONS[kind.table][0]
    known = tables.read_layer(spark, root, kind.layer, kind.table, keep_partition=True).filter(F.col(part).isin(spans)).drop(part)
    both = kind.combined(known.unionByName(delta.select(*known.columns))).filter(F.col(kind.alive) > 0).select(*known.columns)
    tables.store(stored(both), root, kind.layer, kind.table, dynamic=True)
    return delta


def add_users(spark: SparkSession, root: str, user_feed: str) -> DataFrame:
    """Bring the counts of reputations up to date with the change feed of staged users; the counts."""
    staged = tables.read_layer(spark, root, "staging", "stg_users")
    if not tables.exists(spark, tables.table_path(root, LAYER, REPUTATION.table)):
        return tables.store(dimensions.reputation_counts(staged), root, LAYER, REPUTATION.table)
    add(spark, root, REPUTATION, dimensions.reputation_counts(signed(read_feed(spark, user_feed, staged.schema))))
    return tables.read_layer(spark, root, LAYER, REPUTATION.table)


def _tag_years(per_user: DataFrame) -> DataFrame:
    return marts.volume_of(per_user.withColumn("question_year", F.year("period").cast("long")))


def _tag_totals(per_user: DataFrame) -> DataFrame:
    keep = [c for c in TAG_USER.sums]
    return marts.answer_totals(per_user.groupBy("tag_name", "user_id").agg(*[F.sum(c).alias(c) for c in keep]))


_PER_TAG = {"tag_years": _tag_years, "tag_totals": _tag_totals}


def rebuild(spark: SparkSession, root: str, as_of: Moment = None) -> None:
    """All sums from whole facts."""
    fq, fa = (tables.read_layer(spark, root, "warehouse", t) for t in ("fact_questions", "fact_answers"))
    per_user = tables.store(tag_user_rows(fq), root, LAYER, TAG_USER.table)
    tables.store(tag_latency_rows(fq, fa), root, LAYER, TAG_LATENCY.table)
    tables.store(user_post_rows(fq, fa), root, LAYER, USER_POSTS.table)
    tables.store(tag_asker_rows(fq), root, LAYER, TAG_ASKERS.table)
    activity = tables.read_layer(spark, root, "warehouse", "fact_user_activity")
    tables.store(month_user_rows(activity), root, LAYER, MONTH_USERS.table)
    for table, compute in _PER_TAG.items():
        tables.store(compute(per_user).withColumn("computed_at", ntz(as_of)), root, LAYER, table)


def refresh_tags(spark: SparkSession, root: str, touched: DataFrame, as_of: Moment = None) -> None:
    """Recompute the rows of the touched tags from the stored sums; rows of other tags are copied."""
    touched = stored(touched.select("tag_name").distinct())
    per_user = near_keys(tables.read_layer(spark, root, LAYER, TAG_USER.table), "tag_name", touched).join(touched, "tag_name", "left_semi")
    for table, compute in _PER_TAG.items():
        known = tables.read_layer(spark, root, LAYER, table)
        fresh = compute(per_user).withColumn("computed_at", ntz(as_of)).select(*known.columns)
        tables.store(stored(known.join(touched, "tag_name", "left_anti").unionByName(fresh)), root, LAYER, table)


def touched_latency(fq: DataFrame, fa: DataFrame, questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Signed latency sums of the questions whose first or accepted answer may have changed.

    ``fq`` and ``fa`` are the facts after the change, ``questions`` and ``answers`` their
    change feeds. Before the change the same questions had the answers of now without the
    changed ones, and those as they were.
    """
    moved = F.col("_old").isNull() | ~F.col("accepted_answer_flag").eqNullSafe(F.col("_old.accepted_answer_flag"))
    ids = stored(answers.filter(moved).select("question_id").unionByName(
        questions.filter("_old IS NULL").select("question_id")).filter("question_id IS NOT NULL").distinct())
    of = lambda df, *cols: near_keys(df.select("question_id", *cols), "question_id", ids).join(ids, "question_id", "left_semi")
    asked = stored(of(fq, "creation_date", "creation_timestamp", "tags_clean"))
    cols = ("answer_id", "creation_date", "creation_timestamp", "accepted_answer_flag")
    now = stored(of(fa, *cols))
    changed = answers.join(ids, "question_id", "left_semi")
    untouched = now.join(changed.select("answer_id"), "answer_id", "left_anti").select("question_id", *cols)
    before = untouched.unionByName(changed.filter("_old IS NOT NULL").select("question_id", *[F.col(f"_old.{c}").alias(c) for c in cols]))
    known = asked.join(questions.filter("_old IS NULL").select("question_id"), "question_id", "left_anti")
    return tag_latency_rows(asked, now).unionByName(tag_latency_rows(known, before, -1))


def add_changes(spark: SparkSession, root: str, question_feed: str, answer_feed: str, as_of: Moment = None) -> DataFrame:
    """Add the changes that the fact merges told to the activity facts and, where they exist, to all sums; the touched tags."""
    fq, fa = (tables.read_layer(spark, root, "warehouse", t) for t in ("fact_questions", "fact_answers"))
    questions, answers = read_feed(spark, question_feed, fq.schema), read_feed(spark, answer_feed, fa.schema)
    both = signed(questions), signed(answers)
    active = add(spark, root, ACTIVITY, activity_rows(*both))
    if not exists(spark, root):
        return spark.createDataFrame([], "tag_name string")
    added = add(spark, root, TAG_USER, tag_user_rows(both[0]))
    add(spark, root, USER_POSTS, user_post_rows(*both))
    add(spark, root, MONTH_USERS, month_user_rows(active))
    add(spark, root, TAG_ASKERS, tag_asker_rows(both[0]))
    add(spark, root, TAG_LATENCY, touched_latency(fq, fa, questions, answers))
    touched = stored(added.select("tag_name").distinct())
    if not touched.isEmpty():
        refresh_tags(spark, root, touched, as_of)
    return touched


# ---- marts from sums


def growth(spark: SparkSession, root: str, min_year: int) -> DataFrame:
    years = tables.read_layer(spark, root, LAYER, "tag_years").drop("computed_at")
    return marts.growth_of(years.filter(F.col("question_year") >= min_year))


def gaps(spark: SparkSession, root: str, min_questions: int) -> DataFrame:
    totals = tables.read_layer(spark, root, LAYER, "tag_totals").drop("computed_at")
    return marts.ranked_gaps(marts.answer_state(totals, min_questions))


def latency(spark: SparkSession, root: str, min_questions: int, interpolate: bool) -> DataFrame:
    rows = tables.read_layer(spark, root, LAYER, TAG_LATENCY.table)
    per_value = rows.groupBy("tag_name", "hours_to_first_answer").agg(*[F.sum(c).alias(c) for c in TAG_LATENCY.sums])
    return marts.ranked_latency(marts.latency_columns(marts.exact_latency_of(per_value, interpolate), min_questions))


def contributors(spark: SparkSession, root: str, dim_user: DataFrame, as_of: Moment = None) -> DataFrame:
    rows = tables.read_layer(spark, root, LAYER, USER_POSTS.table)
    asked = rows.filter("questions > 0").groupBy("user_id").agg(
        F.sum("questions").alias("total_questions_asked"),
        rnd(ratio(F.sum("question_score_sum"), F.sum("question_score_n")), 2).alias("avg_question_score"),
        F.sum("views").alias("total_views_generated"))
    answered = marts.answer_stats_of(rows.filter("answers > 0"))
    return marts.ranked_contributors(marts.combined_stats(answered, asked), dim_user, as_of)


def retention(spark: SparkSession, root: str) -> DataFrame:
    return marts.retention_of_bitmaps(tables.read_layer(spark, root, LAYER, MONTH_USERS.table).select("activity_month", "bucket", "users", "posts"))


def distinct_askers(spark: SparkSession, root: str, *span: Column) -> DataFrame:
    """Estimated distinct askers per tag and span of months, from stored sketches alone."""
    return marts.distinct_askers(tables.read_layer(spark, root, LAYER, TAG_ASKERS.table), *span)
