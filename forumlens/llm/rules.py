"""Quality rules whose thresholds the corpus sets, per language and source.

Every document is measured once: words, symbols, repeated lines, repeated runs of three
words. Four signals follow, whole numbers in fixed units (``SIGNALS``). Each signal of each
(language, source) has a quantile sketch: counts per bucket, buckets of one value up to 127
and of one sixty-fourth of the value above, so that a quantile is off by less than 1.6 % and
sketches merge by adding counts (``merged``): of days, of shards, of the sources of a
language. Sums do not depend on the order of rows, so thresholds are the same on every run.

A threshold is Tukey's far fence, q3 + 3 (q3 - q1), and q1 - 3 (q3 - q1) for signals with a
lower side; the quartile distance counts as ``least`` at least, since in many groups most
documents have no symbol and no repeated line. A group borrows from the merged sketches of
its language, and the language from those of the corpus, with the weight of ``PRIOR``
documents: large groups follow themselves, small ones their language. Documents are then
joined with the thresholds of their group and kept where every signal is inside.

Large groups are joined by a broadcast of a thousand groups at most, the others by a shuffle.
Everything is a built-in function; windows run over the buckets of one group (4,000 at most).

Defined results: a NULL text counts as empty; a text without words has no signals and fails
the base rule. NULL languages and sources are groups like others, missing columns count as
NULL. Repeated rows are judged one by one, each counting in the sketches. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, joined_by_group, stored, union_all

# Fixed values of the base measures and the base rule.
SPACES, GAP, SYMBOLS = " \t\n\x0b\f\r", r"[\x20\x09-\x0D]+", "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PCT = 50, 50
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: (signal, numerator, denominator, factor, has a lower side, least quartile distance in the signal's unit)
SIGNALS = (
    ("word_length", "word_chars", "n_words", 100, True, 40),
    ("symbols", "n_symbols", "word_chars", 10_000, False, 60),
    ("dup_lines", "n_dup_lines", "n_lines", 10_000, False, 700),
    ("repeats", "n_repeat_words", "n_words", 10_000, False, 700),
)
FENCE, PRIOR = 3, 100


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside runs of three that stand twice or more in ``words``."""
    three = lambda w: F.zip_with(
        F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b)),
        F.slice(w, 3, F.size(w)), lambda ab, c: F.concat(ab, F.lit(" "), c))
    placed = F.filter(F.transform(three(words), lambda x, i: F.struct(x.alias("run"), i.alias("at"))), lambda s: s["run"].isNotNull())
    flagged = lambda s: _let(
        F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.coalesce(a["run"] == b["run"], F.lit(False))),
        lambda next_: F.zip_with(F.zip_with(s, next_, lambda a, n: F.struct(a["at"].alias("at"), n.alias("on"))),
                                 F.concat(F.array(F.lit(False)), F.slice(next_, 1, F.greatest(F.size(next_) - 1, F.lit(0)))),
                                 lambda a, p: F.when(a["on"] | p, a["at"])))
    starts = F.array_sort(F.array_compact(_let(F.array_sort(placed), flagged)))
    return _let(starts, lambda s: F.aggregate(
        F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, x: total + x))


def _div(a: Column, b: Column) -> Column:
    """Quotient of whole numbers, rounded towards zero."""
    return F.call_function("div", a, b)


def _long(n: Column) -> Column:
    return n.cast("long")


def measured(docs: DataFrame, text_col: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with a struct of base measures, the number of lines with a word, and the signals of every whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = lambda x: F.translate(x, SPACES, "")
    counts = F.struct(
        _let(F.filter(F.split(text, GAP), lambda w: w != ""),
             lambda w: F.struct(_long(F.size(w)).alias("n"), _repeat_words(w).alias("repeated"))).alias("words"),
        _let(F.filter(F.split(text, "\n"), lambda x: bare(x) != ""),
             lambda x: F.struct(_long(F.size(x)).alias("n"), _long(F.size(x) - F.size(F.array_distinct(x))).alias("repeated"))).alias("lines"),
        _long(F.length(bare(text))).alias("word_chars"), _long(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"))

    def described(c: Column) -> Column:
        value = {"n_words": c["words"]["n"], "word_chars": c["word_chars"], "n_symbols": c["n_symbols"], "n_dup_lines": c["lines"]["repeated"],
                 "n_repeat_words": c["words"]["repeated"], "n_lines": c["lines"]["n"]}
        signals = [F.when(value["n_words"] > 0, _div(value[top] * F.lit(factor).cast("long"), value[below])).alias(name)
                   for name, top, below, factor, _, _ in SIGNALS]
        failed = (value["n_words"] < LEAST_WORDS) | (value["n_repeat_words"] * 100 > value["n_words"] * MOST_REPEATED_PCT)
        return F.struct(*[v.alias(n) for n, v in value.items()], *signals, failed.alias("base_failed"))

    return docs.withColumn(into, _let(counts, described))


# ---- sketches


def bucket(value: Column) -> Column:
    """Bucket of a whole number from 0 on; numbers up to 127 have their own."""
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return shift * 64 + F.call_function("shiftright", value, shift)


def bucket_floor(b: Column) -> Column:
    """The smallest number of a bucket."""
    return F.when(b < 128, b).otherwise(F.call_function("shiftleft", F.pmod(b, F.lit(64)) + 64, (F.floor(b / 64) - 1).cast("int")))


def sketched(rows: DataFrame, keys: list[str], into: str = "quality") -> DataFrame:
    """(keys, signal, bucket, n): the sketch of every signal of every group."""
    one = [F.struct(F.lit(name).alias("signal"), bucket(F.col(f"`{into}`.{name}")).alias("bucket")) for name, *_ in SIGNALS]
    found = rows.filter(F.col(f"`{into}`.n_words") > 0).select(*keys, F.explode(F.array(*one)).alias("_s"))
    return found.groupBy(*keys, F.col("_s.signal").alias("signal"), F.col("_s.bucket").cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups, or of several tables of sketches one below the other."""
    return sketches.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))


def _fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, signal, n, low, high): documents and far fences of every group."""
    group = Window.partitionBy(*keys, "signal")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    quarters = (sketches.withColumns({"upto": upto, "total": F.sum("n").over(group)}).groupBy(*keys, "signal")
                .agg(F.max("total").alias("n"), F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("b1"),
                     F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("b3"))
                .select(*keys, "signal", "n", bucket_floor(F.col("b1")).alias("q1"), bucket_floor(F.col("b3")).alias("q3")))
    least = F.create_map(*[F.lit(x) for name, *_, least in SIGNALS for x in (name, least)])[F.col("signal")]
    reach = F.greatest(F.col("q3") - F.col("q1"), least) * FENCE
    return quarters.select(*keys, "signal", "n", F.greatest(F.col("q1") - reach, F.lit(0)).alias("low"), (F.col("q3") + reach).alias("high"))


def _borrowed(own: DataFrame, wider: DataFrame, keys: list[str]) -> DataFrame:
    """Fences of groups drawn towards those of the wider groups they belong to."""
    other = wider.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("signal").alias("_signal"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    both = own.join(other, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("signal") == F.col("_signal")])
    drawn = lambda c: _div(F.col(c) * F.col("n") + F.col(f"_{c}") * PRIOR, F.col("n") + PRIOR).alias(c)
    return both.select(*own.drop("low", "high").columns, drawn("low"), drawn("high"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """(lang, source, n, <signal>_low, <signal>_high): one row per group of ``sketches`` (lang, source, signal, bucket, n)."""
    by_language = merged(sketches, ["lang"])
    language = _borrowed(_fences(by_language, ["lang"]), _fences(merged(by_language, []), []), [])
    own = _borrowed(_fences(sketches, ["lang", "source"]), language, ["lang"])
    side = lambda name, c: F.max(F.when(F.col("signal") == name, F.col(c))).alias(f"{name}_{c}")
    return own.groupBy("lang", "source").agg(F.max("n").alias("n"), *[side(name, c) for name, *_ in SIGNALS for c in ("low", "high")])


# ---- the verdict


def judged(rows: DataFrame, limits: DataFrame, lang_col: str = "lang", source_col: str = "source", into: str = "quality",
           verdict: str = "kept") -> DataFrame:
    """``rows`` of ``measured`` with the verdict: base rule passed and every signal within its group's thresholds."""
    names = [c for c in limits.columns if c not in ("lang", "source")]
    mine = fresh(rows, *(f"_{c}" for c in names))
    keyed = limits.select(F.col("lang").alias(lang_col), F.col("source").alias(source_col), *[F.col(c).alias(m) for c, m in zip(names, mine)])
    joined = joined_by_group(rows, [lang_col, source_col], keyed, mine[names.index("n")])
    of = dict(zip(names, mine))
    inside = F.lit(True)
    for name, *_, lower, _least in SIGNALS:
        signal = F.col(f"`{into}`.{name}")
        inside = inside & (signal <= F.col(of[f"{name}_high"]))
        if lower:
            inside = inside & (signal >= F.col(of[f"{name}_low"]))
    return joined.withColumn(verdict, ~F.col(f"`{into}`.base_failed") & F.coalesce(inside, F.lit(False))).drop(*mine)


def with_columns_of(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with the columns it lacks, as NULL text."""
    return docs.withColumns({c: F.lit(None).cast("string") for c in needed if c not in docs.columns})


def filtered(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
             history: DataFrame | None = None) -> DataFrame:
    """The documents that pass, with the columns of ``docs``.

    ``history`` are sketches (lang, source, signal, bucket, n) of earlier runs; they are merged with this one's.
    """
    into, verdict = fresh(docs, "_quality", "_kept")
    rows = stored(measured(with_columns_of(docs, lang_col, source_col), text_col, into), "rules-rows")
    sketches = sketched(rows.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), into), ["lang", "source"], into)
    if history is not None:
        sketches = merged(union_all([sketches, history.select(*sketches.columns)]), ["lang", "source"])
    limits = thresholds(stored(sketches, "rules-sketches"))
    return judged(rows, limits, lang_col, source_col, into, verdict).filter(verdict).select(*docs.columns)
