"""Secrets in text: candidates by form, false positives removed by a random forest.

Candidates are runs of at least ``SHORTEST`` characters that keys and tokens are made of; an
equals sign ends a name, and belongs to a candidate as its padding only.
Each is described by its length, its character classes and the transitions between them,
the share of its letter runs that are words of the corpus (dictionary coverage), words of
the document's path that mark tests and samples, and the words before and after it. A
forest trained on labelled findings tells secrets from identifiers, numbers and long words.

DataFrame functions and Spark's own forest only. Dictionary counts cover the whole corpus,
but only words that some candidate contains leave the map side. Training uses a bounded
sample of findings (``SAMPLE_ROWS``), as many of each label, different candidates only.

Findings may come labelled from a review: ``train`` takes any and then uses all features.
``labelled_by_form`` gives first labels where there is no review: secrets are random-looking
values assigned to a name like "token", the opposite are candidates without an assignment
that are all letters or all digits; whatever is neither stays unlabelled and is left to the
forest. A forest learned from such labels does not see assignment and name (``BY_FORM``), or
it would only repeat the rule that made them.

Defined results: NULL and empty texts have no findings; repeated rows have equal findings;
positions are code points, ends exclusive; with findings of one label only, every candidate
gets that label's probability, with none every candidate has probability 0.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, maybe_in, running_total, stored

SHORTEST, SAMPLE_ROWS, TREES, DEPTH, SEED = 16, 20_000, 40, 6, 11
#: Documents a word must occur in to count as a dictionary word.
KNOWN_FROM = 3
CANDIDATE = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{SHORTEST},}}+={{0,2}}(?![A-Za-z0-9+/_-])"
#: Characters before and after a candidate that its surroundings are taken from, other candidates among them.
BEFORE, AFTER = 48, 32
#: Names that secrets are assigned to, and words of paths that mark samples (fixed values).
NAMES = ("token", "secret", "password", "passwd", "pwd", "key", "apikey", "credential", "auth", "bearer")
SAMPLES = ("test", "tests", "example", "examples", "sample", "docs", "mock", "fixture", "fixtures")
FEATURES = ("length", "digits", "upper", "lower", "hex", "marks", "transitions", "distinct", "longest_run", "coverage",
            "quoted", "assigned", "named", "word_before", "word_after", "sample_path")
#: What a forest sees that learns from ``labelled_by_form``: no feature that made the labels' names.
BY_FORM = tuple(f for f in FEATURES if f not in ("assigned", "named"))


def _count(text: Column, cls: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{cls}]", ""))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(doc_id, key, start, end, candidate, before, after, path): candidates with their surroundings; key is the text's hash."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"),
                       F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"))
    found = (rows.withColumns({"gaps": F.split("text", CANDIDATE, -1), "hits": F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))})
             .filter(F.size("hits") > 0)
             .withColumn("ends", running_total(F.zip_with(F.slice("gaps", 1, F.size("hits")), "hits", lambda g, h: F.length(g) + F.length(h))))
             # edges of the gaps are all that surroundings need; candidates between them count as text
             .withColumns({"left": F.transform("gaps", lambda g: F.substring(g, -BEFORE, BEFORE)), "right": F.transform("gaps", lambda g: F.substring(g, 1, AFTER))})
             .select("doc_id", "key", "path", F.explode(F.arrays_zip(
                 "hits", "ends", *[_shifted(side, k).alias(f"{side[0]}{k + 3}") for side, k in _AROUND])).alias("c"))
             .filter("c.hits is not null"))  # shifted lists are longer
    at = lambda side, k: F.coalesce(F.col(f"c.{side}{k + 3}"), F.lit(""))
    before = F.concat(*[at(side[0], k) for side, k in _AROUND if side == "left" or (side == "hits" and k < 0)])
    after = F.concat(*[at(side[0], k) for side, k in _AROUND if side == "right" or (side == "hits" and k > 0)])
    return found.select("doc_id", "key", (F.col("c.ends") - F.length("c.hits")).cast("long").alias("start"), F.col("c.ends").cast("long").alias("end"),
                        F.col("c.hits").alias("candidate"), F.substring(before, -BEFORE, BEFORE).alias("before"),
                        F.substring(after, 1, AFTER).alias("after"), "path")


# a candidate has SHORTEST characters or more, so three of them fill the space before, two that after
_AROUND = [("left", -3), ("hits", -3), ("left", -2), ("hits", -2), ("left", -1), ("hits", -1), ("left", 0),
           ("right", 1), ("hits", 1), ("right", 2), ("hits", 2), ("right", 3)]


def _shifted(parts: str, k: int) -> Column:
    """A list moved so that its element ``i + k`` stands at ``i``; rows of a long text stay small, as no list travels whole."""
    return F.slice(parts, k + 1, F.size(parts)) if k > 0 else F.concat(F.array_repeat(F.lit(""), -k), F.col(parts))


def _letter_runs(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z]+", -1), lambda w: F.length(w) >= 3)


def dictionary(docs: DataFrame, wanted: DataFrame, text_col: str = "text", known_from: int = KNOWN_FROM) -> DataFrame:
    """(word): letter runs of ``wanted`` that at least ``known_from`` documents contain, counted over all documents."""
    said = docs.select(F.explode(F.array_distinct(F.filter(F.split(F.lower(text_col), "[^a-z]+", -1), lambda w: F.length(w) >= 3))).alias("word"))
    marked, flag = maybe_in(said, ["word"], wanted)
    counts = marked.filter(flag).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= known_from)
    return counts.join(wanted, "word", "left_semi").select("word")


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Candidates with their features."""
    found = stored(candidates(docs, id_col, text_col, path_col), "secret-candidates")
    # dictionary coverage, per distinct candidate
    parts = stored(found.select("candidate").distinct().select("candidate", F.explode(_letter_runs(F.col("candidate"))).alias("word")), "secret-words")
    known = stored(dictionary(docs, parts.select("word").distinct(), text_col), "secret-dictionary")
    covered = (parts.join(known, "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("known")))
    c = F.col("candidate")
    n = F.length(c)
    classes = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "+/_=-", ".....")
    runs = F.regexp_extract_all(classes, F.lit(r"(.)\1*+"), F.lit(0))
    near = F.lower("before")
    name = F.regexp_extract(near, r"([a-z_-]+)[\"']?\s*[:=]+\s*[\"']?$", 1)
    word = lambda side, pattern: F.lower(F.regexp_extract(side, pattern, 1))
    yes = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    features = {
        "length": n.cast("double"), "digits": _count(c, "0-9") / n, "upper": _count(c, "A-Z") / n, "lower": _count(c, "a-z") / n,
        "hex": _count(F.lower(c), "0-9a-f") / n, "marks": _count(c, "+/_=-") / n,
        "transitions": (F.size(runs) - 1) / n, "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "longest_run": F.array_max(F.transform(runs, F.length)) / n, "coverage": F.coalesce("known", F.lit(0)) / n,
        "quoted": yes(near.rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")), "assigned": yes(near.rlike(r"[:=]\s*[\"']?$")),
        "named": yes(F.exists(F.array(*map(F.lit, NAMES)), lambda w: F.contains(name, w))),
        "word_before": F.length(word("before", r"(\p{L}+)\P{L}*$")).cast("double"),
        "word_after": F.length(word("after", r"^\P{L}*(\p{L}+)")).cast("double"),
        "sample_path": yes(F.arrays_overlap(F.split(F.lower("path"), "[^a-z]+"), F.array(*map(F.lit, SAMPLES))))}
    out = stored(found.join(covered, "candidate", "left").withColumns(features)
                 .select("doc_id", "key", "start", "end", "candidate", "path", *FEATURES), "secret-features")
    for df in (found, parts, known):
        discard(df)
    return out


def labelled_by_form(found: DataFrame) -> DataFrame:
    """Candidates with a first label: 1.0 secret, 0.0 not; unlabelled ones are left out."""
    uniform = (F.col("digits") == 1) | (F.col("digits") + F.col("marks") == 0)
    secret = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("digits") >= 0.1) & (F.col("transitions") >= 0.2)
    return found.withColumn("label", F.when(secret, 1.0).when(uniform & (F.col("assigned") == 0), 0.0)).filter("label is not null")


def train(findings: DataFrame, sample_rows: int = SAMPLE_ROWS, features: tuple[str, ...] = FEATURES):
    """Assembler and forest fitted on at most ``sample_rows`` labelled findings, half of each label, different candidates only."""
    once = findings.groupBy("candidate", "label").agg(*[F.max(f).alias(f) for f in FEATURES])
    halves = [once.filter(F.col("label") == v).orderBy(F.xxhash64("candidate"), "candidate").limit(sample_rows // 2) for v in (0.0, 1.0)]
    sample = stored(halves[0].unionByName(halves[1]), "secret-findings")
    if sample.select("label").distinct().count() < 2:
        row = sample.first()
        return float(row.label) if row else 0.0
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), forest]).fit(
        sample.coalesce(1).sortWithinPartitions("label", "candidate"))


def secrets(found: DataFrame, model, least: float = 0.5) -> DataFrame:
    """(doc_id, start, end, candidate, probability) of the candidates that the forest takes for secrets."""
    if isinstance(model, float):
        scored = found.withColumn("probability", F.lit(model))
    else:
        scored = model.transform(found).withColumn("probability", vector_to_array("probability")[1])
    return scored.filter(F.col("probability") >= least).select(
        "doc_id", "start", "end", "candidate", F.round("probability", 6).alias("probability"))
