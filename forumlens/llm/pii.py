"""Personal data: base patterns, and identifiers that bootstrapped contexts add to them.

The base finds e-mail addresses, IPv4 addresses, card numbers and phone numbers by their
form. Around every run of tokens with a digit or an @ sign, lexical patterns are read off:
the two words before, the words on either side, the two words after. The tokens of a base
match are a run of their own, a seed of its kind; those beside it are cut off as further runs.
Patterns and instances then score each other in rounds over their graph: a pattern by the
share of its instances that are of a kind, an instance by the patterns it stands in (noisy
or). Runs without a base match whose score reaches ``CONFIDENCE`` by patterns with at least
``SUPPORT`` different seeds are reported and are seeds of their kind from the next round on;
there are ``ROUNDS`` rounds, and more as long as the last one found something.

DataFrame functions throughout. Scores are computed on distinct (pattern, instance) pairs,
so copies of a document count once and a frequent word is combined before any shuffle.

Defined results: a NULL text counts as empty; repeated rows get equal results; positions are
code points, ends exclusive. Base spans of different kinds may overlap, and added spans
never overlap base spans. A base match that fails its check is dropped without a retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, joined_by_id, running_total, stored

KINDS = ("email", "ip", "card", "phone")
#: Leftmost non-overlapping matches. A start inside a run of the first class is tried only right
#: after a match, and repetitions are possessive: equal matches, in linear time and constant stack.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must contain for a pattern to match at all.
_NEEDS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_TOKEN = r"(?=[^\s0-9@]*+[0-9@])\S++"
RUN = rf"(?<!\S){_TOKEN}(?: {_TOKEN})*+"
#: Stand for the characters of base matches, one for each kind, where a run is cut; other uses in the run count as ``_OTHER``.
_MARKS, _OTHER = "\ue000\ue001\ue002\ue003", "\ue004"
#: One token that a base match touches (its spaces are marked as well), or tokens that none touches.
_PIECE = rf"[^ {_MARKS}]*+[{_MARKS}][^ ]*+|[^ {_MARKS}]++(?: [^ {_MARKS}]++(?![^ ]))*+"
SUPPORT, CONFIDENCE, ROUNDS = 3, 0.8, 3


def _located(text: Column, pattern: str) -> tuple[Column, Column]:
    """Gaps and matches of a pattern: gap 0, match 0, gap 1, match 1, …, last gap."""
    return F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _ends(gaps: Column, hits: Column) -> Column:
    return running_total(F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h)))


def _valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _spans(kind: str, hits: Column, ends: Column) -> Column:
    """Valid matches of a kind as (start, kind, end)."""
    pairs = F.filter(F.zip_with(hits, ends, lambda h, e: F.struct(h.alias("hit"), e.alias("end"))), lambda s: _valid(kind, s["hit"]))
    return F.transform(pairs, lambda s: F.struct((s["end"] - F.length(s["hit"])).alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                                 s["end"].alias("end")))


def with_base_spans(df: DataFrame, text: Column, out: str) -> DataFrame:
    """``df`` with the base matches of ``text``: array of (start, kind, end) in order of start and kind."""
    work = fresh(df, "_text", *(f"_{a}_{k}" for k in KINDS for a in ("gaps", "hits", "ends")))
    source, parts = work[0], {k: work[1 + 3 * i:4 + 3 * i] for i, k in enumerate(KINDS)}
    none = F.array().cast("array<string>")
    at = df.withColumn(source, F.coalesce(text, F.lit("")))
    possible = {k: F.col(source).rlike(_NEEDS[k]) for k in KINDS}
    for k, (gaps, hits, _) in parts.items():
        g, h = _located(F.col(source), PATTERNS[k])
        at = at.withColumns({gaps: F.when(possible[k], g).otherwise(none), hits: F.when(possible[k], h).otherwise(none)})
    at = at.withColumns({ends: _ends(F.col(gaps), F.col(hits)) for gaps, hits, ends in parts.values()})
    spans = []
    for k, (_, hits, ends) in parts.items():
        spans.append(_spans(k, F.col(hits), F.col(ends)))
    return at.withColumn(out, F.array_sort(F.concat(*spans))).drop(*work)


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _words(text: Column, first: bool) -> Column:
    """Words of the part of a gap next to the run, lower-cased, without punctuation."""
    near = F.substring(text, 1, 64) if first else F.substring(text, -64, 64)
    return F.filter(F.split(F.lower(near), r"[^\p{L}\p{N}']+", -1), lambda w: w != "")


def _marked(run: Column, start: Column, inside: Column) -> Column:
    """A run with the characters of base matches replaced by the mark of their kind; of overlapping ones the first counts."""
    at = lambda acc, s: F.greatest(acc["at"], s["start"] - start)
    end = lambda s: F.least(s["end"] - start, F.length(run))  # noqa: E731  # a match may reach into the next run
    plain = F.translate(run, _MARKS, _OTHER * len(_MARKS))
    mark = lambda s: F.substring(F.lit(_MARKS), s["kind"] + 1, F.lit(1))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    done = F.aggregate(inside, zero, lambda acc, s: F.struct(
        F.greatest(acc["at"], end(s)).alias("at"),
        F.concat(acc["text"], F.substring(plain, acc["at"] + 1, at(acc, s) - acc["at"]),
                 F.repeat(mark(s), F.greatest(F.lit(0), end(s) - at(acc, s)))).alias("text")))
    return F.concat(done["text"], F.substring(plain, done["at"] + 1, F.length(plain)))


def occurrences(rows: DataFrame) -> DataFrame:
    """(key, start, end, instance, seed, patterns) of every run, from rows (key, text, base)."""
    gaps, hits = _located(F.col("text"), RUN)
    whole = (rows.filter(F.col("text").rlike("[0-9@]")).withColumns({"gaps": gaps, "hits": hits})
             .withColumn("ends", _ends(F.col("gaps"), F.col("hits")))
             .select("key", "base", F.posexplode(F.arrays_zip("hits", "ends")).alias("i", "run"), "gaps")
             .select("key", "base", F.col("run.hits").alias("run"), F.col("run.ends").alias("run_end"),
                     F.get("gaps", F.col("i")).alias("before"), F.get("gaps", F.col("i") + 1).alias("after"))
             .withColumn("run_start", F.col("run_end") - F.length("run"))
             .withColumn("inside", F.filter("base", lambda s: (s["start"] < F.col("run_end")) & (s["end"] > F.col("run_start")))))
    pieces = F.when(F.size("inside") > 0, F.regexp_extract_all(_marked(F.col("run"), F.col("run_start"), F.col("inside")), F.lit(_PIECE), F.lit(0))
                    ).otherwise(F.array(F.translate("run", _MARKS, _OTHER * len(_MARKS))))
    # one space lies between pieces
    ends = running_total(F.transform("pieces", lambda p: F.length(p) + 1))
    cut = (whole.withColumn("pieces", pieces).withColumn("n", F.size("pieces"))
           .select("key", "run", "run_start", "before", "after", "n", F.posexplode(F.arrays_zip("pieces", ends.alias("ends"))).alias("i", "piece"))
           .withColumn("at", F.col("piece.ends") - 1 - F.length("piece.pieces")))
    found = cut.select("key", F.substring("run", F.col("at") + 1, F.length("piece.pieces")).alias("run"),
                       (F.col("run_start") + F.col("piece.ends") - 1).alias("run_end"),
                       (F.instr(F.lit(_MARKS), F.nullif(F.regexp_extract("piece.pieces", f"[{_MARKS}]", 0), F.lit(""))) - 1).alias("seed"),
                       F.when(F.col("i") == 0, F.col("before")).otherwise(" ").alias("before"),
                       F.when(F.col("i") == F.col("n") - 1, F.col("after")).otherwise(" ").alias("after"))
    lead = F.length(F.regexp_extract("run", r"^[^\p{L}\p{N}+(@]*", 0))
    cut = F.regexp_replace(F.regexp_replace("run", r"^[^\p{L}\p{N}+(@]+", ""), r"[^\p{L}\p{N})]+$", "")
    start = F.col("run_end") - F.length("run") + lead
    placed = found.select("key", "seed", "before", "after", cut.alias("instance"), start.alias("start"),
                          (start + F.length(cut)).alias("end")).filter(F.length("instance") >= 4)
    left, right = _words(F.col("before"), False), _words(F.col("after"), True)
    l1, l2 = (F.coalesce(F.try_element_at("left", F.lit(-n)), F.lit("^")) for n in (1, 2))
    r1, r2 = (F.coalesce(F.try_element_at("right", F.lit(n)), F.lit("$")) for n in (1, 2))
    return (placed.withColumns({"left": left, "right": right})
            .select("key", "start", "end", "instance", "seed",
                    F.array(F.concat_ws(" ", l2, l1, F.lit("_")), F.concat_ws(" ", l1, F.lit("_"), r1),
                            F.concat_ws(" ", F.lit("_"), r1, r2)).alias("patterns")))


def discovered(found: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """(instance, kind) of unseen identifiers, by rounds of mutual scoring over the pattern-instance graph."""
    edges = stored(found.select("instance", "seed", F.explode("patterns").alias("pattern"))
                   .groupBy("pattern", "instance").agg(F.min("seed").alias("seed")), "pii-edges")
    seeds = (edges.filter("seed is not null").groupBy("instance").agg(F.min("seed").alias("kind"))
             .withColumn("score", F.lit(1.0)))
    scores = known = seeds = stored(seeds, "pii-seeds")
    sizes = stored(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "pii-sizes")
    done = 0
    while True:
        # patterns with support among all that is known by now; others score nothing in this round
        strong = stored(edges.join(known, "instance").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
                        .filter(F.col("seeds") >= support).join(sizes, "pattern"), "pii-patterns")
        open_edges = stored(edges.join(strong.select("pattern").distinct(), "pattern").select("pattern", "instance"), "pii-graph")
        weight = open_edges.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"))
        reliable = (strong.join(weight, ["pattern", "kind"])
                    .select("pattern", "kind", F.least(F.lit(0.999), F.col("mass") / F.col("n")).alias("trust")))
        told = (open_edges.join(reliable, "pattern").groupBy("instance", "kind")
                .agg((1 - F.exp(F.sum(F.log1p(-F.col("trust"))))).alias("score"))
                .join(known.select("instance"), "instance", "left_anti"))
        best = stored(told.groupBy("instance").agg(F.max(F.struct(F.round("score", 9).alias("score"), (-F.col("kind")).alias("kind"))).alias("b"))
                      .select("instance", (-F.col("b.kind")).alias("kind"), F.col("b.score").alias("score")), "pii-best")
        sure = F.col("score") >= confidence
        n_new = best.filter(sure).count()
        old, scores = {id(x): x for x in (known, scores) if x is not seeds}, stored(known.unionByName(best), "pii-scores")
        known = stored(known.unionByName(best.filter(sure)), "pii-known")
        for df in (*old.values(), strong, open_edges, best):
            discard(df)
        done += 1
        if done >= rounds and not n_new:
            break
    out = stored(known.join(seeds.select("instance"), "instance", "left_anti").select("instance", "kind"), "pii-new")
    for df in (edges, sizes, seeds, scores, known):
        discard(df)
    return out


def added_spans(rows: DataFrame, **options) -> DataFrame:
    """(key, added): the spans that contexts add to the base spans of a text, from rows (key, text, base)."""
    found = stored(occurrences(rows), "pii-runs")
    new = discovered(found, **options)
    out = (found.filter("seed is null").join(new, "instance").groupBy("key")
           .agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("added")))  # of one text
    out = stored(out, "pii-added")
    discard(found)
    discard(new)
    return out


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, base, added, spans): arrays of (start, kind, end) of every row; kind counts through ``KINDS``."""
    rows = with_base_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), F.col("text"), "base")
    keyed = rows.select("doc_id", _text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"), "base")
    added = added_spans(keyed, **options)
    return (keyed.select("doc_id", "key", "base").join(added, "key", "left").drop("key")
            .withColumn("added", F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
            .withColumn("spans", F.array_sort(F.concat("base", "added"))))


def span_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans as text."""
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    return found.select("doc_id", *[of_kind(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every span of personal data in the text replaced by its kind in brackets; rows and columns stay."""
    key, base, more, spans, merged, cut = fresh(docs, "_key", "_base", "added", "_spans", "_merged", "_cut")
    keyed = with_base_spans(docs.withColumn(key, _text_key(F.col(text_col))), F.col(text_col), base)
    added = added_spans(keyed.select(F.col(key).alias("key"), F.coalesce(text_col, F.lit("")).alias("text"), F.col(base).alias("base")), **options)
    found = joined_by_id(docs.withColumn(key, _text_key(F.col(text_col))), key,
                         added.select(F.col("key").alias(key), F.col("added").alias(more)))
    found = with_base_spans(found, F.col(text_col), base).withColumn(
        spans, F.array_sort(F.concat(base, F.coalesce(more, F.array().cast("array<struct<start:int,kind:int,end:int>>")))))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    # overlapping spans become one, of the first one's kind
    joined = F.aggregate(F.col(spans), none, lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > s["start"]),
        F.array_append(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.struct(
            F.try_element_at(acc, F.lit(-1))["start"].alias("start"), F.try_element_at(acc, F.lit(-1))["kind"].alias("kind"),
            F.greatest(F.try_element_at(acc, F.lit(-1))["end"], s["end"]).alias("end")))).otherwise(F.array_append(acc, s)))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col(text_col)
    pieces = F.transform(F.col(merged), lambda s, i: F.concat(
        F.substring(text, F.coalesce(F.get(F.col(merged), i - 1)["end"], F.lit(0)) + 1,
                    s["start"] - F.coalesce(F.get(F.col(merged), i - 1)["end"], F.lit(0))),
        F.element_at(names, s["kind"] + 1)))
    tail = F.substring(text, F.try_element_at(F.col(merged), F.lit(-1))["end"] + 1, F.length(text))
    out = (found.withColumn(merged, joined)
           .withColumn(cut, F.when(F.size(merged) == 0, text).otherwise(F.concat(F.array_join(pieces, ""), tail))))
    return out.select(*[F.col(cut).alias(c) if c == text_col else F.col(c) for c in docs.columns])
