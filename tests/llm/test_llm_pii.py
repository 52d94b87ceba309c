import hashlib
import random
import re

from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from forumlens.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in text.split(".")),
            "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def brute(text):
    found = [(m.start(), i, m.end()) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if valid(k, m.group())]
    return sorted(found)


def texts():
    rng = random.Random(4)
    parts = ["a@b.com", "_x@c.org", "a@b", "@", "..", "1.2.3.4", ".5.6.7.8", "256.1.1.1", "001.2.3.004", "4111 1111 1111 1111", "4111-1111-1111-1111",
             "4111111111111112", "+1 (743) 555-3824", "+1", "+12345678901234567", " ", "  ", "-", "x", "é", "\U0001F600", "9", "12", "%+a@b-c.d.e-f", "\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(400)]


EDGE = [None, "", "a" * 100_000, "7" * 100_000, "1." * 50_000, "4111 1111 1111 1111 " * 3000, "a@b.com " * 5000, "+1" * 30_000]


def test_base_spans_equal_brute_force(spark):
    given = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()] + texts() + EDGE
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(8)
    for r in pii.with_base_spans(df, F.col("text"), "spans").collect():
        assert [tuple(s) for s in r.spans] == brute(r.text), repr((r.text or "")[:200])


def test_digest_of_rows(spark):
    df = spark.createDataFrame([(1, "mail a@b.com or 1.2.3.4"), (1, "mail a@b.com or 1.2.3.4"), (None, None), (2, "")], "doc_id long, text string")
    got = rows(pii.span_digest(pii.personal_data(df)))
    full = "email:5:12,ip:16:23"
    none = hashlib.sha256(b"").hexdigest()
    assert got == [(None, 0, 0, 0, 0, none, ""), (1, 1, 1, 0, 0, hashlib.sha256(full.encode()).hexdigest(), full),
                   (1, 1, 1, 0, 0, hashlib.sha256(full.encode()).hexdigest(), full), (2, 0, 0, 0, 0, none, "")]
    assert pii.personal_data(df.limit(0)).count() == 0


def test_contexts_discover_identifiers_and_leave_others(spark):
    seeds = [f"please call me at +1 555 010 {i:04d} tomorrow" for i in range(6)]
    docs = [*seeds, "please call me at 555-0199 tomorrow", "the year 1999 was good", "room 101 is there", "page 12345 of it"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.added] for r in pii.personal_data(df).collect()}
    assert got[6] == [(18, 3, 26)] and not any(v for k, v in got.items() if k != 6)
    red = {r.doc_id: r.text for r in pii.redacted(df.withColumn("added", F.lit(1)).withColumn("_key", F.lit("k"))).collect()}
    assert red[6] == "please call me at [PHONE] tomorrow" and red[0] == "please call me at [PHONE] tomorrow" and red[7] == docs[7]


def test_redaction_of_overlapping_spans_and_nulls(spark):
    df = spark.createDataFrame([(1, "x +378282246310005 y"), (2, None), (3, ""), (4, "a@b.com"), (None, "1.2.3.4 und 4111 1111 1111 1111é")], "doc_id long, text string")
    got = rows(pii.redacted(df))
    assert got[0] == (None, "[IP] und [CARD]é") and got[2:] == [(2, None), (3, ""), (4, "[EMAIL]")]
    assert got[1] == (1, "x [PHONE] y")  # a phone number whose digits are a card number too
    assert pii.redacted(df.limit(0)).columns == ["doc_id", "text"]


def added_of(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    return {docs[r.doc_id]: [(docs[r.doc_id][a:b], k) for a, k, b in r.added] for r in pii.personal_data(df).collect()}


def test_found_identifiers_support_further_contexts(spark):
    first = [f"please call me at +1 555 010 {i:04d} tomorrow" for i in range(8)]
    docs = [*first, *[f"please call me at 555-01{k}9 tomorrow" for k in "4"], "fax of ours: 555-0149 ask reception",
            *[f"fax of ours: +1 555 010 {i:04d} ask reception" for i in (0, 1)], "fax of ours: 555-7777 ask reception", "the year 1999 was good"]
    # two base seeds and one found identifier stand in the fax context: together they support it
    got = added_of(spark, docs)
    assert got["please call me at 555-0149 tomorrow"] == [("555-0149", 3)]
    assert got["fax of ours: 555-7777 ask reception"] == [("555-7777", 3)] and got["the year 1999 was good"] == []


def test_tokens_beside_a_base_match_stay_instances(spark):
    seeds = [f"please call me at +1 555 010 {i:04d} tomorrow" for i in range(8)]
    docs = [*seeds, "write a@b.com 555-0199 tomorrow", "a@b.com c@d.org \ue000x555-0177 tomorrow", "é x=1.2.3.4; 4111 1111 1111 1111 x555-0188 tomorrow"]
    got = added_of(spark, docs)
    assert [got[d] for d in docs[8:]] == [[("555-0199", 3)], [("x555-0177", 3)], [("x555-0188", 3)]]
    assert not any(got[d] for d in seeds)


def test_runs_are_cut_at_base_matches(spark):
    df = spark.createDataFrame([(t, t) for t in texts()], "key string, text string").repartition(8)
    found = pii.with_base_spans(df, F.col("text"), "base")
    base = {r.key: [tuple(s) for s in r.base] for r in found.collect()}
    for r in pii.occurrences(found).collect():
        assert r.key[r.start:r.end] == r.instance
        assert r.seed == next((k for a, k, b in base[r.key] if a < r.end and b > r.start), None), repr((r.key[:200], r.instance))
