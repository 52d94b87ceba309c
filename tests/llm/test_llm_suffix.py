import hashlib
import random

import numpy as np
import pytest

from conftest import SF_DIR, rows
from forumlens.llm import suffix

KIND = "doc_id long, text string"


def brute(data):
    """By the definition, position by position."""
    order = sorted(range(len(data)), key=lambda i: (data[i][0] is None, data[i][0] or 0))
    seen, out = set(), [None] * len(data)
    for i in order:
        raw = (data[i][1] or "").encode()
        cover = np.zeros(len(raw) + 1, int)
        for p in range(len(raw) - 99):
            s = raw[p:p + 100]
            if s in seen:
                cover[p] += 1
                cover[p + 100] -= 1
            seen.add(s)
        gone = np.cumsum(cover[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[i] = (data[i][0], len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def key(r):
    return tuple((v is not None, v) for v in r)


def planted():
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    shared = [text(n) for n in (60, 99, 100, 101, 130, 170, 400)]
    data = [(i, "".join(rng.choice([text(rng.randint(1, 80)), rng.choice(shared)]) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    return data + [(100, "ab" * 300), (101, "z" * 450), (102, "z" * 120), (103, "ab" * 60), (104, shared[-1][:250] + text(5) + shared[-1][240:])]


@pytest.mark.parametrize("block", [2 << 20, 300])
def test_planted_repeats_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block)  # small blocks: texts in overlapping pieces
    data = planted()
    got = suffix.removal_digest(suffix.repeated_strings(spark.createDataFrame(data, KIND).repartition(3)))
    assert rows(got) == sorted(brute(data), key=key)


def test_edge_rows(spark):
    long = "The quick brown fox jumps over the lazy dog and runs away from all of them, as it has always done before."
    data = [(1, None), (2, ""), (3, "short"), (5, long), (5, long), (None, long + "!"), (4, "x" + long), (-7, long[:99]), (None, None)]
    docs = spark.createDataFrame(data, KIND)
    got = suffix.removal_digest(suffix.repeated_strings(docs.selectExpr("*", "text AS part", "1 AS seq")))
    assert rows(got) == sorted(brute(data), key=key)
    assert suffix.repeated_strings(docs.limit(0)).count() == 0


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    got = suffix.removal_digest(suffix.repeated_strings(docs))
    assert rows(got) == sorted(brute([tuple(r) for r in docs.collect()]), key=key)
