import random

import pytest

from conftest import SF_DIR
from forumlens.llm import packing
from forumlens.llm.queries import QUERIES


def check(rows, sizes, texts):
    """Every byte is placed once, bins hold their contents without overlap and have the smallest size that does."""
    bins, placed = {}, {}
    for r in rows:
        placed.setdefault(r.doc_id, []).append((r.start, r.length))
        if r.length == 0:
            assert r.bin_id is None and r.bin_size is None
        else:
            bins.setdefault((r.bin_id, r.bin_size), []).append((r.bin_offset, r.length))
    for doc, n in texts.items():
        at = 0
        for start, length in sorted(placed[doc]):
            assert start == at and length <= max(sizes)
            at += length
        assert at == n
    assert len({b for b, _ in bins}) == len(bins)
    for (_, size), parts in bins.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size and not [s for s in sizes if at <= s < size]
    return sum(sum(n for _, n in p) for p in bins.values()) / max(1, sum(s for _, s in bins))


def test_given_documents(spark):
    texts = {r.doc_id: len(r.text.encode()) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    fill = check(QUERIES["op8_variable_best_fit"](spark, SF_DIR).collect(), packing.SIZES, texts)
    assert fill > 0.97


@pytest.mark.parametrize("seed", range(5))
def test_plans_hold_every_piece(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 64): rng.choice([1, 2, 7, 1000]) for _ in range(rng.randint(1, 40))}
    made = packing.plan(histogram, (16, 32, 64))
    used = {}
    for length, count in histogram.items():
        for number in range(count):
            at = max(i for i, k in enumerate(made.key) if k <= (length << 40 | number))
            assert made.key[at] >> 40 == length
            within = number - (made.key[at] & ((1 << 40) - 1))
            b = made.first_bin[at] + within // made.per_bin[at]
            used[b] = used.get(b, 0) + length
    for b, n in used.items():
        size = made.bin_size[max(i for i, s in enumerate(made.bin_start) if s <= b)]
        assert n <= size and not [s for s in (16, 32, 64) if n <= s < size]
    # never worse than one piece short of half full
    assert sum(used.values()) > 0.5 * sum(made.bin_size[max(i for i, s in enumerate(made.bin_start) if s <= b)] for b in used)


def test_sizes_are_chosen_together():
    # three pieces of 20 fill 60 of 64; alone each would take a bin of 32
    made = packing.plan({20: 3}, (32, 64), cost=lambda s: s)
    assert list(made.bin_size) == [64]
    dear = packing.plan({20: 3}, (32, 64), cost=lambda s: s * s)
    assert list(dear.bin_size) == [32] or set(dear.bin_size) == {32}


def test_edge_rows(spark):
    long = "é" * 20_000
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, long, 5), (4, "abc", 5), (4, "abc", 5), (None, "xyz", 5)],
                                 "doc_id long, text string, bin_id int")
    got = packing.packed(docs).collect()
    assert sorted(r.length for r in got if r.doc_id == 3) == [40_000 - 2 * 16384, 16384, 16384]
    assert [r.bin_id for r in got if r.doc_id in (1, 2)] == [None, None]
    same = [r for r in got if r.doc_id == 4]
    assert len(same) == 2 and len({(r.bin_id, r.bin_offset) for r in same}) == 2
    assert len([r for r in got if r.doc_id is None]) == 1
    assert packing.packed(docs.limit(0)).count() == 0
