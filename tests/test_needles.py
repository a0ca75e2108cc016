"""Many needles in one scan against Python's own containment."""

import random

import pytest

from sifter.functions.text import fold_case
from sifter.operators import needles


def found(needle_rows, pages):
    return sorted((q, d) for q, n in needle_rows if n is not None for d, t in pages if t is not None and n.lower() in t.lower())


@pytest.mark.parametrize("block_bytes,pages_bytes,max_rows", [(1 << 20, 1 << 20, 1000), (8, 1, 1000), (1 << 20, 1 << 20, 3)])
def test_one_letter_overlapping_repeated_needles(spark, block_bytes, pages_bytes, max_rows):
    rng = random.Random(1)
    words = ["ab", "aba", "Baab", "a", "b c", "ÄB", "\U0001F600b"]
    pages = [(d, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for d in range(40)] + [(90, None), (91, ""), (92, "x" * 100_000 + "aba")]
    needle_rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 3)))) for i in range(25)]
    needle_rows += [(50, "a"), (51, "a"), (50, "aba"), (52, ""), (53, None), (54, "not there"), (55, "x" * 5000), (None, "äb")]
    n = spark.createDataFrame(needle_rows, "query_id long, needle string")
    p = spark.createDataFrame(pages, "doc_id long, t string").repartition(3)
    p = p.select("doc_id", fold_case("t").alias("page_lc"))
    got = needles.containing_any(n, p, "needle", ["doc_id"], block_bytes, pages_bytes, max_rows)
    assert got.columns == ["query_id", "doc_id"]
    if max_rows > 3:
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        assert sorted(map(tuple, got.collect()), key=key) == sorted(
            ((q, d) for q, x in needle_rows if x is not None for d, t in pages if t is not None and x.lower() in t.lower()), key=key)
    else:  # beyond the bound: the equi joins, a row for each (query id, page) at least
        assert set(map(tuple, got.collect())) == {(q, d) for q, x in needle_rows if x is not None for d, t in pages if t is not None and x.lower() in t.lower()}


def test_empty_sides(spark):
    n = spark.createDataFrame([(1, "a")], "query_id long, needle string")
    p = spark.createDataFrame([(1, "a b")], "doc_id long, page_lc string")
    assert needles.containing_any(n.limit(0), p, "needle", ["doc_id"]).collect() == []
    assert needles.containing_any(n, p.limit(0), "needle", ["doc_id"]).collect() == []


def test_blocks_hold_every_needle():
    texts = ["a" * n for n in (1, 5, 30, 2, 9)]
    blocks = needles.needle_blocks(texts, 10)
    assert [x for b in blocks for x in b] == list(enumerate(texts))
    assert all(len(b) == 1 or sum(len(t) for _, t in b) <= 10 for b in blocks)
