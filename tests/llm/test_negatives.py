"""Hard negatives against brute force in whole numbers."""

import math
import random

import numpy as np
import pytest

from seriesguard.llm import negatives, queries

TYPE = "vec_id long, embedding array<double>, label int"


def floor256(x):
    return math.floor(x * 256) if abs(x) < 2.0 ** 900 else int(x) * 256


def brute(rows, every=100, k=5):
    """Rows (id, vector, label) by definition; repeated ids are rows of their own."""
    kept = [(i, [floor256(x) for x in v], c) for i, v, c in rows
            if i is not None and c is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v, c) in enumerate(kept):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, d) for m, (j, w, d) in enumerate(kept) if m != n)
        for p, j, _ in [s for s in scored if s[2] == c][:k]:
            found = [(-s, q) for s, q, d in scored if d != c and 80 * -p <= 100 * -s <= 100 * -p][:k]
            out += [(i, j, r + 1, q, -p, s) for r, (s, q) in enumerate(found)]
    return sorted(out)


def clipped(rows):
    low, high = -(1 << 63), (1 << 63) - 1
    return sorted((*r[:4], *(max(low, min(high, s)) for s in r[4:])) for r in rows)


@pytest.mark.parametrize("scale", [1, 60, 10 ** 4, 2.0 ** 40, 1e200])
def test_products_are_exact(scale):
    rng = np.random.default_rng(3)
    a, b = (negatives.integers(rng.normal(size=(n, 7)) * scale) for n in (5, 45))
    want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b.tolist()] for u in a.tolist()]
    assert negatives.products(a, b).tolist() == want


def test_several_candidates_share_an_integer():
    rng = np.random.default_rng(1)
    rows = negatives.integers(rng.normal(size=(9, 64)) * 0.13)
    width = (64 * int(rows.max() - rows.min()) ** 2).bit_length()
    assert negatives.EXACT_BITS // width >= 2  # the given vectors' case


def test_query_equals_brute_force(spark):
    data = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(map(float, r.embedding)), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{data}/embeddings.parquet").collect() if r.label is not None]
    got = [tuple(r) for r in queries.op11_kronecker_negatives(spark, data).collect()]
    assert len(got) > 50 and sorted(got) == brute(rows)


def test_parts_and_blocks(spark):
    """Many small parts and blocks, few labels of which one holds most rows, ties, negative scores."""
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0, 2.0]) for _ in range(4)], 0 if rng.random() < 0.7 else rng.randint(1, 3))
            for i in range(400)]
    got = negatives.mine(spark.createDataFrame(rows, TYPE).repartition(5), every=10, part_rows=16, anchor_rows=8, cell_rows=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


@pytest.mark.parametrize("scale", [1.0, 3e6, 1e12, 1e250])
def test_outliers(spark, scale):
    rng = random.Random(2)
    rows = [(i, [rng.random() * (scale if i % 9 == 0 else 1) for _ in range(3)], i % 2) for i in range(120)]
    got = negatives.mine(spark.createDataFrame(rows, TYPE), every=6, part_rows=32, cell_rows=8)
    assert sorted(map(tuple, got.collect())) == clipped(brute(rows, 6))


def test_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.5], 1), (100, None, 1), (200, [], 1), (300, [nan, 1.0], 1), (400, [inf, 1.0], 1),
            (500, [None, 1.0], 1), (600, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (7, [1.0, 0.0, 0.0], 2), (8, [0.9, 0.0], 2),
            (8, [0.9, 0.0], 2), (9, [0.0, 0.0], 1), (700, [0.0, 0.0], 3)]
    got = sorted(map(tuple, negatives.mine(spark.createDataFrame(rows, TYPE)).collect()))
    assert got == brute([r for r in rows if r[1] is None or len(r[1]) == 2]) and got
    assert negatives.mine(spark.createDataFrame([], TYPE)).count() == 0
    named = spark.createDataFrame([(r[0], r[1], str(r[2]), "x") for r in rows if r[2]], "vec_id long, embedding array<double>, label string, part string")
    assert sorted(map(tuple, negatives.mine(named).collect())) == got
    only = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1)], TYPE)
    assert negatives.mine(only).count() == 0
