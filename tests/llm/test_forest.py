"""Near duplicates by the LSH forest against all pairs."""

import random

import numpy as np
import pytest

import plain
from seriesguard.llm import forest, queries
from test_llm import awkward, empty


def sets_of(text, words=2):
    found = plain.SPACE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1)))


def brute(rows, share=80):
    """(id, size, smallest id that links reach) of each row."""
    sets = [sets_of(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= share * (len(a) + len(sets[j]) - both):
                label[root(i)] = root(j)
    first = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            first[root(i)] = min(key, first.get(root(i), key))
    return sorted(((k, len(s), first.get(root(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def result(found):
    return sorted(map(tuple, found.collect()), key=str)


def edited(words, rng, share):
    return [rng.choice(words) + "x" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def crowd():
    """Near copies of a few texts with more and fewer edits, texts that share a passage, copies, other texts."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rng.choices(vocabulary, k=rng.randint(15, 90)) for _ in range(4)]
    rows = [" ".join(edited(base[n % 4], rng, rng.choice([0, 0.01, 0.03, 0.06]))) for n in range(300)]
    passage = rng.choices(vocabulary, k=40)
    rows += [" ".join(passage + rng.choices(vocabulary, k=30)) for _ in range(150)]
    rows += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(100)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("options", [{}, {"group_docs": 20}, {"group_docs": 5, "dense": 1 << 30}, {"dense": 64}])
def test_crowds(spark, crowd, options):
    """Groups in one task and in chunks, regions of base depth and deeper."""
    table = spark.createDataFrame(crowd, "doc_id long, text string").repartition(7)
    assert result(forest.near_duplicates(table, **options)) == brute(crowd)


def test_query(spark):
    data = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = result(queries.op13_lsh_forest(spark, data))
    assert got == sorted(((*r, r[0] == r[2]) for r in brute(rows)), key=str)


def test_threshold_is_exact(spark):
    """8 of 10 shingles shared links, 7 of 9 does not, 79 of 99 does not."""
    shared = [f"s{i}" for i in range(9)]
    rows = [(1, " ".join(["a", *shared])), (2, " ".join([*shared, "b"])),
            (3, " ".join(["c", *[f"t{i}" for i in range(8)]])), (4, " ".join([*[f"t{i}" for i in range(8)], "d"]))]
    got = result(forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows) and [r[2] for r in got] == [1, 1, 3, 4]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    b = np.r_[a[:16_000], np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))]
    one, two = forest.signatures([a, b])
    assert abs((one == two).mean() - 16 / 24) < 0.1
    assert (forest.signatures([a[:5], a, a[:9]])[1] == one).all()


def test_sets_find_all_links():
    rng = np.random.default_rng(2)
    for seed in range(20):
        base = rng.integers(0, 40, 30, dtype=np.uint64)
        sets = [np.unique(np.where(rng.random(30) < 0.12, rng.integers(0, 60, 30, dtype=np.uint64), base)) for _ in range(25)]
        group = forest.Sets(sets, 80)
        for i, a in enumerate(sets):
            want = [j for j, b in enumerate(sets) if j != i and 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))]
            assert group.linked(i).tolist() == want


def test_order_edges_across_partitions(spark, crowd):
    """Candidates do not depend on how the orders are cut."""
    table = spark.createDataFrame(crowd, "doc_id long, text string")
    rows = forest.sketches(table, key="doc_id", text="text", words=2).withColumnRenamed("key", "cid").where("n > 0")
    found = []
    for n in ("1", "23"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(tuple, forest.candidates(rows).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1]


def test_awkward(spark):
    table = awkward(spark)
    rows = [(r.doc_id, r.text) for r in table.collect()]
    assert result(forest.near_duplicates(table)) == brute(rows)
    assert forest.near_duplicates(empty(spark)).count() == 0
    ids = [(1, "one two three"), (1, "four five six"), (None, "one two three"), (None, None), (None, "seven"), (None, "seven"), (2, " ")]
    assert result(forest.near_duplicates(spark.createDataFrame(ids, "doc_id long, text string"))) == brute(ids)
    with pytest.raises(ValueError):
        forest.near_duplicates(table, share=70)
