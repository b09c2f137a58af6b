"""Phrase counts and collocations against a plain version."""

import random
import re
from collections import Counter, defaultdict

import pytest

from seriesguard.llm import phrases
from test_llm import awkward, empty


def plain(docs, least=10, share=50, top=2000):
    """Result rows from the definition."""
    f = defaultdict(Counter)
    for lang, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(100 * b >= share * a for q, b in found.items() if len(q) > len(p) and any(
                    q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((10 ** 6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def result(found):
    return sorted(map(tuple, found.collect()))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["a", "A", "be", "Été", "x\0", "<unk>", "'s"] + [f"w{n}" for n in range(15)])
    gap = lambda: rng.choice([" "] * 9 + ["\t", "  ", ". ", ",", "\n", "\x0b", "\r\n", "!? ", "\xa0"])
    return [(rng.choice(["en", "en", "en", None, "und", ""]), "".join(word() + gap() for _ in range(rng.randint(0, 300))))
            for _ in range(60)] + [("en", None), (None, "")] + [("en", "hot word here. " * 500)]


@pytest.mark.parametrize("budget", [1 << 21, 2000, 100, 3])
def test_any_budget_gives_the_same(spark, docs, budget):
    """From one group for all to prefixes of three words everywhere."""
    table = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    assert result(phrases.collocations(table, budget=budget)) == plain(docs)


def test_limits(spark, docs):
    table = spark.createDataFrame(docs, "lang string, text string")
    assert result(phrases.collocations(table, least=3, share=90, top=7)) == plain(docs, 3, 90, 7)


def test_tasks_hand_on_early(spark, docs, monkeypatch):
    rows = spark.createDataFrame(docs, "lang string, text string").collect()
    schema = phrases.pa.schema([("lang", phrases.pa.string()), ("text", phrases.pa.string())])
    batch = phrases.pa.RecordBatch.from_pylist([{"lang": r.lang or "", "text": r.text or ""} for r in rows], schema=schema)
    whole = Counter()
    monkeypatch.setattr(phrases, "HELD", 400)
    parts = 0
    for lang, held in phrases._held(iter([batch.slice(i, 7) for i in range(0, len(rows), 7)])):
        codes, totals = held.merge()
        names, parts = list(held.numbers), parts + 1
        for c, n in zip(codes.tolist(), totals.tolist()):
            whole[lang, names[c >> 42], names[c >> 21 & 0x1FFFFF], names[c & 0x1FFFFF]] += n
    monkeypatch.setattr(phrases, "HELD", 1 << 22)
    once = Counter()
    for lang, held in phrases._held(iter([batch])):
        codes, totals = held.merge()
        names = list(held.numbers)
        for c, n in zip(codes.tolist(), totals.tolist()):
            once[lang, names[c >> 42], names[c >> 21 & 0x1FFFFF], names[c & 0x1FFFFF]] += n
    assert whole == once and parts > 8


def test_large_counts_stay_exact(spark, monkeypatch):
    """Products beyond 64 bits."""
    big = 3_000_000_001
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big + 7)], "lang string, word string, f long")
    nodes = spark.createDataFrame([("en", "a", "b", None, big - 5)], "lang string, w1 string, w2 string, w3 string, f long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *_, **__: (words, nodes))
    row = phrases.collocations(words).first()
    assert (row.score, row.n) == (10 ** 6 * (big - 5) ** 2 // (big * (big + 7)), 2 * big + 7)


def test_awkward(spark):
    table = awkward(spark)
    rows = [(r.lang, r.text) for r in table.collect()]
    assert result(phrases.collocations(table, least=2)) == plain(rows, 2)
    assert phrases.collocations(empty(spark)).count() == 0
