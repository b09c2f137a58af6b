"""Phrase collocations by vertical partitioning of truncated suffixes.

Every word of a piece begins a suffix, cut after three words. Suffixes are partitioned vertically by variable-length word
prefixes: a word that begins more suffixes than the memory budget is extended to two-word prefixes, and these, where they
too are over it, to three words. Prefixes are then grouped so that the suffixes of a group stay within the budget, by exact counts
per bucket of their hash; a task handles the suffixes of one group at a time. It sorts them, which is the leaf order of the
suffix subtrees cut off at depth three, and reads every phrase's count from the leaf totals below its node.

Tasks sum equal suffixes before the exchange, which moves packed runs of them, not rows. What tasks are handed
is the hashes of the extended prefixes (at most occurrences / budget) and one number for each of at most 2 ** 20 buckets.

Defined results: null text is empty, null language ``und``; repeated rows count again; texts are taken whole; an empty table
gives an empty one. Words differ if their bytes do, after ASCII letters are lower-cased.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store, text_of

#: Suffixes of a group, and occurrences beyond which a prefix is extended.
BUDGET = 1 << 21
BUCKET_BITS = 20
#: Bits of a task's own word number; three make a suffix. Words and suffixes that a task holds before it hands them on.
WORD_BITS = 21
HELD = 1 << 22
SEED = 42  # of Spark's xxhash64
#: Fixed: what ends a piece, besides what lies between words.
BREAKS = b",;:!?\n\v\f\r"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + BREAKS, b"abcdefghijklmnopqrstuvwxyz" + b"." * len(BREAKS))
_MASK = np.int64((1 << WORD_BITS) - 1)


def words_of(texts: bytes) -> list[bytes]:
    """Words and, where a piece ends, dots."""
    return texts.translate(_TABLE).replace(b".", b" . ").split()


def _by_language(batch: pa.RecordBatch):
    """(language, texts as bytes joined by a break, in runs of some megabytes)."""
    langs = batch.column(0).dictionary_encode()
    texts = batch.column(1).cast(pa.large_binary())
    of = langs.indices.to_numpy()
    for n, lang in enumerate(langs.dictionary.to_pylist()):
        mine = texts.take(np.flatnonzero(of == n))
        ends = np.cumsum(pc.binary_length(mine).to_numpy())
        at = 0
        while at < len(mine):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 22), side="right")))
            yield lang, b" . ".join(mine.slice(at, stop - at).to_pylist())
            at = stop


class _Numbers(dict):
    """Numbers of words in the order met; the break is 0."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word):
        self[word] = n = len(self)
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _rows(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, f): how often each word of a language occurs."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])

    def run(batches):
        held: dict[str, tuple[_Numbers, np.ndarray]] = {}

        def out():
            for lang, (numbers, totals) in held.items():
                names = list(numbers)[1:]
                for at in range(0, len(names), 1 << 16):
                    part = names[at:at + (1 << 16)]
                    yield _rows([[lang] * len(part), pa.array(part, pa.binary()).cast(pa.string()),
                                 totals[at + 1:at + 1 + len(part)]], schema)
        for batch in batches:
            for lang, data in _by_language(batch):
                numbers, totals = held.get(lang) or (_Numbers(), np.zeros(1, np.int64))
                ids = numbers.of(words_of(data))
                new = np.bincount(ids, minlength=len(numbers))
                new[:len(totals)] += totals
                held[lang] = numbers, new
            if sum(len(n) for n, _ in held.values()) > HELD // 4:
                yield from out()
                held = {}
        yield from out()

    counted = rows.mapInArrow(run, "lang string, word string, f long")
    return counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))


class _Suffixes:
    """Suffixes of one language, summed; a task has one for each."""

    def __init__(self, lang: str):
        self.seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
        self.numbers, self.codes, self.totals = _Numbers(), [], []
        self.size = 0

    def add(self, data: bytes) -> None:
        ids = self.numbers.of(words_of(data))
        if len(ids) < 2:
            return
        second = np.r_[ids[1:], 0]
        third = np.where(second > 0, np.r_[ids[2:], 0, 0], 0)
        some = (ids > 0) & (second > 0)  # a suffix of one word is a word
        codes = (ids[some] << 2 * WORD_BITS) | (second[some] << WORD_BITS) | third[some]
        self.codes.append(codes)
        self.totals.append(np.ones(len(codes), np.int64))
        self.size += len(codes)

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        codes, totals = _summed(np.concatenate(self.codes or [np.empty(0, np.int64)]),
                                np.concatenate(self.totals or [np.empty(0, np.int64)]))
        self.codes, self.totals, self.size = [codes], [totals], len(codes)
        return codes, totals


def _held(batches):
    """The suffixes of each language of a task, handed out whenever enough different ones are held."""
    held: dict[str, _Suffixes] = {}
    for batch in batches:
        for lang, data in _by_language(batch):
            suffixes = held.setdefault(lang, _Suffixes(lang))
            suffixes.add(data)
            if sum(s.size for s in held.values()) > HELD:
                for s in held.values():
                    s.merge()
            if sum(s.size for s in held.values()) > HELD // 2 and suffixes.size == len(suffixes.codes[0]) \
                    or len(suffixes.numbers) > 1 << WORD_BITS - 1:
                yield from held.items()
                held = {}
    yield from held.items()


def _summed(codes: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and their totals."""
    order = np.argsort(codes, kind="stable")
    codes, totals = codes[order], totals[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(totals, first) if len(first) else totals


class Grouping:
    """Group of a prefix hash: buckets are its top bits; a bucket that alone is over the budget is split evenly."""

    def __init__(self, sums: dict[int, int], even: int, bits: int, budget: int):
        self.bits = bits
        self.first = np.zeros(1 << bits, np.int64)
        self.split = np.zeros(1 << bits, np.uint8)
        group, inside = 0, 0
        for b in range(1 << bits):
            size = sums.get(b, 0) + (even >> bits)
            more = max(0, math.ceil(math.log2(size / budget)) + 1) if size > budget else 0
            if more or inside + size > budget:
                group, inside = group + (inside > 0), 0
            self.first[b], self.split[b] = group, more
            inside += size
            if more:
                group, inside = group + (1 << more), 0
        self.hot = [np.empty(0, np.uint64)] * 2  # sorted hashes of extended prefixes of one and of two words

    def of(self, h: np.ndarray) -> np.ndarray:
        b = (h >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)
        rest = (h << np.uint64(self.bits)) >> np.uint64(32)
        return self.first[b] + (rest >> (np.uint64(32) - self.split[b].astype(np.uint64))).astype(np.int64)


def _hot(h: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(h), bool)
    at = np.searchsorted(hot, h)
    return hot[np.minimum(at, len(hot) - 1)] == h


def _hashes(seeds, names) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(n, s) for n, s in zip(names, seeds)], np.uint64)


def _pair_counts(rows: DataFrame, hot: np.ndarray) -> DataFrame:
    """(lang, w1, w2, f) of the pairs that begin with a word whose hash is in ``hot``."""
    schema = pa.schema([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("f", pa.int64())])

    def run(batches):
        for lang, s in _held(batches):
            codes, totals = s.merge()
            names = np.array(list(s.numbers), object)
            h = _hashes([s.seed] * len(names), names.tolist())
            codes, totals = _summed(codes >> WORD_BITS, totals)
            some = _hot(h, hot)[codes >> WORD_BITS]
            codes, totals = codes[some], totals[some]
            for at in range(0, len(codes), 1 << 16):
                part = codes[at:at + (1 << 16)]
                yield _rows([[lang] * len(part), *[pa.array(names[x], pa.binary()).cast(pa.string())
                                                   for x in (part >> WORD_BITS, part & _MASK)], totals[at:at + (1 << 16)]],
                            schema)

    found = rows.mapInArrow(run, "lang string, w1 string, w2 string, f long")
    return found.groupBy("lang", "w1", "w2").agg(F.sum("f").alias("f"))


def _packed_suffixes(rows: DataFrame, grouping: Grouping) -> DataFrame:
    """(grp, whole, lang, data): summed suffixes of a task for a group. ``whole``: pairs have all of their suffixes there."""
    schema = pa.schema([("grp", pa.int64()), ("whole", pa.bool_()), ("lang", pa.string()), ("data", pa.binary())])

    def run(batches):
        for lang, s in _held(batches):
            yield from _runs(lang, s, grouping, schema)

    return rows.mapInArrow(run, "grp long, whole boolean, lang string, data binary")


def _runs(lang: str, s: _Suffixes, grouping: Grouping, schema: pa.Schema):
    codes, totals = s.merge()
    if not len(codes):
        return
    names = list(s.numbers)
    h = _hashes([s.seed] * len(names), names)
    one = codes >> 2 * WORD_BITS
    key, whole = h[one], np.ones(len(codes), bool)
    for at in np.flatnonzero(_hot(key, grouping.hot[0])).tolist():  # extended prefixes
        code = int(codes[at])
        two = xxhash.xxh64_intdigest(names[code >> WORD_BITS & int(_MASK)], int(h[code >> 2 * WORD_BITS]))
        key[at] = two
    for at in np.flatnonzero(_hot(h[one], grouping.hot[0]) & _hot(key, grouping.hot[1])).tolist():
        key[at] = xxhash.xxh64_intdigest(names[int(codes[at] & _MASK)], int(key[at]))
        whole[at] = False
    group = grouping.of(key)
    order = np.lexsort((codes, whole, group))
    codes, totals, group, whole = codes[order], totals[order], group[order], whole[order]
    cuts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (whole[1:] != whole[:-1]), True])
    pack = zstandard.ZstdCompressor(level=1)
    rows = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        rows.append((int(group[a]), bool(whole[a]), lang, pack.compress(_laid(codes[a:b], totals[a:b], names))))
        if len(rows) == 256:
            yield _rows(list(zip(*rows)), schema)
            rows = []
    if rows:
        yield _rows(list(zip(*rows)), schema)


def _laid(codes: np.ndarray, totals: np.ndarray, names: list[bytes]) -> bytes:
    """Words used, then three word numbers and a total for each suffix."""
    ids = np.stack([codes >> 2 * WORD_BITS, codes >> WORD_BITS & _MASK, codes & _MASK])
    used = np.union1d(0, ids)
    words = b"\n".join(names[i] for i in used.tolist())
    small = np.searchsorted(used, ids).astype("<u4")
    return b"".join([len(words).to_bytes(8, "little"), words, small.tobytes(), totals.astype("<u8").tobytes()])


def _nodes(least: int):
    """Phrases of two and three words and their counts, from the summed suffixes of a group."""
    schema = pa.schema([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()), ("f", pa.int64())])

    def run(batches):
        group, parts = None, {}
        for batch in batches:
            for g, whole, lang, data in zip(*[c.to_pylist() for c in batch.columns]):
                if g != group:
                    for key, runs in parts.items():
                        yield from tree(*key, runs)
                    group, parts = g, {}
                parts.setdefault((lang, whole), []).append(data)
        for key, runs in parts.items():
            yield from tree(*key, runs)

    def tree(lang: str, whole: bool, runs: list[bytes]):
        numbers, codes, totals = _Numbers(), [], []
        unpack = zstandard.ZstdDecompressor()
        for run_ in runs:
            data = unpack.decompress(run_)
            n = int.from_bytes(data[:8], "little")
            own = numbers.of(data[8:8 + n].split(b"\n"))
            size = (len(data) - 8 - n) // 20
            ids = own[np.frombuffer(data, "<u4", 3 * size, 8 + n)].reshape(3, -1)
            codes.append(ids)
            totals.append(np.frombuffer(data, "<u8", size, 8 + n + 12 * size).astype(np.int64))
        names = np.array(list(numbers), object)
        ids, totals = np.concatenate(codes, axis=1), np.concatenate(totals)
        # sorted suffixes are the leaves of the subtrees; a node's count is the total of the leaves below it
        order = np.lexsort(ids[::-1])
        ids, totals = ids[:, order], totals[order]
        new = np.ones(ids.shape[1], bool)
        for depth in (2, 3):
            new[1:] = (ids[:depth, 1:] != ids[:depth, :-1]).any(axis=0)
            first = np.flatnonzero(new)
            count = np.add.reduceat(totals, first)
            some = count >= least
            if depth == 3:
                some &= ids[2, first] > 0
            elif not whole:
                continue
            first, count = first[some], count[some]
            for at in range(0, len(first), 1 << 16):
                here = first[at:at + (1 << 16)]
                text = [pa.array(names[ids[d, here]], pa.binary()).cast(pa.string()) for d in range(depth)]
                yield _rows([[lang] * len(here), *text, *[[None] * len(here)] * (3 - depth), count[at:at + (1 << 16)]], schema)
    return run


def _group(rows: DataFrame, words: DataFrame, budget: int) -> tuple[Grouping, DataFrame | None]:
    """How prefixes are grouped, and the stored counts of the pairs that begin with an extended word."""
    total = words.agg(F.sum("f")).first()[0] or 0
    bits = min(BUCKET_BITS, max(0, math.ceil(math.log2(max(1, 4 * total / budget)))))
    bucket = lambda *names: (F.shiftrightunsigned(F.xxhash64(*names), 64 - bits) if bits
                             else F.lit(0).cast("long"))
    hot, sums, pairs, even = [], {}, None, 0
    at = words.select(F.xxhash64("lang", "word").alias("h"), bucket("lang", "word").alias("bucket"), "f")
    for depth in (1, 2):
        hot.append(_sorted_hashes(at.where(F.col("f") > budget)))
        for r in at.where(F.col("f") <= budget).groupBy("bucket").agg(F.sum("f").alias("f")).collect():  # one for each bucket
            sums[r["bucket"]] = sums.get(r["bucket"], 0) + r["f"]
        if depth == 1:
            if not len(hot[0]):
                hot.append(np.empty(0, np.uint64))
                break
            pairs = store(_pair_counts(rows, hot[0]), "pairs")
            at = pairs.select(F.xxhash64("lang", "w1", "w2").alias("h"), bucket("lang", "w1", "w2").alias("bucket"), "f")
        else:  # three-word prefixes spread evenly
            even = at.where(F.col("f") > budget).agg(F.sum("f")).first()[0] or 0
    grouping = Grouping(sums, even, bits, budget)
    grouping.hot = hot
    return grouping, pairs


def _sorted_hashes(rows: DataFrame) -> np.ndarray:
    """Hashes of extended prefixes: at most occurrences / budget of them."""
    return np.sort(np.array([r["h"] for r in rows.select("h").collect()], np.int64).view(np.uint64))


def phrase_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 10,
                  budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(lang, word, f) of all words, and (lang, w1, w2, w3, f) of the phrases of two (w3 is null) and three words that
    occur ``least`` times or more. Both are stored."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_of(docs, text).alias("text"))
    words = store(word_counts(rows), "words")
    grouping, pairs = _group(rows, words, budget)
    moved = _packed_suffixes(rows, grouping).repartition("grp").sortWithinPartitions("grp")
    nodes = moved.mapInArrow(_nodes(least), "lang string, w1 string, w2 string, w3 string, f long")
    if len(grouping.hot[1]):  # pairs whose suffixes lie in several groups
        split = pairs.where(F.col("f") > budget).select("lang", "w1", "w2", F.lit(None).cast("string").alias("w3"), "f")
        nodes = nodes.unionByName(split.where(F.col("f") >= least))
    return words, store(nodes, "phrases")


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 10, share: int = 50,
                 top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase's score is that of its weakest cut into two parts, floor(10^6 a^2 / (l r)); a phrase inside a longer one with
    at least ``share`` per cent of its count is left out.
    """
    words, nodes = phrase_counts(docs, text=text, lang=lang, least=least, budget=budget)
    wide = "decimal(38,0)"
    found = nodes.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"), "w1", "w2", "w3")
    counts = words.where(F.col("f") >= least).select("lang", F.col("word").alias("part"), "f").unionByName(
        nodes.where("w3 is null").select("lang", F.concat_ws(" ", "w1", "w2").alias("part"), "f"))
    joined = lambda *names: F.concat_ws(" ", *names)
    cut = lambda k, side, part: F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), part.alias("part"))
    two = [cut(1, "l", F.col("w1")), cut(1, "r", F.col("w2"))]
    three = [cut(1, "l", F.col("w1")), cut(1, "r", joined("w2", "w3")), cut(2, "l", joined("w1", "w2")), cut(2, "r", F.col("w3"))]
    parts = found.select("lang", "phrase", "a", F.explode(F.when(F.col("w3").isNull(), F.array(*two)).otherwise(
        F.array(*three))).alias("c")).select("lang", "phrase", "a", "c.*")
    of = lambda side, k: F.max(F.when((F.col("side") == side) & (F.col("k") == k), F.col("f")))
    both = parts.join(counts, ["lang", "part"]).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), *[of(s, k).alias(f"{s}{k}") for k in (1, 2) for s in "lr"])
    score = lambda k: F.expr(f"cast(1000000 AS {wide}) * a * a div (cast(l{k} AS {wide}) * r{k})")
    both = both.withColumn("s1", score(1)).withColumn("s2", score(2))
    first = F.col("l2").isNull() | (F.col("s1") <= F.col("s2"))
    scored = both.select("lang", "phrase", "a", *[F.when(first, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(c) for c in "lr"],
                         F.when(first, F.col("s1")).otherwise(F.col("s2")).alias("score"))
    held = found.where("w3 is not null").select("lang", F.explode(F.array(joined("w1", "w2"), joined("w2", "w3"))).alias(
        "phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(held, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
