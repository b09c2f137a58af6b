"""SimHash near-dedup by anchor-point covering.

A fingerprint has 64 bits; two are linked at three or fewer differing bits, so in one of its halves at most one bit
differs. The anchors of a half are the codewords of the perfect Hamming code of length 31 times its last bit: every
half lies within covering radius 1 of one anchor. Each fingerprint is copied to every anchor within covering radius plus
threshold (2) of each half, and fingerprints are compared per anchor. Equal fingerprints are one before that.

What meets at an anchor is not emitted as pairs but as a spanning forest of its links; anchors with more than
``GROUP_ROWS`` fingerprints are dealt out as pairs of chunks, so no task holds more than two chunks and no link is lost.

Defined results: null and empty texts have no words and fingerprint 0, linked like any other; null ids take part but name
no component unless all of its ids are null; repeated rows are separate rows; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, packed, store, unpacked
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints of one anchor that are compared at once.
GROUP_ROWS = 1 << 16
#: In groups up to this size every pair is compared by shifts of the whole batch.
SMALL = 24

_TAIL = np.uint64((1 << 32) - 1)
_MASKS = np.array([sum(1 << i for i in range(31) if (i + 1) >> j & 1) for j in range(5)], np.uint64)
#: Error patterns of weight 1 and 2 for each syndrome: 1 + 15 where it is not zero.
_ERRORS = np.array([[0] * 16] + [[1 << (s - 1)] + [1 << (i - 1) | 1 << ((i ^ s) - 1) for i in range(1, 32)
                                                  if i < i ^ s] for s in range(1, 32)], np.uint64)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles, ASCII letters lower-cased, as a signed 64-bit number."""
    found = text.encode().lower().split() if text else []
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return _signed(xxhash.xxh64_intdigest(joined, SEED))
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[:len(found) - words + 1].tolist()
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    ends = ends[words - 1:].tolist()
    for at in range(0, n, 1 << 15):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + (1 << 15)], ends[at:at + (1 << 15)])],
                     dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return _signed(int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(key, fp) of every row."""
    return map_texts(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")),
                     lambda texts: [[fingerprint(t, words) for t in texts]], "fp long")


def _anchors(batches):
    """Copies of fingerprints: (anchor, fp). An anchor is the half's number, its last bit and the codeword."""
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for half in (0, 1):
            v = (fp >> np.uint64(32 * half)) & _TAIL
            code, last = v & np.uint64((1 << 31) - 1), v >> np.uint64(31)
            syndrome = sum((np.bitwise_count(code & m).astype(np.int64) & 1) << j for j, m in enumerate(_MASKS))
            errors = _ERRORS[syndrome]
            top = np.uint64(half << 32)
            near = top | (last << np.uint64(31))[:, None] | (code[:, None] ^ errors)  # last bit as it is
            far = top | ((last ^ np.uint64(1)) << np.uint64(31)) | (code ^ errors[:, 0])  # last bit differs
            wanted = np.ones(near.shape, bool)
            wanted[syndrome == 0, 1:] = False  # a codeword: no other within radius 2
            rows = np.repeat(np.arange(len(fp)), wanted.sum(axis=1))
            anchors = np.concatenate([near[wanted], far]).view(np.int64)
            fps = np.concatenate([fp[rows], fp]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(fps)], names=["anchor", "fp"])


def _forest(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among distinct fingerprints: each newly reached one with the one it was reached from."""
    rest, a, b = fp, [], []
    stack: list[np.uint64] = []
    while len(rest) or stack:
        if not stack:
            stack.append(rest[0])
            rest = rest[1:]
        at = stack.pop()
        near = np.bitwise_count(rest ^ at) <= bits
        if near.any():
            new = rest[near]
            a.append(np.full(len(new), at, np.uint64))
            b.append(new)
            stack.extend(new)
            rest = rest[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _compare(groups: np.ndarray, fp: np.ndarray, bits: int):
    """Links of complete groups that stand one after the other."""
    starts = np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]).any(axis=1)])
    sizes = np.diff(np.r_[starts, len(fp)])
    a, b = [], []
    small = np.repeat(sizes <= SMALL, sizes)
    last = np.repeat(starts + sizes, sizes)
    at = np.arange(len(fp))
    for shift in range(1, SMALL):
        i = at[small & (at + shift < last)]
        if not len(i):
            break
        i = i[np.bitwise_count(fp[i] ^ fp[i + shift]) <= bits]
        a.append(fp[i])
        b.append(fp[i + shift])
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        x, y = _forest(fp[start:start + size], bits)
        a.append(x)
        b.append(y)
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _links(bits: int):
    def run(batches):
        kept_groups, kept_fp = np.empty((0, 2), np.int64), np.empty(0, np.uint64)

        def out(groups, fp):
            a, b = _compare(groups, fp, bits)
            a, b = np.minimum(a, b).view(np.int64), np.maximum(a, b).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            groups = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
            kept_groups = np.concatenate([kept_groups, groups])
            kept_fp = np.concatenate([kept_fp, batch.column(2).to_numpy().view(np.uint64)])
            other = np.flatnonzero((kept_groups != kept_groups[-1]).any(axis=1))
            if len(other):  # the last group may go on in the next batch
                end = int(other[-1]) + 1
                yield out(kept_groups[:end], kept_fp[:end])
                kept_groups, kept_fp = kept_groups[end:], kept_fp[end:]
        if len(kept_fp):
            yield out(kept_groups, kept_fp)
    return run


def links(distinct: DataFrame, *, bits: int = MAX_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b) of distinct fingerprints ``fp`` that connect all that are linked; no link between components."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"halves differ in at most one bit only up to {MAX_BITS} bits")
    copies = distinct.select("fp").mapInArrow(_anchors, "anchor long, fp long")
    hot = store(copies.groupBy("anchor").count().where(F.col("count") > group_rows).select(
        "anchor", F.ceil(F.col("count") / group_rows).cast("int").alias("chunks")), "hot")
    if hot.isEmpty():
        copies = copies.withColumn("chunk", F.lit(0).cast("long"))
    else:  # chunk c meets every chunk: pair (smaller, larger)
        mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("long")
        copies = copies.join(hot, "anchor", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))) \
            .withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))) \
            .withColumn("chunk", F.least("mine", "other") * F.col("chunks") + F.greatest("mine", "other"))
    groups = copies.select("anchor", "chunk", "fp").repartition("anchor", "chunk") \
        .sortWithinPartitions("anchor", "chunk", "fp")
    return groups.mapInArrow(_links(bits), "a long, b long").distinct()


def _grouped(docs: DataFrame, *, key: str, text: str, words: int, bits: int) -> DataFrame:
    """(key, fp, root, component) of every row; the root is a fingerprint that names the group."""
    prints = store(fingerprints(docs, key=key, text=text, words=words), "fingerprints")
    classes = store(prints.groupBy("fp").agg(F.min("key").alias("first")), "classes")
    roots = components(links(classes, bits=bits))  # node, root
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left") \
        .select("fp", F.coalesce("root", "fp").alias("root"), "first")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(firsts, "root").select("fp", "root", "component")
    return prints.join(named, "fp").select("key", "fp", "root", "component")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    bits: int = MAX_BITS) -> DataFrame:
    """(key, fp, component) of every row; the component is the smallest key that links reach, itself included."""
    return _grouped(docs, key=key, text=text, words=words, bits=bits).select("key", "fp", "component")


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
             bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest key (rows with null keys stay).

    A key may stand on several rows, also of several groups: each group keeps one row, of repeated rows any.
    """
    found = _grouped(docs, key=key, text=text, words=words, bits=bits).where("key is not null")
    # rows of a group's smallest key: one fingerprint of each group and key
    firsts = found.where("key = component").groupBy("root", "key").agg(F.min("fp").alias("fp"))
    rows = packed(docs).withColumn("key", F.col("row").getField(key))
    twice = found.groupBy("key").count().where("count > 1").select("key")
    if twice.isEmpty():
        one = rows.join(firsts.select("key").hint("shuffle_hash"), "key", "left_semi")
    else:  # a repeated key does not tell its rows apart, their fingerprints do
        text_ = F.col("row").getField(text).cast("string")
        marked = map_texts(rows.where("key is not null").select("row", "key", text_.alias("text")),
                           lambda texts: [[fingerprint(t, words) for t in texts]], "fp long")
        one = marked.join(firsts.select("key", "fp").hint("shuffle_hash"), ["key", "fp"], "left_semi")
        alone = one.join(twice, "key", "left_anti").select("row", "key")
        one = alone.unionByName(one.join(twice, "key", "left_semi").dropDuplicates(["key", "fp"]).select("row", "key"))
    return unpacked(one.unionByName(rows.where("key is null")), docs.columns, {})


def hex_digits(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

