"""MinHash near-dedup by an LSH forest.

A document's set is its distinct word shingles. ``ORDERS`` sorted orders of MinHash signatures make the forest: each order
sorts the documents by its own run of hash values, Spark range-partitions and sorts them, and neighbours in an order that share
a prefix are candidates. Neighbours need ``BASE`` equal values in sparse regions; in a region (the documents below one
prefix of that length) with more than ``DENSE`` documents one more for each doubling, so loose boilerplate falls
apart where it is crowded.

Candidates are joined to candidate groups, whose full sets meet once, and links are confirmed there on full sets:
for a document all others of its group with a rarest-first shingle in common are compared, so a group finds also the links
that no order showed. Documents linked to a pivot of the group need not be compared with each other, as they are connected.
Groups too large for a task are compared with their pivot in chunks, and what is not linked to it meets all chunks.

A pair with Jaccard similarity 0.8 shares a prefix in none of 48 orders with a chance of 5e-7; for more similar pairs it is
smaller. Documents with equal sets are one before that. Shingles are 64-bit hashes, sets are addressed by 128 bits.

Defined results: null and empty texts and texts without words have the empty set and are linked with nothing; null ids take
part but name no component unless all of its ids are null; repeated rows are separate rows; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesguard.frame import cogrouped

from .common import runs, store
from .components import components

SHINGLE_WORDS = 2
SHARE = 80
ORDERS = 48
BASE = 6
DEEPEST = 12
DENSE = 1 << 14
#: Documents, and shingles of all of them, that are compared in one task.
GROUP_DOCS = 1 << 13
GROUP_SHINGLES = 1 << 22
#: Documents that are tried as pivot.
PIVOTS = 4
#: Words whose hashes a task remembers, and shingles that are hashed for signatures at once.
KEPT_WORDS = 500_000
BLOCK = 1 << 13

_VALUES = ORDERS * BASE
_draw = np.random.default_rng(13)
_FACTORS = (_draw.integers(0, 1 << 31, _VALUES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_SHIFTS = _draw.integers(0, 1 << 32, _VALUES, dtype=np.uint32)
#: Hash values of each order; the deeper ones are the next order's.
_PICK = (np.arange(ORDERS)[:, None] * BASE + np.arange(DEEPEST)[None, :]) % _VALUES


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two, in order."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, words: int, known: _Words) -> np.ndarray:
    """Sorted distinct hashes of the word shingles, ASCII letters lower-cased."""
    found = text.encode().lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - words + 1)
    x = h[:n]
    for i in range(1, min(words, len(h))):
        x = _mixed(x, h[i:i + n])
    # a short sequence is no shingle of full length
    return np.unique(x if len(h) >= words else _mixed(x, np.full(len(x), len(h), np.uint64)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (16 bits each) of non-empty sets, one row for each."""
    out = np.empty((len(sets), _VALUES), "<u2")
    at = 0
    while at < len(sets):
        stop, size = at, 0
        while stop < len(sets) and (stop == at or size + len(sets[stop]) <= BLOCK):
            size += len(sets[stop])
            stop += 1
        part = np.concatenate(sets[at:stop])
        part = (part ^ (part >> np.uint64(32))).astype(np.uint32)
        starts = np.cumsum([0, *map(len, sets[at:stop - 1])])
        least = np.full((_VALUES, stop - at), np.uint32((1 << 32) - 1))
        for first in range(0, size, BLOCK) if stop == at + 1 else (0,):  # a long set in pieces
            piece = part[first:first + BLOCK] if stop == at + 1 else part
            hashed = _FACTORS[:, None] * piece + _SHIFTS[:, None]
            least = np.minimum(least, np.minimum.reduceat(hashed, starts, axis=1))
        out[at:stop] = least.T.astype(np.uint16)
        at = stop
    return out


def _digest(values: np.ndarray) -> tuple[int, int]:
    return np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), "<i8").tolist()


def _batch(names: list[str], arrays: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(arrays, names=names)


def sketches(docs: DataFrame, *, key: str, text: str, words: int) -> DataFrame:
    """(key, n, d1, d2, sig) of every row: size and address of its set, signature; the last three null for the empty set."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        known = _Words()
        for batch in batches:
            for first, last, texts in runs(batch.column(1)):
                sets = [shingle_set(t, words, known) for t in texts]
                if len(known) > KEPT_WORDS:
                    known = _Words()
                some = [s for s in sets if len(s)]
                sig = iter(signatures(some)) if some else iter(())
                made = [(*_digest(s), next(sig).tobytes()) if len(s) else (None, None, None) for s in sets]
                yield _batch(["key", "n", "d1", "d2", "sig"], [
                    batch.column(0).slice(first, last - first), pa.array([len(s) for s in sets], pa.int64()),
                    *[pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]])

    return rows.mapInArrow(run, f"key {kind}, n long, d1 long, d2 long, sig binary")


# ---------------------------------------------------------------- the forest

def _orders(batches):
    """Each document once for each order: (ord, k1, k2, k3, cid), four hash values in each k."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cid = batch.column(0)
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, _VALUES)
        for t in range(ORDERS):
            values = sig[:, _PICK[t]].astype(np.int64)
            k = [(values[:, 4 * i] << 48) | (values[:, 4 * i + 1] << 32) | (values[:, 4 * i + 2] << 16) | values[:, 4 * i + 3]
                 for i in range(3)]
            yield _batch(["ord", "k1", "k2", "k3", "cid"], [pa.array(np.full(len(sig), t, np.int32)), *map(pa.array, k), cid])


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefix, in hash values, of rows of (k1, k2, k3)."""
    x = (a ^ b).view(np.uint64)
    out = np.zeros(len(x), np.int64)
    open_ = np.ones(len(x), bool)
    for level in range(DEEPEST):
        open_ &= (x[:, level // 4] >> np.uint64(48 - 16 * (level % 4))) & np.uint64(0xFFFF) == 0
        out += open_
    return out


_EDGE = "ord int, p1 long, p2 long, shared int, a long, b long"


def _neighbours(batches):
    """Candidate neighbours of a sorted partition; its first and last document come as rows of their own (shared < 0)."""
    from pyspark import TaskContext

    pid, last = TaskContext.get().partitionId(), None
    names = ["ord", "p1", "p2", "shared", "a", "b", "part", "k3"]

    def end(row, mark):
        order, k, cid = row
        return _batch(names, [pa.array([v], t) for v, t in zip((order, k[0], k[1], mark, cid, cid, pid, k[2]), (
            pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))])

    for batch in batches:
        if not batch.num_rows:
            continue
        order, cid = batch.column(0).to_numpy(), batch.column(4).to_numpy()
        k = np.stack([batch.column(i).to_numpy() for i in (1, 2, 3)], axis=1)
        if last is None:
            yield end((order[0], k[0], cid[0]), -1)
        else:
            order, cid, k = np.r_[last[0], order], np.r_[last[2], cid], np.concatenate([last[1][None], k])
        shared = _shared(k[:-1], k[1:])
        at = np.flatnonzero((shared >= BASE) & (order[1:] == order[:-1]))
        yield _batch(names, [
            pa.array(order[at].astype(np.int32)), pa.array(k[at, 0]), pa.array(k[at, 1] >> 32), pa.array(shared[at].astype(np.int32)),
            pa.array(cid[at]), pa.array(cid[at + 1]), pa.array(np.full(len(at), pid, np.int32)), pa.array(k[at, 2])])
        last = order[-1], k[-1], cid[-1]
    if last is not None:
        yield end(last, -2)


def _across(ends: pd.DataFrame) -> pd.DataFrame:
    """Candidates that lie on both sides of a partition's edge; two rows for each partition."""
    ends = ends.sort_values(["part", "shared"], ascending=[True, False])  # first, then last
    out = []
    for before, after in zip(ends[1:-1:2].itertuples(), ends[2::2].itertuples()):
        a, b = (np.array([[r.p1, r.p2, r.k3]], np.int64) for r in (before, after))
        n = int(_shared(a, b)[0])
        if before.ord == after.ord and n >= BASE:
            out.append((before.ord, before.p1, before.p2 >> 32, n, before.a, after.a))
    return pd.DataFrame(out, columns=["ord", "p1", "p2", "shared", "a", "b"])


def candidates(classes: DataFrame, *, dense: int = DENSE) -> DataFrame:
    """(a, b): pairs of ``cid`` that stand next to each other in an order and share as long a prefix as their region asks."""
    ordered = classes.select("cid", "sig").mapInArrow(_orders, "ord int, k1 long, k2 long, k3 long, cid long")
    ordered = ordered.repartitionByRange("ord", "k1", "k2", "k3").sortWithinPartitions("ord", "k1", "k2", "k3", "cid")
    found = store(ordered.mapInArrow(_neighbours, f"{_EDGE}, part int, k3 long"), "neighbours")
    ends = found.where("shared < 0").groupBy().applyInPandas(_across, _EDGE)  # two rows for each partition
    pairs = found.where("shared >= 0").drop("part", "k3").unionByName(ends)
    crowd = pairs.groupBy("ord", "p1", "p2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= dense).select(
        "ord", "p1", "p2", F.least(F.lit(DEEPEST), BASE + F.ceil(F.log2(F.col("n") / dense)).cast("int") + 1).alias("asked"))
    return pairs.join(crowd, ["ord", "p1", "p2"], "left").where(
        F.col("shared") >= F.coalesce("asked", F.lit(BASE))).select("a", "b").distinct()


# ---------------------------------------------------------------- confirmation on full sets

class Sets:
    """Full sets that are compared with each other. Shingles are numbered, the rarest in the group first."""

    def __init__(self, sets: list[np.ndarray], share: int):
        self.share, self.sizes = share, np.array([len(s) for s in sets], np.int64)
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        _, of, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(counts), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
        doc = np.repeat(np.arange(len(sets)), self.sizes)
        tokens = rank[of]
        self.tokens = tokens[np.lexsort((tokens, doc))]
        self.marks = np.zeros(len(counts), bool)
        # sets that are similar enough share a shingle among the first ones of both
        self.heads = self.sizes - -(-share * self.sizes // 100) + 1
        place = np.arange(len(self.tokens)) - np.repeat(self.starts[:-1], self.sizes)
        head = place < np.repeat(self.heads, self.sizes)
        order = np.argsort(self.tokens[head], kind="stable")
        self.holders = doc[head][order]
        self.first = np.searchsorted(self.tokens[head][order], np.arange(len(counts) + 1))

    def linked(self, i: int) -> np.ndarray:
        """All other sets that ``i`` is linked with."""
        own = self.tokens[self.starts[i]:self.starts[i + 1]]
        near = [self.holders[self.first[t]:self.first[t + 1]] for t in own[:self.heads[i]].tolist()]
        near = np.unique(np.concatenate(near))
        n, m = self.sizes[near], self.sizes[i]
        near = near[(near != i) & (100 * np.minimum(n, m) >= self.share * np.maximum(n, m))]
        if not len(near):
            return near
        n = self.sizes[near]
        ends = np.cumsum(n)
        places = np.arange(int(ends[-1])) + np.repeat(self.starts[near] - ends + n, n)
        self.marks[own] = True
        both = np.add.reduceat(self.marks[self.tokens[places]].astype(np.int64), ends - n)
        self.marks[own] = False
        return near[100 * both >= self.share * (n + m - both)]

    def forest(self, asked: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Links that connect all linked sets, each with an asked one; by default all sets are asked."""
        count, out = len(self.sizes), []
        label = np.arange(count)
        if asked is None:  # what is linked to the pivot need not be asked
            tried = [(i, self.linked(i)) for i in np.unique(np.linspace(0, count - 1, PIVOTS).astype(int)).tolist()]
            pivot, star = max(tried, key=lambda t: (len(t[1]), -t[0]))
            out = [(pivot, j) for j in star.tolist()]
            label[star] = pivot
            asked = label != pivot
        for i in np.flatnonzero(asked).tolist():
            near = self.linked(i)
            for j in near[np.unique(label[near], return_index=True)[1]].tolist() if len(near) else ():
                if label[j] != label[i]:
                    out.append((i, j))
                    label[label == label[j]] = label[i]
        return out


def _full_sets(docs: DataFrame, wanted: DataFrame, *, key: str, text: str, words: int, repeated: bool) -> DataFrame:
    """(root, cid, n, items) of the wanted documents (key, d1, d2, root, cid): their sets, read from their texts again."""
    rows = docs.select(F.col(key).alias("own"), F.col(text).cast("string").alias("text"))
    # by shuffle at every size: the number of copies is not known to be small
    both = rows.join(wanted.hint("shuffle_hash"), F.col("own").eqNullSafe(F.col("key"))).select("root", "cid", "d1", "d2", "text")

    def run(batches):
        known = _Words()
        for batch in batches:
            for first, last, texts in runs(batch.column(4)):
                sets = [shingle_set(t, words, known) for t in texts]
                d1, d2 = (batch.column(i).slice(first, last - first).to_numpy() for i in (2, 3))
                # ids may be repeated: only the text that the address is of
                same = np.array([tuple(_digest(s)) == (a, b) for s, a, b in zip(sets, d1.tolist(), d2.tolist())], bool)
                if len(known) > KEPT_WORDS:
                    known = _Words()
                at = np.flatnonzero(same)
                root, cid = (batch.column(i).slice(first, last - first).to_numpy()[at] for i in (0, 1))
                yield _batch(["root", "cid", "n", "items"], [
                    pa.array(root), pa.array(cid), pa.array([len(sets[i]) for i in at], pa.int64()),
                    pa.array([sets[i].tobytes() for i in at], pa.binary())])

    found = both.mapInArrow(run, "root long, cid long, n long, items binary")
    return found.dropDuplicates(["cid"]) if repeated else found


def _opened(items) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u8") for x in items]


def _edges(cid: np.ndarray, links: list[tuple[int, int]]) -> pd.DataFrame:
    at = np.array(links, np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": cid[at[:, 0]], "b": cid[at[:, 1]]})


def _whole_groups(share: int):
    """Links of groups that stand one after the other; a group may go on in the next batch."""
    def run(batches):
        held: list[tuple[int, int, bytes]] = []

        def links(rows):
            cid = np.array([r[1] for r in rows], np.int64)
            return _edges(cid, Sets(_opened([r[2] for r in rows]), share).forest()) if len(rows) > 1 else None

        for batch in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and held[0][0] != row[0]:
                    out.append(links(held))
                    held = []
                held.append(row)
            if any(o is not None for o in out):
                yield pa.RecordBatch.from_pandas(pd.concat(out), preserve_index=False)
        if len(held) > 1:
            yield pa.RecordBatch.from_pandas(links(held), preserve_index=False)
    return run


def confirmed(full: DataFrame, share: int, *, group_docs: int = GROUP_DOCS,
              group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """(a, b): links, confirmed on full sets, that connect all linked documents of each candidate group ``root``."""
    full = store(full, "sets")
    sizes = store(full.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / group_docs), F.ceil(
        F.sum("n") / group_shingles)).cast("int").alias("chunks"), F.min_by("cid", F.xxhash64("cid")).alias("pivot")), "sizes")
    small = full.join(sizes.where("chunks = 1").select("root"), "root")

    found = small.select("root", "cid", "items").repartition("root").sortWithinPartitions("root", "cid") \
        .mapInArrow(_whole_groups(share), "a long, b long")
    large = sizes.where("chunks > 1")
    if large.isEmpty():
        return found
    big = full.join(large, "root").withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    pivots = big.where("cid = pivot").select("root", F.col("cid").alias("pid"), F.col("items").alias("own"), F.explode(
        F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))

    def near_pivot(rows: pd.DataFrame, pivot: pd.DataFrame) -> pd.DataFrame:
        own = _opened(pivot["own"])[0]
        n = rows["n"].to_numpy()
        both = np.array([np.isin(s, own, assume_unique=True, kind="sort").sum() for s in _opened(rows["items"])], np.int64)
        return pd.DataFrame({"root": rows.root, "cid": rows.cid, "pid": pivot.pid.iloc[0],
                             "near": 100 * both >= share * (n + len(own) - both)})

    told = store(cogrouped(big.select("root", "chunk", "cid", "n", "items"), pivots, ["root", "chunk"], near_pivot,
                           "root long, cid long, pid long, near boolean"), "pivots")
    star = told.where("near and cid <> pid").select(F.col("pid").alias("a"), F.col("cid").alias("b"))
    alone = big.join(told.where("not near").select("cid"), "cid")
    counts = alone.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / group_docs), F.ceil(
        F.sum("n") / group_shingles)).cast("int").alias("parts"))
    asked = alone.join(counts, "root").select("root", "cid", "items", F.pmod(F.xxhash64("cid", F.lit(1)), F.col("parts")).cast(
        "int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    others = big.join(counts, "root").select("root", "cid", "items", "chunk", F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right[~right.cid.isin(left.cid)]
        cid = np.r_[left.cid.to_numpy(), right.cid.to_numpy()]
        mine = np.arange(len(cid)) < len(left)
        if not mine.any():
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        return _edges(cid, Sets(_opened([*left["items"], *right["items"]]), share).forest(mine))

    met = cogrouped(asked, others, ["root", "part", "chunk"], meet, "a long, b long")
    return found.unionByName(star).unionByName(met)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    share: int = SHARE, dense: int = DENSE, group_docs: int = GROUP_DOCS) -> DataFrame:
    """(key, n, component) of every row: set size and smallest key that links reach, itself included.

    Sets are linked if 100 * intersection >= share * union, for a share of at least 80.
    """
    if share < 80:
        raise ValueError("the forest has too few orders for a share below 80")
    rows = store(sketches(docs, key=key, text=text, words=words), "sketches")
    classes = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("key").alias("key"), F.first("sig").alias("sig"))
    classes = store(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    groups = components(candidates(classes, dense=dense))  # node, root
    wanted = store(classes.drop("sig").join(groups, F.col("cid") == F.col("node")).select("key", "d1", "d2", "root", "cid"),
                   "wanted")
    repeated = not rows.where("n > 0").groupBy("key", "d1", "d2").count().where("count > 1").isEmpty()
    full = _full_sets(docs, wanted, key=key, text=text, words=words, repeated=repeated)
    linked = components(confirmed(full, share, group_docs=group_docs))
    rooted = classes.drop("sig").join(linked, F.col("cid") == F.col("node"), "left") \
        .select("d1", "d2", "key", F.coalesce("root", "cid").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("key").alias("component"))
    named = rooted.join(firsts, "root").select("d1", "d2", "component")
    return rows.select("key", "n", "d1", "d2").join(named, ["d1", "d2"], "left").select(
        "key", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key")).alias("component"))
