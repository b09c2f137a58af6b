"""Hard negatives by Kronecker-packed products.

Components become integers floor(scale * x). To multiply an anchor with several candidates at once, candidates' components
are biased to be non-negative and laid into separated bit fields of one wide integer, wide enough that a sum over all
components never reaches the next field. One product of an anchor's component with that integer then serves every field,
and the exact inner products are unpacked from the sum. The wide integers are whole numbers in doubles (53 bits, so that
the sums are matrix products) where a field fits, and unbounded integers elsewhere; biases and widths are those of the
blocks that meet, so an outlier costs only its own block.

Anchors are a query set that meets all rows, in blocks: rows sorted by label make parts of bounded size, and each part
meets each block of anchors in one group that returns the best few rows of every anchor. A first pass visits only parts
that hold an anchor's label and finds its positives; the second visits the others and finds, for each positive, the
best rows of other labels within the score band.

Defined results: rows with a null id, label or vector, with null or non-finite components, or with another number of
components than most take no part; repeated ids are rows of their own (an anchor is not its own positive, another row
with its id may be); ties by smaller id, then by vector; an anchor without positives, or a positive without negatives,
gives no row; scores beyond 64 bits are ranked exactly and shown as the nearest long; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesguard.frame import cogrouped

from .common import store

SCALE = 256
#: Bits of a wide integer that doubles hold exactly, and fields of one that is not held so.
EXACT_BITS = 53
WIDE_FIELDS = 16
#: Rows of a cell, of a part and anchors of a block; a group holds one part and one block.
CELL_ROWS = 1 << 10
PART_ROWS = 1 << 14
ANCHOR_ROWS = 1 << 12
#: Scores that are held at once.
SCORES = 1 << 22
LONG = (1 << 63) - 1


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) exactly: whole doubles where these are exact, else Python integers."""
    if not x.size or np.abs(x).max() < 2.0 ** 44:
        return np.floor(x * SCALE)
    whole = [math.floor(v * SCALE) if abs(v) < 2.0 ** 900 else int(v) * SCALE for v in x.ravel().tolist()]
    return np.array(whole, object).reshape(x.shape)


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products (anchors x rows) of whole numbers: one product for each anchor component and wide integer."""
    if not len(anchors) or not len(rows):
        return np.zeros((len(anchors), len(rows)), np.int64)
    dim = rows.shape[1]
    a_bias, r_bias = max(0, -int(anchors.min())), max(0, -int(rows.min()))
    width = max(1, (dim * (int(anchors.max()) + a_bias) * (int(rows.max()) + r_bias)).bit_length())
    fields = EXACT_BITS // width
    exact = fields > 0
    fields = fields or WIDE_FIELDS
    kind = np.float64 if exact else object
    a, r = anchors.astype(kind), rows.astype(kind)
    if not exact:  # doubles that hold whole numbers become integers
        a, r = (np.frompyfunc(int, 1, 1)(m) for m in (a, r))
    groups = -(-len(r) // fields)
    biased = np.zeros((groups * fields, dim), kind)
    biased[:len(r)] = r + r_bias
    biased = biased.reshape(groups, fields, dim)
    packed = sum((biased[:, f] * kind(1 << width * f) if exact else biased[:, f] * (1 << width * f) for f in range(fields)))
    wide = (a + a_bias) @ packed.T  # the sum of every field stays below 2 ** width
    wide = wide.astype(np.int64) if exact else wide
    out = np.empty((len(a), groups, fields), np.int64 if exact else object)
    for f in range(fields):
        out[:, :, f] = (wide >> width * f) & ((1 << width) - 1)
    out = out.reshape(len(a), -1)[:, :len(r)]
    kind = np.int64 if exact else object
    sums = r_bias * a.sum(axis=1).astype(kind)[:, None] + a_bias * r.sum(axis=1).astype(kind)[None, :]
    return out - sums - dim * a_bias * r_bias


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest allowed scores of each row; ties by smaller column."""
    m, n = scores.shape
    least = 0
    if scores.dtype != object and scores.size:
        least = max(abs(int(scores.min())), abs(int(scores.max())))
    if scores.dtype == object or least * n > 1 << 61:
        found = [(i, j) for i in range(m) for j in heapq.nsmallest(
            k, np.flatnonzero(allowed[i]).tolist(), key=lambda j: (-scores[i, j], j))]
        return tuple(np.array(found, np.int64).reshape(-1, 2).T)
    none = np.iinfo(np.int64).max
    rank = np.where(allowed, np.arange(n) - scores * n, none)  # all different where allowed
    if n > k:
        columns = np.argpartition(rank, k - 1, axis=1)[:, :k]
        i, j = np.nonzero(np.take_along_axis(rank, columns, axis=1) != none)
        return i, columns[i, j]
    return np.nonzero(allowed)


class Scores:
    """How scores travel: as long, or as big-endian biased bytes that sort alike."""

    def __init__(self, largest: float, dim: int):
        bits = 2 * (math.frexp(max(largest, 1.0))[1] + SCALE.bit_length()) + dim.bit_length() + 1
        self.bytes = 0 if bits <= 62 else bits // 8 + 2
        self.type = "binary" if self.bytes else "long"

    def out(self, scores: np.ndarray) -> list:
        half = 1 << 8 * self.bytes - 1 if self.bytes else 0
        values = scores.tolist()
        return [(int(s) + half).to_bytes(self.bytes, "big") for s in values] if self.bytes else values

    def back(self, value) -> int:
        return int.from_bytes(value, "big") - (1 << 8 * self.bytes - 1) if self.bytes else int(value)

    def shown(self, rows: DataFrame, names: list[str]) -> DataFrame:
        """Scores as long columns."""
        if not self.bytes:
            return rows
        kept = [(c, rows.schema[c].dataType.simpleString()) for c in rows.columns]
        ddl = ", ".join(f"{c} {'long' if c in names else t}" for c, t in kept)

        def run(parts):
            for part in parts:
                yield part.assign(**{c: [max(-LONG - 1, min(LONG, self.back(v))) for v in part[c]] for c in names})
        return rows.mapInPandas(run, ddl)


def _cells(rows: DataFrame, size: int) -> DataFrame:
    """Rows of sorted partitions in cells: (cell, labels present, uids, and as bytes ids, labels and components)."""
    def run(batches):
        from pyspark import TaskContext

        cell = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                uid, id_, label = (part.column(i).to_numpy() for i in range(3))
                x = np.ascontiguousarray(part.column(3).flatten().to_numpy(), "<f8")
                row = [[cell], [np.unique(label).tolist()], [uid.tolist()], [id_.tobytes()], [label.tobytes()], [x.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (
                    pa.int64(), *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 3))], names=["cell", "labels", "uids", "ids", "own", "x"])
                cell += 1
    return rows.select("uid", "id", "label", "x").mapInArrow(
        run, "cell long, labels array<long>, uids array<long>, ids binary, own binary, x binary")


def _open(cells: pd.DataFrame, dim: int) -> tuple[np.ndarray, ...]:
    """uid, id, label and integers of the rows in cells, by (id, uid)."""
    uid = np.concatenate(cells["uids"].tolist()).astype(np.int64)
    id_, label = (np.frombuffer(b"".join(cells[c]), "<i8") for c in ("ids", "own"))
    x = np.frombuffer(b"".join(cells["x"]), "<f8").reshape(-1, dim)
    order = np.lexsort((uid, id_))
    return uid[order], id_[order], label[order], integers(x[order])


def _numbered(cells: DataFrame, name: str, per: int) -> DataFrame:
    """Cells by number, so many to a group: (name, cell columns). One row for each cell is numbered, without its bytes."""
    order = Window.partitionBy(F.col("cell").bitwiseAND(F.lit(~((1 << 32) - 1)))).orderBy("cell")
    rank = cells.select("cell").withColumn("_n", F.row_number().over(order) - 1)
    part = F.concat_ws("-", F.shiftright("cell", 32).cast("string"), F.expr(f"_n div {per}").cast("string"))
    return cells.join(rank, "cell").withColumn(name, part).drop("_n")


def mine(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100,
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, part_rows: int = PART_ROWS,
         anchor_rows: int = ANCHOR_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose key is divisible by ``every``. A negative of a positive with score p has another label
    and a score n with low * p <= 100 * n <= high * p.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[label].dataType.typeName()
    whole = F.col(label).cast("long") if kind in ("byte", "short", "integer", "long") else F.xxhash64(F.col(label))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.when(F.col(label).isNotNull(), whole).alias("label"),
                          F.col(vector).cast("array<double>").alias("x")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)
        & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    lengths = rows.groupBy(F.size("x").alias("n")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.aggregate("x", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v)))).alias("top")) \
        .orderBy(F.desc("rows"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], out)
    dim, form = lengths["n"], Scores(lengths["top"], lengths["n"])
    sorted_ = rows.where(F.size("x") == dim).repartitionByRange("label", "id", F.xxhash64("x")) \
        .sortWithinPartitions("label", "id", "x").withColumn("uid", F.monotonically_increasing_id())
    rows = store(sorted_, "vectors")
    parts = store(_numbered(store(_cells(rows, cell_rows), "cells"), "part", max(1, part_rows // cell_rows)), "parts")
    asked = rows.where(F.col("id") % every == 0)
    asked = asked.repartitionByRange("label", "id", "uid").sortWithinPartitions("label", "id", "uid")
    blocks = store(_numbered(store(_cells(asked, cell_rows), "cells"), "block", max(1, anchor_rows // cell_rows)), "anchors")

    labels_of = lambda cells, name: cells.select(name, F.explode("labels").alias("label")).distinct()
    same = labels_of(blocks, "block").join(labels_of(parts, "part"), "label").select("block", "part").distinct()
    found = cogrouped(blocks.join(same, "block"), parts.join(same, "part"), ["block", "part"],
                      _positives(dim, positives, form), f"a_uid long, a_id long, uid long, id long, score {form.type}")
    rank = Window.partitionBy("a_uid").orderBy(F.desc("score"), "id", "uid")
    near = store(found.withColumn("n", F.row_number().over(rank)).where(F.col("n") <= positives), "positives")

    # each part meets the positives of each block of anchors: one row for each anchor, number and score of them
    owners = near.groupBy("a_uid").agg(F.array_sort(F.collect_list(F.struct("n", "id", "uid", "score"))).alias("found"))
    held = blocks.select("block", F.explode("uids").alias("a_uid")).join(owners, "a_uid")
    wanted = held.groupBy("block").agg(F.collect_list(F.struct("a_uid", F.transform("found", lambda p: p["score"]).alias("p"))
                                                      ).alias("wanted"))  # at most a block of anchors
    # every block and every part, but no pair that has one and the same label only
    alone = lambda cells, name: cells.groupBy(name).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("labels")))).alias("labels")) \
        .select(name, F.when(F.size("labels") == 1, F.col("labels")[0]).alias(f"{name}_label"))
    names = store(alone(blocks, "block").withColumn("number", F.row_number().over(Window.orderBy("block"))), "blocks")
    pairs = alone(parts, "part").withColumn("number", F.explode(F.sequence(F.lit(1), F.lit(names.count())))) \
        .join(names, "number").where("block_label is null or part_label is null or block_label <> part_label") \
        .select("block", "part")
    first = blocks.groupBy("block").agg(F.min("cell").alias("cell"))  # carries the block's positives
    carried = blocks.join(wanted.join(first, "block"), ["block", "cell"], "left")
    away = cogrouped(carried.join(pairs, "block"), parts.join(pairs, "part"), ["block", "part"],
                     _negatives(dim, negatives, low, high, form),
                     f"a_uid long, n int, neg_uid long, neg_id long, score {form.type}")
    rank = Window.partitionBy("a_uid", "n").orderBy(F.desc("score"), "neg_id", "neg_uid")
    chosen = away.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= negatives)
    done = chosen.join(near.select("a_uid", "n", "a_id", "id", F.col("score").alias("p_score")), ["a_uid", "n"])
    return form.shown(done.select(F.col("a_id").alias("anchor_id"), F.col("id").alias("positive_id"), "rank",
                                  F.col("neg_id").alias("negative_id"), F.col("p_score").alias("positive_score"),
                                  F.col("score").alias("negative_score")), ["positive_score", "negative_score"])


def _chunks(anchors: int, rows: int):
    step = max(1, SCORES // max(1, rows))
    return (slice(at, at + step) for at in range(0, anchors, step))


def _positives(dim: int, k: int, form: Scores):
    def run(block: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(part):
            a_uid, a_id, a_label, a = _open(block, dim)
            uid, id_, label, x = _open(part, dim)
            for at in _chunks(len(a), len(x)):
                scores = products(a[at], x)
                i, j = best(scores, (a_label[at][:, None] == label) & (a_uid[at][:, None] != uid), k)
                out.append(pd.DataFrame({"a_uid": a_uid[at][i], "a_id": a_id[at][i], "uid": uid[j], "id": id_[j],
                                         "score": form.out(scores[i, j])}))
        return pd.concat(out) if out else pd.DataFrame(columns=["a_uid", "a_id", "uid", "id", "score"])
    return run


def _negatives(dim: int, k: int, low: int, high: int, form: Scores):
    def run(block: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        out = []
        wanted = [w for w in (block["wanted"] if len(block) and len(part) else []) if w is not None]
        if wanted:
            of = {w["a_uid"]: [form.back(p) for p in w["p"]] for w in wanted[0]}
            a_uid, _, a_label, a = _open(block, dim)
            some = np.isin(a_uid, list(of))
            a_uid, a_label, a = a_uid[some], a_label[some], a[some]
            uid, id_, label, x = _open(part, dim)
            for at in _chunks(len(a), len(x)):
                scores = products(a[at], x)
                if scores.dtype != object and max(abs(int(scores.min())), abs(int(scores.max()))) > 1 << 55:
                    scores = scores.astype(object)
                other = a_label[at][:, None] != label
                for n in range(max(len(of[u]) for u in a_uid[at])):
                    p = [of[u][n] if n < len(of[u]) else -1 for u in a_uid[at].tolist()]
                    p = np.array(p, object if scores.dtype == object or max(p) > 1 << 55 else np.int64)[:, None]
                    # no score lies between a negative p's bounds
                    inside = other & (100 * scores <= high * p) & (100 * scores >= low * p) & (p >= 0)
                    i, j = best(scores, inside.astype(bool), k)
                    out.append(pd.DataFrame({"a_uid": a_uid[at][i], "n": n + 1, "neg_uid": uid[j], "neg_id": id_[j],
                                             "score": form.out(scores[i, j])}))
        return pd.concat(out) if out else pd.DataFrame(columns=["a_uid", "n", "neg_uid", "neg_id", "score"])
    return run
