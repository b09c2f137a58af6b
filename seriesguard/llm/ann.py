"""Approximate nearest neighbours by shifted space-filling curves.

Several orthogonal projections to a few dimensions, each with a random shift, give every vector a Hilbert key per curve;
Spark range-partitions the vectors by (curve, key) into segments. A query looks at the segments around its own on every
curve; candidates from all curves are merged and ranked by the exact inner product of the original vectors. Vectors of
unequal length get one more coordinate that turns the largest inner product into the smallest distance.

The window is not guessed: for a bounded sample of queries the true neighbours are found by brute force against all
vectors, and the window is the least number of segments that reaches the wanted recall on them. Data without structure,
such as uniform directions, thereby gets wide windows, clustered data narrow ones.

Equal vectors are one in the index and are unfolded at the end, so many copies make no hot segment.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part; null ids neither; rows alike in id and vector count once, rows of one id with other vectors are rows of their own (a
query does not find its own row, but others with its id); with fewer candidates than asked for, all are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesguard.frame import cogrouped

from .common import store

CURVES = 4
DIMENSIONS = 7
KEY_BITS = 8  # for each dimension
#: Vectors of a segment; a query gets its k best of each segment it looks at.
SEGMENT_ROWS = 1 << 15
#: Queries that the window is measured on, and the recall wanted there.
SAMPLE_QUERIES = 128
RECALL = 0.95
#: Queries that meet a segment at once.
QUERY_ROWS = 1 << 13
#: Scores that are held at once.
SCORES = 1 << 22


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows); published bit-transpose method, whole columns at once."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo excess work from the top bit down
        low = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ flip) >> bit) & 1)
    return key


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each row, and of all that tie with the smallest of them."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, bool)
    return scores >= -np.partition(-scores, k - 1, axis=1)[:, k - 1:k] - 1e-12


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def _doubles(column: pa.Array) -> np.ndarray:
    data = np.frombuffer(b"".join(column.to_pylist()), "<f8")
    return data.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def classes(vectors: DataFrame, k: int, *, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (code, vec, cid, ids): bytes of doubles, number of the first row, (id, uid) of the k + 1 rows with the
    smallest ids; and the rows (id, uid, vec, code) themselves."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & F.exists("v", lambda x: x != 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("v") == (lengths["n"] if lengths else 0))

    def packed(batches):
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False) + 0.0  # no negative zero
            v = np.ascontiguousarray(flat.reshape(batch.num_rows, -1), "<f8") if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in v], pa.binary())],
                                             names=["id", "vec"])

    rows = store(rows.mapInArrow(packed, "id long, vec binary").withColumn("code", F.sha2("vec", 256))
                 .dropDuplicates(["id", "code"]).withColumn("uid", F.monotonically_increasing_id()), "members")
    first = Window.partitionBy("code").orderBy("id", "uid")  # limited before the exchange
    least = rows.select("code", "id", "uid").withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    ids = least.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("id", "uid"))).alias("ids"))
    one = rows.groupBy("code").agg(F.min("uid").alias("uid"))
    return rows.join(one, ["code", "uid"]).select("code", "vec", F.col("uid").alias("cid")).join(ids, "code"), rows


def search(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20,
           curves: int = CURVES, segment_rows: int = SEGMENT_ROWS, recall: float = RECALL, seed: int = 11,
           report: dict | None = None) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found for each row whose key is divisible by ``every``.

    ``report`` gets the window: ``segments`` of a curve, ``reach`` on each side, and the ``share`` of a curve's vectors that a
    query meets.
    """
    spark = vectors.sparkSession
    found, members = classes(vectors, k, key=key, vector=vector)
    index = store(found, "vectors")
    stats = index.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("vec")).alias("bytes")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    if not stats["n"]:
        return empty
    dim = stats["bytes"] // 8
    asked = members.where(F.col("id") % every == 0).select("code", "id", "uid")
    queries = store(asked.select("code").distinct().join(index.select("code", "cid", "vec"), "code"), "queries")

    # scale from a bounded sample
    some = index.select("vec").orderBy(F.xxhash64("vec")).limit(2000).collect()
    x = np.stack([np.frombuffer(r["vec"], "<f8") for r in some])
    norm = index.mapInArrow(_norms, "norm double").agg(F.max("norm")).first()[0]
    rng = np.random.default_rng(seed)
    d = min(DIMENSIONS, dim + 1)
    x = np.c_[x, np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))]
    spread = []
    for _ in range(curves):
        basis = np.linalg.qr(rng.normal(size=(dim + 1, d)))[0]
        y = x @ basis
        low, high = y.min(axis=0), y.max(axis=0)
        width = np.maximum(high - low, 1e-9) * 1.5
        spread.append((basis, low - width * (0.05 + 0.28 * rng.random(d)), width * 1.1))

    def keyed(batches):
        for batch in batches:
            v = _doubles(batch.column(1))
            if not len(v):
                continue
            v = np.c_[v, np.sqrt(np.maximum(norm * norm - (v * v).sum(axis=1), 0))]
            for curve, (basis, low, width) in enumerate(spread):
                cells = np.clip((v @ basis - low) / width * (1 << KEY_BITS), 0, (1 << KEY_BITS) - 1)
                keys = hilbert_keys(cells.astype(np.int64), KEY_BITS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([curve] * len(v), pa.int32()), pa.array(keys), batch.column(1)],
                    names=["cid", "curve", "key", "vec"])

    on_curve = index.select("cid", "vec").mapInArrow(keyed, "cid long, curve int, key long, vec binary")
    # rank along the curve: place in the sorted partition, after the rows of the partitions before
    ranged = store(on_curve.repartitionByRange(max(1, -(-stats["n"] * curves // segment_rows)), "curve", "key", "cid")
                   .sortWithinPartitions("curve", "key", "cid").withColumn("place", F.monotonically_increasing_id()), "curves")
    ranged = ranged.withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    offsets = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.col("offset") + F.col("place").bitwiseAND((1 << 33) - 1) - F.col("curve") * F.lit(stats["n"])
    rows = ranged.join(F.broadcast(offsets), "part").select(
        "cid", "curve", "vec", F.floor(rank / segment_rows).cast("int").alias("segment"))
    last = rows.groupBy("curve").agg(F.max("segment").alias("last"))

    reach = _window(index, queries, rows, k, recall)
    own = queries.select("cid", F.col("vec").alias("query")).join(rows.select("cid", "curve", "segment"), "cid")
    asks = own.join(F.broadcast(last), "curve").select(
        "cid", "query", "curve", F.explode(F.sequence(F.greatest(F.lit(0), F.col("segment") - reach), F.least(
            F.col("last"), F.col("segment") + reach))).alias("segment"))
    # many queries at a segment: its vectors are copied to blocks of queries, as many as the fullest segment needs
    loads = asks.groupBy("curve", "segment").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.avg("n")).first()
    blocks = max(1, -(-(loads[0] or 0) // QUERY_ROWS))
    if report is not None:
        segments, n_queries = last.agg(F.max("last")).first()[0] + 1, queries.count()
        report.update(segments=segments, reach=reach, share=min(1.0, (loads[1] or 0) / max(1, n_queries)))
    asks = asks.withColumn("block", F.pmod(F.xxhash64("cid"), F.lit(blocks)).cast("int"))
    held = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    near = cogrouped(asks.select("curve", "segment", "block", "cid", "query"), held, ["curve", "segment", "block"],
                     _meet(k), "query long, cid long, score double")
    merged = near.groupBy("query", "cid").agg(F.max("score").alias("score")) \
        .withColumn("n", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(F.col("n") <= k + 1)

    # unfold classes: the k + 1 first members of each, then the first k + 1 of a query vector, then without itself
    unfolded = merged.join(index.select("cid", "ids"), "cid").select("query", "score", F.explode("ids").alias("m")) \
        .select("query", "score", "m.*")
    top = unfolded.withColumn("n", F.row_number().over(
        Window.partitionBy("query").orderBy(F.desc("score"), "id", "uid"))).where(F.col("n") <= k + 1).drop("n")
    rows_of = asked.join(queries.select("code", F.col("cid").alias("query")), "code").select(
        "query", F.col("id").alias("query_id"), F.col("uid").alias("query_uid"))
    mine = rows_of.join(top, "query").where("uid <> query_uid")
    return mine.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_uid").orderBy(F.desc("score"), "id", "uid")).cast("int")).where(F.col("rank") <= k) \
        .select("query_id", "rank", "id", "score")


def _norms(batches):
    for batch in batches:
        v = _doubles(batch.column(batch.schema.get_field_index("vec")))
        yield pa.RecordBatch.from_arrays([pa.array(np.sqrt((v * v).sum(axis=1)) if len(v) else [], pa.float64())],
                                         names=["norm"])


def _window(index: DataFrame, queries: DataFrame, rows: DataFrame, k: int, recall: float) -> int:
    """Segments on each side that find the wanted share of true neighbours for a sample of queries."""
    sample = queries.orderBy(F.xxhash64("cid")).limit(SAMPLE_QUERIES).select("cid", "vec").collect()
    ids = np.array([r["cid"] for r in sample])
    q = np.stack([np.frombuffer(r["vec"], "<f8") for r in sample])

    def brute(batches):
        for batch in batches:
            cids, v = batch.column(0).to_numpy(), _doubles(batch.column(1))
            if not len(cids):
                continue
            scores = q @ v.T
            scores[ids[:, None] == cids[None, :]] = -np.inf
            order = np.argsort(-scores, axis=1)[:, :k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, order.shape[1])), pa.array(cids[order].ravel()),
                 pa.array(np.take_along_axis(scores, order, axis=1).ravel())], names=["query", "cid", "score"])

    truth = index.select("cid", "vec").mapInArrow(brute, "query long, cid long, score double").withColumn(
        "n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cid"))) \
        .where((F.col("n") <= k) & (F.col("score") > float("-inf"))).select("query", "cid")
    at = rows.select("cid", "curve", "segment")
    pairs = truth.join(at, "cid").join(at.select(F.col("cid").alias("query"), "curve", F.col("segment").alias("own")),
                                       ["query", "curve"])
    away = pairs.groupBy("query", "cid").agg(F.min(F.abs(F.col("segment") - F.col("own"))).alias("away"))
    per = away.groupBy("away").count().orderBy("away").collect()  # one row for each distance, of a bounded sample
    total, have = sum(r["count"] for r in per), 0
    for r in per:
        have += r["count"]
        if have >= recall * total:
            return int(r["away"])
    return 0


def _meet(k: int):
    def run(asks: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asks) or not len(held):
            return pd.DataFrame({"query": pd.Series(dtype="i8"), "cid": pd.Series(dtype="i8"),
                                 "score": pd.Series(dtype="f8")})
        q = np.stack([np.frombuffer(v, "<f8") for v in asks["query"]])
        v = np.stack([np.frombuffer(v, "<f8") for v in held["vec"]])
        step, out = max(1, SCORES // len(v)), []
        for at in range(0, len(q), step):
            i, j = np.nonzero(_top(q[at:at + step] @ v.T, k + 1))
            out.append((i + at, j))
        i, j = (np.concatenate(x) for x in zip(*out))
        return pd.DataFrame({"query": asks.cid.to_numpy()[i], "cid": held.cid.to_numpy()[j], "score": _dots(q[i], v[j])})
    return run
