"""Packing into fixed windows without changing the order, by dynamic programming.

The documents' ids form one stream. Windows are cut at document ends (free), sentence ends and, inside longer runs,
elsewhere (at a price), so that padding plus the price of truncations is least. With windows of at most ``length`` ids the
best cut before position p minimises cost(c) + c over the cuts c in [p - length, p): the minimum of a sliding window,
kept in a monotone queue, so the work grows with the number of cuts.

A task packs a range of the order; the last, open window of a buffer goes on in the next.

Defined results: null text is empty and has only the end id; null keys come first, equal keys in the order of a hash of
their texts; an empty table gives an empty one; a text longer than a window spreads over several.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_key_order, runs, text_of
from .tokens import encoder

LENGTH = 2048
END_ID = 1
#: Prices in padding ids.
SENTENCE_PRICE = 24
FORCED_PRICE = 160
#: Distance of forced cuts in a run without sentence ends.
FORCED_STEP = 256
#: Ids that are packed at once.
BUFFER_IDS = 1 << 20
SENTENCE_ENDS = (b".", b"!", b"?", b"\n")
PIECES = "key long, start long, length long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, " \
         "padded_to long, ids binary"


def best_cuts(cuts: np.ndarray, prices: np.ndarray, length: int) -> np.ndarray:
    """Chosen cuts from 0 to the last one. ``cuts`` ascend from 0 in steps of at most ``length``."""
    at, price = cuts.tolist(), prices.tolist()
    n = len(at)
    reach, before = [0] * n, [0] * n  # cost so far plus position; previous cut
    queue: deque[int] = deque([0])
    for i in range(1, n):
        low = at[i] - length
        while at[queue[0]] < low:
            queue.popleft()
        j = queue[0]
        before[i] = j
        reach[i] = value = reach[j] + length + price[i]  # reach[j] + length - at[i] + price[i], plus at[i]
        while queue and reach[queue[-1]] >= value:
            queue.pop()
        queue.append(i)
    chosen, i = [], n - 1
    while i:
        chosen.append(at[i])
        i = before[i]
    return np.array([0, *chosen[::-1]], np.int64)


def candidates(ends: np.ndarray, sentences: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts and prices: document ends, sentence ends, and cuts inside gaps longer than ``step``."""
    known = np.union1d(np.r_[0, ends], sentences)
    gaps = np.diff(known)
    wide = np.flatnonzero(gaps > step)
    forced = [np.arange(known[i] + step, known[i + 1], step) for i in wide]
    cuts = np.union1d(known, np.concatenate(forced)) if forced else known
    prices = np.full(len(cuts), FORCED_PRICE, np.int64)
    prices[np.isin(cuts, sentences)] = SENTENCE_PRICE
    prices[np.isin(cuts, ends)] = 0
    return cuts, prices


def _padded(n: int, length: int) -> int:
    return n if n & (n - 1) == 0 else length


class Packer:
    """Packs documents that come in order; ``full`` and ``rest`` give pieces."""

    def __init__(self, ends_sentence: np.ndarray, length: int, first: int):
        self.ends_sentence, self.length, self.sequence = ends_sentence, length, first
        self.docs: list[tuple[object, int, int]] = []  # key, ids before those in the buffer, all ids
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, key, ids: np.ndarray) -> None:
        self.docs.append((key, 0, len(ids)))
        self.ids.append(ids)
        self.size += len(ids)

    def pieces(self, last: bool) -> list[tuple]:
        if not self.size:
            return []
        ids = np.concatenate(self.ids)
        sizes = np.array([len(x) for x in self.ids])
        ends = np.cumsum(sizes)
        sentences = np.flatnonzero(self.ends_sentence[ids]) + 1
        chosen = best_cuts(*candidates(ends, sentences, FORCED_STEP), self.length)
        stop = int(chosen[-1] if last else chosen[-2])  # the open window waits for more
        if not stop:
            return []
        chosen = chosen[chosen <= stop]
        bounds = np.union1d(chosen, np.r_[0, ends[ends < stop]])
        of_doc = np.searchsorted(ends, bounds[:-1], side="right")
        of_window = np.searchsorted(chosen, bounds[:-1], side="right") - 1
        begins = ends - sizes
        data, out = ids.astype("<u4", copy=False), []
        for a, b, d, w in zip(bounds[:-1].tolist(), bounds[1:].tolist(), of_doc.tolist(), of_window.tolist()):
            key, before, total = self.docs[d]
            n = int(chosen[w + 1] - chosen[w])
            out.append((key, before + a - int(begins[d]), b - a, total, self.sequence + w, a - int(chosen[w]), n,
                        _padded(n, self.length), data[a:b].tobytes()))
        self.sequence += len(chosen) - 1
        d = int(np.searchsorted(ends, stop, side="right"))
        if d < len(self.docs):
            key, before, total = self.docs[d]
            cut = stop - int(begins[d])
            self.docs, self.ids = [(key, before + cut, total), *self.docs[d + 1:]], [self.ids[d][cut:], *self.ids[d + 1:]]
        else:
            self.docs, self.ids = [], []
        self.size = len(ids) - stop
        return out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def pack_sorted(rows: DataFrame, tokenizer: str, *, length: int = LENGTH) -> DataFrame:
    """Pack (key, text) rows in the order of their partitions."""
    key = rows.schema["key"].dataType.simpleString()
    ddl = PIECES.replace("key long", f"key {key}")
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(rows.sparkSession.createDataFrame([], ddl).schema)

    def run(batches):
        coder = encoder(tokenizer)
        packer = Packer(coder.ending_with(SENTENCE_ENDS), length, TaskContext.get().partitionId() << 40)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, last, texts in runs(batch.column(1)):
                for k, t in zip(keys[first:last], texts):
                    packer.add(k, np.concatenate([coder.ids(t), end]))
                    if packer.size >= BUFFER_IDS and (found := packer.pieces(False)):
                        yield _batch(found, schema)
        if found := packer.pieces(True):
            yield _batch(found, schema)

    return rows.select("key", "text").mapInArrow(run, ddl)


def pack(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Pieces of all documents in key order. ``ids`` holds a piece's ids as little-endian unsigned 32-bit numbers."""
    return pack_sorted(in_key_order(docs.select(F.col(key).alias("key"), text_of(docs, text).alias("text"))),
                       tokenizer, length=length)
