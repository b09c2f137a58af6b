"""Token-ID output with Re-Pair grammar compression.

A shard is a range of documents in key order, written as blocks. In a block the most frequent pairs of neighbouring ids
are repeatedly replaced by new symbols (nonterminals), many pairs in each round, until no pair occurs twice; where
matches overlap, that of the more frequent pair is replaced. A block stores the rules, the length of each rule's expansion and the symbols of every document,
so ids from anywhere in a document are decoded without what stands before. Pairs never span documents.

Block: header, documents (ids each, first symbol each), rules (left, right), expansion lengths, symbols. Base ids and
nonterminals share 16 bits where they fit. Blocks are the binary column of Parquet files, so Spark's own commit makes
the output whole or absent.

Defined results: null text is empty and has only the end id; null keys come first, equal keys in the order of a hash of
their texts; an empty table gives no block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import fresh_path, in_key_order, spans, text_of
from .tokens import encoder

END_ID = 1
#: Ids of a block; a longer document makes a longer block.
BLOCK_IDS = 1 << 21
#: Bytes of text that are encoded at once.
RUN_BYTES = 1 << 22
#: How often a pair must occur to be replaced, and how much rarer than the most frequent one it may be in one round.
LEAST_COUNT = 2
SPREAD = 256
#: Slots in which pairs are looked up.
SLOT_BITS = 20
#: Rules that are expanded at once on reading.
RULES_AT_ONCE = 1 << 14
MAGIC = b"RPR1"
HEAD = "<4sIIIIQ"  # magic, base ids, documents, rules, symbol bytes, symbols


def _hashed(codes: np.ndarray) -> np.ndarray:
    """SLOT_BITS bits of each code."""
    return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)


def _chosen(codes: np.ndarray, least: int | None, weights: np.ndarray | None) -> tuple[np.ndarray, int]:
    """Pairs found ``least`` times, by default 1 / SPREAD as often as the most frequent one, which comes last, ties by hash;
    and that number."""
    order = None if weights is None else np.argsort(codes)
    ordered = np.sort(codes) if weights is None else codes[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    counts = np.diff(np.r_[starts, len(ordered)]) if weights is None else np.add.reduceat(weights[order], starts)
    least = least or max(LEAST_COUNT, int(counts.max()) // SPREAD)
    often = np.flatnonzero(counts >= least)
    pairs = ordered[starts[often]]
    return pairs[np.lexsort((pairs * np.uint64(0x9E3779B97F4A7C15), counts[often]))], least


def _slots(pairs: np.ndarray) -> np.ndarray:
    """Number of the last pair in each slot of the hash, -1 where there is none."""
    out = np.full(1 << SLOT_BITS, -1, np.int32)
    np.maximum.at(out, _hashed(pairs), np.arange(len(pairs), dtype=np.int32))
    return out


class _Sequence:
    """The symbols of a block, linked, so that a round costs what is next to the last round's replacements."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, weights: np.ndarray | None = None):
        """Parts (documents, or pieces that stand ``weights`` times in the block) of so many ids; no pair spans them."""
        n = len(ids)
        self.seq = np.empty(n + 1, np.uint64)  # one more place for what lies beyond both ends
        self.seq[:n], self.seq[n] = ids, 0
        self.weight = None if weights is None else np.r_[np.repeat(weights, sizes), 0]
        self.last = np.zeros(n + 1, bool)  # of a part
        self.last[np.cumsum(sizes)[sizes > 0] - 1] = True
        self.link()

    def link(self) -> None:
        """Drop the places that were replaced, and look at all pairs again."""
        n = len(self.seq) - 1
        self.last[n] = True
        self.next, self.prev = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        self.next[n] = n
        self.live = np.ones(n + 1, bool)
        self.rule = np.full(n + 1, -1, np.int32)
        self.active = None  # all

    def pack(self) -> None:
        self.seq, self.last = self.seq[self.live], self.last[self.live]
        if self.weight is not None:
            self.weight = self.weight[self.live]
        self.link()

    def round(self, symbols: int, least: int | None) -> tuple[np.ndarray, int]:
        """Replace pairs found ``least`` times by symbols from ``symbols`` on; the pairs, and how often was asked for.

        Without a number all pairs are looked at, and it is set by the most frequent one. With the last round's number only
        pairs next to its replacements are: others occur as often as before.
        """
        at = self.active
        if at is None:
            left, right, free = self.seq[:-2], self.seq[1:-1], ~self.last[:-2]
            same = np.flatnonzero((left == right) & free)
            begins = np.diff(same) != 1
        else:
            after = self.next[at]
            left, right, free = self.seq[at], self.seq[after], np.ones(len(at), bool)
            same = np.flatnonzero(left == right)
            begins = after[same[:-1]] != at[same[1:]]
        codes = left << np.uint64(32)
        codes |= right
        if len(same):  # of a run of one symbol every other pair
            run = np.flatnonzero(np.r_[True, begins])
            free[same[(np.arange(len(same)) - np.repeat(run, np.diff(np.r_[run, len(same)]))) % 2 == 1]] = False
        weights = None if self.weight is None else (self.weight[:-2] if at is None else self.weight[at])[free]
        pairs, least = _chosen(codes[free], least, weights) if free.any() else (codes[:0], least or LEAST_COUNT)
        if not len(pairs):
            return pairs, least
        slots = _slots(pairs)
        pairs = pairs[slots[_hashed(pairs)] == np.arange(len(pairs))]  # of pairs that share a slot the others wait
        slots = _slots(pairs)
        rule = slots[_hashed(codes)]
        seen = np.flatnonzero(rule >= 0)  # may occur that often
        rule = rule[seen]
        match = free[seen] & (pairs[rule] == codes[seen])
        seen = seen if at is None else at[seen]
        here, rule = seen[match], rule[match]
        # of overlapping matches the more frequent pair's; the most frequent one keeps all, so every round gets on
        self.rule[here] = rule
        keep = rule > np.maximum(self.rule[self.prev[here]], self.rule[self.next[here]])
        self.rule[here] = -1
        weights = None if self.weight is None else self.weight[here[keep]]
        used = np.bincount(rule[keep], weights, minlength=len(pairs)) >= LEAST_COUNT
        keep &= used[rule]
        here, number = here[keep], (np.cumsum(used) - 1)[rule[keep]]
        gone = self.next[here]
        after = self.next[gone]
        self.seq[here] = (symbols + number).astype(np.uint64)
        self.last[here] = self.last[gone]
        self.next[here] = after
        self.prev[after] = here
        self.live[gone] = False
        touched = np.concatenate([seen, here, self.prev[here]])
        if len(touched) < len(self.seq) >> 5:
            touched = np.unique(touched)
        else:
            marks = np.zeros(len(self.seq), bool)
            marks[touched] = True
            touched = np.flatnonzero(marks)
        self.active = touched[self.live[touched] & ~self.last[touched]]
        return pairs[used], least


def _replaced(held: _Sequence, symbols: int, rules: list[np.ndarray]) -> int:
    """Replace pairs until none occurs twice; the number of symbols then."""
    least = None
    while True:
        pairs, least = held.round(symbols, least)
        if len(pairs):
            rules.append(pairs)
            symbols += len(pairs)
        elif least > LEAST_COUNT:  # on to rarer pairs
            held.pack()
            least = None
        else:
            held.pack()
            return symbols


def compress(ids: np.ndarray, sizes: np.ndarray, base: int) -> bytes:
    """A block of documents with so many ids each."""
    held, rules = _Sequence(ids, sizes), []
    return _block(held, rules, _replaced(held, base, rules), sizes, base)


def compress_pieces(pieces: np.ndarray, counts: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pool: np.ndarray,
                    base: int) -> bytes:
    """The same for documents of so many pieces each, given by number; a piece's ids stand in the pool.

    Pairs inside pieces are replaced first, each piece looked at once however often it occurs; then pairs across them.
    """
    often = np.bincount(pieces)
    used = np.flatnonzero(often)
    size = lengths[used]
    ends = np.cumsum(size)
    ids = pool[np.arange(int(ends[-1])) + np.repeat(starts[used] - ends + size, size)]
    inside, rules = _Sequence(ids, size, often[used]), []
    symbols = _replaced(inside, base, rules)
    left = np.flatnonzero(inside.last[:-1]) + 1  # where each piece ends now
    size = np.diff(np.r_[0, left])
    place = np.empty(len(often), np.int64)
    place[used] = np.arange(len(used))
    of = place[pieces]
    each = size[of]
    ends = np.cumsum(each)
    seq = inside.seq[np.arange(int(ends[-1])) + np.repeat((left - size)[of] - ends + each, each)]
    last = np.cumsum(counts)
    held = _Sequence(seq, np.diff(np.r_[0, np.r_[0, ends][last]]))
    symbols = _replaced(held, symbols, rules)
    total = np.r_[0, np.cumsum(lengths[pieces])][last]
    return _block(held, rules, symbols, np.diff(np.r_[0, total]), base)


def _block(held: _Sequence, rules: list[np.ndarray], symbols: int, sizes: np.ndarray, base: int) -> bytes:
    kind, shift = np.uint64, np.uint64(32)
    seq, last = held.seq[:-1], held.last[:-1]
    pairs = np.concatenate(rules) if rules else np.empty(0, kind)
    left, right = (pairs >> shift).astype(np.int64), (pairs & (kind(1) << shift) - kind(1)).astype(np.int64)
    lengths = np.ones(symbols, np.int64)
    at = base
    for part in rules:  # a rule only uses symbols of earlier rounds
        n = len(part)
        lengths[at:at + n] = lengths[left[at - base:at - base + n]] + lengths[right[at - base:at - base + n]]
        at += n
    first = np.r_[0, np.flatnonzero(last) + 1]
    starts = np.zeros(len(sizes), np.int64)
    starts[sizes > 0] = first[:-1]
    width = 4 if symbols > 1 << 16 else 2
    return b"".join([
        struct.pack(HEAD, MAGIC, base, len(sizes), len(pairs), width, len(seq)), sizes.astype("<u4").tobytes(),
        starts.astype("<u8").tobytes(), left.astype("<u4").tobytes(), right.astype("<u4").tobytes(),
        lengths[base:].astype("<u4").tobytes(), seq.astype(f"<u{width}").tobytes()])


class Block:
    """A written block, decoded in whole or from anywhere."""

    def __init__(self, data: bytes):
        magic, base, docs, rules, width, symbols = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a block of ids")
        at = struct.calcsize(HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.base, self.sizes, self.starts = base, take("<u4", docs), take("<u8", docs).astype(np.int64)
        self.left, self.right = take("<u4", rules).astype(np.int64), take("<u4", rules).astype(np.int64)
        self.lengths = np.r_[np.ones(base, np.int64), take("<u4", rules).astype(np.int64)]
        self.symbols = take(f"<u{width}", symbols)
        # expansions of all symbols one after the other: every symbol's place follows from the lengths
        self.places = np.r_[0, np.cumsum(self.lengths)]
        self.pool = np.empty(int(self.places[-1]), np.uint32)
        self.pool[:base] = np.arange(base)
        deepest = np.maximum(self.left, self.right) if rules else self.left
        at = 0
        while at < rules:  # as many rules at once as use only earlier symbols
            late = np.flatnonzero(deepest[at:at + RULES_AT_ONCE] >= base + at)
            stop = at + int(late[0]) if len(late) else min(rules, at + RULES_AT_ONCE)
            both = np.stack([self.left[at:stop], self.right[at:stop]], axis=1).ravel()
            self.pool[self.places[base + at]:self.places[base + stop]] = self.expand(both)
            at = stop

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.lengths[symbols]
        ends = np.cumsum(n)
        index = np.arange(int(ends[-1]) if len(n) else 0) + np.repeat(self.places[symbols] - ends + n, n)
        return self.pool[index]

    def ids(self) -> np.ndarray:
        """Ids of all documents."""
        return np.concatenate([self.expand(self.symbols[i:i + (1 << 18)])
                               for i in range(0, len(self.symbols), 1 << 18)] or [np.empty(0, np.uint32)])

    def read(self, doc: int, start: int, length: int) -> np.ndarray:
        """Ids [start, start + length) of a document, from the symbols that cover them."""
        stop = self.starts[doc + 1:][self.sizes[doc + 1:] > 0]
        own = self.symbols[self.starts[doc]:stop[0] if len(stop) else None] if self.sizes[doc] else self.symbols[:0]
        ends = np.cumsum(self.lengths[own])
        a, b = np.searchsorted(ends, [start, min(start + length, int(self.sizes[doc])) - 1], side="right")
        found = self.expand(own[a:b + 1])
        skip = start - (int(ends[a - 1]) if a else 0)
        return found[skip:skip + length]


BLOCKS = "shard int, block int, keys array<long>, tokens long, data binary"


def write(docs: DataFrame, tokenizer: str, path: str | None = None, *, key: str = "doc_id", text: str = "text",
          block_ids: int = BLOCK_IDS) -> str:
    """Encode all texts, add the end id, and write blocks in ascending key order; returns the path."""
    path = path or fresh_path(docs, "token-ids")
    rows = docs.select(F.col(key).cast("long").alias("key"), text_of(docs, text).alias("text"))
    rows = in_key_order(rows)
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], BLOCKS).schema)

    def run(batches):
        coder, shard, block = encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys, parts, counts, size = [], [], [], 0
        coder.forget()
        end = coder.pieces.single(END_ID)

        def out():
            known = coder.pieces
            data = compress_pieces(np.concatenate(parts), np.array(counts), known.starts, known.sizes, known.pool, coder.size)
            row = [[shard], [block], [keys], [size], [data]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, schema)], schema=schema)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, last in spans(batch.column(1), RUN_BYTES):
                of, ends = coder.pieces_of(batch.column(1).slice(first, last - first))
                lengths, begin = coder.pieces.sizes[of], 0
                for k, stop, ids in zip(names[first:last], ends.tolist(), np.diff(np.r_[0, np.r_[0, np.cumsum(lengths)][ends]]).tolist()):
                    mine = of[begin:stop]
                    keys.append(k)
                    parts.append(np.r_[mine[lengths[begin:stop] > 0], end])
                    counts.append(len(parts[-1]))
                    size, begin = size + ids + 1, stop
                    if size >= block_ids:
                        yield out()
                        keys, parts, counts, size, block = [], [], [], 0, block + 1
                if coder.full():  # numbers hold for one block
                    if keys:
                        yield out()
                        keys, parts, counts, size, block = [], [], [], 0, block + 1
                    coder.forget()
                    end = coder.pieces.single(END_ID)
        if keys:
            yield out()

    rows.mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(path)
    return path


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document in the files, decoded; start counts over all shards."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    order = Window.orderBy("shard", "block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.select("shard", "block", "tokens")  # one row for each block
    starts = totals.withColumn("first", F.coalesce(F.sum("tokens").over(order), F.lit(0))).drop("tokens")
    out = "shard int, block int, key long, inner long, n_tokens long, ids_crc32 long"
    schema = to_arrow_schema(spark.createDataFrame([], out).schema)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["data"])
                ids = block.ids().astype("<u4", copy=False)
                sizes = block.sizes.astype(np.int64)
                ends = np.cumsum(sizes)
                begins = ends - sizes
                data = memoryview(ids.tobytes())
                sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                n = len(sizes)
                columns = [[row["shard"]] * n, [row["block"]] * n, row["keys"], begins, sizes, sums]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    found = blocks.mapInArrow(run, out).join(starts, ["shard", "block"])
    return found.select("key", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
