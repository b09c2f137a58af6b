"""Helpers of the operators in this package."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seriesguard.frame import shared_dir

#: A table of at most this many measured bytes may be broadcast.
BROADCAST_BYTES = 8 << 20


def fresh_path(df: DataFrame, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str = "llm") -> DataFrame:
    """Write once in the shared folder and go on from there: later passes survive lost executors."""
    path = fresh_path(df, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text as string, null as empty."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def packed(docs: DataFrame, name: str = "row") -> DataFrame:
    """All columns of the rows in one struct, so that no name of theirs can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name))


def unpacked(rows: DataFrame, columns: list[str], added: dict[str, Column], name: str = "row") -> DataFrame:
    """The rows' own columns, then the added ones; an added one replaces an own one of its name in its place."""
    place = {key: f"added{i}" for i, key in enumerate(added)}
    # two steps: an own column's name must not be taken for the struct while the added ones are made
    rows = rows.select(F.col(name).alias("whole"), *[value.alias(place[key]) for key, value in added.items()])
    own = [F.col(place[c]).alias(c) if c in added else F.col("whole").getField(c).alias(c) for c in columns]
    return rows.select(*own, *[F.col(place[c]).alias(c) for c in added if c not in columns])


def partitions(docs: DataFrame) -> int:
    return max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def in_key_order(rows: DataFrame) -> DataFrame:
    """(key, text) rows in ranges of the key. Equal keys are ordered by a hash of the text and the row's place in the table,
    so that a hot key is many ranges."""
    placed = rows.select("key", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("uid"))
    return placed.repartitionByRange("key", "h", "uid").sortWithinPartitions("key", "h", "uid").select("key", "text")


def map_texts(rows: DataFrame, function, added: str, *, text: str = "text", keep: list[str] | None = None,
              most: int | None = None) -> DataFrame:
    """Replace the text column by what ``function(list of texts)`` gives: one array for each added column.

    Other columns pass through as Arrow arrays; texts go to the function in runs of about a million characters and ``most`` rows.
    """
    keep = [c for c in rows.columns if c != text] if keep is None else keep
    rows = rows.select(*keep, text)
    empty = rows.sparkSession.createDataFrame([], added)
    schema = T.StructType([*[rows.schema[c] for c in keep], *empty.schema.fields])

    def run(batches):
        target = to_arrow_schema(schema)
        for batch in batches:
            for first, last, texts in runs(batch.column(len(keep)), most=most):
                new = function(texts)
                old = [batch.column(i).slice(first, last - first) for i in range(len(keep))]
                arrays = [*old, *[pa.array(x, type=f.type) for x, f in zip(new, list(target)[len(keep):])]]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a
                                                  for a, f in zip(arrays, target)], schema=target)

    return rows.mapInArrow(run, schema)


def runs(texts: pa.Array, size: int = 1 << 20, most: int | None = None):
    """(first, last, texts) of consecutive texts with about so many bytes, at most so many; only these become strings."""
    for first, last in spans(texts, size, most):
        yield first, last, texts.slice(first, last - first).to_pylist()


def spans(texts: pa.Array, size: int, most: int | None = None):
    """(first, last) of such runs."""
    ends = np.cumsum(np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False)))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
        last = min(last, first + most) if most else last
        yield first, last
        first = last
