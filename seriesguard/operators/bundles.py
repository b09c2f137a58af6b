"""Groups inside an Arrow table that holds many small ones: their numbers, features as arrays, lists as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seriesguard.frame import bundled
from seriesguard.operators.features import FEATURES


def numbered(tables: Sequence[pa.Table], by: Sequence[str]) -> list[np.ndarray]:
    """For each table a number per row, equal where all of ``by`` are equal, nulls too."""
    together = pa.concat_tables([t.select(list(by)) for t in tables])
    out = np.zeros(together.num_rows, np.int64)
    for name in by:
        column = together[name].combine_chunks().dictionary_encode(null_encoding="encode")
        places = column.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.unique(out * max(1, len(column.dictionary)) + places, return_inverse=True)[1]
    return np.split(out, np.cumsum([t.num_rows for t in tables])[:-1])


def runs(numbers: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and one past the last place of each run of equal numbers."""
    edges = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True]) if len(numbers) else np.zeros(1, int)
    return zip(edges[:-1].tolist(), edges[1:].tolist())


def matrix(table: pa.Table, names: Sequence[str] = FEATURES) -> np.ndarray:
    return np.column_stack([table[name].to_numpy() for name in names])


def lists(values: np.ndarray | pa.Array, counts: np.ndarray) -> pa.Array:
    """A column of lists that take ``counts`` of the values in turn."""
    values = pa.array(values) if isinstance(values, np.ndarray) else values
    return pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int64()), values).cast(pa.list_(values.type))


def per_series(rows: DataFrame, keys: Sequence[str], size: int, run: Callable[[np.ndarray], dict[str, np.ndarray]],
               schema) -> DataFrame:
    """Keys, position and the scores that ``run`` gives to the features of each series, which come in order of position.

    For series of bounded length. ``size`` is the number of rows.
    """
    keys = list(keys)

    def scored(part: pa.Table) -> pa.Table:
        number, at = numbered([part], keys)[0], part["i"].to_numpy()
        order = np.lexsort((at, number))
        x = matrix(part)[order]
        found = [run(x[a:b]) for a, b in runs(number[order])]
        out = part.select([*keys, "i"]).take(order)
        for name in found[0] if found else ():
            out = out.append_column(name, pa.array(np.concatenate([f[name] for f in found]).astype(float)))
        return out

    return bundled(rows.select(*keys, "i", *FEATURES), keys, size, scored, schema)
