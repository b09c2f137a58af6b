"""Nearest-neighbour detectors (M2, M3) on the standardised features of a series.

A short series is one bounded group. A long one becomes a tree with at most ``FAN`` children a node, built from a bounded
sample of each node and level by level, so its size sets no limit. A row first searches its own cell; the k-th distance found
there is its reach. It then goes down the tree's boxes, node by node, and gets the list of cells that its reach touches,
nearest first. Rounds visit the next few cells of each list and shrink the reach, until no cell is left inside
it. The result is exact, every group is bounded, and rows in far-apart cells never meet.

Where all cells of a series fit one Arrow call, that call makes the visits, and nothing but scores leaves it. Else rows travel
to the cells they visit. Cells take turns, and rows that still search are taken in slices, so that the lists of cells and what
travels at once, and with them the disk, stay in proportion to the rows however many cells each of them visits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, attach, bundled, cobundled, discard, store, stored_path
from seriesguard.operators.bundles import lists, matrix, numbered, per_series, runs
from seriesguard.operators.features import FEATURES, scaled_features, stored_features

CELL_ROWS = 32_768
#: Children of a node, as a power of two, and rows that a node's cuts are taken from for each child.
FAN_BITS = 10
FAN = 1 << FAN_BITS
SAMPLE_ROWS = 16
#: Cells that a row visits in the first round; each further round visits GROWTH times as many, up to MOST_VISITS.
FIRST_VISITS = 2
GROWTH = 4
MOST_VISITS = 64
QUERY_ROWS = 100_000
#: Rows whose cells are searched in the same turn, and how many turns there are at most.
TURN_ROWS = 1 << 22
MOST_TURNS = 4
#: Visits, or links between neighbours, that always may travel at once; more may if there are more rows, one for each.
SLICE_ROWS = 1 << 24
#: Links, which are narrow, for each row.
LINKS = 4
#: Leaves that go down the tree together, as a power of two.
CHUNK_BITS = 2
#: Rows that are taken as one box, and up to which rows are compared without boxes.
BOX_ROWS = 128
#: A bound on the relative error of a distance's square by products.
ROUNDING = 1e-13
TINY = 1e-10


def nearest(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, point_ids: np.ndarray,
            k: int, reach: np.ndarray | None = None, boxes: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the k nearest points of each query, itself left out, ties by id.

    Points must come sorted by id. Missing neighbours have distance infinity. Points farther than a query's ``reach``
    may be left out. Without ``boxes`` every query meets every point.
    """
    ids = np.full((len(queries), k), -1, np.int64)
    dists = np.full((len(queries), k), np.inf)
    if not len(points):
        return ids, dists
    if reach is None:
        reach = _own_reach(points, k) if queries is points and len(points) > BOX_ROWS else np.full(len(queries), np.inf)
    boxed = boxes and len(points) > BOX_ROWS
    if boxed:
        points, point_ids = _first_copies(points, point_ids, k + 1)
        sets = list(_near_rows(points, BOX_ROWS))
        points, point_ids = points[np.concatenate(sets)], point_ids[np.concatenate(sets)]
        many = np.array([len(rows) for rows in sets])
        first = np.cumsum(many) - many
        lowest, highest = np.minimum.reduceat(points, first), np.maximum.reduceat(points, first)
    square = (points * points).sum(axis=1)
    for rows in _near_rows(queries, BOX_ROWS):
        x, own, limit = queries[rows], query_ids[rows], reach[rows]
        near, held, size = None, points, square
        if boxed and (far := limit.max() * (1.0 + 1e-9)) < np.inf:
            # only boxes, and points in them, that are within reach of the box around these queries
            low, high = x.min(axis=0), x.max(axis=0)
            gap = np.maximum(0.0, np.maximum(low - highest, lowest - high))
            near = np.flatnonzero(np.repeat((gap * gap).sum(axis=1) <= far * far, many))
            held = points[near]
            gap = np.maximum(0.0, np.maximum(low - held, held - high))
            some = (gap * gap).sum(axis=1) <= far * far
            near, held = near[some], held[some]
            if not len(near):
                continue
            size = square[near]
        # squared distances less the query's square by a matrix product, and how far rounding may have moved them
        rough = x @ (-2.0 * held.T)
        rough += size
        mine = (x * x).sum(axis=1)
        error = ROUNDING * (mine + size.max())
        limit = limit * limit * (1.0 + 1e-12) - mine + error
        if len(held) > k and np.isinf(limit).any():
            limit = np.minimum(limit, np.partition(rough, k, axis=1)[:, k] + 2.0 * error)
        row, col = np.nonzero(rough <= limit[:, None])
        if near is not None:
            col = near[col]
        other = own[row] != point_ids[col]
        row, col = row[other], col[other]
        gap = x[row] - points[col]
        exact = np.sqrt((gap * gap).sum(axis=1))
        order = np.lexsort((point_ids[col], exact, row))
        row, col, exact = row[order], col[order], exact[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        some = place < k
        ids[rows[row[some]], place[some]] = point_ids[col[some]]
        dists[rows[row[some]], place[some]] = exact[some]
    return ids, dists


def _near_rows(x: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Row numbers in sets of at most ``size`` rows that are near each other: halves along the widest side."""
    todo = [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            yield rows
            continue
        here, half = x[rows], len(rows) // 2
        order = np.argpartition(here[:, int(np.argmax(here.max(axis=0) - here.min(axis=0)))], half)
        todo += [rows[order[:half]], rows[order[half:]]]


def _own_reach(x: np.ndarray, k: int) -> np.ndarray:
    """Distances that hold k others of the rows: the k-th of those in the same set of near rows."""
    reach = np.full(len(x), np.inf)
    for rows in _near_rows(x, BOX_ROWS):
        if len(rows) > k:
            here = x[rows]
            square = (here * here).sum(axis=1)
            rough = square[:, None] + square[None, :] - 2.0 * (here @ here.T)
            kth = np.partition(rough, k, axis=1)[:, k]  # the row itself is among them
            reach[rows] = np.sqrt(np.maximum(kth, 0.0) + ROUNDING * (square + square.max()))
    return reach


def _first_copies(points: np.ndarray, ids: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The points without those that ``many`` equal points with smaller ids precede."""
    order = np.argsort(points @ np.sqrt(np.arange(2.0, 2.0 + points.shape[1])), kind="stable")
    there = points[order]
    fresh = np.r_[True, (there[1:] != there[:-1]).any(axis=1)]
    every = np.arange(len(order))
    spare = every - np.maximum.accumulate(np.where(fresh, every, 0)) >= many
    if not spare.any():
        return points, ids
    kept = np.sort(order[~spare])
    return points[kept], ids[kept]


def standardise(x: np.ndarray) -> np.ndarray:
    mean, sd = x.mean(axis=0), x.std(axis=0)
    flat = sd <= 1e-12 * np.maximum(1.0, np.abs(mean))
    return (x - mean) / np.where(flat, 1.0, sd)


def local_density_ratio(ids: np.ndarray, dists: np.ndarray) -> np.ndarray:
    """Local outlier factor of rows 0..m-1 from their neighbours (Breunig et al. 2000)."""
    reach = np.maximum(dists[:, -1][ids], dists)
    density = 1.0 / (reach.mean(axis=1) + TINY)
    return density[ids].mean(axis=1) / density


def neighbour_scores(frame: SeriesFrame, window: int = 10, knn: int | None = None,
                     lof: int | None = None, cell_rows: int = CELL_ROWS, call_rows: int = CELL_ROWS) -> DataFrame:
    """Keys, position and the columns ``knn`` (distance to that many-th neighbour) and ``lof``.

    Both come from one neighbour search. ``knn`` and ``lof`` are neighbour counts, None to leave
    the score out; they are lowered to what a short series has. Series of up to ``call_rows`` rows are searched in one call.
    """
    wanted = [name for name, count in (("knn", knn), ("lof", lof)) if count]
    keys, profile = list(frame.keys), frame.profile
    rows = stored_features(frame, window)
    schema = rows.select(*keys, "i").withColumns({name: F.lit(0.0) for name in wanted}).schema
    whole = _whole_series(knn, lof)
    if profile.longest - window <= cell_rows:
        return per_series(rows, keys, profile.total, whole, schema)
    sizes = frame.valid.groupBy(*keys).agg((F.count(F.lit(1)) - window).alias("_m"))
    short = attach(rows, sizes.where(F.col("_m") <= cell_rows).select(*keys), keys, profile.n_series)
    scores = per_series(short, keys, profile.total, whole, schema)
    n_long = profile.series_longer_than(cell_rows)
    long = attach(scaled_features(frame, window), sizes.where(F.col("_m") > cell_rows), keys, n_long)
    if call_rows > cell_rows:
        some = long.where(F.col("_m") <= call_rows)
        scores = scores.unionByName(_cells_in_calls(some, keys, knn, lof, n_long, profile.total, cell_rows, schema))
        long = long.where(F.col("_m") > call_rows)
        if profile.longest - window <= call_rows:
            return scores
    distance = [F.col("dists")[knn - 1].alias("knn")] if knn else []
    found = neighbours(long, keys, max(knn or 0, lof or 0), n_long, profile.total, cell_rows,
                       kept=[*distance, "ids", "dists"] if lof else distance)
    if lof:
        factors = outlier_factors(found, keys, lof, profile.total)
        found = found.select(*keys, "i", "knn").join(factors, [*keys, "i"]) if knn else factors
    return scores.unionByName(found)


def _whole_series(knn: int | None, lof: int | None):
    def run(rows: np.ndarray) -> dict[str, np.ndarray]:
        x = standardise(rows)
        every = np.arange(len(x))
        return _scores(lambda most: nearest(x, every, x, every, most), len(x), knn, lof)

    return run


def _scores(search, rows: int, knn: int | None, lof: int | None) -> dict[str, np.ndarray]:
    """Scores of the rows of one series; ``search`` finds so many neighbours of each, as row numbers and distances."""
    most = min(max(knn or 0, lof or 0), rows - 1)
    if most == 0:
        return {name: np.zeros(rows) for name, count in (("knn", knn), ("lof", lof)) if count}
    ids, dists = search(most)
    out = {}
    if knn:
        out["knn"] = dists[:, min(knn, most) - 1]
    if lof:
        k = min(lof, most)
        out["lof"] = local_density_ratio(ids[:, :k], dists[:, :k])
    return out


def _cells_in_calls(rows: DataFrame, keys: list[str], knn: int | None, lof: int | None, n_series: int, total: int,
                    cell_rows: int, schema) -> DataFrame:
    """Scores of series that one Arrow call holds with all their cells."""
    placed, *_, path = _tree(rows, keys, n_series, total, cell_rows, FAN_BITS)

    def scored(part: pa.Table) -> pa.Table:
        number, at, leaf, chance = numbered([part], keys)[0], *(part[c].to_numpy() for c in ("i", "_leaf", "_chance"))
        order = np.lexsort((at, number))
        x, leaf, chance = matrix(part)[order], leaf[order], chance[order]
        found = [_scores(lambda most: _near_in_cells(x[a:b], leaf[a:b], chance[a:b], cell_rows, most), b - a, knn, lof)  # noqa: B023
                 for a, b in runs(number[order])]
        out = part.select([*keys, "i"]).take(order)
        for name in found[0] if found else ():
            out = out.append_column(name, pa.array(np.concatenate([f[name] for f in found])))
        return out

    scores = store(bundled(placed.select(*keys, "_leaf", _chance().alias("_chance"), "i", *FEATURES), keys, total, scored, schema))
    discard(scores.sparkSession, path)
    return scores


def _near_in_cells(x: np.ndarray, leaf: np.ndarray, chance: np.ndarray, cell_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and distances of the k nearest rows: first in a row's own cell, then in the leaves that its reach touches."""
    every = np.arange(len(x))
    number, rows = np.unique(leaf, return_inverse=True, return_counts=True)[1:]
    part = np.mod(chance, -(-rows // cell_rows)[number])
    ids, dists = np.empty((len(x), k), np.int64), np.empty((len(x), k))
    order = np.lexsort((every, part, number))
    edges = np.flatnonzero((number[order][1:] != number[order][:-1]) | (part[order][1:] != part[order][:-1])) + 1
    for own in np.split(order, edges):
        here = x[own]
        ids[own], dists[own] = nearest(here, own, here, own, k)
    if len(rows) == 1 and len(edges) == 0:
        return ids, dists
    order = np.argsort(number, kind="stable")
    first = np.cumsum(rows) - rows
    low, high = np.minimum.reduceat(x[order], first), np.maximum.reduceat(x[order], first)
    for query, target, _, _ in _near_children(x, dists[:, -1], low, high, rows > k):
        some = np.unique(query)
        if len(some):
            touched = np.zeros(len(rows), bool)
            touched[target] = True
            held = np.flatnonzero(touched[number])
            ids[some], dists[some] = nearest(x[some], some, x[held], held, k, dists[some, -1], boxes=False)
    return ids, dists


def neighbours(rows: DataFrame, keys: list[str], k: int, n_series: int, total: int, cell_rows: int,
               fan_bits: int = FAN_BITS, report: list | None = None, kept: Sequence[str | Column] = ("ids", "dists")) -> DataFrame:
    """Keys, position, ``ids`` and ``dists`` of the k nearest rows, or what ``kept`` makes of them, for series of ``_m`` > k rows.

    ``report`` gets one (rows still searching, cells they visit) for each round.
    """
    spark, cell = rows.sparkSession, [*keys, "_leaf", "_part"]
    stored, sizes, levels, longest, rows_path = _tree(rows, keys, n_series, total, cell_rows, fan_bits)
    parts = F.ceil(F.col("_n") / cell_rows)
    placed = attach(stored, sizes, cell[:-1], 4 * total // cell_rows + n_series).withColumn("_part", F.pmod(_chance(), parts)).drop("_n")
    types = {c: placed.schema[c].dataType.simpleString() for c in [*cell, "i"]}
    types |= {"_node": "bigint", "_reach": "double"} | dict.fromkeys(FEATURES, "double")
    ddl = lambda names, *more: ", ".join([*[f"`{c}` {types[c]}" for c in names], *more])
    found_type = ["ids array<long>", "dists array<double>"]

    def in_cell(part: pa.Table) -> pa.Table:
        number, at = numbered([part], cell)[0], part["i"].to_numpy()
        order = np.lexsort((at, number))
        x, at = matrix(part)[order], at[order]
        ids, dists = np.empty((len(at), k), np.int64), np.empty((len(at), k))
        for a, b in runs(number[order]):
            here = x[a:b]
            ids[a:b], dists[a:b] = nearest(here, at[a:b], here, at[a:b], k)
        many = np.full(len(at), k)
        return part.take(order).append_column("ids", lists(ids.ravel(), many)) \
            .append_column("dists", lists(dists.ravel(), many))

    pending_type = "_pending array<struct<d:double,leaf:bigint,parts:int>>"
    boxes_path = stored_path(spark)
    boxes = store(placed.groupBy(*keys, "_leaf").agg(
        F.array(*[F.min(f) for f in FEATURES]).alias("_low"), F.array(*[F.max(f) for f in FEATURES]).alias("_high"),
        F.count(F.lit(1)).alias("_n"), (F.max("_part") + 1).cast("int").alias("_parts")), boxes_path)

    def still() -> Column:
        """The cells of a row's list that its reach still touches."""
        listed = F.coalesce("_pending", F.array().cast("array<struct<d:double,leaf:bigint,parts:int>>"))
        return F.filter(listed, lambda c: c["d"] < F.col("dists")[k - 1])

    # small leaves with numbers in a row share the boxes
    side, bits = [*keys, "_chunk", "_part"], max(0, int(math.log2(CELL_ROWS / cell_rows)))
    turns = min(MOST_TURNS, math.ceil(max(1, total) / TURN_ROWS))

    def searched(turn: int, path: str) -> DataFrame:
        """Rows of a turn's cells with what they found in their own cell and the cells their reach touches."""
        own = placed.withColumn("_chunk", F.shiftright("_leaf", bits))
        own = own.where(F.pmod(F.xxhash64(*side, F.lit(3)), F.lit(turns)) == turn)
        if levels == 1:
            # the boxes of a series are few enough to come to each of its cells
            nodes = own.select(*side).distinct().join(boxes.withColumnRenamed("_leaf", "_child"), keys)
            state = cobundled(own.select(*cell, "_chunk", "i", *FEATURES), nodes, side, total // turns, first,
                              ddl([*cell, "i", *FEATURES], *found_type, pending_type))
            return store(state.withColumn("_pending", still()), path)
        own_path = stored_path(spark)
        state = store(bundled(own.select(*cell, "i", *FEATURES), cell, total // turns, lambda part: in_cell(part).drop_columns("_bundle"),
                              ddl([*cell, "i", *FEATURES], *found_type)), own_path)
        state = state.join(_descend(state.withColumn("_reach", F.col("dists")[k - 1]), boxes, keys, levels, k, fan_bits, total, ddl),
                           [*keys, "i"], "left")
        state = store(state.select(*cell, "i", *FEATURES, "ids", "dists", still().alias("_pending")), path)
        discard(spark, own_path)
        return state

    def first(part: pa.Table, node: pa.Table) -> pa.Table:
        part = in_cell(part)
        reach = part["dists"].combine_chunks().flatten().to_numpy().reshape(-1, k)[:, -1]
        return _touched(part.append_column("_reach", pa.array(reach)), node, side, k, [*cell, "i", *FEATURES, "ids", "dists"])

    points = placed.select(*cell, "i", *FEATURES)
    group = [*cell, "_group"]

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        mine, theirs = numbered([asked, held], group)
        at = held["i"].to_numpy()
        order = np.lexsort((at, theirs))
        y, at, theirs = matrix(held)[order], at[order], theirs[order]
        order = np.argsort(mine, kind="stable")
        x, own, reach, mine = matrix(asked)[order], asked["i"].to_numpy()[order], asked["_reach"].to_numpy()[order], mine[order]
        hit, ids, dists = np.zeros(len(mine), np.int64), [], []
        for a, b in runs(mine):
            first, last = np.searchsorted(theirs, [mine[a], mine[a] + 1])
            near, far = nearest(x[a:b], own[a:b], y[first:last], at[first:last], k, reach[a:b])
            some = far < np.inf
            hit[a:b] = some.sum(axis=1)
            ids.append(near[some])
            dists.append(far[some])
        some = np.flatnonzero(hit)
        return asked.select([*keys, "i"]).take(order[some]).append_column(
            "ids", lists(np.concatenate([*ids, np.empty(0, np.int64)]), hit[some])).append_column(
            "dists", lists(np.concatenate([*dists, np.empty(0)]), hit[some]))

    at = [*keys, "i"]

    def rounds(state: DataFrame) -> list[DataFrame]:
        """Stored neighbours of the rows of a slice, whose lists of cells are visited to their ends."""
        done, visits, path = [], FIRST_VISITS, None
        while True:
            asked = state.select(*cell, "i", *FEATURES, F.col("dists")[k - 1].alias("_reach"),
                                 F.explode(F.slice("_pending", 1, visits)).alias("_c"))
            # a leaf may have several parts, of which a row has seen its own
            asked = asked.select(*keys, "i", *FEATURES, "_reach", F.col("_leaf").alias("_own"), F.col("_part").alias("_mine"),
                                 F.col("_c.leaf").alias("_leaf"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_c.parts").cast("long") - 1))
                                 .alias("_part")).where((F.col("_own") != F.col("_leaf")) | (F.col("_mine") != F.col("_part")))
            sums = asked.agg(F.count(F.lit(1)).alias("visits")).first()
            if not sums["visits"]:
                done.append(store(state.select(*at, *kept)))
                discard(spark, *([path] if path else []))
                return done
            if report is not None:
                report.append((state.count(), sums["visits"]))
            asked, held = asked.drop("_own", "_mine").withColumn("_group", F.lit(0).cast("long")), points.withColumn("_group", F.lit(0).cast("long"))
            if longest > QUERY_ROWS:
                # popular cells are searched by several groups, each with a copy of the cell
                loads = asked.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("_groups"))
                n_cells = 4 * total // cell_rows + n_series
                asked = attach(asked, loads, cell, n_cells).withColumn("_group", F.pmod(F.xxhash64("i"), F.col("_groups")))
                held = attach(points, loads, cell, n_cells).withColumn(
                    "_group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_groups") - 1)))
            away = cobundled(asked.select(*group, "i", *FEATURES, "_reach"), held.select(*group, "i", *FEATURES), group,
                             max(total, sums["visits"]), search, ddl([*keys, "i"], *found_type))
            # at most as many lists as cells of this round
            pairs = F.flatten(F.collect_list(F.arrays_zip("dists", "ids")))
            merged = away.groupBy(*at).agg(F.slice(F.sort_array(pairs), 1, k).alias("_new"))
            own = F.arrays_zip("dists", "ids")
            best = F.when(F.col("_new").isNull(), own).otherwise(F.slice(F.sort_array(F.concat(own, "_new")), 1, k))
            state = state.join(merged, at, "left").withColumn("_best", best).select(
                *cell, "i", *FEATURES, F.col("_best.ids").alias("ids"), F.col("_best.dists").alias("dists"),
                F.slice("_pending", visits + 1, 1 << 30).alias("_pending"))
            above, path = path, stored_path(spark)
            state = store(state.withColumn("_pending", still()), path)
            discard(spark, *([above] if above else []))
            done.append(store(state.where(F.size("_pending") == 0).select(*at, *kept)))
            state = state.where(F.size("_pending") > 0)
            visits = min(MOST_VISITS, visits * GROWTH)

    done, most = [], max(total, SLICE_ROWS)
    for turn in range(turns):
        path = stored_path(spark)
        start = searched(turn, path)
        done.append(store(start.where(F.size("_pending") == 0).select(*at, *kept)))
        start = start.where(F.size("_pending") > 0)
        visits = F.sum(F.aggregate("_pending", F.lit(0).cast("long"), lambda n, c: n + c["parts"]))
        slices = math.ceil((start.agg(visits).first()[0] or 0) / most)
        for number in range(slices):
            done += rounds(start.where(F.pmod(F.xxhash64("i", F.lit(2)), F.lit(slices)) == number))
        discard(spark, path)
    discard(spark, rows_path, boxes_path)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _tree(rows: DataFrame, keys: list[str], n_series: int, total: int, cell_rows: int,
          fan_bits: int) -> tuple[DataFrame, DataFrame, int, int, str]:
    """Each row with its leaf, the rows of each leaf, the number of levels, the rows of the longest series, and the path of the rows.

    A level cuts every node that is too large into up to 2 ** fan_bits children. Rows that no cut separates, such as
    copies, fill one leaf; its parts keep groups bounded.
    """
    key_types = ", ".join(f"`{key}` {rows.schema[key].dataType.simpleString()}" for key in keys)
    node, levels, largest, longest = [*keys, "_leaf"], 0, None, 0
    rows = rows.select(*keys, "i", *FEATURES, F.lit(0).cast("long").alias("_leaf"), F.col("_m").alias("_n"))

    def build(part: pa.Table) -> pa.Table:
        number = numbered([part], node)[0]
        order = np.argsort(number, kind="stable")
        x, depths = matrix(part)[order], part["_splits"].to_numpy()[order]
        spans = list(runs(number[order]))
        trees = [cuts_of(x[a:b], int(depths[a])) for a, b in spans]
        many = np.array([len(dims) for dims, _ in trees], np.int64)
        every = [np.concatenate([np.empty(0, kind), *(t[j] for t in trees)]) for j, kind in enumerate((np.int32, float))]
        return part.select(node).take(order[[a for a, _ in spans]]).append_column("_dims", lists(every[0], many)) \
            .append_column("_cuts", lists(every[1], many))

    def cuts_of(x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        dims, cuts = np.zeros(2 ** depth - 1, np.int32), np.zeros(2 ** depth - 1)
        inside = {0: np.arange(len(x))}
        for n in range(2 ** depth - 1):
            members = inside.pop(n, np.empty(0, np.int64))
            if len(members):
                here = x[members]
                dims[n] = int(np.argmax(here.max(axis=0) - here.min(axis=0)))
                cuts[n] = float(np.median(here[:, dims[n]]))
                above = here[:, dims[n]] > cuts[n]
                inside[2 * n + 1], inside[2 * n + 2] = members[~above], members[above]
        return dims, cuts

    values = F.array(*FEATURES)

    def step(node, _):
        return 2 * node + 1 + F.when(F.get(values, F.get("_dims", node)) > F.get("_cuts", node), 1).otherwise(0).cast("int")

    most, path = rows.agg(F.max("_n")).first()[0] or 0, None
    while True:
        # a level that separates next to nothing leaves copies only
        if levels and (most <= 4 * cell_rows or most > 0.9 * largest) or levels * fan_bits > 60 - fan_bits:
            break
        largest, longest = most, longest or most
        splits = F.least(F.ceil(F.log2(F.col("_n") / cell_rows)), F.lit(fan_bits)).cast("int")
        rows = rows.withColumn("_splits", F.greatest(splits, F.lit(0)))
        sampled = rows.where((F.col("_splits") > 0) & (
            F.pmod(F.xxhash64("i", F.lit(levels)), F.col("_n")) < SAMPLE_ROWS * F.pow(F.lit(2), F.col("_splits"))))
        trees = bundled(sampled.select(*node, "_splits", *FEATURES), node, total, build,
                        f"{key_types}, _leaf long, _dims array<int>, _cuts array<double>")
        nodes = 2 * total // cell_rows + n_series if levels else n_series
        placed = attach(rows, trees, node, nodes, "left", values=2 << fan_bits)
        leaf = F.aggregate(F.sequence(F.lit(1), F.greatest("_splits", F.lit(1))), F.lit(0), step)
        # children of a node of s splits are its numbers 2 ** s - 1 and up
        child = F.when((F.col("_splits") > 0) & F.col("_dims").isNotNull(), leaf + 1 - F.pow(F.lit(2), F.col("_splits"))).otherwise(0)
        above, path = path, stored_path(placed.sparkSession)
        placed = store(placed.select(*keys, "i", *FEATURES, (F.col("_leaf") * (1 << fan_bits) + child.cast("long")).alias("_leaf")), path)
        discard(placed.sparkSession, *([above] if above else []))
        sizes = placed.groupBy(*node).agg(F.count(F.lit(1)).alias("_n"))
        most = sizes.agg(F.max("_n")).first()[0] or 0
        rows = attach(placed, sizes, node, 4 * total // cell_rows + n_series)
        levels += 1
    return placed, sizes, levels, longest, path


def _chance() -> Column:
    """A number by which rows of a large leaf are dealt to its parts."""
    return F.xxhash64("i", F.lit(1))


def _descend(queries: DataFrame, boxes: DataFrame, keys: list[str], levels: int, k: int, fan_bits: int, total: int, ddl) -> DataFrame:
    """Keys, position and ``_pending``: the leaves (distance of the box, leaf, its parts) that a row's reach touches, nearest first.

    A group holds the rows of some leaves side by side and the boxes of one node's children. Its own leaf is among a row's
    leaves only if it has more parts.
    """
    merged = lambda f, name: F.transform(F.sequence(F.lit(0), F.lit(len(FEATURES) - 1)), lambda j: f(
        F.transform(F.col(name), lambda box: box[j])))

    def children(level: int) -> DataFrame:
        """One row for each child of a level's nodes: its box, row count and parts."""
        shift = fan_bits * (levels - level - 1)
        at = boxes.withColumn("_child", F.shiftright("_leaf", shift))
        if shift:
            at = at.groupBy(*keys, "_child").agg(
                F.collect_list("_low").alias("l"), F.collect_list("_high").alias("h"), F.sum("_n").alias("_n"),
                F.max("_parts").alias("_parts")).select(*keys, "_child", merged(F.array_min, "l").alias("_low"),
                                                        merged(F.array_max, "h").alias("_high"), "_n", "_parts")
        return at.select(*keys, F.shiftright("_child", fan_bits).alias("_node"), "_child", "_low", "_high", "_n", "_parts")

    at, group = [*keys, "i"], [*keys, "_node", "_chunk", "_part"]
    asked = queries.select(*at, *FEATURES, "_reach", "_leaf", "_part").withColumn("_node", F.lit(0).cast("long"))
    def touched(last: bool):
        kept = at if last else [*at, *FEATURES, "_leaf", "_part"]
        return lambda part, node: _touched(part, node, group, k, kept, last)

    for level in range(levels):
        # leaves with numbers in a row lie side by side
        asked = asked.withColumn("_chunk", F.shiftright("_leaf", CHUNK_BITS))
        nodes = children(level).join(asked.select(*group).distinct(), [*keys, "_node"])
        last = level + 1 == levels
        kinds = ddl(at, "_pending array<struct<d:double,leaf:bigint,parts:int>>") if last else ddl(
            [*at, *FEATURES, "_leaf", "_part", "_reach", "_node"])
        asked = cobundled(asked, nodes.select(*group, "_child", "_low", "_high", "_n", "_parts"), group, total, touched(last), kinds)
        if not last:
            asked = store(asked)
    return asked.groupBy(*at).agg(F.sort_array(F.flatten(F.collect_list("_pending"))).alias("_pending"))


def _near_children(x: np.ndarray, reach: np.ndarray, low: np.ndarray, high: np.ndarray,
                  many: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows, children their reach touches, the distances of those boxes and the reach, for some rows at a time."""
    for rows in _near_rows(x, BOX_ROWS):
        here, far = x[rows], reach[rows]
        if many.any() and np.isinf(far).any():  # a box with more than k rows has k neighbours no farther than its farthest corner
            corner = sum(np.maximum(np.abs(here[:, j, None] - low[many, j]), np.abs(here[:, j, None] - high[many, j])) ** 2
                         for j in range(len(FEATURES)))
            far = np.minimum(far, np.nextafter(np.sqrt(corner.min(axis=1)) * (1 + 1e-12), np.inf))
        apart = np.maximum(0.0, np.maximum(low - here.max(axis=0), here.min(axis=0) - high))
        some = np.flatnonzero((apart * apart).sum(axis=1) <= (far.max() * (1.0 + 1e-9)) ** 2)
        gap = np.zeros((len(rows), len(some)))
        for j in range(len(FEATURES)):
            gap += np.maximum(0.0, np.maximum(low[some, j] - here[:, j, None], here[:, j, None] - high[some, j])) ** 2
        gap = np.sqrt(gap)
        query, target = np.nonzero(gap < far[:, None])
        yield rows[query], some[target], gap[query, target], far[query]


def _touched(part: pa.Table, node: pa.Table, group: list[str], k: int, kept: list[str], last: bool = True) -> pa.Table:
    """The rows of ``part`` with the leaves their reach touches, nearest first, or, above the last level, once for each child."""
    mine, theirs = numbered([part, node], group)
    order, kids = np.argsort(mine, kind="stable"), np.argsort(theirs, kind="stable")
    x, reach, mine, theirs = matrix(part)[order], part["_reach"].to_numpy()[order], mine[order], theirs[kids]
    corners = [node[name].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))[kids] for name in ("_low", "_high")]
    child, rows, parts = (node[name].to_numpy()[kids] for name in ("_child", "_n", "_parts"))
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0))]
    for a, b in runs(mine):
        here = slice(*np.searchsorted(theirs, [mine[a], mine[a] + 1]))
        found += [(a + query, here.start + kid, gap, far) for query, kid, gap, far in _near_children(
            x[a:b], reach[a:b], corners[0][here], corners[1][here], rows[here] > k)]
    query, kid, gap, far = (np.concatenate(c) for c in zip(*found))
    if not last:
        return part.select(kept).take(order[query]).append_column("_reach", pa.array(far)).append_column("_node", pa.array(child[kid]))
    # a row's own leaf is listed only if it has more parts
    other = (child[kid] != part["_leaf"].to_numpy()[order][query]) | (parts[kid] > 1)
    query, kid, gap = query[other], kid[other], gap[other]
    nearest_first = np.lexsort((child[kid], gap, query))
    query, kid, gap = query[nearest_first], kid[nearest_first], gap[nearest_first]
    leaves = pa.StructArray.from_arrays([pa.array(gap), pa.array(child[kid]), pa.array(parts[kid], pa.int32())], ["d", "leaf", "parts"])
    return part.select(kept).take(order).append_column("_pending", lists(leaves, np.bincount(query, minlength=len(order))))


def outlier_factors(found: DataFrame, keys: list[str], k: int, total: int) -> DataFrame:
    """Local outlier factor from a neighbour table: three equi-joins on (key, position).

    Links are made for some rows at a time where there are many.
    """
    at = [*keys, "i"]
    slices = max(1, math.ceil(k * total / max(LINKS * total, SLICE_ROWS)))

    def sliced(run) -> DataFrame:
        if slices == 1:
            return run(links)
        path = stored_path(found.sparkSession)
        for turn in range(slices):
            kept = store(run(links.where(F.pmod(F.xxhash64("i", F.lit(2)), F.lit(slices)) == turn)), f"{path}/{turn}")
        return found.sparkSession.read.schema(kept.schema).parquet(*[f"{path}/{turn}" for turn in range(slices)])

    links = found.select(*at, F.explode(F.arrays_zip(
        F.slice("ids", 1, k).alias("j"), F.slice("dists", 1, k).alias("d"))).alias("_l"))
    links = links.select(*at, F.col("_l.j").alias("_j"), F.col("_l.d").alias("_d"))
    reach = found.select(*keys, F.col("i").alias("_j"), F.col("dists")[k - 1].alias("_kd"))
    density = sliced(lambda some: some.join(reach, [*keys, "_j"]).groupBy(*at)
                     .agg((1.0 / (F.avg(F.greatest("_d", "_kd")) + TINY)).alias("_density")))
    theirs = density.select(*keys, F.col("i").alias("_j"), F.col("_density").alias("_theirs"))
    around = sliced(lambda some: some.join(theirs, [*keys, "_j"]).groupBy(*at).agg(F.avg("_theirs").alias("_around")))
    return around.join(density, at).select(*at, (F.col("_around") / F.col("_density")).alias("lof"))
