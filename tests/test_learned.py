import pathlib

import doubles
import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest

from seriesguard.frame import series_frame, shared_dir
from seriesguard.operators import neighbors
from seriesguard.operators.features import FEATURES, features, scaled_features, stored_features
from seriesguard.operators.grubbs import grubbs_flags
from seriesguard.operators.hbos import hbos_scores
from seriesguard.operators.iforest import iforest_scores
from seriesguard.operators.neighbors import _near_in_cells, nearest, neighbour_scores, neighbours
from seriesguard.operators.ocsvm import boundary_distance, gram, ocsvm_scores
from seriesguard.operators.pca import pca_scores
from seriesguard.plans.registry import LEARNED, detect


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(8)
    made = {"short": rng.normal(size=11), "none": rng.normal(size=10), "mid": rng.exponential(5, 90),
            "long": rng.normal(size=700).cumsum() + rng.standard_t(2, 700)}
    made["steps"] = np.repeat(rng.normal(size=8), 60)
    return made


@pytest.fixture(scope="module")
def frame(spark, series):
    rows = [(k, j, float(x)) for k, v in series.items() for j, x in enumerate(v)]
    table = spark.createDataFrame(pd.DataFrame(rows, columns=["k", "t", "x"])).cache()
    return series_frame(table, ["k"], ["t"], "x", 128).stored


def parts(rows):
    return {k: part.sort_values("i") for k, part in rows.toPandas().groupby("k")}


def test_features_and_scaling(frame, series):
    raw, scaled = parts(features(frame)), parts(scaled_features(frame))
    assert "none" not in raw
    for k, part in raw.items():
        expected = doubles.features(series[k])
        assert part["i"].min() == 10
        assert np.allclose(part[list(FEATURES)], expected, atol=1e-9)
        assert np.allclose(scaled[k][list(FEATURES)], doubles.scaled(expected), atol=1e-7)
    with pytest.raises(ValueError):
        features(frame, 4)


def test_histogram_and_component_scores(frame, series):
    for k, part in parts(hbos_scores(frame)).items():
        if k != "steps":
            assert np.allclose(part["score"], doubles.hbos_scores(series[k]), atol=1e-7), k
    for k, part in parts(pca_scores(frame)).items():
        assert np.allclose(part["score"], doubles.pca_scores(series[k]), atol=1e-8), k


def test_forest_is_the_same_split_or_whole(frame):
    whole, split = parts(iforest_scores(frame)), parts(iforest_scores(frame, local_rows=100, chunk_rows=150))
    assert whole.keys() == split.keys()
    for k in whole:
        assert np.allclose(whole[k]["score"], split[k]["score"])
        assert whole[k]["score"].between(0, 1).all()


@pytest.mark.parametrize("cell_rows", [5_000, 64])
def test_neighbours_match_brute_force(frame, series, cell_rows):
    for k, part in parts(neighbour_scores(frame, knn=5, lof=20, cell_rows=cell_rows)).items():
        if k == "short":
            assert (part[["knn", "lof"]] == 0).all(axis=None)
            continue
        knn, lof = doubles.neighbour_scores(series[k])
        assert np.allclose(part["knn"], knn, atol=1e-9), k
        if k != "steps":  # copies tie, and ties may be broken either way
            assert np.allclose(part["lof"], lof, atol=1e-8), k


@pytest.mark.parametrize("made", ["spread", "copies"])
def test_cells_of_a_series_are_searched_in_one_call(made):
    """Small cells and leaves with parts find what brute force finds; copies may be named in another order."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, len(FEATURES)))
    if made == "copies":
        x = np.round(x[rng.integers(0, 40, 300)])
    leaf = (x[:, 0] > 0) * 2 + (x[:, 1] > 0.5)
    ids, dists = _near_in_cells(x, leaf.astype(np.int64), rng.integers(-2**60, 2**60, 300), 20, 7)
    every = np.arange(300)
    want, far = nearest(x, every, x, every, 7)
    assert np.allclose(dists, far, rtol=1e-12, atol=1e-12)
    assert np.allclose(np.sqrt(((x[ids] - x[:, None]) ** 2).sum(axis=2)), far, atol=1e-9) and (ids != every[:, None]).all()
    assert made == "copies" or np.array_equal(ids, want)


def test_small_cells_leave_only_scores_on_disk(spark):
    """Where one call holds a series, what is written stays near the size of its features, and no shuffle files stay."""
    rng = np.random.default_rng(6)
    rows = pd.DataFrame({"k": np.repeat(np.arange(300), 60), "t": np.tile(np.arange(60), 300), "x": rng.normal(size=18_000)})
    frame = series_frame(spark.createDataFrame(rows), ["k"], ["t"], "x").stored
    features_of = written(spark, lambda: stored_features(frame))
    scores = written(spark, lambda: neighbour_scores(frame, lof=20, cell_rows=12).collect())
    assert 0 < scores < features_of


def written(spark, run):
    """Bytes below the shared folder that a run leaves there."""
    def size():
        return sum(f.stat().st_size for f in pathlib.Path(shared_dir(spark).removeprefix("file:")).rglob("*.parquet"))

    before = size()
    run()
    return size() - before


@pytest.mark.parametrize("fan_bits, cell_rows, shape", [(10, 32, "spread"), (2, 16, "spread"), (1, 8, "tied"), (3, 20, "far"), (2, 8, "one")])
def test_tree_descent_is_exact(spark, fan_bits, cell_rows, shape):
    """Several levels, leaves with parts, tiny leaves, an outlier, two series of unlike size."""
    rng = np.random.default_rng(fan_bits)
    made = {}
    for key, n in (("a", 400), ("b", 90)):
        x = rng.normal(size=(n, 11)) * rng.exponential(1, 11)
        if shape == "tied":
            x = np.round(x)
            x[: n // 2] = x[0]
        elif shape == "far":
            x[:3] += 1e6
        elif shape == "one":
            x[:, 1:] = 0
        made[key] = x
    rows = pd.DataFrame([(key, i + 10, len(x), *v) for key, x in made.items() for i, v in enumerate(x)], columns=["k", "i", "_m", *FEATURES])
    report = []
    found = neighbours(spark.createDataFrame(rows), ["k"], 7, 2, len(rows), cell_rows, fan_bits, report).toPandas()
    assert len(found) == len(rows) and report
    for key, x in made.items():
        at = np.arange(len(x)) + 10
        ids, dists = nearest(x, at, x, at, 7)
        part = found[found.k == key].sort_values("i")
        got = np.stack(part["dists"])
        assert part["i"].tolist() == at.tolist() and np.allclose(got, dists, rtol=1e-12, atol=1e-12)
        if shape in ("spread", "far"):
            assert np.array_equal(np.stack(part["ids"]), ids)
        else:  # ties may be broken either way, but the rows named are as far as stated
            named = x[np.stack(part["ids"]) - 10]
            assert np.allclose(np.sqrt(((named - x[:, None]) ** 2).sum(axis=2)), got, atol=1e-9)


@pytest.mark.parametrize("fan_bits", [10, 2])
def test_visits_travel_in_slices(spark, monkeypatch, fan_bits):
    """However many cells rows visit, about one visit for each row travels at once, and states are not left on disk."""
    monkeypatch.setattr(neighbors, "TURN_ROWS", 60)
    monkeypatch.setattr(neighbors, "SLICE_ROWS", 220)
    x = np.random.default_rng(4).normal(size=(96, len(FEATURES)))
    rows = pd.DataFrame([("a", i, len(x), *v) for i, v in enumerate(x)], columns=["k", "i", "_m", *FEATURES])
    report, found = [], []
    left = written(spark, lambda: found.append(neighbours(spark.createDataFrame(rows), ["k"], 7, 1, len(rows), 16, fan_bits, report)))
    part = found[0].toPandas().sort_values("i")
    ids, dists = nearest(x, np.arange(96), x, np.arange(96), 7)
    assert np.array_equal(np.stack(part["ids"]), ids) and np.allclose(np.stack(part["dists"]), dists, rtol=1e-12)
    assert sum(visits for _, visits in report) > 400 and max(visits for _, visits in report) < 300
    tables = [t for t in stored_tables(spark, found[0]) if {"value", "_pending"} & set(t.column_names)]
    assert left > 0 and not tables


def stored_tables(spark, df):
    return [pq.read_table(f.removeprefix("file:").removeprefix("//")) for f in df.inputFiles()]


def test_long_series_in_turns_match_brute_force(frame, series, monkeypatch):
    monkeypatch.setattr(neighbors, "TURN_ROWS", 800)
    monkeypatch.setattr(neighbors, "SLICE_ROWS", 9_000)
    for k, part in parts(neighbour_scores(frame, knn=5, lof=20, cell_rows=64, call_rows=0)).items():
        if k in ("mid", "long"):
            knn, lof = doubles.neighbour_scores(series[k])
            assert np.allclose(part["knn"], knn, atol=1e-9) and np.allclose(part["lof"], lof, atol=1e-8), k


def test_boundary_is_optimal():
    x = np.random.default_rng(3).normal(size=(150, 11))
    value, kernel = boundary_distance(x, 0.2), gram(x, "rbf")
    outside, on = value < 0, value == 0
    assert outside.sum() <= 0.2 * 150 <= (outside | on).sum()
    # with full weight outside and the right weights on the boundary the field is reproduced
    free = np.linalg.lstsq(np.vstack([kernel[np.ix_(on, on)] - kernel[on][0:1, on], np.ones(on.sum())]),
                           np.r_[kernel[on][0:1, outside].sum() - kernel[np.ix_(on, outside)].sum(axis=1),
                                 0.2 * 150 - outside.sum()], rcond=None)[0]
    assert free.min() > -1e-4 and free.max() < 1 + 1e-4


@pytest.mark.parametrize("kernel", ["rbf", "sigmoid"])
def test_boundary_in_chunks_equals_the_one_of_a_group(frame, kernel):
    whole, split = (parts(ocsvm_scores(frame, kernel=kernel, group_rows=rows)) for rows in (None, 50))
    assert set(whole) == set(split)
    for k, part in whole.items():
        assert np.allclose(part["score"], split[k]["score"], atol=1e-5 * max(1.0, part["score"].abs().max())), k


def test_boundary_is_smooth_where_landmarks_begin_to_stand_for_rows(spark):
    flags = []
    for m in (400, 402):  # the first 400 rows are alike; the landmarks are 400
        values = np.random.default_rng(8).normal(size=430)[:m + 10]
        table = spark.createDataFrame([("a", j, float(v)) for j, v in enumerate(values)], "k string, t long, x double")
        part = parts(ocsvm_scores(series_frame(table, ["k"], ["t"], "x"), landmarks=400))["a"]
        flags.append((part["score"] > 0).to_numpy()[:400])
        assert 0.03 < flags[-1].mean() <= 0.11
    assert (flags[0] != flags[1]).sum() <= 8


def test_few_landmarks_flag_about_nu(frame):
    got = parts(ocsvm_scores(frame, landmarks=120))
    assert set(got) == {"short", "mid", "long", "steps"}
    assert 0.04 < (got["long"]["score"] > 0).mean() < 0.18


def test_detection_by_learned_methods(frame, series):
    found = detect(frame, [*LEARNED, "ensemble_ml"]).toPandas()
    assert len(found) == 7 * sum(map(len, series.values()))
    hits = found[found["is_anomaly"]]
    assert hits["t"].min() >= 10 and "none" not in set(hits["k"])
    per = hits.groupby(["method", "k"]).size()
    for method in ("isolation_forest", "lof", "knn", "hbos"):
        for k, v in series.items():
            assert per.get((method, k), 0) <= 0.1 * (len(v) - 10) + 1
    wide = found.pivot(index=["k", "t"], columns="method", values="is_anomaly")
    votes = wide[["isolation_forest", "lof", "knn"]].sum(axis=1)
    assert (wide["ensemble_ml"] == (votes >= 1.5)).all()


def test_many_small_series_share_a_call(spark):
    from seriesguard.operators.bundles import per_series

    rng = np.random.default_rng(3)
    made = pd.DataFrame([(None if key == 7 else key, i, *rng.normal(size=len(FEATURES))) for key in range(300) for i in range(3)],
                        columns=["k", "i", *FEATURES]).astype({"k": "Int64"})
    rows = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in made.astype(object).to_numpy().tolist()],
                                 "k long, i long, " + ", ".join(f"{f} double" for f in FEATURES))

    def run(x):
        return {"score": np.full(len(x), x.sum())}

    scored = per_series(rows, ["k"], len(made), run, "k long, i long, score double")
    assert "FlatMapGroupsInArrow" in scored._jdf.queryExecution().toString()
    bundles = scored.sparkSession.sparkContext.defaultParallelism * 8
    assert scored.count() == len(made) and bundles < 300
    got = {(r["k"], r["i"]): r["score"] for r in scored.collect()}
    for key, part in made.groupby("k", dropna=False):
        key = None if pd.isna(key) else key
        assert all(np.isclose(got[key, i], part[list(FEATURES)].to_numpy().sum()) for i in range(3))


def test_boxes_inside_a_cell_are_exact():
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(700, 3)).round(1), np.repeat(rng.normal(size=(2, 3)), 200, axis=0)])
    at = rng.permutation(5000)[:len(x)]
    x, at = x[np.argsort(at)], np.sort(at)
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(far, np.inf)
    ids, dists = nearest(x, at, x, at, 6)
    for row, apart in enumerate(far):
        order = np.lexsort((at, apart))[:6]
        assert (ids[row] == at[order]).all() and np.array_equal(dists[row], apart[order])
    near, within = nearest(x[:50], at[:50], x, at, 6, reach=dists[:50, 2])
    assert (near[:, :3] == ids[:50, :3]).all() and np.array_equal(within[:, :3], dists[:50, :3])


@pytest.mark.parametrize("scores", [iforest_scores, ocsvm_scores, lambda f: neighbour_scores(f, knn=5, lof=7), grubbs_flags])
def test_short_series_do_not_take_a_call_each(frame, scores):
    plan = scores(frame)._jdf.queryExecution().toString()
    assert "FlatMapGroupsInArrow" in plan and "FlatMapGroupsInPandas" not in plan


def test_rows_a_task_gets_are_bounded(spark, monkeypatch):
    from seriesguard import frame as frames

    made = pd.DataFrame([(k, t, float((k * 7 + t * t) % 31)) for k in range(60) for t in range(20)], columns=["k", "t", "x"])
    frame_of = lambda: series_frame(spark.createDataFrame(made), ["k"], ["t"], "x")
    want = sorted(map(tuple, detect(frame_of(), ["ensemble", "zscore"]).collect()))
    monkeypatch.setattr(frames, "TASK_ROWS", 50)
    assert frame_of().indexed.rdd.getNumPartitions() == 24
    assert sorted(map(tuple, detect(frame_of(), ["ensemble", "zscore"]).collect())) == want


def test_bars_are_laid_out_after_the_join(frame):
    from seriesguard.operators.report import histogram

    plan = histogram(detect(frame, ["zscore"]), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join")
