import math

import doubles
import numpy as np
import pandas as pd
import pytest

from seriesguard.frame import HOT_BUCKET_BLOCKS, series_frame
from seriesguard.functions.student_t import upper_tail
from seriesguard.operators import stats
from seriesguard.operators.grubbs import grubbs_flags
from seriesguard.operators.statistical import flag_columns, seasonal_parts
from seriesguard.operators.windows import ema_frame
from seriesguard.plans.registry import detect

METHODS = {"zscore": doubles.zscore, "modified_zscore": doubles.modified_zscore, "iqr": doubles.iqr,
           "moving_average": doubles.moving_average, "ema": doubles.ema_flags, "seasonal": doubles.seasonal}


def edge_series():
    rng = np.random.default_rng(5)
    made = {f"n{n}": rng.normal(10, 3, n).round(2) for n in (1, 2, 3, 9, 10, 11, 47, 48, 200)}
    made["constant"] = np.full(120, 0.1)
    made["heavy"] = rng.standard_t(1.5, 300).round(3)
    made["twins"] = np.r_[rng.normal(0, 1, 60).round(2), 50.0, 50.0, -50.0]
    wave = np.sin(np.arange(240) * 2 * np.pi / 24) * 5
    wave[100] += 30
    made["wave"] = wave + rng.normal(0, 0.2, 240)
    return made


@pytest.fixture(scope="module")
def series():
    return edge_series()


@pytest.fixture(scope="module")
def table(spark, series):
    rows = [(k, j // 2, j, float(x)) for k, v in series.items() for j, x in enumerate(v)]
    # equal times in pairs, told apart by the tie-breaker; rows in no order
    frame = pd.DataFrame(rows, columns=["k", "t", "tie", "x"]).sample(frac=1, random_state=1)
    return spark.createDataFrame(frame).repartition(5).cache()


@pytest.mark.parametrize("block_rows", [None, 32])
def test_methods_match_numpy_for_any_block_size(table, series, block_rows):
    frame = series_frame(table, ["k"], ["t", "tie"], "x", block_rows)
    got = flag_columns(frame, list(METHODS), indexed=True).toPandas()
    assert len(got) == sum(map(len, series.values()))
    for k, part in got.groupby("k"):
        part = part.sort_values("i")
        assert (part["tie"].to_numpy() == np.arange(len(part))).all()
        for name, double in METHODS.items():
            assert (part[name].to_numpy() == double(series[k])).all(), (k, name)


def test_constant_series_flags_nothing(table):
    frame = series_frame(table.where("k = 'constant'"), ["k"], ["t", "tie"], "x")
    found = detect(frame, [*METHODS, "grubbs", "ensemble"])
    assert found.where("is_anomaly and method <> 'iqr'").count() == 0


@pytest.mark.parametrize("block_rows,tail", [(None, 1000), (32, 4)])
def test_grubbs_matches_the_direct_loop(table, series, block_rows, tail):
    frame = series_frame(table, ["k"], ["t", "tie"], "x", block_rows)
    got = {(r["k"], r["i"]) for r in grubbs_flags(frame, first_tail=tail).collect()}
    assert got == {(k, int(i)) for k, v in series.items() for i in np.flatnonzero(doubles.grubbs(v))}
    assert len([g for g in got if g[0] == "twins"]) == 2


def test_grubbs_with_many_outliers_sorts_once(spark, monkeypatch):
    """Dozens of removals from either end, equal outliers, slices of a few ranks: the rows are ranked in one go."""
    from seriesguard.operators import grubbs

    rng, made = np.random.default_rng(6), {}
    for key, far in (("both", 40), ("up", 25), ("none", 0)):
        v = rng.normal(size=900)
        v[rng.choice(900, far, replace=False)] = rng.choice([-1, 1] if key == "both" else [1], far) * np.exp(rng.uniform(3, 9, far))
        made[key] = v
    at = rng.choice(900, 12, replace=False)
    made["equal"] = rng.normal(size=900)
    made["equal"][at] = np.repeat([1e4, -300.0, 50.0], 4)
    table = spark.createDataFrame([(k, t, float(x)) for k, v in made.items() for t, x in enumerate(v)], "k string, t long, x double")
    calls, ranked = [], grubbs._ranked
    monkeypatch.setattr(grubbs, "_ranked", lambda *a: calls.append(1) or ranked(*a))
    monkeypatch.setattr(grubbs, "MAX_TAIL", 12)
    for block_rows in (None, 64):
        frame = series_frame(table, ["k"], ["t"], "x", block_rows)
        got = {(r["k"], r["i"]) for r in grubbs_flags(frame, first_tail=3).collect()}
        assert got == {(k, int(i)) for k, v in made.items() for i in np.flatnonzero(doubles.grubbs(v))}
    assert len(calls) == 2


def test_times_bunched_in_one_bucket_are_still_ordered(spark):
    n = 40 * HOT_BUCKET_BLOCKS
    rows = pd.DataFrame({"k": "a", "t": np.r_[np.zeros(n), 1e6].astype(int), "tie": np.arange(n + 1), "x": 1.0})
    shuffled = spark.createDataFrame(rows.sample(frac=1, random_state=2))
    got = series_frame(shuffled, ["k"], ["t", "tie"], "x", 16).indexed.toPandas()
    assert (got.sort_values("i")["tie"].to_numpy() == np.arange(n + 1)).all()
    assert (np.sort(got["i"].to_numpy()) == np.arange(n + 1)).all()


def test_missing_values_are_kept_unflagged_and_do_not_count(spark):
    rows = [("a", j, float(x)) for j, x in enumerate([1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 90])]
    rows += [("a", 50, None), ("a", 51, math.nan), ("empty", 1, None)]
    frame = series_frame(spark.createDataFrame(rows, "k string, t long, x double"), ["k"], ["t"], "x")
    got = detect(frame, ["zscore", "ensemble"]).toPandas()
    assert len(got) == 2 * len(rows)
    assert set(got[got["is_anomaly"] & (got["method"] == "zscore")]["t"]) == {12}


def test_ema_of_a_long_span(table, series):
    got = ema_frame(series_frame(table, ["k"], ["t", "tie"], "x", 64), 30).toPandas()
    for k, part in got.groupby("k"):
        assert np.allclose(part.sort_values("i")["ema"], doubles.ema(series[k], 30), atol=1e-11)


@pytest.mark.parametrize("period", [7, 24])
def test_seasonal_residual(table, series, period):
    got = seasonal_parts(series_frame(table, ["k"], ["t", "tie"], "x", 64), period).toPandas()
    for k, part in got.groupby("k"):
        if len(part) >= 2 * period:
            assert np.allclose(part.sort_values("i")["resid"], doubles.seasonal_residual(series[k], period), atol=1e-8)


@pytest.mark.parametrize("map_rows", [10, 10_000])
def test_quantiles_are_exact_on_both_paths(table, series, map_rows):
    wanted = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q9": 0.9, "q10": 1.0}
    got = stats.quantiles(table, ["k"], "x", wanted, 300, len(series), map_rows=map_rows).toPandas().set_index("k")
    for k, v in series.items():
        assert np.allclose(got.loc[k], np.quantile(v, list(wanted.values()))), k


def test_bracketed_quantiles_of_a_long_series(spark):
    rows = spark.range(400_000).selectExpr("'a' AS k", "pow(pmod(id * 7919, 400009), 1.5) AS x", "id")
    rows = rows.unionByName(spark.range(100_000).selectExpr("'a' AS k", "77.0D AS x", "id"))
    wanted = {"q1": 0.25, "q2": 0.5, "q9": 0.999}
    got = stats.quantiles(rows, ["k"], "x", wanted, 500_000, 1, map_rows=10).drop("k").first()
    assert np.allclose(got, np.quantile(rows.toPandas()["x"], list(wanted.values())), rtol=1e-14)


def test_affine_change_keeps_flags(table):
    frame = series_frame(table, ["k"], ["t", "tie"], "x")
    moved = series_frame(table.selectExpr("k", "t", "tie", "x * 8 + 64 AS x"), ["k"], ["t", "tie"], "x")
    names = ["zscore", "modified_zscore", "iqr"]
    keep = ["k", "tie", *names]
    first, second = (flag_columns(f, names).select(*keep).where("k <> 'constant'").toPandas().sort_values(["k", "tie"])
                     for f in (frame, moved))
    assert (first.to_numpy() == second.to_numpy()).all()


def test_t_tail_against_tables():
    for df, t, p in ((1, 12.7062047, 0.025), (10, 2.2281389, 0.025), (100, 3.3904913, 0.0005), (8, 3.8325187, 0.0025)):
        assert math.isclose(upper_tail(t, df), p, rel_tol=1e-6)
    assert math.isclose(upper_tail(5.0, 99_999), upper_tail(5.0, 100_001), rel_tol=1e-4)
