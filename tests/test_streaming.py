"""Mergeable summaries and the flags of a stream."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesguard.operators import sketches
from seriesguard.streaming import scores

DAY = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    made = [("a", p, float(x)) for p in range(4) for x in rng.normal(1e9, 3, 500)]
    made += [("b", p, float(x)) for p in range(3) for x in rng.exponential(2, 50)] + [("c", 0, 5.0), ("d", 0, None), ("e", 0, float("nan"))]
    return spark.createDataFrame(made, "k string, part int, value double")


def test_merged_summaries_equal_one_pass(rows):
    whole = {r["k"]: r for r in sketches.approximate(sketches.summarize(rows, ["k"]), {"q": 0.5}).collect()}
    merged = sketches.merge(sketches.summarize(rows, ["k"], part=["part"]), ["k"])
    values = {k: np.array([r["value"] for r in rows.where(F.col("k") == k).collect()]) for k in "abc"}
    found = {r["k"]: r for r in sketches.approximate(merged, {"q": 0.5}).collect()}
    assert set(found) == set(whole) == set("abc")
    for k, v in values.items():
        for r in (whole[k], found[k]):
            assert (r["n"], r["low"], r["high"]) == (len(v), v.min(), v.max())
            assert np.isclose(r["mean"], v.mean(), rtol=1e-12) and np.isclose(r["sd"], v.std(), rtol=1e-6, atol=1e-9)
            assert abs((v <= r["q"]).mean() - 0.5) <= 0.01 + 1 / len(v)
    fences = {r["k"]: r for r in sketches.thresholds(merged).collect()}
    q1, q3 = np.quantile(values["a"], [0.25, 0.75])
    assert abs(fences["a"]["lower"] - (q1 - 1.5 * (q3 - q1))) < 0.5 and fences["c"]["lower"] == fences["c"]["upper"] == 5.0
    assert sketches.merge(sketches.summarize(rows.limit(0), ["k"]), ["k"]).count() == 0


def folder(spark, path, number, values):
    made = [(k, DAY + datetime.timedelta(minutes=t), v) for k, t, v in values]
    spark.createDataFrame(made, "k string, at timestamp, value double").coalesce(1).write.parquet(f"{path}/{number}")


def test_stream_over_restarts_and_late_rows(spark, tmp_path):
    statistics = spark.createDataFrame([("a", 10.0, 1.0, 8.0, 12.0), ("flat", 3.0, 0.0, 3.0, 3.0)],
                                       "k string, mean double, sd double, lower double, upper double")
    source, nan = str(tmp_path / "in"), float("nan")

    def stream():
        rows = spark.readStream.schema("k string, at timestamp, value double").option("recursiveFileLookup", True).parquet(source)
        return scores.flag_stream(rows, statistics, ["k"])

    def run():
        scores.write_rows(stream(), str(tmp_path / "rows"), str(tmp_path / "s1")).awaitTermination()
        counts = scores.count_stream(stream(), ["k"], "at", "1 hour", "2 hours")
        scores.write_counts(counts, str(tmp_path / "counts"), str(tmp_path / "s2")).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "rows"))
        last = scores.latest_counts(spark.read.parquet(str(tmp_path / "counts")), ["k"])
        return (sorted((r["k"], r["method"], r["value"]) for r in rows.where("is_anomaly").collect()), rows.count(),
                {(r["k"], r["method"], (r["span_start"] - DAY).seconds // 3600): (r["anomaly_count"], r["total"]) for r in last.collect()})

    folder(spark, source, 1, [("a", 0, 10.0), ("a", 5, 20.0), ("a", 70, 12.5), ("flat", 1, 4.0), ("new", 1, 99.0), ("a", 2, None), ("a", 3, nan)])
    flagged, n, counts = run()
    assert flagged == [("a", "iqr", 12.5), ("a", "iqr", 20.0), ("a", "zscore", 20.0), ("flat", "iqr", 4.0)] and n == 14
    assert counts["a", "iqr", 0] == (1, 4) and counts["a", "iqr", 1] == (1, 1) and counts["new", "zscore", 0] == (0, 1)
    folder(spark, source, 2, [("a", 30, 1.0), ("a", 600, 10.0)])
    _, n, counts = run()  # earlier files are not read again
    assert n == 18 and counts["a", "iqr", 0] == (2, 5) and counts["a", "iqr", 10] == (0, 1)
    folder(spark, source, 3, [("a", 31, 1.0), ("a", 590, 1.0)])
    _, n, counts = run()  # the first row comes after the watermark: flagged, but no longer counted
    assert n == 22 and counts["a", "iqr", 0] == (2, 5) and counts["a", "iqr", 9] == (1, 1)
    with pytest.raises(ValueError):
        scores.flag_stream(stream(), statistics, ["k"], methods=["grubbs"])
