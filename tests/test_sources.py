import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesguard.frame import series_frame, shared_dir
from seriesguard.operators import report, stats
from seriesguard.operators.features import FEATURES, features
from seriesguard.operators.resample import resample
from seriesguard.operators.select import first_series, kpis, one_series, services
from seriesguard.plans.pipeline import analyze, metric_frame, run_detection
from seriesguard.plans.registry import detect, detect_wide, normalize
from seriesguard.sources import csv, sinks, store

# The two demo series.
SVC_A = [100, 101, 99, 102, 98, 250, 100.5, 99.5, 101.2, 98.8, 97.9, 300, 100.1, 99.7, 102.3, 97.5, 96.9, 101.8, 98.4, 99]
SVC_B = [200, 198.5, 205, 199, 202, 400, 201.5, 199.5, 203.2, 198.8, 197.9, 450, 200.1, 199.7, 202.3, 197.5, 196.9, 201.8, 198.4, 199]
START = 1_703_550_000
BED = "demo-cloudbed-2025-12-28"


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("metrics")
    layouts = [("svcA", "cpu_usage", SVC_A, "timestamp,value,cmdb_id,kpi_name"),
               ("svcB", "latency", SVC_B, "timestamp,cmdb_id,kpi_name,value")]
    folder = root / BED / "metric" / "service"
    folder.mkdir(parents=True)
    for service, kpi, values, header in layouts:
        lines = [header]
        for j, v in enumerate(values):
            cells = {"timestamp": START + 300 * j, "value": v, "cmdb_id": service, "kpi_name": kpi}
            lines.append(",".join(str(cells[c]) for c in header.split(",")))
        (folder / f"{service}.csv").write_text("\n".join(lines) + "\n")
    other = root / "other cloudbed+2" / "metric" / "custom"
    other.mkdir(parents=True)
    (other / "a.csv").write_text("kpi_name,extra,value,cmdb_id,timestamp\nlatency,x,7.5,svcB,1703550000\n")
    return root


@pytest.fixture(scope="module")
def demo(spark, root):
    return metric_frame(csv.load_cloudbed(spark, str(root), BED).cache())


def test_columns_are_matched_by_name(spark, root):
    rows = csv.read_metrics(spark, str(root), categories=None)
    got = {(r["cloudbed"], r["category"], r["cmdb_id"], r["kpi_name"]): r["n"] for r in rows.groupBy(
        "cloudbed", "category", "cmdb_id", "kpi_name").agg(F.count("value").alias("n")).collect()}
    assert got == {(BED, "service", "svcA", "cpu_usage"): 20, (BED, "service", "svcB", "latency"): 20,
                   ("other cloudbed+2", "custom", "svcB", "latency"): 1}
    assert csv.load_all_cloudbeds(spark, str(root)).count() == 40
    assert csv.load_all_cloudbeds(spark, str(root), "2024").count() == 0
    assert csv.load_metric_category(spark, str(root / BED), "service").count() == 40
    stated = csv.read_metrics(spark, str(root / "other cloudbed+2"), categories=None,
                              header="kpi_name,extra,value,cmdb_id,timestamp").first()
    assert (stated["value"], stated["timestamp"].timestamp() % 300) == (7.5, 0)


def test_files_without_a_needed_column(spark, tmp_path):
    folder = tmp_path / "cloudbed9" / "metric" / "node"
    folder.mkdir(parents=True)
    (folder / "bad.csv").write_text("timestamp,value\n1,2\n")
    assert csv.load_cloudbed(spark, str(tmp_path), "cloudbed9").count() == 0
    with pytest.raises(ValueError, match="lack"):
        csv.load_job_input(spark, str(tmp_path))
    with pytest.raises(ValueError, match="missing"):
        csv.require_columns(spark.range(1))


def test_rows_that_are_no_numbers(spark, tmp_path):
    folder = tmp_path / "cloudbed[9]" / "metric" / "node"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text('\ufefftimestamp,"value",cmdb_id,kpi_name\r\n1,oops,"a, b",k\r\nbad,2,a,k\r\n\r\n3\r\n4,5,a,k,more\r\n')
    (folder / "b.csv").write_text("value,kpi_name,cmdb_id,timestamp\n")
    rows = csv.load_cloudbed(spark, str(tmp_path), "cloudbed[9]").orderBy("timestamp").collect()
    assert [(r["timestamp"].timestamp(), r["cmdb_id"], r["value"]) for r in rows] == [(1, "a, b", None), (3, None, None), (4, "a", 5)]
    assert tuple(csv.count_bad_rows(spark, str(tmp_path)).first()) == ("cloudbed[9]", "node", 4, 1, 2)
    assert csv.load_cloudbed(spark, str(tmp_path), "nowhere").count() == 0


def test_golden_flags(demo):
    spikes = {1_703_551_500, 1_703_553_300}
    expected = {"zscore": {1_703_553_300}, "modified_zscore": spikes, "iqr": spikes, "moving_average": set(),
                "ema": {1_703_553_300}, "ensemble_stat": {1_703_553_300}, "grubbs": spikes,
                "seasonal": {1_703_553_300}, "autoencoder": {START + 13 * 300}, "knn": {START + 11 * 300}}
    found = detect(demo, list(expected)).where("is_anomaly").select(
        "cmdb_id", "method", F.unix_seconds("timestamp").alias("at")).collect()
    for service in ("svcA", "svcB"):
        for method, at in expected.items():
            assert {r["at"] for r in found if (r["cmdb_id"], r["method"]) == (service, method)} == at, (service, method)


def test_golden_statistics(demo):
    got = {r["cmdb_id"]: r for r in stats.median_mad(demo).join(stats.fences(demo), list(demo.keys))
           .join(stats.moments(demo), list(demo.keys)).collect()}
    for service, want in (("svcA", (117.18, 53.21785038875584, 99.85, 1.4, 98.7, 101.35)),
                          ("svcB", (222.555, 67.97217427006437, 199.85, 1.8, 198.725, 202.075))):
        row = got[service]
        assert np.allclose([row[c] for c in ("mean", "sd", "med", "mad", "q1", "q3")], want)
    first = features(demo).where("i = 10 and cmdb_id = 'svcA'").first()
    assert np.allclose([first[f] for f in FEATURES],
                       [97.9, 115, 45.01486421, 98, 250, 100.25, -0.9, -17.1, 98.8, 101.2, 250])


def test_selection(demo):
    assert {r[0] for r in services(demo.rows).collect()} == {"svcA", "svcB"}
    assert [r[0] for r in kpis(demo.rows, "svcB").collect()] == ["latency"]
    assert first_series(demo.rows).first().asDict() == {"cmdb_id": "svcA", "kpi_name": "cpu_usage"}
    assert [r["value"] for r in one_series(demo, cmdb_id="svcB", kpi_name="latency").collect()] == SVC_B


def test_store_round_trip_and_pruning(spark, root, tmp_path):
    path = str(tmp_path / "store")
    store.ingest_cloudbed(spark, str(root), BED, path)
    start, end = (START + 300) * 1000, (START + 900) * 1000
    rows = store.read_store(spark, path, "svcA", "cpu_usage", start, end)
    assert [r["value"] for r in rows.orderBy("timestamp").collect()] == SVC_A[1:4]
    assert store.read_store(spark, path, "svcA", end_ms=0).count() == 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = store.read_store(spark, path, "svcA", "cpu_usage", start, end)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(device_bucket" in plan
    for pushed in ("EqualTo(device,svcA)", "EqualTo(measurement,cpu_usage)", "GreaterThanOrEqual(timestamp", "LessThanOrEqual(timestamp"):
        assert pushed in plan[plan.index("PushedFilters"):]


def test_store_is_merged(spark, tmp_path, monkeypatch):
    """Later rows win, other rows and buckets stay, names are told apart by their raw form, many series are few files."""
    monkeypatch.setattr(store, "BUCKET_ROWS", 200)
    path, kind = str(tmp_path / "merged"), "cmdb_id string, kpi_name string, timestamp timestamp, value double"

    def rows(values):
        return spark.createDataFrame([(d, k, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=t), float(v))
                                      for (d, k, t), v in values.items()], kind)

    held = {(f"d{i}", f"k{j}", t): i + j + t for i in range(40) for j in range(10) for t in range(5)}
    held |= {("a/b", "k", 1): 1, ("a_b", "k", 1): 2, (None, "k", 1): 3}
    store.write_store(rows(held), path, mode="append")  # the first write makes the store
    folders = sorted(p.name for p in (tmp_path / "merged" / "buckets=16").iterdir() if p.is_dir())
    assert 10 < len(folders) <= 16
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "merged").rglob("*.parquet")}
    assert len(before) < 100

    def back(**where):
        found = store.read_store(spark, path, **where).collect()
        out = {(r["device_name"], r["measurement_name"], r["timestamp"].second): r["value"] for r in found}
        assert len(out) == len(found)
        return out

    assert back() == held
    new = {("d3", "k1", 2): -1, ("d3", "k1", 9): -2, ("a_b", "k", 1): -3, (None, "k", 1): -4}
    store.write_store(rows(new), path, mode="append")
    held |= new
    assert back() == held
    same = [p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]]
    assert len({p.parent for p in same}) >= len(folders) - 3  # buckets without new rows were left alone
    assert back(device="d3") == {k: v for k, v in held.items() if k[0] == "d3"}
    assert back(device="a/b") == {k: v for k, v in held.items() if k[0] in ("a/b", "a_b")}
    store.write_store(rows({}), path, mode="append")
    assert back() == held
    store.write_store(rows(new), path)
    assert back() == new
    with pytest.raises(ValueError):
        store.write_store(rows(new), path, mode="ignore")


def test_job_writes_rows_and_counts(spark, root, tmp_path):
    run_detection(spark, str(root), str(tmp_path), ["iqr", "ensemble"], partition_by=("method", "cmdb_id"))
    counts = {(r["cloudbed"], r["cmdb_id"], r["method"]): (int(r["anomaly_count"]), int(r["total"])) for r in
              spark.read.option("header", True).csv(str(tmp_path / "counts")).collect()}
    assert counts[BED, "svcA", "iqr"] == (2, 20) and counts[BED, "svcB", "ensemble_stat"] == (1, 20)
    assert counts["other cloudbed+2", "svcB", "iqr"] == (0, 1)
    assert (tmp_path / "detections" / "method=iqr" / "cmdb_id=svcA").exists()


def test_analysis_and_reports(spark, demo, tmp_path):
    found = analyze(demo, ["zscore", "iqr"], compare=True)
    summary = {(r["cmdb_id"], r["method"]): r for r in found["summary"].collect()}
    row, normal = summary["svcA", "zscore"], [v for v in SVC_A if v != 300]
    assert (row["total_points"], row["anomaly_count"], row["anomaly_mean"], row["anomaly_std"]) == (20, 1, 300.0, None)
    assert math.isclose(row["normal_mean"], np.mean(normal)) and math.isclose(row["normal_std"], np.std(normal, ddof=1))
    text = found["summary_text"].where("cmdb_id = 'svcA' and method = 'zscore'").first()["report"]
    assert "Anomaly rate: 5.00%" in text and text.endswith("  Std: nan")
    bins = found["histogram"].where("cmdb_id = 'svcA' and method = 'zscore' and not is_anomaly").orderBy("bin").collect()
    assert [b["points"] for b in bins] == np.histogram(normal, 50)[0].tolist()
    box = found["box_plot"].where("cmdb_id = 'svcA' and method = 'zscore' and not is_anomaly").first()
    assert math.isclose(box["median"], np.median(normal)) and box["outliers"] == 1
    assert found["comparison"].count() == 4 and found["anomalies"].count() == 6
    grid = found["matrix"].where("cmdb_id = 'svcA'").agg(F.sum("zscore"), F.sum("iqr")).first()
    assert tuple(grid) == (1, 2)
    overlay = report.overlay(detect_wide(demo, ["zscore", "iqr"]), demo.keys, "timestamp", "value", {"cmdb_id": "svcB"}, ["zscore", "iqr"])
    assert [r["value"] for r in overlay.collect()] == SVC_B
    assert {r["cmdb_id"] for r in analyze(demo, ["iqr"], key="first")["detections"].collect()} == {"svcA"}
    sinks.write_summary_text(found["summary_text"], str(tmp_path / "text"), demo.keys)
    back = spark.read.json(str(tmp_path / "text"))
    assert back.count() == 4 and (tmp_path / "text" / "method=zscore").exists()
    assert back.where("cmdb_id = 'svcA' and method = 'zscore'").first()["report"] == text


def test_far_off_time_makes_no_huge_grid(spark):
    rows = spark.createDataFrame([("a", 0, 1.0), ("a", 1_700_000_000, 2.0), ("a", 1_700_000_001, 4.0)], "k string, s long, x double")
    frame = series_frame(rows.withColumn("t", F.timestamp_seconds("s")).drop("s"), ["k"], ["t"], "x")
    found = resample(frame, 1).where("t >= timestamp_seconds(1700000000)")
    mean = frame.value
    assert [r[mean] for r in found.orderBy("t").collect()] == [2.0, 4.0]
    assert [r[mean] for r in resample(frame, 600_000_000).orderBy("t").collect()] == [1.0, None, 3.0]


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    class Elsewhere:
        conf = spark.conf

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    class Conf:
        @staticmethod
        def get(name, default=None):
            return default

    Elsewhere.conf = Conf
    with pytest.raises(ValueError):
        shared_dir(Elsewhere)


def test_method_names_and_votes(spark):
    assert normalize(["ensemble", "knn", "zscore", "ensemble_stat"]) == ["zscore", "knn", "ensemble_stat"]
    rows = spark.createDataFrame([("a", j, float(v)) for j, v in enumerate(SVC_A)], "k string, t long, x double")
    frame = series_frame(rows, ["k"], ["t"], "x")
    for bad in (lambda: detect(frame, ["nope"]), lambda: detect(frame, ["zscore"], {"zscore": {"x": 1}}),
                lambda: detect(frame, ["ensemble"], {"ensemble": {"methods": ["seasonal"]}}),
                lambda: detect(frame, ["knn"], {"knn": {"k": 1}}), lambda: detect(frame, ["iqr"], {"nope": {}})):
        with pytest.raises(ValueError):
            bad()
    # own parameters do not reach the vote; a listed non-voter raises the bar
    params = {"zscore": {"threshold": 1.0}, "ensemble": {"methods": ["zscore", "iqr", "grubbs", "seasonal"]}}
    got = detect(frame, ["zscore", "ensemble"], params).where("is_anomaly").groupBy("method").count()
    assert {r["method"]: r["count"] for r in got.collect()} == {"zscore": 2, "ensemble_stat": 1}


def test_paths_are_taken_apart_once_for_each_file(spark, tmp_path):
    folder = tmp_path / "2024-cloudbed1" / "metric" / "jvm"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("timestamp,value,cmdb_id,kpi_name\n1,2.5,s,k\n")
    rows = csv.load_metric_category(spark, str(tmp_path / "2024-cloudbed1"), "jvm")
    assert "url_decode" not in rows._jdf.queryExecution().toString()
    assert [(r["cloudbed"], r["category"], r["cmdb_id"], r["value"]) for r in rows.collect()] == [("2024-cloudbed1", "jvm", "s", 2.5)]
