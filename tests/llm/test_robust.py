"""Texts and ids that are hard on an operator: long runs, extreme and repeated ids, hot keys."""

import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from seriesguard.llm import ann, common, langid, packing, queries, rules, secrets, sharding, simhash
from seriesguard.llm.tokens import encoder
from test_llm import awkward, empty

DOC = "doc_id long, text string"


@pytest.mark.parametrize("run", [" ", "\t", "\n", "　", " \r\n"])
def test_long_runs_of_white_space(run):
    coder = encoder(queries.tokenizer_path("byte_bpe_50k.json"))
    for text in ("a" + run * 2_000_000 + "b", run * 1_100_000):
        assert coder.ids(text).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_takes_a_run_of_blanks(spark):
    table = spark.createDataFrame([(1, "x" + " " * 2_000_000), (2, "y")], DOC)
    found = packing.pack(table, queries.tokenizer_path("byte_bpe_50k.json")).groupBy("key").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert {r["key"] for r in found} == {1, 2} and all(r["n"] == r["all"] for r in found)


def test_a_hot_key_is_many_ranges(spark):
    table = spark.createDataFrame([(None if i % 2 else 7, f"text {i % 3}") for i in range(40_000)], DOC).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few bytes are one task
    rows = common.in_key_order(table.withColumnRenamed("doc_id", "key")).withColumn("part", F.spark_partition_id())
    sizes = [r["count"] for r in rows.groupBy("part").count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 10_000
    ends = rows.groupBy("part").agg(F.min(F.coalesce("key", F.lit(-1))).alias("a"), F.max(F.coalesce("key", F.lit(-1))).alias("b")) \
        .orderBy("part").collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(x["b"] <= y["a"] for x, y in zip(ends, ends[1:]))


@pytest.mark.parametrize("ids", [[-1 << 63, 0, (1 << 63) - 1], [-(1 << 62) - 5, 1 << 62, None], [None, None],
                                 [*range(60), (1 << 63) - 1], [*range(50), 1 << 40]])
def test_shards_of_any_ids(spark, ids):
    """Ids over the whole range of a long, and one far outlier; splitters checked against plain running sums."""
    rows = [(k, "z" * (n % 17)) for n, k in enumerate(ids * 20)]
    found = sharding.shard_by_bytes(spark.createDataFrame(rows, DOC).repartition(3), 4, range_bytes=200).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    order = sorted(found, key=lambda r: (r.shard, r.slot))
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in order]
    assert keys == sorted(keys)
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    for shard in sizes:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    mean = sum(sizes.values()) / 4
    assert len(sizes) == 4 and all(abs(v - mean) <= 2 * 25 for v in sizes.values())  # a row at each end


def test_keep_one_keeps_a_row_of_every_group(spark):
    words = [f"w{i}" for i in range(400)]
    a, b, c = (" ".join(words[i:i + 100]) for i in (0, 100, 200))
    rows = [(1, a), (1, b), (1, b), (2, b), (3, c), (4, c), (4, "other words that nobody else has at all"), (None, a)]
    found = simhash.keep_one(spark.createDataFrame(rows, DOC)).collect()
    kept = Counter((r.doc_id, r.text) for r in found)
    assert kept == Counter([(1, a), (1, b), (3, c), (4, rows[6][1]), (None, a)])
    unique = [r for r in rows if r[0] in (2, 3)]
    assert Counter(map(tuple, simhash.keep_one(spark.createDataFrame(unique, DOC)).collect())) == Counter(unique)


def test_search_keeps_rows_of_a_repeated_id(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (20, [0.5, 0.5]), (20, [0.25, 0.0])]
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    of = Counter((r.query_id, r.id, r.score) for r in found)
    alone = list(dict.fromkeys((i, tuple(v)) for i, v in rows))  # rows alike in all count once
    want = Counter((i, j, float(np.dot(v, w))) for i, v in alone if i % 20 == 0 for j, w in alone if (i, v) != (j, w))
    assert of == want


def test_windows_select_where_there_is_structure(spark):
    """Over 20 segments a curve: of clustered vectors a query meets a small part on each, of directions without structure most."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 6)) * 8
    shares = {}
    for name, x in (("clustered", centres[np.arange(6000) % 60] + rng.normal(size=(6000, 6))), ("uniform", rng.normal(size=(3000, 64)))):
        report = {}
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        found = ann.search(rows, segment_rows=len(x) // 30, report=report).collect()
        assert report["segments"] >= 21
        scores = x[::20] @ x.T
        scores[np.arange(len(scores)), np.arange(0, len(x), 20)] = -np.inf
        best = np.argsort(-scores, axis=1)[:, :20]
        truth = {(20 * q, int(i)) for q, row in enumerate(best) for i in row}
        assert len(truth & {(r.query_id, r.id) for r in found}) >= 0.9 * len(truth)
        shares[name] = report["share"]
    assert shares["clustered"] < 0.4


def test_secret_patterns_are_linear():
    """Every rule on long runs of what it begins with: four times the text may take no more than about four times as long."""
    import re

    for rule in secrets.RULES:
        for part in ("eyJ", "eyJaaaaaaaaaaaa.", "a", "AKIA", "password", "password ", "token:", "ghp_", "ghp_a", "-----BEGIN ", "A"):
            taken = []
            for n in (40_000, 160_000):
                start = time.process_time()
                for _ in re.finditer(rule.pattern, part * (n // len(part))):
                    pass
                taken.append(time.process_time() - start)
            assert taken[1] < 10 * taken[0] + 0.3, (rule.kind, part)


def test_secret_scan_of_a_long_run(spark):
    text = "eyJ" * 700_000 + " eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0.SflKxwRJSMeKKF2QT4 " + "password" * 200_000
    row = secrets.scan(spark.createDataFrame([(1, text)], DOC)).first()
    start = text.index(" eyJh") + 1
    assert [(s.start, s.end) for s in row.findings["web_token"]] == [(start, text.index(" password"))]


def test_further_kinds_match_plain(spark):
    texts = ["-----BEGIN PRIVATE KEY----- -----BEGIN RSA PRIVATE KEY-----x-----BEGIN  PRIVATE KEY-----",
             "ghp_" + "a1" * 18 + " ghx_" + "a" * 40 + " gho_" + "b" * 35 + " 😀ghs_" + "c" * 50,
             "eyJ0123456789.eyJ0123456789.0123456789 xeyJ0123456789.eyJ0123456789.0123456789 eyJ01234.eyJ0123456789.0123456789"]
    import re

    found = secrets.scan(spark.createDataFrame(list(enumerate(texts)), DOC)).collect()
    for r in found:
        for rule in secrets.MORE:
            want = [m.span() for m in re.finditer(rule.pattern, texts[r.doc_id])]
            assert [(s.start, s.end) for s in r.findings.get(rule.kind) or []] == want
    assert sum(len(r.findings.get(rule.kind) or []) for r in found for rule in secrets.MORE) == 5


def test_language_model_equals_a_plain_one(spark):
    """Document frequencies over all labelled rows, TF-IDF vectors and cosines in plain arithmetic."""
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    rows = docs.collect()
    import re
    import zlib

    learned = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang and re.search(r"[^\W\d_]", r.text or "")]
    found = sum((langid.counts(r.text) > 0).astype(int) for r in learned)
    assert np.allclose(model.idf, np.log((1 + len(learned)) / (1 + found)) + 0.1, rtol=1e-5)
    got = {r.key: r for r in langid.predict(docs, model).collect()}
    for r in rows:
        if not re.search(r"[^\W\d_]", r.text or ""):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        x = np.log1p(langid.counts(r.text).astype(float)) * model.idf
        near = model.centroids.astype(float) @ (x / np.linalg.norm(x))
        assert abs(got[r.doc_id].score - near.max()) < 1e-4
        assert near[[i for i, s in enumerate(model.languages) if s == got[r.doc_id].lang_pred]].max() > near.max() - 1e-4


def test_verdict_column_equals_numpy(spark):
    data = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    stats = rules.document_statistics(docs)
    learned = rules.fit(stats, labels)
    assert learned
    rows = stats.select("key", *[c.alias(f"r_{k}") for k, c in rules.ratios().items()],
                        rules.base_failed().alias("base"), rules.verdict(learned).alias("good")).collect()
    x = np.array([[r[f"r_{k}"] for k in rules.RATIOS] for r in rows], float)
    bad = np.zeros(len(rows), bool)
    for rule in learned:
        bad |= np.all([t.holds(x) for t in rule], axis=0)
    assert [not r.good for r in rows] == bad.tolist()
    kept = {r.doc_id: r.kept for r in queries.op4_decision_list(spark, data).collect()}
    assert kept == {r.key: not r.base and not b for r, b in zip(rows, bad.tolist())}


def test_pipeline_rows_of_awkward_tables(spark, tmp_path):
    """Each stage's rows against what the stage's operator is defined to give."""
    import corpus_pipeline

    for n, table in enumerate((awkward(spark), empty(spark))):
        root = tmp_path / str(n)
        table.write.parquet(str(root / "documents.parquet"))
        spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
        docs = spark.read.parquet(str(root / "documents.parquet"))
        whole = lambda rows: Counter(map(tuple, rows.collect()))
        good = [r for r in docs.collect() if plain.quality_counts(r.text)[0] >= 20
                and 100 * plain.quality_counts(r.text)[4] <= 30 * plain.quality_counts(r.text)[0]]
        after = corpus_pipeline.quality(spark, docs, str(root))
        assert whole(after) == Counter(map(tuple, good))
        once = corpus_pipeline.near_dedup(spark, docs, str(root))
        prints = {i: plain.simhash(r.text) for i, r in enumerate(docs.collect())}
        group = plain.groups(prints) if prints else {}
        rows = docs.collect()
        want = {g: min((rows[i].doc_id for i in prints if group[i] == g and rows[i].doc_id is not None), default=None)
                for g in set(group.values())}
        kept = Counter((r.doc_id, plain.simhash(r.text)) for r in once.collect() if r.doc_id is not None)
        assert sorted(k for k, _ in kept.elements()) == sorted(v for v in want.values() if v is not None)
        assert once.where("doc_id is null").count() == sum(r.doc_id is None for r in rows)
        assert corpus_pipeline.redact(spark, docs, str(root)).count() == len(rows)
        assert whole(corpus_pipeline.mix(spark, docs, str(root))) == whole(docs)
