"""Registered queries of this package and their SQL."""

from __future__ import annotations

import pathlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, forest, langid, mixing, negatives, packing, phrases, repair, rules, secrets, sharding, simhash


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held))
    return langid.predict(docs, model).select(
        F.col("key").alias("doc_id"), langid.held_out(F.col("key")).alias("held_out"), "lang_pred", "score", "rejected")


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.BASE]
    spans = lambda kind: F.coalesce(F.col("findings")[kind], F.array().cast(secrets.FOUND))
    count = lambda kind: F.size(spans(kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in base],
                        F.sha2(secrets.listed(F.col("findings"), base), 256).alias("base_sha256"),
                        secrets.listed(F.col("findings"), [r.kind for r in secrets.RULES]).alias("spans"))


def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select(F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept")


def op5_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))
    return found.select(F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                        "sequence_id", "offset")


def op6_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    return found.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_anchor_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("key").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op8_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat.preference_pairs(chat.regenerated_pairs(table(spark, sf_dir, "conversations")))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(c)
    return found.select("pair_id", F.col("part").cast("int").alias("part"), "prompt_turns", "prompt", "chosen", "rejected",
                        listed("chosen_mask"), listed("rejected_mask"))


def op9_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = repair.write(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))
    return repair.read_documents(spark, path).withColumnRenamed("key", "doc_id")


def op11_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return negatives.mine(rows)


def op12_era_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                        F.col("key").eqNullSafe(F.col("component")).alias("kept"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = str(pathlib.Path(__file__).resolve().parents[2])
    if top not in sys.path:
        sys.path.insert(0, top)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    found = [op1_pfair_mixing, op2_language_id, op3_secret_ledger, op4_decision_list, op5_window_packing,
             op6_histogram_sort, op7_anchor_simhash, op8_preference_chat, op9_hilbert_ann, op10_repair_ids,
             op11_kronecker_negatives, op12_era_phrases, op13_lsh_forest, pipeline]
    return {f.__name__: f for f in found}


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor, a.lab AS anchor_lab, v.id, v.lab, list_inner_product(a.c, v.c)::BIGINT AS s
  FROM v AS a JOIN v ON a.id <> v.id WHERE a.id % 100 = 0),
p AS (
  SELECT anchor, anchor_lab, id, s FROM s WHERE lab = anchor_lab
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY s DESC, id) <= 5)
SELECT p.anchor AS anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.s DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.s AS positive_score, s.s AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND s.lab <> p.anchor_lab AND 80 * p.s <= 100 * s.s AND s.s <= p.s
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.s DESC, s.id) <= 5
"""


PHRASES_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, t
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS t FROM documents)),
w AS (
  SELECT lang, list_filter(string_split_regex(t, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, greatest(len(ws) - k + 2, 1)),
                                        lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) AS sizes(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
parts AS (
  SELECT lang, phrase, a, 1 AS cut, ws[1] AS lp, array_to_string(ws[2:3], ' ') AS rp FROM c UNION ALL
  SELECT lang, phrase, a, 2, array_to_string(ws[1:2], ' '), ws[3] FROM c WHERE k = 3),
often AS MATERIALIZED (SELECT lang, phrase, f FROM f WHERE f >= 10),
cuts AS (
  SELECT p.*, l.f AS l, r.f AS r,
         (1000000 * p.a::HUGEINT * p.a::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
  FROM parts AS p JOIN often AS l ON l.lang = p.lang AND l.phrase = p.lp
  JOIN often AS r ON r.lang = p.lang AND r.phrase = p.rp),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM c WHERE k = 3)
  GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, s.a DESC, phrase) AS rank, phrase,
       s.a, s.l, s.r, n.n::BIGINT AS n, s.score::BIGINT AS score
FROM scored AS s JOIN n USING (lang) LEFT JOIN longer AS x USING (lang, phrase)
WHERE x.a IS NULL OR 100 * x.a < 50 * s.a
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, s.a DESC, phrase) <= 2000
"""


FOREST_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 1 THEN ws ELSE list_transform(
         range(1, greatest(len(ws), 1)), lambda i: ws[i] || ' ' || ws[i + 1]) END)) AS s FROM w),
classes AS MATERIALIZED (SELECT min(doc_id) AS c, s, len(s) AS n, list(doc_id) AS ids FROM sets WHERE len(s) > 0 GROUP BY s),
items AS MATERIALIZED (SELECT c, n, unnest(s) AS item FROM classes),
links AS MATERIALIZED (
  SELECT a.c AS a, b.c AS b FROM items AS a JOIN items AS b
  ON a.item = b.item AND a.c <> b.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT c, c AS root FROM classes UNION
  SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.c WHERE links.b > reach.root),
firsts AS (SELECT c, min(root) AS root FROM reach GROUP BY c)
SELECT sets.doc_id, len(sets.s) AS n_shingles, coalesce(f.root, sets.doc_id) AS component_id,
       sets.doc_id = coalesce(f.root, sets.doc_id) AS kept
FROM sets LEFT JOIN (SELECT unnest(ids) AS doc_id, root FROM classes JOIN firsts USING (c)) AS f USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_kronecker_negatives": NEGATIVES_SQL, "op12_era_phrases": PHRASES_SQL,
            "op13_lsh_forest": FOREST_SQL}
