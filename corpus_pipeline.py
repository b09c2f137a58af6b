"""A corpus pipeline of five stages. Each stage gets what the one before it kept, written as Parquet and read again.

Quality rules and near-dedup drop rows, the secret scan rewrites texts, mixing lays the rows out in the mixture's order
(sorted files), packing cuts that order into token sequences. All stages but the last return the columns of documents.

Defined results: null texts and texts without words fail the quality rules; empty tables give empty results; rows with
null ids go through near-dedup as they are; columns besides those of documents are carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesguard.llm import mixing, packing, rules, secrets, simhash
from seriesguard.llm.common import fresh_path
from seriesguard.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_mixed_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in the order of the files that mixing wrote."""
    place = F.struct(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("file"),
                     F.col("_metadata.file_name").alias("name"), F.col("_metadata.row_index").alias("row"))
    rows = docs.select(F.struct("doc_id", place.alias("place")).alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"), place.alias("place"))
    rows = rows.repartitionByRange("place").sortWithinPartitions("place").drop("place")
    found = packing.pack_sorted(rows, tokenizer_path("byte_bpe_50k.json"))
    return found.select(F.col("key.doc_id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                        "doc_tokens", "sequence_id", "offset", "padded_to", "ids")


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("secret_scan", redact),
          ("source_mixing", mix), ("packing", pack)]

#: Learned rules, link components and byte-pair encoding are not SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(docs, name)
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
