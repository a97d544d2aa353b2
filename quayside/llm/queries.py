"""Registered queries of this package and their SQL where it can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    chat,
    collocations,
    decontaminate,
    divergence,
    jaccard,
    langid,
    neighbours,
    oracles,
    pieces,
    quality,
    repeats,
    secret_scan,
    sharding,
    simhash,
)
from quayside.llm.common import fold_number


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = decontaminate.decontaminate(docs, items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat.rotate(_table(spark, sf_dir, "conversations"))
    return found.withColumn("mask", _spans("mask"))


def _spans(column: str):
    """start-end, comma-joined."""
    return F.array_join(F.transform(column, lambda m: F.concat_ws("-", m["start"], m["end"])), ",")


#: Rows of this fold are held out from learning.
HELD_OUT = 1


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.learn(docs, labels.filter(fold_number() != HELD_OUT))
    return quality.score(docs, model).select(
        "doc_id",
        (fold_number() == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.filter(fold_number() != HELD_OUT))
    return langid.predict(docs.drop("lang"), model).select(
        "doc_id",
        (fold_number() == HELD_OUT).alias("held_out"),
        "lang_pred",
        "score",
        F.transform("mixture", lambda m: m["lang"]).alias("languages"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copy_id", "n_links", "shingles")


def op7_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "size",
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: Where the files of public tokenizers are, on the driver.
TOKENIZERS = os.environ.get("TOKENIZERS", "/opt/tokenizers")
PIECE_MODEL = "piece_bpe_32k.model"


def op8_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load(os.path.join(TOKENIZERS, PIECE_MODEL))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(docs, vocabulary, and_decode=True)
    return found.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op9_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(rows, F.col("vec_id") % 50 == 0, k=5)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [
        F.size(F.filter("base", _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.encode(secret_scan.listed(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_perspective_rotation": op2_perspective_rotation,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_language_id": op4_language_id,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_sampled_splitters": op7_sampled_splitters,
    "op8_suffix_array_pieces": op8_suffix_array_pieces,
    "op9_hash_prefix_forest": op9_hash_prefix_forest,
    "op10_secret_scan": op10_secret_scan,
    "op11_source_divergence": op11_source_divergence,
    "op12_collocations": op12_collocations,
    "op13_simhash": op13_simhash,
}

# Learning, sampling and merges are tested against brute force instead.
ORACLES = {
    "op1_decontaminate": oracles.DECONTAMINATE,
    "op2_perspective_rotation": oracles.PERSPECTIVES,
    "op5_substring_dedup": oracles.REPEATS,
    "op10_secret_scan": oracles.SECRETS,
    "op11_source_divergence": oracles.DIVERGENCE,
    "op12_collocations": oracles.COLLOCATIONS,
}
