"""A corpus pipeline of the operators for training data.

Five stages, each of which works on all rows that the one before kept: language identification,
near-duplicate removal, benchmark decontamination, secret removal and encoding. Clean documents
stay. Texts that are null or have no letter are rejected by the first stage. Rows with a null id take part in all.
Further columns, whatever their names, keep their values; only the last stage replaces columns that are
called like those it adds.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayside.llm import arrays, decontaminate, jaccard, langid, pieces, queries, secret_scan  # noqa: E402
from quayside.llm.common import (  # noqa: E402
    BROADCAST_ROWS,
    bits_for,
    free_names,
    hash_bits,
    lookup,
    prepare,
    stored,
)

#: Documents go whose main language has less than this share of their words.
LEAST_SHARE = 1 / 3


def _packed(docs: DataFrame) -> DataFrame:
    """The text, and all other columns in one, so that none can clash with what an operator adds."""
    return docs.select(F.struct(*(_column(c) for c in docs.columns if c != "text")).alias("row"), "text")


def _unpacked(columns: list[str]) -> list[Column]:
    return [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns]


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or without a main language; lang becomes what was found.

    If nothing could be learned, as all languages are null, every document with a letter stays as it is.
    """
    model = langid.learn(docs.select("lang", "text"))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(_packed(docs), model).filter(
        (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SHARE)
    )
    kept = found.select(*_unpacked([c for c in docs.columns if c != "lang"]), F.col("lang_pred").alias("lang"))
    return kept.select(*(_column(c) for c in docs.columns))


def _named(docs: DataFrame, rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The documents without, and those with, an id and a text that ``rows(id, hash)`` name.

    Few rows are broadcast. Of many, hash bits of their texts are, so that only documents that may be among them
    are shuffled for the join and the texts of all others stay where they are.
    """
    key, mark, maybe = free_names(docs.columns, "id", "hash", "maybe")
    rows = stored(rows.select(F.col("id").alias(key), F.col("hash").alias(mark)).distinct(), label)
    same = [F.col("doc_id").cast("long").eqNullSafe(F.col(key)), F.xxhash64("text") == F.col(mark)]
    count = rows.count()
    if count <= BROADCAST_ROWS:
        few = F.broadcast(rows)
        return docs.join(few, same, "left_anti"), docs.join(few, same, "left_semi")
    spark, bits = docs.sparkSession, bits_for(count)
    prepare(spark)
    shared = spark.sparkContext.broadcast(hash_bits(rows, mark, bits))

    @F.pandas_udf("boolean")
    def among(hashes: pd.Series) -> pd.Series:
        return pd.Series(arrays.Bits(shared.value, bits).has(hashes.to_numpy().view(arrays.U64)))

    marked = docs.withColumn(maybe, among(F.xxhash64("text")))
    others, some = marked.filter(~F.col(maybe)).drop(maybe), marked.filter(F.col(maybe)).drop(maybe)
    return others.unionByName(some.join(rows, same, "left_anti")), some.join(rows, same, "left_semi")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: that with the least id, of equal ids the least hash of the text.

    Null ids come last. Texts without a word are in no class; of those with the same id one stays.
    """
    # Ids may be null or stand for several texts, so documents are compared by hashes of id and text, and of the text.
    own = F.xxhash64(F.lit(1), "doc_id", "text")
    names = docs.select(
        own.alias("own"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash")
    ).distinct()
    found = stored(jaccard.near_duplicates(docs.select(own.alias("doc_id"), "text")), "near-duplicates")
    crowded = found.groupBy("class_id").agg(F.count("*").alias("n")).filter("n > 1").select("class_id")
    members = (
        found.join(lookup(crowded, "crowded"), "class_id", "left_semi")
        .groupBy(F.col("doc_id").alias("own"), "text_hash", "class_id")
        .agg(F.count("*").alias("n"), F.max("shingles").alias("shingles"))
    )
    members = members.join(names, ["own", "text_hash"]).filter("id is not null or shingles > 0")
    place = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("text_hash").alias("hash"))
    members = stored(members.select("class_id", "n", place.alias("place")), "members")
    first = members.groupBy("class_id").agg(F.min("place").alias("first"))
    losers = members.join(lookup(first, "first"), "class_id").filter("place <> first")
    kept, _ = _named(docs, losers.select("place.id", "place.hash"), "losers")
    # Of rows with the same id and text one stays. Only such rows are shuffled.
    once, repeated = _named(kept, members.filter("n > 1").select("place.id", "place.hash"), "repeated")
    return once.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs.select("doc_id", "text"), items).filter("n_hit > 0")
    clean, _ = _named(docs, found.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")), "contaminated")
    return clean


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in texts by a mark; every document stays."""
    clean = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast("long"))
    return clean.select(*(_column(c) for c in docs.columns))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their pieces, checked by decoding them again."""
    vocabulary = pieces.load(os.path.join(queries.TOKENIZERS, queries.PIECE_MODEL))
    docs = docs.drop("ids", "n_pieces", "round_trip")
    found = pieces.encode(_packed(docs), vocabulary, and_decode=True)
    # The mark of a space is the only character that decoding does not give back.
    same = F.col("decoded") == F.replace("text", F.lit(pieces.MARK), F.lit(" "))
    added = [F.col("ids"), F.size("ids").cast("long").alias("n_pieces"), same.alias("round_trip")]
    return found.select(*_unpacked(docs.columns), *added)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", keep_languages),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# Expectation-maximisation and the merges of a vocabulary are not for SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are written and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
