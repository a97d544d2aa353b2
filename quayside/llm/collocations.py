"""Phrase collocations, mined by partitioning after Savasere, Omiecinski and Navathe (SON).

Documents are dealt to shards by the hash of their text. A phrase that occurs s times in a language occurs
in some shard at least s n_i / n times, n_i being the share of the shard in the n words of the language;
so that number, rounded up, is the support that a phrase needs in a shard.

1. Each shard is mined completely, words first, then phrases of two to four words whose two parts, the
   phrase without its last and without its first word, are frequent in some shard.
2. Phrases that are frequent in any shard are united, for each length, as hashes.
3. All their occurrences are counted over all documents, by their words; what is below s goes.

A shard is no task: all tasks mine all shards, with counts by (language, shard, phrase hash) that are
added up before and after the shuffle. Their number stays fixed, since the support in a shard falls with it;
with more than s shards everything would be frequent. Hashes only find candidates, equal ones do no harm; the
table of them that tasks read has 2**28 bits at most, and passes more phrases when it is full.

A candidate's score compares it with its parts l and r at the worst cut. A candidate inside a
longer one that occurs nearly as often says nothing of its own and goes.

A null language is ``und`` and takes part in that one, a null text has no words. Every row counts, repeated ones as well;
ids and other columns are not looked at. An empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import arrays
from quayside.llm.common import bits_for, hash_bits, prepare, stored

SUPPORT = 30
LONGEST = 4
SHARDS = 6
REPORTED = 2000
#: A phrase is dropped for a longer one around it with this share of its occurrences.
ABSORBED_PERCENT = 80
SCORE_UNIT = 2_000_000

#: Characters that end a piece, and all that end a word.
BREAK = arrays.byte_class(".,;:!?\x0a\x0b\x0c\x0d")
IN_WORD = ~(BREAK | arrays.byte_class(" \t"))
#: Texts of a slice are counted together. No phrase goes beyond a piece, so longer texts are cut between pieces.
SLICE_BYTES = 2 << 20


class Phrases:
    """Words of the texts of a slice, and how many words each has until its piece ends, itself included."""

    def __init__(self, texts: arrays.Texts, group: np.ndarray):
        self.words = words = arrays.Words(texts, IN_WORD, lower=True)
        count = len(words)
        breaks = np.flatnonzero(BREAK[texts.bytes])
        ends = np.ones(count, dtype=bool)
        ends[:-1] = np.searchsorted(breaks, words.end[:-1]) != np.searchsorted(breaks, words.start[1:])
        ends[words.first[1:][np.diff(words.first) > 0] - 1] = True
        stop = np.flatnonzero(ends)
        self.left = stop[np.searchsorted(stop, np.arange(count))] + 1 - np.arange(count)
        self.row = np.repeat(np.arange(len(texts)), np.diff(words.first))
        # Phrases of different languages have different hashes.
        self.of_group = arrays.mixed(group.view(arrays.U64))[self.row]
        self.runs = arrays.Runs(words.hash)

    def keys(self, start: np.ndarray, size: int, runs: arrays.Runs | None = None) -> np.ndarray:
        return arrays.mixed((runs or self.runs).of(start, start + size) ^ self.of_group[start])

    def likely(self, size: int, shorter: arrays.Bits | None) -> np.ndarray:
        """Places of phrases of that size whose two parts, a word shorter, are among the known ones."""
        start = np.flatnonzero(self.left >= size)
        if shorter is not None:
            start = start[shorter.has(self.keys(start, size - 1))]
            start = start[shorter.has(self.keys(start + 1, size - 1))]
        return start


def _parts(batches: Iterator[pa.RecordBatch], *columns: str):
    """Texts of a slice, long ones cut where pieces end, and the values of columns for each."""
    for batch, texts in arrays.slices(batches, "text", SLICE_BYTES):
        values = [batch.column(c).to_numpy() for c in columns]
        for part, of in arrays.parts(texts, SLICE_BYTES, BREAK):
            yield part, *(own[of] for own in values)


MINED_SCHEMA = "lang_key long, shard int, phrase long, n long"
COUNTED_SCHEMA = "lang_key long, phrase string, n long"


def _mined(size: int, shared, n_bits: int):
    """Phrases of a size counted by language and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shorter = arrays.Bits(shared.value, n_bits) if shared is not None else None
        for texts, group, shard in _parts(batches, "lang_key", "shard"):
            found = Phrases(texts, group)
            start = found.likely(size, shorter)
            key, of_shard = found.keys(start, size), shard[found.row[start]]
            order = np.lexsort((key, of_shard))
            key, of_shard = key[order], of_shard[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (of_shard[1:] != of_shard[:-1])
            first = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group[found.row[start[order[first]]]]),
                    pa.array(of_shard[first]),
                    pa.array(arrays.signed(key[first])),
                    pa.array(np.diff(np.append(first, len(key)))),
                ],
                ["lang_key", "shard", "phrase", "n"],
            )

    return run


def _counted(shared, n_bits: list[int]):
    """Occurrences of candidates of all sizes, by their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [arrays.Bits(words, bits) for words, bits in zip(shared.value, n_bits)]
        for texts, group in _parts(batches, "lang_key"):
            found = Phrases(texts, group)
            second = arrays.Runs(found.words.hash, seed=1)
            data, begin, end = arrays.spaced(found.words)
            view = memoryview(data.tobytes())
            for size, bits in enumerate(known, 1):
                start = np.flatnonzero(found.left >= size)
                key = found.keys(start, size)
                start, key = start[bits.has(key)], key[bits.has(key)]
                check = found.keys(start, size, second)
                order = np.argsort(key, kind="stable")
                key, check, start = key[order], check[order], start[order]
                # Phrases that share a hash are told apart by the second one.
                new = np.ones(len(key), dtype=bool)
                new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
                first = np.flatnonzero(new)
                at = start[first]
                phrases = [
                    bytes(view[a:b]) for a, b in zip(begin[at].tolist(), end[at + size - 1].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group[found.row[at]]),
                        pa.array(phrases, pa.binary()).cast(pa.string()),
                        pa.array(np.diff(np.append(first, len(key)))),
                    ],
                    ["lang_key", "phrase", "n"],
                )

    return run


def _exact_quotient(dividend: str, divisor: str) -> str:
    return f"({dividend}) div cast({divisor} as decimal(28, 0))"


def frequent_phrases(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS
) -> tuple[DataFrame, DataFrame]:
    """lang, size, phrase and n of all phrases of 1 to ``longest`` words with at least ``support`` occurrences,
    and the words and the support of each language (as lang_key, its hash) and shard."""
    spark = docs.sparkSession
    prepare(spark)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    docs = docs.select(
        lang.alias("lang"),
        F.xxhash64(lang).alias("lang_key"),
        F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int").alias("shard"),
        F.col("text").cast("string").alias("text"),
    )
    shared, n_bits, tables, needed = None, 0, [], None
    for size in range(1, longest + 1):
        local = (
            docs.select("lang_key", "shard", "text")
            .mapInArrow(_mined(size, shared, n_bits), MINED_SCHEMA)
            .groupBy("lang_key", "shard", "phrase")
            .agg(F.sum("n").alias("n"))
        )
        if needed is None:
            local = stored(local, "words")
            needed = stored(_local_support(local, support), "support")
        phrases = stored(
            local.join(needed, ["lang_key", "shard"]).filter("n >= least").select("phrase").distinct(), "phrases"
        )
        n_bits = bits_for(phrases.count())
        tables.append((hash_bits(phrases, "phrase", n_bits), n_bits))
        shared = spark.sparkContext.broadcast(tables[-1][0])
    known = spark.sparkContext.broadcast([words for words, _ in tables])
    counts = (
        docs.select("lang_key", "text")
        .mapInArrow(_counted(known, [bits for _, bits in tables]), COUNTED_SCHEMA)
        .groupBy("lang_key", "phrase")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= support)
    )
    # Words have no space, so the spaces of a phrase tell their number.
    size = (F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1).alias("size")
    names = docs.select("lang_key", "lang").distinct()
    return counts.join(names, "lang_key").select("lang", size, "phrase", "n"), needed


def _local_support(words: DataFrame, support: int) -> DataFrame:
    """The least count that makes a phrase frequent in a shard: support * n_i / n, rounded up."""
    each = words.groupBy("lang_key", "shard").agg(F.sum("n").alias("own"))
    every = each.groupBy("lang_key").agg(F.sum("own").alias("total"))
    share = _exact_quotient(f"{support} * cast(own as decimal(28, 0)) + total - 1", "total")
    return each.join(every, "lang_key").select("lang_key", "shard", "total", F.expr(share).alias("least"))


def _rated(counts: DataFrame) -> DataFrame:
    """Candidates of two words or more with the parts of their lowest-scoring cut."""
    candidates = counts.filter("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("head"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("tail"),
    )
    part = counts.select("lang", F.col("phrase"), "n")
    score = _exact_quotient(f"{SCORE_UNIT} * cast(a as decimal(28, 0))", "l + r")
    return (
        cuts.join(part.toDF("lang", "head", "l"), ["lang", "head"])
        .join(part.toDF("lang", "tail", "r"), ["lang", "tail"])
        .groupBy("lang", "size", "phrase", "a")
        .agg(F.min(F.struct(F.expr(score).alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "size", "phrase", "a", "cut.score", "cut.l", "cut.r")
    )


def _absorbed(counts: DataFrame) -> DataFrame:
    """The greatest count of a longer candidate around each shorter one."""
    words = F.split("phrase", " ", -1)
    longer = counts.filter("size > 2").select("lang", "n", "size", words.alias("words"))
    parts = longer.select(
        "lang",
        "n",
        F.explode(
            F.expr(
                """flatten(transform(sequence(2, size - 1), m ->
                    transform(sequence(1, size - m + 1), i -> array_join(slice(words, i, m), ' '))))"""
            )
        ).alias("phrase"),
    )
    return parts.groupBy("lang", "phrase").agg(F.max("n").alias("around"))


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    shards: int = SHARDS,
    reported: int = REPORTED,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n and score.

    a, l and r are the occurrences of the phrase and of its parts at the cut with the least score, n
    the words of the language.
    """
    counts, totals = frequent_phrases(docs, support, longest, shards)
    counts = stored(counts, "phrase-counts")
    rated = _rated(counts).join(_absorbed(counts), ["lang", "phrase"], "left")
    own = f"{ABSORBED_PERCENT} * cast(a as decimal(28, 0))"
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = (
        rated.filter(f"around is null or 100 * cast(around as decimal(28, 0)) < {own}")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= reported)
    )
    totals = totals.select("lang_key", "total").distinct()
    return ranked.join(totals, F.xxhash64("lang") == F.col("lang_key")).select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
