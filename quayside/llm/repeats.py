"""Removal of long repeated passages: winnowed anchors as seeds, extended to maximal repeats.

A window is a run of consecutive words. Its anchor is the rightmost of its word n-grams with the
least hash, so equal windows have equal anchors at the same place. The windows of a document that
share an anchor follow each other; they are one seed: the anchor, and the words that its windows
cover (the seed extended as far as the anchor reaches to both sides).

1. Seeds of all documents, one row for a run of windows.
2. Seeds that are equal as a whole: every later document repeats all of their windows. Copies and
   the inner part of shared passages end here, by one aggregation and one equi join.
3. Anchors with different extensions (the edges of passages): their windows are compared one by
   one, by an aggregation over window hashes. A table of hash bits whose size is bounded tells
   the tasks which anchors these are.
4. The windows found are joined to maximal passages per document, and their words are removed.

No pairs are made: a group of n copies costs n rows. A sequence is known by its anchor's and its
own hash, which do not depend on each other (128 bits).

Nulls, empty and repeated rows: a null text has no words. Rows without an id are kept whole and
are no source for others. Rows with the same id never remove words of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import arrays
from quayside.llm.common import bits_for, hash_bits, prepare, stored

WINDOW = 50
ANCHOR = 10

SEED_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("anchor", pa.int64()),
        ("extent", pa.int64()),
        ("start", pa.int64()),
        ("windows", pa.int64()),
    ]
)
WINDOW_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("anchor", pa.int64()),
        ("hash", pa.int64()),
        ("start", pa.int64()),
    ]
)


def rightmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the rightmost least value of each window of that width."""
    index = np.arange(len(values))
    span = 1

    def closer(index: np.ndarray, step: int) -> np.ndarray:
        left, right = index[: len(index) - step], index[step:]
        return np.where(values[right] <= values[left], right, left)

    while span * 2 <= width:
        index = closer(index, span)
        span *= 2
    return closer(index, width - span) if width > span else index


class Seeds:
    """Runs of windows with the same anchor in the texts of a batch."""

    def __init__(self, texts: arrays.Texts, window: int, size: int):
        self.words = arrays.Words(texts, arrays.VISIBLE, lower=False)
        self.window = window
        grams = arrays.Runs(self.words.hash, seed=1).every(size)
        starts = np.flatnonzero(self.words.left() >= window)
        empty = np.zeros(0, dtype=np.int64)
        if not len(starts):
            self.anchor = self.extent = np.zeros(0, dtype=arrays.U64)
            self.row = self.first = self.last = empty
            return
        place = rightmost_least(grams, window - size + 1)[starts]
        row = np.searchsorted(self.words.first, starts, side="right") - 1
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(new)
        finish = np.append(begin[1:], len(starts)) - 1
        self.row, self.first, self.last = row[begin], starts[begin], starts[finish]
        self.anchor = grams[place[begin]]
        offset = (place[begin] - self.first).astype(arrays.U64)
        whole = arrays.Runs(self.words.hash, seed=2)
        self.extent = arrays.mixed(
            whole.of(self.first, self.last + window) + offset * arrays.U64(0x9FB21C651E98DF25)
        )

    def place(self) -> np.ndarray:
        """First word of each run, counted in its text."""
        return self.first - self.words.first[self.row]


def _seeds(window: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in arrays.slices(batches, "text"):
            seeds = Seeds(texts, window, size)
            rows = pa.array(seeds.row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("text_hash").take(rows),
                    pa.array(arrays.signed(seeds.anchor)),
                    pa.array(arrays.signed(seeds.extent)),
                    pa.array(seeds.place()),
                    pa.array(seeds.last - seeds.first + 1),
                ],
                schema=SEED_SCHEMA,
            )

    return run


def _windows(window: int, size: int, flags, n_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = arrays.Bits(flags.value, n_bits)
        for batch, texts in arrays.slices(batches, "text"):
            seeds = Seeds(texts, window, size)
            wanted = np.flatnonzero(bits.has(seeds.anchor))
            count = (seeds.last - seeds.first + 1)[wanted]
            owner = np.repeat(wanted, count)
            step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            start = seeds.first[owner] + step
            rows = pa.array(seeds.row[owner])
            whole = arrays.Runs(seeds.words.hash, seed=2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("text_hash").take(rows),
                    pa.array(arrays.signed(seeds.anchor[owner])),
                    pa.array(arrays.signed(whole.of(start, start + window))),
                    pa.array(start - seeds.words.first[seeds.row[owner]]),
                ],
                schema=WINDOW_SCHEMA,
            )

    return run


def repeated_passages(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Maximal runs of words that lie in windows which a document with a smaller id has too.

    docs: doc_id, text_hash and text. Returns doc_id, text_hash and spans, the sorted and merged
    (start, end) in words, for documents that repeat something.
    """
    spark = docs.sparkSession
    known = docs.filter("doc_id is not null and text is not null")
    seeds = stored(
        known.mapInArrow(
            _seeds(window, anchor),
            "doc_id long, text_hash long, anchor long, extent long, start long, windows long",
        ),
        "seeds",
    )
    extents = stored(
        seeds.groupBy("anchor", "extent").agg(
            F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
        ),
        "extents",
    )
    whole = (
        seeds.join(
            extents.filter("first_doc < last_doc").drop("last_doc"), ["anchor", "extent"]
        )
        .filter("doc_id > first_doc")
        .select("doc_id", "text_hash", "start", (F.col("start") + F.col("windows") - 1).alias("last"))
    )
    edges = stored(
        extents.groupBy("anchor")
        .agg(
            F.count("*").alias("extents"),
            F.min("first_doc").alias("first_doc"),
            F.max("last_doc").alias("last_doc"),
        )
        .filter("extents > 1 and first_doc < last_doc")
        .select("anchor"),
        "edges",
    )
    n_bits = bits_for(edges.count())
    flags = spark.sparkContext.broadcast(hash_bits(edges, "anchor", n_bits))
    windows = stored(
        known.mapInArrow(
            _windows(window, anchor, flags, n_bits),
            "doc_id long, text_hash long, anchor long, hash long, start long",
        ),
        "windows",
    )
    firsts = stored(
        windows.groupBy("anchor", "hash")
        .agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        .filter("first_doc < last_doc")
        .drop("last_doc"),
        "firsts",
    )
    single = (
        windows.join(firsts, ["anchor", "hash"])
        .filter("doc_id > first_doc")
        .select("doc_id", "text_hash", "start", F.col("start").alias("last"))
    )
    return (
        whole.unionByName(single)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", (F.col("last") + window).alias("end"))).alias("spans"))
    )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in arrays.slices(batches, "text"):
        spans = batch.column("spans")
        offsets, flat = spans.offsets.to_numpy(), spans.values
        begin = flat.field("start").to_numpy(zero_copy_only=False)
        end = flat.field("end").to_numpy(zero_copy_only=False)
        has = spans.is_valid().to_numpy(zero_copy_only=False)
        n_words, n_removed, kept = [], [], []
        for row in range(len(texts)):
            words = texts.raw(row).split()
            n_words.append(len(words))
            if has[row]:
                part = slice(offsets[row], offsets[row + 1])
                change = np.bincount(begin[part], minlength=len(words) + 1)
                change -= np.bincount(end[part], minlength=len(words) + 1)
                stays = np.flatnonzero(np.cumsum(change)[: len(words)] == 0)
                words = [words[i] for i in stays]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Documents without the words of passages that a document with a smaller id has too.

    Returns a row per document: doc_id, n_words, n_removed and kept (words joined by one space).
    """
    prepare(docs.sparkSession)
    docs = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string")
    )
    passages = repeated_passages(docs, window, anchor)
    return (
        docs.join(passages, ["doc_id", "text_hash"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string")
    )
