"""Benchmark decontamination as a prefix-filtered containment join.

A window is a run of consecutive item words. It occurs in a document only if each of its word
shingles does, so it is enough to look up one shingle, and the rarest one finds the fewest
candidates: for a containment of 1 the necessary prefix of the ordered shingles has one member.

1. Items become windows and shingles (hashed).
2. Documents are counted by shingle, over the whole corpus; a window's prefix is its rarest.
3. Documents give the places of prefix shingles, with the words around. An equi join with the
   windows follows; length and position bounds and the comparison of all words decide.

Both passes over documents send only what passes a table of hash bits. Its size follows the number of
shingles up to 2**28 bits, so no broadcast grows further with the benchmark, or with the documents at all.

Nulls, empty and repeated rows: a null text has no words. Items without id or words are left out.
Repeated documents give one row each. An empty benchmark finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import arrays
from quayside.llm.common import bits_for, hash_bits, prepare, stored

WINDOW = 10
SHINGLE = 3


def _items(size: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in arrays.slices(batches, "text"):
            words = arrays.Words(texts, arrays.WORD, lower=True)
            runs = arrays.Runs(words.hash)
            ids = batch.column("item_id").to_pylist()
            out: dict[str, list] = {"item": [], "words": [], "size": [], "at": [], "shingle": []}
            for row in range(len(texts)):
                begin, end = int(words.first[row]), int(words.first[row + 1])
                named = [words.text(i) for i in range(begin, end)]
                long = min(size, end - begin)
                part = min(shingle, long)
                for start in range(begin, end - long + 1 if long else begin):
                    at = np.arange(start, start + long - part + 1)
                    for offset, value in enumerate(arrays.signed(runs.of(at, at + part))):
                        out["item"].append(ids[row])
                        out["words"].append(" ".join(named[start - begin : start - begin + long]))
                        out["size"].append(long)
                        out["at"].append(offset)
                        out["shingle"].append(int(value))
            yield pa.RecordBatch.from_pydict(out, schema=ITEM_SCHEMA)

    return run


ITEM_SCHEMA = pa.schema(
    [
        ("item", pa.string()),
        ("words", pa.string()),
        ("size", pa.int32()),
        ("at", pa.int32()),
        ("shingle", pa.int64()),
    ]
)
PLACE_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n_words", pa.int64()),
        ("shingle", pa.int64()),
        ("place", pa.int64()),
        ("before", pa.list_(pa.string())),
        ("after", pa.list_(pa.string())),
    ]
)


def _found(words: arrays.Words, runs: arrays.Runs, sizes: list[int], bits: arrays.Bits):
    """Places of shingles that may be looked for: (place, hash), for each shingle size."""
    left = words.left()
    for size in sizes:
        hashes = runs.every(size)
        places = np.flatnonzero(bits.has(hashes) & (left[: len(hashes)] >= size))
        yield places, hashes[places]


def _counts(sizes: list[int], flags, n_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = arrays.Bits(flags.value, n_bits)
        for _, texts in arrays.slices(batches, "text"):
            words = arrays.Words(texts, arrays.WORD, lower=True)
            runs = arrays.Runs(words.hash)
            for _, hashes in _found(words, runs, sizes, bits):
                shingles, n = np.unique(arrays.signed(hashes), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shingles), pa.array(n)], ["shingle", "n"])

    return run


def _places(sizes: list[int], flags, n_bits: int, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = arrays.Bits(flags.value, n_bits)
        for batch, texts in arrays.slices(batches, "text"):
            words = arrays.Words(texts, arrays.WORD, lower=True)
            runs = arrays.Runs(words.hash)
            ids, hashes = batch.column("doc_id"), batch.column("text_hash")
            n_words = np.diff(words.first)
            every = len(texts)
            yield pa.RecordBatch.from_arrays(
                [ids, hashes, pa.array(n_words), *(pa.nulls(every, f.type) for f in list(PLACE_SCHEMA)[3:])],
                schema=PLACE_SCHEMA,
            )
            for places, found in _found(words, runs, sizes, bits):
                rows = np.searchsorted(words.first, places, side="right") - 1
                before = [
                    [words.text(i) for i in range(max(words.first[r], p - reach), p)]
                    for r, p in zip(rows, places)
                ]
                after = [
                    [words.text(i) for i in range(p, min(words.first[r + 1], p + reach + 1))]
                    for r, p in zip(rows, places)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows)),
                        hashes.take(pa.array(rows)),
                        pa.array(n_words[rows]),
                        pa.array(arrays.signed(found)),
                        pa.array(places - words.first[rows]),
                        pa.array(before, pa.list_(pa.string())),
                        pa.array(after, pa.list_(pa.string())),
                    ],
                    schema=PLACE_SCHEMA,
                )

    return run


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, bits: int | None = None
) -> DataFrame:
    """Which words of documents stand in an occurrence of a window of an item.

    Returns a row per document: doc_id, text_hash (xxhash64 of the text), n_words, n_hit, items (ids as
    sorted strings) and spans (start and end of the hits in words, merged). ``bits`` of the hashes are looked up in
    tables, by default as many as the benchmark needs.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string")
    )
    parts = stored(
        items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
        .filter("item_id is not null and text is not null")
        .mapInArrow(_items(window, shingle), "item string, words string, size int, at int, shingle long"),
        "benchmark",
    )
    sizes = sorted(
        row[0] for row in parts.select(F.least("size", F.lit(shingle))).distinct().collect()
    )
    bits = bits or bits_for(parts.count())
    flags = spark.sparkContext.broadcast(hash_bits(parts, "shingle", bits))
    rarity = (
        docs.select("text")
        .mapInArrow(_counts(sizes, flags, bits), "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
    )
    # A window with a shingle that no document has can't occur, so the join is an inner one
    # and the least count that is left belongs to a necessary shingle.
    windows = parts.groupBy("words", "size").agg(
        F.sort_array(F.collect_set("item")).alias("items"),
        F.count_distinct("shingle").alias("n_shingles"),
    )
    prefixes = stored(
        parts.select("words", "size", "at", "shingle")
        .distinct()
        .join(rarity, "shingle")
        .groupBy("words", "size")
        .agg(
            F.min(F.struct("n", "shingle", "at")).alias("rarest"),
            F.count_distinct("shingle").alias("n_present"),
        )
        .join(windows, ["words", "size"])
        .filter("n_present = n_shingles")
        .select("words", "size", "items", "rarest.shingle", "rarest.at"),
        "prefixes",
    )
    rare = spark.sparkContext.broadcast(hash_bits(prefixes, "shingle", bits))
    places = stored(
        docs.mapInArrow(
            _places(sizes, rare, bits, window - 1),
            "doc_id long, text_hash long, n_words long, shingle long, place long, "
            "before array<string>, after array<string>",
        ),
        "places",
    )
    start = F.col("place") - F.col("at")
    around = F.concat("before", "after")
    hits = (
        places.filter("shingle is not null")
        .join(prefixes, "shingle")
        .filter((start >= 0) & (start + F.col("size") <= F.col("n_words")))
        .filter(
            F.array_join(F.slice(around, F.size("before") - F.col("at") + 1, F.col("size")), " ")
            == F.col("words")
        )
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.struct(start.alias("start"), (start + F.col("size")).alias("end")).alias("span"),
            "items",
            F.lit(0).alias("rows"),
        )
    )
    every = places.filter("shingle is null").select(
        "doc_id",
        "text_hash",
        "n_words",
        F.lit(None).cast("struct<start:bigint,end:bigint>").alias("span"),
        F.lit(None).cast("array<string>").alias("items"),
        F.lit(1).alias("rows"),
    )
    return (
        every.unionByName(hits)
        .groupBy("doc_id", "text_hash", "n_words")
        .agg(
            F.sum("rows").alias("rows"),
            F.sort_array(F.collect_set("span")).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .withColumn("spans", _merged("spans"))
        .withColumn("n_hit", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)"))
        .withColumn("_row", F.explode(F.expr("sequence(1L, rows)")))
        .select("doc_id", "text_hash", "n_words", "n_hit", "items", "spans")
    )


def _merged(spans: str):
    """Sorted spans without overlap: a span stays apart if it begins after all earlier ones end."""
    return F.expr(
        f"""aggregate({spans},
            struct(cast(array() as array<struct<start:bigint,end:bigint>>) as done,
                   cast(null as struct<start:bigint,end:bigint>) as open),
            (s, x) -> case
                when s.open is null then struct(s.done as done, x as open)
                when x.start <= s.open.end then struct(s.done as done,
                    named_struct('start', s.open.start, 'end', greatest(s.open.end, x.end)) as open)
                else struct(concat(s.done, array(s.open)) as done, x as open) end,
            s -> if(s.open is null, s.done, concat(s.done, array(s.open))))"""
    )
