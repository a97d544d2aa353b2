"""Audit of how the sources of a language differ in their terms, by chunk factorization.

A chunk is what stands between white space, a term a run of letters in it. Texts repeat their
chunks far more often than they bring new ones, so terms are cut out of distinct chunks only:

1. Chunks are counted in each document, then added up by cell (language and source) and chunk: occurrences
   and documents.
2. Chunks are dealt to tasks, each to one, with all its counts. A task tokenizes every chunk once and joins the
   terms back to the counts.
3. Terms are added up by cell. A term is kept if at least ``least`` documents of the language have it, in whatever
   chunks. Per cell these documents are no fewer than those of the term's most frequent chunk, and no more than those
   of all its chunks. Only if the sums of these bounds do not decide, the documents with the term are counted.

Divergence of group p from group q is the sum of floor((p - q)^2 / q) over the kept terms, of
probabilities in billionths with one added to every count. Most terms are missing in most sources, where
p depends on the source only. Sums over those come from the number of terms of each count; only terms
that two sources share are compared, from the row of the term, which lists its cells. Neither list nor the table of
cells that tasks get is longer than the number of cells, whose pairs are the result.

Null languages, sources and texts are empty strings. Each row is a document, whatever its id; repeated rows count
as often as they occur. Texts without a term leave their group in the result. An empty table gives
no rows; a language without kept terms gives pairs of value 0. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import arrays
from quayside.llm.common import bits_for, hash_bits, lookup, prepare, stored

#: Documents of the language that a kept term needs, and the ranks of terms that are reported.
LEAST_DOCUMENTS = 3
TERM_RANKS = 200
BILLION = 1_000_000_000

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of terms; the capital letters are small ones then.
LETTER = arrays.byte_class("abcdefghijklmnopqrstuvwxyz")
LETTER[128:] = True

CHUNK_SCHEMA = "cell long, chunk string, n long, docs long"
TERM_SCHEMA = "cell long, term string, n long, lower long, upper long"
LIST_SCHEMA = "lang string, term string, cells array<struct<cell:bigint,n:bigint>>, n long, lower long, upper long"
#: Rows of a task that needs all rows of its keys, and bytes of chunks that are tokenized at once.
TASK_ROWS, TOKENIZED_BYTES = 500_000, 64 << 20
#: Rows of counted chunks that a task adds up before it hands them on.
HELD_ROWS = 600_000
#: Pairs that are compared at once, and cells of a batch whose sums are kept in a square.
PAIRS_AT_ONCE, SQUARE = 500_000, 1500


def _added(parts: list[pa.Table]) -> pa.Table:
    rows = pa.concat_tables(parts).group_by(["cell", "chunk"], use_threads=False)
    found = rows.aggregate([("n", "sum"), ("docs", "sum")])
    return found.rename_columns(["cell", "chunk", "n", "docs"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks counted in each document, then added up by cell within a task."""
    held, rows = [], 0
    for batch, _ in arrays.slices(batches, "text"):
        cut = pc.split_pattern_regex(batch.column("text"), r"[\x20\x09-\x0D]+")
        words = pa.table({"row": pc.list_parent_indices(cut), "chunk": pc.list_flatten(cut)})
        words = words.filter(pc.greater(pc.binary_length(words["chunk"]), 0))
        each = words.group_by(["row", "chunk"], use_threads=False).aggregate([([], "count_all")])
        cell = batch.column("cell").take(each["row"].combine_chunks())
        one = pa.array(np.ones(len(each), dtype=np.int64))
        held.append(pa.table({"cell": cell, "chunk": each["chunk"], "n": each["count_all"], "docs": one}))
        rows += len(each)
        if rows > 2 * HELD_ROWS:
            held = [_added(held)]
            rows = len(held[0])
            if rows > HELD_ROWS:
                yield from held[0].to_batches(max_chunksize=65536)
                held, rows = [], 0
    if held:
        yield from _added(held).to_batches(max_chunksize=65536)


def with_cells(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts with the number of their cell, and the cells (cell, lang, source) that occur."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    docs = docs.select(*filled)
    for seed in range(100):
        cell = F.xxhash64("lang", "source", F.lit(seed)).alias("cell")
        cells = stored(docs.select(cell, "lang", "source").distinct(), "cells")
        # Numbers are hashes; another one is taken if any two cells should ever share theirs.
        if cells.groupBy("cell").count().filter("count > 1").isEmpty():
            return docs.select(cell, "text"), cells
    raise ValueError("no numbers for the cells")


def count_chunks(texts: DataFrame) -> DataFrame:
    """Occurrences and documents of each chunk by cell."""
    prepare(texts.sparkSession)
    counted = texts.mapInArrow(_chunks, CHUNK_SCHEMA)
    return counted.groupBy("cell", "chunk").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of the chunks of a task, each chunk tokenized once, with the counts of the chunk.

    Very long chunks are tokenized as they come, so one that many cells have may be tokenized again.
    """
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("chunk").nbytes
        if size > TOKENIZED_BYTES:
            yield from _joined_back(held)
            held, size = [], 0
    if held:
        yield from _joined_back(held)


def _joined_back(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(batches).combine_chunks()
    if not len(rows):
        return
    chunks = rows["chunk"].combine_chunks().dictionary_encode()
    cut = pc.split_pattern_regex(pc.ascii_lower(chunks.dictionary), NO_TERM)
    of, terms = pc.list_parent_indices(cut).to_numpy(), pc.list_flatten(cut)
    filled = pc.greater(pc.binary_length(terms), 0)
    of, terms = of[filled.to_numpy(zero_copy_only=False)], terms.filter(filled)
    # The rows of a chunk stand together; each meets all terms of the chunk.
    chunk = chunks.indices.to_numpy()
    order = np.argsort(chunk, kind="stable")
    each = np.bincount(chunk, minlength=len(chunks.dictionary))
    first = np.cumsum(each) - each
    count = each[of]
    row = order[np.repeat(first[of], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    term = np.repeat(np.arange(len(of)), count)
    met = pa.table(
        {
            "cell": rows["cell"].take(row),
            "term": terms.take(pa.array(term)),
            "n": rows["n"].take(row),
            "docs": rows["docs"].take(row),
        }
    )
    sums = met.group_by(["cell", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "max"), ("docs", "sum")])
    yield from sums.rename_columns(["cell", "term", "n", "lower", "upper"]).to_batches(max_chunksize=65536)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each term of a language, with the list of its cells. A task has all rows of its terms."""
    batches = list(batches)
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    found = rows.group_by(["lang", "term"], use_threads=False).aggregate(
        [("cell", "list"), ("n", "list"), ("n", "sum"), ("lower", "sum"), ("upper", "sum")]
    )
    for batch in found.combine_chunks().to_batches(max_chunksize=16384):
        cell, n = batch.column("cell_list"), batch.column("n_list")
        lists = pa.StructArray.from_arrays([cell.flatten(), n.flatten()], ["cell", "n"])
        lengths = np.concatenate([[0], np.cumsum(pc.list_value_length(cell).to_numpy())]).astype(np.int32)
        cells = pa.ListArray.from_arrays(pa.array(lengths), lists)
        sums = [batch.column(c) for c in ("n_sum", "lower_sum", "upper_sum")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("term"), cells, *sums], ["lang", "term", "cells", "n", "lower", "upper"]
        )


def _tasks(rows: DataFrame) -> int:
    """Tasks of about TASK_ROWS rows; ``rows`` is a stored table."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // TASK_ROWS))


def count_terms(chunks: DataFrame, cells: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Terms by language: occurrences, also by cell, and bounds of the number of documents that have it.

    Terms that have too few documents by the upper bound are left out.
    """
    by_cell = (
        chunks.repartition(_tasks(chunks), "chunk")
        .mapInArrow(_terms, TERM_SCHEMA)
        .groupBy("cell", "term")
        # A chunk that has a term twice counts twice in the upper bound, which stays one.
        .agg(F.sum("n").alias("n"), F.max("lower").alias("lower"), F.sum("upper").alias("upper"))
    )
    by_cell = stored(by_cell, "cell-terms")
    named = by_cell.join(cells.select("cell", "lang"), "cell")
    lists = named.repartition(_tasks(by_cell), "lang", "term").mapInArrow(_listed, LIST_SCHEMA)
    return lists.filter(F.col("upper") >= least)


def kept_terms(
    counts: DataFrame, cells: DataFrame, texts: DataFrame, least: int = LEAST_DOCUMENTS
) -> DataFrame:
    """The rows of terms in at least ``least`` documents of the language."""
    open_ = stored(counts.filter(F.col("lower") < least).select("lang", "term"), "open-terms")
    if open_.isEmpty():
        return counts
    bits = bits_for(8 * open_.count())
    hashes = open_.select("term").mapInArrow(_hashes, "hash long")
    shared = texts.sparkSession.sparkContext.broadcast(hash_bits(hashes, "hash", bits))
    documents = (
        texts.mapInArrow(_asked(shared, bits), "cell long, term string, documents long")
        .groupBy("cell", "term")
        .agg(F.sum("documents").alias("documents"))
        .join(cells.select("cell", "lang"), "cell")
        .groupBy("lang", "term")
        .agg(F.sum("documents").alias("documents"))
        .filter(F.col("documents") >= least)
    )
    too_few = lookup(open_.join(documents, ["lang", "term"], "left_anti"), "rare-terms")
    return counts.join(too_few, ["lang", "term"], "left_anti")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in arrays.slices(batches, "term"):
        found = arrays.span_hashes(texts.bytes, texts.at[:-1], texts.at[1:])
        yield pa.RecordBatch.from_arrays([pa.array(arrays.signed(found))], ["hash"])


def _asked(shared, n_bits: int):
    """Documents by cell that have a term which is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = arrays.Bits(shared.value, n_bits)
        for batch, texts in arrays.slices(batches, "text"):
            words = arrays.Words(texts, LETTER, lower=True)
            places = np.flatnonzero(bits.has(words.hash))
            rows = np.searchsorted(words.first, places, side="right") - 1
            found = pa.table({"row": rows, "term": pa.array([words.text(i) for i in places], pa.string())})
            found = found.group_by(["row", "term"], use_threads=False).aggregate([])
            cell = batch.column("cell").take(found["row"].combine_chunks())
            each = pa.table({"cell": cell, "term": found["term"]}).group_by(["cell", "term"], use_threads=False)
            yield from each.aggregate([([], "count_all")]).rename_columns(["cell", "term", "documents"]).to_batches()

    return run


def _billionths(count: str, total: str, terms: str) -> Column:
    """1 + floor(10^9 (count + 1) / (total + terms)), by three digits at a time.

    Exact as long as a language has fewer than 9 * 10^15 words; beyond that Spark reports the overflow.
    """
    rest, all_, digits = f"({count} + 1L)", f"({total} + {terms})", []
    for _ in range(3):
        digits.append(f"({rest} * 1000L) div {all_}")
        rest = f"(({rest} * 1000L) % {all_})"
    return F.expr(f"1L + ({digits[0]}) * 1000000L + ({digits[1]}) * 1000L + ({digits[2]})")


def _shares(count: np.ndarray, all_: np.ndarray) -> np.ndarray:
    """The same as _billionths for arrays."""
    rest, found = count + 1, np.ones(len(count), dtype=np.int64)
    for unit in (1_000_000, 1000, 1):
        found += rest * 1000 // all_ * unit
        rest = rest * 1000 % all_
    return found


def _diverging(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _groups(cells: DataFrame, kept: DataFrame) -> DataFrame:
    """Every cell: total of kept terms, own terms, terms of the language, p of a missing term."""
    sums = kept.select(F.inline("cells")).groupBy("cell").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    return (
        cells.join(sums, "cell", "left")
        .join(terms, "lang", "left")
        .fillna(0, ["total", "own", "terms"])
        .withColumn("missing", F.when(F.col("terms") > 0, _billionths("0L", "total", "terms")))
    )


def _shared_terms(known, most_square: int, at_once: int):
    """Sums over the terms of two cells of what f adds there to the sums of each, for batches of terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, words, missing, _ = known.value

        def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            apart = p - q
            apart *= apart
            return np.floor_divide(apart, q, out=apart)

        for batch in batches:
            lists = batch.column("cells")
            at = lists.offsets.to_numpy()
            inside = lists.values
            cell = np.searchsorted(names, inside.field("cell").to_numpy())
            share = _shares(inside.field("n").to_numpy(), words[cell])
            present, local = np.unique(cell, return_inverse=True)
            size, square = len(present), None
            if size <= most_square:
                square = np.zeros(size * size, dtype=np.int64)
            lengths = np.diff(at)
            for length in np.unique(lengths[lengths > 1]).tolist():
                starts = at[:-1][lengths == length]
                # Terms at once, and for very long lists firsts of pairs at once.
                step, row = max(1, at_once // length**2), max(1, min(length, at_once // length))
                for low in range(0, len(starts), step):
                    place = starts[low : low + step, None] + np.arange(length)
                    for first in range(0, length, row):
                        one, two = place[:, first : first + row, None], place[:, None, :]
                        p, q, p_0, q_0 = share[one], share[two], missing[cell[one]], missing[cell[two]]
                        value = (f(p, q) - f(p, q_0) - f(p_0, q) + f(p_0, q_0)).ravel()
                        pair = (local[one] * size + local[two]).ravel()
                        if square is not None:
                            np.add.at(square, pair, value)
                        else:
                            yield from _sums(*_added_up(pair, value), present, names)
            if square is not None:
                pair = np.flatnonzero(square)
                yield from _sums(pair, square[pair], present, names)

    return run


def _apart(known, ranks: int):
    """Terms of cells that are more probable there than in the language, of each batch those that may have a rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, words, _, lang_words = known.value
        for batch in batches:
            lists = batch.column("cells")
            lengths = np.diff(lists.offsets.to_numpy())
            inside = lists.flatten()
            cell = np.searchsorted(names, inside.field("cell").to_numpy())
            term = np.repeat(np.arange(len(batch)), lengths)
            p = _shares(inside.field("n").to_numpy(), words[cell])
            q = _shares(batch.column("n").to_numpy()[term], lang_words[cell])
            more = np.flatnonzero(p > q)
            value = (p[more] - q[more]) ** 2 // q[more]
            order = more[np.lexsort((-value, cell[more]))]
            value = (p[order] - q[order]) ** 2 // q[order]
            first = np.flatnonzero(np.diff(cell[order], prepend=-1))
            count = np.diff(np.append(first, len(order)))
            # Ties with the last rank stay; their order is not settled here.
            last = value[first + np.minimum(ranks, count) - 1]
            kept = value >= np.repeat(last, count)
            found = [pa.array(names[cell[order[kept]]]), batch.column("term").take(term[order[kept]])]
            yield pa.RecordBatch.from_arrays([*found, pa.array(value[kept])], ["cell", "item", "value"])

    return run


def _added_up(pair: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, places = np.unique(pair, return_inverse=True)
    sums = np.zeros(len(keys), dtype=np.int64)
    np.add.at(sums, places, value)
    return keys, sums


def _sums(pair: np.ndarray, value: np.ndarray, present: np.ndarray, names: np.ndarray) -> Iterator[pa.RecordBatch]:
    first, second = np.divmod(pair, max(1, len(present)))
    apart = first != second
    columns = [names[present[first]], names[present[second]], value]
    yield pa.RecordBatch.from_arrays([pa.array(c[apart]) for c in columns], ["cell", "other", "value"])


def _pairs(groups: DataFrame, kept: DataFrame, known) -> DataFrame:
    """Divergence of every cell from every other one of its language: (cell, other, value).

    For the pair (g, h) with p and q, 0 being a missing term: the sum over all terms is that of f(p, 0)
    over the terms of g, of f(0, q) over those of h, f(0, 0) for the other terms, and for terms of
    both f(p, q) - f(p, 0) - f(0, q) + f(0, 0).
    """
    other = groups.select("lang", F.col("cell").alias("other"), *(F.col(c).alias(f"{c}_2") for c in ("own", "missing")))
    both_missing = _diverging("missing", "missing_2")
    base = groups.join(other, "lang").filter("cell <> other").selectExpr(
        "cell", "other", f"coalesce((terms - own - own_2) * {both_missing}, 0L) as value"
    )
    # Terms of equal count in a cell have the same p.
    counted = kept.select(F.inline("cells")).groupBy("cell", "n").agg(F.count("*").alias("m"))
    counted = counted.join(groups, "cell").withColumn("p", _billionths("n", "total", "terms"))
    single = (
        counted.select("lang", "cell", "p", "m", "missing").join(other, "lang")
        .filter("cell <> other")
        .selectExpr(
            f"""inline(array(
                struct(cell, other, m * {_diverging("p", "missing_2")} as value),
                struct(other as cell, cell as other, m * {_diverging("missing_2", "p")} as value)))"""
        )
    )
    both = kept.select("cells").mapInArrow(_shared_terms(known, SQUARE, PAIRS_AT_ONCE), "cell long, other long, value long")
    return base.unionByName(single).unionByName(both).groupBy("cell", "other").agg(F.sum("value").alias("value"))


def _shared_groups(groups: DataFrame):
    """For tasks: sorted cells with their words and terms, p of a missing term, words and terms of the language."""
    languages = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    table = (
        groups.filter("terms > 0")
        .join(languages, "lang")
        .selectExpr("cell", "total + terms as words", "missing", "lang_total + terms as lang_words")
        .toArrow()
        .sort_by("cell")
    )
    columns = [table.column(c).to_numpy() for c in ("cell", "words", "missing", "lang_words")]
    return groups.sparkSession.sparkContext.broadcast(columns)


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part ``pair``: the divergence of the source from each other source of its language. Part
    ``term``: the terms that are more probable in the source than in its language, up to ``ranks``.
    """
    texts, cells = with_cells(docs)
    chunks = stored(count_chunks(texts), "chunks")
    counts = stored(count_terms(chunks, cells, least), "term-counts")
    kept = stored(kept_terms(counts, cells, texts, least).select("lang", "term", "n", "cells"), "kept-terms")
    groups = stored(_groups(cells, kept), "groups")
    known = _shared_groups(groups)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = (
        _pairs(groups, kept, known)
        .join(cells, "cell")
        .join(cells.select(F.col("cell").alias("other"), F.col("source").alias("item")), "other")
        .withColumn("rank", F.row_number().over(by_value))
        .withColumn("part", F.lit("pair"))
    )
    in_cell = Window.partitionBy("cell").orderBy(F.desc("value"), F.asc("item"))
    apart = (
        kept.select("term", "n", "cells")
        .mapInArrow(_apart(known, ranks), "cell long, item string, value long")
        .withColumn("rank", F.row_number().over(in_cell))
        .filter(F.col("rank") <= ranks)
        .join(cells, "cell")
        .withColumn("part", F.lit("term"))
    )
    return pairs.select(columns).unionByName(apart.select(columns))
