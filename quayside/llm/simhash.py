"""Near duplicates by SimHash, found by meeting in the middle.

A fingerprint has a bit for each of 64, set if more than half of the text's shingle hashes have it. If two
fingerprints differ in up to 2r bits, some number differs from both in up to r bits; so when every
fingerprint emits all numbers within r bits, its variants, the two meet at one.

1. Texts become fingerprints. Equal ones are one row from here on, so a large group of copies costs no more
   than one text.
2. Variants are shuffled by their leading bits. Of the 2,081 variants of a fingerprint many have the same
   leading bits, so the fingerprint is sent once to each stretch of variants that it reaches, with the number of
   bits that are changed already; the receiving task writes out the variants of the stretch. Stretches with too many
   variants, where fingerprints are alike, are divided by further bits and shuffled again until none is left. A
   stretch of a single number has no more than 2,081 fingerprints, so this ends.
3. Equal variants meet by sorting. Of the fingerprints at a variant each is linked with the least one, never all
   with each other; links are deduplicated and verified by the number of differing bits.
4. Components of the links give documents their least id.

Texts of fewer words than a shingle have one hash, of all their words. Null and empty texts and those without words
have the fingerprint zero, linked like any other. Every row has a row in the result; rows of equal text
have the same fingerprint. Null ids are no component's least id unless it has no other. An empty table gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import arrays, graph
from quayside.llm.common import lookup, prepare, stored

SHINGLE = 4
SEED = 42
#: Fingerprints that differ in up to RADIUS bits are linked.
RADIUS = 4
BITS = 64
#: Variants of a stretch on average, and at most before it is divided, and by how many bits.
STRETCH, FULL, STEP = 1 << 20, 1 << 22, 6
#: Variants for each task.
TASK = 1 << 24
#: Shingle hashes whose bits are unpacked at once.
BLOCK = 1 << 17


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in arrays.slices(batches, "text"):
            words = arrays.Words(texts, arrays.VISIBLE, lower=True)
            data, begin, end = arrays.spaced(words)
            counts = np.diff(words.first)
            shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
            at = np.cumsum(shingles) - shingles
            row = np.repeat(np.arange(len(counts)), shingles)
            first = words.first[:-1][row] + np.arange(len(row)) - at[row]
            last = first + np.minimum(counts, size)[row] - 1
            ones = np.zeros((len(counts), BITS), dtype=np.int64)
            view = memoryview(data.tobytes())
            for low in range(0, len(row), BLOCK):
                part = slice(low, low + BLOCK)
                spans = zip(begin[first[part]].tolist(), end[last[part]].tolist())
                hashes = np.array([xxhash.xxh64_intdigest(view[a:b], SEED) for a, b in spans], dtype="<u8")
                bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                rows, starts = np.unique(row[part], return_index=True)
                ones[rows] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
            set_bits = 2 * ones > shingles[:, None]
            found = np.packbits(set_bits, axis=1, bitorder="little").view("<i8").ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.astype(np.int64))], ["doc_id", "fingerprint"]
            )

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (as a long) of every row."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(_fingerprints(shingle), "doc_id long, fingerprint long")


def _changes(width: int, most: int) -> list[tuple[int, int]]:
    """All numbers of a width with up to ``most`` bits set, and how many are."""
    return [
        (sum(1 << bit for bit in chosen), count)
        for count in range(most + 1)
        for chosen in combinations(range(width), count)
    ]


def _variants(depth, most: int):
    """SQL for the variants that a row stands for: changes of the bits below ``depth``."""
    terms, ways = [], "1L"
    rest = f"({BITS} - {depth})"
    for count in range(most + 1):
        terms.append(f"if(changed <= {most - count}, {ways}, 0L)")
        ways = f"(({ways}) * ({rest} - {count}) div {count + 1})"
    return " + ".join(terms)


def _divided(entries: DataFrame, depth: int, step: int, most: int) -> DataFrame:
    """The stretches at ``depth + step`` that each row reaches."""
    changes = F.array(
        *(F.struct(F.lit(bits).cast("long").alias("bits"), F.lit(n).alias("n")) for bits, n in _changes(step, most))
    )
    own = F.shiftrightunsigned("fingerprint", BITS - depth - step).bitwiseAND(F.lit((1 << step) - 1))
    reached = F.explode(F.filter(changes, lambda c: c["n"] <= most - F.col("changed"))).alias("change")
    return entries.select("fingerprint", "changed", "stretch", reached).select(
        "fingerprint",
        (F.col("changed") + F.col("change.n")).alias("changed"),
        F.shiftleft("stretch", step).bitwiseOR(own.bitwiseXOR(F.col("change.bits"))).alias("stretch"),
    )


def stretches(prints: DataFrame, most: int, average: int = STRETCH, full: int = FULL) -> tuple[DataFrame, int]:
    """Rows (depth, stretch, fingerprint, changed) whose stretches have ``full`` variants at most, and the number of
    all variants."""
    total = prints.count() * sum(1 for _ in _changes(BITS, most))
    depth = min(BITS - STEP, max(1, (total // average).bit_length()))
    entries = prints.select("fingerprint", F.lit(0).alias("changed"), F.lit(0).cast("long").alias("stretch"))
    entries = _divided(entries, 0, depth, most)
    done = []
    while True:
        sized = entries.groupBy("stretch").agg(F.sum(F.expr(_variants(depth, most))).alias("n"))
        overfull = lookup(sized.filter(F.col("n") > full).select("stretch"), "overfull")
        step = min(STEP, BITS - depth)
        last = step == 0 or overfull.isEmpty()
        kept = entries if last else entries.join(overfull, "stretch", "left_anti")
        done.append(kept.select(F.lit(depth).alias("depth"), "stretch", "fingerprint", "changed"))
        if last:
            break
        entries = stored(_divided(entries.join(overfull, "stretch", "left_semi"), depth, step, most), "stretches")
        depth += step
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, total


def _met(most: int, radius: int):
    """Links of a stretch: fingerprints with the least one at a common variant."""

    def run(table: pa.Table) -> pa.Table:
        depth, stretch = table.column("depth")[0].as_py(), table.column("stretch")[0].as_py()
        prints = table.column("fingerprint").to_numpy().view(arrays.U64)
        changed = table.column("changed").to_numpy()
        rest = BITS - depth
        low = arrays.U64((1 << rest) - 1)
        prefix = arrays.U64((stretch << rest) & ((1 << BITS) - 1))
        changes = _changes(rest, most)
        bits = np.array([b for b, _ in changes], dtype=arrays.U64)
        count = np.array([n for _, n in changes])
        variants, sources = [], []
        for used in range(most + 1):
            own = np.flatnonzero(changed == used)
            ways = bits[count <= most - used]
            variants.append((((prints[own] & low) | prefix)[:, None] ^ ways[None, :]).ravel())
            sources.append(np.repeat(prints[own], len(ways)))
        variant, source = np.concatenate(variants), np.concatenate(sources)
        order = np.argsort(variant)
        same = variant[order[1:]] == variant[order[:-1]]
        first, last = np.concatenate([[True], ~same]), np.concatenate([~same, [True]])
        shared = ~(first & last)
        begins = shared & first
        met = source[order[shared]]
        group = np.cumsum(begins[shared]) - 1
        least = np.minimum.reduceat(met, np.flatnonzero(begins[shared])) if len(met) else met
        pairs = np.unique(np.stack([met, least[group]], axis=1), axis=0) if len(met) else np.zeros((0, 2), arrays.U64)
        u, v = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
        near = (u != v) & (np.bitwise_count(u ^ v) <= radius)
        return pa.table({"u": pa.array(arrays.signed(u[near])), "v": pa.array(arrays.signed(v[near]))})

    return run


def links(prints: DataFrame, radius: int = RADIUS, average: int = STRETCH, full: int = FULL) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints within the radius that join all that can be joined by such pairs."""
    most = (radius + 1) // 2
    entries, total = stretches(prints, most, average, full)
    tasks = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK))
    return (
        entries.repartition(tasks, "depth", "stretch")
        .groupBy("depth", "stretch")
        .applyInArrow(_met(most, radius), "u long, v long")
        .distinct()
    )


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least doc_id that links lead to."""
    found = stored(fingerprints(docs, shingle), "fingerprints")
    prints = stored(found.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "prints")
    roots = graph.components(links(prints.select("fingerprint"), radius))
    rooted = prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fingerprint", "component_id")
    return found.join(lookup(named, "components"), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
