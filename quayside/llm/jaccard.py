"""N-gram Jaccard join by chosen paths.

Documents are sets of word shingles. Equal sets are one set from the first step on, so copies
cost a row each. Each set gets a signature of minimum hashes, whose members (place, value) are
tokens that two sets share with a probability of their Jaccard similarity.

1. Split: a node of the tree samples signature places by a hash of its path; its sets go to one
   child for each sampled place and value. Buckets of one set end, buckets up to a bound are
   searched, larger ones are split again, as long as there are any whose sets are not alike. More levels cost a
   pair at the threshold no recall beyond a limit that the number of runs takes into account.
2. Search: all signatures of a bucket are compared. A task gives the links of its sets to the least one of their local component, so no
   more rows than it has sets. Large buckets whose sets are alike would not be divided by more
   tokens; they are linked as a whole, and all their pairs are left to the verification.
3. Runs: as many trees as bring a pair at the threshold to the target recall.
4. Verification: links make candidate components (no driver involved). All pairs of sets in a
   component, not only those that met in a bucket, get their exact similarity, large components
   again in pairs of blocks. Only sums per set and links to local components leave a task.

Nulls, empty and repeated rows: rows without an id or without a word have no links and are a
class of their own. A text of fewer words than a shingle is one shingle. Repeated rows are copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import arrays
from quayside.llm.common import bits_for, hash_bits, prepare, stored
from quayside.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
PLACES = 64
#: Sampled places for each node of a tree.
BRANCHES = 2.0
RECALL = 0.9999
#: Sets of a bucket that are compared at once; larger buckets are searched in blocks of this size.
BUCKET = 400
#: Signatures may agree less than the sets do; with 64 places this is 4 standard deviations.
SLACK = 0.2
#: Signature places that are looked at to see whether the sets of a large bucket are alike, and the
#: share of pairs that then agree.
PROBES = 8
#: Counts that stand for the values of a place, which are put into them by a hash.
BINS = 16
#: Buckets whose counts a task holds before it hands them on.
COUNTED = 10_000
#: Links that a task holds before it hands them on.
HELD = 500_000
DENSE = 0.5

U64 = arrays.U64
SHINGLES_SCHEMA = "doc_id long, text_hash long, low long, high long, shingles long, signature binary"


def runs_needed(threshold: float, recall: float, branches: float = BRANCHES) -> int:
    """Trees, however deep, after which a pair at the threshold has met with the probability asked for.

    A pair stays together in some child with 1 - exp(-branches * threshold * m), m being the same for a
    level less. That falls to a limit above 0 if branches * threshold is more than 1.
    """
    if branches * threshold <= 1.0:
        raise ValueError("deep trees need more branches for that threshold")
    meets, last = 1.0, 2.0
    while last - meets > 1e-9:
        meets, last = 1.0 - math.exp(-branches * threshold * meets), meets
    return max(1, math.ceil(math.log(1.0 - recall) / math.log(1.0 - meets)))


class Sets:
    """Distinct shingles of the texts of a batch, 48 bits each, sorted within each text."""

    def __init__(self, texts: arrays.Texts, size: int):
        words = arrays.Words(texts, arrays.WORD, lower=True)
        runs = arrays.Runs(words.hash, seed=3)
        count = np.diff(words.first)
        short = np.flatnonzero((count > 0) & (count < size))
        start = np.flatnonzero(words.left() >= size)
        row = np.concatenate([np.searchsorted(words.first, start, side="right") - 1, short])
        value = np.concatenate(
            [runs.of(start, start + size), runs.of(words.first[short], words.first[short + 1])]
        ) >> U64(16)
        order = np.argsort(row.astype(U64) << U64(48) | value) if len(texts) < 1 << 16 else np.lexsort((value, row))
        row, value = row[order], value[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        self.row, self.value = row[new], value[new]
        self.size = np.bincount(self.row, minlength=len(texts))
        self.rows = np.flatnonzero(self.size)
        self.begin = (np.cumsum(self.size) - self.size)[self.rows]

    def sums(self, seed: int) -> np.ndarray:
        """A hash of the set of each text that has shingles."""
        if not len(self.rows):
            return np.zeros(0, dtype=U64)
        salted = arrays.mixed(self.value + U64((seed * 0xC2B2AE3D27D4EB4F) % (1 << 64)))
        return arrays.mixed(np.add.reduceat(salted, self.begin))

    def signatures(self, places: int) -> np.ndarray:
        out = np.zeros((len(self.rows), places), dtype=np.uint32)
        spread = arrays.mixed(self.value)
        for place in range(places):
            factor = U64(arrays.BASE * (2 * place + 1) % (1 << 64) | 1)
            if len(self.rows):
                hashed = (spread * factor + arrays.mixed(np.array([place + 7], U64))[0]) >> U64(32)
                out[:, place] = np.minimum.reduceat(hashed, self.begin)
        return out


def _shingled(size: int, places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in arrays.slices(batches, "text"):
            sets = Sets(texts, size)
            low, high = (np.zeros(len(texts), dtype=U64) for _ in range(2))
            low[sets.rows], high[sets.rows] = sets.sums(1), sets.sums(2)
            signatures: list[bytes | None] = [None] * len(texts)
            for row, signature in zip(sets.rows, sets.signatures(places)):
                signatures[row] = signature.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(arrays.signed(low)),
                    pa.array(arrays.signed(high)),
                    pa.array(sets.size, pa.int64()),
                    pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "text_hash", "low", "high", "shingles", "signature"],
            )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.uint32).reshape(len(values), -1)


def _children(branches: float, runs: int, places: int):
    """Rows of the next level: a child of the bucket for each sampled place and its value."""

    def sampled(paths: np.ndarray) -> np.ndarray:
        spread = arrays.mixed(paths[:, None] + arrays.mixed(np.arange(places, dtype=U64) + U64(11))[None, :])
        return (spread >> U64(11)).astype(np.float64) / 2.0**53 < branches / places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                part = batch.slice(begin, 2000)
                signature = _matrix(part.column("signature"))
                nodes = part.column("node").to_numpy()
                if "bucket" in part.schema.names:
                    paths = [part.column("bucket").to_numpy().view(U64)]
                else:
                    roots = arrays.mixed(np.arange(runs, dtype=U64) + U64(101))
                    paths = [np.full(len(nodes), root) for root in roots]
                for path in paths:
                    row, place = np.nonzero(sampled(path))
                    child = arrays.mixed(
                        path[row] + U64(31) * arrays.mixed(signature[row, place].astype(U64) << U64(8) | place.astype(U64))
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(arrays.signed(child)), pa.array(nodes[row])], ["bucket", "node"]
                    )

    return run


def _probes(places: int):
    """How often the values of a few signature places occur in each bucket, by their hash: a row for each bucket of a task."""

    def told(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array([n.tobytes() for n in held.values()], pa.binary())],
            ["bucket", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = np.linspace(0, places - 1, min(PROBES, places)).astype(np.int64)
        cells = len(chosen) * BINS
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                part = batch.slice(begin, 2000)
                value = _matrix(part.column("signature"))[:, chosen].astype(U64) << U64(8) | chosen.astype(U64)
                cell = (arrays.mixed(value) % U64(BINS)).astype(np.int64) + BINS * np.arange(len(chosen))
                found, own = np.unique(part.column("bucket").to_numpy(), return_inverse=True)
                counts = np.bincount((own[:, None] * cells + cell).ravel(), minlength=len(found) * cells)
                for bucket, n in zip(found.tolist(), counts.reshape(-1, cells)):
                    held[bucket] = held[bucket] + n if bucket in held else n.copy()
                if len(held) > COUNTED:
                    yield told(held)
                    held = {}
        if held:
            yield told(held)

    return run


def _alike_share(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The share of the pairs of sets of a bucket that agree in a place, from the counts of all tasks."""
    counts = sum(np.frombuffer(n, dtype=np.int64) for n in table.column("counts").to_pylist()).reshape(-1, BINS)
    same = ((counts / counts[0].sum()) ** 2).sum(axis=1).mean()
    # Values that differ share a count by chance.
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "alike": [(same - 1 / BINS) / (1 - 1 / BINS)]})


def _dense(large: DataFrame, places: int) -> DataFrame:
    """Buckets whose sets are alike: two of them agree in at least half of their signatures."""
    return (
        large.select("bucket", "signature")
        .mapInArrow(_probes(places), "bucket long, counts binary")
        .groupBy("bucket")
        .applyInArrow(_alike_share, "bucket long, alike double")
        .filter(F.col("alike") >= DENSE)
        .select("bucket")
    )


def _buckets(
    sets: DataFrame, branches: float, runs: int, places: int, bucket: int
) -> tuple[DataFrame, DataFrame]:
    """Rows (bucket, node, members) of the buckets to be searched, and links (u, v) of dense ones."""
    children = _children(branches, runs, places)
    rows = sets.select("node", "signature").mapInArrow(children, "bucket long, node long")
    leaves = links = None
    while True:
        rows = stored(rows, "paths")
        shared = stored(
            rows.groupBy("bucket")
            .agg(F.count("*").alias("members"), F.min("node").alias("least"))
            .filter("members > 1"),
            "shared",
        )
        counted = rows.join(shared, "bucket")
        if shared.filter(F.col("members") > bucket).isEmpty():
            ends = counted.drop("least")
            return (ends if leaves is None else leaves.unionByName(ends)), links
        counted = stored(counted, "counted")
        large = stored(
            counted.filter(F.col("members") > bucket).join(sets.select("node", "signature"), "node"), "large"
        )
        dense = stored(_dense(large, places), "dense")
        # Splitting does not divide sets that are alike. They become one candidate component, in
        # which the verification compares all pairs.
        stars = large.join(dense, "bucket").select(F.col("node").alias("u"), F.col("least").alias("v"))
        links = stars if links is None else links.unionByName(stars)
        ends = counted.filter(F.col("members") <= bucket).drop("least")
        leaves = ends if leaves is None else leaves.unionByName(ends)
        # Sets of which fewer than half agree in a place are divided by each further level.
        sparse = large.join(dense, "bucket", "left_anti")
        rows = sparse.mapInArrow(children, "bucket long, node long")


def _blocked(rows: DataFrame, group: str, key: str, bucket: int) -> DataFrame:
    """Rows with part and side: groups above the bound become pairs of blocks.

    A row of block i meets block j in part (i, j), on side 0 if i is the smaller one.
    """
    blocks = F.ceil(F.col("members") / bucket).cast("int")
    own = F.pmod(F.xxhash64(key, F.lit(5)), blocks).cast("int")
    return (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn(
            "part", F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other"), "members")
        )
        .withColumn("side", F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int")))
        .drop("own", "other", "members")
    )


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole parts of rows that are sorted by part; several small ones come together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part").to_numpy()
        cut = int(np.searchsorted(part, part[-1]))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif held and held[-1].column("part")[-1].as_py() != part[0]:
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def local_roots(linked: np.ndarray) -> np.ndarray:
    """The least index of the component of each index."""
    count = len(linked)
    roots = np.arange(count)
    while True:
        lower = np.minimum(roots, np.where(linked, roots[None, :], count).min(axis=1, initial=count))
        lower = lower[lower]
        if np.array_equal(lower, roots):
            return roots
        roots = lower


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components, one for each node but the least of its component."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while True:
        lower = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(lower, root[a], least)
        np.minimum.at(lower, root[b], least)
        lower = lower[lower]
        if np.array_equal(lower, root):
            break
        root = lower
    some = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[some], nodes[root[some]]


def _meeting(side: np.ndarray) -> np.ndarray:
    """Which rows of a part are to be compared: all of one block, or those of different blocks."""
    meets = (side[:, None] != side[None, :]) | (side[:, None] < 0)
    np.fill_diagonal(meets, False)
    return meets


def _alike(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, dtype=np.int64),) * 2
        for table in parts(batches):
            table = table.combine_chunks()
            part, side = table.column("part").to_numpy(), table.column("side").to_numpy()
            node = table.column("node").to_numpy()
            signature = _matrix(table.column("signature").combine_chunks())
            new = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
            left, right = [held[0]], [held[1]]
            size = np.diff(new)
            # Buckets of two sets are most of all, so they are compared at once.
            pairs = new[:-1][size == 2]
            agree = (signature[pairs] == signature[pairs + 1]).mean(axis=1) >= least
            good = pairs[agree & ((side[pairs] < 0) | (side[pairs] != side[pairs + 1]))]
            left.append(node[good])
            right.append(node[good + 1])
            for begin, end in zip(new[:-1][size > 2], new[1:][size > 2]):
                own = signature[begin:end]
                agree = np.zeros((end - begin, end - begin), dtype=np.int16)
                for place in range(own.shape[1]):
                    agree += own[:, place][:, None] == own[:, place][None, :]
                roots = local_roots((agree >= least * own.shape[1]) & _meeting(side[begin:end]))
                moved = np.flatnonzero(roots != np.arange(end - begin))
                left.append(node[begin:end][moved])
                right.append(node[begin:end][roots[moved]])
            held = contracted(np.concatenate(left), np.concatenate(right))
            if len(held[0]) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["u", "v"])
                held = (np.zeros(0, dtype=np.int64),) * 2
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["u", "v"])

    return run


def _members(size: int, flags, n_bits: int):
    """The shingles of the first document of each set that is looked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = arrays.Bits(flags.value, n_bits)
        for batch, texts in arrays.slices(batches, "text"):
            sets = Sets(texts, size)
            low = arrays.signed(sets.sums(1))
            ids = batch.column("doc_id").to_numpy()[sets.rows]
            wanted = np.flatnonzero(bits.has(arrays.mixed(low.view(U64) ^ arrays.mixed(ids.view(U64)))))
            high = arrays.signed(sets.sums(2))
            ends = sets.begin + sets.size[sets.rows]
            for begin in range(0, len(wanted), 500):
                some = wanted[begin : begin + 500]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(low[some]),
                        pa.array(high[some]),
                        pa.array(ids[some]),
                        pa.array([sets.value[sets.begin[i] : ends[i]].tobytes() for i in some], pa.binary()),
                    ],
                    ["low", "high", "first_doc", "members_of_set"],
                )

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by blocks of the values that are shared."""
    values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    shared = count[place] > 1
    row, place = row[shared], rank[place[shared]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.int64)
    step = max(1, (1 << 22) // len(sets))
    for begin in range(0, int(place[-1]) + 1 if len(place) else 0, step):
        some = slice(*np.searchsorted(place, [begin, begin + step]))
        block = np.zeros((len(sets), step), dtype=np.float32)
        block[row[some], place[some] - begin] = 1
        total += (block @ block.T).astype(np.int64)
    return total


def _links(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in parts(batches):
            table = table.combine_chunks()
            part, side = table.column("part").to_numpy(), table.column("side").to_numpy()
            copies = table.column("copies").to_numpy()
            node = table.column("node").to_numpy()
            members = table.column("members_of_set")
            new = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
            links = np.zeros(len(part), dtype=np.int64)
            root = node.copy()
            for begin, end in zip(new[:-1], new[1:]):
                sets = [np.frombuffer(members[i].as_py(), dtype=U64) for i in range(begin, end)]
                size = np.array([len(s) for s in sets])
                both = intersections(sets)
                # I / (A + B - I) >= t, without division
                alike = both * (1.0 + threshold) >= threshold * (size[:, None] + size[None, :]) - 1e-9
                alike &= _meeting(side[begin:end])
                links[begin:end] = alike @ copies[begin:end]
                root[begin:end] = node[begin:end][local_roots(alike)]
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("low").combine_chunks().take(pa.array(some)),
                    table.column("high").combine_chunks().take(pa.array(some)),
                    pa.array(links[some]),
                    pa.array(root[some]),
                ],
                ["low", "high", "links", "root"],
            )

    return run


def _by_part(rows: DataFrame) -> DataFrame:
    # With a number of its own, as comparing takes much longer than the bytes of a partition tell.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "part").sortWithinPartitions("part")


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    recall: float = RECALL,
    places: int = PLACES,
    branches: float = BRANCHES,
    bucket: int = BUCKET,
) -> DataFrame:
    """Classes of documents whose shingle sets have a Jaccard similarity at the threshold or above.

    Returns a row per document: doc_id, text_hash (xxhash64 of the text), shingles, copy_id (least id
    with the same set), class_id (least id of the connected component) and n_links (other
    documents at the threshold or above, copies included).
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string")
    )
    rows = stored(docs.mapInArrow(_shingled(shingle, places), SHINGLES_SCHEMA), "shingles")
    real = rows.filter("doc_id is not null and shingles > 0")
    # A set is known by 128 bits; the lower half names it in links.
    sets = stored(
        real.groupBy("low", "high").agg(
            F.min("doc_id").alias("first_doc"),
            F.count("*").alias("copies"),
            F.first("signature").alias("signature"),
        ),
        "sets",
    ).withColumn("node", F.col("low"))
    runs = runs_needed(threshold, recall, branches)
    leaves, links = _buckets(sets, branches, runs, places, bucket)
    searched = _blocked(leaves, "bucket", "node", bucket).drop("bucket")
    edges = _by_part(searched.join(sets.select("node", "signature"), "node")).mapInArrow(
        _alike(threshold - SLACK), "u long, v long"
    )
    edges = edges if links is None else edges.unionByName(links)
    candidates = stored(components(edges), "candidates")
    wanted = stored(
        sets.drop("signature").join(candidates, "node"),
        "wanted",
    )
    key = _mixed_key("low", "first_doc")
    keyed = stored(wanted.select("low", "first_doc").mapInArrow(key, "hash long"), "wanted-bits")
    n_bits = bits_for(keyed.count())
    flags = spark.sparkContext.broadcast(hash_bits(keyed, "hash", n_bits))
    members = stored(
        docs.filter("doc_id is not null and text is not null")
        .select("doc_id", "text")
        .mapInArrow(
            _members(shingle, flags, n_bits), "low long, high long, first_doc long, members_of_set binary"
        )
        .join(wanted, ["low", "high", "first_doc"])
        .dropDuplicates(["low", "high"]),
        "members",
    )
    counts = stored(members.groupBy("root").agg(F.count("*").alias("members")), "member-counts")
    compared = _by_part(
        _blocked(members.join(counts.filter("members > 1"), "root"), "root", "high", bucket)
    ).mapInArrow(_links(threshold), "low long, high long, links long, root long")
    links = stored(compared, "links")
    classes = components(links.select(F.col("low").alias("u"), F.col("root").alias("v")))
    counted = links.groupBy("low", "high").agg(F.sum("links").alias("links"))
    known = (
        sets.select("low", "high", "node", "first_doc", "copies")
        .join(classes, "node", "left")
        .join(counted, ["low", "high"], "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    known = stored(known, "classes")
    least = known.groupBy("root").agg(F.min("first_doc").alias("class_id"))
    found = stored(
        known.join(least, "root").select(
            "low",
            "high",
            F.col("first_doc").alias("copy_id"),
            "class_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "found",
    )
    alone = rows.filter("doc_id is null or shingles = 0").select(
        "doc_id",
        "text_hash",
        "shingles",
        F.col("doc_id").alias("copy_id"),
        F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
    )
    return (
        real.select("doc_id", "text_hash", "shingles", "low", "high")
        .join(found, ["low", "high"])
        .select(*alone.columns)
        .unionByName(alone)
    )


def _mixed_key(low: str, doc: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy().view(U64) for c in (low, doc))
            yield pa.RecordBatch.from_arrays(
                [pa.array(arrays.signed(arrays.mixed(a ^ arrays.mixed(b))))], ["hash"]
            )

    return run
