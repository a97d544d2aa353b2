"""Approximate nearest neighbours by cosine with a forest of hash prefixes.

A tree gives each vector a string of 64 bits, the sides of random planes it lies on, and keeps the
vectors sorted by it. A query descends to the places with the longest common prefix in every tree;
then all trees ascend together, one bit at a time, until they hold enough candidates. All
candidates get their exact cosine in double precision.

- Equal vectors are one entry with its least ids, so copies do not fill buckets.
- A tree is cut into parts by prefixes, which are made longer, up to all bits, where a part is still
  too large. A prefix range is inside a part or is a union of parts, so counts are exact and no query
  misses a part.
- Near copies may share all bits. Such a part is dealt by hash over slices of about PART entries; queries
  go to all slices, their counts are added and the best of each are merged. Queries of a slice are dealt
  over blocks, each with the entries of the slice.
- Where the candidates of all trees, repeated ones counted, would be as many as a tree has entries, a query ascends to
  the root instead. There all trees hold the same entries, so it visits the first tree only and rates
  each entry once.
- Where few queries ask, handing the entries to the other trees would be most of the work. They are then handed to the
  first tree only, and the strings of all trees tell there which of them are candidates of a query. Both ways
  rate the same candidates, so results don't depend on the choice.
- How many candidates are enough is measured: a bounded sample of queries is compared with
  all vectors, and the number is the one that finds TARGET of their true neighbours. On vectors
  without structure that may be a large share of all of them.

Every valid row is indexed. Rows whose vector is null, empty, zero, or holds a null or a number that is
not finite take no part; vectors are compared with those of their own length only. Ties go to the
smaller id. Rows without an id take no part; repeated rows (an id with the same vector) count once.
An empty table, or one without a valid query, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import arrays
from quayside.llm.common import prepare, stored

TREES = 16
BITS = 64
#: Entries of a part, and the greatest length of the prefixes that first cut a tree.
PART, DEPTH = 20_000, 14
#: Queries that meet the entries of a slice in one task.
QUESTIONS = 20_000
#: Candidates that can be rated for what it costs to hand an entry to one more tree.
HANDED = 256
#: Counts of longer prefixes that reach the driver in a round: 2**ROUND at most, or two for each overfull part.
ROUND = 18
SAMPLE = 200
TARGET = 0.97
LEAST = 200
SEED = 20_011
U64 = arrays.U64


def _planes(dimension: int, trees: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, trees * BITS))


def _strings(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Hash strings as numbers whose first bit is the highest: (vectors, trees)."""
    out = np.zeros((len(vectors), planes.shape[1] // BITS), dtype=U64)
    for begin in range(0, len(vectors), 4096):
        side = (vectors[begin : begin + 4096] @ planes > 0).reshape(-1, out.shape[1], BITS)
        out[begin : begin + 4096] = np.packbits(side, axis=2).view(">u8")[:, :, 0]
    return out


def _range(strings: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """First and last string with the same first bits."""
    level = np.asarray(level, dtype=U64)
    rest = np.where(level >= BITS, U64(0), U64(0xFFFFFFFFFFFFFFFF) >> np.minimum(level, U64(63)))
    return strings & ~rest, strings | rest


@dataclass
class Forest:
    dimension: int
    trees: int
    #: For each tree the first strings of its parts, in order, and the entries before each part.
    starts: list[np.ndarray]
    before: list[np.ndarray]
    #: Entries of a slice.
    most: int

    def __post_init__(self):
        self.planes = _planes(self.dimension, self.trees)
        #: For each tree the slices before each part. A slice is known by its number in the tree.
        self.slices = [
            np.append(0, np.cumsum(np.maximum(1, -(-np.diff(before) // self.most)))) for before in self.before
        ]


def _cut(
    prefixes: np.ndarray, counts: np.ndarray, depth: int, most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts from the counts of prefixes of ``depth`` bits: first prefixes, sizes, and which can't be cut here."""
    full = np.zeros(1 << depth, dtype=np.int64)
    full[prefixes] = counts
    total = np.append(0, np.cumsum(full))
    starts = []

    def split(begin: int, size: int) -> None:
        if size == 1 or total[begin + size] - total[begin] <= most:
            starts.append(begin)
        else:
            split(begin, size // 2)
            split(begin + size // 2, size // 2)

    split(0, 1 << depth)
    at = np.array(starts)
    sizes = np.diff(np.append(total[at], total[-1]))
    return at, sizes, sizes > most


def _vectors(column: pa.Array, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dimension)


def _prefixes(dimension: int, trees: int, depth: int, within: int, overfull: list[np.ndarray] | None):
    """Counts of prefixes of ``depth`` bits, of those only that begin with an overfull one of ``within`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _planes(dimension, trees)
        for batch in batches:
            strings = _strings(_vectors(batch.column("vector"), dimension), planes)
            for tree in range(trees):
                own = strings[:, tree]
                if overfull is not None:
                    own = own[np.isin(own >> U64(BITS - within), overfull[tree])]
                prefix = own >> U64(BITS - depth) if depth else own * U64(0)
                found, n = np.unique(arrays.signed(prefix), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), tree)), pa.array(found), pa.array(n)], ["tree", "prefix", "n"]
                )

    return run


def plant(entries: DataFrame, dimension: int, count: int, trees: int, part: int) -> Forest:
    """The cuts of all trees, in rounds of longer prefixes over the parts that are still too large.

    At most trees * 2**DEPTH counts reach the driver in the first round and 2**ROUND in the others, or two for
    each overfull part, of which there are at most trees * count / part.
    """
    depth = min(DEPTH, max(0, int(np.ceil(np.log2(max(1, count) / part))) + 2)) if count > part else 0
    within, overfull = 0, None
    #: First strings and sizes of the parts of each tree.
    parts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(trees)]
    while True:
        found = (
            entries.select("vector")
            .mapInArrow(_prefixes(dimension, trees, depth, within, overfull), "tree long, prefix long, n long")
            .groupBy("tree", "prefix")
            .agg(F.sum("n").alias("n"))
            .toArrow()
        )
        tree, prefix, n = (found.column(c).to_numpy() for c in ("tree", "prefix", "n"))
        prefix = prefix.view(U64)
        step = depth - within
        left = []
        for t in range(trees):
            order = np.flatnonzero(tree == t)
            order = order[np.argsort(prefix[order])]
            own, counts = prefix[order], n[order]
            left_here = []
            for root in [U64(0)] if overfull is None else overfull[t]:
                base = root << U64(step)
                a = np.searchsorted(own, base)
                b = np.searchsorted(own, base + U64((1 << step) - 1), side="right")
                at, sizes, full = _cut((own[a:b] - base).astype(np.int64), counts[a:b], step, part)
                first = base + at.astype(U64)
                more = full if depth < BITS else np.zeros(len(full), dtype=bool)
                left_here.append(first[more])
                parts[t].append(((first << U64(BITS - depth) if depth else first)[~more], sizes[~more]))
            left.append(np.concatenate(left_here) if left_here else np.zeros(0, dtype=U64))
        n_left = sum(map(len, left))
        if not n_left:
            break
        within, overfull = depth, left
        depth = min(BITS, depth + max(1, ROUND - int(np.ceil(np.log2(n_left)))))
    starts, before = [], []
    for own in parts:
        first, sizes = (np.concatenate(x) for x in zip(*own))
        order = np.argsort(first)
        starts.append(first[order])
        before.append(np.append(0, np.cumsum(sizes[order])))
    return Forest(dimension, trees, starts, before, part)


def _dealt(forest, with_vector: bool, asks: bool = False, trees: int | None = None, blocks=None):
    """A row for each tree: the slice where the string of an entry is kept; queries go to all slices of the part.

    ``trees`` are the first ones that are needed, ``blocks`` the blocks of queries of each slice: entries go to all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for batch in batches:
            strings = _strings(_vectors(batch.column("vector"), f.dimension), f.planes)
            node = batch.column("node").to_numpy()
            salt = arrays.mixed(node.astype(np.int64).view(U64))
            for tree in range(trees or f.trees):
                own = strings[:, tree]
                part = np.searchsorted(f.starts[tree], own, side="right") - 1
                first, n = f.slices[tree][part], np.diff(f.slices[tree])[part]
                if asks:
                    yield from _copied(first, n, tree, {"node": node, "string": arrays.signed(own)})
                    continue
                columns = [
                    pa.array(np.full(len(own), tree, dtype=np.int32)),
                    pa.array((first + (salt % n.astype(U64)).astype(np.int64)).astype(np.int32)),
                    batch.column("node"),
                    pa.array(arrays.signed(own)),
                ]
                if with_vector:
                    columns.append(batch.column("vector"))
                names = ["tree", "part", "node", "string", "vector"][: len(columns)]
                if blocks is None:
                    yield pa.RecordBatch.from_arrays(columns, names)
                    continue
                here = blocks.value[tree][columns[1].to_numpy()]
                for block in range(int(here.max(initial=0))):
                    rows = pa.array(np.flatnonzero(here > block))
                    number = pa.array(np.full(len(rows), block, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [*(column.take(rows) for column in columns), number], [*names, "block"]
                    )

    return run


def _copied(first: np.ndarray, n: np.ndarray, tree: int, columns: dict) -> Iterator[pa.RecordBatch]:
    """Row i once for each of the n[i] slices from first[i] on, in batches of bounded size."""
    ends = np.cumsum(n)
    for a in range(0, int(ends[-1]) if len(ends) else 0, 5000):
        place = np.arange(a, min(a + 5000, int(ends[-1])))
        row = np.searchsorted(ends, place, side="right")
        slice_ = first[row] + place - (ends - n)[row]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(row), tree, dtype=np.int32)),
                pa.array(slice_.astype(np.int32)),
                *(pa.array(c[row]) if isinstance(c, np.ndarray) else c.take(pa.array(row)) for c in columns.values()),
            ],
            ["tree", "part", *columns],
        )


def _profile(forest, enough: int):
    """How many entries share at least a number of bits with each query of this slice of a part."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        f = forest.value
        tree, slice_ = key[0].as_py(), key[1].as_py()
        part = int(np.searchsorted(f.slices[tree], slice_, side="right")) - 1
        leads = slice_ == f.slices[tree][part]
        strings = table.column("string").to_numpy().view(U64)
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        node = table.column("node").to_numpy()
        entries = np.sort(strings[~asks])
        queries, names = strings[asks], node[asks]
        starts, before = f.starts[tree], f.before[tree]
        last_start = starts[part + 1] - U64(1) if part + 1 < len(starts) else U64(0xFFFFFFFFFFFFFFFF)
        out: list[tuple[np.ndarray, int, np.ndarray]] = []
        held = np.zeros(len(queries), dtype=np.int64)
        open_ = np.arange(len(queries))
        for level in range(BITS, -1, -1):
            if not len(open_):
                break
            low, high = _range(queries[open_], level)
            inside = (low >= starts[part]) & (high <= last_start)
            own = np.searchsorted(entries, high, side="right") - np.searchsorted(entries, low)
            whole = before[np.searchsorted(starts, high, side="right")] - before[
                np.searchsorted(starts, low)
            ]
            # Of ranges beyond the part, whose counts are known, the first slice tells.
            held = np.where(inside, own, whole if leads else 0)
            some = held > 0
            out.append((names[open_[some]], level, held[some]))
            open_ = open_[held < enough]
        return pa.table(
            {
                "node": pa.array(np.concatenate([o[0] for o in out]) if out else [], pa.int64()),
                "level": pa.array(
                    np.concatenate([np.full(len(o[0]), o[1]) for o in out]) if out else [], pa.int32()
                ),
                "held": pa.array(np.concatenate([o[2] for o in out]) if out else [], pa.int64()),
            }
        )

    return run


def _levels(entries: DataFrame, queries: DataFrame, forest, enough: int) -> DataFrame:
    """Entries of all trees that share at least ``level`` bits with a query: (node, level, held)."""
    places = "tree int, part int, node long, string long"
    both = (
        entries.select("node", "vector")
        .mapInArrow(_dealt(forest, False), places)
        .withColumn("asks", F.lit(False))
        .unionByName(
            queries.select("node", "vector")
            .mapInArrow(_dealt(forest, False, asks=True), places)
            .withColumn("asks", F.lit(True))
        )
    )
    return (
        both.groupBy("tree", "part")
        .applyInArrow(_profile(forest, enough), "node long, level int, held long")
        .groupBy("node", "level")
        .agg(F.sum("held").alias("held"))
    )


def _visits(forest, one_tree: bool):
    """The slices that hold strings with the first ``level`` bits of a query, or all slices of the first tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for batch in batches:
            strings = _strings(_vectors(batch.column("vector"), f.dimension), f.planes)
            level = batch.column("level").to_numpy()
            for tree in range(1 if one_tree else f.trees):
                low, high = _range(strings[:, tree], 0 if one_tree else level)
                if tree:
                    # At the root every tree has the same entries.
                    rows = np.flatnonzero(level > 0)
                    batch, strings, level = batch.take(pa.array(rows)), strings[rows], level[rows]
                    low, high = low[rows], high[rows]
                first = f.slices[tree][np.searchsorted(f.starts[tree], low, side="right") - 1]
                n = f.slices[tree][np.searchsorted(f.starts[tree], high, side="right")] - first
                columns = {
                    "node": batch.column("node"),
                    "string": arrays.signed(strings[:, tree]),
                    "vector": batch.column("vector"),
                    "level": level.astype(np.int32),
                }
                yield from _copied(first, n, tree, columns)

    return run


def _blocks(forest: Forest, visits: DataFrame) -> list[np.ndarray]:
    """How many blocks of queries each slice of each tree has. Slices that nobody visits have none."""
    counts = visits.groupBy("tree", "part").agg(F.count("*").alias("n")).toArrow()
    out = [np.zeros(int(slices[-1]), dtype=np.int64) for slices in forest.slices]
    tree, part, n = (counts.column(c).to_numpy() for c in ("tree", "part", "n"))
    for t in range(forest.trees):
        own = tree == t
        out[t][part[own]] = -(-n[own] // QUESTIONS)
    return out


def _blocked(blocks):
    """The block of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, part, node = (batch.column(c).to_numpy() for c in ("tree", "part", "node"))
            count = np.ones(len(node), dtype=np.int64)
            for t in np.unique(tree).tolist():
                count[tree == t] = blocks.value[t][part[tree == t]]
            own = arrays.mixed(node.astype(np.int64).view(U64)) % count.astype(U64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.astype(np.int32))], [*batch.schema.names, "block"]
            )

    return run


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors, scaled where their squares would leave the range of doubles."""
    most = np.abs(vectors).max(axis=1, initial=0.0, keepdims=True)
    return np.where((most > 1e100) | (most < 1e-100), vectors / most, vectors)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines of one vector with others, summed in the same order wherever they stand."""
    query, vectors = _scaled(query[None, :]), _scaled(vectors)
    dots = (vectors * query).sum(axis=1)
    return (dots / (_norms(query) * _norms(vectors))).clip(-1.0, 1.0)


class Rated:
    """Vectors made ready for many queries."""

    def __init__(self, vectors: np.ndarray, nodes: np.ndarray):
        self.vectors, self.nodes, self.places = vectors, nodes, np.arange(len(nodes))
        scaled = _scaled(vectors)
        self.units = scaled / _norms(scaled)[:, None]

    def best(self, query: np.ndarray, within: slice | np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and cosines of the nearest of some, ties to smaller nodes."""
        # Quick scores may be off by rounding: what is near the last one kept is scored again.
        quick, some = self.units[within] @ _scaled(query[None, :])[0], self.places[within]
        if len(quick) > keep:
            least = np.partition(quick, len(quick) - keep)[len(quick) - keep]
            some = some[quick >= least - 1e-9 * np.abs(quick).max()]
        scores = cosines(query, self.vectors[some])
        order = np.lexsort((self.nodes[some], -scores))[:keep]
        return self.nodes[some][order], scores[order]


def _rated(forest, keep: int, one_tree: bool):
    """The best candidates of each query among the entries of a slice.

    Slices of one tree alone hold the candidates of all trees: what shares ``level`` bits in any of them.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        f = forest.value
        strings = table.column("string").to_numpy().view(U64)
        asks = table.column("level").to_numpy(zero_copy_only=False)
        asks = ~np.isnan(asks.astype(np.float64))
        node = table.column("node").to_numpy()
        vectors = _vectors(table.column("vector").combine_chunks(), f.dimension)
        entries, questions = np.flatnonzero(~asks), np.flatnonzero(asks)
        entries = entries[np.argsort(strings[entries], kind="stable")]
        ordered, rated = strings[entries], Rated(vectors[entries], node[entries])
        levels = table.column("level").take(pa.array(questions)).to_numpy()
        low, high = _range(strings[questions], levels)
        begin, end = np.searchsorted(ordered, low), np.searchsorted(ordered, high, side="right")
        if one_tree and len(levels) and levels.max() > 0:
            leads = np.ascontiguousarray(_strings(rated.vectors, f.planes).T)
            asked = _strings(vectors[questions], f.planes)
            rest = _range(asked, levels[:, None])[1] ^ _range(asked, levels[:, None])[0]
        query, found, score = [], [], []
        for place, (i, a, b) in enumerate(zip(questions, begin, end)):
            some = slice(a, b)
            if one_tree and levels[place] > 0:
                near = (leads ^ asked[place][:, None]) <= rest[place][:, None]
                some = np.flatnonzero(near.any(axis=0))
            near, cosine = rated.best(vectors[i], some, keep)
            if not len(near):
                continue
            query.append(np.full(len(near), node[i]))
            found.append(near)
            score.append(cosine)
        return pa.table(
            {
                "query": pa.array(np.concatenate(query) if query else [], pa.int64()),
                "node": pa.array(np.concatenate(found) if found else [], pa.int64()),
                "score": pa.array(np.concatenate(score) if score else [], pa.float64()),
            }
        )

    return run


def _all_rated(questions, keep: int, dimension: int):
    """The best of a batch for each of a few queries, by comparing all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vectors = questions.value
        for batch in batches:
            rated = Rated(_vectors(batch.column("vector"), dimension), batch.column("node").to_numpy())
            for name, vector in zip(names, vectors):
                near, cosine = rated.best(vector, slice(None), keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(near), name)), pa.array(near), pa.array(cosine)],
                    ["query", "node", "score"],
                )

    return run


def _top(rated: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    return (
        rated.dropDuplicates(["query", "node"])
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= keep)
    )


def enough_candidates(
    entries: DataFrame, queries: DataFrame, forest, keep: int, sample: int, target: float
) -> int:
    """The number of candidates that finds the target share of the true neighbours of some queries."""
    spark = entries.sparkSession
    chosen = queries.orderBy(F.xxhash64("node"), "node").limit(sample).select("node", "vector")
    rows = chosen.toArrow()
    if not rows.num_rows:
        return LEAST
    dimension = forest.value.dimension
    questions = spark.sparkContext.broadcast(
        (rows.column("node").to_numpy(), _vectors(rows.column("vector").combine_chunks(), dimension))
    )
    true = _top(
        entries.select("node", "vector").mapInArrow(
            _all_rated(questions, keep, dimension), "query long, node long, score double"
        ),
        keep,
    )
    close = true.join(entries.select("node", "vector"), "node").select("query", "vector").toArrow()
    levels = _levels(entries, spark.createDataFrame(rows), forest, np.iinfo(np.int64).max).toArrow()
    names, vectors = questions.value
    place = {name: i for i, name in enumerate(names.tolist())}
    strings = _strings(vectors, forest.value.planes)
    near = _strings(_vectors(close.column("vector").combine_chunks(), dimension), forest.value.planes)
    own = np.array([place[q] for q in close.column("query").to_pylist()], dtype=np.int64)
    # Bits in common, in the tree where these are most.
    common = np.array(
        [max(BITS - int(x).bit_length() for x in row) for row in strings[own] ^ near], dtype=np.int64
    )
    held = np.zeros((len(names), BITS + 2), dtype=np.int64)
    asked = [place[q] for q in levels.column("node").to_pylist()]
    held[asked, levels.column("level").to_numpy()] = levels.column("held").to_numpy()
    # A neighbour is found if one level further down there were not enough candidates yet.
    need = np.sort(held[own, common + 1] + 1)
    return max(LEAST, int(need[min(len(need) - 1, int(np.ceil(target * len(need))))]))


def _valid(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & good & F.exists(vector, lambda x: x != 0)


def nearest(
    rows: DataFrame,
    queries: Column,
    k: int = 5,
    trees: int = TREES,
    part: int = PART,
    sample: int = SAMPLE,
    target: float = TARGET,
) -> DataFrame:
    """The k nearest other rows of each row for which ``queries`` holds.

    rows: vec_id and embedding. Returns query_id, rank (from 1), vec_id and score, the cosine.
    """
    spark = rows.sparkSession
    prepare(spark)
    keep = k + 1
    doubles = F.col("embedding").cast("array<double>")
    valid = (
        rows.filter(F.col("vec_id").isNotNull())
        .select(
            F.col("vec_id").cast("long"), doubles.alias("values"), queries.alias("asks")
        )
        .filter(_valid(F.col("values")))
        .withColumn("dimension", F.size("values"))
        # Two hashes stand for the vector where rows are grouped and joined.
        .withColumn("h1", F.xxhash64("values"))
        .withColumn("h2", F.xxhash64(F.lit(1), "values"))
    )
    # The least ids of each distinct vector are all that a result can hold of them; the limit
    # works before the shuffle, so copies don't meet in one task.
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    entries = stored(
        valid.dropDuplicates(["vec_id", "h1", "h2"])
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= keep)
        .groupBy("h1", "h2", "dimension")
        .agg(
            F.sort_array(F.collect_list("vec_id")).alias("ids"),
            F.min_by("values", "place").alias("values"),
        )
        .withColumn("node", F.element_at("ids", 1))
        .mapInArrow(
            _packed, "h1 long, h2 long, dimension int, ids array<long>, node long, vector binary"
        ),
        "vectors",
    )
    asking = stored(valid.filter("asks").select("vec_id", "h1", "h2").distinct(), "asking")
    found = None
    for row in entries.groupBy("dimension").agg(F.count("*").alias("n")).orderBy("dimension").collect():
        own = entries.filter(F.col("dimension") == row.dimension)
        asked = own.join(asking.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi")
        forest = spark.sparkContext.broadcast(plant(own, row.dimension, row.n, trees, part))
        enough = enough_candidates(own, asked, forest, keep, sample, target)
        levels = _levels(own, asked, forest, enough)
        # Levels with enough candidates; where they are as many as a tree has entries, the root.
        deepest = stored(
            levels.filter((F.col("held") >= enough) & (F.col("held") < row.n))
            .groupBy("node")
            .agg(F.max("level").alias("level"), F.max_by("held", "level").alias("held"))
            .join(asked.select("node"), "node", "right")
            .select("node", F.coalesce("level", F.lit(0)).alias("level"), F.coalesce("held", F.lit(row.n)).alias("held")),
            "levels",
        )
        work = deepest.agg(F.count("*").alias("asked"), F.sum("held").alias("held"), F.max("level").alias("level")).first()
        # The way that is less work; both have the same candidates.
        one_tree = not work.level or work.asked * row.n <= work.held + (trees - 1) * row.n * HANDED
        used = 1 if one_tree else trees
        places = "tree int, part int, node long, string long, vector binary"
        visits = (
            asked.select("node", "vector")
            .join(deepest.select("node", "level"), "node")
            .mapInArrow(_visits(forest, one_tree), places + ", level int")
        )
        blocks = _blocks(forest.value, visits)
        spread = spark.sparkContext.broadcast(blocks)
        kept = own.select("node", "vector").mapInArrow(
            _dealt(forest, True, trees=used, blocks=spread), places + ", block int"
        )
        rated = (
            kept.withColumn("level", F.lit(None).cast("int"))
            .unionByName(visits.mapInArrow(_blocked(spread), places + ", level int, block int"))
            .groupBy("tree", "part", "block")
            .applyInArrow(_rated(forest, keep, one_tree), "query long, node long, score double")
        )
        best = _top(rated, keep).select("query", "node", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = stored(
        found.join(entries.select("node", "ids"), "node")
        .groupBy("query")
        .agg(F.collect_list(F.struct("score", "ids")).alias("found"))
        .join(entries.select(F.col("node").alias("query"), "h1", "h2"), "query"),
        "found",
    )
    # Sorted by falling score and rising id.
    near = F.flatten(
        F.transform(
            "found", lambda f: F.transform(f["ids"], lambda i: F.struct((-f["score"]).alias("s"), i.alias("i")))
        )
    )
    others = F.filter(F.array_sort(near), lambda x: x["i"] != F.col("vec_id"))
    return (
        asking.join(found, ["h1", "h2"])
        .select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("at", "near"))
        .select(
            "query_id",
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("near.i").alias("vec_id"),
            (-F.col("near.s")).alias("score"),
        )
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as the bytes of their doubles."""
    for batch in batches:
        values = batch.column("values")
        flat, at = values.values.to_numpy(zero_copy_only=False), values.offsets.to_numpy()
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("h1", "h2", "dimension", "ids", "node")),
                pa.array([flat[a:b].astype(np.float64).tobytes() for a, b in zip(at, at[1:])], pa.binary()),
            ],
            ["h1", "h2", "dimension", "ids", "node", "vector"],
        )
