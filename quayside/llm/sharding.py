"""Sharding by sampled splitters: shards of nearly equal bytes, without a global sort.

Records are ordered by the hash of their text and then by id, so equal texts stand together and
a large group of them can still be divided.

1. Sample: keys are drawn with a probability that grows with their size. Quantiles of the sample
   are the splitters of many small ranges.
2. Bytes and rows of every range are counted over all records. Ranges that are too full are divided by
   splitters that are sampled in them, again and again until none is.
3. Records go to their range by one shuffle and are sorted there. The sums of the ranges before
   give each record its place among all bytes and all rows, and with them shard and slot.

Shards are consecutive stretches of equal bytes; a record belongs to the shard that holds its middle, so a
shard is off by no more than half a record at each end. Slots count the records of a shard from 0.

Records equal in text and id stand at one key that no splitter divides, and their order does not matter. If they are
too many for a range, they are dealt over parts by chance and written down, so that the parts keep
their records when a task runs again; a part is then to them what a range is to others.

Nulls, empty and repeated rows: a null text has no bytes but the fixed ones, a null id comes first.
An empty table gives no rows. Columns named size, shard or slot are replaced, others keep their names and values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import prepare, stored

SHARDS = 40
OVERHEAD = 16
#: Target bytes of a range; there are at least RANGES_EACH of them for each shard.
RANGE_BYTES = 64 << 20
RANGES_EACH = 8
#: Expected keys drawn for each range, and times the target bytes that make a range too full.
DRAWN_EACH = 20
FULL = 2.0


def _assigned(splitters):
    """The range of each key: how many splitters are not greater."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = splitters.value
        for batch in batches:
            key = batch.column("key").to_numpy()
            id_ = batch.column("id").to_numpy()
            low, high = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
            place = low.copy()
            # Splitters within one key, that is within a group of equal texts, are compared by id.
            for begin, end in {(a, b) for a, b in zip(low.tolist(), high.tolist()) if a < b}:
                rows = np.flatnonzero((low == begin) & (high == end))
                place[rows] = begin + np.searchsorted(ids[begin:end], id_[rows], side="right")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place.astype(np.int64))], [*batch.schema.names, "range"]
            )

    return run


def _ranged(rows: DataFrame, splitters: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(splitters)
    return rows.mapInArrow(_assigned(shared), T.StructType([*rows.schema, T.StructField("range", T.LongType())]))


def _drawn(rows: DataFrame, step: float, salt: int) -> DataFrame:
    """Keys drawn with probability size / step (1 if that is more), and the bytes each stands for."""
    chance = F.least(F.lit(1.0), F.col("size") / step)
    luck = F.pmod(F.xxhash64("key", "id", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(luck < chance).select("key", "id", (F.col("size") / chance).alias("weight"))


def _quantiles(sample: pa.Table, bytes_each: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys at which another ``bytes_each`` of the sampled bytes begin."""
    key, id_, weight = (sample.column(c).to_numpy() for c in ("key", "id", "weight"))
    order = np.lexsort((id_, key))
    sums = np.cumsum(weight[order])
    cuts = np.searchsorted(sums, np.arange(bytes_each, sums[-1] if len(sums) else 0, bytes_each))
    cuts = np.unique(cuts[cuts < len(order)])
    return key[order][cuts], id_[order][cuts]


def _merged(first: tuple, second: tuple) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(
        np.rec.fromarrays(
            [np.concatenate([first[0], second[0]]), np.concatenate([first[1], second[1]])], names="key,id"
        )
    )
    return np.ascontiguousarray(pairs["key"]), np.ascontiguousarray(pairs["id"])


def find_splitters(thin: DataFrame, bytes_each: float) -> tuple[np.ndarray, np.ndarray]:
    """Splitters of ranges none of which holds more than FULL times ``bytes_each``, but for those of a single key.

    About DRAWN_EACH keys for each range reach the driver, none of the records.
    """
    step = max(1.0, bytes_each / DRAWN_EACH)
    splitters = _quantiles(_drawn(thin, step, 1).toArrow(), bytes_each)
    place, salt = F.struct("key", "id"), 1
    while True:
        ranged = _ranged(thin, splitters)
        sums = ranged.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.min(place).alias("first"), F.max(place).alias("last")
        )
        full = F.broadcast(sums.filter((F.col("bytes") > FULL * bytes_each) & (F.col("first") < F.col("last"))))
        inside = stored(ranged.join(full.select("range", "first"), "range"), "overfull")
        if inside.isEmpty():
            return splitters
        salt += 1
        # Half the size of a range, so that sampling errors can't leave it too full for long.
        more = _quantiles(_drawn(inside, step / salt, salt).toArrow(), bytes_each / 2)
        # Where the sample knows a single key, the key after the first one divides the range.
        after = inside.filter(place > F.col("first")).groupBy("range").agg(F.min(place).alias("next")).select("next.*")
        after = after.toArrow()
        splitters = _merged(splitters, more)
        splitters = _merged(splitters, tuple(after.column(c).to_numpy() for c in ("key", "id")))


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    overhead: int = OVERHEAD,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The columns of docs (doc_id and text among them), and size, shard and slot.

    size is the bytes of the text in UTF-8 and the overhead. Rows of a shard come from few
    partitions and are in the order of their slots there.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop("size", "shard", "slot")
    text = F.col("text").cast("string")
    # The given columns stay together in one, so that none can clash with those of this work.
    keyed = docs.select(
        F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns)).alias("row"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.xxhash64(text).alias("key"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
    )
    thin = stored(keyed.select("key", "id", "size"), "keys")
    total = thin.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bytes_each = max(1.0, min(float(range_bytes), total / (shards * RANGES_EACH)))
    splitters = find_splitters(thin, bytes_each)
    thin, keyed = (_ranged(rows, splitters).withColumn("part", F.lit(0).cast("long")) for rows in (thin, keyed))
    sums = stored(thin.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "ranges")
    # There are no more of them than ranges of that size.
    single = sums.filter(F.col("bytes") > FULL * bytes_each).select("range", "bytes")
    if not single.isEmpty():
        thin, keyed = _dealt(thin, keyed, single, bytes_each)
        sums = thin.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    else:
        sums = sums.withColumn("part", F.lit(0).cast("long"))
    ordered = Window.partitionBy("range", "part").orderBy("key", "id", "size")
    until = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # One row for each range: a running sum over them is a small job of its own.
    counted = sums.toArrow().sort_by([("range", "ascending"), ("part", "ascending")])
    b, n = (counted.column(c).to_numpy() for c in ("bytes", "n"))
    before = spark.createDataFrame(
        pa.table(
            {
                "range": counted.column("range"),
                "part": counted.column("part"),
                "bytes": pa.array(np.cumsum(b) - b, pa.int64()),
                "rows": pa.array(np.cumsum(n) - n, pa.int64()),
            }
        )
    )

    def placed(rows: DataFrame) -> DataFrame:
        # Twice the place of a record's middle among all bytes.
        middle = 2 * (F.col("bytes") + F.sum("size").over(until)) - F.col("size")
        return (
            rows.join(before, ["range", "part"])
            .withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2 * total))).cast("int"))
            .withColumn("rank", F.col("rows") + F.row_number().over(ordered) - 1)
        )

    firsts = stored(placed(thin).groupBy("shard").agg(F.min("rank").alias("first")), "shards")
    return (
        placed(keyed)
        .join(firsts, "shard")
        .withColumn("slot", F.col("rank") - F.col("first"))
        .select("row.*", "size", "shard", "slot")
    )


def _dealt(
    thin: DataFrame, keyed: DataFrame, single: DataFrame, bytes_each: float
) -> tuple[DataFrame, DataFrame]:
    """The rows with those of overfull ranges of a single key dealt over parts.

    Such rows are equal in all that counts, so chance may deal them; what it gave is kept in a table.
    """
    parts = single.select("range", F.ceil(F.col("bytes") / bytes_each).cast("long").alias("parts"))
    parts = F.broadcast(parts)
    chance = F.floor(F.rand() * F.col("parts")).cast("long")
    dealt = keyed.join(parts, "range").withColumn("part", chance).drop("parts").select(keyed.columns)
    dealt = stored(dealt, "dealt")
    others = [rows.join(parts.select("range"), "range", "left_anti").select(rows.columns) for rows in (thin, keyed)]
    return others[0].unionByName(dealt.select(thin.columns)), others[1].unionByName(dealt)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write each shard to a folder of its own."""
    sharded.write.partitionBy("shard").parquet(path)
