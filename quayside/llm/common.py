"""Helpers that the operators of this package share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import scratch_dir, ship_package

# Texts may be long, so batches that go to Python are bounded by bytes, not only by rows.
ARROW_BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Make Python tasks of this package ready to run."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared scratch folder, which cuts the lineage.

    Lost executors can't take these rows with them, and two readers don't compute them twice.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_number(column: str = "doc_id", folds: int = 3) -> Column:
    """The remainder of the CRC32 of an id as text; null ids count as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(folds)).cast("int")


def hash_bits(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which of 2**bits numbers occur as low bits of a hash, 64 flags in a number.

    At most 2**(bits - 6) rows reach the driver, whatever the number of hashes is.
    """
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    found = (
        hashes.select(low.alias("low"))
        .groupBy(F.shiftright("low", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(low & 63 as int))")).alias("flags"))
        .toArrow()
    )
    words = np.zeros(1 << max(0, bits - 6), dtype=np.int64)
    words[found.column("word").to_numpy()] = found.column("flags").to_numpy()
    return words


#: Hash bits for each value that is looked for, and the bounds of the table (2**n bits).
BITS_EACH, LEAST_BITS, MOST_BITS = 32, 20, 28


def bits_for(count: int) -> int:
    """Number of low hash bits that keep false positives at about one in BITS_EACH or less."""
    return min(MOST_BITS, max(LEAST_BITS, (count * BITS_EACH).bit_length()))


#: Rows of short columns that are broadcast at most.
BROADCAST_ROWS = 1_000_000


def lookup(rows: DataFrame, label: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """The rows as a table, to be broadcast in joins if their number is within a bound."""
    rows = stored(rows, label)
    return F.broadcast(rows) if rows.count() <= most else rows


def schema_with(rows: DataFrame, added: str) -> T.StructType:
    """The schema of the rows and further fields (as DDL), whatever the names in it."""
    return T.StructType([*rows.schema, *T._parse_datatype_string(added)])


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Names for work columns that no given column has, whatever its case."""
    known = {name.lower() for name in taken}
    found = []
    for name in wanted:
        while name.lower() in known:
            name = f"_{name}"
        known.add(name.lower())
        found.append(name)
    return found
