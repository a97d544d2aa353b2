"""Search for words in the log store, with an index of the words of its files.

The index holds a bitmap for each file: the bits that the hashes of its words set among 2**24, in pieces of
32,768 bits, of which only those with a bit are kept. A word is in a file only if its bit is set, so a search
opens the files in which all bits of its words are set, and those that are not indexed yet. Files are known by
their date folder and name; the log store never changes a file.

A word is a run of letters, digits and underscores, in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.logs import search
from quayside.sources.objects import list_objects

WORD = r"[\p{L}\p{N}_]+"
#: Bits of the bitmaps of a file.
BITS = 24
#: Files that a search names to the reader; if more are needed, the dates are read as a whole.
NAMED_FILES = 10_000

_FILE = r"(log_date=[^/]+/[^/]+)$"
_DATE = r"^log_date=([^/]+)/"


def words(text: Column) -> Column:
    """The distinct words of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def _place(word: Column) -> Column:
    # Bitmap functions count from 1.
    return F.pmod(F.xxhash64(word), F.lit(1 << BITS)) + 1


def index_files(spark: SparkSession, store: str, index: str, dates: list[str] | None = None) -> None:
    """Write the bitmaps of all files of some dates (or of all) of a log store, in place of earlier ones.

    Every task reads its files once; what is shuffled are bit positions, each once for a file and task.
    """
    rows = spark.read.parquet(store)
    if dates is not None:
        rows = rows.where(F.col("log_date").isin(*dates))
    file = F.regexp_extract("_metadata.file_path", _FILE, 1).alias("file")
    places = rows.select(file, F.explode(words(F.col("message"))).alias("word")).select("file", _place(F.col("word")).alias("place"))
    bitmaps = (
        places.distinct()
        .groupBy("file", F.bitmap_bucket_number("place").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    # A file without a word is known by a piece of its own.
    every = rows.select(file).distinct().select("file", F.lit(0).cast("long").alias("piece"), F.lit(None).cast("binary").alias("bits"))
    dated = bitmaps.unionByName(every).withColumn("log_date", F.to_date(F.regexp_extract("file", _DATE, 1)))
    dated.write.partitionBy("log_date").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(index)


def _has_bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def files_with(spark: SparkSession, store: str, index: str, asked: list[str], first: str, last: str) -> DataFrame:
    """The files (path) of the dates from first to last that may hold all of the words, or are not indexed."""
    listed = list_objects(spark, store, "*.parquet").select("path", F.regexp_extract("path", _FILE, 1).alias("file"))
    dated = listed.withColumn("log_date", F.to_date(F.regexp_extract("file", _DATE, 1)))
    listed = dated.where(F.col("log_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    known = spark.read.parquet(index).where(
        F.col("log_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )
    sought = spark.createDataFrame([(word,) for word in asked], "word STRING").select(
        "word",
        F.bitmap_bucket_number(_place(F.col("word"))).alias("piece"),
        F.bitmap_bit_position(_place(F.col("word"))).alias("position"),
    )
    # A search has few words.
    hits = (
        known.join(F.broadcast(sought), "piece")
        .where(_has_bit(F.col("bits"), F.col("position")))
        .groupBy("file")
        .agg(F.count_distinct("word").alias("found"))
        .where(F.col("found") == len(asked))
    )
    indexed = known.select("file").distinct()
    return listed.join(hits, "file", "left_semi").unionByName(listed.join(indexed, "file", "left_anti")).select("path")


def search_words(
    spark: SparkSession, store: str, index: str, text: str, start: str, end: str
) -> DataFrame:
    """Stored events from ``start`` to ``end`` whose message holds all words of ``text``.

    The columns are those of ``search``. Without a word, all events of the time are found.
    """
    asked = sorted(set(spark.range(1).select(F.explode(words(F.lit(text)))).toPandas().iloc[:, 0]))
    schema = spark.read.parquet(store).schema
    rows = None
    if asked:
        paths = files_with(spark, store, index, asked, start[:10], end[:10]).limit(NAMED_FILES + 1).collect()
        if len(paths) <= NAMED_FILES:
            named = [row.path for row in paths]
            # The base path gives the rows of single files their date.
            rows = spark.read.schema(schema).option("basePath", store).parquet(*named) if named else None
            if not named:
                return search(spark.createDataFrame([], schema), start, end)
    if rows is None:
        rows = spark.read.parquet(store).where(
            F.col("log_date").between(F.lit(start[:10]).cast("date"), F.lit(end[:10]).cast("date"))
        )
    has_all = [F.array_contains(words(F.col("message")), word) for word in asked]
    for condition in has_all:
        rows = rows.where(condition)
    return search(rows, start, end)
