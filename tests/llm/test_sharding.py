from __future__ import annotations

import random

from pyspark.sql import functions as F

from quayside.llm import sharding
from quayside.llm.sharding import shard, write_shards


def check(rows, shards, longest, total):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert abs(sum(r.size for r in own) - total / shards) <= longest + 1


def test_sizes_slots_and_hot_texts(documents, tmp_path):
    draw = random.Random(3)
    docs = [(i, "é" * draw.choice([0, 3, 50, 400])) for i in range(700)]
    docs += [(1000 + i, "the same text") for i in range(600)]
    docs += [(5000, "row")] * 40 + [(None, None), (None, "x"), (6000, None), (6001, "")]
    for ranges in (1 << 20, 400):
        frame = shard(documents(docs), shards=7, range_bytes=ranges)
        rows = frame.collect()
        assert sorted((r.doc_id, r.text) for r in rows if r.text and r.doc_id) == sorted(
            (i, t) for i, t in docs if i and t
        )
        assert len(rows) == len(docs)
        sizes = [len((t or "").encode()) + 16 for _, t in docs]
        assert sum(r.size for r in rows) == sum(sizes)
        check(rows, 7, max(sizes), sum(sizes))
    # With shards that are smaller than a group of equal texts, the group is divided.
    group = 600 * (len("the same text") + 16)
    for shards in (12, 40):
        assert sum(sizes) / shards < group
        rows = shard(documents(docs), shards=shards, range_bytes=400).collect()
        check(rows, shards, max(sizes), sum(sizes))
        assert len({r.shard for r in rows if r.text == "the same text"}) > 1
    write_shards(frame.select("doc_id", "text", "shard", "slot"), str(tmp_path / "out"))
    back = frame.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(docs)


def test_same_result_again(documents):
    docs = documents([(i, str(i) * (i % 90)) for i in range(500)])
    places = [sorted(map(tuple, shard(docs).select("doc_id", "shard", "slot").collect())) for _ in range(2)]
    assert places[0] == places[1]


def test_few_and_no_rows(documents):
    assert shard(documents([])).count() == 0
    rows = shard(documents([(1, "a"), (2, "b")]), shards=40).collect()
    assert len(rows) == 2 and all(r.slot == 0 for r in rows)
    assert shard(documents([(1, "a")])).select(F.max("shard")).first()[0] <= 39


def test_equal_rows_are_dealt_over_parts(spark):
    """A third of all rows are equal in text and id (null), and differ in another column only."""
    rows = spark.range(200_000).selectExpr(
        "if(id % 3 = 0, null, id) as doc_id", "if(id % 3 = 0, 'equal', concat('t', id)) as text", "id as other"
    )
    found = shard(rows, shards=10, range_bytes=20_000).cache()
    by = found.groupBy("shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("slot").alias("last"))
    by = by.collect()
    total = sum(r.bytes for r in by)
    assert len(by) == 10 and all(r.n == r.last + 1 and abs(r.bytes - total / 10) < 60 for r in by)
    assert found.select("shard", "slot").distinct().count() == 200_000
    assert found.select("other").distinct().count() == 200_000
    # No window task has more than a few ranges of rows: the equal ones stand in many parts.
    thin = rows.selectExpr("xxhash64(text) as key", "coalesce(doc_id, -1L) as id", "20L as size")
    ranged = sharding._ranged(thin, sharding.find_splitters(thin, 20_000.0)).withColumn("part", F.lit(0).cast("long"))
    single = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).filter("bytes > 40000")
    assert single.count() == 1
    dealt, _ = sharding._dealt(ranged, ranged.withColumn("row", F.struct("key")), single, 20_000.0)
    sizes = [r.n for r in dealt.groupBy("range", "part").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 200_000 and max(sizes) < 3000


def test_ranges_are_divided_until_none_can_be(spark):
    """Heavy keys beside light ones: what is still too full has a single key."""
    thin = spark.range(30_000).selectExpr("if(id < 20000, id % 4 * 100, id) as key", "0L as id", "10L as size")
    ranged = sharding._ranged(thin, sharding.find_splitters(thin, 500.0))
    sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count_distinct("key").alias("keys"))
    assert sums.filter("bytes > 1000 and keys > 1").isEmpty()


def test_columns_keep_their_values(spark):
    names = ["_id", "_key", "_rank", "_range", "_bytes", "_rows", "_first", "key", "id", "range", "part", "rows", "row"]
    names += ["bytes", "first", "rank", "parts", "n", "a.b", "c`d"]
    rows = spark.createDataFrame([(i, f"t{i}", *[f"{n}{i}" for n in names]) for i in range(50)], ["doc_id", "text", *names])
    found = shard(rows, shards=3).drop("size", "shard", "slot")
    assert found.columns == rows.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))
