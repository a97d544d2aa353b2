from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quayside.llm import simhash


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [words[i : i + 4] for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """The least position that links lead to, of a list of fingerprints."""
    root = list(range(len(prints)))
    values = np.array(prints, dtype=np.uint64)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius).tolist():
            a, b = sorted((find(i), find(i + 1 + j)))
            root[b] = a
    return [find(i) for i in range(len(prints))]


def made_texts():
    draw = random.Random(5)
    vocabulary = ["Wort", "ÉTÉ", "été", "a", "B", "日本", "x y", "-", "...", "long" * 9]
    texts = [None, "", " \t\n", "one", "one two", "one two three", "One  TWO\nthree four", "\x00 \x0e"]
    for _ in range(60):
        base = [draw.choice(vocabulary) + str(draw.randrange(40)) for _ in range(draw.randrange(1, 300))]
        texts.append(" ".join(base))
        for _ in range(draw.randrange(4)):
            copy = list(base)
            copy[draw.randrange(len(copy))] = "changed"
            texts.append("\n".join(copy))
    return texts + ["one two three"] * 30


def test_equals_all_pairs(documents):
    texts = made_texts()
    ids = list(range(1000, 1000 + len(texts)))
    random.Random(1).shuffle(ids)
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(list(zip(ids, texts)))).collect()}
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    prints = [plain_fingerprint(texts[i]) for i in order]
    roots = plain_components(prints, 4)
    assert len(got) == len(ids)
    for place, i in enumerate(order):
        row = got[ids[i]]
        assert row.fingerprint == f"{prints[place]:016x}"
        assert row.component_id == ids[order[roots[place]]]
    assert len({r.component_id for r in got.values()}) < len(set(prints))


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
@pytest.mark.parametrize("average, full", [(1 << 20, 1 << 22), (300, 700)])
def test_links_join_all_within_the_radius(spark, radius, average, full):
    draw = random.Random(radius)
    prints = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(12):
        x = draw.getrandbits(64)
        prints.add(x)
        for _ in range(12):
            y = x
            for bit in draw.sample(range(64), draw.randrange(7)):
                y ^= 1 << bit
            prints.add(y)
            x = draw.choice([x, y])
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    found = [(r.u % (1 << 64), r.v % (1 << 64)) for r in simhash.links(frame, radius, average, full).collect()]
    place = {p: i for i, p in enumerate(prints)}
    assert all(0 < (u ^ v).bit_count() <= radius for u, v in found)
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in found:
        a, b = sorted((find(place[u]), find(place[v])))
        root[b] = a
    assert [find(i) for i in range(len(prints))] == plain_components(prints, radius)


def test_dense_fingerprints_are_divided(spark):
    """3,000 fingerprints that differ in 14 bits only are divided until no stretch is overfull."""
    frame = spark.range(3000).select((F.col("id") * 5 + F.lit(7 << 40)).alias("fingerprint"))
    entries, total = simhash.stretches(frame, 2, average=1 << 18, full=1 << 18)
    assert total == 3000 * 2081
    variants = F.expr("if(changed = 2, 1L, if(changed = 1, 65L - depth, 1L + (64 - depth) + (64L - depth) * (63 - depth) div 2))")
    sized = entries.groupBy("depth", "stretch").agg(F.sum(variants).alias("n"))
    summed = sized.agg(F.max("n"), F.sum("n"), F.count_distinct("depth")).first()
    assert summed[0] <= 1 << 18 and summed[1] == total and summed[2] > 1
    links = simhash.links(frame, 4, average=1 << 18, full=1 << 18)
    # Each is linked with the least one at a variant, so links don't grow with the pairs.
    assert links.count() < 3000 * 100


def test_null_ids_and_no_rows(documents, spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, "quite another text here"), (3, None), (9, "")]
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(documents(rows)).collect())
    assert got == [(-1, -1), (-1, 7), (3, 3), (7, 7), (7, 7), (9, 3)]
    assert simhash.near_duplicates(documents([])).count() == 0


def test_very_long_text(documents):
    text = " ".join(f"word{i % 5000}" for i in range(400_000))
    got = simhash.near_duplicates(documents([(1, text), (2, "short"), (3, text + " end")])).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1}
    assert next(r.fingerprint for r in got if r.doc_id == 1) == f"{plain_fingerprint(text):016x}"
