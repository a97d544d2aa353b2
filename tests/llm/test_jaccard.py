from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from quayside.llm import jaccard as J
from quayside.llm.graph import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, size=5):
    own = WORD.findall((text or "").lower())
    return frozenset(tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))) if own else frozenset()


def classes(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(docs, threshold=0.8):
    sets = [(i, shingles(t)) for i, t in docs]
    place = range(len(sets))
    links = [
        (a, b)
        for a, b in combinations(place, 2)
        if sets[a][0] is not None
        and sets[b][0] is not None
        and sets[a][1]
        and sets[b][1]
        and len(sets[a][1] & sets[b][1]) >= threshold * len(sets[a][1] | sets[b][1])
    ]
    count = [sum(x in link for link in links) for x in place]
    group = classes(links, place)
    least = {}
    for x in place:
        if sets[x][0] is not None:
            least[group[x]] = min(least.get(group[x], sets[x][0]), sets[x][0])
    return sorted(((sets[x][0], least.get(group[x]), count[x]) for x in place), key=repr)


def found(docs, **options):
    rows = J.near_duplicates(docs, **options).select("doc_id", "class_id", "n_links").collect()
    return sorted(map(tuple, rows), key=repr)


def fixture():
    draw = random.Random(2)
    line = lambda n: " ".join(f"w{draw.randrange(400)}" for _ in range(n))
    docs = [(i, line(draw.choice([3, 30, 80]))) for i in range(40)]
    for i in range(8):
        base = line(draw.choice([40, 100])).split()
        for k in range(6):
            other = list(base)
            for _ in range(k):
                other[draw.randrange(len(other))] = f"x{draw.randrange(99)}"
            docs.append((100 + 10 * i + k, " ".join(other)))
    # A large group of near copies, beyond the bound of a bucket.
    base = line(120).split()
    for i in range(60):
        other = list(base)
        other[draw.randrange(120)] = f"y{i}"
        docs.append((1000 + i, " ".join(other)))
    docs += [(2000 + i, "the same text of some words, again") for i in range(30)]
    docs += [(1, docs[0][1]), (None, docs[0][1]), (3000, None), (3001, ""), (3002, "..."), (3003, "a b")]
    docs += [(3004, "A  b!"), (3005, "a b c")]
    return docs


def test_equals_brute_force(documents):
    docs = fixture()
    assert found(documents(docs), bucket=16) == brute(docs)
    assert found(documents(docs), bucket=400) == brute(docs)


def test_empty_table(documents):
    assert found(documents([])) == []


def test_runs_reach_the_recall():
    assert J.runs_needed(0.8, 0.9999) > J.runs_needed(0.8, 0.99) >= 1
    with pytest.raises(ValueError):
        J.runs_needed(0.4, 0.99)


def test_large_buckets_are_split_until_they_are_small(documents, spark, monkeypatch):
    """Sets that share a third of their shingles with all others fall apart in deep trees; no bucket is searched in blocks."""
    draw = random.Random(12)
    common = [f"c{i}" for i in range(60)]
    docs = [(i, " ".join(common + [f"w{draw.randrange(10**6)}" for _ in range(60)])) for i in range(400)]
    docs += [(1000 + i, docs[i][1] + " end") for i in range(0, 400, 9)]
    sizes = []
    blocked = J._blocked

    def seen(rows, group, key, bucket):
        if group == "bucket":
            sizes.append(rows.groupBy("bucket").count().agg({"count": "max"}).first()[0])
        return blocked(rows, group, key, bucket)

    monkeypatch.setattr(J, "_blocked", seen)
    assert found(documents(docs), bucket=12) == brute(docs)
    assert sizes[0] <= 12


def test_alike_buckets_are_known_by_few_rows(spark):
    """What is told of a large bucket doesn't grow with its sets: a row for each task, whatever the values are."""
    draw = np.random.default_rng(5)
    base = draw.integers(0, 1 << 32, 64)
    agreeing = {1: 0.9, 2: 0.3, 3: 0.0, 4: 0.8}
    rows = []
    for bucket, share in agreeing.items():
        for _ in range(1500):
            own = np.where(draw.random(64) < share, base, draw.integers(0, 1 << 32, 64)).astype(np.uint32)
            rows.append((bucket, own.tobytes()))
    large = spark.createDataFrame(rows, "bucket long, signature binary").repartition(6)
    told = [batch for batch in J._probes(64)(iter(large.toArrow().to_batches(1000)))]
    assert sum(batch.num_rows for batch in told) == len(agreeing)
    assert sorted(r.bucket for r in J._dense(large, 64).collect()) == [1, 4]


def test_intersections():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 50, n)).astype(np.uint64) for n in (1, 20, 40, 40, 3)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = J.intersections(sets)
    np.fill_diagonal(got, 0)
    np.fill_diagonal(want := np.array(want), 0)
    assert (got == want).all()


def test_components(spark):
    draw = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1050)]
    other = [(draw.randrange(5000, 5100), draw.randrange(5000, 5100)) for _ in range(60)]
    edges = chain + star + other
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in got} == classes(edges, nodes) and len(got) == len(nodes)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_all_pairs_of_the_given_documents(spark):
    """On 1,000 given documents every pair at the threshold is found, with the right classes and numbers of links.

    Pairs are counted by the shingles they share, so all of them are known.
    """
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    sets = [shingles(text) for _, text in docs]
    holders = {}
    for i, own in enumerate(sets):
        for shingle in own:
            holders.setdefault(shingle, []).append(i)
    both = Counter(pair for own in holders.values() for pair in combinations(own, 2))
    links = [(a, b) for (a, b), n in both.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    count = Counter(x for link in links for x in link)
    group = classes([(docs[a][0], docs[b][0]) for a, b in links], [i for i, _ in docs])
    want = sorted(((i, group[i], count[x]) for x, (i, _) in enumerate(docs)), key=repr)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert len(links) > 50 and found(frame) == want
