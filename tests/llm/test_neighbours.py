from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import neighbours
from quayside.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string"


def brute(vectors, queries, k=5):
    out = {}
    units = {i: np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64)) for i, v in vectors.items()}
    for q in queries:
        own = [(-float(units[q] @ u), i) for i, u in units.items() if i != q and len(u) == len(units[q])]
        out[q] = [i for _, i in sorted((round(s, 12), i) for s, i in own)[:k]]
    return out


@pytest.fixture(autouse=True)
def small_tables_use_all_trees(monkeypatch):
    """Else few vectors would be compared at the root of one tree."""
    monkeypatch.setattr(neighbours, "HANDED", 0)


def frame(spark, vectors):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "") for i, v in vectors], SCHEMA
    )


@pytest.mark.parametrize("part", [20_000, 150])
def test_recall_against_brute_force(spark, part):
    draw = np.random.default_rng(1)
    vectors = {i: draw.standard_normal(16).astype(np.float32) for i in range(1500)}
    centre = draw.standard_normal(16)
    vectors |= {i: (centre + 0.1 * draw.standard_normal(16)).astype(np.float32) for i in range(1500, 2500)}
    rows = nearest(frame(spark, vectors.items()), F.col("vec_id") % 50 == 0, part=part).collect()
    want = brute(vectors, [i for i in vectors if i % 50 == 0])
    got = {}
    for r in sorted(rows, key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = sum(len(set(got[q]) & set(w)) for q, w in want.items())
    assert got.keys() == want.keys() and hits >= 0.9 * sum(map(len, want.values()))
    assert all([r.rank for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] == [1, 2, 3, 4, 5] for q in want)


def test_copies_ties_and_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(i, [1.0, 2.0, 0.0]) for i in range(0, 400)]
    vectors += [(400, [2.0, 4.0, 0.0]), (450, [0.0, 0.0, 1.0]), (451, [0.0, 0.1, 1.0]), (500, [1.0, 1.0])]
    vectors += [(550, [3.0]), (551, [-2.0])]
    vectors += [(600, None), (650, [0.0, 0.0, 0.0]), (700, [1.0, nan, 0.0]), (750, [inf, 0.0, 0.0]), (800, [1.0, None, 2.0])]
    vectors += [(None, [1.0, 2.0, 0.0]), (850, []), (50, [1.0, 2.0, 0.0])]
    rows = nearest(frame(spark, vectors), F.col("vec_id") % 50 == 0).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[100]] == [0, 1, 2, 3, 4]
    assert got[450][0][0] == 451 and got[550] == [(551, -1.0)] and 500 not in got
    assert not {600, 650, 700, 750, 800, 850} & (got.keys() | {i for v in got.values() for i, _ in v})


def test_empty_table(spark):
    assert nearest(frame(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def near_copies(noise):
    """A third of the vectors are near copies of one."""
    draw = np.random.default_rng(3)
    vectors = {i: draw.standard_normal(16).astype(np.float32) for i in range(1200)}
    centre = draw.standard_normal(16)
    return vectors | {i: (centre * (1 + noise * draw.standard_normal(16))).astype(np.float32) for i in range(1200, 1800)}


@pytest.mark.parametrize("noise", [1e-2, 1e-4])
def test_groups_of_near_copies_are_bounded(spark, monkeypatch, noise):
    largest = []

    def spied(make):
        def wrapped(*args):
            run = make(*args)

            def counted(key, table):
                asks = table.column("level" if make.__name__ == "_rated" else "asks").to_pylist()
                n = sum(a is None or a is False for a in asks)
                assert n <= 2 * 100, f"{n} entries in a group"
                return run(key, table)

            return counted

        largest.append(make.__name__)
        return wrapped

    for name in ("_profile", "_rated"):
        monkeypatch.setattr(neighbours, name, spied(getattr(neighbours, name)))
    vectors = near_copies(noise)
    rows = nearest(frame(spark, vectors.items()), F.col("vec_id") % 50 == 0, part=100).collect()
    want = brute(vectors, [i for i in vectors if i % 50 == 0])
    got = {}
    for r in sorted(rows, key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert len(largest) == 2 and got.keys() == want.keys()
    assert sum(len(set(got[q]) & set(w)) for q, w in want.items()) >= 0.9 * sum(map(len, want.values()))


@pytest.mark.parametrize("rounds", [18, 2])
def test_slices_and_rounds_change_no_result(spark, monkeypatch, rounds):
    """Of vectors with a common string, and in rounds of few bits, the same neighbours are found."""
    vectors = near_copies(1e-5)
    monkeypatch.setattr(neighbours, "ROUND", rounds)
    found = [
        sorted(map(tuple, nearest(frame(spark, vectors.items()), F.col("vec_id") % 50 == 0, part=p).collect()))
        for p in (20_000, 90)
    ]
    assert len(found[0]) == 5 * 36 and found[0] == found[1]


def test_queries_of_a_slice_are_dealt_over_blocks(spark, monkeypatch):
    """Blocks change no result, and no task gets many more queries than asked for."""
    vectors = near_copies(1e-2)
    ask = F.col("vec_id") % 5 == 0
    want = sorted(map(tuple, nearest(frame(spark, vectors.items()), ask, part=300).collect()))
    rated = neighbours._rated

    def spied(*args):
        run = rated(*args)

        def counted(key, table):
            assert sum(level is not None for level in table.column("level").to_pylist()) <= 60
            return run(key, table)

        return counted

    monkeypatch.setattr(neighbours, "_rated", spied)
    monkeypatch.setattr(neighbours, "QUESTIONS", 20)
    got = sorted(map(tuple, nearest(frame(spark, vectors.items()), ask, part=300).collect()))
    assert len(want) == 5 * 360 and got == want


def test_root_is_visited_in_one_tree(spark, monkeypatch):
    """Vectors without structure need as many candidates as there are: each is rated once, and all are found."""
    draw = np.random.default_rng(8)
    vectors = {i: draw.standard_normal(64).astype(np.float32) for i in range(900)}
    trees = []
    dealt = neighbours._dealt

    def seen(forest, with_vector, **options):
        trees.append(options.get("trees"))
        return dealt(forest, with_vector, **options)

    monkeypatch.setattr(neighbours, "_dealt", seen)
    want = brute(vectors, [i for i in vectors if i % 50 == 0])
    # Also with structure, if there are so few queries that the other trees would cost more.
    centre = draw.standard_normal(64)
    near = {i: (centre * (1 + 0.3 * draw.standard_normal(64))).astype(np.float32) for i in range(300)}
    for handed, own in ((0, vectors), (1 << 40, vectors | near)):
        monkeypatch.setattr(neighbours, "HANDED", handed)
        rows = nearest(frame(spark, own.items()), F.col("vec_id") % 50 == 0, part=100).collect()
        want = brute(own, [i for i in own if i % 50 == 0])
        got = {}
        for r in sorted(rows, key=lambda r: r.rank):
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert got == want and trees[-1] == 1


@pytest.mark.parametrize("part", [20_000, 100])
def test_the_way_of_work_changes_no_result(spark, monkeypatch, part):
    """With so few candidates that neighbours are missed, few queries get the same rows by one tree as by all."""
    draw = np.random.default_rng(9)
    vectors = near_copies(0.3) | {i: draw.standard_normal(16).astype(np.float32) for i in range(1800, 2400)}
    monkeypatch.setattr(neighbours, "LEAST", 20)
    found = []
    for handed in (0, 1 << 40):
        monkeypatch.setattr(neighbours, "HANDED", handed)
        rows = nearest(frame(spark, vectors.items()), F.col("vec_id") % 50 == 0, part=part, target=0.1)
        found.append(sorted(map(tuple, rows.collect())))
    exact = brute(vectors, [i for i in vectors if i % 50 == 0])
    got = {(q, i) for q, _, i, _ in found[0]}
    assert got != {(q, i) for q, own in exact.items() for i in own}
    assert found[0] == found[1]
