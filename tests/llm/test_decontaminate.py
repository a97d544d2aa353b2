from __future__ import annotations

import random
import re

import pytest

from quayside.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    windows = {}
    for name, text in items:
        own = words(text)
        if name is None or not own:
            continue
        n = min(size, len(own))
        for i in range(len(own) - n + 1):
            windows.setdefault(tuple(own[i : i + n]), set()).add(str(name))
    rows = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if items_ := windows.get(tuple(own[i : i + n])):
                    found |= items_
                    hit |= set(range(i, i + n))
        rows.append((doc, len(own), len(hit), sorted(found)))
    return sorted(rows, key=repr)


def found(docs, items, **options):
    result = decontaminate(docs, items, **options).select("doc_id", "n_words", "n_hit", "items").collect()
    return sorted(((r[0], r[1], r[2], list(r[3])) for r in result), key=repr)


@pytest.fixture(scope="module")
def case():
    draw = random.Random(1)
    bag = [f"w{i}" for i in range(12)] + ["Ünder", "çé", "THE"]
    line = lambda n: " ".join(draw.choice(bag) for _ in range(n))
    items = [(i, line(draw.choice([1, 2, 3, 7, 10, 11, 14, 30]))) for i in range(12, 40)]
    items += [(1, ""), (2, None), (None, line(12)), (3, items[5][1]), (3, items[5][1]), (4, "!!! ...")]
    docs = [(i, line(draw.choice([0, 1, 5, 40, 200]))) for i in range(30)]
    docs += [(100 + i, line(20) + ", " + draw.choice(items[:28])[1].upper() + " " + line(5)) for i in range(30)]
    docs += [(200, None), (200, None), (None, docs[-1][1]), (7, docs[40][1]), (7, docs[40][1])]
    docs.append((300, " ".join(line(500) for _ in range(200))))
    return docs, items


def test_equals_brute_force(spark, documents, case):
    docs, items = case
    frame = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    assert found(documents(docs), frame) == brute(docs, items)


def test_full_table_of_bits_changes_no_result(spark, documents, case):
    """With a table that every shingle passes, the joins decide alone."""
    docs, items = case
    docs = docs[:60] + docs[-6:-1]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert found(documents(docs), frame, bits=6) == brute(docs, items)


def test_empty_tables(spark, documents, case):
    docs, items = case
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(documents(docs), none) == brute(docs, [])
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate(documents([]), frame).count() == 0


def test_spans_are_merged(spark, documents):
    items = spark.createDataFrame([(1, " ".join("abcdefghijkl")), (2, "x y")], "item_id long, text string")
    row = decontaminate(documents([(1, "0 a b c d e f g h i j k l 0 x y x y")]), items).first()
    assert [tuple(s) for s in row.spans] == [(1, 13), (14, 18)]
    assert (row.n_hit, row["items"]) == (16, ["1", "2"])
