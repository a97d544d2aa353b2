from __future__ import annotations

import random

from quayside.llm.repeats import remove_repeats


def brute(docs, size):
    first = {}
    for doc, text in docs:
        own = (text or "").encode().split()
        for i in range(len(own) - size + 1 if doc is not None else 0):
            key = tuple(own[i : i + size])
            first[key] = min(first.get(key, doc), doc)
    rows = []
    for doc, text in docs:
        own = (text or "").encode().split()
        gone = set()
        for i in range(len(own) - size + 1 if doc is not None else 0):
            if first[tuple(own[i : i + size])] < doc:
                gone |= set(range(i, i + size))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone).decode()
        rows.append((doc, len(own), len(gone), kept))
    return sorted(rows, key=repr)


def found(docs, **options):
    return sorted(map(tuple, remove_repeats(docs, **options).collect()), key=repr)


def fixture(size):
    draw = random.Random(size)
    word = lambda: "".join(draw.choice("abcd") for _ in range(draw.randint(1, 3)))
    line = lambda n: " ".join(word() for _ in range(n))
    passages = [line(draw.choice([size - 1, size, size + 1, 3 * size])) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = [line(draw.randint(0, 2 * size)) for _ in range(3)]
        parts.insert(draw.randint(0, 3), draw.choice(passages))
        docs.append((draw.randint(0, 10**6), "\t\n".join(parts)))
    docs += [(i, docs[3][1]) for i in (5, 2, 9)] + [(5, docs[3][1]), (None, docs[3][1]), (None, None)]
    docs += [(11, ""), (12, None), (13, "no break"), (14, "a " * (4 * size)), (15, "a " * (2 * size))]
    # Copies that differ in a word here and there.
    base = line(12 * size).split()
    for i in range(20):
        other = list(base)
        for _ in range(i % 4):
            other[draw.randrange(len(other))] = "edit"
        docs.append((2000 - i, " ".join(other)))
    return docs


def test_equals_brute_force(documents):
    for size, anchor in ((50, 10), (8, 3), (6, 6), (5, 1)):
        docs = fixture(size)
        assert found(documents(docs), window=size, anchor=anchor) == brute(docs, size)


def test_empty_table(documents):
    assert found(documents([])) == []
