from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quayside.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, value string, rank string, term string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", "y", "z", "w") for i, (t, lang, s) in enumerate(rows)], SCHEMA)


def plain(rows, least=3, ranks=200):
    docs = [
        (lang or "", source or "", [
            "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        ])
        for text, lang, source in rows
    ]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = [t for t, n in seen.items() if n >= least]
        counts = defaultdict(Counter)
        for own, source, words in docs:
            if own == lang:
                counts[source].update(w for w in words if seen[w] >= least)
        total = sum(counts.values(), Counter())

        def share(of):
            size = sum(of.values())
            return {t: 1 + 10**9 * (of[t] + 1) // (size + len(kept)) for t in kept}

        shares, all_share = {s: share(c) for s, c in counts.items()}, share(total)
        for s, p in shares.items():
            pairs = [
                (o, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)) for o, q in shares.items() if o != s
            ]
            terms = [(t, (p[t] - all_share[t]) ** 2 // all_share[t]) for t in kept if counts[s][t] and p[t] > all_share[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, r) for r, (item, v) in enumerate(items[:most], 1)]
    return sorted(out)


def texts(seed):
    draw = random.Random(seed)
    words = ["The", "the", "the,", "(the)", "Été", "été", "a-b", "a", "b", "x1y2x", "日本", "one two", "--", "", "12", "z"]
    rows = []
    for _ in range(draw.randrange(2, 60)):
        text = "".join(draw.choice(words) + draw.choice([" ", "\n", "\t ", "/"]) for _ in range(draw.randrange(30)))
        rows.append((draw.choice([text, text, None, ""]), draw.choice(["en", "fr", None, ""]), draw.choice(["s1", "s2", "s3", None])))
        rows += [rows[-1]] * draw.choice([0, 0, 1, 2])
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_equals_plain_loop(spark, rows, seed):
    made = texts(seed)
    got = divergence.audit(frame(spark, made), ranks=4)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(made, ranks=4)


def test_documents_of_a_term_over_chunks(spark):
    """A term counts once for each document, whatever the chunks; equal documents count each."""
    cases = [
        (["w w, (w)", "w", "v"], False),
        (["w w,", "w", "w,"], True),
        (["w w,", "w w,", "(w)"], True),
        (["w w, w.", "w w, w."], False),
        (["w w,", "w w,", "w w,"], True),
        (["w,", "w,", "(w)", "x"], True),
    ]
    for case, kept in cases:
        texts, cells = divergence.with_cells(frame(spark, [(t, "en", f"s{i % 2}") for i, t in enumerate(case)]))
        chunks = divergence.count_chunks(texts).cache()
        found = divergence.kept_terms(divergence.count_terms(chunks, cells), cells, texts)
        assert ("w" in {r.term for r in found.collect()}) == kept, case


def test_no_rows_and_no_terms(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
    got = divergence.audit(frame(spark, [(None, "en", "a"), ("1 2", "en", "b"), ("x", "fr", "a")])).collect()
    assert sorted(map(tuple, got)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_shares_beyond_64_bits(spark):
    big = 9 * 10**15
    row = spark.range(1).selectExpr(f"{big}L as n", f"{big + 7}L as total", "5L as terms")
    got = row.select(divergence._billionths("n", "total", "terms")).first()[0]
    assert got == 1 + 10**9 * (big + 1) // (big + 12)
    count, all_ = np.array([big, 0, 7]), np.array([big + 12, 3, 8])
    assert divergence._shares(count, all_).tolist() == [1 + 10**9 * (int(c) + 1) // int(a) for c, a in zip(count, all_)]


@pytest.mark.parametrize("square, pairs", [(1500, 500_000), (0, 7)])
def test_many_sources(spark, square, pairs, monkeypatch):
    """Sums of pairs in squares and in keys, all at once and in small steps, give the same."""
    draw = random.Random(4)
    made = [
        (" ".join(draw.choice("abcdefghij") for _ in range(draw.randrange(12))), "en", f"s{draw.randrange(30)}")
        for _ in range(200)
    ]
    known = [(names, n) for names, n in (("SQUARE", square), ("PAIRS_AT_ONCE", pairs))]
    for name, n in known:
        monkeypatch.setattr(divergence, name, n)
    assert sorted(map(tuple, divergence.audit(frame(spark, made)).collect())) == plain(made)


def test_very_long_text_and_chunk(spark):
    long = "word " * 300_000
    run = "x," * 200_000
    made = [(long, "en", "a"), (run, "en", "b"), ("word x", "en", "a"), ("Word X", "en", "b"), ("x word", "en", "a")]
    assert sorted(map(tuple, divergence.audit(frame(spark, made)).collect())) == plain(made)
