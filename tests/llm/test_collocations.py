from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from quayside.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n string, score string, rank string, lang_key string, shard string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, *"abcdef") for i, (t, lang) in enumerate(rows)], SCHEMA)


def plain(rows, support, longest=4, reported=2000):
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang, words[i : i + m]] += 1
    candidates = {key: f for key, f in counts.items() if f >= support and len(key[1]) > 1}
    around = Counter()
    for (lang, words), f in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                part = (lang, words[i : i + m])
                around[part] = max(around[part], f)
    out = {}
    for (lang, words), a in candidates.items():
        if 100 * around[lang, words] >= 80 * a:
            continue
        cuts = [
            (2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))
        ]
        score, k = min(cuts)
        out.setdefault(lang, []).append(
            (" ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], n[lang], score)
        )
    rows = []
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        rows += [(lang, rank, *x) for rank, x in enumerate(found[:reported], 1)]
    return sorted(rows)


def texts(seed):
    draw = random.Random(seed)
    words = ["New", "york", "YORK", "city", "the", "the", "of", "été", "日本", "x y", "a", "a", "-", "(b)"]
    gaps = [" "] * 9 + ["  ", "\t", ". ", ",", "\n", "\x0b", " ! "]
    rows = []
    for _ in range(draw.randrange(1, 80)):
        text = "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randrange(40)))
        rows.append((draw.choice([text, text, text, None, "", " .,"]), draw.choice(["en", "fr", None, "und"])))
        rows += [rows[-1]] * draw.choice([0, 0, 0, 5])
    return rows


@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize("support, shards", [(5, 6), (3, 1), (2, 4)])
def test_equals_plain_loop(spark, seed, support, shards):
    made = texts(seed)
    got = collocations.collocations(frame(spark, made), support=support, shards=shards, reported=25)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(made, support, reported=25)


def test_support_of_uneven_shards_loses_nothing(spark):
    """A third of all rows are copies and fall into one shard; a phrase outside of it stays frequent."""
    made = [("same words again and again " * 3, "en")] * 60 + [(f"rare phrase number{i}", "en") for i in range(12)]
    made += [(f"filler{i} of its own", "en") for i in range(100)]
    got = collocations.collocations(frame(spark, made), support=12)
    assert sorted(map(tuple, got.collect())) == plain(made, 12)
    assert ("en", "rare phrase") in {(r.lang, r.phrase) for r in got.collect()}


def test_no_rows_and_one_very_long_text(spark):
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, [(None, None), ("", "en")])).count() == 0
    draw = random.Random(2)
    made = [(" ".join(draw.choice("abcdefgh") for _ in range(300_000)), "en"), ("a b c", "en")]
    got = collocations.collocations(frame(spark, made), support=400)
    assert sorted(map(tuple, got.collect())) == plain(made, 400)


def test_exact_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", 2, "a b", 9 * 10**15), ("en", 1, "a", 9 * 10**15 + 1), ("en", 1, "b", 9 * 10**15 + 5)],
        "lang string, size int, phrase string, n long",
    )
    row = collocations._rated(counts).first()
    assert row.score == 2_000_000 * 9 * 10**15 // (18 * 10**15 + 6)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    """Counts of a text do not depend on the bytes that are worked on at once."""
    draw = random.Random(8)
    texts = ["".join(draw.choice(["ab ", "c ", "de", ". ", ", ", "é ", "\n"]) for _ in range(400)) for _ in range(5)]
    texts += [None, "", "no end of a piece " * 9]
    batch = pa.RecordBatch.from_pydict(
        {"text": pa.array(texts, pa.string()), "lang_key": list(range(8)), "shard": pa.array([0, 1] * 4, pa.int32())}
    )
    found = []
    for limit in (1 << 20, 40):
        monkeypatch.setattr(collocations, "SLICE_BYTES", limit)
        for size in (1, 3):
            counts = Counter()
            for out in collocations._mined(size, None, 0)([batch]):
                for row in out.to_pylist():
                    counts[row["lang_key"], row["shard"], row["phrase"]] += row["n"]
            found.append(counts)
    assert found[0] == found[2] and found[1] == found[3] and len(found[1]) > 50
