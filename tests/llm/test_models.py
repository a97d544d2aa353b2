from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import arrays, langid, quality
from quayside.llm.common import fold_number

SF = "/root/testdata/sf0.01"
SYLLABLES = {
    "aa": ["the", "and", "ing", "th", "ou"],
    "bb": ["ich", "sch", "ung", "ä", "ver"],
    "cc": ["ção", "qu", "ê", "os", "lh"],
}


def prose(draw, lang, n):
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(1)
    rows = [(lang, prose(draw, lang, 60)) for lang in SYLLABLES for _ in range(20)]
    return langid.learn(spark.createDataFrame([*rows, (None, "zz"), ("aa", None)], "lang string, text string"))


def test_fold_is_the_crc_of_the_id_as_text(spark):
    rows = spark.range(-3, 50).select("id", fold_number("id").alias("fold")).collect()
    assert all(r.fold == zlib.crc32(str(r.id).encode()) % 3 for r in rows)


def test_mixtures(documents, model):
    draw = random.Random(2)
    half = prose(draw, "aa", 50) + ". " + prose(draw, "bb", 50)
    docs = [(1, prose(draw, "cc", 40)), (2, half), (3, None), (4, ""), (5, "12 ... 34"), (6, "— “ ”")]
    docs += [(7, prose(draw, "bb", 20_000)), (8, "日本"), (None, prose(draw, "aa", 9).upper()), (2, half)]
    got = {r.doc_id: r for r in langid.predict(documents(docs), model).collect()}
    assert [got[i].lang_pred for i in (1, 7, None)] == ["cc", "bb", "aa"]
    assert [(got[i].lang_pred, got[i].score) for i in (3, 4, 5, 6)] == [("und", 0.0)] * 4
    assert got[8].lang_pred in SYLLABLES
    assert {m.lang for m in got[2].mixture} == {"aa", "bb"}
    assert all(abs(m.share - 0.5) < 0.05 for m in got[2].mixture)
    assert got[1].score == 1.0 and len(got[1].mixture) == 1


def test_nothing_learned(spark, documents):
    empty = langid.learn(spark.createDataFrame([], "lang string, text string"))
    assert langid.predict(documents([(1, "abc")]), empty).first().lang_pred == "und"
    assert langid.predict(documents([]), empty).count() == 0


def test_many_languages(spark, documents, monkeypatch):
    """Two hundred languages take no more memory at once than a few; a column of other values is refused."""
    draw = random.Random(6)
    letters = [chr(c) for c in range(0x400, 0x460)]
    rows = []
    for n in range(200):
        own = draw.sample(letters, 6)
        rows += [(f"l{n:03d}", " ".join("".join(draw.choices(own, k=5)) for _ in range(40))) for _ in range(2)]
    model = langid.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert len(model.languages) == 200
    found = langid.predict(documents([(i, text) for i, (_, text) in enumerate(rows)]), model).collect()
    assert sum(r.lang_pred == rows[r.doc_id][0] for r in found) > 390
    long = " ".join(text for _, text in rows[:2]) * 40
    texts = [long] * 30
    tracemalloc.start()
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    shared = type("Shared", (), {"value": model})
    list(langid._predictions(shared)([batch]))
    assert tracemalloc.get_traced_memory()[1] < 600 << 20
    tracemalloc.stop()
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 199)
    with pytest.raises(ValueError, match="more than 199"):
        langid.learn(spark.createDataFrame(rows, "lang string, text string"))


def test_language_accuracy_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.predict(docs, langid.learn(docs.filter(fold_number() != 1)))
    assert found.filter(fold_number() == 1).filter("lang <> lang_pred").count() <= 3


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality.learn(docs, labels.filter(fold_number() != 1))
    held = quality.score(docs, model).join(labels.filter(fold_number() == 1), "doc_id")
    right = held.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col("label")).cast("double"))).first()[0]
    assert right >= 0.95


def test_quality_edges(spark, documents):
    docs = documents([(1, "good words here"), (2, "BAD!! BAD!!"), (3, None), (4, ""), (None, "x" * 200_000)])
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 0), (3, 0), (3, 1), (None, 1), (4, None)], "doc_id long, label int"
    )
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.learn(docs, labels)).collect()}
    assert len(scores) == 5 and all(0.0 <= s <= 1.0 for s in scores.values())
    assert scores[1] > scores[2] and scores[3] == scores[4]
    none = quality.learn(docs, labels.filter("label > 5"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(documents([]), none).count() == 0


def test_parts_of_long_texts():
    draw = random.Random(3)
    rows = ["", "a b", "x" * 50, "ab " * 30, "é " * 9 + "y" * 40 + " z" * 20, None, "end"]
    rows += ["".join(draw.choice("ab \n") for _ in range(draw.randrange(80))) for _ in range(60)]
    texts = arrays.Texts(pa.array(rows, pa.string()))
    white = ~arrays.VISIBLE
    found = [(part, of) for part, of in arrays.parts(texts, 16, white)]
    joined = {}
    for part, of in found:
        for i, row in enumerate(of):
            piece = part.raw(i)
            assert len(piece) <= 16 or not any(white[b] for b in piece[1:16])
            joined[row] = joined.get(row, b"") + piece
    assert [joined[i].decode() for i in range(len(rows))] == [t or "" for t in rows]


def test_quality_of_a_very_long_text(spark):
    """Twenty megabytes are scored in pieces, with the memory of a piece."""
    draw = random.Random(9)
    weights = np.random.default_rng(2).standard_normal(quality.BUCKETS)
    shared = type("Shared", (), {"value": quality.Model(weights, 0.0)})
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 9))) for _ in range(5000)]
    long = " ".join(draw.choices(words, k=3_300_000))
    assert len(long) > 18 << 20
    batch = pa.RecordBatch.from_pydict({"text": pa.array([long, long[: 1 << 19], None, ""])})
    tracemalloc.start()
    (first, *_), = [list(b.column("score").to_pylist() for b in quality._scores(shared)([batch]))]
    assert tracemalloc.get_traced_memory()[1] < 700 << 20
    tracemalloc.stop()
    # The average over the whole text, but for the pairs at cuts.
    texts = arrays.Texts(pa.array([long[: 3 << 20]]))
    total = n = 0
    for owner, bucket in quality.Features(texts).kinds:
        total, n = total + weights[bucket].sum(), n + len(bucket)
    logit = np.log(first[0] / (1 - first[0])) if 0 < first[0] < 1 else None
    cut = [s for b in quality._scores(shared)([pa.RecordBatch.from_pydict({"text": pa.array([long[: 3 << 20]])})]) for s in b.column("score").to_pylist()]
    assert abs(np.log(cut[0] / (1 - cut[0])) - total / n) < 1e-4 and logit is not None
