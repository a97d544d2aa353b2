from __future__ import annotations

import os
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from quayside.llm import pieces as P
from quayside.llm.queries import PIECE_MODEL, TOKENIZERS

MODEL = os.path.join(TOKENIZERS, PIECE_MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return P.load(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts():
    draw = random.Random(6)
    alphabet = "ab cdethe inon▁éñ漢🎉\n  \t.,1"
    made = ["", " ", "a", "  hello   world  ", "a" * 3000, "日本語🎉🎉", "\n\n\t tab", "ab" * 900, " " * 99]
    made += ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(1500)]
    with open(np.__file__) as source:
        made += source.read().split("\n\n")
    return made


def test_same_pieces_as_the_library(vocabulary, library):
    made = texts()
    ids, bounds = P.Encoder(vocabulary).encode(made)
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == library.encode(made, num_threads=1)
    back = P.Decoder(vocabulary).decode(ids, bounds)
    assert back == [t.replace(P.MARK, " ") for t in made]


def test_index_finds_every_occurrence():
    draw = np.random.default_rng(2)
    codes = draw.integers(1, 4, 300).astype(np.uint16)
    index = P.Index(codes, 16)
    keys = [codes[i : i + n] for n in (1, 3, 4, 5, 8, 9, 15, 16) for i in (0, 50, 200)]
    keys += [np.array([9], np.uint16), np.array([1] * 16, np.uint16)]
    table = np.zeros((len(keys), 16), dtype=np.uint16)
    for row, key in enumerate(keys):
        table[row, : len(key)] = key
    begin, end = index.ranges(table, np.array([len(k) for k in keys]))
    for key, a, b in zip(keys, begin, end):
        want = [i for i in range(len(codes) - len(key) + 1) if (codes[i : i + len(key)] == key).all()]
        assert sorted(index.order[a:b].tolist()) == want


def test_rows(documents, vocabulary, library):
    docs = [(1, "Hello  you"), (2, None), (3, ""), (None, "x"), (1, "Hello  you"), (4, "word " * 30_000)]
    rows = P.decode(P.encode(documents(docs), vocabulary), vocabulary).collect()
    assert sorted(((r.doc_id, r.decoded) for r in rows), key=repr) == sorted(docs, key=repr)
    for r in rows:
        assert r.ids == (None if r.text is None else library.encode(r.text))
    both = P.encode(documents(docs), vocabulary, and_decode=True).collect()
    assert sorted(map(repr, both)) == sorted(map(repr, rows))
    assert P.decode(P.encode(documents([]), vocabulary), vocabulary).count() == 0


def test_long_texts_are_cut_where_no_piece_spans(vocabulary, library):
    """Pieces of a text have the ids that the text has, and joined they are the text again."""
    draw = random.Random(11)
    encoder, decoder = P.Encoder(vocabulary), P.Decoder(vocabulary)
    alphabet = "ab cdethe inon éñ漢  \n\t.,1  "
    made = ["".join(draw.choice(alphabet) for _ in range(draw.randint(30, 400))) for _ in range(300)]
    made += [" " * 80, "x" * 80, "a " * 60, "word  " * 30, "a" * 50 + " " * 50 + "b" * 50, "end " * 20]
    for text in made:
        parts = P.pieces_of(text, 16, vocabulary)
        assert " ".join(parts) == text
        ids = [i for part in parts for i in encoder.encode([part])[0].tolist()]
        assert ids == library.encode(text)
    assert max(len(part) for part in P.pieces_of("some words " * 100, 16, vocabulary)) <= 16


def test_very_long_text(vocabulary, library):
    """Twenty megabytes are encoded with the memory of a piece and of the ids."""
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 9))) for _ in range(5000)]
    text = " ".join(draw.choices(words, k=3_400_000))
    assert len(text) > 18 << 20
    shared = type("Shared", (), {"value": vocabulary})
    batch = pa.RecordBatch.from_pydict({"text": pa.array([text, "short", None])})
    P._tools(vocabulary)
    tracemalloc.start()
    rows = [row for b in P._encoded(shared, True)([batch]) for row in b.to_pylist()]
    assert tracemalloc.get_traced_memory()[1] < 600 << 20
    tracemalloc.stop()
    assert rows[0]["decoded"] == text and rows[0]["ids"][:20_000] == library.encode(text[:200_000])[:20_000]
    assert rows[1]["decoded"] == "short" and rows[2]["ids"] is None and rows[2]["decoded"] is None
