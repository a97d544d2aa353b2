"""Language identification by mixture inference.

Each language has a model of byte trigrams within words (with the word's edges), counted over all
training texts. The likelihood of a word in a language is the product of its trigrams'. A document
is a mixture: expectation-maximisation estimates which share of its words each language gives.
The set of languages is the one with the best penalised likelihood, searched from the languages
with the greatest shares: a further language must gain PENALTY for each word of the text, and half
the logarithm of their number.

The model has 2**16 numbers for each language, of which there may be MOST_LANGUAGES; a column with more values
is refused, as it can't hold languages. Texts are worked on in slices that shrink as languages grow. Nulls, empty and repeated rows: rows without a
language or text teach nothing; a text that is null or has no letter is ``und`` with score 0,
as is every text if nothing was learned. Of equal shares the first language in order counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import arrays
from quayside.llm.common import prepare, schema_with

BUCKETS = 1 << 16
SMOOTHING = 0.5
PENALTY = 0.02
STEPS = 30
CLOSE = 1e-3
UNKNOWN = "und"
MOST_LANGUAGES = 500
#: Bytes of text that are worked on at once, for up to 8 languages; fewer for more.
SLICE_BYTES, SLICE_LANGUAGES = 2 << 20, 8

#: Lower-case letters and every byte of characters beyond ASCII.
LETTER = arrays.byte_class("abcdefghijklmnopqrstuvwxyz")
LETTER[128:] = True
SPACE = 32


class Grams:
    """Trigrams of the words of texts, as buckets, and the words and texts they belong to."""

    def __init__(self, texts: arrays.Texts):
        count = len(texts)
        # Each text gets a space before it, so that words have an edge on both sides.
        at = texts.at + np.arange(count + 1)
        data = np.full(len(texts.bytes) + count + 1, SPACE, dtype=np.uint8)
        place = np.ones(len(data), dtype=bool)
        place[at] = False
        data[place] = arrays.LOWER[texts.bytes]
        letter = LETTER[data]
        data[~letter] = SPACE
        wide = data.astype(np.uint32)
        code = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(0x9E3779B1)
        # A trigram counts if its middle byte is a letter; so a word of n bytes has n of them.
        middle = np.flatnonzero(letter[1:-1])
        self.bucket = (code[middle] >> np.uint32(16)).astype(np.int64)
        first = ~letter[middle] if len(middle) else np.zeros(0, dtype=bool)
        self.word = np.flatnonzero(first)
        text = np.searchsorted(at, middle[self.word], side="right") - 1
        self.first = np.searchsorted(text, np.arange(count + 1))

    def text_of_grams(self) -> np.ndarray:
        sizes = np.diff(np.append(self.word, len(self.bucket)))
        return np.repeat(np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)), sizes)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch, texts in arrays.slices(batches, "text", SLICE_BYTES):
        names, own = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
        grams = Grams(texts)
        cell = own[grams.text_of_grams()] * BUCKETS + grams.bucket
        found = np.bincount(cell, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
        for name, counts in zip(names, found):
            totals[name] = totals.get(name, 0) + counts
    for name, counts in totals.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(counts[some])],
            ["lang", "bucket", "n"],
        )


@dataclass
class Model:
    languages: list[str]
    #: Logarithms of probabilities, a row for each language.
    table: np.ndarray


def learn(labelled: DataFrame) -> Model:
    """Count the trigrams of all texts (columns lang and text) by language."""
    prepare(labelled.sparkSession)
    rows = labelled.filter("lang is not null and text is not null").select(
        F.col("lang").cast("string"), F.col("text").cast("string")
    )
    many = rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).count()
    if many > MOST_LANGUAGES:
        raise ValueError(f"the column lang has more than {MOST_LANGUAGES} values")
    found = (
        rows.mapInArrow(_counts, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages, row = np.unique(np.array(found.column("lang").to_pylist(), dtype=object), return_inverse=True)
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    counts[row, found.column("bucket").to_numpy()] += found.column("n").to_numpy()
    table = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    return Model([str(name) for name in languages], table)


def _mixture(likely: np.ndarray, first: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares and log-likelihood per text by expectation-maximisation.

    likely: likelihoods of words, scaled per word; shares: where to start, 0 stays 0.
    """
    count = len(first) - 1
    size = np.diff(first)
    shares, fit = shares.copy(), np.zeros(count)
    active = np.flatnonzero(size)
    for step in range(STEPS + 1):
        if not len(active):
            break
        whole = len(active) == count
        words = slice(None) if whole else np.concatenate([np.arange(first[i], first[i + 1]) for i in active])
        begin = np.cumsum(size[active]) - size[active]
        joint = likely[words] * np.repeat(shares[active], size[active], axis=0)
        total = joint.sum(axis=1)
        fit[active] = np.add.reduceat(np.log(total), begin)
        if step == STEPS:
            break
        joint /= total[:, None]
        new = np.add.reduceat(joint, begin, axis=0) / size[active][:, None]
        moved = np.abs(new - shares[active]).max(axis=1)
        shares[active] = new
        active = active[moved > CLOSE]
    return shares, fit


def infer(grams: Grams, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages of the chosen set (0 for others), and the number of words."""
    count, kinds = len(grams.first) - 1, len(model.languages)
    size = np.diff(grams.first)
    if not len(grams.word) or not kinds:
        return np.zeros((count, kinds)), size
    logs = np.stack([np.add.reduceat(row[grams.bucket], grams.word) for row in model.table], axis=1)
    logs = logs.astype(np.float64)
    scale = logs.max(axis=1)
    likely = np.maximum(np.exp(logs - scale[:, None]), 1e-12)
    uniform = np.where(size[:, None] > 0, 1.0 / kinds, 0.0) * np.ones((1, kinds))
    full, best_fit = _mixture(likely, grams.first, uniform)
    order = np.argsort(-full, axis=1, kind="stable")
    cost = PENALTY * size + 0.5 * np.log(np.maximum(size, 1))
    chosen = np.zeros((count, kinds))
    filled = np.flatnonzero(size)
    chosen[filled, order[filled, 0]] = 1.0
    # One language: the sum of its word likelihoods.
    fit = np.zeros(count)
    top = np.repeat(order[:, 0], size)
    fit[filled] = np.add.reduceat(np.log(likely[np.arange(len(top)), top]), grams.first[filled])
    # All languages bound the fit of any set, so a text stops when they could not pay one more.
    open_ = filled[best_fit[filled] - fit[filled] > cost[filled]]
    for many in range(2, kinds + 1):
        if not len(open_):
            break
        some = np.concatenate([np.arange(grams.first[i], grams.first[i + 1]) for i in open_])
        first = np.append(0, np.cumsum(size[open_]))
        start = np.zeros((len(open_), kinds))
        np.put_along_axis(start, order[open_, :many], 1.0 / many, axis=1)
        shares, now = _mixture(likely[some], first, start)
        better = now - fit[open_] > cost[open_]
        chosen[open_[better]] = shares[better]
        fit[open_[better]] = now[better]
        open_ = open_[better & (best_fit[open_] - now > cost[open_])]
    return chosen, size


def _predictions(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = model.value.languages
        limit = SLICE_BYTES * SLICE_LANGUAGES // max(SLICE_LANGUAGES, len(languages))
        for batch, texts in arrays.slices(batches, "text", limit):
            shares, size = infer(Grams(texts), model.value)
            known = (size > 0) & bool(languages)
            for row in np.flatnonzero(known):
                raw = arrays.LOWER[texts.bytes[texts.at[row] : texts.at[row + 1]]]
                if not ((raw >= 97) & (raw <= 122)).any():
                    known[row] = any(map(str.isalpha, texts.raw(row).decode("utf-8", "replace")))
            best = shares.argmax(axis=1) if languages else np.zeros(len(texts), dtype=int)
            pred = [languages[i] if k else UNKNOWN for i, k in zip(best, known)]
            score = np.where(known, shares.max(axis=1, initial=0.0), 0.0).clip(0.0, 1.0)
            mix = [
                sorted(((languages[i], float(s[i])) for i in np.flatnonzero(s)), key=lambda x: (-x[1], x[0]))
                if k
                else []
                for s, k in zip(shares, known)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in batch.schema.names),
                    pa.array(pred, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array([[{"lang": a, "share": b} for a, b in m] for m in mix], MIXTURE),
                ],
                [*batch.schema.names, "lang_pred", "score", "mixture"],
            )

    return run


MIXTURE = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
ADDED = ("lang_pred", "score", "mixture")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of docs (with a text), and lang_pred, score (its share) and mixture.

    Columns of these names are replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop(*ADDED).withColumn("text", F.col("text").cast("string"))
    schema = schema_with(docs, "lang_pred string, score double, mixture array<struct<lang:string,share:double>>")
    return docs.mapInArrow(_predictions(spark.sparkContext.broadcast(model)), schema)
