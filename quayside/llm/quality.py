"""Quality classification with supervised subword embeddings.

A text is the average of the vectors of its features: words, pairs of words (a word
said twice is one feature for all words), and byte n-grams of words with their edges, each hashed to
one of 2**16 vectors. A softmax layer on the average gives
the classes. Vectors and layer are learned together by stochastic gradient descent in numpy, from a
bounded sample of labelled rows (SAMPLE rows of each class, those with the least hash of their
id; each has at most 2**16 different features). The balance of the classes is put back
afterwards from the counts of all labels.

As the layer is linear, a feature's vector times the layer is one number, so scoring a text looks
up and averages numbers; whole texts are scored. Texts of more than SLICE_BYTES are worked on in pieces, cut at white
space at places that depend on the text alone; a pair of words across a cut is no feature.

Nulls, empty and repeated rows: a text without words gets the score of the classes' balance. Rows with
contradictory labels, null labels or null ids teach nothing. Without both classes, the score is
the share of class 1 among labels (0.5 without labels).
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
DIMENSIONS = 8
SIZES = (2, 3, 4)
SAMPLE = 1500
EPOCHS = 8
BATCH = 16
RATE = 2.0
SEED = 7
SPACE = 32
#: Features take about a hundred bytes of memory for each byte of text.
SLICE_BYTES = 1 << 20
WHITE = ~arrays.VISIBLE

U64 = arrays.U64


class Features:
    """Buckets of all features of texts, text after text within each kind."""

    def __init__(self, texts: arrays.Texts):
        words = arrays.Words(texts, arrays.VISIBLE, lower=False)
        count = np.diff(words.first)
        owner = np.repeat(np.arange(len(texts)), count)
        #: (owner of each feature, bucket of each feature), one for each kind of feature
        self.kinds = [(owner, self._bucket(words.hash, 1))]
        pairs = np.flatnonzero(words.left() >= 2)
        runs = arrays.Runs(words.hash, seed=9)
        # A word that is said twice is the same feature whatever the word is.
        twice = words.hash[pairs] == words.hash[pairs + 1]
        self.kinds.append((owner[pairs], self._bucket(np.where(twice, U64(0), runs.of(pairs, pairs + 2)), 2)))
        # Words with a space on both sides, one after the other: " a  word "
        size = words.end - words.start
        at = np.cumsum(size + 2) - size - 1
        data = np.full(int(size.sum()) + 2 * len(size) + max(SIZES), SPACE, dtype=np.uint8)
        inside = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        source = np.repeat(words.start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        data[inside] = words.bytes[source]
        letters = np.repeat(np.arange(len(size)), size + 2)
        rest = np.repeat(at + size + 1, size + 2) - np.arange(len(letters))
        wide = data.astype(U64)
        code = np.zeros(len(letters), dtype=U64)
        for length in range(1, max(SIZES) + 1):
            code = code << U64(8) | wide[length - 1 : length - 1 + len(letters)]
            if length in SIZES:
                some = np.flatnonzero(rest >= length)
                self.kinds.append((owner[letters[some]], self._bucket(code[some], 10 + length)))

    @staticmethod
    def _bucket(values: np.ndarray, kind: int) -> np.ndarray:
        offset = U64(kind * 0xD1B54A32D192ED03 % (1 << 64))
        return ((values * U64(arrays.BASE) + offset) >> U64(48)).astype(np.int64)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets and shares of features per text."""
    for batch, texts in arrays.slices(batches, "text", SLICE_BYTES):
        cells, counts = [], []
        for part, of in arrays.parts(texts, SLICE_BYTES, WHITE):
            found = Features(part)
            cell = np.concatenate([of[owner] * BUCKETS + bucket for owner, bucket in found.kinds])
            cell, n = np.unique(cell, return_counts=True)
            cells.append(cell)
            counts.append(n)
        cell, place = np.unique(np.concatenate(cells), return_inverse=True)
        n = np.bincount(place, np.concatenate(counts), minlength=len(cell)).astype(np.int64)
        ends = np.searchsorted(cell, np.arange(len(texts) + 1) * BUCKETS)
        parts = [slice(a, b) for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                pa.array([(cell[p] % BUCKETS).astype(np.uint16).tobytes() for p in parts], pa.binary()),
                pa.array([(n[p] / max(1, n[p].sum())).astype(np.float32).tobytes() for p in parts], pa.binary()),
            ],
            ["label", "bucket", "share"],
        )


@dataclass
class Model:
    #: What a feature adds to the difference of the classes' logits.
    weights: np.ndarray
    #: The balance of the classes in all labels, as a difference of logits.
    prior: float


def train(label: np.ndarray, buckets: list[np.ndarray], shares: list[np.ndarray], epochs: int = EPOCHS) -> np.ndarray:
    """Learn vectors and layer; returns vectors times the difference of the layer's two rows.

    A run that diverges is repeated with half the rate.
    """
    rate = RATE
    with np.errstate(over="ignore", invalid="ignore"):
        while not np.isfinite(weights := _descend(label, buckets, shares, epochs, rate)).all():
            rate /= 2.0
    return weights


def _descend(label, buckets, shares, epochs: int, first_rate: float) -> np.ndarray:
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-1.0, 1.0, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((2, DIMENSIONS), dtype=np.float32)
    rounds = epochs * -(-len(label) // BATCH)
    done = 0
    for _ in range(epochs):
        order = random.permutation(len(label))
        for begin in range(0, len(order), BATCH):
            some = order[begin : begin + BATCH]
            rate = first_rate * (1.0 - done / rounds) / len(some)
            done += 1
            hidden = np.stack([shares[i] @ vectors[buckets[i]] for i in some])
            logits = hidden @ layer.T
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(some)), label[some]] -= 1.0
            change = error @ layer
            layer -= rate * (error.T @ hidden)
            # Each vector of a text gets the whole change of the average, which then moves by it.
            for i, step in zip(some, change):
                vectors[buckets[i]] -= rate * step
    return vectors @ (layer[1] - layer[0])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from texts (doc_id, text) and labels (doc_id, label 0 or 1).

    At most ``sample`` rows of each class are used.
    """
    prepare(docs.sparkSession)
    clear = (
        labels.filter("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .select("doc_id", F.col("label").cast("int"))
    )
    counts = {row.label: row.n for row in clear.groupBy("label").agg(F.count("*").alias("n")).collect()}
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    prior = float(np.log((ones + 0.5) / (zeros + 0.5)))
    if not zeros or not ones:
        return Model(np.zeros(BUCKETS, dtype=np.float32), prior)
    chosen = [
        clear.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        for value in (0, 1)
    ]
    ids = chosen[0].unionByName(chosen[1])
    # At most 2 * sample rows, so that the broadcast is bounded.
    rows = (
        docs.filter("text is not null")
        .select("doc_id", "text")
        .join(F.broadcast(ids), "doc_id")
        .dropDuplicates(["doc_id"])
        .select("label", F.col("text").cast("string"))
        .mapInArrow(_sparse, "label int, bucket binary, share binary")
        .toArrow()
        .sort_by([("label", "ascending"), ("share", "ascending")])
    )
    label = rows.column("label").to_numpy()
    buckets = [np.frombuffer(b, dtype=np.uint16) for b in rows.column("bucket").to_pylist()]
    shares = [np.frombuffer(b, dtype=np.float32) for b in rows.column("share").to_pylist()]
    drawn = np.bincount(label, minlength=2)
    if not drawn.all():
        return Model(np.zeros(BUCKETS, dtype=np.float32), prior)
    weights = train(label, buckets, shares)
    return Model(weights, prior - float(np.log(drawn[1] / drawn[0])))


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.value.weights.astype(np.float64)
        for batch, texts in arrays.slices(batches, "text", SLICE_BYTES):
            total, n = np.zeros(len(texts)), np.zeros(len(texts))
            for part, of in arrays.parts(texts, SLICE_BYTES, WHITE):
                for owner, bucket in Features(part).kinds:
                    total += np.bincount(of[owner], weights[bucket], minlength=len(texts))
                    n += np.bincount(of[owner], minlength=len(texts))
            logit = model.value.prior + total / np.maximum(n, 1)
            score = 1.0 / (1.0 + np.exp(-logit.clip(-500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names), pa.array(score)],
                [*batch.schema.names, "score"],
            )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of docs (with a text), and score, the probability of class 1."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop("score").withColumn("text", F.col("text").cast("string"))
    return docs.mapInArrow(_scores(spark.sparkContext.broadcast(model)), schema_with(docs, "score double"))
