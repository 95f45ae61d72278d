"""Quality classifier with learned vectors of hashed words and character n-grams.

A text is the mean of the vectors of its features: words, a mark for a word that repeats the one before it, and byte
3- and 4-grams, each hashed to a row of one table. A linear layer with softmax gives the chance of the good label.
The table and the layer are trained together by stochastic gradient descent in numpy on a bounded sample of labelled
rows. As the layer is linear, a text's score is the mean of one number per feature; only those numbers are sent out.

Defined results: a null or empty text has no feature and score 0. Without labelled rows, or with one label only, every
other text scores the share of good labels (0.5 without any). Repeated rows get repeated scores. Only the columns asked
for are carried.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .texts import slices, text_bytes, word_hashes, words
from .tokens import release_encoders

TABLE_BITS = 18
DIMENSIONS = 16
TRAIN_ROWS = 2_000  # bound of the training sample
EPOCHS = 12
RATE = 0.5
_WORD, _THREE, _FOUR = 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers of all texts, number of the text of each)."""
    data, offsets = text_bytes(texts)
    starts, stops, bounds = words(data, offsets)
    hashes = word_hashes(data, starts, stops, lower=False)
    shift = np.uint64(64 - TABLE_BITS)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    found, of = [(hashes * np.uint64(_WORD | 1)) >> shift], [owner]
    same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]))
    found.append(np.zeros(len(same), np.uint64))
    of.append(owner[same])
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    wide = data.astype(np.uint32)
    for size, factor in ((3, _THREE), (4, _FOUR)):
        if len(data) < size:
            continue
        code = wide[: len(data) - size + 1].copy()
        for j in range(1, size):
            code |= wide[j : len(data) - size + 1 + j] << np.uint32(8 * j)
        inside = owner[: len(code)] == owner[size - 1 :]
        with np.errstate(over="ignore"):
            place = (code * np.uint32(factor)) >> np.uint32(32 - TABLE_BITS)
        found.append(place[inside].astype(np.uint64))
        of.append(owner[: len(code)][inside])
    return np.concatenate(found).astype(np.int32), np.concatenate(of)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release_encoders()
    for part in slices(batches, "text"):
        found, of = features(part.column("text"))
        order = np.argsort(of, kind="stable")
        found, cuts = found[order], np.searchsorted(of[order], np.arange(part.num_rows + 1))
        rows = [np.unique(found[a:b], return_counts=True) for a, b in zip(cuts, cuts[1:])]
        yield pa.record_batch(
            [
                part.column("place"),
                part.column("label"),
                pa.array([f.astype("<i4").tobytes() for f, _ in rows], pa.binary()),
                pa.array([c.astype("<u4").tobytes() for _, c in rows], pa.binary()),
            ],
            ["place", "label", "features", "counts"],
        )


@dataclass
class Classifier:
    """One number per feature; `prior` is the score if nothing could be learnt."""

    weights: np.ndarray
    bias: float
    prior: float | None = None

    def scores(self, texts: pa.Array) -> np.ndarray:
        found, of = features(texts)
        count = np.bincount(of, minlength=len(texts))
        if self.prior is not None:
            return np.where(count > 0, self.prior, 0.0)
        total = np.bincount(of, weights=self.weights[found], minlength=len(texts))
        return np.where(count > 0, 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias))), 0.0)


def train(rows: Sequence[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 5) -> Classifier:
    """Rows are (label, feature numbers, how often each occurs)."""
    labels = [r[0] for r in rows]
    if len(set(labels)) < 2:
        return Classifier(np.zeros(1 << TABLE_BITS, np.float32), 0.0, float(labels[0]) if labels else 0.5)
    random = np.random.default_rng(seed)
    table = random.uniform(-1, 1, (1 << TABLE_BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)).tolist():
            label, found, counts = rows[i]
            share = counts.astype(np.float32) / np.float32(counts.sum(dtype=np.float64))
            step = rate * (1 - done / steps)
            done += 1
            vectors = table[found]
            hidden = share @ vectors
            out = hidden @ layer + bias
            chance = np.exp(out - out.max())
            error = chance / chance.sum()
            error[label] -= 1
            back = layer @ error
            layer -= step * np.outer(hidden, error)
            bias -= step * 0.1 * error
            # every feature moves by its share; shares are small, so they are scaled up to a fixed length
            table[found] = vectors - (step / max(float(share.max()), 1e-6) * share)[:, None] * back
    return Classifier((table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label", rows: int = TRAIN_ROWS) -> Classifier:
    """Train on the texts of at most `rows` labelled keys, the first in the order of a hash of the key.

    The keys are chosen before any text is read; of rows that share a key one counts.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__key"))
    chosen = chosen.agg(F.max(F.col(label).cast("int")).alias("label"))
    chosen = chosen.orderBy(F.xxhash64(F.col("__key").cast("string"), F.lit("fit")), "__key").limit(rows)
    texts = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "__key").select(F.xxhash64("__key").alias("place"), "label", "text")
    sparse = sample.mapInArrow(_sparse, "place long, label int, features binary, counts binary")
    one = sparse.groupBy("place").agg(F.min(F.struct("features", "label", "counts")).alias("one")).orderBy("place")
    found = one.select("one.*").toArrow()  # `rows` at most
    columns = [[v.as_buffer() for v in found.column(name)] for name in ("features", "counts")]
    ready = [
        (target, np.frombuffer(f, "<i4"), np.frombuffer(c, "<u4"))
        for target, f, c in zip(found.column("label").to_pylist(), *columns)
        if f.size
    ]
    model = train(ready)
    del found, ready, columns
    release_encoders()  # the driver's share of memory, too
    return model


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for part in slices(batches, "__text"):
            yield pa.record_batch([part.column("__keep"), pa.array(model.value.scores(part.column("__text")))], ["__keep", "__score"])

    return run


def score(docs: DataFrame, model: Classifier, keep: Sequence[str | Column], text: str = "text", name: str = "score") -> DataFrame:
    """Columns `keep` and the score from 0 to 1, higher for the good label."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 1 MB
    rows = docs.select(F.struct(*keep).alias("__keep"), F.col(text).cast("string").alias("__text"))
    kind = rows.schema["__keep"].dataType.simpleString()
    return rows.mapInArrow(_score(sent), f"__keep {kind}, __score double").select("__keep.*", F.col("__score").alias(name))
