"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each present or not: its words, the words' beginnings (four, five and six bytes), neighbouring
pairs, and pairs around one word (skip-grams). Each kind is hashed into 2^bits places. FTRL-proximal keeps a learning rate
for each coordinate; its L1 term leaves few weights, which are sent to the executors as a list of (place, weight) pairs: at most one for each
feature of two rows of the sample, whatever the corpus holds, and nothing else cuts them.

The model is fitted in one task on a sample of at most about ``fit_rows`` labelled rows and ``fit_chars``
characters, chosen by a hash of the doc_id; this bound is the only one. Every row is scored over its whole text.

Defined results: null and empty texts get the score of a text without features; a null doc_id is scored and isn't held out;
labels that are null or contradict each other are no training rows; repeated rows are scored each for itself; without training
rows of both labels every score is the share of label 1 (0.5 without labels); extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumq.llm import shared, words

KINDS = 6
#: Value of a present feature, by kind: words, three beginnings, pairs, skip-grams. Pairs are many and each is rarely evidence.
VALUES = np.array([1, 1, 1, 1, 0.3, 0.3])


def features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of the features of all texts, with repeats."""
    data, offsets = words.utf8(texts)
    begins, ends, first = words.spans(data, offsets, words.ALNUM)
    whole = words.hashes(data, begins, ends)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found = [(text, whole)]
    for n in (4, 5, 6):
        long = np.flatnonzero(ends - begins >= n)
        found.append((text[long], words.hashes(data, begins[long], begins[long] + n)))
    for gap in (1, 2):
        same = np.flatnonzero(text[gap:] == text[:-gap])
        found.append((text[same], words.mix(whole[same] * np.uint64(0xF1357AEA2E62A9C5) + whole[same + gap])))
    shift = np.uint64(64 - bits)
    places = [(h >> shift).astype(np.int64) + (kind << bits) for kind, (_, h) in enumerate(found)]
    return np.concatenate([t for t, _ in found]), np.concatenate(places)


class Ftrl:
    """FTRL-proximal for logistic loss: per-coordinate rates, L1 and L2."""

    def __init__(self, size: int, alpha: float = 2.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.0):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.full(len(z), self.l1)
        if isinstance(at, np.ndarray):
            l1[at == len(self.z) - 1] = 0  # the constant term
        else:
            l1[-1] = 0
        return np.where(np.abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        """places: with the constant's last."""
        w = self.weights(places)
        g = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
        n = self.n[places]
        self.z[places] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[places] = n + g * g


def fitted(rows: list[tuple[np.ndarray, int]], size: int, epochs: int) -> np.ndarray:
    """Weights of all places, the constant last, each multiplied by its kind's value."""
    values = np.append(np.repeat(VALUES, size // KINDS), 1.0)
    model = Ftrl(size)
    for _ in range(epochs):
        for places, y in rows:
            model.learn(places, values[places], y)
    return model.weights(slice(None)) * values


def calibration(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and constant of a logistic curve from margins to probabilities (Platt), slope above 0, by Newton steps."""
    a, b = 1.0, 0.0
    x = np.stack((margins, np.ones(len(margins))))
    prior = np.diag([0.02, 0.02])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + prior, x @ (p - labels) + prior @ np.array([a - 1, b]))
        step = step / max(1.0, float(np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return max(a, 0.05), b


def labelled(documents: DataFrame, labels: DataFrame, label: str, training: Column, fit_rows: int, fit_chars: int) -> DataFrame:
    """A bounded sample of the training rows: text, label, order. Rows with null or contradicting labels are left out."""
    known = labels.filter(F.col(label).isNotNull()).groupBy(F.col("doc_id").alias("key")).agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("most")).filter("label = most").drop("most")
    known = known.withColumn("doc_id", F.col("key")).filter(training).drop("doc_id")
    rows = documents.filter(F.length(F.trim("text")) > 0).select(F.col("doc_id").alias("key"), "text").join(known, "key")
    total = documents.select("doc_id", F.length("text").alias("c")).join(known.select("key"), F.col("doc_id") == F.col("key")).agg(F.count("*"), F.sum("c")).head()
    share = min(1.0, fit_rows / max(1, total[0] or 0), fit_chars / max(1, total[1] or 0))
    order = F.xxhash64("key", F.lit(11))
    return rows.filter(shared.within(order, share)).select("text", "label", order.alias("order"))


def train(sample: DataFrame, bits: int = 20, epochs: int = 8, least: int = 2) -> tuple[np.ndarray, np.ndarray, float]:
    """Places, weights and constant of a model fitted in one task. Features of fewer than least rows get no weight.

    The sample's halves are scored by a model of the other half each; a logistic curve over those scores calibrates the model of all.
    """
    size = KINDS << bits

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[np.ndarray] = []
        labels: list[int] = []
        seen = np.zeros(size + 1, np.int32)
        for part in words.pieces(batches, "text"):
            text, place = features(part.column("text"), bits)
            both = np.unique(text * size + place)
            own += [x.astype(np.int32) for x in np.split(both % size, np.searchsorted(both // size, np.arange(1, part.num_rows)))]
            labels += part.column("label").to_pylist()
        for x in own:
            seen[x] += 1
        rows = [(np.append(x[seen[x] >= least], size).astype(np.int32), y) for x, y in zip(own, labels, strict=True)]
        y = np.array(labels)
        if 0 < y.sum() < len(y):
            margins = np.zeros(len(rows))
            for half in (0, 1):
                if 0 < y[1 - half :: 2].sum() < len(y[1 - half :: 2]):
                    w = fitted(rows[1 - half :: 2], size, epochs)
                    margins[half::2] = [w[x].sum() for x, _ in rows[half::2]]
            slope, constant = calibration(margins, y) if margins.any() else (1.0, 0.0)
            w = fitted(rows, size, epochs) * slope
            bias, w = float(w[-1]) + constant, w[:-1]
        else:
            share = y.mean() if len(y) else 0.5
            bias, w = float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -35, 35)), np.zeros(size)
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array([kept.tolist()], pa.list_(pa.int64())), pa.array([w[kept].tolist()], pa.list_(pa.float64())), pa.array([bias], pa.float64())], names=["places", "weights", "bias"])

    row = sample.repartition(1).sortWithinPartitions("order", "label").select("text", "label").mapInArrow(fit, "places array<bigint>, weights array<double>, bias double").head()
    if row is None:  # no partition at all
        return np.zeros(0, np.int64), np.zeros(0), 0.0
    return np.array(row[0], np.int64), np.array(row[1], np.float64), row[2]


class Scorer:
    """Scores of texts by a model of train()."""

    def __init__(self, model: tuple[np.ndarray, np.ndarray, float], bits: int):
        places, weights, self.bias = model
        self.bits, self.size = bits, KINDS << bits
        self.table = np.zeros(self.size, np.float32)
        self.table[places] = weights

    def __call__(self, texts: pa.Array) -> np.ndarray:
        text, place = features(texts, self.bits)
        hit = np.flatnonzero(self.table[place])
        both = np.unique(text[hit] * self.size + place[hit])
        total = np.full(len(texts), self.bias)
        np.add.at(total, both // self.size, self.table[both % self.size])
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def scored(documents: DataFrame, model: tuple[np.ndarray, np.ndarray, float], bits: int = 20) -> DataFrame:
    """doc_id, score of every row."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value, bits)
        for part in words.pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(scorer(part.column("text")))], names=["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(score, "doc_id bigint, score double")


def kept(documents: DataFrame, labels: DataFrame, training: Column, threshold: float = 0.7, fit_rows: int = 12_000, fit_chars: int = 40_000_000, bits: int = 20) -> DataFrame:
    """The rows, with all their columns, whose score is below the threshold."""
    sent = documents.sparkSession.sparkContext.broadcast(train(labelled(documents, labels, "toxic", training, fit_rows, fit_chars), bits))

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value, bits)
        for part in words.pieces(batches, "text"):
            yield part.filter(pa.array(scorer(part.column("text")) < threshold))

    return documents.mapInArrow(choose, documents.schema)


def toxicity(documents: DataFrame, labels: DataFrame, training: Column, fit_rows: int = 12_000, fit_chars: int = 40_000_000, bits: int = 20) -> DataFrame:
    """doc_id, score (0 to 1) of every document, learnt from the labelled rows that training selects."""
    model = train(labelled(documents, labels, "toxic", training, fit_rows, fit_chars), bits)
    return scored(documents, model, bits)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learnt from the labelled rows that aren't held out. Odd rows as in the module's text."""
    held = F.coalesce(shared.fold(F.col("doc_id"), 3) == 1, F.lit(False))
    out = toxicity(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"), ~held)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
