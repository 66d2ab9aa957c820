"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

Two dictionaries hold text of the training rows with label 1 and with label 0. A text is compressed with either, and without one;
the differences of the compressed sizes, over the text's size, say which kind of text it repeats. A logistic curve, fitted on training
rows whose text is not in the dictionaries, makes them a probability. It also has the size without a dictionary, as the difference means less for a text
that compresses well by itself.

The dictionaries come from a sample of at most about ``fit_rows`` rows and ``fit_chars`` characters, chosen by a hash of the doc_id. Whole texts of the
sample are cut into pieces of ``piece`` bytes, and all pieces go into training. Each half of the rows gives a pair of dictionaries, the curve is fitted on
the other half, and a text's values are the means over both pairs, so all rows of the sample count. A dictionary is trained in one way at every size: it is an eighth of
its text long, ``dictionary_bytes`` at most, which bounds what is sent to the executors. Every row is scored over its whole text.

Defined results: null and empty texts get the training rows' share of label 1 (0.5 without any); a null doc_id is scored and isn't held out; labels that are
null or contradict each other are no training rows; a label whose text has nothing to choose from, as one repeated word or a few characters, has no dictionary, and
the size without one stands for it; repeated rows are scored each for itself; with one label only, or none, every score is that share;
extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumq.llm import shared, words
from vellumq.llm.toxicity import labelled

LEVEL = 3


class Sizes:
    """Compressed sizes of a text with the good, the bad and no dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.tools = []
        for held in (good, bad):
            data = zstandard.ZstdCompressionDict(held, dict_type=zstandard.DICT_TYPE_FULLDICT) if held else None
            if data is not None:
                data.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, **plain) if data is not None else None)
        self.alone = zstandard.ZstdCompressor(level=LEVEL, **plain)

    def features(self, data: bytes) -> list[float]:
        """The normalised size difference, the sizes without and with the good dictionary, the difference less for texts over 200 bytes, and the square of the second."""
        n = len(data)
        own = len(self.alone.compress(data)) / (n + 20)
        good, bad = (len(t.compress(data)) / (n + 20) if t else own for t in self.tools)
        return [bad - good, own, good, (bad - good) * min(1.0, 200 / (n + 1)), own * own]


def dictionary(texts: list[bytes], size: int, piece: int = 4096) -> bytes:
    """A dictionary of an eighth of the texts' length, 256 bytes at least and size at most, trained on all their pieces; empty where training finds nothing to choose from."""
    parts = [t[i : i + piece] for t in texts for i in range(0, len(t), piece)]
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, parts)) // 8)), parts).as_bytes()
    except zstandard.ZstdError:
        return b""


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights, the constant last, by Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step / max(1.0, float(np.abs(step).max()) / 4)
    return w


def train(sample: DataFrame, dictionary_bytes: int = 112_640, piece: int = 4096) -> tuple[list[bytes], list[bytes], list[float], float]:
    """The dictionaries of either half, good and bad, means, scales and weights in one list, and the share of label 1; fitted in one task."""

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(t.encode(), y) for part in words.pieces(batches, "text") for t, y in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True)]
        y = np.array([r[1] for r in rows])
        share = float(y.mean()) if len(y) else 0.5
        good: list[bytes] = []
        bad: list[bytes] = []
        model: list[float] = []
        if 0 < y.sum() < len(y):
            half = [rows[0::2], rows[1::2]]
            points, labels = [], []
            for i in (0, 1):
                pair = [dictionary([t for t, label in half[i] if label == want], dictionary_bytes, piece) for want in (1, 0)]
                good.append(pair[0])
                bad.append(pair[1])
                sizes = Sizes(*pair)
                points += [sizes.features(t) for t, _ in half[1 - i]]
                labels += [label for _, label in half[1 - i]]
            x = np.array(points)
            mean, scale = x.mean(0), x.std(0) + 1e-9
            model = [*mean, *scale, *logistic((x - mean) / scale, np.array(labels))]
        yield pa.RecordBatch.from_arrays([pa.array([good], pa.list_(pa.binary())), pa.array([bad], pa.list_(pa.binary())), pa.array([[float(v) for v in model]], pa.list_(pa.float64())), pa.array([share])], names=["good", "bad", "model", "share"])

    row = sample.repartition(1).sortWithinPartitions("order", "label").select("text", "label").mapInArrow(fit, "good array<binary>, bad array<binary>, model array<double>, share double").head()
    return ([bytes(x) for x in row[0]], [bytes(x) for x in row[1]], list(row[2]), row[3]) if row else ([], [], [], 0.5)


def scored(documents: DataFrame, model: tuple[list[bytes], list[bytes], list[float], float]) -> DataFrame:
    """doc_id, difference (normalised), score of every row."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad, numbers, share = sent.value
        halves = [Sizes(*pair) for pair in zip(good, bad, strict=True)] or [Sizes(b"", b"")]
        k = (len(numbers) - 1) // 3
        mean, scale, w = (np.array(x) for x in (numbers[:k], numbers[k : 2 * k], numbers[2 * k :]))
        for part in words.pieces(batches, "text"):
            data, offsets = words.utf8(part.column("text"))
            whole = data.tobytes()
            x = np.array([np.mean([sizes.features(whole[a:b]) for sizes in halves], axis=0) if b > a else [0.0] * 5 for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
            p = np.full(len(x), share)
            if len(numbers):
                p = np.where(np.diff(offsets) > 0, 1 / (1 + np.exp(-np.clip((x - mean) / scale @ w[:-1] + w[-1], -35, 35))), share)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(x[:, 0]), pa.array(p)], names=["doc_id", "difference", "score"])

    return documents.select("doc_id", "text").mapInArrow(score, "doc_id bigint, difference double, score double")


def quality(documents: DataFrame, labels: DataFrame, training: Column, fit_rows: int = 20_000, fit_chars: int = 40_000_000) -> DataFrame:
    """doc_id, difference, score (0 to 1) of every document, learnt from the labelled rows that training selects."""
    return scored(documents, train(labelled(documents, labels, "quality", training, fit_rows, fit_chars)))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every whole text, learnt from the labelled rows that aren't held out. Odd rows as in the module's text."""
    held = F.coalesce(shared.fold(F.col("doc_id"), 4) == 2, F.lit(False))
    out = quality(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"), ~held)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
