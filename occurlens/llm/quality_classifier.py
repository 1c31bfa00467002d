"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Every whole text gives a row of document statistics (``STATISTICS``), standardised over the
training rows. ``cos(x W + b)`` with Gaussian W approximates a Gaussian kernel over them.
The ridge scores solve normal equations that are summed over partitions: each task adds
up its own matrix, slices of it are summed in tasks of their own, and one matrix of
(features + 2) squared numbers reaches the driver, whatever the number of rows. Scores
of a fold kept out of the fit are binned on a fixed grid, pooled to a rising step function
(isotonic regression) and interpolated between step centres.

Scale: texts are read once; statistics are a small table, which all later steps read.
All labelled training rows are used, without sampling.

Defined cases: null and empty texts have the statistics of an empty text and are scored;
several labels of one id are averaged; labels that are null, of unknown ids or with a null
id are ignored; without any usable label every score is 0.5; repeated rows get equal
scores; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (LOWER, PLAIN, Texts, Words, bound_batches, list_array, mix, sum_vectors, text_slices, vector_rows, written)

FEATURES = 256
BANDWIDTH = 4.0       # of the kernel, in standard deviations
RIDGE = 1e-3          # penalty per training row
GRID = 2048           # bins of the calibration scores
SUM_PARTS = 8
THRESHOLD = 0.3

STATISTICS = ["log_words", "word_length", "upper", "digit", "punctuation", "symbol", "pipe", "exclamation", "non_ascii",
              "space", "lines_per_word", "repeated_lines", "distinct_words", "repeated_trigrams", "short_words", "long_words",
              "sentence_ends", "doubled_bytes"]


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


CLASSES = {"upper": _class(bytes(range(65, 91))), "digit": _class(b"0123456789"), "punctuation": _class(b".,;:?'\"()-"),
           "symbol": _class(b"#*$%&<>@^~_=+\\/{}[]"), "pipe": _class(b"|"), "exclamation": _class(b"!"),
           "non_ascii": _class(bytes(range(0xC0, 0x100))), "space": _class(bytes([0x20, *range(9, 14)]))}


def _by_text(texts: Texts, flags: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return np.diff(total[texts.offsets]).astype(np.float64)


def _distinct(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    key = mix(value + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.bincount(doc[np.unique(key, return_index=True)[1]], minlength=n).astype(np.float64)


def statistics(texts: Texts) -> np.ndarray:
    """(texts x statistics); shares of bytes, words, lines or trigrams, all finite."""
    n, data = texts.n, texts.data
    words = Words(texts, LOWER)
    size, count = np.diff(texts.offsets).astype(np.float64), words.counts.astype(np.float64)
    some_bytes, some_words = np.maximum(size, 1), np.maximum(count, 1)
    length = words.ends - words.starts
    per_word = lambda flag: np.bincount(words.doc, weights=flag, minlength=n) / some_words
    at, grams = words.grams(3)
    trigrams = np.bincount(words.doc[at], minlength=n).astype(np.float64)
    # lines that hold a word, by the hashes of their words in order
    line_start = np.union1d(texts.offsets[:-1], np.flatnonzero(data == 0x0A) + 1)
    _, first, in_line = np.unique(np.searchsorted(line_start, words.starts, side="right"), return_index=True, return_counts=True)
    place = (np.arange(len(words.doc)) - np.repeat(first, in_line)).astype(np.uint64)
    total = np.concatenate(([np.uint64(0)], np.cumsum(mix(words.hashes + mix(place)), dtype=np.uint64)))
    line, line_doc = total[first + in_line] - total[first], words.doc[first]
    lines = np.bincount(line_doc, minlength=n).astype(np.float64)
    last = PLAIN[data[words.ends - 1]] if len(words.ends) else np.zeros(0, np.uint8)
    doubled = np.zeros(len(data), bool)
    doubled[1:] = (data[1:] == data[:-1]) & ~CLASSES["space"][data[1:]]
    doubled[texts.offsets[:-1][texts.offsets[:-1] < len(data)]] = False
    out = {"log_words": np.log1p(count), "word_length": np.log1p(per_word(length.astype(np.float64)))}
    out |= {name: _by_text(texts, table[data]) / some_bytes for name, table in CLASSES.items()}
    out |= {"lines_per_word": lines / some_words,
            "repeated_lines": 1 - _distinct(line_doc, line, n) / np.maximum(lines, 1) * (lines > 0) - (lines == 0),
            "distinct_words": _distinct(words.doc, words.hashes, n) / some_words,
            "repeated_trigrams": (trigrams - _distinct(words.doc[at], grams, n)) / np.maximum(trigrams, 1),
            "short_words": per_word(length <= 3), "long_words": per_word(length >= 12),
            "sentence_ends": per_word(np.isin(last, np.frombuffer(b".?!", np.uint8))),
            "doubled_bytes": _by_text(texts, doubled) / some_bytes}
    return np.stack([out[name] for name in STATISTICS], axis=1)


def describe(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Written table (doc_id, x): the statistics of every row."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            x = statistics(Texts(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), list_array(x.ravel(), np.full(len(x), x.shape[1]))],
                                             names=["doc_id", "x"])

    return written(rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>"), "statistics")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(STATISTICS))


@dataclass
class Model:
    """Standardisation, kernel features, ridge weights and calibration steps."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.full(1, 0.5))

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        f = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([f, np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.ridge(x), *self.steps)


def pooled(score: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic steps (centre, share) of counted scores in rising order."""
    steps: list[list[float]] = []
    for s, g, n in zip(score, good, count):
        steps.append([s * n, g, n])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            a, b, c = steps.pop()
            steps[-1][0] += a
            steps[-1][1] += b
            steps[-1][2] += c
    total = np.array(steps)
    return total[:, 0] / total[:, 2], total[:, 1] / total[:, 2]


def fit(described: DataFrame, labels: DataFrame, training, calibration, label_col: str = "quality", id_col: str = "doc_id",
        features: int = FEATURES, bandwidth: float = BANDWIDTH, ridge: float = RIDGE) -> Model:
    """``training`` and ``calibration``: column of the id -> boolean column of the rows to fit
    the ridge scores on and to calibrate on."""
    d = len(STATISTICS)
    y = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label"))
         .filter("id is not null and label is not null").groupBy("id").agg(F.avg("label").alias("y")))
    known = described.join(y, F.col("doc_id") == F.col("id")).select("doc_id", "x", "y")
    train = written(known.filter(training(F.col("doc_id"))).select("x", "y"), "train")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * d + 1)
        for batch in batches:
            x = _matrix(batch)
            total += np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [len(x)]])
        yield vector_rows(total, 1)

    s = sum_vectors(train.mapInArrow(moments, "part int, data binary"), 1)
    rng = np.random.Generator(np.random.PCG64(11))
    n = s[-1] if s is not None else 0
    mean = s[:d] / n if n else np.zeros(d)
    scale = np.sqrt(np.maximum(s[d:2 * d] / n - mean ** 2, 0)) if n else np.ones(d)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(size=(d, features)) / bandwidth,
                  rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1))
    if not n:
        return model

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for batch in batches:
            f = model.features(_matrix(batch))
            a += f.T @ f
            b += f.T @ batch.column("y").to_numpy(zero_copy_only=False)
        yield vector_rows(np.concatenate([a.ravel(), b]), SUM_PARTS)

    v = sum_vectors(train.mapInArrow(normal, "part int, data binary"), SUM_PARTS)
    a, b = v[:-features - 1].reshape(features + 1, -1), v[-features - 1:]
    penalty = np.eye(features + 1) * ridge * n
    penalty[-1, -1] = 0  # the constant is not shrunk
    model.weights = np.linalg.solve(a + penalty + 1e-9 * n * np.eye(features + 1), b)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, GRID))
        for batch in batches:
            s = model.ridge(_matrix(batch))
            at = np.clip(((s + 0.5) * GRID / 2).astype(np.int64), 0, GRID - 1)  # scores lie around 0 to 1
            for i, w in enumerate((s, batch.column("y").to_numpy(zero_copy_only=False), np.ones(len(s)))):
                total[i] += np.bincount(at, weights=w, minlength=GRID)
        yield vector_rows(total, 1)

    held = known.filter(calibration(F.col("doc_id"))).select("x", "y")
    v = sum_vectors(held.mapInArrow(bins, "part int, data binary"), 1)
    if v is None or not v[2 * GRID:].any():
        v = sum_vectors(train.mapInArrow(bins, "part int, data binary"), 1)
    score, good, count = v.reshape(3, GRID)
    used = count > 0
    model.steps = pooled(score[used] / count[used], good[used], count[used])
    return model


def classify(docs: DataFrame, labels: DataFrame, training, calibration, threshold: float = THRESHOLD,
             text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier) and predicted per document."""
    described = describe(docs, text_col, id_col)
    model = fit(described, labels, training, calibration, id_col=id_col, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_matrix(batch)))], names=["doc_id", "score"])

    kind = described.schema["doc_id"].dataType.simpleString()
    scored = described.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
