"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lowered, runs of non-letters become one blank, and n-grams of 1 to 3 characters are
hashed to ``BUCKETS`` columns, weighted ``(1 + log tf) * idf`` and scaled to unit length.
Document frequencies come from every training text. The weights are learnt by
follow-the-regularised-leader (per-coordinate, with L1 and L2 penalties) on a bounded sample
of labelled rows: about ``PER_LANGUAGE`` a language, drawn by a hash of id and text. A
temperature is fitted on a fifth of the sample that the weights have not seen.

Scale: two narrow passes over the whole texts (document frequencies, then prediction); the
document frequencies are summed slice by slice (``sum_vectors``); the model is a fixed number
of columns a language, of which the non-zero ones are shipped.

Defined cases: null texts and texts without a letter give ``und`` with score 0; a null language
is not learnt; null ids are not used for training; without any training row everything is
``und``; with one language that is the answer, score 1; repeated rows get equal answers; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, sum_vectors, text_slices, vector_rows

BUCKETS = 1 << 14
PER_LANGUAGE = 1500
EPOCHS = 3
ALPHA, BETA = 0.5, 1.0          # learning rate
L1, L2 = 0.02, 0.1
SUM_PARTS = 4
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point: itself for a letter, else the blank."""
    points = np.arange(0x110000, dtype=np.uint32)
    is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return np.where(is_letter, points, 32).astype(np.uint32)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(columns, counts) of the n-grams of a text; empty without a letter. Long texts are
    counted in runs that overlap by two characters."""
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(text or ""), 1 << 20):
        run = text[max(0, at - 2):at + (1 << 20)].lower()
        c = _letters()[np.frombuffer(run.encode("utf-32-le", "surrogatepass"), np.uint32)]
        c = c[(c != 32) | (np.concatenate(([0], c[:-1])) != 32)].astype(np.uint64)
        if not (c != 32).any():
            continue
        h = np.zeros(len(c), np.uint64)
        for n in range(1, 4):
            if len(c) < n:
                break
            h = (h[:len(c) - n + 1] + c[n - 1:] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
            total += np.bincount((h >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1), minlength=BUCKETS)
    used = np.flatnonzero(total)
    return used, total[used]


def weighted(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    used, count = counted(text)
    x = (1 + np.log(count)) * idf[used]
    return used, x / max(np.sqrt((x * x).sum()), 1e-12)


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, alpha: float = ALPHA, beta: float = BETA,
         l1: float = L1, l2: float = L2, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (BUCKETS x classes) by per-coordinate follow-the-regularised-leader."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def leader(at):
        shrunk = np.sign(z[at]) * l1 - z[at]
        return np.where(np.abs(z[at]) <= l1, 0.0, shrunk / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for at, x, label in rows:
            w = leader(at)
            p = softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return leader(slice(None))


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Divisor of the scores with the smallest log-loss (golden-section search)."""
    def loss(t):
        return -np.log(np.maximum(softmax(scores / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean()

    a, b, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _texts(docs: DataFrame, text_col: str, id_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))


def train(rows: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray, np.ndarray, float] | None:
    """(languages, idf, weights, temperature) from labelled rows (doc_id, text, lang)."""
    amounts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language
    if not amounts:
        return None
    languages = sorted(amounts)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1)
        for part in text_slices(batches):
            for text in part.column("text"):
                used, _ = counted(text.as_py())
                total[used] += 1
                total[BUCKETS] += 1
        yield vector_rows(total, SUM_PARTS)

    df = sum_vectors(rows.select("text").mapInArrow(frequencies, "part int, data binary"), SUM_PARTS)
    idf = np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 1

    share = F.lit(0.0)
    for lang, n in amounts.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_language / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(draw < share).withColumn("draw", F.xxhash64("text", "doc_id"))
    index = {lang: i for i, lang in enumerate(languages)}

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, held = [], []
        for part in text_slices(batches):
            for text, lang, draw in zip(part.column("text"), part.column("lang").to_pylist(), part.column("draw").to_pylist()):
                at, x = weighted(text.as_py(), idf)
                (held if draw % 5 == 0 else examples).append((draw, at, x.astype(np.float32), index[lang]))
        examples, held = sorted(examples or held, key=lambda e: e[0]), sorted(held or examples, key=lambda e: e[0])
        if not examples:
            return
        w = ftrl([e[1:] for e in examples], len(languages))
        scores = np.array([x @ w[at] for _, at, x, _ in held])
        t = temperature(scores, np.array([e[3] for e in held]))
        yield pa.RecordBatch.from_pydict({"weights": [w.astype(np.float32).tobytes()], "temperature": [t]})

    # The sample is drawn where the texts are read; only its rows, at most about languages x
    # per_language of them, meet in one task, in an order fixed by a hash.
    got = sample.select("text", "lang", "draw").repartition(1).mapInArrow(learn, "weights binary, temperature double").collect()
    if not got:
        return None
    weights = np.frombuffer(got[0]["weights"], np.float32).reshape(BUCKETS, len(languages))
    return languages, idf, weights, got[0]["temperature"]


def identify(docs: DataFrame, training, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang",
             per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, lang_pred, score per document. ``training``: column of the id -> boolean column."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = _texts(docs, text_col, id_col, lang_col)
    model = train(rows.filter(F.col("lang").isNotNull() & training(F.col("doc_id"))), per_language)
    shared = spark.sparkContext.broadcast(model)  # buckets x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in text_slices(batches):
            names, scores = [], []
            for text in part.column("text"):
                name, score = UNKNOWN, 0.0
                if model is not None:
                    languages, idf, weights, t = model
                    at, x = weighted(text.as_py(), idf)
                    if len(at):
                        p = softmax(x @ weights[at] / t)
                        best = int(p.argmax())
                        name, score = languages[best], float(p[best])
                names.append(name)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
