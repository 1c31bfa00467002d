"""Quality classifier and language identification: held-out accuracy, parts against plain
versions, edge cases."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from occurlens.llm import language_id, quality_classifier as qc
from occurlens.llm.common import Texts
from occurlens.llm.queries import QUERIES


def test_quality_held_out(spark):
    got = QUERIES["op2_quality_classifier"](spark, SF_MID).toPandas()
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    held = got[got.held_out].merge(spark.read.parquet(f"{SF_MID}/labels.parquet").toPandas(), on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.9


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = QUERIES["op5_language_id"](spark, SF_MID).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97


def test_ridge_equals_direct_solution(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, len(qc.STATISTICS)))
    y = (x[:, 0] + 0.1 * rng.normal(size=400) > 0).astype(float)
    described = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "doc_id long, x array<double>").repartition(5)
    labels = spark.createDataFrame([(i, int(v), 0) for i, v in enumerate(y)], "doc_id long, quality int, x int")
    m = qc.fit(described, labels, lambda c: c % 5 != 0, lambda c: c % 5 == 0, features=32)
    use = np.arange(400) % 5 != 0
    f, n = m.features(x[use]), use.sum()
    pen = np.eye(33) * qc.RIDGE * n
    pen[-1, -1] = 0
    assert m.weights == pytest.approx(np.linalg.solve(f.T @ f + pen + 1e-9 * n * np.eye(33), f.T @ y[use]), abs=1e-6)
    assert (np.diff(m.steps[1]) >= 0).all()
    auc = np.mean([m.score(x[[i]])[0] for i in range(0, 400, 5) if y[i]]) - np.mean([m.score(x[[i]])[0] for i in range(0, 400, 5) if not y[i]])
    assert auc > 0.4


def test_statistics_are_finite_and_independent_of_neighbours():
    texts = [None, "", " ", "\n\n", "a", "A!! B!!\nA!! B!!", "é ñ. 12 | 3", "x" * 5000, "word " * 300]
    together = qc.statistics(Texts(pa.array(texts)))
    assert np.isfinite(together).all()
    for i, t in enumerate(texts):
        assert np.allclose(qc.statistics(Texts(pa.array([t], pa.string())))[0], together[i]), t


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "en"), (1, "12 !!", "en"), (None, "hello there", None), (2, "hello there", "en")],
                                 "doc_id long, text string, lang string").selectExpr("*", "1 as x")
    labels = spark.createDataFrame([(None, 1), (2, None), (9, 1)], "doc_id long, quality int")
    fold = lambda c: c % 5 != 0
    out = qc.classify(docs, labels, fold, fold).collect()
    assert len(out) == 4 and all(r.score == 0.5 for r in out)
    assert qc.classify(docs.limit(0), labels.limit(0), fold, fold).count() == 0
    langs = language_id.identify(docs, fold).collect()
    assert sorted((r.lang_pred, r.score) for r in langs) == [("en", 1.0), ("en", 1.0), ("und", 0.0), ("und", 0.0)]
    assert {r.lang_pred for r in language_id.identify(docs, lambda c: F.lit(False)).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), fold).count() == 0


def test_long_texts_counted_in_runs():
    text = "abc déf " * 200_000
    used, count = language_id.counted(text)
    assert count.sum() > len(text) * 2.5 and len(used) < 200
    assert len(language_id.counted("12 3!")[0]) == 0


def test_ftrl_is_sparse_and_separates():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(300):
        label = int(rng.integers(2))
        at = np.unique(np.concatenate(([10 + label], rng.integers(100, 1000, 5))))
        rows.append((at, np.full(len(at), len(at) ** -0.5), label))
    w = language_id.ftrl(rows, 2)
    assert (w != 0).mean() < 0.1 and w[10, 0] > w[10, 1] and w[11, 1] > w[11, 0]
