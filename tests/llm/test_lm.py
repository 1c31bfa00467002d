"""Language model against a plain recursive version, and its edge cases."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from occurlens.llm import lm
from occurlens.llm.queries import QUERIES, _fold


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute(rows, trained, order, mu):
    counts = Counter()
    for doc_id, text in rows:
        if trained(doc_id):
            seq = tokens(text)
            for i in range(len(seq)):
                for k in range(1, order + 1):
                    counts[tuple((["<s>"] * (k - 1) + seq)[i:i + k])] += 1
            for k in range(1, order):
                counts[("<s>",) * k] += 1
    words = [g for g in counts if len(g) == 1 and g != ("<s>",)]
    n, v = sum(counts[w] for w in words), len(words)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 0.5) / (n + 0.5 * (v + 1))
        return (counts[gram] + mu * p(gram[1:])) / (counts[gram[:-1]] + mu)

    out = {}
    for doc_id, text in rows:
        seq = tokens(text)
        padded = ["<s>"] * (order - 1) + seq
        out[doc_id] = (len(seq), sum(counts[(t,)] > 0 for t in seq), n, sum(math.log10(p((t,))) for t in seq),
                       sum(math.log10(p(tuple(padded[i:i + order]))) for i in range(len(seq))))
    return out


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        a, b, n, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (a, b, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_query_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = QUERIES["op10_lm"](spark, SF_SMALL).collect()
    check(got, brute(rows, lambda d: zlib.crc32(str(d).encode()) % 5 != 1, lm.ORDER, lm.CONCENTRATION))
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in got)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # context helps on unseen texts


def test_query_tells_longer_contexts_apart(spark, tmp_path):
    rows = [(i, "a b c" if i % 2 else "x b d") for i in range(40)] + [(100, "a b c"), (101, "a b d")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op10_lm"](spark, str(tmp_path)).collect()
    check(got, brute(rows, lambda d: zlib.crc32(str(d).encode()) % 5 != 1, 3, lm.CONCENTRATION))


@pytest.mark.parametrize("order", [1, 3])
def test_orders_blocks_and_edges(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 50)
    rows = [(i, f"the cat {'sat ' * (i % 4)}on The mat{i % 3}") for i in range(40)] + [(50, None), (51, ""), (52, "zz " * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row_id", "'b' as block").repartition(3)
    got = lm.score(docs, lambda d: _fold(d) != 1, order=order, mu=2.0, shards=7).collect()
    check(got, brute(rows, lambda d: zlib.crc32(str(d).encode()) % 5 != 1, order, 2.0))


def test_empty_untrained_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert lm.score(docs.limit(0), lambda d: F.lit(True)).count() == 0
    none = lm.score(docs, lambda d: F.lit(False)).collect()
    assert all((r.n_known, r.train_tokens) == (0, 0) and r.score == pytest.approx(r.base_score) for r in none)
    assert [r.train_tokens for r in lm.score(docs, lambda d: _fold(d) != 1).collect()][0] in (3, 9)
