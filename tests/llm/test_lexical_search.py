"""Ranked lexical search: ranks against a plain version, the sharing graph, edge cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from occurlens.llm import lexical_search as ls

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, top=20):
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in set(items):
        found = []
        for d, c in held:
            n = sum(c.values())
            m = 75 + 25 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item_id, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


def result(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def sample(n=250, seed=4):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["The", "the", "of", "É", "é", "漢", "x1"]
    text = lambda k: " ".join(rng.choice(vocab[:rng.choice([8, 67])]) + rng.choice(["", ".", "'s", "-"]) for _ in range(k))
    docs = [(i, text(rng.randint(0, 40))) for i in range(n)]
    return docs, [(i, text(rng.randint(1, 30))) for i in range(30)]


def test_ranks_against_brute_force(spark):
    docs, items = sample()
    docs += [docs[3], docs[3], (None, docs[3][1]), (None, docs[9][1]), (900, None), (901, ""), (902, "... --"), (903, "the " * 30000)]
    docs += [(1000 + i, "the same text of a tie w1 w2") for i in range(40)]
    items += [items[0], (0, "another text w3 under one id"), (None, "w1 w2"), (500, None), (501, ""), (502, "neverseen"), (503, "w1 " * 50)]
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as n", "'a' as terms", "2 as item_id").repartition(5)
    q = spark.createDataFrame(items, ITEMS).selectExpr("*", "7 as doc_id", "8 as rank")
    want = brute(docs, items)
    assert result(ls.search(d, q)) == want
    assert result(ls.search(d, q, block_bytes=600)) == want  # several blocks of items
    assert result(ls.search(d, q, top=3)) == brute(docs, items, 3)


def test_best_rows_survive_compaction(spark, monkeypatch):
    monkeypatch.setattr(ls, "CANDIDATES", 50)
    monkeypatch.setattr(ls, "MATRIX_BYTES", 1)
    docs, items = sample(seed=6)  # one document at a time, compacted after every few
    assert result(ls.search(spark.createDataFrame(docs, DOCS).coalesce(1), spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def test_shared_sets_are_computed_once_and_sums_are_exact():
    common = " ".join(f"c{i}" for i in range(16))
    texts = [f"{common} own{i} own{i}" for i in range(12)]
    g = ls.SharedSums(list(range(12)), texts)
    assert len(g.operands) <= 12 * 4 < 12 * 18  # the shared 16 terms are one operand of each item
    rng = np.random.default_rng(1)
    x = rng.integers(0, 10**9, (len(g.vocabulary), 5))
    term, doc = np.divmod(np.arange(x.size), 5)
    naive = np.zeros((12, 5), np.int64)
    words = {int(h): i for i, h in enumerate(g.vocabulary)}
    from occurlens.llm.common import ALNUM, Texts, Words
    import pyarrow as pa
    w = Words(Texts(pa.array(texts)), ALNUM)
    for d, h in zip(w.doc, w.hashes):
        naive[d] += x[words[int(h)]]
    assert (g.scores(term, doc, x.ravel(), 5) == naive).all()


def test_levels_only_use_earlier_nodes():
    _, items = sample(seed=9)
    g = ls.SharedSums([i for i, _ in items], [t for _, t in items])
    seen = len(g.vocabulary)
    for first, left, right in g.levels:
        assert first == seen and max(left.max(), right.max()) < first
        seen += len(left)
    assert seen == g.nodes and g.operands.max() < g.nodes
    parents = defaultdict(int)
    for _, left, right in g.levels:
        for n in (*left, *right):
            parents[n] += 1
    assert any(parents[n] > 1 for n in parents)  # a graph, not only a tree


def test_length_norm_beyond_64_bits():
    n = np.array([10**9, 7], np.int64)
    assert ls.length_norm(n, 10**12, 10**15).tolist() == [75 + 25 * 10**9 * 10**12 // 10**15, 75]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a b")], ITEMS)
    for d, q in ((docs, items), (docs, some[1]), (some[0], items)):
        got = ls.search(d, q)
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]
