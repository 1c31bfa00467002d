"""Decontamination against a plain version, the winnowing guarantee, and edge cases."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from occurlens.llm import decontaminate as dc
from occurlens.llm.common import ALNUM, Texts, Words


def words(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(item)
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i:i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[key]
        names = sorted(str(i) for i in found if i is not None)
        out[doc_id] = (len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))
    return out


def test_noise_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda: rng.choice(["a", "b", "cé", "D4", "x"])
    long = [" ".join(f"q{i}r{j}" for j in range(rng.randint(10, 40))) for i in range(12)]
    items = list(enumerate(long + ["one two three", "", "Solo", "a b a", "x x x x x x x x x x x x"]))
    items += [(100, long[0]), (100, long[0]), (None, long[1]), (101, None)]
    docs = []
    for i in range(150):
        parts = [word() for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            source = rng.choice(long).split()
            a = rng.randrange(len(source))
            parts[len(parts) // 2:len(parts) // 2] = source[a:a + rng.randint(1, 25)]
        docs.append((i, rng.choice([" ", ", ", "--\n"]).join(parts)))
    docs += [(500, None), (501, ""), (502, "ONE, two;three one two"), (503, "x " * 5000 + long[3] + " solo" * 3)]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row_id", "'c' as cands").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in dc.digest(d, b).collect()}
    assert got == brute(docs, items)
    kept = dc.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if not r[4])


def test_every_shared_window_shares_a_fingerprint():
    rng = np.random.default_rng(3)
    for _ in range(40):
        span = [f"s{x}" for x in rng.integers(0, 4, 10)]
        a = [f"a{x}" for x in rng.integers(0, 9, 30)]
        b = [f"b{x}" for x in rng.integers(0, 9, 30)]
        prints = []
        for side in (a[:11] + span + a[11:], b[:5] + span + b[5:]):
            w = Words(Texts(pa.array([" ".join(side)])), ALNUM)
            first, value, _ = dc.fingerprints(w, 10, 5, [])
            prints.append(set(value.tolist()))
        assert prints[0] & prints[1]


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b c"), (None, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert dc.digest(docs.limit(0), items).count() == 0
    assert [r.n_hit for r in dc.digest(docs, items.limit(0)).collect()] == [0, 0]
    assert [r.n_hit for r in dc.digest(docs, items).collect()] == [3, 3]
