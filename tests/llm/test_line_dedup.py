"""Line deduplication: digests, bitmaps and rebuilt texts against a plain version, hot lines, edge cases."""

import hashlib
import random
import re

from occurlens.llm import line_dedup as ld

SCHEMA = "doc_id long, text string"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))


def brute(rows, min_chars=10):
    rank = lambda d: (d is None, d or 0)
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)], key=rank) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def digests(rows):
    return sorted(((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(rows)), key=str)


def sample(seed=3, n=300):
    rng = random.Random(seed)
    pool = ["All rights reserved.", "  ALL rights Reserved.\t", "ÄLL rights reserved.", "äLL rights reserved.", "short", "", " ",
            "exactly10!", "nine char", "漢字漢字漢字漢字漢字", "a wide blank stays ", "\x0bvertical and form\f"]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < .6 else f"line number {rng.randrange(500)}"
                          for _ in range(rng.randint(0, 9)))) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_noise_against_brute_force(spark):
    rows = sample()
    rows += [(None, "All rights reserved.\nonly without an id"), (None, "only without an id\nx"), (9000, None), (9001, ""),
             (9002, "\n\n\n"), (9003, "Windows line ends\r\n" * 3), (9004, "windows line ends")]
    rows += [rows[0], rows[0], (rows[1][0], "another text with the same id\nAll rights reserved.")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row_id", "'x' as lines", "0 as pos").repartition(5)
    assert sorted(map(tuple, ld.digest(docs).collect()), key=str) == digests(rows)


def test_bitmaps_are_runs_of_kept_lines_and_rebuild_the_text(spark):
    rows = sample(5, 120)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "doc_id * 2 as `n chars.x`")
    plain = {d: (n, k, t) for d, n, k, t in brute(rows)}
    text = dict(rows)
    for r in ld.bitmaps(docs).collect():
        lines = text[r.doc_id].split("\n")
        runs = [tuple(x) for x in r.keep_bitmap]
        assert all(a[0] + a[1] < b[0] for a, b in zip(runs, runs[1:])) and all(n > 0 for _, n in runs)
        kept = [x for a, n in runs for x in lines[a:a + n]]
        assert (r.n_lines, r.n_dropped, "\n".join(kept)) == plain[r.doc_id]
    out = ld.apply(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: (r.text, r["n chars.x"]) for r in out.collect()} == {d: (t, 2 * d) for d, (_, _, t) in plain.items()}


def test_hot_line_is_spread_and_kept_once(spark):
    """One line in every document: its cell is cut into slices, and no range holds all of it."""
    rows = [(i, f"the line that everybody has\nown line of number {i}\nthe line that everybody has") for i in range(4000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    measured, total = ld.measure(docs)
    lines = measured.selectExpr("row_id", "doc_id", "inline(lines)")
    assert total == 12000 and ld._sliced(lines, total).agg({"slices": "max"}).first()[0] > 8
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in ld.digest(docs).collect()}
    assert got.pop(0) == (3, 0) and set(got.values()) == {(3, 2)} and len(got) == 3999


def test_long_text_and_empty_table(spark):
    big = "\n".join(f"unique line {i}" if i % 3 else "a line of two documents" for i in range(60000)) + "\n" + "x" * 300000
    rows = [(1, big), (0, "a line of two documents\n" + "x" * 300000), (2, "x" * 299999)]
    assert sorted(map(tuple, ld.digest(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == digests(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert ld.digest(empty).count() == 0 and ld.bitmaps(empty).count() == 0 and ld.apply(empty).columns == ["doc_id", "text"]


def test_one_range_exchange_and_no_python(spark):
    docs = spark.createDataFrame(sample(), SCHEMA)
    measured, total = ld.measure(docs)
    lines = measured.selectExpr("row_id", "doc_id", "inline(lines)")
    ranged = ld._sliced(lines, total).repartitionByRange("h1", "h2", "slice")
    text = ld.with_first(ranged)._jdf.queryExecution().executedPlan().toString()
    assert text.count("rangepartitioning") == 1 and "hashpartitioning(h1" not in text
    assert "Python" not in text and "Python" not in ld.digest(docs)._jdf.queryExecution().executedPlan().toString()
