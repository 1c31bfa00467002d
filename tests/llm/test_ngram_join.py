"""N-gram join against brute force over all pairs, large groups and edge cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from occurlens.llm import components as components_module
from occurlens.llm import ngram_join
from occurlens.llm.components import components, with_lowest
from occurlens.llm.queries import QUERIES


def gram_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """doc_id -> (class_id, n_links) by comparing all pairs of n-gram sets."""
    by_set = {}
    for doc_id, text in rows:
        by_set.setdefault(gram_set(text), []).append(doc_id)
    reps = [s for s in by_set if s]
    links = {i: [] for i in range(len(reps))}
    for i in range(len(reps)):
        for j in range(i):
            common = len(reps[i] & reps[j])
            if common and common >= 0.8 * (len(reps[i]) + len(reps[j]) - common) - 1e-9:
                links[i].append(j)
                links[j].append(i)
    out = {d: (d, 0) for s, ds in by_set.items() if not s for d in ds}
    seen = set()
    for i in range(len(reps)):
        if i in seen:
            continue
        todo, group = [i], []
        seen.add(i)
        while todo:
            x = todo.pop()
            group.append(x)
            for y in links[x]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        first = min(d for x in group for d in by_set[reps[x]])
        out.update({d: (first, len(links[x])) for x in group for d in by_set[reps[x]]})
    return out


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(out)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.class_id, r.n_links) for r in QUERIES["op3_ngram_join"](spark, SF_SMALL).collect()}
    assert got == brute(rows)


def test_large_group_in_chunks_and_edges(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK_TEXTS", 20)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, edited(rng, base, 1 + i % 4)) for i in range(90)]
    rows += [(100 + i, " ".join(base)) for i in range(40)]
    rows += [(200 + i, edited(rng, [f"x{i}y{j}" for j in range(60)], 0)) for i in range(20)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one two"), (304, "ONE two"), (305, "one two three"), (306, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row_id", "'g' as grp").repartition(4)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.jaccard_join(docs).collect()}
    assert got == brute(rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    classes = {}
    for d, (c, _) in got.items():
        classes.setdefault(c, []).append(d)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(v) for v in classes.values())


def test_small_groups_of_long_texts_with_empty_chunks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK_GRAMS", 150)  # one to seven chunks a group, so many have no member
    rng = random.Random(6)
    rows = []
    for g in range(24):
        base = [f"g{g}w{i}" for i in range(200)]
        rows += [(10 * g + i, edited(rng, base, 1 + i % 3)) for i in range(2 + g % 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.jaccard_join(docs).collect()} == brute(rows)


def test_null_ids_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f")], "doc_id long, text string")
    assert [(r.class_id, r.n_links) for r in ngram_join.jaccard_join(docs).collect()] == [(5, 0)] * 3
    assert [r.doc_id for r in ngram_join.keep_one(docs).collect()] == [5]
    assert ngram_join.jaccard_join(docs.limit(0)).count() == 0


def test_components_of_a_path_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(500, 500)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 500: 500}


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_lowest_and_components_of_hot_centres(spark, monkeypatch, salts):
    """Two thirds of the rows name one node; minima and components are those of plain Python, whatever the salts."""
    monkeypatch.setattr(components_module, "SALTS", salts)
    rng = random.Random(salts)
    edges = [(7, rng.randrange(8, 1000)) for _ in range(600)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(150)]
    edges += [(50, 50), (2000, 2000), (3, 2001), (2001, 7)]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(4)
    values = {}
    for u, v in edges:
        values.setdefault(u, set()).add(v)
    got = sorted((r.u, r.v, r.m) for r in with_lowest(frame).collect())
    assert got == sorted((u, v, min(values[u])) for u, v in edges)
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            low = min(root[u], root[v])
            changed |= root[u] != low or root[v] != low
            root[u] = root[v] = low
    assert {r.node: r.root for r in components(frame).collect()} == root


def test_links_of_one_centre_are_dealt_over_tasks(spark):
    """20,000 rows of one node, 64 parts over eight tasks: no task gets over twice the mean."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = with_lowest(spark.range(20_000).selectExpr("id div 1000000 as u", "id as v"))
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("v").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


@pytest.mark.parametrize("threshold,recall", [(0.8, 0.9999), (0.9, 0.99), (0.8, 0.5)])
def test_bands_reach_the_recall(threshold, recall):
    bands, rows = ngram_join.choose_bands(threshold, recall)
    assert 1 - (1 - threshold ** rows) ** bands >= recall and bands * rows <= ngram_join.MAX_HASHES


def test_size_classes_lose_no_link(spark, monkeypatch):
    """Nested texts of 30 to 150 n-grams in one group of many chunks: two are linked exactly if
    the smaller has at least 0.8 of the larger's n-grams, ratios of exactly 0.8 included."""
    monkeypatch.setattr(ngram_join, "CHUNK_TEXTS", 4)
    words = [f"w{i}" for i in range(200)]
    sizes = range(30, 151)
    rows = [(n, " ".join(words[:n + ngram_join.N - 1])) for n in sizes]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {n: (30, sum(n != m and 5 * min(n, m) >= 4 * max(n, m) for m in sizes)) for n in sizes}
