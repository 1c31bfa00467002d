"""Sharding against a brute-force minimax partition, and its edge cases."""

import random
import zlib
from itertools import accumulate

import pytest

from occurlens.llm import sharding


def brute(sizes, shards):
    def count(cap):
        n, room = 0, 0
        for s in sizes:
            if s > room:
                n, room = n + 1, cap
            room -= s
        return n
    cap = max(max(sizes), -(-sum(sizes) // shards))
    while count(cap) > shards:
        cap += 1
    return cap


@pytest.mark.parametrize("seed,n,shards,cells", [(1, 3000, 5, 1), (2, 9000, 24, 1), (3, 50, 24, 8), (4, 1, 3, 4), (5, 3000, 3, 1)])
def test_smallest_capacity_with_coarse_passes(spark, seed, n, shards, cells):
    rng = random.Random(seed)
    sizes = [8 + int(rng.paretovariate(1.1) * 20) for _ in range(n)]
    ends = list(accumulate(sizes))
    groups = spark.createDataFrame(list(zip(sizes, ends)), "size long, cum_size long").repartition(3).cache()
    cuts = sharding.find_cuts(groups, shards, cells)
    cap = brute(sizes, shards)
    assert cuts == sharding.cuts_of(ends, cap, shards, ends[-1])
    groups.unpersist()


def test_assignment_laws(spark):
    rng = random.Random(0)
    texts = [None, "", "é" * 5] + ["".join(rng.choice("ab \n") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    rows = [(i, rng.choice(texts), "x") for i in range(900)] + [(None, "é" * 5, "x"), (7, "same", "x"), (7, "same", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string")
    out = sharding.assign(docs, 6, cells=16).collect()
    assert len(out) == len(rows)
    sizes = sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in out)
    want = sorted((i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sizes == want
    for s in range(6):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    shard_of = {}
    for r in out:
        if r.size > 8:
            assert shard_of.setdefault(r.text_crc32, r.shard) == r.shard


def test_empty_and_native(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.table(empty).count() == 0
    one = sharding.table(spark.createDataFrame([(5, None)], "doc_id long, text string")).first()
    assert (one.size, one.shard, one.slot, one.law, one.grown_shard, one.text_crc32) == (8, 0, 0, "bytes", None, 0)
