"""Prefix trie: nodes against a plain version at several container sizes, bursts, edge cases."""

import hashlib
import random
import re
import zlib

import pytest

from occurlens.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn int, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    base = lambda c: c - (c % 20 if c >= 0 else -(-c % 20))
    seqs = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(base(c), [])[:h] + t[h:])
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    kids, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * (words(p[-1][1]) if p else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    sha([c for c in m if len(seqs[c]) == len(p)])) for p, m in nodes.items()), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select(*pt.OUT).collect()), key=str)


def sample(n=400, seed=2):
    """Copies, shared openings, chains that fork late, and short and long conversations."""
    rng = random.Random(seed)
    system = [("system", f"be  kind {i}") for i in range(2)]
    rows = []
    for c in range(n):
        kind = rng.randrange(5)
        if kind == 0:
            turns = system + [("user", "hello there"), ("assistant", "hi")]          # copies
        elif kind == 1:
            turns = system + [("user", "same opening")] * 12 + [("user", str(c % 7))]  # late forks
        else:
            turns = [(rng.choice(["user", "assistant", "a:b"]), f"t {rng.randrange(4)}\n" * rng.randint(0, 2)) for _ in range(rng.randint(1, 7))]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("capacity", [pt.CAPACITY, 500, 20])
def test_nodes_against_brute_force(spark, capacity):
    rows = sample() + [(-3, 0, "user", "negative"), (-3, 1, None, "id"), (-20, 0, "user", "base of -21"), (-21, 5, "user", "x"),
                       (7001, None, "user", "null turn first"), (7001, 0, "user", None), (7002, 1, None, None), (None, 0, "user", "no id"),
                       (7003, 0, "user", "a repeated row"), (7003, 0, "user", "a repeated row"),
                       (9003, 0, "user", "\x0b\x0c é\x85漢 \r\n"), (10**15 + 1, 0, "user", "w " * 70000)]
    convs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as seq", "'h' as head", "2 as depth").repartition(5)
    assert result(pt.table(convs, capacity)) == brute(rows)


def test_bursts_skip_shared_turns(spark):
    """A long common chain bursts in one round; copies of one sequence never burst."""
    chain = [("user", f"turn {i}") for i in range(60)]
    rows = [(20 * c, i, *t) for c in range(50) for i, t in enumerate([*chain, ("user", str(c % 3))])]
    convs = spark.createDataFrame(rows, SCHEMA)
    state = pt._start(pt.rebuild(pt.sequences(convs)))
    over = pt._oversized(state, 20).collect()
    assert len(over) == 1 and over[0].skip == 60 * pt.TURN and over[0].n_convs == 50
    moved = pt._burst(state, pt._oversized(state, 20))
    assert moved.select("head").distinct().count() == 3 and pt._oversized(moved, 20).count() == 0
    assert result(pt.table(convs, 20)) == brute(rows)
    assert result(pt.table(convs)) == brute(rows)


def test_group_of_copies_over_many_id_ranges(spark):
    rows = [(20 * c, 0, "user", "copied text") for c in range(9000)] + [(5, 0, "user", "copied text"), (5, 1, "user", "more")]
    convs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert pt._start(pt.rebuild(pt.sequences(convs))).count() < 60
    assert result(pt.table(convs, 30)) == brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    short = next(c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(short, 0, "user", "gone"), (100000, 0, "user", "stays")]
    got = result(pt.table(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows) and [r for r in got if r[1] == 0][0][3] == 2


def test_empty_table(spark):
    empty = pt.table(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == pt.OUT
