"""PII: base spans against a plain brute-force version; model, redaction, edges."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from occurlens.llm import pii
from occurlens.llm.queries import QUERIES


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)]
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in rules for m in re.finditer(p, text) if ok(m.group())]


def check(rows, got):
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text in rows:
        want, r = base_spans(text or ""), by_id[doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (text, want, r.spans)
        assert r.spans.split(",")[:len(want)] == want or not want
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in pii.BASE_KINDS]


def test_query_base_spans_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(rows, QUERIES["op9_pii"](spark, SF_SMALL).collect())


def test_base_spans_on_noise(spark):
    rng = random.Random(5)
    alphabet = ["a", "b.c", "@", ".", "1", "23", "4539", " ", "-", "+", "(", ")", "é", "😀", "256", "0", "x@y.z", "\n", "_%"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (1002, "1 " * 5000), (1003, "a" * 30000 + "@" + "b" * 30000 + ".c"), (1004, "9" * 20000),
             (1005, "a@b.c_d@e.f g@h"), (1006, "1.2.3.4.5.6.7.8 00255.1.1.1 256.1.1.1"), (1007, "+" * 3000 + "1(((("),
             (1008, "é +1 (017) 555-7713, 4111 1111 1111 1111"), (1009, "a1b2" * 9000)]
    check(rows, pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_addresses_with_zero_parts(spark):
    values = ["10.0.0.1", "0.0.0.0", "00.1.2.000", "127.0.0.1", "8.8.8.0", "192.168.0.5", "000.000.00.0255",
              "0256.0.0.1", "10.0.0.300", "1.0.0.00256", "0" * 4000 + ".0.0." + "0" * 4000 + "7", "0" * 4000 + "256.0.0.0"]
    rows = [(i, f"from {v} on") for i, v in enumerate(values)]
    got = pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(rows, got)
    assert sum(r.n_ip for r in got) == 8
    redacted = pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert redacted[0].text == "from [IP] on"


def test_model_adds_secrets_and_redacts(spark):
    rng = random.Random(9)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(200)]
    rows = [(i, f'some text token = "{h}" more', 1, "x") for i, h in enumerate(hexes)]
    rows += [(900, f'here "{hexes[0]}" alone', 1, "x"), (901, "call é +1 (017) 555-7713 or a.b@c.example.com", 1, "x"),
             (902, "nothing here", 12, "x"), (903, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, kind string").repartition(4)
    found = {r.doc_id: r.spans for r in pii.digest(docs).collect()}
    assert all(found[i] == "secret:19:59" for i in range(200)), found[0]
    assert found[900] == "secret:6:46" and found[902] == "" and found[903] == ""
    out = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert out[0].text == 'some text token = "[SECRET]" more' and out[0].n_chars == len(out[0].text)
    assert out[901].text == "call é [PHONE] or [EMAIL]" and out[901].kind == "x"
    assert out[902].text == "nothing here" and out[902].n_chars == 12 and out[903].text is None


def test_model_adds_domestic_phones_and_spelt_addresses(spark):
    rng = random.Random(3)
    number = lambda: f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
    name = lambda: "".join(rng.choice("bdklmnrst") + rng.choice("aeiou") for _ in range(2))
    rows = [(i, f"please call {number()} today", 1) for i in range(150)]
    rows += [(200 + i, f"mail: {name()} (at) {name()} (dot) org today", 1) for i in range(150)]
    rows += [(400 + i, f"we met {name()} at {name()}. Then 233.{rng.randrange(100, 999)}.171 left", 1) for i in range(150)]
    rows += [(600 + i, f"reach +1 {number()} or {name()}@{name()}.org", 1) for i in range(60)]
    rows += [(900, "desk (555) 123-4567 here", 1), (901, "desk jo (at) site (dot) org here", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(4)
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out[900] == "desk [DIAL] here" and out[901] == "desk [ADDRESS] here"
    assert all(out[i] == "please call [DIAL] today" and out[200 + i] == "mail: [ADDRESS] today" for i in range(150))
    assert all(out[i] == text for i, text, _ in rows if 400 <= i < 550)
    assert all(out[600 + i] == "reach [PHONE] or [EMAIL]" for i in range(60))


def test_long_prefix_sums(spark):
    text = "ab 1.2.3.4 " * 1000
    row = pii.digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_ip == 1000 and row.spans.split(",")[-1] == f"ip:{999 * 11 + 3}:{999 * 11 + 10}"


def test_empty_table_and_plan(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.digest(empty).count() == 0
    plan = pii.find(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("points,want", [([(1, 1, 2), (2, 0, 2), (3, 3, 3)], [0.25, 1.0]), ([], [])])
def test_isotonic(points, want):
    assert [p for _, p, _ in pii.isotonic(points)] == want


def test_generators_have_no_length_limits(spark):
    late = "abcdefghij" * 9 + "7" + "k" * 30         # its digit comes after 90 letters
    mixed = "".join(chr(65 + i % 26) + chr(97 + i * 7 % 26) for i in range(20))  # no digit at all
    hosts = ["2001:db8::1", "::ffff:0:1", "fe80::1ff:fe23:4567:890a", "2001:0db8:0000:0000:0000:ff00:0042:8329", "1:2:3:4"]
    not_hosts = ["dead::beef", "std::vector", "12:30:45", "1::2::3", "::", "a:b"]
    local = "x" * 100 + "@" + "y" * 80 + "." + "z" * 30
    rows = [(1, f"token = {late} and {mixed} end"), (2, " ".join(["at", *hosts, *not_hosts, "end"])), (3, f"write {local} now"),
            (4, "Verfassungsgerichtshof donaudampfschifffahrt")]
    cands = {r.doc.doc_id: r.cands for r in pii.propose(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    found = {d: {(pii.ADDED_KINDS[c.kind], text[d][c.start:c.end]) for c in cs} for d, cs in cands.items()}
    assert found[1] == {("secret", late), ("secret", mixed)} and found[4] == set()
    assert {x for k, x in found[2] if k == "host"} == set(hosts) and ("address", local) in found[3]


def test_addresses_with_blanks_around_the_sign_have_negatives(spark):
    rng = random.Random(4)
    name = lambda: "".join(rng.choice("bdklmnrst") + rng.choice("aeiou") for _ in range(2))
    rows = [(i, f"we met @ {name()}. Then {name()} @ {name()}. Again", 1) for i in range(120)]
    rows += [(200 + i, f"see {name()}@{name()}.org now", 1) for i in range(120)]
    out = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()}
    assert all(out[i] == t for i, t, _ in rows if i < 200) and all(out[200 + i] == "see [EMAIL] now" for i in range(120))


def test_boosting_against_brute_force():
    """Every split of the first tree is the best of all by its plain definition; later trees lower the loss."""
    rng = random.Random(8)
    cells = [{f: rng.randrange(b) for f, b in pii.FEATURES.items()} | {"n": rng.randint(1, 30)} for _ in range(60)]
    for c in cells:
        c["pos"] = sum(rng.random() < (0.9 if c["digit_bin"] > 2 and c["mixed"] == 2 else 0.1) for _ in range(c["n"]))
    grad, hess = [c["n"] * 0.5 - c["pos"] for c in cells], [c["n"] * 0.25 for c in cells]

    def part(at):
        g, h = sum(grad[i] for i in at), sum(hess[i] for i in at)
        return g * g / (h + pii.LAMBDA)

    def best(at):
        return max((part([i for i in at if cells[i][f] <= b]) + part([i for i in at if cells[i][f] > b]) - part(at), f, b)
                   for f, n in pii.FEATURES.items() for b in range(n - 1))

    trees = pii.boost(cells)
    name, bound, low, high = trees[0]
    everything = list(range(60))
    assert pii._best_split(cells, grad, hess, everything)[0] == pytest.approx(best(everything)[0])
    sides = [i for i in everything if cells[i][name] <= bound], [i for i in everything if cells[i][name] > bound]
    for at, (f, b, left, right) in zip(sides, (low, high)):
        inner = [i for i in at if cells[i][f] <= b], [i for i in at if cells[i][f] > b]
        assert part(inner[0]) + part(inner[1]) - part(at) == pytest.approx(best(at)[0])
        for leaf, ids in zip((left, right), inner):
            assert leaf == pytest.approx(-pii.RATE * sum(grad[i] for i in ids) / (sum(hess[i] for i in ids) + pii.LAMBDA))

    def loss(n):
        m = [sum(pii.tree_value(t, c) for t in trees[:n]) for c in cells]
        return sum(c["n"] * math.log(1 + math.exp(x)) - c["pos"] * x for c, x in zip(cells, m))

    losses = [loss(n) for n in range(len(trees) + 1)]
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:])) and losses[-1] < 0.7 * losses[0]
