"""Quality rules: statistics and verdicts against a plain version, and edge cases."""

import random
import re
from collections import Counter, defaultdict

from occurlens.llm import quality_rules as qr

SCHEMA = "doc_id long, text string, source string"


def words(s):
    return re.findall(r"[^\x20\x09-\x0D]+", s)


def base(text):
    text = text or ""
    w = words(text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dups, len(hit)


def norm(line):
    return " ".join(re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(line))


def brute(rows, min_docs, max_share, max_removed):
    docs, hosts = defaultdict(set), defaultdict(set)
    for doc_id, text, host in rows:
        hosts[host].add(doc_id)
        for line in (text or "").split("\n"):
            if len(words(line)) >= qr.MIN_LINE_WORDS:
                docs[host, norm(line)].add(doc_id)
    first = {k: min((d for d in ids if d is not None), default=None) for k, ids in docs.items()
             if len(ids) > max(min_docs, max_share * len(hosts[k[0]]))}
    out = []
    for doc_id, text, host in rows:
        removed = sum(len(words(line)) for line in (text or "").split("\n")
                      if (host, norm(line)) in first and first[host, norm(line)] != doc_id)
        b = base(text)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        out.append((doc_id, *b, failed, not failed and removed <= max_removed * b[0], removed))
    return sorted(out, key=str)


def test_noise_against_brute_force(spark):
    rng = random.Random(8)
    pool = ["The Menu  here", "the menu here", "|#| <x>", "", "  ", "\tfooter é 漢", "a b c a b c a b c", "UNIQUE"]
    rows = []
    for i in range(160):
        lines = [rng.choice(pool) if rng.random() < 0.5 else " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 30)))
                 for _ in range(rng.randint(0, 9))]
        rows.append((None if i % 41 == 0 else i, "\n".join(lines), rng.choice(["h1", "h1", "h2", None])))
    rows += [rows[5], rows[6], (500, None, "h1"), (501, "", "h1"), (502, "x" * 70000 + " y\r\n" + "z " * 4000, "h2")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row_id", "'l' as lines").repartition(4)
    for share in (0.01, 0.2):  # 0.2 of a host's documents is more than 6
        got = qr.verdicts(docs, 6, share, 0.3)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 6, share, 0.3)


def test_limit_follows_the_size_of_the_host(spark):
    """The same 30 documents with a common line, in a small host and in one of 5,000 documents."""
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(h * 10000 + i, f"Read our other stories\n{body(h * 10000 + i)}", f"h{h}") for h in (0, 1) for i in range(30)]
    rows += [(20000 + i, body(i), "h1") for i in range(5000)]
    got = {r.doc_id: r.removed_words for r in qr.verdicts(spark.createDataFrame(rows, SCHEMA)).filter("doc_id < 20000").collect()}
    assert got == {i: 4 if 0 < i < 30 else 0 for i in (*range(30), *range(10000, 10030))}


def test_clean_removes_lines_and_depleted_documents(spark):
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    menu = "Home About Contact"
    rows = [(i, f"{menu}\n{body(i)}\n home  about CONTACT ", "h", 7) for i in range(30)]
    rows += [(100, "short text", "h", 10), (101, None, "h", None)]
    long_menu = "\n".join(" ".join(f"m{k}n{j}" for j in range(12)) for k in range(5))
    rows += [(200 + i, f"{long_menu}\nown{i}", "h", 1) for i in range(25)]
    docs = spark.createDataFrame(rows, SCHEMA + ", n_chars long")
    out = {r.doc_id: r for r in qr.clean(docs).collect()}
    assert set(out) == {*range(30), 200}  # the first document of the long menu stays whole
    assert out[0].text == rows[0][1] and out[0].n_chars == 7
    assert out[1].text == body(1) and out[1].n_chars == len(body(1)) and out[1].source == "h"
    assert qr.clean(docs.limit(0)).count() == 0 and qr.clean(docs).columns == docs.columns
