"""Personal data: candidate spans scored by gradient-boosted trees, natively.

Generators propose spans by pattern, with high recall and overlaps: addresses,
dotted and colon-separated host numbers, long numbers, phone-like digit groups and
opaque tokens. Four *base* kinds are fixed patterns with checks (email, ip, card,
phone); what passes is always kept. Every candidate becomes a cell of small binned
format and context features. Cells are counted over all documents (a grouped sum
whose row count is bounded by the product of the bins), boosted trees of depth 2 are
fitted to them with weak labels (the base checks; an assignment to a secret-like name
for opaque tokens; a contact word before phone numbers without + and addresses spelt
with at and dot, which no base check keeps; addresses with @ are true where they are written
without blanks or follow a contact word; all eight groups, or three of a shortened one, for host
numbers; none of these is a feature), margins are calibrated by isotonic
regression on held-out cells, and candidates whose calibrated probability reaches
``MIN_PRECISION`` are added.

Everything that touches text is built-in expressions: positions come from the pieces
and matches of one pattern (``split`` and ``regexp_extract_all``) by a two-level prefix
sum, patterns use possessive loops and start only where a run starts, so neither
the stack nor the time of a match grows beyond the text's length. The trees
become a CASE expression. Only the bounded cell counts reach the driver.

Spans are code points, end exclusive. Defined cases: null and empty texts have no
spans (a null text stays null when redacting); repeated rows get the same spans;
without candidates, or with one class only, nothing is added; a kind of which fewer than
``MIN_HELD_OUT`` held-out candidates support a threshold adds nothing (a precision cannot be
vouched for from fewer), so very small tables get base spans only; empty tables give empty
results. Tokens of lower-case letters alone, and of one capital and lower-case letters, are not proposed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_row_id, written

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["address", "host", "number", "dial", "secret", "dial", "address"]  # by code; the last two without + and @
ROUNDS, RATE, LAMBDA = 30, 0.4, 1.0
MIN_PRECISION = 0.9
MIN_HELD_OUT = 5         # held-out candidates that must back a threshold
PREFIX_CHUNK = 128

# The base patterns. Possessive loops and start conditions give the same
# leftmost matches as their plain forms (see the tests) without backtracking.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # generators beyond the base patterns
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]++"
               r"\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[A-Za-z]{2,}+",
    "host": r"(?<![0-9A-Za-z:])[0-9A-Fa-f:]++(?<=[0-9A-Fa-f]|::)(?![0-9A-Za-z])",
    "dial": r"(?<![0-9+])\(?[0-9]{2,4}+\)?[\x20.-][0-9]{3,4}+[\x20.-][0-9]{3,4}+(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+",
}
# What a run must be to be proposed: a host number of 4 to 8 groups, or one with a run of zeros
# left out (::) and a digit; a token with a digit or with a capital after another letter or mark.
HOST_FULL = r"^[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){3,7}$"
HOST_SHORT = r"^(?=.*[0-9])(?!.*::.*::)(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?$"
TOKEN = r"[0-9]|[a-z+/_=-][A-Z]"
PLAIN_ADDRESS = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\."
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_VALID = rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"
SECRET_NAME = r"(?i)(?:token|secret|passw(?:or)?d|passwd|pwd|credential|(?:api|access|private|auth)[_ -]?key)[\"']?\x20?[:=]\x20?[\"']?$"
PHONE_WORD = r"(?i)(?<!\p{L})(?:(?:tele)?phone|tel|call|dial|fax|mobile|cell)(?:\x20(?:me|us|no|number|at|on))?[^\p{L}0-9]{0,4}$"
MAIL_WORD = r"(?i)(?<!\p{L})(?:(?:e-?)?mail|contact|write)(?:\x20(?:me|us|address|at|to))?[^\p{L}0-9]{0,4}$"
IN_PHONE = r"\+[0-9][\x20().0-9-]*$"  # what stands before is the start of a number with +
CONTEXT = r"(?i)(?:mail|phone|tel|call|fax|contact|card|account|ip|host|server|address)[^A-Za-z]{0,4}$"

#: feature -> number of bins; the cells are bounded by their product
FEATURES = {"kind": 7, "len_bin": 6, "digit_bin": 5, "mixed": 3, "seps": 3, "marks": 2, "context": 2, "left": 3, "right": 3}
MAX_CELLS = math.prod(FEATURES.values()) * 4  # x label x fold


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _found(df: DataFrame, kind: str, guard: Column) -> DataFrame:
    """Columns ``f_<kind>`` (matches), ``p_<kind>`` (text between them) and ``s_<kind>``
    (start of each match): projections in steps, each evaluated once per row."""
    f, p, s, n = (F.col(f"{x}_{kind}") for x in "fpsn")
    pattern, none = F.lit(PATTERNS[kind]), F.array().cast("array<string>")
    df = df.withColumn(f"f_{kind}", F.when(guard, F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(none))
    df = df.withColumn(f"p_{kind}", F.when(F.size(f) > 0, F.split("text", PATTERNS[kind], -1)).otherwise(none))
    df = df.withColumn(f"n_{kind}", F.transform(f, lambda x, i: F.length(x) + F.length(F.element_at(p, i + 1))))
    chunks = F.when(F.size(n) > 0, F.sequence(F.lit(0), F.floor((F.size(n) - 1) / PREFIX_CHUNK).cast("int")))
    add = lambda a, b: a + b
    total = lambda a: F.aggregate(a, F.lit(0), add)
    df = df.withColumn(f"c_{kind}", F.transform(chunks, lambda c: total(F.slice(n, c * PREFIX_CHUNK + 1, PREFIX_CHUNK))))
    df = df.withColumn(f"b_{kind}", F.transform(F.col(f"c_{kind}"), lambda x, c: total(F.slice(F.col(f"c_{kind}"), 1, c))))
    start = lambda x, i: (
        F.element_at(F.col(f"b_{kind}"), F.floor(i / PREFIX_CHUNK).cast("int") + 1)
        + total(F.slice(n, i - i % PREFIX_CHUNK + 1, i % PREFIX_CHUNK)) + F.length(F.element_at(p, i + 1)))
    return df.withColumn(f"s_{kind}", F.transform(f, start)).drop(f"n_{kind}", f"c_{kind}", f"b_{kind}")


def _spans(kind: str, valid) -> Column:
    """Sorted array of (start, end) of the matches that pass ``valid``."""
    both = F.zip_with(f"f_{kind}", f"s_{kind}", lambda x, s: F.struct(
        s.cast("int").alias("start"), (s + F.length(x)).cast("int").alias("end"), valid(x).alias("ok")))
    return F.transform(F.filter(both, lambda e: e["ok"]), lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end")))


def _edge(c: Column) -> Column:
    """0: nothing or white space, 1: letter or digit, 2: other."""
    return F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike(r"[\p{L}0-9]"), 1).otherwise(2)


def _bin(x: Column, bounds: list[int]) -> Column:
    """How many of the bounds ``x`` reaches."""
    out = F.lit(0)
    for b in bounds:
        out = out + (x >= b).cast("int")
    return out


def _candidates(kind: str, code: int, proposes, label, context: bool = True) -> Column:
    """Array of candidate structs: span, features and weak label (null: not to learn from).
    ``context``: whether the words before are a feature (not where they are the label)."""
    def make(x: Column, i: Column) -> Column:
        before, after = F.element_at(F.col(f"p_{kind}"), i + 1), F.element_at(F.col(f"p_{kind}"), i + 2)
        left = F.right(before, F.lit(32))
        start = F.element_at(F.col(f"s_{kind}"), i + 1)
        digits, letters = F.length(_digits(x)), F.length(F.regexp_replace(x, "[^A-Za-z]", ""))
        size = F.length(x)
        return F.struct(
            F.lit(code).alias("kind"), start.cast("int").alias("start"), (start + size).cast("int").alias("end"),
            _bin(size, [10, 14, 18, 28, 48]).alias("len_bin"),
            F.floor(digits * 4 / size).cast("int").alias("digit_bin"),
            F.when(letters == 0, 0).when(digits == 0, 1).otherwise(2).alias("mixed"),
            _bin(size - digits - letters, [1, 3]).alias("seps"),
            x.rlike(r"[(\[]").cast("int").alias("marks"),
            (left.rlike(CONTEXT).cast("int") if context else F.lit(0)).alias("context"),
            _edge(F.right(left, F.lit(1))).alias("left"), _edge(F.left(after, F.lit(1))).alias("right"),
            label(x, left).cast("int").alias("label"), proposes(x).alias("ok"))
    return F.filter(F.transform(f"f_{kind}", make), lambda c: c["ok"])


def propose(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Written table: row_id, doc (the input row), fold, one span array per base kind and ``cands``."""
    df = with_row_id(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")))
    df = df.withColumn("text", F.coalesce(F.col(f"doc.`{text_col}`"), F.lit("")))
    df = df.withColumn("has_digit", F.col("text").rlike("[0-9]"))
    digit, at = F.col("has_digit"), F.col("text").contains("@")
    guards = {"email": at, "ip": digit, "card": digit, "phone": digit & F.col("text").contains("+"),
              "address": at | F.col("text").rlike(r"[\[(]at[\])]|\x20at\x20[A-Za-z0-9-]+\x20?(?:dot|[\[(.])"),
              "host": digit & F.col("text").contains(":"), "dial": digit,
              "secret": F.col("text").rlike("[A-Za-z0-9+/_=-]{16}")}
    for kind, guard in guards.items():
        df = _found(df, kind, guard)
    card_ok = lambda x: F.length(_digits(x)).between(13, 19) & F.call_function("luhn_check", _digits(x))
    phone_ok = lambda x: F.length(_digits(x)).between(9, 15)
    ip_ok = lambda x: x.rlike(IP_VALID)
    always = lambda x: F.lit(True)
    groups = lambda x: F.size(F.filter(F.split(x, ":"), lambda g: g != ""))
    df = df.select(
        "row_id", "doc", F.pmod(F.xxhash64("text"), F.lit(5)).cast("int").alias("fold"),
        _spans("email", always).alias("email"), _spans("ip", ip_ok).alias("ip"),
        _spans("card", card_ok).alias("card"), _spans("phone", phone_ok).alias("phone"),
        F.concat(
            _candidates("address", 0, lambda x: x.contains("@"),
                        lambda x, left: x.rlike(PLAIN_ADDRESS) | left.rlike(MAIL_WORD), context=False),
            _candidates("ip", 1, always, lambda x, left: ip_ok(x)),
            _candidates("host", 1, lambda x: x.rlike(HOST_FULL) | x.rlike(HOST_SHORT),
                        lambda x, left: F.when(x.rlike(HOST_SHORT), groups(x) >= 3).otherwise(groups(x) == 8)),
            _candidates("card", 2, lambda x: F.length(_digits(x)) >= 7, lambda x, left: card_ok(x)),
            _candidates("phone", 3, always, lambda x, left: phone_ok(x)),
            _candidates("secret", 4, lambda x: x.rlike(TOKEN), lambda x, left: left.rlike(SECRET_NAME) & x.rlike("[A-Za-z]")),
            _candidates("dial", 5, always, lambda x, left: F.when(~left.rlike(IN_PHONE), left.rlike(PHONE_WORD)), context=False),
            _candidates("address", 6, lambda x: ~x.contains("@"), lambda x, left: left.rlike(MAIL_WORD), context=False)).alias("cands"))
    return written(df, "pii")


Tree = tuple[str, int, tuple, tuple]  # (feature, bound, (feature, bound, low, high) on either side)


def _best_split(cells: list[dict], grad: list[float], hess: list[float], at: list[int]) -> tuple:
    """(gain, feature, bound): best split of the cells ``at`` into x <= bound and the rest."""
    total_g, total_h = sum(grad[i] for i in at), sum(hess[i] for i in at)
    best = (0.0, None, 0)
    for name, bins in FEATURES.items():
        g, h = [0.0] * bins, [0.0] * bins
        for i in at:
            g[cells[i][name]] += grad[i]
            h[cells[i][name]] += hess[i]
        lg = lh = 0.0
        for bound in range(bins - 1):
            lg, lh = lg + g[bound], lh + h[bound]
            gain = (lg * lg / (lh + LAMBDA) + (total_g - lg) ** 2 / (total_h - lh + LAMBDA) - total_g ** 2 / (total_h + LAMBDA))
            if gain > best[0] + 1e-9:
                best = (gain, name, bound)
    return best


def _leaf(grad: list[float], hess: list[float], at: list[int]) -> float:
    return -RATE * sum(grad[i] for i in at) / (sum(hess[i] for i in at) + LAMBDA)


def boost(cells: list[dict]) -> list:
    """Depth-2 trees for the log-odds of the label, fitted to counted cells
    (``n`` candidates, ``pos`` of them positive)."""
    margin, trees = [0.0] * len(cells), []
    for _ in range(ROUNDS):
        prob = [1 / (1 + math.exp(-m)) for m in margin]
        grad = [c["n"] * p - c["pos"] for c, p in zip(cells, prob)]
        hess = [max(c["n"] * p * (1 - p), 1e-9) for c, p in zip(cells, prob)]
        everything = list(range(len(cells)))
        gain, name, bound = _best_split(cells, grad, hess, everything)
        if name is None:
            break
        sides = []
        for part in ([i for i in everything if cells[i][name] <= bound], [i for i in everything if cells[i][name] > bound]):
            _, n2, b2 = _best_split(cells, grad, hess, part)
            if n2 is None:
                sides.append(("kind", FEATURES["kind"], _leaf(grad, hess, part), 0.0))
            else:
                low = [i for i in part if cells[i][n2] <= b2]
                high = [i for i in part if cells[i][n2] > b2]
                sides.append((n2, b2, _leaf(grad, hess, low), _leaf(grad, hess, high)))
        trees.append((name, bound, sides[0], sides[1]))
        margin = [m + tree_value(trees[-1], c) for m, c in zip(margin, cells)]
    return trees


def tree_value(tree: tuple, cell: dict) -> float:
    name, bound, low, high = tree
    n2, b2, a, b = low if cell[name] <= bound else high
    return a if cell[n2] <= b2 else b


def isotonic(points: list[tuple[float, float, float]]) -> list[tuple[float, float, float]]:
    """(lowest score, probability, weight) steps that rise with the score, from
    (score, positives, count) points, by pooling adjacent violators."""
    steps: list[list[float]] = []
    for score, pos, n in sorted(points):
        steps.append([score, pos, n])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            _, p, m = steps.pop()
            steps[-1][1] += p
            steps[-1][2] += m
    return [(s, p / n, n) for s, p, n in steps]


def fit(proposed: DataFrame, min_precision: float = MIN_PRECISION) -> tuple[list, list[float]]:
    """Trees and the margin each kind must reach (infinite where the held-out cells
    support none). Reads all candidates; at most ``MAX_CELLS`` counts reach the driver."""
    c = F.col("c")
    cells = (proposed.select("fold", F.explode("cands").alias("c")).filter(c["label"].isNotNull())
             .groupBy(*[c[name].alias(name) for name in FEATURES], (F.col("fold") == 0).alias("held"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(c["label"]).alias("pos")).collect())
    train = [r.asDict() for r in cells if not r["held"]]
    train.sort(key=lambda r: [r[name] for name in FEATURES])
    trees = boost(train)
    bounds = []
    for kind in range(FEATURES["kind"]):
        points: dict[float, list[float]] = {}
        for r in (r.asDict() for r in cells if r["held"] and r["kind"] == kind):
            p = points.setdefault(round(sum(tree_value(t, r) for t in trees), 9), [0.0, 0.0])
            p[0] += r["pos"]
            p[1] += r["n"]
        steps = isotonic([(s, p, n) for s, (p, n) in points.items()])
        good = [(s, n) for s, p, n in steps if p >= min_precision]
        bounds.append(good[0][0] - 1e-6 if sum(n for _, n in good) >= MIN_HELD_OUT else math.inf)
    return trees, bounds


def _margin(trees: list, c: Column) -> Column:
    leaf = lambda side: F.when(c[side[0]] <= side[1], F.lit(side[2])).otherwise(F.lit(side[3]))
    out = F.lit(0.0)
    for name, bound, low, high in trees:
        out = out + F.when(c[name] <= bound, leaf(low)).otherwise(leaf(high))
    return out


def select(proposed: DataFrame, trees: list, bounds: list[float]) -> DataFrame:
    """``proposed`` with ``base`` and ``spans``: arrays of (kind, start, end), base kinds
    first in their order, then the added kinds, each by start."""
    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    df = proposed.withColumn("base", F.concat(*[named(k) for k in BASE_KINDS]))
    def chosen(k: int) -> Column:
        passing = F.filter("cands", lambda c: (c["kind"] == k) & (_margin(trees, c) >= bounds[k]))
        free = F.filter(passing, lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
        return F.array_sort(F.transform(free, lambda c: F.struct(
            F.lit(ADDED_KINDS[k]).alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))

    usable = [k for k, b in enumerate(bounds) if trees and b < math.inf]
    added = [chosen(k) for k in usable]
    return df.withColumn("spans", F.concat("base", *added)).drop("cands")


def find(docs: DataFrame, text_col: str = "text", min_precision: float = MIN_PRECISION) -> DataFrame:
    """row_id, doc, one array per base kind, ``base`` and ``spans`` per row."""
    proposed = propose(docs, text_col)
    return select(proposed, *fit(proposed, min_precision))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts per base kind, base_sha256 and spans per document."""
    out = find(docs.select("doc_id", "text"))
    return out.select(F.col("doc.doc_id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
                      F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The input rows, every span replaced by ``[KIND]`` (overlapping spans by the
    first one's), the size column following the text."""
    found = find(docs, text_col)
    # Spans in order; each contributes only if it starts at or after the furthest end so far.
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    cut = F.aggregate(
        ordered, F.struct(F.lit(0).alias("far"), F.array().cast("array<struct<start:int,end:int,kind:string,from:int>>").alias("out")),
        lambda a, s: F.when(s["start"] < a["far"], F.struct(F.greatest(a["far"], s["end"]).alias("far"), a["out"].alias("out")))
        .otherwise(F.struct(s["end"].alias("far"), F.concat(a["out"], F.array(F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), a["far"].alias("from")))).alias("out"))))
    df = found.withColumn("cut", F.when(F.size("spans") > 0, cut))
    text = F.col(f"doc.`{text_col}`")
    parts = F.transform("cut.out", lambda s: F.concat(
        F.substring(text, s["from"] + 1, s["start"] - s["from"]), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    redacted = F.concat(F.array_join(parts, ""), F.substring(text, F.col("cut.far") + 1, F.length(text)))
    df = df.withColumn("redacted", F.when(F.size("spans") > 0, redacted).otherwise(text))
    new = {text_col: F.col("redacted")}
    if size_col in docs.columns:
        new[size_col] = F.when(F.size("spans") > 0, F.length("redacted").cast(docs.schema[size_col].dataType)) \
            .otherwise(F.col(f"doc.`{size_col}`"))
    return df.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
