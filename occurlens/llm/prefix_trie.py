"""Prefix trie of conversations: one row per distinct sequence of first turns.

Method: a burst trie. Conversations become sequences of turn ids and start in one container
under the root. Every round, containers with more than ``capacity`` turns in them (and with
more than one sequence) burst: the turns that all their members share are skipped, and the
members go to the container of their next turn id, whose trie head is the sequence so far; those
that end there stay as the head's own. What is left are small containers of suffixes under
trie heads: dealt by head, sorted by suffix and swept into nodes in one pass each. Burst
heads get their subtree sums from the containers and heads below them.

Scale: texts are read once; a turn travels as 20 bytes (128 bits of its role and text, and its
word count). Conversations of one sequence are packed into rows of ids from one range of
``2 ** ID_BITS``, so a group of copies holds few rows; these are aggregated map-side, and
their digest streams over them in order (a SHA-256 of one list is sequential: the ids of one
sequence, not its texts, pass through one task). Bursting divides every other hot prefix, and
needs as many rounds as containers fork while oversized, not as sequences have turns. A sweep
holds the open path and, per open node, its finished children: at most ``capacity`` nodes.

Defined cases: null role and text are empty; null turns come first; turns that tie in one
conversation are put in order of their content's hash, so the result does not depend on the
input order; repeated rows are turns of their own; rows without a conv_id are left out; an
empty table has no node; extra columns are ignored. One conversation's turn ids (20 bytes
a turn) are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, written

TURN = 20            # bytes of a turn: 16 of its hash, 4 of its word count
ID_BITS = 12         # conversations of one sequence are packed by ranges of 2 ** ID_BITS ids
CAPACITY = 1 << 16   # turns a container may hold
FAMILY = 20          # conversations that share a base, in the rebuilding rule
EMPTY = hashlib.sha256(b"").hexdigest()
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
STATE = ["head", "ends", "up", "path", "depth", "head_words", "suffix", "bucket", "ids"]


def _bytes(column: str, start: Column | int, length: Column | int) -> Column:
    return F.substring(F.col(column), F.lit(start) if isinstance(start, int) else start,
                       F.lit(length) if isinstance(length, int) else length)


def _no_bytes() -> Column:
    return F.unhex(F.lit(""))


def sequences(convs: DataFrame) -> DataFrame:
    """(conv_id, seq): the turns of every conversation, in order, ``TURN`` bytes each."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")), 8, "0")
    turns = convs.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                         F.concat(F.substring(content, 1, 32), words).alias("code")).filter("conv_id is not null")
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "code"))).alias("t"))
    return listed.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: x["code"]), "")).alias("seq"))


def rebuild(seqs: DataFrame) -> DataFrame:
    """Every conversation c: the first h turns of conversation c - c % 20, then its own after
    its first h; h = crc32(c) % 4. A base is met by at most 39 conversations."""
    base = seqs.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base_id"), _bytes("seq", 1, 3 * TURN).alias("start"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 4 * TURN).cast("int")
    met = seqs.withColumn("h", h).join(base, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("base_id"), "left")
    return met.select("conv_id", F.concat(F.coalesce(_bytes("start", 1, F.col("h")), _no_bytes()),
                                          _bytes("seq", F.col("h") + 1, F.length("seq"))).alias("seq"))


def _start(seqs: DataFrame) -> DataFrame:
    """All sequences, in one container under the root; ids of equal sequences packed."""
    packed = seqs.groupBy("seq", F.shiftright("conv_id", ID_BITS).alias("bucket")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    none = F.lit(None).cast("binary")
    return packed.select(_no_bytes().alias("head"), F.lit(False).alias("ends"), none.alias("up"),
                         F.array().cast("array<binary>").alias("path"), F.lit(0).alias("depth"),
                         F.lit(0).cast("long").alias("head_words"), F.col("seq").alias("suffix"), "bucket", "ids")


def _word_count(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, 17, 4)), 16, 10).cast("long")


def _turns_of(column: str) -> Column:
    """The turns of a byte column as an array."""
    n = (F.length(column) / TURN).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col(column), i * TURN + 1, F.lit(TURN)))
                  ).otherwise(F.array().cast("array<binary>"))


def _oversized(state: DataFrame, capacity: int) -> DataFrame:
    """Containers to burst: head, its place, members, and the ``chain`` of turns all share."""
    sizes = state.groupBy("head").agg(
        F.sum(F.length("suffix") / TURN + 1).alias("turns"), F.min("suffix").alias("lo"), F.max("suffix").alias("hi"),
        F.sum(F.size("ids")).alias("n_convs"), F.min(F.col("ids")[0]).alias("conv_id"),
        F.first("up").alias("up"), F.first("path").alias("path"), F.first("depth").alias("depth"),
        F.first("head_words").alias("head_words")).filter((F.col("turns") > capacity) & (F.col("lo") != F.col("hi")))
    same = F.arrays_zip(_turns_of("lo").alias("a"), F.slice(_turns_of("hi"), F.lit(1), F.greatest(F.lit(1), F.size(_turns_of("lo")))).alias("b"))
    differ = F.array_position(F.transform(same, lambda p: F.coalesce(p["a"] == p["b"], F.lit(False))), False)
    common = F.when(differ > 0, differ - 1).otherwise((F.length("lo") / TURN).cast("long"))
    return sizes.withColumn("skip", (common * TURN).cast("int")).select(
        "head", "up", "path", "depth", "head_words", "n_convs", "conv_id", "skip", _bytes("lo", 1, F.col("skip")).alias("chain"))


def _burst(state: DataFrame, over: DataFrame) -> DataFrame:
    """One round: members of oversized containers move to the containers of their next turn."""
    o = over.select(F.col("head").alias("o_head"), "skip", "chain")
    rest = F.expr("substring(suffix, skip + 1)")
    met = state.join(o, F.col("head") == F.col("o_head"), "left").withColumn("rest", rest)
    moved = F.col("o_head").isNotNull()
    ends = F.length("rest") == 0
    deeper = F.substring(F.unhex(F.sha2(F.concat("head", "chain", _bytes("rest", 1, TURN)), 256)), 1, 16)
    turns = (F.col("skip") / TURN).cast("int")
    new = {
        "head": F.when(ends, F.col("head")).otherwise(deeper), "ends": ends, "up": F.col("head"),
        "path": F.concat("path", F.array("head")), "depth": F.col("depth") + turns + F.when(ends, 0).otherwise(1),
        "head_words": F.when(ends, 0).otherwise(_word_count(_bytes("rest", 1, TURN))),
        "suffix": F.when(ends, _no_bytes()).otherwise(F.expr(f"substring(rest, {TURN + 1})"))}
    return met.select(*[F.when(moved, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in STATE],
                      (moved & ~ends).alias("open"))


class _Node:
    __slots__ = ("words", "n", "least", "children", "leaves", "saved", "digest", "done")

    def __init__(self, words: int):
        self.words, self.n, self.least, self.children, self.leaves, self.saved = words, 0, None, 0, 0, 0
        self.digest, self.done = None, []

    def add(self, ids: list[int]) -> None:
        text = ",".join(map(str, ids)).encode()
        if self.digest is None:
            self.digest = hashlib.sha256(text)
        else:
            self.digest.update(b"," + text)
        self.n += len(ids)
        self.least = ids[0] if self.least is None else min(self.least, ids[0])


class _Sweep:
    """Nodes of sorted containers; finished rows collect in ``rows``."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.key = self.up = self.depth = None
        self.path: list[bytes] = []
        self.stack: list[_Node] = []

    def _close(self) -> tuple:
        """Finish the deepest open node; its children's parent is known now."""
        x = self.stack.pop()
        depth = self.depth + len(self.stack)
        x.saved += (x.n - 1) * x.words
        x.leaves = x.leaves or 1
        self.rows += [(0, None, conv, d, x.least, *more) for conv, d, *more in x.done]
        record = (x.least, depth, x.n, x.children, x.leaves, x.saved, x.digest.hexdigest() if x.digest else EMPTY)
        if self.stack:
            p = self.stack[-1]
            p.n, p.leaves, p.saved, p.children = p.n + x.n, p.leaves + x.leaves, p.saved + x.saved, p.children + 1
            p.least = x.least if p.least is None else min(p.least, x.least)
            p.done.append(record)
        return record

    def finish(self) -> None:
        """Close the container; its head's parent is a burst head (or nothing: the root)."""
        while self.stack:
            conv, depth, *more = self._close()
            if not self.stack:
                kind = 2 if self.key[1] else 1 if self.up is not None else 0
                self.rows.append((kind, self.up, conv, depth, None, *more))

    def take(self, head: bytes, ends: bool, up: bytes | None, depth: int, words: int, suffix: bytes, ids: list[int]) -> None:
        if self.key != (head, ends):
            self.finish()
            self.key, self.up, self.depth, self.path, self.stack = (head, ends), up, depth, [], [_Node(words)]
        turns = [suffix[i:i + TURN] for i in range(0, len(suffix), TURN)]
        same = 0
        while same < min(len(turns), len(self.path)) and turns[same] == self.path[same]:
            same += 1
        while len(self.stack) > same + 1:
            self._close()
        self.path = turns
        self.stack += [_Node(int.from_bytes(t[16:], "big")) for t in turns[same:]]
        self.stack[-1].add(ids)


SWEPT = ("kind int, up binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string")
SWEPT_TYPES = pa.schema([("kind", pa.int32()), ("up", pa.binary()), *((c, pa.int64()) for c in OUT[:-1]), (OUT[-1], pa.string())])


def _swept(settled: DataFrame) -> DataFrame:
    """Rows of nodes (kind 0), heads under a burst head (1) and ends of a burst head (2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = _Sweep()

        def out() -> pa.RecordBatch:
            rows, sweep.rows = sweep.rows, []
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SWEPT_TYPES)], schema=SWEPT_TYPES)

        for batch in batches:
            columns = [batch.column(c) for c in ("head", "ends", "up", "depth", "head_words", "suffix", "ids")]
            for i in range(batch.num_rows):
                sweep.take(*[c[i].as_py() for c in columns])
                if len(sweep.rows) > 10000:
                    yield out()
        sweep.finish()
        yield out()

    bound_batches(settled.sparkSession)
    dealt = settled.select(*STATE).repartition("head", "ends").sortWithinPartitions("head", "ends", "suffix", "bucket")
    return dealt.drop("path", "bucket").mapInArrow(run, SWEPT)


def _upper(over: DataFrame, swept: DataFrame) -> DataFrame:
    """Nodes of the burst heads and of the turns their members share: subtree sums come from
    the containers and heads below, along each head's path of burst heads above it."""
    top = F.col("kind") == 1
    direct = swept.filter("kind > 0").groupBy("up").agg(
        F.count_if(top).alias("tops"), F.sum(F.when(top, F.col("n_leaves"))).alias("leaves"),
        F.sum(F.when(top, F.col("saved_tokens"))).alias("saved"), F.max(F.when(~top, F.col("ends_sha256"))).alias("ends"))
    heads = over.withColumn("costs", F.concat(F.array("head_words"), F.transform(_turns_of("chain"), _word_count)))
    heads = heads.join(direct.withColumnRenamed("up", "d_head"), F.col("head") == F.col("d_head"), "left")
    own = (F.col("n_convs") - 1) * F.aggregate("costs", F.lit(0).cast("long"), lambda a, x: a + x)
    below = heads.select(
        "head", F.explode(F.concat("path", F.array("head"))).alias("above"), "up", F.coalesce("leaves", F.lit(0)).alias("leaves"),
        (F.coalesce("saved", F.lit(0)) + F.when(F.col("above") == F.col("head"), 0).otherwise(own)).alias("saved"))
    sums = below.groupBy("above").agg(F.sum("leaves").alias("all_leaves"), F.sum("saved").alias("all_saved"),
                                      F.count_if(F.col("up") == F.col("above")).alias("heads"))
    parents = over.select(F.col("head").alias("p_head"), F.col("conv_id").alias("p_conv"))
    met = heads.join(sums, F.col("head") == F.col("above")).join(parents, F.col("up") == F.col("p_head"), "left")
    last = F.size("costs") - 1
    nodes = met.select("*", F.posexplode("costs").alias("j", "cost"), last.alias("last"))
    rest = F.aggregate(F.expr("slice(costs, j + 1, last - j + 1)"), F.lit(0).cast("long"), lambda a, x: a + x)
    bottom = F.col("j") == F.col("last")
    return nodes.select(
        "conv_id", (F.col("depth") + F.col("j")).cast("long").alias("depth"),
        F.when(F.col("j") == 0, F.col("p_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n_convs").cast("long").alias("n_convs"),
        F.when(bottom, F.coalesce("tops", F.lit(0)) + F.col("heads")).otherwise(1).cast("long").alias("n_children"),
        F.col("all_leaves").cast("long").alias("n_leaves"),
        (F.col("all_saved") + (F.col("n_convs") - 1) * rest).cast("long").alias("saved_tokens"),
        F.when(bottom, F.coalesce("ends", F.lit(EMPTY))).otherwise(F.lit(EMPTY)).alias("ends_sha256"))


def trie(seqs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The nodes of the trie of (conv_id, seq) rows, columns ``OUT``; conv_ids are distinct."""
    state = written(_start(seqs), "container")
    settled, bursts = [], []
    while True:
        over = written(_oversized(state, capacity), "burst")
        if over.isEmpty():
            break
        bursts.append(over)
        moved = written(_burst(state, over), "container")
        settled.append(moved.filter("not open").drop("open"))
        state = moved.filter("open").drop("open")
    for part in settled:
        state = state.unionByName(part)
    if not bursts:
        return _swept(state).select(*OUT)
    over = bursts[0]
    for part in bursts[1:]:
        over = over.unionByName(part)
    swept = written(_swept(state), "nodes")
    parents = over.select(F.col("head").alias("p_head"), F.col("conv_id").alias("p_conv"))
    tops = (swept.filter("kind = 1").join(parents, F.col("up") == F.col("p_head"), "left")
            .withColumn("parent_conv_id", F.col("p_conv")))
    return (swept.filter("kind = 0").select(*OUT).unionByName(tops.select(*OUT)).unionByName(_upper(over, swept).select(*OUT)))


def table(convs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The nodes of the rebuilt conversations."""
    return trie(rebuild(sequences(convs)), capacity)


# DuckDB: every prefix of every conversation, grouped; subtree sums over all ancestors.
ORACLE_SQL = r"""
with recursive
crc_table(i, k, c) as (
  select i, 0, i from (select unnest(range(256)) as i)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc_table where k < 8),
crc as (select list(c order by i) as tab from crc_table where k = 8),
turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
         sha256(cast(strlen(coalesce(role, '')) as varchar) || ':' || coalesce(role, '') || coalesce(text, '')) as k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
  from conversations where conv_id is not null),
own as (select conv_id, list({'k': k, 'w': words} order by i) as t from turns group by 1),
asked as (
  select conv_id, own.t as t, conv_id - conv_id % 20 as base_id,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(cast(conv_id as varchar))), '..'),
                                                           lambda b: ('0x' || b)::bigint)),
           lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1]))) % 4 as h
  from own, crc),
rebuilt as (
  select a.conv_id, list_concat(coalesce(list_slice(b.t, 1, h), []), list_slice(a.t, h + 1, len(a.t))) as t
  from asked a left join own b on b.conv_id = a.base_id),
prefixes as (
  select conv_id, d, len(t) as n, array_to_string(list_transform(list_slice(t, 1, d), lambda x: x.k), '') as key,
         case when d = 0 then 0 else t[d].w end as words
  from (select conv_id, t, unnest(range(0, len(t) + 1)) as d from rebuilt)),
nodes as (
  select key, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where d = n), '')) as ends_sha256
  from prefixes group by key, d),
kids as (select substr(key, 1, 64 * (d - 1)) as key, count(*) as n_children from nodes where d > 0 group by 1),
full_nodes as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join kids using (key)),
sums as (
  select substr(key, 1, 64 * a) as key, sum(cast(n_children = 0 as bigint)) as n_leaves, sum((n_convs - 1) * words) as saved_tokens
  from (select *, unnest(range(0, d + 1)) as a from full_nodes) group by 1)
select n.conv_id, cast(n.d as bigint) as depth, p.conv_id as parent_conv_id, cast(n.n_convs as bigint) as n_convs,
       cast(n.n_children as bigint) as n_children, cast(n_leaves as bigint) as n_leaves,
       cast(saved_tokens as bigint) as saved_tokens, n.ends_sha256
from full_nodes n join sums s on s.key = n.key
left join nodes p on n.d > 0 and p.d = n.d - 1 and p.key = substr(n.key, 1, 64 * (n.d - 1))
"""
