"""Minimax contiguous sharding of documents, copies kept together.

Atomic groups are equal texts, ordered by their first doc_id; a group's size is the sum
of its documents' sizes (UTF-8 bytes plus a fixed cost per row). The shard capacity is
the smallest one for which cutting greedily (fill a shard until the next group would
overflow it) needs at most the given number of shards; it is found by binary
search, every candidate being checked greedily, and the groups are cut there.

Scale: built-in DataFrame operations only. Prefix sums over the ordered groups are
computed by range partitions (a running sum inside each, plus the totals of those before
it). The greedy check never needs all groups: it works on at most ``CELLS`` group
ends at a time. A coarse pass takes the last group end of each of ``CELLS`` equal
cells, which bounds the capacity from both sides and every cut to a window; the next
pass refines only those windows, until all group ends inside them are known and the
search is exact. Slots are positions in a range-partitioned order that goes down to
the single row, so one huge group of copies is spread over many tasks.

Defined cases: a null text has no bytes (its rows form one group, apart from the empty
text; checksum 0); null doc_ids sort first; repeated rows are copies and get slots
of their own; with fewer groups than shards some shards stay empty; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import with_row_id, written

SHARDS = 24
ROW_BYTES = 8
CELLS = 1 << 15


def prefix_sums(df: DataFrame, order: list[str], sums: list[str]) -> DataFrame:
    """``df`` with ``cum_<col>``: the sum over all rows up to this one in the order."""
    keys = [F.asc_nulls_first(c) for c in order]
    placed = written(df.repartitionByRange(*keys).withColumn("pid", F.spark_partition_id()), "ordered")
    totals = placed.groupBy("pid").agg(*[F.sum(c).alias(f"t_{c}") for c in sums])  # one row per partition
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("pid", *[F.coalesce(F.sum(f"t_{c}").over(before), F.lit(0)).alias(f"o_{c}") for c in sums])
    inside = Window.partitionBy("pid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.select("*", *[F.sum(c).over(inside).alias(f"r_{c}") for c in sums])
    out = running.join(offsets, "pid")
    return out.select(*[F.col(c) for c in df.columns],
                      *[(F.col(f"r_{c}") + F.col(f"o_{c}")).cast("long").alias(f"cum_{c}") for c in sums])


def cuts_of(ends: list[int], capacity: int, shards: int, total: int) -> list[int] | None:
    """Greedy cuts on the given group ends; None if ``shards`` do not suffice."""
    cuts, at = [], 0
    while at < total:
        if len(cuts) == shards:
            return None
        i = bisect_right(ends, at + capacity) - 1
        if i < 0 or ends[i] <= at:
            return None
        at = ends[i]
        cuts.append(at)
    return cuts


def smallest_capacity(low: int, high: int, feasible) -> int:
    while low < high:
        mid = (low + high) // 2
        if feasible(mid):
            high = mid
        else:
            low = mid + 1
    return low


def _reach(spans: list[tuple[int, int]], x: int) -> int:
    """The furthest position at or before ``x`` where a group may end, given the first and
    last group end of each cell (inside a cell any position may be one)."""
    i = bisect_right(spans, (x, x)) - 1
    if i + 1 < len(spans) and spans[i + 1][0] <= x:
        i += 1
    return min(x, spans[i][1]) if i >= 0 else 0


def _might_do(spans: list[tuple[int, int]], capacity: int, shards: int, total: int) -> bool:
    at = 0
    for _ in range(shards):
        at = _reach(spans, at + capacity)
    return at >= total


def find_cuts(groups: DataFrame, shards: int, cells: int = CELLS) -> list[int]:
    """Cut positions (cumulative bytes) of the smallest feasible capacity. ``groups`` has
    ``size`` and ``cum_size``; about ``cells`` rows a pass reach the driver."""
    total, largest, count = groups.agg(F.max("cum_size"), F.max("size"), F.count(F.lit(1))).first()
    if not count:
        return []
    cells = max(cells, 4 * shards * shards)  # so that every pass narrows the windows
    low = max(largest, -(-total // shards))
    high = low + largest  # always enough: every full shard then holds more than total / shards
    windows = [(0, total)]
    while True:
        inside = F.lit(False)
        for a, b in windows:
            inside = inside | F.col("cum_size").between(a, b)
        rows = groups.filter(inside)
        width = max(1, -(-sum(b - a + 1 for a, b in windows) // cells))
        if width <= ROW_BYTES or rows.count() <= cells:
            width = 1  # at most ``cells`` group ends, or so dense that no two share a cell
        found = (rows.groupBy(F.floor(F.col("cum_size") / width))
                 .agg(F.min("cum_size").alias("first"), F.max("cum_size").alias("last")).collect())
        spans = sorted((r["first"], r["last"]) for r in found)
        ends = sorted({x for span in spans for x in span})
        high = smallest_capacity(low, high, lambda c: cuts_of(ends, c, shards, total) is not None)
        if width == 1:
            return cuts_of(ends, high, shards, total)
        low = smallest_capacity(low, high, lambda c: _might_do(spans, c, shards, total))
        # where each cut of any capacity in [low, high] can lie
        windows, a, b = [], 0, 0
        for _ in range(shards):
            a, b = ends[bisect_right(ends, a + low) - 1], _reach(spans, b + high)
            if windows and a <= windows[-1][1]:
                windows[-1] = windows[-1][0], max(b, windows[-1][1])
            else:
                windows.append((a, b))


def assign(docs: DataFrame, shards: int = SHARDS, text_col: str = "text", id_col: str = "doc_id",
           cells: int = CELLS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot per document."""
    text = F.col(f"`{text_col}`")
    rows = written(with_row_id(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.sha2(text, 256), F.lit("null")).alias("group"))), "rows")
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
    groups = written(prefix_sums(groups, ["first_id", "group"], ["size", "n"]), "groups")
    cuts = find_cuts(groups, shards, cells)
    shard = F.lit(0)
    for cut in cuts[:-1]:
        shard = shard + (F.col("cum_size") > cut).cast("int")
    placed = groups.withColumn("shard", shard)
    starts = placed.groupBy("shard").agg(F.min(F.col("cum_n") - F.col("n")).alias("base"))  # one row per shard
    placed = placed.join(starts, "shard").select("group", "first_id", "shard", "base")
    # Rows in group order, down to the single row, so that a huge group spreads over tasks.
    ordered = prefix_sums(rows.join(placed, "group").withColumn("one", F.lit(1)),
                          ["first_id", "group", "doc_id", "row_id"], ["one"])
    return ordered.select("doc_id", "size", "text_crc32", "shard", (F.col("cum_one") - 1 - F.col("base")).alias("slot"))


def table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The assignment with its law: shard bytes as equal as whole groups allow."""
    return assign(docs, shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                       F.lit(None).cast("int").alias("grown_shard"))


# DuckDB: CRC-32 by its byte table, then the same search as a recursive query, one greedy step a row.
ORACLE_SQL = """
with recursive crc_table(i, k, c) as (
  select i, 0, i from (select unnest(range(256)) as i)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc_table where k < 8),
crc as (select list(c order by i) as t from crc_table where k = 8),
rows_ as (
  select doc_id, text, strlen(coalesce(text, '')) + 8 as size,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                                           lambda b: ('0x' || b)::bigint)),
           lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))) as text_crc32
  from documents, crc),
groups_ as (
  select text, min(doc_id) as first_id, sum(size)::bigint as size, count(*) as n from rows_ group by text),
ordered as (
  select *, sum(size) over (order by first_id)::bigint as cum, (sum(n) over (order by first_id))::bigint - n as before from groups_),
facts as (select max(cum) as total, greatest(max(size), cast(ceil(max(cum) / 24.0) as bigint)) as low, max(size) as largest from ordered),
search(lo, hi, pos, used, cuts) as (
  select low, low + largest, 0::bigint, 0, []::bigint[] from facts
  union all
  select case when lo = hi then lo when reach < total and used = 23 then mid + 1 else lo end,
         case when lo < hi and reach = total then mid else hi end,
         case when lo < hi and (reach = total or used = 23) then 0 else reach end,
         case when lo < hi and (reach = total or used = 23) then 0 else used + 1 end,
         case when lo = hi then list_append(cuts, reach) else [] end
  from (select lo, hi, (lo + hi) // 2 as mid, used, cuts, total,
               (select max(cum) from ordered where cum <= pos + (lo + hi) // 2) as reach
        from search, facts where pos < total))
, cut as (select cuts as found from search where lo = hi and len(cuts) > 0 order by len(cuts) desc limit 1),
placed as (
  select text, first_id, before, len(list_filter(found, lambda c: c < cum)) as shard from ordered, cut)
select r.doc_id, r.size, r.text_crc32, 'bytes' as law, cast(p.shard as int) as shard,
       row_number() over (partition by p.shard order by p.first_id, r.doc_id) - 1 as slot, cast(null as int) as grown_shard
from rows_ r join placed p on r.text is not distinct from p.text
"""
