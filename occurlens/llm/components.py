"""Connected components of a link table, by alternating star contraction.

Every round is joins and map-side aggregated minima over the edge table, which
is written to the shared work folder after each round; no adjacency list,
component or label ever sits whole in a task or on the driver. The number of
rounds grows with the logarithm of the node count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import written


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edge table, written, with its count and order-free checksum (taken by the write)."""
    seen = Observation()
    table = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")), "edges")
    return table, (seen.get["n"], seen.get["x"])


SALTS = 64  # parts that the pairs of one node are dealt over (the bits of a long)


def with_lowest(pairs: DataFrame) -> DataFrame:
    """(u, v, m) for the rows (u, v): m is the smallest v of u. The rows of one u are dealt over SALTS
    parts by v and meet the minimum there, so a centre that a third of all rows link to is no
    hot task; a part is looked up only where it has rows, so the minima are never more than the rows."""
    dealt = pairs.select("u", "v", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int").alias("salt")).repartition("u", "salt")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("salt"))
    low = (dealt.groupBy("u", "salt").agg(F.min("v").alias("m"))
           .groupBy("u").agg(F.min("m").alias("m"), F.bit_or(bit).alias("parts")))
    has = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)),
                   lambda i: F.call_function("shiftright", F.col("parts"), i).bitwiseAND(1) == 1)
    low = low.select("u", "m", F.explode(has).alias("salt"))
    return dealt.join(low.hint("merge"), ["u", "salt"]).select("u", "v", "m")  # at every size where the rows were dealt


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns u, v); root
    is the smallest node of the component. Self links name single nodes."""
    given, _ = _stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    alone = given.filter("u = v").select(F.col("u").alias("node"))
    cur, seen = given.filter("u <> v"), None
    while True:
        both = cur.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
        both = both.select("e.u", "e.v")
        large = with_lowest(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = (with_lowest(large)
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        cur, now = _stored(small)
        if now == seen or not now[0]:
            break
        seen = now
    labels = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return (labels.unionByName(roots).unionByName(alone.withColumn("root", F.col("node")))
            .groupBy("node").agg(F.min("root").alias("root")))
