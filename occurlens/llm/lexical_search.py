"""Ranked lexical search of many items at once, over a graph of shared partial sums.

Every item (a text) is a bag of terms; its score of a document is a sum of integer term
impacts, one per term of the item, repeats included. Many items share terms, so the items are
evaluated together: term sets that several items share are mined, each becomes a node whose
document accumulator is the sum of two earlier ones and is computed once per document, and the
items combine the nodes that are left to them.

Method: terms of an item are ordered by the number of items that hold them, then by the set of
these items, so shared sets stand side by side; pairs of neighbours that occur twice or more
are replaced by a new node, round after round, until no pair repeats. Each round is one level
of the query-sharing graph. Sums are 64-bit integers, so the grouping never changes a score.

Scale: one pass over the texts keeps, per document, its number of terms and the counts of the
items' terms (a written table); document frequencies, N and L come from that table, and a
second pass over it evaluates the graph on blocks of documents, whose accumulators have a fixed
size. A task keeps the k best documents of each item; the k best of all follow from
those. Items are taken in blocks of about ``BLOCK_BYTES`` of text, one search per block, so
what the driver plans and the tasks receive is bounded whatever the number of items.

Defined cases: null text has no term; a document without terms is not counted; items without
terms, and items that no document matches, have no rows; equal rows (id and text) of the
items are one item, different texts under one id are items with ranks of their own; rows of
repeated documents are documents of their own; equal scores go by doc_id, null ids
last; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .common import ALNUM, Texts, Words, bound_batches, list_array, text_slices, written

TOP = 20
BLOCK_BYTES = 256 << 10     # item text planned and searched at a time
MATRIX_BYTES = 4 << 20      # accumulators of one block of documents
CANDIDATES = 1 << 18        # rows a task holds before it keeps the best of each item


class SharedSums:
    """The query-sharing graph of a block of items.

    ``vocabulary`` holds the sorted term hashes, node t < len(vocabulary) is a term. ``levels``
    are (first node, left operands, right operands); ``operands`` and ``starts`` list the nodes
    that each item (by place in ``ids``) sums up."""

    def __init__(self, ids: list, texts: list):
        words = Words(Texts(pa.array(texts, pa.large_string())), ALNUM)
        have = np.flatnonzero(words.counts)
        self.ids = [ids[i] for i in have]
        self.vocabulary, term = np.unique(words.hashes, return_inverse=True)
        bags = [list(term[words.first[i]:words.first[i + 1]]) for i in have]
        place = self._order(bags)
        bags = [sorted(bag, key=place.__getitem__) for bag in bags]
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.nodes = len(self.vocabulary)
        while self._share(bags):
            pass
        self.operands = np.array([n for bag in bags for n in bag], np.int64)
        self.starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])))[:-1].astype(np.int64)

    def _order(self, bags: list[list[int]]) -> np.ndarray:
        """Rank of every term: most items first, terms of the same items side by side."""
        holders: list[list[int]] = [[] for _ in self.vocabulary]
        for i, bag in enumerate(bags):
            for t in set(bag):
                holders[t].append(i)
        ranked = sorted(range(len(holders)), key=lambda t: (-len(holders[t]), holders[t], t))
        place = np.empty(len(ranked), np.int64)
        place[ranked] = np.arange(len(ranked))
        return place

    def _share(self, bags: list[list[int]]) -> bool:
        """One round: neighbours that occur twice or more become one node, left to right."""
        count: dict[tuple[int, int], int] = {}
        for bag in bags:
            for pair in zip(bag, bag[1:]):
                count[pair] = count.get(pair, 0) + 1
        node: dict[tuple[int, int], int] = {}
        for k, bag in enumerate(bags):
            out, i = [], 0
            while i < len(bag):
                here = count[bag[i], bag[i + 1]] if i + 1 < len(bag) else 1
                after = count[bag[i + 1], bag[i + 2]] if i + 2 < len(bag) else 1
                if here > 1 and here >= after:
                    out.append(node.setdefault((bag[i], bag[i + 1]), self.nodes + len(node)))
                    i += 2
                else:
                    out.append(bag[i])
                    i += 1
            bags[k] = out
        if node:
            left, right = np.array(list(node), np.int64).T
            self.levels.append((self.nodes, left, right))
            self.nodes += len(node)
        return bool(node)

    def scores(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores (items x documents) from the impacts of (term, document) pairs."""
        sums = np.zeros((self.nodes, n_docs), np.int64)
        sums[term, doc] = impact
        for first, left, right in self.levels:
            np.add(sums[left], sums[right], out=sums[first:first + len(left)])
        return np.add.reduceat(sums[self.operands], self.starts, axis=0)


def term_counts(docs: DataFrame, vocabulary: np.ndarray, text_col: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, int, int]:
    """(doc_id, n, terms, tfs) of every document with a term, written; N and L."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words = Words(Texts(part.column("text")), ALNUM)
            at = np.minimum(np.searchsorted(vocabulary, words.hashes), len(vocabulary) - 1)
            known = vocabulary[at] == words.hashes
            pair, tf = np.unique(words.doc[known] * len(vocabulary) + at[known], return_counts=True)
            per_doc = np.bincount(pair // len(vocabulary), minlength=part.num_rows)
            out = pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words.counts.astype(np.int64)),
                 list_array((pair % len(vocabulary)).astype(np.int32), per_doc), list_array(tf.astype(np.int64), per_doc)],
                names=["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(words.counts > 0))

    seen = Observation()
    counted = rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")
    table = written(counted.observe(seen, F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")), "terms")
    return table, int(seen.get["docs"]), int(seen.get["terms"])


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term: at most one row per term of the block reaches the driver."""
    df = np.zeros(size, np.int64)
    for row in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():
        df[row["t"]] = row["n"]
    return df


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 25 + 25 n N div L; Python integers where 64 bits would not hold the product."""
    if len(n) and 25 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 75 + 25 * n * n_docs // n_terms


def _best(found: tuple[np.ndarray, ...], top: int) -> tuple[np.ndarray, ...]:
    """The ``top`` rows of each item: highest score, then lowest id, null ids last."""
    item, score, doc, missing = found
    order = np.lexsort((doc, missing, -score, item))
    item = item[order]
    first = np.searchsorted(item, item)
    order = order[np.arange(len(item)) - first < top]
    return tuple(a[order] for a in found)


def _search_block(docs: DataFrame, ids: list, texts: list, id_type, top: int, text_col: str, id_col: str) -> DataFrame | None:
    graph = SharedSums(ids, texts)
    if not graph.ids:
        return None
    counted, n_docs, n_terms = term_counts(docs, graph.vocabulary, text_col, id_col)
    weight = weights(document_frequencies(counted, len(graph.vocabulary)), n_docs)
    step = max(1, MATRIX_BYTES // (8 * max(graph.nodes, len(graph.operands))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        held, rows, floor = [empty], 0, np.ones(len(graph.ids), np.int64)
        schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
        for batch in batches:
            n = batch.column("n").to_numpy()
            ids_of = batch.column("doc_id")
            missing = ids_of.is_null().to_numpy(zero_copy_only=False)
            doc_id = ids_of.fill_null(0).to_numpy()
            off = np.concatenate(([0], np.cumsum(batch.column("terms").value_lengths().to_numpy())))
            term = batch.column("terms").flatten().to_numpy()
            tf = batch.column("tfs").flatten().to_numpy()
            norm = np.repeat(length_norm(n, n_docs, n_terms), np.diff(off))
            impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * norm))
            for a in range(0, len(n), step):
                b = min(a + step, len(n))
                lo, hi = off[a], off[b]
                if lo == hi:
                    continue
                doc = np.repeat(np.arange(b - a), np.diff(off[a:b + 1]))
                score = graph.scores(term[lo:hi], doc, impact[lo:hi], b - a)
                item, at = np.nonzero(score >= floor[:, None])
                held.append((item, score[item, at], doc_id[a + at], missing[a + at]))
                rows += len(item)
                if rows > CANDIDATES:
                    held = [_best(tuple(map(np.concatenate, zip(*held))), top)]
                    rows = len(held[0][0])
                    full = np.bincount(held[0][0], minlength=len(floor)) == top
                    least = np.full(len(floor), np.iinfo(np.int64).max)
                    np.minimum.at(least, held[0][0], held[0][1])
                    floor = np.where(full, least, 1)
        item, score, doc, missing = _best(tuple(map(np.concatenate, zip(*held))), top)
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(doc, pa.int64(), mask=missing), pa.array(score)], schema=schema)

    spark = docs.sparkSession
    best = counted.mapInArrow(run, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(i, x) for i, x in enumerate(graph.ids)], f"item int, item_id {id_type.simpleString()}")
    # one row per item of the block: bounded by BLOCK_BYTES
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES,
           text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item, best first."""
    spark = docs.sparkSession
    items = items.select("item_id", "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    found = []
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        part = _search_block(docs, [r["item_id"] for r in rows], [r["text"] for r in rows],
                             items.schema["item_id"].dataType, top, text_col, id_col)
        if part is not None:
            found.append(part if blocks == 1 else written(part, "found"))
    if not found:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


# DuckDB: every (item, document) sum from the postings, nothing shared.
ORACLE_SQL = r"""
with docs as (
  select * from (
    select row_number() over () as r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents) where len(w) > 0),
totals as (select count(*) as n_docs, cast(sum(len(w)) as bigint) as n_terms from docs),
items as (select row_number() over () as i, item_id, text from (select distinct item_id, text from benchmark)),
asked as (
  select i, item_id, term, count(*) as times from (
    select i, item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from items) group by all),
postings as (
  select r, doc_id, n, term, count(*) as tf from (select r, doc_id, len(w) as n, unnest(w) as term from docs)
  where term in (select term from asked) group by all),
df as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint) as w
  from (select term, count(*) as df from postings group by 1), totals),
impacts as (
  select r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) as x
  from postings join df using (term), totals),
sums as (
  select i, item_id, r, doc_id, cast(sum(times * x) as bigint) as score
  from asked join impacts using (term) group by all having sum(times * x) > 0)
select item_id, cast(rank as int) as rank, doc_id, score from (
  select *, row_number() over (partition by i order by score desc, doc_id) as rank from sums) where rank <= 20
"""
