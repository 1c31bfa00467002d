"""Benchmark decontamination by winnowing.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lowering A-Z. A benchmark item's
windows are its runs of ``window`` words (an item of fewer words is one window of its
own length). Of the ``window - k + 1`` k-gram hashes inside each sliding window the
smallest is kept as a fingerprint (winnowing), on both sides: two texts that share
a run of ``window`` words share the fingerprint chosen there, so no shared span of
that length is missed. Fingerprints of documents are joined with those of the
benchmark; each hit is extended to the windows around it, which are compared whole
(64-bit hashes of all their words), and the words inside matching windows are
counted as a union. Items shorter than the window are fingerprinted by their full
length, for the lengths that occur (at most ``window - 1``).

Scale: documents are read once in a narrow pass. A Bloom filter of the benchmark
fingerprints of fixed size (``2 ** bloom_bits`` bits, broadcast) lets through all true
fingerprints and few others, so what is shuffled follows the hits, not the corpus;
with a benchmark of any size the joins behind it stay exact. Hot passages meet the
joins as rows of the large side, which skew splitting divides.

Defined cases: null and empty texts have no words (0 everywhere, not
contaminated); null item_id is left out of the listed ids but its windows count;
repeated items count once per id; empty tables on either side give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (ALNUM, MASK, WORD_SLICE_BYTES, Texts, Words, bound_batches, list_array, mix, signed, split_by, text_of, text_slices,
                     with_row_id, written)

WINDOW = 10
K = 5
BLOOM_BITS = 24


def _short_key(grams: np.ndarray, size: int) -> np.ndarray:
    return mix(grams + np.uint64(size * 0xA24BAED4963EE407 & MASK))


def winnow(words: Words, window: int, k: int) -> np.ndarray:
    """First words of the k-grams that are the minimum of some window (the
    rightmost one among equals)."""
    at, grams = words.grams(k)
    span = window - k + 1
    starts, _ = words.grams(window)
    if not len(starts):
        return np.zeros(0, np.int64)
    index = np.searchsorted(at, starts)
    best = index + span - 1
    low = grams[best]
    for j in range(span - 2, -1, -1):
        less = grams[index + j] < low
        best = np.where(less, index + j, best)
        low = np.where(less, grams[index + j], low)
    return at[np.unique(best)]


def fingerprints(words: Words, window: int, k: int, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, hash, length) of the fingerprints; length is k for winnowed
    k-grams, and the item length for whole short items."""
    first = winnow(words, window, k)
    at, grams = words.grams(k)
    parts = [(first, grams[np.searchsorted(at, first)], np.zeros(len(first), np.int64))]
    for size in lengths:
        a, g = words.grams(size)
        parts.append((a, _short_key(g, size), np.full(len(a), size)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def item_tables(benchmark: DataFrame, window: int, k: int, text_col: str, id_col: str) -> DataFrame:
    """(item_id, kind, hash, size): windows ('w') and fingerprints ('f') of every item."""
    items = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words = Words(Texts(part.column("text")), ALNUM)
            doc, kind, value, size = [], [], [], []

            def add(at, h, name, length):
                doc.append(words.doc[at])
                value.append(h)
                kind.extend([name] * len(at))
                size.append(np.full(len(at), length))

            at, g = words.grams(window)
            add(at, g, "w", window)
            first = winnow(words, window, k)
            a, g = words.grams(k)
            add(first, g[np.searchsorted(a, first)], "f", 0)
            for length in range(1, window):
                a, g = words.grams(length)
                whole = words.counts[words.doc[a]] == length
                add(a[whole], g[whole], "w", length)
                add(a[whole], _short_key(g[whole], length), "f", length)
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id").take(pa.array(np.concatenate(doc))), pa.array(kind, pa.string()),
                 pa.array(signed(np.concatenate(value))), pa.array(np.concatenate(size).astype(np.int32))],
                names=["item_id", "kind", "hash", "size"])

    kind = items.schema["item_id"].dataType.simpleString()
    return written(items.mapInArrow(run, f"item_id {kind}, kind string, hash long, size int").distinct(), "items")


def bloom(prints: DataFrame, bits: int) -> np.ndarray:
    """Bloom filter words (2 ** bits bits, two probes per hash), built by a
    grouped bit-or; at most 2 ** (bits - 6) rows reach the driver."""
    probes = prints.select(F.explode(F.array("hash", F.shiftright("hash", 27))).alias("p"))
    word = F.shiftright("p", 6).bitwiseAND((1 << (bits - 6)) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63).cast("int"))
    rows = probes.groupBy(word.cast("int").alias("at")).agg(F.bit_or(bit).alias("bits")).collect()
    table = np.zeros(1 << (bits - 6), np.int64)
    for r in rows:
        table[r["at"]] = r["bits"]
    return table


def maybe(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter (all that are, few others)."""
    h = signed(hashes)
    ok = np.ones(len(h), bool)
    for p in (h, h >> 27):
        ok &= (table[(p >> 6) & (len(table) - 1)] >> (p & 63)) & 1 == 1
    return ok


def _candidates(words: Words, n: int, table: np.ndarray, window: int, k: int, lengths: list[int]) -> pa.ListArray:
    """Per text: fingerprints that pass the filter, each with the windows around it."""
    first, value, size = fingerprints(words, window, k, lengths)
    keep = maybe(table, value)
    first, value, size = first[keep], value[keep], size[keep]
    order = np.argsort(first, kind="stable")
    first, value, size = first[order], value[order], size[order]
    begin = words.first[words.doc[first]]
    hashes = {length: words.grams(length) for length in {window, *lengths}}
    spots, spans, wins, counts = [], [], [], []
    for f, s, b in zip(first.tolist(), size.tolist(), begin.tolist()):
        length = s or window
        at, g = hashes[length]
        lo, hi = (f, f + 1) if s else (max(b, f + k - window), f + 1)
        i, j = np.searchsorted(at, [lo, hi])
        spots.append(at[i:j] - b)
        wins.append(g[i:j])
        spans.append(np.full(j - i, length))
        counts.append(j - i)
    cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
    windows = pa.StructArray.from_arrays(
        [pa.array(cat(spots, np.int32)), pa.array(cat(spans, np.int32)), pa.array(signed(cat(wins, np.uint64)))],
        ["at", "size", "win"])
    structs = pa.StructArray.from_arrays(
        [pa.array(signed(value)), list_array(windows, np.array(counts, np.int64))], ["print", "wins"])
    return list_array(structs, np.bincount(words.doc[first], minlength=n))


def scan(docs: DataFrame, items: DataFrame, window: int, k: int, bloom_bits: int, text_col: str) -> DataFrame:
    """(row_id, doc, n_words, cands) per document, written as a table; ``doc``: its other columns."""
    spark = docs.sparkSession
    bound_batches(spark)
    lengths = sorted(r["size"] for r in items.filter((F.col("size") > 0) & (F.col("size") < window))
                     .select("size").distinct().collect())  # at most window - 1
    table = spark.sparkContext.broadcast(bloom(items.filter("kind = 'f'"), bloom_bits))
    rows = with_row_id(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")))
    keep = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, f"doc.{text_col}", WORD_SLICE_BYTES):
            texts = Texts(text_of(part, f"doc.{text_col}"))
            words = Words(texts, ALNUM)
            doc = pa.StructArray.from_arrays([text_of(part, f"doc.{c}") for c in keep], keep)
            yield pa.RecordBatch.from_arrays(
                [doc, part.column("row_id"), pa.array(words.counts.astype(np.int64)),
                 _candidates(words, texts.n, table.value, window, k, lengths)], names=["doc", "row_id", "n_words", "cands"])

    kept = ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in docs.schema if f.name in keep)
    return written(rows.mapInArrow(run, f"doc struct<{kept}>, row_id long, n_words long,"
                                        " cands array<struct<print:long,wins:array<struct<at:int,size:int,win:long>>>>"), "scan")


def hits(scanned: DataFrame, items: DataFrame) -> DataFrame:
    """(row_id, n_hit, n_items, item_ids) of the contaminated rows."""
    prints = items.filter("kind = 'f'").select("hash").distinct()
    windows = items.filter("kind = 'w'").select(F.col("hash").alias("win"), "size", "item_id")
    cands = scanned.select("row_id", F.explode("cands").alias("c")).select("row_id", "c.print", "c.wins")
    found = (cands.join(prints, F.col("print") == F.col("hash"), "left_semi")
             .select("row_id", F.explode("wins").alias("w")).select("row_id", "w.at", "w.size", "w.win").distinct())
    matched = written(found.join(windows, ["win", "size"]).select("row_id", "at", "size", "item_id"), "matched")
    # Union of the word ranges: ranges in order, each adds what lies beyond the furthest end so far.
    ranges = F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("size")).alias("end"))))
    union = F.aggregate(
        ranges, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("far")),
        lambda s, r: F.struct((s["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(r["at"], s["far"]))).alias("n"),
                              F.greatest(s["far"], r["end"]).alias("far")), lambda s: s["n"])
    spans = matched.groupBy("row_id").agg(union.alias("n_hit"))
    ids = matched.select("row_id", F.col("item_id").cast("string").alias("item_id")).distinct()
    ids = ids.groupBy("row_id").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    return spans.join(ids, "row_id")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, bloom_bits: int = BLOOM_BITS,
                  text_col: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Scanned rows (doc.<id>) with n_words, n_hit, item_ids and contaminated."""
    items = item_tables(benchmark, window, k, item_text, item_id)
    scanned = scan(docs.select(id_col, text_col), items, window, k, bloom_bits, text_col)
    return (scanned.drop("cands").join(hits(scanned, items), "row_id", "left")
            .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
            .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
            .withColumn("contaminated", F.col("n_hit") > 0))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per document."""
    out = contamination(docs, benchmark)
    return out.select(F.col("doc.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The input rows without a hit. Contamination depends on the text alone, so the scan is keyed
    by two hashes of the text; the texts are read a second time, and only those that may be
    contaminated are shuffled."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.concat_ws(":", F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit("second"), text)))
    found = contamination(docs.select(key.alias("key"), F.col(f"`{text_col}`").alias("text")), benchmark, id_col="key", **options)
    gone = written(found.filter("contaminated").select(F.col("doc.key").alias("key")).distinct(), "contaminated")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key.alias("key"))
    apart, maybe = split_by(rows, gone, ["key"])
    kept = apart.unionByName(maybe.join(gone.hint("merge"), "key", "left_anti"))
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


# DuckDB: windows compared as word lists.
ORACLE_SQL = r"""
with doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
item_windows as (
  select distinct item_id, least(len(w), 10) as size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as i from item_words where len(w) > 0)),
doc_windows as (
  select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as win
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
        from doc_words, (select distinct size from item_windows) where len(w) >= size)),
matched as (select doc_id, i, size, item_id from doc_windows join item_windows using (size, win)),
hit_words as (
  select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + size)) as j from matched) group by 1),
ids as (
  select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as items
  from (select distinct doc_id, cast(item_id as varchar) as s from matched) group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join hit_words using (doc_id) left join ids using (doc_id)
"""
