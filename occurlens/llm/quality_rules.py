"""Quality rules with cross-document line frequency.

One pass over the whole texts gives per document the rule statistics and the
hash of every normalised line (ASCII-lowered words, single spaces) that has a
word. A line of at least ``MIN_LINE_WORDS`` words is boilerplate where more than
max(``min_docs``, ``max_share`` of the host's documents) distinct documents (doc_ids) of one host hold it:
it is removed from every document of the host but the first (smallest doc_id), and a document that
loses more than ``max_removed`` of its words is rejected as depleted, like one that fails the
base rules. The share keeps the meaning of the limit as a host grows; copies of a document are
documents, so of many copies the first alone keeps its lines.

Scale: the pass is narrow; lines leave it as 64-bit hashes, counted with map-side
aggregation on (host, line, document), so neither a hot host nor a hot line meets
in one task. The join of lines with the frequent ones is left to the
optimizer (size-checked broadcast, or a shuffle with skew splitting).

Defined cases: null text counts as empty (0 words, fails the base rule); null
host is a host of its own; when every doc_id of a line is null its lines stay;
repeated rows are one document and get the same verdict; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (LOWER, PLAIN, WORD_SLICE_BYTES, Texts, Words, bound_batches, list_array, mix, sequence_hash, signed,
                     span_hashes, split_by, text_slices, with_row_id, written)

MIN_DOCS = 20        # documents of one host that may always share a line
MAX_SHARE = 0.01     # share of the host's documents that may share a line, where that is more
MIN_LINE_WORDS = 3   # shorter lines are never boilerplate
MAX_REMOVED = 0.75   # share of a document's words that line removal may take
MIN_WORDS = 50
REPEAT_WINDOW = 3

SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, text_key long"
LINES = "lines array<struct<no:int,line:long,words:int>>"


def _sum_in(texts: Texts, values: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return np.diff(total[texts.offsets])


def _repeated(words: Words, n: int) -> np.ndarray:
    """Words per text inside a window that occurs twice or more in it."""
    at, grams = words.grams(REPEAT_WINDOW)
    doc = words.doc[at]
    key = mix(grams + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = at[count[inverse] > 1]
    mark = np.zeros(len(words.doc), bool)
    for j in range(REPEAT_WINDOW):
        mark[hit + j] = True
    return np.bincount(words.doc[mark], minlength=n)


def _earlier(doc: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    """Lines per text that equal an earlier line of the same text."""
    key = mix(line + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.unique(key, return_index=True)[1]
    return np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)


def measure_slice(batch: pa.RecordBatch, carried: list[str]) -> pa.RecordBatch:
    texts = Texts(batch.column("text"))
    n, data = texts.n, texts.data
    plain, lower = Words(texts, PLAIN), Words(texts, LOWER)
    # Lines: cut at newlines and at text starts; keep those that hold a word.
    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.union1d(texts.offsets[:-1], breaks + 1)
    line_of = np.searchsorted(line_start, plain.starts, side="right") - 1
    used, first_word, n_words = np.unique(line_of, return_index=True, return_counts=True)
    start = line_start[used]
    doc = plain.doc[first_word] if len(used) else np.zeros(0, np.int64)
    stop = texts.offsets[doc + 1]
    nxt = np.append(breaks, len(data))[np.searchsorted(breaks, start)]
    raw = span_hashes(data, start, np.minimum(nxt, stop))
    # Normalised line: its lowered word hashes in order.
    place = (np.arange(len(plain.doc)) - np.repeat(first_word, n_words)).astype(np.uint64)
    value = mix(lower.hashes + mix(place + np.uint64(1)))
    total = np.concatenate(([np.uint64(0)], np.cumsum(value, dtype=np.uint64)))
    norm = mix(total[first_word + n_words] - total[first_word] + n_words.astype(np.uint64))
    at_doc = np.searchsorted(breaks, texts.offsets[doc])
    number = np.searchsorted(breaks, start) - at_doc
    lines = pa.StructArray.from_arrays(
        [pa.array(number.astype(np.int32)), pa.array(signed(norm)), pa.array(n_words.astype(np.int32))],
        ["no", "line", "words"])
    chars = ((data & 0xC0) != 0x80) & (PLAIN[data] != 0)
    columns = [batch.column(c) for c in carried] + [
        pa.array(plain.counts.astype(np.int64)), pa.array(_sum_in(texts, chars)),
        pa.array(_sum_in(texts, SYMBOLS[data])), pa.array(_earlier(doc, raw, n).astype(np.int64)),
        pa.array(_repeated(plain, n).astype(np.int64)),
        pa.array(signed(span_hashes(data, texts.offsets[:-1], texts.offsets[1:]))),
        list_array(lines, np.bincount(doc, minlength=n))]
    return pa.RecordBatch.from_arrays(columns, names=[*carried, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                      "n_repeat_words", "text_key", "lines"])


def _content_key(text_col: str, id_col: str, host_col: str) -> Column:
    """What a verdict depends on (text, id, host) as one string of two hashes: rows that agree
    in it get the same verdict."""
    cols = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0null")) for c in (text_col, id_col, host_col)]
    return F.concat_ws(":", F.hex(F.xxhash64(*cols)), F.hex(F.xxhash64(F.lit("second"), *cols)))


def measure(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", host_col: str = "source") -> DataFrame:
    """Statistics and line hashes per row (no text), written as a table."""
    bound_batches(docs.sparkSession)
    rows = with_row_id(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{host_col}`").alias("host"), F.col(f"`{text_col}`").alias("text"),
                                   _content_key(text_col, id_col, host_col).alias("content")))
    carried = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=WORD_SLICE_BYTES):
            yield measure_slice(part, carried)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"])
    return written(rows.mapInArrow(run, f"{schema}, {STATS}, {LINES}"), "quality")


def boilerplate(measured: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(host, line, first_id) of the lines above the limit."""
    per_doc = (measured.select("host", "doc_id", F.explode("lines").alias("l")).filter(F.col("l.words") >= MIN_LINE_WORDS)
               .groupBy("host", F.col("l.line").alias("line"), "doc_id").agg(F.count(F.lit(1)).alias("times")))
    lines = (per_doc.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_id"))
             .filter(F.col("docs") > min_docs))
    hosts = (measured.groupBy("host", "doc_id").agg(F.count(F.lit(1)).alias("times"))
             .groupBy(F.col("host").alias("h_host")).agg(F.count(F.lit(1)).alias("h_docs")))
    return (lines.join(hosts, F.col("host").eqNullSafe(F.col("h_host"))).filter(F.col("docs") > max_share * F.col("h_docs"))
            .select("host", "line", "first_id"))


def removals(measured: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(row_id, removed_words, removed_lines) of the rows that lose lines."""
    frequent = boilerplate(measured, min_docs, max_share).withColumnRenamed("host", "f_host")
    lines = measured.select("row_id", "host", "doc_id", F.explode("lines").alias("l"))
    return (lines.join(frequent, (F.col("l.line") == F.col("line")) & F.col("host").eqNullSafe(F.col("f_host"))
                       & ~F.col("doc_id").eqNullSafe(F.col("first_id")))
            .groupBy("row_id").agg(F.sum("l.words").alias("removed_words"), F.collect_list("l.no").alias("removed_lines")))


def judge(measured: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_removed: float = MAX_REMOVED) -> DataFrame:
    """Measured rows with ``removed_words``, ``removed_lines``, ``base_failed`` and ``kept``."""
    out = measured.drop("lines").join(removals(measured, min_docs, max_share), "row_id", "left")
    lost = F.coalesce("removed_words", F.lit(0)).cast("long")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (out.withColumn("removed_words", lost).withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("removed_words") <= max_removed * F.col("n_words"))))


def verdicts(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_removed: float = MAX_REMOVED) -> DataFrame:
    """One row per document: the statistics and the verdict."""
    return judge(measure(docs), min_docs, max_share, max_removed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_words")


def clean(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_removed: float = MAX_REMOVED,
          text_col: str = "text", id_col: str = "doc_id", host_col: str = "source", size_col: str = "n_chars") -> DataFrame:
    """The documents kept, boilerplate lines taken out of the text (and ``size_col``
    following it, where the table has that column). The texts are read a second
    time; only those of rejected or changed documents are shuffled, to meet their verdicts."""
    judged = judge(measure(docs, text_col, id_col, host_col), min_docs, max_share, max_removed)
    touched = written(judged.filter("not kept or removed_lines is not null").groupBy("content").agg(
        F.bool_and("kept").alias("kept"), F.first("removed_lines").alias("removed_lines")), "verdicts")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       _content_key(text_col, id_col, host_col).alias("content"))
    whole, maybe = split_by(rows, touched, ["content"])
    met = maybe.join(touched.hint("merge"), "content", "left").filter("kept is null or kept")
    text = F.col(f"doc.`{text_col}`")
    left = F.array_join(F.transform(
        F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
                 lambda s: ~F.array_contains("removed_lines", s["i"])), lambda s: s["x"]), "\n")
    same = F.col("removed_lines").isNull()
    new = {text_col: F.when(same, text).otherwise(left)}
    if size_col in docs.columns:
        new[size_col] = F.when(same, F.col(f"doc.`{size_col}`")).otherwise(F.length(left).cast(docs.schema[size_col].dataType))
    return (whole.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
            .unionByName(met.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])))


# DuckDB: the same rules over whole tables; exact lines in place of hashes.
ORACLE_SQL = r"""
with words as (
  select doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
grams as (
  select doc_id, i, unnest([i, i + 1, i + 2]) as j from (
    select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n
    from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words)) where n > 1),
repeats as (select doc_id, count(distinct j) as n_repeat_words from grams group by 1),
raw_lines as (
  select doc_id, source, text, x, i, regexp_extract_all(x, '[^\x20\x09-\x0D]+') as lw
  from (select doc_id, source, text, unnest(string_split(text, chr(10))) as x,
               generate_subscripts(string_split(text, chr(10)), 1) as i from documents where text is not null)),
lines as (
  select doc_id, source, text, x, i, len(lw) as words,
         translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line
  from raw_lines where len(lw) > 0),
dups as (
  select doc_id, count(*) - count(distinct x) as n_dup_lines from lines group by 1),
hosts as (
  select source, count(distinct doc_id) + max(cast(doc_id is null as int)) as h_docs from documents group by 1),
frequent as (
  select f.source, line, first_id from (
    select source, line, min(doc_id) as first_id, count(distinct doc_id) + max(cast(doc_id is null as int)) as docs
    from lines where words >= {min_line_words} group by 1, 2) f
  join hosts h on f.source is not distinct from h.source
  where docs > {min_docs} and docs > {max_share} * h_docs),
removed as (
  select l.doc_id, sum(l.words) as removed_words from lines l
  join frequent f on l.line = f.line and l.source is not distinct from f.source and l.doc_id is distinct from f.first_id
  group by 1),
stats as (
  select w.doc_id, cast(len(w) as bigint) as n_words,
         cast(length(array_to_string(w, '')) as bigint) as word_chars,
         cast(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
         cast(coalesce(removed_words, 0) as bigint) as removed_words
  from words w left join repeats using (doc_id) left join dups using (doc_id) left join removed using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and removed_words <= {max_removed} * n_words as kept,
       removed_words
from stats
""".replace("{min_docs}", str(MIN_DOCS)).replace("{max_share}", str(MAX_SHARE)).replace(
    "{min_line_words}", str(MIN_LINE_WORDS)).replace("{max_removed}", str(MAX_REMOVED))
