"""Line deduplication across documents, native functions only.

A line's key is the line without surrounding blanks (``[\\x20\\x09-\\x0D]``) and with A-Z
lowered. Keys of at least ``min_chars`` code points that occur in two or more documents keep
their lines in the smallest doc_id only. What comes back per document is a compressed keep
bitmap (runs of kept lines: start and length), not text; ``apply`` rebuilds texts from it.

Method: one narrow pass hashes every key (128 bits). The hashes are range-partitioned with a
secondary sort by document and position; a running window streams over each key in that
order, so a row knows the first document of its key and what follows it is dropped.

Scale: hash, row number and position of a line travel, texts do not. A hash cell (top 16 bits)
that holds far more lines than a partition should is cut into slices by document, so a line
in a third of all documents is spread over many ranges; only the first document of each slice
is then compared across slices. The table of heavy cells has at most 2 ** 16 rows. Only
documents that lose a line are shuffled to meet their bitmaps.

Defined cases: null or empty text is one empty line; a document is a doc_id, so rows that
repeat an id are one document and all keep a line that it is first to hold; rows without an
id are one document that comes after all others; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .common import split_by, with_row_id, written

MIN_CHARS = 10
CELL_BITS = 16       # heavy hash cells are counted on this many leading bits
SLICES_PER_PARTITION = 4
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without surrounding blanks, A-Z lowered (other letters stay)."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _content(doc_id: Column, text: Column) -> Column:
    """What a bitmap is attached to: 128 bits of the id and the text."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("\0null")), F.coalesce(text, F.lit(""))]
    return F.concat_ws(":", F.hex(F.xxhash64(*parts)), F.hex(F.xxhash64(F.lit("second"), *parts)))


def measure(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
            min_chars: int = MIN_CHARS) -> tuple[DataFrame, int]:
    """(row_id, doc_id, content, n_lines, lines<pos, h1, h2>) per row, written, and the number
    of lines whose key is long enough."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    keyed = F.filter(F.transform(F.col("all_lines"), lambda x, i: F.struct(i.alias("pos"), line_key(x).alias("key"))),
                     lambda s: F.char_length(s["key"]) >= min_chars)
    hashed = F.transform(keyed, lambda s: F.struct(
        s["pos"].alias("pos"), F.xxhash64(s["key"]).alias("h1"), F.xxhash64(F.lit("second"), s["key"]).alias("h2")))
    measured = (with_row_id(rows).withColumn("all_lines", lines_of(F.col("text")))
                .select("row_id", "doc_id", _content(F.col("doc_id"), F.col("text")).alias("content"),
                        F.size("all_lines").cast("long").alias("n_lines"), hashed.alias("lines")))
    seen = Observation()
    table = written(measured.observe(seen, F.coalesce(F.sum(F.size("lines")), F.lit(0)).alias("n")), "lines")
    return table, int(seen.get["n"])


def _sliced(lines: DataFrame, total: int) -> DataFrame:
    """``lines`` with ``slices`` (1 but in heavy cells) and ``slice``."""
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    target = max(1, 4 * total // 2**CELL_BITS, total // (SLICES_PER_PARTITION * partitions))
    cell = F.shiftrightunsigned("h1", 64 - CELL_BITS).cast("int")
    heavy = (lines.groupBy(cell.alias("heavy_cell")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > target)
             .select("heavy_cell", F.ceil(F.col("n") / target).alias("slices")))
    return (lines.join(F.broadcast(heavy), cell == F.col("heavy_cell"), "left")
            .withColumn("slices", F.coalesce("slices", F.lit(1)))
            .withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.col("slices"))).drop("heavy_cell"))


def with_first(ranged: DataFrame) -> DataFrame:
    """``later``: the row's document is not the first one of its key (and slice). Streams over
    the ranges: their order by key satisfies the window, so nothing is shuffled again."""
    order = Window.partitionBy("h1", "h2", "slice").orderBy(F.col("doc_id").asc_nulls_last(), "row_id", "pos")
    first = F.first("doc_id").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ranged.withColumn("later", ~F.col("doc_id").eqNullSafe(first))


def dropped(measured: DataFrame, total: int) -> DataFrame:
    """(row_id, drops) of the rows that lose lines; ``drops`` are sorted line numbers."""
    lines = measured.select("row_id", "doc_id", F.inline("lines"))
    ranged = _sliced(lines, total).repartitionByRange("h1", "h2", "slice")
    found = with_first(ranged).filter("later or slices > 1")
    found = written(found.select("row_id", "doc_id", "pos", "h1", "h2", "later"), "repeats")
    across = Window.partitionBy("h1", "h2")
    heads = (found.filter("not later").withColumn("first_id", F.min("doc_id").over(across))
             .filter(~F.col("doc_id").eqNullSafe(F.col("first_id"))))
    return (found.filter("later").select("row_id", "pos").unionByName(heads.select("row_id", "pos"))
            .groupBy("row_id").agg(F.sort_array(F.collect_list("pos")).alias("drops")))


def _keep_runs(n_lines: Column, drops: Column) -> Column:
    """Runs (start, length) of the lines that stay, from the sorted numbers of those that go."""
    n = n_lines.cast("int")
    firsts = F.filter(drops, lambda x, i: (i == 0) | (F.get(drops, i - 1) < x - 1))
    lasts = F.filter(drops, lambda x, i: (i == F.size(drops) - 1) | (F.get(drops, i + 1) > x + 1))
    runs = _let(F.struct(F.concat(firsts, F.array(n)).alias("stop"), F.concat(F.array(F.lit(-1)), lasts).alias("gone")),
                lambda s: F.transform(s["stop"], lambda x, j: F.struct(
                    (F.get(s["gone"], j) + 1).alias("start"), (x - F.get(s["gone"], j) - 1).alias("length"))))
    return F.filter(runs, lambda r: r["length"] > 0)


def _bitmaps(measured: DataFrame, drops: DataFrame, how: str) -> DataFrame:
    met = measured.drop("lines").join(drops, "row_id", how)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_lines").cast("int").alias("length")))
    return met.select("doc_id", "content", "n_lines",
                      F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
                      F.when(F.col("drops").isNull(), whole).otherwise(_keep_runs(F.col("n_lines"), F.col("drops")))
                      .alias("keep_bitmap"))


def bitmaps(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, content (hash of id and text), n_lines, n_dropped and
    ``keep_bitmap``, the runs of kept lines."""
    measured, total = measure(docs, text_col, id_col, min_chars)
    return _bitmaps(measured, dropped(measured, total), "left")


def kept_text(text: Column, keep_bitmap: Column) -> Column:
    """The kept lines of ``text``, joined by newlines."""
    return _let(lines_of(text), lambda lines: F.array_join(F.flatten(F.transform(
        keep_bitmap, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n"))


def _met(docs: DataFrame, text_col: str, id_col: str, min_chars: int) -> DataFrame:
    """Struct ``doc`` of every row with n_dropped and keep_bitmap (null where no line goes)."""
    measured, total = measure(docs, text_col, id_col, min_chars)
    touched = _bitmaps(measured, dropped(measured, total), "inner").groupBy("content").agg(
        F.first("n_dropped").alias("n_dropped"), F.first("keep_bitmap").alias("keep_bitmap"))
    touched = written(touched, "bitmaps")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       _content(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("content"))
    whole, maybe = split_by(rows, touched, ["content"])
    none = whole.select("doc", F.lit(0).cast("long").alias("n_dropped"), F.lit(None).cast(touched.schema["keep_bitmap"].dataType).alias("keep_bitmap"))
    met = maybe.join(touched.hint("merge"), "content", "left")
    return none.unionByName(met.select("doc", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "keep_bitmap"))


def apply(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text_col``; a text that loses no line is unchanged."""
    met = _met(docs, text_col, id_col, min_chars)
    text = F.col(f"doc.`{text_col}`")
    new = {text_col: F.when(F.col("keep_bitmap").isNull(), text).otherwise(kept_text(text, F.col("keep_bitmap")))}
    return met.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept lines of every document."""
    text = F.col("doc.text")
    kept = F.when(F.col("keep_bitmap").isNull(), F.coalesce(text, F.lit(""))).otherwise(kept_text(text, F.col("keep_bitmap")))
    return _met(docs.select("doc_id", "text"), "text", "doc_id", MIN_CHARS).select(
        F.col("doc.doc_id").alias("doc_id"), F.size(lines_of(text)).cast("long").alias("n_lines"), "n_dropped",
        F.sha2(kept, 256).alias("kept_sha256"))


# DuckDB: the same rule on whole keys in place of hashes.
ORACLE_SQL = r"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
lines as (
  select r, doc_id, i, x,
         translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select r, doc_id, unnest(string_split(t, chr(10))) as x,
               generate_subscripts(string_split(t, chr(10)), 1) as i from docs)),
shared as (
  select key, min(doc_id) as first_id from lines where length(key) >= 10
  group by 1 having count(distinct doc_id) + max(cast(doc_id is null as int)) > 1)
select doc_id, cast(count(*) as bigint) as n_lines,
       cast(count(*) filter (where gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(x, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from (select l.*, s.key is not null and l.doc_id is distinct from s.first_id as gone from lines l left join shared s on l.key = s.key)
group by r, doc_id
"""
