"""Multi-file occurrence source (one file per year, every column a string).

* files are those under the root whose names match a glob (``CelularesSubtraidos_*`` by
  default; Office lock files ``~$...`` never match it);
* one probing pass over the text gives a small table, a row per file: its header (first line),
  its encoding (UTF-8 where every line is valid UTF-8, else ``FALLBACK_ENCODING``), and whether
  a line leaves a quote open, as a record with a line break does; only the distinct headers
  reach the driver;
* lines are read in one scan, decoded by their file's encoding and parsed **once**, whatever
  the number of headers, into an array of cells; the required columns are picked from it by the
  positions of their file's header, never by one schema for all (a CSV schema binds by position
  and would silently shift the columns of a file lacking one), never inferred;
* files with open quotes are read record by record instead, one native multi-line scan per
  distinct header and encoding, so a line break inside a cell stays in it;
* the required columns come out in a fixed order; absent columns and empty cells are blank;
* lineage is the file name, or the ``ARQUIVO_ORIGEM=...`` directory value when the files are
  laid out in such partition directories;
* a file whose year column is blank throughout gets year and month from its occurrence date
  (``derive_year_month``); the parsed rows are written for that, so nothing is parsed twice.

A line equal to its file's header is a header. A header with a line break in it is an error.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import parse_date
from ..schema import check_raw_schema
from ..session import scratch_path
from ..sinks.versions import is_missing

# CSV options that keep every character of a value (Spark trims leading and
# trailing blanks on write by default; the padding is data here).
CSV_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "inferSchema": "false",
    "mode": "PERMISSIVE",
}
MAX_HEADERS = 10_000  # distinct headers that may reach the driver; more is an error
FALLBACK_ENCODING = "windows-1252"  # not among Spark's own charsets: ISO-8859-1, with its control range mapped
C1 = "".join(chr(b) for b in range(0x80, 0xA0))
C1_IN_FALLBACK = "".join(bytes([b]).decode(FALLBACK_ENCODING, "ignore") or chr(b) for b in range(0x80, 0xA0))
PROBE_SCHEMA = "file string, header string, encoding string, by_record boolean"


def _lines(spark: SparkSession, root: str | list[str], file_glob: str) -> DataFrame:
    """(file, first_block, line) of all files, bytes as they are: one text scan."""
    reader = spark.read.option("pathGlobFilter", file_glob)
    try:
        text = reader.text([root] if isinstance(root, str) else list(root))
    except AnalysisException as e:
        if is_missing(e):
            raise FileNotFoundError(f"no {file_glob} files under {root}") from e
        raise
    file = F.col("_metadata.file_path")
    return (text.select(file.alias("file"), (F.col("_metadata.file_block_start") == 0).alias("first_block"), F.col("value").alias("line"))
            .filter(~_lock_file(F.col("file")) & (F.col("line") != "")))


def _lock_file(file: Column) -> Column:
    return F.substring_index(file, "/", -1).startswith("~$")


def _from_latin1(text: Column, encoding: Column) -> Column:
    """Bytes 80 to 9F are control characters in ISO-8859-1 and printable ones in windows-1252."""
    return F.when(encoding == FALLBACK_ENCODING, F.translate(text, C1, C1_IN_FALLBACK)).otherwise(text)


def _decoded(line: Column, encoding: Column, options: dict[str, str]) -> Column:
    """The text of a line's bytes, by its file's encoding or the one given for all."""
    if "encoding" in options:
        return F.decode(line.cast("binary"), options["encoding"])
    return F.when(encoding == "UTF-8", line).otherwise(_from_latin1(F.decode(line.cast("binary"), "ISO-8859-1"), encoding))


def _quote(options: dict[str, str]) -> str:
    return options.get("quote", '"')


def _open_quote(line: Column, options: dict[str, str]) -> Column:
    """An odd number of quotes that are not escaped: the record goes on in the next line."""
    quote, escape = _quote(options), options.get("escape", "\\")
    if not quote:
        return F.lit(False)
    bare = line if escape == quote else F.replace(line, F.lit(escape + quote), F.lit(""))
    return (F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(quote), F.lit("")))) % (2 * len(quote)) != 0


def probe_files(spark: SparkSession, root: str | list[str], file_glob: str = C.SOURCE_FILE_GLOB,
                options: dict[str, str] | None = None) -> DataFrame:
    """Written table (file, header, encoding, by_record): one row per file, one pass. An
    ``encoding`` option holds for all files, a true ``multiLine`` option reads all by record."""
    options = options or {}
    lines = _lines(spark, root, file_glob).withColumn("at", F.when(F.col("first_block"), F.monotonically_increasing_id()))
    by_record = (F.lit(True) if str(options.get("multiLine", "")).lower() == "true" else
                 F.bool_or(_open_quote(F.col("line"), options)))
    encoding = (F.lit(options["encoding"]) if "encoding" in options else
                F.when(F.bool_and(F.is_valid_utf8("line")), "UTF-8").otherwise(FALLBACK_ENCODING))
    # Buffers of fixed size, so this is a hash aggregate; the header lines are fetched by their place.
    per_file = lines.groupBy("file").agg(F.min("at").alias("at"), encoding.alias("encoding"), by_record.alias("by_record"))
    found, path = scratch_path(spark, "files"), scratch_path(spark, "files")
    n_files, n_headers = Observation(), Observation()
    count = F.count(F.lit(1)).alias("n")
    per_file.observe(n_files, count).write.parquet(found)
    per_file = spark.read.schema("file string, at long, encoding string, by_record boolean").parquet(found)
    first = lines.select("file", "at", "line").join(F.broadcast(per_file), ["file", "at"])
    probe = first.select("file", _decoded(F.col("line"), F.col("encoding"), options).alias("header"), "encoding", "by_record")
    probe.observe(n_headers, count).write.parquet(path)
    if n_headers.get.get("n", 0) != n_files.get.get("n", 0):
        raise RuntimeError("the source files changed while they were read")
    return spark.read.schema(PROBE_SCHEMA).parquet(path)


def header_columns(header: str, options: dict[str, str]) -> list[str]:
    sep, quote = options.get("sep", options.get("delimiter", ",")), options.get("quote", '"')
    return next(csv.reader([header.lstrip("\ufeff")], delimiter=sep, quotechar=quote or None))


def _distinct_headers(probe: DataFrame, options: dict[str, str]) -> dict[str, set[bool]]:
    """The distinct headers, each with the ways (by record or by line) that its files are read."""
    found: dict[str, set[bool]] = defaultdict(set)
    for r in probe.select("header", "by_record").distinct().limit(2 * MAX_HEADERS + 1).collect():
        found[r["header"]].add(r["by_record"])
    if len(found) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} distinct headers: these files are no occurrence files")
    quote = _quote(options)
    for h in found:
        if quote and h.count(quote) % 2:
            raise ValueError(f"header with a line break: {h[:200]}")
    return dict(sorted(found.items()))


def _parse_options(options: dict[str, str]) -> dict[str, str]:
    return {k: v for k, v in {**CSV_OPTIONS, **options}.items() if k not in ("header", "inferSchema", "encoding", "multiLine")}


def _by_line(lines: DataFrame, probe: DataFrame, headers: list[str], columns: list[str], options: dict[str, str]) -> DataFrame:
    """Every line parsed once into cells; each file's required columns picked by position."""
    spark = lines.sparkSession
    names = {h: header_columns(h, options) for h in headers}
    picks = spark.createDataFrame([(h, [n.index(c) if c in n else -1 for c in columns]) for h, n in names.items()],
                                  "header string, pick array<int>")
    width = max(len(n) for n in names.values())
    ddl = ", ".join(f"`c{i}` string" for i in range(width))
    # One row per distinct header, one per file: broadcast, as lines shuffled by file would come to one task per file.
    files = probe.filter("not by_record").join(F.broadcast(picks), "header")
    rows = lines.join(F.broadcast(files), "file").select("file", "pick", "header", _decoded(F.col("line"), F.col("encoding"), options).alias("line"))
    parsed = rows.filter("line <> header").select("file", "pick", F.from_csv("line", ddl, _parse_options(options)).alias("row"))
    cells = parsed.select("file", "pick", F.array(*[F.col("row")[f"c{i}"] for i in range(width)]).alias("cells"))
    return cells.select("file", *[F.get("cells", F.get("pick", i)).alias(c) for i, c in enumerate(columns)])


def _path_of(file: str) -> str:
    """A literal reader path from a file's URI: decoded, glob characters escaped."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", unquote(file))


def _by_record(spark: SparkSession, probe: DataFrame, columns: list[str], options: dict[str, str]) -> list[DataFrame]:
    """One native multi-line scan per distinct header and encoding of the files that need it."""
    groups: dict[tuple[str, str], list[str]] = defaultdict(list)
    for r in probe.filter("by_record").select("file", "header", "encoding").collect():  # the files a reader lists anyway
        groups[r["header"], r["encoding"]].append(r["file"])
    out = []
    for (header, encoding), files in sorted(groups.items()):
        names = header_columns(header, options)
        ddl = ", ".join(f"`c{i}` string" for i in range(len(names)))
        df = (spark.read.schema(ddl).options(**_parse_options(options)).option("header", "true").option("multiLine", "true")
              .option("encoding", "ISO-8859-1" if encoding == FALLBACK_ENCODING else encoding).csv([_path_of(f) for f in sorted(files)]))
        out.append(df.select(F.col("_metadata.file_path").alias("file"), *[
            (_from_latin1(F.col(f"c{names.index(c)}"), F.lit(encoding)) if c in names else F.lit(None).cast("string")).alias(c)
            for c in columns]))
    return out


def _read_csv(spark: SparkSession, root: str | list[str], file_glob: str, columns: list[str],
              options: dict[str, str]) -> DataFrame:
    probe = probe_files(spark, root, file_glob, options)
    headers = _distinct_headers(probe, options)
    if not headers:
        raise FileNotFoundError(f"no {file_glob} files under {root}")
    parts, ways = [], set().union(*headers.values())
    if False in ways:
        parts.append(_by_line(_lines(spark, root, file_glob).drop("first_block"), probe, list(headers), columns, options))
    if True in ways:
        parts += _by_record(spark, probe, columns, options)
    return reduce(DataFrame.unionByName, parts)


def _read_columnar(spark: SparkSession, root: str | list[str], file_glob: str, fmt: str, columns: list[str],
                   options: dict[str, str]) -> DataFrame:
    """Self-describing files: one scan over the merged schema; columns a file lacks are null."""
    reader = spark.read.format(fmt).options(**{"mergeSchema": "true", **options}).option("pathGlobFilter", file_glob)
    try:
        df = reader.load([root] if isinstance(root, str) else list(root))
    except AnalysisException as e:
        if is_missing(e) or (e.getCondition() or "").startswith("UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no {file_glob} files under {root}") from e
        raise
    return df.select(F.col("_metadata.file_path").alias("file"), *[
        (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in columns])


def _read(spark: SparkSession, root: str | list[str], file_glob: str, fmt: str, columns: list[str],
          options: dict[str, str]) -> DataFrame:
    if fmt == "csv":
        return _read_csv(spark, root, file_glob, columns, options)
    return _read_columnar(spark, root, file_glob, fmt, columns, options)


def read_occurrence_files(spark: SparkSession, root: str | list[str], file_glob: str = C.SOURCE_FILE_GLOB,
                          fmt: str = "csv", columns: list[str] | None = None,
                          options: dict[str, str] | None = None,
                          derive_year: bool = True, is_file_list: bool = False) -> DataFrame:
    """The raw table (required columns + lineage, all strings) from files. ``is_file_list``:
    ``root`` lists files (as ``file_listing`` does), to be read whatever characters they have."""
    columns = columns or C.REQUIRED_COLUMNS
    if is_file_list:
        root = [_path_of(f) for f in root]
    df = _read(spark, root, file_glob, fmt, columns, options or {})
    out = df.select(*columns, origin_of(F.col("file")).alias(C.LINEAGE_COLUMN)).na.fill("", subset=columns)
    if derive_year:  # two passes, so the parsed rows are written first
        path = scratch_path(spark, "parsed")
        out.write.parquet(path)
        out = derive_year_month(spark.read.schema(out.schema).parquet(path))
    check_raw_schema(out, columns + [C.LINEAGE_COLUMN])
    return out


def origin_of(file_path):
    """Lineage from an (encoded) file path: the ``ARQUIVO_ORIGEM=`` folder value when
    present, else the file name. Blanks and accents are decoded, a plus sign stays."""
    pattern = f"/{C.LINEAGE_COLUMN}=([^/]+)/[^/]+$"
    folder = F.regexp_extract(file_path, pattern, 1)
    name = F.regexp_extract(file_path, r"([^/]+)$", 1)
    return F.url_decode(F.replace(F.when(folder != "", folder).otherwise(name), F.lit("+"), F.lit("%2B")))


def derive_year_month(raw: DataFrame) -> DataFrame:
    """Where **every** row of a file has a blank ``ANO``, set ``ANO``/``MES``
    to the year/month of its occurrence date (blank when unparsable).

    The per-file flag is an aggregate of which only the blank files are kept (at most one
    row per file, as in the listing the reader holds) and broadcast: shuffled by
    file, the rows would come to one task per file, however many they are."""
    flags = raw.groupBy(C.LINEAGE_COLUMN).agg(F.bool_and(F.col("ANO") == "").alias("_blank_year")).filter("_blank_year")
    joined = raw.join(F.broadcast(flags), on=C.LINEAGE_COLUMN, how="left")
    date = parse_date("DATA_OCORRENCIA_BO")
    blank = F.coalesce(F.col("_blank_year"), F.lit(False))
    out = joined.withColumns({
        "ANO": F.when(blank, F.coalesce(F.year(date).cast("string"), F.lit(""))).otherwise(F.col("ANO")),
        "MES": F.when(blank, F.coalesce(F.month(date).cast("string"), F.lit(""))).otherwise(F.col("MES")),
    })
    return out.select(*raw.columns)


def file_listing(spark: SparkSession, root: str | list[str], file_glob: str = C.SOURCE_FILE_GLOB) -> DataFrame:
    """(file, tamanho, modificado, origem) of the source files: a listing, no content is read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", file_glob)
    try:
        files = reader.load([root] if isinstance(root, str) else list(root))
    except AnalysisException as e:
        if is_missing(e):
            raise FileNotFoundError(f"no {file_glob} files under {root}") from e
        raise
    file = F.col("_metadata.file_path")
    return (files.select(file.alias("file"), F.col("length").alias("tamanho"), F.col("modificationTime").alias("modificado"),
                         origin_of(file).alias("origem"))
            .filter(~_lock_file(F.col("file"))))


def changed_origins(before: DataFrame, now: DataFrame) -> DataFrame:
    """(origem) with a file that is new, gone, or of another size or time than before."""
    both = (before.select("origem", "file", "tamanho", "modificado", F.lit(1).alias("side"))
            .unionByName(now.select("origem", "file", "tamanho", "modificado", F.lit(2).alias("side"))))
    per_file = both.groupBy("origem", "file", "tamanho", "modificado").agg(F.sum("side").alias("sides"))
    return per_file.filter("sides <> 3").select("origem").distinct()


def schema_drift(spark: SparkSession, root: str | list[str], file_glob: str = C.SOURCE_FILE_GLOB,
                 columns: list[str] | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """CSV files (by lineage value) whose header lacks required columns: a projection of the
    probed headers, one distinct row per file and missing list."""
    columns, options = columns or C.REQUIRED_COLUMNS, options or {}
    probe = probe_files(spark, root, file_glob, options)
    missing = F.lit(None).cast("string")
    for h in _distinct_headers(probe, options):
        names = header_columns(h, options)
        lacking = ",".join(c for c in columns if c not in names)
        missing = F.when(F.col("header") == h, F.lit(lacking)).otherwise(missing)
    return (probe.select(origin_of(F.col("file")).alias("arquivo"), missing.alias("colunas_ausentes"))
            .filter("colunas_ausentes <> ''").distinct())


FOOTER_THREADS = 16


def schema_drift_columnar(spark: SparkSession, root: str | list[str], file_glob: str = C.SOURCE_FILE_GLOB,
                          fmt: str = "parquet", columns: list[str] | None = None) -> DataFrame:
    """Self-describing files whose columns diverge: (arquivo, colunas_ausentes, colunas_de_outro_tipo),
    the latter as ``name:type`` of required columns that are no strings. Each file's footer is read by
    a small Spark job (several at a time), so any store that Spark reads will do and no rows are read."""
    columns = columns or C.REQUIRED_COLUMNS
    paths = [root] if isinstance(root, str) else list(root)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", file_glob).option("recursiveFileLookup", "true")
    try:
        files = [r["path"] for r in listing.load(paths).select("path").collect()]
    except AnalysisException as e:
        if is_missing(e):
            raise FileNotFoundError(f"no {file_glob} files under {root}") from e
        raise

    def footer(file: str) -> tuple[str, str, str]:
        types = {f.name: f.dataType.simpleString() for f in spark.read.format(fmt).load(re.sub(r"([{}\[\]*?\\])", r"\\\1", file)).schema}
        return (file, ",".join(c for c in columns if c not in types),
                ",".join(f"{c}:{types[c]}" for c in columns if types.get(c, "string") != "string"))

    with ThreadPoolExecutor(max_workers=FOOTER_THREADS) as pool:
        found = [r for r in pool.map(footer, sorted(files)) if r[1] or r[2]]
    drift = spark.createDataFrame(found, "file string, colunas_ausentes string, colunas_de_outro_tipo string")
    return drift.select(origin_of(F.replace("file", F.lit("%"), F.lit("%25"))).alias("arquivo"), "colunas_ausentes", "colunas_de_outro_tipo").distinct()


def export_source_files(raw: DataFrame, root: str, drop: dict[str, list[str]] | None = None,
                        fmt: str = "csv") -> str:
    """Write a raw table as source files, one ``ARQUIVO_ORIGEM=<origin>``
    folder per origin; origins listed in ``drop`` are written without those
    columns (as a newer yearly file that lacks them). One write per distinct
    column set."""
    drop = drop or {}
    data_cols = [c for c in raw.columns if c != C.LINEAGE_COLUMN]
    specs: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for origin, cols in drop.items():
        specs[tuple(sorted(cols))].append(origin)
    dropped = [o for origins in specs.values() for o in origins]

    def write(df: DataFrame, cols: list[str]) -> None:
        w = df.select(*cols, C.LINEAGE_COLUMN).write.mode("append").partitionBy(C.LINEAGE_COLUMN)
        if fmt == "csv":
            w.options(**CSV_OPTIONS).csv(root)
        else:
            w.format(fmt).save(root)

    write(raw.filter(~F.col(C.LINEAGE_COLUMN).isin(dropped)) if dropped else raw, data_cols)
    for cols, origins in specs.items():
        write(raw.filter(F.col(C.LINEAGE_COLUMN).isin(origins)), [c for c in data_cols if c not in cols])
    return root
