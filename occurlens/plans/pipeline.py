"""End-to-end pipeline: ingest -> clean -> KPIs -> checks -> publish.

Every step writes new folders (see ``sinks/versions.py``); publishing is one commit
of a manifest, after all eight tables were written and checked. So a run publishes
all eight tables or none, a failure at any step leaves the published state as it was,
and ``rollback`` returns to an earlier one. A commit fails (``CommitConflict``) if another run
has committed meanwhile: a full run then reports it, an ingest commits its raw folder on the new
state, and a refresh runs again on the new state.

The uncut counts (``contagens``: one GROUPING SETS aggregate of clean, partitioned
by year) are stored beside the tables that are cut from them, each with a checksum of its key
and total. A refresh of some years replaces exactly those years' clean folders and counts,
drops the years that raw no longer has, and finishes all eight tables from the merged
counts: the same function as in a full run, so a refresh equals one.

``ingest_files`` keeps a table of the ingested files (size and modification time per file, and the
years of each origin): only origins whose files changed are read again, and only the years they
hold or held are written; the manifest names a raw folder for every year.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from .. import constants as C
from ..operators.clean import clean as clean_step
from ..operators.kpis import counts_schema, grouped_counts, kpis_from_grouped, rows_of
from ..schema import CLEAN_SCHEMA, KPI_TABLES, RAW_COLUMNS, check_raw_schema
from ..session import scratch_path
from ..sinks.tables import (CHECK_COLUMN, LoadResult, check_version, failed, measured, observed, read_kpi, row_checksum,
                            write_kpis, write_partitioned)
from ..sinks.versions import (CommitConflict, Manifest, commit, current, new_folder, partition_values, read_if_present,
                              rollback)
from ..sources.files import changed_origins, file_listing, read_occurrence_files

__all__ = ["CommitConflict", "Layout", "Report", "ingest", "ingest_files", "discover_years", "run_clean", "run_kpis", "run_pipeline", "refresh_years",
           "read_raw", "read_clean", "read_counts", "read_kpi", "rollback", "years_stored"]

STEPS = ["ingest", "clean", "kpis"]
COUNTS = "contagens"
NO_YEAR = "__HIVE_DEFAULT_PARTITION__"

# Raw as stored: data columns as strings, the ANO partition read back as int
# (blank years land in the default partition and read back as null).
RAW_STORED_SCHEMA = StructType(
    [StructField(c, StringType(), True) for c in C.REQUIRED_COLUMNS if c != "ANO"]
    + [StructField(C.LINEAGE_COLUMN, StringType(), True), StructField("ANO", IntegerType(), True)])

# The table of ingested files; ``anos`` are the years of the file's origin.
FILES_SCHEMA = StructType([StructField("file", StringType()), StructField("tamanho", LongType()), StructField("modificado", TimestampType()),
                           StructField("origem", StringType()), StructField("anos", ArrayType(IntegerType()))])


@dataclass(frozen=True)
class Layout:
    root: str


@dataclass
class Report:
    metrics: dict[str, float] = field(default_factory=dict)
    loads: list[LoadResult] = field(default_factory=list)
    failed_years: list[int] = field(default_factory=list)
    published: int | None = None

    @property
    def ok(self) -> bool:
        return not self.failed_years and not failed(self.loads)


def _require(path, step: str):
    if path is None:
        raise FileNotFoundError(f"nothing stored yet: run the '{step}' step first")
    return path


def _by_year(values: set[str]) -> set[int | None]:
    return {None if v == NO_YEAR else int(v) for v in values}


def _read_years(spark: SparkSession, folders: dict[int | None, str], sizes: dict[str, int], schema: StructType, column: str,
                years: set[int | None] | None = None) -> DataFrame:
    """Rows of the given years (None: all): each stored folder contributes the years for which
    the manifest names it, so replaced and removed years are not read."""
    wanted: dict[str, list[int | None]] = {}
    for year, folder in folders.items():
        if years is None or year in years:
            wanted.setdefault(folder, []).append(year)
    if not wanted:
        return spark.createDataFrame([], schema)
    frames = []
    for folder, ys in wanted.items():
        keep = F.col(column).isin([y for y in ys if y is not None])
        if None in ys:
            keep = keep | F.col(column).isNull()
        df = spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())
        frames.append(df if len(ys) == sizes.get(folder) else df.filter(keep))
    return reduce(DataFrame.unionByName, frames)


def _read_raw(spark: SparkSession, state: Manifest, years: set[int | None] | None = None) -> DataFrame:
    return _read_years(spark, state.raw, state.sizes, RAW_STORED_SCHEMA, "ANO", years)


def read_raw(spark: SparkSession, layout: Layout) -> DataFrame:
    state = current(spark, layout.root)
    _require(state.raw or None, "ingest")
    return _read_raw(spark, state)


def _read_clean(spark: SparkSession, state: Manifest, years: set[int | None] | None = None) -> DataFrame:
    return _read_years(spark, state.clean, state.sizes, CLEAN_SCHEMA, "ano", years)


def read_clean(spark: SparkSession, layout: Layout, years: list[int] | None = None) -> DataFrame:
    manifest = current(spark, layout.root)
    if not manifest.clean:
        _require(None, "clean")
    return _read_clean(spark, manifest, None if years is None else set(years))


def read_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """The uncut counts of the published state (input of the rankings)."""
    folder = _require(current(spark, layout.root).kpis, "kpis")
    return spark.read.schema(counts_schema()).parquet(f"{folder}/{COUNTS}")


def years_stored(spark: SparkSession, layout: Layout) -> list[int]:
    """Integer years of the raw table, as the manifest names them (no job)."""
    return sorted(y for y in _require(current(spark, layout.root).raw or None, "ingest") if y is not None)


def discover_years(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.createDataFrame([(y,) for y in years_stored(spark, layout)], "ano int")


def _write_years(spark: SparkSession, df: DataFrame, folder: str, schema: StructType, column: str) -> tuple[dict[int | None, str], int]:
    """Write a table by year, files sized by AQE; the folder per year held, and the rows."""
    n = write_partitioned(df, folder, column, balanced=True)
    stored = read_if_present(spark, folder, schema) if n else None
    return {y: folder for y in (_by_year(partition_values(stored, column)) if stored is not None else [])}, n


def _sizes(held: dict[int | None, str]) -> dict[str, int]:
    return dict(Counter(held.values()))


def _write_raw(spark: SparkSession, layout: Layout, raw: DataFrame, state: Manifest) -> tuple[Manifest, int]:
    check_raw_schema(raw.select(*[c for c in raw.columns if c in RAW_COLUMNS]))
    held, n = _write_years(spark, raw, new_folder(layout.root, "raw"), RAW_STORED_SCHEMA, "ANO")
    return state.with_(raw=held, files=None, sizes={**state.sizes, **_sizes(held)}), n


def _commit_raw(spark: SparkSession, layout: Layout, state: Manifest) -> int:
    """A raw table replaces the stored one whole, so after a conflict it is committed again on
    the state that the other run left."""
    while True:
        try:
            return commit(spark, layout.root, state)
        except CommitConflict:
            now = current(spark, layout.root)
            state = now.with_(raw=state.raw, files=state.files, sizes={**now.sizes, **_sizes(state.raw)})


def ingest(raw: DataFrame, layout: Layout) -> int:
    """Full replacement of the raw table, partitioned by ANO; clean and the published
    tables stay as they are until the next run."""
    spark = raw.sparkSession
    state, n = _write_raw(spark, layout, raw, current(spark, layout.root))
    _commit_raw(spark, layout, state)
    return n


def ingest_files(spark: SparkSession, layout: Layout, root: str | list[str], **source) -> list[int | None]:
    """Bring raw up to date with the files under ``root`` and return the years written, for a
    refresh (None: rows without a year). ``source``: options of ``read_occurrence_files``.

    The files' sizes and modification times are compared with those of the last call. Only
    the files of changed, new or vanished origins are read; the years that these origins hold or
    held are written anew, from the fresh rows and the stored rows of the other origins. The
    first call, and a call after ``ingest``, reads everything."""
    state = current(spark, layout.root)
    glob = {"file_glob": source["file_glob"]} if "file_glob" in source else {}
    listing = file_listing(spark, root, **glob)
    if state.files is None:
        before, stale = None, None
        fresh_files = listing
    else:
        before = spark.read.schema(FILES_SCHEMA).parquet(state.files)
        stale = [r["origem"] for r in changed_origins(before, listing).collect()]  # origins to read again
        if not stale:
            return []
        fresh_files = listing.filter(F.col("origem").isin(stale))
    paths = [r["file"] for r in fresh_files.select("file").collect()]
    fresh = (read_occurrence_files(spark, paths, is_file_list=True, **source) if paths
             else spark.createDataFrame([], ", ".join(f"{c} string" for c in RAW_COLUMNS)))
    path = scratch_path(spark, "fresh")
    fresh.write.parquet(path)
    fresh = spark.read.schema(fresh.schema).parquet(path)
    year = F.col("ANO").try_cast("int")
    origins = fresh.select(F.col(C.LINEAGE_COLUMN).alias("origem"), year.alias("ano")).distinct()
    if before is not None:
        origins = origins.unionByName(before.select("origem", F.explode_outer("anos").alias("ano")).distinct()
                                      .filter(~F.col("origem").isin(stale)))
        touched = {r["ano"] for r in before.filter(F.col("origem").isin(stale)).select(F.explode("anos").alias("ano")).distinct().collect()}
    else:
        touched = set(state.raw)
    touched |= {r["ano"] for r in fresh.select(year.alias("ano")).distinct().collect()}
    rows = fresh
    if before is not None:
        others = _read_raw(spark, state, touched).filter(~F.col(C.LINEAGE_COLUMN).isin(stale))
        rows = rows.unionByName(others.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns]))
    held, _ = _write_years(spark, rows, new_folder(layout.root, "raw"), RAW_STORED_SCHEMA, "ANO")
    files = new_folder(layout.root, "files")
    per_origin = origins.groupBy("origem").agg(F.collect_set("ano").alias("anos"), F.bool_or(F.col("ano").isNull()).alias("sem_ano"))
    per_origin = per_origin.select(F.col("origem").alias("o"), F.when(
        F.col("sem_ano"), F.concat("anos", F.array(F.lit(None).cast("int")))).otherwise(F.col("anos")).alias("anos"))
    listing.join(per_origin, F.col("origem") == F.col("o"), "left").select(*FILES_SCHEMA.fieldNames()).write.parquet(files)
    kept = {y: p for y, p in state.raw.items() if y not in touched} if before is not None else {}
    commit(spark, layout.root, state.with_(raw={**kept, **held}, files=files, sizes={**state.sizes, **_sizes(held)}))
    return sorted(touched, key=lambda y: (y is None, y))


def _write_clean(spark: SparkSession, layout: Layout, state: Manifest, years: list[int] | None,
                 date_mode: str) -> tuple[Manifest, dict[str, float]]:
    """Clean all or some years into a new folder. The manifest then names that folder for
    the years it holds, and forgets every requested year without rows and every year that raw
    no longer has. One pass over raw: rows after the date filter and rows written are observed
    by the write; raw rows are counted from the files' row counts, no column is read for them."""
    _require(state.raw or None, "ingest")
    raw = _read_raw(spark, state, None if years is None else set(years))
    valid, folder = Observation(), new_folder(layout.root, "clean")
    cleaned = clean_step(raw, date_mode=date_mode, valid_rows=valid)
    held, n = _write_years(spark, cleaned, folder, CLEAN_SCHEMA, "ano")
    n_raw = raw.count()
    metrics = {"linhas_brutas": float(n_raw), "linhas_validas": float(valid.get.get("rows", 0)), "linhas_limpas": float(n),
               "pct_retido": round(100.0 * n / n_raw, 1) if n_raw else 0.0}
    kept = {} if years is None else {y: p for y, p in state.clean.items() if y not in years and (y is None or y in state.raw)}
    state = state.with_(clean={**kept, **held}, sizes={**state.sizes, **_sizes(held)})
    rows = n if years is None else _read_clean(spark, state).count()
    return state.with_(clean_rows=rows), metrics


def run_clean(spark: SparkSession, layout: Layout, years: list[int] | None = None,
              date_mode: str = "compat") -> dict[str, float]:
    """Clean raw (all or some years) and commit the clean folders. Publishing is a step of
    its own, so readers still see the previous KPI tables."""
    state, metrics = _write_clean(spark, layout, current(spark, layout.root), years, date_mode)
    commit(spark, layout.root, state)
    return metrics


def _stored_counts_schema() -> StructType:
    return counts_schema().add(CHECK_COLUMN, LongType())


def _count_measures() -> dict[str, str]:
    """Per table, over the counts: rows, sum and checksum (SQL aggregates)."""
    out = {}
    for name in KPI_TABLES:
        mine = rows_of(name)
        if name == C.KPI_HOUR:  # the hours of rows without a year are not in the table
            mine += " and ano is not null"
        out |= {f"{name}:todas": f"count_if({mine})", f"{name}:soma": f"coalesce(sum(if({mine}, total, null)), 0)",
                f"{name}:controle": f"coalesce(bit_xor(if({mine}, {CHECK_COLUMN}, null)), 0)"}
    return out


CUT_TABLES = {C.KPI_MUNICIPALITY, C.KPI_BAIRRO, C.KPI_BRAND}


def _reconciled(clean_rows: int, counted: dict[str, int], written: list[LoadResult]) -> list[LoadResult]:
    """What the writes observed, compared on the driver: the counts add up to the clean rows;
    no table holds a changed or invented row; an uncut table holds all its counts; the hours
    add up to theirs."""
    bad = []

    def expect(name: str, wanted, got) -> None:
        if wanted != got:
            bad.append(LoadResult(name, 0, f"ERRO esperado {wanted}, obtido {got}"))

    expect("contagens_somam_linhas_limpas", clean_rows, counted[f"{C.KPI_ANNUAL}:soma"])
    for r in written:
        m = r.medidas
        if r.tabela not in CUT_TABLES:
            parts = ["soma"] if r.tabela == C.KPI_HOUR else ["todas", "soma", "controle"]
            seen = {"todas": m["linhas"] + m["sem_chave"], "soma": m["soma"], "controle": m["controle_todas"]}
            expect(f"{r.tabela}_igual_contagens", [counted[f"{r.tabela}:{p}"] for p in parts], [seen[p] for p in parts])
        expect(f"{r.tabela}_dentro_das_contagens", 0, m["alteradas"])
    return bad


def _write_version(spark: SparkSession, layout: Layout, state: Manifest,
                   fresh: set[int | None] | None) -> tuple[str, list[LoadResult]]:
    """Write counts and the eight tables into a new version folder and check them.
    ``fresh``: years counted anew (None: all); the others' counts come from the current version."""
    folder, schema = new_folder(layout.root, "kpis"), _stored_counts_schema()
    counts = grouped_counts(_read_clean(spark, state, fresh))
    check = " ".join(f"when {rows_of(t)} then {row_checksum(t)}" for t in KPI_TABLES)
    counts = counts.withColumn(CHECK_COLUMN, F.expr(f"case {check} end")).select(*schema.fieldNames())
    if fresh is not None:
        old = spark.read.schema(schema).parquet(f"{_require(state.kpis, 'kpis')}/{COUNTS}").select(*schema.fieldNames())
        kept = [y for y in state.clean if y not in fresh]
        keep = F.col("ano").isin([y for y in kept if y is not None])
        counts = counts.unionByName(old.filter(keep | F.col("ano").isNull() if None in kept else keep))
    counts, obs = observed(counts, _count_measures())
    write_partitioned(counts, f"{folder}/{COUNTS}", "ano", balanced=True)
    counted = measured(obs)
    stored = spark.read.schema(schema).parquet(f"{folder}/{COUNTS}")
    written = write_kpis(kpis_from_grouped(stored, carry=[CHECK_COLUMN]), folder)
    if failed(written):
        return folder, written
    bad = _reconciled(state.clean_rows, counted, written) or failed(check_version(spark, folder, written))
    return folder, [*written, *bad]


def run_kpis(spark: SparkSession, layout: Layout, dry_run: bool = False) -> list[LoadResult]:
    """All eight tables from the stored clean rows; published if every check passes (and
    this is no dry run)."""
    state = current(spark, layout.root)
    if not state.clean:
        _require(None, "clean")
    folder, results = _write_version(spark, layout, state, None)
    if not failed(results) and not dry_run:
        commit(spark, layout.root, state.with_(kpis=folder))
    return results


def run_pipeline(spark: SparkSession, layout: Layout, raw: DataFrame | None = None,
                 from_step: str = "ingest", date_mode: str = "compat", dry_run: bool = False) -> Report:
    """Full refresh, optionally restarting from a later step. The new state is committed once,
    at the end, if everything passed; a dry run writes and checks but commits nothing."""
    if from_step not in STEPS:
        raise ValueError(f"from_step must be one of {STEPS}")
    steps = STEPS[STEPS.index(from_step):]
    report, state = Report(), current(spark, layout.root)
    if "ingest" in steps:
        if raw is None:
            raise ValueError("the ingest step needs a raw DataFrame")
        state, n = _write_raw(spark, layout, raw, state)
        report.metrics["linhas_ingeridas"] = n
    if "clean" in steps:
        state, metrics = _write_clean(spark, layout, state, None, date_mode)
        report.metrics.update(metrics)
    elif not state.clean:
        _require(None, "clean")
    folder, report.loads = _write_version(spark, layout, state, None)
    if report.ok and not dry_run:  # a conflict is raised: this run's tables are not of the current raw
        report.published = commit(spark, layout.root, state.with_(kpis=folder))
    return report


def refresh_years(spark: SparkSession, layout: Layout, years: list[int] | None = None,
                  date_mode: str = "compat", dry_run: bool = False) -> Report:
    """Clean -> KPIs -> checks -> publish for the requested years (None: every year of raw),
    in one job per step for all of them together. Requested years without rows and years that raw no
    longer has disappear. If the combined run fails, each year is retried alone, and failures
    are collected while the others are published."""
    state = current(spark, layout.root)
    in_raw = set(_require(state.raw or None, "ingest"))
    gone = {y for y in state.clean if y is not None and y not in in_raw}
    asked = {y for y in in_raw if y is not None} if years is None else set(years)
    chosen = sorted(y for y in asked | gone if y in in_raw or y in state.clean)
    report = Report()
    if not chosen:
        return report
    if state.kpis is None:  # nothing published yet: there are no counts to merge with
        return run_pipeline(spark, layout, from_step="clean", date_mode=date_mode, dry_run=dry_run)
    try:
        _refresh(spark, layout, chosen, date_mode, report, dry_run)
    except CommitConflict:
        raise
    except Exception:  # noqa: BLE001 - fall back to one year at a time
        for y in chosen:
            try:
                _refresh(spark, layout, [y], date_mode, report, dry_run)
            except Exception as e:  # noqa: BLE001
                report.failed_years.append(y)
                report.loads = [LoadResult(f"ano {y}", 0, f"ERRO {type(e).__name__}: {e}")]
    return report


REFRESH_TRIES = 3


def _refresh(spark: SparkSession, layout: Layout, years: list[int], date_mode: str, report: Report, dry_run: bool) -> None:
    """Refresh on the current state; once more on the new one where another run committed
    meanwhile (its years and this run's are then both in)."""
    for attempt in range(REFRESH_TRIES):
        state, metrics = _write_clean(spark, layout, current(spark, layout.root), years, date_mode)
        folder, results = _write_version(spark, layout, state, set(years))
        bad = failed(results)
        if bad:
            raise RuntimeError("; ".join(f"{r.tabela}: {r.status}" for r in bad))
        try:
            if not dry_run:
                report.published = commit(spark, layout.root, state.with_(kpis=folder))
        except CommitConflict:
            if attempt + 1 == REFRESH_TRIES:
                raise
            continue
        report.metrics.update(metrics)
        report.loads = results
        return
