"""KPI tables on Parquet: writing, checks, ordered reading, and an optional database target.

Row counts, sums and order-free checksums come from ``DataFrame.observe`` during the write
itself (``Measures``), not from jobs of their own. Every stored count carries a checksum of its key
and total, made when it was counted; each table's write recomputes it from the values it writes,
so a changed or invented row is seen there, and sums and checksums of whole tables are compared on
the driver. One job then reads the written tables once, for their keys, range and checksums.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .. import constants as C
from ..schema import KPI_KEYS, KPI_SCHEMAS, KPI_TABLES
from ..session import held_settings
from .versions import current, read_if_present

#: Reading order of each table: (column, descending).
KPI_ORDER = {
    C.KPI_ANNUAL: [("tipo_crime", False), ("ano", False)],
    C.KPI_MONTHLY: [("ano", False), ("mes", False), ("tipo_crime", False)],
    C.KPI_MUNICIPALITY: [("ano", False), ("total", True), ("municipio", False), ("tipo_crime", False)],
    C.KPI_BAIRRO: [("ano", False), ("total", True), ("bairro", False), ("tipo_crime", False)],
    C.KPI_LOCATION: [("ano", False), ("total", True), ("tipo_local", False), ("tipo_crime", False)],
    C.KPI_BRAND: [("ano", False), ("total", True), ("marca", False), ("tipo_crime", False)],
    C.KPI_HOUR: [("ano", False), ("hora", False), ("tipo_crime", False)],
    C.KPI_PERIOD: [("ano", False), ("total", True), ("periodo", False), ("tipo_crime", False)],
}


#: The shuffle files of a write go when it ends, not when the driver happens to collect its garbage.
WRITE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
#: A task keeps a writer open for each of so many partitions; only the rows of further ones are sorted.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "16"}


def scans_files_only(df: DataFrame) -> bool:
    """Whether ``df`` is row-wise over files: no shuffle or broadcast, and tasks sized by the files' bytes."""
    def ok(node) -> bool:
        children = node.children()
        if children.isEmpty():
            return node.getClass().getSimpleName() == "FileSourceScanExec"
        return "Exchange" not in node.getClass().getSimpleName() and all(ok(children.apply(i)) for i in range(children.size()))
    return ok(df._jdf.queryExecution().executedPlan())


def write_partitioned(df: DataFrame, path: str, partition_by: list[str] | str | None = None, balanced: bool = False,
                      mode: str = "errorifexists") -> int:
    """Write Parquet to a folder of its own; returns the number of rows written. ``balanced``:
    rows are first dealt by the partition column into partitions of the advised size (AQE merges
    small years and splits large ones), so the number of files follows the bytes, not tasks x
    years; worth a shuffle where many tasks hold many years. Rows that come straight from files are
    not dealt: their tasks are of the files' bytes already, and dealt rows take several times the
    disk of the table they are written to."""
    by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    obs, conf = Observation(), WRITE_CONF
    if balanced and scans_files_only(df):
        conf = WRITE_CONF | UNSORTED
    elif balanced:
        df = df.hint("rebalance", *by)
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    with held_settings(df.sparkSession, conf):
        writer.parquet(path)
    return int(obs.get.get("rows", 0))


def observed(df: DataFrame, measures: dict[str, str]) -> tuple[DataFrame, Observation]:
    """``df`` with SQL aggregates that the next write of it takes on the way."""
    obs = Observation()
    return df.observe(obs, *[F.expr(f"{c} as `{n}`") for n, c in measures.items()]), obs


def measured(obs: Observation) -> dict[str, int]:
    return {k: int(v or 0) for k, v in obs.get.items()}


@dataclass
class LoadResult:
    tabela: str
    linhas: int
    status: str
    medidas: dict[str, int] = field(default_factory=dict)  # what the write observed


TABLE_THREADS = 8
CHECK_COLUMN = "conferencia"  # of a stored count: checksum of its key and total


def for_each_table(kpis: dict[str, DataFrame], fn) -> list[LoadResult]:
    """Run ``fn(name, df) -> LoadResult`` for every table, concurrently.

    The tables are small and independent, so their jobs are submitted from
    several driver threads at once instead of one after another. A failing
    table is recorded with its whole error and the others continue; results
    keep table order. Callers decide what a failure means (see pipeline.py:
    nothing is published)."""
    from concurrent.futures import ThreadPoolExecutor  # noqa: PLC0415

    def safe(item):
        name, df = item
        try:
            return fn(name, df)
        except Exception as e:  # noqa: BLE001 - reported, others continue
            return LoadResult(name, 0, f"ERRO {type(e).__name__}: {e}")

    with ThreadPoolExecutor(max_workers=min(TABLE_THREADS, max(1, len(kpis)))) as pool:
        return list(pool.map(safe, kpis.items()))


def any_key_null(name: str) -> str:
    return "(" + " or ".join(f"{k} is null" for k in KPI_KEYS[name]) + ")"


def row_checksum(name: str) -> str:
    """Checksum of a table row's key and total (nulls do not change it), as SQL."""
    by = ("ano", "tipo_crime")
    keys = [*(k for k in by if k in KPI_KEYS[name]), *(k for k in KPI_KEYS[name] if k not in by)]
    return f"xxhash64('{name}', {', '.join(keys)}, total)"


def _changed(name: str) -> str:
    """A row that is not the count it was made from. Hours without a count are rows of 0."""
    same = f"{CHECK_COLUMN} <=> {row_checksum(name)}"
    return f"not ({same} or ({CHECK_COLUMN} is null and total = 0))" if name == C.KPI_HOUR else f"not ({same})"


def write_kpis(kpis: dict[str, DataFrame], folder: str) -> list[LoadResult]:
    """Write the eight tables into one new version folder, partitioned by ``ano``.

    Rows with a null key (a null year) cannot be stored under the natural key; where the write
    observed any, they go to ``<folder>/sem_chave/<table>`` and are counted in the status of the
    report. Tables that carry the column ``CHECK_COLUMN`` are compared with it, row by row, by the
    write; it is not stored."""
    def write(name: str, df: DataFrame) -> LoadResult:
        df, keyless, h = nan_to_null(df), any_key_null(name), row_checksum(name)
        measures = {"linhas": f"count_if(not {keyless})", "sem_chave": f"count_if{keyless}", "soma": "coalesce(sum(total), 0)",
                    "controle": f"coalesce(bit_xor(if({keyless}, null, {h})), 0)", "controle_todas": f"coalesce(bit_xor({h}), 0)"}
        if CHECK_COLUMN in df.columns:
            measures["alteradas"] = f"count_if({_changed(name)})"
        seen, obs = observed(df, measures)
        n = write_partitioned(seen.filter(f"not {keyless}").drop(CHECK_COLUMN), f"{folder}/{name}", "ano")
        m = measured(obs)
        if m["sem_chave"]:
            write_partitioned(df.filter(keyless).drop(CHECK_COLUMN), f"{folder}/sem_chave/{name}")
        return LoadResult(name, n, f"OK ({m['sem_chave']} sem chave)" if m["sem_chave"] else "OK", m)
    return for_each_table(kpis, write)


def check_version(spark: SparkSession, folder: str, written: list[LoadResult] | None = None) -> list[LoadResult]:
    """One job over the tables of a version folder. A missing table, a duplicate or null key, a
    change outside the sink's range, or (given ``written``) rows that are not those the
    write observed, are errors."""
    tables = {name: read_if_present(spark, f"{folder}/{name}", KPI_SCHEMAS[name]) for name in KPI_TABLES}
    parts = []
    for name, df in tables.items():
        if df is not None:
            yoy = out_of_range("variacao_yoy_pct") if "variacao_yoy_pct" in df.columns else "false"
            keys = ", ".join(f"cast({k} as string)" for k in KPI_KEYS[name])
            parts.append(df.selectExpr(f"'{name}' as tabela", f"array({keys}) as chave", f"{any_key_null(name)} as nula",
                                       f"coalesce({yoy}, false) as fora", f"{row_checksum(name)} as h"))
    found = {}
    if parts:
        per_key = reduce(DataFrame.unionByName, parts).groupBy("tabela", "chave").agg(
            F.expr("count(1) as n"), F.expr("count_if(nula) as nulas"), F.expr("count_if(fora) as fora"), F.expr("bit_xor(h) as h"))
        found = {r["tabela"]: r for r in per_key.groupBy("tabela").agg(
            F.expr("sum(n) as linhas"), F.expr("count_if(n > 1) as duplicadas"), F.expr("sum(nulas) as nulas"),
            F.expr("sum(fora) as fora"), F.expr("bit_xor(h) as controle")).collect()}
    by_write = {r.tabela: r.medidas for r in written or []}

    def verdict(name: str) -> LoadResult:
        if tables[name] is None:
            return LoadResult(name, 0, "ERRO tabela ausente")
        r = found[name].asDict() if name in found else dict.fromkeys(("linhas", "duplicadas", "nulas", "fora", "controle"), 0)
        if r["duplicadas"] or r["nulas"]:
            return LoadResult(name, 0, f"ERRO chaves: {r['duplicadas']} duplicadas, {r['nulas']} nulas")
        if r["fora"]:
            return LoadResult(name, 0, f"ERRO faixa: {r['fora']} variacoes fora de +-{max_yoy()}")
        m = by_write.get(name)
        if m and (m["linhas"], m["controle"]) != (r["linhas"], r["controle"]):
            return LoadResult(name, 0, f"ERRO gravacao: {r['linhas']} linhas lidas, {m['linhas']} gravadas, ou outro conteudo")
        return LoadResult(name, r["linhas"], "OK")
    return [verdict(name) for name in KPI_TABLES]


def read_kpi_folder(spark: SparkSession, folder: str, name: str) -> DataFrame:
    columns = [f.name for f in KPI_SCHEMAS[name].fields]
    return spark.read.schema(KPI_SCHEMAS[name]).parquet(f"{folder}/{name}").select(*columns)


def in_order(df: DataFrame, name: str) -> DataFrame:
    """A KPI table in its reading order."""
    return df.orderBy(*[F.desc(c) if down else F.asc_nulls_first(c) for c, down in KPI_ORDER[name]])


def read_kpi(spark: SparkSession, root: str, name: str, ordered: bool = False) -> DataFrame | None:
    """A published KPI table of the current state under ``root``, or None before the
    first publish. ``ordered`` sorts on the read side (the files promise no order)."""
    folder = current(spark, root).kpis
    if folder is None:
        return None
    df = read_kpi_folder(spark, folder, name)
    return in_order(df, name) if ordered else df


def read_kpis(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All published tables of one state (the pointer is read once)."""
    folder = current(spark, root).kpis
    return {} if folder is None else {name: read_kpi_folder(spark, folder, name) for name in KPI_TABLES}


def load_report(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    """(tabela, linhas, status) per table; ``failed(results)`` tells which failed."""
    rows = [(r.tabela, int(r.linhas), r.status) for r in results]
    return spark.createDataFrame(rows, "tabela string, linhas long, status string")


def failed(results: list[LoadResult]) -> list[LoadResult]:
    return [r for r in results if not r.status.startswith("OK")]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null (what a database expects)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.when(F.isnan(f.name), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def max_yoy() -> float:
    p, s = C.YOY_PRECISION
    return float(f"{'9' * (p - s)}.{'9' * s}")


def out_of_range(column: str) -> str:
    """Whether a change (rounded to the sink's scale) does not fit the sink's decimal, as SQL."""
    return f"abs(round({column}, {C.YOY_PRECISION[1]})) > {max_yoy()}D"


def to_sink_types(df: DataFrame) -> DataFrame:
    """Database column types: YoY as DECIMAL(6,2), NaN as null, totals as they are (long).
    A change that does not fit fails the job; it never becomes null."""
    p, s = C.YOY_PRECISION
    out = nan_to_null(df)
    if "variacao_yoy_pct" in out.columns:
        yoy = F.col("variacao_yoy_pct")
        message = F.concat(F.lit("variacao_yoy_pct out of range: "), yoy.cast("string"))
        out = out.withColumn("variacao_yoy_pct", F.when(
            F.expr(out_of_range("variacao_yoy_pct")), F.raise_error(message).cast(f"decimal({p},{s})")).otherwise(yoy.cast(f"decimal({p},{s})")))
    return out


def write_jdbc(df: DataFrame, url: str, table: str, years: list[int] | None = None,
               properties: dict[str, str] | None = None) -> int:
    """Optional database target: replace-all (truncate + insert) in batches of 500 rows.

    Replacing only some years needs a DELETE, which the JDBC writer does not issue, so
    ``years`` is refused rather than appended as duplicates; publish the Parquet tables
    (which do replace by year) and load them whole. Not run by the tests: no database is
    reachable here."""
    if years is not None:
        raise ValueError("replace-by-year is not available over JDBC; load the whole table")
    obs = Observation()
    out = to_sink_types(df).observe(obs, F.count(F.lit(1)).alias("rows"))
    props = {"batchsize": str(C.SINK_BATCH_SIZE), **(properties or {})}
    out.write.format("jdbc").option("url", url).option("dbtable", table).options(**props) \
        .option("truncate", "true").mode("overwrite").save()
    return int(obs.get.get("rows", 0))


def check_keys(df: DataFrame, name: str) -> DataFrame:
    """Duplicate keys and null keys of one KPI table as one row."""
    per_key = df.groupBy(*KPI_KEYS[name]).agg(F.count(F.lit(1)).alias("n")).withColumn("nulo", F.expr(any_key_null(name)))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("linhas"),
        F.count(F.when(F.col("n") > 1, 1)).cast("long").alias("chaves_duplicadas"),
        F.coalesce(F.sum(F.when(F.col("nulo"), F.col("n"))), F.lit(0)).cast("long").alias("chaves_nulas"),
    ).select(F.lit(name).alias("tabela"), "*")
