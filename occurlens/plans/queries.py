"""Named queries: name -> (Spark callable(spark, sf_dir), oracle SQL or None).

Every query reads the benchmark tables (through the ``raw`` fixture) over
their whole extent; nothing is sampled or capped except where a top-k is
the feature itself.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C
from .. import oracle as O
from ..operators import clean as CL
from ..operators import kpis as K
from ..session import case_sensitive
from ..sources.fixture import raw_from_tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.clean(raw_from_tables(spark, sf_dir))


# ---------------------------------------------------------------------------
# KPI tables
# ---------------------------------------------------------------------------

def _kpi_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return K.kpi(_clean(spark, sf_dir), name)
    run.__name__ = name
    return run


for _name in K.KPI_FUNCTIONS:
    REGISTRY[_name] = (_kpi_query(_name), O.with_raw(O.KPI_SQL[_name]))


# ---------------------------------------------------------------------------
# Cleaning rules, one query each (row level, over every raw row)
# ---------------------------------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from .. import functions as FN  # noqa: E402
from ..operators import views as V  # noqa: E402


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_tables(spark, sf_dir)


@register("clean_casts", O.with_raw(
    f"select {O.tolerant_int('ANO_BO')} as ano_bo, {O.tolerant_int('NUM_BO')} as num_bo,"
    f" {O.tolerant_int('MES')} as mes, {O.tolerant_int('ANO')} as ano,"
    f" {O.tolerant_double('LATITUDE')} as latitude, {O.tolerant_double('LONGITUDE')} as longitude"
    f" from raw", clean=False))
def clean_casts(spark, sf_dir):
    t = CL.typed_columns()
    return _raw(spark, sf_dir).select(*[t[c].alias(c) for c in
                                        ("ano_bo", "num_bo", "mes", "ano", "latitude", "longitude")])


@register("clean_valid_dates", O.with_raw(f"select * from raw where {O.date_filter('compat')}", clean=False))
def clean_valid_dates(spark, sf_dir):
    return CL.filter_valid_dates(_raw(spark, sf_dir), "compat")


@register("clean_valid_dates_parsed",
          O.with_raw(f"select * from raw where {O.date_filter('parsed')}", clean=False))
def clean_valid_dates_parsed(spark, sf_dir):
    return CL.filter_valid_dates(_raw(spark, sf_dir), "parsed")


@register("clean_consummated", O.with_raw(
    f"select NUM_BO, FLAG_STATUS from raw where upper({O.clean_text('FLAG_STATUS')}) = 'CONSUMADO'",
    clean=False))
def clean_consummated(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.filter(CL.is_consummated(FN.clean_text("FLAG_STATUS"))).select("NUM_BO", "FLAG_STATUS")


@register("clean_one_year", O.with_raw("select * from clean", year=1998))
def clean_one_year(spark, sf_dir):
    return CL.clean(_raw(spark, sf_dir), years=1998)


@register("clean_full", O.with_raw("select * from clean"))
def clean_full(spark, sf_dir):
    return _clean(spark, sf_dir)


@register("clean_parsed_dates", O.with_raw("select * from clean", date_mode="parsed"))
def clean_parsed_dates(spark, sf_dir):
    return CL.clean(_raw(spark, sf_dir), date_mode="parsed")


@register("clean_strings", O.with_raw(
    "select " + ", ".join(f"{O.clean_text(c)} as {c}" for c in C.TEXT_COLUMNS) + " from raw", clean=False))
def clean_strings(spark, sf_dir):
    t = CL.text_columns()
    return _raw(spark, sf_dir).select(*[t[c].alias(c) for c in C.TEXT_COLUMNS])


@register("clean_hour", O.with_raw(
    f"select HORA_OCORRENCIA, {O.parse_hour('HORA_OCORRENCIA')} as hora from raw", clean=False))
def clean_hour(spark, sf_dir):
    return _raw(spark, sf_dir).select("HORA_OCORRENCIA", FN.parse_hour("HORA_OCORRENCIA").alias("hora"))


@register("clean_dates", O.with_raw(
    f"select DATA_OCORRENCIA_BO, {O.parse_date('DATA_OCORRENCIA_BO')} as data_ocorrencia from raw",
    clean=False))
def clean_dates(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "DATA_OCORRENCIA_BO", FN.parse_date("DATA_OCORRENCIA_BO").alias("data_ocorrencia"))


@register("derive_tipo_crime", O.with_raw(
    f"select RUBRICA, {O.crime_type(O.clean_text('RUBRICA'))} as tipo_crime from raw", clean=False))
def derive_tipo_crime(spark, sf_dir):
    return _raw(spark, sf_dir).select("RUBRICA", FN.crime_type(FN.clean_text("RUBRICA")).alias("tipo_crime"))


@register("derive_brand", O.with_raw(
    f"select MARCA_OBJETO, {O.brand(O.clean_text('MARCA_OBJETO'))} as marca from raw", clean=False))
def derive_brand(spark, sf_dir):
    return _raw(spark, sf_dir).select("MARCA_OBJETO", FN.brand(FN.clean_text("MARCA_OBJETO")).alias("marca"))


@register("normalize_bairro", O.with_raw(
    f"select BAIRRO, {O.normalize_bairro(O.clean_text('BAIRRO'))} as bairro from raw", clean=False))
def normalize_bairro(spark, sf_dir):
    """Its two columns differ in case only, so it runs in a session that tells them apart:
    elsewhere the rows could be collected but not stored."""
    return _raw(case_sensitive(spark), sf_dir).select("BAIRRO", FN.normalize_bairro(FN.clean_text("BAIRRO")).alias("bairro"))


@register("derive_period", O.with_raw(
    f"select hora, {O.period('hora')} as periodo from (select {O.parse_hour('HORA_OCORRENCIA')} as hora"
    f" from raw)", clean=False))
def derive_period(spark, sf_dir):
    hora = _raw(spark, sf_dir).select(FN.parse_hour("HORA_OCORRENCIA").alias("hora"))
    return hora.select("hora", FN.period("hora").alias("periodo"))


# ---------------------------------------------------------------------------
# Dashboard views over the KPI tables
# ---------------------------------------------------------------------------

def _kpi_tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    clean = _clean(spark, sf_dir)
    return [K.kpi(clean, n) for n in names]


_YOY_SQL = (
    "select ano, tipo_crime, total, case when prev is not null and prev <> 0"
    " then (total - prev) / prev * 100 end as variacao_yoy_pct from (select ano, tipo_crime, total,"
    " lag(total) over (partition by tipo_crime order by ano nulls first) as prev"
    " from kpi_annual_summary)")


def _cards_ctes(where: str = "true", ano: int | None = None) -> list[tuple[str, str]]:
    ref = f"{ano}" if ano is not None else "(select max(ano) from py where ano <> 0)"
    return [
        ("y", _YOY_SQL),
        ("d", f"select * from y where {where}"),
        ("py", "select ano, sum(total) as t, sum(case when tipo_crime = 'Furto' then total end) as f,"
               " sum(case when tipo_crime = 'Roubo' then total end) as r,"
               " list_reduce(list_sort(list(coalesce(variacao_yoy_pct, 0))), lambda a, b: a + b) / count(*)"
               " as yy from d group by ano"),
        ("c", "select cast(coalesce(sum(t), 0) as bigint) as total, cast(coalesce(sum(f), 0) as bigint) as furtos,"
              f" cast(coalesce(sum(r), 0) as bigint) as roubos, (select max(yy) from py where ano = {ref})"
              " as variacao_yoy_media from py"),
    ]


_CARDS_BODY = ("select *, case when variacao_yoy_media is null then null when variacao_yoy_media > 0"
               " then 'up' else 'down' end as direcao from c")


def _kpi_body(body: str, *tables: str, extra: list[tuple[str, str]] | None = None) -> str:
    return O.with_raw(body, [(t, O.KPI_SQL[t]) for t in tables] + (extra or []))


@register("view_cards", _kpi_body(_CARDS_BODY, C.KPI_ANNUAL, extra=_cards_ctes()))
def view_cards(spark, sf_dir):
    (annual,) = _kpi_tables(spark, sf_dir, C.KPI_ANNUAL)
    return V.cards(annual)


@register("view_filtered", _kpi_body(_CARDS_BODY, C.KPI_ANNUAL,
                                    extra=_cards_ctes("ano = 1998 and tipo_crime = 'Furto'", 1998)))
def view_filtered(spark, sf_dir):
    """Drill-down: clicking a year bar and the theft slice filters the cards."""
    (annual,) = _kpi_tables(spark, sf_dir, C.KPI_ANNUAL)
    return V.cards(annual, ano=1998, tipo=C.CRIME_THEFT)


def _thousands_sql(x: str) -> str:
    return f"replace(format('{{:,}}', cast({x} as bigint)), ',', '.')"


@register("view_cards_text", _kpi_body(
    f"select {_thousands_sql('total')} as total_txt, {_thousands_sql('furtos')} as furtos_txt,"
    f" {_thousands_sql('roubos')} as roubos_txt,"
    " case when variacao_yoy_media is null then '—' else (case when variacao_yoy_media > 0 then '+' else '' end)"
    " || printf('%.1f', variacao_yoy_media) || '%' end as variacao_txt, direcao from (" + _CARDS_BODY + ")",
    C.KPI_ANNUAL, extra=_cards_ctes()))
def view_cards_text(spark, sf_dir):
    (annual,) = _kpi_tables(spark, sf_dir, C.KPI_ANNUAL)
    return V.cards_text(V.cards(annual))


@register("clean_with_municipality", O.with_raw("select * from clean where municipio is not null"))
def clean_with_municipality(spark, sf_dir):
    return CL.clean(_raw(spark, sf_dir), require_municipality=True)


@register("view_yoy", _kpi_body(_YOY_SQL, C.KPI_ANNUAL))
def view_yoy(spark, sf_dir):
    (annual,) = _kpi_tables(spark, sf_dir, C.KPI_ANNUAL)
    return V.yoy_recomputed(annual)


@register("view_annual_pivot", _kpi_body(
    "select ano, cast(coalesce(sum(case when tipo_crime = 'Furto' then total end), 0) as bigint) as furto,"
    " cast(coalesce(sum(case when tipo_crime = 'Roubo' then total end), 0) as bigint) as roubo"
    " from kpi_annual_summary group by ano", C.KPI_ANNUAL))
def view_annual_pivot(spark, sf_dir):
    (annual,) = _kpi_tables(spark, sf_dir, C.KPI_ANNUAL)
    return V.annual_pivot(annual)


_MONTH_LABELS_SQL = "[" + ", ".join(f"'{m}'" for m in C.MONTH_LABELS) + "]"


@register("view_monthly", _kpi_body(
    f"select cast(m.mes as integer) as mes, {_MONTH_LABELS_SQL}[m.mes] as mes_rotulo,"
    " cast(coalesce(sum(k.total), 0) as bigint) as total"
    " from (select range as mes from range(1, 13)) m left join kpi_monthly k"
    " on coalesce(nullif(k.mes, 0), 1) = m.mes group by m.mes", C.KPI_MONTHLY))
def view_monthly(spark, sf_dir):
    (monthly,) = _kpi_tables(spark, sf_dir, C.KPI_MONTHLY)
    return V.monthly(monthly)


@register("view_hourly", _kpi_body(
    "select cast(h.hora as integer) as hora, lpad(cast(h.hora as varchar), 2, '0') || 'h' as rotulo,"
    " case when h.hora < 6 then 'Madrugada' when h.hora < 12 then 'Manhã' when h.hora < 18 then 'Tarde'"
    " else 'Noite' end as faixa, cast(coalesce(sum(k.total), 0) as bigint) as total"
    " from (select range as hora from range(24)) h left join kpi_by_hour k on k.hora = h.hora"
    " group by h.hora", C.KPI_HOUR))
def view_hourly(spark, sf_dir):
    (hour,) = _kpi_tables(spark, sf_dir, C.KPI_HOUR)
    return V.hourly(hour)


def _top_sql(table: str, key: str, k: int) -> str:
    return (f"select {key}, cast(sum(total) as bigint) as total from {table} group by {key}"
            f" order by total desc, {key} asc nulls first limit {k}")


def _uncut_body(body: str, table: str) -> str:
    """``body`` over every counted row of a table, before its cut per year and type."""
    return O.with_raw(body, [(table, O.UNCUT_SQL[table])])


@register("view_top_brands", _uncut_body(_top_sql(C.KPI_BRAND, "marca", C.VIEW_TOP_BRANDS), C.KPI_BRAND))
def view_top_brands(spark, sf_dir):
    return V.top_brands(K.brand_counts(_clean(spark, sf_dir)))


@register("view_top_3_brands", _uncut_body(_top_sql(C.KPI_BRAND, "marca", 3), C.KPI_BRAND))
def view_top_3_brands(spark, sf_dir):
    return V.top_brands(K.brand_counts(_clean(spark, sf_dir)), k=3)


@register("kpi_by_brand_top_3", O.with_raw(O.top_sql(O.UNCUT_SQL[C.KPI_BRAND], 3)))
def kpi_by_brand_top_3(spark, sf_dir):
    """The brand cut with a limit that binds (there are 14 labels; the table keeps 15)."""
    return K.kpi_by_brand(_clean(spark, sf_dir), n=3).select(*K.KPI_COLUMNS[C.KPI_BRAND])


@register("view_top_locations", _kpi_body(
    _top_sql(C.KPI_LOCATION, "tipo_local", C.VIEW_TOP_LOCATIONS), C.KPI_LOCATION))
def view_top_locations(spark, sf_dir):
    (loc,) = _kpi_tables(spark, sf_dir, C.KPI_LOCATION)
    return V.top_locations(loc)


def _ranking_sql(table: str, key: str, k: int) -> str:
    return (f"select row_number() over (order by total desc, {key} asc nulls first) as posicao, {key}, total,"
            f" round(total / coalesce(nullif(max(total) over (), 0), 1) * 100, 1) as pct_max"
            f" from ({_top_sql(table, key, k)})")


@register("view_municipality_ranking", _uncut_body(
    _ranking_sql(C.KPI_MUNICIPALITY, "municipio", C.VIEW_TOP_MUNICIPALITIES), C.KPI_MUNICIPALITY))
def view_municipality_ranking(spark, sf_dir):
    return V.municipality_ranking(K.municipality_counts(_clean(spark, sf_dir)))


@register("view_bairro_ranking", _uncut_body(
    _ranking_sql(C.KPI_BAIRRO, "bairro", C.VIEW_TOP_BAIRROS), C.KPI_BAIRRO))
def view_bairro_ranking(spark, sf_dir):
    return V.bairro_ranking(K.bairro_counts(_clean(spark, sf_dir)))


@register("view_type_split", _kpi_body(
    "select furtos, roubos, furtos + roubos as total,"
    " round(furtos / nullif(furtos + roubos, 0) * 100, 1) as pct_furto,"
    " round(roubos / nullif(furtos + roubos, 0) * 100, 1) as pct_roubo from ("
    " select cast(coalesce(sum(case when tipo_crime = 'Furto' then total end), 0) as bigint) as furtos,"
    " cast(coalesce(sum(case when tipo_crime = 'Roubo' then total end), 0) as bigint) as roubos"
    " from kpi_annual_summary)", C.KPI_ANNUAL))
def view_type_split(spark, sf_dir):
    (annual,) = _kpi_tables(spark, sf_dir, C.KPI_ANNUAL)
    return V.type_split(annual)


@register("view_total_compat", _kpi_body(
    "select ano, periodo, tipo_crime, cast(coalesce(nullif(total, 0), 0) as bigint) as total"
    " from kpi_by_period", C.KPI_PERIOD))
def view_total_compat(spark, sf_dir):
    (period_kpi,) = _kpi_tables(spark, sf_dir, C.KPI_PERIOD)
    return V.with_total(period_kpi)


@register("view_total_compat_ocorrencias", _kpi_body(
    "select ano, periodo, tipo_crime, cast(total as bigint) as total_ocorrencias, cast(total as bigint) as total"
    " from kpi_by_period", C.KPI_PERIOD))
def view_total_compat_ocorrencias(spark, sf_dir):
    """The other spelling of the count column."""
    (period_kpi,) = _kpi_tables(spark, sf_dir, C.KPI_PERIOD)
    return V.with_total(period_kpi.withColumnRenamed("total", "total_ocorrencias"))


@register("view_cards_untyped", O.with_raw(
    "select cast(sum(total) as bigint) as total, cast(0 as bigint) as furtos, cast(0 as bigint) as roubos,"
    " max_by(yoy, ano) as variacao_yoy_media, case when max_by(yoy, ano) > 0 then 'up' else 'down' end as direcao"
    " from (select ano, total, coalesce((total - lag(total) over (order by ano nulls first))"
    " / lag(total) over (order by ano nulls first) * 100, 0) as yoy"
    " from (select ano, count(*) as total from clean group by ano))"))
def view_cards_untyped(spark, sf_dir):
    """Cards over the per-year shape without a crime type."""
    annual = _clean(spark, sf_dir).groupBy("ano").agg(F.count(F.lit(1)).alias("total_ocorrencias"))
    return V.cards(annual)


@register("dim_years", _kpi_body("select distinct ano from kpi_annual_summary", C.KPI_ANNUAL))
def dim_years(spark, sf_dir):
    (annual,) = _kpi_tables(spark, sf_dir, C.KPI_ANNUAL)
    return V.years(annual)


@register("dim_bairros", _uncut_body("select distinct bairro from kpi_by_bairro", C.KPI_BAIRRO))
def dim_bairros(spark, sf_dir):
    return V.bairros(K.bairro_counts(_clean(spark, sf_dir)))


@register("meta_period", _kpi_body(
    "select max(ano) as ultimo_ano, '{0}' || cast(max(ano) as varchar) || '{1}' as rotulo"
    " from kpi_annual_summary".format(*C.COVERAGE_LABEL.format(first=C.FIRST_YEAR_LABEL, last="\0").split("\0")),
    C.KPI_ANNUAL))
def meta_period(spark, sf_dir):
    (annual,) = _kpi_tables(spark, sf_dir, C.KPI_ANNUAL)
    return V.period_covered(annual)


# ---------------------------------------------------------------------------
# Sources on files (written by Spark from the tables, then read back)
# ---------------------------------------------------------------------------

from ..operators import extras as X  # noqa: E402
from ..operators import quality as QY  # noqa: E402
from ..schema import KPI_KEYS, RAW_COLUMNS  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sinks import tables as SK  # noqa: E402
from ..sources import files as SF  # noqa: E402
from ..sources.fixture import BLANK_YEAR_FILE, raw_blank_year  # noqa: E402
from . import pipeline as PL  # noqa: E402

_EXPORT_GLOB = "part-*"


def _exported(spark: SparkSession, sf_dir: str) -> str:
    """Yearly source files under ``ARQUIVO_ORIGEM=<origin>`` folders; the
    blank-year origin is written without its ANO and MES columns."""
    root = scratch_path(spark, "source-files")
    return SF.export_source_files(_raw(spark, sf_dir), root, drop={BLANK_YEAR_FILE: ["ANO", "MES"]})


_DERIVED_SQL = ", ".join(
    f"case when f.blank then coalesce(cast({fn}({O.parse_date('r.DATA_OCORRENCIA_BO')}) as varchar), '')"
    f" else r.{c} end as {c}" if c in ("ANO", "MES") else f"r.{c}"
    for c, fn in [(c, {"ANO": "year", "MES": "month"}.get(c)) for c in RAW_COLUMNS])
_DERIVED_CTES = [("flags", "select ARQUIVO_ORIGEM, bool_and(ANO = '') as blank from raw0 group by 1")]
_DERIVED_BODY = f"select {_DERIVED_SQL} from raw0 r left join flags f using (ARQUIVO_ORIGEM)"


@register("raw_ingest", O.with_raw_blank_year(_DERIVED_BODY, _DERIVED_CTES))
def raw_ingest(spark, sf_dir):
    return SF.read_occurrence_files(spark, _exported(spark, sf_dir), _EXPORT_GLOB)


@register("raw_projection", O.with_raw_blank_year("select * from raw0"))
def raw_projection(spark, sf_dir):
    return SF.read_occurrence_files(spark, _exported(spark, sf_dir), _EXPORT_GLOB, derive_year=False)


@register("raw_derive_year_month", O.with_raw_blank_year(_DERIVED_BODY, _DERIVED_CTES))
def raw_derive_year_month(spark, sf_dir):
    return SF.derive_year_month(raw_blank_year(_raw(spark, sf_dir)))


@register("schema_drift", O.with_raw(
    f"select distinct ARQUIVO_ORIGEM as arquivo, 'MES,ANO' as colunas_ausentes from raw"
    f" where ARQUIVO_ORIGEM = '{BLANK_YEAR_FILE}'", clean=False))
def schema_drift(spark, sf_dir):
    return SF.schema_drift(spark, _exported(spark, sf_dir), _EXPORT_GLOB)


RETYPED_FILE = "f_1998"


@register("schema_drift_parquet", O.with_raw(
    f"select distinct ARQUIVO_ORIGEM as arquivo, case when ARQUIVO_ORIGEM = '{BLANK_YEAR_FILE}' then 'MES,ANO' else '' end as colunas_ausentes,"
    f" case when ARQUIVO_ORIGEM = '{RETYPED_FILE}' then 'NUM_BO:bigint' else '' end as colunas_de_outro_tipo"
    f" from raw where ARQUIVO_ORIGEM in ('{BLANK_YEAR_FILE}', '{RETYPED_FILE}')", clean=False))
def schema_drift_parquet(spark, sf_dir):
    """Parquet files: one origin lacks two columns, one has a column of another type."""
    raw, root = _raw(spark, sf_dir), scratch_path(spark, "source-files")
    retyped = F.col(C.LINEAGE_COLUMN) == RETYPED_FILE
    SF.export_source_files(raw.filter(~retyped), root, drop={BLANK_YEAR_FILE: ["ANO", "MES"]}, fmt="parquet")
    SF.export_source_files(raw.filter(retyped).withColumn("NUM_BO", F.col("NUM_BO").cast("long")), root, fmt="parquet")
    return SF.schema_drift_columnar(spark, root, _EXPORT_GLOB)


@register("raw_incremental", O.with_raw_blank_year(
    f"select * replace (try_cast(ANO as integer) as ANO) from ({_DERIVED_BODY})", _DERIVED_CTES))
def raw_incremental(spark, sf_dir):
    """Files of which one holds half its rows, then that file whole: the second ingest reads it alone,
    and raw equals all files read at once."""
    raw, layout = _raw(spark, sf_dir), PL.Layout(scratch_path(spark, "pipeline"))
    changed, drop = F.col(C.LINEAGE_COLUMN) == RETYPED_FILE, {BLANK_YEAR_FILE: ["ANO", "MES"]}
    half = F.pmod(F.col("NUM_BO").cast("long"), F.lit(2)) == 0
    root = SF.export_source_files(raw.filter(~changed | half), scratch_path(spark, "source-files"), drop=drop)
    PL.ingest_files(spark, layout, root, file_glob=_EXPORT_GLOB)
    (raw.filter(changed).drop(C.LINEAGE_COLUMN).write.mode("overwrite").options(**SF.CSV_OPTIONS)
     .csv(f"{root}/{C.LINEAGE_COLUMN}={RETYPED_FILE}"))
    PL.ingest_files(spark, layout, root, file_glob=_EXPORT_GLOB)
    return PL.read_raw(spark, layout).select(*RAW_COLUMNS)


# ---------------------------------------------------------------------------
# Pipeline, sinks, refresh
# ---------------------------------------------------------------------------

def _keyed(t: str) -> str:
    return " and ".join(f"{k} is not null" for k in KPI_KEYS[t])


@register("load_report", _kpi_body(" union all ".join(
    f"select '{t}' as tabela, count(*) filter ({_keyed(t)}) as linhas, case when bool_and({_keyed(t)}) then 'OK'"
    f" else 'OK (' || count(*) filter (not ({_keyed(t)})) || ' sem chave)' end as status from {t}"
    for t in K.KPI_FUNCTIONS), *K.KPI_FUNCTIONS))
def load_report(spark, sf_dir):
    layout = PL.Layout(scratch_path(spark, "pipeline"))
    report = PL.run_pipeline(spark, layout, _raw(spark, sf_dir))
    return SK.load_report(spark, report.loads)


SLICE_BYTES, MAX_SLICES = 1 << 30, 64


def _slices(df: DataFrame) -> int:
    """Slices of about SLICE_BYTES of the files that ``df`` reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return min(MAX_SLICES, max(1, -(-size // SLICE_BYTES)))


def _stored(raw: DataFrame) -> DataFrame:
    """``raw`` written once: its uses read it instead of joining the large tables each time. Large
    tables are joined slice after slice of the reports' numbers (the filter reaches the scans that
    have the number), so the disk holds the shuffled rows of one slice, not of all."""
    path, n = scratch_path(raw.sparkSession, "raw"), _slices(raw)
    for i in range(n):
        mine = raw.filter(F.pmod(F.xxhash64("NUM_BO"), F.lit(n)) == i) if n > 1 else raw
        SK.write_partitioned(mine, path, mode="append")
    return raw.sparkSession.read.schema(raw.schema).parquet(path)


_DIMENSION = {t: next((k for k in keys if k not in ("ano", "tipo_crime")), None) for t, keys in KPI_KEYS.items()}


def _all_tables(kpis: dict[str, DataFrame]) -> DataFrame:
    """The eight tables in one long form."""
    parts = [df.select(F.lit(t).alias("tabela"), "ano",
                       (F.col(_DIMENSION[t]).cast("string") if _DIMENSION[t] else F.lit(None).cast("string")).alias("chave"),
                       "tipo_crime", "total",
                       (F.col("variacao_yoy_pct") if t == C.KPI_ANNUAL else F.lit(None).cast("double")).alias("variacao_yoy_pct"))
             for t, df in kpis.items()]
    return reduce(DataFrame.unionByName, parts)


_ALL_TABLES_SQL = " union all ".join(
    f"select '{t}' as tabela, ano, {f'cast({d} as varchar)' if d else 'cast(null as varchar)'} as chave, tipo_crime, total,"
    f" {'variacao_yoy_pct' if t == C.KPI_ANNUAL else 'cast(null as double) as variacao_yoy_pct'} from {t} where {_keyed(t)}"
    for t, d in _DIMENSION.items())


@register("kpi_refresh_year", _kpi_body(_ALL_TABLES_SQL, *K.KPI_FUNCTIONS))
def kpi_refresh_year(spark, sf_dir):
    """A full run over changed data (half of 1998 missing, 1999 missing, a year 2050 that raw
    will not have), then raw as it is and a refresh of 1998 and 1999: all eight published tables
    must equal a full computation."""
    raw, year = _stored(_raw(spark, sf_dir)), F.col("ANO")
    layout = PL.Layout(scratch_path(spark, "pipeline"))
    old = raw.filter((year != "1999") & ~((year == "1998") & (F.pmod(F.col("NUM_BO").cast("long"), F.lit(2)) == 0)))
    PL.run_pipeline(spark, layout, old.withColumn("ANO", F.when(year == "1996", "2050").otherwise(year))
                    .unionByName(old.filter(year == "1996")))
    PL.ingest(raw, layout)
    PL.refresh_years(spark, layout, [1998, 1999])
    return _all_tables(SK.read_kpis(spark, layout.root))


@register("discover_years", O.with_raw(
    f"select distinct {O.tolerant_int('ANO')} as ano from raw where {O.tolerant_int('ANO')} is not null",
    clean=False))
def discover_years(spark, sf_dir):
    layout = PL.Layout(scratch_path(spark, "pipeline"))
    PL.ingest(_raw(spark, sf_dir), layout)
    return PL.discover_years(spark, layout)


@register("null_out_nan", _kpi_body(
    "select ano, tipo_crime, total, case when tipo_crime <> 'Outros' then cast(variacao_yoy_pct as decimal(6,2)) end"
    " as variacao_yoy_pct from kpi_annual_summary", C.KPI_ANNUAL))
def null_out_nan(spark, sf_dir):
    """Sink types; the changes of one crime type are NaN here, so the rule is exercised."""
    (annual,) = _kpi_tables(spark, sf_dir, C.KPI_ANNUAL)
    nan = F.when(F.col("tipo_crime") == C.CRIME_OTHER, F.lit(float("nan"))).otherwise(F.col("variacao_yoy_pct"))
    return SK.to_sink_types(annual.withColumn("variacao_yoy_pct", nan))


@register("hour_grid", O.with_raw(
    "select ano, tipo_crime, hora from (select distinct ano, tipo_crime from clean)"
    " cross join (select cast(range as integer) as hora from range(24))"))
def hour_grid(spark, sf_dir):
    pairs = _clean(spark, sf_dir).select("ano", "tipo_crime").distinct()
    return pairs.select("ano", "tipo_crime", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hora"))


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------

_DATE_OK = O.date_filter("compat")
_CONS = f"upper({O.clean_text('FLAG_STATUS')}) = 'CONSUMADO'"


@register("clean_quality", O.with_raw(
    f"select count(*) as linhas_brutas, count_if({_DATE_OK}) as linhas_validas,"
    f" count_if({_DATE_OK} and {_CONS}) as linhas_limpas,"
    f" case when count(*) > 0 then round(count_if({_DATE_OK} and {_CONS}) / count(*) * 100, 1) else 0.0 end"
    f" as pct_retido from raw", clean=False))
def clean_quality(spark, sf_dir):
    return QY.clean_quality(_raw(spark, sf_dir))


@register("dist_tipo_crime", O.with_raw("select tipo_crime, count(*) as total from clean group by 1"))
def dist_tipo_crime(spark, sf_dir):
    return QY.dist_tipo_crime(_clean(spark, sf_dir))


@register("dist_top_brands", O.with_raw(
    "select marca, count(*) as total from clean group by 1 order by total desc, marca asc nulls first limit 10"))
def dist_top_brands(spark, sf_dir):
    return QY.dist_top_brands(_clean(spark, sf_dir))


def _integrity_sql() -> str:
    parts = []
    for t, keys in KPI_KEYS.items():
        anynull = " or ".join(f"{k} is null" for k in keys)
        parts.append(
            f"select '{t}' as tabela, cast(coalesce(sum(n), 0) as bigint) as linhas,"
            f" cast(count(*) filter (where n > 1) as bigint) as chaves_duplicadas,"
            f" cast(coalesce(sum(case when nulo then n end), 0) as bigint) as chaves_nulas"
            f" from (select {', '.join(keys)}, count(*) as n, bool_or({anynull}) as nulo from {t}"
            f" group by {', '.join(keys)})")
    return " union all ".join(parts)


@register("kpi_integrity", _kpi_body(_integrity_sql(), *K.KPI_FUNCTIONS))
def kpi_integrity(spark, sf_dir):
    return QY.kpi_integrity(K.compute_kpis(_clean(spark, sf_dir)))


def _reconcile_sql() -> str:
    per = O.period("h.hora")
    rows = [
        "select 'anual_soma_igual_linhas_limpas' as verificacao, (select count(*) from clean) as esperado,"
        f" (select coalesce(sum(total), 0) from {C.KPI_ANNUAL}) as obtido",
    ]
    for t in (C.KPI_MONTHLY, C.KPI_PERIOD):
        rows.append(
            f"select '{t}_nao_excede_anual', 0, (select count(*) from (select ano, tipo_crime, sum(total) as p"
            f" from {t} group by all) m left join (select ano, tipo_crime, sum(total) as a"
            f" from {C.KPI_ANNUAL} group by all) a on m.ano is not distinct from a.ano and m.tipo_crime = a.tipo_crime"
            f" where m.p > coalesce(a.a, 0))")
    rows.append(
        "select 'periodo_igual_horas_agrupadas', 0, (select count(*) from"
        f" (select h.ano, {per} as periodo, h.tipo_crime, sum(h.total) as s from {C.KPI_HOUR} h"
        f"  where h.ano is not null group by all) r full join (select * from {C.KPI_PERIOD}"
        "  where ano is not null) p on r.ano = p.ano and r.periodo = p.periodo and r.tipo_crime = p.tipo_crime"
        " where coalesce(r.s, 0) <> coalesce(p.total, 0))")
    rows.append(
        f"select 'horas_24_por_grupo', (select 24 * count(*) from (select distinct ano, tipo_crime"
        f" from {C.KPI_HOUR})), (select count(*) from {C.KPI_HOUR})")
    body = " union all ".join(rows)
    return (f"select verificacao, cast(esperado as bigint) as esperado, cast(obtido as bigint) as obtido,"
            f" cast(esperado as bigint) = cast(obtido as bigint) as ok from ({body})")


@register("kpi_reconcile", _kpi_body(_reconcile_sql(), *K.KPI_FUNCTIONS))
def kpi_reconcile(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    return QY.kpi_reconcile(clean, K.compute_kpis(clean))


# ---------------------------------------------------------------------------
# Specified extras
# ---------------------------------------------------------------------------

@register("annual_share", O.with_raw(
    "select ano, count(*) as total_ocorrencias, count_if(tipo_crime = 'Furto') as total_furtos,"
    " count_if(tipo_crime = 'Roubo') as total_roubos,"
    " round(count_if(tipo_crime = 'Roubo') / count(*) * 100, 2) as pct_roubo from clean group by ano"))
def annual_share(spark, sf_dir):
    return X.annual_share(_clean(spark, sf_dir))


@register("peak_hour", _kpi_body(
    "select ano, hora as hora_pico, total from (select ano, hora, cast(sum(total) as bigint) as total,"
    " row_number() over (partition by ano order by sum(total) desc, hora asc) as rn from kpi_by_hour"
    " group by ano, hora) where rn = 1", C.KPI_HOUR))
def peak_hour(spark, sf_dir):
    (hour,) = _kpi_tables(spark, sf_dir, C.KPI_HOUR)
    return X.peak_hour(hour)


@register("status_split", O.with_raw(
    f"select {O.tolerant_int('ANO')} as ano, upper({O.clean_text('FLAG_STATUS')}) as status, count(*) as total"
    f" from raw where {_DATE_OK} group by all", clean=False))
def status_split(spark, sf_dir):
    return X.status_split(_raw(spark, sf_dir))


def _topn_sql() -> str:
    keep = {"marca": "marca <> 'Outras'",
            "tipo_local": "tipo_local is not null and upper(tipo_local) <> 'NAO INFORMADO'",
            "municipio": "municipio is not null",
            "bairro": "municipio = 'S.PAULO' and bairro is not null and upper(bairro) <> 'NAO INFORMADO'"}
    parts = []
    for dim, n in X.TOPN_PER_YEAR:
        parts.append(
            f"select ano, '{dim}' as dimensao, cast({dim} as varchar) as valor, total, cast(posicao as integer)"
            f" as posicao from (select ano, {dim}, count(*) as total, rank() over (partition by ano"
            f" order by count(*) desc) as posicao from clean where {keep[dim]} group by ano, {dim})"
            f" where posicao <= {n}")
    return " union all ".join(parts)


@register("topn_per_year", O.with_raw(_topn_sql()))
def topn_per_year(spark, sf_dir):
    return X.topn_per_year(_clean(spark, sf_dir))


@register("brand_evolution", O.with_raw(
    "select ano, marca, total, cast(posicao as integer) as posicao,"
    " cast(lag(posicao) over (partition by marca order by ano nulls first) as integer) as posicao_anterior,"
    " cast(lag(posicao) over (partition by marca order by ano nulls first) - posicao as integer)"
    " as variacao_posicao from (select ano, marca, count(*) as total,"
    " rank() over (partition by ano order by count(*) desc) as posicao from clean where marca <> 'Outras'"
    " group by ano, marca)"))
def brand_evolution(spark, sf_dir):
    return X.brand_evolution(_clean(spark, sf_dir))


@register("municipality_history", O.with_raw(
    "select b.municipio, b.ano, b.total,"
    " lag(b.total) over (partition by b.municipio order by b.ano nulls first) as total_anterior,"
    " round((b.total - lag(b.total) over (partition by b.municipio order by b.ano nulls first))"
    " / lag(b.total) over (partition by b.municipio order by b.ano nulls first) * 100, 2) as variacao_yoy_pct,"
    " s.serie from base b join (select municipio, string_agg(cast(ano as varchar) || ':' || cast(total as varchar),"
    " ',' order by ano nulls first) as serie from base group by municipio) s on b.municipio = s.municipio",
    [("base", "select municipio, ano, count(*) as total from clean where municipio is not null group by all")]))
def municipality_history(spark, sf_dir):
    return X.municipality_history(_clean(spark, sf_dir))


@register("brand_rare_fold", O.with_raw(
    "select f.ano, case when p.n < 10 then 'Outras' else f.marca end as marca, f.tipo_crime,"
    " cast(sum(f.total) as bigint) as total from fine f left join pb p on f.ano = p.ano and f.marca = p.marca"
    " group by all",
    [("fine", "select ano, marca, tipo_crime, count(*) as total from clean group by all"),
     ("pb", "select ano, marca, sum(total) as n from fine group by all")]))
def brand_rare_fold(spark, sf_dir):
    return X.brand_rare_fold(_clean(spark, sf_dir))


_COORDS_OK = "latitude is not null and longitude is not null and latitude <> 0 and longitude <> 0"


@register("geo_points", O.with_raw(f"select ano, tipo_crime, latitude, longitude from clean where {_COORDS_OK}"))
def geo_points(spark, sf_dir):
    return X.geo_points(_clean(spark, sf_dir))


@register("geo_heat", O.with_raw(
    f"select ano, round(latitude, 2) as lat, round(longitude, 2) as lon, count(*) as total from clean"
    f" where {_COORDS_OK} group by all"))
def geo_heat(spark, sf_dir):
    return X.geo_heat(_clean(spark, sf_dir))


@register("period_share", _kpi_body(
    "select ano, periodo, cast(sum(total) as bigint) as total,"
    " round(sum(total) / sum(sum(total)) over (partition by ano) * 100, 2) as pct from kpi_by_period"
    " group by ano, periodo",
    C.KPI_PERIOD))
def period_share(spark, sf_dir):
    (period_kpi,) = _kpi_tables(spark, sf_dir, C.KPI_PERIOD)
    return X.period_share(period_kpi)


@register("flagrante_rate", O.with_raw(
    f"select {O.tolerant_int('ANO')} as ano, count(*) as total,"
    f" count_if(upper({O.clean_text('FLAG_FLAGRANTE')}) = 'S') as flagrantes,"
    f" round(count_if(upper({O.clean_text('FLAG_FLAGRANTE')}) = 'S') / count(*) * 100, 2) as pct_flagrante"
    f" from raw where {_DATE_OK} and {_CONS} group by 1", clean=False, extended=True))
def flagrante_rate(spark, sf_dir):
    return X.flagrante_rate(raw_from_tables(spark, sf_dir, extended=True))


@register("by_seccional", O.with_raw(
    f"select {O.tolerant_int('ANO')} as ano, {O.clean_text('NOME_SECCIONAL_CIRC')} as seccional,"
    f" count(*) as total, round(count(*) / sum(count(*)) over (partition by {O.tolerant_int('ANO')}) * 100, 2)"
    f" as pct from raw where {_DATE_OK} and {_CONS} group by 1, 2", clean=False, extended=True))
def by_seccional(spark, sf_dir):
    return X.by_seccional(raw_from_tables(spark, sf_dir, extended=True))


@register("clean_cep", O.with_raw(
    f"select * from raw where try_cast({O.clean_text('CEP')} as double) >= {X.MIN_VALID_CEP}",
    clean=False, extended=True))
def clean_cep(spark, sf_dir):
    return X.clean_cep(raw_from_tables(spark, sf_dir, extended=True))
