"""Dashboard views as DataFrame functions over the KPI tables (V1-V14).

Each view takes the KPI DataFrame(s) plus the optional filters ``ano``,
``tipo`` and ``bairro`` (blank or None = no filter). Inputs are KPI tables:
small (groups, not rows), so global aggregates and top-k are cheap; none of
them collects to the driver. Rankings and lists that add up over years and types
(brands, municipalities, neighbourhoods) take the uncut counts, not the KPI tables,
whose rows are already cut per year and type (``kpis.uncut``, ``kpis.*_counts``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import direction, hour_label, month_label, period_band
from .kpis import uncut


def _set(v) -> bool:
    return v is not None and v != ""


def apply_filters(df: DataFrame, ano=None, tipo=None, bairro=None) -> DataFrame:
    """Optional-filter set: each filter only when given; ``bairro`` only
    for tables that have that column."""
    if _set(ano):
        df = df.filter(F.col("ano") == int(ano))
    if _set(tipo) and "tipo_crime" in df.columns:
        df = df.filter(F.col("tipo_crime") == tipo)
    if _set(bairro) and "bairro" in df.columns:
        df = df.filter(F.col("bairro") == bairro)
    return df


def total_of(df: DataFrame) -> Column:
    """Count field under either spelling: ``total_ocorrencias``, else
    ``total``, else 0 (a zero counts as missing, as in ``a || b || 0``)."""
    parts = [F.nullif(F.col(c), F.lit(0)) for c in ("total_ocorrencias", "total") if c in df.columns]
    return F.coalesce(*parts, F.lit(0)).cast("long")


def with_total(df: DataFrame) -> DataFrame:
    return df.withColumn("total", total_of(df))


def with_type(df: DataFrame) -> DataFrame:
    """Input without a crime type (the per-year shape): its type is null."""
    return df if "tipo_crime" in df.columns else df.withColumn("tipo_crime", F.lit(None).cast("string"))


def yoy_recomputed(annual: DataFrame) -> DataFrame:
    """Unrounded year-on-year change per crime type over the KPI rows.

    Null for the first year of a type and when the previous total is 0."""
    df = with_total(with_type(annual))
    w = Window.partitionBy("tipo_crime").orderBy(F.col("ano").asc_nulls_first())
    prev = F.lag("total", 1).over(w)
    yoy = F.when(prev.isNotNull() & (prev != 0), (F.col("total") - prev) / prev * 100)
    return df.select("ano", "tipo_crime", "total", yoy.alias("variacao_yoy_pct"))


def _sum_if(cond: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")


def _ordered_mean(x: Column) -> Column:
    """Mean whose floating-point sum runs in ascending value order, so the
    result does not depend on how rows were partitioned. Used per year over
    at most one value per crime type (a bounded list)."""
    vals = F.array_sort(F.collect_list(x))
    return F.aggregate(vals, F.lit(0.0), lambda acc, v: acc + v) / F.size(vals)


def cards(annual: DataFrame, ano=None, tipo=None, bairro=None) -> DataFrame:
    """KPI cards: total, thefts, robberies, mean YoY of the reference year
    (the given year, else the latest present), and its direction.

    The mean is unweighted over the year's rows (every type), null taken
    as 0; no rows gives null."""
    d = apply_filters(yoy_recomputed(annual), ano, tipo, bairro)
    per_year = d.groupBy("ano").agg(
        _sum_if(F.lit(True), F.col("total")).alias("t"),
        _sum_if(F.col("tipo_crime") == C.CRIME_THEFT, F.col("total")).alias("f"),
        _sum_if(F.col("tipo_crime") == C.CRIME_ROBBERY, F.col("total")).alias("r"),
        _ordered_mean(F.coalesce(F.col("variacao_yoy_pct"), F.lit(0.0))).alias("y"),
    )
    if _set(ano):
        yoy = F.max(F.when(F.col("ano") == int(ano), F.col("y")))
    else:
        yoy = F.max_by(F.col("y"), F.when(F.col("ano") != 0, F.col("ano")))
    out = per_year.agg(
        F.coalesce(F.sum("t"), F.lit(0)).cast("long").alias("total"),
        F.coalesce(F.sum("f"), F.lit(0)).cast("long").alias("furtos"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("long").alias("roubos"),
        yoy.alias("variacao_yoy_media"),
    )
    return out.withColumn("direcao", direction("variacao_yoy_media"))


def _thousands(c: Column) -> Column:
    """Integer with '.' as the thousands separator (pt-BR)."""
    return F.translate(F.format_number(c.cast("long"), 0), ",", ".")


def cards_text(cards_df: DataFrame) -> DataFrame:
    """The cards as display text: thousands separators, a signed percent
    with one decimal, and a dash when the change is unknown."""
    yoy = F.col("variacao_yoy_media")
    pct = F.concat(F.when(yoy > 0, F.lit("+")).otherwise(F.lit("")), F.format_string("%.1f", yoy), F.lit("%"))
    return cards_df.select(
        _thousands(F.col("total")).alias("total_txt"), _thousands(F.col("furtos")).alias("furtos_txt"),
        _thousands(F.col("roubos")).alias("roubos_txt"),
        F.when(yoy.isNull(), F.lit("—")).otherwise(pct).alias("variacao_txt"), "direcao")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Empty-result guard: an input without rows is an error (one tiny job)."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}: load the KPI tables first")
    return df


def annual_pivot(annual: DataFrame, ano=None, tipo=None, bairro=None) -> DataFrame:
    """Thefts and robberies per year (the type filter is ignored)."""
    d = with_type(with_total(apply_filters(annual, ano, None, bairro)))
    return (d.groupBy("ano").pivot("tipo_crime", [C.CRIME_THEFT, C.CRIME_ROBBERY]).agg(F.sum("total"))
            .select("ano",
                    F.coalesce(F.col(C.CRIME_THEFT), F.lit(0)).cast("long").alias("furto"),
                    F.coalesce(F.col(C.CRIME_ROBBERY), F.lit(0)).cast("long").alias("roubo")))


def _dense(d: DataFrame, key: Column, n: int, first: int, name: str) -> DataFrame:
    """Dense 0..n-1 (offset ``first``) sums of ``total`` by ``key``: one
    global aggregate of n conditional sums, exploded with its position."""
    sums = F.array(*[_sum_if(key == first + i, F.col("total")) for i in range(n)]).alias("s")
    return (d.agg(sums).select(F.posexplode("s").alias("i", "total"))
            .select((F.col("i") + first).cast("int").alias(name), "total"))


def monthly(monthly_kpi: DataFrame, ano=None, tipo=None, bairro=None) -> DataFrame:
    """Seasonality: dense 12 months summed over the filtered rows; a
    missing month counts as January."""
    d = with_total(apply_filters(monthly_kpi, ano, tipo, bairro))
    key = F.coalesce(F.nullif(F.col("mes"), F.lit(0)), F.lit(1))
    out = _dense(d, key, 12, 1, "mes")
    return out.select("mes", month_label("mes").alias("mes_rotulo"), "total")


def hourly(hour_kpi: DataFrame, ano=None, tipo=None, bairro=None) -> DataFrame:
    """Hour histogram: dense 24 hours, label and colour band."""
    d = with_total(apply_filters(hour_kpi, ano, tipo, bairro))
    out = _dense(d, F.col("hora"), 24, 0, "hora")
    return out.select("hora", hour_label("hora").alias("rotulo"), period_band("hora").alias("faixa"), "total")


def _top(d: DataFrame, key: str, k: int) -> DataFrame:
    """Sum by key, top k by (total desc, key asc) - a TakeOrderedAndProject."""
    return (with_total(d).groupBy(key).agg(F.sum("total").cast("long").alias("total"))
            .orderBy(F.desc("total"), F.asc_nulls_first(key)).limit(k))


def top_brands(brand_kpi: DataFrame, ano=None, tipo=None, bairro=None, k: int = C.VIEW_TOP_BRANDS) -> DataFrame:
    return _top(apply_filters(brand_kpi, ano, tipo, bairro), "marca", k)


def top_locations(location_kpi: DataFrame, ano=None, tipo=None, bairro=None,
                  k: int = C.VIEW_TOP_LOCATIONS) -> DataFrame:
    return _top(apply_filters(location_kpi, ano, tipo, bairro), "tipo_local", k)


def _ranking(d: DataFrame, key: str, k: int) -> DataFrame:
    """Top k with 1-based position and percent of the maximum (1 decimal).

    The windows run over the k rows left after the limit."""
    top = _top(d, key, k)
    w = Window.orderBy(F.desc("total"), F.asc_nulls_first(key))
    wall = Window.partitionBy()
    mx = F.coalesce(F.nullif(F.max("total").over(wall), F.lit(0)), F.lit(1))
    return top.select(F.row_number().over(w).alias("posicao"), key, "total",
                      F.round(F.col("total") / mx * 100, 1).alias("pct_max"))


def municipality_ranking(mun_kpi: DataFrame, ano=None, tipo=None, bairro=None,
                         k: int = C.VIEW_TOP_MUNICIPALITIES) -> DataFrame:
    return _ranking(apply_filters(mun_kpi, ano, tipo, bairro), "municipio", k)


def bairro_ranking(bairro_kpi: DataFrame, ano=None, tipo=None, bairro=None,
                   k: int = C.VIEW_TOP_BAIRROS) -> DataFrame:
    return _ranking(apply_filters(bairro_kpi, ano, tipo, bairro), "bairro", k)


def type_split(annual: DataFrame, ano=None, tipo=None, bairro=None) -> DataFrame:
    """Thefts vs robberies (type filter ignored; 'Outros' left out)."""
    d = with_type(with_total(apply_filters(annual, ano, None, bairro)))
    s = d.agg(_sum_if(F.col("tipo_crime") == C.CRIME_THEFT, F.col("total")).alias("furtos"),
              _sum_if(F.col("tipo_crime") == C.CRIME_ROBBERY, F.col("total")).alias("roubos"))
    both = F.col("furtos") + F.col("roubos")
    return s.select("furtos", "roubos", both.alias("total"),
                    F.round(F.col("furtos") / F.nullif(both, F.lit(0)) * 100, 1).alias("pct_furto"),
                    F.round(F.col("roubos") / F.nullif(both, F.lit(0)) * 100, 1).alias("pct_roubo"))


def years(annual: DataFrame) -> DataFrame:
    """Distinct years, newest first."""
    return annual.select("ano").distinct().orderBy(F.desc("ano"))


def bairros(bairro_counts: DataFrame) -> DataFrame:
    """Every neighbourhood that was counted, by name."""
    return bairro_counts.select("bairro").distinct().orderBy("bairro")


def period_covered(annual: DataFrame) -> DataFrame:
    """Latest year and the coverage label."""
    return annual.agg(F.max("ano").alias("ultimo_ano")).select(
        "ultimo_ano",
        F.concat(*_label_parts(F.col("ultimo_ano").cast("string"))).alias("rotulo"))


def _label_parts(last):
    head, tail = C.COVERAGE_LABEL.format(first=C.FIRST_YEAR_LABEL, last="\0").split("\0")
    return [F.lit(head), last, F.lit(tail)]


VIEWS = {
    "cards": (cards, C.KPI_ANNUAL),
    "annual_pivot": (annual_pivot, C.KPI_ANNUAL),
    "monthly": (monthly, C.KPI_MONTHLY),
    "hourly": (hourly, C.KPI_HOUR),
    "top_brands": (top_brands, C.KPI_BRAND),
    "top_locations": (top_locations, C.KPI_LOCATION),
    "municipality_ranking": (municipality_ranking, C.KPI_MUNICIPALITY),
    "bairro_ranking": (bairro_ranking, C.KPI_BAIRRO),
    "type_split": (type_split, C.KPI_ANNUAL),
}


#: Tables whose views need every counted row, not the rows kept per year and type.
RANKED = (C.KPI_MUNICIPALITY, C.KPI_BAIRRO, C.KPI_BRAND)


def dashboard(kpis: dict[str, DataFrame], counts: DataFrame, ano=None, tipo=None, bairro=None) -> dict[str, DataFrame]:
    """All views at one filter setting (a drill-down sets ano or tipo). ``counts``: the
    uncut counts stored with the KPI tables (``pipeline.read_counts``)."""
    require_rows(kpis[C.KPI_ANNUAL], C.KPI_ANNUAL)
    tables = {**kpis, **{t: uncut(counts, t) for t in RANKED}}
    out = {name: fn(tables[table], ano, tipo, bairro) for name, (fn, table) in VIEWS.items()}
    out["years"] = years(kpis[C.KPI_ANNUAL])
    out["bairros"] = bairros(tables[C.KPI_BAIRRO])
    out["period"] = period_covered(kpis[C.KPI_ANNUAL])
    return out
