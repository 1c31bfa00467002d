"""Operators the specification lists beyond the implemented KPIs:
robbery share, peak hour, attempted vs consummated, top-N per year, brand
rank evolution, municipality history, rare-brand fold, coordinates and
heat-map cells, period share, caught-in-the-act rate, police-section
distribution, postal-code validity.

All are aggregates over clean/raw or windows over aggregates (groups, not
rows); none puts an unbounded group into one task.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import clean_text, tolerant_double, tolerant_int
from .clean import filter_valid_dates
from .kpis import bairro_ok, location_ok

# Extra source columns some of these operators need, and the
# smallest valid postal code.
FLAGRANTE_COLUMN = "FLAG_FLAGRANTE"
SECCIONAL_COLUMN = "NOME_SECCIONAL_CIRC"
CEP_COLUMN = "CEP"
MIN_VALID_CEP = 1000000
RARE_BRAND_MIN_ROWS = 10
HEAT_DECIMALS = 2


def _count() -> Column:
    return F.count(F.lit(1)).alias("total")


def annual_share(clean: DataFrame) -> DataFrame:
    """Per year: all rows, thefts, robberies, robbery percent (2 decimals)."""
    agg = clean.groupBy("ano").agg(
        F.count(F.lit(1)).alias("total_ocorrencias"),
        F.count_if(F.col("tipo_crime") == C.CRIME_THEFT).alias("total_furtos"),
        F.count_if(F.col("tipo_crime") == C.CRIME_ROBBERY).alias("total_roubos"))
    return agg.withColumn("pct_roubo", F.round(F.col("total_roubos") / F.col("total_ocorrencias") * 100, 2))


def peak_hour(hour_kpi: DataFrame) -> DataFrame:
    """Per year, the hour with most occurrences over all types (lowest hour
    on ties). Input: the dense hour KPI table (24 rows per group)."""
    by = hour_kpi.groupBy("ano", "hora").agg(F.sum("total").cast("long").alias("total"))
    w = Window.partitionBy("ano").orderBy(F.desc("total"), F.asc("hora"))
    return (by.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1)
            .select("ano", F.col("hora").alias("hora_pico"), "total"))


def status_split(raw: DataFrame, date_mode: str = "compat") -> DataFrame:
    """Attempted vs consummated per year, before the consummated filter."""
    df = filter_valid_dates(raw, date_mode)
    return (df.groupBy(tolerant_int("ANO").alias("ano"), F.upper(clean_text("FLAG_STATUS")).alias("status"))
            .agg(_count()))


# Top-N per year of the executive KPIs.
TOPN_PER_YEAR = [("marca", 5), ("tipo_local", 5), ("municipio", 10), ("bairro", 10)]


def topn_per_year(clean: DataFrame, spec=None) -> DataFrame:
    """Top N per year for brands, locations, municipalities, capital
    neighbourhoods (all types together; ties kept), in long form.

    All four counts come from one GROUPING SETS aggregation (one scan, one
    shuffle, reused by the four rankings); each ranking is a rank <= N over
    its own set."""
    spec = spec or TOPN_PER_YEAR
    keep = {"marca": F.col("marca") != C.BRAND_OTHER, "tipo_local": location_ok(),
            "municipio": F.col("municipio").isNotNull(), "bairro": bairro_ok()}
    dims = [d for d, _ in spec]
    pre = clean.select("ano", *[F.when(keep[d], F.col(d).cast("string")).alias(d) for d in dims])
    grouped = pre.groupingSets([["ano", d] for d in dims], "ano", *dims).agg(
        _count(), *[F.grouping(d).alias(f"g_{d}") for d in dims])
    # Long form straight from the one aggregate: which set a row belongs to
    # and its value; the rank runs per (dimension, year) over groups.
    dim = F.coalesce(*[F.when(F.col(f"g_{d}") == 0, F.lit(d)) for d in dims])
    value = F.coalesce(*[F.when(F.col(f"g_{d}") == 0, F.col(d)) for d in dims])
    long = grouped.select("ano", dim.alias("dimensao"), value.alias("valor"), "total")
    limit = F.coalesce(*[F.when(F.col("dimensao") == d, F.lit(n)) for d, n in spec])
    w = Window.partitionBy("dimensao", "ano").orderBy(F.desc("total"))
    ranked = long.filter(F.col("valor").isNotNull()).withColumn("posicao", F.rank().over(w))
    # The literal bound lets the ranking drop rows before its shuffle (WindowGroupLimit).
    ranked = ranked.filter(F.col("posicao") <= max(n for _, n in spec))
    return ranked.filter(F.col("posicao") <= limit).select(
        "ano", "dimensao", "valor", "total", F.col("posicao").cast("int"))


def brand_evolution(clean: DataFrame) -> DataFrame:
    """Brand rank per year (all types) and its change from the previous
    present year (positive = climbed)."""
    base = clean.filter(F.col("marca") != C.BRAND_OTHER).groupBy("ano", "marca").agg(_count())
    ranked = base.withColumn("posicao", F.rank().over(Window.partitionBy("ano").orderBy(F.desc("total"))))
    prev = F.lag("posicao").over(Window.partitionBy("marca").orderBy(F.col("ano").asc_nulls_first()))
    return ranked.select("ano", "marca", "total", F.col("posicao").cast("int"),
                         prev.cast("int").alias("posicao_anterior"),
                         (prev - F.col("posicao")).cast("int").alias("variacao_posicao"))


def municipality_history(clean: DataFrame) -> DataFrame:
    """Per municipality and year: total, previous present year's total,
    YoY percent (2 decimals) and the whole series 'ano:total,...' for a
    sparkline. Windows run per municipality over its years only."""
    base = clean.filter(F.col("municipio").isNotNull()).groupBy("municipio", "ano").agg(_count())
    w = Window.partitionBy("municipio").orderBy(F.col("ano").asc_nulls_first())
    wall = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    prev = F.lag("total").over(w)
    point = F.concat(F.col("ano").cast("string"), F.lit(":"), F.col("total").cast("string"))
    series = F.array_join(F.collect_list(point).over(wall), ",")
    return base.select("municipio", "ano", "total", prev.alias("total_anterior"),
                       F.round((F.col("total") - prev) / prev * 100, 2).alias("variacao_yoy_pct"),
                       series.alias("serie"))


def brand_rare_fold(clean: DataFrame, min_rows: int = RARE_BRAND_MIN_ROWS) -> DataFrame:
    """Brand counts per (ano, marca, tipo_crime) with brands seen fewer than
    ``min_rows`` times in the year folded into 'Outras'.

    The fold is decided on the per-(ano, marca) aggregate, a side bounded by
    years x brand labels (the brand rule emits at most 15 labels), so it is
    broadcast back; no window over raw rows."""
    fine = clean.groupBy("ano", "marca", "tipo_crime").agg(_count())
    per_brand = fine.groupBy("ano", "marca").agg(F.sum("total").alias("n_ano"))
    folded = (fine.join(F.broadcast(per_brand), ["ano", "marca"], "left")
              .withColumn("marca", F.when(F.col("n_ano") < min_rows, F.lit(C.BRAND_OTHER)).otherwise(F.col("marca"))))
    return folded.groupBy("ano", "marca", "tipo_crime").agg(F.sum("total").cast("long").alias("total"))


def valid_coordinates() -> Column:
    lat, lon = F.col("latitude"), F.col("longitude")
    return lat.isNotNull() & lon.isNotNull() & (lat != 0) & (lon != 0)


def geo_points(clean: DataFrame) -> DataFrame:
    """Rows usable on a map: both coordinates present and non-zero."""
    return clean.filter(valid_coordinates()).select("ano", "tipo_crime", "latitude", "longitude")


def geo_heat(clean: DataFrame, decimals: int = HEAT_DECIMALS) -> DataFrame:
    """Point density on a grid of rounded coordinates, per year."""
    return (clean.filter(valid_coordinates())
            .groupBy("ano", F.round("latitude", decimals).alias("lat"), F.round("longitude", decimals).alias("lon"))
            .agg(_count()))


def period_share(period_kpi: DataFrame) -> DataFrame:
    """Share of each period in its year (all types), 2 decimals."""
    by = period_kpi.groupBy("ano", "periodo").agg(F.sum("total").cast("long").alias("total"))
    year_total = F.sum("total").over(Window.partitionBy("ano"))
    return by.withColumn("pct", F.round(F.col("total") / year_total * 100, 2))


def flagrante_rate(raw: DataFrame, date_mode: str = "compat") -> DataFrame:
    """Percent of consummated reports flagged as caught in the act, per year."""
    from .clean import is_consummated  # noqa: PLC0415

    df = filter_valid_dates(raw, date_mode).filter(is_consummated(clean_text("FLAG_STATUS")))
    flag = F.upper(clean_text(FLAGRANTE_COLUMN)) == "S"
    return (df.groupBy(tolerant_int("ANO").alias("ano"))
            .agg(F.count(F.lit(1)).alias("total"), F.count_if(flag).alias("flagrantes"))
            .withColumn("pct_flagrante", F.round(F.col("flagrantes") / F.col("total") * 100, 2)))


def by_seccional(raw: DataFrame, date_mode: str = "compat") -> DataFrame:
    """Consummated reports per police section and year, with the share."""
    from .clean import is_consummated  # noqa: PLC0415

    df = filter_valid_dates(raw, date_mode).filter(is_consummated(clean_text("FLAG_STATUS")))
    by = df.groupBy(tolerant_int("ANO").alias("ano"), clean_text(SECCIONAL_COLUMN).alias("seccional")).agg(_count())
    return by.withColumn("pct", F.round(F.col("total") / F.sum("total").over(Window.partitionBy("ano")) * 100, 2))


def clean_cep(raw: DataFrame) -> DataFrame:
    """Rows with a valid postal code (numeric and at least 1000000)."""
    cep = tolerant_double(clean_text(CEP_COLUMN))
    return raw.filter(cep >= MIN_VALID_CEP)
