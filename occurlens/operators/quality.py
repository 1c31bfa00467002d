"""Data-quality checks: retention, sanity distributions, key integrity and
KPI reconciliation. All are aggregates (one pass each), never a collect of
rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import clean_text, period
from ..schema import KPI_KEYS
from .clean import filter_years, is_consummated, valid_date


def clean_quality(raw: DataFrame, years=None, date_mode: str = "compat") -> DataFrame:
    """Rows in, rows after the date filter, rows kept, percent kept (1 decimal,
    0 for an empty input), computed in one aggregation over raw."""
    df = filter_years(raw, years)
    date_ok = valid_date(date_mode)
    kept = date_ok & is_consummated(clean_text("FLAG_STATUS"))
    agg = df.agg(F.count(F.lit(1)).alias("linhas_brutas"),
                 F.count_if(date_ok).alias("linhas_validas"),
                 F.count_if(kept).alias("linhas_limpas"))
    pct = F.when(F.col("linhas_brutas") > 0,
                 F.round(F.col("linhas_limpas") / F.col("linhas_brutas") * 100, 1)).otherwise(F.lit(0.0))
    return agg.select(F.col("linhas_brutas").cast("long"), F.col("linhas_validas").cast("long"),
                      F.col("linhas_limpas").cast("long"), pct.alias("pct_retido"))


def dist_tipo_crime(clean: DataFrame) -> DataFrame:
    """Rows per crime type, largest first (ties by name)."""
    return (clean.groupBy("tipo_crime").agg(F.count(F.lit(1)).alias("total"))
            .orderBy(F.desc("total"), F.asc_nulls_first("tipo_crime")))


def dist_top_brands(clean: DataFrame, k: int = 10) -> DataFrame:
    """Ten most frequent brands, ties broken by name."""
    return (clean.groupBy("marca").agg(F.count(F.lit(1)).alias("total"))
            .orderBy(F.desc("total"), F.asc_nulls_first("marca")).limit(k))


def kpi_integrity(kpis: dict[str, DataFrame]) -> DataFrame:
    """Per KPI table: rows, duplicated keys, rows with a null key."""
    from ..sinks.tables import check_keys  # noqa: PLC0415

    parts = [check_keys(df, name) for name, df in kpis.items() if name in KPI_KEYS]
    return reduce(DataFrame.unionByName, parts)


def _sums(name: str, expected: DataFrame, obtained: DataFrame) -> DataFrame:
    """One check row: the sums of the column ``v`` on both sides."""
    both = (expected.select(F.col("v").alias("e"), F.lit(0).alias("o"))
            .unionByName(obtained.select(F.lit(0).alias("e"), F.col("v").alias("o"))))
    return both.agg(F.coalesce(F.sum("e"), F.lit(0)).cast("long").alias("esperado"),
                    F.coalesce(F.sum("o"), F.lit(0)).cast("long").alias("obtido")).select(
        F.lit(name).alias("verificacao"), "esperado", "obtido", (F.col("esperado") == F.col("obtido")).alias("ok"))


def kpi_reconcile(clean: DataFrame, kpis: dict[str, DataFrame]) -> DataFrame:
    """Cross-table checks as rows (verificacao, esperado, obtido, ok):

    * the annual totals add up to the clean row count;
    * monthly, period, hour totals never exceed the annual total;
    * the period table equals the hour table rolled up to periods;
    * the hour table has 24 rows per (ano, tipo_crime)."""
    annual = kpis[C.KPI_ANNUAL]
    checks = []

    checks.append(_sums("anual_soma_igual_linhas_limpas",
                      clean.select(F.lit(1).alias("v")), annual.select(F.col("total").alias("v"))))
    for name in (C.KPI_MONTHLY, C.KPI_PERIOD):
        by = annual.groupBy("ano", "tipo_crime").agg(F.sum("total").alias("a"))
        part = kpis[name].groupBy("ano", "tipo_crime").agg(F.sum("total").alias("p"))
        by = by.select(F.col("ano").alias("a_ano"), F.col("tipo_crime").alias("a_tipo"), "a")
        over = part.join(by, F.col("ano").eqNullSafe(F.col("a_ano")) & (F.col("tipo_crime") == F.col("a_tipo")), "left").select(
            F.when(F.col("p") > F.coalesce(F.col("a"), F.lit(0)), 1).otherwise(0).alias("v"))
        checks.append(_sums(f"{name}_nao_excede_anual", over.limit(0).select("v"), over))
    hour = kpis[C.KPI_HOUR].filter(F.col("ano").isNotNull())
    rolled = (hour.withColumn("periodo", period(F.col("hora"))).groupBy("ano", "periodo", "tipo_crime")
              .agg(F.sum("total").alias("h")))
    per = kpis[C.KPI_PERIOD].filter(F.col("ano").isNotNull())
    diff = (rolled.join(per, ["ano", "periodo", "tipo_crime"], "full")
            .select(F.when(F.coalesce(F.col("h"), F.lit(0)) != F.coalesce(F.col("total"), F.lit(0)), 1)
                    .otherwise(0).alias("v")))
    checks.append(_sums("periodo_igual_horas_agrupadas", diff.limit(0).select("v"), diff))
    cells = kpis[C.KPI_HOUR].groupBy("ano", "tipo_crime").agg(F.count(F.lit(1)).alias("n"))
    checks.append(_sums("horas_24_por_grupo", cells.select(F.lit(24).alias("v")), cells.select(F.col("n").alias("v"))))
    return reduce(DataFrame.unionByName, checks)
