"""The eight KPI tables over the clean table.

Two physical shapes, same results (tested equal):

* one function per table (``kpi_*``): filter -> groupBy -> finish, the shape
  a single query needs;
* ``compute_kpis``: all eight in **one scan and one shuffle** of the clean
  table via GROUPING SETS. Partial aggregation runs before the shuffle, so a
  hot key (a municipality with a third of all rows) costs one partial row per
  task, not a skewed partition. The aggregate is small (groups, not rows) and
  is checkpointed once; the eight finishing steps (ranks, YoY, dense hours)
  run over it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .. import constants as C
from ..schema import CLEAN_SCHEMA

BY = ["ano", "tipo_crime"]


def _count() -> Column:
    return F.count(F.lit(1)).alias("total")


def with_yoy(base: DataFrame) -> DataFrame:
    """Year-on-year percent change per crime type, rounded to 2 decimals.

    The previous row is the previous *present* year of the same type; the
    first year is null. The window holds one row per (year, type).
    """
    w = Window.partitionBy("tipo_crime").orderBy(F.col("ano").asc_nulls_first())
    prev = F.lag("total", 1).over(w)
    return base.withColumn("variacao_yoy_pct", F.round((F.col("total") - prev) / prev * 100, 2))


def top_n(base: DataFrame, n: int) -> DataFrame:
    """Rows ranked <= n by total within (ano, tipo_crime); ties are kept.

    Planned as a WindowGroupLimit (partial limit before the shuffle)."""
    w = Window.partitionBy(*BY).orderBy(F.desc("total"))
    return base.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= n).drop("rank")


def dense_hours(pairs: DataFrame, counts: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Every (ano, tipo_crime) of ``pairs`` times hours 0..23, with the
    matching count or 0. Hours come from a generator, not a cross join;
    the join is between two aggregates (groups, not rows). A null year never
    matches, so its hours stay 0, as in the table being reproduced."""
    grid = pairs.select(*BY, F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hora"))
    return (grid.join(counts, on=[*BY, "hora"], how="left")
            .select(*BY, "hora", F.coalesce(F.col("total"), F.lit(0)).cast("long").alias("total"), *(carry or [])))


# ---------------------------------------------------------------------------
# Row predicates and dimension expressions shared by both shapes
# ---------------------------------------------------------------------------

def month_ok() -> Column:
    return F.col("mes").isNotNull() & F.col("mes").between(1, 12)


def bairro_ok(capital: str = C.CAPITAL) -> Column:
    """The municipality is tested first: rows elsewhere never evaluate the
    neighbourhood's normalisation."""
    named = F.col("bairro").isNotNull() & (F.upper(F.col("bairro")) != C.NOT_INFORMED)
    return F.when(F.col("municipio") == capital, named).otherwise(F.lit(False))


def location_ok() -> Column:
    return F.col("tipo_local").isNotNull() & (F.upper(F.col("tipo_local")) != C.NOT_INFORMED)


def brand_ok() -> Column:
    return F.col("marca").isNotNull() & (F.col("marca") != C.BRAND_OTHER)


def hour_ok() -> Column:
    return F.col("hora").isNotNull() & F.col("hora").between(0, 23)


# ---------------------------------------------------------------------------
# One function per table
# ---------------------------------------------------------------------------

def counted(clean: DataFrame, keys: list[str], keep: Column) -> DataFrame:
    """Rows satisfying ``keep`` counted per key; keys without any dropped.

    The predicate is a conditional count inside the aggregate, not a
    Filter: a Filter on a derived clean column would be pushed below the
    cleaning projection and inline the whole derivation into the scan."""
    return (clean.groupBy(*keys).agg(F.count_if(keep).alias("total"))
            .filter(F.col("total") > 0))


def kpi_annual_summary(clean: DataFrame) -> DataFrame:
    return with_yoy(clean.groupBy(*BY).agg(_count()))


def kpi_monthly(clean: DataFrame) -> DataFrame:
    return counted(clean, ["ano", "mes", "tipo_crime"], month_ok())


def kpi_by_municipality(clean: DataFrame, n: int = C.TOP_MUNICIPALITIES) -> DataFrame:
    return top_n(municipality_counts(clean), n)


def bairro_counts(clean: DataFrame, capital: str = C.CAPITAL) -> DataFrame:
    """Uncut counts per neighbourhood of the capital. The capital filter is one cheap
    expression over the raw column, so it runs (and is pushed down) before the derivation;
    other municipalities' neighbourhoods are neither normalised nor shuffled."""
    return counted(clean.filter(F.col("municipio") == capital), ["ano", "bairro", "tipo_crime"], bairro_ok(capital))


def municipality_counts(clean: DataFrame) -> DataFrame:
    return counted(clean, ["ano", "municipio", "tipo_crime"], F.col("municipio").isNotNull())


def brand_counts(clean: DataFrame) -> DataFrame:
    return counted(clean, ["ano", "marca", "tipo_crime"], brand_ok())


def kpi_by_bairro(clean: DataFrame, n: int = C.TOP_BAIRROS, capital: str = C.CAPITAL) -> DataFrame:
    return top_n(bairro_counts(clean, capital), n)


def kpi_by_location_type(clean: DataFrame) -> DataFrame:
    return counted(clean, ["ano", "tipo_local", "tipo_crime"], location_ok())


def kpi_by_brand(clean: DataFrame, n: int = C.TOP_BRANDS) -> DataFrame:
    return top_n(brand_counts(clean), n)


def kpi_by_hour(clean: DataFrame) -> DataFrame:
    """Dense 0..23 hour counts per (ano, tipo_crime), zeros included.

    One aggregation: an array of 24 conditional counts per group, exploded
    with its position. No grid, no join."""
    h = F.col("hora")
    counts = F.array(*[F.count_if(hour_ok() & (h == i)) for i in range(24)]).alias("c")
    agg = clean.groupBy(*BY).agg(counts)
    out = agg.select(*BY, F.posexplode("c").alias("hora", "total"))
    return out.select(
        *BY, F.col("hora").cast("int").alias("hora"),
        F.when(F.col("ano").isNull(), F.lit(0)).otherwise(F.col("total")).cast("long").alias("total"))


def kpi_by_period(clean: DataFrame) -> DataFrame:
    return counted(clean, ["ano", "periodo", "tipo_crime"], F.col("periodo").isNotNull())


KPI_FUNCTIONS = {
    C.KPI_ANNUAL: kpi_annual_summary,
    C.KPI_MONTHLY: kpi_monthly,
    C.KPI_MUNICIPALITY: kpi_by_municipality,
    C.KPI_BAIRRO: kpi_by_bairro,
    C.KPI_LOCATION: kpi_by_location_type,
    C.KPI_BRAND: kpi_by_brand,
    C.KPI_HOUR: kpi_by_hour,
    C.KPI_PERIOD: kpi_by_period,
}

KPI_COLUMNS = {
    C.KPI_ANNUAL: ["ano", "tipo_crime", "total", "variacao_yoy_pct"],
    C.KPI_MONTHLY: ["ano", "mes", "tipo_crime", "total"],
    C.KPI_MUNICIPALITY: ["ano", "municipio", "tipo_crime", "total"],
    C.KPI_BAIRRO: ["ano", "bairro", "tipo_crime", "total"],
    C.KPI_LOCATION: ["ano", "tipo_local", "tipo_crime", "total"],
    C.KPI_BRAND: ["ano", "marca", "tipo_crime", "total"],
    C.KPI_HOUR: ["ano", "tipo_crime", "hora", "total"],
    C.KPI_PERIOD: ["ano", "periodo", "tipo_crime", "total"],
}


# ---------------------------------------------------------------------------
# All eight in one pass
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class _Dim:
    table: str
    column: str
    keep: Column


def _dims(capital: str) -> list[_Dim]:
    # A row belongs to a table's grouping set only where ``keep`` holds;
    # elsewhere the dimension is null and that group is dropped.
    return [
        _Dim(C.KPI_MONTHLY, "mes", month_ok()),
        _Dim(C.KPI_MUNICIPALITY, "municipio", F.col("municipio").isNotNull()),
        _Dim(C.KPI_BAIRRO, "bairro", bairro_ok(capital)),
        _Dim(C.KPI_LOCATION, "tipo_local", location_ok()),
        _Dim(C.KPI_BRAND, "marca", brand_ok()),
        _Dim(C.KPI_HOUR, "hora", hour_ok()),
        _Dim(C.KPI_PERIOD, "periodo", F.col("periodo").isNotNull()),
    ]


def grouped_counts(clean: DataFrame, capital: str = C.CAPITAL) -> DataFrame:
    """Counts for all eight tables in one aggregation (GROUPING SETS).

    Output: ``gid`` (which set), ano, tipo_crime, one nullable column per
    dimension, total."""
    dims = _dims(capital)
    pre = clean.select(*BY, *[F.when(d.keep, F.col(d.column)).alias(d.column) for d in dims])
    cols = [*BY, *[d.column for d in dims]]
    sets = [BY] + [[*BY, d.column] for d in dims]
    return pre.groupingSets(sets, *cols).agg(_count(), F.grouping_id().alias("gid"))


def counts_schema() -> StructType:
    """Columns of the stored uncut counts (the output of ``grouped_counts``)."""
    return StructType([CLEAN_SCHEMA[c] for c in [*DIMENSIONS.values(), "tipo_crime"]]
                      + [StructField("total", LongType()), StructField("gid", LongType()), CLEAN_SCHEMA["ano"]])


#: Dimension of each table, in the order of the grouping sets' columns (see ``_dims``).
DIMENSIONS = {C.KPI_MONTHLY: "mes", C.KPI_MUNICIPALITY: "municipio", C.KPI_BAIRRO: "bairro", C.KPI_LOCATION: "tipo_local",
              C.KPI_BRAND: "marca", C.KPI_HOUR: "hora", C.KPI_PERIOD: "periodo"}


def rows_of(table: str) -> str:
    """SQL predicate: the rows of ``grouped_counts`` that are those of one table."""
    cols, column = [*BY, *DIMENSIONS.values()], DIMENSIONS.get(table)
    own = f"gid = {_gid(cols, [*BY, column])}"
    return f"{own} and {column} is not null" if column else own


def dimension_of(table: str) -> list[str]:
    """Key columns of a table: year, crime type and its dimension, if it has one."""
    return [*BY, *([DIMENSIONS[table]] if table in DIMENSIONS else [])]


def uncut(grouped: DataFrame, table: str, carry: list[str] | None = None) -> DataFrame:
    """Every counted row of one table, before its top-N cut: the input of rankings and
    lists that add up over years and types."""
    return grouped.filter(rows_of(table)).select(*dimension_of(table), "total", *(carry or []))


def _gid(cols: list[str], members: list[str]) -> int:
    n = len(cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in members)


def kpis_from_grouped(grouped: DataFrame, carry: list[str] | None = None) -> dict[str, DataFrame]:
    """Split the grouping-sets aggregate into the eight finished tables. ``carry``: further
    columns of the counts that each table's rows keep (null in the hours without a count)."""
    part = {name: uncut(grouped, name, carry) for name in KPI_COLUMNS}
    annual = part[C.KPI_ANNUAL]
    out = {
        **part,
        C.KPI_ANNUAL: with_yoy(annual),
        C.KPI_MUNICIPALITY: top_n(part[C.KPI_MUNICIPALITY], C.TOP_MUNICIPALITIES),
        C.KPI_BAIRRO: top_n(part[C.KPI_BAIRRO], C.TOP_BAIRROS),
        C.KPI_BRAND: top_n(part[C.KPI_BRAND], C.TOP_BRANDS),
        C.KPI_HOUR: dense_hours(annual.select(*BY), part[C.KPI_HOUR], carry),
    }
    return {name: df.select(*KPI_COLUMNS[name], *(carry or [])) for name, df in out.items()}


def compute_kpis(clean: DataFrame, capital: str = C.CAPITAL, materialize: bool = True) -> dict[str, DataFrame]:
    """All eight KPI tables from one scan of ``clean``.

    With ``materialize`` the small grouped aggregate is checkpointed to the
    session's checkpoint folder (reliable storage, lineage cut), so the eight
    writes that follow do not rescan the clean table."""
    grouped = grouped_counts(clean, capital)
    if materialize:
        grouped = grouped.checkpoint(eager=True)
    return kpis_from_grouped(grouped)


def kpi(clean: DataFrame, name: str) -> DataFrame:
    return KPI_FUNCTIONS[name](clean).select(*KPI_COLUMNS[name])
