"""Schemas of the raw, clean and KPI tables, and the KPI natural keys."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType,
)

from . import constants as C

RAW_COLUMNS = C.REQUIRED_COLUMNS + [C.LINEAGE_COLUMN]

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

CLEAN_SCHEMA = StructType([
    StructField("ano_bo", IntegerType()),
    StructField("ano", IntegerType()),
    StructField("mes", IntegerType()),
    StructField("municipio", StringType()),
    StructField("cidade", StringType()),
    StructField("bairro", StringType()),
    StructField("tipo_crime", StringType()),
    StructField("rubrica", StringType()),
    StructField("tipo_local", StringType()),
    StructField("marca", StringType()),
    StructField("hora", IntegerType()),
    StructField("periodo", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("data_ocorrencia", DateType()),
    StructField("arquivo_origem", StringType()),
])
CLEAN_COLUMNS = [f.name for f in CLEAN_SCHEMA.fields]

# Natural key (UNIQUE, NOT NULL) of each KPI table, and its full column list.
KPI_KEYS: dict[str, list[str]] = {
    C.KPI_ANNUAL: ["ano", "tipo_crime"],
    C.KPI_MONTHLY: ["ano", "mes", "tipo_crime"],
    C.KPI_MUNICIPALITY: ["ano", "municipio", "tipo_crime"],
    C.KPI_BAIRRO: ["ano", "bairro", "tipo_crime"],
    C.KPI_LOCATION: ["ano", "tipo_local", "tipo_crime"],
    C.KPI_BRAND: ["ano", "marca", "tipo_crime"],
    C.KPI_HOUR: ["ano", "hora", "tipo_crime"],
    C.KPI_PERIOD: ["ano", "periodo", "tipo_crime"],
}

KPI_SCHEMAS: dict[str, StructType] = {
    C.KPI_ANNUAL: StructType([
        StructField("ano", IntegerType()), StructField("tipo_crime", StringType()),
        StructField("total", LongType()), StructField("variacao_yoy_pct", DoubleType()),
    ]),
    C.KPI_MONTHLY: StructType([
        StructField("ano", IntegerType()), StructField("mes", IntegerType()),
        StructField("tipo_crime", StringType()), StructField("total", LongType()),
    ]),
    C.KPI_MUNICIPALITY: StructType([
        StructField("ano", IntegerType()), StructField("municipio", StringType()),
        StructField("tipo_crime", StringType()), StructField("total", LongType()),
    ]),
    C.KPI_BAIRRO: StructType([
        StructField("ano", IntegerType()), StructField("bairro", StringType()),
        StructField("tipo_crime", StringType()), StructField("total", LongType()),
    ]),
    C.KPI_LOCATION: StructType([
        StructField("ano", IntegerType()), StructField("tipo_local", StringType()),
        StructField("tipo_crime", StringType()), StructField("total", LongType()),
    ]),
    C.KPI_BRAND: StructType([
        StructField("ano", IntegerType()), StructField("marca", StringType()),
        StructField("tipo_crime", StringType()), StructField("total", LongType()),
    ]),
    C.KPI_HOUR: StructType([
        StructField("ano", IntegerType()), StructField("tipo_crime", StringType()),
        StructField("hora", IntegerType()), StructField("total", LongType()),
    ]),
    C.KPI_PERIOD: StructType([
        StructField("ano", IntegerType()), StructField("periodo", StringType()),
        StructField("tipo_crime", StringType()), StructField("total", LongType()),
    ]),
}

KPI_TABLES = list(KPI_KEYS)


def check_raw_schema(df, columns: list[str] | None = None) -> None:
    """Fail fast when a raw table does not have the expected string columns
    in the expected order (analysis only, no job)."""
    expected = columns or RAW_COLUMNS
    got = [(f.name, f.dataType) for f in df.schema.fields]
    problems = []
    if [n for n, _ in got] != expected:
        problems.append(f"columns {[n for n, _ in got]} != {expected}")
    problems += [f"{n} is {t.simpleString()}" for n, t in got if not isinstance(t, StringType)]
    if problems:
        raise ValueError("raw schema mismatch: " + "; ".join(problems))
