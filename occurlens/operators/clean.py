"""Cleaning: raw 16 strings -> 16 typed, normalised columns.

All rules are narrow (row-wise) expressions, so the whole step is one
scan -> filter -> project stage inside whole-stage code generation; no
shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .. import constants as C
from ..functions import (
    brand, clean_text, crime_type, normalize_bairro, parse_date, parse_hour, period,
    tolerant_double, tolerant_int,
)
from ..session import compiled_stages

DATE_FILTER_MODES = ("compat", "parsed")


def year_column(df: DataFrame, name: str = "ANO") -> Column:
    """``ANO`` as an int: the column itself when already integral (a
    partition column read back from Parquet, so the filter prunes
    partitions), else a tolerant cast of the string."""
    if isinstance(df.schema[name].dataType, IntegralType):
        return F.col(name)
    return tolerant_int(name)


def filter_years(raw: DataFrame, years: int | Iterable[int] | None) -> DataFrame:
    """Keep the given source years; None keeps all."""
    if years is None:
        return raw
    years = [years] if isinstance(years, int) else sorted(set(years))
    return raw.filter(year_column(raw).isin(years))


def valid_date(mode: str = "compat") -> Column:
    """Predicate of ``filter_valid_dates``."""
    if mode == "compat":
        return F.col("DATA_OCORRENCIA_BO") >= F.lit(C.MIN_DATE_STRING)
    if mode == "parsed":
        return parse_date("DATA_OCORRENCIA_BO") >= F.lit(C.MIN_DATE_STRING).cast("date")
    raise ValueError(f"mode must be one of {DATE_FILTER_MODES}")


def filter_valid_dates(raw: DataFrame, mode: str = "compat") -> DataFrame:
    """Drop rows before 1900-01-01.

    ``compat`` compares the raw **string** with '1900-01-01' (so dd/MM/yyyy
    text with a day below 20 and blank dates drop, and the text 'NULL'
    passes); it is pushed to the Parquet scan. ``parsed`` parses the date
    first and drops unparsable and earlier dates.
    """
    return raw.filter(valid_date(mode))


def typed_columns() -> dict[str, Column]:
    """Tolerant casts of the numeric, hour and date columns."""
    return {
        "ano_bo": tolerant_int("ANO_BO"),
        "num_bo": tolerant_int("NUM_BO"),
        "mes": tolerant_int("MES"),
        "ano": tolerant_int("ANO"),
        "latitude": tolerant_double("LATITUDE"),
        "longitude": tolerant_double("LONGITUDE"),
        "hora": parse_hour("HORA_OCORRENCIA"),
        "data_ocorrencia": parse_date("DATA_OCORRENCIA_BO"),
    }


def text_columns() -> dict[str, Column]:
    """The seven text columns trimmed and null-token mapped."""
    return {c: clean_text(c) for c in C.TEXT_COLUMNS}


def is_consummated(status: Column) -> Column:
    """Upper-cased, trimmed status equals CONSUMADO (null drops)."""
    return F.upper(status) == C.CONSUMMATED


def _staged_columns() -> list[Column]:
    typed = typed_columns()
    text = text_columns()
    return [
        *[text[c].alias(c) for c in C.TEXT_COLUMNS],
        *[typed[c].alias(c) for c in ("ano_bo", "ano", "mes", "latitude", "longitude",
                                      "hora", "data_ocorrencia")],
        F.col(C.LINEAGE_COLUMN),
    ]


def _final_columns() -> list[Column]:
    hora = F.col("hora")
    return [
        F.col("ano_bo"),
        F.col("ano"),
        F.col("mes"),
        F.col("NOME_MUNICIPIO_CIRC").alias("municipio"),
        F.col("CIDADE").alias("cidade"),
        normalize_bairro("BAIRRO").alias("bairro"),
        crime_type("RUBRICA").alias("tipo_crime"),
        F.col("RUBRICA").alias("rubrica"),
        F.col("DESCR_TIPOLOCAL").alias("tipo_local"),
        brand("MARCA_OBJETO").alias("marca"),
        hora,
        period(hora).alias("periodo"),
        F.col("latitude"),
        F.col("longitude"),
        F.col("data_ocorrencia"),
        F.col(C.LINEAGE_COLUMN).alias("arquivo_origem"),
    ]


def clean(raw: DataFrame, years: int | Iterable[int] | None = None,
          date_mode: str = "compat", require_municipality: bool = False, valid_rows: Observation | None = None) -> DataFrame:
    """Raw -> clean: year filter, date filter, consummated filter, one projection.

    ``valid_rows`` observes the rows that pass the date filter (``rows``); it stands above that
    filter, which still reaches the scan.

    ``require_municipality`` also drops rows without a municipality (the
    specification's cleaning rule; by default only the municipality KPI
    drops them)."""
    compiled_stages(raw.sparkSession)
    df = filter_valid_dates(filter_years(raw, years), date_mode)
    if valid_rows is not None:
        df = df.observe(valid_rows, F.count(F.lit(1)).alias("rows"))
    staged = df.select(*_staged_columns()).filter(is_consummated(F.col("FLAG_STATUS")))
    if require_municipality:
        staged = staged.filter(F.col("NOME_MUNICIPIO_CIRC").isNotNull())
    return staged.select(*_final_columns())
