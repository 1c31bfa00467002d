"""Column-level rules. Each takes Columns and returns a Column, built only
from Spark's built-in expressions so that it stays inside code generation."""

from .casts import parse_date, parse_hour, tolerant_double, tolerant_int
from .derive import (
    brand, crime_type, direction, hour_label, month_label, period, period_band,
)
from .text import clean_text, fold_accents, normalize_bairro

__all__ = [
    "parse_date", "parse_hour", "tolerant_double", "tolerant_int",
    "brand", "crime_type", "direction", "hour_label", "month_label", "period",
    "period_band", "clean_text", "fold_accents", "normalize_bairro",
]
