"""Derived columns: crime type, brand, period of day, and display labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .casts import _col


def crime_type(rubrica: Column | str) -> Column:
    """'Roubo' if the text mentions robbery, else 'Furto' for theft, else 'Outros' (null text too: read
    as empty, it needs no null checks in the generated code)."""
    low = F.lower(F.coalesce(_col(rubrica), F.lit("")))
    out = None
    for needle, label in C.CRIME_RULES:
        cond = low.contains(needle)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(C.CRIME_OTHER)


def _has(up: Column, pattern: str) -> Column:
    """``rlike`` on upper-cased text. A pattern of plain words, which ignores case in ASCII, is a
    byte search for each; another's regex runs only where its longest plain word occurs."""
    words = pattern.removeprefix("(?i)").strip("()").split("|")
    out = None
    for word in words:
        plain = max(re.findall(r"(?<![\\\[])[a-z]+", word), key=len).upper()
        cond = up.contains(plain)
        if plain != word.upper():
            cond = cond & up.rlike(f"(?i){word}")
        out = cond if out is None else out | cond
    return out


def brand(marca: Column | str) -> Column:
    """First brand pattern that matches the upper-cased text, else 'Outras' (null text too: read as
    empty, it needs no null checks in the generated code of each word)."""
    up = F.upper(F.trim(F.coalesce(_col(marca), F.lit(""))))
    out = None
    for pattern, label in C.BRAND_RULES:
        cond = _has(up, pattern)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(C.BRAND_OTHER)


def period(hora: Column | str) -> Column:
    """Period of day for hours 0-23; null for null or out-of-range hours.

    A lookup in the 24 labels (built from the period bounds), so the hour
    is referenced once."""
    labels = [label for low, high, label in C.PERIODS for _ in range(low, high + 1)]
    return F.get(F.array(*[F.lit(x) for x in labels]), _col(hora))


def period_band(hora: Column | str) -> Column:
    """Colour band of an hour bar: only upper bounds are tested (< 6, < 12, < 18)."""
    h = _col(hora)
    out = None
    for _, high, label in C.PERIODS[:-1]:
        out = F.when(h <= high, label) if out is None else out.when(h <= high, label)
    return out.otherwise(C.PERIODS[-1][2])


def hour_label(hora: Column | str) -> Column:
    """'00h' .. '23h'."""
    return F.concat(F.lpad(_col(hora).cast("string"), 2, "0"), F.lit("h"))


def month_label(mes: Column | str) -> Column:
    """'Jan' .. 'Dez' for 1..12; null otherwise."""
    labels = F.array(*[F.lit(m) for m in C.MONTH_LABELS])
    m = _col(mes)
    return F.when(m.between(1, 12), F.get(labels, m - 1))


def direction(change: Column | str) -> Column:
    """'up' for a positive change, 'down' otherwise, null when unknown."""
    c = _col(change)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(c > 0, "up").otherwise("down")
