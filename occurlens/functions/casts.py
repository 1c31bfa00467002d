"""Tolerant casts: malformed input becomes null instead of failing (ANSI on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_int(c: Column | str) -> Column:
    """String to int; blanks and text give null, '7.6' gives 7, '-7.6' gives -7.

    Goes through double so that decimal text truncates toward zero, as a
    lenient integer cast does; out-of-range values give null, and so does text
    that only a floating-point cast accepts ('12d', '12f', '1e3', 'NaN').
    """
    c = _col(c)
    return F.when(c.rlike(C.INTEGER_TEXT), c.try_cast("double")).try_cast("int")


def tolerant_double(c: Column | str) -> Column:
    """String to double; blanks and text give null ('0' stays 0.0)."""
    return _col(c).try_cast("double")


def parse_hour(c: Column | str) -> Column:
    """Hour of 'H:MM' / 'HH:MM[:SS]' text; null otherwise. May exceed 23.

    One regex and one reference to the input: a consumer filter that is
    pushed below the projection inlines it once, not once per branch."""
    return F.regexp_extract(_col(c), C.HOUR_CAPTURE, 1).try_cast("int")


def parse_date(c: Column | str) -> Column:
    """Date of a text in one of the accepted formats (``C.DATE_FORMATS``); null otherwise.

    Two regexes bring it to the ISO form, which a cast reads: a formatter's parse takes far longer, and
    raises and catches an exception wherever it fails. One reference to the input (see ``parse_hour``)."""
    iso = F.regexp_replace(_col(c), C.DAY_FIRST_DATE, "$3-$2-$1")
    return F.regexp_extract(iso, C.ISO_DATE, 1).try_cast("date")
