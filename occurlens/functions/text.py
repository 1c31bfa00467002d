"""String rules: trimming, null tokens, accent folding, abbreviations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .casts import _col


def clean_text(c: Column | str) -> Column:
    """Trim spaces; values that upper-case to a null token become null."""
    t = F.trim(_col(c))
    return F.when(F.upper(t).isin(*C.NULL_TOKENS), F.lit(None).cast("string")).otherwise(t)


def fold_accents(c: Column | str) -> Column:
    """Accent folding. Every folded character is non-ASCII, so pure-ASCII
    text (as many bytes as characters) skips the per-character map."""
    c = _col(c)
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.translate(c, C.ACCENTS_FROM, C.ACCENTS_TO))


def normalize_bairro(c: Column | str) -> Column:
    """Fold accents, upper-case, expand abbreviations; null stays null.

    The regex chain runs only on names that contain one of the abbreviations
    as a substring (plain byte searches first); others pass unchanged."""
    base = F.upper(fold_accents(c))
    out = base
    for pattern, expansion in C.ABBREVIATIONS:
        out = F.regexp_replace(out, pattern, expansion)
    words = [p.replace(r"\b", "") for p, _ in C.ABBREVIATIONS]
    maybe = base.contains(words[0])
    for w in words[1:]:
        maybe = maybe | base.contains(w)
    return F.when(maybe, out).otherwise(base)
