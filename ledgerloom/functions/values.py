"""Scalar building blocks, all JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trim spaces (only spaces, as SQL TRIM does) and turn an empty rest into null."""
    t = F.trim(col(c))
    return F.when(t != "", t)


def padded_key(c: Column | str, width: int = 6) -> Column:
    """Upper-case trimmed key, zero-padded on the left up to ``width``; blank is null; longer keys stay whole."""
    t = F.upper(blank_to_null(c))
    return F.when(F.length(t) < width, F.lpad(t, width, "0")).otherwise(t)


def alnum_key(c: Column | str) -> Column:
    """Letters and digits only, ignoring case: equal keys mean the same label. Blank is null."""
    t = blank_to_null(c)
    return F.lower(F.regexp_replace(t, r"[^\p{L}\p{N}]", ""))


def numeric_key(c: Column | str) -> Column:
    """Canonical text of a number ('+47', '47.0' and ' 47' agree); other text stays as it is, blank is null."""
    t = blank_to_null(c)
    n = F.regexp_replace(t, ",", "").try_cast("decimal(24,6)")
    return F.coalesce(n.cast("string"), F.upper(t))


def flexible_date(c: Column | str) -> Column:
    """``YYYY-MM-DD`` or month/day/year, surrounding blanks ignored; anything else, or no real day, is null."""
    t = blank_to_null(c)
    us = F.regexp_extract(t, r"^(\d{1,2})/(\d{1,2})/(\d{4})\z", 0)
    parts = F.split(us, "/")
    iso = F.when(
        us != "",
        F.concat_ws("-", F.get(parts, F.lit(2)), F.lpad(F.get(parts, F.lit(0)), 2, "0"), F.lpad(F.get(parts, F.lit(1)), 2, "0")),
    ).when(t.rlike(r"^\d{4}-\d{2}-\d{2}\z"), t)
    return iso.try_cast("date")


def iso_date(c: Column | str) -> Column:
    """Strictly ``YYYY-MM-DD`` and a real day, else null."""
    t = blank_to_null(c)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}\z"), t).try_cast("date")


def date_text(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")
