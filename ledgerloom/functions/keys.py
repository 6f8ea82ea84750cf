"""Digests of ordered values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_digest(columns: list[str]) -> Column:
    """SHA-256 (hex) of the columns as ordered JSON with explicit nulls."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def entity_key(columns: list[str], nullable: list[str] | tuple[str, ...] = ()) -> Column:
    """Digest of the key columns; null unless every column that may not be null is present."""
    ready = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns if c not in nullable), F.lit(True))
    return F.when(ready, json_digest(columns))


def salted_digest(column: Column, salt: str) -> Column:
    """Digest of a private text with a salt; null stays null. The salt is passed at execution and never logged."""
    return F.when(column.isNotNull(), F.sha2(F.concat(F.upper(F.trim(column)), F.lit(salt)), 256))


def severity_group(code: Column) -> Column:
    c = F.upper(code)
    return F.when(c.isin("A", "B", "C"), "A-C").when(c.isin("D", "E", "F"), "D-F").when(c.isin("G", "H", "I"), "G-I").when(c.isin("J", "K", "L"), "J-L")
