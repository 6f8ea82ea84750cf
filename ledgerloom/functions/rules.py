"""Validation rules as data, compiled to Column expressions; one specification per dataset."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.values import blank_to_null


_BETWEEN = "\u001f"  # in no rule name


@dataclass(frozen=True)
class Subtype:
    """A record of type ``value`` in ``column`` must have ``required`` and must not have ``forbidden`` fields."""

    rule: str
    column: str
    value: str
    required: tuple[str, ...]
    forbidden: tuple[str, ...] = ()


@dataclass(frozen=True)
class RuleSpec:
    source: tuple[str, ...]
    types: Mapping[str, str] = field(default_factory=dict)  # column -> Spark type; others are strings
    flags: tuple[str, ...] = ()  # Y/N columns
    upper: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    regex: Mapping[str, str] = field(default_factory=dict)
    domain: Mapping[str, tuple] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    non_negative: tuple[str, ...] = ()
    conditional: tuple[Subtype, ...] = ()


def clean(spec: RuleSpec, name: str, raw: Column) -> Column:
    c = blank_to_null(raw)
    return F.upper(c) if name in spec.upper else c


def typed(spec: RuleSpec, name: str, value: Column, strict_dates: bool = True) -> Column:
    """Typed value of a cleaned text; null where it cannot be read. Dates are real YYYY-MM-DD days if strict."""
    if name in spec.flags:
        return F.when(F.upper(value) == "Y", True).when(F.upper(value) == "N", False)
    kind = spec.types.get(name)
    if kind is None:
        return value
    if kind == "date" and strict_dates:
        return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}\z"), value).try_cast("date")
    return value.try_cast(kind)


def _failed(spec: RuleSpec, text: Mapping[str, Column], value: Mapping[str, Column]) -> Column:
    checks: list[tuple[str, Column]] = [(f"REQUIRED:{n}", value[n].isNull()) for n in spec.required]
    checks += [(f"SAFE_CAST:{n}", text[n].isNotNull() & value[n].isNull()) for n in spec.types]
    checks += [(f"DOMAIN_YN:{n}", text[n].isNotNull() & value[n].isNull()) for n in spec.flags]
    checks += [(f"REGEX:{n}", value[n].isNotNull() & ~value[n].rlike(rf"^(?:{p})\z")) for n, p in spec.regex.items()]
    checks += [(f"DOMAIN:{n}", value[n].isNotNull() & ~value[n].isin(*d)) for n, d in spec.domain.items()]
    checks += [(f"RANGE:{n}", value[n].isNotNull() & ((value[n] < lo) | (value[n] > hi))) for n, (lo, hi) in spec.ranges.items()]
    checks += [(f"NON_NEGATIVE:{n}", value[n].isNotNull() & (value[n] < 0)) for n in spec.non_negative]
    for s in spec.conditional:
        broken = [value[n].isNull() for n in s.required] + [value[n].isNotNull() for n in s.forbidden]
        checks.append((f"CONDITIONAL:{s.rule}", (value[s.column] == s.value) & reduce(lambda a, b: a | b, broken)))
    # concat_ws leaves nulls out and stays inside generated code; filtering an array would interpret every rule
    return F.concat_ws(_BETWEEN, *(F.when(c, F.lit(n)) for n, c in checks))


def judge(df: DataFrame, spec: RuleSpec, raw: Callable[[str], Column] = F.col, prefix: str = "", strict_dates: bool = True) -> DataFrame:
    """``df`` with the cleaned texts ``<prefix>c_<column>``, the typed values ``<prefix>v_<column>`` and
    ``<prefix>failed``: array<string> of the names of failed rules; an undecidable (null) condition does not fail.

    ``raw`` maps a source column to its text. Rule names: REQUIRED, SAFE_CAST, REGEX, DOMAIN, DOMAIN_YN, RANGE and
    NON_NEGATIVE with the source column, CONDITIONAL with the rule's own name. Cleaning, typing and judging are three
    projections, each referring to columns of the one before, so no cast or pattern is evaluated twice. The partition
    id makes the last one opaque to filter pushdown, which would otherwise inline and repeat all of it in the filter.
    """
    c, v = (lambda n: f"{prefix}c_{n}"), (lambda n: f"{prefix}v_{n}")
    cleaned = df.withColumns({c(n): clean(spec, n, raw(n)) for n in spec.source})
    valued = cleaned.withColumns({v(n): typed(spec, n, F.col(c(n)), strict_dates) for n in spec.source})
    names = _failed(spec, {n: F.col(c(n)) for n in spec.source}, {n: F.col(v(n)) for n in spec.source})
    joined = valued.withColumn("_joined", F.when(F.spark_partition_id() >= 0, names))
    failed = F.when(F.col("_joined") == "", F.array().cast("array<string>")).otherwise(F.split("_joined", _BETWEEN))
    return joined.withColumn(f"{prefix}failed", failed).drop("_joined")
