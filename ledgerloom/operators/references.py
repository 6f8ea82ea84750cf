"""References to records that do not exist.

Method: references are grouped by the null mask of their composite key; every mask is anti-joined on its non-null
columns only, under the declared match semantics. References are first reduced to their distinct keys (map-side
combine), so a key that holds a third of all rows crosses the shuffle once per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

SIMPLE, PARTIAL, FULL = "simple", "partial", "full"


def orphan_keys(references: DataFrame, parents: DataFrame, columns: list[str], match: str = SIMPLE, nullable: list[str] | None = None) -> DataFrame:
    """Distinct key combinations of ``references`` that violate the reference to ``parents`` (same column names).

    SQL match semantics: ``simple`` - a key with any null refers to nothing and is never an orphan; ``partial`` - a
    key is matched by a parent equal in its non-null columns, an all-null key refers to nothing; ``full`` - a key must
    be all null or match completely, so a partly null key is an orphan. ``nullable`` names the columns that may be
    null (all, unless given); a null in another column is treated by the same semantics under the mask of all columns.
    Nulls in parent columns match nothing. Empty references give no orphans; empty parents make every referring key one.
    """
    if match not in (SIMPLE, PARTIAL, FULL):
        raise ValueError(f"unknown match semantics: {match}")
    nullable = columns if nullable is None else nullable
    keys = cut_lineage(references.select(*columns).distinct())  # else each mask would read the references again
    found = []
    for row in keys.select(*(F.col(c).isNull().alias(f"_{i}") for i, c in enumerate(nullable))).distinct().collect():  # the null masks that occur
        mask = dict(zip(nullable, row))
        here = [c for c in columns if not mask.get(c, False)]
        if not here or (match == SIMPLE and len(here) < len(columns)):
            continue
        group = keys.filter(reduce(lambda a, b: a & b, [F.col(c).isNull() if mask.get(c, False) else F.col(c).isNotNull() for c in columns]))
        if match == FULL and len(here) < len(columns):
            found.append(group)
            continue
        targets = parents.select(*here)
        found.append(group.join(targets if here == columns else targets.distinct(), here, "left_anti").select(*columns))
    return reduce(DataFrame.unionByName, found) if found else keys.limit(0)


def orphan_references(references: DataFrame, parents: DataFrame, columns: list[str], period: str, entity: str, match: str = SIMPLE, nullable: list[str] | None = None) -> DataFrame:
    """Rows of ``references`` whose key is an orphan, with the kind of orphan in ``reason``.

    ``period`` is the key column that says when the parent must exist and ``entity`` the one that says which:
    ``DELETED`` if the entity has an earlier parent, else ``LATE`` if it has a later one, else ``MISSING``. A reference
    whose period is null is, under ``partial`` semantics, an orphan only if its entity is unknown altogether; callers
    that need periods before the first use a period lower than all. Repeated references are reported each; other
    columns pass through, one named ``reason`` is replaced.
    Orphan keys are joined back by a null-safe equi-join that AQE may split where a key is hot.
    """
    references = references.drop("reason")
    spans = parents.groupBy(entity).agg(F.min(period).alias("_first"), F.max(period).alias("_last"))
    keys = orphan_keys(references, parents, columns, match, nullable)
    reasons = keys.join(spans, entity, "left").select(
        *columns,
        F.when(F.col("_first") < F.col(period), "DELETED").when(F.col("_last") > F.col(period), "LATE").otherwise("MISSING").alias("reason"),
    )
    nullable = columns if nullable is None else nullable
    right = reasons.select(*(F.col(c).alias(f"__key_{c}") for c in columns), "reason")
    on = reduce(lambda a, b: a & b, [references[c].eqNullSafe(right[f"__key_{c}"]) if c in nullable else references[c] == right[f"__key_{c}"] for c in columns])
    return references.join(right, on).drop(*(f"__key_{c}" for c in columns))


def orphan_report(orphans: DataFrame, table: str, period: Column) -> DataFrame:
    """(table, period, reason, n): the orphans of each table and period, as ``orphan_references`` gives them."""
    return orphans.groupBy(table, period.alias("period"), "reason").agg(F.count(F.lit(1)).alias("n"))
