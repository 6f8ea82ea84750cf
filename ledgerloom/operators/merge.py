"""Merging a source into a target: SCD type 1 with guards, soft deletion, idempotent append, monotone watermarks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.control import ACQUIRED, SNAPSHOTS, latest, newest_snapshot

INSERT, UPDATE, STALE, KEEP, MISSING, DELETE = "INSERT", "UPDATE", "STALE", "KEEP", "MISSING", "DELETE_SOFT"


def merge_actions(target: DataFrame, source: DataFrame, key: str, digest: str = "row_hash", day: str = "source_processing_date", deleted: str = "is_deleted") -> DataFrame:
    """One row per key of either side: key, ``source_row``, ``target_row`` (structs) and ``action``.

    A changed (or deleted) target row is updated only by a source row whose day is present and not older than the
    target's (a target without day is always older); otherwise it is STALE. Source keys must be unique; a repeated one
    raises when the result is computed, as a merge with several matches must. Null keys match nothing.
    """
    unique = source.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*source.columns)).alias("source_row"))
    checked = unique.withColumn("source_row", F.when((F.col("_n") > 1) & F.col(key).isNotNull(), F.raise_error(F.concat(F.lit("several source rows for key "), F.col(key).cast("string")))).otherwise(F.col("source_row")))
    left = target.select(F.col(key).alias("_k"), F.struct(*target.columns).alias("target_row"))
    right = checked.select(F.col(key).alias("_sk"), "source_row")
    joined = left.join(right, left["_k"] == right["_sk"], "full_outer")
    s, t = (lambda c: F.col(f"source_row.{c}")), (lambda c: F.col(f"target_row.{c}"))
    changed = (s(digest) != t(digest)) | F.coalesce(t(deleted), F.lit(False))
    fresh = s(day).isNotNull() & (t(day).isNull() | (s(day) >= t(day)))
    action = (
        F.when(F.col("target_row").isNull(), INSERT).when(F.col("source_row").isNull(), MISSING).when(~changed, KEEP).when(fresh, UPDATE).otherwise(STALE)
    )
    return joined.select(F.coalesce("_k", "_sk").alias(key), "source_row", "target_row", action.alias("action"))


def apply_merge(actions: DataFrame, columns: list[str]) -> DataFrame:
    """The target after the merge: inserted and updated rows from the source, all others as they were."""
    take = F.when(F.col("action").isin(INSERT, UPDATE), F.struct(*(F.col(f"source_row.{c}").alias(c) for c in columns))).otherwise(F.struct(*(F.col(f"target_row.{c}").alias(c) for c in columns)))
    return actions.select(take.alias("r")).select("r.*")


def action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def soft_delete(target: DataFrame, snapshot: DataFrame, key: str, until: Column, day: str = "source_processing_date", deleted: str = "is_deleted", stamp: str | None = "load_timestamp") -> DataFrame:
    """``target`` with rows that the snapshot lacks marked deleted, if they are not newer than ``until``."""
    seen = snapshot.select(F.col(key).alias("_seen")).distinct()
    joined = target.join(seen, target[key] == seen["_seen"], "left")
    gone = F.col("_seen").isNull() & ~F.col(deleted) & F.col(day).isNotNull() & (F.col(day) <= until)
    out = {c: F.col(c) for c in target.columns} | {deleted: F.when(gone, True).otherwise(F.col(deleted))}
    if stamp and stamp in target.columns:
        out[stamp] = F.when(gone, F.current_timestamp()).otherwise(F.col(stamp))
    return joined.select(*(v.alias(c) for c, v in out.items()))


def append_once(existing: DataFrame, incoming: DataFrame, identity: list[str]) -> DataFrame:
    """The rows of ``incoming`` (each once) that ``existing`` has not, equal nulls counting as equal."""
    right = existing.select(*(F.col(c).alias(f"_e_{c}") for c in identity)).distinct()
    new = incoming.dropDuplicates(identity)
    on = reduce(lambda a, b: a & b, (new[c].eqNullSafe(right[f"_e_{c}"]) for c in identity))
    return new.join(right, on, "left_anti")


def advance_watermarks(target: DataFrame, source: DataFrame, key: str, value: str) -> DataFrame:
    """Per key the row with the greater value; a lower source value changes nothing, an equal one replaces the row."""
    tagged = target.withColumn("_side", F.lit(0)).unionByName(source.withColumn("_side", F.lit(1)))
    return tagged.groupBy(key).agg(F.max_by(F.struct(*target.columns), F.struct(value, "_side")).alias("r")).select("r.*")


#: Reasons that forbid a soft deletion, as ``deletion_blockers`` and ``call_blockers`` name them.
BLOCKERS = (
    "NOT_ENABLED", "PARTIAL_SCOPE", "UNDATED", "NO_SNAPSHOT", "NOT_ACQUIRED", "NOT_VALIDATED", "NOT_ONE_FILE", "COUNTS_UNKNOWN", "COUNTS_DIFFER", "EMPTY", "QUARANTINED_ROWS", "NOT_NEWEST",
)


def deletion_blockers(manifest: DataFrame, logs: DataFrame, quarantine: DataFrame) -> DataFrame:
    """(dataset, batch_id, blockers) for each batch of the manifest: what in the control tables forbids deletions by it.

    Everything is derived here, for all batches in one plan: the batch's newest manifest row, the acquired files of its
    run, the newest validated snapshot of its dataset and its rows in the Silver quarantine. An empty list permits it.
    """
    mine = ["dataset", "batch_id"]
    batches = latest(manifest, mine, [F.desc("load_timestamp"), F.desc("acquisition_run_id"), F.desc("landing_path")])
    files = manifest.filter(F.col("status").isin(*ACQUIRED)).groupBy("dataset", "acquisition_run_id").agg(F.countDistinct("batch_id").alias("_files"))
    newest = newest_snapshot(manifest, logs).select(*mine, F.lit(True).alias("_newest"))
    held = quarantine.groupBy("dataset", F.col("source_batch_id").alias("batch_id")).agg(F.count(F.lit(1)).alias("_held"))
    known = batches.join(files, ["dataset", "acquisition_run_id"], "left").join(newest, mine, "left").join(held, mine, "left")
    want, got = F.col("expected_run_rows"), F.col("source_rows")
    broken = {
        "NO_SNAPSHOT": ~F.coalesce(F.col("acquisition_strategy").isin(*SNAPSHOTS), F.lit(False)), "NOT_ACQUIRED": ~F.col("status").isin(*ACQUIRED), "NOT_VALIDATED": ~F.coalesce("row_count_validated", F.lit(False)),
        "NOT_ONE_FILE": ~F.col("_files").eqNullSafe(1), "COUNTS_UNKNOWN": want.isNull() | got.isNull(), "COUNTS_DIFFER": want != got, "EMPTY": (want == got) & (got <= 0),
        "QUARANTINED_ROWS": F.col("_held") > 0, "NOT_NEWEST": F.col("_newest").isNull(),
    }
    return known.select(*mine, F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in broken.items()))).alias("blockers"))


def call_blockers(enabled: bool, partial_scope: bool, until: object | None) -> list[str]:
    """What about the call itself forbids deletions: not asked for, a run over a part, no date to bound them."""
    return [n for n, broken in zip(BLOCKERS, (not enabled, partial_scope, until is None)) if broken]
