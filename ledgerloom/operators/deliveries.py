"""Deliveries and full snapshots, derived from a file manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FULL_STRATEGIES = ("bulk_snapshot", "snapshot_diff")


def newest_batches(manifest: DataFrame, dataset: str) -> DataFrame:
    """One manifest row per batch of ``dataset``: the one with the newest load_timestamp.

    Ties on load_timestamp are settled by the greatest remaining values, so the choice is a function of the data.
    Rows without a batch or run id belong to no delivery. An empty manifest gives an empty result.
    """
    keep = ["load_timestamp", "acquisition_run_id", "as_of_date", "acquisition_strategy", "status", "row_count_validated"]
    newest = (
        manifest.filter((F.col("dataset") == dataset) & F.col("batch_id").isNotNull())
        .groupBy("batch_id")
        .agg(F.max(F.struct(*keep)).alias("m"))
    )
    return newest.select("batch_id", "m.*").filter(F.col("acquisition_run_id").isNotNull())


def full_delivery_batches(manifest: DataFrame, dataset: str) -> DataFrame:
    """Batches of full deliveries: (batch_id, run_id, as_of_date, delivered_at).

    A delivery is full when its strategy is a snapshot and each of its batches succeeded and was row-count validated.
    """
    batches = newest_batches(manifest, dataset)
    ok = (
        F.col("acquisition_strategy").isin(*FULL_STRATEGIES)
        & (F.col("status") == "SUCCESS")
        & F.col("row_count_validated")
    )
    runs = (
        batches.groupBy("acquisition_run_id")
        .agg(
            F.min(F.coalesce(ok, F.lit(False))).alias("full"),
            F.max("as_of_date").alias("as_of_date"),
            F.max("load_timestamp").alias("delivered_at"),
        )
        .filter(F.col("full") & F.col("as_of_date").isNotNull())
        .select(F.col("acquisition_run_id").alias("run_id"), "as_of_date", "delivered_at")
    )
    return batches.select("batch_id", F.col("acquisition_run_id").alias("run_id")).join(runs, "run_id")


def snapshot_calendar(full_batches: DataFrame) -> DataFrame:
    """One row per as_of_date that has a full snapshot: (run_id, as_of_date, idx, next_as_of, last_idx), idx from 0.

    The global window runs over one row per date, a set bounded by the calendar and not by the data.
    """
    chosen = full_batches.groupBy("as_of_date").agg(F.max(F.struct("delivered_at", "run_id")).alias("d"))
    w = Window.orderBy("as_of_date")
    return chosen.select(
        F.col("d.run_id").alias("run_id"),
        "as_of_date",
        (F.row_number().over(w) - 1).alias("idx"),
        F.lead("as_of_date").over(w).alias("next_as_of"),
    )


def snapshot_batches(manifest: DataFrame, dataset: str) -> DataFrame:
    """Batches that make up the full snapshots: (batch_id, idx, as_of_date, next_as_of)."""
    full = full_delivery_batches(manifest, dataset)
    return full.select("batch_id", "run_id").join(snapshot_calendar(full), "run_id").select("batch_id", "idx", "as_of_date", "next_as_of")


def newest_non_blank(value, stamp):
    """Aggregate: the non-blank value with the newest stamp; equal stamps are settled by the greatest value."""
    present = value.isNotNull() & (F.trim(value.cast("string")) != "")
    return F.max(F.when(present, F.struct(stamp.alias("at"), value.alias("value"))))["value"]
