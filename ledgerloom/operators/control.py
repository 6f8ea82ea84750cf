"""Incremental control: what to load, what is complete, how far the extraction has come."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Vocabularies of the control tables.
LAYERS = ("CMS-to-Landing", "Raw-to-Bronze", "Bronze-to-Silver")
LOAD_TYPES = ("full", "incremental")
STATUSES = ("SUCCESS", "SKIPPED_ALREADY_ACQUIRED", "FAILURE", "QUARANTINED_PARTIAL")
ACQUIRED = ("SUCCESS", "SKIPPED_ALREADY_ACQUIRED")
SILVER_TERMINAL = ("SUCCESS", "QUARANTINED_PARTIAL")
SNAPSHOTS = ("bulk_snapshot", "snapshot_diff")
PAGE_ROWS = 500


def latest(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group under ``order``."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_rn = 1").drop("_rn")


def succeeded(logs: DataFrame, layer: str, statuses: tuple[str, ...] = ("SUCCESS",), run_id: str | None = None) -> DataFrame:
    """Distinct (dataset, batch_id) with a log of one of the statuses in a layer."""
    found = logs.filter((F.col("pipeline_layer") == layer) & F.col("status").isin(*statuses))
    return (found.filter(F.col("run_id") == run_id) if run_id else found).select("dataset", "batch_id").distinct()


def _narrow(manifest: DataFrame, dataset: str | None, load_type: str | None, run_id: str | None) -> DataFrame:
    if load_type and load_type not in LOAD_TYPES:
        raise ValueError(f"load type must be one of {LOAD_TYPES}")
    out = manifest.filter(F.col("status").isin(*ACQUIRED))
    for column, value in (("dataset", dataset), ("load_type", load_type), ("acquisition_run_id", run_id)):
        out = out.filter(F.col(column) == value) if value else out
    return out


def manifest_selection(manifest: DataFrame, logs: DataFrame, dataset: str | None = None, load_type: str | None = None, run_id: str | None = None, source_path: str | None = None, reprocess: bool = False) -> tuple[DataFrame, DataFrame]:
    """(scope, process): scope = newest row per run, batch and path that is not validated or whose batch has no
    successful Bronze log; process = newest per batch of those without such a log. ``reprocess`` takes all.
    """
    rows = _narrow(manifest, dataset, load_type, run_id)
    if source_path:
        rows = rows.filter(F.col("landing_path") == source_path)
        if rows.isEmpty():
            raise ValueError(f"no successful acquisition of {source_path}")
    items = latest(rows, ["acquisition_run_id", "dataset", "batch_id", "landing_path"], [F.desc("load_timestamp")])
    done = succeeded(logs, "Raw-to-Bronze").withColumn("_done", F.lit(True))
    marked = items.join(done, ["dataset", "batch_id"], "left").withColumn("_done", F.coalesce("_done", F.lit(False)))
    scope = marked if reprocess else marked.filter(~F.coalesce("row_count_validated", F.lit(False)) | ~F.col("_done"))
    todo = scope if reprocess else scope.filter(~F.col("_done"))
    process = latest(todo, ["dataset", "batch_id"], [F.desc("load_timestamp"), F.col("landing_path")])
    return scope.drop("_done"), process.drop("_done")


def silver_work(manifest: DataFrame, logs: DataFrame, dataset: str | None = None, load_type: str | None = None, run_id: str | None = None, reprocess: bool = False) -> DataFrame:
    """Batches with a successful Bronze log and no finished Silver one, with the number of files of their run."""
    rows = _narrow(manifest, dataset, load_type, run_id)
    files = rows.groupBy("dataset", "acquisition_run_id").agg(F.countDistinct("batch_id").alias("acquisition_file_count"))
    items = latest(rows, ["dataset", "batch_id"], [F.desc("load_timestamp")]).join(files, ["dataset", "acquisition_run_id"], "left")
    ready = items.join(succeeded(logs, "Raw-to-Bronze"), ["dataset", "batch_id"], "left_semi")
    return ready if reprocess else ready.join(succeeded(logs, "Bronze-to-Silver", SILVER_TERMINAL), ["dataset", "batch_id"], "left_anti")


def contiguous(lo: Column, hi: Column, distinct: Column, n: Column, step: int = PAGE_ROWS) -> Column:
    """Whether ``n`` offsets, ``distinct`` of them different, from ``lo`` to ``hi`` are 0, step, 2 step, ... without a hole or repetition."""
    return (distinct == n) & (lo == 0) & (hi == (n - 1) * step)


def reconcile_runs(manifest: DataFrame, logs: DataFrame, bronze_run: str | None = None) -> DataFrame:
    """One row per acquisition run: (dataset, acquisition_run_id, complete, expected_rows, parsed_rows, watermark_value,
    problem). All runs are judged in one aggregation; the first failing test names the problem. ``bronze_run`` accepts
    only the Bronze logs of that run.
    """
    items = latest(manifest.filter(F.col("status").isin(*ACQUIRED)), ["acquisition_run_id", "dataset", "batch_id", "landing_path"], [F.desc("load_timestamp")])
    done = succeeded(logs, "Raw-to-Bronze", run_id=bronze_run).withColumn("_done", F.lit(1))
    joined = items.join(done, ["dataset", "batch_id"], "left")
    paged = F.col("acquisition_strategy") == "api_date_window"
    runs = joined.groupBy("dataset", "acquisition_run_id").agg(
        F.countDistinct("expected_run_rows").alias("kinds"), F.max("expected_run_rows").alias("expected_rows"),
        F.sum("source_rows").alias("parsed_rows"), F.count_if(F.col("source_rows").isNull()).alias("unparsed"),
        F.count_if(F.col("_done").isNull()).alias("open"), F.count(F.lit(1)).alias("files"), F.max(paged.cast("int")).alias("paged"),
        F.count_if(F.col("page_offset").isNull()).alias("no_offset"), F.countDistinct("page_offset").alias("offsets"), F.min("page_offset").alias("lo"), F.max("page_offset").alias("hi"),
        F.count_if(F.col("page_offset") % PAGE_ROWS != 0).alias("off_grid"),
        F.countDistinct("window_end").alias("ends"), F.max("window_end").alias("window_end"), F.countDistinct("as_of_date").alias("dates"), F.max("as_of_date").alias("as_of"),
    )
    gap = ~contiguous(F.col("lo"), F.col("hi"), F.col("offsets"), F.col("files")) | (F.col("off_grid") > 0)
    problem = (
        F.when(F.col("kinds") != 1, "no single expected row count")
        .when(F.col("unparsed") > 0, "a file is not parsed")
        .when(F.col("parsed_rows") != F.col("expected_rows"), "parsed rows differ from expected rows")
        .when((F.col("paged") == 1) & (F.col("no_offset") > 0), "a page has no offset")
        .when((F.col("paged") == 1) & gap, "page offsets are not contiguous")
        .when(F.col("open") > 0, "a batch has no successful Bronze log")
        .when(F.col("ends") > 1, "several window ends")
        .when((F.col("ends") == 0) & (F.col("dates") != 1), "several as-of dates")
    )
    mark = F.when(problem.isNull(), F.coalesce(F.col("window_end"), F.col("as_of")))
    return runs.select("dataset", "acquisition_run_id", problem.isNull().alias("complete"), "expected_rows", "parsed_rows", mark.alias("watermark_value"), problem.alias("problem"))


def complete_windows(manifest: DataFrame, logs: DataFrame) -> DataFrame:
    """Runs of incremental date windows whose pages are complete: (dataset, window_start, window_end, acquisition_run_id,
    paths, bronze_complete), the newest run per window. ``bronze_complete`` false means pending.

    ``paths`` are the pages of the run, for ``with_files`` to test that they are still there.
    """
    rows = manifest.filter((F.col("acquisition_strategy") == "api_date_window") & (F.col("load_type") == "incremental"))
    done = succeeded(logs, "Raw-to-Bronze").withColumn("_done", F.lit(1))
    runs = rows.join(done, ["dataset", "batch_id"], "left").groupBy("dataset", "window_start", "window_end", "acquisition_run_id").agg(
        F.countDistinct("expected_run_rows").alias("kinds"), F.max("expected_run_rows").alias("expected"), F.sum("source_rows").alias("got"),
        F.count_if(F.col("source_rows").isNull() | ~F.col("status").isin(*ACQUIRED)).alias("broken"), F.count(F.lit(1)).alias("n"),
        F.countDistinct("page_offset").alias("offsets"), F.min("page_offset").alias("lo"), F.max("page_offset").alias("hi"),
        F.count_if(F.col("_done").isNull()).alias("open"), F.max("load_timestamp").alias("at"), F.sort_array(F.collect_set("landing_path")).alias("paths"),
    )
    whole = runs.filter("kinds = 1 AND broken = 0 AND got = expected").filter(contiguous(F.col("lo"), F.col("hi"), F.col("offsets"), F.col("n")))
    newest = latest(whole.filter(F.col("window_start").isNotNull() | F.col("window_end").isNotNull()), ["dataset", "window_start", "window_end"], [F.desc("at"), F.desc("acquisition_run_id")])
    return newest.select("dataset", "window_start", "window_end", "acquisition_run_id", "paths", (F.col("open") == 0).alias("bronze_complete"))


def with_files(windows: DataFrame, listing: DataFrame) -> DataFrame:
    """Windows all of whose pages are in ``listing`` (path), the files of the landing folder as ``landed_files`` lists them."""
    pages = windows.select("dataset", "acquisition_run_id", "window_start", "window_end", F.explode("paths").alias("path"))
    lost = pages.join(listing.select("path").distinct(), "path", "left_anti").select("dataset", "acquisition_run_id").distinct()
    return windows.join(lost, ["dataset", "acquisition_run_id"], "left_anti")


def pending_windows(windows: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Complete windows that end after the committed watermark of their dataset and have not fully reached Bronze."""
    return windows.join(current_watermark(watermarks), "dataset").filter((F.col("window_end") > F.col("watermark_value")) & ~F.col("bronze_complete")).drop("watermark_value")


def newest_snapshot(manifest: DataFrame, logs: DataFrame) -> DataFrame:
    """Per dataset the newest validated snapshot whose batch reached Bronze."""
    good = manifest.filter(F.col("status").isin(*ACQUIRED) & F.col("row_count_validated") & F.col("acquisition_strategy").isin(*SNAPSHOTS))
    ready = good.join(succeeded(logs, "Raw-to-Bronze"), ["dataset", "batch_id"], "left_semi")
    return latest(ready, ["dataset"], [F.desc("as_of_date"), F.desc("load_timestamp"), F.desc("batch_id")])  # a tie must not depend on the plan


def current_watermark(watermarks: DataFrame) -> DataFrame:
    return watermarks.groupBy("dataset").agg(F.max_by("watermark_value", "load_timestamp").alias("watermark_value"))


def window_start(explicit: dt.date | None, watermark: dt.date | None, overlap_days: int = 60) -> dt.date:
    """An explicit start wins, else the watermark less the overlap; without either there is no silent full history."""
    if explicit:
        return explicit
    if watermark is None:
        raise ValueError("no watermark: load in full first or give a start")
    return watermark - dt.timedelta(days=overlap_days)


def window_starts(watermarks: DataFrame, overlap_days: int = 60) -> DataFrame:
    """(dataset, watermark_value, window_start): where the next window of each dataset with a watermark starts."""
    return current_watermark(watermarks).withColumn("window_start", F.date_sub("watermark_value", overlap_days))


def pending_keys(bronze_done: set[tuple[str, str]], silver_done: set[tuple[str, str]]) -> list[tuple[str, str]]:
    return sorted(bronze_done - silver_done)


