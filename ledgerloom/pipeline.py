"""The two pipelines end to end: landed files to Bronze, Bronze batches to Silver, with control tables and audit."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.headers import Assessment
from ledgerloom.operators import control, merge
from ledgerloom.operators.audit import DRIFT_SCHEMA, LEGACY_QUARANTINE_SCHEMA, LOG_SCHEMA, MANIFEST_SCHEMA, SILVER_QUARANTINE_SCHEMA, WATERMARK_SCHEMA, audited
from ledgerloom.operators.classify import CONFLICT, INVALID, conservation, silver_schema, transform
from ledgerloom.operators.versioned import CURRENT, BatchTable, ConcurrentChange, VersionedTable
from ledgerloom.sources.files import QUARANTINE, BreakingDrift, Landed, bronze_schema, load_file
from ledgerloom.spec import REGISTRY, DatasetSpec, dataset as spec_of


class PipelineFailed(RuntimeError):
    """Some batches failed, each logged; the others were committed."""

    def __init__(self, failures: list[dict]):
        super().__init__(f"{len(failures)} batches failed: " + "; ".join(f"{f['batch_id']}: {f['error']}" for f in failures[:5]))
        self.failures = failures


class Lake:
    """All tables of one deployment below ``root``: six control tables, a Bronze and a Silver table per dataset."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        control_table = lambda name, schema: VersionedTable(spark, f"{root}/{name}", schema)
        self.manifest = control_table("source_file_manifest", MANIFEST_SCHEMA)
        self.logs = control_table("pipeline_execution_logs", LOG_SCHEMA)
        self.watermarks = control_table("ingestion_watermarks", WATERMARK_SCHEMA)
        self.drift = control_table("schema_drift_log", DRIFT_SCHEMA)
        self.silver_quarantine = control_table("silver_quarantine", SILVER_QUARANTINE_SCHEMA)
        self.bronze_quarantine = BatchTable(spark, f"{root}/bronze_quarantine", QUARANTINE, "batch_id")

    def bronze(self, spec: DatasetSpec) -> BatchTable:
        return BatchTable(self.spark, f"{self.root}/{spec.bronze_table}", bronze_schema(spec))

    def silver(self, spec: DatasetSpec) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{spec.silver_table}", silver_schema(spec))

    def ensure(self) -> dict[str, str]:
        """Create what is missing and verify the rest: table -> CREATED or VERIFIED."""
        tables = [self.manifest, self.logs, self.watermarks, self.drift, self.silver_quarantine, *(self.silver(s) for s in REGISTRY.values())]
        return {t.root.rsplit("/", 1)[1]: t.ensure() for t in tables}

    def rows(self, rows: list[dict], schema: T.StructType) -> DataFrame:
        return self.spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)

    def change(self, table: VersionedTable, make: Callable[[DataFrame], DataFrame], operation: str, tries: int = 5) -> None:
        """Replace the rows of a table by a function of them; again if another writer came in between."""
        for n in range(tries):
            version = table.version()
            try:
                table.publish(make(table.read(version)), operation, based_on=version)
                return
            except ConcurrentChange:
                if n == tries - 1:
                    raise


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _told(error: BaseException) -> str:
    return f"{type(error).__name__}: {error}"[:2000]


# ---- landing to Bronze ----------------------------------------------------------------------------------------------------


@dataclass
class BronzeRun:
    """What one run did: a row per loaded file, a row per failed one, and the verdict on every acquisition run in scope."""

    loaded: list[dict] = field(default_factory=list)
    failures: list[dict] = field(default_factory=list)
    reconciled: list[dict] = field(default_factory=list)


#: Schemas of what a run reports.
LOADED = "acquisition_run_id string, dataset string, batch_id string, status string, rows_read bigint, rows_inserted bigint, rows_quarantined bigint, added_columns array<string>"
FAILED = "acquisition_run_id string, dataset string, batch_id string, source_file string, error string"
RECONCILED = "dataset string, acquisition_run_id string, complete boolean, expected_rows bigint, parsed_rows bigint, watermark_value date, problem string"
PROCESSED = "dataset string, batch_id string, rows_read bigint, rows_inserted bigint, rows_updated bigint, rows_deleted bigint, rows_quarantined bigint, rows_stale bigint, statuses map<string,bigint>, blockers array<string>"


def report(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Rows of a run as an ordered frame of a declared schema, also where there are none."""
    names = T._parse_datatype_string(schema).names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema).orderBy("dataset", *(n for n in ("acquisition_run_id", "batch_id") if n in names))


def _drift_rows(found: Assessment, item: dict, run_id: str) -> list[dict]:
    base = {"run_id": run_id, "batch_id": item["batch_id"], "dataset": item["dataset"], "source_file": item["landing_path"], "source_file_sha256": item["source_file_sha256"], "load_timestamp": _now()}
    return [base | {"drift_type": kind, "column_name": name or None, "detail": detail} for kind, name, detail in found.records()]


def _landed(item: dict) -> Landed:
    text = lambda d: d and d.isoformat()
    return Landed(
        item["landing_path"], item["batch_id"], item["load_type"], item["as_of_date"].isoformat(), item["source_file_sha256"], item["source_bytes"], item["expected_run_rows"],
        text(item["window_start"]), text(item["window_end"]),
    )


def _load_item(lake: Lake, item: dict, run_id: str, logs: list[dict], drift: list[dict]) -> dict:
    """One file into Bronze and the Bronze quarantine, each batch replaced as a whole; returns its counts."""
    spec = spec_of(item["dataset"])
    parameter = f"acquisition_run_id={item['acquisition_run_id']};strategy={item['acquisition_strategy']};path={item['landing_path']}"
    fields = {"run_id": run_id, "batch_id": item["batch_id"], "pipeline_layer": "Raw-to-Bronze", "dataset": item["dataset"], "load_type": item["load_type"], "parameter_processed": parameter}
    paged = item["acquisition_strategy"] == "api_date_window"
    with audited(logs.append, **fields) as record:
        if not paged and item["acquisition_strategy"] not in control.SNAPSHOTS:
            raise ValueError(f"unknown acquisition strategy {item['acquisition_strategy']!r}")
        if paged == item["landing_path"].lower().endswith(".csv"):
            raise ValueError(f"{item['landing_path']} is no file of strategy {item['acquisition_strategy']}")
        try:
            loaded = load_file(lake.spark, _landed(item), spec)
        except BreakingDrift as error:
            drift += _drift_rows(error.assessment, item, run_id)
            raise
        try:
            drift += _drift_rows(loaded.drift, item, run_id)
            record["rows_read"], bad = loaded.counts()
            record["rows_quarantined"] = lake.bronze_quarantine.replace(loaded.corrupt, item["batch_id"])
            record["rows_inserted"] = lake.bronze(spec).replace(loaded.good, item["batch_id"])
            if bad != record["rows_quarantined"] or record["rows_read"] != record["rows_inserted"] + record["rows_quarantined"]:
                raise ValueError("rows written are not the rows read")
        finally:
            loaded.release()
    out = {k: record[k] for k in ("rows_read", "rows_inserted", "rows_quarantined")}
    status = "QUARANTINED_PARTIAL" if out["rows_quarantined"] else "SUCCESS"
    return {k: item[k] for k in ("acquisition_run_id", "dataset", "batch_id")} | {"status": status, "added_columns": list(loaded.drift.added.values())} | out


def run_bronze(
    lake: Lake, run_id: str, *, dataset: str | None = None, load_type: str | None = None, acquisition_run_id: str | None = None, source_path: str | None = None, reprocess: bool = False, parallel: int = 4, group: int = 32
) -> BronzeRun:
    """Load the pending files of the manifest, then judge every acquisition run in scope and commit the complete ones.

    A file that fails is logged and does not keep the others from Bronze. Files are loaded ``parallel`` at a time and
    committed in groups: data first (replaced by batch, so a repetition changes nothing), then the drift found (also that
    of refused files), the manifest's row counts and last the audit rows, by which a batch counts as done. A job lost in
    between repeats the group. Of a complete run the watermark is committed first, then its manifest rows are marked.
    """
    scope, process = control.manifest_selection(lake.manifest.read(), lake.logs.read(), dataset, load_type, acquisition_run_id, source_path, reprocess)
    runs = scope.select("dataset", "acquisition_run_id").distinct().collect()  # acquisition runs that are not closed
    items = [r.asDict() for r in process.orderBy("load_timestamp", "dataset", F.col("page_offset").asc_nulls_first(), "batch_id").collect()]  # files to load, which the driver schedules
    out = BronzeRun()
    for lo in range(0, len(items), group):
        logs: list[dict] = []
        drift: list[dict] = []
        lock = threading.Lock()
        counts: dict[tuple[str, str], int] = {}

        def work(item: dict) -> None:
            try:
                done = _load_item(lake, item, run_id, logs, drift)
                with lock:
                    out.loaded.append(done)
                    counts[item["dataset"], item["batch_id"]] = done["rows_read"]
            except Exception as error:  # logged by its audit; the others go on
                with lock:
                    out.failures.append({k: item[k] for k in ("acquisition_run_id", "dataset", "batch_id")} | {"source_file": item["landing_path"], "error": _told(error)})

        with ThreadPoolExecutor(max(1, parallel)) as pool:
            list(pool.map(work, items[lo : lo + group]))
        if drift:
            lake.drift.append(lake.rows(drift, DRIFT_SCHEMA))
        if counts:
            parsed = F.broadcast(lake.spark.createDataFrame([(*k, n) for k, n in counts.items()], "dataset string, batch_id string, _parsed bigint"))  # one row per file of the group
            lake.change(lake.manifest, lambda m: m.join(parsed, ["dataset", "batch_id"], "left").withColumn("source_rows", F.coalesce("_parsed", "source_rows")), "UPDATE source_rows")
        lake.logs.append(lake.rows(logs, LOG_SCHEMA))
    if runs:
        out.reconciled = reconcile_and_commit(lake, [(r["dataset"], r["acquisition_run_id"]) for r in runs], run_id, run_id if reprocess else None)
    return out


def reconcile_and_commit(lake: Lake, runs: list[tuple[str, str]], bronze_run_id: str, require: str | None = None) -> list[dict]:
    """Judge acquisition runs; commit watermark, then flag, of the complete ones. Repeating it after a crash is safe."""
    asked = F.broadcast(lake.spark.createDataFrame(runs, "dataset string, acquisition_run_id string"))  # the runs in scope
    verdicts = [r.asDict() for r in control.reconcile_runs(lake.manifest.read().join(asked, ["dataset", "acquisition_run_id"], "left_semi"), lake.logs.read(), require).collect()]  # one row per run
    complete = [v for v in verdicts if v["complete"]]
    marks = [
        {"dataset": v["dataset"], "watermark_column": w, "watermark_value": v["watermark_value"], "last_successful_acquisition_run_id": v["acquisition_run_id"], "last_successful_bronze_run_id": bronze_run_id, "load_timestamp": _now()}
        for v in complete if (w := spec_of(v["dataset"]).watermark)
    ]
    if marks:
        newest: dict[str, dict] = {}
        for m in sorted(marks, key=lambda m: (m["watermark_value"], m["last_successful_acquisition_run_id"])):
            newest[m["dataset"]] = m
        lake.change(lake.watermarks, lambda w: merge.advance_watermarks(w, lake.rows(list(newest.values()), WATERMARK_SCHEMA), "dataset", "watermark_value"), "MERGE watermarks")
    if complete:
        done = F.broadcast(lake.spark.createDataFrame([(v["dataset"], v["acquisition_run_id"], True) for v in complete], "dataset string, acquisition_run_id string, _done boolean"))
        lake.change(lake.manifest, lambda m: m.join(done, ["dataset", "acquisition_run_id"], "left").withColumn("row_count_validated", F.coalesce("_done", "row_count_validated")), "UPDATE row_count_validated")
    return verdicts


# ---- Bronze to Silver -----------------------------------------------------------------------------------------------------


@dataclass
class SilverRun:
    """What one run did: a row per processed batch and the batches outside the asked ingestion dates."""

    processed: list[dict] = field(default_factory=list)
    outside: list[dict] = field(default_factory=list)


def _silver_item(lake: Lake, item: dict, run_id: str, salt: str, allow_soft_deletes: bool, partial: bool, first: str | None, last: str | None, strict_dates: bool, logs: list[dict]) -> dict | None:
    spec = spec_of(item["dataset"])
    parameter = f"acquisition_run_id={item['acquisition_run_id']};batch_id={item['batch_id']};ingest_from={first or ''};ingest_to={last or ''};allow_soft_deletes={str(allow_soft_deletes).lower()}"
    fields = {"run_id": run_id, "batch_id": item["batch_id"], "pipeline_layer": "Bronze-to-Silver", "dataset": item["dataset"], "load_type": item["load_type"], "parameter_processed": parameter}
    with audited(logs.append, **fields) as record:
        table, batch = lake.bronze(spec), item["batch_id"]
        inside = (F.lit(True) if not first else F.col("_ingest_date") >= F.lit(first).cast("date")) & (F.lit(True) if not last else F.col("_ingest_date") <= F.lit(last).cast("date"))
        seen = table.read(batch).agg(F.count(F.lit(1)).alias("all"), F.count_if(inside).alias("inside")).first()
        if not seen["all"]:
            raise ValueError(f"batch {batch} has no rows in {spec.bronze_table}")
        if not seen["inside"]:
            record["suppress"] = True
            return None
        if seen["inside"] < seen["all"]:
            raise ValueError(f"the ingestion dates select {seen['inside']} of {seen['all']} rows of batch {batch}; part of a batch cannot be finished")
        record["rows_read"] = seen["all"]
        done = transform(table.slice(batch, "_ingest_date", first, last), spec, salt, strict_dates)
        counts = conservation(done)
        record["rows_quarantined"] = counts[INVALID] + counts[CONFLICT]
        identity = [c for c in SILVER_QUARANTINE_SCHEMA.names if c != "load_timestamp"]
        held = lake.silver_quarantine.read().filter(F.col("source_batch_id") == batch)
        if record["rows_quarantined"]:
            lake.silver_quarantine.append(merge.append_once(held, done.quarantine, identity))
        merged = lake.silver(spec).merge(done.silver, spec.entity_key)
        record["rows_inserted"], record["rows_updated"] = merged["inserted"], merged["updated"]
        until = done.silver.agg(F.max("source_processing_date").alias("d")).first()["d"]
        blockers = merge.call_blockers(allow_soft_deletes, partial, until)
        mine = merge.deletion_blockers(lake.manifest.read(), lake.logs.read(), lake.silver_quarantine.read()).filter((F.col("dataset") == spec.name) & (F.col("batch_id") == batch)).first()
        blockers += mine["blockers"]
        if not blockers:
            record["rows_deleted"] = _delete_missing(lake.silver(spec), done.silver, spec.entity_key, until)
    kept = {k: record[k] for k in ("rows_read", "rows_inserted", "rows_updated", "rows_deleted", "rows_quarantined")}
    return {"dataset": spec.name, "batch_id": batch, **kept, "rows_stale": merged["stale"], "statuses": counts, "blockers": blockers}


def _delete_missing(table: VersionedTable, snapshot: DataFrame, key: str, until: dt.date) -> int:
    version = table.version()
    old = table.read(version)
    after = merge.soft_delete(old, snapshot, key, F.lit(until))
    gone = after.filter("is_deleted").count() - old.filter("is_deleted").count()
    if gone:
        table.publish(after, "SOFT DELETE", {"deleted": gone}, based_on=version)
    return gone


def run_silver(
    lake: Lake, run_id: str, salt: str, *, dataset: str | None = None, load_type: str | None = None, acquisition_run_id: str | None = None, batch_ids: list[str] | None = None, ingest_from: str | None = None,
    ingest_to: str | None = None, reprocess: bool = False, allow_soft_deletes: bool = False, strict_dates: bool = False,
) -> SilverRun:
    """Bring the pending Bronze batches into Silver in order of arrival; raises ``PipelineFailed`` at the end if any failed.

    Each batch: all of its rows or none; classified once, counted against what was read; rejected rows appended to the
    quarantine unless they are there; accepted rows merged; rows a complete snapshot lacks marked as deleted if nothing
    forbids it. The audit row of a batch is written when it ends, so a lost job repeats only what it was doing.
    """
    if ingest_from and ingest_to and ingest_from > ingest_to:
        raise ValueError("the first ingestion date is after the last")
    if (state := lake.silver_quarantine.schema_state(LEGACY_QUARANTINE_SCHEMA)) != CURRENT:
        raise RuntimeError(f"the Silver quarantine is {state}; it must be migrated first")
    work = control.silver_work(lake.manifest.read(), lake.logs.read(), dataset, load_type, acquisition_run_id, reprocess)
    work = work.filter(F.col("batch_id").isin(*batch_ids)) if batch_ids else work
    partial = bool(acquisition_run_id or batch_ids or ingest_from or ingest_to or reprocess)
    out, failures = SilverRun(), []
    for item in [r.asDict() for r in work.orderBy("load_timestamp", "dataset", F.col("page_offset").asc_nulls_first(), "batch_id").collect()]:  # batches to merge, one after the other
        logs: list[dict] = []
        try:
            done = _silver_item(lake, item, run_id, salt, allow_soft_deletes, partial, ingest_from, ingest_to, strict_dates, logs)
            (out.outside if done is None else out.processed).append(done or {k: item[k] for k in ("dataset", "batch_id")})
        except Exception as error:  # logged by its audit; the next batch goes on
            failures.append({k: item[k] for k in ("dataset", "batch_id")} | {"error": _told(error)})
        lake.logs.append(lake.rows(logs, LOG_SCHEMA))
    if failures:
        raise PipelineFailed(failures)
    return out
