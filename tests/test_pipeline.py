import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import control, evidence, merge
from ledgerloom.operators.audit import LEGACY_QUARANTINE_SCHEMA, MANIFEST_SCHEMA
from ledgerloom.operators.versioned import VersionedTable
from ledgerloom.pipeline import FAILED, LOADED, PROCESSED, RECONCILED, Lake, PipelineFailed, report, run_bronze, run_silver
from ledgerloom.spec import PENALTY_COLUMNS, PROVIDER_COLUMNS, dataset

D, T0 = dt.date, dt.datetime(2024, 3, 1)
FINE = dict(cms_certification_number_ccn="012345", penalty_date="2024-01-05", penalty_type="Fine", fine_id="F1", fine_amount="10.50", provider_address="1 Main St", processing_date="2024-02-01")


def quoted(cells):
    return ",".join('"' + (c or "").replace('"', '""') + '"' for c in cells)


def csv(path, columns, rows, tail=""):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(columns), *(quoted([r.get(c) for c in columns]) for r in rows)]) + "\n" + tail)
    return path


def page(path, rows, total, **meta):
    path.parent.mkdir(parents=True, exist_ok=True)
    base = {"dataset_id": dataset("penalties").dataset_id, "filter": "penalty_date >= 2024-01-01 AND penalty_date <= 2024-02-28", "rows_available": total, "rows_in_file": len(rows), "load_type": "incremental"}
    path.write_text(json.dumps({"_meta": base | meta, "results": rows}))
    return path


def entry(path, name, run, batch, day, **kw):
    data = path.read_bytes()
    digest = hashlib.sha256(data).hexdigest()
    paged = path.suffix == ".json"
    row = {
        "acquisition_run_id": run, "dataset": name, "dataset_id": dataset(name).dataset_id, "load_type": "incremental" if paged else "full", "as_of_date": D(2024, 2, day),
        "acquisition_strategy": "api_date_window" if paged else "snapshot_diff", "source_url": "u", "landing_path": str(path), "batch_id": batch, "source_content_sha256": digest,
        "source_file_sha256": digest.upper(), "source_bytes": len(data), "row_count_validated": False, "status": "SUCCESS", "load_timestamp": T0 + dt.timedelta(days=day),
    }
    return row | ({"window_start": D(2024, 1, 1), "window_end": D(2024, 2, 28), "page_offset": 0} if paged else {}) | kw


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert set(lake.ensure().values()) == {"CREATED"} and set(lake.ensure().values()) == {"VERIFIED"}
    return lake


def announce(lake, *rows):
    lake.manifest.append(lake.rows(list(rows), MANIFEST_SCHEMA))


def test_files_fail_alone_and_complete_runs_are_committed(spark, tmp_path, lake):
    land = tmp_path / "land"
    pages = [dict.fromkeys(PENALTY_COLUMNS) | FINE | {"fine_id": f"F{i}"} for i in range(3)]
    good = entry(page(land / "p0.json", pages, 3), "penalties", "r1", "b1", 1, expected_run_rows=3)
    empty = entry(page(land / "e0.json", [], 0, rows_available=0, filter="penalty_date >= 2024-03-01 AND penalty_date <= 2024-03-31"), "penalties", "r2", "b2", 2, expected_run_rows=0, window_start=D(2024, 3, 1), window_end=D(2024, 3, 31))
    broken = entry(page(land / "x0.json", pages, 3), "penalties", "r3", "b3", 3, expected_run_rows=3, source_bytes=1)
    other = entry(page(land / "w0.json", pages, 3, filter="penalty_date >= 2024-01-01 AND penalty_date <= 2024-01-31"), "penalties", "r4", "b4", 4, expected_run_rows=3)
    renamed = entry(csv(land / "d.csv", [*PENALTY_COLUMNS[:-1], "Released On"], [FINE]), "penalties", "r5", "b5", 5, expected_run_rows=1)
    partial = entry(csv(land / "q.csv", [*PENALTY_COLUMNS, "Note"], [FINE], "a,b\n"), "penalties", "r6", "b6", 6, expected_run_rows=2)
    announce(lake, good, empty, broken, other, renamed, partial)
    run = run_bronze(lake, "one")
    assert {r["batch_id"]: (r["status"], r["rows_read"], r["rows_quarantined"]) for r in run.loaded} == {"b1": ("SUCCESS", 3, 0), "b2": ("SUCCESS", 0, 0), "b6": ("QUARANTINED_PARTIAL", 2, 1)}
    assert {r["batch_id"] for r in run.failures} == {"b3", "b4", "b5"} and any("filter" in r["error"] for r in run.failures)
    verdicts = {r["acquisition_run_id"]: r["problem"] for r in run.reconciled}
    assert verdicts["r1"] is None and verdicts["r2"] is None and "not parsed" in verdicts["r3"] and "no successful Bronze log" in verdicts["r6"]
    assert {(r["batch_id"], r["drift_type"]) for r in lake.drift.read().collect()} == {("b5", "MISSING_COLUMN"), ("b5", "RENAMED_OR_UNMAPPED_COLUMN"), ("b6", "ADDED_COLUMN")}
    assert lake.watermarks.read().first()["watermark_value"] == D(2024, 3, 31)
    assert {r["batch_id"] for r in lake.manifest.read().filter("row_count_validated").collect()} == {"b1", "b2"}
    assert {r["status"] for r in lake.logs.read().collect()} == {"SUCCESS", "FAILURE", "QUARANTINED_PARTIAL"}
    assert lake.bronze(dataset("penalties")).read(evolve=True).count() == 4 and lake.bronze_quarantine.read().count() == 1
    assert evidence.drift_listing(lake.drift.read(), lake.manifest.read().filter("batch_id = 'b5'")).count() == 2 and evidence.watermark_listing(lake.watermarks.read(), "penalties").count() == 1
    shown = [report(spark, rows, schema) for rows, schema in ((run.loaded, LOADED), (run.failures, FAILED), (run.reconciled, RECONCILED), ([], PROCESSED))]
    assert [f.count() for f in shown] == [3, 3, 6, 0] and [r["batch_id"] for r in shown[0].collect()] == ["b1", "b2", "b6"]
    again = run_bronze(lake, "two")  # what succeeded is not loaded again; what is broken fails again
    assert {r["batch_id"] for r in again.loaded} == {"b6"} and {r["batch_id"] for r in again.failures} == {"b3", "b4", "b5"}
    back = run_bronze(lake, "three", reprocess=True, source_path=good["landing_path"])
    assert [r["rows_inserted"] for r in back.loaded] == [3] and lake.bronze(dataset("penalties")).read("b1").count() == 3
    found = {r["batch_id"]: (r["attempts"], r["bronze_rows"], r["idempotent"]) for r in evidence.rerun_idempotency(lake.bronze(dataset("penalties")).read(), lake.logs.read()).collect()}
    assert found == {"b1": (2, 3, True), "b2": (1, 0, True)}
    lake.bronze(dataset("penalties")).storage.remove("_batch_id=b1")
    assert not [r for r in evidence.rerun_idempotency(lake.bronze(dataset("penalties")).read(), lake.logs.read()).collect() if r["batch_id"] == "b1"][0]["idempotent"]


def provider(ccn, name="Home", day="2024-02-01"):
    return dict.fromkeys(PROVIDER_COLUMNS) | {"cms_certification_number_ccn": ccn, "provider_name": name, "processing_date": day, "provider_address": "1 Main St"}


def test_silver_merges_quarantines_and_deletes_and_a_second_run_changes_nothing(spark, tmp_path, lake):
    land, spec = tmp_path / "land", dataset("provider_info")
    a = entry(csv(land / "a.csv", PROVIDER_COLUMNS, [provider("1AAAAA"), provider("2BBBBB"), provider("3CCCCC")]), "provider_info", "r1", "s1", 1, expected_run_rows=3)
    announce(lake, a)
    assert run_bronze(lake, "b1").reconciled[0]["complete"]
    first = run_silver(lake, "s1", "salt")
    assert first.processed[0]["rows_inserted"] == 3 and first.processed[0]["blockers"] == ["NOT_ENABLED"]
    stamps = {r["facility_key"]: r["load_timestamp"] for r in lake.silver(spec).read().collect()}
    version = lake.silver(spec).version()
    assert run_silver(lake, "s2", "salt").processed == []
    redone = run_silver(lake, "s3", "salt", reprocess=True, allow_soft_deletes=True).processed[0]
    assert (redone["rows_inserted"], redone["rows_updated"], redone["blockers"]) == (0, 0, ["PARTIAL_SCOPE"])
    assert lake.silver(spec).version() == version and {r["facility_key"]: r["load_timestamp"] for r in lake.silver(spec).read().collect()} == stamps
    b = entry(csv(land / "b.csv", PROVIDER_COLUMNS, [provider("1AAAAA", day="2024-03-01"), provider("2BBBBB", "New Name", "2024-03-01")]), "provider_info", "r2", "s2", 2, expected_run_rows=2)
    announce(lake, b)
    run_bronze(lake, "b2")
    done = run_silver(lake, "s4", "salt", allow_soft_deletes=True).processed[0]
    assert (done["rows_inserted"], done["rows_updated"], done["rows_deleted"], done["blockers"]) == (0, 1, 1, [])
    assert {r["cms_certification_number_ccn"]: r["is_deleted"] for r in lake.silver(spec).read().collect()} == {"1AAAAA": False, "2BBBBB": False, "3CCCCC": True}
    history = [(r["operation"], r["counts"]) for r in lake.silver(spec).history().collect()]
    assert ("MERGE", {"inserted": 3, "updated": 0, "stale": 0}) in history and ("SOFT DELETE", {"deleted": 1}) in history
    c = entry(csv(land / "c.csv", PROVIDER_COLUMNS, [provider("4DDDDD"), provider("bad"), provider("5EEEEE"), provider("5EEEEE", "Other")]), "provider_info", "r3", "s3", 3, expected_run_rows=4)
    announce(lake, c)
    run_bronze(lake, "b3")
    for run, held in (("s5", 3), ("s6", 3)):
        done = run_silver(lake, run, "salt", allow_soft_deletes=True, **({"reprocess": True, "batch_ids": ["s3"]} if run == "s6" else {})).processed[0]
        assert done["rows_quarantined"] == 3 and "QUARANTINED_ROWS" in done["blockers"] and done["rows_deleted"] == 0
        assert lake.silver_quarantine.read().count() == held


def test_part_of_a_batch_and_failing_batches(spark, tmp_path, lake):
    land = tmp_path / "land"
    for n in (1, 2):
        announce(lake, entry(csv(land / f"{n}.csv", PENALTY_COLUMNS, [FINE | {"fine_id": f"F{n}"}]), "penalties", f"r{n}", f"b{n}", n, expected_run_rows=1))
    run_bronze(lake, "b")
    spec = dataset("penalties")
    assert [o["batch_id"] for o in run_silver(lake, "s0", "salt", ingest_from="2030-01-01").outside] == ["b1", "b2"]
    assert lake.logs.read().filter("pipeline_layer = 'Bronze-to-Silver'").count() == 0
    mixed = lake.bronze(spec).read("b1").unionByName(lake.bronze(spec).read("b1").withColumn("_ingest_date", F.lit(D(2030, 1, 1)))).collect()
    lake.bronze(spec).replace(spark.createDataFrame(mixed, lake.bronze(spec).schema), "b1")
    with pytest.raises(PipelineFailed, match="part of a batch"):
        run_silver(lake, "s1", "salt", ingest_from="2024-01-01", ingest_to="2025-01-01")
    assert lake.silver(spec).read().count() == 1  # b2 went on
    assert {r["batch_id"]: r["status"] for r in lake.logs.read().filter("pipeline_layer = 'Bronze-to-Silver'").collect()} == {"b1": "FAILURE", "b2": "SUCCESS"}
    with pytest.raises(ValueError):
        run_silver(lake, "s2", "salt", ingest_from="2025-01-01", ingest_to="2024-01-01")
    legacy = Lake(spark, str(tmp_path / "old"))
    VersionedTable(spark, f"{tmp_path}/old/silver_quarantine", LEGACY_QUARANTINE_SCHEMA).ensure()
    with pytest.raises(RuntimeError, match="LEGACY"):
        run_silver(legacy, "s", "salt")


def test_every_blocker(spark):
    m = "dataset string, batch_id string, acquisition_run_id string, landing_path string, acquisition_strategy string, status string, row_count_validated boolean, expected_run_rows bigint, source_rows bigint, as_of_date date, load_timestamp timestamp"
    row = lambda b, run, strategy="snapshot_diff", status="SUCCESS", ok=True, want=5, got=5, day=1: ("p", b, run, b, strategy, status, ok, want, got, D(2024, 1, day), dt.datetime(2024, 1, day))
    rows = [row("fine", "r1", day=9), row("bad", "r2", "api_date_window", "FAILURE", None, 5, 4), row("two", "r3"), row("two_b", "r3"), row("none", "r4", want=0, got=0, day=2), row("open", "r5", got=None, day=3), row("held", "r6", day=4)]
    logs = spark.createDataFrame([("p", r[1], "Raw-to-Bronze", "SUCCESS", "x") for r in rows], "dataset string, batch_id string, pipeline_layer string, status string, run_id string")
    held = spark.createDataFrame([("p", "held"), ("p", "held")], "dataset string, source_batch_id string")
    got = {r["batch_id"]: set(r["blockers"]) for r in merge.deletion_blockers(spark.createDataFrame(rows, m), logs, held).collect()}
    assert got["fine"] == set()
    assert got["bad"] == {"NO_SNAPSHOT", "NOT_ACQUIRED", "NOT_VALIDATED", "NOT_ONE_FILE", "COUNTS_DIFFER", "NOT_NEWEST"}
    assert got["two"] == {"NOT_ONE_FILE", "NOT_NEWEST"} and got["none"] == {"EMPTY", "NOT_NEWEST"} and got["open"] == {"COUNTS_UNKNOWN", "NOT_NEWEST"} and got["held"] == {"QUARANTINED_ROWS", "NOT_NEWEST"}
    assert merge.call_blockers(False, True, None) == ["NOT_ENABLED", "PARTIAL_SCOPE", "UNDATED"] and merge.call_blockers(True, False, 1) == []
    assert set().union(*got.values(), merge.call_blockers(False, True, None)) == set(merge.BLOCKERS)


def test_windows_whose_files_are_gone_and_pending_ones(spark):
    w = spark.createDataFrame([("p", "r1", D(2024, 1, 1), D(2024, 1, 31), ["a", "b"], False), ("p", "r2", D(2024, 2, 1), D(2024, 2, 28), ["c"], True), ("p", "r3", D(2024, 3, 1), D(2024, 3, 31), ["d"], False)], "dataset string, acquisition_run_id string, window_start date, window_end date, paths array<string>, bronze_complete boolean")
    there = control.with_files(w, spark.createDataFrame([("a",), ("c",), ("d",)], "path string"))
    assert {r["acquisition_run_id"] for r in there.collect()} == {"r2", "r3"}
    marks = spark.createDataFrame([("p", D(2024, 2, 28), dt.datetime(2024, 3, 1))], "dataset string, watermark_value date, load_timestamp timestamp")
    assert {r["acquisition_run_id"] for r in control.pending_windows(w, marks).collect()} == {"r3"}
