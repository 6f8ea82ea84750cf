import datetime as dt
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import control, evidence, merge
from ledgerloom.operators.audit import LEGACY_QUARANTINE_SCHEMA, LOG_SCHEMA, SILVER_QUARANTINE_SCHEMA, audited, check_log
from ledgerloom.operators.classify import classify, conservation, silver_columns, transform
from ledgerloom.operators.versioned import CREATED, VERIFIED, BatchTable, ConcurrentChange, SchemaMismatch, VersionedTable
from ledgerloom.sources.storage import Storage
from ledgerloom.spec import BRONZE_METADATA, PENALTY_COLUMNS, REGISTRY, check_contract, dataset

D = dt.date


def test_contract():
    check_contract()
    sizes = {"health_deficiencies": 24, "penalties": 13, "provider_info": 100, "mds_quality": 22}
    assert {n: len(silver_columns(s)) for n, s in REGISTRY.items()} == sizes
    with pytest.raises(ValueError):
        dataset("other")


def bronze(spark, rows):
    base = dict(cms_certification_number_ccn="12345a", penalty_date="2024-01-05", penalty_type="Fine", fine_id="F1", fine_amount="10.50", provider_address="1 Main St", processing_date="2024-02-01")
    full = [tuple((base | r).get(c) for c in PENALTY_COLUMNS) + ("id", r.get("file", "f"), "sha", r.get("batch", "b1"), "full", D(2024, 2, 2), dt.datetime(2024, 2, 2)) for r in rows]
    ddl = ", ".join(f"{c} string" for c in PENALTY_COLUMNS) + ", " + ", ".join(f"{c} {'date' if c == '_ingest_date' else 'timestamp' if c == 'load_timestamp' else 'string'}" for c in BRONZE_METADATA)
    return spark.createDataFrame(full, ddl)


def test_transform_classifies_each_row_once(spark):
    rows = [{}, {}, {"fine_id": "F2"}, {"fine_id": "F2", "fine_amount": "11"}, {"fine_id": "F3", "penalty_type": "?"}, {"fine_id": None}, {"cms_certification_number_ccn": " "}, {"processing_date": "2024-03-01"}]
    done = transform(bronze(spark, rows), dataset("penalties"), "salt")
    assert conservation(done) == {"INVALID": 3, "CONFLICT": 2, "DUPLICATE": 2, "ACCEPTED": 1, "read": 8}
    kept = done.silver.collect()
    assert len(kept) == 1 and kept[0]["source_processing_date"] == D(2024, 3, 1)  # the newest of equal rows survives
    assert kept[0]["cms_certification_number_ccn"] == "12345A" and len(kept[0]["provider_address_hash"]) == 64
    assert "provider_address" not in done.silver.columns and "location" not in done.silver.columns
    rules = {tuple(r["failed_rules"]) for r in done.quarantine.collect()}
    assert ("CONFLICTING_BUSINESS_KEY",) in rules and ("DOMAIN:penalty_type",) in rules
    assert transform(bronze(spark, rows).limit(0), dataset("penalties"), "s").silver.count() == 0
    with pytest.raises(ValueError):
        transform(bronze(spark, rows).drop("state"), dataset("penalties"), "s")


def test_classification_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "hot", "hot", *"abc"]), rng.choice("xxxy"), ["R"] if rng.random() < 0.2 else [], i) for i in range(200)]
    got = classify(spark.createDataFrame(rows, "k string, h string, failed array<string>, i int"), "k", "h", "failed", [F.col("i")])
    good = [r for r in rows if r[0] is not None and not r[2]]
    for r in got.collect():
        same = [g for g in good if g[0] == r["k"]]
        if r["k"] is None or r["failed"]:
            want = "INVALID"
        elif len({g[1] for g in same}) > 1:
            want = "CONFLICT"
        else:
            want = "ACCEPTED" if r["i"] == min(g[3] for g in same) else "DUPLICATE"
        assert r["status"] == want
    assert got.count() == 200


SIDE = "k string, row_hash string, source_processing_date date, is_deleted boolean"


def test_merge_decisions(spark):
    t = [("keep", "a", D(2024, 1, 1), False), ("new", "a", D(2024, 1, 1), False), ("old", "a", D(2024, 3, 1), False), ("undated", "a", D(2024, 1, 1), False), ("back", "a", D(2024, 1, 1), True), ("gone", "a", D(2024, 1, 1), False), ("open", "a", None, False)]
    s = [("keep", "a", D(2024, 2, 1), False), ("new", "b", D(2024, 2, 1), False), ("old", "b", D(2024, 2, 1), False), ("undated", "b", None, False), ("back", "a", D(2024, 2, 1), False), ("fresh", "z", None, False), ("open", "b", D(2020, 1, 1), False)]
    target, source = spark.createDataFrame(t, SIDE), spark.createDataFrame(s, SIDE)
    actions = merge.merge_actions(target, source, "k")
    assert {r["k"]: r["action"] for r in actions.collect()} == {"keep": "KEEP", "new": "UPDATE", "old": "STALE", "undated": "STALE", "back": "UPDATE", "gone": "MISSING", "fresh": "INSERT", "open": "UPDATE"}
    after = merge.apply_merge(actions, target.columns)
    again = {r["action"] for r in merge.merge_actions(after, source, "k").collect()}
    assert not again & {"INSERT", "UPDATE"}  # a second run changes nothing
    with pytest.raises(Exception, match="several source rows"):
        merge.merge_actions(target, source.unionByName(source), "k").collect()
    deleted = merge.soft_delete(target, source, "k", F.lit(D(2024, 6, 1)), stamp=None)
    assert {r["k"] for r in deleted.filter("is_deleted").collect()} == {"back", "gone"}


def test_append_and_watermarks(spark):
    rows = [("a", None, ["x"]), ("a", None, ["x"]), (None, "1", ["y"]), ("b", "2", None)]
    df = spark.createDataFrame(rows, "a string, b string, r array<string>")
    assert merge.append_once(df.limit(0), df, df.columns).count() == 3
    assert merge.append_once(df, df, df.columns).count() == 0
    w = "d string, v int, note string"
    out = merge.advance_watermarks(spark.createDataFrame([("a", 5, "t"), ("b", 1, "t")], w), spark.createDataFrame([("a", 4, "s"), ("b", 1, "s"), ("c", 2, "s")], w), "d", "v")
    assert {tuple(r) for r in out.collect()} == {("a", 5, "t"), ("b", 1, "s"), ("c", 2, "s")}


MF = "dataset string, acquisition_run_id string, batch_id string, landing_path string, status string, row_count_validated boolean, load_type string, acquisition_strategy string, expected_run_rows bigint, source_rows bigint, page_offset bigint, window_start date, window_end date, as_of_date date, load_timestamp timestamp"
LG = "dataset string, batch_id string, pipeline_layer string, status string, run_id string"


def control_frames(spark):
    t, e = (lambda d: dt.datetime(2024, 1, d)), D(2024, 1, 31)
    page = lambda run, b, off, n, day=1, status="SUCCESS": ("p", run, b, f"{b}.json", status, False, "incremental", "api_date_window", 700, n, off, D(2024, 1, 1), e, e, t(day))
    rows = [page("r1", "b1", 0, 500), page("r1", "b2", 500, 200), page("r2", "b3", 0, 500), page("r2", "b4", 1000, 200), page("r3", "b5", 0, 300), page("r4", "b6", 0, 500), page("r4", "b7", 500, None), page("r1", "b1", 0, 500, 2), page("r5", "b8", 0, 700, 3, "FAILURE")]
    logs = [("p", b, "Raw-to-Bronze", "SUCCESS", "x") for b in ("b1", "b2", "b3", "b4", "b5")] + [("p", "b6", "Raw-to-Bronze", "QUARANTINED_PARTIAL", "x"), ("p", "b1", "Bronze-to-Silver", "QUARANTINED_PARTIAL", "x")]
    return spark.createDataFrame(rows, MF), spark.createDataFrame(logs, LG)


def test_control(spark):
    m, logs = control_frames(spark)
    runs = {r["acquisition_run_id"]: r for r in control.reconcile_runs(m, logs).collect()}
    assert runs["r1"]["complete"] and runs["r1"]["watermark_value"] == D(2024, 1, 31)
    assert "contiguous" in runs["r2"]["problem"] and "differ" in runs["r3"]["problem"] and "not parsed" in runs["r4"]["problem"] and "r5" not in runs
    scope, process = control.manifest_selection(m, logs)
    assert {r["batch_id"] for r in process.collect()} == {"b6", "b7"}
    assert scope.count() == 7  # nothing is validated yet
    assert control.manifest_selection(m, logs, reprocess=True)[1].count() == 7
    with pytest.raises(ValueError):
        control.manifest_selection(m, logs, source_path="nowhere")
    with pytest.raises(ValueError):
        control.silver_work(m, logs, load_type="other")
    assert {r["batch_id"] for r in control.silver_work(m, logs).collect()} == {"b2", "b3", "b4", "b5"}
    windows = control.complete_windows(m, logs).collect()
    assert [(r["acquisition_run_id"], r["bronze_complete"]) for r in windows] == []  # r1 was registered twice, r2 has a gap, the others lack rows
    assert [(r["acquisition_run_id"], r["bronze_complete"]) for r in control.complete_windows(m.filter("acquisition_run_id = 'r1'").dropDuplicates(["batch_id"]), logs).collect()] == [("r1", True)]
    assert control.window_start(None, D(2024, 3, 1)) == D(2024, 1, 1) and control.window_start(D(2020, 1, 1), None) == D(2020, 1, 1)
    with pytest.raises(ValueError):
        control.window_start(None, None)
    assert control.pending_keys({("a", "1"), ("a", "2")}, {("a", "1")}) == [("a", "2")]


def test_audit():
    out = []
    fields = dict(run_id="r", batch_id="b", pipeline_layer="Raw-to-Bronze", dataset="p", load_type="full", parameter_processed="x")
    with audited(out.append, **fields) as record:
        record["rows_read"] = 3
    with audited(out.append, **fields) as record:
        record["rows_quarantined"] = 1
    with audited(out.append, **fields) as record:
        record["suppress"] = True
    with pytest.raises(KeyError):
        with audited(out.append, **fields):
            raise KeyError("x")
    assert [r["status"] for r in out] == ["SUCCESS", "QUARANTINED_PARTIAL", "FAILURE"] and set(out[0]) == set(LOG_SCHEMA.names)

    def broken(_):
        raise OSError("log is down")

    with pytest.raises(KeyError):
        with audited(broken, **fields):
            raise KeyError("original")
    with pytest.raises(ValueError):
        check_log(out[0] | {"rows_read": True})
    with pytest.raises(ValueError):
        check_log(out[0] | {"status": "other"})


def test_versioned_table(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("v", T.IntegerType())])
    t = VersionedTable(spark, str(tmp_path / "t"), schema)
    assert t.read().count() == 0 and t.ensure() == CREATED and t.ensure() == VERIFIED
    t.append(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))
    t.append(spark.createDataFrame([], "k string, v int"))
    t.append(spark.createDataFrame([("c", 3)], "k string, v int"))
    assert t.read().count() == 3 and len(list((tmp_path / "t").glob("data-*"))) == 3  # an append leaves the other folders alone
    t.delete(F.col("k") == "c")
    t.update(F.col("k") == "a", {"v": F.lit(9)})
    t.delete(F.col("k") == "b")
    assert [tuple(r) for r in t.read().collect()] == [("a", 9)] and t.history().count() == 6
    with pytest.raises(ValueError, match="null in required"):
        t.append(spark.createDataFrame([(None, 1)], "k string, v int"))
    assert t.read().count() == 1
    t.add_columns([T.StructField("w", T.StringType())], {"w": F.concat("k", F.lit("!"))})
    assert t.read().first()["w"] == "a!"
    with pytest.raises(SchemaMismatch):
        VersionedTable(spark, str(tmp_path / "t"), T.StructType([T.StructField("k", T.IntegerType())])).ensure()
    with pytest.raises(SchemaMismatch):  # nullability counts
        VersionedTable(spark, str(tmp_path / "t"), T.StructType([T.StructField(f.name, f.dataType) for f in t.schema.fields])).ensure()
    counts = {(r["operation"], *sorted(r["counts"].items())) for r in t.history().collect()}
    assert {("APPEND", ("inserted", 2)), ("UPDATE", ("updated", 1)), ("DELETE", ("deleted", 1))} <= counts
    assert t.update(F.col("k") == "nowhere", {"v": F.lit(0)}) == t.version() and t.read(1).count() == 2  # nothing to publish; old versions can be read
    assert len(t.vacuum()) == 6 and t.read().count() == 1 and len(list((tmp_path / "t").glob("data-*"))) == 1


def test_two_writers_lose_nothing(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType(), False)])
    a, b = (VersionedTable(spark, str(tmp_path / "w"), schema) for _ in range(2))
    a.ensure()
    one = lambda k: spark.createDataFrame([(k,)], schema)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: (a if int(k) % 2 else b).append(one(k)), "12345678"))
    assert sorted(r["k"] for r in a.read().collect()) == list("12345678") and a.versions() == list(range(9))
    version = a.version()
    b.append(one("9"))
    with pytest.raises(ConcurrentChange):  # computed from rows that are no longer all
        a.publish(a.read(version).filter("k > '4'"), "DELETE", based_on=version)
    assert a.read().count() == 9 and len(list((tmp_path / "w").glob("data-*"))) == 10


def test_storage_through_hadoop_creates_only_once(spark, tmp_path):
    class Remote(Storage):
        local = None  # as on a file system that is not the driver's

    s = Remote(spark, f"file:{tmp_path}/s")
    assert s.create("_log/1.json", "é") and not s.create("_log/1.json", "other") and s.read("_log/1.json") == "é"
    assert s.names("_log") == ["1.json"] and s.names("nowhere") == [] and not s.exists("x")
    s.move(f"file:{tmp_path}/t")
    with pytest.raises(OSError):
        Storage(spark, f"file:{tmp_path}/t").move(f"file:{tmp_path}/t")
    assert Storage(spark, str(tmp_path / "t")).read("_log/1.json") == "é"


def test_batch_table(spark, tmp_path):
    schema = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("_batch_id", T.StringType())])
    t = BatchTable(spark, str(tmp_path / "b"), schema)
    df = lambda b, *vs: spark.createDataFrame([(v, b) for v in vs], schema)
    digits = "012345678901234567890123"
    assert t.read().count() == 0
    t.replace(df(digits, 1, 2), digits)
    t.replace(df("b2", 3), "b2")
    t.replace(df(digits, 7), digits)
    assert {tuple(r) for r in t.read().collect()} == {(7, digits), (3, "b2")} and t.read("b2").count() == 1
    t.replace(df("b2"), "b2")
    assert {tuple(r) for r in t.read().collect()} == {(7, digits)}
    t.replace(df("b3", 4).withColumn("note", F.lit("n")), "b3")
    assert {(r["v"], r["note"]) for r in t.read(evolve=True).collect()} == {(7, None), (4, "n")}
    for bad in (lambda: t.replace(df("../x", 1), "../x"), lambda: t.replace(df("b4", 1), "b5")):
        with pytest.raises(Exception, match="unsafe|another batch"):
            bad()


def test_migration(spark, tmp_path):
    legacy = VersionedTable(spark, str(tmp_path / "q"), LEGACY_QUARANTINE_SCHEMA)
    at = dt.datetime(2024, 1, 1)
    legacy.append(spark.createDataFrame([("p", "b1", "{}", ["R"], at), ("p", "b1", "{}", ["R"], at)], LEGACY_QUARANTINE_SCHEMA))
    manifest = spark.createDataFrame([("p", "b1", "path", "SHA", "SUCCESS", at), ("p", "b1", "path", "sha", "SUCCESS", at), ("p", "b1", "other", "x", "FAILURE", at)], "dataset string, batch_id string, landing_path string, source_file_sha256 string, status string, load_timestamp timestamp")
    staged = VersionedTable(spark, str(tmp_path / "q_new"), SILVER_QUARANTINE_SCHEMA)
    m = evidence.Migration(legacy, staged, ("prepare", "yes"))
    with pytest.raises(PermissionError):
        m.prepare(manifest, "yes")
    with pytest.raises(ValueError, match="MISSING"):  # nothing is prepared yet
        m.activate("yes")
    m.prepare(manifest, "prepare")
    assert m.preview() == {"legacy_rows": 2, "staged_rows": 2} and m.verify()
    with pytest.raises(PermissionError):
        m.activate("no")
    m.activate("yes")
    assert m.states() == ("CURRENT", "MISSING")
    with pytest.raises(ValueError):
        m.activate("yes")
    live = VersionedTable(spark, str(tmp_path / "q"), SILVER_QUARANTINE_SCHEMA)
    assert {r["source_file"] for r in live.read().collect()} == {"path"}
    with pytest.raises(evidence.UnresolvedLineage):
        evidence.rebuild_lineage(VersionedTable(spark, str(tmp_path / "q__backup"), LEGACY_QUARANTINE_SCHEMA).read(), manifest.limit(0))
    with pytest.raises(evidence.UnresolvedLineage, match="several"):
        evidence.rebuild_lineage(VersionedTable(spark, str(tmp_path / "q__backup"), LEGACY_QUARANTINE_SCHEMA).read(), manifest.withColumn("status", F.lit("SUCCESS")))
