import hashlib
import json

import pytest
from pyspark.sql import types as T

from ledgerloom.operators.versioned import BatchTable
from ledgerloom.sources.files import BreakingDrift, EnvelopeError, IntegrityError, Landed, check_page, csv_header, load_file, page_facts, split_by_cutoff, verify_files
from ledgerloom.sources.paged import PagedSource, batch_id, csv_distribution, fetch_bulk, fetch_window, page_url, retry
from ledgerloom.spec import PENALTY_COLUMNS, dataset
from ledgerloom.streaming.ingest import quarantine_of, run_into, stream_csv

SPEC = dataset("penalties")
WINDOW = ("2024-01-01", "2024-01-31")
ROW = ["012345", "Home", 'a "b", c', "City", "TX", "12345", "2024-01-05", "Fine", "F1", "10", "", "", "line\nbreak", "2024-02-01"]


def landed(path, text, **kw):
    path.write_bytes(text.encode())
    return Landed(str(path), kw.get("batch", "b1"), kw.get("load_type", "full"), "2024-02-02", hashlib.sha256(path.read_bytes()).hexdigest(), path.stat().st_size, kw.get("expected"), *WINDOW)


def quoted(*cells):
    return ",".join('"' + c.replace('"', '""') + '"' for c in cells)


def test_csv_load(spark, tmp_path):
    head = "﻿" + ",".join(c.replace("_", " ").title() for c in PENALTY_COLUMNS)
    item = landed(tmp_path / "a.csv", "\n".join([head, quoted(*ROW), quoted(*ROW[:-1]), quoted(*ROW, "x")]) + "\n")
    done = load_file(spark, item, SPEC)
    good = done.good.collect()
    assert len(good) == 1 and good[0]["provider_address"] == 'a "b", c' and good[0]["location"] == "line\nbreak" and good[0]["_batch_id"] == "b1"
    assert done.corrupt.count() == 2 and not done.drift.records()
    with pytest.raises(IntegrityError, match="digest"):
        load_file(spark, Landed(item.path, "b", "full", "2024-01-01", "0" * 64, item.size), SPEC)
    with pytest.raises(IntegrityError, match="size"):
        load_file(spark, Landed(item.path, "b", "full", "2024-01-01", item.sha256, 1), SPEC)
    with pytest.raises(IntegrityError, match="exist"):
        load_file(spark, Landed("/nowhere.csv", "b", "full", "2024-01-01", item.sha256, 1), SPEC)


def test_csv_drift(spark, tmp_path):
    more = landed(tmp_path / "m.csv", ",".join([*PENALTY_COLUMNS, "New One"]) + "\n" + quoted(*ROW, "n") + "\n")
    assert load_file(spark, more, SPEC).good.first()["new_one"] == "n"
    less = landed(tmp_path / "l.csv", ",".join(PENALTY_COLUMNS[:-1]) + "\n")
    with pytest.raises(BreakingDrift):
        load_file(spark, less, SPEC)
    (tmp_path / "e.csv").write_text("")
    with pytest.raises(ValueError):
        csv_header(str(tmp_path / "e.csv"))


def page(rows, **meta):
    base = {"dataset_id": SPEC.dataset_id, "filter": "penalty_date >= 2024-01-01 AND penalty_date <= 2024-01-31", "rows_available": len(rows), "rows_in_file": len(rows), "load_type": "incremental"}
    return json.dumps({"_meta": base | meta, "results": rows})


def test_json_page(spark, tmp_path):
    rows = [dict(zip(PENALTY_COLUMNS, ROW)), {"cms_certification_number_ccn": "x", "added": "new"}]
    done = load_file(spark, landed(tmp_path / "p.json", page(rows), load_type="incremental", expected=2), SPEC)
    assert {r["added"] for r in done.good.collect()} == {None, "new"} and done.corrupt.count() == 0
    for wrong in ({"rows_in_file": 3}, {"dataset_id": "x"}, {"filter": "penalty_date >= 2024-01-01"}, {"filter": "penalty_date >= 2024-01-01 AND penalty_date <= 2024-01-30"}, {"load_type": "full"}, {"rows_available": 1}):
        (tmp_path / "w.json").write_text(page(rows, **wrong))
        meta, _, n = page_facts(str(tmp_path / "w.json"))
        with pytest.raises(EnvelopeError):
            check_page(meta, n, SPEC, "incremental", 2, *WINDOW)
    meta = json.loads(page(rows))["_meta"]
    with pytest.raises(EnvelopeError, match="window"):
        check_page(meta, 2, SPEC, "incremental", 2)
    nothing = load_file(spark, landed(tmp_path / "n.json", page([]), load_type="incremental", expected=0), SPEC)
    assert nothing.counts() == (0, 0) and nothing.good.count() == 0
    (tmp_path / "x.json").write_text("[]")
    with pytest.raises(EnvelopeError):
        page_facts(str(tmp_path / "x.json"))


def test_many_files_are_verified_at_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    a = landed(folder / "a.csv", "x")
    landed(folder / "b.csv", "y")
    rows = [(a.path, 1, a.sha256.upper()), (str(folder / "b.csv"), 1, a.sha256), (str(folder / "c.csv"), 1, a.sha256), (a.path, 5, a.sha256)]
    got = verify_files(spark, str(folder), spark.createDataFrame(rows, "landing_path string, source_bytes bigint, source_file_sha256 string"))
    assert sorted(str(r["problem"]) for r in got.collect()) == ["None", "digest", "missing", "size"]


def test_split_by_cutoff(spark, tmp_path):
    df = spark.createDataFrame([("1", "2024-01-01"), ("2", "7/1/2024"), ("3", "unknown"), ("4", None)], "id string, d string")
    split_by_cutoff(df, str(tmp_path / "parts"), "d", "2024-06-01", 1)
    back = spark.read.option("header", True).csv(str(tmp_path / "parts"))
    assert {r["id"] for r in back.collect()} == {"1", "3", "4"}
    many = spark.createDataFrame([(str(i), "2024-01-01", 'q"' * (i % 7)) for i in range(500)], "id string, d string, t string").coalesce(1)
    split_by_cutoff(many, str(tmp_path / "many"), "d", "2024-06-01", 1000)
    parts = list((tmp_path / "many").glob("*.csv"))
    assert len(parts) > 10 and max(p.stat().st_size for p in parts) <= 1000 and spark.read.option("header", True).csv(str(tmp_path / "many")).count() == 500


def test_paged_fetch(tmp_path):
    rows = [{"id": str(i)} for i in range(7)]

    def service(url, broken=None):
        offset = int(url.split("offset=")[1].split("&")[0])
        return json.dumps({"count": 7 if offset != broken else 8, "results": rows[offset : offset + 3]}).encode()

    got = fetch_window(service, "https://x", SPEC, str(tmp_path / "ok"), "2024-01-01", "2024-01-31", rows=3)
    assert [g["offset"] for g in got] == [0, 3, 6] and page_facts(got[2]["path"])[2] == 1
    with pytest.raises(ValueError, match="changed"):
        fetch_window(lambda u: service(u, 3), "https://x", SPEC, str(tmp_path / "bad"), "2024-01-01", "2024-01-31", rows=3)
    assert not list((tmp_path / "bad").glob("*.json"))
    same = lambda u: json.dumps({"count": 6, "results": rows[:3]}).encode()
    with pytest.raises(ValueError, match="twice"):
        fetch_window(same, "https://x", SPEC, str(tmp_path / "twice"), "2024-01-01", "2024-01-31", rows=3)
    short = lambda u: json.dumps({"count": 6, "results": rows[:2] if "offset=3" in u else rows[3:6]}).encode()
    with pytest.raises(ValueError, match="announced 6 rows and gave 5"):
        fetch_window(short, "https://x", SPEC, str(tmp_path / "short"), "2024-01-01", "2024-01-31", rows=3)
    assert not list((tmp_path / "short").glob("*.json"))
    none = lambda u: json.dumps({"count": 0, "results": []}).encode()
    assert [g["rows"] for g in fetch_window(none, "https://x", SPEC, str(tmp_path / "none"), "2024-01-01", "2024-01-31")] == [0]
    assert "conditions%5B1%5D%5Boperator%5D=%3C%3D" in page_url("https://x", "d", 0, "c", "a", "b")


def test_retry_bulk_and_ids(tmp_path):
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("again")
        return b"body"

    waits = []
    assert retry(flaky, 4, waits.append) == b"body" and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        retry(lambda: (_ for _ in ()).throw(OSError("x")), 2, waits.append)
    item = {"modified": "2024-01-01", "distribution": [{"downloadURL": "https://h/f.csv", "mediaType": "text/csv"}]}
    body = lambda *blocks, length=None: lambda url: (length, iter(blocks))
    first = fetch_bulk(body(b"a,", b"b\n", length=4), item, str(tmp_path / "x"), "penalties")
    assert first["status"] == "SUCCESS" and first["path"].startswith(str(tmp_path / "x" / "f_")) and open(first["path"], "rb").read() == b"a,b\n"

    def never(url):
        raise AssertionError("an unchanged publication was downloaded")

    assert fetch_bulk(never, item, str(tmp_path / "x"), "penalties", [first])["path"] == first["path"]
    changed = fetch_bulk(body(b"a,b\n"), item | {"modified": "2024-02-01"}, str(tmp_path / "x"), "penalties", [first])
    assert changed["status"] == "SKIPPED_ALREADY_ACQUIRED" and changed["path"] == first["path"]
    assert fetch_bulk(body(b"c,d\n"), item | {"modified": "2024-02-01"}, str(tmp_path / "x"), "penalties", [first])["status"] == "SUCCESS"
    for bad in (body(), body(b"a,", length=4)):
        with pytest.raises(OSError):
            fetch_bulk(bad, item, str(tmp_path / "y"), "penalties", sleep=waits.append)
    assert not list((tmp_path / "y").iterdir()) and len(list((tmp_path / "x").iterdir())) == 2
    assert len(batch_id("d", "full", "u", "x")) == 24
    assert csv_distribution({"distribution": [{"downloadURL": "http://a/x.csv"}, {"downloadURL": "https://a/x", "mediaType": "text/csv"}]}) == "https://a/x"
    with pytest.raises(ValueError):
        csv_distribution({})


def test_paged_data_source(spark, tmp_path):
    for offset in (0, 2, 4):
        (tmp_path / f"{offset}.json").write_text(json.dumps({"count": 5, "results": [{"id": i, "v": None} for i in range(offset, min(offset + 2, 5))]}))
    spark.dataSource.register(PagedSource)
    df = spark.read.format("paged_api").schema("id string, v string").options(base=f"file:{tmp_path}", dataset_id="d", rows="2").load()
    assert sorted(r["id"] for r in df.collect()) == list("01234")


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write = lambda name, *rows: (folder / name).write_text("\n".join([",".join(PENALTY_COLUMNS), *(quoted(*ROW[:12], "x", r) for r in rows)]) + "\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*PENALTY_COLUMNS, "_batch_id")])
    table = BatchTable(spark, str(tmp_path / "out"), schema)
    write("a.csv", "2024-01-01", "2024-01-02")
    for _ in range(2):  # the second run finds nothing new
        run_into(stream_csv(spark, str(folder), SPEC), table, str(tmp_path / "cp")).awaitTermination(60)
        assert table.read().count() == 2
    write("b.csv", "2024-01-03")
    run_into(stream_csv(spark, str(folder), SPEC), table, str(tmp_path / "cp")).awaitTermination(60)
    assert table.read().count() == 3 and table.read().select("_batch_id").distinct().count() == 2


def test_stream_quarantines_broken_rows_and_replaces_by_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write = lambda name, *rows: (folder / name).write_text("\n".join([",".join(PENALTY_COLUMNS), *rows]) + "\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*PENALTY_COLUMNS, "_batch_id")])
    table = BatchTable(spark, str(tmp_path / "out"), schema)

    def load(run):  # another checkpoint each time: every file is delivered again
        run_into(stream_csv(spark, str(folder), SPEC), table, str(tmp_path / run)).awaitTermination(60)
        return table.read().collect(), quarantine_of(table).read().collect()

    short, long = quoted(*ROW[:-1]), quoted(*ROW, "x")
    write("a.csv", quoted(*ROW), short)
    write("b.csv", quoted(*ROW), quoted(*ROW), long)
    good, bad = load("1")
    assert len(good) == 3 and all(r["location"] == "line\nbreak" for r in good)  # as load_file reads it
    assert len(bad) == 2 and {tuple(r["failed_rules"]) for r in bad} == {("CORRUPT_RECORD",)}
    assert {r["dataset"] for r in bad} == {"penalties"} and all(r["corrupt_record"] for r in bad) and {r["source_file"].rsplit("/", 1)[1] for r in bad} == {"a.csv", "b.csv"}
    write("a.csv", short, short)
    write("b.csv", quoted(*ROW))
    good, bad = load("2")
    assert len(good) == 1 and len(bad) == 2 and {r["batch_id"] for r in bad}.isdisjoint(r["_batch_id"] for r in good)


def test_paged_data_source_refuses_short_pages(spark, tmp_path):
    for offset, n in ((0, 2), (2, 1), (4, 1)):
        (tmp_path / f"{offset}.json").write_text(json.dumps({"count": 5, "results": [{"id": i} for i in range(offset, offset + n)]}))
    spark.dataSource.register(PagedSource)
    df = spark.read.format("paged_api").schema("id string").options(base=f"file:{tmp_path}", dataset_id="d", rows="2").load()
    with pytest.raises(Exception, match="planned"):
        df.collect()
