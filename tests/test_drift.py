import datetime as dt
import json
import random

import brute
from pyspark.sql import functions as F

from ledgerloom.functions.headers import assess_header, assess_keys, match_key, new_name, qualified_name, strict_mapping
from ledgerloom.operators import drift
from ledgerloom.operators.drift import canonical_names, consistent_table, csv_fields, drift_report, land, ordered_files, path_statistics, reading_problems, whole_table
from ledgerloom.plans import problems
import pytest

KINDS = {"penalties": {"ccn": "", "amount": "decimal(14,2)", "day": "date", "flag": "boolean", "n": "int"}}
IDENTITY = {"penalties": ("ccn", "day")}


def landing(rng, feeds=8, months=7):
    rows, days = [], {}
    for f in range(feeds):
        csv = f % 2 == 0
        names = {c: c for c in KINDS["penalties"]}
        bad = set()
        entities = [(f"{rng.randrange(10**6):06}", f"{rng.randrange(10**4)}.{rng.randrange(100):02}", f"2024-01-{rng.randrange(1, 29):02}", rng.choice("YN"), str(rng.randrange(500))) for _ in range(30)]
        for m in range(months):
            path = f"landing/penalties/feed_{f}/2024-{m + 1:02}-01/part.{'csv' if csv else 'json'}"
            days[path] = dt.date(2024, m + 1, 1)
            for c in rng.sample(sorted(KINDS["penalties"]), 2):
                roll = rng.random()
                if roll < 0.2:
                    names[c] = f"{c}_v{m}" if names[c] else c
                elif roll < 0.3:
                    names[c] = None if names[c] else c
                elif roll < 0.5:
                    bad ^= {c}
            cells = [dict(zip(KINDS["penalties"], e)) for e in rng.sample(entities, 26)]
            for r in cells:
                for c in bad & {"amount", "n"}:
                    r[c] = f"USD {r[c]}"
                if "day" in bad:
                    r["day"] = r["day"][8:] + "." + r["day"][5:7] + ".2024"
            style = rng.choice([str.upper, lambda s: s.replace("_", " "), lambda s: f" {s} "])
            present = [c for c in names if names[c]]
            extra = {"note": "x"} if rng.random() < 0.3 else {}
            if csv:
                head = [style(names[c]) for c in present] + list(extra)
                rows.append((path, 0, ",".join(head)))
                rows += [(path, i + 1, ",".join([*(f'"{r[c]}"' if i % 3 == 0 else r[c] for c in present), *extra.values()])) for i, r in enumerate(cells)]
            else:
                rows += [(path, i, json.dumps({style(names[c]): r[c] for c in present} | extra)) for i, r in enumerate(cells)]
    return rows, days


def frames(spark, rows, days):
    records = spark.createDataFrame(rows, "landing_path string, row_no int, record string").withColumn("path", F.lit("clash"))
    manifest = spark.createDataFrame([(p, d, "penalties", dt.datetime(2024, 1, k)) for p, d in days.items() for k in (1, 2)], "landing_path string, as_of_date date, dataset string, load_timestamp timestamp")
    landing = land(records, "landing_path", "row_no", "record")
    return landing, ordered_files(manifest, landing)


@pytest.mark.parametrize("seed", [6, 7])
def test_report_against_brute_force(spark, seed):
    rows, days = landing(random.Random(seed))
    report, _ = drift_report(*frames(spark, rows, days), KINDS, IDENTITY)
    assert {tuple(r) for r in report.collect()} == brute.drift(rows, days, KINDS, IDENTITY)


def test_values_of_other_records_are_not_carried_on(spark):
    """Alike values at other records are no renaming; the same values in another format are one."""
    days = {f"landing/penalties/f/2024-0{m}-01/x.csv": dt.date(2024, m, 1) for m in (1, 2)}
    a, b = days
    rows = [(a, 0, "ccn,roof,amount"), *((a, i, f"{i},w{i},${i}00.50") for i in range(1, 9)), (b, 0, "ccn,note,sum"), *((b, i, f"{i},w{9 - i},{i}00.50") for i in range(1, 9))]
    want = {(b, "ADDED_COLUMN", "note"), (b, "MISSING_COLUMN", "roof"), (b, "RENAMED_OR_UNMAPPED_COLUMN", "sum")}
    assert {tuple(r) for r in drift_report(*frames(spark, rows, days), KINDS, IDENTITY)[0].collect()} == want == brute.drift(rows, days, KINDS, IDENTITY)
    alike = {tuple(r) for r in drift_report(*frames(spark, rows, days), KINDS, {})[0].collect()}  # nothing tells records apart
    assert (b, "RENAMED_OR_UNMAPPED_COLUMN", "note") in alike


def test_nothing_is_lost_without_being_reported(spark):
    rows = [
        ("a.csv", 1, "1,2"), ("a.csv", 2, "3,4"), ("b.csv", 0, "x,"), ("b.csv", 0, "x,z"), ("b.csv", 0, None), ("b.csv", 1, "5,6,7"), ("b.csv", 2, "8"), ("b.csv", 3, None),
        ("c.json", 0, '{"k":"v","!":"w","K":"u"}'), ("c.json", 1, "[1]"), ("c.json", 2, '{"k":"\\ud800"}'), (None, 1, "lost"),
    ]
    landing = land(spark.createDataFrame(rows, "p string, n int, r string"), "p", "n", "r")
    files = spark.createDataFrame([(p, "f", "d", 1, None) for p in ("a.csv", "b.csv", "c.json")], "path string, feed string, dataset string, seq int, next_path string")
    got = {tuple(r) for r in reading_problems(landing, files.filter("path <> 'c.json'")).collect()}
    assert got == {
        ("a.csv", "NO_HEADER", 2), ("b.csv", "SURPLUS_VALUES", 1), ("b.csv", "MISSING_VALUES", 1), ("b.csv", "UNREADABLE_RECORD", 1), ("b.csv", "UNNAMED_FIELD", 1),
        ("c.json", "UNREADABLE_RECORD", 1), ("c.json", "UNNAMED_FIELD", 1), ("c.json", "NOT_IN_MANIFEST", 2),
    }
    canon = spark.createDataFrame([], "feed string, canon map<string,string>")
    table = {(r["path"], r["row_no"]): (r["x"], r["extra"], r["problems"]) for r in consistent_table(landing, files, canon, "d", {"x": "", "k": ""}).collect()}
    assert table == {
        ("a.csv", 1): (None, {"value_1": "1", "value_2": "2"}, ["NO_HEADER"]), ("a.csv", 2): (None, {"value_1": "3", "value_2": "4"}, ["NO_HEADER"]),
        ("b.csv", 1): ("5", {"value_2": "6", "value_3": "7"}, ["SURPLUS_VALUES"]), ("b.csv", 2): ("8", {}, ["MISSING_VALUES"]), ("b.csv", 3): (None, {}, ["UNREADABLE_RECORD"]),
        ("c.json", 0): (None, {"!": "w", "k_2": "u"}, []), ("c.json", 1): (None, {}, ["UNREADABLE_RECORD"]), ("c.json", 2): (None, {}, []),
    }


def test_texts_are_read_alike_in_both_engines(spark):
    texts = ["1", "-1", "+1", "2147483647", "2147483648", "1.5", "1e3", "1e400", ".5", "5.", ".", "+", "1-2", "999999999999.99", "999999999999.994", "999999999999.995", "1000000000000", "2024-02-29", "2023-02-29", "2024-2-9", "Y", "n", "x", "-", "１"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    jvm = {r["t"]: tuple(i for i in range(len(drift.KINDS)) if r[f"k{i}"]) for r in df.select("t", *(drift.reads_as(F.col("t"), k).alias(f"k{i}") for i, k in enumerate(drift.KINDS))).collect()}
    assert {t: drift._KIND_BITS[drift.raw_type(t)] for t in texts} == jvm
    named = ["Zip Code ", "É-b", "_a__B_", "!!"]
    assert [r["n"] for r in spark.createDataFrame([(n,) for n in named], "t string").select(drift.field_name(F.col("t")).alias("n")).collect()] == [drift.plain_name(n) for n in named]
    lines = ['a,"b ""q"", x",,', "", '"open,b', '"a"b,c', '"",""']
    assert [r["f"] for r in spark.createDataFrame([(x,) for x in lines], "r string").select(csv_fields(F.col("r")).alias("f")).collect()] == [drift.split_csv(x) for x in lines]


def test_spellings_of_one_value():
    alike = [("$1234.50", "1234,50", "1234.50 USD", "1,234.50"), ("2024-03-05", "3/5/2024", "05.03.2024", "Mar 5, 2024", "March 05, 2024", "5 March 2024"), ("Y", "yes", "true", "1"), ("No. 3", "3"), ("A-b c", "abc")]
    for group in alike:
        assert len({drift.same_value(v) for v in group}) == 1, group
    assert drift.same_value("12 Main St") != drift.same_value("12")


def test_consistent_table_reads_renamed_fields_and_reports_failed_casts(spark):
    days = {f"landing/penalties/f/2024-0{m}-01/x.csv": dt.date(2024, m, 1) for m in (1, 2)}
    a, b = days
    rows = [(a, 0, "ccn,amount"), (a, 1, "1,5.00"), (a, 2, "2,6.00"), (b, 0, "CCN,Sum,extra"), (b, 1, "1,5.00,e"), (b, 2, "2,x6,e"), (b, 3, "3"), (b, 4, None)]
    landed, files = frames(spark, rows, days)
    report, canon = drift_report(landed, files, KINDS, IDENTITY)
    assert {tuple(r)[1:] for r in report.collect()} == {("ADDED_COLUMN", "extra"), ("ADDED_COLUMN", "sum"), ("MISSING_COLUMN", "amount")}
    rows[5] = (b, 2, "2,6.00,e")
    landed, files = frames(spark, rows + [(b, 5, "9,oops,e")], days)
    _, canon = drift_report(landed, files, KINDS, IDENTITY)
    got = {(r["path"], r["row_no"]): r for r in consistent_table(landed, files, canon, "penalties", KINDS["penalties"]).collect()}
    assert str(got[(b, 2)]["amount"]) == "6.00" and got[(b, 2)]["extra"] == {"extra": "e"}
    assert got[(b, 5)]["amount"] is None and got[(b, 5)]["failed_casts"] == ["amount"]
    assert got[(b, 3)]["ccn"] == "3" and got[(b, 4)]["ccn"] is None and len(got) == 7


def test_a_header_alone_gives_a_csv_file_its_fields(spark):
    days = {f"landing/penalties/f/2024-0{m}-01/x.csv": dt.date(2024, m, 1) for m in (1, 2, 3)}
    a, b, c = days
    rows = [(a, 0, "ccn,amount,n"), (a, 1, "1,5.00,7"), (a, 2, "2,6.00,8"), (b, 0, "CCN,Amount,N,note"), (c, 0, "ccn,amount,n,note"), (c, 1, "1,x5,7,e"), (c, 2, "2,x6,8,e")]
    landed, files = frames(spark, rows, days)
    assert {tuple(r) for r in path_statistics(landed).filter(F.col("path") == b).select("name", "rows", "present").collect()} == {(n, 0, 0) for n in ("ccn", "amount", "n", "note")}
    report, canon = drift_report(landed, files, KINDS, IDENTITY)
    got = {tuple(r) for r in report.collect()}
    assert got == brute.drift(rows, days, KINDS, IDENTITY) == {(b, "ADDED_COLUMN", "note"), (c, "TYPE_VALUE_FAILURE", "amount")}
    table = consistent_table(landed, files, canon, "penalties", KINDS["penalties"])
    assert sorted((r["path"], r["row_no"]) for r in table.collect()) == [(a, 1), (a, 2), (c, 1), (c, 2)]


def test_empty_landing(spark):
    landed, files = frames(spark, [], {"landing/penalties/f/2024-01-01/x.csv": dt.date(2024, 1, 1)})
    report, canon = drift_report(landed, files, KINDS, IDENTITY)
    assert report.count() == 0 and canon.count() == 0 and reading_problems(landed, files).count() == 0
    assert consistent_table(landed, files, canon, "penalties", KINDS["penalties"]).count() == 0


def test_csv_fields(spark):
    df = spark.createDataFrame([('a,"b ""q"", x",,',), ("",), ("é",), ('"' + "y" * 200_000 + '",z',)], "r string").select(csv_fields(F.col("r")).alias("f"))
    got = [r["f"] for r in df.collect()]
    assert got[0] == ["a", 'b "q", x', "", ""] and got[1] == [""] and got[2] == ["é"] and len(got[3][0]) == 200_000 and got[3][1] == "z"


def test_canonical_names_follow_chains(spark):
    renames = spark.createDataFrame([("f", 2, "b", "a"), ("f", 3, "c", "b"), ("g", 2, "x", "y")], "feed string, seq int, name string, gone string")
    assert {r["feed"]: r["canon"] for r in canonical_names(renames).collect()} == {"f": {"b": "a", "c": "a"}, "g": {"x": "y"}}


def test_headers():
    a = assess_header(["﻿Provider Name", "ZIP-Code", "New Field!", "2nd"], ["provider_name", "zip_code"])
    assert a.columns == ["provider_name", "zip_code", "new_field", "source_2nd"] and not a.breaking
    assert {k for k, _, _ in a.records()} == {"ADDED_COLUMN"}
    b = assess_header(["a", "A", "!!", "Load Timestamp", "extra"], ["a", "z"])
    assert b.missing == ["z"] and b.duplicate == ["A"] and b.invalid == ["!!", "Load Timestamp"] and b.breaking
    assert ("RENAMED_OR_UNMAPPED_COLUMN", "extra", "source header 'extra'") in b.records()
    assert assess_header(["Total"], ["t_4a14"], {"Total": "t_4a14"}).columns == ["t_4a14"]
    c = assess_keys(["b", "x y", "n", "b"], ["a", "b"])
    assert c.columns == ["a", "b", "n"] and c.missing == ["a"] and c.invalid == ["x y"]
    assert match_key(" A-b_C ") == "abc" and new_name("9 x__y ") == "source_9_x_y"
    assert strict_mapping(["A", "b"], ["a", "b"]) == {"A": "a", "b": "b"}
    with pytest.raises(ValueError):
        strict_mapping(["A"], ["a", "b"])
    with pytest.raises(ValueError):
        qualified_name("ok", "not ok")


def test_whole_table_holds_the_rows_of_all_datasets(spark):
    kinds = {"penalties": {"ccn": "", "day": "date", "n": "int"}, "reports": {"code": "", "ccn": "", "share": "double"}}
    days = {f"{d}/f/2024-0{m}-01/x.{e}": (d, m) for d, e in (("penalties", "csv"), ("reports", "json"), ("others", "csv")) for m in (1, 2)}
    (a, b, c, d, e, _), lost = days, "nowhere/x.csv"
    rows = [(a, 0, "ccn,day,n"), *((a, i, f"{i},2024-01-0{i},{i}") for i in (1, 2, 3)), (b, 0, "CCN,Due Day,n,code"), *((b, i, f"{i},2024-01-0{i},x{i},q") for i in (1, 2, 3)), (b, None, "3,4"), (b, -1, None)]
    rows += [(c, 0, '{"code":"A","ccn":"7","share":0.5}'), (d, 0, '{"code":"B","ccn":"8","share":"half","n":"4"}'), (d, 1, "[]"), (e, 0, "ccn,n"), (e, 1, "1,2"), (lost, 0, "ccn,n"), (lost, 1, "9,9"), (None, 4, "text"), (None, 0, None)]
    landed = land(spark.createDataFrame(rows, "p string, n int, r string"), "p", "n", "r")
    manifest = spark.createDataFrame([(p, dt.date(2024, m, 1), k, dt.datetime(2024, 1, 1)) for p, (k, m) in days.items()], "landing_path string, as_of_date date, dataset string, load_timestamp timestamp")
    files = ordered_files(manifest, landed)
    _, canon = drift_report(landed, files, kinds, {"penalties": ("ccn",)})
    table = whole_table(landed, files, canon, kinds)
    assert table.columns == ["dataset", "path", "row_no", "ccn", "day", "n", "code", "share", "extra", "failed_casts", "problems"]
    day = lambda i: dt.date(2024, 1, i)
    want = [("penalties", a, i, str(i), day(i), i, None, None, {}, [], []) for i in (1, 2, 3)]
    want += [("penalties", b, i, str(i), day(i), None, None, None, {"code": "q"}, ["n"], []) for i in (1, 2, 3)]
    want += [("penalties", b, None, None, None, None, None, None, {"record": "3,4"}, [], ["NO_PLACE_IN_FILE"]), ("penalties", b, -1, None, None, None, None, None, {"record": None}, [], ["NO_PLACE_IN_FILE", "UNREADABLE_RECORD"])]
    want += [("reports", c, 0, "7", None, None, "A", 0.5, {}, [], []), ("reports", d, 0, "8", None, None, "B", None, {"n": "4"}, ["share"], []), ("reports", d, 1, None, None, None, None, None, {}, [], ["UNREADABLE_RECORD"])]
    want += [("others", e, 1, None, None, None, None, None, {"ccn": "1", "n": "2"}, [], []), (None, lost, 1, None, None, None, None, None, {"ccn": "9", "n": "9"}, [], ["NOT_IN_MANIFEST"])]
    want += [(None, None, 4, None, None, None, None, None, {"record": "text"}, [], ["NO_PLACE_IN_FILE"]), (None, None, 0, None, None, None, None, None, {"record": None}, [], ["NO_PLACE_IN_FILE", "UNREADABLE_RECORD"])]
    plain = lambda rows: sorted(repr([sorted(v.items()) if isinstance(v, dict) else v for v in r]) for r in rows)
    assert plain(table.collect()) == plain(want)
    with pytest.raises(ValueError, match="n of reports"):
        whole_table(landed, files, canon, kinds | {"reports": {"n": ""}})


def test_p7_penalties_returns_every_landed_row_but_the_headers(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    landed = spark.read.parquet("/root/testdata/sf0.001/landing_records.parquet")
    want = landed.filter(~(F.col("landing_path").endswith(".csv") & (F.col("row_no") == 0))).groupBy("landing_path").count()
    got = problems.p7_penalties(spark, "/root/testdata/sf0.001").groupBy("path").count()
    assert dict(map(tuple, got.collect())) == dict(map(tuple, want.collect()))
