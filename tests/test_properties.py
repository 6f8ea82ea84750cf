"""Properties over generated inputs, without a session where none is needed."""

import csv
import datetime as dt
import io
import json

import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.functions.headers import assess_header, new_name
from ledgerloom.operators.classify import classify
from ledgerloom.operators.history import close_versions
from ledgerloom.operators.merge import apply_merge, merge_actions
from ledgerloom.operators.record_parser import COLUMN_COUNT, JSON, QUOTING, parse_group, strict_csv, strict_json

CELL = st.text(alphabet='ab ,"\n\ré', max_size=6)
NOISE = st.text(alphabet='a,"\n{}[]:1 \\', max_size=14)
FEW = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


@given(st.lists(CELL, min_size=1, max_size=5))
def test_written_csv_records_are_read_back(cells):
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(cells)
    assert strict_csv(out.getvalue()) == cells


@settings(deadline=None)
@given(st.lists(NOISE, max_size=12), st.integers(1, 5))
def test_csv_blocks_agree_with_single_records(records, block):
    errors, fields = parse_group(pa.array(records, pa.string()), "csv", ["x", "y"], block)
    for text, error, got in zip(records, errors, fields.to_pylist()):
        want = strict_csv(text)
        assert error == (QUOTING if want is None else COLUMN_COUNT if len(want) != 2 else None)
        assert got == (want if error is None else None)


@settings(deadline=None)
@given(st.lists(st.one_of(NOISE, st.dictionaries(st.sampled_from("xyz"), st.one_of(st.none(), st.integers(), st.text(max_size=3), st.booleans())).map(json.dumps)), max_size=10), st.integers(1, 5))
def test_json_blocks_agree_with_single_records(records, block):
    errors, _ = parse_group(pa.array(records, pa.string()), "json", ["x", "y"], block)
    assert errors == [JSON if strict_json(r) is None else None for r in records]


@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), st.sampled_from([None, "a", "b"])), max_size=18, unique_by=lambda r: r[:2]), st.integers(1, 4))
def test_versions_do_not_depend_on_batches(rows, size):
    days = [dt.date(2024, 1, d + 1) for d in range(6)]
    schema = pa.schema([("entity", pa.string()), ("valid_from", pa.date32()), ("valid_to", pa.date32()), ("p", pa.string())])
    kind = pa.schema([("entity", pa.string()), ("idx", pa.int32()), ("p", pa.string())])
    ordered = [{"entity": str(e), "idx": i, "p": v} for e, i, v in sorted(rows, key=lambda r: r[:2])]
    batches = lambda n: iter([pa.RecordBatch.from_pylist(ordered[k : k + n], schema=kind) for k in range(0, len(ordered), n)])
    run = lambda n: [r for b in close_versions(batches(n), ["p"], days, schema) for r in b.to_pylist()]
    got = run(size)
    assert got == run(100)
    for r in got:
        assert r["valid_from"] < r["valid_to"]
    covered = {(r["entity"], d) for r in got for d in days if r["valid_from"] <= d < r["valid_to"]}
    assert covered == {(str(e), days[i]) for e, i, _ in rows}  # versions cover exactly the snapshots that hold the entity


@given(st.text(max_size=20))
def test_new_names_are_safe(text):
    name = new_name(text)
    assert name == "" or (name.isidentifier() and name == name.lower())
    assert len(assess_header([text], []).columns) <= 1


ROWS = st.lists(st.tuples(st.sampled_from([None, "k1", "k2", "k3"]), st.sampled_from("xy"), st.booleans()), max_size=12)


@FEW
@given(ROWS)
def test_rows_are_conserved(spark, rows):
    df = spark.createDataFrame([(i, k, h, ["R"] if bad else []) for i, (k, h, bad) in enumerate(rows)], "i int, k string, h string, failed array<string>")
    got = classify(df, "k", "h", "failed", [df["i"]]).collect()
    assert sorted(r["i"] for r in got) == list(range(len(rows)))
    accepted = [r["k"] for r in got if r["status"] == "ACCEPTED"]
    assert len(accepted) == len(set(accepted)) and None not in accepted


DAY = st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 1, 4)))
SIDE = st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from("xy"), DAY, st.booleans()), max_size=4, unique_by=lambda r: r[0])


@FEW
@given(SIDE, SIDE)
def test_a_second_merge_changes_nothing(spark, target, source):
    ddl = "k string, row_hash string, source_processing_date date, is_deleted boolean"
    t, s = spark.createDataFrame(target, ddl), spark.createDataFrame([(k, h, d, False) for k, h, d, _ in source], ddl)
    after = apply_merge(merge_actions(t, s, "k"), t.columns)
    again = apply_merge(merge_actions(after, s, "k"), t.columns)
    assert sorted(map(str, after.collect())) == sorted(map(str, again.collect()))
    assert {r["k"] for r in after.collect()} == {r[0] for r in target} | {r[0] for r in source}
