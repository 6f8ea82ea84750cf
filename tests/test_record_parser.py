import csv
import io
import json
import random

import pyarrow as pa
import pytest

from ledgerloom.functions.rules import judge
from ledgerloom.operators.record_parser import COLUMN_COUNT, JSON, QUOTING, parse_group, parse_records, strict_csv, strict_json
from ledgerloom.spec import DEFICIENCIES, PENALTIES
from pyspark.sql import functions as F


def test_strict_csv():
    assert strict_csv("a,b,") == ["a", "b", ""]
    assert strict_csv('"a ""q"", x",b') == ['a "q", x', "b"]
    assert strict_csv('"line\nbreak",b') == ["line\nbreak", "b"]
    assert strict_csv("") == [""]
    for bad in ('a,"b', '"a"x,b', 'a"b,c', '"a" ,b', "a\nb,c", '"', 'a,""" '):
        assert strict_csv(bad) is None, bad


def test_strict_json():
    assert strict_json('{"a": 1.50, "b": "x"}') == {"a": "1.50", "b": "x"}
    for bad in ('{"a":1,}', "{'a':1}", '{"a":NaN}', "[1]", '"x"', "", '{"a":1} {"b":2}', '{"a":"\n"}', "[" * 100_000):
        assert strict_json(bad) is None, bad[:20]


def mutate(rng, text):
    for _ in range(rng.choice([0, 0, 1, 2])):
        i = rng.randrange(len(text) + 1)
        text = rng.choice([text[:i] + rng.choice('",{}[]:\n x1') + text[i:], text[:i] + text[i + 1 :], text[:i]])
    return text


def test_csv_blocks_equal_the_strict_parser():
    rng = random.Random(1)
    rows = []
    for _ in range(900):
        out = io.StringIO()
        csv.writer(out, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), lineterminator="").writerow([rng.choice(["", "a", "x, y", 'q"q', "é\nz", " "]) for _ in range(4)])
        rows.append(mutate(rng, out.getvalue()))
    errors, fields = parse_group(pa.array([*rows, None, ""]), "csv", list("abcd"), 64)
    for text, error, got in zip([*rows, "", ""], errors, fields.to_pylist()):
        want = strict_csv(text)
        assert error == (QUOTING if want is None else COLUMN_COUNT if len(want) != 4 else None)
        assert got == (want if error is None else None)


def test_a_failing_csv_block_is_bisected_by_its_parses(monkeypatch):
    from ledgerloom.operators import record_parser

    parsed, strict = [], []
    block, alone = record_parser.csv_passes, record_parser.strict_csv
    monkeypatch.setattr(record_parser, "csv_passes", lambda records, width: parsed.append(len(records)) or block(records, width))
    monkeypatch.setattr(record_parser, "strict_csv", lambda record: strict.append(record) or alone(record))
    errors, _ = parse_group(pa.array(["a,b"] * 11 + ["a"] + ["a,b"] * 20), "csv", ["x", "y"], 16)
    assert [i for i, e in enumerate(errors) if e] == [11] and errors[11] == COLUMN_COUNT
    assert parsed == [16, 8, 8, 4, 2, 2, 1, 1, 4, 16] and strict == ["a"]


def test_what_the_columnar_reader_refuses_is_halved(monkeypatch):
    from ledgerloom.operators import record_parser

    read = []
    reader = record_parser.csv_columns
    monkeypatch.setattr(record_parser, "csv_columns", lambda records, width: read.append(len(records)) or (None if "x,y" in records else reader(records, width)))
    errors, fields = parse_group(pa.array(["a,b"] * 5 + ["x,y"] + ["a,b"] * 2), "csv", ["x", "y"], 16)
    assert errors == [None] * 8 and fields.to_pylist()[5] == ["x", "y"] and read == [8, 4, 4, 2, 1, 1, 2]


def test_separators_and_byte_order_marks_inside_records(spark):
    texts = ["\ufeffa,b", "a\x1eb,c", '"a\x1e",b', "a,b\x1e", "\ufeffa,b", '"\r\n",""', "a\r,b", "a,b"]
    for block in (1, 2, 64):
        errors, fields = parse_group(pa.array(texts), "csv", ["x", "y"], block)
        for text, error, got in zip(texts, errors, fields.to_pylist()):
            assert got == strict_csv(text) and (error is None) == (got is not None), text
    forged = ['{"a":1},"\\u0002record\\u0003",{"b":2}', '{"b":["x"', '"y"]}', '{"a":"x}', '{y"}', "{},{}"]
    errors, _ = parse_group(pa.array(forged), "json", ["a", "b"], 64)
    assert errors == [JSON] * 6
    rows = [(i, "p", "csv" if i % 2 else "json", t) for i, t in enumerate([t for pair in zip(forged, texts) for t in pair])]
    df = spark.createDataFrame(rows, "id int, dataset string, fmt string, rec string").repartition(1)
    seen = []
    for n in ("1", "4", "1000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
        seen.append(sorted(map(str, parse_records(df, ["id"], "dataset", "fmt", "rec", {"p": ["x", "y"]}).collect())))
    assert seen[0] == seen[1] == seen[2]


def test_json_blocks_equal_the_strict_parser():
    rng = random.Random(2)
    value = lambda: rng.choice(["x", 'q"', None, 3, 2.50, True, {"n": [1]}, ""])
    rows = [mutate(rng, json.dumps({k: value() for k in "abz" if rng.random() < 0.8})) for _ in range(900)]
    rows += ['{"a":1', '"b":2}', '{"a":1},{"b":2}', '{"a":[1', "2]}", "{}", ""]
    errors, fields = parse_group(pa.array(rows), "json", ["a", "b"], 64)
    for text, error, got in zip(rows, errors, fields.to_pylist()):
        want = strict_json(text)
        assert error == (JSON if want is None else None), text
        if want is not None:
            plain = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)
            assert got == [plain(want.get("a")), plain(want.get("b"))]


def test_records_keep_order_and_extra_columns(spark):
    rows = [(i, "p" if i % 2 else "h", "CSV" if i % 3 else "json", t) for i, t in enumerate(["1,2", '{"x":"5"}', "1", None, '"', '{"x":7}', "a,b", '{"x"'])]
    rows = [(i, d, f, t) for i, d, f, t in rows]
    df = spark.createDataFrame(rows, "id int, dataset string, fmt string, rec string").withColumn("fields", F.lit("clash"))
    got = {r["id"]: (r["structure"], r["fields"]) for r in parse_records(df, ["id"], "dataset", "fmt", "rec", {"p": ["x", "y"], "h": ["x"]}).collect()}
    assert got[0] == ("JSON", None) and got[2] == (None, ["1"]) and got[3] == ("JSON", None) and got[4] == ("QUOTING", None)
    assert len(got) == 8
    assert parse_records(df.limit(0), ["id"], "dataset", "fmt", "rec", {}).count() == 0
    with pytest.raises(ValueError):
        parse_records(df, ["id", "fields"], "dataset", "fmt", "rec", {})


def test_no_record_ends_the_query(spark):
    rows = [(0, None, "csv", "1"), (1, "h", None, "1"), (2, "q", "xml", "1"), (3, "h", "xml", "1"), (4, "h", "json", '{"x":"a\\ud800b"}'), (5, "h", "json", '{"x":["\\udc00"]}'), (6, "h", "json", '{"x":"\\ud83d\\ude00"}'), (7, "h\nq", "csv", "1"), (8, "h", "csv", "1")]
    df = spark.createDataFrame(rows, "id int, dataset string, fmt string, rec string")
    got = {r["id"]: (r["structure"], r["fields"]) for r in parse_records(df, ["id"], "dataset", "fmt", "rec", {"h": ["x"]}).collect()}
    assert got == {
        0: ("UNKNOWN_DATASET", None), 1: ("UNKNOWN_FORMAT", None), 2: ("UNKNOWN_DATASET", None), 3: ("UNKNOWN_FORMAT", None), 4: (None, ["a\ufffdb"]),
        5: (None, ['["\ufffd"]']), 6: (None, ["\U0001f600"]), 7: ("UNKNOWN_DATASET", None), 8: (None, ["1"]),
    }


def reasons(spark, spec, **values):
    row = [values.get(c) for c in spec.source]
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in spec.source))
    return set(judge(df, spec).first()["failed"])


FINE = dict(cms_certification_number_ccn="01a234", penalty_date="2024-01-05", penalty_type="Fine", fine_id="F1", fine_amount="10.50", state="tx", zip_code="12345", processing_date="2024-02-01")
DEF = dict(cms_certification_number_ccn="012345", survey_date="2024-01-05", survey_type="Health", deficiency_prefix="f", deficiency_tag_number="0123", inspection_cycle="1")


def test_rules(spark):
    assert reasons(spark, PENALTIES, **FINE) == set()
    assert reasons(spark, PENALTIES, **FINE | {"payment_denial_start_date": "2024-01-09"}) == {"CONDITIONAL:fine_subtype"}
    assert reasons(spark, PENALTIES, **FINE | {"fine_amount": "$5"}) == {"SAFE_CAST:fine_amount", "CONDITIONAL:fine_subtype"}
    assert reasons(spark, PENALTIES, **FINE | {"fine_amount": "-5"}) == {"NON_NEGATIVE:fine_amount"}
    assert reasons(spark, PENALTIES, **FINE | {"penalty_type": " "}) == {"REQUIRED:penalty_type"}
    assert reasons(spark, PENALTIES, **FINE | {"penalty_type": "Payment Denial", "fine_id": None, "fine_amount": "", "payment_denial_start_date": "2024-02-30", "payment_denial_length_in_days": "3"}) == {"SAFE_CAST:payment_denial_start_date", "CONDITIONAL:payment_denial_subtype"}
    assert reasons(spark, DEFICIENCIES, **DEF) == set()
    assert reasons(spark, DEFICIENCIES, **DEF | {"inspection_cycle": "abc"}) == {"REQUIRED:inspection_cycle", "SAFE_CAST:inspection_cycle"}
    assert reasons(spark, DEFICIENCIES, **DEF | {"inspection_cycle": "4", "standard_deficiency": "maybe", "zip_code": "12345\n", "scope_severity_code": "m"}) == {"DOMAIN:inspection_cycle", "DOMAIN_YN:standard_deficiency", "REGEX:zip_code", "DOMAIN:scope_severity_code"}
    corrected = {"deficiency_corrected": "Deficient, Provider has date of correction"}
    assert reasons(spark, DEFICIENCIES, **DEF | corrected) == {"CONDITIONAL:correction_date_required"}
    assert reasons(spark, DEFICIENCIES, **DEF | corrected | {"correction_date": "2020-01-01"}) == set()
