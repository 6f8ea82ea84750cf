import datetime as dt
import random
from collections import Counter
from decimal import Decimal
from statistics import median

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.profile import HISTOGRAM, VALIDITY, chunk_statistics, grouped_median, load_histogram, table_profile
from ledgerloom.sources.parquet_stats import chunks

VALID = {"zip": "[0-9]{5}", "code": "[A-L]", "day": ".*"}
NEEDS = {"zip": VALIDITY, "code": HISTOGRAM, "day": HISTOGRAM}


@pytest.fixture(params=["snappy", "zstd", "none", "gzip"])
def written(request, tmp_path):
    rng = random.Random(4)
    rows = []
    for load, n, dirty in (("l1", 40, False), ("l2", 40, True), ("l3", 40, False), (None, 7, False)):
        for _ in range(n):
            z = rng.choice(["12345", "99999", *([" ", None, "1234"] if dirty else [None])])
            rows.append((load, z, rng.choice(["A", "B", None]) if load != "l3" else "C", f"day-{load}"))
    rng2 = rows[:20] + [(a, b, c, d) for a, b, c, d in rows[-20:]]
    folder = tmp_path / "t.parquet"
    folder.mkdir()
    for name, part in (("a", rows), ("b", rng2), ("c", [])):
        cols = list(zip(*part)) or [[]] * 4
        table = pa.table({n: pa.array(list(c), pa.string()) for n, c in zip(("load", "zip", "code", "day"), cols)} | {"n_rows": pa.array([1] * len(part))})
        pq.write_table(table, folder / f"{name}.parquet", row_group_size=40, compression=request.param)
    return str(folder), rows + rng2


def test_histogram_equals_a_plain_count(spark, written):
    path, rows = written
    got = load_histogram(spark, path, "load", NEEDS, VALID).collect()
    for k, column in ((2, "code"), (3, "day")):
        want = Counter((r[0], r[k]) for r in rows if r[0] is not None)
        assert {(r["load"], r["value"]): r["n"] for r in got if r["column"] == column} == want
    kind = lambda v: "blank" if v is None or not v.strip() else "valid" if len(v) == 5 else "invalid"
    want, have = Counter((r[0], kind(r[1])) for r in rows if r[0] is not None), Counter()
    for r in got:
        if r["column"] == "zip":
            have[(r["load"], kind(r["value"]))] += r["n"]
    assert have == want


def test_sufficient_chunks_are_not_scanned(spark, written):
    path, _ = written
    files = spark.read.parquet(path).inputFiles()
    stats = chunk_statistics(spark, files, "load", NEEDS, VALID).collect()
    settled = {(r["load"], r["column"]) for r in stats if not r["scan"]}
    assert ("l1", "zip") in settled and ("l3", "code") in settled and ("l1", "day") in settled
    assert ("l2", "zip") not in settled and ("l1", "code") not in settled


def test_footers(written):
    path, rows = written
    got = chunks(f"{path}/a.parquet", ["load", "zip", "nowhere"], ["zip"])
    assert [c.rows for c in got] == [40, 40, 40, 7] and [c.first_row for c in got] == [0, 40, 80, 120]
    assert got[0].constant["load"] == "l1" and got[0].nulls["zip"] == sum(r[1] is None for r in rows[:40])
    assert set(got[1].values["zip"]) == {r[1] for r in rows[40:80] if r[1] is not None}
    assert got[3].nulls["load"] == 7 and got[0].nulls["nowhere"] == 40


def test_exact_medians(spark):
    rng = random.Random(9)
    data = {g: [rng.choice([-1, 1]) * rng.randrange(10 ** rng.randrange(1, 14)) for _ in range(n)] for g, n in (("a", 1), ("b", 2), ("c", 301), ("d", 500))}
    data["e"] = [5] * 1000 + [7]
    rows = [(g, v, 1) for g, vs in data.items() for v in vs] + [("c", data["c"][0], 0)]
    got = {r["g"]: r["median"] for r in grouped_median(spark.createDataFrame(rows, "g string, v bigint, n bigint"), ["g"], "v", "n").collect()}
    assert got == {g: float(median(vs)) for g, vs in data.items()}
    assert grouped_median(spark.createDataFrame([], "g string, v bigint, n bigint"), ["g"], "v", "n").count() == 0


def test_empty_table(spark, tmp_path):
    pq.write_table(pa.table({n: pa.array([], pa.string()) for n in ("load", "zip", "code", "day")}), tmp_path / "e.parquet")
    assert load_histogram(spark, str(tmp_path / "e.parquet"), "load", NEEDS, VALID).count() == 0


def test_file_names_with_blanks(spark, tmp_path):
    folder = tmp_path / "with blank%20.parquet"
    folder.mkdir()
    pq.write_table(pa.table({"load": ["x"] * 4 + ["y"] * 4, "zip": ["1"] * 8, "code": ["A", "B"] * 4, "day": ["d"] * 8}), folder / "p 1.parquet", row_group_size=4)
    got = load_histogram(spark, str(folder), "load", NEEDS, VALID)
    assert got.filter("column = 'code'").agg(F.sum("n")).first()[0] == 8


def test_medians_are_the_same_beyond_the_bound(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), rng.randrange(-50, 10**6), rng.randrange(1, 4)) for _ in range(300)] + [("c", 7, 2)]
    hist = spark.createDataFrame(rows, "g string, v bigint, n bigint")
    a, b = (dict(map(tuple, grouped_median(hist, ["g"], "v", "n", small).collect())) for small in (100_000, 0))
    assert a == b == {g: median(v for k, v, n in rows for _ in range(n) if k == g) for g in "abc"}


def test_profile_of_every_column(spark, tmp_path):
    path = tmp_path / "t.parquet"
    path.mkdir()
    day = dt.date(2024, 1, 1)
    rows = [("l1", "2024-01-01", "12345" if i % 4 else " ", i, None if i % 5 == 0 else i / 4, "same", None, day + dt.timedelta(i)) for i in range(40)]
    rows += [("l2", "2024-02-01", "9999x" if i % 2 else None, i + 100, None, "same", None, day) for i in range(20)] + [(None, None, "12345", 5, 1.0, "same", None, day)] * 3
    names = ["load", "released", "zip", "k", "amount", "fixed", "empty", "day"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.string(), pa.string(), pa.date32()]
    for n, part in enumerate((rows, rows[5:15] + rows[40:], [])):
        columns = list(zip(*part)) or [[]] * 8
        pq.write_table(pa.table({c: pa.array(list(v), k) for c, v, k in zip(names, columns, kinds)}), path / f"{n}.parquet", row_group_size=20)
    every = rows + rows[5:15] + rows[40:]
    got = {(r["column_name"], r["batch_id"]): r for r in table_profile(spark, str(path), "load", "released", {"zip": "[0-9]{5}"}).collect()}
    assert set(got) == {(c, b) for c in names[1:] for b in ("l1", "l2", None)}
    for k, c in enumerate(names):
        for b in ("l1", "l2", None) if k else ():
            mine = [r[k] for r in every if r[0] == b]
            r, full = got[c, b], [v for v in mine if v is not None]
            assert (r["rows"], r["nulls"]) == (len(mine), len(mine) - len(full)), (c, b)
            if c in ("k", "amount"):
                assert (r["least_number"], r["greatest_number"]) == (min(full, default=None), max(full, default=None))
            if c == "day":
                assert (r["least"], r["greatest"]) == (str(min(full)), str(max(full)))
            assert r["distinct_values"] == (None if c in ("k", "amount", "day") else len(set(full)))
    assert got["zip", "l1"]["blanks"] == sum(r[0] == "l1" and r[2] == " " for r in every) and got["zip", "l1"]["violations"] == 0
    assert got["zip", "l2"]["violations"] == sum(r[2] == "9999x" for r in every) and got["zip", "l2"]["shift"] == 1.0 and got["fixed", "l2"]["shift"] == 0.0
    assert got["fixed", "l2"]["violations"] is None and got["amount", "l2"]["null_rate_change"] == 1 - got["amount", "l1"]["null_rate"] and got["zip", "l2"]["distinct_ratio"] == 0.5
    empty = tmp_path / "e.parquet"
    empty.mkdir()
    pq.write_table(pa.table({c: pa.array([], k) for c, k in zip(names, kinds)}), empty / "0.parquet")
    assert table_profile(spark, str(empty), "load", "released", {}).count() == 0


def test_profile_of_typed_columns_and_other_types(spark, tmp_path):
    path = tmp_path / "t.parquet"
    path.mkdir()
    day, at = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 250_000)
    kinds = {
        "load": pa.string(), "released": pa.string(), "k": pa.int64(), "x": pa.float64(), "flag": pa.bool_(), "price": pa.decimal128(20, 9), "day": pa.date32(), "at": pa.timestamp("us"),
        "raw": pa.binary(), "tags": pa.list_(pa.int32()), "pair": pa.struct([("a", pa.string()), ("b", pa.int32())]),
    }
    rows = [
        ("l1", "2024-01-01", 2**60 + i % 7, float("inf") if i == 3 else i % 4 / 4, i % 2 == 0, Decimal(i % 3) / 10**9, day + dt.timedelta(i % 5), at, bytes([i % 6]), [i % 2, None], {"a": None, "b": i % 3} if i else None) for i in range(40)
    ]
    rows += [("l2", "2024-02-01", 5, None, True, Decimal(0), day, at + dt.timedelta(seconds=i % 2), b"\xff", [i], {"a": "y", "b": 1}) for i in range(20)]
    for n, part in enumerate((rows, rows[7:20] + rows[50:])):
        pq.write_table(pa.table({c: pa.array(list(v), k) for (c, k), v in zip(kinds.items(), zip(*part))}), path / f"{n}.parquet", row_group_size=20)
    every = rows + rows[7:20] + rows[50:]
    got = {(r["column_name"], r["batch_id"]): r for r in table_profile(spark, str(path), "load", "released", {}, typed=True).collect()}
    assert set(got) == {(c, b) for c in kinds if c != "load" for b in ("l1", "l2")}
    share = {}
    for j, c in enumerate(kinds):
        for b in ("l1", "l2") if j else ():
            full = Counter(repr(r[j]) for r in every if r[0] == b and r[j] is not None)
            r, total = got[c, b], sum(1 for r in every if r[0] == b)
            share[c, b] = {v: n / full.total() for v, n in full.items()}
            assert (r["rows"], r["nulls"], r["distinct_values"]) == (total, total - full.total(), len(full)), (c, b)
    for c in kinds:
        if c not in ("load", "x"):
            both, r = (share[c, "l1"], share[c, "l2"]), got[c, "l2"]
            assert r["shift"] == pytest.approx(sum(abs(both[0].get(v, 0) - both[1].get(v, 0)) for v in {*both[0], *both[1]}) / 2), c
            assert r["distinct_ratio"] == len(both[1]) / len(both[0]), c
    ends = lambda c, b="l1": (got[c, b]["least"], got[c, b]["greatest"])
    assert ends("k") == (str(2**60), str(2**60 + 6)) and ends("flag") == ("false", "true") and ends("x") == ("0.0", "Infinity") and got["x", "l1"]["greatest_number"] == float("inf")
    assert ends("price") == ("0.000000000", "0.000000002") and ends("raw") == ("00", "05") and ends("at") == ("2024-01-01 00:00:00.25",) * 2
    assert ends("tags") == ("[0,null]", "[1,null]") and ends("pair") == ('{"a":null,"b":0}', '{"a":null,"b":2}')
