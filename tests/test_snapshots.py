import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.deliveries import full_delivery_batches, newest_non_blank, snapshot_batches
from ledgerloom.operators.snapshot_diff import comparable, content_hash, snapshot_changes

DAYS = [dt.date(2024, m, 1) for m in range(1, 7)]


def test_changes_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"k{k}", i, rng.choice("abb")) for k in range(80) for i in range(len(DAYS)) if rng.random() < 0.75] + [(None, 1, "a")]
    want = set()
    state = {(k, i): h for k, i, h in rows if k is not None}
    for k in {k for k, _ in state}:
        for i in range(1, len(DAYS)):
            a, b = state.get((k, i - 1)), state.get((k, i))
            if a != b:
                want.add((k, DAYS[i], "ADDED" if a is None else "REMOVED" if b is None else "CHANGED"))
    df = spark.createDataFrame(rows, "k string, i int, h string").withColumn("extra", F.lit(1))
    cal = spark.createDataFrame([(i, d, DAYS[i + 1] if i + 1 < len(DAYS) else None) for i, d in enumerate(DAYS)], "i int, d date, nd date")
    got = snapshot_changes(df.join(cal, "i"), "k", "i", "h", "d", "nd")
    assert {tuple(r) for r in got.collect()} == want
    assert snapshot_changes(df.join(cal, "i").limit(0), "k", "i", "h", "d", "nd").count() == 0


def test_digest_tells_nulls_and_positions_apart(spark):
    rows = [("a", None), (None, "a"), ("", None), (None, ""), ("a|1:b", None), ("a", "b"), ("1:a", None), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string").select(content_hash([F.col("x"), F.col("y")]).alias("h"))
    assert df.distinct().count() == len(rows)


def test_doubles_agree_to_six_decimals(spark):
    df = spark.createDataFrame([(0.1 + 0.2, 0.3), (45.8108600001, 45.81086), (-0.0, 0.0)], "x double, y double")
    f = lambda n: comparable(T.StructField(n, T.DoubleType()))
    assert df.filter(f("x") == f("y")).count() == 3
    assert spark.createDataFrame([(1.000001, 1.000002)], "x double, y double").filter(f("x") == f("y")).count() == 0


MANIFEST = "batch_id string, acquisition_run_id string, dataset string, as_of_date date, acquisition_strategy string, status string, row_count_validated boolean, load_timestamp timestamp"


def test_full_snapshots(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    rows = [
        ("b1", "r1", "p", DAYS[0], "bulk_snapshot", "FAILURE", False, t(1)),
        ("b1", "r1", "p", DAYS[0], "bulk_snapshot", "SUCCESS", True, t(2)),  # the newest row of a batch counts
        ("b2", "r2", "p", DAYS[0], "snapshot_diff", "SUCCESS", True, t(5)),  # a later delivery of the same date supersedes
        ("b3", "r3", "p", DAYS[1], "snapshot_diff", "SUCCESS", True, t(6)),
        ("b4", "r3", "p", DAYS[1], "snapshot_diff", "SUCCESS", False, t(6)),  # not validated: the whole delivery is no snapshot
        ("b5", "r5", "p", DAYS[2], "api_date_window", "SUCCESS", True, t(7)),
        ("b6", "r6", "p", DAYS[3], "snapshot_diff", "SUCCESS", True, t(8)),
        ("b7", "r7", "other", DAYS[3], "snapshot_diff", "SUCCESS", True, t(8)),
        (None, "r8", "p", DAYS[4], "snapshot_diff", "SUCCESS", True, t(8)),
        ("b9", None, "p", DAYS[4], "snapshot_diff", "SUCCESS", True, t(8)),
    ]
    m = spark.createDataFrame(rows, MANIFEST)
    assert {r["batch_id"] for r in full_delivery_batches(m, "p").collect()} == {"b1", "b2", "b6"}
    got = {(r["batch_id"], r["idx"], r["as_of_date"], r["next_as_of"]) for r in snapshot_batches(m, "p").collect()}
    assert got == {("b2", 0, DAYS[0], DAYS[3]), ("b6", 1, DAYS[3], None)}
    assert snapshot_batches(m.limit(0), "p").count() == 0


def test_newest_non_blank_is_per_column(spark):
    rows = [("x", "a", 1), ("x", " ", 2), ("x", None, 3), ("y", None, 1)]
    df = spark.createDataFrame(rows, "k string, v string, at int").groupBy("k").agg(newest_non_blank(F.col("v"), F.col("at")).alias("v"))
    assert {tuple(r) for r in df.collect()} == {("x", "a"), ("y", None)}
