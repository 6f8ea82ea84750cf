import datetime as dt
import random

from ledgerloom.operators.history import version_history
from pyspark.sql import functions as F

DAYS = [dt.date(2024, m, 1) for m in range(1, 9)]
SCHEMA = "entity string, idx int, own string, beds string"


def brute(rows):
    out, by = set(), {}
    for e, i, o, b in rows:
        if e is not None:
            by.setdefault(e, {})[i] = (o, b)
    for e, seen in by.items():
        last, start, state = None, None, (None, None)
        versions = []
        for i in range(len(DAYS)):
            if i not in seen:
                if start is not None:
                    versions.append((start, i))
                    start = None
                continue
            new = tuple(v if v is not None else s for v, s in zip(seen[i], state))
            if start is None:
                start = i
            elif new != state:
                versions.append((start, i))
                start = i
            state = new
        if start is not None:
            versions.append((start, None))
        out |= {(e, DAYS[a], DAYS[b] if b is not None else dt.date(9999, 12, 31)) for a, b in versions}
    return out


def run(spark, rows, calendar=DAYS):
    df = version_history(spark.createDataFrame(rows, SCHEMA), "entity", "idx", ["own", "beds"], calendar)
    return {(r["entity"], r["valid_from"], r["valid_to"]) for r in df.collect()}


def test_versions_against_brute_force(spark):
    rng = random.Random(7)
    pick = lambda: rng.choice([None, "a", "a", "b"])
    rows = [(f"e{e}", i, pick(), rng.choice([None, "1", "1", "2"])) for e in range(60) for i in range(len(DAYS)) if rng.random() < 0.8]
    assert run(spark, rows) == brute(rows)


def test_blank_continues_across_absence_and_first_report_starts_a_version(spark):
    rows = [("x", 0, "a", None), ("x", 3, None, None), ("x", 4, None, "5"), ("x", 5, "a", "5")]
    assert run(spark, rows) == {("x", DAYS[0], DAYS[1]), ("x", DAYS[3], DAYS[4]), ("x", DAYS[4], DAYS[6])}


def test_null_entities_and_empty_input(spark):
    assert run(spark, [(None, 0, "a", "1")]) == set()
    assert run(spark, []) == set()
    assert run(spark, [], []) == set()


def test_entity_in_every_snapshot_stays_open(spark):
    rows = [("x", i, "a", "1") for i in range(len(DAYS))]
    assert run(spark, rows) == {("x", DAYS[0], dt.date(9999, 12, 31))}


def test_long_values_and_extra_columns(spark):
    long = "v" * 100_000
    df = spark.createDataFrame([("x", 0, long, "1")], SCHEMA).withColumn("valid_from", F.lit("clash")).withColumn("entity_2", F.lit(1))
    got = version_history(df, "entity", "idx", ["own"], DAYS).collect()
    assert len(got) == 1 and got[0]["own"] == long
