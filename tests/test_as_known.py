import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerloom.operators.as_known import as_known

D0 = dt.date(2024, 1, 1)
EV = "id int, ccn string, day date"
RP = "ccn string, known date, as_of date, own string"


def run(spark, events, reports):
    e = spark.createDataFrame(events, EV)
    for clash in ("entity", "period", "base", "known_value", "differs", "changes", "m"):
        e = e.withColumn(clash, F.lit("clash"))
    r = spark.createDataFrame(reports, RP)
    return as_known(e, r, "ccn", "day", "ccn", "known", ["as_of", "known"], "own", "as_of")


def test_against_brute_force(spark):
    rng = random.Random(11)
    day = lambda: D0 + dt.timedelta(days=rng.randrange(400))
    reports = [(f"c{rng.randrange(6)}", day(), day(), rng.choice(["a", "b", None])) for _ in range(120)]
    reports += reports[:10]
    events = [(i, rng.choice([None, *(f"c{k}" for k in range(7))]), rng.choice([None, day(), day(), D0 - dt.timedelta(days=90), dt.date(2031, 1, 1)])) for i in range(300)]

    def best(c, until):
        known = [(a, k, o) for cc, k, a, o in reports if cc == c and o is not None and (until is None or k <= until)]
        return max(known) if known else None

    got = {r["id"]: (r["known_as_of"], r["known_value"], r["differs"]) for r in run(spark, events, reports).collect()}
    assert len(got) == len(events)
    for i, c, d in events:
        b = best(c, d) if c is not None and d is not None else None
        assert got[i] == ((b[0], b[2], b[2] != best(c, None)[2]) if b else (None, None, None)), (i, c, d)


def test_empty_reports_keep_all_events(spark):
    got = run(spark, [(1, "c", D0), (2, None, None)], []).collect()
    assert len(got) == 2 and all(r["known_value"] is None for r in got)
    assert run(spark, [], [("c", D0, D0, "a")]).count() == 0
