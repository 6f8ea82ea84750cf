import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.references import FULL, PARTIAL, SIMPLE, orphan_keys, orphan_references

REFS = [("a", 1), ("a", 9), ("zz", 1), ("a", None), ("zz", None), (None, 1), (None, 77), (None, None), ("a", 1)]
PARENTS = [("a", 1), ("b", 2), (None, 3)]


def keys(spark, match):
    r, p = spark.createDataFrame(REFS, "x string, y int"), spark.createDataFrame(PARENTS, "x string, y int")
    return {tuple(t) for t in orphan_keys(r, p, ["x", "y"], match).collect()}


def test_match_semantics(spark):
    assert keys(spark, SIMPLE) == {("a", 9), ("zz", 1)}
    assert keys(spark, PARTIAL) == {("a", 9), ("zz", 1), ("zz", None), (None, 77)}
    assert keys(spark, FULL) == {("a", 9), ("zz", 1), ("a", None), ("zz", None), (None, 1), (None, 77)}
    with pytest.raises(ValueError):
        keys(spark, "other")


def test_empty_tables(spark):
    r, p = spark.createDataFrame(REFS, "x string, y int"), spark.createDataFrame(PARENTS, "x string, y int")
    assert orphan_keys(r.limit(0), p, ["x", "y"]).count() == 0
    assert {tuple(t) for t in orphan_keys(r, p.limit(0), ["x", "y"]).collect()} == {("a", 1), ("a", 9), ("zz", 1)}


def test_reasons_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    parents = {(f"c{c}", i) for c in range(20) for i in range(6) if rng.random() < 0.5}
    refs = [(n, "c3" if n % 3 == 0 else f"c{rng.randrange(26)}", rng.choice([None, -1, 0, 1, 2, 3, 4, 5])) for n in range(400)]

    def reason(c, i):
        mine = [p for k, p in parents if k == c]
        if i is None:
            return None if mine else "MISSING"
        if i in mine:
            return None
        return "DELETED" if any(p < i for p in mine) else "LATE" if any(p > i for p in mine) else "MISSING"

    want = {(n, reason(c, i)) for n, c, i in refs if reason(c, i)}
    r = spark.createDataFrame(refs, "n int, ccn string, idx int").withColumn("_first", F.lit("clash")).withColumn("reason", F.lit("clash"))
    p = spark.createDataFrame(list(parents), "ccn string, idx int")
    got = orphan_references(r, p, ["ccn", "idx"], "idx", "ccn", PARTIAL, ["idx"])
    assert {(t["n"], t["reason"]) for t in got.collect()} == want
