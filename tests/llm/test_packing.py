import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.packing import SumOfSquares, fill, pack


def naive(capacity, sizes):
    """The rule spelled out: try each gap, take the least sum of squares, full bins leave the sum."""
    gaps: dict[int, int] = defaultdict(int)
    bins, out = 0, []
    for s in sizes:
        options = []
        for g in [*sorted(k for k, n in gaps.items() if n and k >= s), None]:
            after = dict(gaps)
            if g is not None:
                after[g] -= 1
            rest = (capacity if g is None else g) - s
            if rest:
                after[rest] = after.get(rest, 0) + 1
            options.append((sum(n * n for n in after.values()), g is None, g or 0, after))
        best = min(options, key=lambda o: (o[0], o[1], o[2]))
        gaps = defaultdict(int, best[3])
        bins += best[1]
        out.append(best[0])
    return bins, out


def test_placement_follows_the_rule():
    rng = random.Random(1)
    for capacity in (7, 20):
        sizes = [rng.randrange(1, capacity + 1) for _ in range(300)]
        p = SumOfSquares(capacity)
        fill, squares = defaultdict(int), []
        for s in sizes:
            fill[p.place(s)] += s
            squares.append(int((p.counts**2).sum()))
        bins, want = naive(capacity, sizes)
        assert max(fill.values()) <= capacity and squares == want and p.bins == bins


SIZES = "doc_id bigint, n bigint"


def check(rows, got, windows):
    capacity = dict(windows)
    used, parts = defaultdict(int), defaultdict(list)
    for r in got:
        used[(r["window_id"], r["bin_id"])] += r["n_tokens"]
        parts[(r["window_id"], r["doc_id"])].append((r["part"], r["first_token"], r["n_tokens"]))
    assert all(n <= capacity[w] for (w, _), n in used.items())
    for w, c in windows:
        for k, n in rows:
            mine, n = sorted(parts[(w, k)]), n or 0
            assert len(mine) == max(1, -(-n // c)) and sum(p[2] for p in mine) == n  # whole unless longer than the window
            assert [p[1] for p in mine] == [i * c for i in range(len(mine))]
    return used


def test_pack_keeps_everything(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0, None, 1, 5, 16, 17, 32, 100, rng.randrange(1, 17)])) for i in range(500)]
    windows = [(1, 16), (2, 50)]
    df = spark.createDataFrame(rows, SIZES).withColumn("bin_id", F.lit("clash"))
    for per_shard in (10_000, 60):
        check(rows, pack(df, "doc_id", "n", windows, len(rows), per_shard).collect(), windows)
    a, b = (pack(df.repartition(n), "doc_id", "n", windows, len(rows), 60) for n in (1, 7))
    assert a.exceptAll(b).isEmpty()  # bins depend on the rows only
    assert pack(df.limit(0), "doc_id", "n", windows, 0).count() == 0
    with pytest.raises(ValueError):
        pack(df, "doc_id", "n", [(1, 0)], 1)


def test_little_room_is_wasted(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(20, 300)) for i in range(3000)]
    used = check(rows, pack(spark.createDataFrame(rows, SIZES), "doc_id", "n", [(1, 512)], len(rows)).collect(), [(1, 512)])
    assert sum(used.values()) / (512 * len(used)) > 0.99


def test_repeated_items_are_placed_each(spark):
    got = pack(spark.createDataFrame([(1, 5)] * 7, SIZES), "doc_id", "n", [(1, 10)], 7).collect()
    assert len(got) == 7 and len({r["bin_id"] for r in got}) == 4


def test_fill_counts_bins_and_room(spark):
    bins = pack(spark.createDataFrame([(1, 5), (2, 5), (3, 4), (4, 0)], SIZES), "doc_id", "n", [(1, 10), (2, 5)], 4)
    got = {r["window_id"]: (r["bins"], r["n_tokens"], round(r["fill"], 3)) for r in fill(bins, [(1, 10), (2, 5)]).collect()}
    assert got == {1: (2, 14, 0.7), 2: (3, 14, 0.933)}
