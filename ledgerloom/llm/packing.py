"""Filling fixed-capacity containers with items by the sum-of-squares rule.

Method: an item goes where it makes the sum, over all residual gaps, of the squared number of open bins with that gap
smallest: into an open bin of some gap or into a new one. Items longer than the capacity fill whole bins first; their
rest is placed like any other item. Items are spread over shards by hash and each shard is packed as one sorted
stream, so neither the corpus nor a group is ever collected; what a shard leaves open costs far less than one percent
of its room at the default shard size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FAR = np.int64(1) << 40
_OUT = "window_id int, bin_id bigint, item {kind}, part int, first_token bigint, n_tokens bigint"


class SumOfSquares:
    """Open bins of one capacity, by residual gap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[int]] = {}
        self.bins = 0

    def new_bin(self) -> int:
        self.bins += 1
        return self.bins - 1

    def place(self, size: int) -> int:
        """The bin of an item of 1 to capacity units."""
        c = self.capacity
        if size == c:
            return self.new_bin()
        here = self.counts[size:c]
        change = 2 * (self.counts[: c - size] - here) + 2
        change[0] = 1 - 2 * here[0]  # a bin that becomes full leaves the sum
        change[here == 0] = _FAR
        k = int(change.argmin())
        if change[k] <= 2 * self.counts[c - size] + 1:
            stack = self.open[size + k]
            at = stack.pop()
            self.counts[size + k] -= 1
        else:
            at, k = self.new_bin(), c - size
        if k:
            self.counts[k] += 1
            self.open.setdefault(k, []).append(at)
        return at


def pack_stream(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Bins for rows ordered by (window_id, shard, rest descending): window_id, capacity, shard, item, size."""
    current, packer = None, None
    for batch in batches:
        window, capacity, shard, size = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
        rows: list[tuple] = []
        take: list[int] = []
        for i, n in enumerate(size):
            if (window[i], shard[i]) != current:
                current, packer = (window[i], shard[i]), SumOfSquares(capacity[i])
            base, part, at = shard[i] << 32, 0, 0
            while n - at >= packer.capacity:  # whole bins of an item that is as long as one or longer
                rows.append((window[i], base + packer.new_bin(), part, at, packer.capacity))
                take.append(i)
                part, at = part + 1, at + packer.capacity
            if at < n:
                rows.append((window[i], base + packer.place(n - at), part, at, n - at))
                take.append(i)
            elif n == 0:  # takes no room: the first bin holds it
                packer.bins = max(packer.bins, 1)
                rows.append((window[i], base, 0, 0, 0))
                take.append(i)
        columns = list(zip(*rows)) or [[]] * 5
        arrays = [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), batch.column(3).take(pa.array(take, pa.int64()))]
        arrays += [pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def pack(sizes: DataFrame, item: str, size: str, windows: list[tuple[int, int]], items: int, per_shard: int = 20_000) -> DataFrame:
    """(window_id, bin_id, <item>, part, first_token, n_tokens): where each part of each item lies, per window size.

    ``windows`` is the short list of (window_id, capacity); ``items`` the number of rows of ``sizes``, which only sets
    the number of shards. Each item is whole in one bin unless it is longer than the capacity; then it fills whole
    bins and its rest is one more part. Null sizes count as 0; items of size 0 lie in a first bin with no tokens.
    Repeated items are placed each; an empty frame gives no bins. Bins depend only on the rows, not on partitions.
    """
    if any(c is None or c < 1 for _, c in windows):
        raise ValueError("capacities must be positive")
    shards = max(1, -(-items // per_shard))
    kind = sizes.schema[item].dataType.simpleString()
    n = F.coalesce(F.col(size).cast("bigint"), F.lit(0))
    offers = F.array(*(F.struct(F.lit(w).cast("int").alias("window_id"), F.lit(c).cast("int").alias("capacity")) for w, c in windows))
    rows = sizes.select(F.col(item).alias("item"), n.alias("size"), F.pmod(F.xxhash64(item), F.lit(shards)).cast("bigint").alias("shard"), F.explode(offers).alias("w"))
    flat = rows.select("w.window_id", "w.capacity", "shard", "item", "size")
    # a number of its own: partitions are few bytes but much work, so they must not be coalesced by size
    ordered = flat.repartition(min(2 * shards * max(1, len(windows)), 20_000), "window_id", "shard").sortWithinPartitions("window_id", "shard", F.desc(F.col("size") % F.col("capacity")), "item", "size")
    ddl = _OUT.format(kind=kind)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(ddl))
    return ordered.mapInArrow(lambda it: pack_stream(it, schema), ddl).withColumnRenamed("item", item)


def fill(bins: DataFrame, windows: list[tuple[int, int]]) -> DataFrame:
    """(window_id, bins, n_tokens, fill): how many bins each window size took, and the share of their room that is used."""
    capacity = F.element_at(F.create_map(*(F.lit(x) for w in windows for x in w)), F.col("window_id"))
    per_bin = bins.groupBy("window_id", "bin_id").agg(F.sum("n_tokens").alias("used"))
    total = per_bin.groupBy("window_id").agg(F.count(F.lit(1)).alias("bins"), F.sum("used").alias("n_tokens"))
    return total.select("window_id", "bins", "n_tokens", (F.col("n_tokens") / (F.col("bins") * capacity)).alias("fill"))
