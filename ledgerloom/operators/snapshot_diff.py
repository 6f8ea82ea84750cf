"""What changed between consecutive full snapshots.

Method: each key's rows are windowed by snapshot index; the lagged row hash reveals changes, and gaps of the index
reveal removals and later additions. One shuffle by key serves all snapshots at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(field: T.StructField, decimals: int = 6) -> Column:
    """Text of a value such that equal texts mean equal values; doubles agree when equal to ``decimals`` places."""
    c = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        rounded = F.round(c.cast("double"), decimals)
        return F.coalesce(rounded.try_cast(f"decimal({20 + decimals},{decimals})").cast("string"), c.cast("string"))
    return c.cast("string")


def content_hash(columns: list[Column]) -> Column:
    """128-bit digest over ordered values; null is a value of its own and positions do not run together."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("~")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("|", *parts)))


def snapshot_changes(rows: DataFrame, key: str, idx: str, hash_col: str, as_of: str, next_as_of: str) -> DataFrame:
    """(key, as_of_date, change_type) for each pair of consecutive snapshots.

    ``rows`` has one row per key and snapshot index (0-based, without holes); ``next_as_of`` is the date of the next
    snapshot, null at the last. Null keys are left out. Rows of one key are at most one per snapshot, so the window
    holds a bounded group. Extra columns are ignored; an empty frame gives no changes.
    """
    w = Window.partitionBy("k").orderBy("i")
    seen = rows.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("k"), F.col(idx).alias("i"), F.col(hash_col).alias("h"), F.col(as_of).alias("d"), F.col(next_as_of).alias("nd")
    )
    ordered = seen.select("k", "i", "h", "d", "nd", F.lag("i").over(w).alias("pi"), F.lag("h").over(w).alias("ph"), F.lead("i").over(w).alias("ni"))
    follows = F.col("pi") == F.col("i") - 1
    came = (
        F.when((F.col("i") > 0) & ~F.coalesce(follows, F.lit(False)), F.lit("ADDED"))
        .when(follows & ~F.col("h").eqNullSafe(F.col("ph")), F.lit("CHANGED"))
    )
    gone = F.when(F.col("nd").isNotNull() & ~F.coalesce(F.col("ni") == F.col("i") + 1, F.lit(False)), F.lit("REMOVED"))
    events = F.array(F.struct(F.col("d").alias("as_of_date"), came.alias("change_type")), F.struct(F.col("nd").alias("as_of_date"), gone.alias("change_type")))
    return (
        ordered.select(F.col("k").alias("key"), F.explode(F.filter(events, lambda e: e["change_type"].isNotNull())).alias("e"))
        .select("key", "e.as_of_date", "e.change_type")
    )
