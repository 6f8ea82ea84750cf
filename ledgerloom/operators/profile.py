"""Column-level data quality profile of loads.

Method: the footers of the columnar files give exact null counts and constants of each chunk, dictionary pages give
its distinct values; a chunk whose statistics are sufficient for what is asked of a column is not scanned for it. The
rest is scanned (pruned to the columns) and combined into one histogram per (load, column), from which everything else
is derived.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.session import bounded_broadcast, cut_lineage
from ledgerloom.sources.parquet_stats import chunks

VALIDITY, HISTOGRAM = "validity", "histogram"
_CHUNK = "file string, first_row bigint, rows bigint, column string, load string, value string, n bigint, scan boolean"


def _examine(uris: Iterator[pd.DataFrame], load: str, needs: dict[str, str], valid: dict[str, str]) -> Iterator[pd.DataFrame]:
    names = list(needs)
    for part in uris:
        rows = []
        for uri in part["file"]:
            for c in chunks(uri, [load, *names], names):
                one = c.constant[load]
                for name in names:
                    values, nulls = c.values[name], c.nulls[name]
                    enough = one is not None and values is not None and nulls is not None
                    if enough and needs[name] == HISTOGRAM:
                        enough = len(values) + (nulls > 0) <= 1
                    elif enough and len(values) > 1:
                        enough = all(re.fullmatch(valid[name], v.strip(" ")) for v in values)
                    base = (uri, c.first_row, c.rows, name)
                    if not enough:
                        rows.append((*base, None, None, 0, True))
                        continue
                    if nulls:
                        rows.append((*base, one, None, nulls, False))
                    if c.rows > nulls:  # all present values are alike for what is asked; any of them stands for all
                        rows.append((*base, one, values[0], c.rows - nulls, False))
        yield pd.DataFrame(rows, columns=["file", "first_row", "rows", "column", "load", "value", "n", "scan"])


def _one_slash(uri: Column) -> Column:
    """Listings and row metadata spell the root of a file URI differently (file:///a and file:/a)."""
    return F.regexp_replace(uri, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def chunk_statistics(spark: SparkSession, paths: list[str], load: str, needs: dict[str, str], valid: dict[str, str]) -> DataFrame:
    """Per chunk and column either its contribution to the histogram or the mark that it must be scanned."""
    files = spark.createDataFrame([(p,) for p in paths], "file string")
    tasks = min(len(paths), max(1, 2 * spark.sparkContext.defaultParallelism), 10_000) or 1
    return files.repartition(tasks).mapInPandas(lambda it: _examine(it, load, needs, valid), _CHUNK)


def _open_rows(df: DataFrame, marks: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, bool]] | None:
    """The rows to scan and the columns open in them, with whether a column is so in each chunk; None if there are none.

    ``marks`` says per chunk and column whether it must be scanned. Of the columns that are open in some chunks only,
    ``_here`` names in each row those that are open in its chunk.
    """
    totals = marks.groupBy("column").agg(F.count(F.lit(1)).alias("chunks"), F.count_if("scan").alias("open")).collect()  # one row per column
    parts = {r["column"]: r["open"] == r["chunks"] for r in totals if r["open"]}  # column -> whether each chunk is open
    if not parts:
        return None
    source = df
    if not all(parts.values()):
        todo = (
            marks.groupBy(_one_slash(F.col("file")).alias("_file"), "first_row", "rows").agg(F.collect_set(F.when(F.col("scan"), F.col("column"))).alias("_open"))
            .groupBy("_file").agg(F.collect_list(F.struct("first_row", "rows", "_open")).alias("_chunks"))  # chunks of one file
        )
        source = df.select(*columns, _one_slash(F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.row_index").alias("_row")).join(bounded_broadcast(todo), "_file", "left")

        # the open columns of the row's chunk, looked up once a row
        inside = lambda k: (F.col("_row") >= k["first_row"]) & (F.col("_row") < k["first_row"] + k["rows"])
        unknown = F.raise_error(F.concat(F.lit("no statistics of file "), F.col("_file"))).cast("array<string>")
        source = source.withColumn("_here", F.when(F.col("_chunks").isNull(), unknown).otherwise(F.get(F.filter("_chunks", inside), F.lit(0))["_open"]))
    return source, parts


def _open_entries(df: DataFrame, marks: DataFrame, load: str, needs: list[str]) -> DataFrame | None:
    """(load, column, value) of the rows in chunks whose statistics are insufficient; None if there are none."""
    if (found := _open_rows(df, marks, list(dict.fromkeys([load, *needs])))) is None:
        return None
    source, parts = found
    entries = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), (F.lit(True) if every else F.array_contains("_here", c)).alias("open")) for c, every in parts.items()))
    return source.select(F.col(load).alias("load"), F.explode(entries).alias("e")).filter("e.open").select("load", "e.column", "e.value")


def _count_batches(batches: Iterator[pa.RecordBatch], columns: list[str], always: list[str]) -> Iterator[pa.RecordBatch]:
    """(load, column, value, n) of batches (load, columns..., open): equal values of a batch are counted together."""
    kinds = pa.schema({"load": pa.string(), "column": pa.string(), "value": pa.string(), "n": pa.int64()})
    for batch in batches:
        table = pa.table(batch.columns, ["load", *(f"v{i}" for i in range(len(columns))), "open"])
        parts = []
        opens = table["open"].unique()
        for chosen in opens:  # alike in all rows of a chunk
            mine = table if len(opens) == 1 else table.filter(pc.equal(table["open"], chosen))
            here = {*always, *(columns[int(k)] for k in chosen.as_py().split(",") if k)}
            for i, name in enumerate(columns):
                if name in here:
                    counted = mine.group_by(["load", f"v{i}"], use_threads=False).aggregate([([], "count_all")])
                    parts.append(pa.table([counted["load"], pa.repeat(name, len(counted)), counted[f"v{i}"], counted["count_all"]], ["load", "column", "value", "n"]).cast(kinds))
        yield from pa.concat_tables(parts).combine_chunks().to_batches() if parts else []


def _open_counts(df: DataFrame, marks: DataFrame, load: str, columns: dict[str, Column]) -> DataFrame | None:
    """(load, column, value, n) of the rows in chunks whose statistics are insufficient; None if there are none.

    ``columns`` gives per column its text. Values are counted within a batch, which spares most of the rows that an
    entry per row and column would make; a value comes out once per batch that holds it.
    """
    if (found := _open_rows(df, marks, [load, *columns])) is None:
        return None
    source, parts = found
    names, always = list(parts), [c for c, every in parts.items() if every]
    partial = [F.when(F.array_contains("_here", c), F.lit(str(i))) for i, c in enumerate(names) if c not in always]
    chosen = F.concat_ws(",", *partial) if partial else F.lit("")
    wide = source.select(F.col(load).cast("string").alias("load"), *(columns[c].alias(f"v{i}") for i, c in enumerate(names)), chosen.alias("open"))
    return wide.mapInArrow(lambda it: _count_batches(it, names, always), "load string, column string, value string, n bigint")


def load_histogram(spark: SparkSession, path: str, load: str, needs: dict[str, str], valid: dict[str, str]) -> DataFrame:
    """(column, load, value, n) over all rows of the parquet table at ``path``; null values are counted too.

    ``needs`` says for each string column whether a full histogram is asked for or only validity (how many values are
    blank, valid under the pattern ``valid[column]``, or invalid); for the latter, valid values of a chunk may be
    counted under one of them. Rows without a load are left out. An empty table gives an empty histogram.
    """
    df = spark.read.parquet(path)
    stats = cut_lineage(chunk_statistics(spark, df.inputFiles(), load, needs, valid))
    known = stats.filter("NOT scan").select("column", "load", "value", "n")
    opened = _open_entries(df, stats.select("file", "first_row", "rows", "column", "scan").distinct(), load, list(needs))
    rows = known if opened is None else known.unionByName(opened.select("column", "load", "value", F.lit(1).cast("bigint").alias("n")))
    return rows.filter(F.col("load").isNotNull()).groupBy("column", "load", "value").agg(F.sum("n").alias("n"))


#: Buckets of hashed values by which the distributions of two loads are compared.
BUCKETS = 64
_RANGES = "file string, first_row bigint, rows bigint, column string, load string, scan boolean, value string, n bigint"


def _ranges(uris: Iterator[pd.DataFrame], load: str, texts: list[str], others: list[str], unread: list[str], typed: bool) -> Iterator[pd.DataFrame]:
    """What the footers tell of each chunk: nulls and extrema of typed columns (with ``typed`` only of constant ones, as the
    values between count too), all-null or constant text columns, and nothing of the ``unread`` ones."""
    for part in uris:
        rows = []
        for uri in part["file"]:
            for c in chunks(uri, [load, *texts], [], others):
                one = c.constant[load]
                rows += [(uri, c.first_row, c.rows, name, None, True, None, 0) for name in unread]
                for name in (*texts, *others):
                    base = (uri, c.first_row, c.rows, name)
                    nulls = c.nulls[name]
                    if name in others:
                        bounds = c.bounds[name]
                        if one is None or nulls is None or (nulls < c.rows and (bounds is None or (typed and bounds[0] != bounds[1]))):
                            rows.append((*base, None, True, None, 0))
                            continue
                        present = c.rows - nulls
                        ends = [] if not present else [(bounds[0], present - (present > 1))] + [(bounds[1], 1)] * (present > 1)
                    elif one is None or nulls is None or (c.constant[name] is None and nulls < c.rows):
                        rows.append((*base, None, True, None, 0))
                        continue
                    else:
                        ends = [(c.constant[name], c.rows - nulls)] if nulls < c.rows else []
                    rows += [(*base, one, False, v, n) for v, n in [*ends, *([(None, nulls)] if nulls else [])]]
        yield pd.DataFrame(rows, columns=["file", "first_row", "rows", "column", "load", "scan", "value", "n"])


def _spelled(df: DataFrame, name: str, kind: str) -> Column:
    """A column's values as text: hexadecimal digits of bytes, JSON of nested values."""
    if kind == "binary":
        return F.hex(name)
    if kind.startswith(("array", "struct", "map", "variant")):
        return F.to_json(name, {"ignoreNullFields": "false"})
    return F.col(name) if kind == "string" else F.col(name).cast("string")


def table_profile(spark: SparkSession, path: str, load: str, order: str, patterns: dict[str, str], typed: bool = False) -> DataFrame:
    """One row per column and load of the parquet table at ``path``, beside the preceding load by ``order`` (a text column).

    (column_name, batch_id, rows, nulls, blanks, distinct_values, least, greatest, least_number, greatest_number,
    violations, null_rate, null_rate_change, distinct_ratio, shift). Text columns: blanks, an approximate number of
    distinct values (about 1 %), extrema as text and of what reads as a number, values that violate ``patterns[column]`` (null
    without one) and ``shift``, half the sum of absolute differences of the shares of hashed values to the preceding
    load. Typed columns: nulls and extrema (as text by the order of their type), which the footers have where a chunk
    holds one load, and with ``typed`` also distinct values and shifts as of texts, for which only constant chunks are
    spared the scan; without it these are null. Columns of any other type are text columns of their values' spelling
    (``_spelled``). Chunks whose footers suffice are not scanned; the rest is one pruned scan with one aggregation. The
    load itself is no column of the profile but its batch_id. Rows without a load form a load of their own; an empty
    table gives no rows.
    """
    df = spark.read.parquet(path)
    kinds = dict(df.dtypes)
    texts = [c for c, k in kinds.items() if k == "string" and c != load]
    others = [c for c, k in kinds.items() if k in ("tinyint", "smallint", "int", "bigint", "double", "float", "date", "timestamp", "timestamp_ntz", "boolean") or k.startswith("decimal")]
    others = [c for c in others if c != load]
    unread = [c for c in kinds if c not in (load, *texts, *others)]  # of other types; their footers are not read
    spelled = {c: _spelled(df, c, kinds[c]) for c in (*texts, *others, *unread)}
    paths = df.inputFiles()
    tasks = min(len(paths), max(1, 2 * spark.sparkContext.defaultParallelism), 10_000) or 1
    files = spark.createDataFrame([(p,) for p in paths], "file string").repartition(tasks)
    stats = cut_lineage(files.mapInPandas(lambda it: _ranges(it, load, texts, others, unread, typed), _RANGES))
    opened = _open_counts(df, stats.select("file", "first_row", "rows", "column", "scan").distinct(), load, spelled)
    rows = stats.filter("NOT scan").select("load", "column", "value", "n")
    rows = rows if opened is None else rows.unionByName(opened)
    v, n = F.col("value"), F.col("n")
    among = lambda names: F.col("column").isin(*names) if names else F.lit(False)
    is_text = among([*texts, *unread])
    is_counted = is_text | among(others if typed else [])
    is_float = among([c for c in others if kinds[c] in ("double", "float")])
    t = F.trim(v)
    blank = is_text & (v.isNotNull() & (t == ""))
    first = F.ascii(t)  # spares most texts the pattern, and numbers the cast that would only fail
    number = F.when(((first >= 43) & (first <= 57) & t.rlike(r"^[-+]?[0-9.][-+.0-9eE]*\z")) | is_float, t.try_cast("double"))
    wrong = F.coalesce(*(F.when(F.col("column") == c, ~t.rlike(rf"^(?:{p})\z")) for c, p in patterns.items()), F.lit(None).cast("boolean"))
    bucket = F.when(is_counted & v.isNotNull(), F.pmod(F.xxhash64(v), F.lit(BUCKETS)).cast("int")).otherwise(-1)
    # what is asked of a value, computed once in generated code; the aggregation with sketches is not generated
    facts = rows.select(
        F.col("column").alias("column_name"), F.col("load").alias("batch_id"), bucket.alias("bucket"), "n", F.when(v.isNull(), n).otherwise(0).alias("null_n"), F.when(blank, n).otherwise(0).alias("blank_n"),
        F.when(is_counted, v).alias("text"), number.alias("number"), F.when(v.isNotNull() & ~blank & wrong, n).when(v.isNotNull() & ~blank & ~wrong, 0).alias("wrong_n"), is_counted.cast("int").alias("counted_n"),
    )
    # a bucket holds its values alone, so the distinct values of the buckets add up, and small sketches are exact enough
    buckets = facts.groupBy("column_name", "batch_id", "bucket").agg(
        F.sum("n").alias("rows"), F.sum("null_n").alias("nulls"), F.sum("blank_n").alias("blanks"), F.approx_count_distinct("text").alias("_distinct"), F.min("number").alias("least_number"),
        F.max("number").alias("greatest_number"), F.sum("wrong_n").alias("violations"), F.max("counted_n").alias("_counted"),
    )
    measured = buckets.groupBy("column_name", "batch_id").agg(
        *(F.sum(c).alias(c) for c in ("rows", "nulls", "blanks", "_distinct", "violations")), F.min("least_number").alias("least_number"),
        *(F.max(c).alias(c) for c in ("greatest_number", "_counted")), F.map_from_entries(F.collect_list(F.when(F.col("bucket") >= 0, F.struct("bucket", "rows")))).alias("_buckets"),
    )
    # Extrema of texts would make the aggregation above sort its rows; here they take one row per load from each task. The
    # empty list makes Spark aggregate them in a map of objects; without it the wide rows would be sorted by load.
    ordered = list(spelled)
    real = lambda c: F.col(c) if c in others else F.when(F.trim(spelled[c]) != "", spelled[c])
    wide = df.groupBy(F.col(load).alias("batch_id")).agg(*(f(real(c)).cast("string").alias(f"{n}_{i}") for i, c in enumerate(ordered) for n, f in (("least", F.min), ("greatest", F.max))), F.collect_list(F.lit(None).cast("int")).alias("_none"))
    ends = [F.struct(F.lit(c).alias("column_name"), F.col(f"least_{i}").alias("least"), F.col(f"greatest_{i}").alias("greatest")) for i, c in enumerate(ordered)]
    extrema = wide.select("batch_id", F.explode(F.array(*ends)).alias("e")).select(F.col("batch_id").alias("_b"), F.col("e.column_name").alias("_c"), "e.least", "e.greatest")
    measured = measured.join(extrema, (F.col("column_name") == F.col("_c")) & F.col("batch_id").eqNullSafe(F.col("_b")), "left").drop("_b", "_c")
    measured = cut_lineage(measured)  # one row per column and load
    released = measured.filter(F.col("column_name") == order).select("batch_id", F.col("least").alias("_released"))
    w = Window.partitionBy("column_name").orderBy(F.col("_released").asc_nulls_first(), "batch_id")
    known = measured.join(released, measured["batch_id"].eqNullSafe(released["batch_id"]), "left").select(measured["*"], "_released")
    before = {c: F.lag(c).over(w) for c in ("rows", "nulls", "_distinct", "_buckets")}
    rated = known.select("*", *(x.alias(f"_before_{c}") for c, x in before.items()))
    present, present_before = F.col("rows") - F.col("nulls"), F.col("_before_rows") - F.col("_before_nulls")
    rate = share(F.col("nulls"), F.col("rows"))
    part = lambda m, k, whole: F.coalesce(F.element_at(m, k), F.lit(0)) / whole
    apart = F.aggregate(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), F.lit(0.0), lambda acc, k: acc + F.abs(part(F.col("_buckets"), k, present) - part(F.col("_before__buckets"), k, present_before))) / 2
    only_counted = lambda c: F.when(F.col("_counted") == 1, c)
    return rated.select(
        "column_name", "batch_id", "rows", "nulls", "blanks", only_counted(F.col("_distinct")).alias("distinct_values"), "least", "greatest", "least_number", "greatest_number", "violations",
        rate.alias("null_rate"), (rate - share(F.col("_before_nulls"), F.col("_before_rows"))).alias("null_rate_change"), only_counted(share(F.col("_distinct"), F.col("_before__distinct"))).alias("distinct_ratio"),
        only_counted(F.when((present > 0) & (present_before > 0), apart)).alias("shift"),
    )


def grouped_median(hist: DataFrame, by: list[str], value: str, n: str, small: int = 100_000) -> DataFrame:
    """Exact median per group of weighted bigint values: (by..., median double), the mean of the two middle ones.

    Where no group has more than ``small`` different values, the exact percentile of each is built from them in one
    aggregation. Beyond, radix selection in three steps of 16 bits (values below 2**47): each step sums the weights per bucket and keeps the
    bucket that holds the wanted rank, so that no task sees more than 65,536 buckets of a group, however large it is.
    """
    live = cut_lineage(hist.groupBy(*by, F.col(value).alias("_v")).agg(F.sum(n).alias("_n")))
    if (live.groupBy(*by).agg(F.count(F.lit(1)).alias("k")).agg(F.max("k").alias("k")).first()["k"] or 0) <= small:
        return live.groupBy(*by).agg(F.percentile("_v", 0.5, F.col("_n")).alias("median"))
    size = live.groupBy(*by).agg(F.sum("_n").alias("_t"))
    ranks = F.array(F.struct(F.lit(0).alias("id"), F.floor((F.col("_t") + 1) / 2).alias("rank")), F.struct(F.lit(1).alias("id"), (F.floor(F.col("_t") / 2) + 1).alias("rank")))
    wanted = size.select(*by, F.explode(ranks).alias("_r")).select(*by, F.col("_r.id").alias("_id"), F.col("_r.rank").alias("_rank"))
    keys = list(by)
    for shift in (32, 16, 0):
        bucket = f"_b{shift}"
        live = live.withColumn(bucket, F.shiftright("_v", shift))
        w = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
        sums = live.groupBy(*keys, bucket).agg(F.sum("_n").alias("_n")).withColumn("_c", F.sum("_n").over(w))
        picked = wanted.join(sums, keys).filter((F.col("_rank") <= F.col("_c")) & (F.col("_rank") > F.col("_c") - F.col("_n")))
        wanted = picked.select(*keys, bucket, "_id", (F.col("_rank") - F.col("_c") + F.col("_n")).alias("_rank"))
        live = live.join(wanted.select(*keys, bucket).distinct(), [*keys, bucket], "left_semi")
        keys.append(bucket)
    return wanted.groupBy(*by).agg(F.avg(F.col("_b0").cast("double")).alias("median"))


def share(part: Column, whole: Column) -> Column:
    """part / whole, null where the whole is zero."""
    return F.when(whole > 0, part / whole)
