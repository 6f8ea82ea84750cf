"""Landed files: csv and JSON page readers with explicit schemas, integrity checks and the batch loader."""

from __future__ import annotations

import csv
import datetime as dt
import hashlib
import io
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.headers import Assessment, assess_header, assess_keys
from ledgerloom.sources.storage import open_uri
from ledgerloom.spec import BRONZE_METADATA, HEADER_OVERRIDES, DatasetSpec

CORRUPT = "_corrupt_record"
#: The Bronze quarantine.
QUARANTINE = T.StructType(
    [*(T.StructField(n, T.StringType()) for n in ("dataset", "dataset_id", "source_file", "source_file_sha256", "batch_id", "load_type", "raw_record", "corrupt_record"))]
    + [T.StructField("failed_rules", T.ArrayType(T.StringType())), T.StructField("load_timestamp", T.TimestampType())]
)


class IntegrityError(ValueError):
    pass


class EnvelopeError(ValueError):
    pass


class BreakingDrift(ValueError):
    def __init__(self, assessment: Assessment):
        super().__init__(str(assessment.records()))
        self.assessment = assessment


def text_schema(columns: list[str] | tuple[str, ...], corrupt: bool = False) -> T.StructType:
    """All columns nullable text; nothing is ever inferred."""
    names = [*columns, CORRUPT] if corrupt else columns
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def envelope_schema(columns: list[str] | tuple[str, ...]) -> T.StructType:
    meta = T.StructType(
        [T.StructField(n, t) for n, t in (("dataset_id", T.StringType()), ("filter", T.StringType()), ("rows_available", T.LongType()), ("rows_in_file", T.LongType()), ("fetched_at_utc", T.StringType()), ("load_type", T.StringType()))]
    )
    return T.StructType([T.StructField("_meta", meta), T.StructField("results", T.ArrayType(text_schema(columns)))])


def file_digest(path: str) -> tuple[str, int]:
    digest, size = hashlib.sha256(), 0
    with open_uri(path) as f:
        while block := f.read(1 << 20):
            digest.update(block)
            size += len(block)
    return digest.hexdigest(), size


def verify_file(path: str, size: int, sha256: str) -> None:
    """Existence, then size, then digest; the file is read in blocks, from any file system."""
    try:
        with open_uri(path) as f:
            found = f.size()
    except FileNotFoundError:
        raise IntegrityError(f"{path} does not exist") from None
    if found != size:
        raise IntegrityError(f"{path} has another size than the manifest says")
    if file_digest(path)[0] != sha256.lower():
        raise IntegrityError(f"{path} has another digest than the manifest says")


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the files below a folder; only listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "length")


def verify_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """The same for many files, distributed: (path, problem), problem null for sound files. Files are read in blocks."""
    want = manifest.select(F.col("landing_path").alias("path"), "source_bytes", F.lower("source_file_sha256").alias("want"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([file_digest(p)[0] for p in batch.column(0).to_pylist()], pa.string())], names=["path", "length", "digest"])

    there = landed_files(spark, folder).join(want.select("path").distinct(), "path", "left_semi")
    seen = there.repartition(max(1, spark.sparkContext.defaultParallelism)).mapInArrow(digests, "path string, length bigint, digest string")
    joined = want.join(seen, "path", "left")
    problem = F.when(F.col("length").isNull(), "missing").when(F.col("length") != F.col("source_bytes"), "size").when(F.col("digest") != F.col("want"), "digest")
    return joined.select("path", problem.alias("problem"))


def csv_header(path: str) -> list[str]:
    with open_uri(path) as raw, io.TextIOWrapper(io.BufferedReader(raw), encoding="utf-8-sig", newline="") as f:
        row = next(csv.reader(f), None)
    if not row:
        raise ValueError(f"{path} is empty")
    return row


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-text rows bound to ``columns`` by position, with the raw text of rows of another width or quoting."""
    reader = spark.read.schema(text_schema(columns, corrupt=True)).options(header=True, mode="PERMISSIVE", multiLine=True, quote='"', escape='"', enforceSchema=True, columnNameOfCorruptRecord=CORRUPT)
    return reader.csv(path)


def read_page(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The records of one JSON page, all text."""
    pages = spark.read.schema(envelope_schema(columns)).option("multiLine", True).json(path)
    return pages.select(F.explode("results").alias("r")).select("r.*")


def page_facts(path: str) -> tuple[dict, list[str], int]:
    """(_meta, keys of all records in order of first sight, number of records); anything but an envelope raises."""
    with open_uri(path) as f:
        page = json.loads(f.read())
    if not isinstance(page, dict) or not isinstance(page.get("_meta"), dict) or not isinstance(page.get("results"), list) or not all(isinstance(r, dict) for r in page["results"]):
        raise EnvelopeError(f"{path} is no page of records")
    return page["_meta"], list(dict.fromkeys(k for r in page["results"] for k in r)), len(page["results"])


def check_page(meta: dict, rows: int, spec: DatasetSpec, load_type: str, expected_rows: int | None, start: str | None = None, end: str | None = None) -> None:
    """The page must be the one its manifest row describes; the filter is the exact text of the row's window."""
    if not (spec.watermark and start and end):
        raise EnvelopeError("a page needs a watermark column and a date window")
    tests = [
        (meta.get("dataset_id") == spec.dataset_id, "dataset_id"),
        (meta.get("load_type") == load_type, "load_type"),
        (meta.get("filter") == f"{spec.watermark} >= {start} AND {spec.watermark} <= {end}", "filter"),
        (meta.get("rows_in_file") == rows, "rows_in_file"),
        (expected_rows is None or meta.get("rows_available") in (None, expected_rows), "rows_available"),
        (meta.get("rows_available") is None or rows <= meta["rows_available"], "more rows than available"),
    ]
    if bad := [name for ok, name in tests if not ok]:
        raise EnvelopeError(f"page does not match its manifest: {', '.join(bad)}")


@dataclass(frozen=True)
class Landed:
    """One file of the manifest."""

    path: str
    batch_id: str
    load_type: str
    ingest_date: str
    sha256: str
    size: int
    expected_rows: int | None = None
    window_start: str | None = None
    window_end: str | None = None


@dataclass(frozen=True)
class Loaded:
    """Rows of one file. The parsed frame is kept until ``release``, so that counts and both writes come from one parse."""

    good: DataFrame
    corrupt: DataFrame
    drift: Assessment
    parsed: DataFrame

    def counts(self) -> tuple[int, int]:
        """(rows read, corrupt rows)."""
        seen = self.parsed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(CORRUPT).isNotNull()).alias("bad")).first()
        return seen["n"], seen["bad"]

    def release(self) -> None:
        self.parsed.unpersist()


def bronze_schema(spec: DatasetSpec) -> T.StructType:
    """All source columns as text, then the metadata."""
    kinds = {"_ingest_date": T.DateType(), "load_timestamp": T.TimestampType()}
    return T.StructType([*text_schema(spec.rules.source).fields, *(T.StructField(c, kinds.get(c, T.StringType()), False) for c in BRONZE_METADATA)])


def quarantined(bad: DataFrame, columns: list[str], dataset: Column, dataset_id: Column, source_file: Column, sha256: Column, batch_id: Column, load_type: Column) -> DataFrame:
    """Rows with a corrupt record as rows of the Bronze quarantine."""
    return bad.select(
        dataset.alias("dataset"), dataset_id.alias("dataset_id"), source_file.alias("source_file"), sha256.alias("source_file_sha256"), batch_id.alias("batch_id"),
        load_type.alias("load_type"), F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("raw_record"),
        F.col(CORRUPT).alias("corrupt_record"), F.array(F.lit("CORRUPT_RECORD")).alias("failed_rules"), F.current_timestamp().alias("load_timestamp"),
    )


def load_file(spark: SparkSession, item: Landed, spec: DatasetSpec) -> Loaded:
    """Integrity, drift, then the rows of one file as Bronze rows and as quarantine rows.

    Added fields are kept as text; missing, unusable or repeated ones raise ``BreakingDrift`` after they were assessed. A
    JSON page must be the one of the item's window, and Spark must parse as many records as it has; a page without
    records is valid. The caller releases the result.
    """
    verify_file(item.path, item.size, item.sha256)
    is_csv, rows = item.path.lower().endswith(".csv"), None
    if is_csv:
        drift = assess_header(csv_header(item.path), spec.rules.source, HEADER_OVERRIDES.get(spec.name))
    else:
        meta, keys, rows = page_facts(item.path)
        check_page(meta, rows, spec, item.load_type, item.expected_rows, item.window_start, item.window_end)
        drift = assess_keys(keys or spec.rules.source, spec.rules.source)
    if drift.breaking:
        raise BreakingDrift(drift)
    stamp = {
        "_dataset_id": F.lit(spec.dataset_id), "_source_file": F.lit(item.path), "_source_file_sha256": F.lit(item.sha256), "_batch_id": F.lit(item.batch_id),
        "_load_type": F.lit(item.load_type), "_ingest_date": F.lit(item.ingest_date).cast("date"), "load_timestamp": F.lit(dt.datetime.now(dt.timezone.utc)),
    }
    parsed = read_csv(spark, item.path, drift.columns) if is_csv else read_page(spark, item.path, drift.columns).withColumn(CORRUPT, F.lit(None).cast("string"))
    parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    lineage = (F.lit(x) for x in (spec.name, spec.dataset_id, item.path, item.sha256, item.batch_id, item.load_type))
    good = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT).withColumns(stamp)
    done = Loaded(good, quarantined(parsed.filter(F.col(CORRUPT).isNotNull()), drift.columns, *lineage), drift, parsed)
    if rows is not None and done.counts()[0] != rows:
        done.release()
        raise EnvelopeError(f"{item.path}: not all records of the page can be parsed")
    return done


def split_by_cutoff(df: DataFrame, folder: str, date: str, cutoff: str, bytes_per_file: int) -> None:
    """Csv parts of at most ``bytes_per_file`` bytes (one row at least) with repeated header: rows before the cut-off, and
    those without a readable date, are kept."""
    from ledgerloom.functions.values import flexible_date

    day = flexible_date(date)
    kept = df.filter(day.isNull() | (day < F.lit(cutoff).cast("date")))
    quoted = sum((F.octet_length(F.coalesce(F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit(""))) + 3 for c in df.columns), F.lit(1))
    longest = kept.agg(F.coalesce(F.max(quoted), F.lit(1)).alias("n")).first()["n"]  # so many bytes a row may take, quotes, commas and line break included
    head = sum(len(c.encode()) + 3 for c in df.columns) + 1
    rows = max(1, (bytes_per_file - head) // longest)
    kept.write.mode("overwrite").options(header=True, quote='"', escape='"', maxRecordsPerFile=rows).csv(folder)
