"""Bronze rows to typed, keyed, validated and classified Silver rows; the input is evaluated once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.keys import entity_key, json_digest, salted_digest, severity_group
from ledgerloom.functions.rules import judge
from ledgerloom.session import cut_lineage, spread
from ledgerloom.spec import BRONZE_METADATA, LINEAGE, DatasetSpec

INVALID, CONFLICT, DUPLICATE, ACCEPTED = "INVALID", "CONFLICT", "DUPLICATE", "ACCEPTED"
CONFLICT_RULE = "CONFLICTING_BUSINESS_KEY"
PRIVATE = ("telephone_number", "provider_address", "location")


def classify(df: DataFrame, key: str, digest: str, failed: str, order: list[Column]) -> DataFrame:
    """``df`` with ``status``: INVALID (rules failed or no key), CONFLICT (its key has several digests among the valid
    rows; all of them), DUPLICATE (not the least of equal key and digest by ``order``) or ACCEPTED.

    The input is written once; everything else reads that. Rows are reduced to one per (key, digest) before they are
    shuffled, and only the reduced rows of keys and digests that occur again are joined back: few in most data, so the
    rows themselves stay where they are, and a key with a third of all rows is one reduced row per task. Of rows equal in
    ``order`` too, any one is the first. Null keys are INVALID; a null digest is a value. Extra columns pass through, a
    column named ``status`` is replaced; an empty frame gives an empty one.
    """
    names = [c for c in df.columns if c != "status"]
    rows = cut_lineage(df.select(*names, F.monotonically_increasing_id().alias("_row"), F.coalesce((F.size(failed) == 0) & F.col(key).isNotNull(), F.lit(False)).alias("_valid"), F.coalesce(F.col(digest).cast("string"), F.lit("")).alias("_digest"), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order))).alias("_order")))
    good = rows.filter("_valid")
    groups = good.groupBy(F.col(key).alias("_key"), "_digest").agg(F.count(F.lit(1)).alias("_n"))
    contested = groups.groupBy("_key").agg(F.count(F.lit(1)).alias("_digests")).filter("_digests > 1").select("_key", F.lit(True).alias("_contested"))
    crowded = cut_lineage(groups.join(contested, "_key", "left").filter("_n > 1 OR _contested").select("_key", "_digest", "_contested", F.lit(True).alias("_valid")))
    equal = good.select(F.col(key).alias("_key"), "_digest", F.struct("_order", "_row").alias("_place")).join(crowded.filter("_contested IS NULL").select("_key", "_digest"), ["_key", "_digest"])
    firsts = equal.groupBy("_key", "_digest").agg(F.min("_place")["_row"].alias("_first"))
    again = crowded.join(firsts, ["_key", "_digest"], "left")
    status = (
        F.when(~F.col("_valid"), INVALID).when(F.col("_contested"), CONFLICT).when(F.col("_first") != F.col("_row"), DUPLICATE).otherwise(ACCEPTED)
    )
    marked = rows.withColumnRenamed(key, "_key") if key in names else rows
    joined = marked.join(again, ["_key", "_digest", "_valid"], "left")
    return joined.select(*(F.col("_key").alias(key) if c == key else F.col(c) for c in names), status.alias("status"))


@dataclass(frozen=True)
class Transformed:
    classified: DataFrame
    silver: DataFrame
    quarantine: DataFrame
    read: Callable[[], int]  # rows of the input, counted where it was read


def silver_columns(spec: DatasetSpec) -> list[str]:
    """Silver columns in order, without lineage."""
    kept = [c for c in spec.rules.source if c not in PRIVATE and c != "processing_date"]
    extra = ["provider_address_hash"] if "provider_address" in spec.rules.source else []
    extra += ["severity_group"] if "scope_severity_code" in spec.rules.source else []
    return [spec.entity_key, *kept, *extra]


def transform(bronze: DataFrame, spec: DatasetSpec, salt: str, strict_dates: bool = False) -> Transformed:
    """A Bronze batch as classified rows, accepted Silver rows and quarantine rows.

    Text is trimmed, blanks are null, values are cast safely; private columns are dropped or hashed. Required source
    and metadata columns must be there (a missing one raises), extra columns are ignored. The row digest covers the
    business columns, not key, lineage or processing date. An empty batch gives empty frames.
    """
    rules = spec.rules
    missing = [c for c in (*rules.source, *BRONZE_METADATA) if c not in bronze.columns]
    if missing:
        raise ValueError(f"Bronze lacks {', '.join(missing)}")
    seen = Observation()
    counted = spread(bronze.select(*rules.source, *BRONZE_METADATA)).observe(seen, F.count(F.lit(1)).alias("rows"))
    judged = judge(counted, rules, prefix="s_", strict_dates=strict_dates)
    business = [c for c in silver_columns(spec) if c != spec.entity_key]
    derived = {"provider_address_hash": salted_digest(F.col("s_c_provider_address"), salt), "severity_group": severity_group(F.col("s_v_scope_severity_code")) if "severity_group" in business else None}
    named = judged.select(
        *(derived[c].alias(c) if c in derived else F.col(f"s_v_{c}").alias(c) for c in business),
        F.col("s_v_processing_date").alias("source_processing_date"),
        F.to_json(F.struct(*rules.source), {"ignoreNullFields": "false"}).alias("raw_record"),
        F.col("s_failed").alias("failed"),
        *BRONZE_METADATA,
    )
    keyed = named.withColumn(spec.entity_key, entity_key(list(spec.key), spec.nullable_key)).withColumn("row_hash", json_digest(business))
    newest_first = F.coalesce(-F.unix_date("source_processing_date"), F.lit(2**31 - 1))  # without a date last
    order = [newest_first, F.coalesce("_source_file", F.lit("")), F.col("raw_record"), F.coalesce("_batch_id", F.lit(""))]
    classified = classify(keyed, spec.entity_key, "row_hash", "failed", order)
    silver = classified.filter(F.col("status") == ACCEPTED).select(
        spec.entity_key, *business, "row_hash", F.lit(False).alias("is_deleted"), F.col("_source_file").alias("source_file"), F.col("_source_file_sha256").alias("source_file_sha256"),
        F.col("_batch_id").alias("source_batch_id"), "source_processing_date", F.current_timestamp().alias("load_timestamp"),
    )
    rejected = classified.filter(F.col("status").isin(INVALID, CONFLICT))
    reasons = F.when(F.col("status") == CONFLICT, F.array(F.lit(CONFLICT_RULE))).otherwise(F.array_sort("failed"))
    quarantine = rejected.select(
        F.lit(spec.name).alias("dataset"), F.col("_batch_id").alias("source_batch_id"), F.col("_source_file").alias("source_file"),
        F.col("_source_file_sha256").alias("source_file_sha256"), F.col(spec.entity_key).alias("candidate_entity_key"), "raw_record", reasons.alias("failed_rules"),
    ).distinct().withColumn("load_timestamp", F.current_timestamp())
    return Transformed(classified, silver, quarantine, lambda: seen.get["rows"])


class NotConserved(ValueError):
    pass


def conservation(done: Transformed) -> dict[str, int]:
    """Rows read, counted where the batch was read, and rows per status; raises if a row got lost or came twice."""
    counts = {s: 0 for s in (INVALID, CONFLICT, DUPLICATE, ACCEPTED)}
    counts |= {r["status"]: r["n"] for r in done.classified.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}  # four rows
    read = done.read()
    if read != sum(counts.values()):
        raise NotConserved(f"{read} rows were read, but {counts} came out")
    return counts | {"read": read}


def silver_schema(spec: DatasetSpec) -> T.StructType:
    """The declared schema of a Silver table: key, business columns and lineage, with the columns that must not be null."""
    kinds = {"date": T.DateType(), "int": T.IntegerType(), "double": T.DoubleType(), "decimal(14,2)": T.DecimalType(14, 2)}
    rules = spec.rules
    must = {spec.entity_key, *rules.required}
    own = [T.StructField(c, T.BooleanType() if c in rules.flags else kinds.get(rules.types.get(c, ""), T.StringType()), c not in must) for c in silver_columns(spec)]
    lineage = {"is_deleted": T.BooleanType(), "source_processing_date": T.DateType(), "load_timestamp": T.TimestampType()}
    return T.StructType(own + [T.StructField(c, lineage.get(c, T.StringType()), c == "source_processing_date") for c in LINEAGE])
