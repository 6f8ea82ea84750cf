"""Queries p1 to p7: the core problems on this project's tables, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.values import alnum_key, date_text, flexible_date, iso_date, numeric_key, padded_key
from ledgerloom.operators.as_known import as_known
from ledgerloom.operators.deliveries import full_delivery_batches, newest_non_blank, snapshot_batches
from ledgerloom.functions.rules import judge
from ledgerloom.operators.drift import Landing, drift_report, land, ordered_files, reading_problems, whole_table
from ledgerloom.operators.history import version_history
from ledgerloom.operators.profile import HISTOGRAM, VALIDITY, grouped_median, load_histogram, share, table_profile
from ledgerloom.operators.record_parser import parse_records
from ledgerloom.operators.references import PARTIAL, orphan_references, orphan_report
from ledgerloom.operators.snapshot_diff import comparable, content_hash, snapshot_changes
from ledgerloom.session import bounded_broadcast, cut_lineage, table
from ledgerloom.spec import DATASETS, REGISTRY, silver_kinds

CCN = "cms_certification_number_ccn"


def _provider_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of the full snapshots: written once, as every query asks them for the calendar and the rows."""
    return bounded_broadcast(cut_lineage(snapshot_batches(table(spark, sf_dir, "source_file_manifest"), "provider_info")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = _provider_batches(spark, sf_dir)
    calendar = [r["as_of_date"] for r in batches.select("idx", "as_of_date").distinct().orderBy("idx").collect()]  # one date per snapshot
    rows = table(spark, sf_dir, "provider_info").select(
        padded_key(CCN).alias("ccn"), "_batch_id", "load_timestamp", alnum_key("ownership_type").alias("ownership"), numeric_key("number_of_certified_beds").alias("beds")
    )
    at = F.col("load_timestamp")
    merged = (
        rows.filter(F.col("ccn").isNotNull())
        .join(batches.select("batch_id", "idx"), F.col("_batch_id") == F.col("batch_id"))
        .groupBy("ccn", "idx")
        .agg(newest_non_blank(F.col("ownership"), at).alias("ownership"), newest_non_blank(F.col("beds"), at).alias("beds"))
    )
    versions = version_history(merged, "ccn", "idx", ["ownership", "beds"], calendar)
    return versions.select(F.col("entity").alias("ccn"), date_text("valid_from").alias("valid_from"), date_text("valid_to").alias("valid_to"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    facility = table(spark, sf_dir, "silver_facility")
    names = facility.columns
    content = [n for n in names[names.index("provider_name") : names.index("longitude") + 1] if n != "provider_address_hash"]
    batches = _provider_batches(spark, sf_dir)
    present = facility.filter(~F.coalesce(F.col("is_deleted"), F.lit(False)))
    rows = present.select(padded_key(CCN).alias("ccn"), "source_batch_id", "load_timestamp", *(comparable(facility.schema[n]).alias(n) for n in content)).filter(F.col("ccn").isNotNull())
    merged = (
        rows.join(batches, F.col("source_batch_id") == F.col("batch_id"))
        .groupBy("ccn", "idx", "as_of_date", "next_as_of")
        .agg(*(newest_non_blank(F.col(n), F.col("load_timestamp")).alias(n) for n in content))
        .select("ccn", "idx", "as_of_date", "next_as_of", content_hash([F.col(n) for n in content]).alias("row_digest"))
    )
    changes = snapshot_changes(merged, "ccn", "idx", "row_digest", "as_of_date", "next_as_of")
    return changes.select(F.col("key").alias("ccn"), date_text("as_of_date").alias("as_of_date"), "change_type")


def _events(spark: SparkSession, sf_dir: str, day: dict[str, str]) -> DataFrame:
    one = lambda t, d: table(spark, sf_dir, t).select(F.lit(t).alias("source_table"), "record_id", padded_key(CCN).alias("ccn"), F.col(d).alias("day"))
    return one("health_deficiencies", day["health_deficiencies"]).unionByName(one("penalties", day["penalties"]))


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = _provider_batches(spark, sf_dir)
    parents = (
        table(spark, sf_dir, "provider_info")
        .select(padded_key(CCN).alias("ccn"), "_batch_id")
        .filter(F.col("ccn").isNotNull())
        .join(batches.select("batch_id", "idx"), F.col("_batch_id") == F.col("batch_id"))
        .select("ccn", "idx")
        .distinct()
    )
    parents = cut_lineage(parents)  # one narrow row per facility and snapshot, used by each null mask
    calendar = [(r["idx"], r["as_of_date"]) for r in batches.select("idx", "as_of_date").distinct().orderBy("idx").collect()]  # one date per snapshot
    rows = _events(spark, sf_dir, {"health_deficiencies": "processing_date", "penalties": "processing_date"}).withColumn("day", iso_date("day"))
    # The newest snapshot on or before the day; -1 where there is none, which no parent has. A row without a readable
    # day refers to the CCN in any snapshot: its key is partly null.
    dates = F.array(*(F.lit(d) for _, d in calendar)) if calendar else F.array().cast("array<date>")
    snapshot = F.when(F.col("day").isNotNull(), F.size(F.filter(dates, lambda d: d <= F.col("day"))) - 1)
    refs = rows.filter(F.col("ccn").isNotNull()).select("source_table", "record_id", "ccn", snapshot.alias("idx"), "day")
    return orphan_references(refs, parents, ["ccn", "idx"], period="idx", entity="ccn", match=PARTIAL, nullable=["idx"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("source_table", "record_id", "reason").distinct()


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, release month and kind; every row counts."""
    return orphan_report(_orphans(spark, sf_dir), "source_table", F.date_format("day", "yyyy-MM"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = bounded_broadcast(full_delivery_batches(table(spark, sf_dir, "source_file_manifest"), "provider_info"))
    reports = (
        table(spark, sf_dir, "provider_info")
        .select(padded_key(CCN).alias("ccn"), "_batch_id", "_ingest_date", "load_timestamp", alnum_key("ownership_type").alias("ownership"))
        .join(full.select("batch_id", "as_of_date"), F.col("_batch_id") == F.col("batch_id"))
    )
    rows = _events(spark, sf_dir, {"health_deficiencies": "survey_date", "penalties": "penalty_date"}).withColumn("day", flexible_date("day"))
    known = as_known(
        rows, reports, event_entity="ccn", event_day="day", entity="ccn", known_from="_ingest_date",
        rank=["as_of_date", "_ingest_date", "load_timestamp"], value="ownership", shown="as_of_date",
    )
    return known.filter("differs").select("source_table", "record_id", date_text("known_as_of_date").alias("known_as_of")).distinct()


def classified_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_records parsed and judged: line_id, dataset, fields and all reasons (an empty array for valid records)."""
    layouts = {d: list(DATASETS[d].source) for d in ("health_deficiencies", "penalties")}
    parsed = parse_records(table(spark, sf_dir, "raw_records"), ["line_id"], "dataset", "record_format", "raw_record", layouts)
    judged, reasons = parsed, F.when(F.col("structure").isNotNull(), F.array("structure"))
    for k, (name, layout) in enumerate(layouts.items()):
        field = lambda n, name=name, layout=layout: F.when(F.col("dataset") == name, F.get(F.col("fields"), F.lit(layout.index(n))))
        judged = judge(judged, DATASETS[name], field, prefix=f"d{k}_")
        reasons = reasons.when(F.col("dataset") == name, F.col(f"d{k}_failed"))
    return judged.select("line_id", "dataset", "fields", reasons.alias("reasons"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified_records(spark, sf_dir).select("line_id", F.explode("reasons").alias("reason"))


def p5_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records apart from the broken ones, with their fields as one JSON array."""
    return classified_records(spark, sf_dir).filter(F.size("reasons") == 0).select("line_id", "dataset", F.to_json("fields", {"ignoreNullFields": "false"}).alias("fields"))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p3_found": p3_found, "p3_report": p3_report, "p4_found": p4_found, "p5_found": p5_found, "p5_valid": p5_valid}


#: What is asked of each column, the pattern of its valid values and the thresholds of the findings.
PROFILED = {
    "health_deficiencies": {"scope_severity_code": HISTOGRAM, "zip_code": VALIDITY},
    "penalties": {"zip_code": VALIDITY, "fine_amount": HISTOGRAM},
}
VALID = {"scope_severity_code": "[A-La-l]", "zip_code": "[0-9]{5}", "fine_amount": r"-?[0-9]{1,12}(\.[0-9]{1,2})?", "processing_date": ".*"}
LEAST_ROWS, PATTERN_SHARE, NULL_STEP, DISTANCE = 30, 0.05, 0.15, 0.3


def load_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (source_table, column_name, batch_id): counts, codes, extrema and median beside the preceding load's."""
    parts = []
    for name, needs in PROFILED.items():
        hist = load_histogram(spark, f"{sf_dir}/{name}.parquet", "_batch_id", {**needs, "processing_date": HISTOGRAM}, VALID)
        parts.append(hist.select(F.lit(name).alias("source_table"), "column", F.col("load").alias("batch_id"), "value", "n"))
    hist = cut_lineage(parts[0].unionByName(parts[1]))
    v = F.trim("value")
    blank = F.col("value").isNull() | (v == "")
    valid = ~blank & F.coalesce(*(F.when(F.col("column") == c, v.rlike(rf"^(?:{p})\z")) for c, p in VALID.items()))
    cents = F.when(valid & (F.col("column") == "fine_amount"), (v.try_cast("decimal(14,2)") * 100).cast("bigint"))
    by = ["source_table", "column", "batch_id"]
    code = F.when(valid & (F.col("column") == "scope_severity_code"), F.upper(v))
    codes = [F.sum(F.when(code == c, F.col("n")).otherwise(0)).alias(f"code_{c}") for c in "ABCDEFGHIJKL"]
    stats = hist.groupBy(*by).agg(
        F.sum("n").alias("rows"), F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("blanks"), F.sum(F.when(valid, F.col("n")).otherwise(0)).alias("valids"),
        F.min(cents).alias("least"), F.max(cents).alias("greatest"), F.min(v).alias("first_value"), *codes,
    )
    medians = grouped_median(hist.withColumn("cents", cents).filter("cents IS NOT NULL"), by, "cents", "n")
    released = stats.filter("column = 'processing_date'").select("source_table", "batch_id", F.col("first_value").alias("released"))
    w = Window.partitionBy("source_table", "column").orderBy("released", "batch_id")
    profile = stats.filter("column <> 'processing_date'").join(medians, by, "left").join(released, ["source_table", "batch_id"]).filter(F.col("rows") >= LEAST_ROWS)
    before = ["rows", "blanks", "valids", "greatest", "median", *(f"code_{c}" for c in "ABCDEFGHIJKL")]
    return profile.select("*", *(F.lag(c).over(w).alias(f"before_{c}") for c in before)).drop("first_value")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load_profiles(spark, sf_dir)
    c = F.col
    present = c("rows") - c("blanks")
    letters = [f"code_{x}" for x in "ABCDEFGHIJKL"]
    distance = sum((F.abs(share(c(x), c("valids")) - share(c(f"before_{x}"), c("before_valids"))) for x in letters), F.lit(0.0)) / 2
    kinds = lambda prefix: sum(((c(prefix + x) > 0).cast("int") for x in letters), F.lit(0))
    severity, amount = c("column") == "scope_severity_code", c("column") == "fine_amount"
    findings = {
        "PATTERN": share(present - c("valids"), present) > PATTERN_SHARE,
        "NULL_RATE": F.abs(share(c("blanks"), c("rows")) - share(c("before_blanks"), c("before_rows"))) > NULL_STEP,
        "DISTRIBUTION": (severity & (distance > DISTANCE)) | (amount & ((c("median") > 3 * c("before_median")) | (3 * c("median") < c("before_median")))),
        "DISTINCT": severity & (kinds("before_") > 0) & (2 * kinds("") <= kinds("before_")),
        "RANGE": amount & ((c("least") < 0) | F.coalesce(c("greatest") > 10 * c("before_greatest"), F.lit(False))),
    }
    found = F.filter(F.array(*(F.when(cond, F.lit(name)) for name, cond in findings.items())), lambda x: x.isNotNull())
    return p.select("source_table", F.col("column").alias("column_name"), "batch_id", F.explode(found).alias("finding"))


#: Patterns of the columns that have one, by which the profile counts violations.
PATTERNS = {
    "scope_severity_code": VALID["scope_severity_code"], "zip_code": VALID["zip_code"], "fine_amount": VALID["fine_amount"], "state": "[A-Za-z]{2}", "deficiency_tag_number": "[0-9]{4}",
    "cms_certification_number_ccn": "[0-9A-Za-z]{6}", "processing_date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
}


def p6_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of both tables, per load and against the load before it."""
    parts = [table_profile(spark, f"{sf_dir}/{t}.parquet", "_batch_id", "processing_date", PATTERNS, typed=True).select(F.lit(t).alias("source_table"), "*") for t in PROFILED]
    return parts[0].unionByName(parts[1])


QUERIES |= {"p6_found": p6_found, "p6_profile": p6_profile}


def landing(spark: SparkSession, sf_dir: str) -> tuple[Landing, DataFrame]:
    landed = land(table(spark, sf_dir, "landing_records"), "landing_path", "row_no", "record")
    return landed, cut_lineage(ordered_files(table(spark, sf_dir, "source_file_manifest"), landed))


KINDS = {d: silver_kinds(s) for d, s in DATASETS.items()}
#: Fixed value: the datasets whose files land as records; those of any other keep their fields in ``extra``.
LANDED = ("penalties", "health_deficiencies", "mds_quality")
IDENTITY = {d: s.key for d, s in REGISTRY.items()}


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _ = drift_report(*landing(spark, sf_dir), KINDS, IDENTITY)
    return report.select(F.col("path").alias("landing_path"), "drift_type", "column_name").distinct()


def p7_penalties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed files as one consistent, typed table; the name is from when it held the penalties alone."""
    landed, files = landing(spark, sf_dir)
    _, canon = drift_report(landed, files, KINDS, IDENTITY)
    return whole_table(landed, files, canon, {d: KINDS[d] for d in LANDED})


def p7_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the files could not be read as it stands."""
    return reading_problems(*landing(spark, sf_dir)).select(F.col("path").alias("landing_path"), "problem", "rows")


QUERIES |= {"p7_found": p7_found, "p7_penalties": p7_penalties, "p7_problems": p7_problems}
