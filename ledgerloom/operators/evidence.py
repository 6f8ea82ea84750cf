"""Evidence that batches are conserved and reruns change nothing, and the migration of old quarantine rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.control import ACQUIRED
from ledgerloom.operators.versioned import VersionedTable


def batch_conservation(manifest: DataFrame, bronze: DataFrame, quarantine: DataFrame) -> DataFrame:
    """(batch_id, source_rows, bronze_rows, quarantine_rows, conserved) for each batch of the manifest."""
    good = bronze.groupBy(F.col("_batch_id").alias("batch_id")).agg(F.count(F.lit(1)).alias("bronze_rows"))
    bad = quarantine.groupBy("batch_id").agg(F.count(F.lit(1)).alias("quarantine_rows"))
    base = manifest.select("batch_id", "source_rows").join(good, "batch_id", "left").join(bad, "batch_id", "left").fillna(0, ["bronze_rows", "quarantine_rows"])
    return base.withColumn("conserved", F.coalesce(F.col("source_rows") == F.col("bronze_rows") + F.col("quarantine_rows"), F.lit(False)))


def rerun_idempotency(bronze: DataFrame, logs: DataFrame) -> DataFrame:
    """(batch_id, attempts, expected_rows, bronze_rows, idempotent) for each batch with a successful load.

    Starts from the logs, so that a batch that vanished from Bronze is listed with 0 rows: each must hold what its
    largest successful load inserted.
    """
    loads = logs.filter("pipeline_layer = 'Raw-to-Bronze' AND status = 'SUCCESS'").groupBy("batch_id").agg(F.count(F.lit(1)).alias("attempts"), F.max("rows_inserted").alias("expected_rows"))
    rows = bronze.groupBy(F.col("_batch_id").alias("batch_id")).agg(F.count(F.lit(1)).alias("bronze_rows"))
    both = loads.join(rows, "batch_id", "left").fillna(0, ["bronze_rows"])
    return both.withColumn("idempotent", F.coalesce(F.col("bronze_rows") == F.col("expected_rows"), F.lit(False)))


def drift_listing(drift: DataFrame, manifest: DataFrame) -> DataFrame:
    """The drift rows of the batches of ``manifest`` (narrowed to a scope by the caller), oldest first."""
    scoped = drift.join(manifest.select("dataset", "batch_id").distinct(), ["dataset", "batch_id"], "left_semi")
    return scoped.select("run_id", "dataset", "batch_id", "drift_type", "column_name", "detail", "source_file", "load_timestamp").orderBy("load_timestamp", "column_name")


def watermark_listing(watermarks: DataFrame, dataset: str | None = None) -> DataFrame:
    """The committed watermarks, of all datasets or of one."""
    rows = watermarks.filter(F.col("dataset") == dataset) if dataset else watermarks
    return rows.select("dataset", "watermark_column", "watermark_value", "last_successful_acquisition_run_id", "last_successful_bronze_run_id", "load_timestamp").orderBy("dataset")


def attempts(logs: DataFrame) -> DataFrame:
    return logs.groupBy("dataset", "pipeline_layer").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("status") == "FAILURE").alias("failed"),
        F.count_if(F.col("rows_inserted") == 0).alias("zero_insert"), F.count_if(F.col("rows_updated") == 0).alias("zero_update"),
    )


def table_summary(silver: DataFrame, key: str) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("distinct_keys"), F.count_if("is_deleted").alias("soft_deleted"),
        F.min("load_timestamp").alias("first_load"), F.max("load_timestamp").alias("last_load"),
    )


def key_profile(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows, distinct keys (nulls count as values) and rows with a null in the key."""
    any_null = F.greatest(*(F.col(c).isNull().cast("int") for c in key), F.lit(0)) == 1
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.struct(*key)).alias("distinct_keys"), F.count_if(any_null).alias("null_key_rows"))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks, with multiplicity: (side, columns...). Empty means equal."""
    a = left.exceptAll(right).withColumn("side", F.lit("left"))
    return a.unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


class UnresolvedLineage(ValueError):
    pass


def rebuild_lineage(legacy: DataFrame, manifest: DataFrame) -> DataFrame:
    """Old quarantine rows with source file and digest from the manifest.

    Only rows of acquired files are evidence; digests are compared without regard to case. One aggregate over them gives
    each batch its number of different (path, digest) pairs and the newest pair. Null required fields or rules, batches
    with several pairs and rows without such a batch raise, each before anything is written.
    """
    pair = F.struct(F.col("landing_path").alias("path"), F.lower("source_file_sha256").alias("digest"))
    acquired = manifest.filter(F.col("status").isin(*ACQUIRED) & F.col("landing_path").isNotNull() & F.col("source_file_sha256").isNotNull())
    evidence = acquired.groupBy("dataset", "batch_id").agg(F.countDistinct(pair).alias("_pairs"), F.max_by(pair, "load_timestamp").alias("_pair"))
    joined = legacy.join(evidence, ["dataset", "batch_id"], "left")
    nulls = F.greatest(*(F.col(c).isNull().cast("int") for c in ("dataset", "batch_id", "raw_record", "failed_rules", "load_timestamp"))) == 1
    tests = {
        "null required fields": nulls | F.exists("failed_rules", lambda r: r.isNull()), "several source files": F.col("_pairs") > 1, "a batch that the manifest does not hold": F.col("_pairs").isNull(),
    }
    seen = joined.agg(*(F.count_if(F.coalesce(t, F.lit(False))).alias(n) for n, t in tests.items())).first().asDict()
    if broken := {n: k for n, k in seen.items() if k}:
        raise UnresolvedLineage(f"legacy rows with {broken}")
    return joined.select("dataset", F.col("batch_id").alias("source_batch_id"), F.col("_pair.path").alias("source_file"), F.col("_pair.digest").alias("source_file_sha256"), F.lit(None).cast("string").alias("candidate_entity_key"), "raw_record", "failed_rules", "load_timestamp")


class Migration:
    """preview -> prepare -> verify -> activate of a quarantine, the writing steps only with their confirmation token.

    ``states`` tells where it stands by the schemas of both tables; a step that does not fit the state raises.
    Activation renames folders; it is undone if the second renaming or the test of the result fails.
    """

    def __init__(self, legacy, staged, tokens: tuple[str, str]):
        self.legacy, self.staged, self.tokens = legacy, staged, tokens
        self.live, self.aside = legacy.root, staged.root

    def states(self) -> tuple[str, str]:
        """State of the live table (LEGACY before the migration, CURRENT after it) and of the staged one."""
        at = lambda root: VersionedTable(self.staged.spark, root, self.staged.schema).schema_state(self.legacy.schema)
        return at(self.live), at(self.aside)

    def _confirm(self, given: str, step: int, want: tuple[str, str]) -> None:
        if given != self.tokens[step]:
            raise PermissionError("wrong confirmation token")
        if self.states() != want:
            raise ValueError(f"the tables are {self.states()}, not {want}")

    def preview(self) -> dict[str, int]:
        return {"legacy_rows": self.legacy.read().count(), "staged_rows": self.staged.read().count() if self.staged.exists() else 0}

    def prepare(self, manifest: DataFrame, confirmation: str) -> int:
        self._confirm(confirmation, 0, ("LEGACY", "MISSING"))
        return self.staged.publish(rebuild_lineage(self.legacy.read(), manifest), "PREPARE")

    def verify(self) -> bool:
        """Whether the staged rows are the legacy ones, with multiplicity."""
        narrow = lambda t, b: t.read().select("dataset", F.col(b).alias("b"), "raw_record", "failed_rules", "load_timestamp")
        return multiset_difference(narrow(self.legacy, "batch_id"), narrow(self.staged, "source_batch_id")).isEmpty()

    def activate(self, confirmation: str) -> None:
        self._confirm(confirmation, 1, ("LEGACY", "CURRENT"))
        if not self.verify():
            raise ValueError("staged rows differ from the legacy ones")
        rows = self.staged.read().count()
        old = self.legacy.rename_to(f"{self.live}__backup")
        try:
            new = self.staged.rename_to(self.live)
            try:
                if new.schema_state() != "CURRENT" or new.read().count() != rows:
                    raise OSError("the renamed table cannot be read")
            except Exception:
                new.rename_to(self.aside)
                raise
        except Exception:
            old.rename_to(self.live)
            raise
        self.legacy, self.staged = old, new
