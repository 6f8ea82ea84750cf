"""The Bronze load as a stream: files that arrive in a folder become batches, each micro-batch replaced as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.versioned import BatchTable
from ledgerloom.sources.files import CORRUPT, QUARANTINE, quarantined, text_schema
from ledgerloom.spec import DatasetSpec


def stream_csv(spark: SparkSession, folder: str, spec: DatasetSpec) -> DataFrame:
    """A stream of all-text rows with the batch id derived from the file's path; broken rows keep their raw text."""
    reader = spark.readStream.schema(text_schema(spec.rules.source, corrupt=True)).options(header=True, mode="PERMISSIVE", multiLine=True, quote='"', escape='"', columnNameOfCorruptRecord=CORRUPT)
    rows = reader.csv(folder)
    named = rows.withColumns({"_dataset": F.lit(spec.name), "_dataset_id": F.lit(spec.dataset_id), "_source_file": F.input_file_name()})
    return named.withColumn("_batch_id", F.substring(F.sha2("_source_file", 256), 1, 24))


def quarantine_of(table: BatchTable) -> BatchTable:
    """The Bronze quarantine beside a table that is loaded by a stream."""
    return BatchTable(table.spark, f"{table.root}_quarantine", QUARANTINE, "batch_id")


def run_into(rows: DataFrame, table: BatchTable, checkpoint: str, quarantine: BatchTable | None = None) -> StreamingQuery:
    """Load what is there and stop. A file that is delivered again replaces its batch, so a restart repeats nothing.

    Rows with a corrupt record go to ``quarantine`` (``quarantine_of(table)`` unless given), replaced by batch as well.
    A stream has no manifest: digest and load type are null there. A file without any row is not seen, and leaves what
    its batch had.
    """
    aside = quarantine or quarantine_of(table)
    columns = [c for c in rows.columns if not c.startswith("_")]

    def write(df: DataFrame, _: int) -> None:
        df = df.persist()  # one parse for both tables and the counts, with all columns, as widths are told by them
        try:
            broken = F.col(CORRUPT).isNotNull()
            seen = df.groupBy(F.col(table.batch).alias("batch")).agg(F.count_if(~broken).alias("good"), F.count_if(broken).alias("bad")).collect()  # one row per file
            none = F.lit(None).cast("string")
            bad = quarantined(df.filter(broken), columns, F.col("_dataset"), F.col("_dataset_id"), F.col("_source_file"), none, F.col(table.batch), none)
            table.replace_many(df.filter(~broken), {r["batch"]: r["good"] for r in seen})
            aside.replace_many(bad, {r["batch"]: r["bad"] for r in seen})
        finally:
            df.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
