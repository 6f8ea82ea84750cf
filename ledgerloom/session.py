"""Session helpers: table access, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "ledgerloom", cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by spark.checkpoint.dir; set one only where none is set and all runs on one machine (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not named:
        import tempfile

        named = tempfile.mkdtemp(prefix="ledgerloom-checkpoint-")
    sc.setCheckpointDir(named)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def bounded_broadcast(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only if the frame is measured to hold at most ``max_rows`` rows and ``max_bytes`` bytes of JSON.

    Beyond either bound the frame is returned unhinted, so that the join shuffles.
    """
    size = F.length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    seen = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if seen["n"] <= max_rows and seen["b"] <= max_bytes else df


def spread(df: DataFrame) -> DataFrame:
    """``df``, over all cores where it is read in fewer partitions than that: a file with one row group is read by one task.

    Larger inputs have more partitions and are left alone, so nothing is shuffled at scale. Frames that are shuffled
    anyway are left alone too: counting their partitions would compute them.
    """
    plan = df._jdf.queryExecution().sparkPlan().toString()
    if any(word in plan for word in ("Join", "Aggregate", "Window", "Sort", "Exchange", "Repartition", "Union")):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder for written intermediates, beside the checkpoints in the shared folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"
