"""Queries of the text problems, over the whole table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.encoding import decode, encode, token_counts
from ledgerloom.llm.packing import fill, pack
from ledgerloom.llm.personal import occurrences, redacted


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(_documents(spark, sf_dir), "doc_id", "text")


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts again, from their ids."""
    return decode(p8_ids(spark, sf_dir), "doc_id", "ids")


def _windows(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    return [(r["window_id"], r["capacity_tokens"]) for r in spark.read.parquet(f"{sf_dir}/context_windows.parquet").collect()]  # a fixed table


def p9_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return pack(token_counts(documents, "doc_id", "text"), "doc_id", "n_tokens", _windows(spark, sf_dir), documents.count())


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the windows of each size are filled."""
    return fill(p9_bins(spark, sf_dir), _windows(spark, sf_dir))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occurrences(_documents(spark, sf_dir), "doc_id", "text")


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redacted(_documents(spark, sf_dir), "doc_id", "text")


QUERIES = {"p8_ids": p8_ids, "p8_decoded": p8_decoded, "p9_bins": p9_bins, "p9_fill": p9_fill, "p10_found": p10_found, "p10_redacted": p10_redacted}
