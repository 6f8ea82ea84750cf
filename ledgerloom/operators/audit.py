"""Audit log: one validated row per attempt."""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import types as T

from ledgerloom.operators.control import LAYERS, LOAD_TYPES, STATUSES

METRICS = ("rows_read", "rows_inserted", "rows_updated", "rows_deleted", "rows_quarantined")
_S, _L, _TS, _D, _B = T.StringType(), T.LongType(), T.TimestampType(), T.DateType(), T.BooleanType()


def _struct(text: str) -> T.StructType:
    """'name kind?' items; a question mark allows nulls."""
    kinds = {"s": _S, "l": _L, "t": _TS, "d": _D, "b": _B, "a": T.ArrayType(_S, True)}
    fields = []
    for item in text.split():
        name, _, kind = item.partition(":")
        fields.append(T.StructField(name, kinds[kind[0]], kind.endswith("?")))
    return T.StructType(fields)


# Schemas of the control tables.
LOG_SCHEMA = _struct("run_id:s batch_id:s pipeline_layer:s dataset:s load_type:s parameter_processed:s start_time:t end_time:t status:s rows_read:l rows_inserted:l rows_updated:l rows_deleted:l rows_quarantined:l error_message:s? load_timestamp:t")
MANIFEST_SCHEMA = _struct(
    "acquisition_run_id:s dataset:s dataset_id:s load_type:s as_of_date:d acquisition_strategy:s source_url:s source_catalog_modified:d? window_start:d? window_end:d? page_offset:l? landing_path:s "
    "batch_id:s source_content_sha256:s source_file_sha256:s source_bytes:l expected_run_rows:l? source_rows:l? row_count_validated:b status:s error_message:s? load_timestamp:t"
)
WATERMARK_SCHEMA = _struct("dataset:s watermark_column:s watermark_value:d last_successful_acquisition_run_id:s last_successful_bronze_run_id:s last_successful_silver_run_id:s? load_timestamp:t")
DRIFT_SCHEMA = _struct("run_id:s batch_id:s? dataset:s source_file:s source_file_sha256:s? drift_type:s column_name:s? detail:s load_timestamp:t")
BRONZE_QUARANTINE_SCHEMA = _struct("dataset:s dataset_id:s source_file:s source_file_sha256:s batch_id:s load_type:s raw_record:s? corrupt_record:s? failed_rules:a load_timestamp:t")
SILVER_QUARANTINE_SCHEMA = _struct("dataset:s source_batch_id:s source_file:s source_file_sha256:s candidate_entity_key:s? raw_record:s failed_rules:a load_timestamp:t")
LEGACY_QUARANTINE_SCHEMA = _struct("dataset:s batch_id:s raw_record:s failed_rules:a load_timestamp:t")


def check_log(record: dict) -> None:
    for field, allowed in (("pipeline_layer", LAYERS), ("load_type", LOAD_TYPES), ("status", STATUSES)):
        if record.get(field) not in allowed:
            raise ValueError(f"{field} must be one of {allowed}, not {record.get(field)!r}")
    for m in METRICS:
        if type(record.get(m)) is not int or record[m] < 0:
            raise ValueError(f"{m} must be a non-negative integer, not {record.get(m)!r}")


@contextmanager
def audited(write: Callable[[dict], None], **fields) -> Iterator[dict]:
    """Run a step and write its log row on success or failure.

    The step fills the metrics of the yielded record; quarantined rows turn SUCCESS into QUARANTINED_PARTIAL; setting
    ``suppress`` skips the row of a successful step only. A failing step raises its own error even if writing fails.
    """
    now = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    record = {**fields, **dict.fromkeys(METRICS, 0), "start_time": now(), "error_message": None, "suppress": False}
    finish = lambda status, error=None: {k: v for k, v in record.items() if k != "suppress"} | {"status": status, "error_message": error, "end_time": now(), "load_timestamp": now()}
    try:
        yield record
    except BaseException as error:
        try:
            row = finish("FAILURE", f"{type(error).__name__}: {error}"[:2000])
            check_log(row)
            write(row)
        except Exception:
            error.add_note("the audit row was not written: " + traceback.format_exc(limit=1))
        raise
    if not record["suppress"]:
        row = finish("QUARANTINED_PARTIAL" if record["rows_quarantined"] else "SUCCESS")
        check_log(row)
        write(row)
