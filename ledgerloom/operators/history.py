"""Version history of entity attributes from periodic full snapshots.

Method: the snapshots are co-partitioned by entity and key-sorted by (entity, time); the sorted runs of all snapshots
are merged into one ordered stream per partition, and an iterator closes a version whenever the payload changes or a
snapshot lacks the entity. The iterator holds one record batch and the one open version, never a history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN_END = dt.date(9999, 12, 31)


def _forward_fill(codes: np.ndarray, entity_start: np.ndarray) -> np.ndarray:
    """Last non-negative code at or before each position, not reaching before ``entity_start``; -1 if there is none."""
    pos = np.where(codes >= 0, np.arange(len(codes)), -1)
    pos = np.maximum.accumulate(pos)
    return np.where(pos >= entity_start, codes[np.maximum(pos, 0)], -1)


def _codes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, list]:
    enc = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    enc = enc.dictionary_encode()
    return enc.indices.fill_null(-1).to_numpy(zero_copy_only=False), enc.dictionary.to_pylist()


def close_versions(batches: Iterator[pa.RecordBatch], payload: list[str], calendar: list[dt.date], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Merge-iterator over rows ordered by (entity, idx) with one row per entity and snapshot.

    Emits (entity, valid_from, valid_to, payload...) for each closed version. A null payload value continues the last
    reported one. ``calendar[idx]`` is the date of snapshot idx.
    """
    days = np.array(calendar + [OPEN_END], dtype="datetime64[D]")
    n_snap = len(calendar)
    carry: dict | None = None

    def flush(c: dict) -> pa.RecordBatch:
        end = days[c["idx"] + 1] if c["idx"] + 1 < n_snap else days[n_snap]
        return out([c["entity"]], days[[c["start"]]], np.array([end]), [[c["payload"][p]] for p in payload])

    def out(entity, start, end, values) -> pa.RecordBatch:
        cols = [pa.array(entity, pa.string()), pa.array(start, pa.date32()), pa.array(end, pa.date32())]
        return pa.RecordBatch.from_arrays([*cols, *(pa.array(v, pa.string()) for v in values)], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if carry is not None:  # the open version takes part as a first row that is known to start a version
            t = t.select(["entity", "idx", *payload])
            head = {"entity": [carry["entity"]], "idx": [carry["idx"]], **{p: [carry["payload"][p]] for p in payload}}
            t = pa.concat_tables([pa.Table.from_pydict(head, schema=t.schema), t])
        ent, names = _codes(t["entity"])
        idx = t["idx"].to_numpy()
        n = len(idx)
        first = np.r_[True, ent[1:] != ent[:-1]]
        entity_start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        starts = first | np.r_[False, idx[1:] != idx[:-1] + 1]
        filled, dictionaries = [], []
        for p in payload:
            raw, values = _codes(t[p])
            f = _forward_fill(raw, entity_start)
            starts |= np.r_[False, f[1:] != f[:-1]]
            filled.append(f)
            dictionaries.append(values)
        at = np.flatnonzero(starts)
        start_idx = idx[at].copy()
        if carry is not None:
            start_idx[0] = carry["start"]
        last = np.r_[at[1:] - 1, n - 1]  # last row of each version
        follows = np.r_[~first[at[1:]] & (idx[at[1:]] == idx[last[:-1]] + 1), False]
        nxt = np.minimum(idx[last] + 1, n_snap)
        valid_to = np.where(follows, days[np.r_[idx[at[1:]], n_snap]], days[nxt])
        done = slice(0, len(at) - 1)
        value = lambda k, rows: [dictionaries[k][c] if c >= 0 else None for c in filled[k][rows]]
        if len(at) > 1:
            rows = last[done]
            yield out([names[c] for c in ent[rows]], days[start_idx[done]], valid_to[done], [value(k, rows) for k in range(len(payload))])
        carry = {"entity": names[ent[-1]], "idx": int(idx[-1]), "start": int(start_idx[-1]), "payload": {p: value(k, [n - 1])[0] for k, p in enumerate(payload)}}
    if carry is not None:
        yield flush(carry)


def version_history(rows: DataFrame, entity: str, idx: str, payload: list[str], calendar: list[dt.date]) -> DataFrame:
    """History of ``payload`` per ``entity`` over the snapshots numbered by ``idx`` (0-based, dates in ``calendar``).

    ``rows`` holds at most one row per (entity, snapshot); payload columns are comparison keys as strings. Null
    entities refer to nothing and are left out; null payload values continue the last reported value; repeated rows
    must be reduced before (see ``newest_non_blank``); extra columns are ignored; an empty frame or calendar gives no
    versions.
    """
    names = [f"payload_{k}" for k in range(len(payload))]
    narrow = rows.filter(F.col(entity).isNotNull() & F.col(idx).isNotNull()).select(
        F.col(entity).cast("string").alias("entity"), F.col(idx).cast("int").alias("idx"), *(F.col(p).cast("string").alias(n) for p, n in zip(payload, names))
    )
    fields = [("entity", pa.string()), ("valid_from", pa.date32()), ("valid_to", pa.date32()), *((n, pa.string()) for n in names)]
    schema = pa.schema(fields)
    ddl = "entity string, valid_from date, valid_to date" + "".join(f", {n} string" for n in names)
    merged = narrow.repartition("entity").sortWithinPartitions("entity", "idx")
    versions = merged.mapInArrow(lambda it: close_versions(it, names, calendar, schema), ddl)
    return versions.select("entity", "valid_from", "valid_to", *(F.col(n).alias(p) for p, n in zip(payload, names)))
