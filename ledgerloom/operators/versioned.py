"""Versioned Parquet tables without a table-format dependency: data folders behind a log of exclusively created versions."""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.merge import INSERT, STALE, UPDATE, apply_merge, merge_actions
from ledgerloom.sources.storage import Storage

CREATED, VERIFIED = "CREATED", "VERIFIED"
MISSING, CURRENT, LEGACY, MISMATCH = "MISSING", "CURRENT", "LEGACY", "MISMATCH"
_BATCH = re.compile(r"[A-Za-z0-9_-]{1,128}")
HISTORY = "version long, operation string, counts map<string,long>"


class SchemaMismatch(ValueError):
    pass


class ConcurrentChange(RuntimeError):
    """Another writer changed the rows that a change was computed from."""


def write_json_atomically(path: str | Path, payload: object) -> None:
    """Readers see the old or the new content, never a part."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    part.write_text(json.dumps(payload, sort_keys=True))
    os.replace(part, path)


def _counted(df: DataFrame, counts: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` and a function that gives the counts once it was computed; the write itself counts."""
    seen = Observation()
    exprs = [F.coalesce(F.count_if(c), F.lit(0)).alias(n) for n, c in counts.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(seen, *exprs), lambda: {n: int(v or 0) for n, v in seen.get.items()}


class VersionedTable:
    """A table in the folder ``root``: ``data-*`` folders of rows and ``_log/N.json``, the versions.

    A version names the folders that make up the table, the operation that made it and its counts. A writer puts rows
    into a folder of its own and then creates the next version's file, which fails if another writer was first: appends
    then try again on the new version, changes of existing rows raise ``ConcurrentChange``. A lost job leaves a folder
    that no version names. Columns declared NOT NULL are checked in what was written before a version names it.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, str(root), schema
        self.storage = Storage(spark, self.root)

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.storage.names("_log") if n.endswith(".json") and not n.startswith(".")]

    def exists(self) -> bool:
        return bool(self.versions())

    def version(self) -> int:
        return self.versions()[-1]

    def _entry(self, version: int) -> dict:
        return json.loads(self.storage.read(f"_log/{version:012d}.json"))

    def _state(self) -> tuple[int, list[str]]:
        """The current version, -1 if there is none, and its folders."""
        found = self.versions()
        return (found[-1], self._entry(found[-1])["folders"]) if found else (-1, [])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the current or of an earlier version."""
        folders = self._state()[1] if version is None else self._entry(version)["folders"]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.root}/{f}" for f in folders))

    def stored_schema(self) -> T.StructType | None:
        """The schema the current version was written with, nullability included; None if there is no table."""
        found = self.versions()
        return T.StructType.fromJson(self._entry(found[-1])["schema"]) if found else None

    def schema_state(self, legacy: T.StructType | None = None) -> str:
        """MISSING, CURRENT (names, types and order as declared), LEGACY (as ``legacy`` declares) or MISMATCH."""
        stored = self.stored_schema()
        if stored is None:
            return MISSING
        have, want, old = (s and [(f.name, f.dataType.simpleString()) for f in s.fields] for s in (stored, self.schema, legacy))
        return CURRENT if have == want else LEGACY if have == old else MISMATCH

    def ensure(self) -> str:
        """Create the empty table, or verify that the stored schema equals the declared one: names, types, order, nullability."""
        if not self.exists():
            self.publish(self.spark.createDataFrame([], self.schema), "CREATE")
            return CREATED
        have, want = ([(f.name, f.dataType.simpleString(), f.nullable) for f in s.fields] for s in (self.stored_schema(), self.schema))
        if have != want:
            raise SchemaMismatch(f"{self.root}: stored {have}, declared {want}")
        return VERIFIED

    def _commit(self, based_on: int, folders: list[str], operation: str, counts: dict[str, int], schema: T.StructType) -> bool:
        entry = {"version": based_on + 1, "folders": folders, "operation": operation, "counts": counts, "schema": schema.jsonValue(), "at": time.time()}
        return self.storage.create(f"_log/{based_on + 1:012d}.json", json.dumps(entry, sort_keys=True))

    def publish(self, df: DataFrame, operation: str, counts: dict[str, int] | None = None, add: bool = False, based_on: int | None = None, count: Callable[[], dict[str, int]] | None = None, unless: Callable[[dict[str, int]], bool] | None = None, schema: T.StructType | None = None) -> int:
        """Write ``df`` and make it current, instead of the old rows or (``add``) beside them.

        ``based_on`` is the version the rows were computed from (the current one, unless given); ``count`` gives the
        counts after the write, and where ``unless`` holds of them nothing is published.
        """
        schema = schema or self.schema
        start = self._state()[0] if based_on is None else based_on
        required = [f.name for f in schema.fields if not f.nullable]
        target = f"data-{uuid.uuid4().hex}"
        try:
            df.select(*schema.names).write.parquet(f"{self.root}/{target}")
            counts = counts if count is None else count()
            if unless and unless(counts or {}):
                self.storage.remove(target)
                return start
            if required:
                written = self.spark.read.schema(schema).parquet(f"{self.root}/{target}")
                broken = written.select(*(F.count_if(F.col(c).isNull()).alias(c) for c in required)).first().asDict()
                if any(broken.values()):
                    raise ValueError(f"null in required columns: {sorted(c for c, n in broken.items() if n)}")
            while not self._commit(start, [*(self._state()[1] if add else []), target], operation, counts or {}, schema):
                if not add:
                    raise ConcurrentChange(f"{self.root} has changed since version {start}")
                start = self._state()[0]
        except BaseException:
            self.storage.remove(target)
            raise
        return start + 1

    def append(self, df: DataFrame) -> int:
        """Add rows; an empty frame changes nothing."""
        if not self.exists():
            self.ensure()
        counted, counts = _counted(df.select(*self.schema.names), {})
        return self.publish(counted, "APPEND", add=True, count=lambda: {"inserted": counts()["rows"]}, unless=lambda c: not c["inserted"])

    def update(self, condition: Column, values: dict[str, Column]) -> int:
        """Set columns where the condition holds; without such a row nothing is published."""
        at, old = self._state()[0], self.read()
        hit = F.coalesce(condition, F.lit(False))
        counted, counts = _counted(old.withColumn("_hit", hit), {"updated": F.col("_hit")})
        new = counted.select(*(F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in self.schema.names))
        return self.publish(new, "UPDATE", based_on=at, count=counts, unless=lambda c: not c["updated"])

    def delete(self, condition: Column) -> int:
        at, old = self._state()[0], self.read()
        counted, counts = _counted(old.withColumn("_hit", F.coalesce(condition, F.lit(False))), {"deleted": F.col("_hit")})
        return self.publish(counted.filter(~F.col("_hit")), "DELETE", based_on=at, count=counts, unless=lambda c: not c["deleted"])

    def merge(self, source: DataFrame, key: str) -> dict[str, int]:
        """Type-1 merge (see ``merge_actions``); the counts of inserted, updated and stale rows, as the history has them.

        A merge that changes nothing publishes nothing, so unchanged rows keep their time stamps.
        """
        at, old = self._state()[0], self.read()
        kinds = {"inserted": F.col("action") == INSERT, "updated": F.col("action") == UPDATE, "stale": F.col("action") == STALE}
        actions, counts = _counted(merge_actions(old, source.select(*self.schema.names), key), kinds)
        self.publish(apply_merge(actions, self.schema.names), "MERGE", based_on=at, count=counts, unless=lambda c: not c["inserted"] + c["updated"])
        return counts()

    def add_columns(self, fields: list[T.StructField], backfill: dict) -> int:
        """Additive evolution: new columns with values computed from the old ones, null unless given."""
        at, old = self._state()[0], self.read()
        wider = T.StructType([*self.schema.fields, *fields])
        version = self.publish(old.select("*", *(backfill.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields)), "ADD COLUMNS", based_on=at, schema=wider)
        self.schema = wider
        return version

    def rename_to(self, root: str) -> VersionedTable:
        self.storage.move(str(root))
        return VersionedTable(self.spark, str(root), self.schema)

    def history(self) -> DataFrame:
        entries = [self._entry(v) for v in self.versions()]
        return self.spark.createDataFrame([(r["version"], r["operation"], r["counts"]) for r in entries], HISTORY)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove data folders that none of the newest ``keep`` versions names, and older versions; no writer may be at work."""
        kept = self.versions()[-keep:]
        named = {f for v in kept for f in self._entry(v)["folders"]}
        gone = [n for n in self.storage.names() if n.startswith("data-") and n not in named]
        for n in [*gone, *(f"_log/{v:012d}.json" for v in self.versions() if v not in kept)]:
            self.storage.remove(n)
        return gone


class BatchTable:
    """Rows partitioned by batch; a batch is replaced as a whole, schema may gain columns."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, batch: str = "_batch_id"):
        self.spark, self.root, self.schema, self.batch = spark, str(root), schema, batch
        self.storage = Storage(spark, self.root)

    def _write(self, df: DataFrame) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.batch).parquet(self.root)

    def replace(self, df: DataFrame, batch_id: str) -> int:
        """Replace the rows of one batch and count them; an empty frame removes the batch. Unsafe batch ids raise."""
        if not _BATCH.fullmatch(batch_id):
            raise ValueError(f"unsafe batch id {batch_id!r}")
        same = F.col(self.batch).eqNullSafe(F.lit(batch_id))
        checked = df.withColumn(self.batch, F.when(same, F.col(self.batch)).otherwise(F.raise_error(F.lit("rows of another batch"))))
        counted, counts = _counted(checked, {})
        self._write(counted)
        if not (n := counts()["rows"]):  # a dynamic overwrite without rows leaves the old ones
            self.storage.remove(f"{self.batch}={batch_id}")
        return n

    def replace_many(self, df: DataFrame, counts: dict[str, int]) -> None:
        """Replace the batches named in ``counts``, which gives the rows ``df`` has of each; a batch without rows is removed."""
        if unsafe := [b for b in counts if not _BATCH.fullmatch(b)]:
            raise ValueError(f"unsafe batch ids {unsafe}")
        self._write(df.select(*self.schema.names))
        for b, n in counts.items():
            if not n:
                self.storage.remove(f"{self.batch}={b}")

    def read(self, *batches: str, evolve: bool = False) -> DataFrame:
        """All rows, or those of some batches (pruned by folder). Ids of digits only stay text, as the schema says so."""
        if not any(n.startswith(f"{self.batch}=") for n in self.storage.names()):
            return self.spark.createDataFrame([], self.schema)
        schema = self.schema
        if evolve:
            seen = self.spark.read.option("mergeSchema", "true").parquet(self.root).schema
            known = set(schema.names)
            schema = T.StructType([*schema.fields, *(f for f in seen.fields if f.name not in known)])
        df = self.spark.read.schema(schema).parquet(self.root).select(*schema.names)
        return df.filter(F.col(self.batch).isin(*batches)) if batches else df

    def slice(self, batch_id: str, date: str, first: str | None = None, last: str | None = None) -> DataFrame:
        """The rows of one batch whose ``date`` lies within the bounds, both inclusive and each optional."""
        df = self.read(batch_id)
        df = df.filter(F.col(date) >= F.lit(first).cast("date")) if first else df
        return df.filter(F.col(date) <= F.lit(last).cast("date")) if last else df
