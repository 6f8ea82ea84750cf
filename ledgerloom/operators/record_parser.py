"""Rows that fail to parse: bulk block parsing with bisection down to the bad records.

Method: blocks of records are parsed as wholes on a fast path (csv: one match of the block's joined text, then one
columnar parse of all blocks that passed; JSON: one parse of the block as an array). A block that fails is bisected
until the bad records stand alone; those, and only those, go through a strict single-record parser that names the
violation. Whether a block passes is a property of its records, so results do not depend on how they are cut.
"""

from __future__ import annotations

import functools
import io
import json
import re
import secrets
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUOTING, COLUMN_COUNT, JSON = "QUOTING", "COLUMN_COUNT", "JSON"
UNKNOWN_DATASET, UNKNOWN_FORMAT = "UNKNOWN_DATASET", "UNKNOWN_FORMAT"
#: Separates the records of a joined csv block. No field may contain it there; a record that does is parsed alone.
_BETWEEN = "\x1e"


@functools.lru_cache(maxsize=64)
def csv_grammar(width: int) -> re.Pattern:
    """A block of records of ``width`` fields, each record followed by the separator: quotes only around whole fields,
    doubled inside; line breaks only inside quotes. Possessive: nothing is read twice."""
    field = rf'(?:"[^"{_BETWEEN}]*+(?:""[^"{_BETWEEN}]*+)*+"|[^",\r\n{_BETWEEN}]*+)'
    return re.compile(rf"(?:{field}(?:,{field}){{{width - 1}}}{_BETWEEN})*+")


def strict_csv(record: str) -> list[str] | None:
    """Fields of one record, or None if it violates the quoting."""
    fields, i, n = [], 0, len(record)
    while True:
        if i < n and record[i] == '"':
            parts, i = [], i + 1
            while True:
                j = record.find('"', i)
                if j < 0:
                    return None
                parts.append(record[i:j])
                if record[j + 1 : j + 2] == '"':
                    parts.append('"')
                    i = j + 2
                    continue
                i = j + 1
                break
            fields.append("".join(parts))
            if i < n and record[i] != ",":
                return None
        else:
            j = record.find(",", i)
            j = n if j < 0 else j
            value = record[i:j]
            if any(c in value for c in '"\r\n'):
                return None
            fields.append(value)
            i = j
        if i >= n:
            return fields
        i += 1


def _refuse(text: str):
    raise ValueError(text)


def _loads(text: str):
    return json.loads(text, parse_int=str, parse_float=str, parse_constant=_refuse)


def strict_json(record: str) -> dict | None:
    """The object of one RFC 8259 text, numbers as their text; None if it is no valid object."""
    try:
        value = _loads(record)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _text(value) -> str | None:
    if value is None or type(value) is str:
        return value
    return json.dumps(value, ensure_ascii=False)


def _texts(values: list[str | None]) -> pa.Array:
    """A text column; unpaired surrogates, which JSON escapes can give but UTF-8 cannot hold, become U+FFFD."""
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:
        return pa.array([v and re.sub("[\ud800-\udfff]", "\ufffd", v) for v in values], pa.string())


def csv_passes(records: list[str], width: int) -> bool:
    """Whether each record of the block obeys the grammar with ``width`` fields.

    The separator stands only between records and is part of no field, so a match proves each record on its own.
    """
    text = _BETWEEN.join(records) + _BETWEEN
    return text.count(_BETWEEN) == len(records) and csv_grammar(width).fullmatch(text) is not None


def csv_columns(records: list[str], width: int) -> list[pa.Array] | None:
    """Columns of records that obey the grammar, or None if the columnar reader refuses them."""
    if width == 1:  # the reader takes an empty line for no row
        return [pa.array([r[1:-1].replace('""', '"') if r[:1] == '"' else r for r in records], pa.string())]
    names = [f"f{k}" for k in range(width)]
    data = "\n".join([",".join(names), *records]).encode()  # the header keeps the reader from taking off a record's byte-order mark
    try:
        t = pacsv.read_csv(
            io.BytesIO(data),
            read_options=pacsv.ReadOptions(use_threads=False, block_size=len(data) + 64),
            parse_options=pacsv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False),
            convert_options=pacsv.ConvertOptions(column_types={n: pa.string() for n in names}, strings_can_be_null=False),
        )
    except pa.ArrowInvalid:
        return None
    return [c.combine_chunks() for c in t.columns] if t.num_rows == len(records) and t.num_columns == width else None


def json_block(records: list[str]) -> list[dict] | None:
    """The objects of a block, or None if any record is not exactly one object.

    The records are parsed as one array with a separator between them that is drawn anew for each parse. No record can
    spell it, so finding it at every second place of the array proves that each record is one value of its own.
    """
    separator = secrets.token_hex(16)
    try:
        values = _loads("[" + f',"{separator}",'.join(records) + "]")
    except (ValueError, RecursionError):
        return None
    objects = values[::2]
    if len(values) != 2 * len(records) - 1 or any(v != separator for v in values[1::2]) or any(type(o) is not dict for o in objects):
        return None
    return objects


def _rows(columns: list[pa.Array], n: int) -> pa.ListArray:
    """Columns to one list per row, without a Python loop over rows."""
    k = len(columns)
    order = (np.arange(n)[:, None] + np.arange(k) * n).ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k), pa.int32()), pa.concat_arrays(columns).take(pa.array(order)))


def _bisect(lo: int, hi: int, passes: Callable[[int, int], bool], alone: Callable[[int], None]) -> Iterator[tuple[int, int]]:
    """Blocks of [lo, hi) that pass, in order; what cannot be split further is handed to ``alone``."""
    if passes(lo, hi):
        yield lo, hi
    elif hi - lo == 1:
        alone(lo)
    else:
        mid = (lo + hi) // 2
        yield from _bisect(lo, mid, passes, alone)
        yield from _bisect(mid, hi, passes, alone)


def parse_group(records: pa.Array, fmt: str, layout: list[str], block: int) -> tuple[list[str | None], pa.ListArray]:
    """Structure error (or None) and fields of each record of one format and layout; fields of bad records are null.

    A csv block passes if its joined text obeys the grammar; all passing blocks are then parsed at once by columns, and
    halved if the columnar reader refuses them. A JSON block's parse is its test.
    """
    n, width = len(records), len(layout)
    texts = records.fill_null("").to_pylist()
    errors: list[str | None] = [None] * n
    kind = pa.list_(pa.string())
    places: list[np.ndarray] = []
    pieces: list[pa.Array] = []

    def keep(at: np.ndarray, fields: pa.Array) -> None:
        places.append(at)
        pieces.append(fields)

    def alone(i: int) -> None:
        if fmt == "csv":
            fields = strict_csv(texts[i])
            if fields is not None and len(fields) == width:
                keep(np.array([i]), pa.array([fields], kind))
                return
            errors[i] = QUOTING if fields is None else COLUMN_COUNT
        else:
            value = strict_json(texts[i])
            if value is not None:
                keep(np.array([i]), _rows([_texts([_text(value.get(name))]) for name in layout], 1))
                return
            errors[i] = JSON
        keep(np.array([i]), pa.array([None], kind))

    if fmt == "csv":

        def columnar(at: np.ndarray) -> None:
            columns = csv_columns([texts[i] for i in at], width)
            if columns is not None:
                keep(at, _rows(columns, len(at)))
            elif len(at) == 1:
                alone(int(at[0]))
            else:
                columnar(at[: len(at) // 2])
                columnar(at[len(at) // 2 :])

        passed = [p for lo in range(0, n, block) for p in _bisect(lo, min(n, lo + block), lambda a, b: csv_passes(texts[a:b], width), alone)]
        if passed:
            columnar(np.concatenate([np.arange(a, b) for a, b in passed]))
    elif fmt == "json":
        parsed: dict[tuple[int, int], list[dict]] = {}

        def passes(a: int, b: int) -> bool:
            objects = json_block(texts[a:b])
            if objects is not None:
                parsed[a, b] = objects
            return objects is not None

        passed = [p for lo in range(0, n, block) for p in _bisect(lo, min(n, lo + block), passes, alone)]
        if passed:
            objects = [o for p in passed for o in parsed[p]]
            columns = [_texts([v if (v := o.get(name)) is None or type(v) is str else _text(v) for o in objects]) for name in layout]
            keep(np.concatenate([np.arange(a, b) for a, b in passed]), _rows(columns, len(objects)))
    else:
        raise ValueError(f"unknown record format: {fmt}")
    if not n:
        return errors, pa.array([], kind)
    back = np.empty(n, np.int64)
    back[np.concatenate(places)] = np.arange(n)
    return errors, pa.concat_arrays(pieces).take(pa.array(back))


def parse_batches(batches: Iterator[pa.RecordBatch], layouts: dict[str, list[str]], block: int, schema: pa.Schema, keep: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.string())
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        groups = pc.binary_join_element_wise(batch.column(keep + 1).fill_null(""), batch.column(keep).fill_null(""), "\n").to_numpy(zero_copy_only=False)
        errors = np.empty(n, object)
        order, pieces = [], []
        for g in np.unique(groups.astype(str)):
            at = np.flatnonzero(groups == g)
            fmt, dataset = g.split("\n", 1)
            if dataset in layouts and fmt in ("csv", "json"):
                found, fields = parse_group(batch.column(keep + 2).take(pa.array(at)), fmt, layouts[dataset], block)
            else:
                found, fields = UNKNOWN_FORMAT if dataset in layouts else UNKNOWN_DATASET, pa.nulls(len(at), kind)
            errors[at] = found
            order.append(at)
            pieces.append(fields)
        back = np.empty(n, np.int64)
        back[np.concatenate(order)] = np.arange(n)
        fields = pa.concat_arrays(pieces).take(pa.array(back)).cast(kind)
        yield pa.RecordBatch.from_arrays([*batch.columns[:keep], batch.column(keep), pa.array(errors.tolist(), pa.string()), fields], schema=schema)


def parse_records(df: DataFrame, keep: list[str], dataset: str, record_format: str, record: str, layouts: dict[str, list[str]], block: int = 64) -> DataFrame:
    """``keep`` columns, dataset, ``structure`` (null, QUOTING, COLUMN_COUNT, JSON, UNKNOWN_DATASET or UNKNOWN_FORMAT) and ``fields`` (array in layout order).

    One input row is one record. A null record counts as an empty text: COLUMN_COUNT for csv, JSON for json. Records
    of a null or unknown dataset or format are not parsed: UNKNOWN_DATASET, else UNKNOWN_FORMAT. Unpaired surrogates of
    JSON escapes become U+FFFD. Repeated rows are parsed each; absent JSON keys and JSON null are null
    fields, other JSON values count as their text, unknown keys are ignored; an empty frame gives an empty frame.
    Columns that are not kept are ignored, whatever their names; kept ones named like the added ones raise.
    """
    if clash := {"dataset", "structure", "fields", "_format", "_record"} & {*keep} - {dataset}:
        raise ValueError(f"columns to keep must not be named {sorted(clash)}")
    keep = [c for c in keep if c != "dataset"]
    narrow = df.select(*keep, F.col(dataset).alias("dataset"), F.lower(F.col(record_format)).alias("_format"), F.col(record).alias("_record"))
    out = narrow.select(*keep, "dataset", F.lit("").alias("structure"), F.array().cast("array<string>").alias("fields")).schema
    for f in out.fields:
        f.nullable = True
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)
    schema = schema.set(len(schema) - 1, pa.field("fields", pa.list_(pa.string())))
    work: Callable = lambda it: parse_batches(it, layouts, block, schema, len(keep))
    return narrow.mapInArrow(work, out)
