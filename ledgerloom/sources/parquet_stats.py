"""What columnar-file footers and dictionary pages tell about a chunk without decoding its data pages."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq

from ledgerloom.sources.storage import open_uri

_DICTIONARY_PAGE, _DATA_PAGES = 2, (0, 3)
_DICTIONARY_ENCODINGS = (2, 8)
_HEADER_BYTES = 512


class _Compact:
    """Reader for the few shapes of the compact thrift protocol that page headers use."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def byte(self) -> int:
        self.at += 1
        return self.data[self.at - 1]

    def varint(self) -> int:
        shift = value = 0
        while True:
            b = self.byte()
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7

    def value(self, kind: int):
        if kind in (1, 2):
            return kind == 1
        if kind == 3:
            return self.byte()
        if kind in (4, 5, 6):
            v = self.varint()
            return (v >> 1) ^ -(v & 1)
        if kind == 7:
            self.at += 8
            return None
        if kind == 8:
            n = self.varint()
            self.at += n
            return None
        if kind == 12:
            return self.struct()
        raise ValueError(f"unexpected thrift type {kind}")

    def struct(self) -> dict:
        found, last = {}, 0
        while True:
            head = self.byte()
            if head == 0:
                return found
            step = head >> 4
            if step:
                last += step
            else:
                v = self.varint()
                last = (v >> 1) ^ -(v & 1)
            found[last] = self.value(head & 15)


class _Window:
    """Reads a chunk's header regions in blocks, so that neighbouring page headers cost one request."""

    def __init__(self, f, end: int, block: int = 1 << 18):
        self.f, self.end, self.block, self.start, self.data = f, end, block, 0, b""

    def header(self, at: int) -> tuple[dict, int]:
        if not (self.start <= at and min(at + _HEADER_BYTES, self.end) <= self.start + len(self.data)):
            self.start, self.data = at, self.f.read_at(min(self.block, max(self.end - at, _HEADER_BYTES)), at)
        r = _Compact(self.data[at - self.start : at - self.start + _HEADER_BYTES])
        return r.struct(), at + r.at


def dictionary_values(f, chunk: pq.ColumnChunkMetaData, max_bytes: int = 1 << 20) -> list[bytes] | None:
    """All distinct values of a byte-array chunk from its dictionary page, or None if they are not known from it.

    The headers of the data pages are walked to make sure that each page is dictionary-encoded; their data stay
    unread. A dictionary above ``max_bytes`` is left to the scan.
    """
    if not chunk.has_dictionary_page or chunk.physical_type != "BYTE_ARRAY":
        return None
    try:
        at = chunk.dictionary_page_offset
        end = at + chunk.total_compressed_size
        window = _Window(f, end)
        head, body = window.header(at)
        if head.get(1) != _DICTIONARY_PAGE or head[2] > max_bytes:
            return None
        raw = f.read_at(head[3], body)
        if chunk.compression != "UNCOMPRESSED":
            raw = pa.Codec(chunk.compression.lower()).decompress(raw, head[2], asbytes=True)
        seen, at = 0, body + head[3]
        while at < end and seen < chunk.num_values:
            page, start = window.header(at)
            if page.get(1) not in _DATA_PAGES:
                return None
            data = page.get(5) or page.get(8)
            if data[2 if 5 in page else 4] not in _DICTIONARY_ENCODINGS:
                return None
            seen += data[1]
            at = start + page[3]
        if seen != chunk.num_values:
            return None
        values, p = [], 0
        for _ in range(head[7][1]):
            n = int.from_bytes(raw[p : p + 4], "little")
            values.append(raw[p + 4 : p + 4 + n])
            p += 4 + n
        return values
    except (ValueError, KeyError, IndexError, TypeError, OSError, pa.ArrowException):
        return None  # anything unusual is left to the scan


@dataclass
class Chunk:
    first_row: int
    rows: int
    nulls: dict[str, int | None]
    constant: dict[str, str | None]  # the only value of a chunk without nulls
    values: dict[str, list[str] | None]  # all distinct non-null values
    bounds: dict[str, tuple[str, str] | None] = field(default_factory=dict)  # least and greatest value of typed columns, as text


def _as_text(value) -> str | None:
    """A footer's bound as Spark's cast to text spells it; None for kinds whose spelling or order is not the same."""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, int) or type(value) is dt.date:
        return str(value)
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return value.isoformat(" ").rstrip("0").rstrip(".") if value.microsecond else value.isoformat(" ")
    return None


def chunks(uri: str, columns: list[str], decode: list[str], typed: list[str] = []) -> list[Chunk]:  # noqa: B006
    """Per row group of a file: exact nulls, constants and dictionary values of string ``columns`` where they are valid, and
    nulls and bounds of ``typed`` columns."""
    out, first = [], 0
    with open_uri(uri) as f:
        meta = pq.ParquetFile(f).metadata
        place = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            rg = meta.row_group(g)
            c = Chunk(first, rg.num_rows, {}, {}, {})
            first += rg.num_rows
            for name in columns:
                c.nulls[name] = c.constant[name] = c.values[name] = None
                if name not in place:
                    c.nulls[name] = rg.num_rows
                    c.values[name] = []
                    continue
                chunk = rg.column(place[name])
                s = chunk.statistics
                if s is not None and s.has_null_count:
                    c.nulls[name] = s.null_count
                    # short equal bounds cannot be truncated ones
                    if s.null_count == 0 and s.has_min_max and s.min == s.max and isinstance(s.min, str) and len(s.min) < 48:
                        c.constant[name] = s.min
                if name in decode and c.nulls[name] is not None:
                    if c.nulls[name] == rg.num_rows:
                        c.values[name] = []
                    elif c.constant[name] is not None:
                        c.values[name] = [c.constant[name]]
                    elif (v := dictionary_values(f, chunk)) is not None:
                        c.values[name] = [x.decode("utf-8", "replace") for x in v]
            for name in typed:
                s = rg.column(place[name]).statistics if name in place else None
                c.nulls[name] = rg.num_rows if name not in place else s.null_count if s is not None and s.has_null_count else None
                lo, hi = (_as_text(s.min), _as_text(s.max)) if s is not None and s.has_min_max else (None, None)
                c.bounds[name] = None if lo is None or hi is None else (lo, hi)
            out.append(c)
    return out
