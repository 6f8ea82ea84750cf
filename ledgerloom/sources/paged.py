"""Remote sources behind a pluggable transport: bulk snapshots, paged date windows and a Python data source."""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from urllib.parse import urlencode, urlparse

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerloom.operators.control import PAGE_ROWS
from ledgerloom.operators.versioned import write_json_atomically

SKIPPED = "SKIPPED_ALREADY_ACQUIRED"
#: url -> body; raises OSError on failures worth another try.
Transport = Callable[[str], bytes]
#: url -> (announced length or None, blocks of the body); raises OSError likewise.
Stream = Callable[[str], tuple[int | None, Iterator[bytes]]]


def retry(work: Callable, tries: int = 4, sleep: Callable[[float], None] = time.sleep):
    """Try again after 1, 2, 4, ... seconds; the last failure is raised."""
    for n in range(tries):
        try:
            return work()
        except OSError:
            if n == tries - 1:
                raise
            sleep(2.0**n)
    raise AssertionError("unreachable")


def http_stream(url: str, block: int = 1 << 20) -> tuple[int | None, Iterator[bytes]]:
    """A body over HTTP in blocks."""
    from urllib.request import Request, urlopen

    response = urlopen(Request(url, headers={"Accept-Encoding": "identity"}), timeout=300)
    length = response.headers.get("Content-Length")
    return (int(length) if length else None), iter(lambda: response.read(block), b"")


def download(get: Stream, url: str, part: Path) -> tuple[str, int]:
    """Write a body to ``part`` as it comes: (digest, bytes). An empty body or one shorter than announced raises OSError."""
    length, blocks = get(url)
    digest, size = hashlib.sha256(), 0
    with open(part, "wb") as f:
        for block in blocks:
            f.write(block)
            digest.update(block)
            size += len(block)
    if not size or (length is not None and size < length):
        raise OSError(f"{url}: {size} of {length} bytes")
    return digest.hexdigest(), size


def batch_id(dataset: str, load_type: str, source: str, digest: str) -> str:
    return hashlib.sha256("|".join((dataset, load_type, source, digest)).encode()).hexdigest()[:24]


def csv_distribution(item: dict) -> str:
    """The first https distribution that says it is csv."""
    for d in item.get("distribution") or []:
        url = d.get("downloadURL") or (d.get("data") or {}).get("downloadURL") or ""
        said = " ".join(str(x).lower() for x in (d.get("mediaType"), d.get("format"), urlparse(url).path))
        if urlparse(url).scheme == "https" and "csv" in said:
            return url
    raise ValueError("no csv distribution")


def page_url(base: str, dataset_id: str, offset: int, column: str | None = None, start: str | None = None, end: str | None = None, rows: int = PAGE_ROWS) -> str:
    """Offset paging with the date range pushed to the service."""
    query: list[tuple[str, str]] = [("limit", str(rows)), ("offset", str(offset))]
    for i, (value, op) in enumerate((v, o) for v, o in ((start, ">="), (end, "<=")) if v):
        query += [(f"conditions[{i}][property]", column or ""), (f"conditions[{i}][operator]", op), (f"conditions[{i}][value]", value)]
    return f"{base}/{dataset_id}/0?{urlencode(query)}"


def fetch_bulk(get: Stream, item: dict, folder: str, dataset: str, known: Iterable[dict] = (), force: bool = False, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Download the csv of a catalogue item once, in blocks; the file appears whole or not at all.

    ``known`` are the manifest rows of earlier deliveries of the dataset. An unchanged publication (same url and date of
    change) whose file is still there is not downloaded; content that is known is downloaded, but not kept twice. Both
    are SKIPPED_ALREADY_ACQUIRED with the path they have, unless ``force``.
    """
    url, modified = csv_distribution(item), item.get("modified")
    facts = {"url": url, "modified": modified}
    there = [r for r in known if r.get("path") and Path(r["path"]).is_file()] if not force else []
    for r in there:
        if (r.get("url"), r.get("modified")) == (url, modified) and modified:
            return facts | {k: r[k] for k in ("sha256", "bytes", "path")} | {"status": SKIPPED, "batch_id": batch_id(dataset, "full", url, r["sha256"])}
    target = Path(folder) / (Path(urlparse(url).path).name or f"{dataset}.csv")
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(f".{target.name}.{uuid.uuid4().hex}.part")
    try:
        digest, size = retry(lambda: download(get, url, part), 3, sleep)
        facts |= {"sha256": digest, "bytes": size, "batch_id": batch_id(dataset, "full", url, digest)}
        for r in there:
            if r["sha256"] == digest:
                return facts | {"status": SKIPPED, "path": r["path"]}
        final = target.with_name(f"{target.stem}_{digest[:12]}{target.suffix or '.csv'}")
        os.replace(part, final)
        return facts | {"status": "SUCCESS", "path": str(final)}
    finally:
        part.unlink(missing_ok=True)


def fetch_window(get: Transport, base: str, spec, folder: str, start: str, end: str, rows: int = PAGE_ROWS) -> list[dict]:
    """All pages of a date window as files. A changed total, a repeated page or fewer rows than announced raises; then no
    file is left behind."""
    out: list[dict] = []
    seen: set[str] = set()
    total = None
    try:
        while total is None or len(out) * rows < total:
            url = page_url(base, spec.dataset_id, len(out) * rows, spec.watermark, start, end, rows)
            page = json.loads(retry(lambda url=url: get(url)))
            if total is not None and page["count"] != total:
                raise ValueError("the number of rows changed between pages")
            total = page["count"]
            content = hashlib.sha256(json.dumps(page["results"], sort_keys=True).encode()).hexdigest()
            if content in seen and page["results"]:
                raise ValueError("a page came twice")
            seen.add(content)
            meta = {"dataset_id": spec.dataset_id, "filter": f"{spec.watermark} >= {start} AND {spec.watermark} <= {end}", "rows_available": total, "rows_in_file": len(page["results"]), "load_type": "incremental"}
            path = Path(folder) / f"page_{len(out):04d}.json"
            write_json_atomically(path, {"_meta": meta, "results": page["results"]})
            out.append({"path": str(path), "offset": len(out) * rows, "rows": len(page["results"]), "total": total, "batch_id": batch_id(spec.name, "incremental", url, content)})
            if len(page["results"]) < rows:
                break
        if (got := sum(item["rows"] for item in out)) != total:
            raise ValueError(f"the service announced {total} rows and gave {got}")
    except BaseException:
        for item in out:
            Path(item["path"]).unlink(missing_ok=True)
        raise
    return out


class _Page(InputPartition):
    def __init__(self, offset: int, total: int):
        super().__init__(offset)
        self.offset, self.total = offset, total


class _PageReader(DataSourceReader):
    def __init__(self, schema, options):
        self.names, self.options, self.rows = schema.names, options, int(options.get("rows", PAGE_ROWS))

    def _get(self, offset: int) -> dict:
        where = self.options["base"]
        if where.startswith("file:"):  # a folder of pages named by offset stands in for the service
            with open(f"{urlparse(where).path}/{offset}.json", encoding="utf-8") as f:
                return json.load(f)
        from urllib.request import urlopen

        url = page_url(where, self.options["dataset_id"], offset, self.options.get("column"), self.options.get("start"), self.options.get("end"), self.rows)
        return json.loads(retry(lambda: urlopen(url, timeout=120).read()))

    def partitions(self) -> list[InputPartition]:
        total = int(self._get(0)["count"])
        return [_Page(o, total) for o in range(0, max(total, 1), self.rows)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        """The rows of one page, which must hold what the total that all pages were planned by leaves for it."""
        page = self._get(partition.offset)
        want = min(self.rows, partition.total - partition.offset)
        if int(page["count"]) != partition.total or len(page["results"]) != max(want, 0):
            raise ValueError(f"page at {partition.offset}: {len(page['results'])} rows of a total of {page['count']}, {want} of {partition.total} were planned")
        for r in page["results"]:
            yield tuple(None if r.get(n) is None else str(r[n]) for n in self.names)


class PagedSource(DataSource):
    """spark.dataSource.register(PagedSource); spark.read.format("paged_api").schema(...).options(base=..., dataset_id=...).load()"""

    @classmethod
    def name(cls) -> str:
        return "paged_api"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(schema, self.options)
