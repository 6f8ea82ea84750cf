"""Schemas that drift between files.

Method: every row is loaded as a map from path (normalised field name) to raw value with its raw type; type statistics
per path are aggregated by file; files of a feed are compared with their predecessors on those statistics; typed columns
are then projected from the maps, with a report of the values that failed their cast.

The maps live in Arrow batches: a batch is parsed once, and what leaves it are counts per file and field (the scan),
tokens of the few fields that came or went (the renamings) or the projected columns (the consistent table). Rows are
never shuffled.
"""

from __future__ import annotations

import functools
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from datetime import date

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.values import blank_to_null
from ledgerloom.session import bounded_broadcast, cut_lineage

ADDED, MISSING, RENAMED, TYPE_FAILURE = "ADDED_COLUMN", "MISSING_COLUMN", "RENAMED_OR_UNMAPPED_COLUMN", "TYPE_VALUE_FAILURE"
UNREADABLE, SURPLUS, SHORT, NO_HEADER, UNNAMED, UNLISTED = "UNREADABLE_RECORD", "SURPLUS_VALUES", "MISSING_VALUES", "NO_HEADER", "UNNAMED_FIELD", "NOT_IN_MANIFEST"
UNPLACED = "NO_PLACE_IN_FILE"
#: One field of a csv record followed by its comma; possessive, so that long fields need no backtracking.
_CSV_FIELD = r'("[^"]*+(?:""[^"]*+)*+"|[^,]*+),'
_NUMBER_LIKE = r"^[-+]?[0-9.][-+.0-9eE]*\z"
KINDS = ("date", "int", "double", "decimal(14,2)", "boolean")
#: Raw types that can be read as each kind.
_READS = {"date": ("date",), "int": ("int",), "double": ("int", "decimal", "double"), "decimal(14,2)": ("int", "decimal"), "boolean": ("flag",)}
#: Places of the rows of a scan that are no csv field; the name of a header row is its text.
_HEADER, _UNREADABLE, _ROWS = -3, -2, -1
_SCAN = "path string, pos int, name string, rows bigint, present bigint, " + ", ".join(f"k{i} bigint" for i in range(len(KINDS)))


# ---- values and records in a batch --------------------------------------------------------------------------------------

_NAME, _FIELD = re.compile("[^a-z0-9]+"), re.compile(_CSV_FIELD)
_DAY, _NUMBER, _WHOLE = re.compile(r"\d{4}-\d{2}-\d{2}", re.A), re.compile(r"[-+]?[0-9.][-+.0-9eE]*"), re.compile(r"[-+]?[0-9]+")
_CENT, _LIMIT = Decimal("0.01"), Decimal(10) ** 12


@functools.lru_cache(maxsize=100_000)
def plain_name(name: str) -> str:
    """``field_name`` of one text."""
    return _NAME.sub("_", name.lower()).strip("_")


def split_csv(record: str) -> list[str]:
    """``csv_fields`` of one text."""
    if '"' not in record:
        return record.split(",")
    return [f[1:-1].replace('""', '"') if len(f) > 1 and f[0] == '"' else f for f in _FIELD.findall(record + ",")]


def _refuse(text: str):
    raise ValueError(text)


_json = json.JSONDecoder(parse_int=str, parse_float=str, parse_constant=_refuse)


def json_fields(record: str) -> dict | None:
    """The fields of one JSON object, numbers as their text; None for anything else."""
    try:
        value = _json.decode(record)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _text(value) -> str | None:
    return value if value is None or type(value) is str else json.dumps(value, ensure_ascii=False)


def raw_type(value: str) -> str:
    """Raw type of a trimmed, non-blank text: flag, date, int, decimal, double or text, each the narrowest it reads as."""
    if value in ("Y", "N", "y", "n"):
        return "flag"
    if not "+" <= value[0] <= "9":
        return "text"
    if _DAY.fullmatch(value):
        try:
            date.fromisoformat(value)
        except ValueError:
            return "text"
        return "date"
    if not _NUMBER.fullmatch(value):
        return "text"
    if _WHOLE.fullmatch(value) and -(2**31) <= int(value) < 2**31:
        return "int"
    try:
        float(value)
        return "decimal" if abs(Decimal(value).quantize(_CENT, "ROUND_HALF_UP")) < _LIMIT else "double"
    except InvalidOperation:  # beyond the digits a decimal can have
        return "double"
    except ValueError:
        return "text"


_KIND_BITS = {raw: tuple(i for i, k in enumerate(KINDS) if raw in _READS[k]) for raw in ("flag", "date", "int", "decimal", "double", "text")}


class _Types(dict):
    """Kinds each text can be read as, None for a blank one; forgets all beyond a bound."""

    def __missing__(self, value: str) -> tuple[int, ...] | None:
        if len(self) > 500_000:
            self.clear()
        v = value.strip(" ")
        found = self[value] = _KIND_BITS[raw_type(v)] if v else None
        return found


# Spellings of flags and of months in values whose format changed.
_FLAGS = {"y": "1", "yes": "1", "true": "1", "n": "0", "no": "0", "false": "0"}
_MONTHS = {m: str(i + 1) for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
_DATE_LIKE = re.compile(r"\d{1,4}[-/. ]\d{1,2}[-/. ]\d{1,4}|[a-z]{3,9}\.? \d{1,2},? \d{4}|\d{1,2}\.? [a-z]{3,9}\.?,? \d{4}")
_AMOUNT_LIKE = re.compile(r"[^\w\s+-]{0,2}([-+]?\d[\d.,]*)\s*(?:%|[a-z]{1,8})?|(?:[a-z]{1,8}\.?\s+)([-+]?\d[\d.,]*)")


@functools.lru_cache(maxsize=200_000)
def same_value(text: str) -> str:
    """Equal for spellings of one value: letters and digits ignoring case, numbers without currency, unit and separators, dates in any order of their parts, flags."""
    v = text.strip(" ").lower()
    if v in _FLAGS:
        return _FLAGS[v]
    if _DATE_LIKE.fullmatch(v):
        parts = [_MONTHS.get(p[:3], p) if p.isalpha() else p.lstrip("0") for p in re.findall(r"[a-z]+|\d+", v)]
        return "/".join(sorted(parts))
    if m := _AMOUNT_LIKE.fullmatch(v):
        return re.sub(r"[.,]", "", m[1] or m[2]).lstrip("+")
    return re.sub(r"[\W_]+", "", v)


# ---- column versions ------------------------------------------------------------------------------------------------------


def field_name(c: Column) -> Column:
    """Lower case, runs of other characters than a-z and 0-9 made one underscore, ends trimmed."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def csv_fields(record: Column) -> Column:
    """array<string> of the fields of one csv record, quotes taken off."""
    raw = F.regexp_extract_all(F.concat(record, F.lit(",")), F.lit(_CSV_FIELD), F.lit(1))
    bare = lambda f: F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))
    return F.transform(raw, lambda f: F.when(f.startswith('"') & (F.length(f) >= 2), bare(f)).otherwise(f))


def reads_as(value: Column, kind: str) -> Column:
    """Whether a trimmed, non-blank text can be read as ``kind``: flags are Y or N, dates real YYYY-MM-DD days."""
    if kind == "boolean":
        return F.upper(value).isin("Y", "N")
    if kind == "date":
        return value.rlike(r"^\d{4}-\d{2}-\d{2}\z") & value.try_cast("date").isNotNull()
    return value.rlike(_NUMBER_LIKE) & value.try_cast(kind).isNotNull()  # the pattern spares casts that would only fail


def read_typed(value: Column, kind: str | None) -> Column:
    if kind is None:
        return value
    if kind == "boolean":
        return F.when(F.upper(value) == "Y", True).when(F.upper(value) == "N", False)
    return F.when(reads_as(value, kind), value).try_cast(kind)


# ---- the scan -------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Landing:
    """Landed records (path, row_no, record) with the counts of one scan over them; ``every`` holds those of no file too."""

    rows: DataFrame
    scanned: DataFrame
    every: DataFrame


def _is_csv(path: str) -> bool:
    return path[-4:].lower() == ".csv"


def _count_file(path: str, rows: list[tuple], types: _Types, out: list[tuple]) -> None:
    """Append the scan rows of the records (row_no, record) of one file in one batch."""
    none = (0,) * len(KINDS)

    def count(pos: int | None, name: str | None, n: int, values: Counter) -> None:
        present, kinds = 0, [0] * len(KINDS)
        for v, k in values.items():
            if v is not None and (bits := types[v]) is not None:
                present += k
                for i in bits:
                    kinds[i] += k
        out.append((path, pos, name, n, present, *kinds))

    body = [r for n, r in rows if n != 0] if _is_csv(path) else [r for _, r in rows]
    if _is_csv(path):
        out += [(path, _HEADER, r, 0, 0, *none) for n, r in rows if n == 0 and r is not None]
        parsed = [split_csv(r) for r in body if r is not None]
        width = max(map(len, parsed), default=0)
        for pos in range(width):
            column = [r[pos] for r in parsed if len(r) > pos]
            count(pos, None, len(column), Counter(column))
    else:
        objects = [o for r in body if r is not None and (o := json_fields(r)) is not None]
        parsed = objects
        columns: dict[str, list] = {}
        for o in objects:
            for k, v in o.items():
                columns.setdefault(k, []).append(v if type(v) is str else _text(v))
        for k, column in columns.items():
            count(None, plain_name(k), len(column), Counter(column))
    out.append((path, _ROWS, None, len(parsed), 0, *none))
    if len(parsed) < len(body):
        out.append((path, _UNREADABLE, None, len(body) - len(parsed), 0, *none))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = _Types()
    kinds = [pa.string(), pa.int32(), pa.string(), *[pa.int64()] * (2 + len(KINDS))]
    names = [c.split()[0] for c in _SCAN.split(", ")]
    for batch in batches:
        files: dict[str, list[tuple]] = {}
        for p, n, r in zip(*(c.to_pylist() for c in batch.columns)):
            files.setdefault(p, []).append((n, r))
        out: list[tuple] = []
        for p, rows in files.items():
            _count_file(p, rows, types, out)
        columns = zip(*out) if out else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def land(records: DataFrame, path: str, row_no: str, record: str) -> Landing:
    """Scan landed records: counts per file and field, in one pass without a shuffle of rows.

    ``records`` holds one record per row; csv files have their header in row 0, other files hold one JSON object per row.
    Null paths and rows before a header belong to no file and are left out of the scan; ``every`` keeps them for
    ``whole_table``. Null and unreadable records are counted as such.
    Other columns are ignored, whatever their names; an empty frame gives an empty scan.
    """
    every = records.select(F.col(path).alias("path"), F.col(row_no).alias("row_no"), F.col(record).alias("record"))
    rows = every.filter("path IS NOT NULL").filter(~F.lower("path").endswith(".csv") | F.coalesce(F.col("row_no") >= 0, F.lit(True)))
    counts = ["rows", "present", *(f"k{i}" for i in range(len(KINDS)))]
    parts = rows.mapInArrow(_scan_batches, _SCAN)
    return Landing(rows, cut_lineage(parts.groupBy("path", "pos", "name").agg(*(F.sum(c).alias(c) for c in counts))), every)


def headers(landing: Landing) -> DataFrame:
    """(path, names): the normalised header of each csv file; of several rows 0 of a file the least text counts."""
    first = landing.scanned.filter(F.col("pos") == _HEADER).groupBy("path").agg(F.min("name").alias("header"))
    return first.select("path", F.transform(csv_fields(F.col("header")), field_name).alias("names"))


def path_statistics(landing: Landing) -> DataFrame:
    """(path, name, rows, present, k0...): per file and field the rows, non-blank values and how many read as each kind.

    The fields of a csv file are those of its header, with or without data rows; of equal names the first counts.
    Nameless fields are none (see ``reading_problems``); JSON keys that are normalised alike are added up.
    """
    counts = ["rows", "present", *(f"k{i}" for i in range(len(KINDS)))]
    placed = headers(landing).select("path", F.posexplode("names").alias("pos", "name")).filter("name <> ''").groupBy("path", "name").agg(F.min("pos").alias("pos"))
    cells = landing.scanned.filter("pos >= 0").select("path", "pos", *counts)
    csv_stats = placed.join(cells, ["path", "pos"], "left").fillna(0, counts).select("path", "name", *counts)
    return csv_stats.unionByName(landing.scanned.filter("pos IS NULL AND name <> ''").select("path", "name", *counts))


def reading_problems(landing: Landing, files: DataFrame) -> DataFrame:
    """(path, problem, rows): what could not be read as it stands, with the number of rows concerned.

    UNREADABLE_RECORD: null or no JSON object; SURPLUS_VALUES and MISSING_VALUES: csv rows longer or shorter than their
    header; NO_HEADER: csv rows of a file without row 0; UNNAMED_FIELD: rows of a field without a name; NOT_IN_MANIFEST.
    """
    s, heads = landing.scanned, headers(landing)
    total = s.filter(F.col("pos") == _ROWS).select("path", F.col("rows").alias("total"))
    is_csv = F.lower("path").endswith(".csv")
    bare = total.filter(is_csv & (F.col("total") > 0)).join(heads, "path", "left_anti").select("path", F.lit(NO_HEADER).alias("problem"), F.col("total").alias("rows"))
    unreadable = s.filter(F.col("pos") == _UNREADABLE).select("path", F.lit(UNREADABLE).alias("problem"), "rows")
    width = heads.select("path", F.size("names").alias("width"), F.posexplode("names").alias("pos", "name"))
    cells = s.filter("pos >= 0").select("path", "pos", "rows")
    beyond = cells.join(heads.select("path", F.size("names").alias("pos")), ["path", "pos"]).select("path", F.lit(SURPLUS).alias("problem"), "rows")
    last = heads.select("path", (F.size("names") - 1).alias("pos")).join(cells, ["path", "pos"], "left").join(total, "path")
    short = last.select("path", F.lit(SHORT).alias("problem"), (F.col("total") - F.coalesce("rows", F.lit(0))).alias("rows")).filter("rows > 0")
    nameless = width.filter("name = ''").join(cells, ["path", "pos"]).select("path", "rows").unionByName(s.filter("pos IS NULL AND name = ''").select("path", "rows"))
    unnamed = nameless.groupBy("path").agg(F.max("rows").alias("rows")).select("path", F.lit(UNNAMED).alias("problem"), "rows")
    unlisted = total.join(files.select("path"), "path", "left_anti").select("path", F.lit(UNLISTED).alias("problem"), F.col("total").alias("rows"))
    return unreadable.unionByName(beyond).unionByName(short).unionByName(bare).unionByName(unnamed).unionByName(unlisted)


def ordered_files(manifest: DataFrame, landing: Landing) -> DataFrame:
    """(path, feed, dataset, seq, next_path): files of a feed (the path up to the date) numbered by as_of_date from the manifest.

    Several manifest rows of one file count once, with the newest load_timestamp. Files the manifest lacks have no place
    in a feed; ``reading_problems`` reports them.
    """
    present = landing.scanned.select("path").distinct()
    newest = manifest.groupBy(F.col("landing_path").alias("path")).agg(F.max(F.struct("load_timestamp", "as_of_date", "dataset")).alias("m"))
    feed = F.regexp_replace("path", r"/\d{4}-\d{2}-\d{2}/.*$", "")
    named = present.join(newest, "path").select("path", feed.alias("feed"), F.col("m.dataset").alias("dataset"), F.col("m.as_of_date").alias("as_of"))
    w = Window.partitionBy("feed").orderBy("as_of", "path")
    return named.select("path", "feed", "dataset", F.row_number().over(w).alias("seq"), F.lead("path").over(w).alias("next_path"))


# ---- renamings ------------------------------------------------------------------------------------------------------------


def _planned(landing: Landing, plans: DataFrame, every: bool = False) -> DataFrame:
    """(path, row_no, record, plan): the rows of the files that have a plan, or ``every`` row, with the names of their header in it."""
    named = plans.join(headers(landing), "path", "left").select("path", F.to_json(F.struct("names", "todo")).alias("plan"))
    return (landing.every if every else landing.rows).join(bounded_broadcast(named, 50_000), "path", "left" if every else "inner")


def _fields(path: str, record: str | None, names: list[str] | None) -> dict[str, str | None]:
    """Name to value of one record; of equal names the first counts."""
    if record is None:
        return {}
    if not _is_csv(path):
        out: dict[str, str | None] = {}
        for k, v in (json_fields(record) or {}).items():
            out.setdefault(plain_name(k), _text(v))
        return out
    return dict(zip(reversed(names or []), reversed((split_csv(record) + [None] * len(names or []))[: len(names or [])])))


def _hash(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


#: Kinds of tokens: the value, the record, and both.
_VALUE, _RECORD, _BOTH = 0, 1, 2


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    plans = functools.lru_cache(maxsize=10_000)(json.loads)
    kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    for batch in batches:
        seen: Counter = Counter()
        for path, row_no, record, text in zip(*(c.to_pylist() for c in batch.columns)):
            if row_no == 0 and _is_csv(path):
                continue
            plan = plans(text)
            fields = _fields(path, record, plan.get("names"))
            for t in plan["todo"]:
                known = [same_value(fields.get(k) or "") for k in t.get("identity") or ()]
                record_key = "\x1f".join(known) if any(known) else None
                for name in t["fields"]:
                    value = (fields.get(name) or "").strip(" ")
                    if not value:
                        continue
                    at = (t["feed"], t["seq"], t["role"], name)
                    value = same_value(value)
                    seen[(*at, _VALUE, _hash(value))] += 1
                    if record_key is not None:
                        seen[(*at, _RECORD, _hash(record_key))] += 1
                        seen[(*at, _BOTH, _hash(f"{record_key}\x1e{value}"))] += 1
        columns = [*zip(*seen), tuple(seen.values())] if seen else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["feed", "seq", "role", "name", "kind", "token", "n"])


def _identity(identity: Mapping[str, tuple[str, ...]]) -> Column:
    pairs = [x for d, names in identity.items() for x in (F.lit(d), F.array(*map(F.lit, names)).cast("array<string>"))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("dataset")), F.array().cast("array<string>")) if pairs else F.array().cast("array<string>")


def file_changes(landing: Landing, stats: DataFrame, identity: Mapping[str, tuple[str, ...]]) -> tuple[DataFrame, DataFrame]:
    """Fields that came and went between consecutive files, and the renamings among them.

    Returns (edges, renames): edges = (feed, seq, path, name, role NEW or GONE) and renames = (feed, seq, name, gone).
    A new field continues a vanished one if it carries on its values for most rows. Rows of the two files are the same
    record if they agree in the columns of ``identity`` (per dataset) that both files have. Where most rows with a value
    of the new field are records that had one of the vanished field, more than half of those must have the same value;
    elsewhere more than half of the values, counted with multiplicity, must be among the vanished field's. Values are
    compared as ``same_value`` does, as a field may change its name and format at once. The best matches are taken first,
    each field at most once.
    """
    s = stats.select("path", "name", "feed", "dataset", "seq", "next_path", "before", "after")
    stays = F.coalesce(F.col("before") == F.col("seq") - 1, F.lit(False))
    new = s.filter((F.col("seq") > 1) & ~stays).select("feed", "seq", "path", F.col("path").alias("source"), "name", F.lit("NEW").alias("role"))
    gone = s.filter(F.col("next_path").isNotNull() & ~F.coalesce(F.col("after") == F.col("seq") + 1, F.lit(False))).select(
        "feed", (F.col("seq") + 1).alias("seq"), F.col("next_path").alias("path"), F.col("path").alias("source"), "name", F.lit("GONE").alias("role")
    )
    edges = cut_lineage(new.unionByName(gone))
    both = edges.groupBy("feed", "seq").agg(F.max((F.col("role") == "NEW").cast("int")).alias("a"), F.max((F.col("role") == "GONE").cast("int")).alias("b")).filter("a = 1 AND b = 1").select("feed", "seq")
    shared_keys = s.filter(stays & F.array_contains(_identity(identity), F.col("name"))).groupBy("feed", "seq").agg(F.sort_array(F.collect_set("name")).alias("identity"))  # a few names
    asked = edges.join(both, ["feed", "seq"]).groupBy(F.col("source").alias("path"), "feed", "seq", "role").agg(F.sort_array(F.collect_set("name")).alias("fields"))  # fields of one file
    plans = asked.join(shared_keys, ["feed", "seq"], "left").groupBy("path").agg(F.collect_list(F.struct("feed", "seq", "role", "fields", "identity")).alias("todo"))  # a file has two neighbours
    tokens = _planned(landing, plans).mapInArrow(_token_batches, "feed string, seq int, role string, name string, kind int, token bigint, n bigint")
    told = cut_lineage(tokens.groupBy("feed", "seq", "role", "name", "kind", "token").agg(F.sum("n").alias("n")))
    a = told.filter("role = 'NEW'").select("feed", "seq", "kind", "token", "name", "n")
    b = told.filter("role = 'GONE'").select("feed", "seq", "kind", "token", F.col("name").alias("gone"), F.col("n").alias("m"))
    size = a.filter(F.col("kind") == _VALUE).groupBy("feed", "seq", "name").agg(F.sum("n").alias("size"))
    total = lambda kind, v: F.sum(F.when(F.col("kind") == kind, v).otherwise(0))
    hits = a.join(b, ["feed", "seq", "kind", "token"]).groupBy("feed", "seq", "name", "gone").agg(
        total(_RECORD, F.col("n")).alias("linked"), total(_BOTH, F.col("n")).alias("agree"), total(_VALUE, F.least("n", "m")).alias("shared")
    )
    score = F.when(2 * F.col("linked") > F.col("size"), F.col("agree") / F.col("linked")).otherwise(F.col("shared") / F.col("size"))
    likely = hits.join(size, ["feed", "seq", "name"]).withColumn("score", score).filter("2 * score > 1")
    ranked = likely.groupBy("feed", "seq").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "name", "gone"))).alias("c"))  # fields of one file
    empty = F.filter(F.col("c"), lambda e: F.lit(False))
    taken = lambda acc, e: F.exists(acc, lambda t: (t["name"] == e["name"]) | (t["gone"] == e["gone"]))
    picked = F.aggregate("c", empty, lambda acc, e: F.when(taken(acc, e), acc).otherwise(F.concat(acc, F.array(e))))
    renames = ranked.select("feed", "seq", F.explode(picked).alias("p")).select("feed", "seq", F.col("p.name").alias("name"), F.col("p.gone").alias("gone"))
    return edges, cut_lineage(renames)


def canonical_names(renames: DataFrame) -> DataFrame:
    """(feed, canon): per feed the map from a renamed field to the name it first had."""
    events = renames.groupBy("feed").agg(F.sort_array(F.collect_list(F.struct("seq", "name", "gone"))).alias("ev"))  # renamings of one feed
    start = F.create_map().cast("map<string,string>")

    def step(acc: Column, e: Column) -> Column:
        rest = F.map_filter(acc, lambda k, _: k != e["name"])
        return F.map_concat(rest, F.create_map(e["name"], F.coalesce(acc[e["gone"]], e["gone"])))

    return events.select("feed", F.aggregate("ev", start, step).alias("canon"))


# ---- report and table -----------------------------------------------------------------------------------------------------


def _silver_kind(kinds: Mapping[str, Mapping[str, str]], dataset: Column, name: Column) -> Column:
    """Silver kind of a field, '' for text, null for names the data model does not know."""
    flat = {f"{d}/{n}": k for d, m in kinds.items() for n, k in m.items()}
    table = F.create_map(*(F.lit(x) for kv in flat.items() for x in kv))
    return F.element_at(table, F.concat_ws("/", dataset, name))


def drift_report(landing: Landing, files: DataFrame, kinds: Mapping[str, Mapping[str, str]], identity: Mapping[str, tuple[str, ...]]) -> tuple[DataFrame, DataFrame]:
    """(report, canon): report = (path, drift_type, column_name) against each file's predecessor in its feed.

    ``kinds`` gives per dataset the Silver kind of each known field ('' for text), ``identity`` the columns that identify
    a record. A renamed field keeps the kind of the field it continues. A type failure is reported where most of the
    non-blank values of a field of both files cannot be read as its kind, but not so in the preceding file. First files
    of a feed have no report.
    """
    w = Window.partitionBy("feed", "name").orderBy("seq")
    counts = ["present", *(f"k{i}" for i in range(len(KINDS)))]
    placed = path_statistics(landing).join(bounded_broadcast(files), "path")
    stats = cut_lineage(placed.select("*", F.lag("seq").over(w).alias("before"), F.lead("seq").over(w).alias("after"), *(F.lag(c).over(w).alias(f"before_{c}") for c in counts)))
    edges, renames = file_changes(landing, stats, identity)
    canon = canonical_names(renames)
    named_new = renames.select("feed", "seq", "name", F.lit(RENAMED).alias("kind"))
    named_gone = renames.select("feed", "seq", F.col("gone").alias("name"), F.lit("CONTINUED").alias("kind"))
    came = edges.filter("role = 'NEW'").join(named_new, ["feed", "seq", "name"], "left").select("path", F.coalesce("kind", F.lit(ADDED)).alias("drift_type"), F.col("name").alias("column_name"))
    went = edges.filter("role = 'GONE'").join(named_gone, ["feed", "seq", "name"], "left").filter("kind IS NULL").select("path", F.lit(MISSING).alias("drift_type"), F.col("name").alias("column_name"))
    typed = stats.filter(F.col("before") == F.col("seq") - 1).join(bounded_broadcast(canon), "feed", "left")
    kind = F.coalesce(_silver_kind(kinds, F.col("dataset"), F.col("name")), _silver_kind(kinds, F.col("dataset"), F.col("canon")[F.col("name")]))

    def fails(prefix: str) -> Column:
        good = F.coalesce(*(F.when(F.col("kind") == k, F.col(f"{prefix}k{i}")) for i, k in enumerate(KINDS)))
        return F.coalesce(2 * (F.col(f"{prefix}present") - good) > F.col(f"{prefix}present"), F.lit(False))

    wrong = typed.withColumn("kind", kind).filter(fails("") & ~fails("before_")).select("path", F.lit(TYPE_FAILURE).alias("drift_type"), F.col("name").alias("column_name"))
    return came.unionByName(went).unionByName(wrong), canon


def _free(name: str, taken: Mapping) -> str:
    k = 2
    while f"{name}_{k}" in taken:
        k += 1
    return f"{name}_{k}"


def _project(batches: Iterator[pa.RecordBatch], known: Mapping[str, list[str]]) -> Iterator[pa.RecordBatch]:
    plans = functools.lru_cache(maxsize=10_000)(json.loads)
    places = {d: {n: i for i, n in enumerate(names)} for d, names in known.items()}
    texts = pa.list_(pa.string())
    for batch in batches:
        keep, datasets, values, extras, problems = [], [], [], [], []
        for i, (path, row_no, record, text) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
            is_csv = path is not None and _is_csv(path)
            if is_csv and row_no == 0:
                continue
            plan = {} if text is None else plans(text)
            todo = plan.get("todo", {})
            place = places.get(todo.get("dataset"), {})
            names, canon, wrong = plan.get("names"), todo.get("canon") or {}, [] if todo.get("listed", True) else [UNLISTED]
            if path is None or (is_csv and (row_no is None or row_no < 0)):
                wrong.append(UNPLACED)
                cells = [("record", record)]  # the whole text, as it cannot be told what it holds
            elif is_csv:
                cells = [] if record is None else split_csv(record)
                if record is not None and names is None:
                    wrong.append(NO_HEADER)
                elif record is not None and len(cells) != len(names):
                    wrong.append(SURPLUS if len(cells) > len(names) else SHORT)
                cells = [((names[j] if names and j < len(names) else "") or f"value_{j + 1}", v) for j, v in enumerate(cells)]
            else:
                found = None if record is None else json_fields(record)
                cells = [(plain_name(k) or k, _text(v)) for k, v in (found or {}).items()]
                record = record if found is not None else None
            if record is None:
                wrong.append(UNREADABLE)
            row: list[str | None] = [None] * len(place)
            extra: dict[str, str | None] = {}
            set_here: set[str] = set()
            for name, v in cells:
                target = name if name in place else canon.get(name, name)
                if target in place and target not in set_here:
                    set_here.add(target)
                    row[place[target]] = v
                else:
                    target = name if target in place else target
                    extra[_free(target, extra) if target in extra or target in place else target] = v
            keep.append(i)
            datasets.append(todo.get("dataset"))
            values.append(row)
            extras.append(list(extra.items()))
            problems.append(wrong)
        at = pa.array(keep, pa.int64())
        clean = lambda v: v and re.sub("[\ud800-\udfff]", "�", v)  # noqa: E731  # JSON escapes can give what UTF-8 cannot hold
        try:
            arrays = [pa.array(values, texts), pa.array(extras, pa.map_(pa.string(), pa.string()))]
        except UnicodeEncodeError:
            arrays = [pa.array([[clean(v) for v in row] for row in values], texts), pa.array([[(clean(k), clean(v)) for k, v in e] for e in extras], pa.map_(pa.string(), pa.string()))]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(datasets, pa.string()), *arrays, pa.array(problems, texts)], names=["path", "row_no", "dataset", "texts", "extra", "problems"])


def consistent_table(landing: Landing, files: DataFrame, canon: DataFrame, dataset: str, kinds: Mapping[str, str]) -> DataFrame:
    """All rows of a dataset's files as one table: path, row_no, the typed known columns, ``extra``, ``failed_casts`` and ``problems``.

    ``extra`` is a map of everything else: fields outside the data model, values beyond the header's width or without a
    name (value_<place>), and what a name that occurs again holds (name_2). ``failed_casts`` names the columns whose
    non-blank value could not be read (the typed column is then null), ``problems`` what is wrong with the record itself
    (see ``reading_problems``). Every data row of the files comes out once; files the manifest lacks belong to no dataset.
    """
    todo = files.filter(F.col("dataset") == dataset).join(canon, "feed", "left").select("path", F.struct("dataset", "canon").alias("todo"))
    return _typed_table(landing, _planned(landing, todo), {dataset: kinds}).drop("dataset")


def whole_table(landing: Landing, files: DataFrame, canon: DataFrame, kinds: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """The files of all datasets as one table: dataset, path, row_no, the typed columns of all data models, ``extra``, ``failed_casts`` and ``problems``.

    As ``consistent_table`` for each dataset; a column of several data models must be of one kind in them, and is null in
    rows of datasets that lack it. Every landed row comes out once but the headers: rows of files the manifest lacks
    (NOT_IN_MANIFEST) or of datasets without a model have all their fields in ``extra``, rows without a path or before a
    header (NO_PLACE_IN_FILE) their text under ``record``.
    """
    seen = landing.scanned.select("path").distinct().join(files.select("path", "feed", "dataset", F.lit(True).alias("_listed")), "path", "left").join(canon, "feed", "left")
    todo = seen.select("path", F.struct("dataset", "canon", F.coalesce("_listed", F.lit(False)).alias("listed")).alias("todo"))
    return _typed_table(landing, _planned(landing, todo, every=True), kinds)


def _typed_table(landing: Landing, planned: DataFrame, kinds: Mapping[str, Mapping[str, str]]) -> DataFrame:
    columns: dict[str, str] = {}
    for d, of in kinds.items():
        for n, k in of.items():
            if columns.setdefault(n, k) != k:
                raise ValueError(f"{n} of {d} is {k or 'text'}, elsewhere {columns[n] or 'text'}")
    known = {d: list(of) for d, of in kinds.items()}
    row_type = landing.rows.schema["row_no"].dataType.simpleString()
    work: Callable = lambda it: _project(it, known)
    split = planned.mapInArrow(work, f"path string, row_no {row_type}, dataset string, texts array<string>, extra map<string,string>, problems array<string>")

    def text(name: str) -> Column:
        return F.coalesce(*(F.when(F.col("dataset") == d, F.get("texts", F.lit(names.index(name)))) for d, names in known.items() if name in names))

    named = split.select("dataset", "path", "row_no", *(blank_to_null(text(n)).alias(n) for n in columns), "extra", "problems")
    failed = F.array_compact(F.array(*(F.when(F.col(n).isNotNull() & ~reads_as(F.col(n), k), F.lit(n)) for n, k in columns.items() if k)))
    judged = named.withColumn("failed_casts", failed)
    return judged.select("dataset", "path", "row_no", *(read_typed(F.col(n), k or None).alias(n) for n, k in columns.items()), "extra", "failed_casts", "problems")
