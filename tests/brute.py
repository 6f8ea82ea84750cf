"""Plain Python versions of operators that SQL cannot express, for small fixtures."""

from __future__ import annotations

import csv
import datetime as dt
import io
import json
import re
from collections import Counter, defaultdict
from decimal import Decimal, InvalidOperation

FIXED = {"boolean": lambda v: v.upper() in ("Y", "N"), "": lambda v: True}


def is_date(v: str) -> bool:
    try:
        return bool(re.fullmatch(r"\d{4}-\d{2}-\d{2}", v)) and bool(dt.date.fromisoformat(v))
    except ValueError:
        return False


def is_decimal(v: str) -> bool:
    try:
        return abs(Decimal(v).quantize(Decimal("0.01"))) < 10**12
    except InvalidOperation:
        return False


def is_float(v: str) -> bool:
    try:
        float(v)
        return bool(re.fullmatch(r"[-+.0-9eE]+", v))
    except ValueError:
        return False


READS = FIXED | {"date": is_date, "int": lambda v: bool(re.fullmatch(r"[-+]?\d{1,9}", v)), "double": is_float, "decimal(14,2)": is_decimal}


def normal(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def spelt(v: str) -> tuple:
    """Numbers, dates and flags whatever their format."""
    v = v.strip(" ").lower()
    if m := re.fullmatch(r"(\d+)[-./](\d+)[-./](\d+)", v):
        return ("date", *sorted(map(int, m.groups())))
    if m := re.fullmatch(r"(?:\$|usd )?([\d.,]+)(?: usd)?", v):
        return ("number", m[1].replace(".", "").replace(",", ""))
    return ("text", {"y": "1", "n": "0"}.get(v, v))


def drift(records: list[tuple[str, int, str]], as_of: dict[str, object], kinds: dict[str, dict[str, str]], identity: dict[str, tuple[str, ...]]) -> set[tuple[str, str, str]]:
    """(path, drift_type, column) of landing records, dataset = second part of the path."""
    by_path: dict[str, list] = defaultdict(list)
    for p, n, r in sorted(records):
        by_path[p].append(r)
    files, fields = {}, {}
    for p, rs in by_path.items():
        if p.endswith(".csv"):
            rows = [next(csv.reader(io.StringIO(r))) for r in rs]
            head = [normal(x) for x in rows[0]]
            files[p], fields[p] = [dict(zip(head, r)) for r in rows[1:]], set(head)
        else:
            files[p] = [{normal(k): v for k, v in json.loads(r).items()} for r in rs]
            fields[p] = set().union(*files[p])
    feeds: dict[str, list[str]] = defaultdict(list)
    for p in files:
        feeds[re.split(r"/\d{4}-\d{2}-\d{2}/", p)[0]].append(p)
    out = set()
    full = lambda p, f: [r[f].strip(" ") for r in files[p] if (r.get(f) or "").strip(" ")]
    for feed, paths in feeds.items():
        known = kinds[feed.split("/")[1]]
        canon: dict[str, str] = {}
        paths.sort(key=lambda p: (as_of[p], p))
        bad = lambda p, f: 2 * sum(not READS[known.get(f, known.get(canon.get(f, f), ""))](v) for v in full(p, f)) > len(full(p, f))
        for a, b in zip(paths, paths[1:]):
            new, gone = fields[b] - fields[a], fields[a] - fields[b]
            pairs = []
            same = [k for k in identity[feed.split("/")[1]] if k in fields[a] & fields[b]]
            record = lambda r, same=same: tuple(spelt(r.get(k) or "") for k in same)
            having = lambda p, f, record=record: [(record(r), spelt(r[f])) for r in files[p] if (r.get(f) or "").strip(" ")]
            for n in new:
                have = having(b, n)
                for g in gone:
                    had = having(a, g)
                    linked = [x for x in have if same and x[0] in {k for k, _ in had}]
                    if 2 * len(linked) > len(have):
                        score = sum(x in had for x in linked) / len(linked)
                    else:
                        score = sum((Counter(v for _, v in have) & Counter(v for _, v in had)).values()) / max(1, len(have))
                    if 2 * score > 1:
                        pairs.append((-score, n, g))
            taken: set[str] = set()
            for _, n, g in sorted(pairs):
                if n not in taken and "-" + g not in taken:
                    taken |= {n, "-" + g}
                    canon[n] = canon.get(g, g)
                    out.add((b, "RENAMED_OR_UNMAPPED_COLUMN", n))
            out |= {(b, "ADDED_COLUMN", n) for n in new if n not in taken} | {(b, "MISSING_COLUMN", g) for g in gone if "-" + g not in taken}
            out |= {(b, "TYPE_VALUE_FAILURE", f) for f in fields[a] & fields[b] if bad(b, f) and not bad(a, f)}
    return out
