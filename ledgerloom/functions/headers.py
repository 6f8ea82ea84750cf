"""Headers of landed files: matching, naming of new fields and drift records. Plain Python over short tuples."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from ledgerloom.spec import BRONZE_METADATA

ADDED, MISSING, RENAMED = "ADDED_COLUMN", "MISSING_COLUMN", "RENAMED_OR_UNMAPPED_COLUMN"
RESERVED = frozenset((*BRONZE_METADATA, "_corrupt_record"))
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def match_key(name: str) -> str:
    """Letters and digits in lower case: what a header is matched on."""
    return re.sub(r"[^a-z0-9]+", "", name.strip().lower())


def new_name(name: str) -> str:
    """A safe name for a field the contract does not know yet; empty if there is none."""
    value = re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]+", "_", name.strip().lower())).strip("_")
    return f"source_{value}" if value[:1].isdigit() else value


@dataclass
class Assessment:
    columns: list[str] = field(default_factory=list)  # names in physical order
    added: dict[str, str] = field(default_factory=dict)  # header -> name
    missing: list[str] = field(default_factory=list)
    invalid: list[str] = field(default_factory=list)
    duplicate: list[str] = field(default_factory=list)

    @property
    def breaking(self) -> bool:
        return bool(self.missing or self.invalid or self.duplicate)

    def records(self) -> list[tuple[str, str, str]]:
        """(drift_type, column_name, detail). Added fields beside missing ones may be renamings and are reported so."""
        kind = RENAMED if self.missing else ADDED
        out = [(kind, name, f"source header {header!r}") for header, name in self.added.items()]
        out += [(MISSING, name, "expected field is absent") for name in self.missing]
        out += [(RENAMED, h, "name cannot be used") for h in self.invalid]
        return out + [(RENAMED, h, "name occurs twice") for h in self.duplicate]


def assess_header(header: Iterable[str], expected: Iterable[str], overrides: Mapping[str, str] | None = None) -> Assessment:
    """Names of a csv header: an override, else the expected field with equal letters and digits, else a new name."""
    expected = list(expected)
    known = {match_key(c): c for c in expected}
    out = Assessment()
    for raw in header:
        title = str(raw).removeprefix("﻿").strip()
        name = (overrides or {}).get(title) or known.get(match_key(title))
        fresh = name is None
        name = new_name(title) if fresh else name
        if not name or not _IDENTIFIER.fullmatch(name) or name in RESERVED:
            out.invalid.append(title)
        elif name in out.columns:
            out.duplicate.append(title)
        else:
            out.columns.append(name)
            if name not in expected:
                out.added[title] = name
    out.missing = [c for c in expected if c not in out.columns]
    return out


def assess_keys(keys: Iterable[str], expected: Iterable[str]) -> Assessment:
    """Names of JSON keys: exact matches only; new keys must be safe identifiers."""
    expected, seen = list(expected), list(dict.fromkeys(map(str, keys)))
    fresh = [k for k in seen if k not in expected]
    usable = [k for k in fresh if _IDENTIFIER.fullmatch(k) and k not in RESERVED]
    return Assessment([*expected, *usable], {k: k for k in usable}, [c for c in expected if c not in seen], [k for k in fresh if k not in usable])


def strict_mapping(header: Iterable[str], expected: Iterable[str], overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """Header to field where nothing may be missing, added, invalid or twice; anything else raises."""
    titles = [str(h).removeprefix("﻿").strip() for h in header]
    found = assess_header(titles, expected, overrides)
    if found.breaking or found.added:
        raise ValueError(f"header does not match: {found.records()}")
    return dict(zip(titles, found.columns))


def qualified_name(*parts: str) -> str:
    bad = [p for p in parts if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", p)]
    if bad:
        raise ValueError(f"unsafe identifier {bad[0]!r}")
    return ".".join(parts)
