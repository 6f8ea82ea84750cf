"""SQL of the rule-based queries, generated from the same specifications but for another engine's casts and patterns."""

from __future__ import annotations

from collections.abc import Callable

from ledgerloom.functions.rules import RuleSpec
from ledgerloom.spec import DATASETS, DEFICIENCIES, PENALTIES, REGISTRY


def _lit(x) -> str:
    return str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"


def text_sql(spec: RuleSpec, name: str, raw: str) -> str:
    t = f"NULLIF(trim({raw}), '')"
    return f"upper({t})" if name in spec.upper else t


def value_sql(spec: RuleSpec, name: str, c: str) -> str:
    """Typed value of the cleaned text column ``c``; patterns guard casts that the engine would take too freely."""
    if name in spec.flags:
        return f"CASE upper({c}) WHEN 'Y' THEN true WHEN 'N' THEN false END"
    kind = spec.types.get(name, "")
    if kind == "date":
        return rf"CASE WHEN regexp_full_match({c}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN TRY_CAST({c} AS DATE) END"
    if kind == "int":
        return rf"CASE WHEN regexp_full_match({c}, '[-+]?\d+') THEN TRY_CAST({c} AS INTEGER) END"
    if kind == "double":
        return rf"CASE WHEN regexp_full_match({c}, '[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?') THEN TRY_CAST({c} AS DOUBLE) END"
    if kind.startswith("decimal"):
        return rf"CASE WHEN regexp_full_match({c}, '[-+]?\d*\.?\d*') THEN TRY_CAST({c} AS {kind.upper()}) END"
    return c


def staged_sql(spec: RuleSpec, source: str, raw: Callable[[str], str], keep: str) -> str:
    """Subquery with ``keep``, the cleaned texts c_<name> and the typed values v_<name>."""
    texts = ", ".join(f"{text_sql(spec, n, raw(n))} AS c_{n}" for n in spec.source)
    values = ", ".join(f"{value_sql(spec, n, f'c_{n}')} AS v_{n}" for n in spec.source)
    return f"SELECT *, {values} FROM (SELECT {keep}, {texts} FROM {source})"


def failed_sql(spec: RuleSpec) -> str:
    """List of the names of failed rules over the columns of ``staged_sql``."""
    checks = [(f"REQUIRED:{n}", f"v_{n} IS NULL") for n in spec.required]
    checks += [(f"SAFE_CAST:{n}", f"c_{n} IS NOT NULL AND v_{n} IS NULL") for n in spec.types]
    checks += [(f"DOMAIN_YN:{n}", f"c_{n} IS NOT NULL AND v_{n} IS NULL") for n in spec.flags]
    checks += [(f"REGEX:{n}", f"NOT regexp_full_match(v_{n}, '{p}')") for n, p in spec.regex.items()]
    checks += [(f"DOMAIN:{n}", f"v_{n} NOT IN ({', '.join(map(_lit, d))})") for n, d in spec.domain.items()]
    checks += [(f"RANGE:{n}", f"v_{n} < {lo} OR v_{n} > {hi}") for n, (lo, hi) in spec.ranges.items()]
    checks += [(f"NON_NEGATIVE:{n}", f"v_{n} < 0") for n in spec.non_negative]
    for s in spec.conditional:
        broken = [f"v_{n} IS NULL" for n in s.required] + [f"v_{n} IS NOT NULL" for n in s.forbidden]
        checks.append((f"CONDITIONAL:{s.rule}", f"v_{s.column} = {_lit(s.value)} AND ({' OR '.join(broken)})"))
    return "[x FOR x IN [" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in checks) + "] IF x IS NOT NULL]"


_FIELD = r'(?:[^",\r\n]*|"(?:[^"]|"")*")'


def _parsed(name: str, spec: RuleSpec) -> tuple[str, Callable[[str], str]]:
    """The records of one dataset with the violation of their structure, and the raw text of a field."""
    place = {n: i + 1 for i, n in enumerate(spec.source)}
    raw = lambda n: f"CASE WHEN fmt = 'csv' THEN f[{place[n]}] ELSE json_extract_string(j, '$.{n}') END"
    parsed = f"(SELECT *, CASE WHEN fmt = 'csv' AND NOT fits THEN 'QUOTING' WHEN fmt = 'csv' AND len(f) <> {len(spec.source)} THEN 'COLUMN_COUNT' WHEN fmt = 'json' AND j IS NULL THEN 'JSON' END AS structure FROM p WHERE dataset = '{name}')"
    return parsed, raw


def _side(name: str, spec: RuleSpec) -> str:
    parsed, raw = _parsed(name, spec)
    return f"SELECT line_id, unnest(CASE WHEN structure IS NOT NULL THEN [structure] ELSE {failed_sql(spec)} END) AS reason FROM ({staged_sql(spec, parsed, raw, 'line_id, structure')})"


def _valid(name: str, spec: RuleSpec) -> str:
    parsed, raw = _parsed(name, spec)
    fields = f"[{', '.join(raw(n) for n in spec.source)}] AS fields"
    return f"SELECT line_id, '{name}' AS dataset, CAST(to_json(fields) AS VARCHAR) AS fields FROM ({staged_sql(spec, parsed, raw, f'line_id, structure, {fields}')}) WHERE structure IS NULL AND len({failed_sql(spec)}) = 0"


#: The text without its strings: that engine takes a comma before a closing bracket, which RFC 8259 forbids.
_BARE = r"""regexp_replace(t, '"(?:[^"\\]|\\.)*"', '""', 'g')"""
P5_PARSED = f"""WITH r AS (SELECT line_id, dataset, record_format AS fmt, coalesce(raw_record, '') AS t FROM raw_records),
p AS (SELECT *, regexp_full_match(t, '{_FIELD}(?:,{_FIELD})*') AS fits,
  [CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END FOR x IN regexp_extract_all(t || ',', '("(?:[^"]|"")*"|[^,]*),', 1)] AS f,
  CASE WHEN fmt = 'json' AND json_valid(t) AND NOT regexp_matches({_BARE}, ',[ \t\r\n]*[}}\\]]') THEN CASE WHEN json_type(t) = 'OBJECT' THEN t END END AS j FROM r)
"""
P5 = P5_PARSED + f"{_side('health_deficiencies', DEFICIENCIES)} UNION ALL {_side('penalties', PENALTIES)}"

_ADDRESS = "CASE WHEN c_provider_address IS NOT NULL THEN sha256(concat(upper(trim(c_provider_address)), 'test-salt')) END"
_SEVERITY = "CASE WHEN v_scope_severity_code IN ('A', 'B', 'C') THEN 'A-C' WHEN v_scope_severity_code IN ('D', 'E', 'F') THEN 'D-F' WHEN v_scope_severity_code IN ('G', 'H', 'I') THEN 'G-I' WHEN v_scope_severity_code IN ('J', 'K', 'L') THEN 'J-L' END"


def _json_digest(values: dict[str, str]) -> str:
    return f"sha256(CAST(to_json(struct_pack({', '.join(f'{n} := {v}' for n, v in values.items())})) AS VARCHAR))"


def _business(spec: RuleSpec) -> dict[str, str]:
    """Silver columns without key and lineage, in order, as expressions over ``staged_sql``."""
    out = {c: f"v_{c}" for c in spec.source if c not in ("telephone_number", "provider_address", "location", "processing_date")}
    out["provider_address_hash"] = _ADDRESS
    return out | ({"severity_group": _SEVERITY} if "scope_severity_code" in spec.source else {})


def classified_sql(name: str, present: set[str] | None = None) -> str:
    """WITH ..., a: every row of the table ``name`` with its status, failed rules and typed values; absent columns are null."""
    spec, dataset = DATASETS[name], REGISTRY[name]
    raw = lambda n: n if present is None or n in present else "CAST(NULL AS VARCHAR)"
    ready = " AND ".join(f"v_{c} IS NOT NULL" for c in dataset.key if c not in dataset.nullable_key)
    key = f"CASE WHEN {ready} THEN {_json_digest({c: f'v_{c}' for c in dataset.key})} END"
    digest = f"[{', '.join(f'CAST({v} AS VARCHAR)' for v in _business(spec).values())}]"
    record = f"CAST(to_json(struct_pack({', '.join(f'{c} := {raw(c)}' for c in spec.source)})) AS VARCHAR)"
    keep = f"_batch_id, _source_file, _source_file_sha256, {record} AS raw_record"
    return f"""WITH s AS ({staged_sql(spec, name, raw, keep)}),
j AS (SELECT *, {failed_sql(spec)} AS failed, {key} AS entity, {digest} AS h FROM s),
g AS (SELECT *, count(DISTINCT h) OVER (PARTITION BY entity) AS kinds, row_number() OVER (PARTITION BY entity, h ORDER BY v_processing_date DESC NULLS LAST, _source_file, raw_record, _batch_id) AS rn FROM j WHERE len(failed) = 0),
a AS (SELECT * EXCLUDE (kinds, rn), CASE WHEN kinds > 1 THEN 'CONFLICT' WHEN rn > 1 THEN 'DUPLICATE' ELSE 'ACCEPTED' END AS status FROM g UNION ALL SELECT *, 'INVALID' FROM j WHERE len(failed) > 0)"""


_COUNTS = "SELECT status, CAST(count(*) AS BIGINT) AS n FROM a GROUP BY 1"
PENALTY_STATUSES = classified_sql("penalties")
SILVER_PENALTIES = f"{PENALTY_STATUSES} {_COUNTS}"
#: The columns of provider_info that the driver's table has.
_PROVIDER_PRESENT = set(
    """cms_certification_number_ccn provider_name provider_address citytown state zip_code telephone_number countyparish urban ownership_type number_of_certified_beds average_number_of_residents_per_day provider_type
    legal_business_name chain_name chain_id special_focus_status overall_rating health_inspection_rating staffing_rating total_nursing_staff_turnover number_of_fines latitude longitude processing_date""".split()
)
SILVER_PROVIDERS = f"{classified_sql('provider_info', _PROVIDER_PRESENT)} {_COUNTS}"
QUARANTINED_PENALTIES = f"""{PENALTY_STATUSES} SELECT DISTINCT 'penalties' AS dataset, _batch_id AS source_batch_id, _source_file AS source_file, _source_file_sha256 AS source_file_sha256, entity AS candidate_entity_key, raw_record,
  CASE WHEN status = 'CONFLICT' THEN 'CONFLICTING_BUSINESS_KEY' ELSE array_to_string(list_sort(failed), '|') END AS failed_rules FROM a WHERE status IN ('INVALID', 'CONFLICT')"""
_DEFICIENCY = _business(DEFICIENCIES)
SILVER_DEFICIENCIES = f"""{classified_sql("health_deficiencies")} SELECT entity AS deficiency_key, {', '.join(f'{v} AS {n}' for n, v in _DEFICIENCY.items())}, {_json_digest(_DEFICIENCY)} AS row_hash, false AS is_deleted,
  v_processing_date AS source_processing_date FROM a WHERE status = 'ACCEPTED'"""
#: The records apart from the broken ones, with their fields.
P5_VALID = P5_PARSED + " UNION ALL ".join(_valid(n, DATASETS[n]) for n in ("health_deficiencies", "penalties"))

SQL = {"p5_found": P5, "p5_valid": P5_VALID, "silver_penalties": SILVER_PENALTIES}
