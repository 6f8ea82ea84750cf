"""Independent SQL of the core problems' queries, for an engine with the same tables registered as views."""

from __future__ import annotations

_CCN = "CASE WHEN trim({c}) = '' THEN NULL WHEN length(trim({c})) < 6 THEN lpad(upper(trim({c})), 6, '0') ELSE upper(trim({c})) END"
_OWN = "CASE WHEN trim(ownership_type) <> '' THEN lower(regexp_replace(ownership_type, '[^\\p{L}\\p{N}]', '', 'g')) END"
_BEDS = "CASE WHEN trim(number_of_certified_beds) <> '' THEN coalesce(CAST(TRY_CAST(replace(trim(number_of_certified_beds), ',', '') AS DECIMAL(24, 6)) AS VARCHAR), upper(trim(number_of_certified_beds))) END"

_SNAPSHOTS = """
m AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY load_timestamp DESC, acquisition_run_id DESC) AS rn
                 FROM source_file_manifest WHERE dataset = 'provider_info' AND batch_id IS NOT NULL) WHERE rn = 1),
runs AS (
  SELECT acquisition_run_id AS run_id, max(as_of_date) AS as_of_date, max(load_timestamp) AS delivered_at FROM m GROUP BY 1
  HAVING bool_and(coalesce(acquisition_strategy IN ('bulk_snapshot', 'snapshot_diff') AND status = 'SUCCESS' AND row_count_validated, false))),
fullb AS (SELECT m.batch_id, r.run_id, r.as_of_date FROM m JOIN runs r ON m.acquisition_run_id = r.run_id),
cal AS (
  SELECT run_id, as_of_date, row_number() OVER (ORDER BY as_of_date) - 1 AS idx, lead(as_of_date) OVER (ORDER BY as_of_date) AS next_as_of
  FROM (SELECT *, row_number() OVER (PARTITION BY as_of_date ORDER BY delivered_at DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1),
snap AS (SELECT fullb.batch_id, cal.idx, cal.as_of_date, cal.next_as_of FROM fullb JOIN cal USING (run_id))
"""

P1 = f"""WITH {_SNAPSHOTS},
r AS (
  SELECT {_CCN.format(c='cms_certification_number_ccn')} AS ccn, idx, as_of_date, next_as_of, load_timestamp AS lt, {_OWN} AS own, {_BEDS} AS beds
  FROM provider_info JOIN snap ON _batch_id = batch_id),
g AS (
  SELECT ccn, idx, as_of_date, next_as_of, arg_max(own, lt) FILTER (own IS NOT NULL) AS own, arg_max(beds, lt) FILTER (beds IS NOT NULL) AS beds
  FROM r WHERE ccn IS NOT NULL GROUP BY ALL),
f AS (
  SELECT ccn, idx, as_of_date, next_as_of, last_value(own IGNORE NULLS) OVER w AS own, last_value(beds IGNORE NULLS) OVER w AS beds, lag(idx) OVER w AS pidx, lead(idx) OVER w AS nidx
  FROM g WINDOW w AS (PARTITION BY ccn ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
c AS (
  SELECT *, CASE WHEN pidx IS NULL OR pidx <> idx - 1 OR own IS DISTINCT FROM lag(own) OVER w OR beds IS DISTINCT FROM lag(beds) OVER w THEN 1 ELSE 0 END AS s
  FROM f WINDOW w AS (PARTITION BY ccn ORDER BY idx)),
v AS (SELECT *, sum(s) OVER (PARTITION BY ccn ORDER BY idx) AS ver, lead(s) OVER (PARTITION BY ccn ORDER BY idx) AS ns FROM c)
SELECT ccn, strftime(min(as_of_date), '%Y-%m-%d') AS valid_from,
  coalesce(strftime(arg_max({{'n': next_as_of}}, idx).n, '%Y-%m-%d'), '9999-12-31') AS valid_to
FROM v GROUP BY ccn, ver"""

_P2_COLUMNS = [
    "provider_name", "citytown", "state", "zip_code", "countyparish", "urban", "ownership_type", "number_of_certified_beds", "average_number_of_residents_per_day", "provider_type",
    "legal_business_name", "chain_name", "chain_id", "special_focus_status", "overall_rating", "health_inspection_rating", "staffing_rating", "total_nursing_staff_turnover", "number_of_fines", "latitude", "longitude",
]
_P2_DOUBLES = {"average_number_of_residents_per_day", "total_nursing_staff_turnover", "latitude", "longitude"}


def _p2_value(c: str) -> str:
    return f"CAST(CAST(round({c}, 6) AS DECIMAL(26, 6)) AS VARCHAR)" if c in _P2_DOUBLES else f"CAST({c} AS VARCHAR)"


P2 = f"""WITH {_SNAPSHOTS},
r AS (
  SELECT {_CCN.format(c='cms_certification_number_ccn')} AS ccn, idx, as_of_date, next_as_of, load_timestamp AS lt, {', '.join(f'{_p2_value(c)} AS {c}' for c in _P2_COLUMNS)}
  FROM silver_facility JOIN snap ON source_batch_id = batch_id WHERE NOT coalesce(is_deleted, false)),
g AS (
  SELECT ccn, idx, as_of_date, next_as_of, [{', '.join(f"arg_max({c}, lt) FILTER (trim({c}) <> '')" for c in _P2_COLUMNS)}] AS vals
  FROM r WHERE ccn IS NOT NULL GROUP BY ALL),
w AS (SELECT *, lag(idx) OVER (PARTITION BY ccn ORDER BY idx) AS pidx, lag(vals) OVER (PARTITION BY ccn ORDER BY idx) AS pvals, lead(idx) OVER (PARTITION BY ccn ORDER BY idx) AS nidx FROM g)
SELECT ccn, strftime(as_of_date, '%Y-%m-%d') AS as_of_date, 'ADDED' AS change_type FROM w WHERE idx > 0 AND (pidx IS NULL OR pidx <> idx - 1)
UNION ALL SELECT ccn, strftime(as_of_date, '%Y-%m-%d'), 'CHANGED' FROM w WHERE pidx = idx - 1 AND vals IS DISTINCT FROM pvals
UNION ALL SELECT ccn, strftime(next_as_of, '%Y-%m-%d'), 'REMOVED' FROM w WHERE next_as_of IS NOT NULL AND (nidx IS NULL OR nidx <> idx + 1)"""

_EVENTS = """
ev AS (
  SELECT 'health_deficiencies' AS source_table, record_id, {ccn} AS ccn, {hd} AS day FROM health_deficiencies
  UNION ALL SELECT 'penalties', record_id, {ccn}, {pn} FROM penalties)
"""

_P3 = f"""WITH {_SNAPSHOTS}, {_EVENTS.format(ccn=_CCN.format(c='cms_certification_number_ccn'), hd='processing_date', pn='processing_date')},
p AS (SELECT DISTINCT {_CCN.format(c='cms_certification_number_ccn')} AS ccn, idx FROM provider_info JOIN snap ON _batch_id = batch_id),
s AS (SELECT ccn, min(idx) AS lo, max(idx) AS hi FROM p GROUP BY 1),
e AS (SELECT ev.*, (SELECT max(idx) FROM cal WHERE as_of_date <= CAST(trim(day) AS DATE)) AS idx FROM ev WHERE ccn IS NOT NULL)
{{what}}
FROM e LEFT JOIN p ON e.ccn = p.ccn AND e.idx = p.idx LEFT JOIN s ON e.ccn = s.ccn WHERE p.ccn IS NULL"""
_REASON = "CASE WHEN s.lo < e.idx THEN 'DELETED' WHEN s.hi > coalesce(e.idx, -1) THEN 'LATE' ELSE 'MISSING' END AS reason"
P3_REPORT = _P3.replace("{what}", f"SELECT e.source_table, strftime(CAST(trim(day) AS DATE), '%Y-%m') AS period, {_REASON}, CAST(count(*) AS BIGINT) AS n") + " GROUP BY ALL"
P3 = _P3.replace("{what}", f"SELECT DISTINCT e.source_table, e.record_id, {_REASON}")

_DAY = "CASE WHEN regexp_full_match(trim({d}), '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(trim({d}) AS DATE) WHEN regexp_full_match(trim({d}), '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN TRY_CAST(split_part(trim({d}), '/', 3) || '-' || lpad(split_part(trim({d}), '/', 1), 2, '0') || '-' || lpad(split_part(trim({d}), '/', 2), 2, '0') AS DATE) END"

P4 = f"""WITH {_SNAPSHOTS}, {_EVENTS.format(ccn=_CCN.format(c='cms_certification_number_ccn'), hd=_DAY.format(d='survey_date'), pn=_DAY.format(d='penalty_date'))},
k AS (
  SELECT {_CCN.format(c='cms_certification_number_ccn')} AS ccn, as_of_date, CAST(_ingest_date AS DATE) AS ing, load_timestamp AS lt, {_OWN} AS own
  FROM provider_info JOIN fullb ON _batch_id = batch_id WHERE trim(ownership_type) <> ''),
kd AS (SELECT ccn, ing, max({{'a': as_of_date, 'i': ing, 'l': lt, 'o': own}}) AS best FROM k WHERE ccn IS NOT NULL AND ing IS NOT NULL GROUP BY 1, 2),
kr AS (SELECT ccn, ing, max(best) OVER (PARTITION BY ccn ORDER BY ing) AS best, max(best) OVER (PARTITION BY ccn) AS final FROM kd)
SELECT DISTINCT ev.source_table, ev.record_id, strftime(kr.best.a, '%Y-%m-%d') AS known_as_of
FROM ev ASOF JOIN kr ON ev.ccn = kr.ccn AND ev.day >= kr.ing WHERE kr.best.o <> kr.final.o"""


def _p6_side(table: str, column: str, valid: str, extra: str) -> str:
    return f"""SELECT '{table}' AS t, '{column}' AS c, _batch_id AS b, min(processing_date) AS pd, count(*) AS n,
      count(*) FILTER (coalesce(trim({column}), '') = '') AS blanks,
      count(*) FILTER (regexp_full_match(trim({column}), '{valid}')) AS ok, {extra}
      FROM {table} GROUP BY _batch_id HAVING count(*) >= 30"""


_AMOUNT = "CASE WHEN regexp_full_match(trim(fine_amount), '-?[0-9]{1,12}([.][0-9]{1,2})?') THEN CAST(trim(fine_amount) AS DOUBLE) END"
_NO_AMOUNT = "NULL::DOUBLE AS med, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi"
_NO_CODES = f"[{', '.join('0' for _ in 'ABCDEFGHIJKL')}]::BIGINT[] AS codes"
_COUNTS = ", ".join(f"count(*) FILTER (upper(trim(scope_severity_code)) = '{x}')" for x in "ABCDEFGHIJKL")
_CODES = f"[{_COUNTS}]::BIGINT[] AS codes"
P6 = f"""WITH s AS (
  {_p6_side('health_deficiencies', 'scope_severity_code', '[A-La-l]', _NO_AMOUNT + ', ' + _CODES)}
  UNION ALL {_p6_side('health_deficiencies', 'zip_code', '[0-9]{5}', _NO_AMOUNT + ', ' + _NO_CODES)}
  UNION ALL {_p6_side('penalties', 'zip_code', '[0-9]{5}', _NO_AMOUNT + ', ' + _NO_CODES)}
  UNION ALL {_p6_side('penalties', 'fine_amount', '-?[0-9]{1,12}([.][0-9]{1,2})?', f'median({_AMOUNT}) AS med, min({_AMOUNT}) AS lo, max({_AMOUNT}) AS hi, ' + _NO_CODES)}),
l AS (SELECT *, lag(n) OVER w AS pn, lag(blanks) OVER w AS pb, lag(ok) OVER w AS po, lag(med) OVER w AS pm, lag(hi) OVER w AS ph, lag(codes) OVER w AS pc FROM s WINDOW w AS (PARTITION BY t, c ORDER BY pd, b)),
f AS (
  SELECT t, c, b, 'PATTERN' AS f FROM l WHERE n > blanks AND (n - blanks - ok) / (n - blanks) > 0.05
  UNION ALL SELECT t, c, b, 'NULL_RATE' FROM l WHERE abs(blanks / n - pb / pn) > 0.15
  UNION ALL SELECT t, c, b, 'DISTRIBUTION' FROM l WHERE c = 'scope_severity_code' AND ok > 0 AND po > 0 AND list_sum([abs(x[1] / ok - x[2] / po) FOR x IN list_zip(codes, pc)]) / 2 > 0.3
  UNION ALL SELECT t, c, b, 'DISTRIBUTION' FROM l WHERE c = 'fine_amount' AND (med > 3 * pm OR med < pm / 3)
  UNION ALL SELECT t, c, b, 'DISTINCT' FROM l WHERE c = 'scope_severity_code' AND len([x FOR x IN pc IF x > 0]) > 0 AND 2 * len([x FOR x IN codes IF x > 0]) <= len([x FOR x IN pc IF x > 0])
  UNION ALL SELECT t, c, b, 'RANGE' FROM l WHERE c = 'fine_amount' AND (lo < 0 OR hi > 10 * ph))
SELECT t AS source_table, c AS column_name, b AS batch_id, f AS finding FROM f"""

SQL = {"p1_found": P1, "p2_found": P2, "p3_found": P3, "p3_report": P3_REPORT, "p4_found": P4, "p6_found": P6}
