"""Queries for the operators of the reference's inventory on the driver tables, each beside its independent SQL.

The driver tables are clean, so some queries inject blanks, nulls and bad values by fixed expressions in both engines.
Every query runs over its whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.keys import entity_key, json_digest, salted_digest, severity_group
from ledgerloom.functions.rules import RuleSpec, Subtype, judge, typed
from ledgerloom.functions.values import blank_to_null, flexible_date
from ledgerloom.operators import control, evidence, merge
from ledgerloom.operators.audit import MANIFEST_SCHEMA
from ledgerloom.operators.classify import ACCEPTED, CONFLICT, DUPLICATE, classify, transform
from ledgerloom.operators.drift import consistent_table, drift_report
from ledgerloom.operators.versioned import BatchTable, VersionedTable
from ledgerloom.pipeline import Lake, run_bronze, run_silver
from ledgerloom.plans import problems
from ledgerloom.plans.rule_sql import PENALTY_STATUSES, QUARANTINED_PENALTIES, SILVER_DEFICIENCIES, SILVER_PROVIDERS
from ledgerloom.session import cut_lineage, scratch_dir, spread, table
from ledgerloom.sources.files import CORRUPT, file_digest, quarantined, read_csv, read_page
from ledgerloom.sources.storage import Storage
from ledgerloom.spec import dataset

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# ---- text orders with injected faults ---------------------------------------------------------------------------------

_ORDERS = """o AS (SELECT CAST(o_orderkey AS VARCHAR) AS k,
  CASE WHEN o_orderkey % 17 = 0 THEN '   ' WHEN o_orderkey % 19 = 0 THEN NULL ELSE ' ' || o_orderstatus || ' ' END AS status,
  CASE WHEN o_orderkey % 23 = 0 THEN 'N/A' WHEN o_orderkey % 29 = 0 THEN '-5.00' ELSE CAST(o_orderkey % 1000 AS VARCHAR) || '.50' END AS price,
  CASE WHEN o_orderkey % 31 = 0 THEN '2024-13-45' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE WHEN o_orderkey % 37 = 0 THEN '9-NONE' ELSE lower(o_orderpriority) END AS priority,
  CASE WHEN o_custkey % 3 = 0 THEN 'y' WHEN o_custkey % 3 = 1 THEN 'N' ELSE 'maybe' END AS flag, o_orderkey FROM orders)"""

_RULES = RuleSpec(
    source=("k", "status", "price", "day", "priority", "flag"),
    types={"price": "decimal(14,2)", "day": "date"},
    flags=("flag",),
    upper=("priority",),
    required=("k", "status", "day"),
    regex={"priority": "[0-9]-[A-Z ]+"},
    domain={"status": ("O", "F")},
    ranges={"price": (0, 900)},
    non_negative=("price",),
)


def _text_orders(spark: SparkSession, d: str) -> DataFrame:
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("k"),
        F.when(k % 17 == 0, "   ").when(k % 19 == 0, F.lit(None)).otherwise(F.concat(F.lit(" "), "o_orderstatus", F.lit(" "))).alias("status"),
        F.when(k % 23 == 0, "N/A").when(k % 29 == 0, "-5.00").otherwise(F.concat((k % 1000).cast("string"), F.lit(".50"))).alias("price"),
        F.when(k % 31 == 0, "2024-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(k % 37 == 0, "9-NONE").otherwise(F.lower("o_orderpriority")).alias("priority"),
        F.when(F.col("o_custkey") % 3 == 0, "y").when(F.col("o_custkey") % 3 == 1, "N").otherwise("maybe").alias("flag"),
        "o_orderkey",
    )


def _typed_orders(spark: SparkSession, d: str) -> DataFrame:
    judged = judge(_text_orders(spark, d), _RULES)
    return judged.select("o_orderkey", *(F.col(f"v_{c}").alias(c) for c in _RULES.source), "failed")


_TYPED = f"""{_ORDERS}, t AS (SELECT o_orderkey, k, NULLIF(trim(status), '') AS status, TRY_CAST(price AS DECIMAL(14, 2)) AS price, price AS praw, TRY_CAST(day AS DATE) AS day, day AS draw,
  upper(priority) AS priority, CASE upper(flag) WHEN 'Y' THEN true WHEN 'N' THEN false END AS flag FROM o),
r AS (SELECT *, [x FOR x IN [CASE WHEN k IS NULL THEN 'REQUIRED:k' END, CASE WHEN status IS NULL THEN 'REQUIRED:status' END, CASE WHEN day IS NULL THEN 'REQUIRED:day' END,
  CASE WHEN price IS NULL THEN 'SAFE_CAST:price' END, CASE WHEN day IS NULL AND draw IS NOT NULL THEN 'SAFE_CAST:day' END, CASE WHEN flag IS NULL THEN 'DOMAIN_YN:flag' END,
  CASE WHEN NOT regexp_full_match(priority, '[0-9]-[A-Z ]+') THEN 'REGEX:priority' END, CASE WHEN status NOT IN ('O', 'F') THEN 'DOMAIN:status' END,
  CASE WHEN price < 0 OR price > 900 THEN 'RANGE:price' END, CASE WHEN price < 0 THEN 'NON_NEGATIVE:price' END] IF x IS NOT NULL] AS failed FROM t)"""


@query(f"WITH {_TYPED} SELECT priority, CAST(count(*) AS BIGINT) AS n, CAST(sum(price) AS DECIMAL(24, 2)) AS total FROM r WHERE len(failed) = 0 GROUP BY priority")
def silver_orders_by_priority(spark, d):
    good = _typed_orders(spark, d).filter(F.size("failed") == 0)
    return good.groupBy("priority").agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(24,2)").alias("total"))


@query(f"WITH {_TYPED} SELECT o_orderkey, array_to_string(failed, '|') AS failed FROM r")
def failed_rule_array(spark, d):
    return _typed_orders(spark, d).select("o_orderkey", F.array_join("failed", "|").alias("failed"))


@query(f"WITH {_TYPED} SELECT unnest AS rule, CAST(count(*) AS BIGINT) AS n FROM r, unnest(failed) GROUP BY 1")
def rule_histogram(spark, d):
    return _typed_orders(spark, d).select(F.explode("failed").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_quantity AS VARCHAR) AS l_quantity, l_returnflag, 'lineitem' AS _dataset_id FROM lineitem")
def bronze_stringify(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(*(F.col(c).cast("string").alias(c) for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")), F.lit("lineitem").alias("_dataset_id"))


@query(f"WITH {_ORDERS} SELECT o_orderkey, NULLIF(trim(status), '') AS status FROM o")
def trim_blank_to_null(spark, d):
    return _text_orders(spark, d).select("o_orderkey", blank_to_null("status").alias("status"))


@query("SELECT l_orderkey, l_linenumber, CASE CASE l_linestatus WHEN 'O' THEN 'y' WHEN 'F' THEN 'N' ELSE '?' END WHEN 'y' THEN true WHEN 'N' THEN false END AS flag FROM lineitem")
def yn_boolean(spark, d):
    spec = RuleSpec(source=("f",), flags=("f",))
    text = F.when(F.col("l_linestatus") == "O", "y").when(F.col("l_linestatus") == "F", "N").otherwise("?")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", typed(spec, "f", text).alias("flag"))


@query("""SELECT p_partkey, CASE WHEN c IN ('A','B','C') THEN 'A-C' WHEN c IN ('D','E','F') THEN 'D-F' WHEN c IN ('G','H','I') THEN 'G-I' ELSE 'J-L' END AS band
FROM (SELECT p_partkey, substr('ABCDEFGHIJKL', CAST(p_size % 12 + 1 AS INT), 1) AS c FROM part)""")
def severity_band(spark, d):
    letter = F.substring(F.lit("ABCDEFGHIJKL"), F.col("p_size") % 12 + 1, F.lit(1))
    return table(spark, d, "part").select("p_partkey", severity_group(F.lower(letter)).alias("band"))


@query(f"WITH {_ORDERS} SELECT o_orderkey, price FROM o WHERE price IS NOT NULL AND TRY_CAST(price AS DECIMAL(14, 2)) IS NULL")
def safe_cast_failures(spark, d):
    return _text_orders(spark, d).filter(F.col("price").isNotNull() & F.col("price").try_cast("decimal(14,2)").isNull()).select("o_orderkey", "price")


def _one_rule(df: DataFrame, keys: list[str], column: str, **rules) -> DataFrame:
    """``keys``, the typed value ``v`` and the failed rules of one column, through the compiled rules."""
    spec = RuleSpec(source=(column,), **rules)
    judged = judge(df.select(*keys, F.col(column).cast("string").alias(column)), spec)
    return judged.select(*keys, F.col(f"v_{column}").alias("v"), "failed")


@query("SELECT c_custkey, regexp_full_match(c_name, 'Customer#[0-9]{6}[1-8]{3}') AS ok FROM customer")
def regex_rule(spark, d):
    judged = _one_rule(table(spark, d, "customer"), ["c_custkey"], "c_name", regex={"c_name": "Customer#[0-9]{6}[1-8]{3}"})
    return judged.select("c_custkey", (F.size("failed") == 0).alias("ok"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def domain_rule(spark, d):
    judged = _one_rule(table(spark, d, "customer"), ["c_custkey"], "c_mktsegment", domain={"c_mktsegment": ("BUILDING", "MACHINERY")})
    return judged.filter(F.array_contains("failed", "DOMAIN:c_mktsegment")).select("c_custkey", F.col("v").alias("c_mktsegment"))


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.08")
def range_rule(spark, d):
    judged = _one_rule(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_discount", types={"l_discount": "double"}, ranges={"l_discount": (0.02, 0.08)})
    return judged.filter(F.array_contains("failed", "RANGE:l_discount")).select("l_orderkey", "l_linenumber", F.col("v").alias("l_discount"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def non_negative_rule(spark, d):
    judged = _one_rule(table(spark, d, "customer"), ["c_custkey"], "c_acctbal", types={"c_acctbal": "double"}, non_negative=("c_acctbal",))
    return judged.filter(F.array_contains("failed", "NON_NEGATIVE:c_acctbal")).select("c_custkey", F.col("v").alias("c_acctbal"))


_SUB = """s AS (SELECT l_orderkey, l_linenumber, l_returnflag AS kind, CASE WHEN l_returnflag = 'R' OR l_suppkey % 7 = 0 THEN 'x' END AS fine, CASE WHEN l_returnflag <> 'R' AND l_partkey % 5 > 0 THEN 'y' END AS denial FROM lineitem)"""


@query(f"""WITH {_SUB} SELECT l_orderkey, l_linenumber, CASE WHEN kind = 'R' AND (fine IS NULL OR denial IS NOT NULL) THEN 'CONDITIONAL:fine' WHEN kind = 'A' AND (denial IS NULL OR fine IS NOT NULL) THEN 'CONDITIONAL:denial' ELSE '' END AS failed FROM s""")
def conditional_subtype(spark, d):
    li = table(spark, d, "lineitem")
    raw = li.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("kind"), F.when((F.col("l_returnflag") == "R") | (F.col("l_suppkey") % 7 == 0), "x").alias("fine"), F.when((F.col("l_returnflag") != "R") & (F.col("l_partkey") % 5 > 0), "y").alias("denial"))
    spec = RuleSpec(source=("kind", "fine", "denial"), conditional=(Subtype("fine", "kind", "R", ("fine",), ("denial",)), Subtype("denial", "kind", "A", ("denial",), ("fine",))))
    return judge(raw, spec).select("l_orderkey", "l_linenumber", F.array_join("failed", "|").alias("failed"))


# ---- keys, conflicts, duplicates --------------------------------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0 THEN sha256(CAST(to_json(struct_pack(a := o_orderkey, b := CASE WHEN o_custkey % 4 > 0 THEN o_orderstatus END)) AS VARCHAR)) END AS key FROM orders")
def entity_keys(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 > 0, F.col("o_orderkey")).alias("a"), F.when(F.col("o_custkey") % 4 > 0, F.col("o_orderstatus")).alias("b"))
    return o.select("o_orderkey", entity_key(["a", "b"], ["b"]).alias("key"))


@query("SELECT l_orderkey, l_linenumber, sha256(CAST(to_json(struct_pack(l_partkey := l_partkey, l_returnflag := l_returnflag, l_linestatus := l_linestatus)) AS VARCHAR)) AS row_hash FROM lineitem")
def row_hashes(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", json_digest(["l_partkey", "l_returnflag", "l_linestatus"]).alias("row_hash"))


@query("SELECT c_custkey, sha256(concat(upper(trim(c_name)), 'test-salt')) AS digest FROM customer")
def address_hash(spark, d):
    return table(spark, d, "customer").select("c_custkey", salted_digest(F.col("c_name"), "test-salt").alias("digest"))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    li = spread(table(spark, d, "lineitem")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array().cast("array<string>").alias("failed"))
    again = li.filter("l_suppkey % 9 = 0")
    both = li.unionByName(again)
    return both.withColumn("key", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))).withColumn("digest", json_digest(["l_partkey", "l_suppkey"]))


_CLASSES = """l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_suppkey % 9 = 0),
k AS (SELECT *, count(DISTINCT (l_partkey, l_suppkey)) OVER (PARTITION BY l_orderkey, l_linenumber) AS kinds, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM l),
c AS (SELECT *, CASE WHEN kinds > 1 THEN 'CONFLICT' WHEN rn > 1 THEN 'DUPLICATE' ELSE 'ACCEPTED' END AS status FROM k)"""


@query(f"WITH {_CLASSES} SELECT status, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY status")
def classify_conservation(spark, d):
    return classify(_lines(spark, d), "key", "digest", "failed", [F.col("l_partkey")]).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(DISTINCT (l_partkey, l_suppkey, l_quantity)) > 1")
def conflicting_keys(spark, d):
    li = spread(table(spark, d, "lineitem")).withColumn("h", json_digest(["l_partkey", "l_suppkey", "l_quantity"]))
    keyed = li.select("l_orderkey", "l_linenumber", "h", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"), F.array().cast("array<string>").alias("failed"))
    return classify(keyed, "key", "h", "failed", [F.col("l_orderkey")]).filter(F.col("status") == CONFLICT).select("l_orderkey", "l_linenumber").distinct()


@query("SELECT min(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS copies FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1")
def exact_duplicates(spark, d):
    docs = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("h"), F.array().cast("array<string>").alias("failed"))
    marked = classify(docs, "h", "h", "failed", [F.col("doc_id")])
    kept = F.min(F.when(F.col("status") == ACCEPTED, F.col("doc_id")))
    return marked.groupBy("h").agg(kept.alias("doc_id"), F.count_if(F.col("status") == DUPLICATE).alias("extra")).filter("extra > 0").select("doc_id", (F.col("extra") + 1).alias("copies"))


def _rejected(spark: SparkSession, d: str) -> DataFrame:
    bad = judge(_text_orders(spark, d), _RULES).filter(F.size("failed") > 0)
    return bad.select(F.lit("orders").alias("dataset"), F.col("k").alias("candidate_entity_key"), "c_status", F.concat_ws("|", F.coalesce("status", F.lit("~")), "price", "day").alias("raw_record"), F.array_sort("failed").alias("failed_rules"))


@query(QUARANTINED_PENALTIES)
def quarantine_projection(spark, d):
    """The Silver quarantine of all penalties, as the Bronze-to-Silver pass makes it."""
    done = transform(table(spark, d, "penalties"), dataset("penalties"), "test-salt", strict_dates=True)
    return done.quarantine.drop("load_timestamp").withColumn("failed_rules", F.array_join("failed_rules", "|"))


@query(f"""WITH {_TYPED}, q AS (SELECT DISTINCT r.k, NULLIF(trim(o.status), '') AS s, array_to_string(list_sort(failed), '|') AS f FROM r JOIN o USING (o_orderkey) WHERE len(failed) > 0)
SELECT k AS candidate_entity_key, s AS status, f AS failed_rules FROM q a WHERE NOT EXISTS (SELECT 1 FROM q b WHERE contains(b.f, 'price') AND b.k IS NOT DISTINCT FROM a.k AND b.s IS NOT DISTINCT FROM a.s AND b.f IS NOT DISTINCT FROM a.f)""")
def idempotent_quarantine(spark, d):
    q = _rejected(spark, d).select("candidate_entity_key", F.col("c_status").alias("status"), "failed_rules")
    fresh = merge.append_once(q.filter(F.exists("failed_rules", lambda r: r.contains("price"))), q.unionByName(q), ["candidate_entity_key", "status", "failed_rules"])
    return fresh.withColumn("failed_rules", F.array_join("failed_rules", "|"))


# ---- merge ------------------------------------------------------------------------------------------------------------

_SIDES = """t AS (SELECT o_orderkey AS k, o_custkey % 10 AS h, CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderdate AS DATE) END AS day, o_orderkey % 13 = 0 AS del FROM orders),
s AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS k, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 10 ELSE 99 END AS h, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 - 2 AS INT) END AS day, false AS del FROM orders),
j AS (SELECT coalesce(t.k, s.k) AS k, t.h AS th, s.h AS sh, t.day AS td, s.day AS sd, t.del AS tdel, CASE WHEN t.k IS NULL THEN 'INSERT' WHEN s.k IS NULL THEN 'MISSING' WHEN s.h = t.h AND NOT t.del THEN 'KEEP'
  WHEN s.day IS NOT NULL AND (t.day IS NULL OR s.day >= t.day) THEN 'UPDATE' ELSE 'STALE' END AS action FROM t FULL JOIN s ON t.k = s.k)"""


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    target = o.select(k.alias("k"), (F.col("o_custkey") % 10).alias("row_hash"), F.when(k % 11 > 0, day).alias("source_processing_date"), (k % 13 == 0).alias("is_deleted"))
    shifted = F.date_add(day, (k % 5 - 2).cast("int"))
    source = o.select(F.when(k % 5 == 0, -k - 1).otherwise(k).alias("k"), F.when(k % 2 == 0, F.col("o_custkey") % 10).otherwise(99).alias("row_hash"), F.when(k % 7 > 0, shifted).alias("source_processing_date"), F.lit(False).alias("is_deleted"))
    return target, source


@query(f"WITH {_SIDES} SELECT action, CAST(count(*) AS BIGINT) AS n FROM j GROUP BY action")
def merge_counts(spark, d):
    return merge.action_counts(merge.merge_actions(*_sides(spark, d), "k"))


@query(f"WITH {_SIDES} SELECT k, CASE WHEN action IN ('INSERT', 'UPDATE') THEN sh ELSE th END AS row_hash, CASE WHEN action IN ('INSERT', 'UPDATE') THEN sd ELSE td END AS source_processing_date, CASE WHEN action IN ('INSERT', 'UPDATE') THEN false ELSE tdel END AS is_deleted FROM j")
def merge_scd1(spark, d):
    target, source = _sides(spark, d)
    return merge.apply_merge(merge.merge_actions(target, source, "k"), target.columns)


@query(f"WITH {_SIDES} SELECT k FROM j WHERE action = 'STALE'")
def merge_stale(spark, d):
    return merge.merge_actions(*_sides(spark, d), "k").filter("action = 'STALE'").select("k")


@query(f"WITH {_SIDES} SELECT t.k, t.del OR (s.k IS NULL AND NOT t.del AND t.day IS NOT NULL AND t.day <= DATE '1998-06-01') AS is_deleted FROM t LEFT JOIN s ON t.k = s.k")
def soft_delete(spark, d):
    target, source = _sides(spark, d)
    return merge.soft_delete(target, source, "k", F.lit("1998-06-01").cast("date")).select("k", "is_deleted")


@query("""WITH a AS (SELECT user_id, max(ts) AS ts FROM events GROUP BY 1), b AS (SELECT user_id + 5 AS user_id, max(ts + INTERVAL 1 DAY) AS ts FROM events GROUP BY 1)
SELECT coalesce(a.user_id, b.user_id) AS user_id, greatest(a.ts, b.ts) AS ts FROM a FULL JOIN b ON a.user_id = b.user_id""")
def watermark_monotone(spark, d):
    e = table(spark, d, "events")
    later = e.select((F.col("user_id") + 5).alias("user_id"), (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    newest = lambda df: df.groupBy("user_id").agg(F.max("ts").alias("ts"))
    return merge.advance_watermarks(newest(e), newest(later), "user_id", "ts")


# ---- control ----------------------------------------------------------------------------------------------------------


_CONTROL = """mf AS (SELECT *, row_number() OVER (PARTITION BY dataset, batch_id ORDER BY load_timestamp DESC) AS rn, row_number() OVER (PARTITION BY acquisition_run_id, dataset, batch_id, landing_path ORDER BY load_timestamp DESC) AS rp
  FROM source_file_manifest WHERE status IN ('SUCCESS', 'SKIPPED_ALREADY_ACQUIRED')),
lg AS (SELECT DISTINCT dataset, batch_id, 'Raw-to-Bronze' AS layer FROM source_file_manifest WHERE source_bytes % 3 > 0 UNION SELECT DISTINCT dataset, batch_id, 'Bronze-to-Silver' FROM source_file_manifest WHERE source_bytes % 5 = 1)"""


def _logs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    m = table(spark, d, "source_file_manifest")
    one = lambda cond, layer: m.filter(cond).select("dataset", "batch_id", F.lit("r").alias("run_id"), F.lit(layer).alias("pipeline_layer"), F.lit("SUCCESS").alias("status"))
    return m, one(F.col("source_bytes") % 3 > 0, "Raw-to-Bronze").unionByName(one(F.col("source_bytes") % 5 == 1, "Bronze-to-Silver"))


@query("SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1")
def latest_per_key(spark, d):
    return control.latest(table(spark, d, "events"), ["user_id"], [F.desc("ts"), F.col("event_id")]).select("user_id", "event_id", "ts")


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, value DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def newest_snapshot_per_type(spark, d):
    return control.latest(table(spark, d, "events"), ["event_type"], [F.desc("ts"), F.desc("value"), F.desc("event_id")]).select("event_type", "event_id")


@query(f"""WITH {_CONTROL}, s AS (SELECT m.*, row_number() OVER (PARTITION BY dataset ORDER BY as_of_date DESC, load_timestamp DESC) AS r FROM source_file_manifest m
  WHERE status IN ('SUCCESS', 'SKIPPED_ALREADY_ACQUIRED') AND row_count_validated AND acquisition_strategy IN ('bulk_snapshot', 'snapshot_diff') AND EXISTS (SELECT 1 FROM lg WHERE layer = 'Raw-to-Bronze' AND lg.dataset = m.dataset AND lg.batch_id = m.batch_id))
SELECT dataset, as_of_date, load_timestamp FROM s WHERE r = 1""")
def newest_validated_snapshot(spark, d):
    return control.newest_snapshot(*_logs(spark, d)).select("dataset", "as_of_date", "load_timestamp")


@query("SELECT event_type, max(ts) AS watermark_value FROM events GROUP BY 1")
def top1_watermark(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("dataset"), F.col("ts").alias("watermark_value"), F.col("ts").alias("load_timestamp"))
    return control.current_watermark(e).withColumnRenamed("dataset", "event_type")


@query("SELECT CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS priority, o_orderkey FROM orders ORDER BY priority ASC NULLS FIRST, o_orderkey LIMIT 50")
def nulls_first_sort(spark, d):
    o = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")).alias("priority"), "o_orderkey")
    return o.orderBy(F.col("priority").asc_nulls_first(), "o_orderkey").limit(50)


@query(f"""WITH {_CONTROL} SELECT m.dataset, m.batch_id FROM mf m WHERE rn = 1 AND EXISTS (SELECT 1 FROM lg WHERE layer = 'Raw-to-Bronze' AND lg.dataset = m.dataset AND lg.batch_id = m.batch_id)
AND NOT EXISTS (SELECT 1 FROM lg WHERE layer = 'Bronze-to-Silver' AND lg.dataset = m.dataset AND lg.batch_id = m.batch_id)""")
def work_selection(spark, d):
    return control.silver_work(*_logs(spark, d)).select("dataset", "batch_id")


@query(f"""WITH {_CONTROL}, x AS (SELECT m.*, EXISTS (SELECT 1 FROM lg WHERE layer = 'Raw-to-Bronze' AND lg.dataset = m.dataset AND lg.batch_id = m.batch_id) AS done FROM mf m WHERE rp = 1)
SELECT dataset, batch_id, landing_path, acquisition_run_id FROM x WHERE NOT coalesce(row_count_validated, false) OR NOT done""")
def manifest_scope(spark, d):
    return control.manifest_selection(*_logs(spark, d))[0].select("dataset", "batch_id", "landing_path", "acquisition_run_id")


@query(f"""WITH {_CONTROL}, i AS (SELECT m.*, EXISTS (SELECT 1 FROM lg WHERE layer = 'Raw-to-Bronze' AND lg.dataset = m.dataset AND lg.batch_id = m.batch_id) AS done FROM mf m WHERE rp = 1)
SELECT dataset, acquisition_run_id, count(DISTINCT expected_run_rows) = 1 AND count(*) FILTER (source_rows IS NULL) = 0 AND sum(source_rows) = max(expected_run_rows)
  AND (NOT bool_or(acquisition_strategy = 'api_date_window') OR (count(*) FILTER (page_offset IS NULL) = 0 AND count(DISTINCT page_offset) = count(*) AND min(page_offset) = 0 AND max(page_offset) = (count(*) - 1) * 500 AND count(*) FILTER (page_offset % 500 <> 0) = 0))
  AND bool_and(done) AND count(DISTINCT window_end) <= 1 AND (count(DISTINCT window_end) = 1 OR count(DISTINCT as_of_date) = 1) AS complete FROM i GROUP BY 1, 2""")
def reconcile_runs(spark, d):
    return control.reconcile_runs(*_logs(spark, d)).select("dataset", "acquisition_run_id", "complete")


@query(f"""WITH {_CONTROL}, r AS (SELECT dataset, window_start, window_end, acquisition_run_id, max(load_timestamp) AS newest,
  bool_and(EXISTS (SELECT 1 FROM lg WHERE layer = 'Raw-to-Bronze' AND lg.dataset = m.dataset AND lg.batch_id = m.batch_id)) AS bronze_complete
  FROM source_file_manifest m WHERE acquisition_strategy = 'api_date_window' AND load_type = 'incremental' AND (window_start IS NOT NULL OR window_end IS NOT NULL) GROUP BY 1, 2, 3, 4
  HAVING count(DISTINCT expected_run_rows) = 1 AND count(*) FILTER (source_rows IS NULL OR status NOT IN ('SUCCESS', 'SKIPPED_ALREADY_ACQUIRED')) = 0 AND sum(source_rows) = max(expected_run_rows)
  AND count(DISTINCT page_offset) = count(*) AND min(page_offset) = 0 AND max(page_offset) = (count(*) - 1) * 500)
SELECT dataset, window_start, window_end, acquisition_run_id, bronze_complete FROM (SELECT *, row_number() OVER (PARTITION BY dataset, window_start, window_end ORDER BY newest DESC, acquisition_run_id DESC) AS rn FROM r) WHERE rn = 1""")
def complete_api_windows(spark, d):
    return control.complete_windows(*_logs(spark, d)).drop("paths")


@query("SELECT event_id, CAST(ts AS DATE) - 60 AS window_start FROM events")
def overlap_window(spark, d):
    """Each event as the only watermark of a dataset of its own."""
    marks = table(spark, d, "events").select(F.col("event_id").alias("dataset"), F.to_date("ts").alias("watermark_value"), F.col("ts").alias("load_timestamp"))
    return control.window_starts(marks).select(F.col("dataset").alias("event_id"), "window_start")


@query("SELECT landing_path, min(row_no) = 0 AND max(row_no) = count(*) - 1 AND count(DISTINCT row_no) = count(*) AS contiguous FROM landing_records GROUP BY 1")
def page_contiguity(spark, d):
    g = table(spark, d, "landing_records").groupBy("landing_path").agg(F.min("row_no").alias("lo"), F.max("row_no").alias("hi"), F.countDistinct("row_no").alias("offsets"), F.count(F.lit(1)).alias("n"))
    return g.select("landing_path", control.contiguous(F.col("lo"), F.col("hi"), F.col("offsets"), F.col("n"), 1).alias("contiguous"))


@query(f"""WITH {_CONTROL}, b AS (SELECT *, row_number() OVER (PARTITION BY dataset, batch_id ORDER BY load_timestamp DESC, acquisition_run_id DESC, landing_path DESC) AS rb FROM source_file_manifest),
f AS (SELECT dataset, acquisition_run_id, count(DISTINCT batch_id) AS files FROM source_file_manifest WHERE status IN ('SUCCESS', 'SKIPPED_ALREADY_ACQUIRED') GROUP BY 1, 2),
s AS (SELECT m.dataset, m.batch_id, row_number() OVER (PARTITION BY m.dataset ORDER BY as_of_date DESC, load_timestamp DESC, batch_id DESC) AS r FROM source_file_manifest m
  WHERE status IN ('SUCCESS', 'SKIPPED_ALREADY_ACQUIRED') AND row_count_validated AND acquisition_strategy IN ('bulk_snapshot', 'snapshot_diff') AND EXISTS (SELECT 1 FROM lg WHERE layer = 'Raw-to-Bronze' AND lg.dataset = m.dataset AND lg.batch_id = m.batch_id)),
q AS (SELECT DISTINCT dataset, batch_id FROM source_file_manifest WHERE source_bytes % 4 = 0)
SELECT b.dataset, b.batch_id, array_to_string([x FOR x IN [CASE WHEN NOT coalesce(acquisition_strategy IN ('bulk_snapshot', 'snapshot_diff'), false) THEN 'NO_SNAPSHOT' END,
  CASE WHEN status NOT IN ('SUCCESS', 'SKIPPED_ALREADY_ACQUIRED') THEN 'NOT_ACQUIRED' END, CASE WHEN NOT coalesce(row_count_validated, false) THEN 'NOT_VALIDATED' END,
  CASE WHEN files IS DISTINCT FROM 1 THEN 'NOT_ONE_FILE' END, CASE WHEN expected_run_rows IS NULL OR source_rows IS NULL THEN 'COUNTS_UNKNOWN' END, CASE WHEN expected_run_rows <> source_rows THEN 'COUNTS_DIFFER' END,
  CASE WHEN expected_run_rows = source_rows AND source_rows <= 0 THEN 'EMPTY' END, CASE WHEN EXISTS (SELECT 1 FROM q WHERE q.dataset = b.dataset AND q.batch_id = b.batch_id) THEN 'QUARANTINED_ROWS' END,
  CASE WHEN NOT EXISTS (SELECT 1 FROM s WHERE r = 1 AND s.dataset = b.dataset AND s.batch_id = b.batch_id) THEN 'NOT_NEWEST' END] IF x IS NOT NULL], '|') AS blockers
FROM b LEFT JOIN f ON b.dataset = f.dataset AND b.acquisition_run_id = f.acquisition_run_id WHERE rb = 1""")
def deletion_gate(spark, d):
    m, logs = _logs(spark, d)
    held = m.filter(F.col("source_bytes") % 4 == 0).select("dataset", F.col("batch_id").alias("source_batch_id"))
    return merge.deletion_blockers(m, logs, held).withColumn("blockers", F.array_join("blockers", "|"))


# ---- tables, sets, evidence -------------------------------------------------------------------------------------------


@query("SELECT event_id, CASE WHEN user_id % 4 = 2 THEN value * 2 ELSE value END AS value FROM events WHERE user_id % 4 <> 3")
def batch_replace(spark, d):
    """Four batches written, one replaced by changed rows and one by none, then read back."""
    schema = "event_id bigint, value double, b string"
    e = table(spark, d, "events").select("event_id", "value", (F.col("user_id") % 4).cast("string").alias("b"))
    events = BatchTable(spark, f"{scratch_dir(spark)}/events", spark.createDataFrame([], schema).schema, "b")
    events.replace_many(e, {b: 1 for b in "0123"})
    events.replace(e.filter("b = '2'").withColumn("value", F.col("value") * 2), "2")
    events.replace(e.limit(0), "3")
    return events.read().select("event_id", "value")


@query("SELECT n_nationkey, n_name, NULL::VARCHAR AS note FROM nation WHERE n_regionkey < 2 UNION ALL SELECT n_nationkey, n_name, 'new' FROM nation WHERE n_regionkey >= 2")
def schema_evolve(spark, d):
    """A batch with a new column beside one without it."""
    n = table(spark, d, "nation")
    old, new = n.filter("n_regionkey < 2"), n.filter("n_regionkey >= 2").withColumn("note", F.lit("new"))
    nations = BatchTable(spark, f"{scratch_dir(spark)}/nations", spark.createDataFrame([], "n_nationkey int, n_name string, b string").schema, "b")
    nations.replace(old.select("n_nationkey", "n_name", F.lit("old").alias("b")), "old")
    nations.replace(new.select("n_nationkey", "n_name", "note", F.lit("new").alias("b")), "new")
    return nations.read(evolve=True).drop("b")


@query("SELECT r_regionkey, r_name, NULL::INT AS n_nationkey, NULL::VARCHAR AS n_name FROM region UNION ALL SELECT NULL, NULL, n_nationkey, n_name FROM nation")
def union_missing(spark, d):
    return table(spark, d, "region").unionByName(table(spark, d, "nation").select("n_nationkey", "n_name"), allowMissingColumns=True)


@query("""WITH a AS (SELECT o_custkey, o_orderstatus FROM orders), b AS (SELECT o_custkey, CASE WHEN o_orderkey % 40 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders)
SELECT 'left' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'right', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def except_all_both(spark, d):
    o = table(spark, d, "orders")
    changed = F.when(F.col("o_orderkey") % 40 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    return evidence.multiset_difference(o.select("o_custkey", "o_orderstatus"), o.select("o_custkey", changed))


@query("SELECT l_returnflag, CAST(count(DISTINCT (l_linenumber, CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey END)) AS BIGINT) AS n FROM lineitem GROUP BY 1")
def count_distinct_struct(spark, d):
    li = table(spark, d, "lineitem").withColumn("s", F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey")))
    return li.groupBy("l_returnflag").agg(F.countDistinct(F.struct("l_linenumber", "s")).alias("n"))


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT (l_orderkey, CASE WHEN l_suppkey % 7 > 0 THEN l_linenumber END)) AS BIGINT) AS distinct_keys, CAST(count(*) FILTER (l_suppkey % 7 = 0) AS BIGINT) AS null_key_rows FROM lineitem")
def key_profile(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_suppkey") % 7 > 0, F.col("l_linenumber")).alias("line"))
    return evidence.key_profile(li, ["l_orderkey", "line"])


def _evidence(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    m = table(spark, d, "source_file_manifest").filter("dataset IN ('penalties', 'health_deficiencies')").select("batch_id", "source_rows")
    both = table(spark, d, "penalties").select("_batch_id", "record_id").unionByName(table(spark, d, "health_deficiencies").select("_batch_id", "record_id"))
    return m, both.filter("record_id % 10 > 0"), both.filter("record_id % 10 = 0").withColumnRenamed("_batch_id", "batch_id")


@query("""WITH m AS (SELECT batch_id, source_rows FROM source_file_manifest WHERE dataset IN ('penalties', 'health_deficiencies')),
a AS (SELECT _batch_id AS b, record_id FROM penalties UNION ALL SELECT _batch_id, record_id FROM health_deficiencies),
g AS (SELECT b, count(*) FILTER (record_id % 10 > 0) AS good, count(*) FILTER (record_id % 10 = 0) AS bad FROM a GROUP BY 1)
SELECT batch_id, source_rows, CAST(coalesce(good, 0) AS BIGINT) AS bronze_rows, CAST(coalesce(bad, 0) AS BIGINT) AS quarantine_rows, coalesce(source_rows = coalesce(good, 0) + coalesce(bad, 0), false) AS conserved FROM m LEFT JOIN g ON m.batch_id = g.b""")
def evidence_conservation(spark, d):
    return evidence.batch_conservation(*_evidence(spark, d))


@query("""WITH g AS (SELECT _batch_id AS batch_id, count(*) AS n FROM penalties GROUP BY 1)
SELECT m.batch_id, CAST(count(*) AS BIGINT) AS attempts, max(m.source_rows) AS expected_rows, CAST(coalesce(any_value(g.n), 0) AS BIGINT) AS bronze_rows, coalesce(coalesce(any_value(g.n), 0) = max(m.source_rows), false) AS idempotent
FROM source_file_manifest m LEFT JOIN g ON g.batch_id = m.batch_id WHERE m.status = 'SUCCESS' GROUP BY m.batch_id""")
def evidence_idempotency(spark, d):
    """Every successful delivery of the manifest as a load: most of its batches are not in this Bronze table, as if they had vanished."""
    logs = table(spark, d, "source_file_manifest").select("batch_id", "status", F.lit("Raw-to-Bronze").alias("pipeline_layer"), F.col("source_rows").alias("rows_inserted"))
    return evidence.rerun_idempotency(table(spark, d, "penalties"), logs)


@query("""SELECT dataset, acquisition_strategy AS pipeline_layer, CAST(count(*) AS BIGINT) AS attempts, CAST(count(*) FILTER (status = 'FAILURE') AS BIGINT) AS failed, CAST(count(*) FILTER (source_rows = 0) AS BIGINT) AS zero_insert, CAST(count(*) FILTER (source_rows % 2 = 0) AS BIGINT) AS zero_update FROM source_file_manifest GROUP BY 1, 2""")
def attempt_summary(spark, d):
    logs = table(spark, d, "source_file_manifest").select("dataset", F.col("acquisition_strategy").alias("pipeline_layer"), "status", F.col("source_rows").alias("rows_inserted"), (F.col("source_rows") % 2).alias("rows_updated"))
    return evidence.attempts(logs)


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT cms_certification_number_ccn) AS BIGINT) AS distinct_keys, CAST(count(*) FILTER (is_deleted) AS BIGINT) AS soft_deleted, min(load_timestamp) AS first_load, max(load_timestamp) AS last_load FROM silver_facility")
def silver_summary(spark, d):
    return evidence.table_summary(table(spark, d, "silver_facility"), "cms_certification_number_ccn")


@query("""SELECT dataset, batch_id AS source_batch_id, arg_max(landing_path, load_timestamp) AS source_file, lower(arg_max(source_file_sha256, load_timestamp)) AS source_file_sha256
FROM source_file_manifest WHERE status IN ('SUCCESS', 'SKIPPED_ALREADY_ACQUIRED') GROUP BY 1, 2 HAVING count(DISTINCT (landing_path, lower(source_file_sha256))) = 1""")
def lineage_reconstruct(spark, d):
    """The manifest as it is, with failed acquisitions and digests in other letters; a legacy row for each batch with one file."""
    m = table(spark, d, "source_file_manifest").withColumn("source_file_sha256", F.when(F.col("status") == "SUCCESS", F.upper("source_file_sha256")).otherwise(F.col("source_file_sha256")))
    file = F.struct("landing_path", F.lower("source_file_sha256"))
    clear = m.filter(F.col("status").isin(*control.ACQUIRED)).groupBy("dataset", "batch_id").agg(F.countDistinct(file).alias("n"), F.min("load_timestamp").alias("load_timestamp")).filter("n = 1")
    legacy = clear.select("dataset", "batch_id", F.lit("{}").alias("raw_record"), F.array(F.lit("REQUIRED:x")).alias("failed_rules"), "load_timestamp")
    return evidence.rebuild_lineage(legacy, m).select("dataset", "source_batch_id", "source_file", "source_file_sha256")


@query("SELECT record_id, CASE WHEN regexp_full_match(trim(survey_date), '\\d{4}-\\d{2}-\\d{2}') THEN TRY_CAST(trim(survey_date) AS DATE) WHEN regexp_full_match(trim(survey_date), '\\d{1,2}/\\d{1,2}/\\d{4}') THEN CAST(TRY_STRPTIME(trim(survey_date), '%m/%d/%Y') AS DATE) END AS day FROM health_deficiencies")
def date_normalizer(spark, d):
    return table(spark, d, "health_deficiencies").select("record_id", flexible_date("survey_date").alias("day"))


# ---- files ------------------------------------------------------------------------------------------------------------


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ', \"' || c_mktsegment || '\"' AS label FROM customer")
def csv_roundtrip(spark, d):
    folder = f"{scratch_dir(spark)}/csv"
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("label"))
    c.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(folder)
    return read_csv(spark, folder, ["c_custkey", "label"]).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS event_type FROM events")
def json_envelope(spark, d):
    """Fifty landed pages, read as pages."""
    folder = f"{scratch_dir(spark)}/json"
    rows = table(spark, d, "events").select((F.col("event_id") % 50).alias("page"), F.struct(F.col("event_id").cast("string").alias("event_id"), F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("event_type")).alias("r"))
    pages = rows.groupBy("page").agg(F.collect_list("r").alias("results"))  # one page of a landed file
    enveloped = pages.select("page", F.struct(F.lit("events").alias("dataset_id"), F.size("results").cast("bigint").alias("rows_in_file")).alias("_meta"), "results")
    enveloped.write.mode("overwrite").partitionBy("page").json(folder)
    return read_page(spark, folder, ["event_id", "event_type"])


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_custkey % 20 > 0 THEN c_mktsegment END AS c_mktsegment, c_custkey % 20 > 1 AS good FROM customer")
def corrupt_split(spark, d):
    """Landed csv with short and over-long rows: good rows and, from the raw text in the Bronze quarantine, broken ones."""
    folder, names, none = f"{scratch_dir(spark)}/corrupt", ["c_custkey", "c_mktsegment"], F.lit(None).cast("string")
    k = F.col("c_custkey")
    line = F.when(k % 20 == 0, k.cast("string")).when(k % 20 == 1, F.concat_ws(",", k.cast("string"), "c_mktsegment", F.lit("x"))).otherwise(F.concat_ws(",", k.cast("string"), "c_mktsegment"))
    table(spark, d, "customer").select(line.alias(",".join(names))).write.mode("overwrite").options(header=True, sep="\x01", quote="").csv(folder)
    parsed = cut_lineage(read_csv(spark, folder, names))  # with all columns, as widths are told by them
    good = parsed.filter(F.col(CORRUPT).isNull()).select(*names, F.lit(True).alias("good"))
    bad = quarantined(parsed.filter(F.col(CORRUPT).isNotNull()), names, F.lit("customer"), none, none, none, none, none)
    fields = F.split("corrupt_record", ",")
    return good.unionByName(bad.select(F.get(fields, F.lit(0)).alias("c_custkey"), F.get(fields, F.lit(1)).alias("c_mktsegment"), F.lit(False).alias("good")))


# ---- planned star schema, our own design --------------------------------------------------------------------------------


@query("""SELECT n.n_name, CAST(count(*) AS BIGINT) AS n_orders, CAST(round(sum(CAST(o_totalprice AS DECIMAL(18, 2))), 2) AS DECIMAL(28, 2)) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey GROUP BY 1""")
def gold_orders_by_nation(spark, d):
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))  # nation is a fixed table
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))


_GOLD = "SELECT state, CAST(count(*) AS BIGINT) AS citations, CAST(count(*) FILTER (upper(trim(scope_severity_code)) IN ('G','H','I','J','K','L')) AS BIGINT) AS serious FROM health_deficiencies WHERE regexp_full_match(state, '[A-Z]{2}') GROUP BY 1"


@query(_GOLD)
def gold_state_quality(spark, d):
    h = table(spark, d, "health_deficiencies").filter(F.col("state").rlike(r"^[A-Z]{2}\z"))
    return h.groupBy("state").agg(F.count(F.lit(1)).alias("citations"), F.count_if(severity_group(F.trim("scope_severity_code")).isin("G-I", "J-L")).alias("serious"))


def silver_penalties(spark: SparkSession, d: str) -> DataFrame:
    """All penalties through the whole Bronze-to-Silver pass: rows per status."""
    done = transform(table(spark, d, "penalties"), dataset("penalties"), "test-salt", strict_dates=True)
    return done.classified.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(SILVER_DEFICIENCIES)
def silver_deficiencies(spark: SparkSession, d: str) -> DataFrame:
    """The accepted rows of all health deficiencies, typed and keyed."""
    done = transform(table(spark, d, "health_deficiencies"), dataset("health_deficiencies"), "test-salt", strict_dates=True)
    return done.silver.drop("load_timestamp", "source_file", "source_file_sha256", "source_batch_id")


@query(SILVER_PROVIDERS)
def silver_providers(spark: SparkSession, d: str) -> DataFrame:
    """All of provider_info through the Bronze-to-Silver pass: rows per status. Columns the table lacks are null."""
    spec = dataset("provider_info")
    rows = table(spark, d, "provider_info")
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in spec.rules.source if c not in rows.columns})
    return transform(rows, spec, "test-salt", strict_dates=True).classified.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def silver_mds_quality(spark: SparkSession, d: str) -> DataFrame:
    """The landed files of mds_quality, drifting names resolved, as Bronze text through the Bronze-to-Silver pass: rows per status."""
    spec = dataset("mds_quality")
    landing, files = problems.landing(spark, d)
    _, canon = drift_report(landing, files, problems.KINDS, problems.IDENTITY)
    rows = consistent_table(landing, files, canon, spec.name, dict.fromkeys(spec.rules.source, ""))
    newest = table(spark, d, "source_file_manifest").groupBy(F.col("landing_path").alias("path")).agg(F.max_by(F.struct("batch_id", "source_file_sha256"), "load_timestamp").alias("m"))
    stamp = {
        "_dataset_id": F.lit(spec.dataset_id), "_source_file": F.col("path"), "_source_file_sha256": F.col("m.source_file_sha256"), "_batch_id": F.col("m.batch_id"), "_load_type": F.lit("full"),
        "_ingest_date": F.lit(None).cast("date"), "load_timestamp": F.current_timestamp(),
    }
    bronze = rows.join(newest, "path").withColumns(stamp)
    return transform(bronze, spec, "test-salt", strict_dates=True).classified.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


QUERIES |= {"silver_penalties": silver_penalties, "silver_mds_quality": silver_mds_quality}


def _landed_files(spark: SparkSession, d: str, folder: str, tables: list[str]) -> list[dict]:
    """All rows of tables as landed csv files, one for each part the table is written in; one key is in one file."""
    rows = []
    for name in tables:
        spec = dataset(name)
        source = table(spark, d, name).select(*spec.rules.source).repartition(2, "cms_certification_number_ccn")
        path = f"{folder}/{name}"
        source.write.options(header=True, quote='"', escape='"', quoteAll=True, emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
        files = [f"{path}/{n}" for n in Storage(spark, path).names() if n.endswith(".csv")]
        total = source.count()
        for f in files:
            digest, size = file_digest(f)
            rows.append({
                "acquisition_run_id": f"run-{name}", "dataset": name, "dataset_id": spec.dataset_id, "load_type": "full", "as_of_date": dt.date(2024, 1, 1), "acquisition_strategy": "bulk_snapshot", "source_url": "u",
                "landing_path": f, "batch_id": digest[:24], "source_content_sha256": digest, "source_file_sha256": digest, "source_bytes": size, "expected_run_rows": total, "row_count_validated": False,
                "status": "SUCCESS", "load_timestamp": dt.datetime(2024, 1, 2),
            })
    return rows


def _loaded(spark: SparkSession, d: str, tables: list[str]) -> Lake:
    lake = Lake(spark, scratch_dir(spark))
    lake.ensure()
    lake.manifest.append(lake.rows(_landed_files(spark, d, f"{lake.root}/landing", tables), MANIFEST_SCHEMA))
    run_bronze(lake, "bronze-1")
    return lake


def _one_row(*counts: DataFrame) -> DataFrame:
    """One row of counts from several rows of one."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return rows.agg(*(F.sum(c).alias(c) for c in rows.columns))


_BOTH = ["penalties", "health_deficiencies"]


@query("""SELECT 'penalties' AS dataset, CAST(count(*) AS BIGINT) AS rows_read, CAST(count(*) AS BIGINT) AS rows_inserted, CAST(count(*) AS BIGINT) AS bronze_rows, true AS validated, DATE '2024-01-01' AS watermark_value FROM penalties
UNION ALL SELECT 'health_deficiencies', count(*), count(*), count(*), true, DATE '2024-01-01' FROM health_deficiencies""")
def bronze_run(spark, d):
    """All rows of two datasets as landed files through the Bronze pipeline: counts of log, table, manifest and watermark."""
    lake = _loaded(spark, d, _BOTH)
    logged = lake.logs.read().groupBy("dataset").agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_inserted").alias("rows_inserted"))
    held = [lake.bronze(dataset(n)).read().groupBy(F.lit(n).alias("dataset")).agg(F.count(F.lit(1)).alias("bronze_rows")) for n in _BOTH]
    closed = lake.manifest.read().groupBy("dataset").agg(F.bool_and("row_count_validated").alias("validated"))
    marks = lake.watermarks.read().select("dataset", "watermark_value")
    return logged.join(held[0].unionByName(held[1]), "dataset").join(closed, "dataset").join(marks, "dataset")


_PENALTY_COUNTS = """c AS (SELECT count(*) AS n, count(*) FILTER (status = 'ACCEPTED') AS ok, count(*) FILTER (status IN ('INVALID', 'CONFLICT')) AS bad FROM a)"""


@query(f"{PENALTY_STATUSES}, {_PENALTY_COUNTS} SELECT CAST(n AS BIGINT) AS rows_read, CAST(ok AS BIGINT) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, CAST(bad AS BIGINT) AS rows_quarantined, CAST(ok AS BIGINT) AS silver_rows FROM c")
def silver_run(spark, d):
    """All penalties as landed files through both pipelines: what the audit rows say and what Silver holds."""
    lake = _loaded(spark, d, ["penalties"])
    run_silver(lake, "silver-1", "test-salt", strict_dates=True)
    done = lake.logs.read().filter("pipeline_layer = 'Bronze-to-Silver'").agg(*(F.sum(c).alias(c) for c in ("rows_read", "rows_inserted", "rows_updated", "rows_quarantined")))
    return _one_row(done, lake.silver(dataset("penalties")).read().agg(F.count(F.lit(1)).alias("silver_rows")))


@query(f"{PENALTY_STATUSES}, {_PENALTY_COUNTS} SELECT CAST(0 AS BIGINT) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, CAST(n AS BIGINT) AS bronze_rows, CAST(ok AS BIGINT) AS silver_rows, true AS same_versions FROM c")
def rerun_changes_nothing(spark, d):
    """Both pipelines again over the same files: nothing is inserted or updated, no version is added."""
    lake, spec = _loaded(spark, d, ["penalties"]), dataset("penalties")
    run_silver(lake, "silver-1", "test-salt", strict_dates=True)
    before = (lake.silver(spec).version(), lake.silver_quarantine.version())
    run_bronze(lake, "bronze-2", reprocess=True)
    run_silver(lake, "silver-2", "test-salt", reprocess=True, strict_dates=True)
    same = (lake.silver(spec).version(), lake.silver_quarantine.version()) == before
    done = lake.logs.read().filter("run_id = 'silver-2'").agg(F.sum("rows_inserted").alias("rows_inserted"), F.sum("rows_updated").alias("rows_updated"))
    counts = [lake.bronze(spec).read().agg(F.count(F.lit(1)).alias("bronze_rows")), lake.silver(spec).read().agg(F.count(F.lit(1)).alias("silver_rows"))]
    return _one_row(done, *counts).withColumn("same_versions", F.lit(same))


# ---- relational primitives of the inventory, one query each ---------------------------------------------------------------


@query("SELECT o_orderkey AS key, o_totalprice AS amount, o_orderstatus, 'orders' AS _dataset FROM orders")
def dynamic_projection(spark, d):
    names = {"o_orderkey": "key", "o_totalprice": "amount", "o_orderstatus": "o_orderstatus"}
    return table(spark, d, "orders").select(*(F.col(c).alias(n) for c, n in names.items()), F.lit("orders").alias("_dataset"))


@query("SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events")
def struct_expansion(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint").alias("r")).select("event_id", "r.*")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'P') AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def batch_slice(spark, d):
    """Orders as batches by their status; two batches between two dates."""
    rows = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("_ingest_date"), F.col("o_orderstatus").alias("_batch_id"))
    orders = BatchTable(spark, f"{scratch_dir(spark)}/orders", rows.schema)
    orders.replace_many(rows, {})
    return orders.slice("O", "_ingest_date", "1996-01-01", "1996-12-31").unionByName(orders.slice("P", "_ingest_date", "1996-01-01", "1996-12-31")).select("o_orderkey")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_custkey % 3 > 0 THEN o_orderstatus END = 'O', false) AS is_open FROM orders")
def equality_flag(spark, d):
    status = F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderstatus"))
    return table(spark, d, "orders").select("o_orderkey", F.when(status.isNull(), False).otherwise(status == "O").alias("is_open"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 5 > 0 THEN o_orderstatus END IS NOT DISTINCT FROM CASE WHEN o_custkey % 7 > 0 THEN 'O' END AS same FROM orders")
def null_safe_equality(spark, d):
    a, b = F.when(F.col("o_custkey") % 5 > 0, F.col("o_orderstatus")), F.when(F.col("o_custkey") % 7 > 0, F.lit("O"))
    return table(spark, d, "orders").select("o_orderkey", a.eqNullSafe(b).alias("same"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_join(spark, d):
    keys = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(keys, "c_custkey", "left_semi").select("c_custkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_quantity > 45 AND r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber)")
def anti_join_composite(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return li.join(li.filter("l_quantity > 45").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], "left_anti").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey, CAST(coalesce(n, 0) AS BIGINT) AS n_orders, last_order FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_order FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def left_join_rollup(spark, d):
    per = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order"))
    return table(spark, d, "customer").select("c_custkey").join(per, "c_custkey", "left").fillna(0, ["n_orders"])


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS clicks, CAST(count(DISTINCT event_type) AS BIGINT) AS kinds, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1 HAVING count(*) > 20")
def grouped_counts_having(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "click").alias("clicks"), F.countDistinct("event_type").alias("kinds"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return g.filter("n > 20")


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_keys(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderstatus").dropDuplicates(["o_custkey", "o_orderstatus"])


@query("SELECT o_orderkey, array_to_string(list_sort([x FOR x IN [o_orderpriority, o_orderstatus, CASE WHEN o_custkey % 2 = 0 THEN 'even' END] IF x IS NOT NULL]), '|') AS tags, o_custkey % 2 = 0 AS has_even FROM orders")
def array_functions(spark, d):
    tags = F.array_compact(F.array("o_orderpriority", "o_orderstatus", F.when(F.col("o_custkey") % 2 == 0, "even")))
    o = table(spark, d, "orders").select("o_orderkey", tags.alias("t"))
    return o.select("o_orderkey", F.array_join(F.array_sort("t"), "|").alias("tags"), F.exists("t", lambda x: x == "even").alias("has_even"))


@query("""SELECT page, min(path) AS path FROM (SELECT user_id % 50 AS page, event_id AS path, ts, row_number() OVER (PARTITION BY user_id % 50 ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 GROUP BY 1""")
def first_wins_map(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 50).alias("page"), "ts", "event_id")
    return e.groupBy("page").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("path"))


@query("SELECT o_orderkey, coalesce(CASE WHEN o_custkey % 4 > 0 THEN CAST(o_orderdate AS DATE) END, DATE '1992-01-01') AS window_end FROM orders")
def additive_backfill(spark, d):
    """A table gains a column that is computed from an old one where it has a value."""
    old = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 4 > 0, F.to_date("o_orderdate")).alias("day"))
    orders = VersionedTable(spark, f"{scratch_dir(spark)}/orders", old.schema)
    orders.append(old)
    orders.add_columns([T.StructField("window_end", T.DateType())], {"window_end": F.coalesce("day", F.lit("1992-01-01").cast("date"))})
    return orders.read().select("o_orderkey", "window_end")


@query("SELECT batch_id, landing_path, CASE WHEN status = 'SUCCESS' AND dataset = 'penalties' THEN 500 ELSE source_rows END AS source_rows FROM source_file_manifest WHERE NOT coalesce(status = 'FAILURE', false)")
def keyed_update_and_delete(spark, d):
    m = table(spark, d, "source_file_manifest").select("batch_id", "landing_path", "status", "dataset", "source_rows")
    manifest = VersionedTable(spark, f"{scratch_dir(spark)}/manifest", m.schema)
    manifest.append(m)
    manifest.update((F.col("status") == "SUCCESS") & (F.col("dataset") == "penalties"), {"source_rows": F.lit(500).cast("bigint")})
    manifest.delete(F.col("status") == "FAILURE")
    return manifest.read().select("batch_id", "landing_path", "source_rows")


@query("""SELECT operation, CAST(n AS BIGINT) AS n FROM (SELECT 'inserted' AS operation, count(*) AS n FROM source_file_manifest UNION ALL SELECT 'updated', count(*) FILTER (status = 'SUCCESS' AND dataset = 'penalties') FROM source_file_manifest
UNION ALL SELECT 'deleted', count(*) FILTER (status = 'FAILURE') FROM source_file_manifest)""")
def table_history(spark, d):
    """What the history of a table says about its changes."""
    m = table(spark, d, "source_file_manifest").select("status", "dataset", "source_rows")
    manifest = VersionedTable(spark, f"{scratch_dir(spark)}/manifest", m.schema)
    manifest.append(m)
    manifest.update((F.col("status") == "SUCCESS") & (F.col("dataset") == "penalties"), {"source_rows": F.lit(500).cast("bigint")})
    manifest.delete(F.col("status") == "FAILURE")
    return manifest.history().select(F.explode("counts").alias("operation", "n"))
