"""Attributes as they were known at the time of an event.

Method: for each entity the knowledge (the best report known so far) is materialised at the start of every period,
together with the log of changes within the period; an event joins its preceding snapshot by (entity, period) and
replays only the changes between the period's start and the event. Nothing that became known later takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _period(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def knowledge_log(reports: DataFrame, entity: str, known_from: str, rank: list[str], value: str) -> DataFrame:
    """(entity, known_from, best, final): the best report known on each day on which something was reported.

    ``reports`` may repeat rows; those without entity, day or value are left out. The best report is the greatest by
    ``rank`` (compared in order), then by value. Reports are reduced per (entity, day) before they are shuffled, so a
    hot entity leaves at most one row per day.
    """
    usable = reports.filter(F.col(entity).isNotNull() & F.col(known_from).isNotNull() & F.col(value).isNotNull())
    report = F.struct(*(F.col(r) for r in rank), F.col(value).alias("value"))
    daily = usable.groupBy(F.col(entity).alias("entity"), F.col(known_from).alias("known_from")).agg(F.max(report).alias("report"))
    w = Window.partitionBy("entity").orderBy("known_from")
    return daily.select(
        "entity",
        "known_from",
        F.max("report").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("best"),
        F.max("report").over(Window.partitionBy("entity")).alias("final"),
    )


def periodic_snapshots(log: DataFrame, shown: str) -> DataFrame:
    """(entity, period, base, changes, next): months with changes, the knowledge at their start and the next such month.

    ``shown`` is the rank column to report beside the value. A month's changes are at most one per day.
    """
    state = F.struct(F.col(f"best.{shown}").alias("shown"), F.col("best.value").alias("value"), (F.col("best.value") != F.col("final.value")).alias("differs"))
    months = (
        log.select("entity", _period(F.col("known_from")).alias("period"), "known_from", state.alias("s"))
        .groupBy("entity", "period")
        .agg(F.sort_array(F.collect_list(F.struct("known_from", "s"))).alias("changes"))  # at most one per day of the month
    )
    w = Window.partitionBy("entity").orderBy("period")
    return months.select(
        "entity", "period", "changes",
        F.lag(F.element_at("changes", -1)["s"]).over(w).alias("base"),
        F.lead("period").over(w).alias("next"),
    )


def as_known(events: DataFrame, reports: DataFrame, event_entity: str, event_day: str, entity: str, known_from: str, rank: list[str], value: str, shown: str) -> DataFrame:
    """``events`` with ``known_value``, ``known_<shown>`` and ``differs`` (from what is known without a date limit).

    Events without entity or day, or about whose entity nothing was known yet, keep nulls in the added columns; no
    event is dropped or repeated. Values are comparison keys (equal keys mean the same value). Extra columns of
    ``events`` pass through; columns of the three added names are replaced.
    """
    events = events.drop("known_value", f"known_{shown}", "differs")
    log = knowledge_log(reports, entity, known_from, rank, value)
    bounds = reports.agg(F.max(known_from).alias("d")).select(_period(F.col("d")).alias("p")).collect()  # one scalar
    horizon = (bounds[0]["p"] if bounds and bounds[0]["p"] is not None else 0) + 1
    dense = periodic_snapshots(log, shown)
    ends = F.element_at("changes", -1)["s"]
    upto = F.coalesce(F.col("next") - 1, F.lit(horizon))
    filled = dense.select(
        "entity",
        F.explode(
            F.transform(
                F.sequence(F.col("period"), F.greatest(upto, F.col("period"))),
                lambda p: F.struct(
                    p.alias("period"),
                    F.when(p == F.col("period"), F.col("base")).otherwise(ends).alias("base"),
                    F.when(p == F.col("period"), F.col("changes")).alias("changes"),
                ),
            )
        ).alias("m"),
    ).select(F.col("entity").alias("__entity"), F.col("m.period").alias("__period"), F.col("m.base").alias("__base"), F.col("m.changes").alias("__changes"))
    left = events.withColumn("__p", F.when(F.col(event_day).isNotNull(), F.least(_period(F.col(event_day)), F.lit(horizon))))
    joined = left.join(filled, (left[event_entity] == filled["__entity"]) & (left["__p"] == filled["__period"]), "left")
    replayed = F.get(F.reverse(F.filter("__changes", lambda c: c["known_from"] <= F.col(event_day))), F.lit(0))["s"]
    known = F.coalesce(replayed, F.col("__base"))
    return joined.withColumn("__known", known).select(
        *events.columns,
        F.col("__known.value").alias("known_value"),
        F.col("__known.shown").alias(f"known_{shown}"),
        F.col("__known.differs").alias("differs"),
    )
