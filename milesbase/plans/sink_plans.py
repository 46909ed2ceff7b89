"""Keyed tables with column defaults, and sinks that can be repeated (src_tables, flt_validate, snk_run_metrics, snk_retention)."""

from __future__ import annotations

import os
import uuid
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import functions as F

from milesbase.operators import quality, sinks, transfers
from milesbase.operators.numbering import stored
from milesbase.plans import domain as D
from milesbase.plans.monitoring_plans import snk_run_metrics
from milesbase.plans.registry import ORACLES, query
from milesbase.plans.report_plans import _REASON_SQL
from milesbase.session import checkpoint_dir
from milesbase.sources import keyed
from milesbase.sources.fixtures import AS_OF, AS_OF_DATE


def _folder(spark, name):
    return os.path.join(checkpoint_dir(spark), "sinks", f"{name}-{uuid.uuid4().hex}")


# ------------------------------------------------------------------ keyed tables
# what the input holds of each table, as (frame, columns, rows of the older files); older files have no column with a default
_SOURCES = {
    "routes_queue": ("fx_queue", "queue_id % 2 = 0", [
        "origin", "dest", "airline", "priority_tier", "search_count", "decayed_demand", "last_search_at_utc", "change_rate",
        "last_scraped_at_utc", "next_scrape_at_utc"]),
    "flights": ("fx_award", "stops = 0", [
        "origin", "destination", "date", "airline", "points_cost", "cash_cost", "stops", "cabin_class", "available_seats",
        "raw_flight_number", "scraped_at_utc", "duration_minutes"]),
    "cash_fares": ("fx_cash", "cabin_class = 'economy'", [
        "origin", "destination", "date", "airline", "cabin_class", "flight_number", "cash_price", "scraped_at_utc", "expires_at_utc"]),
    "transfer_bonuses": ("fx_bonus", "bonus_pct > 20", ["bank_program_id", "airline_code", "bonus_pct", "starts_at", "ends_at"]),
    "cash_coverage": ("cash_attempts", "fare_count = 0", [
        "origin", "destination", "date", "cabin", "attempt_utc AS last_attempt_utc", "fare_count", "attempt_utc AS next_probe_utc"]),
    "ondemand_coverage": ("fx_attempt", "records = 0", [
        "origin", "dest AS destination", "ts AS last_attempt_utc", "records AS result_count", "ts AS next_probe_utc"]),
    "airline_budget": ("fx_queue", "queue_id % 3 = 0", ["airline", "decayed_demand AS tokens", "last_scraped_at_utc AS last_refill_utc"]),
    "transfer_partners": ("fx_bonus", "bonus_pct > 10", ["bank_program_id", "airline_code", "airline_code AS program_name", "bonus_pct AS min_transfer"]),
    "bank_programs": ("banks", "id > 3", ["id", "name", "short_code"]),
}
_BANKS = ", ".join(f"({i}, '{n}', '{s}')" for i, n, s in transfers.BANK_PROGRAMS)
_BANKS_CTE = f"banks AS (SELECT * FROM (VALUES {_BANKS}) v(id, name, short_code))"


def _name(expr):
    return expr.split(" AS ")[-1]


def _landed(L, table):
    """The table's folder: newer files with every column that the input has, older ones without those that have a default."""
    frame, older, exprs = _SOURCES[table]
    src = {"cash_attempts": D.cash_attempts,
           "banks": lambda L: L.spark.createDataFrame(transfers.BANK_PROGRAMS, "id int, name string, short_code string")}.get(
               frame, lambda L: getattr(L, frame))(L)
    kinds = {c: (kind, default) for c, kind, _, default in keyed.TABLES[table]}
    cols = [(e, F.expr(e.split(" AS ")[0]).cast(kinds[_name(e)][0]).alias(_name(e))) for e in exprs]
    path = _folder(L.spark, table)
    src.filter(f"NOT ({older})").select(*[c for _, c in cols]).write.mode("append").parquet(path)
    src.filter(older).select(*[c for e, c in cols if kinds[_name(e)][1] is None]).write.mode("append").parquet(path)
    return keyed.read_keyed(L.spark, path, table, AS_OF)


def _table_sql(table):
    frame, older, exprs = _SOURCES[table]
    have = {_name(e): e.split(" AS ")[0] for e in exprs}
    cols = []
    for c, kind, _, default in keyed.TABLES[table]:
        kind = kind.replace("timestamp_ntz", "timestamp")
        dflt = keyed.default_sql(kind, default, AS_OF) or f"CAST(NULL AS {kind})"
        own = f"CAST({have[c]} AS {kind})" if c in have else dflt
        cols.append(f"{own} AS {c}" if default is None or c not in have else f"CASE WHEN {older} THEN {dflt} ELSE {own} END AS {c}")
    return f"SELECT {', '.join(cols)} FROM {frame}"


def _column_sql(table):
    parts = []
    for c, kind, required, default in keyed.TABLES[table]:
        dflt = keyed.default_sql(kind.replace("timestamp_ntz", "timestamp"), default, AS_OF)
        at = f"count(*) FILTER (WHERE {c} = {dflt})" if dflt else "CAST(0 AS BIGINT)"
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS rows, count({c}) AS non_null, {at} AS at_default, "
                     f"{f'count(*) - count({c})' if required else 'CAST(0 AS BIGINT)'} AS missing FROM k_{table}")
    return " UNION ALL ".join(parts)


_KEYED_CTE = D.CASH_ATTEMPTS_CTE + "," + _BANKS_CTE + ",\n" + ",\n".join(f"k_{t} AS ({_table_sql(t)})" for t in _SOURCES)


def _each(L, report):
    return reduce(lambda a, b: a.unionByName(b), [report(_landed(L, t), t) for t in keyed.TABLES])


@query("src_keyed_tables", " UNION ALL ".join(_column_sql(t) for t in _SOURCES), _KEYED_CTE)
def src_keyed_tables(spark, sf_dir):
    """Typed scans of the nine keyed tables, whose older files lack the columns that have a default: per column the rows, non-null
    values, values at the default and rows that break NOT NULL."""
    return _each(D.lk(spark, sf_dir), lambda df, t: keyed.column_report(df, t, AS_OF))


@query("src_keyed_uniqueness", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, count(*) AS keys, CAST(coalesce(sum(n), 0) - count(*) AS BIGINT) AS repeated "
    f"FROM (SELECT count(*) AS n FROM k_{t} GROUP BY {', '.join(keyed.KEYS[t])})" for t in _SOURCES), _KEYED_CTE)
def src_keyed_uniqueness(spark, sf_dir):
    """Rows, keys and rows beyond the first of their key in each keyed table as landed (before any merge)."""
    return _each(D.lk(spark, sf_dir), keyed.key_report)


# ------------------------------------------------------------------ counted and repeatable writes
@query("snk_validated", f"""
SELECT CAST(count(*) AS BIGINT) AS total, count(*) FILTER (WHERE r IS NULL) AS accepted, count(*) FILTER (WHERE r IS NOT NULL) AS rejected,
 count(*) FILTER (WHERE r = 'date_rolled') AS rolled, count(*) FILTER (WHERE r IS NULL) AS stored FROM (SELECT {_REASON_SQL} AS r FROM fx_award)""")
def snk_validated(spark, sf_dir):
    """Accepted, rejected and rolled-over records, counted in the pass that writes the accepted ones; ``stored`` recounts the table."""
    path, why = _folder(spark, "validated"), F.col("reject_reason")
    a = quality.with_reject_reason(D.lk(spark, sf_dir).fx_award, AS_OF_DATE)
    seen = sinks.write_counted(a, path, why.isNull(), {
        "total": F.count(F.lit(1)), "accepted": F.count_if(why.isNull()), "rejected": F.count_if(why.isNotNull()),
        "rolled": F.count_if(why == "date_rolled")})
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored")).select(
        *[F.lit(seen[c]).cast("bigint").alias(c) for c in ("total", "accepted", "rejected", "rolled")], "stored")


def snk_run_metrics_log(spark, sf_dir):
    """The metrics table after three appends: some runs, then all runs, then all runs again (a replayed job). Each run is in it once."""
    path, rows = _folder(spark, "run-metrics"), stored(snk_run_metrics(spark, sf_dir), "run-metrics")
    sinks.append_once(rows.filter(F.pmod("run_id", F.lit(2)) == 0), path, ["run_id"], 0)
    sinks.append_once(rows, path, ["run_id"], 1)
    return sinks.append_once(rows, path, ["run_id"], 1).drop("batch_id")


query("snk_run_metrics_log")(snk_run_metrics_log)
ORACLES["snk_run_metrics_log"] = ORACLES["snk_run_metrics"]  # the same rows, each once


@query("snk_retention_drop", "SELECT * FROM fx_cash WHERE date >= DATE '2024-01-30'")
def snk_retention_drop(spark, sf_dir):
    """snk_retention on the stored cash table: the folders of dates before yesterday are deleted, no other file is touched."""
    path = _folder(spark, "cash")
    cash = D.lk(spark, sf_dir).fx_cash
    cash.repartition("date").write.partitionBy("date").parquet(path)
    sinks.drop_partitions_before(spark, path, "date", (date.fromisoformat(str(AS_OF_DATE)[:10]) - timedelta(days=1)).isoformat())
    return spark.read.schema(cash.schema).parquet(path).select(*cash.columns)
