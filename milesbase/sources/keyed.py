"""The nine keyed tables: declared types, column defaults, keys (src_tables).

A default is metadata of the scan's schema, so a file written before a column existed reads the column's default, with no rewrite
and with filters still pushed down; ``now`` defaults take the caller's ``as_of``. Parquet cannot enforce NOT NULL, so
``column_report`` counts the rows that break it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

NOW = "now"

# --- fixed values: columns (name, type, required, default) and keys of the keyed tables ---
TABLES = {
    "routes_queue": [
        ("origin", "string", True, None), ("dest", "string", True, None), ("airline", "string", True, "'alaska'"),
        ("priority_tier", "string", True, "'LOW'"), ("search_count", "int", True, "0"), ("decayed_demand", "double", True, "0"),
        ("last_search_at_utc", "timestamp_ntz", False, None), ("change_rate", "double", True, "0.5"),
        ("last_cheapest", "string", False, None), ("interval_h", "double", False, None),
        ("last_scraped_at_utc", "timestamp_ntz", False, None), ("next_scrape_at_utc", "timestamp_ntz", True, NOW),
        ("created_at_utc", "timestamp_ntz", True, NOW)],
    "flights": [
        ("id", "bigint", True, None), ("origin", "string", True, None), ("destination", "string", True, None), ("date", "date", True, None),
        ("airline", "string", True, None), ("program", "string", True, None), ("source", "string", False, None),
        ("points_cost", "int", True, None), ("cash_cost", "decimal(8,2)", True, "0.0"), ("stops", "int", True, "0"),
        ("cabin_class", "string", True, None), ("available_seats", "int", True, "-1"), ("raw_flight_number", "string", True, "'UNKNOWN'"),
        ("partner_airline", "string", False, None), ("scraped_at_utc", "timestamp_ntz", True, None),
        ("expires_at_utc", "timestamp_ntz", True, None), ("departure_time_local", "timestamp_ntz", False, None),
        ("arrival_time_local", "timestamp_ntz", False, None), ("duration_minutes", "int", False, None),
        ("aircraft_type", "string", False, None), ("is_saver", "boolean", True, "false"), ("fare_class", "string", False, None),
        ("layover_airports", "string", False, None), ("layover_duration_minutes", "int", False, None),
        ("next_day_arrival", "boolean", True, "false"), ("mixed_cabin", "boolean", True, "false")],
    "cash_fares": [
        ("id", "bigint", True, None), ("origin", "string", True, None), ("destination", "string", True, None), ("date", "date", True, None),
        ("airline", "string", True, None), ("cabin_class", "string", True, None), ("flight_number", "string", True, None),
        ("cash_price", "decimal(10,2)", True, None), ("currency", "string", True, "'USD'"), ("source", "string", True, "'google_flights'"),
        ("scraped_at_utc", "timestamp_ntz", True, None), ("expires_at_utc", "timestamp_ntz", True, None)],
    "bank_programs": [
        ("id", "int", True, None), ("name", "string", True, None), ("short_code", "string", True, None),
        ("created_at_utc", "timestamp_ntz", True, NOW)],
    "transfer_partners": [
        ("bank_program_id", "int", True, None), ("airline_code", "string", True, None), ("program_name", "string", True, None),
        ("transfer_ratio", "decimal(5,2)", True, "1.00"), ("min_transfer", "int", True, "1000"), ("transfer_increment", "int", True, "1000")],
    "transfer_bonuses": [
        ("id", "bigint", True, None), ("bank_program_id", "int", True, None), ("airline_code", "string", True, None),
        ("bonus_pct", "int", True, None), ("starts_at", "date", True, None), ("ends_at", "date", True, None), ("notes", "string", False, None),
        ("created_at_utc", "timestamp_ntz", True, NOW), ("updated_at_utc", "timestamp_ntz", True, NOW)],
    "ondemand_coverage": [
        ("origin", "string", True, None), ("destination", "string", True, None), ("airline", "string", True, None),
        ("last_attempt_utc", "timestamp_ntz", True, None), ("result_count", "int", True, "0"), ("next_probe_utc", "timestamp_ntz", True, None)],
    "cash_coverage": [
        ("origin", "string", True, None), ("destination", "string", True, None), ("date", "date", True, None),
        ("cabin", "string", True, "'economy'"), ("last_attempt_utc", "timestamp_ntz", True, None), ("fare_count", "int", True, "0"),
        ("next_probe_utc", "timestamp_ntz", True, None)],
    "airline_budget": [
        ("airline", "string", True, None), ("tokens", "double", True, "0"), ("capacity", "double", True, "0"),
        ("refill_per_hour", "double", True, "0"), ("last_refill_utc", "timestamp_ntz", True, NOW)],
}
KEYS = {
    "routes_queue": ["origin", "dest", "airline"],
    "flights": ["origin", "destination", "date", "airline", "cabin_class", "raw_flight_number"],
    "cash_fares": ["origin", "destination", "date", "airline", "cabin_class", "flight_number"],
    "bank_programs": ["id"], "transfer_partners": ["bank_program_id", "airline_code"],
    "transfer_bonuses": ["bank_program_id", "airline_code", "starts_at"], "ondemand_coverage": ["origin", "destination", "airline"],
    "cash_coverage": ["origin", "destination", "date", "cabin"], "airline_budget": ["airline"],
}
# --- end fixed values ---


def default_sql(kind: str, default: str | None, as_of) -> str | None:
    """The default as a constant of the column's type; null where the column has none."""
    if default is None:
        return None
    return f"CAST('{as_of}' AS {kind})" if default == NOW else f"CAST({default} AS {kind})"


def table_schema(name: str, as_of) -> StructType:
    fields = []
    for column, kind, _required, default in TABLES[name]:
        field = StructType.fromDDL(f"{column} {kind}").fields[0]
        sql = default_sql(kind, default, as_of)
        meta = {"CURRENT_DEFAULT": sql, "EXISTS_DEFAULT": sql} if sql else {}
        fields.append(StructField(column, field.dataType, True, meta))
    return StructType(fields)


def read_keyed(spark: SparkSession, path: str, name: str, as_of) -> DataFrame:
    """Typed scan of a keyed table's folder; files that lack a column read its default, else null."""
    return spark.read.schema(table_schema(name, as_of)).parquet(path)


def column_report(df: DataFrame, name: str, as_of) -> DataFrame:
    """One row per column: rows, non-null values, values equal to the default, rows that break NOT NULL (one pass, no distinct)."""
    sums, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, (column, kind, required, default) in enumerate(TABLES[name]):
        sql = default_sql(kind, default, as_of)
        sums.append(F.count(column).alias(f"_n{i}"))
        sums.append((F.count_if(F.col(column) == F.expr(sql)) if sql else F.lit(0).cast("bigint")).alias(f"_d{i}"))
        rows.append(F.struct(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), F.col("_rows").alias("rows"),
                             F.col(f"_n{i}").alias("non_null"), F.col(f"_d{i}").alias("at_default"),
                             ((F.col("_rows") - F.col(f"_n{i}")) if required else F.lit(0).cast("bigint")).alias("missing")))
    return df.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def key_report(df: DataFrame, name: str) -> DataFrame:
    """One row: rows, different keys and rows beyond the first of their key."""
    per = df.groupBy(*KEYS[name]).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys")).select(
        F.lit(name).alias("table_name"), "rows", "keys", (F.col("rows") - F.col("keys")).alias("repeated"))
