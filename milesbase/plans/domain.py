"""Domain tables derived from the fixture views, shared by many queries.

* ``award_batch``: validated award observations with expiry and source stamped.
* ``flights``: the keyed serving table = sequential upsert of that batch into an
  empty store at ``AS_OF`` (snk_flights_merge).
* ``cash``: the matched cash table (fixture ``fx_cash``).

Each has a DuckDB twin as CTE text (``*_CTE``), used by the oracles.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milesbase.functions import exprs as X
from milesbase.operators import merge, quality
from milesbase.operators.numbering import stored
from milesbase.session import scratch_table_path
from milesbase.sources.dims import CASH_SOURCE  # noqa: F401 - of matched fares and of every cash record
from milesbase.sources.fixtures import AS_OF, AS_OF_DATE, Lake, lake

AWARD_KEY = ["origin", "destination", "date", "airline", "cabin_class", "raw_flight_number"]
AWARD_MATERIAL = ["points_cost", "cash_cost", "stops", "available_seats", "dep_min", "duration_minutes"]
AWARD_MERGED = [*AWARD_MATERIAL, "source"]  # updated by a merge; ``program`` is set once, at insert
AWARD_KEEP = ["program"]
AWARD_STAMPS = ["scraped_at_utc", "expires_at_utc"]
AWARD_ORDER = ["scraped_at_utc", *AWARD_MATERIAL, "tier"]
CASH_KEY = ["origin", "destination", "date", "airline", "cabin_class", "flight_number"]

STORED_BEFORE = "2024-01-30 00:00:00"

# --- fixed values: provider slug per program carrier ---
AIRLINE_SOURCE = {"AS": "alaska", "DL": "delta", "B6": "jetblue", "TK": "turkish", "EY": "etihad",
                  "WN": "southwest"}
# --- end fixed values ---


def lk(spark: SparkSession, sf_dir: str) -> Lake:
    return lake(spark, sf_dir)


def award_batch(L: Lake) -> DataFrame:
    a = quality.filter_valid(L.fx_award, AS_OF_DATE)
    return a.withColumn("expires_at_utc", X.expiry("scraped_at_utc", "tier")) \
            .withColumn("source", X.case_map("airline", AIRLINE_SOURCE)).withColumn("program", F.col("airline"))


def merge_awards(current: DataFrame | None, batch: DataFrame) -> DataFrame:
    return merge.conditional_merge(current, batch, AWARD_KEY, AWARD_MERGED, AWARD_STAMPS, AWARD_ORDER, AS_OF, keep_cols=AWARD_KEEP)


def flights(L: Lake) -> DataFrame:
    return merge_awards(None, award_batch(L)).drop(*AWARD_KEEP)


def flights_onto_store(L: Lake) -> DataFrame:
    """The merge onto a store that already holds the observations before STORED_BEFORE, collected by another
    source under another program name."""
    b = award_batch(L)
    early = F.col("scraped_at_utc") < F.lit(STORED_BEFORE).cast("timestamp_ntz")
    old = b.filter(early).withColumn("source", F.concat(F.lit("old_"), F.col("source"))).withColumn("program", F.lit("old"))
    return merge_awards(merge_awards(None, old), b.filter(~early))


def input_version(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the input folder's address and of the names, sizes and change times of its files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files, found = fs.listFiles(folder, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha1("\n".join([str(fs.makeQualified(folder)), *sorted(found)]).encode()).hexdigest()[:16]


def materialized(L: Lake, name: str, build, layout=None) -> DataFrame:
    """A derived table written once per state of the input folder into the session's shared checkpoint
    folder and read back by every later query (lineage cut by a written table). Each build writes a
    path of its own; a marker written after the table commits names it, so neither a partial write nor another
    session's build is ever read or overwritten."""
    version = input_version(L.spark, L.sf_dir)
    key = f"_mat_{name}_{version}"
    if key not in L._frames:
        spark = L.spark
        path = scratch_table_path(spark, f"{name}_{version}")
        marker = path + "_committed"
        try:
            path = spark.read.parquet(marker).first()["path"]
        except AnalysisException:
            path = f"{path}_{uuid.uuid4().hex}"
            df = build()
            if layout:  # a range layout samples its input: it reads the finished rows, not the work that makes them
                df = layout(stored(df, name))
            writer = df.write.mode("overwrite")
            if layout:
                writer = writer.partitionBy("date")
            writer.parquet(path)
            spark.createDataFrame([(path,)], "path string").write.mode("overwrite").parquet(marker)
        L._frames[key] = spark.read.parquet(path)
    return L._frames[key]


def date_layout(df: DataFrame) -> DataFrame:
    """File layout of the served tables: partitioned by travel date (partition pruning for date
    windows), range-clustered and sorted by route inside (tight parquet min/max for route filters)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, "date", "origin", "destination").sortWithinPartitions(
        "date", "origin", "destination", "cabin_class")


def flights_table(L: Lake) -> DataFrame:
    """The served keyed table, as the merge job writes it (see ``flights`` for the merge itself)."""
    return materialized(L, "flights_v2", lambda: flights(L), date_layout)


def cash(L: Lake) -> DataFrame:
    return L.fx_cash


def cash_table(L: Lake) -> DataFrame:
    """The stored cash table as the cash merge job writes it."""
    return materialized(L, "cash_v2", lambda: L.fx_cash, date_layout)


def live_cash(L: Lake) -> DataFrame:
    return cash_table(L).filter(F.col("expires_at_utc") > F.lit(AS_OF).cast("timestamp_ntz"))


# ---------------------------------------------------------------- DuckDB twins
_K = "origin, destination, date, airline, cabin_class, raw_flight_number"
_VALID = ("length(origin) = 3 AND origin = upper(origin) AND origin <> lower(origin) AND "
          "length(destination) = 3 AND destination = upper(destination) AND destination <> lower(destination) AND "
          "origin <> destination AND date >= DATE '2024-01-31' AND points_cost > 0")

AWARD_BATCH_CTE = f"""
award_batch AS (SELECT *, scraped_at_utc + INTERVAL '1' HOUR * CASE tier WHEN 'HIGH' THEN 8 WHEN 'MED' THEN 24 ELSE 48 END AS expires_at_utc,
  CASE airline WHEN 'AS' THEN 'alaska' WHEN 'DL' THEN 'delta' WHEN 'B6' THEN 'jetblue' WHEN 'TK' THEN 'turkish' WHEN 'EY' THEN 'etihad' WHEN 'WN' THEN 'southwest' END AS source
  FROM fx_award WHERE {_VALID})"""

FLIGHTS_CTE = AWARD_BATCH_CTE + f""",
fl_o AS (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY scraped_at_utc, points_cost, cash_cost, stops, available_seats, dep_min, duration_minutes, tier) AS ord FROM award_batch),
fl_l AS (SELECT {_K}, points_cost AS m_pc, cash_cost AS m_cc, stops AS m_st, available_seats AS m_as, dep_min AS m_dm, duration_minutes AS m_du
  FROM fl_o QUALIFY row_number() OVER (PARTITION BY {_K} ORDER BY ord DESC) = 1),
fl_j AS (SELECT fl_o.*, m_pc, m_cc, m_st, m_as, m_dm, m_du,
  (points_cost IS DISTINCT FROM m_pc OR cash_cost IS DISTINCT FROM m_cc OR stops IS DISTINCT FROM m_st OR available_seats IS DISTINCT FROM m_as OR dep_min IS DISTINCT FROM m_dm OR duration_minutes IS DISTINCT FROM m_du) AS differs
  FROM fl_o JOIN fl_l USING ({_K})),
fl_t AS (SELECT *, max(CASE WHEN differs THEN ord END) OVER (PARTITION BY {_K}) AS tstar FROM fl_j),
flights AS (SELECT {_K}, any_value(m_pc) AS points_cost, any_value(m_cc) AS cash_cost, any_value(m_st) AS stops,
  any_value(m_as) AS available_seats, any_value(m_dm) AS dep_min, any_value(m_du) AS duration_minutes,
  coalesce(arg_min(scraped_at_utc, ord) FILTER (WHERE expires_at_utc > TIMESTAMP '2024-01-31 00:00:00'), arg_max(scraped_at_utc, ord)) AS scraped_at_utc,
  coalesce(arg_min(expires_at_utc, ord) FILTER (WHERE expires_at_utc > TIMESTAMP '2024-01-31 00:00:00'), arg_max(expires_at_utc, ord)) AS expires_at_utc,
  arg_min(source, ord) AS source
  FROM fl_t WHERE tstar IS NULL OR ord > tstar GROUP BY {_K})"""

# the same merge over the observations of the older store and of the batch, in one pass
STORE_CTE = (FLIGHTS_CTE
             .replace("AS source\n  FROM fx_award", "AS slug,\n  CASE WHEN scraped_at_utc < TIMESTAMP '" + STORED_BEFORE + "' THEN 'old' ELSE airline END AS program,\n"
                      "  CASE WHEN scraped_at_utc < TIMESTAMP '" + STORED_BEFORE + "' THEN 'old_' || slug ELSE slug END AS source\n  FROM fx_award")
             .replace("duration_minutes AS m_du\n", "duration_minutes AS m_du, source AS m_so\n")
             .replace("m_dm, m_du,\n", "m_dm, m_du, m_so,\n")
             .replace("duration_minutes IS DISTINCT FROM m_du)", "duration_minutes IS DISTINCT FROM m_du OR source IS DISTINCT FROM m_so)")
             .replace("PARTITION BY {_K}) AS tstar FROM fl_j".format(_K=_K), "PARTITION BY {_K}) AS tstar, arg_min(program, ord) OVER (PARTITION BY {_K}) AS first_program FROM fl_j".format(_K=_K))
             .replace("arg_min(source, ord) AS source\n", "any_value(m_so) AS source, any_value(first_program) AS program\n"))

LIVE_CASH_CTE = """
live_cash AS (SELECT * FROM fx_cash WHERE expires_at_utc > TIMESTAMP '2024-01-31 00:00:00')"""


def queue(L: Lake) -> DataFrame:
    """Work queue with the provider slug of its program carrier."""
    return L.fx_queue.withColumn("source", X.case_map("airline", AIRLINE_SOURCE))


QUEUE_CTE = """
queue AS (SELECT *, CASE airline WHEN 'AS' THEN 'alaska' WHEN 'DL' THEN 'delta' WHEN 'B6' THEN 'jetblue' WHEN 'TK' THEN 'turkish' WHEN 'EY' THEN 'etihad' WHEN 'WN' THEN 'southwest' END AS source FROM fx_queue)"""


def cash_attempts(L: Lake) -> DataFrame:
    """Cash collection attempts per unit, derived from the attempt log (fare_count = records)."""
    a = L.fx_attempt
    return a.select("origin", F.col("dest").alias("destination"),
                    F.date_add(F.lit(AS_OF_DATE).cast("date"), F.pmod(F.col("seq"), F.lit(31)).cast("int")).alias("date"),
                    X.case_map(F.pmod(F.col("seq"), F.lit(4)), {0: "economy", 1: "business", 2: "premium_economy"},
                               "first").alias("cabin"),
                    F.col("ts").alias("attempt_utc"), "seq", F.col("records").alias("fare_count"))


CASH_ATTEMPTS_CTE = """
cash_attempts AS (SELECT origin, dest AS destination, DATE '2024-01-31' + CAST(seq % 31 AS INT) AS date,
  CASE seq % 4 WHEN 0 THEN 'economy' WHEN 1 THEN 'business' WHEN 2 THEN 'premium_economy' ELSE 'first' END AS cabin,
  ts AS attempt_utc, seq, records AS fare_count FROM fx_attempt),
coverage AS (SELECT upper(origin) AS origin, upper(destination) AS destination, date, cabin, attempt_utc AS last_attempt_utc, fare_count,
  CASE WHEN fare_count = 0 THEN attempt_utc + INTERVAL 3 DAY ELSE attempt_utc END AS next_probe_utc
  FROM cash_attempts QUALIFY row_number() OVER (PARTITION BY upper(origin), upper(destination), date, cabin ORDER BY attempt_utc DESC, seq DESC) = 1)"""
