"""Column defaults of the keyed tables, and sinks that give the same table when they run again."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from milesbase.operators import sinks
from milesbase.sources import keyed

NOW = "2024-01-31 00:00:00"


def _path(spark, name):
    return os.path.join(tempfile.mkdtemp(prefix="sinks-", dir=spark.conf.get("spark.checkpoint.dir").rsplit("/", 1)[0]), name)


def test_old_files_read_the_default_and_new_ones_their_value(spark):
    path = _path(spark, "budget")
    spark.createDataFrame([("AS",), ("DL",)], "airline string").write.mode("append").parquet(path)
    spark.createDataFrame([("B6", 3.0, None)], "airline string, tokens double, capacity double").write.mode("append").parquet(path)
    df = keyed.read_keyed(spark, path, "airline_budget", NOW)
    got = {r["airline"]: (r["tokens"], r["capacity"], r["last_refill_utc"]) for r in df.collect()}
    now = dt.datetime(2024, 1, 31)
    assert got == {"AS": (0.0, 0.0, now), "DL": (0.0, 0.0, now), "B6": (3.0, None, now)}  # a written null stays one
    rep = {r["column_name"]: (r["rows"], r["non_null"], r["at_default"], r["missing"]) for r in keyed.column_report(df, "airline_budget", NOW).collect()}
    assert rep["tokens"] == (3, 3, 2, 0) and rep["capacity"] == (3, 2, 2, 1) and rep["airline"] == (3, 3, 0, 0)
    assert df.filter("tokens = 0").count() == 2  # a filter on a defaulted column


def test_keyed_table_without_rows(spark):
    path = _path(spark, "empty")
    spark.createDataFrame([], "origin string").write.parquet(path)
    df = keyed.read_keyed(spark, path, "routes_queue", NOW)
    assert {tuple(r)[2:] for r in keyed.column_report(df, "routes_queue", NOW).collect()} == {(0, 0, 0, 0)}
    assert keyed.key_report(df, "routes_queue").collect()[0][1:] == (0, 0, 0)


def test_every_table_has_a_key_of_its_own_columns():
    assert set(keyed.KEYS) == set(keyed.TABLES) and len(keyed.TABLES) == 9
    for name, key in keyed.KEYS.items():
        required = {c for c, _, need, _ in keyed.TABLES[name] if need}
        assert set(key) <= required


def test_counted_write(spark):
    path = _path(spark, "kept")
    got = sinks.write_counted(spark.range(10), path, F.col("id") > 6, {"all": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)})
    assert got == {"all": 10, "odd": 5}
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [7, 8, 9]
    assert sinks.write_counted(spark.range(0), _path(spark, "none"), F.col("id") > 6, {"all": F.count(F.lit(1))}) == {"all": 0}


def test_append_once_survives_replays_and_repeats(spark):
    path = _path(spark, "log")
    rows = lambda *ids: spark.createDataFrame([(i, f"v{i}") for i in ids], "run_id long, v string")
    assert sinks.append_once(rows(), path, ["run_id"], 0).count() == 0
    sinks.append_once(rows(1, 2), path, ["run_id"], 1)
    for _ in range(2):  # the second is a replay
        got = sinks.append_once(rows(2, 3), path, ["run_id"], 2)
        assert sorted((r["run_id"], r["batch_id"]) for r in got.collect()) == [(1, 1), (2, 1), (3, 2)]


def test_retention_deletes_only_old_folders(spark):
    path = _path(spark, "dated")
    spark.createDataFrame([(i, dt.date(2024, 1, 28 + i % 4)) for i in range(8)], "id int, date date").write.partitionBy("date").parquet(path)
    assert sinks.drop_partitions_before(spark, path, "date", "2024-01-30") == ["2024-01-28", "2024-01-29"]
    assert sinks.drop_partitions_before(spark, path, "date", "2024-01-30") == []
    assert {r["date"].isoformat() for r in spark.read.parquet(path).collect()} == {"2024-01-30", "2024-01-31"}
