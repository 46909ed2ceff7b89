"""Plans whose cost must not grow faster than their input."""

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from milesbase.operators import flatten as FL
from milesbase.operators import folds, merge, serving, text_parse
from milesbase.operators.numbering import stored
from milesbase.plans import domain as D

T0 = datetime(2024, 1, 30)


def _observations(spark, n, keys, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        at = None if r.random() < 0.05 else T0 + timedelta(hours=r.randrange(12))
        expires = None if r.random() < 0.05 else T0 + timedelta(hours=r.randrange(48))
        rows.append((r.choice([*range(keys), None]), r.choice([1, 1, 1, 2, None]), at, expires, i, f"s{i % 3}"))
    return spark.createDataFrame(rows, "k int, p int, scraped_at_utc timestamp_ntz, expires_at_utc timestamp_ntz, o int, src string")


_MERGE = (["k"], ["p"], ["scraped_at_utc", "expires_at_utc"], ["scraped_at_utc", "p", "o"], "2024-01-31 00:00:00")


def test_deciding_rows_give_the_merge_of_all_rows(spark):
    for seed, n, keys in ((1, 400, 40), (2, 400, 5), (3, 60, 30)):
        b = stored(_observations(spark, n, keys, seed), "test-batch")
        old = merge.latest_per_key(_observations(spark, 30, keys, seed + 10), ["k"], ["o"]).drop("o")
        for current in (None, old):
            args = dict(keep_cols=["src"], strategy="window")
            want = sorted(str(tuple(r)) for r in merge.conditional_merge(current, b, *_MERGE, **args).collect())
            got = merge.conditional_merge(current, b, *_MERGE, keep_cols=["src"], crowded=0)
            assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_few_rows_of_a_long_history_are_sorted(spark):
    rows = [(1, 5 if i > 100 else 4, T0 - timedelta(minutes=i), T0 + timedelta(days=2), i, "a") for i in range(3000)]
    b = spark.createDataFrame(rows, "k int, p int, scraped_at_utc timestamp_ntz, expires_at_utc timestamp_ntz, o int, src string")
    seq = stored(merge._sequence(None, b, ["k", "p", "scraped_at_utc", "expires_at_utc", "src"], ["scraped_at_utc", "p", "o"]), "test-seq")
    left = merge.deciding_rows(seq, merge._ends(seq, ["k"]), ["k"], ["p"], "2024-01-31 00:00:00", "expires_at_utc", ["src"])
    assert left.count() <= 4


def test_layout_does_not_repeat_the_build(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def once(it):
        for b in it:
            seen.add(len(b))
            yield b

    spark.range(5).write.parquet(str(tmp_path / "x.parquet"))
    L = type("L", (), {})()
    L.spark, L.sf_dir, L._frames = spark, str(tmp_path), {}
    df = spark.range(1000).mapInPandas(once, "id long").select(
        (F.lit("2024-02-01").cast("date") + F.pmod("id", F.lit(3)).cast("int")).alias("date"), F.lit("SEA").alias("origin"), F.lit("JFK").alias("destination"), F.lit("first").alias("cabin_class"), "id")
    assert D.materialized(L, "test_scale", lambda: df, D.date_layout).count() == 1000
    assert seen.value == 1000


def test_a_history_of_some_thousand_rows_is_folded_without_doubling(spark, monkeypatch):
    n = 2000
    rows = [("a", 1 + (i // 7) % 2, T0 + timedelta(hours=i), T0 + timedelta(hours=i + 3)) for i in range(n)]
    log = spark.createDataFrame(rows, "key string, points int, scraped_at_utc timestamp_ntz, expires_at_utc timestamp_ntz")
    want = folds.merge_replay(log, ["key"], ["points"], order=["points"], block=10).collect()

    def doubled(*_):
        raise AssertionError("shuffled once for each doubling")

    monkeypatch.setattr(folds, "_replayed_by_pointers", doubled)
    assert folds.merge_replay(log, ["key"], ["points"], order=["points"]).collect() == want


def test_alaska_rows_do_not_carry_the_flat_array(spark):
    df = spark.createDataFrame([("SEA", "JFK", datetime(2024, 2, 1).date(), T0, json.dumps({}))],
                               "origin string, destination string, travel_date date, scraped_at_utc timestamp_ntz, payload string")
    plan = FL.flatten_alaska(df, details=True)._jdf.queryExecution().optimizedPlan().toString()
    generated = [x for x in plan.splitlines() if "Generate explode" in x or "Generate posexplode" in x]
    above = plan[:plan.rindex("Generate")]
    assert generated and "_flat" not in above


def test_answers_are_ranked_where_they_are_joined(spark):
    day = datetime(2024, 2, 1).date()
    f = spark.createDataFrame([("SEA", "JFK", day, "first", "AS", 0, 3, p, f"AS {p}") for p in range(1, 30)],
                              "origin string, destination string, date date, cabin_class string, airline string, stops int, available_seats int, points_cost int, raw_flight_number string")
    r = spark.createDataFrame([(i, "SEA", "JFK", day, day, None, None, 1, None) for i in range(50)],
                              "request_id long, origin string, destination string, date_from date, date_to date, cabin_class string, airline string, passengers int, max_points int")
    out = serving.serve_awards(F.broadcast(f), r, "2024-01-31", limit=10)
    assert out.count() == 500
    plan = out._jdf.queryExecution().executedPlan().toString()
    window = plan.index("Window [row_number")
    assert "Exchange hashpartitioning(request_id" not in plan[window:plan.index("BroadcastHashJoin", window)]


def test_lists_are_sorted_without_the_columns_that_only_the_answer_shows(spark):
    day = datetime(2024, 2, 1).date()
    f = spark.createDataFrame([("SEA", "JFK", day + timedelta(days=p % 2), "first", "AS", 0, 3, 100 + p // 3, f"AS {p}", "x" * 50) for p in range(30)],
                              "origin string, destination string, date date, cabin_class string, airline string, stops int, available_seats int, points_cost int, "
                              "raw_flight_number string, note string")
    r = spark.createDataFrame([(i, "SEA", "JFK", day, day + timedelta(days=1), None, None, 1, None) for i in range(5)],
                              "request_id long, origin string, destination string, date_from date, date_to date, cabin_class string, airline string, passengers int, max_points int")
    out = serving.serve_awards(f, r, "2024-01-31", limit=20)
    want = [(x.date, x.points_cost, x.raw_flight_number, x.note) for x in sorted(f.collect(), key=lambda x: (x.date, x.points_cost, x.raw_flight_number))][:20]
    got = out.orderBy("request_id", "rank").collect()
    assert [(x.date, x.points_cost, x.raw_flight_number, x.note) for x in got] == want * 5 and [x["rank"] for x in got] == [*range(1, 21)] * 5
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    window = plan.index("Window [row_number")
    assert "note" not in plan[window:plan.index("Join ", window)]
    assert serving.serve_awards(f.limit(0), r, "2024-01-31").count() == 0


def test_a_duration_is_searched_once_for_each_of_its_parts(spark):
    df = spark.createDataFrame([("12h 40m",), ("13h",), ("0h",), ("",), ("none",), (None,), ("99999999999h",), ("1h 99999999999m",), ("2H5M",)], "t string")
    out = df.select(text_parse.duration_text("t").alias("m"))
    assert [x.m for x in out.collect()] == [760, 780, None, None, None, None, None, None, 125]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 2 and "RLIKE" not in plan


def test_times_of_a_trip_are_read_once(spark):
    """Duration, next-day flag and details each name both clocks; their texts were parsed again for each."""
    z = spark.createDataFrame([("SEA", "America/Los_Angeles"), ("JFK", "America/New_York")], "iata string, tz string")
    df = spark.createDataFrame([("SEA", "JFK", datetime(2024, 2, 1).date(), T0, "{}")],
                               "origin string, destination string, travel_date date, scraped_at_utc timestamp_ntz, payload string")
    for flatten in (FL.flatten_turkish, FL.flatten_jetblue, FL.flatten_delta):
        plan = flatten(df, z, details=True)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("gettimestamp(") == 2, flatten.__name__
