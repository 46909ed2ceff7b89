"""Structured Streaming jobs (str_merge, str_freshness, str_route_state).

All three read landed parquet files with ``readStream`` and run with the
``availableNow`` trigger, checkpointing under the cluster's shared
``spark.checkpoint.dir`` so a restarted job resumes where it stopped:

* str_merge: ``foreachBatch`` reads the date partitions that the micro-batch
  touches, applies the keyed conditional merge and writes those partitions
  into a new directory (a path is never read and overwritten in one plan). A
  commit log of batch ids makes a replayed micro-batch a no-op; partitions
  that a later commit has replaced are removed one commit after.
* str_freshness: a stateful streaming aggregation per source; every trigger
  writes the complete per-source snapshot.
* str_route_state: ``applyInPandasWithState`` keyed by route folds scrape and
  block events into (rate, interval, next scrape). Events older than the
  key's last applied event are late: they leave state untouched and go to a
  side output instead.
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import timedelta

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StringType, StructField, StructType

from milesbase.operators import merge
from milesbase.session import checkpoint_dir
from milesbase.sources.dims import BLOCK_COOLDOWN_MIN, CHANGE_RATE_ALPHA, CHANGE_RATE_SEED


def job_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of a job inside the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), "streams", name, uuid.uuid4().hex)


def land(df: DataFrame, path: str, key, files: int | None = None) -> None:
    """Land a frame as parquet files partitioned by ``key`` (a key's rows share a file); without ``files`` their
    number follows the data (adaptive execution joins small shuffle partitions)."""
    by = [F.col(c) for c in key]
    (df.repartition(files, *by) if files else df.repartition(*by)).write.mode("overwrite").parquet(path)


def _run_available_now(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


# ------------------------------------------------------------------ str_merge
class VersionedTable:
    """A table stored as immutable version directories plus a batch-id commit log."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.log = os.path.join(root, "_commits")

    def _log(self):
        try:
            return self.spark.read.parquet(self.log)
        except AnalysisException:
            return None

    def last_commit(self):
        log = self._log()
        if log is None:
            return None
        row = log.orderBy(F.col("batch_id").desc()).select("batch_id", "path").first()
        return (row["batch_id"], row["path"]) if row else None

    def current(self) -> DataFrame | None:
        last = self.last_commit()
        return self.spark.read.parquet(last[1]) if last else None

    def commit(self, batch_id: int, df: DataFrame) -> None:
        path = os.path.join(self.root, f"v{batch_id:09d}")
        df.write.mode("overwrite").parquet(path)
        self.spark.createDataFrame([(batch_id, path)], "batch_id long, path string").write.mode("append").parquet(self.log)


class PartitionedTable(VersionedTable):
    """The same for a table partitioned by ``by`` (part of its key): a commit writes the partitions it touches only, and the log
    names the newest folder of each. The driver holds the partitions' names, never rows."""

    def __init__(self, spark: SparkSession, root: str, schema, by: str):
        super().__init__(spark, root)
        self.schema, self.by = schema, by

    def _part(self):
        """Name of a row's partition (null and "none" share one)."""
        return F.coalesce(F.col(self.by).cast("string"), F.lit("none"))

    def _newest(self, log: DataFrame) -> DataFrame:
        return log.filter(F.col("path").isNotNull()).groupBy("part").agg(F.max_by("path", "batch_id").alias("path"))

    def current(self, touched_by: DataFrame | None = None) -> DataFrame | None:
        """The table, or only the partitions that rows of ``touched_by`` fall in."""
        log = self._log()
        if log is None:
            return None
        live = self._newest(log)
        if touched_by is not None:
            live = live.join(touched_by.select(self._part().alias("part")).distinct(), "part", "left_semi")
        paths = [r["path"] for r in live.select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], self.schema) if touched_by is None else None
        return self.spark.read.schema(self.schema).parquet(*paths)

    def commit(self, batch_id: int, df: DataFrame) -> None:
        path = os.path.join(self.root, f"v{batch_id:09d}")
        cols = [f.name for f in self.schema]
        df.select(*cols, self._part().alias("_part")).repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(path)
        layout = StructType([*self.schema.fields, StructField("_part", StringType())])
        written = [r["_part"] for r in self.spark.read.schema(layout).parquet(path).select("_part").distinct().collect()]
        rows = [(batch_id, os.path.join(path, f"_part={part}"), part) for part in written] or [(batch_id, None, None)]
        old = self._log()
        replaced = [] if old is None else [r["path"] for r in old.filter(F.col("path").isNotNull()).join(
            self._newest(old).select(F.col("path").alias("live")), F.col("path") == F.col("live"), "left_anti").select("path").collect()]
        self.spark.createDataFrame(rows, "batch_id long, path string, part string").coalesce(1).write.mode("append").parquet(self.log)
        # what an earlier commit had replaced: readers of the version before this one don't need it
        for p in replaced:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(p)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def merge_stream(spark: SparkSession, landing: str, schema, table_root: str, checkpoint: str, key, material, stamps,
                 order_cols, as_of, keep_cols=(), files_per_trigger: int = 1, partition_by: str | None = None) -> VersionedTable:
    """Micro-batches merged into a table; with ``partition_by``, a key column, only the touched partitions are read and written."""
    kept = [*key, *material, *stamps, *keep_cols]
    if partition_by:
        table = PartitionedTable(spark, table_root, StructType([schema[c] for c in kept]), partition_by)
    else:
        table = VersionedTable(spark, table_root)

    def apply(batch: DataFrame, batch_id: int) -> None:
        last = table.last_commit()
        if last is not None and last[0] >= batch_id:
            return  # replayed micro-batch: already committed
        current = table.current(batch) if partition_by else table.current()
        table.commit(batch_id, merge.conditional_merge(current, batch, key, material, stamps, order_cols, as_of, keep_cols=keep_cols))

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
    _run_available_now(stream.writeStream.foreachBatch(apply), checkpoint)
    return table


# ------------------------------------------------------------------ str_freshness
def freshness_stream(spark: SparkSession, landing: str, schema, out: str, checkpoint: str, as_of) -> DataFrame:
    ts = F.lit(as_of).cast("timestamp_ntz")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    agg = stream.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.max("scraped_at_utc").alias("newest_scrape"),
                                       F.count_if(F.col("expires_at_utc") > ts).alias("unexpired_rows"))
    table = VersionedTable(spark, out)

    def snapshot(batch: DataFrame, batch_id: int) -> None:
        last = table.last_commit()
        if last is None or last[0] < batch_id:
            table.commit(batch_id, batch)

    _run_available_now(agg.writeStream.outputMode("complete").foreachBatch(snapshot), checkpoint)
    res = table.current()
    return res.withColumn("newest_age_h", F.round(
        F.timestamp_diff("MICROSECOND", F.col("newest_scrape"), ts).cast("double") / 1e6 / 3600.0, 1))


# ------------------------------------------------------------------ str_route_state
ROUTE_KEY = ["origin", "destination", "airline"]
EVENT_SCHEMA = ("origin string, destination string, airline string, t timestamp_ntz, blocked boolean, "
                "economy int, premium_economy int, business int, first int, lo int, hi int, step int")
STATE_SCHEMA = ("prev string, rate double, interval_h double, next_us long, changes long, scrapes long, last_us long")
OUT_SCHEMA = ("kind string, origin string, destination string, airline string, rate double, interval_h double, "
              "next_scrape_at_utc timestamp_ntz, changes long, scrapes long, late_t timestamp_ntz")
STATE_COLS = ["origin", "destination", "airline", "rate", "interval_h", "next_scrape_at_utc", "changes", "scrapes"]
_CABINS = ["economy", "premium_economy", "business", "first"]


def _cheap_key(row) -> str:
    return json.dumps([None if pd.isna(row[c]) else int(row[c]) for c in _CABINS])


def _route_fold(key, pdfs, state):
    """Fold one key's new events into its state (mark_scraped semantics, see folds.mark_scraped_fold)."""
    if state.exists:
        prev, rate, iv, next_us, changes, scrapes, last_us = state.get
    else:
        prev, rate, iv, next_us, changes, scrapes, last_us = None, None, None, None, 0, 0, None
    late: list = []
    chunks = list(pdfs)  # one key's events of this trigger; order across chunks is not guaranteed
    pdf = pd.concat(chunks, ignore_index=True) if chunks else pd.DataFrame()
    if len(pdf):
        pdf = pdf.sort_values(["t", "blocked"], kind="mergesort")
    for row in (pdf.to_dict("records") if len(pdf) else []):
        if iv is None:
            iv, rate = float(row["lo"]), CHANGE_RATE_SEED
        t_us = int(pd.Timestamp(row["t"]).value // 1000)
        if last_us is not None and t_us < last_us:
            late.append(row["t"])  # side output, never applied to state
            continue
        last_us = t_us
        if row["blocked"]:
            next_us = t_us + BLOCK_COOLDOWN_MIN * 60 * 1_000_000
            continue
        cheap = _cheap_key(row)
        chg = prev is None or prev != cheap
        rate = CHANGE_RATE_ALPHA * (1.0 if chg else 0.0) + (1.0 - CHANGE_RATE_ALPHA) * rate
        nxt = iv * 0.5 if chg else iv + row["step"]
        iv = float(max(row["lo"], min(row["hi"], nxt)))
        next_us = t_us + int(round(iv * 3600 * 1_000_000))
        changes += int(chg)
        scrapes += 1
        prev = cheap
    state.update((prev, rate, iv, next_us, changes, scrapes, last_us))
    nxt_ts = None if next_us is None else pd.Timestamp(0) + timedelta(microseconds=next_us)
    base = {"origin": key[0], "destination": key[1], "airline": key[2]}
    rows = [{"kind": "state", **base, "rate": rate, "interval_h": iv, "next_scrape_at_utc": nxt_ts, "changes": changes,
             "scrapes": scrapes, "late_t": None}]
    rows += [{"kind": "late", **base, "rate": None, "interval_h": None, "next_scrape_at_utc": None, "changes": None,
              "scrapes": None, "late_t": t} for t in late]
    yield pd.DataFrame(rows)


def route_state_stream(spark: SparkSession, landing: str, out: str, checkpoint: str) -> DataFrame:
    """Keyed route state; returns the state table. Late events go to ``out/_late``, a partition for each batch."""
    stream = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
    states = stream.groupBy(*ROUTE_KEY).applyInPandasWithState(
        _route_fold, OUT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)
    table = VersionedTable(spark, out)
    late_path = os.path.join(out, "_late")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        last = table.last_commit()
        if last is not None and last[0] >= batch_id:
            return
        # a replayed batch writes its own partition again instead of adding to it
        batch.filter(F.col("kind") == "late").select(*ROUTE_KEY, F.col("late_t").alias("t"), F.lit(batch_id).alias("batch_id")) \
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(late_path)
        upd = batch.filter(F.col("kind") == "state").select(*STATE_COLS)
        cur = table.current()
        nxt = upd if cur is None else cur.join(upd.select(*ROUTE_KEY), ROUTE_KEY, "left_anti").unionByName(upd)
        table.commit(batch_id, nxt)

    _run_available_now(states.writeStream.outputMode("update").foreachBatch(upsert), checkpoint)
    return table.current()


def late_events(spark: SparkSession, out: str) -> DataFrame | None:
    try:
        return spark.read.parquet(os.path.join(out, "_late"))
    except AnalysisException:
        return None
