"""Sinks that are safe to run again: counted writes, an append keyed by run, retention by dropping partitions
(flt_validate, snk_run_metrics, snk_retention)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def write_counted(df: DataFrame, path: str, keep: Column, counts: dict) -> dict:
    """Write the rows that ``keep`` passes and return ``counts`` (name -> aggregate over all rows), taken in the pass that
    writes: no second job over the input. A task that runs again is counted once."""
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in counts.items()]).filter(keep).write.mode("overwrite").parquet(path)
    return dict(seen.get)


def append_once(rows: DataFrame, path: str, key, batch_id: int) -> DataFrame:
    """Append the rows whose key no other batch has appended, and return the table. A batch owns a partition: run again, also after
    a crash halfway, it replaces its own rows."""
    spark = rows.sparkSession
    layout = StructType([*rows.schema.fields, StructField("batch_id", LongType())])
    try:
        old = spark.read.schema(layout).parquet(path).filter(F.col("batch_id") != batch_id).select(*key)
        rows = rows.join(old, list(key), "left_anti")
    except AnalysisException:  # first append
        pass
    rows.select(*rows.columns, F.lit(batch_id).cast("bigint").alias("batch_id")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
    return spark.read.schema(layout).parquet(path)


def drop_partitions_before(spark, path: str, column: str, cutoff: str) -> list[str]:
    """Delete the partition folders ``column=value`` below ``cutoff`` (ISO dates compare as text) and return their values. Only
    folder names are read; a repeated call finds nothing left to do."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in fs.listStatus(folder):
        name, _, value = status.getPath().getName().partition("=")
        if name == column and value < cutoff and fs.delete(status.getPath(), True):
            dropped.append(value)
    return sorted(dropped)
