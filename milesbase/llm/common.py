"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milesbase.session import checkpoint_dir, ship_package

#: ASCII white space that separates words: space and \t \n \v \f \r
WS = " \t\n\x0b\x0c\r"
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (unique per call, so concurrent runs never meet)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)  # texts take a third less room than by the default codec
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers."""
    ship_package(spark)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare case-insensitively in Spark)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def col_of(df: DataFrame, name: str) -> Column:
    return df[f"`{name}`"]


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; empty for null, empty or blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_SPLIT))
