"""Corpus pipeline over ``documents``: quality rules, line dedup, MinHash near-dedup, suffix-array dedup, packing.

Every stage works on all that its predecessor kept and is written as Parquet before the next one reads it. All but the
last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milesbase.llm import line_dedup, minhash, packing, quality_rules, suffix_dedup
from milesbase.llm.common import prepare, read_table, staged
from milesbase.llm.plans import token_pattern, tokenizer


def _counted(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType)).select(*like.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled cutoffs keep."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source removed."""
    return _counted(line_dedup.line_dedup(docs)[0], docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    return minhash.drop_near_duplicates(docs, size=5, percent=80)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that occur elsewhere too (nor characters that a cut splits)."""
    out, s = suffix_dedup.without_repeats(docs, with_bytes=False)
    return _counted(out.withColumn("text", F.col(s)["kept_text"]), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts, packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.tiktoken"), token_pattern(), added=packing.added_tokens(tokenizer("byte_bpe_50k.json")))


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("minhash", near_stage),
          ("suffix_dedup", suffix_stage), ("packing", packing_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
