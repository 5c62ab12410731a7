"""The training-data pipeline: each stage works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, host_rules, lines, near_dup, pieces
from tidemark.llm.queries import PIECE_MODEL, tokenizer
from tidemark.llm.registry import ship
from tidemark.sources.scratch import written


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return df.withColumn("n_chars", F.length("text").cast("bigint")).select("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return host_rules.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(lines.drop_common_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents with their ids; the text is the one that the ids spell."""
    ship(spark)
    coded = pieces.encode_decode(docs, tokenizer(PIECE_MODEL))
    return coded.select("doc_id", F.col("decoded").alias("text"), "lang", "source", "n_chars", "n_pieces", "ids")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup),
          ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

# The near-dedup and encoding stages have no SQL form; tests/llm holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
