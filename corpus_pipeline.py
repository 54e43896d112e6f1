"""From raw documents to a training mix, one operator of ``tidegrid.llm`` per stage.

Every stage takes the documents its predecessor kept and returns documents with the columns they came with; the
last one adds what it decided. Stages are written as Parquet and read again, so a lost executor costs at most the
stage it was lost in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.llm import decontaminate, language_id, line_dedup, mixing, near_dedup
from tidegrid.session import durable, scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those that come out as ``und`` go."""
    model = language_id.train(language_id.language_sample(docs))
    return language_id.identify(docs, model).filter(F.col("lang_pred") != "und").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more share (the largest id keeps them)."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(
        *docs.columns
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id."""
    gone = durable(near_dedup.near_groups(docs).filter(~F.col("kept")).select("doc_id").distinct())
    return docs.join(near_dedup.small_side(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``size, source_size, target, taken``."""
    return mixing.mix_sources(docs).filter(F.col("taken") > 0)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix),
]

#: Trained models and components of links have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; results between them lie in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
