"""Batch history, feature tables, logs and reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def read_history(
    spark: SparkSession, path: str, schema: T.StructType | str, ts_col: str, fmt: str = "parquet"
) -> DataFrame:
    """Read with a declared schema (no inference pass) and parse the time column. A path that is
    not there gives an empty table of that schema."""
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        df = reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        df = spark.createDataFrame([], schema)
    if isinstance(df.schema[ts_col].dataType, T.StringType):
        return df.withColumn(ts_col, F.try_to_timestamp(ts_col))
    return df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def write_features(df: DataFrame, target: str, date_col: str = "feature_date") -> None:
    """Write by date, replacing only the dates present in ``df``. ``target`` is a path, or a table
    name if it has no slash; a table that exists keeps its columns and their order. The rebalance
    hint lets adaptive execution split a date that is far larger than the others and merge the
    small ones into few files."""
    spark = df.sparkSession
    rows = df.hint("rebalance", F.col(date_col))
    if "/" in target:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            date_col
        ).format("parquet").save(target)
    elif not spark.catalog.tableExists(target):
        rows.write.partitionBy(date_col).format("parquet").saveAsTable(target)
    else:
        # saveAsTable would replace the whole table. An insert keeps the other dates, if the session
        # says so: it does not look at writer options.
        before = spark.conf.get(OVERWRITE_MODE)
        spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            rows.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set(OVERWRITE_MODE, before)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_report(df: DataFrame, path: str, run_time: str) -> None:
    """Reports of one run replace what the same run wrote before, and no other run."""
    df.withColumn("run_time", F.lit(run_time)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run_time").json(path)
