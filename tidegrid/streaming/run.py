"""Start a stream over what is there now and read back its output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrid.session import scratch_path


def run_available(stream: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Run to the end of the available input into a Parquet table and return that table. Rows go
    from executors to files; nothing passes through the driver."""
    spark: SparkSession = stream.sparkSession
    out = path or scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, f"{name}-state"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
