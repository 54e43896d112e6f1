"""What streams with a watermark leave out: rows behind it and rows without a time, kept and counted per micro-batch.

The mark of a micro-batch is the newest time of all micro-batches before it, in whole milliseconds, less the delay. Operators that
hold rows back until the mark has passed them (``stateful.InOrder``) leave out what is not after the mark of its own batch. Windows
and other operators of Spark close by that mark and leave out, with their rows or window ends, what is not after the mark of the
batch before. The side query here reads the same source, keeps the same marks in a small table, and writes every such row
with its batch. Rows without a time have no place in any window or order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid.functions.columns import event_time

BATCHES = "batch_id long, mark_ms long, newest_ms long, n_rows long, n_late long, n_no_time long"


def milliseconds(spark: SparkSession, delay: str) -> int:
    """Length of an interval such as ``10 minutes``."""
    begin = F.lit("1970-01-01").cast("timestamp_ntz")
    length = F.timestamp_diff("MICROSECOND", begin, begin + F.expr(f"INTERVAL {delay}"))
    return int(spark.range(1).select(length).first()[0] // 1000)


def left_out(ts: Column, mark_ms: Column, width_ms: int | None = None) -> Column:
    """``late``, ``no time`` or null. With ``width_ms`` a row is late when its tumbling window has ended by the mark."""
    at = F.floor(F.unix_micros(ts) / 1000)
    if width_ms:
        at = (F.floor(at / width_ms) + 1) * width_ms
    return F.when(ts.isNull(), "no time").when(at <= mark_ms, "late")


def stream_late_rows(
    df: DataFrame, ts: str, path: str, checkpoint: str, watermark: str = "10 minutes", width: str | None = None,
    held_back: bool = True, trigger: str | None = None,
) -> StreamingQuery:
    """Write what a stream over ``df`` with this watermark leaves out to ``path/rows`` (all columns, ``reason``, ``batch_id``), and
    a row per micro-batch to ``path/batches``. ``held_back``: the stream holds rows back until the mark passes them; for windows
    give their ``width``.

    A batch that runs again overwrites its own folders and finds the mark it had before. ``df`` must be cut into the same
    micro-batches as the stream it stands beside: same source, same limit per trigger.
    """
    spark = df.sparkSession
    delay, size = milliseconds(spark, watermark), milliseconds(spark, width) if width else None
    behind = 0 if held_back and not width else 1
    rows = df.withColumn(ts, event_time(ts))

    def write(batch: DataFrame, batch_id: int) -> None:
        known = batches(batch.sparkSession, path).filter(F.col("batch_id") < batch_id - behind)
        newest = known.agg(F.max("newest_ms")).first()[0]
        mark = max(0, newest - delay) if newest is not None else 0
        judged = batch.withColumn("reason", left_out(F.col(ts), F.lit(mark), size))
        folder = f"batch_id={batch_id}"
        judged.filter("reason IS NOT NULL").write.mode("overwrite").parquet(f"{path}/rows/{folder}")
        judged.agg(
            F.lit(mark).cast("long").alias("mark_ms"), F.floor(F.unix_micros(F.max(ts)) / 1000).cast("long").alias("newest_ms"),
            F.count("*").alias("n_rows"), F.count_if(F.col("reason") == "late").alias("n_late"),
            F.count_if(F.col("reason") == "no time").alias("n_no_time"),
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/batches/{folder}")

    timing = {"processingTime": trigger} if trigger else {"availableNow": True}
    batches(spark, path, create=True)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**timing).start()


def batches(spark: SparkSession, path: str, create: bool = False) -> DataFrame:
    """One row per micro-batch: its mark, the newest time in it, and how many rows it had and left out."""
    if create:
        spark.createDataFrame([], BATCHES).write.mode("append").partitionBy("batch_id").parquet(f"{path}/batches")
    return spark.read.schema(BATCHES).option("basePath", f"{path}/batches").parquet(f"{path}/batches")


def late_rows(df: DataFrame, path: str) -> DataFrame:
    """The rows left out, in the columns of ``df`` with ``reason`` and ``batch_id``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.sparkSession.read.schema(f"{columns}, reason string, batch_id long").option("basePath", f"{path}/rows").parquet(f"{path}/rows")
