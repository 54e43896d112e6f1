"""Streams that need only windows and joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.columns import calendar_features, event_time
from tidegrid.operators.quality import Rules, check_contract

FLAGS = ["hour_of_day", "day_of_week", "is_weekend", "is_holiday", "peak_hour_indicator"]


def stream_demand(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    value: str,
    width: str = "5 minutes",
    watermark: str = "10 minutes",
    with_time: bool = False,
) -> DataFrame:
    """Demand per key and tumbling window: sum, count, average. Partial sums are made before the
    shuffle into the state. The calendar flags follow from the window, so they are added after
    the aggregate and need no place in the state key. ``with_time`` adds ``window_time``, the event time that a
    stateful operator after this one needs."""
    agg = (
        df.withColumn(ts, event_time(ts))
        .withWatermark(ts, watermark)
        .groupBy(F.window(ts, width), *key)
        .agg(
            F.sum(value).alias("demand_current_5min"),
            F.count(value).alias("raw_demand_count"),
            F.avg(value).alias("demand_avg"),
        )
    )
    return calendar_features(agg.withColumn("_start", F.col("window.start")), "_start").select(
        F.col("window.start").alias("feature_window_start"),
        F.col("window.end").alias("feature_window_end"),
        *key,
        *FLAGS,
        "demand_current_5min",
        "raw_demand_count",
        "demand_avg",
        *([F.window_time("window").alias("window_time")] if with_time else []),
    )


def stream_flash_insight(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    seconds: int = 10,
    threshold: int = 5,
    slide: int = 1,
    watermark: str = "10 minutes",
) -> DataFrame:
    """Count per key over sliding windows, judged at every slide.

    Events are first counted per slide, so a window is the sum of a few counts and a busy key
    does not multiply its raw events by the number of windows they lie in.
    """
    ticks = (
        df.withColumn(ts, event_time(ts))
        .withWatermark(ts, watermark)
        .groupBy(F.window(ts, f"{slide} seconds").alias("tick"), *key)
        .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_event"))
    )
    return (
        ticks.groupBy(
            F.window(F.window_time("tick"), f"{seconds} seconds", f"{slide} seconds"), *key
        )
        .agg(F.sum("n").alias("pulse_count"), F.min("first_event").alias("first_event"))
        .select(
            F.col("window.end").alias("judged_at"),
            *key,
            "pulse_count",
            F.when(F.col("pulse_count") >= threshold, "CRITICAL").otherwise("NORMAL").alias(
                "insight_level"
            ),
            F.when(F.col("pulse_count") >= threshold, F.col("first_event")).alias("window_start"),
        )
    )


def stream_feedback_error(
    pred: DataFrame,
    actual: DataFrame,
    key: Sequence[str],
    ts: str,
    watermark: str = "10 minutes",
    how: str = "inner",
    predicted: str = "predicted",
    observed: str = "actual",
) -> DataFrame:
    """Predictions joined to actuals on key and time; both sides forget rows the watermark passed.
    ``how="left"`` also gives predictions whose actual never came."""
    p = pred.withColumn(ts, event_time(ts)).withWatermark(ts, watermark)
    a = (
        actual.withColumn(ts, event_time(ts))
        .withWatermark(ts, watermark)
        .select(*[F.col(k).alias(f"_{k}") for k in key], F.col(ts).alias("_at"), observed)
    )
    same = F.col(ts) == F.col("_at")
    for k in key:
        same = same & (F.col(k) == F.col(f"_{k}"))
    error = F.col(observed) - F.col(predicted)
    return (
        p.join(a, same, {"left": "leftOuter"}.get(how, how))
        .drop("_at", *[f"_{k}" for k in key])
        .withColumns({"error": error, "absolute_error": F.abs(error)})
    )


def stream_quarantine(
    df: DataFrame, json_col: str, contract: Rules, path: str, checkpoint: str, trigger: str | None = None
):
    """Check each message against the contract and write valid and rejected ones apart.

    One pass per micro-batch, into ``path/batch_id=N/is_valid=true|false``. A batch that is run
    again overwrites its own folder, so no message is written twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            check_contract(batch, json_col, contract)
            .write.mode("overwrite")
            .partitionBy("is_valid")
            .parquet(f"{path}/batch_id={batch_id}")
        )

    timing = {"processingTime": trigger} if trigger else {"availableNow": True}
    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**timing)
        .start()
    )
