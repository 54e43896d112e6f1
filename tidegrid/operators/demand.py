"""Demand aggregation per place and time bucket, and the re-runnable backfill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.columns import PEAK_ONLINE, calendar_features, time_bucket
from tidegrid.operators.lookback import lookback_trailing

CELL = ["grid_id_latitude", "grid_id_longitude"]


def demand_per_cell(
    df: DataFrame, key: Sequence[str], ts: str, value: str, width: str = "15 minutes"
) -> DataFrame:
    """Count and sum per key and bucket. Partial sums are built before the shuffle, so a cell or
    bucket that holds a third of all events still sends one row per map task."""
    return (
        time_bucket(df, ts, width)
        .groupBy(*key, "feature_window_start")
        .agg(F.count(value).alias("raw_demand_count"), F.sum(value).alias("demand_sum"))
        .withColumn(
            "feature_window_end", F.col("feature_window_start") + F.expr(f"interval {width}")
        )
    )


def time_range(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows with ``start <= ts < end``; on a date-partitioned table this prunes partitions."""
    kind = df.schema[ts].dataType.typeName()
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    return df.filter((F.col(ts) >= low) & (F.col(ts) < high))


def drop_unlabelled(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target) > 0)


def backfill(
    df: DataFrame,
    zone: str,
    ts: str,
    value: str,
    start,
    end,
    horizons: Sequence[int] = (15, 30, 60, 1440),
) -> DataFrame:
    """Five-minute demand per zone with calendar flags and true trailing sums for buckets in
    ``[start, end)``.

    Events from the longest horizon before ``start`` are read as well, and the bucket that holds
    ``start`` is counted whole, so a re-run gives the rows of a run over all history.
    """
    seconds = F.unix_seconds(F.lit(start).cast("timestamp"))
    first = F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(300)))
    kind = df.schema[ts].dataType
    read_from = (first - F.expr(f"interval {max(horizons)} minutes")).cast(kind)
    kept = df.filter((F.col(ts) >= read_from) & (F.col(ts) < F.lit(end).cast(kind)))
    slots = demand_per_cell(kept, [zone], ts, value, "5 minutes")
    slots = calendar_features(slots, "feature_window_start", peak=PEAK_ONLINE)
    slots = lookback_trailing(slots, [zone], "feature_window_start", "demand_sum", horizons)
    return (
        slots.filter(F.col("feature_window_start") >= first)
        .withColumnRenamed("demand_sum", "demand_current_5min")
        .drop("raw_demand_count", "feature_window_end")
    )
