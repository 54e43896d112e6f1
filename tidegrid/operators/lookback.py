"""Lookback features and the target over one row per key and time bucket.

These windows are partitioned by the bare key. That is safe on their input: bucketed demand has at
most one row per key and bucket (about 35,000 a year for 15 minutes), however many events a key
has. The ``*_columns`` forms give bare expressions: added in one ``withColumns`` they share one
shuffle, one sort and one window pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidegrid.operators.chunks import global_rank

TARGET = "future_demand_next_15min"
LOOKBACKS = (15, 30, 60, 1440)


def _by_time(key: Sequence[str], ts: str):
    return W.partitionBy(*key).orderBy(F.unix_seconds(F.col(ts).cast("timestamp")))


def cumulative_columns(
    key: Sequence[str],
    ts: str,
    value: str,
    minutes: Sequence[int] = LOOKBACKS,
    step: int = 15,
) -> dict[str, Column]:
    w = _by_time(key, ts)
    earlier = F.sum(value).over(w.rowsBetween(W.unboundedPreceding, -1))
    position = F.row_number().over(w)
    return {
        f"demand_last_{m}min": F.when(position > max(m // step, 1), earlier)
        .otherwise(0)
        .cast("double")
        for m in minutes
    }


def lookback_cumulative(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    value: str,
    minutes: Sequence[int] = LOOKBACKS,
    step: int = 15,
) -> DataFrame:
    """Running total of all earlier rows of the key, 0 until ``minutes / step`` of them exist.
    Counts rows, not time: gaps are ignored."""
    return df.withColumns(cumulative_columns(key, ts, value, minutes, step))


def trailing_columns(
    key: Sequence[str], ts: str, value: str, minutes: Sequence[int] = LOOKBACKS
) -> dict[str, Column]:
    w = _by_time(key, ts)
    return {
        f"demand_last_{m}min": F.coalesce(
            F.sum(value).over(w.rangeBetween(-60 * m, -1)), F.lit(0)
        ).cast("double")
        for m in minutes
    }


def next_column(
    key: Sequence[str], ts: str, value: str, target: str = TARGET
) -> dict[str, Column]:
    following = F.lead(value, 1).over(_by_time(key, ts))
    return {target: F.coalesce(following, F.lit(0)).cast("double")}


def lookback_trailing(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    value: str,
    minutes: Sequence[int] = LOOKBACKS,
) -> DataFrame:
    """Sum over the last ``minutes`` of time, current bucket excluded."""
    return df.withColumns(trailing_columns(key, ts, value, minutes))


def next_demand(
    df: DataFrame, key: Sequence[str], ts: str, value: str, target: str = TARGET
) -> DataFrame:
    """Demand of the key's next row, 0 after the last one."""
    return df.withColumns(next_column(key, ts, value, target))


def same_hour_last_day(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    value: str,
    name: str = "demand_same_hour_last_day",
) -> DataFrame:
    """Demand of the key exactly 24 hours earlier, null if there was no such bucket.

    A frame of one second, one day back: shares the sort of the other lookbacks, where a
    self-join would read and shuffle the table twice.
    """
    day = 86_400
    w = _by_time(key, ts).rangeBetween(-day, -day)
    return df.withColumn(name, F.sum(value).over(w).cast("double"))


def split_train_test(
    df: DataFrame, key: Sequence[str], ts: str, test: float = 0.2, order: str = "time"
) -> DataFrame:
    """Add ``is_test`` for the last ``test`` share of the rows, cut at an exact row.

    ``order="time"`` cuts by time; ``order="cell"`` sorts by key first, which is what a split of
    the key-major feature table does. (key, ts) must be unique.
    """
    cols = [ts, *key] if order == "time" else [*key, ts]
    ranked = global_rank(df.select(*cols), cols)  # keys only; the table itself is never moved
    total = ranked.count()
    kept = total - math.ceil(test * total)
    if not 0 < kept < total:
        return df.withColumn("is_test", F.lit(kept <= 0))
    last = ranked.filter(F.col("_rank") == kept).first()
    cut = F.struct(*[F.lit(last[c]).cast(df.schema[c].dataType).alias(c) for c in cols])
    return df.withColumn("is_test", F.struct(*cols) > cut)
