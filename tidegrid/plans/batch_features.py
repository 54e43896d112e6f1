"""Batch feature build: events -> grid -> demand -> calendar, lookbacks, target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.columns import calendar_features, grid_cell
from tidegrid.operators.demand import CELL, backfill, demand_per_cell, drop_unlabelled
from tidegrid.operators.history import upsert_table
from tidegrid.operators.lookback import (
    LOOKBACKS,
    TARGET,
    cumulative_columns,
    next_column,
    trailing_columns,
)


def batch_features(
    events: DataFrame,
    lat: str,
    lon: str,
    ts: str,
    value: str,
    size_km: float = 1.0,
    minutes=LOOKBACKS,
    lookback: str = "trailing",
) -> DataFrame:
    """Two shuffles: one for the demand aggregate, one for all window columns together.

    ``lookback="cumulative"`` gives the running-total variant of the lookback columns.
    """
    start = "feature_window_start"
    demand = demand_per_cell(grid_cell(events, lat, lon, size_km), CELL, ts, value)
    out = calendar_features(demand, start)
    history = trailing_columns if lookback == "trailing" else cumulative_columns
    out = out.withColumns(
        history(CELL, start, "demand_sum", minutes) | next_column(CELL, start, "demand_sum")
    )
    return drop_unlabelled(out, TARGET).drop("raw_demand_count", "demand_sum")


def run_backfill(
    events: DataFrame, zone: str, ts: str, value: str, start, end, target: str,
    horizons: Sequence[int] = LOOKBACKS,
) -> None:
    """Backfill ``[start, end)`` into a date-partitioned table. Rows are replaced by zone and
    window, so a range may be run again and may begin or end inside a day."""
    rows = backfill(events, zone, ts, value, start, end, horizons).withColumn(
        "feature_date", F.to_date("feature_window_start")
    )
    upsert_table(target, rows, [zone, "feature_window_start"], "feature_date")
