"""Streaming feature build: payloads -> events -> grid -> windows -> messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegrid.functions.columns import grid_cell
from tidegrid.operators.demand import CELL
from tidegrid.sources.streams import DEMAND_EVENT, parse_events
from tidegrid.streaming.windows import stream_demand


def stream_features(
    payloads: DataFrame, value: str = "value", size_km: float = 1.0, watermark: str = "10 minutes"
) -> DataFrame:
    """Demand per cell and five minutes from raw payloads. Hand the result to ``stream_lookbacks``
    for trailing sums, or to ``write_event_stream`` to publish it."""
    events = parse_events(payloads, DEMAND_EVENT, "event_timestamp", value)
    cells = grid_cell(events, "pickup_latitude", "pickup_longitude", size_km)
    return stream_demand(cells, CELL, "timestamp", "demand_at_pickup", watermark=watermark)
