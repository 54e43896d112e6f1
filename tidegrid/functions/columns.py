"""Column expressions: grid cells, time buckets, calendar, masking, routing of threats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KM_PER_DEGREE = 111.0

# Peak-hour ranges (inclusive hours) of the batch and of the online rule.
PEAK_BATCH = ((7, 9), (17, 20))
PEAK_ONLINE = ((7, 9), (16, 18))

# Yearly holidays as month-day.
HOLIDAYS = ("03-20", "03-21", "03-22", "03-23", "03-24", "08-19")

# Fields treated as personal data unless the caller says otherwise.
SENSITIVE_FIELDS = (
    "user_id",
    "driver_id",
    "start_location_coords",
    "end_location_coords",
    "device_id",
    "ip_address",
    "phone_number",
)


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(c: str | Column) -> Column:
    """Any timestamp flavour as a zoned timestamp (watermarks refuse the zone-less type)."""
    return as_col(c).cast("timestamp")


def grid_cell(df: DataFrame, lat: str, lon: str, size_km: float = 1.0) -> DataFrame:
    """Add integer cell ids. Cells shrink in longitude with the cosine of the latitude; the cast
    truncates toward zero."""
    degrees = size_km / KM_PER_DEGREE
    lon_degrees = F.lit(size_km) / (F.lit(KM_PER_DEGREE) * F.cos(F.radians(F.col(lat))))
    return df.withColumns(
        {
            "grid_id_latitude": (F.col(lat) / F.lit(degrees)).cast("int"),
            "grid_id_longitude": (F.col(lon) / lon_degrees).cast("int"),
        }
    )


def time_bucket(df: DataFrame, ts: str, width: str = "15 minutes") -> DataFrame:
    """Add the start and end of the tumbling window that holds ``ts``."""
    slot = F.window(event_time(ts), width)
    return (
        df.withColumn("_slot", slot)
        .withColumns(
            {"feature_window_start": F.col("_slot.start"), "feature_window_end": F.col("_slot.end")}
        )
        .drop("_slot")
    )


def peak_flag(hour: Column, peak: Sequence[tuple[int, int]]) -> Column:
    hit = F.lit(False)
    for first, last in peak:
        hit = hit | hour.between(first, last)
    return F.when(hit, 1).otherwise(0)


def holiday_flag(ts: Column, holidays: Sequence[str] | None) -> Column:
    """``holidays`` holds ``MM-dd`` (every year) and ``yyyy-MM-dd`` (one day) strings."""
    if not holidays:
        return F.lit(0)
    yearly = [d for d in holidays if len(d) == 5]
    single = [d for d in holidays if len(d) != 5]
    hit = F.lit(False)
    if yearly:
        hit = hit | F.date_format(ts, "MM-dd").isin(yearly)
    if single:
        hit = hit | F.date_format(ts, "yyyy-MM-dd").isin(single)
    return F.when(hit, 1).otherwise(0)


def calendar_features(
    df: DataFrame,
    ts: str,
    peak: Sequence[tuple[int, int]] = PEAK_BATCH,
    holidays: Sequence[str] | None = None,
) -> DataFrame:
    """Add hour, weekday (Monday is 0), weekend, holiday and peak flags as integers."""
    hour, day = F.hour(ts), F.weekday(ts)
    return df.withColumns(
        {
            "hour_of_day": hour,
            "day_of_week": day,
            "is_weekend": F.when(day >= 5, 1).otherwise(0),
            "is_holiday": holiday_flag(F.col(ts), holidays),
            "peak_hour_indicator": peak_flag(hour, peak),
        }
    )


def _as_text(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_json(name)
    return F.col(name).cast("string")


def anonymize(
    df: DataFrame, cols: Sequence[str] = SENSITIVE_FIELDS, method: str = "hash", keep: int = 4
) -> DataFrame:
    """Hide columns. ``hash``: SHA-256 hex of the text; ``mask``: first ``keep`` characters, then
    stars (all stars when the text is not longer); ``remove``: drop. Nulls stay null, names that
    are not there are ignored, an unknown method changes nothing."""
    present = [c for c in cols if c in df.columns]
    if method == "remove":
        return df.drop(*present)
    if method == "hash":
        return df.withColumns({c: F.sha2(_as_text(df, c), 256) for c in present})
    if method == "mask":
        changed = {}
        for c in present:
            text = _as_text(df, c)
            size = F.length(text)
            changed[c] = F.when(size <= keep, F.repeat(F.lit("*"), size)).otherwise(
                F.concat(F.substring(text, 1, keep), F.repeat(F.lit("*"), size - keep))
            )
        return df.withColumns(changed)
    return df


def shape_output(df: DataFrame, key: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Message form of a feature row: text key, JSON value."""
    text_key = F.concat_ws("_", *[F.col(k).cast("string") for k in key])
    return df.select(text_key.alias("key"), F.to_json(F.struct(*value_cols)).alias("value"))


def threat_action(df: DataFrame, level: str, system: str) -> DataFrame:
    """Add the reaction to a threat report: contain, escalate or only log."""
    known = F.coalesce(F.col(level), F.lit("LOW"))
    return df.withColumns(
        {
            "threat_level": known,
            "affected_system": F.coalesce(F.col(system), F.lit("unknown")),
            "action": F.when(known == "CRITICAL", "CONTAIN")
            .when(known == "HIGH", "ESCALATE")
            .otherwise("LOG_ONLY"),
        }
    )
