"""Stream sources and sinks. The format is a parameter: Kafka on a cluster, files elsewhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegrid.functions.columns import shape_output


def read_event_stream(
    spark: SparkSession,
    fmt: str,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of raw payloads or rows. ``max_per_trigger`` caps a micro-batch: offsets for
    Kafka, files otherwise."""
    options = dict(options or {})
    path = options.pop("path", None)
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", starting)
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    else:
        if schema is not None:
            reader = reader.schema(schema)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.load(path) if path else reader.load()


def write_event_stream(
    df: DataFrame,
    fmt: str,
    key: Sequence[str],
    checkpoint: str,
    trigger: str | None = "1 minute",
    mode: str = "update",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Send rows as (key text, JSON value). ``trigger=None`` handles what is there and stops."""
    writer = (
        shape_output(df, key, df.columns)
        .writeStream.format(fmt)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .options(**dict(options or {}))
    )
    timing = {"processingTime": trigger} if trigger else {"availableNow": True}
    return writer.trigger(**timing).start()


def parse_events(
    df: DataFrame, schema: T.StructType, ts_col: str, value: str = "value", name: str = "timestamp"
) -> DataFrame:
    """Payload bytes or text -> columns of ``schema`` plus the parsed time. A payload that is no
    JSON, or a time that is none, gives nulls."""
    text = F.from_json(F.col(value).cast("string"), schema, {"mode": "PERMISSIVE"})
    return df.select(text.alias("_data")).select("_data.*").withColumn(
        name, F.try_to_timestamp(ts_col)
    )


# Fields of a demand event message.
DEMAND_EVENT = T.StructType(
    [
        T.StructField("event_timestamp", T.StringType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("is_holiday", T.IntegerType()),
        T.StructField("peak_hour_indicator", T.IntegerType()),
        T.StructField("demand_at_pickup", T.IntegerType()),
    ]
)
