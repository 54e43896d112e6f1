"""Point-in-time lookups and the match of predictions to actuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidegrid.operators.chunks import CHUNK, KIND, RUNNING, add_carry, range_chunks


def feature_asof(
    requests: DataFrame,
    features: DataFrame,
    key: Sequence[str],
    ts: str,
    ts_name: str = "feature_ts",
    parts: int | None = None,
) -> DataFrame:
    """For each request the newest feature row of its key at or before its time (null columns if
    there is none).

    Both sides meet in range chunks of (key, time); the carry row of a chunk is the last feature of
    the chunks before it. One feature row per key and time is assumed; features without a time are
    never found.
    """
    rest = [c for c in features.columns if c not in (*key, ts)]
    facts = features.filter(F.col(ts).isNotNull()).select(
        *key, ts, F.struct(F.col(ts).alias(ts_name), *rest).alias("_fact"), F.lit(0).alias("_side")
    )
    both = range_chunks(
        requests.withColumn("_side", F.lit(1)).unionByName(facts, allowMissingColumns=True), [*key, ts, "_side"], parts
    )
    before = W.partitionBy(*key).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carry = (
        both.groupBy(*key, CHUNK)
        .agg(F.max_by("_fact", F.when(F.col("_side") == 0, F.col(ts))).alias("_fact"))
        .withColumn("_fact", F.last("_fact", ignorenulls=True).over(before))
    )
    order = W.partitionBy(*key, CHUNK).orderBy(KIND, ts, "_side").rowsBetween(*RUNNING)
    return (
        add_carry(both, carry)
        .withColumn("_fact", F.last("_fact", ignorenulls=True).over(order))
        .filter((F.col(KIND) == 1) & (F.col("_side") == 1))
        .select(*requests.columns, *[F.col(f"_fact.`{c}`") for c in (ts_name, *rest)])
    )


def weather_enrich(
    df: DataFrame,
    weather: DataFrame,
    key: Sequence[str],
    ts: str,
    max_age_s: int = 900,
    ts_name: str = "weather_ts",
    parts: int | None = None,
) -> DataFrame:
    """As-of lookup that accepts a reading only while it is younger than ``max_age_s``."""
    found = feature_asof(df, weather, key, ts, ts_name, parts)
    age = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col(ts_name).cast("timestamp"))
    added = [c for c in found.columns if c not in df.columns]
    return found.withColumn("_fresh", age < max_age_s * 1_000_000).select(
        *df.columns, *[F.when(F.col("_fresh"), F.col(c)).alias(c) for c in added]
    )


def prediction_feedback(
    pred: DataFrame,
    actual: DataFrame,
    key: Sequence[str],
    ts: str,
    predicted: str = "predicted",
    observed: str = "actual",
) -> DataFrame:
    """Match predictions to actuals on key and time; add the error (actual minus predicted)."""
    error = F.col(observed) - F.col(predicted)
    return pred.join(actual, [*key, ts]).withColumns(
        {"error": error, "absolute_error": F.abs(error)}
    )
