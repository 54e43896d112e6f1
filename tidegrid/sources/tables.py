"""Domain views over the given tables. Each is lazy and keeps scan pruning intact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.columns import calendar_features, grid_cell
from tidegrid.operators.demand import CELL, demand_per_cell
from tidegrid.operators.lookback import TARGET, next_column, trailing_columns

FEATURES = [
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_holiday",
    "peak_hour_indicator",
    "demand_last_15min",
    "demand_last_30min",
    "demand_last_60min",
    "demand_last_1440min",
]

# Message texts, in SQL that Spark and DuckDB read alike. Some are wrong on purpose: other kinds,
# values out of range, fields missing or null.
RECORD_TEXT = """'{"geohash_id":' || CASE WHEN event_id % 11 = 0 THEN 'null' ELSE '"' || geohash || '"' END
  || ',"hour_of_day":' || CASE WHEN event_id % 7 = 0 THEN '"ten"' WHEN event_id % 13 = 0 THEN '30'
       ELSE cast(hour(ts) AS string) END
  || ',"demand_current_5min":' || CASE WHEN event_id % 5 = 0 THEN cast(demand AS string)
       WHEN event_id % 17 = 0 THEN '-5.0' ELSE cast(demand AS string) || '.5' END
  || ',"is_weekend":' || CASE WHEN event_id % 19 = 0 THEN '2' WHEN event_id % 23 = 0 THEN 'true' ELSE '0' END
  || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"temperature_celsius":' || cast(event_id % 120 - 60 AS string) END
  || '}'"""

MESSAGE_TEXT = """CASE WHEN event_id % 29 = 0 THEN '{"event_timestamp":' ELSE
  '{"event_timestamp":"2024-01-01T00:00:00"'
  || ',"pickup_latitude":' || CASE WHEN event_id % 7 = 0 THEN '95.5' ELSE '35.5' END
  || ',"pickup_longitude":51.25,"dropoff_latitude":' || CASE WHEN event_id % 31 = 0 THEN '"north"' ELSE '35' END
  || ',"dropoff_longitude":51.5,"hour_of_day":' || cast(hour(ts) AS string)
  || CASE WHEN event_id % 5 = 0 THEN '.0' ELSE '' END
  || ',"day_of_week":3,"is_weekend":' || CASE WHEN event_id % 13 = 0 THEN '2' ELSE '0' END
  || ',"is_holiday":0' || CASE WHEN event_id % 11 = 0 THEN '' ELSE ',"peak_hour_indicator":1' END
  || ',"demand_at_pickup":' || CASE WHEN event_id % 17 = 0 THEN '-1' WHEN event_id % 19 = 0 THEN '2.5'
       WHEN event_id % 23 = 0 THEN 'true' ELSE cast(demand AS string) END
  || CASE WHEN event_id % 37 = 0 THEN ',"wind_speed":null' ELSE '' END || '}' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ride_events(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    """Events as ride requests: position and zone from the user, demand from the value."""
    e = table(spark, sf_dir, "events") if source is None else source
    user = F.col("user_id")
    return e.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        "props",
        (F.lit(35.5737) + F.lit(0.01) * (user % 30)).alias("lat"),
        (F.lit(51.1437) + F.lit(0.01) * (user % 50)).alias("lon"),
        (user % 40).alias("zone"),
        F.substring(F.md5(user.cast("string")), 1, 7).alias("geohash"),
        F.floor("value").cast("int").alias("demand"),
    )


def gridded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_cell(ride_events(spark, sf_dir), "lat", "lon")


def cell_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand_per_cell(gridded(spark, sf_dir), CELL, "ts", "demand")


def zone_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand_per_cell(ride_events(spark, sf_dir), ["zone"], "ts", "demand")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = calendar_features(cell_demand(spark, sf_dir), "feature_window_start")
    where = (CELL, "feature_window_start", "demand_sum")
    return d.withColumns(trailing_columns(*where) | next_column(*where))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A closed-form forecast beside the true next demand, per cell and window."""
    return features(spark, sf_dir).select(
        *CELL,
        "feature_window_start",
        "hour_of_day",
        F.col(TARGET).alias("actual"),
        (F.lit(0.8) * F.col("demand_last_15min") + F.lit(5.0)).alias("predicted"),
    )


def zone_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = (["zone"], "feature_window_start", "demand_sum")
    d = zone_demand(spark, sf_dir)
    return d.withColumns(trailing_columns(*where, [15]) | next_column(*where)).select(
        "zone",
        F.col("feature_window_start").alias("ts"),
        F.col(TARGET).alias("actual"),
        (F.lit(0.8) * F.col("demand_last_15min") + F.lit(5.0)).alias("predicted"),
    )


def feature_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ride_events(spark, sf_dir).selectExpr("event_id", f"{RECORD_TEXT} AS record")


def demand_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ride_events(spark, sf_dir).selectExpr("event_id", "ts", f"{MESSAGE_TEXT} AS message")


def gappy_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with missing quantities and prices."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_partkey") % 11 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
    )


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ride_events(spark, sf_dir).select(
        "event_id",
        "ts",
        "user_id",
        (F.col("event_type") != "error").alias("is_successful"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ride_events(spark, sf_dir).select(
        "event_id",
        "ts",
        (F.col("value") / 500.0).alias("cpu_utilization"),
        (F.col("value") * 10.0).alias("qps"),
    )


def pulses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health pulses of four components for each zone (the group watched together)."""
    return ride_events(spark, sf_dir).select(
        "event_id",
        "ts",
        "zone",
        F.concat(F.lit("component_"), (F.col("event_id") % 4).cast("string")).alias("component"),
        F.when(F.col("event_type") == "error", "DEGRADED").otherwise("HEALTHY").alias("status"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price steps: each request carries the multiplier before and after it and the relative
    change of demand that followed."""
    multiplier = F.lit(1.0) + (F.col("event_id") % 7) / F.lit(10.0)
    before = F.lit(1.0) + ((F.col("event_id") + 3) % 7) / F.lit(10.0)
    return ride_events(spark, sf_dir).select(
        "event_id",
        "ts",
        "zone",
        before.alias("old_price"),
        multiplier.alias("new_price"),
        ((F.col("demand") % 41 - 20) / F.lit(100.0)).alias("demand_change"),
    )


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        ride_events(spark, sf_dir)
        .groupBy("zone")
        .agg((F.first("zone") % 17).cast("int").alias("active_drivers"))
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings: the ``view`` events of a zone."""
    return (
        ride_events(spark, sf_dir)
        .filter(F.col("event_type") == "view")
        .select(
            "zone",
            "ts",
            (F.col("value") % 40 - 5).alias("temperature_celsius"),
            F.when(F.col("event_id") % 3 == 0, "Rain").otherwise("Clear").alias("weather_condition"),
        )
    )


def drift_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Current and baseline halves of the largest table, split by ship date."""
    li = table(spark, sf_dir, "lineitem")
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    current = li.filter(F.col("l_shipdate") >= cut)
    base = li.filter(F.col("l_shipdate") < cut)
    return current, base


def schema_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form (version, feature, property, value) of two schema versions with one feature per
    part: every tenth feature appears, every tenth goes, properties come, go and change."""
    p = table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    kinds = F.array(F.lit("string"), F.lit("integer"), F.lit("number"))
    kind = F.element_at(kinds, (size % 3 + 1).cast("int"))
    other = F.element_at(kinds, ((size + 1) % 3 + 1).cast("int"))
    required = F.when(k % 4 == 0, "true").otherwise("false")

    def version(n, keep, type_, low, low_value):
        props = F.array(
            F.struct(F.lit("type").alias("property"), type_.alias("value")),
            F.struct(F.lit("required").alias("property"), required.alias("value")),
            F.when(
                low, F.struct(F.lit("min_value").alias("property"), F.lit(low_value).alias("value"))
            ),
        )
        return p.filter(keep).select(
            F.lit(n).alias("version"),
            F.concat(F.lit("feature_"), k.cast("string")).alias("feature"),
            F.inline(F.array_compact(props)),
        )

    old = version(1, k % 10 != 0, kind, k % 5 == 0, "0")
    new = version(
        2, k % 10 != 1, F.when(k % 7 == 0, other).otherwise(kind), k % 6 == 0,
        "0",
    )
    return old.unionByName(new)


def lineage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creation (nation -> supplier), transformation (supplier -> order -> customer) and
    consumption (customer -> segment) events."""
    none = F.lit(None).cast("string")

    def ev(df, kind, **cols):
        names = ("asset_id", "source_system", "source_asset_id", "target_asset_id",
                 "consumer_id", "consumed_asset_id")
        return df.select(
            F.lit(kind).alias("event_type"), *[cols.get(n, none).alias(n) for n in names]
        )

    def node(prefix, c):
        return F.concat(F.lit(prefix + "/"), F.col(c).cast("string"))

    s = table(spark, sf_dir, "supplier")
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    created = ev(s, "creation", asset_id=node("supplier", "s_suppkey"),
                 source_system=node("nation", "s_nationkey"))
    shipped = ev(li, "transformation", source_asset_id=node("supplier", "l_suppkey"),
                 target_asset_id=node("order", "l_orderkey"))
    placed = ev(o, "transformation", source_asset_id=node("order", "o_orderkey"),
                target_asset_id=node("customer", "o_custkey"))
    used = ev(c, "consumption", consumer_id=node("segment", "c_mktsegment"),
              consumed_asset_id=node("customer", "c_custkey"))
    return created.unionByName(shipped).unionByName(placed).unionByName(used)


def threats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threat reports from events; some have no level or no target system."""
    level = (
        F.when(F.col("event_type") == "error", "CRITICAL")
        .when(F.col("event_type") == "purchase", "HIGH")
        .when(F.col("event_type") == "view", "MEDIUM")
    )
    return ride_events(spark, sf_dir).select(
        "event_id",
        "ts",
        level.alias("level"),
        F.when(F.col("zone") % 5 != 0, F.concat(F.lit("system_"), F.col("zone").cast("string")))
        .alias("target_system"),
    )


def model_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table of the answers of three models per request; one model fails now and then."""
    r = ride_events(spark, sf_dir)
    base = F.col("demand").cast("double")
    answers = F.array(
        F.struct(F.lit("boosted").alias("model"), (base * 0.9 + 3).alias("prediction")),
        F.struct(F.lit("linear").alias("model"), (base * 1.1).alias("prediction")),
        F.struct(
            F.lit("naive").alias("model"),
            F.when(F.col("event_id") % 9 != 0, base + F.col("zone") % 7).alias("prediction"),
        ),
    )
    return r.select(F.col("event_id").alias("request_id"), F.inline(answers))


def latest(df: DataFrame, key: list[str], ts: str) -> DataFrame:
    """Newest row per key, by a partial aggregate."""
    rest = [c for c in df.columns if c not in key]
    return (
        df.groupBy(*key)
        .agg(F.max_by(F.struct(*rest), F.col(ts)).alias("_last"))
        .select(*key, "_last.*")
    )
