"""Round trips through the readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.operators import demand as D
from tidegrid.operators import distribution as X
from tidegrid.operators import history as H
from tidegrid.plans import views as V
from tidegrid.plans.q_quality import DRIFT_COLS, _CDF
from tidegrid.plans.registry import query
from tidegrid.session import scratch_path
from tidegrid.sources import files as A
from tidegrid.sources import streams as R
from tidegrid.sources import tables as S
from tidegrid.streaming.run import run_available

WS = "feature_window_start"

_PAYLOAD = """CASE WHEN event_id % 50 = 0 THEN '{"event_timestamp":' ELSE '{"event_timestamp":"'
  || CASE WHEN event_id % 70 = 1 THEN 'soon' ELSE '2024-01-01T00:00:00Z' END || '","pickup_latitude":35.5,"hour_of_day":'
  || cast(hour(ts) AS string) || ',"demand_at_pickup":' || cast(demand AS string) || '}' END"""


@query("a1_read_event_stream", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    schema = S.table(spark, sf, "events").schema
    options = {"path": sf, "pathGlobFilter": "events.parquet"}
    stream = R.read_event_stream(spark, "parquet", schema, options, max_per_trigger=1)
    return run_available(stream.select("event_id", "user_id", "event_type"), "read_stream")


@query("a2_write_event_stream", """SELECT event_id::varchar AS key,
  '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def _(spark, sf):
    schema = S.table(spark, sf, "events").schema
    options = {"path": sf, "pathGlobFilter": "events.parquet"}
    stream = R.read_event_stream(spark, "parquet", schema, options)
    out = scratch_path(spark, "messages")
    q = R.write_event_stream(
        stream.select("event_id", "event_type"), "parquet", ["event_id"],
        scratch_path(spark, "messages-state"), trigger=None, mode="append", options={"path": out})
    q.awaitTermination()
    return spark.read.schema("key string, value string").parquet(out)


@query("a3_read_history", "SELECT event_id, ts, user_id FROM events")
def _(spark, sf):
    path = scratch_path(spark, "history")
    e = S.table(spark, sf, "events").select("event_id", F.col("ts").cast("string"), "user_id")
    e.write.option("header", True).csv(path)
    return A.read_history(spark, path, "event_id long, ts string, user_id long", "ts", "csv")


@query("a4_write_features", f"""WITH {V.CELLS} SELECT {V.CELL_KEY}, feature_window_start, demand_sum,
  feature_window_start::date AS feature_date FROM cells""")
def _(spark, sf):
    path = scratch_path(spark, "features")
    d = S.cell_demand(spark, sf).select(*D.CELL, WS, "demand_sum").withColumn("feature_date", F.to_date(WS))
    A.write_features(d, path)
    A.write_features(d.filter(F.dayofmonth(WS) <= 10), path)
    return spark.read.schema(d.schema).parquet(path)


@query("a5_append_log", """SELECT event_id, user_id FROM events UNION ALL
  SELECT event_id, user_id FROM events WHERE event_type = 'error'""")
def _(spark, sf):
    path = scratch_path(spark, "log")
    e = S.table(spark, sf, "events")
    A.append_log(e.select("event_id", "user_id"), path)
    A.append_log(e.filter("event_type = 'error'").select("event_id", "user_id"), path)
    return spark.read.schema("event_id long, user_id long").json(path)


@query("a6_write_report", f"""{_CDF} SELECT feature, n_current, n_baseline, round(d, 6) AS ks_statistic,
  pv < 0.05 OR area / span > 0.1 AS overall_drift_detected FROM p""")
def _(spark, sf):
    path = scratch_path(spark, "report")
    report = X.drift_report(*S.drift_pair(spark, sf), DRIFT_COLS).select(
        "feature", "n_current", "n_baseline", F.round("ks_statistic", 6).alias("ks_statistic"),
        "overall_drift_detected")
    A.write_report(report, path, "2024-01-31T00-00-00")
    return spark.read.schema(report.schema).json(path).select(*report.columns)


@query("b1_parse_events", f"""WITH {V.RIDES} SELECT
  CASE WHEN event_id % 50 <> 0 THEN CASE WHEN event_id % 70 = 1 THEN 'soon' ELSE '2024-01-01T00:00:00Z' END END AS event_timestamp,
  CASE WHEN event_id % 50 <> 0 THEN 35.5::double END AS pickup_latitude,
  CASE WHEN event_id % 50 <> 0 THEN hour(ts)::int END AS hour_of_day,
  CASE WHEN event_id % 50 <> 0 THEN demand END AS demand_at_pickup,
  CASE WHEN event_id % 50 <> 0 AND event_id % 70 <> 1 THEN timestamp '2024-01-01' END AS timestamp FROM rides""")
def _(spark, sf):
    raw = S.ride_events(spark, sf).selectExpr(f"cast({_PAYLOAD} AS binary) AS value")
    out = R.parse_events(raw, R.DEMAND_EVENT, "event_timestamp")
    return out.select("event_timestamp", "pickup_latitude", "hour_of_day", "demand_at_pickup", "timestamp")


@query("g2_upsert_table", f"""WITH {V.PREDICTIONS}, b AS (
    SELECT {V.CELL_KEY}, feature_window_start, actual, predicted, 0 AS n FROM predictions WHERE day(feature_window_start) < 20
    UNION ALL SELECT {V.CELL_KEY}, feature_window_start, actual, predicted * 2, 1 FROM predictions WHERE day(feature_window_start) >= 15)
  SELECT * EXCLUDE (n), feature_window_start::date AS day FROM b
  QUALIFY row_number() OVER (PARTITION BY {V.CELL_KEY}, feature_window_start ORDER BY n DESC) = 1""")
def _(spark, sf):
    path = scratch_path(spark, "predictions")
    p = S.predictions(spark, sf).drop("hour_of_day").withColumn("day", F.to_date(WS))
    key = [*D.CELL, WS]
    H.upsert_table(path, p.filter(F.dayofmonth(WS) < 20), key, "day")
    fresh = p.filter(F.dayofmonth(WS) >= 15).withColumn("predicted", F.col("predicted") * 2)
    H.upsert_table(path, fresh, key, "day")
    return spark.read.schema(p.schema).parquet(path)
