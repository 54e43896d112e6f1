"""Queries of the feature build: scalar functions, aggregation, lookbacks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions import columns as C
from tidegrid.operators import demand as D
from tidegrid.operators import lookback as L
from tidegrid.plans import views as V
from tidegrid.plans.batch_features import batch_features, run_backfill
from tidegrid.plans.registry import query
from tidegrid.session import scratch_path
from tidegrid.sources import tables as S

WS = "feature_window_start"


@query("batch_features", f"WITH {V.FEATURES} SELECT * EXCLUDE (raw_demand_count, demand_sum) "
       "FROM features WHERE future_demand_next_15min > 0")
def _(spark, sf):
    return batch_features(S.ride_events(spark, sf), "lat", "lon", "ts", "demand")


def _cumulative(m: int) -> str:
    return f"""(CASE WHEN row_number() OVER w > {m // 15} THEN coalesce(sum(demand_sum) OVER
      (PARTITION BY {V.CELL_KEY} ORDER BY feature_window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      ELSE 0 END)::double AS demand_last_{m}min"""


_CUMULATIVE = ", ".join(_cumulative(m) for m in L.LOOKBACKS)


@query("batch_features_cumulative", f"""WITH {V.CELLS}, f AS (SELECT {V.CELL_KEY}, feature_window_start, feature_window_end,
    {V.calendar(WS)}, {_CUMULATIVE}, coalesce(lead(demand_sum) OVER w, 0)::double AS future_demand_next_15min FROM cells
    WINDOW w AS (PARTITION BY {V.CELL_KEY} ORDER BY feature_window_start))
  SELECT * FROM f WHERE future_demand_next_15min > 0""")
def _(spark, sf):
    return batch_features(S.ride_events(spark, sf), "lat", "lon", "ts", "demand", lookback="cumulative")


@query("b2_grid_cell",
       f"WITH {V.GRID} SELECT event_id, grid_id_latitude, grid_id_longitude FROM grid")
def _(spark, sf):
    return S.gridded(spark, sf).select("event_id", *D.CELL)


@query("b3_time_bucket", """SELECT event_id, time_bucket(interval 5 minute, ts) AS feature_window_start,
  time_bucket(interval 5 minute, ts) + interval 5 minute AS feature_window_end FROM events""")
def _(spark, sf):
    out = C.time_bucket(S.ride_events(spark, sf), "ts", "5 minutes")
    return out.select("event_id", WS, "feature_window_end")


@query("b4_calendar_features", """SELECT o_orderkey, hour(o_orderdate)::int AS hour_of_day,
  (isodow(o_orderdate) - 1)::int AS day_of_week,
  (CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END)::int AS is_weekend,
  (CASE WHEN (month(o_orderdate) = 3 AND day(o_orderdate) BETWEEN 20 AND 24)
     OR (month(o_orderdate) = 8 AND day(o_orderdate) = 19) THEN 1 ELSE 0 END)::int AS is_holiday,
  (CASE WHEN hour(o_orderdate) BETWEEN 7 AND 9 OR hour(o_orderdate) BETWEEN 17 AND 20
     THEN 1 ELSE 0 END)::int AS peak_hour_indicator FROM orders""")
def _(spark, sf):
    out = C.calendar_features(S.table(spark, sf, "orders"), "o_orderdate", holidays=C.HOLIDAYS)
    return out.select("o_orderkey", "hour_of_day", "day_of_week", "is_weekend", "is_holiday",
                      "peak_hour_indicator")


@query("b4_calendar_online", f"""SELECT event_id, {V.calendar('ts', '(7,8,9,16,17,18)')} FROM events""")
def _(spark, sf):
    out = C.calendar_features(S.ride_events(spark, sf), "ts", peak=C.PEAK_ONLINE)
    return out.select("event_id", "hour_of_day", "day_of_week", "is_weekend", "is_holiday",
                      "peak_hour_indicator")


@query("b5_anonymize_hash", """SELECT c_custkey, sha256(c_name) AS c_name,
  sha256(c_nationkey::varchar) AS c_nationkey, c_mktsegment FROM customer""")
def _(spark, sf):
    c = S.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return C.anonymize(c, ["c_name", "c_nationkey"], "hash")


@query("b5_anonymize_mask", """SELECT c_custkey,
  CASE WHEN length(c_name) <= 4 THEN repeat('*', length(c_name))
       ELSE substr(c_name, 1, 4) || repeat('*', length(c_name) - 4) END AS c_name,
  CASE WHEN length(c_nationkey::varchar) <= 4 THEN repeat('*', length(c_nationkey::varchar))
       ELSE substr(c_nationkey::varchar, 1, 4) || repeat('*', length(c_nationkey::varchar) - 4)
  END AS c_nationkey FROM customer""")
def _(spark, sf):
    c = S.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return C.anonymize(c, ["c_name", "c_nationkey"], "mask")


@query("b5_anonymize_remove", "SELECT c_custkey, c_mktsegment FROM customer")
def _(spark, sf):
    c = S.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return C.anonymize(c, ["c_name", "phone_number"], "remove")


@query("b6_shape_output", f"""WITH {V.CELLS} SELECT
  grid_id_latitude::varchar || '_' || grid_id_longitude::varchar AS key,
  '{{"raw_demand_count":' || raw_demand_count || ',"demand_sum":' || demand_sum || '}}' AS value
  FROM cells""")
def _(spark, sf):
    return C.shape_output(S.cell_demand(spark, sf), D.CELL, ["raw_demand_count", "demand_sum"])


@query("b7_threat_action", f"""WITH {V.RIDES}, t AS (SELECT event_id,
  CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'HIGH' WHEN 'view' THEN 'MEDIUM' END AS level,
  CASE WHEN zone % 5 <> 0 THEN 'system_' || zone END AS target_system FROM rides)
  SELECT event_id, coalesce(level, 'LOW') AS threat_level,
    coalesce(target_system, 'unknown') AS affected_system,
    CASE level WHEN 'CRITICAL' THEN 'CONTAIN' WHEN 'HIGH' THEN 'ESCALATE' ELSE 'LOG_ONLY' END AS action
  FROM t""")
def _(spark, sf):
    out = C.threat_action(S.threats(spark, sf), "level", "target_system")
    return out.select("event_id", "threat_level", "affected_system", "action")


@query("c1_time_range", """SELECT event_id, ts FROM events
  WHERE ts >= timestamp '2024-01-05 06:00:00' AND ts < timestamp '2024-01-20 18:30:00'""")
def _(spark, sf):
    out = D.time_range(S.table(spark, sf, "events"), "ts", "2024-01-05 06:00:00", "2024-01-20 18:30:00")
    return out.select("event_id", F.col("ts").cast("timestamp").alias("ts"))


@query("c2_drop_unlabelled", f"""WITH {V.FEATURES} SELECT {V.CELL_KEY}, feature_window_start,
  future_demand_next_15min FROM features WHERE future_demand_next_15min > 0""")
def _(spark, sf):
    d = L.next_demand(S.cell_demand(spark, sf), D.CELL, WS, "demand_sum")
    return D.drop_unlabelled(d, L.TARGET).select(*D.CELL, WS, L.TARGET)


@query("d1_demand_per_cell", f"WITH {V.CELLS} SELECT * FROM cells")
def _(spark, sf):
    return S.cell_demand(spark, sf)


@query("d2_backfill", f"""WITH {V.RIDES}, slots AS (
  SELECT zone, time_bucket(interval 5 minute, ts) AS feature_window_start,
    sum(demand)::bigint AS demand_current_5min FROM rides GROUP BY ALL)
  SELECT * FROM (SELECT *, {V.calendar('feature_window_start', '(7,8,9,16,17,18)')},
    {V.trailing('zone', 'feature_window_start', 'demand_current_5min')} FROM slots)
  WHERE feature_window_start >= timestamp '2024-01-10' AND feature_window_start < timestamp '2024-01-24'""")
def _(spark, sf):
    return D.backfill(S.ride_events(spark, sf), "zone", "ts", "demand", "2024-01-10", "2024-01-24")


@query("d2_run_backfill", f"""WITH {V.RIDES}, slots AS (
  SELECT zone, time_bucket(interval 5 minute, ts) AS feature_window_start,
    sum(demand)::bigint AS demand_current_5min FROM rides GROUP BY ALL)
  SELECT zone, feature_window_start, demand_current_5min, demand_last_1440min FROM (SELECT *,
    {V.trailing('zone', 'feature_window_start', 'demand_current_5min')} FROM slots)
  WHERE feature_window_start >= timestamp '2024-01-10' AND feature_window_start < timestamp '2024-01-20 06:00:00'""")
def _(spark, sf):
    target = scratch_path(spark, "backfill")
    e = S.ride_events(spark, sf)
    run_backfill(e, "zone", "ts", "demand", "2024-01-10", "2024-01-15 12:00:00", target)
    run_backfill(e, "zone", "ts", "demand", "2024-01-14 06:00:00", "2024-01-20 06:00:00", target)
    schema = "zone long, feature_window_start timestamp, demand_current_5min long, demand_last_1440min double"
    return spark.read.schema(schema).parquet(target).drop("feature_date")


@query("e1_lookback_cumulative", f"""WITH {V.CELLS} SELECT {V.CELL_KEY}, feature_window_start, {_CUMULATIVE}
  FROM cells WINDOW w AS (PARTITION BY {V.CELL_KEY} ORDER BY feature_window_start)""")
def _(spark, sf):
    out = L.lookback_cumulative(S.cell_demand(spark, sf), D.CELL, WS, "demand_sum")
    return out.select(*D.CELL, WS, *[f"demand_last_{m}min" for m in L.LOOKBACKS])


@query("e2_lookback_trailing", f"""WITH {V.FEATURES} SELECT {V.CELL_KEY}, feature_window_start,
  demand_last_15min, demand_last_30min, demand_last_60min, demand_last_1440min FROM features""")
def _(spark, sf):
    out = L.lookback_trailing(S.cell_demand(spark, sf), D.CELL, WS, "demand_sum")
    return out.select(*D.CELL, WS, *[f"demand_last_{m}min" for m in L.LOOKBACKS])


@query("e3_next_demand", f"""WITH {V.FEATURES} SELECT {V.CELL_KEY}, feature_window_start,
  future_demand_next_15min FROM features""")
def _(spark, sf):
    out = L.next_demand(S.cell_demand(spark, sf), D.CELL, WS, "demand_sum")
    return out.select(*D.CELL, WS, L.TARGET)


@query("e4_same_hour_last_day", f"""WITH {V.ZONES} SELECT a.zone, a.feature_window_start,
  b.demand_sum::double AS demand_same_hour_last_day FROM zones a LEFT JOIN zones b
  ON a.zone = b.zone AND b.feature_window_start = a.feature_window_start - interval 1 day""")
def _(spark, sf):
    out = L.same_hour_last_day(S.zone_demand(spark, sf), ["zone"], WS, "demand_sum")
    return out.select("zone", WS, "demand_same_hour_last_day")


def _split_sql(order: str) -> str:
    return f"""WITH {V.CELLS}, ranked AS (SELECT *, row_number() OVER (ORDER BY {order}) AS r,
      count(*) OVER () AS n FROM cells)
      SELECT {V.CELL_KEY}, feature_window_start, r > n - ceil(0.2::double * n) AS is_test FROM ranked"""


@query("e5_split_by_time", _split_sql(f"feature_window_start, {V.CELL_KEY}"))
def _(spark, sf):
    return L.split_train_test(S.cell_demand(spark, sf), D.CELL, WS).select(*D.CELL, WS, "is_test")


@query("e5_split_by_cell", _split_sql(f"{V.CELL_KEY}, feature_window_start"))
def _(spark, sf):
    out = L.split_train_test(S.cell_demand(spark, sf), D.CELL, WS, order="cell")
    return out.select(*D.CELL, WS, "is_test")
