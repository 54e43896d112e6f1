"""SQL forms of the domain views, as chains of common table expressions."""

RIDES = """rides AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         35.5737::double + 0.01::double * (user_id % 30) AS lat,
         51.1437::double + 0.01::double * (user_id % 50) AS lon,
         user_id % 40 AS zone,
         substr(md5(user_id::varchar), 1, 7) AS geohash,
         floor(value)::int AS demand
  FROM events)"""

GRID = RIDES + """, grid AS (
  SELECT *, trunc(lat / (1.0::double / 111.0::double))::int AS grid_id_latitude,
         trunc(lon / (1.0::double / (111.0::double * cos(radians(lat)))))::int AS grid_id_longitude
  FROM rides)"""

CELLS = GRID + """, cells AS (
  SELECT grid_id_latitude, grid_id_longitude,
         time_bucket(interval 15 minute, ts) AS feature_window_start,
         time_bucket(interval 15 minute, ts) + interval 15 minute AS feature_window_end,
         count(*)::bigint AS raw_demand_count, sum(demand)::bigint AS demand_sum
  FROM grid GROUP BY ALL)"""

ZONES = RIDES + """, zones AS (
  SELECT zone, time_bucket(interval 15 minute, ts) AS feature_window_start,
         count(*)::bigint AS raw_demand_count, sum(demand)::bigint AS demand_sum
  FROM rides GROUP BY ALL)"""


def calendar(ts: str, peak: str = "(7,8,9,17,18,19,20)") -> str:
    return f"""hour({ts})::int AS hour_of_day, (isodow({ts}) - 1)::int AS day_of_week,
  (CASE WHEN isodow({ts}) >= 6 THEN 1 ELSE 0 END)::int AS is_weekend, 0::int AS is_holiday,
  (CASE WHEN hour({ts}) IN {peak} THEN 1 ELSE 0 END)::int AS peak_hour_indicator"""


def trailing(key: str, ts: str, value: str, minutes=(15, 30, 60, 1440)) -> str:
    return ", ".join(
        f"""coalesce(sum({value}) OVER (PARTITION BY {key} ORDER BY {ts} RANGE BETWEEN
        interval {m} minute PRECEDING AND interval 1 second PRECEDING), 0)::double
        AS demand_last_{m}min"""
        for m in minutes
    )


CELL_KEY = "grid_id_latitude, grid_id_longitude"

FEATURES = CELLS + f""", features AS (
  SELECT *, {calendar("feature_window_start")},
         {trailing(CELL_KEY, "feature_window_start", "demand_sum")},
         coalesce(lead(demand_sum) OVER (PARTITION BY {CELL_KEY} ORDER BY feature_window_start), 0)::double
           AS future_demand_next_15min
  FROM cells)"""

PREDICTIONS = FEATURES + f""", predictions AS (
  SELECT {CELL_KEY}, feature_window_start, hour_of_day, future_demand_next_15min AS actual,
         0.8::double * demand_last_15min + 5.0::double AS predicted
  FROM features)"""

ZONE_PREDICTIONS = ZONES + f""", zone_features AS (
  SELECT *, {trailing("zone", "feature_window_start", "demand_sum", (15,))},
         coalesce(lead(demand_sum) OVER (PARTITION BY zone ORDER BY feature_window_start), 0)::double AS actual
  FROM zones), zone_predictions AS (
  SELECT zone, feature_window_start AS ts, actual,
         0.8::double * demand_last_15min + 5.0::double AS predicted FROM zone_features)"""
