"""Streaming queries over the events file, against the batch result of what the watermark closed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.functions.columns import grid_cell
from tidegrid.operators import demand as D
from tidegrid.operators.quality import DEMAND_CONTRACT
from tidegrid.plans import views as V
from tidegrid.plans.q_decisions import ELASTICITY_CTE
from tidegrid.plans.q_monitoring import STREAK_SQL
from tidegrid.plans.q_quality import _MESSAGES, _contract_sql, rounded
from tidegrid.plans.registry import query
from tidegrid.plans.stream_features import stream_features
from tidegrid.session import scratch_path
from tidegrid.sources import tables as S
from tidegrid.sources.streams import read_event_stream, write_event_stream
from tidegrid.streaming import stateful as J
from tidegrid.streaming import windows as K
from tidegrid.streaming.late import batches, late_rows, stream_late_rows
from tidegrid.streaming.run import run_available


_ARRIVED: dict[tuple[str, str, str], str] = {}


def event_stream(spark, sf, at_once=False):
    """The events as three arrivals, one after the other, a micro-batch each, or all at once for what reports once
    per micro-batch. Events without a time come with the last."""
    events = S.table(spark, sf, "events")
    if at_once:
        where = {"path": sf, "pathGlobFilter": "events.parquet"}
        return S.ride_events(spark, sf, read_event_stream(spark, "parquet", events.schema, where))
    return S.ride_events(spark, sf, _arrivals(spark, sf, "in order", _third_of_the_month()))


#: Files of an arrival; a micro-batch takes as many.
FILES = 4


def _arrivals(spark, sf, name, part):
    """The events as a stream, in the micro-batches 1 to 3 that ``part`` says."""
    events = S.table(spark, sf, "events")
    known = (spark.sparkContext.applicationId, sf, name)
    if known not in _ARRIVED:
        _ARRIVED[known] = path = scratch_path(spark, "arrived")
        for i in (1, 2, 3):
            events.filter(part == i).repartition(FILES).write.mode("append").parquet(path)
    return read_event_stream(spark, "parquet", events.schema, {"path": _ARRIVED[known]}, max_per_trigger=FILES)


def _third_of_the_month():
    day = F.dayofmonth("ts")
    return F.when(day <= 10, 1).when(day <= 20, 2).otherwise(3)


def _late_stream(spark, sf):
    """Each 7th event comes with the last arrival, each 11th of the others has lost its time."""
    part = F.when(F.col("event_id") % 7 == 0, F.lit(3)).otherwise(_third_of_the_month())
    raw = _arrivals(spark, sf, "late", part)
    return raw.withColumn("ts", F.when((F.col("event_id") % 7 == 0) | (F.col("event_id") % 11 != 0), F.col("ts")))


# Marks are whole milliseconds, cut off as Spark does; epoch_ms would round.
_LATE = """timed AS (SELECT event_id, user_id, event_type, "value", CASE WHEN event_id % 7 = 0 OR event_id % 11 <> 0 THEN ts END AS ts,
    CASE WHEN event_id % 7 = 0 THEN 3 WHEN day(ts) <= 10 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END AS part FROM events),
  marks AS (SELECT p.part, coalesce((SELECT max(epoch_us(t.ts) // 1000) FROM timed t WHERE t.part < p.part) - 600000, 0) AS mark_ms,
    coalesce((SELECT max(epoch_us(t.ts) // 1000) FROM timed t WHERE t.part < p.part - 1) - 600000, 0) AS before_ms
    FROM (SELECT unnest([1, 2, 3]) AS part) p)"""


def _left_out(spark, sf, width=None):
    path, given = scratch_path(spark, "late"), _late_stream(spark, sf)
    stream_late_rows(given, "ts", path, scratch_path(spark, "late-state"), width=width).awaitTermination()
    return late_rows(given, path), batches(spark, path)


@query("j1_late_rows", f"""WITH {_LATE} SELECT event_id, part - 1 AS batch_id, CASE WHEN ts IS NULL THEN 'no time' ELSE 'late' END AS reason
  FROM timed JOIN marks USING (part) WHERE ts IS NULL OR epoch_ms(time_bucket(interval 5 minute, ts) + interval 5 minute) <= before_ms""")
def _(spark, sf):
    """What the 5-minute windows of a stream with late and untimed events leave out."""
    return _left_out(spark, sf, "5 minutes")[0].select("event_id", F.col("batch_id").cast("int").alias("batch_id"), "reason")


@query("j4_late_rows", f"""WITH {_LATE} SELECT event_id, part - 1 AS batch_id, CASE WHEN ts IS NULL THEN 'no time' ELSE 'late' END AS reason
  FROM timed JOIN marks USING (part) WHERE ts IS NULL OR epoch_us(ts) // 1000 <= mark_ms""")
def _(spark, sf):
    """What a stream with state per key leaves out."""
    return _left_out(spark, sf)[0].select("event_id", F.col("batch_id").cast("int").alias("batch_id"), "reason")


@query("j4_late_counts", f"""WITH {_LATE} SELECT part - 1 AS batch_id, mark_ms, count(*) AS n_rows, count(*) FILTER (ts IS NULL) AS n_no_time,
  count(*) FILTER (epoch_us(ts) // 1000 <= mark_ms) AS n_late FROM timed JOIN marks USING (part) GROUP BY part, mark_ms""")
def _(spark, sf):
    out = _left_out(spark, sf)[1].filter("n_rows > 0")
    return out.select(F.col("batch_id").cast("int").alias("batch_id"), "mark_ms", "n_rows", "n_no_time", "n_late")


@query("j1_demand_without_late_rows", f"""WITH {_LATE} SELECT time_bucket(interval 5 minute, ts) AS feature_window_start, user_id,
    count("value") AS raw_demand_count FROM timed JOIN marks USING (part)
  WHERE epoch_ms(time_bucket(interval 5 minute, ts) + interval 5 minute) > before_ms
    AND epoch_ms(time_bucket(interval 5 minute, ts) + interval 5 minute) <= (SELECT max(epoch_us(ts) // 1000) FROM timed) - 600000 GROUP BY ALL""")
def _(spark, sf):
    """Windows over what is left: what the side table holds and what the stream used are all events."""
    out = K.stream_demand(_late_stream(spark, sf), ["user_id"], "ts", "value")
    return run_available(out, "late-demand").select("feature_window_start", "user_id", "raw_demand_count")


@query("j4_streaks_without_late_rows", f"""WITH {_LATE}, e AS (SELECT timed.* FROM timed JOIN marks USING (part)
    WHERE epoch_us(ts) // 1000 > mark_ms AND epoch_us(ts) // 1000 <= (SELECT max(epoch_us(ts) // 1000) FROM timed) - 600000),
  g AS (SELECT *, sum((event_type <> 'error')::int) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM e),
  s AS (SELECT *, count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS n FROM g)
  SELECT user_id, ts, event_id, n AS failed_attempts FROM s WHERE event_type = 'error' AND n >= 2""")
def _(spark, sf):
    """Streaks over what is left: what the side table holds and what the stream used are all events."""
    e = _late_stream(spark, sf).withColumn("ok", F.col("event_type") != "error")
    return run_available(J.stream_failed_access(e, "user_id", "ts", "ok", "event_id", limit=2), "late-streaks")


CLOSED = "(SELECT max(ts) FROM events) - interval 10 minute"
CLOSED_MS = "(SELECT epoch_ms(max(ts)) FROM events) - 600000"

_SLOTS = f"""{V.GRID}, slots AS (SELECT grid_id_latitude, grid_id_longitude, time_bucket(interval 5 minute, ts) AS feature_window_start,
    sum(demand)::bigint AS demand_current_5min, count(*)::bigint AS raw_demand_count, avg(demand) AS demand_avg
    FROM grid WHERE time_bucket(interval 5 minute, ts) + interval 5 minute <= {CLOSED} GROUP BY ALL)"""


def _demand(spark, sf, with_time=False):
    cells = grid_cell(event_stream(spark, sf), "lat", "lon")
    return K.stream_demand(cells, D.CELL, "ts", "demand", with_time=with_time)


@query("j1_stream_demand", f"""WITH {_SLOTS} SELECT * REPLACE (round(demand_avg, 6) AS demand_avg),
  feature_window_start + interval 5 minute AS feature_window_end, {V.calendar('feature_window_start')} FROM slots""")
def _(spark, sf):
    return rounded(run_available(_demand(spark, sf), "demand"), ["demand_avg"])


@query("j2_stream_lookbacks", f"""WITH {_SLOTS} SELECT {V.CELL_KEY}, feature_window_start,
  demand_current_5min::double AS demand_current_5min, {V.trailing(V.CELL_KEY, 'feature_window_start', 'demand_current_5min')} FROM slots""")
def _(spark, sf):
    return run_available(J.stream_lookbacks(_demand(spark, sf, with_time=True), D.CELL), "lookbacks")


@query("j3_stream_flash_insight", f"""WITH {V.RIDES}, placed AS (SELECT zone, ts, time_bucket(interval 600 second, ts) AS tick FROM rides),
  w AS (SELECT zone, ts, tick + interval 600 second * (1 + i) AS judged_at FROM placed, range(6) t(i)),
  c AS (SELECT zone, judged_at, count(*)::bigint AS pulse_count, min(ts) AS s FROM w GROUP BY ALL HAVING judged_at <= {CLOSED})
  SELECT zone, judged_at, pulse_count, CASE WHEN pulse_count >= 3 THEN 'CRITICAL' ELSE 'NORMAL' END AS insight_level,
    CASE WHEN pulse_count >= 3 THEN s END AS window_start FROM c""")
def _(spark, sf):
    out = K.stream_flash_insight(event_stream(spark, sf), ["zone"], "ts", seconds=3600, threshold=3, slide=600)
    return run_available(out, "insight")


@query("j4_stream_failed_access", f"""{STREAK_SQL} SELECT user_id, ts, event_id, failed_attempts FROM s
  WHERE failed_attempts >= 3 AND epoch_ms(ts) <= {CLOSED_MS}""")
def _(spark, sf):
    e = event_stream(spark, sf).withColumn("ok", F.col("event_type") != "error")
    return run_available(J.stream_failed_access(e, "user_id", "ts", "ok", "event_id"), "streaks")


@query("j5_stream_entity_state", f"""WITH last AS (SELECT user_id, event_type, arg_max(floor("value")::int, ts) AS v, max(ts) AS t
    FROM events GROUP BY ALL),
  m AS (SELECT user_id, '{{' || string_agg('"' || event_type || '": "' || v || '"', ', ' ORDER BY event_type) || '}}' AS state,
    max(t) AS last_update FROM last GROUP BY user_id)
  SELECT user_id, 'updated' AS kind, state, last_update FROM m UNION ALL
  SELECT user_id, 'expired', state, last_update FROM m WHERE epoch_ms(last_update) + 43200000 < {CLOSED_MS}""")
def _(spark, sf):
    out = J.stream_entity_state(event_stream(spark, sf, at_once=True), "user_id", "event_type", "demand", "ts", "event_id",
                                ttl_s=43_200)
    return run_available(out, "entities")


@query("j6_stream_elasticity", f"""WITH {ELASTICITY_CTE.replace("FROM r WHERE ratio <> 0", "FROM r JOIN events USING (event_id) WHERE ratio <> 0 AND epoch_ms(ts) <= " + CLOSED_MS)}
  SELECT zone, round(elasticity, 6) AS elasticity, updates FROM eta""")
def _(spark, sf):
    e = event_stream(spark, sf)
    steps = e.select(
        "event_id", "ts", "zone",
        (F.lit(1.0) + ((F.col("event_id") + 3) % 7) / F.lit(10.0)).alias("old_price"),
        (F.lit(1.0) + (F.col("event_id") % 7) / F.lit(10.0)).alias("new_price"),
        ((F.col("demand") % 41 - 20) / F.lit(100.0)).alias("demand_change"))
    out = J.stream_elasticity(steps, ["zone"], "ts", "old_price", "new_price", "demand_change", "event_id")
    ran = run_available(out, "elasticity")
    return rounded(S.latest(ran, ["zone"], "ts").select("zone", "elasticity", "updates"), ["elasticity"])


@query("j6_stream_outlier", f"""WITH {V.RIDES}, q AS (SELECT event_id, zone, ts, demand,
    count(*) OVER w AS n, quantile_cont(demand::double, 0.025) OVER w AS lo, quantile_cont(demand::double, 0.975) OVER w AS hi
    FROM rides WINDOW w AS (PARTITION BY zone ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))
  SELECT event_id, zone, ts, demand::double AS value, n = 100 AND (demand < lo OR demand > hi) AS is_outlier FROM q
  WHERE epoch_ms(ts) <= {CLOSED_MS}""")
def _(spark, sf):
    out = J.stream_outlier(event_stream(spark, sf), ["zone"], "ts", "demand", "event_id")
    return run_available(out, "outliers")


@query("j7_stream_feedback_error", """SELECT user_id, ts, 0.8::double * "value" + 5.0::double AS predicted, "value" AS actual,
  "value" - (0.8::double * "value" + 5.0::double) AS error, abs("value" - (0.8::double * "value" + 5.0::double)) AS absolute_error
  FROM events WHERE event_type <> 'error'""")
def _(spark, sf):
    pred = event_stream(spark, sf).select("user_id", "ts", (F.lit(0.8) * F.col("value") + F.lit(5.0)).alias("predicted"))
    actual = event_stream(spark, sf).filter("event_type <> 'error'").select("user_id", "ts", F.col("value").alias("actual"))
    return run_available(K.stream_feedback_error(pred, actual, ["user_id"], "ts"), "feedback")


@query("j8_stream_quarantine", f"{_MESSAGES} SELECT event_id, ({_contract_sql()}) AS is_valid FROM messages")
def _(spark, sf):
    messages = event_stream(spark, sf).selectExpr("event_id", f"{S.MESSAGE_TEXT} AS message")
    path = scratch_path(spark, "quarantine")
    K.stream_quarantine(messages, "message", DEMAND_CONTRACT, path, scratch_path(spark, "quarantine-state")).awaitTermination()
    schema = "event_id long, message string, batch_id int, is_valid boolean"
    return spark.read.schema(schema).parquet(path).select("event_id", "is_valid")


@query("stream_features", f"""WITH {_SLOTS} SELECT grid_id_latitude::varchar || '_' || grid_id_longitude::varchar AS key,
  demand_current_5min AS demand, raw_demand_count AS requests, hour(feature_window_start)::int AS hour_of_day FROM slots""")
def _(spark, sf):
    payload = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.col("lat").alias("pickup_latitude"), F.col("lon").alias("pickup_longitude"),
        F.col("demand").alias("demand_at_pickup")))
    raw = event_stream(spark, sf).select(payload.cast("binary").alias("value"))
    out = scratch_path(spark, "feature-messages")
    write_event_stream(stream_features(raw), "parquet", D.CELL, scratch_path(spark, "feature-state"),
                       trigger=None, mode="append", options={"path": out}).awaitTermination()
    kept = "demand_current_5min long, raw_demand_count long, hour_of_day int"
    rows = spark.read.schema("key string, value string").parquet(out)
    return rows.select("key", F.from_json("value", kept).alias("v")).select(
        "key", F.col("v.demand_current_5min").alias("demand"), F.col("v.raw_demand_count").alias("requests"), "v.hour_of_day")
