"""Queries of accuracy, health, fairness, streaks, rolling statistics and state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.operators import distribution as X
from tidegrid.operators import monitor as M
from tidegrid.operators import sequence as E
from tidegrid.plans import views as V
from tidegrid.plans.q_quality import _CDF, DRIFT_COLS, rounded
from tidegrid.plans.registry import query
from tidegrid.sources import tables as S

METRICS = """sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
  avg(abs(actual - predicted)) AS mae,
  1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) AS r2,
  count(*)::bigint AS num_predictions"""
ACC = ["rmse", "mae", "r2"]


def _metric_sql(by: str) -> str:
    keys = f"{by}, " if by else ""
    return f"""WITH {V.PREDICTIONS}, m AS (SELECT {keys}{METRICS} FROM predictions {'GROUP BY ' + by if by else ''}),
    a AS (SELECT *, list_filter([CASE WHEN rmse > 7.0 THEN printf('RMSE (%.2f) exceeded threshold (7.0).', rmse) END,
      CASE WHEN r2 < 0.7 THEN printf('R2 score (%.2f) fell below threshold (0.7).', r2) END], lambda x: x IS NOT NULL) AS alerts FROM m)
    SELECT {keys}round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2, num_predictions, alerts,
      CASE WHEN num_predictions = 0 THEN 'no_data' WHEN len(alerts) > 0 THEN 'alert' ELSE 'ok' END AS status FROM a"""


@query("d3_model_metrics", _metric_sql(""))
def _(spark, sf):
    return rounded(M.model_metrics(S.predictions(spark, sf), "actual", "predicted"), ACC)


@query("d3_model_metrics_by_cell", _metric_sql(V.CELL_KEY).replace("var_pop(actual) * count(*)", "nullif(var_pop(actual) * count(*), 0)")
       .replace("AS r2,\n", "AS r2,\n"))
def _(spark, sf):
    out = M.model_metrics(S.predictions(spark, sf), "actual", "predicted",
                          ["grid_id_latitude", "grid_id_longitude"])
    return rounded(out, ACC)


_COMPONENTS = [f"component_{i}" for i in range(5)]


@query("d7_component_health", f"""WITH {V.RIDES}, last AS (
    SELECT zone, 'component_' || (event_id % 4) AS component,
      arg_max(CASE WHEN event_type = 'error' THEN 'DEGRADED' ELSE 'HEALTHY' END, event_id) AS status
    FROM rides GROUP BY ALL),
  allc AS (SELECT zone, component, coalesce(status, 'UNKNOWN') AS status
    FROM (SELECT DISTINCT zone FROM last) CROSS JOIN (SELECT 'component_' || i AS component FROM range(5) t(i))
    LEFT JOIN last USING (zone, component)),
  agg AS (SELECT zone, count(*)::int AS total_count, (count(*) FILTER (status = 'HEALTHY'))::int AS healthy_count,
    coalesce(list_sort(list(component || '=' || status) FILTER (status <> 'HEALTHY')), []) AS details FROM allc GROUP BY zone)
  SELECT *, CASE WHEN healthy_count = total_count THEN 'PERFECT_HARMONY'
    WHEN healthy_count >= total_count * 0.7::double THEN 'MINOR_MISALIGNMENT' ELSE 'CRITICAL_DISRUPTION' END AS overall FROM agg""")
def _(spark, sf):
    out = M.component_health(S.pulses(spark, sf), _COMPONENTS, ["zone"], tie=["event_id"])
    text = F.transform(F.map_entries("details"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.withColumn("details", F.array_sort(text))


_DISPARITY = """WITH long AS (SELECT 'o_orderpriority' AS attribute, o_orderpriority AS "group", o_totalprice AS p FROM orders
    UNION ALL SELECT 'o_orderstatus', o_orderstatus, o_totalprice FROM orders),
  g AS (SELECT attribute, "group", avg(p) AS mean_prediction, count(*)::bigint AS n,
    (SELECT avg(o_totalprice) FROM orders) AS overall_mean FROM long GROUP BY ALL),
  d AS (SELECT *, greatest(0, least(0.5::double, abs(mean_prediction - overall_mean) / abs(overall_mean)))::double AS disparity FROM g)"""


@query("d8_group_disparity", f"""{_DISPARITY} SELECT attribute, "group", round(mean_prediction, 4) AS mean_prediction, n,
  round(overall_mean, 4) AS overall_mean, round(disparity, 6) AS disparity, disparity > 0.005 AS concern FROM d""")
def _(spark, sf):
    out = M.group_disparity(S.table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"],
                            "o_totalprice", threshold=0.005)
    return rounded(rounded(out, ["mean_prediction", "overall_mean"], 4), ["disparity"])


@query("d8_fairness_guidance", f"""{_DISPARITY}, a AS (SELECT attribute, max(disparity) AS score FROM d GROUP BY 1),
  s AS (SELECT greatest(0, least(1, 1 - sum(score) / (count(*) + 1e-6::double)))::double AS guidance_score,
    coalesce(list_sort(list(attribute) FILTER (score > 0.005)), []) AS ethical_concerns FROM a)
  SELECT round(guidance_score, 6) AS guidance_score, ethical_concerns,
    CASE WHEN len(ethical_concerns) = 0 THEN 'ETHICAL_ALIGNMENT' WHEN guidance_score < 0.5 THEN 'CRITICAL_ETHICAL_RISK'
      ELSE 'BIAS_DETECTED' END AS status FROM s""")
def _(spark, sf):
    d = M.group_disparity(S.table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], "o_totalprice")
    return rounded(M.fairness_guidance(d, threshold=0.005), ["guidance_score"])


@query("d9_experiment_by_arm", f"""WITH {V.PREDICTIONS}, t AS (SELECT *, 'lookback_' || (hour_of_day // 8) AS experiment,
    CASE WHEN grid_id_latitude % 2 = 0 THEN 'control' ELSE 'treatment' END AS arm FROM predictions),
  m AS (SELECT experiment, arm, {METRICS} FROM t GROUP BY ALL),
  w AS (SELECT experiment, """ + ", ".join(
    f"max({n}) FILTER (arm = '{a}') AS {a}_{n}" for a in ("control", "treatment")
    for n in ("rmse", "mae", "r2", "num_predictions")) + """ FROM m GROUP BY experiment)
  SELECT experiment, """ + ", ".join(
    f"round({a}_{n}, 6) AS {a}_{n}" for a in ("control", "treatment") for n in ACC) + ", " + ", ".join(
    f"round(treatment_{n} - control_{n}, 6) AS {n}_delta" for n in ACC) + """,
  control_num_predictions, treatment_num_predictions,
  coalesce(control_num_predictions, 0) >= 1000 AND coalesce(treatment_num_predictions, 0) >= 1000 AS enough_samples FROM w""")
def _(spark, sf):
    p = S.predictions(spark, sf).withColumns({
        "experiment": F.concat(F.lit("lookback_"), F.floor(F.col("hour_of_day") / 8).cast("string")),
        "arm": F.when(F.col("grid_id_latitude") % 2 == 0, "control").otherwise("treatment"),
    })
    out = M.experiment_by_arm(p, "experiment", "arm", "actual", "predicted")
    return rounded(out, [f"{a}_{n}" for a in ("control", "treatment") for n in ACC] + [f"{n}_delta" for n in ACC])


# --- sequences -----------------------------------------------------------------------------------

STREAK_SQL = """WITH a AS (SELECT event_id, ts, user_id, event_type <> 'error' AS is_successful FROM events),
  i AS (SELECT *, sum(is_successful::int) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM a),
  s AS (SELECT *, CASE WHEN is_successful THEN 0 ELSE sum((NOT is_successful)::int) OVER
    (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) END::bigint AS failed_attempts FROM i)"""


@query("e6_failed_access_streak", f"""{STREAK_SQL} SELECT event_id, user_id, is_successful, failed_attempts,
  failed_attempts >= 3 AS alert FROM s""")
def _(spark, sf):
    out = E.failed_access_streak(S.audit(spark, sf), "user_id", "ts", "is_successful", ["event_id"])
    return out.select("event_id", "user_id", "is_successful", "failed_attempts", "alert")


ELASTICITY_CTE = f"""{V.RIDES}, p AS (SELECT event_id, zone, 1.0::double + ((event_id + 3) % 7) / 10.0::double AS old_price,
    1.0::double + (event_id % 7) / 10.0::double AS new_price, (demand % 41 - 20) / 100.0::double AS demand_change FROM rides),
  r AS (SELECT *, (new_price - old_price) / old_price AS ratio FROM p WHERE old_price <> 0 AND new_price <> 0),
  u AS (SELECT zone, list(demand_change / ratio ORDER BY event_id) AS obs FROM r WHERE ratio <> 0 GROUP BY zone),
  eta AS (SELECT zone, list_reduce(list_prepend(-0.8::double, obs),
    lambda a, x: greatest(-2.5::double, least(-0.1::double, a * (1 - 0.01::double) + x * 0.01::double))) AS elasticity, len(obs)::bigint AS updates FROM u)"""


@query("e7_elasticity", f"WITH {ELASTICITY_CTE} SELECT zone, round(elasticity, 6) AS elasticity, updates FROM eta")
def _(spark, sf):
    out = E.elasticity(S.prices(spark, sf), ["zone"], "ts", "old_price", "new_price", "demand_change",
                       ["event_id"])
    return rounded(out, ["elasticity"])


@query("e7_elasticity_gaps", f"""WITH {ELASTICITY_CTE.replace("FROM rides)", "FROM rides WHERE event_id % 4 <> 1)")}
  SELECT zone, round(elasticity, 6) AS elasticity, updates FROM eta""")
def _(spark, sf):
    """Every fourth change is not known and counts for nothing."""
    p = S.prices(spark, sf).withColumn("demand_change", F.when(F.col("event_id") % 4 != 1, F.col("demand_change")))
    return rounded(E.elasticity(p, ["zone"], "ts", "old_price", "new_price", "demand_change", ["event_id"]), ["elasticity"])


@query("e8_flash_insight_gaps", f"""WITH {V.RIDES}, g AS (SELECT event_id, zone, CASE WHEN event_id % 5 <> 2 THEN ts END AS ts FROM rides),
  c AS (SELECT event_id, zone, ts, count(ts) OVER w AS n, min(ts) OVER w AS s
    FROM g WINDOW w AS (PARTITION BY zone ORDER BY ts RANGE BETWEEN interval 7200 second PRECEDING AND CURRENT ROW))
  SELECT event_id, zone, CASE WHEN ts IS NULL THEN 0 ELSE n END::bigint AS pulse_count,
    CASE WHEN ts IS NOT NULL AND n >= 3 THEN 'CRITICAL' ELSE 'NORMAL' END AS insight_level,
    CASE WHEN ts IS NOT NULL AND n >= 3 THEN s END AS window_start FROM c""")
def _(spark, sf):
    """Every fifth event has no time."""
    e = S.ride_events(spark, sf).withColumn("ts", F.when(F.col("event_id") % 5 != 2, F.col("ts")))
    out = E.flash_insight(e, ["zone"], "ts", 7200, 3, ["event_id"])
    return out.select("event_id", "zone", "pulse_count", "insight_level", "window_start")


@query("e8_flash_insight", f"""WITH {V.RIDES}, c AS (SELECT event_id, zone, ts, count(*) OVER w AS pulse_count, min(ts) OVER w AS s
    FROM rides WINDOW w AS (PARTITION BY zone ORDER BY ts RANGE BETWEEN interval 7200 second PRECEDING AND CURRENT ROW))
  SELECT event_id, zone, pulse_count::bigint AS pulse_count, CASE WHEN pulse_count >= 3 THEN 'CRITICAL' ELSE 'NORMAL' END AS insight_level,
    CASE WHEN pulse_count >= 3 THEN s END AS window_start FROM c""")
def _(spark, sf):
    out = E.flash_insight(S.ride_events(spark, sf), ["zone"], "ts", 7200, 3, ["event_id"])
    return out.select("event_id", "zone", "pulse_count", "insight_level", "window_start")


@query("e9_rolling_outlier", f"""WITH {V.RIDES}, q AS (SELECT event_id, zone, demand,
    count(*) OVER w AS n, quantile_cont(demand::double, 0.025) OVER w AS lo, quantile_cont(demand::double, 0.975) OVER w AS hi
    FROM rides WINDOW w AS (PARTITION BY zone ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))
  SELECT event_id, zone, round(CASE WHEN n = 100 THEN lo END, 6) AS lower_bound, round(CASE WHEN n = 100 THEN hi END, 6) AS upper_bound,
    n = 100 AND (demand < lo OR demand > hi) AS is_outlier FROM q""")
def _(spark, sf):
    out = E.rolling_outlier(S.ride_events(spark, sf), ["zone"], "ts", "demand", tie=["event_id"])
    return rounded(out.select("event_id", "zone", "lower_bound", "upper_bound", "is_outlier"),
                   ["lower_bound", "upper_bound"])


CONFIDENCE_CTE = f"""{V.ZONE_PREDICTIONS}, errs AS (SELECT zone, ts, count(actual - predicted) OVER w AS n,
    stddev_pop(actual - predicted) OVER w AS sd FROM zone_predictions
    WINDOW w AS (PARTITION BY zone ORDER BY ts ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
  scored AS (SELECT zone, ts, n, CASE WHEN n >= 5 THEN greatest(0, 1 - least(1, sd / 60.0::double - 0.5::double))::double ELSE 0.5::double END AS score,
    CASE WHEN n >= 5 THEN sd ELSE 60.0::double END AS variability FROM errs)"""
_LEVEL = """CASE WHEN n < 5 THEN 'MEDIUM' WHEN score >= 0.7 THEN 'HIGH' WHEN score < 1 - 0.7::double THEN 'LOW' ELSE 'MEDIUM' END"""


def _confidence(spark, sf):
    p = S.zone_predictions(spark, sf).withColumn("error", F.col("actual") - F.col("predicted"))
    return E.recent_error_confidence(p, ["zone"], "ts", "error", hist_std=60.0)


@query("e11_recent_error_confidence", f"""WITH {CONFIDENCE_CTE} SELECT zone, ts, round(score, 6) AS confidence_score,
  {_LEVEL} AS confidence_level, round(variability, 6) AS error_variability FROM scored""")
def _(spark, sf):
    out = _confidence(spark, sf)
    return rounded(out.select("zone", "ts", "confidence_score", "confidence_level", "error_variability"),
                   ["confidence_score", "error_variability"])


@query("e12_entity_state", """WITH last AS (SELECT user_id, event_type, arg_max("value", ts) AS v, max(ts) AS t FROM events GROUP BY ALL),
  m AS (SELECT user_id, list_sort(list(event_type || '=' || round(v, 2)::varchar)) AS state, max(t) AS last_update FROM last GROUP BY user_id)
  SELECT * FROM m WHERE last_update >= (SELECT max(ts) FROM events) - interval 86400 second""")
def _(spark, sf):
    out = E.entity_state(S.ride_events(spark, sf), "user_id", "event_type", "value", "ts", ttl_s=86_400,
                         tie=["event_id"])
    text = F.transform(F.map_entries("state"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.withColumn("state", F.array_sort(text))


_THREATS = f"""WITH {V.RIDES}, t AS (SELECT event_id, ts, zone,
  CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'HIGH' WHEN 'view' THEN 'MEDIUM' END AS level,
  CASE WHEN zone % 5 <> 0 THEN 'system_' || zone END AS target_system FROM rides)"""


@query("e13_recent_history", f"{_THREATS} SELECT event_id, ts, level, target_system FROM t ORDER BY ts DESC, event_id DESC LIMIT 10")
def _(spark, sf):
    return E.recent_history(S.threats(spark, sf), "ts", 10, tie=["event_id"])


@query("e13_recent_history_by_system", f"""{_THREATS} SELECT event_id, ts, level, target_system FROM t
  QUALIFY row_number() OVER (PARTITION BY target_system ORDER BY ts DESC, event_id DESC) <= 10""")
def _(spark, sf):
    return E.recent_history(S.threats(spark, sf), "ts", 10, ["target_system"], ["event_id"])


# --- anomaly records and retraining --------------------------------------------------------------


@query("f6_metric_rules", """SELECT event_id, ts, 'resource_cpu_spike' AS detector, 'cpu_utilization' AS metric,
    "value" / 500.0::double AS severity, "value" / 500.0::double >= 0.8 AS alert_raised FROM events WHERE "value" / 500.0::double > 0.5
  UNION ALL SELECT event_id, ts, 'traffic_spike', 'qps', "value" * 10.0::double, "value" * 10.0::double >= 0.8 FROM events
    WHERE "value" * 10.0::double > 3000""")
def _(spark, sf):
    rules = [{"detector": "resource_cpu_spike", "metric": "cpu_utilization", "above": 0.5},
             {"detector": "traffic_spike", "metric": "qps", "above": 3000.0}]
    return M.metric_rules(S.metrics(spark, sf), rules, keep=["event_id", "ts"])


@query("f6_merged_anomalies", f"""WITH {CONFIDENCE_CTE} SELECT ts, 'resource_cpu_spike' AS detector,
    'cpu_utilization' AS metric, round("value" / 500.0::double, 6) AS severity, "value" / 500.0::double >= 0.8 AS alert_raised
    FROM events WHERE "value" / 500.0::double > 0.9
  UNION ALL SELECT ts, 'model_prediction_variance', 'prediction_confidence', round(1 - score, 6), 1 - score >= 0.8
    FROM scored WHERE {_LEVEL} = 'LOW'""")
def _(spark, sf):
    both = M.merge_anomalies(
        M.metric_rules(S.metrics(spark, sf)),
        M.confidence_anomalies(_confidence(spark, sf), keep=["ts"]),
    )
    return rounded(both, ["severity"])


@query("f6_drift_anomalies", f"""{_CDF} SELECT 'demand_forecast_drift' AS detector, feature AS metric,
  round(d, 6) AS severity, d >= 0.001 AS alert_raised FROM p WHERE pv < 0.9 OR area / span > 0.1""")
def _(spark, sf):
    cur, base = S.drift_pair(spark, sf)
    report = X.drift_report(cur, base, DRIFT_COLS, alpha=0.9)
    return rounded(M.drift_anomalies(report, alert=0.001), ["severity"])


@query("f8_retrain_decision", f"""WITH {V.ZONE_PREDICTIONS}, drift AS (SELECT zone, ts::date AS day,
    abs(avg(actual) - (SELECT avg(actual) FROM zone_predictions)) / 500 AS drift_score FROM zone_predictions
    WHERE zone % 7 <> 0 GROUP BY ALL),
  perf AS (SELECT zone, ts::date AS day, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse, 60.0::double AS baseline_rmse
    FROM zone_predictions WHERE zone % 5 <> 0 GROUP BY ALL),
  j AS (SELECT coalesce(d.zone, p.zone) AS zone, coalesce(d.day, p.day) AS day, drift_score, rmse, baseline_rmse,
    (rmse - baseline_rmse) / baseline_rmse AS performance_drop
    FROM drift d FULL JOIN perf p ON d.zone = p.zone AND d.day = p.day),
  r AS (SELECT *, list_filter([CASE WHEN drift_score > 0.1 THEN 'Significant data drift detected.' END,
    CASE WHEN performance_drop > 0.05 THEN 'Model performance degradation detected.' END], lambda x: x IS NOT NULL) AS reasons FROM j)
  SELECT zone, day, round(drift_score, 6) AS drift_score, round(rmse, 6) AS rmse, baseline_rmse,
    round(performance_drop, 6) AS performance_drop, reasons, len(reasons) > 0 AS retrain FROM r""")
def _(spark, sf):
    p = S.zone_predictions(spark, sf).withColumn("day", F.to_date("ts"))
    overall = p.agg(F.avg("actual").alias("m")).scalar()
    drift = (p.filter("zone % 7 <> 0").groupBy("zone", "day").agg(F.avg("actual").alias("m"))
             .withColumn("drift_score", F.abs(F.col("m") - overall) / 500))
    perf = (p.filter("zone % 5 <> 0").groupBy("zone", "day").agg(*M.metric_columns("actual", "predicted"))
            .withColumn("baseline_rmse", F.lit(60.0)))
    return rounded(M.retrain_decision(drift, perf, ["zone", "day"]), ["drift_score", "rmse", "performance_drop"])


