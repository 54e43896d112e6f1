"""Queries of lookups, routing, decisions, history tables and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidegrid.operators import asof as A
from tidegrid.operators import decide as R
from tidegrid.operators import history as H
from tidegrid.operators import lineage as N
from tidegrid.operators import monitor as M
from tidegrid.operators import sequence as E
from tidegrid.plans import views as V
from tidegrid.plans.q_monitoring import ELASTICITY_CTE, METRICS
from tidegrid.plans.q_quality import rounded
from tidegrid.plans.registry import query
from tidegrid.plans.training import promote_stages
from tidegrid.session import scratch_path
from tidegrid.sources import tables as S

WS = "feature_window_start"


@query("f1_feature_asof", f"""WITH {V.ZONES}, req AS (SELECT event_id, zone, ts FROM rides WHERE event_type = 'purchase')
  SELECT r.event_id, r.zone, r.ts, z.feature_window_start AS feature_ts, z.demand_sum, z.raw_demand_count
  FROM req r ASOF LEFT JOIN zones z ON r.zone = z.zone AND r.ts >= z.feature_window_start""")
def _(spark, sf):
    req = S.ride_events(spark, sf).filter("event_type = 'purchase'").select("event_id", "zone", "ts")
    facts = S.zone_demand(spark, sf).select("zone", F.col(WS).alias("ts"), "demand_sum", "raw_demand_count")
    return A.feature_asof(req, facts, ["zone"], "ts")


@query("f1_feature_asof_sparse", f"""WITH {V.RIDES}, req AS (SELECT event_id, user_id, ts FROM rides WHERE event_type = 'click'),
  facts AS (SELECT user_id, ts, "value" AS last_error FROM rides WHERE event_type = 'error')
  SELECT r.event_id, r.user_id, r.ts, f.ts AS feature_ts, f.last_error
  FROM req r ASOF LEFT JOIN facts f ON r.user_id = f.user_id AND r.ts >= f.ts""")
def _(spark, sf):
    e = S.ride_events(spark, sf)
    req = e.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    facts = e.filter("event_type = 'error'").select("user_id", "ts", F.col("value").alias("last_error"))
    return A.feature_asof(req, facts, ["user_id"], "ts")


@query("f2_weather_enrich", f"""WITH {V.RIDES}, weather AS (SELECT zone, ts, "value" % 40 - 5 AS temperature_celsius,
    CASE WHEN event_id % 3 = 0 THEN 'Rain' ELSE 'Clear' END AS weather_condition FROM rides WHERE event_type = 'view'),
  j AS (SELECT r.event_id, r.zone, r.ts, w.ts AS wts, w.temperature_celsius AS t, w.weather_condition AS c
    FROM rides r ASOF LEFT JOIN weather w ON r.zone = w.zone AND r.ts >= w.ts)
  SELECT event_id, zone, CASE WHEN ts - wts < interval 900 second THEN wts END AS weather_ts,
    CASE WHEN ts - wts < interval 900 second THEN round(t, 6) END AS temperature_celsius,
    CASE WHEN ts - wts < interval 900 second THEN c END AS weather_condition FROM j""")
def _(spark, sf):
    e = S.ride_events(spark, sf).select("event_id", "zone", "ts")
    out = A.weather_enrich(e, S.weather(spark, sf), ["zone"], "ts").drop("ts")
    return rounded(out, ["temperature_celsius"])


@query("f3_prediction_feedback", f"""WITH {V.ZONE_PREDICTIONS} SELECT p.zone, p.ts, p.predicted, z.demand_sum::double AS actual,
    z.demand_sum - p.predicted AS error, abs(z.demand_sum - p.predicted) AS absolute_error
  FROM (SELECT zone, ts + interval 15 minute AS ts, predicted FROM zone_predictions) p
  JOIN zones z ON z.zone = p.zone AND z.feature_window_start = p.ts""")
def _(spark, sf):
    pred = S.zone_predictions(spark, sf).select(
        "zone", (F.col("ts") + F.expr("interval 15 minutes")).alias("ts"), "predicted")
    actual = S.zone_demand(spark, sf).select(
        "zone", F.col(WS).alias("ts"), F.col("demand_sum").cast("double").alias("actual"))
    return A.prediction_feedback(pred, actual, ["zone"], "ts")


_PREFIXES = {"0a": "north_local", "0": "north", "1f": "south_local", "f": "east", "a": "gone"}
_READY = ["north_local", "north", "south_local", "east"]


@query("f4_region_model_route", f"""WITH {V.RIDES} SELECT event_id, geohash, CASE WHEN geohash LIKE '0a%' THEN 'north_local'
  WHEN geohash LIKE '0%' THEN 'north' WHEN geohash LIKE '1f%' THEN 'south_local' WHEN geohash LIKE 'f%' THEN 'east'
  ELSE 'global' END AS model FROM rides""")
def _(spark, sf):
    e = S.ride_events(spark, sf).select("event_id", "geohash")
    return R.region_model_route(e, "geohash", _PREFIXES, "global", _READY)


@query("f4_region_route_table", f"""WITH {V.RIDES}, rules AS (SELECT substr(md5(s_suppkey::varchar), 1, (2 + s_suppkey % 3)::int) AS prefix,
    'model_' || (s_suppkey % 9) AS model, s_suppkey AS priority FROM supplier),
  hit AS (SELECT geohash, arg_min(model, priority) AS model FROM (SELECT DISTINCT geohash FROM rides)
    JOIN rules ON starts_with(geohash, prefix) GROUP BY geohash)
  SELECT event_id, geohash, coalesce(model, 'global') AS model FROM rides LEFT JOIN hit USING (geohash)""")
def _(spark, sf):
    e = S.ride_events(spark, sf).select("event_id", "geohash")
    rules = S.table(spark, sf, "supplier").selectExpr(
        "substring(md5(cast(s_suppkey AS string)), 1, cast(2 + s_suppkey % 3 AS int)) AS prefix",
        "concat('model_', s_suppkey % 9) AS model", "s_suppkey AS priority")
    return R.region_model_route(e, "geohash", rules, "global")


_FORECAST = f"""{V.ZONE_PREDICTIONS}, forecast AS (SELECT zone, avg(predicted) AS predicted_demand FROM zone_predictions GROUP BY zone),
  supply AS (SELECT DISTINCT zone, (zone % 17)::int AS active_drivers FROM rides)"""


def _forecast(spark, sf):
    return S.zone_predictions(spark, sf).groupBy("zone").agg(F.avg("predicted").alias("predicted_demand"))


@query("f5_driver_allocation", f"""WITH {_FORECAST}, g AS (SELECT zone, predicted_demand, active_drivers,
    CASE WHEN active_drivers = 0 THEN predicted_demand ELSE predicted_demand / active_drivers - 2.0 END AS gap FROM forecast JOIN supply USING (zone))
  SELECT zone, round(predicted_demand, 6) AS predicted_demand, active_drivers, round(gap, 6) AS demand_supply_gap_score,
    CASE WHEN gap > 2 THEN 'INCREASE_DRIVERS' WHEN gap < -1 THEN 'OPTIMIZE_EXISTING_DRIVERS' ELSE 'MAINTAIN_CURRENT' END AS recommendation,
    CASE WHEN gap > 2 THEN trunc(predicted_demand / 1.5::double)::int ELSE active_drivers END AS target_drivers,
    CASE WHEN gap > 2 THEN 'HIGH' WHEN gap < -1 THEN 'LOW' ELSE 'MEDIUM' END AS incentive_level FROM g""")
def _(spark, sf):
    out = R.driver_allocation(_forecast(spark, sf), S.supply(spark, sf), "zone")
    return rounded(out, ["predicted_demand", "demand_supply_gap_score"])


_F7 = f"""WITH {V.PREDICTIONS}, long AS (SELECT hour_of_day AS segment, v AS version, actual,
    predicted * (0.7::double + 0.1::double * v) AS predicted FROM predictions, range(1, 5) t(v)),
  m AS (SELECT segment, version, CASE WHEN version = 3 THEN 'Production' ELSE 'None' END AS stage, {METRICS} FROM long GROUP BY ALL),
  c AS (SELECT *, min(rmse) FILTER (stage = 'Production') OVER (PARTITION BY segment) AS production_rmse FROM m),
  d AS (SELECT *, CASE WHEN stage = 'Production' THEN 'CHAMPION' WHEN rmse < production_rmse * 0.95::double THEN 'STRONG_IMPROVEMENT'
    WHEN rmse < production_rmse * 0.99::double THEN 'SLIGHT_IMPROVEMENT' ELSE 'NO_IMPROVEMENT' END AS decision FROM c),
  w AS (SELECT *, decision LIKE '%_IMPROVEMENT' AND decision <> 'NO_IMPROVEMENT' AS promote FROM d),
  b AS (SELECT *, first_value(CASE WHEN promote THEN version END) OVER (PARTITION BY segment ORDER BY promote DESC, rmse, version) AS best FROM w)
  SELECT segment, version::int AS version, stage, round(rmse, 6) AS rmse, round(production_rmse, 6) AS production_rmse, decision, promote,
    CASE WHEN stage = 'Production' AND best IS NOT NULL THEN 'Archived' WHEN promote AND version = best THEN 'Production'
      WHEN promote THEN 'Staging' ELSE stage END AS new_stage FROM b"""


def _scored_versions(spark, sf):
    versions = F.explode(F.array(*[F.lit(v) for v in range(1, 5)])).alias("version")
    long = S.predictions(spark, sf).select(
        F.col("hour_of_day").alias("segment"), versions, "actual", "predicted",
    ).withColumn("predicted", F.col("predicted") * (F.lit(0.7) + F.lit(0.1) * F.col("version")))
    return (long.groupBy("segment", "version").agg(*M.metric_columns("actual", "predicted"))
            .withColumn("stage", F.when(F.col("version") == 3, "Production").otherwise("None"))
            .select("segment", "version", "stage", "rmse"))


@query("f7_champion_vs_candidate", _F7)
def _(spark, sf):
    return rounded(R.champion_vs_candidate(_scored_versions(spark, sf)), ["rmse", "production_rmse"])


@query("f7_promoted_stages", f"""SELECT segment, version, rmse, CASE WHEN segment < 6 THEN stage ELSE new_stage END AS stage FROM ({_F7})""")
def _(spark, sf):
    """The registry table after a promotion that had metrics of the later segments only."""
    path = scratch_path(spark, "registry")
    scored = _scored_versions(spark, sf)
    scored.write.partitionBy("segment").parquet(path)
    promote_stages(scored.filter("segment >= 6"), path)
    return rounded(spark.read.schema(scored.schema).parquet(path).select("segment", "version", "rmse", "stage"), ["rmse"])


_EDGES = """edges AS (SELECT DISTINCT 'nation/' || s_nationkey AS src, 'supplier/' || s_suppkey AS dst, 'creation' AS kind FROM supplier
  UNION ALL SELECT DISTINCT 'supplier/' || l_suppkey, 'order/' || l_orderkey, 'transformation' FROM lineitem
  UNION ALL SELECT DISTINCT 'order/' || o_orderkey, 'customer/' || o_custkey, 'transformation' FROM orders
  UNION ALL SELECT DISTINCT 'customer/' || c_custkey, 'segment/' || c_mktsegment, 'consumption' FROM customer)"""


@query("f9_lineage_edges", f"WITH {_EDGES} SELECT * FROM edges")
def _(spark, sf):
    return N.lineage_edges(S.lineage_events(spark, sf))


def _closure(start: str, a: str, b: str) -> str:
    return f"""WITH RECURSIVE {_EDGES}, walk AS (SELECT '{start}' AS node, 0 AS depth
      UNION SELECT e.{b}, w.depth + 1 FROM walk w JOIN edges e ON e.{a} = w.node)
      SELECT node, min(depth)::int AS depth FROM walk WHERE depth > 0 GROUP BY node"""


@query("f9_lineage_downstream", _closure("supplier/1", "src", "dst"))
def _(spark, sf):
    return N.lineage_impact(N.lineage_edges(S.lineage_events(spark, sf)), "supplier/1")


@query("f9_lineage_deep", """WITH o AS (SELECT o_orderkey, o_custkey, row_number() OVER w AS rn, count(*) OVER (PARTITION BY o_custkey) AS n
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
  most AS (SELECT o_custkey FROM o ORDER BY n DESC, o_custkey LIMIT 1)
  SELECT 'order/' || o_orderkey AS node, (rn - 1)::int AS depth FROM o JOIN most USING (o_custkey) WHERE rn > 1""")
def _(spark, sf):
    """Each order follows the one before of its customer; what follows the first order of the customer with the most."""
    orders = S.table(spark, sf, "orders")
    order = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    name = lambda c: F.concat(F.lit("order/"), F.col(c).cast("string"))
    edges = orders.withColumn("next", F.lead("o_orderkey").over(order)).filter("next IS NOT NULL").select(
        name("o_orderkey").alias("src"), name("next").alias("dst")
    )
    most = orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first")
    ).orderBy(F.desc("n"), "o_custkey").first()
    return N.lineage_impact(edges, f"order/{most['first']}" if most else "")


@query("f9_lineage_upstream", _closure("customer/1", "dst", "src"))
def _(spark, sf):
    return N.lineage_impact(N.lineage_edges(S.lineage_events(spark, sf)), "customer/1", "upstream")


_CHAIN = """edges AS (SELECT DISTINCT 'day/' || strftime(ts, '%Y-%m-%d') AS src, 'day/' || strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') AS dst FROM events
  UNION ALL SELECT DISTINCT 'day/2024-01-01', 'user/' || user_id FROM events)"""


@query("f9_lineage_long_chain", f"""WITH RECURSIVE {_CHAIN}, walk AS (SELECT 'day/2024-01-01' AS node, 0 AS depth
  UNION SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.node)
  SELECT node, min(depth)::int AS depth FROM walk WHERE depth > 0 GROUP BY node""")
def _(spark, sf):
    """Each day's events feed the next day's: about thirty steps, and a wide first day."""
    e = S.table(spark, sf, "events")
    day = F.to_date("ts")
    name = lambda d: F.concat(F.lit("day/"), d.cast("string"))
    edges = e.select(name(day).alias("src"), name(F.date_add(day, 1)).alias("dst")).union(
        e.select(F.lit("day/2024-01-01"), F.concat(F.lit("user/"), F.col("user_id").cast("string")))
    ).distinct()
    return N.lineage_impact(edges, "day/2024-01-01")


# --- history tables ------------------------------------------------------------------------------


def _batches(spark, sf):
    p = S.predictions(spark, sf).drop("hour_of_day")
    old = p.filter(F.hour(WS) < 16)
    new = p.filter(F.hour(WS) >= 8).withColumn("predicted", F.col("predicted") * 2)
    return old, new


_BATCHES = f"""{V.PREDICTIONS}, old AS (SELECT * EXCLUDE (hour_of_day) FROM predictions WHERE hour(feature_window_start) < 16),
  fresh AS (SELECT * EXCLUDE (hour_of_day) REPLACE (predicted * 2 AS predicted) FROM predictions WHERE hour(feature_window_start) >= 8)"""


@query("g1_append_history", f"WITH {_BATCHES} SELECT * FROM old UNION ALL SELECT * FROM fresh")
def _(spark, sf):
    return H.append_history(*_batches(spark, sf))


@query("g2_upsert_keep_last", f"""WITH {_BATCHES}, b AS (SELECT *, 0 AS n FROM old UNION ALL SELECT *, 1 FROM fresh)
  SELECT * EXCLUDE (n) FROM b QUALIFY row_number() OVER (PARTITION BY {V.CELL_KEY}, feature_window_start ORDER BY n DESC) = 1""")
def _(spark, sf):
    return H.upsert_keep_last(*_batches(spark, sf), ["grid_id_latitude", "grid_id_longitude", WS])


@query("g3_sort_features", f"WITH {V.CELLS} SELECT {V.CELL_KEY}, feature_window_start, demand_sum FROM cells ORDER BY ALL")
def _(spark, sf):
    d = S.cell_demand(spark, sf).select("grid_id_latitude", "grid_id_longitude", WS, "demand_sum")
    return H.sort_features(d, ["grid_id_latitude", "grid_id_longitude"], WS)


@query("g4_sample", """SELECT event_id, user_id, "value" FROM events ORDER BY md5(event_id::varchar || '|42') LIMIT 500""")
def _(spark, sf):
    return H.sample(S.table(spark, sf, "events").select("event_id", "user_id", "value"), ["event_id"], 500)


# --- row decisions -------------------------------------------------------------------------------


@query("h1_revenue_projection", f"""WITH {_FORECAST}, b AS (SELECT zone, predicted_demand * 4.0::double AS scaled, active_drivers,
    1.0::double + (zone % 5) / 10.0::double AS pricing_multiplier FROM forecast JOIN supply USING (zone)),
  d AS (SELECT *, least(scaled, active_drivers * 3.0::double) AS done FROM b)
  SELECT zone, round(scaled, 6) AS predicted_demand_scaled, active_drivers, pricing_multiplier, round(done, 6) AS estimated_completed_rides,
    round(done * 5.0::double * pricing_multiplier, 6) AS projected_revenue,
    CASE WHEN (CASE WHEN scaled > 0 THEN done / scaled ELSE 1 END) < 0.7 THEN 'DEMAND_SURPLUS_UNDER_STAFFED' ELSE 'OPTIMAL_BALANCE' END AS operational_insight FROM d""")
def _(spark, sf):
    j = _forecast(spark, sf).join(S.supply(spark, sf), "zone").withColumn(
        "pricing_multiplier", F.lit(1.0) + (F.col("zone") % 5) / F.lit(10.0))
    out = R.revenue_projection(j).drop("predicted_demand")
    return rounded(out, ["predicted_demand_scaled", "estimated_completed_rides", "projected_revenue"])


@query("h2_demand_impact", f"""WITH {ELASTICITY_CTE} SELECT event_id, zone, round(coalesce(elasticity, -0.8::double), 6) AS elasticity,
  round(demand * (1 + coalesce(elasticity, -0.8::double) * 0.1::double), 6) AS expected_demand
  FROM rides LEFT JOIN (SELECT * FROM eta WHERE zone % 3 <> 0) USING (zone)""")
def _(spark, sf):
    eta = E.elasticity(S.prices(spark, sf), ["zone"], "ts", "old_price", "new_price", "demand_change", ["event_id"])
    e = S.ride_events(spark, sf).select("event_id", "zone", "demand").withColumn("price_change", F.lit(0.1))
    out = R.demand_impact(e, eta.filter("zone % 3 <> 0"), ["zone"], "demand", "price_change")
    return rounded(out.select("event_id", "zone", "elasticity", "expected_demand"), ["elasticity", "expected_demand"])


_OUTPUTS = f"""{V.RIDES}, outputs AS (SELECT event_id AS request_id, 'boosted' AS model, demand * 0.9::double + 3 AS prediction FROM rides
  UNION ALL SELECT event_id, 'linear', demand * 1.1::double FROM rides
  UNION ALL SELECT event_id, 'naive', CASE WHEN event_id % 9 <> 0 THEN demand + (zone % 7)::double END FROM rides)"""


@query("h3_ensemble_confidence", f"""WITH {_OUTPUTS}, q AS (SELECT request_id, count(prediction)::bigint AS n_models,
    quantile_cont(prediction, 0.75) - quantile_cont(prediction, 0.25) AS iqr FROM outputs GROUP BY 1),
  s AS (SELECT *, greatest(0, 1 - least(1, iqr / (2 * 7.3::double)))::double AS score FROM q)
  SELECT request_id, n_models, round(score, 6) AS confidence_score, round(iqr, 6) AS prediction_spread,
    CASE WHEN score >= 0.7 THEN 'HIGH' WHEN score < 1 - 0.7::double THEN 'LOW' ELSE 'MEDIUM' END AS confidence_level FROM s""")
def _(spark, sf):
    out = R.ensemble_confidence(S.model_outputs(spark, sf), "request_id", hist_std=7.3)
    return rounded(out, ["confidence_score", "prediction_spread"])


@query("h4_ensemble_average", f"""WITH {_OUTPUTS} SELECT request_id, round(sum(w * coalesce(prediction, 0)) / sum(w), 6) AS ensemble_prediction
  FROM outputs JOIN (VALUES ('boosted', 2.0::double), ('linear', 1.0::double), ('naive', 1.0::double)) t(model, w) USING (model) GROUP BY 1""")
def _(spark, sf):
    w = {"boosted": 2.0, "linear": 1.0, "naive": 1.0}
    return rounded(R.ensemble_average(S.model_outputs(spark, sf), "request_id", w), ["ensemble_prediction"])


@query("h4_ensemble_renormalised", f"""WITH {_OUTPUTS} SELECT request_id, round(avg(prediction), 6) AS ensemble_prediction FROM outputs GROUP BY 1""")
def _(spark, sf):
    out = R.ensemble_average(S.model_outputs(spark, sf), "request_id", on_missing="renormalise")
    return rounded(out, ["ensemble_prediction"])


@query("i7_ab_route", """SELECT user_id, event_id, CASE WHEN ('0x' || substr(md5(event_id::varchar), 1, 8))::bigint < 429496730
  THEN 'Staging' ELSE 'Production' END AS model_version FROM events""")
def _(spark, sf):
    return R.ab_route(S.table(spark, sf, "events").select("user_id", "event_id"), "event_id")


@query("i7_traffic_split", """WITH s AS (SELECT event_id, ('0x' || substr(md5(event_id::varchar), 1, 8))::bigint AS slot FROM events)
  SELECT event_id, CASE WHEN slot < 1073741824 THEN 'v2' WHEN slot < 1717986918 THEN 'v3' ELSE 'v1' END AS model_version FROM s""")
def _(spark, sf):
    e = S.table(spark, sf, "events").select("event_id")
    return R.ab_route(e, "event_id", {"v2": 0.25, "v3": 0.15}, "v1")


@query("i7_tiny_share", """WITH s AS (SELECT l_orderkey, l_linenumber, l_orderkey || '/' || l_linenumber AS k FROM lineitem)
  SELECT l_orderkey, l_linenumber, CASE WHEN ('0x' || substr(md5(k), 1, 8))::bigint < 171799 THEN 'tiny'
    WHEN ('0x' || substr(md5(k), 1, 8))::bigint < 4466766 THEN 'small' ELSE 'Production' END AS model_version FROM s""")
def _(spark, sf):
    k = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    li = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", k.alias("k"))
    return R.ab_route(li, "k", {"tiny": 0.00004, "small": 0.001}).drop("k")
