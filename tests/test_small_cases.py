"""Hand-computed cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import columns as C
from tidegrid.operators import decide as R
from tidegrid.operators import distribution as X
from tidegrid.operators import history as H
from tidegrid.operators import lineage as N
from tidegrid.operators import lookback as L
from tidegrid.operators import monitor as M
from tidegrid.operators import quality as Q
from tidegrid.operators import sequence as E


def at(minute, second=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute, seconds=second)


def test_cumulative_lookback(spark):
    df = spark.createDataFrame([("a", at(15 * i), i + 1) for i in range(5)], "k string, ts timestamp, v int")
    out = L.lookback_cumulative(df, ["k"], "ts", "v", (15, 30, 60, 1440)).orderBy("ts").collect()
    assert [r.demand_last_15min for r in out] == [0, 1, 3, 6, 10]
    assert [r.demand_last_30min for r in out] == [0, 0, 3, 6, 10]
    assert [r.demand_last_60min for r in out] == [0, 0, 0, 0, 10]
    assert [r.demand_last_1440min for r in out] == [0] * 5


def test_trailing_lookback_sees_gaps(spark):
    df = spark.createDataFrame([("a", at(0), 1), ("a", at(15), 2), ("a", at(60), 4)], "k string, ts timestamp, v int")
    out = L.lookback_trailing(df, ["k"], "ts", "v", (15, 60)).orderBy("ts").collect()
    assert [r.demand_last_15min for r in out] == [0, 1, 0]
    assert [r.demand_last_60min for r in out] == [0, 1, 3]


def test_split_cuts_exactly(spark):
    df = spark.createDataFrame([("a", at(i)) for i in range(11)], "k string, ts timestamp")
    out = L.split_train_test(df, ["k"], "ts", 0.2).orderBy("ts").collect()
    assert [r.is_test for r in out] == [False] * 8 + [True] * 3


def test_cleanse_demo(spark):
    vals = [10, 12, None, 15, 100, 13, 11, 14, 16, 5]
    df = spark.createDataFrame([(i, float(v) if v is not None else None) for i, v in enumerate(vals)], "i int, v double")
    stats = Q.fit_imputer(df, ["v"], "mean")
    assert stats.first().v == pytest.approx(196 / 9)
    q = {r.prob: r.value for r in X.exact_quantiles(Q.impute(df, stats), ["v"], [0.25, 0.75]).collect()}
    assert q == {0.25: pytest.approx(11.25), 0.75: pytest.approx(15.75)}
    out = [r.v for r in Q.cleanse(df, ["v"], "mean", 1.5).orderBy("i").collect()]
    assert out[4] is None and sum(v is None for v in out) == 1 and out[2] == pytest.approx(196 / 9)


def test_imputer_other_strategies(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (3.0,), (3.0,), (float("nan"),), (9.0,)], "v double")
    assert Q.fit_imputer(df, ["v"], "median").first().v == 3.0
    assert Q.fit_imputer(df, ["v"], "zero").first().v == 0.0
    assert Q.fit_imputer(df, ["v"], "mode").first().v == 1.0
    approx = Q.null_outliers_iqr(df, ["v"], 1.5, exact=False)
    assert approx.count() == 6


RECORDS = [
    ('{"geohash_id":"dr5ru","hour_of_day":10,"demand_current_5min":25.5,"is_weekend":0,"temperature_celsius":25}', []),
    ('{"geohash_id":"dr5ru","hour_of_day":30,"demand_current_5min":-5.0,"is_weekend":2}', [
        "Value for 'hour_of_day' (30) is above max_value (23)",
        "Value for 'demand_current_5min' (-5.0) is below min_value (0.0)",
        "Value for 'is_weekend' (2) is not in allowed_values: [0, 1]"]),
    ('{"hour_of_day":10,"demand_current_5min":25.5}', ["Missing required feature: 'geohash_id'"]),
    ('{"geohash_id":null,"hour_of_day":10,"demand_current_5min":25.5}', ["Missing required feature: 'geohash_id'"]),
    ('{"geohash_id":"dr5ru","hour_of_day":"ten","demand_current_5min":25.5}', [
        "Invalid type for 'hour_of_day': Expected int, got str"]),
    ('{"geohash_id":"dr5ru","hour_of_day":"10","demand_current_5min":25}', [
        "Invalid type for 'hour_of_day': Expected int, got str",
        "Invalid type for 'demand_current_5min': Expected float, got int"]),
    ('{"geohash_id":[1],"hour_of_day":5.0,"demand_current_5min":1e3,"is_weekend":true,"temperature_celsius":"x"}', [
        "Invalid type for 'geohash_id': Expected str, got list",
        "Invalid type for 'hour_of_day': Expected int, got float",
        "Invalid type for 'temperature_celsius': Expected one of (int, float), got str"]),
    ('{"geohash_id":"[x","hour_of_day":1,"demand_current_5min":1.5}', []),
    ('{"geohash_id":"true","hour_of_day":1,"demand_current_5min":1.5}', []),
]


def test_rules_on_records(spark):
    df = spark.createDataFrame([(i, j) for i, (j, _) in enumerate(RECORDS)], "i int, j string")
    out = Q.validate_rules(df, Q.FEATURE_RULES, "j").orderBy("i").collect()
    for row, (_, expected) in zip(out, RECORDS):
        assert row.errors == expected
    counts = Q.rule_violations(df, Q.FEATURE_RULES, "j").agg(F.sum("violation_count")).first()[0]
    assert counts == sum(len(e) for _, e in RECORDS)
    strict = Q.find_violations(df, Q.FEATURE_RULES, "j", bool_is_int=False).orderBy("i").collect()
    assert "is_weekend" in [v.feature for v in strict[6].violations]
    assert Q.validate_rules(df, Q.FEATURE_RULES, "j").filter(F.size("errors") > 0).count() == 6


def _message(**changes):
    m = {"event_timestamp": '"2024-01-01T00:00:00"', "pickup_latitude": "35.5", "pickup_longitude": "51", "dropoff_latitude": "35",
         "dropoff_longitude": "51.5", "hour_of_day": "3", "day_of_week": "1", "is_weekend": "0", "is_holiday": "0",
         "peak_hour_indicator": "1", "demand_at_pickup": "4"} | changes
    return "{" + ",".join(f'"{k}":{v}' for k, v in m.items() if v is not None) + "}"


@pytest.mark.parametrize("text,valid", [
    (_message(), True), (_message(extra="[1]"), True), (_message(hour_of_day="3.0"), True), (_message(month="null"), False),
    (_message(hour_of_day="true"), False), (_message(event_timestamp="5"), False), (_message(pickup_latitude=None), False),
    (_message(pickup_latitude="91"), False), (_message(is_weekend="2"), False), (_message(hour_of_day="3.5"), False),
    (_message()[:-1], False), ("[" + _message() + "]", False), ("", False), (None, False), (_message(event_timestamp='"NaN"'), True),
    (_message(pickup_latitude='"35.5"'), False), (_message(pickup_latitude='"NaN"'), False),
])
def test_contract(spark, text, valid):
    df = spark.createDataFrame([(text,)], "m string")
    assert Q.check_contract(df, "m", Q.DEMAND_CONTRACT).first().is_valid is valid
    ok, bad = Q.quarantine(df, "m", Q.DEMAND_CONTRACT)
    assert (ok.count(), bad.count()) == ((1, 0) if valid else (0, 1))


def test_no_contract_means_invalid(spark):
    assert not Q.check_contract(spark.createDataFrame([("{}",)], "m string"), "m", {}).first().is_valid


BASE = {"geohash_id": {"type": "string", "required": "true"}, "hour_of_day": {"type": "integer", "required": "true", "max_value": "23"},
        "is_weekend": {"type": "integer"}}


def _registry(spark, *versions):
    rows = [(i + 1, f, p, v) for i, s in enumerate(versions) for f, d in s.items() for p, v in d.items()]
    return spark.createDataFrame(rows, "version int, feature string, property string, value string")


def test_schema_versions(spark):
    wider = BASE | {"rain": {"type": "number"}, "hour_of_day": BASE["hour_of_day"] | {"unit": "hours"}}
    fewer = {k: v for k, v in BASE.items() if k != "geohash_id"}
    other = BASE | {"hour_of_day": {"type": "string", "required": "true"}}
    reg = _registry(spark, BASE, wider, fewer, other)
    diff = Q.schema_diff(reg, 1, 2)
    rows = {(r.feature, r.change, r.property): (r.old_value, r.new_value) for r in diff.collect()}
    assert rows == {("rain", "added", "type"): (None, "number"), ("hour_of_day", "modified", "unit"): ("added", "hours")}
    assert Q.schema_compat(diff).first().is_compatible
    gone = Q.breaking_changes(Q.schema_diff(reg, 1, 3)).collect()
    assert [r.message for r in gone] == ["Removed required feature: 'geohash_id'"]
    retyped = Q.breaking_changes(Q.schema_diff(reg, 1, 4)).collect()
    assert [r.message for r in retyped] == [
        "Type changed for required/critical feature 'hour_of_day': from integer to string"]
    assert {r.to_version for r in Q.schema_history(reg).select("to_version").distinct().collect()} == {2, 3, 4}


def test_elasticity_step(spark):
    df = spark.createDataFrame([("z", at(0), 1.0, 1.2, -0.15), ("z", at(1), 1.0, 1.0, 5.0), ("z", at(2), 0.0, 1.0, 5.0)],
                               "z string, ts timestamp, a double, b double, c double")
    row = E.elasticity(df, ["z"], "ts", "a", "b", "c", seed=-0.7, lr=0.1).first()
    assert row.elasticity == pytest.approx(-0.705) and row.updates == 1


def test_ensemble(spark):
    p = spark.createDataFrame([(1, float(v)) for v in (40, 65, 50, 55, 48)] + [(2, 3.0)], "r int, prediction double")
    out = {r.r: r for r in R.ensemble_confidence(p, "r", hist_std=7.0, level=0.8).collect()}
    assert (out[1].prediction_spread, out[1].confidence_score, out[1].confidence_level) == (7.0, 0.5, "MEDIUM")
    assert (out[2].confidence_score, out[2].confidence_level) == (0.5, "MEDIUM")
    q = spark.createDataFrame([(1, "a", 10.0), (1, "b", None), (1, "c", 20.0)], "r int, model string, prediction double")
    assert R.ensemble_average(q, "r").first()[1] == 10.0
    assert R.ensemble_average(q, "r", on_missing="renormalise").first()[1] == 15.0


def test_component_health(spark):
    df = spark.createDataFrame([("a", "HEALTHY", at(0)), ("b", "HEALTHY", at(0)), ("c", "HEALTHY", at(1)), ("c", "DEGRADED", at(0))],
                               "component string, status string, ts timestamp")
    row = M.component_health(df, ["a", "b", "c", "d"]).first()
    assert (row.overall, row.details, row.healthy_count) == ("MINOR_MISALIGNMENT", {"d": "UNKNOWN"}, 3)
    empty = M.component_health(df.limit(0), ["a"]).first()
    assert empty.overall == "CRITICAL_DISRUPTION"


def test_routes(spark):
    df = spark.createDataFrame([("dr5ru7z",), ("dr5rgaf",), ("dr5ryab",), (None,)], "z string")
    rules = {"dr5ru": "north", "dr5ry": "south"}
    expected = {"dr5ru7z": "north", "dr5rgaf": "global", "dr5ryab": "south", None: "global"}
    table = spark.createDataFrame([(p, m, i) for i, (p, m) in enumerate(rules.items())], "prefix string, model string, priority int")
    for r in (rules, table):
        assert {x.z: x.model for x in R.region_model_route(df, "z", r, "global").collect()} == expected
        assert {x.model for x in R.region_model_route(df, "z", r, "global", ["south"]).collect()} == {"global", "south"}


def test_operating_decisions(spark):
    f = spark.createDataFrame([("z", 100.0), ("q", 5.0)], "zone string, predicted_demand double")
    s = spark.createDataFrame([("z", 10)], "zone string, active_drivers int")
    out = {r.zone: r for r in R.driver_allocation(f, s, "zone").collect()}
    assert (out["z"].demand_supply_gap_score, out["z"].recommendation, out["z"].target_drivers) == (8.0, "INCREASE_DRIVERS", 66)
    assert (out["q"].active_drivers, out["q"].demand_supply_gap_score) == (0, 5.0)
    j = f.join(s, "zone").withColumn("pricing_multiplier", F.lit(1.0))
    r = R.revenue_projection(j).first()
    assert (r.predicted_demand_scaled, r.estimated_completed_rides, r.projected_revenue) == (400.0, 30.0, 150.0)
    assert r.operational_insight == "DEMAND_SURPLUS_UNDER_STAFFED"


def test_masking(spark):
    df = spark.createDataFrame([("user_abcde", "abcd", None, 7)], "user_id string, device_id string, ip_address string, n int")
    row = C.anonymize(df, method="mask").first()
    assert (row.user_id, row.device_id, row.ip_address, row.n) == ("user******", "****", None, 7)
    assert C.anonymize(df, method="remove").columns == ["n"]
    assert C.anonymize(df, method="other").first() == df.first()


def test_metrics_edge_cases(spark):
    empty = spark.createDataFrame([], "a double, p double")
    assert M.model_metrics(empty, "a", "p").first().status == "no_data"
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "a double, p double")
    assert M.model_metrics(flat, "a", "p").first().r2 == 1.0


def test_drift_edge_cases(spark):
    a = spark.createDataFrame([(1.0, None), (1.0, None)], "x double, y double")
    b = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    out = X.drift_report(a, b, ["x", "y", "z"]).collect()
    assert [(r.feature, r.ks_statistic, r.ks_pvalue, r.normalized_wasserstein_distance) for r in out] == [("x", 0.0, 1.0, 0.0)]
    assert not out[0].any_drift_detected


def test_upsert_and_sample(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, H.upsert_keep_last(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    df = spark.range(100)
    one = {r.id for r in H.sample(df, ["id"], 10, 1).collect()}
    assert len(one) == 10 and one == {r.id for r in H.sample(df.repartition(7), ["id"], 10, 1).collect()}


def test_lineage_ends_on_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("x", "a")], "src string, dst string")
    assert {(r.node, r.depth) for r in N.lineage_impact(e, "a").collect()} == {("b", 1), ("c", 1)}
    assert {(r.node, r.depth) for r in N.lineage_impact(e, "b", "upstream").collect()} == {("a", 1), ("x", 2), ("c", 2)}


def test_retrain_uses_what_is_known(spark):
    d = spark.createDataFrame([("a", 0.2), ("b", 0.05)], "g string, drift_score double")
    p = spark.createDataFrame([("b", 16.0, 15.0), ("c", 15.1, 15.0)], "g string, rmse double, baseline_rmse double")
    out = {r.g: r.reasons for r in M.retrain_decision(d, p, ["g"]).collect()}
    assert out["a"] == ["Significant data drift detected."] and out["c"] == []
    assert out["b"] == ["Model performance degradation detected."]


def test_shared_folder_falls_back_only_locally(spark, monkeypatch):
    from tidegrid import session

    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master, applicationId = "local[2]", "app-1"

    class Fake:
        conf, sparkContext = Conf(), Context()

    assert session.shared_root(Fake()) == session.shared_root(Fake())
    Context.master = "yarn"
    with pytest.raises(ValueError):
        session.shared_root(Fake())
    assert session.shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_table_target_keeps_other_dates(spark):
    from tidegrid.sources.files import write_features

    rows = [(1, "2024-01-01"), (2, "2024-01-02")]
    spark.sql("DROP TABLE IF EXISTS features_by_date")
    try:
        df = spark.createDataFrame(rows, "v int, d string").selectExpr("v", "to_date(d) AS feature_date")
        write_features(df, "features_by_date")
        # Columns come in another order; only the second date is written again.
        write_features(df.filter("v = 2").selectExpr("feature_date", "v + 10 AS v"), "features_by_date")
        got = spark.table("features_by_date").collect()
        assert sorted((str(r.feature_date), r.v) for r in got) == [("2024-01-01", 1), ("2024-01-02", 12)]
    finally:
        spark.sql("DROP TABLE IF EXISTS features_by_date")
