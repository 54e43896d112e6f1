"""Drift from sketches against exact distributions."""

import numpy as np
import pytest

from tidegrid.operators import distribution as X
from tidegrid.operators import sketches as Y


@pytest.fixture(scope="module")
def pair(spark):
    rng = np.random.default_rng(3)
    rows = []
    for day in range(1, 41):
        for i in range(400):
            late = day > 20
            flat = float(rng.integers(0, 4) + (rng.random() < 0.3 if late else 0))
            rows.append((f"2024-01-{day:02}" if day < 32 else f"2024-02-{day - 31:02}", float(rng.normal(0.4 * late, 1)), None if i % 9 == 0 else flat, float("nan") if i % 7 == 0 else 5.0))
    df = spark.createDataFrame(rows, "d string, a double, b double, c double").selectExpr("CAST(d AS timestamp) AS ts", "a", "b", "c", "CAST(NULL AS double) AS e")
    return df.filter("ts > '2024-01-20 12:00'"), df.filter("ts < '2024-01-20 12:00'"), df


def test_report_is_within_its_error(spark, pair, tmp_path):
    cur, base, df = pair
    path = f"file://{tmp_path}/s"
    Y.write_sketches(df, ["a", "b", "c", "e"], "ts", path)
    got = {r.feature: r for r in Y.sketched_drift(Y.read_sketches(spark, path, "2024-01-21", "2024-12-31"), Y.read_sketches(spark, path, "2024-01-01", "2024-01-20")).collect()}
    want = {r.feature: r for r in X.drift_report(cur, base, ["a", "b", "c", "e"]).collect()}
    assert got.keys() == want.keys() == {"a", "b", "c"}
    for f, r in got.items():
        assert (r.n_current, r.n_baseline) == (want[f].n_current, want[f].n_baseline)
        assert r.ks_error < 0.01 and r.ks_statistic == pytest.approx(want[f].ks_statistic, abs=r.ks_error)
        assert r.normalized_wasserstein_distance == pytest.approx(want[f].normalized_wasserstein_distance, abs=r.ks_error)
    assert got["a"].ks_statistic > 0.1 and got["c"].ks_statistic == 0


def test_a_day_is_written_anew_and_alone(spark, pair, tmp_path):
    _, _, df = pair
    path = f"file://{tmp_path}/s"
    Y.write_sketches(df, ["a"], "ts", path)
    Y.write_sketches(df.filter("ts = '2024-01-05'").limit(10), ["a"], "ts", path)
    n = {str(r.day): r.n for r in Y.read_sketches(spark, path, "2024-01-01", "2024-01-31").collect()}
    assert n["2024-01-05"] == 10 and n["2024-01-06"] == 400 and len(n) == 31
    plan = Y.read_sketches(spark, path, "2024-01-05", "2024-01-06")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert Y.sketched_drift(Y.read_sketches(spark, path, "2030-01-01", "2030-01-02"), Y.read_sketches(spark, path, "2024-01-01", "2024-01-02")).count() == 0
