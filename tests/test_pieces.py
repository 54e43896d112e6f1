"""Operators that cut keys into pieces, with tiny pieces and a hot key, against plain loops."""

import collections
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import asof as A
from tidegrid.operators import chunks as K
from tidegrid.operators import distribution as X
from tidegrid.operators import sequence as E

T0 = dt.datetime(2024, 1, 1)


def rows(seed, n=400, span=2000):
    """Key 'hot' has most rows, one key is null, times repeat."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        out.append((i, key, T0 + dt.timedelta(seconds=rng.randrange(span)), rng.random() < 0.35, round(rng.gauss(50, 20), 2)))
    return out


@pytest.fixture(scope="module")
def data(spark):
    raw = rows(7)
    df = spark.createDataFrame(raw, "id int, k string, ts timestamp, ok boolean, v double").repartition(5)
    by = collections.defaultdict(list)
    for r in sorted(raw, key=lambda r: (r[2], r[0])):
        by[r[1]].append(r)
    return df, by


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_number_rows(data, parts):
    df, by = data
    got = {r.id: r._rn for r in K.number_rows(df, ["k"], ["ts", "id"], parts).collect()}
    assert got == {r[0]: i + 1 for rs in by.values() for i, r in enumerate(rs)}


def test_row_blocks_repeat_the_tail(spark):
    df = spark.range(1, 26).select(F.col("id").alias("_rn"))
    out = K.row_blocks(df, 3, 10).collect()
    assert sorted(r._rn for r in out if r._home) == list(range(1, 26))
    assert sorted((r._rn, r._block) for r in out if not r._home) == [(8, 1), (9, 1), (10, 1), (18, 2), (19, 2), (20, 2)]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_streaks(data, parts):
    df, by = data
    want = {}
    for rs in by.values():
        n = 0
        for r in rs:
            n = 0 if r[3] else n + 1
            want[r[0]] = n
    got = E.failed_access_streak(df, "k", "ts", "ok", ["id"], 3, parts).collect()
    assert {r.id: r.failed_attempts for r in got} == want
    assert all(r.alert == (want[r.id] >= 3) for r in got)


@pytest.mark.parametrize("parts,block", [(40, 2), (3, 3), (1, 1024)])
def test_elasticity(data, parts, block, monkeypatch):
    monkeypatch.setattr(E, "FAN_IN", 3)  # several levels
    df, by = data
    prices = df.withColumns({"a": F.lit(1.0) + F.col("id") % 3, "b": F.lit(1.0) + F.col("id") % 5, "c": F.col("v") / 25 - 2})
    got = {r.k: r for r in E.elasticity(prices, ["k"], "ts", "a", "b", "c", ["id"], lr=0.2, parts=parts, block=block).collect()}
    for k, rs in by.items():
        eta, n = -0.8, 0
        for i, _, _, _, v in rs:
            a, b = 1.0 + i % 3, 1.0 + i % 5
            if b != a:
                eta = max(-2.5, min(-0.1, eta * 0.8 + (v / 25 - 2) / ((b - a) / a) * 0.2))
                n += 1
        assert got[k].elasticity == pytest.approx(eta) and got[k].updates == n


@pytest.mark.parametrize("seconds,parts", [(10, 1), (10, 9), (60, 40), (90, 3)])
def test_flash(data, seconds, parts):
    df, by = data
    got = {r.id: r for r in E.flash_insight(df, ["k"], "ts", seconds, 4, ["id"], parts).collect()}
    assert len(got) == 400
    for rs in by.values():
        for r in rs:
            inside = [x[2] for x in rs if r[2] - dt.timedelta(seconds=seconds) <= x[2] <= r[2]]
            g = got[r[0]]
            assert g.pulse_count == len(inside)
            assert g.insight_level == ("CRITICAL" if len(inside) >= 4 else "NORMAL")
            assert g.window_start == (min(inside) if len(inside) >= 4 else None)


def test_rolling_outlier(data, monkeypatch):
    df, by = data
    monkeypatch.setattr(E, "row_blocks", lambda d, back: K.row_blocks(d, back, 25))
    got = {r.id: r for r in E.rolling_outlier(df, ["k"], "ts", "v", 10, 0.2, ["id"], 7).collect()}
    for rs in by.values():
        for i, r in enumerate(rs):
            if i < 9:
                assert got[r[0]].lower_bound is None and not got[r[0]].is_outlier
                continue
            lo, hi = np.quantile([x[4] for x in rs[i - 9:i + 1]], [0.1, 0.9])
            assert got[r[0]].lower_bound == pytest.approx(lo) and got[r[0]].upper_bound == pytest.approx(hi)
            assert got[r[0]].is_outlier == (r[4] < lo or r[4] > hi)


def test_recent_error_confidence(data, monkeypatch):
    df, by = data
    monkeypatch.setattr(E, "row_blocks", lambda d, back: K.row_blocks(d, back, 17))
    got = {r.id: r for r in E.recent_error_confidence(df, ["k"], "ts", "v", 8, 20.0, tie=["id"], parts=7).collect()}
    for rs in by.values():
        for i, r in enumerate(rs):
            past = [x[4] for x in rs[max(0, i - 8):i]]
            g = got[r[0]]
            if len(past) < 5:
                assert (g.confidence_score, g.confidence_level, g.error_variability) == (0.5, "MEDIUM", 20.0)
            else:
                sd = float(np.std(past))
                assert g.error_variability == pytest.approx(sd)
                assert g.confidence_score == pytest.approx(max(0.0, 1 - min(1.0, sd / 20 - 0.5)))


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_asof(data, parts):
    df, by = data
    # one fact per key and time
    facts = df.filter("ok").groupBy("k", "ts").agg(F.max("v").alias("fact"))
    asked = df.filter("NOT ok").select("id", "k", "ts")
    known = collections.defaultdict(dict)
    for k, rs in by.items():
        for r in rs:
            if r[3]:
                known[k][r[2]] = max(r[4], known[k].get(r[2], -1e9))
    got = {r.id: r for r in A.feature_asof(asked, facts, ["k"], "ts", parts=parts).collect()}
    fresh = {r.id: r for r in A.weather_enrich(asked, facts, ["k"], "ts", 15, parts=parts).collect()}
    n = 0
    for k, rs in by.items():
        for r in rs:
            if r[3]:
                continue
            n += 1
            before = [t for t in known[k] if t <= r[2]]
            t = max(before, default=None)
            assert (got[r[0]].feature_ts, got[r[0]].fact) == (t, known[k].get(t))
            young = t is not None and (r[2] - t).total_seconds() < 15
            assert (fresh[r[0]].weather_ts, fresh[r[0]].fact) == ((t, known[k][t]) if young else (None, None))
    assert len(got) == len(fresh) == n


def test_entity_state(spark):
    df = spark.createDataFrame(
        [("e", "p", "1", T0), ("e", "p", "2", T0 + dt.timedelta(seconds=5)), ("e", "q", "3", T0), ("old", "p", "4", T0)],
        "e string, c string, v string, ts timestamp")
    now = T0 + dt.timedelta(seconds=302)
    out = E.entity_state(df, "e", "c", "v", "ts", as_of=now).collect()
    assert [(r.e, r.state) for r in out] == [("e", {"p": "2", "q": "3"})]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_global_rank(data, parts):
    df, _ = data
    got = K.global_rank(df.select("id"), ["id"], parts).collect()
    assert all(r._rank == r.id + 1 for r in got) and len(got) == 400


def test_quantiles_and_drift_against_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = np.round(rng.normal(0, 1, 300), 1), np.round(rng.normal(0.2, 1.1, 200), 1)
    da = spark.createDataFrame([(float(x),) for x in a], "x double")
    db = spark.createDataFrame([(float(x),) for x in b], "x double")
    q = {r.prob: r.value for r in X.exact_quantiles(da, ["x"], [0.0, 0.1, 0.5, 0.99, 1.0]).collect()}
    for p, v in q.items():
        assert v == pytest.approx(np.quantile(a, p))
    r = X.drift_report(da, db, ["x"]).first()
    grid = np.unique(np.concatenate([a, b]))
    gap = np.abs(np.searchsorted(np.sort(a), grid, "right") / 300 - np.searchsorted(np.sort(b), grid, "right") / 200)
    assert r.ks_statistic == pytest.approx(gap.max())
    assert r.wasserstein_distance == pytest.approx((gap[:-1] * np.diff(grid)).sum())
    z = np.sqrt(300 * 200 / 500) * gap.max()
    assert r.ks_pvalue == pytest.approx(2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * z * z) for k in range(1, 50)))


def test_dense_keys_are_split_by_size(spark, monkeypatch):
    """Nine rows in ten have one key and one hour; no window partition holds twice the mean."""
    df = spark.range(40_000).selectExpr(
        "id", "IF(id % 10 < 9, 'hot', 'k' || id % 7) AS k",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, IF(id % 10 < 9, id % 3600, id * 60)) AS ts",
        "id % 3 = 0 AS ok", "CAST(id % 11 AS double) AS v", "1.0D AS a", "1.5D AS b",
    ).repartition(6)
    sizes = []
    plain = K.range_chunks

    def watched(rows, order, parts=None):
        out = plain(rows, order, parts)
        key = [c for c in order if c == "k"]
        sizes.append([r["count"] for r in out.groupBy(*key, K.CHUNK).count().collect()] or [0])
        sizes[-1].append(sum(sizes[-1]) / (parts or 1))
        return out

    for module in (K, E, A):
        monkeypatch.setattr(module, "range_chunks", watched)
    parts = 20
    E.failed_access_streak(df, "k", "ts", "ok", ["id"], 3, parts).count()
    E.elasticity(df, ["k"], "ts", "a", "b", "v", ["id"], parts=parts).count()
    E.flash_insight(df, ["k"], "ts", 10, 5, ["id"], parts).count()
    E.rolling_outlier(df, ["k"], "ts", "v", 10, 0.2, ["id"], parts).count()
    E.recent_error_confidence(df, ["k"], "ts", "v", 8, tie=["id"], parts=parts).count()
    A.feature_asof(df, df.select("k", "ts", "v").withColumnRenamed("v", "f").dropDuplicates(["k", "ts"]), ["k"], "ts", parts=parts).count()
    assert len(sizes) == 6
    for *each, mean in sizes:
        assert max(each) < 2 * mean
