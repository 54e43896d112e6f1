"""What must hold for any learner."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import boost as B
from tidegrid.operators import decide as R
from tidegrid.operators import learn as T
from tidegrid.operators.monitor import metric_columns

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 1, (600, 3))
    y = 10 * x[:, 0] + 3 * (x[:, 1] > 0.5)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(4, "id").cache()
    return df, T.train_forecaster(df, COLS, "y", {"maxIter": 15, "stepSize": 0.3, "maxDepth": 3})


def test_beats_the_mean(fitted):
    df, model = fitted
    row = T.score_batch(df, model).agg(*metric_columns("y", "predicted")).first()
    assert row.r2 > 0.8


def test_importance(fitted):
    df, model = fitted
    out = {r.feature: r for r in T.feature_importance(model, COLS, df).collect()}
    assert out["a"].split_count > 0 and out["a"].gain_share > out["c"].gain_share
    rise = {r.feature: r.rmse_rise for r in T.permutation_importance(df, model, COLS, "y", ["id"], parts=4).collect()}
    assert rise["a"] > rise["b"] > rise["c"]


def test_contributions_add_up(fitted):
    df, model = fitted
    some = df.filter("id < 40")
    out = T.attribution(some, model, COLS, ["id"], df).collect()
    assert len(out) == 40
    for r in out:
        total = sum(r[f"{c}_contribution"] for c in COLS)
        assert total == pytest.approx(r.predicted - r.base_value)
    mean = T.score_batch(df, model).agg(F.avg("predicted")).first()[0]
    assert out[0].base_value == pytest.approx(mean)


def test_contributions_are_exact_over_the_whole_background(spark, fitted):
    df, _ = fitted
    some = df.limit(30).withColumn("b", F.when(F.col("id") % 5 > 0, F.col("b"))).withColumn("c", F.lit(0.5)).checkpoint()
    model = T.train_forecaster(df.withColumn("c", F.lit(0.5)), COLS, "y", {"maxIter": 12, "stepSize": 0.3, "maxDepth": 4})
    back = df.withColumn("c", F.col("id") / 600)
    got = {r.id: r for r in T.attribution(some.filter("id % 3 = 0 or id % 5 = 0"), model, COLS, ["id"], back).collect()}
    assert got and all(r.c_contribution == 0 for r in got.values())  # no tree can test it
    x, z = some.alias("x"), back.alias("z")
    pick = lambda side, c: F.col(f"{side}.{c}").alias(c)
    f = {}
    for a, b in ("xx", "xz", "zx", "zz"):
        mixed = x.crossJoin(z).select(F.col("x.id"), pick(a, "a"), pick(b, "b"), pick("z", "c"))
        f[a + b] = {r.id: r.v for r in T.score_batch(mixed, model).groupBy("id").agg(F.avg("predicted").alias("v")).collect()}
    for i, r in got.items():
        xx, xz, zx, zz = (f[k][i] for k in ("xx", "xz", "zx", "zz"))
        assert r.a_contribution == pytest.approx(((xz - zz) + (xx - zx)) / 2, abs=1e-9)
        assert r.b_contribution == pytest.approx(((zx - zz) + (xx - xz)) / 2, abs=1e-9)


def test_save_and_load(fitted, tmp_path):
    df, model = fitted
    T.save_forecaster(model, f"{tmp_path}/m")
    T.save_forecaster(model, f"{tmp_path}/m")
    before, after = (
        {r.id: r.predicted for r in T.score_batch(df, m).collect()} for m in (model, T.load_forecaster(f"{tmp_path}/m"))
    )
    assert before == after and len(before) == 600


def test_search_is_repeatable(fitted):
    df, _ = fitted
    space = {"maxDepth": {"type": "int", "low": 1, "high": 5, "step": 2}, "stepSize": {"type": "float", "low": 0.01, "high": 0.5, "log": True},
             "subsamplingRate": {"type": "categorical", "choices": [0.5, 1.0]}}
    assert T.draw_params(space, 5, 1) == T.draw_params(space, 5, 1)
    assert {d["maxDepth"] for d in T.draw_params(space, 50, 1)} == {1, 3, 5}
    out = T.random_search(df, COLS, "y", space, trials=2, params={"maxIter": 3}).collect()
    assert sum(r.is_best for r in out) == 1 and min(out, key=lambda r: r.rmse).is_best


def test_search_query_draws_from_the_full_ranges(fitted):
    from tidegrid.plans import q_learning as Q

    draws = T.draw_params(Q.SPACE, 500, 1)
    assert {d["maxIter"] for d in draws} == {50, 100, 150, 200} and {d["maxDepth"] for d in draws} == set(range(3, 10))
    assert Q.TRIALS >= 10
    assert len({d["columnShare"] for d in draws}) > 400 and all(0.6 <= d["columnShare"] <= 1 for d in draws)
    assert all(T._trial(d).rounds == d["maxIter"] for d in draws)
    with pytest.raises(ValueError):
        T._trial({"numTrees": 3})


def plain_boost(x, y, rounds, rate, depth, penalty=1.0):
    """Trees over all rows and columns by trying every cut."""
    score = np.full(len(y), y.mean())

    def split(rows, level):
        g = score[rows] - y[rows]
        value = -g.sum() / (len(rows) + penalty)
        best = (1e-9, None, None)
        for f in range(x.shape[1]) if level < depth else ():
            for cut in np.unique(x[rows, f])[:-1]:
                left = x[rows, f] <= cut
                gain = g[left].sum() ** 2 / (left.sum() + penalty) + g[~left].sum() ** 2 / ((~left).sum() + penalty) - g.sum() ** 2 / (len(rows) + penalty)
                if gain > best[0] + 1e-9:
                    best = (gain, f, cut)
        if best[1] is None:
            out[rows] = value
            return
        left = x[rows, best[1]] <= best[2]
        split(rows[left], level + 1)
        split(rows[~left], level + 1)

    for _ in range(rounds):
        out = np.zeros(len(y))
        split(np.arange(len(y)), 0)
        score = score + rate * out
    return score


@pytest.mark.parametrize("block_rows,fan_in,keep", [(1 << 17, 64, 20), (50, 2, 2)])
def test_trees_equal_plain_boosting(spark, monkeypatch, block_rows, fan_in, keep):
    for name, value in (("BLOCK_ROWS", block_rows), ("FAN_IN", fan_in), ("KEEP", keep)):
        monkeypatch.setattr(B, name, value)
    rng = np.random.default_rng(4)
    x = np.stack([rng.integers(0, 12, 300), rng.integers(0, 5, 300), rng.integers(-3, 4, 300)], axis=1).astype(float)
    y = (x[:, 0] * 2 + (x[:, 1] > 2) * x[:, 2] * 5 + rng.normal(0, 0.1, 300)).round(3)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id int, a double, b double, c double, y double")
    params = {"maxIter": 7, "stepSize": 0.3, "maxDepth": 3, "subsamplingRate": 1.0, "columnShare": 1.0}
    model = T.train_forecaster(df.repartition(5), COLS, "y", params)
    got = {r.id: r.predicted for r in T.score_batch(df, model).collect()}
    assert [got[i] for i in range(300)] == pytest.approx(plain_boost(x, y, 7, 0.3, 3).tolist(), abs=1e-6)


def test_trials_grow_as_they_would_alone(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(float(a), None if i % 7 == 0 else float(b), float(2 * a + (b if i % 7 else 3))) for i, (a, b) in enumerate(rng.uniform(0, 1, (500, 2)))]
    df = spark.createDataFrame([*rows, (0.5, 0.5, None), (float("nan"), 0.5, 1.0)], "a double, b double, y double").repartition(3)
    some = [(5, 0.3, 2, 0.8, 0.5, 1), (9, 0.1, 4, 1.0, 1.0, 2), (2, 0.5, 1, 0.6, 1.0, 3), (3, 0.2, 0, 1.0, 1.0, 4)]
    errors = {}
    for size in (1 << 17, 100):
        monkeypatch.setattr(B, "BLOCK_ROWS", size)
        together = [B.Trial(*t) for t in some]
        B.grow(df, ["a", "b"], "y", together, held_out=0.25)
        for t, given in zip(together, some):
            alone = B.Trial(*given)
            B.grow(df, ["a", "b"], "y", [alone], held_out=0.25)
            assert [len(t.trees), len(t.errors)] == [given[0], given[0] + 1]
            assert t.errors == pytest.approx(alone.errors)
        errors[size] = [t.errors[-1] for t in together]
        assert together[1].errors[-1] < together[1].errors[0]
    with pytest.raises(ValueError):
        B.grow(df.limit(0), ["a", "b"], "y", [B.Trial(*some[0])])


def test_unknown_values_go_right(spark):
    rows = [(None if i % 3 else float(i % 2), 10.0 if i % 3 else float(i % 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, y double")
    model = T.train_forecaster(df, ["a"], "y", {"maxIter": 40, "stepSize": 0.5, "maxDepth": 2, "subsamplingRate": 1.0, "columnShare": 1.0})
    out = {r.a: r.predicted for r in T.score_batch(df, model).distinct().collect()}
    assert out[None] == pytest.approx(10, abs=0.1) and out[0.0] == pytest.approx(0, abs=0.1) and out[1.0] == pytest.approx(1, abs=0.1)


def test_planted_outliers_rank_first(spark):
    rng = np.random.default_rng(42)
    x = np.vstack([rng.normal(0, 1, (490, 4)), rng.normal(0, 1, (10, 4)) + 12])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, f0 double, f1 double, f2 double, f3 double")
    cols = ["f0", "f1", "f2", "f3"]
    out = T.isolation_forest(df, cols, ["id"], trees=40, sample=64, contamination=0.02)
    top = [r.id for r in out.orderBy(F.desc("anomaly_score")).limit(10).collect()]
    assert set(top) == set(range(490, 500))
    again = T.isolation_forest(df.repartition(6), cols, ["id"], trees=40, sample=64, contamination=0.02)
    assert {r.id: r.anomaly_score for r in out.collect()} == {r.id: r.anomaly_score for r in again.collect()}


def test_routing_share_and_stability(spark):
    df = spark.range(20_000)
    out = R.ab_route(df, "id")
    share = out.filter("model_version = 'Staging'").count() / 20_000
    assert share == pytest.approx(0.1, abs=0.01)
    wider = R.ab_route(df, "id", {"Staging": 0.3})
    kept = out.filter("model_version = 'Staging'").join(wider.filter("model_version = 'Staging'"), "id").count()
    assert kept == out.filter("model_version = 'Staging'").count()
    assert R.ab_route(df, "id", {"Staging": 0.0}).filter("model_version <> 'Production'").count() == 0


def test_unknown_values_stand_beyond_every_cut(spark):
    """A split between known and unknown values: contributions add up for either kind of row."""
    rows = [(i, None if i % 3 else float(i % 2), float(i % 5), 0.0, 10.0 if i % 3 else float(i % 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y double")
    model = T.train_forecaster(df, COLS, "y", {"maxIter": 10, "stepSize": 0.5, "maxDepth": 2, "subsamplingRate": 1.0, "columnShare": 1.0})
    for r in T.attribution(df, model, COLS, ["id"], df).collect():
        assert r.a_contribution + r.b_contribution + r.c_contribution == pytest.approx(r.predicted - r.base_value, abs=1e-9)


def test_a_growing_tree_goes_on_from_level_to_level(monkeypatch):
    """Each level moves the rows drawn one step on and draws them once per tree."""
    rng = np.random.default_rng(3)
    bins, label = rng.integers(0, 9, (3, 400)).astype(np.uint8), rng.normal(0, 1, 400)
    test, t, drawn = np.zeros(400, bool), B.Trial(4, 0.3, 5, 0.7, 1.0, 1), []
    own, plain = B.Block(0, bins, np.zeros(400), 0), np.zeros(400)
    monkeypatch.setattr(B.Block, "_draw", lambda self, *a, draw=B.Block._draw: (drawn.append(1), draw(self, *a))[1])
    while t.waits:
        if not t.frontier and len(t.trees) < t.rounds:
            t.next_tree(3)
        job, before = t.job(0, 10), len(t.trees) - (t.level > 0)
        error, code, sums, counts = own.sums(job, label, test)
        total, n = np.zeros(job["size"]), np.zeros(job["size"])
        total[code], n[code] = sums, counts
        t.advance(job, total, n, 0.0)
        if len(t.trees) - (t.level > 0) > before:
            own.apply((t.rate, *t.trees[-1].packed()))
            B._apply(plain, bins, (t.rate, *t.trees[-1].packed()))
    assert len(drawn) == 4 and own.score.tolist() == plain.tolist()


def test_a_pass_adds_up_the_smaller_child():
    """Of two children one is added up and the other is the rest of its parent; both are as if each had been added up."""
    rng = np.random.default_rng(5)
    bins, label, test = rng.integers(0, 9, (3, 500)).astype(np.uint8), rng.normal(0, 1, 500), np.zeros(500, bool)
    own, t, seen = B.Block(0, bins, np.zeros(500), 0), B.Trial(1, 0.3, 5, 0.7, 1.0, 1), []
    t.next_tree(3)
    while t.frontier:
        job = t.job(0, 10)
        _, code, sums, counts = own.sums(job, label, test)
        total, n = np.zeros(job["size"]), np.zeros(job["size"])
        total[code], n[code] = sums, counts
        if t.level:
            assert job["size"] == len(t.frontier) // 2 * 3 * 10
            whole = t.whole(total.reshape(-1, 3, 10), n.reshape(-1, 3, 10))
            for node, g, h in zip(t.frontier, *whole):
                rows = own.drawn & (own.at == node)
                assert h.sum() == 3 * rows.sum() == 3 * t.trees[0].n[node]
                for f in range(3):
                    assert g[f].tolist() == pytest.approx(np.bincount(bins[f, rows], -label[rows], 10).tolist(), abs=1e-9)
            seen.append(len(t.frontier))
        t.advance(job, total, n, 0.0)
    assert len(seen) == 4


def test_lost_files_are_worked_out_again(spark, monkeypatch):
    """What an executor kept between passes may go away at any time."""
    monkeypatch.setattr(B, "BLOCK_ROWS", 60)
    monkeypatch.setattr(B, "KEEP", 2)
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(float(a), float(b), float(2 * a + b)) for a, b in rng.uniform(0, 1, (400, 2))], "a double, b double, y double")
    df, once, passes = df.repartition(3).checkpoint(), B.Grower._pass, []

    def losing(self, plan, size):
        passes.append(len(plan))
        if len(passes) % 4 == 0:
            name = self.name
            self.numbers.filter(lambda r: len(passes) % 8 or r[0] % 2).foreach(
                lambda r: B._clear(*(f"{B._shelf(name)}/{x}" for x in (r[0], f"{r[0]}-0", f"{r[0]}-1")))
            )
        return once(self, plan, size)

    def grown():
        trials = [B.Trial(7, 0.3, 3, 0.8, 1.0, 1), B.Trial(4, 0.2, 4, 1.0, 1.0, 2)]
        B.grow(df, ["a", "b"], "y", trials, held_out=0.25)
        return [(t.errors, [tree.feature for tree in t.trees], [tree.cut for tree in t.trees]) for t in trials]

    kept = grown()
    monkeypatch.setattr(B.Grower, "_pass", losing)
    assert grown() == kept and len(passes) > 20
