"""Queries of the learned operators.

Values depend on the learner, so the SQL twins hold what must be true for any learner. One forecaster with the
full number of rounds is trained per session and data set, saved, and loaded by every query that needs one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.operators import demand as D
from tidegrid.operators import learn as T
from tidegrid.operators.lookback import TARGET, split_train_test
from tidegrid.plans.monitoring_run import performance_run, retraining_check
from tidegrid.plans.registry import ORACLES, query
from tidegrid.plans import q_features  # noqa: F401  (the feature view's SQL)
from tidegrid.plans.training import train_and_evaluate
from tidegrid.session import scratch_path
from tidegrid.sources import tables as S

WS = "feature_window_start"
KEY = [*D.CELL, WS]
OUTLIERS = ["demand_last_15min", "demand_last_60min", TARGET]
# The ranges that are searched.
SPACE = {
    "maxDepth": {"type": "int", "low": 3, "high": 9},
    "maxIter": {"type": "int", "low": 50, "high": 200, "step": 50},
    "stepSize": {"type": "float", "low": 0.01, "high": 0.3, "log": True},
    "subsamplingRate": {"type": "float", "low": 0.6, "high": 1.0},
    "columnShare": {"type": "float", "low": 0.6, "high": 1.0},
}
TRIALS = 10

FEATURES_SQL = f"f AS (SELECT * FROM ({ORACLES['batch_features']}) WHERE {TARGET} IS NOT NULL)"
KEY_SQL = ", ".join(KEY)

_SAVED: dict[tuple[str, str], tuple[str, list]] = {}


def _features(spark, sf):
    return D.drop_unlabelled(S.features(spark, sf), TARGET)


def _trained(spark, sf):
    """The forecaster of the earlier four fifths, from where it was saved, and its test metrics."""
    known = (spark.sparkContext.applicationId, sf)
    if known not in _SAVED:
        model, metrics = train_and_evaluate(_features(spark, sf), S.FEATURES, TARGET, D.CELL, WS)
        path = scratch_path(spark, "forecaster")
        T.save_forecaster(model, path)
        _SAVED[known] = path, metrics.collect()
    path, metrics = _SAVED[known]
    return T.load_forecaster(path), spark.createDataFrame(metrics)


@query("i1_train_forecaster")
def _(spark, sf):
    return _trained(spark, sf)[1]


@query("i1_beats_the_mean", f"""WITH {FEATURES_SQL} SELECT count(*) AS n, true AS better, true AS all_scored FROM f""")
def _(spark, sf):
    """Over all rows, the error is smaller than that of always saying the mean."""
    scored = T.score_batch(_features(spark, sf), _trained(spark, sf)[0])
    error = F.sum(F.pow(F.col(TARGET) - F.col("predicted"), 2))
    spread = F.var_pop(TARGET) * F.count(TARGET)
    return scored.agg(
        F.count("*").alias("n"), (error < spread).alias("better"), (F.count("predicted") == F.count("*")).alias("all_scored")
    )


@query("monitoring_run")
def _(spark, sf):
    """The forecaster of the earlier days watched over all later rows."""
    split = split_train_test(_features(spark, sf), D.CELL, WS)
    early, late = split.filter("NOT is_test").drop("is_test"), split.filter("is_test").drop("is_test")
    history = scratch_path(spark, "history")
    report = performance_run(late, _trained(spark, sf)[0], TARGET, D.CELL, WS, "2024-01-01", "2024-02-01", history)
    return retraining_check(late, early, S.FEATURES, report, 60.0)


@query("i2_score_batch")
def _(spark, sf):
    return T.score_batch(_features(spark, sf), _trained(spark, sf)[0]).select(*KEY, TARGET, "predicted")


@query("i2_scored_after_loading", f"""WITH {FEATURES_SQL} SELECT {KEY_SQL}, true AS same FROM f""")
def _(spark, sf):
    """Saved again and loaded again, the model says the same about every row."""
    model = _trained(spark, sf)[0]
    path = scratch_path(spark, "copy")
    T.save_forecaster(model, path)
    once = T.score_batch(_features(spark, sf), model).withColumnRenamed("predicted", "before")
    both = T.score_batch(once, T.load_forecaster(path))
    return both.select(*KEY, (F.col("before") == F.col("predicted")).alias("same"))


@query("i3_feature_importance")
def _(spark, sf):
    return T.feature_importance(_trained(spark, sf)[0], S.FEATURES, _features(spark, sf))


@query("i3_importance_sums", f"SELECT {len(S.FEATURES)}::bigint AS features, true AS gains_sum_to_one, true AS has_splits")
def _(spark, sf):
    out = T.feature_importance(_trained(spark, sf)[0], S.FEATURES, _features(spark, sf))
    return out.agg(
        F.count("*").alias("features"), (F.abs(F.sum("gain_share") - 1) < 1e-6).alias("gains_sum_to_one"),
        (F.sum("split_count") > 0).alias("has_splits"),
    )


@query("i3_permutation_importance")
def _(spark, sf):
    return T.permutation_importance(_features(spark, sf), _trained(spark, sf)[0], S.FEATURES, TARGET, KEY)


@query("i3_permutation_holds", f"""SELECT {len(S.FEATURES)}::bigint AS features, true AS errors_are_positive, true AS rises_differ_by_error,
  true AS the_best_counts""")
def _(spark, sf):
    """A row per feature; rises are errors less one base; some feature matters."""
    out = T.permutation_importance(_features(spark, sf), _trained(spark, sf)[0], S.FEATURES, TARGET, KEY)
    base = F.col("rmse") - F.col("rmse_rise")
    return out.agg(
        F.count_distinct("feature").alias("features"), F.bool_and(F.col("rmse") > 0).alias("errors_are_positive"),
        (F.max(base) - F.min(base) < 1e-9).alias("rises_differ_by_error"), (F.max("rmse_rise") > 0).alias("the_best_counts"),
    )


def _search(spark, sf):
    known = ("search", spark.sparkContext.applicationId, sf)
    if known not in _SAVED:
        path = scratch_path(spark, "search")
        T.random_search(_features(spark, sf), S.FEATURES, TARGET, SPACE, trials=TRIALS).write.parquet(path)
        _SAVED[known] = path, []
    return spark.read.parquet(_SAVED[known][0])


@query("i4_random_search")
def _(spark, sf):
    return _search(spark, sf)


@query("i4_search_holds", f"""SELECT {TRIALS}::bigint AS trials, 1::bigint AS best, true AS best_is_least, true AS all_rounds,
  true AS ranges_hold, true AS beats_the_spread""")
def _(spark, sf):
    """Every draw within its range has all its rounds, one trial is best and it is the least; the best is not worse than the mean."""
    given = "maxDepth int, maxIter int, stepSize double, subsamplingRate double, columnShare double"
    out = _search(spark, sf).withColumn("p", F.from_json("params", given))
    held = F.lit(True)
    for name, at in SPACE.items():
        held = held & F.col(f"p.{name}").between(at["low"], at["high"])
    spread = _features(spark, sf).select(F.stddev_pop(TARGET)).scalar()
    return out.agg(
        F.count("*").alias("trials"), F.count_if("is_best").alias("best"),
        (F.min("rmse") == F.min(F.when(F.col("is_best"), F.col("rmse")))).alias("best_is_least"),
        F.bool_and(F.col("rounds") == F.col("p.maxIter")).alias("all_rounds"), F.bool_and(held).alias("ranges_hold"),
        (F.min("rmse") < 1.1 * spread).alias("beats_the_spread"),
    )


@query("i5_attribution")
def _(spark, sf):
    f = _features(spark, sf)
    return T.attribution(f, _trained(spark, sf)[0], S.FEATURES, KEY, f)


@query("i5_contributions_add_up", f"""WITH {FEATURES_SQL} SELECT {KEY_SQL}, true AS adds_up FROM f""")
def _(spark, sf):
    f = _features(spark, sf)
    out = T.attribution(f, _trained(spark, sf)[0], S.FEATURES, KEY, f)
    total = sum((F.col(f"{c}_contribution") for c in S.FEATURES), F.lit(0.0))
    return out.select(*KEY, (F.abs(total - (F.col("predicted") - F.col("base_value"))) < 1e-6).alias("adds_up"))


@query("i6_isolation_forest")
def _(spark, sf):
    return T.isolation_forest(_features(spark, sf), OUTLIERS, KEY).select(*KEY, "anomaly_score", "is_outlier")


@query("i6_flagged_share", f"""WITH {FEATURES_SQL} SELECT count(*) AS n, true AS share_is_right, true AS scores_in_range FROM f""")
def _(spark, sf):
    """At most the twentieth with the highest scores, and all but ties at the cut of them."""
    out = T.isolation_forest(_features(spark, sf), OUTLIERS, KEY)
    cut = F.max(F.when(~F.col("is_outlier"), F.col("anomaly_score")))
    flagged = F.count_if("is_outlier")
    return out.groupBy().agg(
        F.count("*").alias("n"), flagged.alias("flagged"), cut.alias("cut"),
        F.min(F.when(F.col("is_outlier"), F.col("anomaly_score"))).alias("least"),
        F.count_if((F.col("anomaly_score") > 0) & (F.col("anomaly_score") <= 1)).alias("fine"),
    ).select(
        "n", ((F.col("flagged") <= F.ceil(F.col("n") * 0.05)) & (F.coalesce("least", F.lit(2.0)) > F.col("cut"))).alias("share_is_right"),
        (F.col("fine") == F.col("n")).alias("scores_in_range"),
    )
