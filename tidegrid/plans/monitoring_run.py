"""One monitoring run: score new actuals, keep them in the history table, report accuracy and
drift, decide on retraining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.demand import time_range
from tidegrid.operators.distribution import drift_report
from tidegrid.operators.history import upsert_table
from tidegrid.operators.learn import score_batch
from tidegrid.operators.monitor import model_metrics, retrain_decision


def performance_run(
    features: DataFrame,
    model: PipelineModel,
    label: str,
    key: Sequence[str],
    ts: str,
    start,
    end,
    history: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Predictions for ``[start, end)`` go into the history table (newest wins); the accuracy
    report over them comes back."""
    scored = score_batch(time_range(features, ts, start, end), model).select(
        *key, ts, F.col(label).alias("actual"), "predicted", F.to_date(ts).alias("day")
    )
    upsert_table(history, scored, [*key, ts], "day")
    return model_metrics(scored, "actual", "predicted", by)


def retraining_check(
    current: DataFrame,
    baseline: DataFrame,
    cols: Sequence[str],
    performance: DataFrame,
    baseline_rmse: float,
) -> DataFrame:
    """One row: the strongest normalised drift over the features beside the RMSE, and the verdict."""
    drift = drift_report(current, baseline, cols).agg(
        F.max("normalized_wasserstein_distance").alias("drift_score")
    )
    scope = F.lit("all").alias("scope")
    return retrain_decision(
        drift.select(scope, "drift_score"),
        performance.select(scope, "rmse", F.lit(baseline_rmse).alias("baseline_rmse")),
        ["scope"],
    )
