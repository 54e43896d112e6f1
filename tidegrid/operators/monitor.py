"""Model accuracy, health, fairness, experiments, anomaly records, retraining decisions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RMSE_MAX = 7.0
R2_MIN = 0.7


def metric_columns(actual: str, predicted: str) -> list[Column]:
    """RMSE, MAE, R2 and count as one set of mergeable aggregates (no second pass for the mean)."""
    a, p = F.col(actual), F.col(predicted)
    pair = a.isNotNull() & p.isNotNull()
    e = F.when(pair, a - p)
    a = F.when(pair, a)
    residual = F.sum(e * e)
    spread = F.var_pop(a) * F.count(e)
    r2 = (
        F.when(spread > 0, 1 - residual / spread)
        .when(residual == 0, 1.0)
        .when(F.count(e) > 0, 0.0)
    )
    return [
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        r2.alias("r2"),
        F.count(e).alias("num_predictions"),
    ]


def model_metrics(
    df: DataFrame,
    actual: str,
    predicted: str,
    by: Sequence[str] = (),
    rmse_max: float = RMSE_MAX,
    r2_min: float = R2_MIN,
) -> DataFrame:
    """Accuracy per group with ``status`` (ok, alert, no_data) and alert messages."""
    # Alert texts and status names.
    high = F.format_string(
        f"RMSE (%.2f) exceeded threshold ({rmse_max}).", F.col("rmse")
    )
    low = F.format_string(f"R2 score (%.2f) fell below threshold ({r2_min}).", F.col("r2"))
    alerts = F.array_compact(
        F.array(F.when(F.col("rmse") > rmse_max, high), F.when(F.col("r2") < r2_min, low))
    )
    status = (
        F.when(F.col("num_predictions") == 0, "no_data")
        .when(F.size("alerts") > 0, "alert")
        .otherwise("ok")
    )
    scored = df.groupBy(*by).agg(*metric_columns(actual, predicted))
    return scored.withColumn("alerts", alerts).withColumn("status", status)


def component_health(
    pulses: DataFrame,
    components: Sequence[str],
    by: Sequence[str] = (),
    component: str = "component",
    status: str = "status",
    ts: str = "ts",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Alignment per group from the latest status of each component; components that never sent a
    pulse are UNKNOWN. ``details`` maps the unhealthy ones to their status."""
    latest = pulses.groupBy(*by, component).agg(
        F.max_by(status, F.struct(ts, *tie)).alias("_status")
    )
    seen = F.map_from_entries(F.array_sort(F.collect_list(F.struct(component, "_status"))))
    expected = F.array(*[F.lit(c) for c in components])
    names = F.array_sort(F.array_union(expected, F.map_keys("_seen")))
    state = F.map_from_arrays(
        names,
        F.transform(names, lambda c: F.coalesce(F.try_element_at("_seen", c), F.lit("UNKNOWN"))),
    )
    healthy, total = F.col("healthy_count"), F.col("total_count")
    return (
        latest.groupBy(*by)
        .agg(seen.alias("_seen"))
        .withColumn("_state", state)
        .withColumns(
            {
                "details": F.map_filter("_state", lambda k, v: v != "HEALTHY"),
                "total_count": F.size("_state"),
            }
        )
        .withColumn("healthy_count", total - F.size("details"))
        .withColumn(
            "overall",
            F.when(healthy == total, "PERFECT_HARMONY")
            .when(healthy >= total * 0.7, "MINOR_MISALIGNMENT")
            .otherwise("CRITICAL_DISRUPTION"),
        )
        .drop("_seen", "_state")
    )


def group_disparity(
    df: DataFrame, attrs: Sequence[str], prediction: str, threshold: float = 0.1
) -> DataFrame:
    """Per value of each protected attribute: how far the mean prediction lies from the overall
    mean, relative to it, held to [0, 0.5]; ``concern`` beyond the threshold."""
    overall = df.agg(F.avg(prediction).alias("m")).scalar()
    pairs = F.array(
        *[
            F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("group"))
            for a in attrs
        ]
    )
    apart = F.abs(F.col("mean_prediction") - F.col("overall_mean")) / F.abs("overall_mean")
    return (
        df.select(F.inline(pairs), prediction)
        .groupBy("attribute", "group")
        .agg(F.avg(prediction).alias("mean_prediction"), F.count(prediction).alias("n"))
        .withColumn("overall_mean", overall)
        .withColumn("disparity", F.greatest(F.lit(0.0), F.least(F.lit(0.5), apart)))
        .withColumn("concern", F.col("disparity") > threshold)
    )


def fairness_guidance(disparity: DataFrame, threshold: float = 0.1) -> DataFrame:
    """One row over the attributes: worst disparity of each, score and status."""
    per_attribute = disparity.groupBy("attribute").agg(F.max("disparity").alias("score"))
    raw = 1.0 - F.sum("score") / (F.count(F.lit(1)) + 1e-6)
    concerns = F.array_sort(F.collect_list(F.when(F.col("score") > threshold, F.col("attribute"))))
    score = F.col("guidance_score")
    return per_attribute.agg(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)).alias("guidance_score"),
        concerns.alias("ethical_concerns"),
    ).withColumn(
        "status",
        F.when(F.size("ethical_concerns") == 0, "ETHICAL_ALIGNMENT")
        .when(score < 0.5, "CRITICAL_ETHICAL_RISK")
        .otherwise("BIAS_DETECTED"),
    )


def experiment_by_arm(
    df: DataFrame,
    experiment: str,
    arm: str,
    actual: str,
    predicted: str,
    arms: Sequence[str] = ("control", "treatment"),
    min_sample: int = 1000,
) -> DataFrame:
    """Accuracy of each arm side by side, treatment minus control, and whether every arm has the
    minimum sample. Arms are named, so no pass is spent on finding them."""
    names = ("rmse", "mae", "r2", "num_predictions")
    scored = df.groupBy(experiment, arm).agg(*metric_columns(actual, predicted))
    wide = scored.groupBy(experiment).agg(
        *[
            F.max(F.when(F.col(arm) == a, F.col(n))).alias(f"{a}_{n}")
            for a in arms
            for n in names
        ]
    )
    base, last = arms[0], arms[-1]
    enough = F.lit(True)
    for a in arms:
        enough = enough & (F.coalesce(F.col(f"{a}_num_predictions"), F.lit(0)) >= min_sample)
    deltas = {
        f"{n}_delta": F.col(f"{last}_{n}") - F.col(f"{base}_{n}") for n in ("rmse", "mae", "r2")
    }
    return wide.withColumns(deltas | {"enough_samples": enough})


# The rule of the resource detector.
METRIC_RULES = (
    {"detector": "resource_cpu_spike", "metric": "cpu_utilization", "above": 0.9},
)


def metric_rules(
    metrics: DataFrame,
    rules: Sequence[Mapping[str, Any]] = METRIC_RULES,
    alert: float = 0.8,
    keep: Sequence[str] = ("ts",),
) -> DataFrame:
    """Anomaly records of threshold rules over metric columns; severity is the value itself."""
    hits = [
        F.when(
            F.col(r["metric"]) > r["above"],
            F.struct(
                F.lit(r["detector"]).alias("detector"),
                F.lit(r["metric"]).alias("metric"),
                F.col(r["metric"]).cast("double").alias("severity"),
            ),
        )
        for r in rules
    ]
    return metrics.select(*keep, F.inline(F.array_compact(F.array(*hits)))).withColumn(
        "alert_raised", F.col("severity") >= alert
    )


def drift_anomalies(report: DataFrame, alert: float = 0.8) -> DataFrame:
    """Anomaly records of a drift report; severity is the KS statistic."""
    return report.filter("overall_drift_detected").select(
        F.lit("demand_forecast_drift").alias("detector"),
        F.col("feature").alias("metric"),
        F.col("ks_statistic").alias("severity"),
        (F.col("ks_statistic") >= alert).alias("alert_raised"),
    )


def confidence_anomalies(
    scored: DataFrame, alert: float = 0.8, keep: Sequence[str] = ()
) -> DataFrame:
    """Anomaly records of low-confidence predictions; severity is the missing confidence."""
    severity = 1.0 - F.col("confidence_score")
    return scored.filter(F.col("confidence_level") == "LOW").select(
        *keep,
        F.lit("model_prediction_variance").alias("detector"),
        F.lit("prediction_confidence").alias("metric"),
        severity.alias("severity"),
        (severity >= alert).alias("alert_raised"),
    )


def merge_anomalies(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def retrain_decision(
    drift: DataFrame,
    perf: DataFrame,
    by: Sequence[str],
    drift_limit: float = 0.1,
    drop_limit: float = 0.05,
    drift_score: str = "drift_score",
    rmse: str = "rmse",
    baseline: str = "baseline_rmse",
) -> DataFrame:
    """Retrain where the drift score or the relative RMSE rise passes its limit. A group known to
    only one of the tables is judged by that one."""
    drop = (F.col(rmse) - F.col(baseline)) / F.col(baseline)
    # Reason texts.
    reasons = F.array_compact(
        F.array(
            F.when(F.col(drift_score) > drift_limit, "Significant data drift detected."),
            F.when(
                F.col("performance_drop") > drop_limit,
                "Model performance degradation detected.",
            ),
        )
    )
    return (
        drift.select(*by, drift_score)
        .join(perf.select(*by, rmse, baseline), list(by), "full")
        .withColumn("performance_drop", drop)
        .withColumn("reasons", reasons)
        .withColumn("retrain", F.size("reasons") > 0)
    )
