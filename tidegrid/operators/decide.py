"""Routing and operating decisions over joined tables."""

# The upper-case names of decisions, recommendations, levels and stages in this module.

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidegrid.operators.sequence import confidence_level


def region_model_route(
    df: DataFrame,
    zone: str,
    prefix_map: Mapping[str, str] | DataFrame,
    default: str,
    available: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``model``: of the first prefix, in map order, that the zone id starts with and whose
    model is available; else the default.

    A mapping (a configuration) becomes one CASE expression. A table (prefix, model, priority) of
    any size is matched by equality with each prefix of the distinct zone ids, never by comparing
    every zone with every prefix.
    """
    if not isinstance(prefix_map, DataFrame):
        choice: Column | None = None
        for prefix, model in prefix_map.items():
            if available is not None and model not in available:
                continue
            hit = F.col(zone).startswith(prefix)
            choice = F.when(hit, model) if choice is None else choice.when(hit, model)
        picked = F.lit(default) if choice is None else choice.otherwise(default)
        return df.withColumn("model", picked)
    table = prefix_map
    if available is not None:
        table = table.filter(F.col("model").isin(list(available)))
    ids = df.select(zone).filter(F.col(zone).isNotNull()).distinct()
    starts = F.transform(
        F.sequence(F.lit(0), F.length(zone)), lambda n: F.substring(F.col(zone), F.lit(1), n)
    )
    best = (
        ids.select(zone, F.explode(starts).alias("prefix"))
        .join(table, "prefix")
        .groupBy(zone)
        .agg(F.min_by("model", "priority").alias("model"))
    )
    return df.join(best, zone, "left").withColumn("model", F.coalesce("model", F.lit(default)))


def driver_allocation(
    forecast: DataFrame,
    supply: DataFrame,
    zone: str,
    demand: str = "predicted_demand",
    drivers: str = "active_drivers",
) -> DataFrame:
    """Gap between forecast and supply, and what to do about it. A zone without a supply row has
    no drivers."""
    d, n = F.col(demand), F.col(drivers)
    gap = F.when(n == 0, d).otherwise(d / n - 2.0)
    short, idle = F.col("demand_supply_gap_score") > 2.0, F.col("demand_supply_gap_score") < -1.0
    return (
        forecast.join(supply.select(zone, drivers), zone, "left")
        .withColumn(drivers, F.coalesce(n, F.lit(0)))
        .withColumn("demand_supply_gap_score", gap)
        .withColumns(
            {
                "recommendation": F.when(short, "INCREASE_DRIVERS")
                .when(idle, "OPTIMIZE_EXISTING_DRIVERS")
                .otherwise("MAINTAIN_CURRENT"),
                "target_drivers": F.when(short, (d / 1.5).cast("int")).otherwise(n.cast("int")),
                "incentive_level": F.when(short, "HIGH").when(idle, "LOW").otherwise("MEDIUM"),
            }
        )
    )


def champion_vs_candidate(
    metrics: DataFrame,
    segment: str = "segment",
    version: str = "version",
    stage: str = "stage",
    rmse: str = "rmse",
    strong: float = 0.95,
    slight: float = 0.99,
) -> DataFrame:
    """Compare each candidate with the segment's production model and derive the next stage.

    A missing RMSE counts as infinite. Candidates that pass go to Staging; the best of them
    becomes Production and the old production model is archived. ``metrics`` has a row per model,
    so a segment is small.
    """
    inf = F.lit(float("inf"))
    own = F.coalesce(F.col(rmse), inf)
    here = W.partitionBy(segment)
    is_prod = F.col(stage) == "Production"
    prod = F.coalesce(F.min(F.when(is_prod, own)).over(here), inf)
    passed = F.col("decision").isin("STRONG_IMPROVEMENT", "SLIGHT_IMPROVEMENT")
    winner = F.min(F.when(F.col("promote"), F.struct(own.alias("rmse"), F.col(version).alias("version")))).over(here)
    return (
        metrics.withColumn("production_rmse", prod)
        .withColumn(
            "decision",
            F.when(is_prod, "CHAMPION")
            .when(own < F.col("production_rmse") * strong, "STRONG_IMPROVEMENT")
            .when(own < F.col("production_rmse") * slight, "SLIGHT_IMPROVEMENT")
            .otherwise("NO_IMPROVEMENT"),
        )
        .withColumn("promote", passed)
        .withColumn("_winner", winner)
        .withColumn(
            "new_stage",
            F.when(is_prod & F.col("_winner").isNotNull(), "Archived")
            .when(F.col("promote") & (F.col("_winner.version") == F.col(version)), "Production")
            .when(F.col("promote"), "Staging")
            .otherwise(F.col(stage)),
        )
        .drop("_winner")
    )


def revenue_projection(
    df: DataFrame,
    demand: str = "predicted_demand",
    drivers: str = "active_drivers",
    multiplier: str = "pricing_multiplier",
    fare: float = 5.0,
    horizon_h: float = 1.0,
    capacity: float = 3.0,
) -> DataFrame:
    """Rides that can be completed, revenue, and the balance of demand and supply. Completed rides
    never exceed demand, so the over-staffed verdict cannot come up; it is kept as it is stated."""
    scaled = F.col("predicted_demand_scaled")
    done = F.col("estimated_completed_rides")
    ratio = F.when(scaled > 0, done / scaled).otherwise(1.0)
    return (
        df.withColumn("predicted_demand_scaled", F.col(demand) * (horizon_h / 0.25))
        .withColumn("estimated_completed_rides", F.least(scaled, F.col(drivers) * capacity))
        .withColumns(
            {
                "projected_revenue": done * fare * F.col(multiplier),
                "operational_insight": F.when(ratio < 0.7, "DEMAND_SURPLUS_UNDER_STAFFED")
                .when(ratio > 1.2, "SUPPLY_SURPLUS_OVER_STAFFED")
                .otherwise("OPTIMAL_BALANCE"),
            }
        )
    )


def demand_impact(
    df: DataFrame,
    elasticity: DataFrame,
    key: Sequence[str],
    demand: str,
    price_change: str,
    seed: float = -0.8,
) -> DataFrame:
    """Demand after a relative price change; keys without an estimate use the seed."""
    eta = F.coalesce(F.col("elasticity"), F.lit(seed))
    return df.join(elasticity.select(*key, "elasticity"), list(key), "left").withColumns(
        {
            "elasticity": eta,
            "expected_demand": F.col(demand) * (1 + eta * F.col(price_change)),
        }
    )


def ensemble_confidence(
    preds: DataFrame,
    request: str,
    prediction: str = "prediction",
    hist_std: float = 5.0,
    level: float = 0.7,
) -> DataFrame:
    """Confidence per request from the spread (interquartile range) of its models' answers.

    ``preds`` has one row per request and model; a group is as large as the ensemble.
    """
    spread = F.percentile(prediction, F.array(F.lit(0.25), F.lit(0.75)))
    n, iqr = F.col("n_models"), F.col("_q")[1] - F.col("_q")[0]
    few = n < 2
    score = F.greatest(F.lit(0.0), 1.0 - F.least(F.lit(1.0), iqr / (hist_std * 2)))
    return (
        preds.groupBy(request)
        .agg(F.count(prediction).alias("n_models"), spread.alias("_q"))
        .withColumn("confidence_score", F.when(few, 0.5).otherwise(score))
        .withColumns(
            {
                "confidence_level": F.when(few, "MEDIUM").otherwise(
                    confidence_level(F.col("confidence_score"), level)
                ),
                "prediction_spread": F.when(few, 0.0).otherwise(iqr),
            }
        )
        .drop("_q")
    )


def ensemble_average(
    preds: DataFrame,
    request: str,
    weights: Mapping[str, float] | None = None,
    model: str = "model",
    prediction: str = "prediction",
    on_missing: str = "zero",
) -> DataFrame:
    """Weighted mean of the models' answers, weights normalised (equal when none are given).

    A failed model (null) counts as 0 with ``on_missing="zero"``; ``"renormalise"`` leaves it out
    of the weights too. Models without a weight do not take part.
    """
    if weights is None:
        w: Column = F.lit(1.0)
    else:
        w = F.coalesce(*[F.when(F.col(model) == m, F.lit(float(x))) for m, x in weights.items()], F.lit(0.0))
    answer = F.coalesce(F.col(prediction), F.lit(0.0))
    share = w if on_missing == "zero" else F.when(F.col(prediction).isNotNull(), w).otherwise(0.0)
    total = F.sum(share)
    mean = F.when(total > 0, F.sum(share * answer) / total).otherwise(0.0)
    return preds.groupBy(request).agg(mean.alias("ensemble_prediction"))


def ab_route(
    df: DataFrame,
    key: str,
    shares: Mapping[str, float] | None = None,
    champion: str = "Production",
    name: str = "model_version",
) -> DataFrame:
    """Route by a stable hash of the key: each named version gets its share, the rest goes to the
    champion. Shares count in steps of 2 ** -32. Default: a tenth to Staging."""
    shares = {"Staging": 0.1} if shares is None else shares
    slot = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    picked, reach = F.lit(champion), 0.0
    choice: Column | None = None
    for version, share in shares.items():
        if not version or share <= 0:
            continue
        reach += share
        hit = slot < round(reach * 2**32)
        choice = F.when(hit, version) if choice is None else choice.when(hit, version)
    if choice is not None:
        picked = choice.otherwise(champion)
    return df.withColumn(name, picked)
