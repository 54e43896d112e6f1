"""From a feature table to a scored forecaster."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tidegrid.operators.decide import champion_vs_candidate
from tidegrid.operators.history import upsert_table
from tidegrid.operators.learn import score_batch, train_forecaster
from tidegrid.operators.lookback import split_train_test
from tidegrid.operators.monitor import model_metrics


def train_and_evaluate(
    features: DataFrame,
    cols: Sequence[str],
    label: str,
    key: Sequence[str],
    ts: str,
    params: Mapping[str, Any] | None = None,
    test: float = 0.2,
    order: str = "time",
) -> tuple[PipelineModel, DataFrame]:
    """Split at an exact row, train on the first part, measure on the last."""
    split = split_train_test(features, key, ts, test, order)
    model = train_forecaster(split.filter("NOT is_test"), cols, label, params)
    scored = score_batch(split.filter("is_test"), model)
    return model, model_metrics(scored, label, "predicted")


def promote_stages(
    metrics: DataFrame, registry: str, segment: str = "segment", version: str = "version", stage: str = "stage"
) -> DataFrame:
    """Decide the next stage of every model and write it into the registry table at ``registry``
    (partitioned by segment; segments without new metrics stay as they are). Returns the decisions."""
    decided = champion_vs_candidate(metrics, segment, version, stage)
    now = decided.drop(stage).withColumnRenamed("new_stage", stage)
    upsert_table(registry, now.select(*metrics.columns), [segment, version], segment)
    return decided
