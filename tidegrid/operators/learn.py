"""Forecaster training, scoring, importance, search, attribution, and the isolation forest."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidegrid.operators.boost import Trial, as_spark_model, grow
from tidegrid.operators.chunks import CHUNK, range_chunks
from tidegrid.operators.distribution import exact_quantiles
from tidegrid.operators.monitor import metric_columns
from tidegrid.session import durable, scratch_path

# Training parameters of the forecaster; rows and columns are drawn once per tree.
FORECASTER = {
    "maxIter": 500,
    "stepSize": 0.05,
    "maxDepth": 6,
    "subsamplingRate": 0.7,
    "columnShare": 0.7,
    "seed": 42,
}


def _trial(params: Mapping[str, Any]) -> Trial:
    p = {**FORECASTER, **params}
    unknown = set(p) - set(FORECASTER)
    if unknown:
        raise ValueError(f"unknown training parameters: {sorted(unknown)}")
    return Trial(
        int(p["maxIter"]), float(p["stepSize"]), int(p["maxDepth"]), float(p["subsamplingRate"]), float(p["columnShare"]), int(p["seed"])
    )


def train_forecaster(
    df: DataFrame, cols: Sequence[str], label: str, params: Mapping[str, Any] | None = None
) -> PipelineModel:
    """Squared-error boosted trees over numeric columns. ``params`` overrides the defaults.

    Trees grow from shared histograms (``boost``); the model is Spark ML's own, so it is saved, loaded and scored as such.
    """
    trial, spark = _trial(params or {}), df.sparkSession
    edges, start = grow(df, cols, label, [trial])
    model = as_spark_model(spark, trial, edges, start, "_features", label, "predicted")
    return PipelineModel([VectorAssembler(inputCols=list(cols), outputCol="_features", handleInvalid="keep"), model])


def save_forecaster(model: PipelineModel, path: str) -> None:
    """Write the whole pipeline, replacing what ``path`` held."""
    model.write().overwrite().save(path)


def load_forecaster(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_batch(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``predicted``; works on streams as well."""
    return model.transform(df).drop("_features")


def feature_importance(model: PipelineModel, cols: Sequence[str], df: DataFrame) -> DataFrame:
    """Splits per feature over all trees, with the learner's gain-based importance beside it.

    Node data is read back from the saved model as a table; ``df`` only supplies the session.
    """
    spark = df.sparkSession
    learner = model.stages[-1]
    path = scratch_path(spark, "learner")
    learner.write().overwrite().save(path)
    gains = learner.featureImportances.toArray().tolist()
    names = F.array(
        *[
            F.struct(
                F.lit(i).alias("featureIndex"), F.lit(c).alias("feature"), F.lit(g).alias("gain_share")
            )
            for i, (c, g) in enumerate(zip(cols, gains))
        ]
    )
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.split.featureIndex")
    splits = nodes.filter("featureIndex >= 0").groupBy("featureIndex").agg(
        F.count(F.lit(1)).alias("split_count")
    )
    return (
        spark.range(1).select(F.inline(names)).join(splits, "featureIndex", "left")
        .select("feature", F.coalesce("split_count", F.lit(0)).alias("split_count"), "gain_share")
    )


def permutation_importance(
    df: DataFrame, model: PipelineModel, cols: Sequence[str], label: str, key: Sequence[str],
    parts: int | None = None, seed: int = 42,
) -> DataFrame:
    """RMSE rise per feature when its values are swapped between rows.

    Rows stand in a circle by the hash of their key, and each takes the value of the row after it.
    They lie in range chunks; the last row of a chunk takes the first of the next, so the result
    does not depend on how many there are. All features are handled in one pass over rows times
    features.
    """
    donor = F.struct(*cols)
    rows = range_chunks(
        df.select(*key, *cols, label).withColumn("_h", F.xxhash64(*key, F.lit(seed))), ["_h", *key], parts
    )
    heads = rows.groupBy(CHUNK).agg(F.min_by(donor, F.struct("_h", *key)).alias("_head"))
    circle = W.orderBy(CHUNK)  # one row per chunk
    following = heads.select(
        CHUNK,
        F.coalesce(
            F.lead("_head").over(circle),
            F.first("_head").over(circle.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        ).alias("_following"),
    )
    order = W.partitionBy(CHUNK).orderBy("_h", *key)
    paired = rows.join(following, CHUNK).withColumn("_d", F.coalesce(F.lead(donor).over(order), F.col("_following")))
    swapped = F.explode(F.array(*[F.lit(c) for c in ("", *cols)])).alias("feature")
    probe = paired.select(label, *cols, "_d", swapped).select(
        label,
        "feature",
        *[F.when(F.col("feature") == c, F.col(f"_d.`{c}`")).otherwise(F.col(c)).alias(c) for c in cols],
    )
    scored = score_batch(probe, model).groupBy("feature").agg(*metric_columns(label, "predicted"))
    base = scored.filter("feature = ''").select("rmse").scalar()
    return scored.filter("feature <> ''").select("feature", "rmse", (F.col("rmse") - base).alias("rmse_rise"))


def draw_params(space: Mapping[str, Mapping[str, Any]], trials: int, seed: int) -> list[dict[str, Any]]:
    """Seeded draws: ``int`` (low, high, step), ``float`` (low, high, log), ``categorical``."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trials):
        p: dict[str, Any] = {}
        for name, s in space.items():
            if s["type"] == "int":
                step = s.get("step", 1)
                p[name] = int(s["low"] + step * rng.integers(0, (s["high"] - s["low"]) // step + 1))
            elif s["type"] == "float" and s.get("log"):
                p[name] = float(math.exp(rng.uniform(math.log(s["low"]), math.log(s["high"]))))
            elif s["type"] == "float":
                p[name] = float(rng.uniform(s["low"], s["high"]))
            else:
                p[name] = s["choices"][int(rng.integers(0, len(s["choices"])))]
        out.append(p)
    return out


def random_search(
    df: DataFrame, cols: Sequence[str], label: str, space: Mapping[str, Mapping[str, Any]],
    trials: int = 50, seed: int = 42, train_ratio: float = 0.8, params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Trials table (trial, params JSON, rounds, rmse, is_best) of random draws, validated on held-out rows.

    All trials grow together over one set of bins (``boost.grow``), so a pass over the rows serves all of them; each has all of
    its rounds. ``rmse`` is over the rows kept aside, the same for every trial. Of equals the first is best.
    """
    draws = draw_params(space, trials, seed)
    grown = [_trial({**(params or {}), **d}) for d in draws]
    grow(df, cols, label, grown, held_out=1.0 - train_ratio, seed=seed)
    scores = [t.errors[-1] for t in grown]
    best = int(np.argmin(scores))
    rows = [
        (i, json.dumps(d, sort_keys=True), len(t.trees), float(m), i == best) for i, (d, t, m) in enumerate(zip(draws, grown, scores))
    ]
    return df.sparkSession.createDataFrame(rows, "trial int, params string, rounds int, rmse double, is_best boolean")


#: Stands for no upper bound.
OPEN = 1 << 30


def _leaves(model: PipelineModel, df: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Leaves of all trees: value times the tree's weight, and for each feature tested on the way its index and the
    bounds of what passes, above ``low`` up to ``high``, as ranks among the feature's cuts; and the cuts of each feature.

    Node data is read back from the saved model. Rows are filled up with a feature that does not exist and always passes.
    """
    learner = model.stages[-1]
    path = scratch_path(df.sparkSession, "learner")
    learner.write().overwrite().save(path)
    nodes = df.sparkSession.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        "nodeData.split.featureIndex", "nodeData.split.numCategories",
        F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("cut"),
    ).collect()
    at = {(r.treeID, r.id): r for r in nodes}
    cuts = [np.unique([r.cut for r in nodes if r.leftChild >= 0 and r.featureIndex == f]).astype(float) for f in range(learner.numFeatures)]
    rank = [{c: i for i, c in enumerate(own.tolist())} for own in cuts]
    found: list[tuple[float, dict[int, tuple[int, int]]]] = []
    for tree, weight in enumerate(learner.treeWeights):
        todo: list[tuple[int, dict[int, tuple[int, int]]]] = [(0, {})]
        while todo:
            node, tested = todo.pop()
            r = at[tree, node]
            if r.leftChild < 0:
                found.append((weight * r.prediction, tested))
                continue
            if r.numCategories >= 0:
                raise ValueError("attribution needs numeric features; this model has categorical splits")
            low, high = tested.get(r.featureIndex, (-1, OPEN))
            at_cut = rank[r.featureIndex][r.cut]
            todo.append((r.leftChild, {**tested, r.featureIndex: (low, min(high, at_cut))}))
            todo.append((r.rightChild, {**tested, r.featureIndex: (max(low, at_cut), high)}))
    width = max(1, max(len(t) for _, t in found))
    if width > 12:
        raise ValueError(f"a leaf tests {width} features; its table has 2^{width} entries, which is kept to 2^12")
    feature = np.full((len(found), width), -1)
    low, high = np.full(feature.shape, -1), np.full(feature.shape, OPEN)
    for i, (_, tested) in enumerate(found):
        for j, (f, (lo, hi)) in enumerate(tested.items()):
            feature[i, j], low[i, j], high[i, j] = f, lo, hi
    return np.array([v for v, _ in found]), feature, low, high, cuts


def _passes(x: np.ndarray, feature: list[int], low: list[int], high: list[int]) -> np.ndarray:
    """Which tests of one leaf each row (a column of ranks) passes, one bit per test. Small whole numbers, so that a test of
    many rows is a few machine instructions."""
    kind = np.uint8 if len(feature) <= 8 else np.uint16
    bits, filled = np.zeros(x.shape[1], kind), 0
    for j, (f, a, b) in enumerate(zip(feature, low, high)):
        if f < 0 or (a < 0 and b == OPEN):
            filled |= 1 << j
        elif b == OPEN:
            bits |= (x[f] > a).view(np.uint8).astype(kind, copy=False) << kind(j)
        elif a < 0:
            bits |= (x[f] <= b).view(np.uint8).astype(kind, copy=False) << kind(j)
        else:
            bits |= ((x[f] > a) & (x[f] <= b)).view(np.uint8).astype(kind, copy=False) << kind(j)
    return (bits | kind(filled)).astype(np.int64)


def _shapley_weights(width: int) -> np.ndarray:
    """Shapley value of each test (last axis) in the game of one leaf of value 1, by the tests that the explained row
    (first axis) and the background row (second axis) pass."""
    codes = np.arange(1 << width)
    x, z = (codes[:, None] >> np.arange(width) & 1).astype(bool)[:, None], (codes[:, None] >> np.arange(width) & 1).astype(bool)[None]
    a, b = (x & ~z).sum(-1), (~x & z).sum(-1)
    fact = np.array([math.factorial(i) for i in range(width + 1)], float)
    alive = (x | z).all(-1)
    gain = np.where(alive & (a > 0), fact[np.maximum(a - 1, 0)] * fact[b] / fact[a + b], 0.0)
    loss = np.where(alive & (b > 0), fact[a] * fact[np.maximum(b - 1, 0)] / fact[a + b], 0.0)
    return gain[..., None] * (x & ~z) - loss[..., None] * (~x & z)


#: Rows that are held against the leaves at a time.
ROWS_AT_ONCE = 1 << 16


def _ranks(batches: Iterator[pd.DataFrame], cols: Sequence[str], cuts: list[np.ndarray]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches put together, and for each row (a column) the number of cuts of each feature below its value. Unknown values lie
    beyond all cuts, as the learner sends them right."""
    kind = np.uint8 if max(map(len, cuts)) < 255 else np.uint16 if max(map(len, cuts)) < 65_535 else np.int32

    def ranked(pdf):
        x = [pdf[c].to_numpy(dtype=float) for c in cols]
        return pdf, np.stack([np.where(np.isnan(v), len(cut) + 1, np.searchsorted(cut, v)) for v, cut in zip(x, cuts)]).astype(kind)

    waiting, n = [], 0
    for pdf in batches:
        waiting.append(pdf)
        n += len(pdf)
        if n >= ROWS_AT_ONCE:
            yield ranked(pd.concat(waiting, ignore_index=True))
            waiting, n = [], 0
    if n:
        yield ranked(pd.concat(waiting, ignore_index=True))


def attribution(
    df: DataFrame, model: PipelineModel, cols: Sequence[str], key: Sequence[str],
    background: DataFrame,
) -> DataFrame:
    """Additive contributions per feature: exact Shapley values of the trees against every background row.

    For the explained row and one background row, a leaf is a game whose Shapley values depend only on which of
    the leaf's tests either row passes. So one pass over the background counts, leaf by leaf, its rows by the tests they
    pass, and every explained row is held against these counts: the work is rows plus background times leaves, and nothing
    is drawn. Contributions sum to ``predicted - base_value``, the mean over the background, and a feature that no
    tree tests gets 0. The counts are bounded by the model (leaves times two to the power of the tests of a leaf).
    """
    n, cols = len(cols), list(cols)
    value, feature, low, high, cuts = _leaves(model, df)
    width = feature.shape[1]
    context = df.sparkSession.sparkContext
    tests = context.broadcast((feature.tolist(), low.tolist(), high.tolist()))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        feature, low, high = tests.value
        seen = np.zeros((len(feature), 1 << width), np.int64)
        for _, x in _ranks(batches, cols, cuts):
            for i in range(len(feature)):
                seen[i] += np.bincount(_passes(x, feature[i], low[i], high[i]), minlength=1 << width)
        leaf, passed = np.nonzero(seen)
        yield pd.DataFrame({"leaf": leaf, "passed": passed, "n": seen[leaf, passed]})

    doubles = lambda t, *more: t.select(*more, *[F.col(c).cast("double").alias(c) for c in cols])
    counts = doubles(background).mapInPandas(count, "leaf long, passed long, n long").groupBy("leaf", "passed").agg(F.sum("n").alias("n")).toPandas()
    share = np.zeros((len(feature), 1 << width))
    share[counts["leaf"].to_numpy(dtype=int), counts["passed"].to_numpy(dtype=int)] = counts["n"].to_numpy(dtype=float)
    share *= (value / np.maximum(share.sum(1), 1))[:, None]
    shares = context.broadcast(share)
    given = [f"_x{j}" for j in range(n)]
    out = [f"_c{j}" for j in range(n)]

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        feature, low, high = tests.value
        weights = _shapley_weights(width).transpose(1, 2, 0).reshape(1 << width, -1)  # by background pattern
        for pdf, x in _ranks(batches, given, cuts):
            total = np.zeros((n, len(pdf)))
            for i in range(len(feature)):
                table = (shares.value[i] @ weights).reshape(width, -1)
                passed = _passes(x, feature[i], low[i], high[i])
                for j, f in enumerate(feature[i]):
                    if f >= 0:
                        total[f] += table[j].take(passed)
            yield pdf.drop(columns=given).assign(**{c: total[j] for j, c in enumerate(out)})

    base = score_batch(background, model).agg(F.avg("predicted")).scalar()
    scored = score_batch(df.select(*dict.fromkeys([*key, *cols])), model).select(
        *key, "predicted", *[F.col(c).cast("double").alias(g) for c, g in zip(cols, given)]
    )
    kept = scored.select(*key, "predicted").schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{c} double" for c in out)])
    return scored.mapInPandas(explain, schema).select(
        *key, "predicted", base.alias("base_value"), *[F.col(o).alias(f"{c}_contribution") for o, c in zip(out, cols)]
    )


# --- isolation forest ----------------------------------------------------------------------------


def _mean_path(n: np.ndarray | float) -> np.ndarray | float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    full = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, full, np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, path): leaves have feature -1."""
    nodes: list[tuple] = []
    todo = [(0, np.arange(len(x)), 0)]
    following = 1
    while todo:
        node, rows, depth = todo.pop()
        lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth + float(_mean_path(len(rows)))))
            continue
        f = int(rng.choice(usable))
        cut = float(rng.uniform(lo[f], hi[f]))
        below = x[rows, f] < cut
        nodes.append((node, f, cut, following, following + 1, 0.0))
        todo += [(following, rows[below], depth + 1), (following + 1, rows[~below], depth + 1)]
        following += 2
    return nodes


def sample_per_tree(
    df: DataFrame, cols: Sequence[str], key: Sequence[str], trees: int, sample: int, seed: int
) -> DataFrame:
    """At most ``sample`` rows for each tree, by hash of the key: repeatable and independent of
    partitioning. A first draw thins the table to about twice what all trees need; only those
    rows are tested against every tree. Ranking keeps ``sample`` rows per tree and task before the
    shuffle."""
    n = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    unit = float(2**31)

    def uniform(*salt: Column) -> Column:
        return F.pmod(F.xxhash64(*key, *salt, F.lit(seed)), F.lit(2**31)) / unit

    pool_share = F.least(F.lit(1.0), F.lit(2.0 * sample * trees) / n)
    tree_share = F.least(F.lit(1.0), F.lit(2.0 * sample) / (n * pool_share))
    members = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: uniform(t) < F.col("_q")
    )
    rank = F.row_number().over(W.partitionBy("tree").orderBy(F.xxhash64(*key, "tree", F.lit(seed + 1)), *key))
    return (
        df.select(*key, *cols)
        .filter(uniform() < pool_share)
        .withColumn("_q", tree_share)
        .withColumn("tree", F.explode(members))
        .withColumn("_r", rank)
        .filter(F.col("_r") <= sample)
        .select("tree", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    )


def isolation_forest(
    df: DataFrame, cols: Sequence[str], key: Sequence[str], trees: int = 100, sample: int = 256,
    contamination: float = 0.05, seed: int = 42,
) -> DataFrame:
    """Add ``anomaly_score`` (near 1: isolated early) and ``is_outlier`` (the share
    ``contamination`` with the highest scores, cut at an exact rank).

    ``sample`` rows per tree are part of the model, as is their number; every row is scored.

    Trees grow in parallel, one group of at most ``sample`` rows each. The grown forest has at
    most ``trees * 2 * sample`` nodes whatever the table size; it is shipped to the scoring tasks.
    """
    cols = list(cols)
    limit = max(1, math.ceil(math.log2(max(sample, 2))))
    node_schema = "tree int, n long, node int, feature int, threshold double, left int, right int, path double"

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf[cols].to_numpy(dtype=float)
        x = x[np.lexsort(x.T[::-1])]
        nodes = _grow(x, np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "path"])
        out.insert(0, "tree", tree)
        out.insert(1, "n", len(x))
        return out

    forest = (
        sample_per_tree(df, cols, key, trees, sample, seed)
        .groupBy("tree").applyInPandas(grow, node_schema).toPandas()
    )
    grown = []
    for _, t in forest.sort_values(["tree", "node"]).groupby("tree"):
        grown.append(tuple(t[c].to_numpy() for c in ("feature", "threshold", "left", "right", "path")))
    typical = float(_mean_path(float(forest.groupby("tree")["n"].first().mean()))) if len(forest) else 1.0
    shipped = df.sparkSession.sparkContext.broadcast(grown)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for series in batches:
            x = np.column_stack([s.to_numpy(dtype=float) for s in series])
            total = np.zeros(len(x))
            rows = np.arange(len(x))
            for feature, threshold, left, right, path in shipped.value:
                at = np.zeros(len(x), dtype=np.int64)
                for _ in range(limit):
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    below = x[rows, np.maximum(f, 0)] < threshold[at]
                    at = np.where(inner, np.where(below, left[at], right[at]), at)
                total += path[at]
            mean = total / max(len(shipped.value), 1)
            yield pd.Series(np.power(2.0, -mean / max(typical, 1e-9)))

    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]
    # Written once: the cut and the result both read the scores, and scoring is the costly part.
    scored = durable(df.withColumn("anomaly_score", score(*filled)))
    cut = exact_quantiles(scored, ["anomaly_score"], [1.0 - contamination], "inverse").first()
    return scored.withColumn("is_outlier", F.col("anomaly_score") > (cut["value"] if cut else 1.0))
