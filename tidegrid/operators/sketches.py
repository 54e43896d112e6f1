"""Drift from stored sketches: one KLL sketch per feature and day, merged over any period.

The exact report (``distribution.drift_report``) reads all rows of both periods each time. Here each day's rows are read once,
when the day is written; a report over any two periods reads some kilobytes per feature and day and says how far
it may be off. Sketches are built by partial aggregates, so a day or feature with most of the rows is no group anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Size of a sketch; its ranks are off by at most ``rank_error(K)``, with a confidence of 99 %.
K = 2048
#: Equal shares into which either side is cut to compare them.
MARKS = 1000
SKETCHES = "feature string, n long, low double, high double, sketch binary, day date"


def rank_error(k: int) -> float:
    """Published normalised rank error of a KLL sketch (both sides, 99 %)."""
    return 2.446 / k**0.9433


def day_sketches(df: DataFrame, cols: Sequence[str], ts: str, k: int = K, unit: str = "day") -> DataFrame:
    """``feature, n, low, high, sketch, day`` of the known values; rows without a time are of no day and left out. With another
    ``unit`` (week, month) ``day`` is its first."""
    by_day = df.filter(F.col(ts).isNotNull()).withColumn("_day", F.to_date(F.date_trunc(unit, ts)))
    values = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    rows = by_day.select(F.col("_day").alias("day"), F.inline(values)).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return rows.groupBy("feature", "day").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.kll_sketch_agg_double("value", k).alias("sketch"),
    ).select("feature", "n", "low", "high", "sketch", "day")


def write_sketches(df: DataFrame, cols: Sequence[str], ts: str, path: str, k: int = K, unit: str = "day") -> None:
    """Write the sketches of the days in ``df`` to the table at ``path``, a file each; other days stay as they are."""
    day_sketches(df, cols, ts, k, unit).repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_sketches(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Sketches of the days from ``first`` to ``last``; no other day's files are read."""
    return spark.read.schema(SKETCHES).parquet(path).filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def merged(sketches: DataFrame, k: int = K) -> DataFrame:
    """One sketch per feature."""
    return sketches.groupBy("feature").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )


def sketched_drift(current: DataFrame, baseline: DataFrame, k: int = K, marks: int = MARKS) -> DataFrame:
    """Kolmogorov-Smirnov statistic and Wasserstein distance of two periods per feature, from their sketches.

    Each side is taken as its values at the middle of ``marks`` equal shares, and these are compared exactly (a window over at most
    ``2 * marks`` rows of a feature). ``ks_error`` bounds how far the statistic, and the distance over the joint range, are
    off: half a share and the error of a rank on either side. Features without values on one side are left out.
    """
    ranks = F.array(*[F.lit((i + 0.5) / marks) for i in range(marks)])

    def side(df: DataFrame, name: str) -> DataFrame:
        return merged(df, k).select(
            "feature", F.col("n").alias(f"n_{name}"), F.col("low").alias(f"low_{name}"), F.col("high").alias(f"high_{name}"),
            F.kll_sketch_get_quantile_double("sketch", ranks).alias(f"marks_{name}"),
        )

    both = side(current, "current").join(side(baseline, "baseline"), "feature")
    one = lambda name, up: F.transform(
        f"marks_{name}", lambda v: F.struct(v.alias("value"), F.lit(up).alias("up"))
    )
    sizes = both.select(
        "feature", "n_current", "n_baseline",
        (F.greatest("high_current", "high_baseline") - F.least("low_current", "low_baseline")).alias("_span"),
    )
    order = W.partitionBy("feature").orderBy("value")
    steps = (
        both.select("feature", F.inline(F.concat(one("current", 1), one("baseline", -1)))).groupBy("feature", "value").agg(F.sum("up").alias("up"))
        .withColumn("gap", F.abs(F.sum("up").over(order)) / marks).withColumn("width", F.lead("value").over(order) - F.col("value"))
    )
    found = steps.groupBy("feature").agg(
        F.max("gap").alias("ks_statistic"), F.coalesce(F.sum(F.col("gap") * F.col("width")), F.lit(0.0)).alias("wasserstein_distance")
    )
    scaled = F.when(F.col("_span") > 0, F.col("wasserstein_distance") / F.col("_span")).otherwise(0.0)
    return sizes.join(found, "feature").select(
        "feature", "n_current", "n_baseline", "ks_statistic", "wasserstein_distance", scaled.alias("normalized_wasserstein_distance"),
        F.lit(2 * rank_error(k) + 1 / marks).alias("ks_error"),
    )
