"""Exact distribution statistics over many columns: quantiles, KS, Wasserstein.

KS and Wasserstein need values in order over the whole table. Equal values are counted first (a partial
aggregate, so a value that fills a third of the rows costs one row), then the distinct values are
range-partitioned once, and running counts are finished inside each range with a carry row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidegrid.operators.chunks import CHUNK, KIND, RUNNING, add_carry, range_chunks

DRIFT_ALPHA = 0.05
DRIFT_DISTANCE = 0.1


def long_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One (feature, value) row per column and row, nulls and NaN left out per feature."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    )
    return df.select(F.inline(pairs)).filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def running_counts(counts: DataFrame, names: Sequence[str], parts: int | None = None) -> DataFrame:
    """From one row per (feature, value) with counts ``names``: add ``cum_<name>`` (up to and with
    the value), ``total_<name>`` and ``next_value`` of the feature."""
    rows = range_chunks(counts.select("feature", "value", *names), ["feature", "value"], parts)
    chunk_order = W.partitionBy("feature").orderBy(CHUNK)
    earlier = chunk_order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("feature")
    sums = rows.groupBy("feature", CHUNK).agg(
        *[F.sum(n).alias(n) for n in names], F.min("value").alias("first_value")
    )
    carry = sums.select(
        "feature",
        CHUNK,
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names],
        *[F.sum(n).over(whole).alias(f"total_{n}") for n in names],
        F.lead("first_value").over(chunk_order).alias("next_first"),
    )
    order = W.partitionBy("feature", CHUNK).orderBy(KIND, "value")
    inside = order.rowsBetween(*RUNNING)
    return (
        add_carry(rows, carry)
        .withColumns(
            {f"cum_{n}": F.sum(n).over(inside) for n in names}
            | {f"total_{n}": F.max(f"total_{n}").over(inside) for n in names}
            | {
                "next_value": F.coalesce(
                    F.lead("value").over(order), F.max("next_first").over(inside)
                )
            }
        )
        .filter(F.col(KIND) == 1)
        .drop(KIND, CHUNK, "next_first")
    )


#: A bracket that should hold no more values than this is fetched and sorted.
FEW = 10_000
#: Values a sketch looks at, drawn at random: where it puts its marks decides how many scans there are, never
#: what comes out.
DRAWN = 200_000
DRAW = "__draw"
#: Marks a sketch puts into a bracket, and how many are left on either side of a rank: five standard
#: deviations of a draw.
MARKS = 1000
ASIDE = 1 + math.ceil(5 * 0.5 / math.sqrt(DRAWN) * MARKS)


class _Rank:
    """The value of one rank of a column, known to lie strictly between ``lo`` and ``hi`` (None: open)
    unless a count says otherwise. ``most`` bounds the values in between."""

    def __init__(self, rank: int, marks: Sequence[float], n: int):
        self.rank, self.n, self.value, self.lo, self.hi = rank, n, None, None, None
        self.narrow(marks, (rank + 0.5) / n, n)

    def narrow(self, marks: Sequence[float], share: float, inside: int) -> None:
        low, high = math.floor(share * MARKS) - ASIDE, math.ceil(share * MARKS) + ASIDE
        self.lo = marks[low] if low >= 0 else self.lo
        self.hi = marks[high] if high <= MARKS else self.hi
        self.most = inside * (2 * ASIDE + 1) / MARKS

    def inside(self, v: Column) -> Column:
        out = v.isNotNull()
        if self.lo is not None:
            out = out & (v > self.lo)
        return out & (v < self.hi) if self.hi is not None else out

    def asks(self, v: Column) -> list[Column]:
        none, own = F.lit(0).cast("long"), F.when(self.inside(v), v)
        return [
            none if self.lo is None else F.count_if(v < self.lo),
            none if self.lo is None else F.count_if(v <= self.lo),
            F.count(own),
            F.count(v) if self.hi is None else F.count_if(v <= self.hi),
            F.array_sort(F.collect_list(own)) if self.most <= FEW else _marks(own, self.most),
        ]

    def learn(self, under_lo: int, upto_lo: int, inside: int, upto_hi: int, values) -> None:
        """Take the value, or a better bracket, from the counts and the values or marks between."""
        if self.rank < under_lo:
            self.lo, self.hi, self.most = None, self.lo, self.n
        elif self.rank < upto_lo:
            self.value = self.lo
        elif self.rank < upto_lo + inside:
            if self.most <= FEW:
                self.value = values[self.rank - upto_lo]
            else:
                self.narrow(values, (self.rank + 0.5 - upto_lo) / inside, inside)
        elif self.rank < upto_hi:
            self.value = self.hi
        else:
            self.lo, self.hi, self.most = self.hi, None, self.n


def _marks(v: Column, n: float) -> Column:
    """Evenly spaced quantiles of about ``DRAWN`` of the ``n`` values."""
    drawn = v if n <= DRAWN else F.when(F.col(DRAW) < DRAWN / n, v)
    return F.percentile_approx(drawn, [i / MARKS for i in range(MARKS + 1)], 10_000)


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], kind: str = "linear"
) -> DataFrame:
    """Quantiles as (feature, prob, value): linear between neighbours, or with ``kind="inverse"`` the
    least value that at least the share ``prob`` of the values does not exceed.

    No sort of a column and no shuffle of rows. A sketch of a draw brackets each rank; one aggregate counts
    what lies below, at and between the ends of the bracket, which gives the value, a bracket some sixty
    times narrower, or (if the draw missed the rank) the other side. Once a bracket should hold few
    values they are fetched with the counts. All columns and probabilities share the scans: two up to
    some 600,000 rows (and a count of rows), one more for every factor of sixty.
    """
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    rows = df.count()  # a file scan answers this from its footers; values that are unknown only make the draw smaller
    df = df.select(*cols, F.rand(1).alias(DRAW))
    first = df.agg(*[F.count(value[c]) for c in cols], *[_marks(value[c], rows) for c in cols]).first()
    wanted, ranks = [], {}
    for i, c in enumerate(cols):
        n, marks = first[i], first[len(cols) + i]
        for p in map(float, probs if n else []):
            at = p * (n - 1) if kind == "linear" else max(0, math.ceil(round(p * n, 6)) - 1)
            low, high = math.floor(at), min(math.ceil(at), n - 1)
            wanted.append((c, p, low, high, at - low))
            for r in (low, high):
                ranks.setdefault((c, r), _Rank(r, marks, n))
    while todo := [(c, r) for (c, _), r in ranks.items() if r.value is None]:
        same: dict[tuple, list[_Rank]] = {}
        for c, r in todo:
            same.setdefault((c, r.lo, r.hi, r.most), []).append(r)
        got = df.agg(*[x for (c, *_), rs in same.items() for x in rs[0].asks(value[c])]).first()
        for i, rs in enumerate(same.values()):
            for r in rs:
                r.learn(*got[5 * i : 5 * i + 5])
    rows = [
        (c, p, ranks[c, low].value + w * (ranks[c, high].value - ranks[c, low].value)) for c, p, low, high, w in wanted
    ]
    return df.sparkSession.createDataFrame(rows, "feature string, prob double, value double")


def cdf_pair(cur: DataFrame, base: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Both empirical distributions of each feature over the union of their values. Features
    missing or empty on one side are left out."""
    shared = [c for c in cols if c in cur.columns and c in base.columns]
    both = (
        long_features(cur, shared)
        .withColumns({"cur": F.lit(1), "base": F.lit(0)})
        .unionByName(long_features(base, shared).withColumns({"cur": F.lit(0), "base": F.lit(1)}))
    )
    counts = both.groupBy("feature", "value").agg(
        F.sum("cur").alias("cur"), F.sum("base").alias("base")
    )
    gap = F.abs(
        F.col("cum_cur") / F.col("total_cur") - F.col("cum_base") / F.col("total_base")
    )
    return (
        running_counts(counts, ["cur", "base"])
        .filter((F.col("total_cur") > 0) & (F.col("total_base") > 0))
        .withColumn("gap", gap)
    )


def kolmogorov_p(z: Column, terms: int = 100) -> Column:
    """Upper tail of the Kolmogorov distribution, 2 * sum (-1)^(k-1) exp(-2 k^2 z^2)."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * z * z),
    )
    return F.when(z < 0.1, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


def _ks(alpha: float) -> dict[str, Column]:
    n, m = F.col("n_current"), F.col("n_baseline")
    p = kolmogorov_p(F.sqrt(n * m / (n + m)) * F.col("ks_statistic"))
    return {"ks_pvalue": p, "ks_drift_detected": p < alpha}


def _sizes() -> list[Column]:
    return [F.max("total_cur").alias("n_current"), F.max("total_base").alias("n_baseline")]


def ks_two_sample(
    cur: DataFrame, base: DataFrame, cols: Sequence[str], alpha: float = DRIFT_ALPHA
) -> DataFrame:
    """Two-sided Kolmogorov-Smirnov test per feature; the p-value is the asymptotic one."""
    per_feature = cdf_pair(cur, base, cols).groupBy("feature").agg(
        F.max("gap").alias("ks_statistic"), *_sizes()
    )
    return per_feature.withColumns(_ks(alpha))


def _area() -> list[Column]:
    return [
        F.sum(F.col("gap") * (F.col("next_value") - F.col("value"))).alias("_area"),
        (F.max("value") - F.min("value")).alias("_range"),
    ]


def _distance(limit: float) -> dict[str, Column]:
    area = F.coalesce(F.col("_area"), F.lit(0.0))
    scaled = F.when(F.col("_range") > 0, area / F.col("_range")).otherwise(0.0)
    return {
        "wasserstein_distance": area,
        "normalized_wasserstein_distance": scaled,
        "ws_drift_detected": scaled > limit,
    }


def wasserstein_1d(
    cur: DataFrame, base: DataFrame, cols: Sequence[str], limit: float = DRIFT_DISTANCE
) -> DataFrame:
    """Area between the two distributions per feature, and the same over the joint range."""
    per_feature = cdf_pair(cur, base, cols).groupBy("feature").agg(*_area(), *_sizes())
    return per_feature.withColumns(_distance(limit)).drop("_area", "_range")


def drift_report(
    cur: DataFrame,
    base: DataFrame,
    cols: Sequence[str],
    alpha: float = DRIFT_ALPHA,
    limit: float = DRIFT_DISTANCE,
) -> DataFrame:
    """Both tests from one pass, one row per feature, with a flag over the whole report."""
    per_feature = cdf_pair(cur, base, cols).groupBy("feature").agg(
        F.max("gap").alias("ks_statistic"), *_area(), *_sizes()
    )
    either = F.col("ks_drift_detected") | F.col("ws_drift_detected")
    return (
        per_feature.withColumns(_ks(alpha) | _distance(limit))
        .drop("_area", "_range")
        .withColumn("overall_drift_detected", either)
        .withColumn(
            "any_drift_detected", F.bool_or("overall_drift_detected").over(W.partitionBy(F.lit(1)))
        )
    )


def zscore_outlier(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """Add ``<col>_zscore`` and ``is_outlier`` (any of them beyond ``k`` in size)."""
    fitted = df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in cols], *[F.stddev_samp(c).alias(f"{c}_std") for c in cols]
    )
    row = fitted.select(F.struct(*fitted.columns)).scalar()
    scores = {
        f"{c}_zscore": (F.col(c) - F.col(f"_s.`{c}_mean`")) / F.col(f"_s.`{c}_std`") for c in cols
    }
    hit = F.lit(False)
    for c in cols:
        hit = hit | (F.abs(F.col(f"{c}_zscore")) > k)
    return (
        df.withColumn("_s", row)
        .withColumns(scores)
        .withColumn("is_outlier", F.coalesce(hit, F.lit(False)))
        .drop("_s")
    )
