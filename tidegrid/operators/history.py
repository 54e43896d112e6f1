"""History tables: append, upsert, sort, sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.session import durable


def append_history(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def upsert_keep_last(
    old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """One row per key, the newest batch wins; ``order`` decides inside one batch. A partial
    aggregate, so copies of one key are merged before the shuffle."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(
        new.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    rest = [c for c in both.columns if c not in (*key, "_batch")]
    last = F.max_by(F.struct(*rest), F.struct("_batch", *order)).alias("_last")
    return both.groupBy(*key).agg(last).select(*key, "_last.*")


def upsert_table(path: str, new: DataFrame, key: Sequence[str], date_col: str) -> None:
    """Upsert into a table partitioned by ``date_col``; only partitions that ``new`` touches are
    read and rewritten. The merged rows are made durable before the overwrite."""
    spark = new.sparkSession
    new = durable(new)
    days = new.select(date_col).distinct()
    try:
        old = spark.read.parquet(path)
    except AnalysisException as e:  # the first batch finds no table
        if "PATH_NOT_FOUND" not in str(e):
            raise
        merged = upsert_keep_last(new.limit(0), new, key)
    else:
        touched = old.join(days, date_col, "left_semi")
        merged = durable(upsert_keep_last(touched, new, key))
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(path)
    )


def sort_features(
    df: DataFrame, key: Sequence[str], ts: str, parts: int | None = None
) -> DataFrame:
    """Global order by key, then time, as range partitions sorted inside: the files written from
    it are in order and none of them needs the whole table in one task."""
    cols = [*key, ts]
    ranged = df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def sample(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of exactly ``n`` rows: those with the smallest hash of key and seed."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
    return df.orderBy(F.md5(text)).limit(n)
