"""Ways to run ordered computations over a key without ever holding the whole key in one task.

One key may own a third of all rows, and most of them in one hour, so a window over the bare key,
or over a day of it, is not safe on raw rows. The helpers here split keys by size and make each
piece exact on its own:

* **range chunks** - range partitions of the order (key, time, tie), fixed once by a durable copy:
  a chunk has about the same number of rows wherever the data is dense;
* **carry row** - a running value needs one number from all chunks before it. That number comes
  from a table of one row per key and chunk, and is put in front of the chunk as an extra row, so
  no join is needed and null keys behave like any other key;
* **row blocks** - a window over the last n rows needs only the tail of the block before it, so
  those rows are copied into the next block and thrown away afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidegrid.session import durable

MICROS = 1_000_000

CHUNK = "_chunk"
KIND = "_kind"  # 0 carry row, 1 data row
HOME = "_home"

RUNNING = (W.unboundedPreceding, W.currentRow)


def micros_of(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def add_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Union data rows with one carry row per chunk; sort by ``_kind`` first to see it first."""
    return rows.withColumn(KIND, F.lit(1)).unionByName(
        carry.withColumn(KIND, F.lit(0)), allowMissingColumns=True
    )


def number_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Add ``_rn``, the exact 1-based position of a row inside its key.

    Rows lie in range chunks, so how dense a key is does not matter. Chunk sizes are counted with a
    partial aggregate; their prefix sums (one row per key and chunk) become the carry rows.
    """
    rows = range_chunks(df, [*key, *order], parts)
    before = F.sum("_w").over(
        W.partitionBy(*key).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    )
    carry = (
        rows.groupBy(*key, CHUNK)
        .agg(F.count(F.lit(1)).alias("_w"))
        .withColumn("_w", F.coalesce(before, F.lit(0)))
    )
    inside = W.partitionBy(*key, CHUNK).orderBy(KIND, *order).rowsBetween(*RUNNING)
    return (
        add_carry(rows.withColumn("_w", F.lit(1).cast("long")), carry)
        .withColumn("_rn", F.sum("_w").over(inside))
        .filter(F.col(KIND) == 1)
        .drop(KIND, CHUNK, "_w")
    )


def row_blocks(df: DataFrame, back: int, size: int = 10_000) -> DataFrame:
    """Cut numbered rows into blocks of ``size``; the last ``back`` rows of a block are repeated
    in front of the next one (``_home`` false there)."""
    size = max(size, 2 * back + 1)
    zero = F.col("_rn") - 1
    block = ((zero - zero % size) / size).cast("long")
    tail = zero % size >= size - back
    copies = F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))
    return (
        df.withColumns({"_own": block, "_all": copies})
        .select(*df.columns, "_own", F.explode("_all").alias("_block"))
        .withColumn(HOME, F.col("_block") == F.col("_own"))
        .drop("_own")
    )


def range_chunks(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Range-partition by ``order`` and keep the partition number as ``_chunk``.

    Bounds are sampled, so the result is written once; later branches read the copy.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn(CHUNK, F.spark_partition_id())
    return durable(ranged)


def global_rank(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Add ``_rank``, the 1-based position in the order of the whole table. ``order`` must be
    unique per row. The only unpartitioned window runs over one row per range partition."""
    rows = range_chunks(df, order, parts)
    before = F.sum("_w").over(W.orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1))
    carry = (
        rows.groupBy(CHUNK)
        .agg(F.count(F.lit(1)).alias("_w"))
        .withColumn("_w", F.coalesce(before, F.lit(0)))
    )
    inside = W.partitionBy(CHUNK).orderBy(KIND, *order).rowsBetween(*RUNNING)
    return (
        add_carry(rows.withColumn("_w", F.lit(1).cast("long")), carry)
        .withColumn("_rank", F.sum("_w").over(inside))
        .filter(F.col(KIND) == 1)
        .drop(KIND, CHUNK, "_w")
    )
