"""Ordered, per-key computations on raw rows. Every one splits a key into bounded pieces
(see ``chunks``), so a key with a third of all rows is still spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidegrid.operators.chunks import (
    CHUNK,
    HOME,
    KIND,
    MICROS,
    RUNNING,
    add_carry,
    micros_of,
    number_rows,
    range_chunks,
    row_blocks,
)
from tidegrid.session import durable

#: How many folded pieces are folded into one at a time.
FAN_IN = 256


def failed_access_streak(
    df: DataFrame,
    user: str,
    ts: str,
    ok: str,
    tie: Sequence[str] = (),
    limit: int = 3,
    parts: int | None = None,
) -> DataFrame:
    """Add ``failed_attempts`` (failures in a row up to this one, 0 on success) and ``alert``.

    The carry row of a chunk holds the failures still open when the chunk begins: the trailing
    failures of the chunks before it, back to the last one that saw a success.
    """
    good = F.coalesce(F.col(ok), F.lit(False))
    rows = range_chunks(df, [user, ts, *tie], parts).withColumn("_failed", F.when(good, 0).otherwise(1).cast("long"))
    inside = W.partitionBy(user, CHUNK).orderBy(KIND, ts, *tie).rowsBetween(*RUNNING)

    def counted(d: DataFrame) -> DataFrame:
        """Failures so far, and how many of them a success has already wiped out."""
        return d.withColumn("_fails", F.sum("_failed").over(inside)).withColumn(
            "_wiped", F.max(F.when(good & (F.col(KIND) == 1), F.col("_fails"))).over(inside)
        )

    chunk_order = W.partitionBy(user).orderBy(CHUNK)
    since_reset = W.partitionBy(user, "_resets").orderBy(CHUNK).rowsBetween(*RUNNING)
    carry = (
        counted(rows.withColumn(KIND, F.lit(1)))
        .groupBy(user, CHUNK)
        .agg(F.max("_fails").alias("_all"), F.max("_wiped").alias("_gone"))
        .withColumn("_tail", F.col("_all") - F.coalesce("_gone", F.lit(0)))
        .withColumn(
            "_resets",
            F.sum(F.col("_gone").isNotNull().cast("int")).over(chunk_order.rowsBetween(*RUNNING)),
        )
        .withColumn("_open", F.sum("_tail").over(since_reset))
        .select(user, CHUNK, F.coalesce(F.lag("_open").over(chunk_order), F.lit(0)).alias("_failed"))
    )
    streak = F.when(good, 0).otherwise(F.col("_fails") - F.coalesce("_wiped", F.lit(0)))
    return (
        counted(add_carry(rows, carry))
        .filter(F.col(KIND) == 1)
        .withColumn("failed_attempts", streak.cast("long"))
        .withColumn("alert", F.col("failed_attempts") >= limit)
        .drop(KIND, CHUNK, "_failed", "_fails", "_wiped")
    )


def elasticity(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    old_price: str,
    new_price: str,
    change: str,
    tie: Sequence[str] = (),
    seed: float = -0.8,
    lr: float = 0.01,
    lo: float = -2.5,
    hi: float = -0.1,
    block: int = 1024,
    parts: int | None = None,
) -> DataFrame:
    """Current price elasticity per key after all its price changes, in time order.

    One update is ``eta -> clamp(eta * (1 - lr) + lr * observed, lo, hi)``. Functions of the form
    ``clamp(a * eta + b, l, h)`` with ``a >= 0`` are closed under composition, so runs of updates
    fold to four numbers: first blocks of ``block`` rows of a range chunk, then ``FAN_IN`` of what
    came out at a time, over and over. No array grows with the key. Changes that are not known
    count for nothing.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ratio = (F.col(new_price) - F.col(old_price)) / F.col(old_price)
    usable = (F.col(old_price) != 0) & (F.col(new_price) != 0) & F.col(change).isNotNull()
    steps = (
        range_chunks(
            df.filter(usable)
            .withColumn("_ratio", ratio)
            .filter(F.col("_ratio") != 0)
            .select(*key, ts, *tie, (F.lit(lr) * F.col(change) / F.col("_ratio")).alias("_b")),
            [*key, ts, *tie],
            parts,
        )
        .withColumn("_rn", F.row_number().over(W.partitionBy(*key, CHUNK).orderBy(ts, *tie)))
        .withColumn("_block", ((F.col("_rn") - 1) / block).cast("long"))
    )
    keep = 1.0 - lr

    def clamp(x: Column, low, high) -> Column:
        return F.greatest(low, F.least(high, x))

    def then_step(f: Column, s: Column) -> Column:
        x = s["b"]
        return F.struct(
            (f["a"] * keep).alias("a"),
            (f["b"] * keep + x).alias("b"),
            clamp(f["l"] * keep + x, F.lit(lo), F.lit(hi)).alias("l"),
            clamp(f["h"] * keep + x, F.lit(lo), F.lit(hi)).alias("h"),
            (f["n"] + 1).alias("n"),
        )

    def then_all(f: Column, g: Column) -> Column:
        return F.struct(
            (g["a"] * f["a"]).alias("a"),
            (g["a"] * f["b"] + g["b"]).alias("b"),
            clamp(g["a"] * f["l"] + g["b"], g["l"], g["h"]).alias("l"),
            clamp(g["a"] * f["h"] + g["b"], g["l"], g["h"]).alias("h"),
            (f["n"] + g["n"]).alias("n"),
        )

    nothing = F.struct(
        F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), F.lit(float("-inf")).alias("l"),
        F.lit(float("inf")).alias("h"), F.lit(0).cast("long").alias("n"),
    )

    def fold(level: DataFrame, by: Sequence[str], order: str) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("_f").alias("f"))))
        whole = F.aggregate(
            F.slice("_parts", 2, F.size("_parts")), F.col("_parts")[0]["f"],
            lambda acc, p: then_all(acc, p["f"]),
        )
        return level.groupBy(*by).agg(parts.alias("_parts")).select(*by, whole.alias("_f"))

    rows = F.array_sort(F.collect_list(F.struct(F.col("_rn").alias("o"), F.col("_b").alias("b"))))
    # A row per block, written once: its number of blocks and the levels above are read from it.
    blocks = durable(
        steps.groupBy(*key, CHUNK, "_block")
        .agg(rows.alias("_rows"))
        .select(*key, CHUNK, "_block", F.aggregate("_rows", nothing, then_step).alias("_f"))
    )
    # Chunks hold about the same number of rows, so a level more for every FAN_IN blocks or chunks.
    largest = blocks.agg(F.max("_block")).first()[0] or 0
    level = blocks
    while largest:
        level = fold(level.withColumn("_up", F.floor(F.col("_block") / FAN_IN)), [*key, CHUNK, "_up"], "_block")
        level, largest = level.withColumnRenamed("_up", "_block"), largest // FAN_IN
    level, chunks = level.drop("_block"), parts
    while chunks > 1:
        level = fold(level.withColumn("_up", F.floor(F.col(CHUNK) / FAN_IN)), [*key, "_up"], CHUNK)
        level, chunks = level.withColumnRenamed("_up", CHUNK), -(-chunks // FAN_IN)
    return level.select(
        *key,
        clamp(F.col("_f.a") * seed + F.col("_f.b"), F.col("_f.l"), F.col("_f.h")).alias("elasticity"),
        F.col("_f.n").alias("updates"),
    )


def flash_insight(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    seconds: int = 10,
    threshold: int = 5,
    tie: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Add ``pulse_count`` (events of the key in the trailing ``seconds``, both ends included),
    ``insight_level`` and, when CRITICAL, ``window_start`` (time of the oldest counted event).

    A sweep: each event enters at its time and leaves ``seconds`` later, running sums over enter and
    leave marks give the count, and the next event to leave is the oldest one inside. Cost does not
    grow with the events inside a window, and marks lie in range chunks. Rows without a time stand
    in no window: count 0, NORMAL.
    """
    timeless = df.filter(F.col(ts).isNull()).withColumns(
        {"pulse_count": F.lit(0).cast("long"), "insight_level": F.lit("NORMAL"), "window_start": F.col(ts)}
    )
    micros = micros_of(ts)
    events = df.filter(F.col(ts).isNotNull())
    enters = events.withColumns({"_at": micros, "_leaves": F.lit(0), "_w": F.lit(1).cast("long")})
    leaves = events.select(
        *key, (micros + F.lit(seconds * MICROS)).alias("_at"), F.lit(1).alias("_leaves"),
        F.lit(-1).cast("long").alias("_w"), F.col(ts).alias("_oldest"),
    )
    marks = range_chunks(enters.unionByName(leaves, allowMissingColumns=True), [*key, "_at", "_leaves"], parts)
    by_chunk = W.partitionBy(*key).orderBy(CHUNK)
    chunks = marks.groupBy(*key, CHUNK).agg(F.sum("_w").alias("_w"), F.min("_oldest").alias("_oldest"))
    carry = chunks.select(
        *key, CHUNK,
        F.coalesce(F.sum("_w").over(by_chunk.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_w"),
    )
    # The first to leave in the chunks behind, seen first when the chunk is read backwards.
    behind = W.partitionBy(*key).orderBy(F.col(CHUNK).desc()).rowsBetween(W.unboundedPreceding, -1)
    later = chunks.select(*key, CHUNK, F.min("_oldest").over(behind).alias("_oldest"), F.lit(2).alias(KIND))
    rows = add_carry(marks, carry).unionByName(later, allowMissingColumns=True)
    own = W.partitionBy(*key, CHUNK)
    forward = own.orderBy(KIND, "_at", "_leaves").rangeBetween(*RUNNING)
    backward = own.orderBy(F.col(KIND).desc(), F.col("_at").desc(), F.col("_leaves").desc()).rowsBetween(*RUNNING)
    critical = F.col("pulse_count") >= threshold
    return (
        rows.withColumns({
            "pulse_count": F.sum("_w").over(forward),
            "window_start": F.last("_oldest", ignorenulls=True).over(backward),
        })
        .filter((F.col(KIND) == 1) & (F.col("_leaves") == 0))
        .withColumn("insight_level", F.when(critical, "CRITICAL").otherwise("NORMAL"))
        .withColumn("window_start", F.when(critical, F.col("window_start")))
        .select(*df.columns, "pulse_count", "insight_level", "window_start")
        .unionByName(timeless)
    )


def rolling_outlier(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    value: str,
    n: int = 100,
    contamination: float = 0.05,
    tie: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Add ``is_outlier``: outside the middle ``1 - contamination`` of the key's last ``n`` values
    (this one included); false until ``n`` values are there."""
    numbered = number_rows(df, key, [ts, *tie], parts)
    frame = W.partitionBy(*key, "_block").orderBy("_rn").rowsBetween(-(n - 1), 0)
    current = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    full = F.col("_rn") >= n

    def bound(p: float) -> Column:
        """Linear quantile of the sorted frame of exactly ``n`` values."""
        low = int(p * (n - 1))
        a, b = F.col("_q")[low], F.col("_q")[min(low + 1, n - 1)]
        return F.when(full, a + (b - a) * (p * (n - 1) - low))

    return (
        row_blocks(numbered, n - 1)
        .withColumn("_v", current)
        .withColumn("_frame", F.collect_list("_v").over(frame))
        .filter(HOME)
        .withColumn("_q", F.when(full, F.sort_array("_frame")))
        .withColumns(
            {
                "lower_bound": bound(contamination / 2),
                "upper_bound": bound(1 - contamination / 2),
            }
        )
        .withColumn(
            "is_outlier",
            full & ((F.col("_v") < F.col("lower_bound")) | (F.col("_v") > F.col("upper_bound"))),
        )
        .drop("_v", "_q", "_frame", "_rn", "_block", HOME)
    )


def confidence_level(score: Column, level: float) -> Column:
    return (
        F.when(score >= level, "HIGH").when(score < 1.0 - level, "LOW").otherwise("MEDIUM")
    )


def recent_error_confidence(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    error: str,
    n: int = 20,
    hist_std: float = 5.0,
    level: float = 0.7,
    tie: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Confidence in a prediction from the spread of the key's ``n`` errors before it. Fewer than
    five give 0.5 and MEDIUM. The score passes 1 when the spread is small."""
    numbered = number_rows(df, key, [ts, *tie], parts)
    frame = W.partitionBy(*key, "_block").orderBy("_rn").rowsBetween(-n, -1)
    enough = F.col("_n") >= 5
    score = F.greatest(
        F.lit(0.0), 1.0 - F.least(F.lit(1.0), F.col("_std") / hist_std - 0.5)
    )
    return (
        row_blocks(numbered, n)
        .withColumns({"_n": F.count(error).over(frame), "_std": F.stddev_pop(error).over(frame)})
        .filter(HOME)
        .withColumn("confidence_score", F.when(enough, score).otherwise(0.5))
        .withColumns(
            {
                "confidence_level": F.when(
                    enough, confidence_level(F.col("confidence_score"), level)
                ).otherwise("MEDIUM"),
                "error_variability": F.when(enough, F.col("_std")).otherwise(hist_std),
            }
        )
        .drop("_n", "_std", "_rn", "_block", HOME)
    )


def entity_state(
    df: DataFrame,
    entity: str,
    component: str,
    value: str,
    ts: str,
    as_of=None,
    ttl_s: int = 300,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Latest value per (entity, component) as one map per entity, for entities updated at most
    ``ttl_s`` before ``as_of`` (default: the newest time in ``df``)."""
    if as_of is None:
        now = df.agg(F.max(ts).alias("now")).scalar()
    else:
        now = F.lit(as_of).cast(df.schema[ts].dataType)
    known = df if as_of is None else df.filter(F.col(ts) <= now)
    latest = known.groupBy(entity, component).agg(
        F.max_by(value, F.struct(ts, *tie)).alias("_v"), F.max(ts).alias("_ts")
    )
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_update").cast("timestamp"))
    return (
        latest.groupBy(entity)
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct(component, "_v")))).alias("state"),
            F.max("_ts").alias("last_update"),
        )
        .filter(age <= ttl_s * MICROS)
    )


def recent_history(
    df: DataFrame, ts: str, limit: int = 10, by: Sequence[str] | None = None, tie: Sequence[str] = ()
) -> DataFrame:
    """The newest ``limit`` rows, overall or per ``by``. Both forms keep only ``limit`` rows per
    task before anything is shuffled."""
    newest = [F.col(c).desc() for c in (ts, *tie)]
    if not by:
        return df.orderBy(*newest).limit(limit)
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*newest))
    return df.withColumn("_r", rank).filter(F.col("_r") <= limit).drop("_r")
