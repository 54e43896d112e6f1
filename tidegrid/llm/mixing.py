"""Mixing sources to target weights with hash-threshold histograms (built-in functions only).

Every document gets a stable 48-bit hash of its id. A source's share is met by taking all documents
some whole number of times and, once more, those whose hash lies below a cut. The cut is found
without sorting documents: sizes are summed by source and the 12 leading hash bits, the bucket in
which the running total crosses the budget is the boundary bucket, and only its rows are summed
again by the next 12 bits, four times in all. Then the cut is a single hash value and choosing
documents is a filter. The result depends on ids, sources and texts alone, so reruns agree.

Defined cases: a null text has size 0; a null id hashes like the empty text; a null source is a
source of its own and comes last; rows that share an id share its fate; an empty table gives no
rows; further columns, whatever their names, pass through ``apply_mix`` untouched unless they bear the
names of its four results, which replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidegrid.session import durable

BITS, LEVELS = 12, 4
#: Tables with a row per source are broadcast up to this many rows (about 10 MB), else joined by shuffle.
BROADCAST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"
BIG = "decimal(38,0)"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def hash48(doc_id: Column) -> Column:
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 12)
    return F.conv(digits, 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Share of each source: ``source, source_size`` gains ``target``.

    Weights repeat over the sources by code point, null last. A share stops at ``cap`` times its
    source; the excess goes to the others by weight until none is above. In order of size over
    weight the stopped sources come first, so one pass over the list settles it. The list has one
    row per source; it is the only thing here that is ever sorted as a whole.
    """
    listed = Window.orderBy(F.col("_s").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("_size") / F.col("_w"), "_rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast(BIG)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = sources.select(F.col("source").alias("_s"), F.col("source_size").alias("_size")).select(
        "_s", "_size", (F.row_number().over(listed) - 1).alias("_rank")
    ).withColumn("_w", weight.cast("long"))
    total = F.sum("_size").over(whole).cast(BIG)
    left = (total - cap * F.coalesce(F.sum("_size").over(before).cast(BIG), zero)).cast(BIG)
    weight_left = (F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0))).cast("long")
    tested = ranked.select("*", left.alias("_left"), weight_left.alias("_wl")).withColumn(
        "_stops", (F.col("_size").cast("decimal(25,0)") * F.lit(cap) * F.col("_wl")).cast(BIG)
        <= (F.col("_left").cast("decimal(30,0)") * F.col("_w").cast("decimal(5,0)")).cast(BIG)
    )
    free = ~F.col("_stops")
    rest = F.max(F.when(free, F.col("_left"))).over(whole)
    rest_weight = F.max(F.when(free, F.col("_wl"))).over(whole)
    share = (rest.cast("decimal(30,0)") * F.col("_w").cast("decimal(5,0)")).cast("double") / rest_weight.cast("double")
    return tested.select(
        F.col("_s").alias("source"), F.col("_size").alias("source_size"),
        F.when(F.col("_stops"), (F.col("_size") * cap).cast("double")).otherwise(share).alias("target"),
    )


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """One row per source: ``source, source_size, target``, whole rounds ``__mix_full`` and the hash ``__mix_cut``.

    The cut is where the running total comes nearest to the budget: a hash value is taken when the
    middle of its rows lies below the budget.
    """
    sized = durable(docs.select(F.col("source"), hash48(F.col("doc_id")).alias("h"), size_of(F.col("text")).alias("n")))
    sums = sized.groupBy("source").agg(F.sum("n").alias("source_size"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = durable(
        targets(sums, weights, cap).withColumn("__mix_full", full).withColumn(
            "_budget", F.col("target") - F.col("__mix_full") * F.col("source_size")
        ).select("*", F.lit(0).cast("long").alias("_prefix"), F.lit(0).cast("long").alias("_below"),
                 F.lit(0).cast("long").alias("_upto"), (F.col("_budget") > 0).alias("_open"))
    )
    n_sources = state.count()
    running = Window.partitionBy("__mix_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        at = state.filter("_open").select(
            F.col("source").alias("__mix_source"), F.col("_prefix").alias("_p"), F.col("_below").alias("_b"), "_budget"
        )
        bucket = F.shiftright("h", shift)
        sums = sized.join(
            _small(at, n_sources), F.col("source").eqNullSafe(F.col("__mix_source")) & (F.shiftright(bucket, BITS) == F.col("_p"))
        ).groupBy("__mix_source", "_b", "_budget", bucket.alias("_bucket")).agg(F.sum("n").alias("_n"))
        upto = F.col("_b") + F.sum("_n").over(running)
        found = sums.select("__mix_source", "_bucket", "_budget", upto.alias("_u"), (upto - F.col("_n")).alias("_d")).filter(
            (F.col("_u") >= F.col("_budget")) & (F.col("_d") < F.col("_budget"))
        ).select("__mix_source", "_bucket", "_d", "_u")
        state = durable(
            state.join(_small(found, n_sources), F.col("source").eqNullSafe(F.col("__mix_source")), "left").select(
                "source", "source_size", "target", "__mix_full", "_budget",
                F.coalesce("_bucket", "_prefix").alias("_prefix"), F.coalesce("_d", "_below").alias("_below"),
                F.coalesce("_u", "_upto").alias("_upto"), "_open",
            )
        )
    near = (F.col("_below") + F.col("_upto")) < 2 * F.col("_budget")
    cut = F.when(~F.col("_open"), F.lit(0).cast("long")).when(near, F.col("_prefix") + 1).otherwise(F.col("_prefix"))
    return state.select("source", "source_size", "target", "__mix_full", cut.alias("__mix_cut"))


def apply_mix(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """All rows of ``docs`` with ``size, source_size, target`` and ``taken`` (words, repeats counted)."""
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    side = plan.select(F.col("source").alias("__mix_source"), "source_size", "target", "__mix_full", "__mix_cut")
    side = _small(side, plan.count())
    rows = docs.select(*names).join(side, F.col("source").eqNullSafe(F.col("__mix_source")), "left")
    times = F.col("__mix_full") + (hash48(F.col("doc_id")) < F.col("__mix_cut")).cast("long")
    return rows.withColumn("size", size_of(F.col("text"))).select(
        *names, "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """``docs`` with the share each of them gets in a mix of the same total size."""
    return apply_mix(docs, plan_mix(docs, weights, cap))
