"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegrid.session import durable


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (least id reachable) for every id in links ``a, b``.

    Each turn hangs the larger neighbours of an id, then the smaller ones, on its least neighbour, until nothing
    changes; ids then hang on their component's least id. Least neighbours come from partial
    minima and links find them by a join, so an id with very many links is no group anywhere.
    """
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    links = durable(links.filter(F.col("a") != F.col("b")).select(*pair).distinct())
    before = _signature(links)
    while before[0]:
        both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = durable(small.unionAll(low.select("a", F.col("m").alias("b"))).distinct())
        after = _signature(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
