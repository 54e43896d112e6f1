"""Data lineage: edges from event records, and what lies up- or downstream of an asset."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.session import durable


#: Depth up to which the search goes edge by edge.
TURNS = 8
#: Nodes of a frontier shipped to all tasks at most.
BROADCAST_NODES = 100_000


def lineage_edges(events: DataFrame) -> DataFrame:
    """Creation, transformation and consumption events as distinct (src, dst, kind)."""
    kind = F.col("event_type")
    src = (
        F.when(kind == "creation", F.col("source_system"))
        .when(kind == "transformation", F.col("source_asset_id"))
        .when(kind == "consumption", F.col("consumed_asset_id"))
    )
    dst = (
        F.when(kind == "creation", F.col("asset_id"))
        .when(kind == "transformation", F.col("target_asset_id"))
        .when(kind == "consumption", F.col("consumer_id"))
    )
    return (
        events.select(src.alias("src"), dst.alias("dst"), kind.alias("kind"))
        .filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .distinct()
    )


def lineage_impact(
    edges: DataFrame, asset: str, direction: str = "downstream", max_depth: int | None = None
) -> DataFrame:
    """Every asset reached from ``asset`` with its smallest distance; ``max_depth`` limits it if given.

    Breadth first: each turn joins the distinct frontier with the edges and drops nodes already
    seen, so work is bounded by nodes and edges, not by the number of paths, and cycles end when
    the frontier is empty. A frontier of up to ``BROADCAST_NODES`` is shipped to the edges instead of
    shuffling them. Each turn is written durably, which keeps the plan short. What lies deeper than ``TURNS`` is reached
    over contracted chains, so a long chain takes turns by the logarithm of its length.
    """
    a, b = ("src", "dst") if direction == "downstream" else ("dst", "src")
    step = durable(edges.select(F.col(a).alias("_from"), F.col(b).alias("node")))
    spark = edges.sparkSession
    frontier = spark.range(1).select(F.lit(asset).alias("node"), F.lit(0).alias("depth"))
    seen = frontier
    size = 1
    for depth in itertools.count(1):
        if not size or (max_depth is not None and depth > max_depth):
            break
        if depth > TURNS:
            left = step.join(seen, "node", "left_anti").select("_from", "node").distinct()
            seen = seen.unionByName(_deeper(durable(left), frontier, max_depth))
            break
        ask = frontier.select(F.col("node").alias("_from"))
        reached = (
            step.join(F.broadcast(ask) if size <= BROADCAST_NODES else ask, "_from")
            .select("node")
            .distinct()
            .join(seen, "node", "left_anti")
            .select("node", F.lit(depth).alias("depth"))
        )
        frontier = durable(reached)
        size = frontier.count()
        seen = seen.unionByName(frontier)
    return seen.filter(F.col("depth") > 0)


def _deeper(step: DataFrame, frontier: DataFrame, max_depth: int | None) -> DataFrame:
    """Nodes beyond ``frontier`` over the edges ``_from, node`` that lead to nodes not seen yet, with their depths.

    Chains are contracted: a node with one edge in and one out, not on the frontier, points to the node before it, and pointers
    are doubled until they meet a node that is none of these. What remains are edges with lengths between such nodes. Their
    depths come from relaxing edges until nothing gets nearer; those on chains follow.
    """
    into = step.groupBy("node").agg(F.count("*").alias("_in"), F.min("_from").alias("ptr")).filter("_in = 1")
    out = step.groupBy("_from").agg(F.count("*").alias("_out")).filter("_out = 1").select(F.col("_from").alias("node"))
    chain = into.join(out, "node").join(frontier, "node", "left_anti").select("node", "ptr")
    names = chain.select(F.col("node").alias("ptr"), F.lit(True).alias("_open"))
    pointers = durable(
        chain.join(names, "ptr", "left").select("node", "ptr", F.lit(1).alias("off"), F.coalesce("_open", F.lit(False)).alias("open"))
    )
    open_now = pointers.filter("open").count()
    for _ in range(pointers.count().bit_length() + 1):  # a ring of chain nodes never closes, and nothing leads into it
        if not open_now:
            break
        ahead = pointers.select(
            F.col("node").alias("ptr"), F.col("ptr").alias("_ptr"), F.col("off").alias("_off"), F.col("open").alias("_open")
        )
        jumped = pointers.filter("open").join(ahead, "ptr").select(
            "node", F.col("_ptr").alias("ptr"), (F.col("off") + F.col("_off")).alias("off"), F.col("_open").alias("open")
        )
        pointers = durable(pointers.filter("NOT open").unionByName(jumped))
        open_now = pointers.filter("open").count()
    closed = pointers.filter("NOT open").select("node", "ptr", "off")
    start = closed.select(F.col("node").alias("_from"), F.col("ptr").alias("_ptr"), F.col("off").alias("_off"))
    roads = durable(
        step.join(closed.select("node"), "node", "left_anti").join(start, "_from", "left")
        .select(F.coalesce("_ptr", "_from").alias("_from"), "node", (F.coalesce("_off", F.lit(0)) + 1).alias("length"))
        .groupBy("_from", "node").agg(F.min("length").alias("length"))
    )
    known = near = frontier
    while True:
        reach = near.select(F.col("node").alias("_from"), "depth").join(roads, "_from").groupBy("node").agg(
            F.min(F.col("depth") + F.col("length")).alias("depth")
        )
        if max_depth is not None:
            reach = reach.filter(F.col("depth") <= max_depth)
        before = known.select("node", F.col("depth").alias("_before"))
        near = durable(reach.join(before, "node", "left").filter("_before IS NULL OR depth < _before").select("node", "depth"))
        if near.isEmpty():
            break
        known = durable(known.unionByName(near).groupBy("node").agg(F.min("depth").alias("depth")))
    on_chains = closed.join(known.select(F.col("node").alias("ptr"), "depth"), "ptr").select("node", (F.col("depth") + F.col("off")).alias("depth"))
    found = known.join(frontier, "node", "left_anti").unionByName(on_chains)
    return found if max_depth is None else found.filter(F.col("depth") <= max_depth)
