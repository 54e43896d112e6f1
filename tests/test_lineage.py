"""Lineage search against a plain breadth-first search, on chains, rings and random graphs."""

import collections
import random

import pytest

from tidegrid.operators import lineage as N


def plain(edges, start, max_depth=None):
    to = collections.defaultdict(set)
    for a, b in edges:
        to[a].add(b)
    seen, queue = {start: 0}, collections.deque([start])
    while queue:
        x = queue.popleft()
        for y in to[x]:
            if y not in seen and (max_depth is None or seen[x] < max_depth):
                seen[y] = seen[x] + 1
                queue.append(y)
    return {k: v for k, v in seen.items() if v}


def graphs():
    rng = random.Random(3)
    chain = [(f"c{i}", f"c{i + 1}") for i in range(60)]
    yield "chain", chain
    yield "ring and tails", chain + [("c60", "c0")] + [(f"c{i}", f"t{i}") for i in range(0, 60, 9)] + [(f"r{i}", f"r{(i + 1) % 5}") for i in range(5)]
    yield "two ways", chain + [("c3", "d0")] + [(f"d{i}", f"d{i + 1}") for i in range(30)] + [("d30", "c55"), ("c20", "c50")]
    yield "deep and wide", chain + [(f"c{rng.randrange(61)}", f"c{rng.randrange(61)}") for _ in range(6)] + [(f"c{rng.randrange(61)}", f"x{i}") for i in range(40)]


@pytest.mark.parametrize("turns", [0, 8])
@pytest.mark.parametrize("name,edges", list(graphs()), ids=[n for n, _ in graphs()])
def test_depths_equal_a_plain_search(spark, monkeypatch, turns, name, edges):
    monkeypatch.setattr(N, "TURNS", turns)
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {r.node: r.depth for r in N.lineage_impact(df, "c0").collect()}
    assert got == plain(edges, "c0")
    up = {r.node: r.depth for r in N.lineage_impact(df, "c40", "upstream", max_depth=25).collect()}
    assert up == plain([(b, a) for a, b in edges], "c40", 25)


def test_turns_grow_with_the_logarithm(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(N, "durable", lambda df, real=N.durable: calls.append(1) or real(df))
    df = spark.createDataFrame([(f"c{i:04}", f"c{i + 1:04}") for i in range(1000)], "src string, dst string")
    rows = N.lineage_impact(df, "c0000").collect()
    assert {r.node: r.depth for r in rows} == {f"c{i:04}": i for i in range(1, 1001)}
    assert len(calls) <= 26  # the first eight turns, ten doublings, and what stands around them
