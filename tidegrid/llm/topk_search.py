"""Exact top-k search by inner product with MaxScore.

Terms are the dimensions, a posting is a candidate's integer weight in one of them. Candidates are dealt to
shards by hash and queries to blocks, both of bounded size, and every shard meets every block of
queries. Inside a shard, candidates are traversed in pieces; for each query and piece

1. a term's score bound is the most it can add given the piece's largest and smallest weight (0 for candidates
   without a posting);
2. terms in order of bound whose sum stays below the k-th best score so far are non-essential: a
   candidate found in them alone cannot win, so only the essential postings are traversed;
3. candidates that could still win are probed in the other terms, largest bound first, and dropped
   as soon as what they have plus what is left cannot reach the k-th best score.

Shards' best lists are merged by rank. Nothing is approximate; ties go to the smaller id.

Defined cases: vectors that are null or hold a null or non-finite component take no part, neither do empty
ones; vectors of different length share their leading dimensions, a missing one counts as 0; every
candidate row counts, so repeated rows appear repeatedly; of several query rows with one id the least vector is
asked; rows with the query's id are its own; a null id is below all others and never a query; an empty
table gives no rows; further columns are ignored. Scores must fit a long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidegrid.llm.words import NULL_ID

SHARD_ROWS, QUERY_ROWS, PIECE = 4096, 4096, 1024


def usable(vector: Column) -> Column:
    """Whether a vector is there, has components, and all of them are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def scaled(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


class Best:
    """The k best candidates of one query so far: score down, id up."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def bar(self) -> float:
        return self.scores[-1] if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def max_score(ids: np.ndarray, weights: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[Best]:
    """Best candidates of each query within one shard."""
    best = [Best(k) for _ in queries]
    most = float(np.abs(weights).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, weights.shape[1])
    kind = np.float64 if most < 2**53 else np.int64  # exact either way
    queries = queries.astype(kind)
    for begin in range(0, len(ids), PIECE):
        own_ids = ids[begin : begin + PIECE]
        postings = np.ascontiguousarray(weights[begin : begin + PIECE].T.astype(kind))  # by term
        high, low = postings.max(axis=1), postings.min(axis=1)
        bounds = np.maximum(np.maximum(queries * high, queries * low), 0)
        orders = np.argsort(bounds, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(bounds, orders, axis=1), axis=1)
        for i, query in enumerate(queries):
            bar, order, left = best[i].bar, orders[i], sums[i]
            if left[-1] < bar:
                continue
            cut = int(np.searchsorted(left, bar, side="left"))  # terms below the cut are non-essential
            essential = order[cut:]
            scores = query[essential] @ postings[essential]
            rest = left[cut - 1] if cut else 0
            at = np.flatnonzero((scores + rest >= bar) & (own_ids != query_ids[i]))
            scores = scores[at]
            for j in range(cut - 1, -1, -1):
                if not len(at):
                    break
                scores = scores + query[order[j]] * postings[order[j], at]
                stays = scores + (left[j - 1] if j else 0) >= bar
                at, scores = at[stays], scores[stays]
            if len(at):
                best[i].add(scores.astype(np.int64), own_ids[at])
    return best


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def search(candidates: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id",
           vector: str = "vector") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of each query; vectors are arrays of long."""
    key = F.coalesce(F.col(vec_id).cast("long"), F.lit(int(NULL_ID)))
    found = candidates.filter(F.size(vector) > 0).select(key.alias("id"), F.col(vector).alias("v"))
    asked = queries.filter((F.size(vector) > 0) & F.col(vec_id).isNotNull()).groupBy(key.alias("id")).agg(
        F.min(vector).alias("v")
    )
    n_shards = max(1, -(-found.count() // SHARD_ROWS))
    n_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = found.select(F.pmod(F.xxhash64("id", "v"), F.lit(n_shards)).cast("int").alias("shard"), every(n_blocks).alias("block"), "id", "v")
    spread = asked.select(every(n_shards).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("block"), "id", "v")

    def cell(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        if not len(shard) or not len(block):
            return empty
        shard = shard.sort_values("id", kind="stable")
        width = max(shard["v"].map(len).max(), block["v"].map(len).max())
        asked_ids = block["id"].to_numpy()
        best = max_score(shard["id"].to_numpy(), _matrix(shard["v"], width), _matrix(block["v"], width), asked_ids, k)
        out = [pd.DataFrame({"query_id": q, "vec_id": b.ids, "score": b.scores}) for q, b in zip(asked_ids, best) if len(b.ids)]
        return pd.concat(out) if out else empty

    lists = dealt.groupBy("shard", "block").cogroup(spread.groupBy("shard", "block")).applyInPandas(
        cell, "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != NULL_ID, F.col("vec_id")).alias("vec_id"), "score"
    )
