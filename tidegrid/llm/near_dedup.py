"""Near-duplicate documents: bottom-k sketches, inverted lists of retained values, exact Jaccard.

A document's set is its distinct word shingles (64-bit hashes). Documents link when the Jaccard similarity of their
sets is at least ``percent`` / 100; every link is confirmed on the full sets, and components of links are groups.

1. One pass gives each document its set's size, a 128-bit hash of the set, and the bottom-k sketch (the k
   least values of the one hash function). Equal sets become one class before anything else.
2. Retained values form inverted lists. A set shares at least ``need`` retained values with whatever it links to
   (surely if all its possible partners are whole in their sketches, else but for five standard deviations), so both
   have one of the retained - need + 1 rarest in common: only these stay in the lists, and what is common
   everywhere drops out.
3. Lists that run side by side get one leader (twice over: the leader most of a list's members have for their longest
   list), and a class goes with its text to the leaders of its lists, once to each. Whoever shares a list shares its
   leader, so every candidate pair meets, and near copies that share a hundred lists meet once.
4. At a leader, overlaps of retained values give candidates, the Jaccard estimate of the union's sketch (less
   five standard deviations) drops most, and full sets decide. Pairs already in one component are
   skipped, and only a spanning forest comes out: a group of thousands of near copies gives as many rows as it
   has members. What is too much for a task is cut into blocks and every two blocks meet.

Lists are never capped, pairs never leave a task unless they link, and links never leave the cluster.

Defined cases: documents with fewer words than a shingle have their whole word sequence as the one shingle; null,
empty or wordless texts have no set, size 0, and stand alone; rows that share an id are one document for
grouping; a null id is below all others; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm.components import components
from tidegrid.llm.words import (
    NULL_ID, ids, lower_ascii, mix64, run_hash, run_starts, slices, span_hash, text_bytes, word_spans,
)
from tidegrid.session import durable

K = 48
#: Shingles of one block at a leader; two blocks meet in a task.
BLOCK_SHINGLES = 1 << 17
#: Ids shipped to all tasks at most (16 MB); beyond, the join shuffles.
BROADCAST_IDS = 1_000_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin (texts + 1 values)."""
    starts, ends, first = word_spans(data, offsets)
    words = span_hash(data, starts, ends)
    at, text = run_starts(first, n)
    values = [run_hash(words, n)[at]]
    owners = [text]
    count = np.diff(first)
    for few in range(1, n):
        who = np.flatnonzero(count == few)
        if len(who):
            values.append(mix64(run_hash(words, few)[first[who]] + np.uint64(few)))
            owners.append(who)
    values, owners = np.concatenate(values).view(np.int64), np.concatenate(owners)
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[new], owners[new]
    return values, np.searchsorted(owners, np.arange(len(offsets)))


def sketches(docs: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """``id, n, h1, h2, sketch`` of each document."""

    def sketch(batches):
        for batch in batches:
            for piece in slices(batch, text):
                data, offsets = text_bytes(piece.column(text))
                values, begin = shingle_sets(lower_ascii(data), offsets)
                sums = np.zeros((2, len(values) + 1), np.uint64)
                for i, salt in enumerate((0x51ED270B9F652295, 0x2545F4914F6CDD1D)):
                    np.cumsum(mix64(values.view(np.uint64) ^ np.uint64(salt)), out=sums[i, 1:])
                h1, h2 = (sums[:, begin[1:]] - sums[:, begin[:-1]]).view(np.int64)
                size = np.diff(begin)
                kept = np.minimum(size, k)
                at = np.repeat(begin[:-1] - (np.cumsum(kept) - kept), kept) + np.arange(kept.sum())
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept)).astype(np.int32)), pa.array(values[at]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids(piece.column(doc_id))), pa.array(size.astype(np.int64)), pa.array(h1.copy()), pa.array(h2.copy()), lists],
                    names=["id", "n", "h1", "h2", "sketch"],
                )

    return docs.select(doc_id, text).mapInArrow(sketch, "id long, n long, h1 long, h2 long, sketch array<long>")


def least_shared(n: int, k: int, percent: int) -> int:
    """Retained values that a set of ``n`` shares at least with any set it links to.

    A partner of at most k values is whole in its sketch and shares all of the overlap, at least percent of the larger
    set. A larger partner of m values retains k of them, which the hash draws: of the overlap at least what is
    more than the m - k that went, and the mean of the draw less five standard deviations.
    """
    share = percent / 100
    if n > k:
        return math.floor(k * share - 5 * math.sqrt(k * share * (1 - share)))
    least = -(-n * percent // 100)
    for m in range(k + 1, n * 100 // percent + 1):
        both = -(-percent * (n + m) // (100 + percent))
        spread = math.sqrt(k * both / m * (1 - both / m) * (m - k) / (m - 1))
        least = min(least, max(both - (m - k), math.floor(k * both / m - 5 * spread)))
    return least


def rare_values(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """``id, n, keys``: the retained values a class stands in the lists for, longest list first.

    A value that one class alone retains takes its place among the rarest but needs no list.
    """
    kept = F.least(F.col("n"), F.lit(k)).cast("int")
    need = F.array(*[F.lit(least_shared(n, k, percent)) for n in range(1, k + 2)])
    places = kept - F.get(need, F.least(F.col("n"), F.lit(k + 1)).cast("int") - 1) + 1
    rows = classes.select("id", "n", F.explode("sketch").alias("v"))
    lists = rows.groupBy("v").agg(F.count("*").alias("length")).filter("length > 1")
    shared = rows.join(lists, "v").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("length", "v"))).alias("l"))
    left = places - (kept - F.size("l"))
    keys = F.reverse(F.slice("l", 1, F.greatest(left, F.lit(0)).cast("int")))
    return shared.select("id", "n", F.transform(keys, lambda x: x["v"]).alias("keys")).filter(F.size("keys") > 0)


def leaders(keys: DataFrame, rounds: int = 2) -> DataFrame:
    """``id, n, leader``: a class with each leader of its lists, once.

    Any choice of one leader per list is right, as it depends on the list alone; this one makes them few.
    """
    spread = keys.select("id", "n", F.explode("keys").alias("v"), F.get("keys", F.lit(0)).alias("home"))
    leader = None
    for _ in range(rounds):
        label = spread.select("v", F.col("home").alias("label"))
        if leader is not None:
            label = spread.join(leader.withColumnRenamed("v", "home"), "home").select("v", F.col("leader").alias("label"))
        leader = durable(
            label.groupBy("v", "label").agg(F.count("*").alias("m")).groupBy("v").agg(
                F.max_by("label", F.struct("m", "label")).alias("leader")
            )
        )
    return durable(spread.join(leader, "v").select("id", "n", "leader").distinct())


def cell_links(docs: DataFrame, cells: DataFrame, percent: int, k: int, doc_id: str, text: str) -> DataFrame:
    """Compare all full sets within each cell (``cell, id``); a spanning forest of the links (``a, b``)."""

    def compress(batches):
        for batch in batches:
            for piece in slices(batch, text):
                data, offsets = text_bytes(piece.column(text))
                raw = data.tobytes()
                bodies = [zstandard.compress(raw[a:b], 3) for a, b in itertools.pairwise(offsets.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(ids(piece.column(doc_id))), pa.array(bodies, pa.binary())], names=["id", "z"])

    def compare(batches):
        def rows():
            for batch in batches:
                texts = pa.array([zstandard.decompress(z) for z in batch.column("z").to_pylist()], pa.binary()).cast(pa.string())
                whole = pa.RecordBatch.from_arrays([batch.column("cell"), batch.column("id"), texts], names=["cell", "id", "text"])
                for piece in slices(whole):
                    data, offsets = text_bytes(piece.column("text"))
                    values, begin = shingle_sets(lower_ascii(data), offsets)
                    for cell, who, a, b in zip(piece.column("cell").to_pylist(), piece.column("id").to_pylist(), begin[:-1], begin[1:]):
                        yield cell, who, values[a:b].copy()

        a, b = [], []
        for _, group in itertools.groupby(rows(), key=lambda r: r[0]):
            members = list(group)
            for x, y in forest([m[1] for m in members], [m[2] for m in members], percent, k):
                a.append(x)
                b.append(y)
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    texts = docs.select(doc_id, text).mapInArrow(compress, "id long, z binary")
    return texts.join(cells, "id").select("cell", "id", "z").repartition("cell").sortWithinPartitions("cell").mapInArrow(
        compare, "a long, b long"
    )


def _inverted(values: np.ndarray, owner: np.ndarray, m: int):
    """Inverted lists of values in rows sorted by owner.

    Returns the owners and row numbers of all postings, list by list, and per owner the first posting and length of
    the list of each of its values.
    """
    order = np.argsort(values, kind="stable")
    head = np.ones(len(values), bool)
    head[1:] = values[order][1:] != values[order][:-1]
    first = np.flatnonzero(head)
    length = np.diff(np.append(first, len(values)))
    group = np.empty(len(values), np.int64)
    group[order] = np.cumsum(head) - 1
    cuts = np.cumsum(np.bincount(owner, minlength=m))[:-1]
    return owner[order], order, np.split(first[group], cuts), np.split(length[group], cuts)


def _postings(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(length) - length), length) + np.arange(length.sum())


def forest(names: list[int], sets: list[np.ndarray], percent: int, k: int = K) -> list[tuple[int, int]]:
    """Links that span the components of these sets: (name, least name) for all but the least."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    root = np.arange(m)  # always the component's representative, not a chain
    share = percent / 100
    links = lambda both, i, j: (100 * both >= percent * (size[i] + size[j] - both)) & (both > 0)
    if m == 2:
        if links(len(np.intersect1d(sets[0], sets[1], assume_unique=True)), 0, 1):
            root[1] = 0
    elif m > 2:
        kept = np.minimum(size, k)
        rank = np.concatenate([np.arange(n) for n in kept])
        s_owner, s_row, s_first, s_length = _inverted(
            np.concatenate([s[:k] for s in sets]), np.repeat(np.arange(m), kept), m
        )
        s_rank = rank[s_row]
        f_owner, _, f_first, f_length = _inverted(np.concatenate(sets), np.repeat(np.arange(m), size), m)
        # Sets with the most in common first: they draw most others into one component.
        for i in np.argsort([-int(x.sum()) for x in s_length], kind="stable").tolist():
            at = _postings(s_first[i], s_length[i])
            j, mine, theirs = s_owner[at], np.repeat(np.arange(kept[i]), s_length[i]), s_rank[at]
            apart = root[j] != root[i]
            if not apart.any():
                continue
            j, mine, theirs = j[apart], mine[apart], theirs[apart]
            order = np.argsort(j, kind="stable")
            j, mine, theirs = j[order], mine[order], theirs[order]
            new = np.ones(len(j), bool)
            new[1:] = j[1:] != j[:-1]
            start = np.flatnonzero(new)
            before = np.arange(len(j)) - np.repeat(start, np.diff(np.append(start, len(j))))
            # A common value stands in the union's sketch if fewer than k values of the union come before it.
            common = np.bincount(j[mine + theirs - before < k], minlength=m)
            shared = np.bincount(j, minlength=m)
            union = np.minimum(kept + kept[i] - shared, k)
            whole = (size <= k) & (size[i] <= k)
            slack = np.where(whole, 0, 5 * np.sqrt(share * (1 - share) / np.maximum(union, 1)))
            likely = (common >= (share - slack) * union - 1e-9) & (shared > 0)
            if not likely.any():
                continue
            if likely.sum() <= 16:
                both = np.zeros(m, np.int64)
                for x in np.flatnonzero(likely).tolist():
                    both[x] = len(np.intersect1d(sets[i], sets[x], assume_unique=True))
            else:
                both = np.bincount(f_owner[_postings(f_first[i], f_length[i])], minlength=m)
            for x in np.unique(root[np.flatnonzero(likely & links(both, i, np.arange(m)))]).tolist():
                root[root == x] = root[i]
    out = []
    names_of = np.array(names)
    for r in np.unique(root).tolist():
        own = np.unique(names_of[root == r]).tolist()
        out += [(x, own[0]) for x in own[1:]]
    return out


def near_groups(docs: DataFrame, percent: int = 75, k: int = K, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    base = durable(sketches(docs, k, doc_id, text))
    classes = durable(
        base.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("id").alias("id"), F.any_value("sketch").alias("sketch"))
    )
    keys = durable(rare_values(classes, k, percent))

    met = leaders(keys)
    blocks = met.groupBy("leader").agg(
        F.count("*").alias("m"), F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks")
    ).filter("m > 1").select("leader", "blocks")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    cells = met.join(blocks, "leader").select(
        "id", "leader", own.alias("b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(F.xxhash64("leader", F.least("b", "other"), F.greatest("b", "other")).alias("cell"), "id")
    found = components(cell_links(docs, cells, percent, k, doc_id, text))

    whole = classes.select("h1", "h2", "n", "id").join(found, "id", "left").select(
        "h1", "h2", "n", F.coalesce("component", "id").alias("component")
    )
    name = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return base.select("id", "n", "h1", "h2").join(whole, ["h1", "h2", "n"], "left").withColumn(
        "component", F.coalesce("component", "id")
    ).select(
        name("id").alias("doc_id"), F.col("n").alias("n_shingles"), name("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Ids to be shipped to all tasks if they are few by count."""
    return F.broadcast(df) if rows <= BROADCAST_IDS else df
