"""Boosted regression trees from shared histograms, many trials at a time.

Features are cut into bins once. Rows lie in blocks: packed bins, labels and each trial's prediction so far. One pass over the
blocks adds up, for every trial at once, gradients and counts by (trial, node, feature, bin); tasks send only their sums, and
sums of many tasks are combined on executors before the driver sees them. A model takes thousands of short passes, so they run as
plain jobs over the blocks (an RDD of packed rows), which need no query planning, a task for each core. The driver holds histograms and trees, which are
bounded by the model (trials x nodes of a level x features x bins), and picks the splits. Of two children a pass adds up the smaller one;
the other is what is left of their parent. So a search over ten trials takes as many passes as its longest trial alone.

Trees follow the second-order rule for squared error: a split's gain is ``GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)``, a leaf says
``-G/(H+l)``; rows are drawn per tree, columns once per tree. Unknown values go to the right of every split.

Bins, labels, predictions, and rows drawn and nodes reached of the growing tree lie in files of the executor's own folder from pass to pass, as any of its
workers may get a block next; Spark runs a block's task where the block is cached, and the task is sent no more than its number. Where files are
missing, as after the loss of an executor, the blocks are sent again and predictions worked out from the bins and all trees so far: recent ones go
out with the task, older ones are broadcast.
"""

from __future__ import annotations

import json
import math
import os
import tempfile
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, RDD, StorageLevel, TaskContext
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.session import durable, scratch_path

#: Rounds after which finished trees are broadcast instead of going out with each task.
KEEP = 20
#: Tasks whose sums the driver adds itself; sums of more are combined on executors first.
FAN_IN = 64
BLOCK_ROWS = 1 << 17
#: A table of so many blocks at most is one block: three thousand passes over it cost less than as many jobs.
APART_BLOCKS = 4
#: Blocks that a task takes before there are more tasks than cores.
TASK_BLOCKS = 32
BLOCKS = "block long, n int, bins binary, label binary, test binary"


# --- trees ---------------------------------------------------------------------------------------


class Tree:
    """Nodes in the order they were made; the children of a split stand side by side."""

    def __init__(self, total: float, n: float, penalty: float):
        self.penalty = penalty
        self.feature, self.cut, self.left = [-1], [0], [-1]
        self.total, self.n, self.gain = [total], [n], [0.0]

    def split(self, node: int, feature: int, cut: int, gain: float, left: tuple[float, float]) -> list[int]:
        first = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, first, gain
        for total, n in (left, (self.total[node] - left[0], self.n[node] - left[1])):
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(-1)
            self.total.append(total)
            self.n.append(n)
            self.gain.append(0.0)
        return [first, first + 1]

    def value(self, node: int) -> float:
        return -self.total[node] / (self.n[node] + self.penalty) if self.n[node] else 0.0

    def packed(self) -> tuple[np.ndarray, ...]:
        """Feature, cut and left child of each node, and what it says."""
        small = (np.array(x, np.int32) for x in (self.feature, self.cut, self.left))
        return (*small, np.array([self.value(i) for i in range(len(self.feature))]))


def nodes_of(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """The node where each row (a column of ``bins``) ends, from ``at`` on or from the root."""
    n, flat, inner = bins.shape[1], bins.reshape(-1), feature >= 0
    if at is None:
        at = left[0] + (bins[feature[0]] > cut[0]).astype(np.int64) if inner[0] else np.zeros(n, np.int64)
    # A leaf leads to itself, so that no row has to be picked out.
    places = np.where(inner, feature, 0).astype(np.int64) * n
    cut = np.where(inner, cut, np.iinfo(np.int32).max)
    left, rows = np.where(inner, left, np.arange(len(left))), np.arange(n)
    while inner.take(at).any():
        at = left.take(at) + (flat.take(places.take(at) + rows) > cut.take(at))
    return at


@dataclass
class Trial:
    """One ensemble while it grows."""

    rounds: int
    rate: float
    depth: int
    rows: float
    columns: float
    seed: int
    penalty: float = 1.0
    least: float = 1.0
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)  # held-out RMSE after 0, 1, ... rounds
    frontier: list[int] = field(default_factory=list)
    level: int = 0
    chosen: np.ndarray | None = None
    counted: list[int] = field(default_factory=list)  # of the frontier, the nodes that a pass adds up
    parents: tuple | None = None  # sums and counts of the nodes whose children are the frontier

    @property
    def growing(self) -> bool:
        return len(self.trees) < self.rounds or bool(self.frontier)

    @property
    def waits(self) -> bool:
        """Whether it still grows or its last error is not known yet."""
        return self.growing or len(self.errors) <= len(self.trees)

    def job(self, begin: int, wide: int) -> dict[str, Any]:
        """What a pass adds up: the partial tree, the frontier's places, its columns and where its codes begin."""
        out: dict[str, Any] = {"error": not self.level, "begin": begin, "size": 0}
        if self.frontier:
            tree = self.trees[-1] if self.level else Tree(0.0, 0.0, 0.0)
            place = np.full(len(tree.feature), -1)
            place[self.counted] = np.arange(len(self.counted))
            out |= {
                "tree": tree.packed()[:3], "place": place, "chosen": self.chosen, "rows": self.rows, "wide": wide,
                "seed": [self.seed, len(self.trees) - (self.level > 0), 2], "size": len(self.counted) * len(self.chosen) * wide,
            }
        return out

    def advance(self, job: dict[str, Any], total: np.ndarray, n: np.ndarray, error: float) -> None:
        """Take in what a pass found."""
        if job["error"]:
            self.errors.append(error)
        if job["size"]:
            shape = len(self.counted), len(self.chosen), job["wide"]
            self.take(*self.whole(total.reshape(shape), n.reshape(shape)))

    def whole(self, total: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums and counts of all the frontier: a child that was not added up is its parent less the other."""
        if self.level == 0:
            return total, n
        out = []
        second = np.array([node == right for node, right in zip(self.counted, self.frontier[1::2])])[:, None, None]
        rest = self.parents[1] - n
        for own, other in ((total, np.where(rest > 0, self.parents[0] - total, 0.0)), (n, rest)):
            pairs = np.stack([np.where(second, other, own), np.where(second, own, other)], axis=1)
            out.append(pairs.reshape(len(self.frontier), *own.shape[1:]))
        return out[0], out[1]

    def next_tree(self, features: int) -> None:
        rng = np.random.default_rng([self.seed, len(self.trees), 1])
        n = max(1, round(self.columns * features))
        self.chosen = np.sort(rng.choice(features, n, replace=False))
        self.frontier, self.counted, self.level = [0], [0], 0

    def take(self, total: np.ndarray, n: np.ndarray) -> None:
        """Split the frontier by its histograms (node, feature of the tree, bin; the last bin holds unknown values)."""
        if self.level == 0:
            self.trees.append(Tree(float(total[0, 0].sum()), float(n[0, 0].sum()), self.penalty))
        tree, following, split = self.trees[-1], [], []
        if self.depth > 0:
            left, n_left = np.cumsum(total, axis=2)[:, :, :-1], np.cumsum(n, axis=2)[:, :, :-1]
            whole, n_whole = total.sum(axis=2, keepdims=True), n.sum(axis=2, keepdims=True)
            score = lambda g, h: g * g / (h + self.penalty)
            gains = score(left, n_left) + score(whole - left, n_whole - n_left) - score(whole, n_whole)
            fits = (n_left >= self.least) & (n_whole - n_left >= self.least)
            gains = np.where(fits, gains, -np.inf).reshape(len(self.frontier), -1)
            for i, (node, best) in enumerate(zip(self.frontier, gains.argmax(axis=1).tolist())):
                if gains[i, best] > 1e-9:
                    f, cut = divmod(best, left.shape[2])
                    side = float(left[i, f, cut]), float(n_left[i, f, cut])
                    following += tree.split(node, int(self.chosen[f]), cut, float(gains[i, best]), side)
                    split.append(i)
        self.level += 1
        self.frontier = following if self.level < self.depth else []
        self.counted = [a if tree.n[a] <= tree.n[b] else b for a, b in zip(self.frontier[::2], self.frontier[1::2])]
        self.parents = (total[split], n[split]) if self.frontier else None
        if not self.frontier:
            self.level = 0  # done; the next pass begins with the error


# --- passes over the rows --------------------------------------------------------------------------


def bin_edges(df: DataFrame, cols: Sequence[str], bins: int) -> list[np.ndarray]:
    """Upper ends of each feature's bins: distinct values at evenly spaced ranks, fewer where there are fewer values."""
    ranks = [(i + 1) / bins for i in range(bins - 1)]
    fine = [F.when(~F.isnan(c), F.col(c)) for c in cols]
    found = df.agg(*[F.percentile_approx(x, ranks, 20 * bins).alias(f"_{i}") for i, x in enumerate(fine)]).first()
    return [np.unique(np.array(x if x else [0.0], float)) for x in found]


def packed_blocks(df: DataFrame, cols: Sequence[str], label: str, edges: list[np.ndarray], held_out: float, seed: int, limit: int) -> DataFrame:
    """Rows in blocks of ``BLOCKS``, ``limit`` rows each; in a block they stand in the order of a hash of their values."""
    width = np.uint8 if max(map(len, edges)) < 254 else np.uint16

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            while n >= limit:
                whole = pa.concat_batches(waiting)
                yield whole.slice(0, limit)
                waiting, n = [whole.slice(limit)], n - limit
        if n:
            yield pa.concat_batches(waiting)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for done, piece in enumerate(gathered(batches)):
            order = np.argsort(piece.column("_h").to_numpy(), kind="stable")
            x = [piece.column(f"_{i}").to_numpy(zero_copy_only=False)[order] for i in range(len(edges))]
            packed = [np.where(np.isnan(v), len(e) + 1, np.searchsorted(e, v)).astype(width) for v, e in zip(x, edges)]
            test = np.random.default_rng([seed, part, done]).random(len(order)) < held_out
            y = piece.column("_y").to_numpy(zero_copy_only=False)[order]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([part << 32 | done]), "n": pa.array([len(order)], pa.int32()),
                "bins": [np.stack(packed).tobytes()], "label": [y.tobytes()], "test": [test.tobytes()],
            })

    rows = df.select(
        *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"_{i}") for i, c in enumerate(cols)],
        F.col(label).cast("double").alias("_y"), F.xxhash64(*cols, label).alias("_h"),
    ).filter(F.col("_y").isNotNull() & ~F.isnan("_y"))
    return rows.mapInArrow(pack, BLOCKS)


class Grower:
    """Grows all trials over the same blocks."""

    def __init__(self, spark: SparkSession, blocks: DataFrame, edges: list[np.ndarray], trials: list[Trial], start: float):
        self.spark, self.edges, self.trials, self.start = spark, edges, trials, start
        self.bins = [len(e) + 2 for e in edges]  # the last holds unknown values
        self.wide = max(self.bins)
        self.width = np.uint8 if max(map(len, edges)) < 254 else np.uint16
        self.applied = [0] * len(trials)  # finished trees that are broadcast
        self.sent: list[Broadcast] = []
        self.shelved = False
        self.name = f"boost-{uuid.uuid4().hex}"
        self.stored = durable(blocks).persist(StorageLevel.MEMORY_AND_DISK)
        self.state: RDD = self.stored.rdd.map(tuple)
        self.numbers: RDD = self.stored.select("block", "n").rdd.map(tuple).persist()  # lie where the blocks do
        self.tasks = self.state.getNumPartitions()

    def _done(self, t: Trial) -> int:
        return len(t.trees) - (t.level > 0)

    def _ahead(self) -> list[list[tuple]]:
        """Finished trees that are not broadcast, by trial."""
        return [[(t.rate, *tree.packed()) for tree in t.trees[a : self._done(t)]] for t, a in zip(self.trials, self.applied)]

    def _send(self) -> None:
        """Broadcast the finished trees; a worker reads them only if it has lost its files."""
        self.sent.append(self.spark.sparkContext.broadcast(self._ahead()))
        self.applied = [self._done(t) for t in self.trials]

    def close(self) -> None:
        """Remove what lies on executors. What stays, since a block has moved, goes with the executor."""
        name, n_trials = self.name, len(self.trials)

        def clear(rows):
            for block, _ in rows:
                _clear(f"{_shelf(name)}/{block}", *(f"{_shelf(name)}/{block}-{i}" for i in range(n_trials)))

        if self.shelved:
            self.numbers.foreachPartition(clear)
        self.numbers.unpersist()
        self.stored.unpersist()
        for trees in self.sent:
            trees.unpersist()

    def run(self) -> None:
        """Grow until every trial has its rounds and its last error."""
        if self.tasks == 1 and self.state.count() <= 1:
            self._run_apart()
        while any(t.waits for t in self.trials):
            plan, begin = [], 0
            for t in self.trials:
                if not t.frontier and len(t.trees) < t.rounds:
                    t.next_tree(len(self.edges))
                plan.append(t.job(begin, self.wide) if t.waits else None)
                begin += plan[-1]["size"] if plan[-1] else 0
            total, n, errors = self._pass(plan, begin)
            for i, (t, job) in enumerate(zip(self.trials, plan)):
                if job:
                    own = slice(job["begin"], job["begin"] + job["size"])
                    t.advance(job, total[own], n[own], errors[i])
            if any(self._done(t) - a > KEEP for t, a in zip(self.trials, self.applied) if t.growing):
                self._send()

    def _run_apart(self) -> None:
        """A table of one block has nothing to combine: each trial makes its passes where a copy of the block lies."""
        trials, width, start, wide, d = self.trials, self.width, self.start, self.wide, len(self.edges)

        def whole(pair):
            i, (block, n_rows, packed, label, test) = pair
            t, bins = trials[i], np.frombuffer(packed, width).reshape(d, n_rows)
            label, test = np.frombuffer(label, float), np.frombuffer(test, bool)
            own = Block(block, bins, np.full(n_rows, start), 0)
            while t.waits:
                if not t.frontier and len(t.trees) < t.rounds:
                    t.next_tree(d)
                job, before = t.job(0, wide), len(t.trees) - (t.level > 0)
                error, code, sums, counts = own.sums(job, label, test)
                total, n = np.zeros(job["size"]), np.zeros(job["size"])
                total[code], n[code] = sums, counts
                t.advance(job, total, n, math.sqrt(error / test.sum()) if test.any() else math.nan)
                if len(t.trees) - (t.level > 0) > before:
                    own.apply((t.rate, *t.trees[-1].packed()))
            return i, t

        n = len(trials)
        copies = self.state.flatMap(lambda row: [(i, row) for i in range(n)]).partitionBy(n)
        for i, t in copies.map(whole).collect():
            self.trials[i].trees, self.trials[i].errors = t.trees, t.errors

    def _pass(self, plan: list[dict | None], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums of gradients and counts by code, and each trial's held-out error."""
        ahead, sent, applied, n_trials, name = self._ahead(), list(self.sent), list(self.applied), len(self.trials), self.name
        width, start, d = self.width, self.start, len(self.edges)

        def add(part, rows):
            total, n, error, tests = np.zeros(size), np.zeros(size), np.zeros(n_trials), 0
            missing = []
            for block, n_rows, *given in rows:
                found = _block(name, block, given)
                if not found:
                    missing = [part]
                    continue
                bins, label, test = (np.frombuffer(x, kind) for x, kind in zip(found, (width, float, bool)))
                bins = bins.reshape(d, n_rows)
                tests += int(test.sum())
                for i, job in enumerate(plan):
                    if job:
                        own = _load(name, block, i, bins)
                        if own is None or own.done > applied[i] + len(ahead[i]):
                            own = Block(block, bins, np.full(n_rows, start), 0)
                        trees = ahead[i]
                        if own.done < applied[i]:
                            trees = [tree for old in sent for tree in old.value[i]] + trees
                        for tree in trees[len(trees) - (applied[i] + len(ahead[i]) - own.done) :]:
                            own.apply(tree)
                        off, code, sums, counts = own.sums(job, label, test)
                        _save(name, i, own)
                        error[i] += off
                        total[code + job["begin"]] += sums
                        n[code + job["begin"]] += counts
            code = np.flatnonzero(n)
            if missing:  # all of the part is done again
                code, error, tests = code[:0], error * 0, 0
            yield part, code, total[code], n[code], error, tests, missing

        out, tasks = (self.numbers if self.shelved else self.state).mapPartitionsWithIndex(add), self.tasks
        self.shelved = True
        while tasks > FAN_IN:
            tasks = -(-tasks // FAN_IN)
            out = out.map(lambda r: (r[0] // FAN_IN, r)).groupByKey(tasks).map(lambda g: _combine(g[0], g[1]))
        total, n, error, tests = np.zeros(size), np.zeros(size), np.zeros(n_trials), 0
        found = out.collect()
        again = sorted(part for r in found for part in r[-1])
        if again:
            self.numbers.unpersist().persist()  # they go where the blocks are now
            found += self.spark.sparkContext.runJob(self.state.mapPartitionsWithIndex(add), list, again)
        for _, code, sums, counts, errors, tested, _ in sorted(found, key=lambda r: (r[0], bool(r[-1]))):
            total[code] += sums
            n[code] += counts
            error += errors
            tests += tested
        return total, n, np.sqrt(error / tests) if tests else np.full(n_trials, np.nan)


class Block:
    """One block as a trial sees it: predictions with ``done`` trees in them, and of the tree that grows the rows drawn and the nodes
    that all rows have reached, so that a level is one step on from the level before."""

    def __init__(self, block: int, bins: np.ndarray, score: np.ndarray, done: int):
        self.block, self.bins, self.score, self.done = block, bins, score, done
        self.number, self.steps = -1, 0  # of the tree whose rows are drawn, and passes over it
        self.saved: tuple | None = None  # the state that lies in files

    def _draw(self, job: dict[str, Any], test: np.ndarray) -> None:
        drawn = ~test
        if job["rows"] < 1:
            rng = np.random.default_rng([*job["seed"], self.block >> 32, self.block & 0xFFFFFFFF])
            drawn &= rng.random(len(drawn)) < job["rows"]
        self.number, self.steps, self.drawn = job["seed"][1], 0, drawn
        self.at = np.zeros(len(drawn), np.int64)

    def sums(self, job: dict[str, Any], label: np.ndarray, test: np.ndarray) -> tuple:
        """The held-out squared error, and by code the sums of gradients and the counts."""
        error = float(((self.score[test] - label[test]) ** 2).sum()) if job["error"] else 0.0
        if not job["size"]:
            return error, np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        if job["seed"][1] != self.number:
            self._draw(job, test)
        place, columns, wide = job["place"], len(job["chosen"]), job["wide"]
        if len(place) > 1:
            self.at = nodes_of(self.bins, *job["tree"], self.at)
        self.steps += 1
        place = place.take(self.at)
        rows = np.flatnonzero(self.drawn & (place >= 0))
        begin, gradient = place.take(rows) * wide, self.score.take(rows) - label.take(rows)
        nodes = job["size"] // (columns * wide)
        total, n = np.zeros((nodes, columns, wide)), np.zeros((nodes, columns, wide), np.int64)
        for c, f in enumerate(job["chosen"]):
            code = begin + self.bins[f].take(rows)
            total[:, c] = np.bincount(code, gradient, nodes * wide).reshape(nodes, wide)
            n[:, c] = np.bincount(code, minlength=nodes * wide).reshape(nodes, wide)
        total, n = total.reshape(-1), n.reshape(-1)
        seen = np.flatnonzero(n)
        return error, seen, total[seen], n[seen]

    def apply(self, tree: tuple) -> None:
        """Add a finished tree to the predictions."""
        rate, *shape, value = tree
        at = self.at if self.done == self.number else None
        self.score += (rate * value).take(nodes_of(self.bins, *shape, at))
        self.done += 1


def _apply(score: np.ndarray, bins: np.ndarray, tree: tuple) -> None:
    rate, feature, cut, left, value = tree
    score += rate * value[nodes_of(bins, feature, cut, left)]


def _shelf(name: str) -> str:
    """A folder of this executor alone, which Spark removes with the executor."""
    return os.path.join(os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")[0], name)


def _block(name: str, block: int, given: list[bytes]) -> list | None:
    """A block's bins, labels and test marks from files, where they are put if they come with the task; nothing if they are neither here nor there."""
    folder = f"{_shelf(name)}/{block}"
    paths = [f"{folder}/{x}" for x in ("bins", "label", "test")]
    if given:
        os.makedirs(folder, exist_ok=True)
        for path, x in zip(paths, given):
            _write(path, np.frombuffer(x, np.uint8))
        return given
    try:
        return [np.memmap(path, np.uint8, "r") for path in paths]
    except OSError:
        return None


def _write(path: str, x: np.ndarray) -> None:
    """The whole file or none, as a task may run twice."""
    part = f"{path}-{uuid.uuid4().hex}"
    x.tofile(part)
    os.replace(part, path)


def _files(done: int, number: int, steps: int) -> dict[str, str]:
    """Arrays of a state: predictions with ``done`` trees, and rows drawn for tree ``number`` and nodes reached in ``steps``."""
    return {"score": f"s{done}"} | ({"drawn": f"d{number}", "at": f"a{number}.{steps}"} if number >= 0 else {})


def _states(folder: str) -> list[tuple[int, ...]]:
    return sorted(tuple(map(int, f.split("_")[1:])) for f in os.listdir(folder) if f.startswith("state_"))


def _load(name: str, block: int, trial: int, bins: np.ndarray) -> Block | None:
    """The block as this executor left it. Arrays are mapped, not read; changes stay in memory."""
    folder = f"{_shelf(name)}/{block}-{trial}"
    kinds = {"score": float, "drawn": bool, "at": np.uint32}
    try:
        state = _states(folder)[-1]
        x = {k: np.asarray(np.memmap(f"{folder}/{v}", kinds[k], "c")) for k, v in _files(*state).items()}
    except (OSError, ValueError, IndexError):
        return None
    own = Block(block, bins, x["score"], state[0])
    own.saved = state
    _, own.number, own.steps = state
    if own.number >= 0:
        own.drawn, own.at = x["drawn"], x["at"].astype(np.int64)
    return own


def _save(name: str, trial: int, own: Block) -> None:
    """Write the arrays that changed, then a mark that the state is whole; a file once there never changes, as a task may run twice."""
    folder, state = f"{_shelf(name)}/{own.block}-{trial}", (own.done, own.number, own.steps)
    if state == own.saved:
        return
    os.makedirs(folder, exist_ok=True)
    before, after = _files(*own.saved) if own.saved else {}, _files(*state)
    for k, v in after.items():
        if before.get(k) != v:
            _write(f"{folder}/{v}", own.at.astype(np.uint32) if k == "at" else getattr(own, k))
    open(f"{folder}/state_{'_'.join(map(str, state))}", "w").close()
    if own.saved:
        _remove(f"{folder}/state_{'_'.join(map(str, own.saved))}", *(f"{folder}/{v}" for k, v in before.items() if after.get(k) != v))


def _remove(*paths: str) -> None:
    for path in paths:
        try:
            os.unlink(path)
        except FileNotFoundError:
            pass


def _clear(*folders: str) -> None:
    """Remove the files of a block."""
    for folder in filter(os.path.isdir, folders):
        _remove(*(f"{folder}/{f}" for f in os.listdir(folder)))


def _combine(part: int, rows: Iterable[tuple]) -> tuple:
    """The sums of up to ``FAN_IN`` tasks as one, added in the order of the tasks; equal codes are added up."""
    _, codes, sums, counts, errors, tests, missing = zip(*sorted(rows, key=lambda r: r[0]))
    code = np.concatenate([*codes, np.zeros(0, np.int64)])
    seen, at = np.unique(code, return_inverse=True)
    total = np.bincount(at, np.concatenate([*sums, np.zeros(0)]), len(seen))
    n = np.bincount(at, np.concatenate([*counts, np.zeros(0)]), len(seen))
    return part, seen, total, n, np.sum(errors, axis=0), sum(tests), [x for m in missing for x in m]


def grow(
    df: DataFrame, cols: Sequence[str], label: str, trials: list[Trial], bins: int = 256, held_out: float = 0.0, seed: int = 42,
) -> tuple[list[np.ndarray], float]:
    """Grow ``trials`` in place over the rows of ``df`` that have a label, ``held_out`` of them kept aside to measure.

    Returns the bin edges and the value that every prediction starts from, the mean of the label.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "rows")
    plain = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(label).cast("double").alias("_label"))
    plain.write.parquet(path)  # read by three passes; what it comes from may be a long plan
    plain = spark.read.parquet(path)
    known = plain.filter(F.col("_label").isNotNull() & ~F.isnan("_label"))
    n, start = known.agg(F.count("*"), F.avg("_label")).first()
    if not n:
        raise ValueError(f"no row has a {label}")
    edges = bin_edges(known, cols, bins)
    apart = n <= APART_BLOCKS * BLOCK_ROWS
    blocks = -(-n // BLOCK_ROWS)
    dealt = known.coalesce(1) if apart else known.repartition(min(blocks, max(spark.sparkContext.defaultParallelism, blocks // TASK_BLOCKS)))
    blocks = packed_blocks(dealt, cols, "_label", edges, held_out, seed, n if apart else BLOCK_ROWS)
    grower = Grower(spark, blocks, edges, trials, start)
    try:
        grower.run()
    finally:
        grower.close()
    return edges, start


# --- the model as Spark ML stores it ---------------------------------------------------------------

NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, "
    "numCategories: int>>"
)


def _metadata(kind: str, uid: str, params: Mapping[str, Any], **more) -> str:
    import pyspark

    return json.dumps({
        "class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": pyspark.__version__,
        "uid": uid, "paramMap": dict(params), "defaultParamMap": {"featuresCol": "features", "impurity": "variance", "labelCol": "label", "predictionCol": "prediction"},
        **more,
    })


def as_spark_model(
    spark: SparkSession, trial: Trial, edges: list[np.ndarray], start: float, features: str, label: str, predicted: str
) -> GBTRegressionModel:
    """The ensemble in Spark ML's own files, read back as its model: scored in the JVM, also on streams.

    The mean is a first tree of one leaf; the others weigh ``rate``. A node's gain is per row of it, so that Spark's importance
    of a feature is the sum of the gains of its splits.
    """
    rows = [(0, (0, start, 0.0, [1.0, start, 0.0], 1, -1.0, -1, -1, (-1, [], -1)))]
    for number, tree in enumerate(trial.trees, 1):
        for i in range(len(tree.feature)):
            stats = [tree.n[i], -tree.total[i], 0.0]
            leaf = tree.feature[i] < 0
            if leaf:
                split, gain, left = (-1, [], -1), -1.0, -1
            else:
                edge = edges[tree.feature[i]]
                cut = float(edge[tree.cut[i]]) if tree.cut[i] < len(edge) else float("inf")
                split, gain, left = (tree.feature[i], [cut], -1), tree.gain[i] / max(tree.n[i], 1.0), tree.left[i]
            rows.append((number, (i, tree.value(i), 0.0, stats, int(tree.n[i]), gain, left, -1 if leaf else left + 1, split)))
    path = scratch_path(spark, "learner")
    params = {"featuresCol": features, "labelCol": label, "predictionCol": predicted}
    about = _metadata("GBTRegressionModel", f"boost_{uuid.uuid4().hex[:12]}", params, numFeatures=len(edges), numTrees=len(trial.trees) + 1)
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    trees = [
        (i, _metadata("DecisionTreeRegressionModel", f"tree_{uuid.uuid4().hex[:12]}", {}), 1.0 if i == 0 else trial.rate)
        for i in range(len(trial.trees) + 1)
    ]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(rows, NODES).write.parquet(f"{path}/data")
    return GBTRegressionModel.load(path)
