"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of letters and digits, and runs of other signs. Features are hashed n-grams of one and two tokens, and one
each for "the token before again" and "the one before that again", whatever the token, with log counts scaled to length 1. Training reads at most ``SAMPLE`` labelled documents (those with the least hash of their
id), whole texts; the number of rows is the bound, so one task can hold them. Features are made in parallel; the
updates, which follow one another by nature, run in one task, and the model is one value of at most
``2 ** BITS`` weights. Scoring is a sparse dot product per document, in Arrow batches, without a shuffle.

Defined cases: null or empty texts have no features and get the score of the bias; labels that are null or other than 0
and 1 are not learned from; of several labels of an id the largest counts, of several texts the largest; without
labels the model is 0 and every score 0.5; repeated rows are scored alike; an empty table gives no rows;
further columns stay, except that ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegrid.llm.words import mix64, run_hash, run_starts, slices, span_hash, text_bytes

BITS = 18
SAMPLE = 8192
_KIND = np.full(256, 1, np.uint8)  # letters, digits and all bytes beyond ASCII
_KIND[:128] = 2
for _a, _b in ((48, 57), (65, 90), (97, 122)):
    _KIND[_a : _b + 1] = 1
_KIND[[9, 10, 11, 12, 13, 32]] = 0


def token_spans(data: np.ndarray, offsets: np.ndarray):
    """Begin and end of each token, and the first token of each text (n + 1 values)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    edge[[0, -1]] = True
    cuts = np.flatnonzero(edge)
    real = kind[cuts[:-1]] > 0
    starts, ends = cuts[:-1][real], cuts[1:][real]
    return starts, ends, np.searchsorted(starts, offsets)


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS, orders: tuple[int, ...] = (1, 2)):
    """Bins and values of each text, text by text, and where each text's begin (n + 1 values)."""
    starts, ends, first = token_spans(data, offsets)
    tokens = span_hash(data, starts, ends)
    bins, owners = [], []
    for n in orders:
        at, text = run_starts(first, n)
        bins.append((mix64(run_hash(tokens, n)[at] + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(text)
    for back in range(1, max(orders) + 1):
        at, text = run_starts(first, back + 1)
        again = tokens[at] == tokens[at + back]
        bins.append(np.full(again.sum(), int(mix64(np.array([back]))[0] >> np.uint64(64 - bits)), np.int64))
        owners.append(text[again])
    key = np.concatenate(owners) << bits | np.concatenate(bins)
    key, count = np.unique(key, return_counts=True)
    owner, value = key >> bits, np.log1p(count)
    begin = np.searchsorted(owner, np.arange(len(offsets)))
    length = np.sqrt(np.bincount(owner, value * value, minlength=len(offsets) - 1))
    return key & ((1 << bits) - 1), value / length[owner], begin


class FollowTheLeader:
    """Per-coordinate follow-the-proximally-regularised-leader for logistic loss."""

    def __init__(self, bits: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.01, l2: float = 0.1):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)  # the last is the bias
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, bins: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(bins, len(self.z) - 1), np.append(values, 1.0)
        w = self.weights(at)
        g = (sigmoid(w @ x) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def thin(doc_id: Column, wanted: int, n: Column) -> Column:
    """Whether the hash of an id is among the least, a share that leaves about ``wanted`` of ``n`` rows."""
    return F.xxhash64(doc_id).cast("double") <= F.lit(-(2.0**63)) + 2.0**64 * F.lit(float(wanted)) / F.greatest(n, F.lit(1))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` rows ``text, label``: the labelled documents with the least hash of their id."""
    known = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    # Twice the share that is needed, by hash; only those are sorted.
    ids = known.filter(thin(F.col("doc_id"), 2 * sample, F.lit(known.count()))).groupBy("doc_id").agg(
        F.max("label").cast("int").alias("label")
    ).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # ``ids`` has at most ``sample`` rows of two numbers.
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))


def train(sample: DataFrame, bits: int = BITS, rounds: int = 3) -> np.ndarray:
    """Weights by bin, the bias last, from rows ``doc_id, text, label``."""

    def vectors(batches):
        for batch in batches:
            for piece in slices(batch):
                data, offsets = text_bytes(piece.column("text"))
                bins, values, begin = features(data, offsets, bits)
                cut = [(bins[a:b].astype(np.int32).tobytes(), values[a:b].tobytes()) for a, b in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("label"), pa.array([c[0] for c in cut], pa.binary()),
                     pa.array([c[1] for c in cut], pa.binary())], names=["doc_id", "label", "bins", "vals"],
                )

    def fit(batches):
        rows = [r for batch in batches for r in batch.to_pylist()]
        rows = [(r["label"], np.frombuffer(r["bins"], np.int32), np.frombuffer(r["vals"])) for r in sorted(rows, key=_order)]
        model = FollowTheLeader(bits)
        for _ in range(rounds if len({r[0] for r in rows}) == 2 else 0):
            for label, bins, values in rows:
                model.learn(bins, values, label)
        w = model.weights(np.arange((1 << bits) + 1))
        yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()], pa.binary())], names=["model"])

    vecs = sample.mapInArrow(vectors, "doc_id long, label int, bins binary, vals binary")
    found = vecs.repartition(1).mapInArrow(fit, "model binary").first()
    return np.frombuffer(found["model"], np.float32).astype(np.float64) if found else np.zeros((1 << bits) + 1)


def _order(row: dict) -> int:
    """A fixed random order of documents, so that neither ids nor files decide what comes last."""
    return int(mix64(np.array([row["doc_id"]], np.int64).view(np.uint64))[0])


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    docs = docs.drop("score", "predicted")
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for batch in batches:
            for piece in slices(batch, text):
                data, offsets = text_bytes(piece.column(text))
                bins, values, begin = features(data, offsets, bits)
                owner = np.repeat(np.arange(piece.num_rows), np.diff(begin))
                found = sigmoid(np.bincount(owner, weights[bins] * values, minlength=piece.num_rows) + weights[-1])
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in names), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    names=[*names, "score", "predicted"],
                )

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
