"""Substring deduplication by super-k-mer partitioning, on words.

A window is ``width`` consecutive words of one document. Every word covered by a window whose word sequence also
starts earlier (smaller id, or same document and earlier start) goes; windows are judged on the input.

1. Seeds (``seed``-word sequences) that occur more than once per ``HEAVY_BYTES`` of text are heavy: there are at most
   ``HEAVY_BYTES`` / 2 of them. A minimiser is the least seed hash inside a window, heavy seeds coming after all
   others, so a line that stands in very many documents draws no windows but those it fills alone.
2. Each document is cut into super-k-mers: runs of windows that share a minimiser. A run travels once, as one
   packed string of words, to the bucket of its minimiser; equal windows have equal minimisers and so meet in one
   bucket. A task that sees a string again and again sends it once and answers the later ones itself, so a passage
   found everywhere costs a bucket one string per task.
3. Each bucket sorts its windows by hash, compares the words of equal hashes byte by byte, and finds the earliest
   start of each word sequence. Runs of repeated windows become word ranges, addressed to the blocks of their
   documents.
4. Each block takes the ranges out of its documents.

Bucket and block counts follow the bytes of text. Ids of several rows: a row is known by its id and a
hash of its text; rows that share an id are one document as far as "earlier" goes, and equal rows share
their fate.

Defined cases: null or empty texts have no words and give an empty text; documents shorter than a window stay
whole; a null id is below all others; an empty table gives no rows; further columns stay, except that
``n_words`` and ``n_removed`` are replaced. Kept words are joined by one space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from tidegrid.llm import blocks
from tidegrid.llm.words import ids, mix64, run_hash, run_starts, slices, span_hash, text_bytes, word_spans

BUCKET_BYTES = 4 << 20
#: Strings a task remembers to answer repeats itself; beyond it, repeats travel.
REMEMBERED = 50_000
HEAVY_BYTES = 1 << 20


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """Least of every n consecutive values."""
    out, have = values, 1
    while have < n:
        step = min(have, n - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def text_tags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """32 bits of a hash of each whole text."""
    return (span_hash(data, offsets[:-1], offsets[1:]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def one_spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with one space behind each, and where they lie now."""
    length = ends - starts
    begin = np.cumsum(length + 1) - (length + 1)
    out = np.full(int((length + 1).sum()), 32, np.uint8)
    shift = np.repeat(begin - starts, length)
    source = np.arange(len(shift)) + np.repeat(starts - (np.cumsum(length) - length), length)
    out[source + shift] = data[source]
    return out.tobytes(), begin, begin + length


def heavy_seeds(docs: DataFrame, seed: int, size: int, text: str) -> np.ndarray:
    """Hashes of the heavy seeds, ascending; pieces of text in which a seed is rare do not count for it."""

    def count(batches):
        for flush in blocks.gathered(batches, text):
            found = []
            for piece in slices(flush, text):
                data, offsets = text_bytes(piece.column(text))
                starts, ends, first = word_spans(data, offsets)
                found.append(run_hash(span_hash(data, starts, ends), seed)[run_starts(first, seed)[0]])
            values, n = np.unique(np.concatenate(found), return_counts=True)
            often = n >= 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["seed", "n"]
            )

    counts = docs.select(text).mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    found = counts.filter(F.col("n") >= max(16, size // HEAVY_BYTES)).select("seed").toArrow()
    return np.sort(found.column("seed").to_numpy().view(np.uint64))


class SeedOrder:
    """Ranks seeds by hash, heavy ones last."""

    FILTER_BITS = 20

    def __init__(self, heavy: np.ndarray):
        self.heavy = heavy
        self.seen = np.zeros(1 << self.FILTER_BITS, bool)
        self.seen[(heavy >> np.uint64(64 - self.FILTER_BITS)).astype(np.int64)] = True

    def rank(self, seeds: np.ndarray) -> np.ndarray:
        out = seeds >> np.uint64(1)
        if len(self.heavy):
            maybe = np.flatnonzero(self.seen[(seeds >> np.uint64(64 - self.FILTER_BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.heavy, seeds[maybe]), len(self.heavy) - 1)
            out[maybe[self.heavy[at] == seeds[maybe]]] |= np.uint64(1 << 63)
        return out


def super_kmers(data: np.ndarray, offsets: np.ndarray, width: int, seed: int, order: SeedOrder):
    """Packed words, and per run: minimiser, text, first word within its text, begin and end byte."""
    starts, ends, first = word_spans(data, offsets)
    at, text = run_starts(first, width)
    if not len(at):
        return None
    least = sliding_min(order.rank(run_hash(span_hash(data, starts, ends), seed)), width - seed + 1)[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(at)) - 1
    body, begin, end = one_spaced(data, starts, ends)
    return body, least[head], text[head], at[head] - first[text[head]], begin[at[head]], end[at[last] + width - 1]


def repeated_windows(body: bytes, docs: np.ndarray, firsts: np.ndarray, width: int):
    """Of the strings in ``body`` (one per line): which windows start earlier elsewhere.

    Returns the string of each window, its place in the string, and the verdict.
    """
    data = np.frombuffer(body, np.uint8)
    breaks = np.flatnonzero(data == 10)
    offsets = np.concatenate(([0], breaks, [len(data)]))
    starts, ends, first = word_spans(data, offsets)
    at, owner = run_starts(first, width)
    key = run_hash(span_hash(data, starts, ends), width)[at]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twin = np.zeros(len(key), bool)
    twin[order[1:][same]] = True
    twin[order[:-1][same]] = True
    rows = np.flatnonzero(twin)
    verdict = np.zeros(len(key), bool)
    if len(rows):
        place = firsts[owner[rows]] + at[rows] - first[owner[rows]]
        order = np.lexsort((place, docs[owner[rows]], key[rows]))
        rows, place = rows[order], place[order]
        begin, end = starts[at[rows]].tolist(), ends[at[rows] + width - 1].tolist()
        keys, who = key[rows].tolist(), docs[owner[rows]].tolist()
        earliest: dict[bytes, tuple[int, int]] = {}
        current, head = None, b""
        for i, (k, a, b) in enumerate(zip(keys, begin, end)):
            words = body[a:b]
            mine = (who[i], int(place[i]))
            if k != current:
                current, head, first_of_head, earliest = k, words, mine, {}
                continue
            found = first_of_head if words == head else earliest.setdefault(words, mine)
            verdict[rows[i]] = mine > found
    return owner, at - first[owner], verdict


def word_ranges(owner: np.ndarray, offset: np.ndarray, verdict: np.ndarray, width: int):
    """Runs of repeated windows as word ranges: string, first word, end, both within the string."""
    on = np.flatnonzero(verdict)
    if not len(on):
        return on, on, on
    new = np.ones(len(on), bool)
    new[1:] = (np.diff(on) != 1) | (owner[on][1:] != owner[on][:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(on)) - 1
    return owner[on[head]], offset[on[head]], offset[on[tail]] + width


def _ints(values) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values, np.int64).tobytes(), 1)


def _from_ints(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), np.int64)


ROWS = "bucket int, kind int, body binary, doc binary, tag binary, place binary, until binary"


def _row(bucket: int, kind: int, body: bytes, *numbers) -> tuple:
    return (bucket, kind, body, *map(_ints, numbers))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
    names = ["bucket", "kind", "body", "doc", "tag", "place", "until"]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names
    )


def drop_repeats(docs: DataFrame, width: int = 20, seed: int = 3, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``docs`` with kept words as text, and ``n_words`` and ``n_removed``."""
    docs = docs.drop("n_words", "n_removed")
    size = blocks.text_size(docs, text)
    # A word comes to its bucket about three times: windows of neighbouring runs overlap.
    n_buckets, n_blocks = blocks.n_blocks(3 * size, BUCKET_BYTES), blocks.n_blocks(size)
    bodies = blocks.packed(docs, n_blocks, doc_id, text)
    order = SeedOrder(heavy_seeds(docs, seed, size, text))

    def cut(batches):
        known: dict[bytes, tuple[int, int]] = {}
        for flush in blocks.gathered(batches, text):
            send: dict[int, list] = {}
            again: list[tuple[int, int, int, int]] = []
            for piece in slices(flush, text):
                data, offsets = text_bytes(piece.column(text))
                runs = super_kmers(data, offsets, width, seed, order)
                if runs is None:
                    continue
                packed, least, owner, place, begin, end = runs
                who, tag = ids(piece.column(doc_id))[owner], text_tags(data, offsets)[owner]
                shape = span_hash(np.frombuffer(packed, np.uint8), begin, end)
                _, back, n = np.unique(shape, return_inverse=True, return_counts=True)
                often = (n[back] > 1).tolist()
                bucket = (mix64(least) % np.uint64(n_buckets)).astype(np.int64)
                for i, (b, w, t, p, x, y, many) in enumerate(
                    zip(bucket.tolist(), who.tolist(), tag.tolist(), place.tolist(), begin.tolist(), end.tolist(), often)
                ):
                    words = packed[x:y]
                    before = known.get(words)
                    if before is not None and before < (w, p):
                        again.append((w, t, p, p + words.count(b" ") + 1))
                        continue
                    if before is not None or (many and len(known) < REMEMBERED):
                        known[words] = (w, p)
                    send.setdefault(b, []).append((words, w, t, p))
            rows = [
                _row(b, 0, zstandard.compress(b"\n".join([r[0] for r in runs]), 1),
                     [r[1] for r in runs], [r[2] for r in runs], [r[3] for r in runs], [])
                for b, runs in send.items()
            ]
            if again:
                w, t, p, u = np.array(again, np.int64).T
                rows.append(_row(int(w[0] % n_buckets), 1, b"", w, t, p, u))
            if rows:
                yield _batch(rows)

    def ranges_of(doc, tag, begin, until):
        where = (mix64(doc.view(np.uint64)) % np.uint64(n_blocks)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(where), pa.array(np.zeros(len(doc), np.int32)), *(pa.array(x) for x in (doc, tag, begin, until))],
            names=["block", "kind", "doc", "tag", "begin", "until"],
        )

    def judge(batches):
        for _, pieces in blocks.by_key(batches, "bucket"):
            strings, numbers = [], []
            for piece in pieces:
                for row in piece.to_pylist():
                    doc, tag, place = _from_ints(row["doc"]), _from_ints(row["tag"]), _from_ints(row["place"])
                    if row["kind"] == 1:
                        yield ranges_of(doc, tag, place, _from_ints(row["until"]))
                    else:
                        strings.append(zstandard.decompress(row["body"]))
                        numbers.append((doc, tag, place))
            if strings:
                doc, tag, place = (np.concatenate(x) for x in zip(*numbers))
                owner, begin, until = word_ranges(*repeated_windows(b"\n".join(strings), doc, place, width), width)
                if len(owner):
                    yield ranges_of(doc[owner], tag[owner], place[owner] + begin, place[owner] + until)

    names = [f.name for f in docs.schema.fields]
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def rewrite(batches):
        for _, pieces in blocks.by_key(batches, "block"):
            answers, found = [], None
            for piece in pieces:
                answers.append(piece.filter(pc.equal(piece.column("kind"), 0)))
                for body in piece.filter(pc.equal(piece.column("kind"), 1)).column("body"):
                    if found is None:
                        found = _by_document(answers)
                    for whole in blocks.from_bytes(body.as_py()):
                        for batch in slices(whole, text):
                            yield _without(batch, found, doc_id, text, names)

    strings = docs.select(doc_id, text).mapInArrow(cut, ROWS)
    answers = strings.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        judge, "block int, kind int, doc long, tag long, begin long, until long"
    )
    return answers.unionByName(bodies, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(rewrite, schema)


def _by_document(answers: list[pa.RecordBatch]):
    """Ranges sorted by document: (doc, tag) of each, begin, until, and a lookup of rows by (doc, tag)."""
    doc, tag, begin, until = (
        np.concatenate([a.column(c).to_numpy() for a in answers]) for c in ("doc", "tag", "begin", "until")
    )
    order = np.lexsort((tag, doc))
    doc, tag, begin, until = doc[order], tag[order], begin[order], until[order]
    if not len(doc):
        return {}, begin, until
    cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(tag) != 0)) + 1
    heads, tails = np.append(0, cuts).tolist(), np.append(cuts, len(doc)).tolist()
    return {(int(doc[a]), int(tag[a])): (a, b) for a, b in zip(heads, tails)}, begin, until


def _without(batch: pa.RecordBatch, found, doc_id: str, text: str, names: list[str]) -> pa.RecordBatch:
    where, begin, until = found
    data, offsets = text_bytes(batch.column(text))
    tags = text_tags(data, offsets).tolist()
    raw, kept, n_words, n_removed = data.tobytes(), [], [], []
    for who, tag, a, b in zip(ids(batch.column(doc_id)).tolist(), tags, offsets[:-1].tolist(), offsets[1:].tolist()):
        words = raw[a:b].split()  # bytes.split() cuts at [\x20\x09-\x0D]
        n_words.append(len(words))
        rows = where.get((who, tag))
        if rows is not None:
            depth = np.zeros(len(words) + 1, np.int64)
            np.add.at(depth, begin[rows[0] : rows[1]], 1)
            np.add.at(depth, until[rows[0] : rows[1]], -1)
            stays = np.cumsum(depth)[:-1] == 0
            words = [words[i] for i in np.flatnonzero(stays).tolist()]
        n_removed.append(n_words[-1] - len(words))
        kept.append(b" ".join(words))
    column = pa.array(kept, pa.binary()).cast(batch.schema.field(text).type)
    return pa.RecordBatch.from_arrays(
        [*(column if c == text else batch.column(c) for c in names), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
        names=[*names, "n_words", "n_removed"],
    )
