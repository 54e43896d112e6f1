"""Line deduplication over a sharded minimal perfect hash.

A line's key is the line without white space at both ends, A-Z lower-cased. Keys of at least
``min_chars`` code points that ``min_docs`` documents hold lose all their lines but those of the largest
document id.

1. Documents go to blocks. Each block sends every distinct key hash (128 bits) once to the hash's shard, with
   the number of its documents and the largest id: a line found everywhere costs one row per block.
2. Each shard builds a minimal perfect hash over its distinct hashes, which indexes compact arrays:
   fingerprint, count (held at 255) and last holder. The rows that the blocks sent probe the arrays, and
   what may be dropped goes back to the block.
3. Each block rewrites its documents. Texts move once, packed; lines themselves never move or join.

Shard and block counts follow the bytes of text, and a key has at least ``min_chars`` bytes, so neither
outgrows a task.

Defined cases: a null or empty text is one empty line and gives an empty text; every row is a document, so rows
that share an id count one by one and the line stays in all rows of the largest id; a null id is below all
others; an empty table gives no rows; further columns stay, except that ``n_lines`` and ``n_dropped`` are
replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, types as T

from tidegrid.llm import blocks
from tidegrid.llm.words import ids, mix64, slices

BLANK = " \t\n\x0b\x0c\r"
SHARD_BYTES = 1 << 20


def line_keys(lines: list[str], min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lines have a key that counts, and the 128-bit hashes of those keys (n x 2)."""
    at, digests = [], []
    digest = xxhash.xxh3_128_digest
    for i, line in enumerate(lines):
        key = line.strip(BLANK)
        if len(key) >= min_chars:
            at.append(i)
            digests.append(digest(key.encode().lower()))  # bytes.lower() knows A-Z only
    return np.array(at, np.int64), np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bit arrays, ranked.

    On each level a key takes a bit; keys alone on theirs are done, the others go on to the next level.
    """

    GAMMA, STEP = 2, 64

    def __init__(self, keys: np.ndarray):
        self.levels, base = [], 0
        while len(keys):
            size = -(-self.GAMMA * len(keys) // self.STEP) * self.STEP
            at = self._at(keys, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            words = alone.reshape(-1, self.STEP)
            rank = base + np.concatenate(([0], np.cumsum(words.sum(axis=1))))
            self.levels.append((size, np.packbits(alone, bitorder="little"), rank.astype(np.int64)))
            base = int(rank[-1])
            keys = keys[~alone[at]]
        self.size = base

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """0 .. size - 1 for the keys it was built of; any value, or -1, for others."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, bits, rank) in enumerate(self.levels):
            if not len(left):
                break
            at = self._at(keys[left], level, size)
            hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            at, done = at[hit], left[hit]
            word = bits.view("<u8")[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            out[done] = rank[at >> 6] + np.bitwise_count(word)
            left = left[~hit]
        return out


class LineIndex:
    """Fingerprint, count and last holder of every distinct line hash of a shard."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, holders: np.ndarray):
        order = np.lexsort((hashes[:, 1], hashes[:, 0]))
        hashes, counts, holders = hashes[order], counts[order], holders[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        hashes = hashes[first]
        counts, holders = np.add.reduceat(counts, first), np.maximum.reduceat(holders, first)
        twin = np.zeros(len(hashes), bool)  # same first half, other second half: kept beside the arrays
        twin[1:] = hashes[1:, 0] == hashes[:-1, 0]
        self.twins = {
            tuple(h): (int(c), int(d)) for h, c, d in zip(hashes[twin].tolist(), counts[twin], holders[twin])
        }
        hashes, counts, holders = hashes[~twin], counts[~twin], holders[~twin]
        self.hash = PerfectHash(hashes[:, 0])
        at = self.hash.index(hashes[:, 0])
        self.prints = np.zeros(len(at), np.uint32)
        self.counts = np.zeros(len(at), np.uint8)
        self.holders = np.zeros(len(at), np.int64)
        self.prints[at] = hashes[:, 1].astype(np.uint32)
        self.counts[at] = np.minimum(counts, 255)
        self.holders[at] = holders

    def probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (0 if unknown) and last holder of each hash."""
        at = self.hash.index(hashes[:, 0])
        known = (at >= 0) & (self.prints[at] == hashes[:, 1].astype(np.uint32))
        counts, holders = np.where(known, self.counts[at], 0).astype(np.int64), self.holders[at].copy()
        if self.twins:
            for i in np.flatnonzero(~known):
                counts[i], holders[i] = self.twins.get(tuple(hashes[i].tolist()), (0, 0))
        return counts, holders


def _hash_columns(hashes: np.ndarray) -> list[pa.Array]:
    signed = np.ascontiguousarray(hashes).view(np.int64)
    return [pa.array(signed[:, 0].copy()), pa.array(signed[:, 1].copy())]


def _hashes(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column("h1").to_numpy(), batch.column("h2").to_numpy()], axis=1).view(np.uint64)


def _documents(body: bytes, doc_id: str, text: str):
    for whole in blocks.from_bytes(body):
        for batch in slices(whole, text):
            yield batch, ids(batch.column(doc_id)), [(t or "").split("\n") for t in batch.column(text).to_pylist()]


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """``docs`` with shortened texts, and ``n_lines`` (before dropping) and ``n_dropped``."""
    if not 1 <= min_docs <= 255:
        raise ValueError("min_docs must be from 1 to 255, the largest count the arrays hold")
    docs = docs.drop("n_lines", "n_dropped")
    size = blocks.text_size(docs, text)
    n_blocks, n_shards = blocks.n_blocks(size), blocks.n_blocks(size, SHARD_BYTES)
    bodies = blocks.packed(docs, n_blocks, doc_id, text)

    def distinct_keys(batches):
        for block, pieces in blocks.by_key(batches, "block"):
            found, owner = [], []
            for piece in pieces:
                for body in piece.column("body"):
                    for _, owners, texts in _documents(body.as_py(), doc_id, text):
                        for who, lines in zip(owners, texts):
                            hashes = line_keys(lines, min_chars)[1]
                            if len(hashes):
                                found.append(np.unique(hashes, axis=0) if len(hashes) > 1 else hashes)
                                owner.append(np.full(len(found[-1]), who, np.int64))
            if not found:
                continue
            hashes, owner = np.concatenate(found), np.concatenate(owner)
            order = np.lexsort((hashes[:, 1], hashes[:, 0]))
            hashes, owner = hashes[order], owner[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]).any(axis=1)
            first = np.flatnonzero(new)
            hashes, n = hashes[first], len(first)
            counts = np.diff(np.append(first, len(owner)))
            shard = (mix64(hashes[:, 0]) % np.uint64(n_shards)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(np.full(n, block, np.int32)), *_hash_columns(hashes),
                 pa.array(counts.astype(np.int64)), pa.array(np.maximum.reduceat(owner, first))],
                names=["shard", "block", "h1", "h2", "n", "holder"],
            )

    def probe(batches):
        for _, pieces in blocks.by_key(batches, "shard"):
            rows = pa.Table.from_batches(list(pieces)).combine_chunks().to_batches()[0]
            hashes = _hashes(rows)
            index = LineIndex(hashes, rows.column("n").to_numpy(), rows.column("holder").to_numpy())
            counts, holders = index.probe(hashes)
            repeated = counts >= min_docs
            block = rows.column("block").to_numpy()[repeated]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), pa.array(np.zeros(len(block), np.int32)), *_hash_columns(hashes[repeated]), pa.array(holders[repeated])],
                names=["block", "kind", "h1", "h2", "holder"],
            )

    names = [f.name for f in docs.schema.fields]
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def rewrite(batches):
        for _, pieces in blocks.by_key(batches, "block"):
            last: dict[bytes, int] = {}
            for piece in pieces:
                answers = piece.filter(pc.equal(piece.column("kind"), 0))  # they sort before documents
                raw = _hashes(answers).tobytes()
                last.update(zip((raw[i : i + 16] for i in range(0, len(raw), 16)), answers.column("holder").to_pylist()))
                for body in piece.filter(pc.equal(piece.column("kind"), 1)).column("body"):
                    for batch, owners, texts in _documents(body.as_py(), doc_id, text):
                        kept, n_lines, n_dropped = [], [], []
                        for who, lines in zip(owners.tolist(), texts):
                            at, hashes = line_keys(lines, min_chars)
                            raw, gone = hashes.tobytes(), set()
                            for j, i in enumerate(at.tolist()):
                                holder = last.get(raw[16 * j : 16 * j + 16])
                                if holder is not None and holder != who:
                                    gone.add(i)
                            n_lines.append(len(lines))
                            n_dropped.append(len(gone))
                            kept.append("\n".join([x for i, x in enumerate(lines) if i not in gone] if gone else lines))
                        columns = [pa.array(kept, batch.schema.field(c).type) if c == text else batch.column(c) for c in names]
                        yield pa.RecordBatch.from_arrays(
                            [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                            names=[*names, "n_lines", "n_dropped"],
                        )

    keys = bodies.repartition("block").sortWithinPartitions("block").mapInArrow(
        distinct_keys, "shard int, block int, h1 long, h2 long, n long, holder long"
    )
    answers = keys.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        probe, "block int, kind int, h1 long, h2 long, holder long"
    )
    return answers.unionByName(bodies, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(rewrite, schema)
