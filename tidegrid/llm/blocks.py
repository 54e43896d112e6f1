"""Documents packed into blocks: whole rows, all columns, as compressed Arrow bytes.

A block is a set of documents chosen by a hash of the id. Work that has to reach the documents again
(lines, words to remove) is addressed to blocks, so that what comes back per block is already combined
and a hot line or passage costs one row per block, not one per document. Block counts follow the bytes
of text, so a block stays near ``BLOCK_BYTES`` at every input size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm.words import ids, mix64

BLOCK_BYTES = 2 << 20
#: Text a task gathers before it deals it out; larger pieces compress better and cost memory.
FLUSH_BYTES, PACK_BYTES = 8 << 20, 16 << 20


def text_size(docs: DataFrame, text: str = "text") -> int:
    """Bytes of text in the table: one number, from one scan of the column."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]


def n_blocks(size: int, block: int = BLOCK_BYTES) -> int:
    return max(1, -(-size // block))


def to_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(raw: bytes) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_stream(raw) as given:
        yield from given


def group_rows(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value of the key and the rows that have it."""
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    for rows in np.split(order, cuts):
        yield int(key[rows[0]]), rows


def gathered(batches: Iterator[pa.RecordBatch], text: str | None, limit: int = FLUSH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text."""
    waiting, size = [], 0
    for batch in batches:
        begin = 0
        sizes = np.full(batch.num_rows, 16, np.int64)
        if text is not None:
            sizes += pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        while begin < batch.num_rows:
            used = int(total[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, used + limit - size, side="right")))
            waiting.append(batch.slice(begin, end - begin))
            size += int(total[end - 1]) - used
            begin = end
            if size >= limit or begin < batch.num_rows:
                yield pa.concat_batches(waiting)
                waiting, size = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def packed(docs: DataFrame, blocks: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` as rows ``block, kind = 1, body``: the documents of one block from one piece of input."""

    def pack(batches):
        for batch in gathered(batches, text, PACK_BYTES):
            out = {"block": [], "body": []}
            where = (mix64(ids(batch.column(doc_id)).view(np.uint64)) % np.uint64(blocks)).astype(np.int64)
            for block, rows in group_rows(where):
                out["block"].append(block)
                out["body"].append(to_bytes(batch.take(pa.array(rows))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["block"], pa.int32()), pa.array([1] * len(out["block"]), pa.int32()),
                 pa.array(out["body"], pa.binary())], names=["block", "kind", "body"],
            )

    return docs.mapInArrow(pack, "block int, kind int, body binary")


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Cut a sorted stream of batches where the key changes: each key with its batches, in order."""

    def pieces():
        for batch in batches:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)] if len(values) else []
            for a, b in itertools.pairwise(cuts):
                yield int(values[a]), batch.slice(a, b - a)

    for value, group in itertools.groupby(pieces(), key=lambda piece: piece[0]):
        yield value, (piece for _, piece in group)
