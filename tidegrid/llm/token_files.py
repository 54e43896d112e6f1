"""Token ids of documents as Parquet files in id order, with positions, made for reading parts of them.

``write_tokens`` range-partitions the documents by id, sorts each part, encodes it and lets Spark's own Parquet
writer store one row per document:

| column | what | encoding |
| --- | --- | --- |
| ``part`` int | number of the range part, ascending with the ids | run lengths of zero deltas |
| ``doc_id`` long | the document | delta |
| ``begin`` long | token ids of the part before this document | delta |
| ``n_tokens`` long | its token ids, with the end id | delta |
| ``ids`` array<int> | the ids | dictionary (bit-packed) or delta |

Row groups, pages and rows per page have set sizes and the files carry page indexes, so a range of ids or positions
touches the pages that hold it, and metadata is read without any token column. ``parts`` beside the ``tokens``
folder has one row per part: how many ids lie before it. A document's position in the whole corpus is that plus ``begin``.

Words between ASCII white space are encoded once per worker while they are remembered: no normaliser step, split or merge of
a tokenizer that drops white space before it splits reaches across it. Plain texts are split further, by the tokenizer's own
pattern, and only its model is asked about new pieces. ``whole=True`` encodes texts in one go, for
tokenizers of any other kind.

Defined cases: null and empty texts hold the end id alone; a null ``doc_id`` comes before all others; rows with one id are
ordered by a hash of the text, then by the text; repeated rows are all written; an empty table gives files without rows;
further columns are not stored. A very long text is one row; encoding it by words needs no more than it and its ids.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tidegrid.llm.blocks import text_size
from tidegrid.llm.words import slices, text_bytes

SCHEMA = "part int, doc_id long, begin long, n_tokens long, ids array<int>"
PARTS = "part int, before long, n long"
#: Text of one file, and the least that makes a further file worth while on few documents.
FILE_BYTES, LEAST_BYTES = 64 << 20, 1 << 20
#: Text that a task encodes at a time.
SLICE_BYTES = 2 << 20
#: Fixed value: the split of the word tokenizer, in which white space falls away and letters, digits and signs are tokens apart.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of printable ASCII, white space and Latin letters and signs: composing changes none of them, lower case goes letter by letter.
PLAIN = "^[\t-\r -~\u00a1-\u012f\u0131-\u017f]*$"
#: Code points that plain texts may hold, as white space (0), letters (1), numbers (2) and signs (3).
KINDS = np.array([0 if chr(c).isspace() else {"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 3) for c in range(0x250)], np.uint8)
#: Bytes of remembered words or pieces after which a worker starts to remember anew.
MEMO_BYTES = 64 << 20


@dataclass(frozen=True)
class Layout:
    """How files are cut. ``encoding`` of the ids is ``dictionary`` or ``delta``."""

    encoding: str = "dictionary"
    row_group: int = 32 << 20
    page: int = 256 << 10
    page_rows: int = 2048
    dictionary: int = 1 << 20
    codec: str = "zstd"

    def options(self) -> dict[str, str]:
        if self.encoding not in ("dictionary", "delta"):
            raise ValueError(f"encoding {self.encoding!r} is neither dictionary nor delta")
        return {
            "compression": self.codec,
            "parquet.writer.version": "PARQUET_2_0",  # integers without a dictionary are stored as deltas
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": str(self.encoding == "dictionary").lower(),
            "parquet.dictionary.page.size": str(self.dictionary),
            "parquet.block.size": str(self.row_group),
            "parquet.page.size": str(self.page),
            "parquet.page.row.count.limit": str(self.page_rows),
        }


class Codes(dict):
    """Number of each string seen; new ones wait in ``new`` until they are encoded."""

    def __init__(self):
        super().__init__()
        self.new: list = []
        self.size = 0

    def __missing__(self, string: bytes | str) -> int:
        self[string] = code = len(self)
        self.new.append(string)
        self.size += len(string) + 100
        return code

    def numbers(self, strings: Iterable[bytes | str], n: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, strings), np.int64, n)


class Known:
    """Strings with their token ids, one after the other."""

    def __init__(self):
        self.codes, self.flat, self.counts = Codes(), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def learn(self, flat: np.ndarray, counts: np.ndarray) -> None:
        """The ids of the strings in ``codes.new``."""
        self.codes.new.clear()
        self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])

    def ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[codes]
        return runs(self.flat, (np.cumsum(self.counts) - self.counts)[codes], counts), counts


def group_sums(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of ``sizes`` counts."""
    total = np.concatenate([[0], np.cumsum(counts)])
    edge = np.concatenate([[0], np.cumsum(sizes)])
    return total[edge[1:]] - total[edge[:-1]]


def flat_lists(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(counts.sum())), counts


@cache
def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, as letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def plain_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Plain texts in lower case, split as ``SPLIT`` does: all pieces one after the other, and how many each text has."""
    lower = pc.utf8_lower(texts)
    data, _ = text_bytes(lower)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    edge = np.concatenate([[0], np.cumsum(pc.utf8_length(lower).to_numpy(zero_copy_only=False))]).astype(np.int64)
    kind = KINDS[points]
    first = np.zeros(len(points) + 3, bool)  # of a text; behind the last one too
    first[edge] = True
    first[len(points) :] = True
    fresh = first[: len(points)].copy()
    fresh[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    # 's and the like: an apostrophe that no sign stands before takes one or two letters along.
    mark = np.flatnonzero((points == ord("'")) & fresh)
    ahead = np.concatenate([points, np.zeros(3, np.uint32)])
    one, two = ahead[mark + 1], ahead[mark + 2]
    short = np.isin(one, list(map(ord, "stmd"))) & ~first[mark + 1]
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    pair &= ~first[mark + 1] & ~first[mark + 2]
    fresh[mark[short | pair] + 1] = False
    behind = np.concatenate([mark[short] + 2, mark[pair] + 3])
    fresh[behind[behind < len(points)]] = True
    kept = kind > 0
    starts = np.flatnonzero(fresh & kept)
    width = np.cumsum(np.where(points[kept] < 0x80, 1, 2))
    body = points[kept].tobytes().decode("utf-32-le").encode()
    before = np.concatenate([[0], width])
    offsets = np.append(before[(np.cumsum(kept) - 1)[starts]], len(body)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return pieces, np.diff(np.searchsorted(starts, edge))


class Encoder:
    """Token ids of texts, as one flat array and the number of ids of each text."""

    def __init__(self, tokenizer: str, whole: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread; Spark runs several
        from tokenizers import Tokenizer

        self.tokenizer, self.whole = Tokenizer.from_file(tokenizer), whole
        about = json.loads(self.tokenizer.to_str())
        before = (about["pre_tokenizer"] or {}).get("pretokenizers", [])
        split = [x.get("pattern", {}).get("Regex") for x in before]
        byte_level = any(x["type"] == "ByteLevel" and not x.get("use_regex") for x in before)
        cases = [x["type"] for x in (about["normalizer"] or {}).get("normalizers", [])]
        self.splits = split[:1] == [SPLIT] and byte_level and cases[-1:] == ["Lowercase"] and about["post_processor"] is None
        self.special = [t["content"] for t in about["added_tokens"]]
        self.letters = {b: c for c, b in byte_of_letter().items()}
        self.words, self.pieces = Known(), Known()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat_lists([e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)])

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What the tokenizer's own split gives goes straight to its model."""
        spelt = (p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in pieces)
        model = self.tokenizer.model
        return flat_lists([[t.id for t in model.tokenize(p)] if p else [] for p in spelt])

    def _plain(self, texts: pa.Array) -> np.ndarray:
        """Texts that may be split here, the way the tokenizer does it."""
        if not self.splits:
            return np.zeros(len(texts), bool)
        out, lower = pc.match_substring_regex(texts, PLAIN), pc.utf8_lower(texts)
        for word in self.special:
            out = pc.and_not(out, pc.or_(pc.match_substring(texts, word), pc.match_substring(lower, word)))
        return out.to_numpy(zero_copy_only=False)

    def _by_parts(self, parts: pa.Array, n: np.ndarray, known: Known, encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that come as ``n`` strings each."""
        distinct = parts.dictionary_encode()
        codes = known.codes.numbers(distinct.dictionary.to_pylist(), len(distinct.dictionary))
        if known.codes.new:
            known.learn(*encode(known.codes.new))
        ids, counts = known.ids(codes[distinct.indices.to_numpy()])
        return ids, group_sums(counts, n)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        if self.whole:
            return self._encode(texts.to_pylist())
        if self.words.codes.size > MEMO_BYTES:
            self.words = Known()
        if self.pieces.codes.size > MEMO_BYTES:
            self.pieces = Known()
        plain = self._plain(texts)
        ids, n = self._by_parts(*plain_pieces(texts.filter(pa.array(plain))), self.pieces, self._encode_pieces)
        words = pc.ascii_split_whitespace(texts.filter(pa.array(~plain)))
        more, n_more = self._by_parts(words.flatten(), pc.list_value_length(words).to_numpy(), self.words, self._encode)
        flat, counts, begins = np.concatenate([ids, more]), np.empty(len(plain), np.int64), np.empty(len(plain), np.int64)
        counts[plain], counts[~plain] = n, n_more
        begins[plain], begins[~plain] = np.cumsum(n) - n, len(ids) + np.cumsum(n_more) - n_more
        return runs(flat, begins, counts), counts


@lru_cache(maxsize=1)
def encoder_of(tokenizer: str, whole: bool) -> Encoder:
    """Kept between the tasks of a Python worker."""
    return Encoder(tokenizer, whole)


def runs(flat: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The values ``flat[begin : begin + count]`` of all runs, one after the other."""
    shift = np.repeat(begins - (np.cumsum(counts) - counts), counts)
    return flat[np.arange(len(shift)) + shift]


def with_end(ids: np.ndarray, counts: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Append the end id to each document."""
    if end is None:
        return ids, counts
    return np.insert(ids, np.cumsum(counts), end).astype(np.int32), counts + 1


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end: int | None = 1, layout: Layout = Layout(), whole: bool = False,
    file_bytes: int = FILE_BYTES, doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Write ``path/tokens`` and ``path/parts``; ``tokenizer`` is a file of the tokenizers library, there on all machines."""
    spark = docs.sparkSession
    size = text_size(docs, text)
    files = max(1, -(-size // file_bytes), min(2 * spark.sparkContext.defaultParallelism, size // LEAST_BYTES))
    order = ["doc_id", "_h", "text"]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("_h", F.xxhash64("text"))
    # The hash lets rows of one id lie in several parts; order and parts follow from the bounds alone.
    ranged = rows.repartitionByRange(int(files), "doc_id", "_h").sortWithinPartitions(*order).select("doc_id", "text")

    def encode(batches):
        encoder, part, before = encoder_of(tokenizer, whole), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES):
                ids, counts = with_end(*encoder(piece.column("text")), end)
                edge = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(piece.num_rows, part, np.int32)), piece.column("doc_id"), pa.array(before + edge[:-1]),
                    pa.array(counts), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids, pa.int32())),
                ], names=["part", "doc_id", "begin", "n_tokens", "ids"])
                before += int(edge[-1])

    ranged.mapInArrow(encode, SCHEMA).write.options(**layout.options()).parquet(f"{path}/tokens")
    totals = spark.read.schema(SCHEMA).parquet(f"{path}/tokens").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), "n").coalesce(1).write.parquet(
        f"{path}/parts"
    )


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens`` and, unless ``ids`` is false, ``ids``. Filters on ``doc_id`` reach the page index."""
    stored = spark.read.schema(SCHEMA).parquet(f"{path}/tokens")
    parts = spark.read.schema(PARTS).parquet(f"{path}/parts").select("part", "before")
    columns = ["doc_id", (F.col("before") + F.col("begin")).alias("start"), "n_tokens", *(["ids"] if ids else [])]
    return stored.join(parts, "part").select(*columns)


def read_positions(spark: SparkSession, path: str, begin: int, end: int) -> DataFrame:
    """``doc_id, start, ids`` of the token positions from ``begin`` up to before ``end``: of each document the piece inside.

    Only parts, row groups and pages that may hold such positions are read.
    """
    parts = spark.read.schema(PARTS).parquet(f"{path}/parts").filter(
        (F.col("before") < end) & (F.col("before") + F.col("n") > begin)
    )
    span = parts.agg(
        F.min("part").alias("first"), F.max("part").alias("last"), F.min_by("before", "part").alias("low"),
        F.max_by("before", "part").alias("high"),
    ).first()
    first, last = (span["first"], span["last"]) if span["first"] is not None else (0, -1)
    stored = spark.read.schema(SCHEMA).parquet(f"{path}/tokens").filter(F.col("part").between(first, last))
    if first <= last:
        stored = stored.filter(
            ((F.col("part") > first) | (F.col("begin") + F.col("n_tokens") > begin - span["low"]))
            & ((F.col("part") < last) | (F.col("begin") < end - span["high"]))
        )
        if first == last:
            stored = stored.filter(F.col("begin") < end - span["high"])
    start = F.col("before") + F.col("begin")
    left = F.greatest(start, F.lit(begin))
    right = F.least(start + F.col("n_tokens"), F.lit(end))
    return stored.join(parts, "part").filter(right > left).select(
        "doc_id", left.alias("start"), F.slice("ids", (left - start + 1).cast("int"), (right - left).cast("int")).alias("ids")
    )


def digests(tokens: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``: CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    kept = [c for c in tokens.columns if c != "ids"]

    def digest(batches):
        for batch in batches:
            column = batch.column("ids")
            edge = column.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(crc, pa.int64())], names=[*kept, "ids_crc32"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema if f.name != "ids")
    return tokens.mapInArrow(digest, f"{schema}, ids_crc32 long")
