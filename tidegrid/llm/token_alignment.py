"""Alignment of two tokenizers' tokens over a corpus, by white-space anchors.

Each text is encoded whole by both tokenizers. Then

1. **anchors**: byte offsets before a space-marked token of either tokenizer, verified to be an end of a token in both,
   split the document into windows, mostly of one word;
2. **windows** are aligned once for each pair of id tuples and remembered: inside, every further shared end cuts off
   a group, and all token pairs of a group are links;
3. **counts**: how many documents hold an id pair linked is summed over blocks of documents, each of which sends a
   pair once; counts and each A id's highest go back to the blocks, which hold their documents' links as sparse rows.

Texts move once, as links packed by block; a pair that stands in every document costs a row per block. The window over an
A id's pairs holds at most B's vocabulary. A task holds one block, the windows it remembers (both bounded) and the
encodings of ``SLICE_BYTES`` of text, or of one text that is longer.

Defined cases: texts that are null, empty, or not given back byte for byte by either tokenizer have no tokens: zeros and
``''``; a null id stays null; each row is a document, also repeated ones; ties for the highest count all are best; an empty
table gives no rows; further columns are ignored. Distinct links of one group are at most its distinct A ids times B ids.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tidegrid.llm.blocks import from_bytes, gathered, to_bytes
from tidegrid.llm.token_files import Codes, byte_of_letter, flat_lists, group_sums, runs
from tidegrid.llm.words import slices
from tidegrid.session import scratch_path

BLOCK_BYTES, SLICE_BYTES = 4 << 20, 1 << 19
#: Bytes of remembered windows after which a worker starts anew with its next block.
MEMO_BYTES = 160 << 20
#: Token pairs of a group from which its distinct ids are multiplied instead.
LARGE_GROUP = 1 << 16
BLOCKS = "block long, pairs array<struct<a: int, b: int, n: int>>, body binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Side:
    """One tokenizer: ids of texts, and each id's bytes."""

    pieces: list[bytes]

    def _measure(self) -> None:
        self.sizes = np.array([len(p) for p in self.pieces], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.spaced = np.array([p.startswith(b" ") for p in self.pieces])


#: Fixed value: how byte-level vocabularies of this family split a text before they merge.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces that long are left to the library whose merging does not slow down with their length.
LONG_PIECE = re.compile(r"\S{1000}|\s{1000}")


class ByteLevel(Side):
    """A byte-level tokenizer of the tokenizers library, asked for a space and the text.

    Where ids are in the order of the merges and texts are split in the usual way, the same vocabulary runs in tiktoken, which
    gives the same ids several times faster.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread; Spark runs several
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        about = json.loads(self.tokenizer.to_str())
        special = {t["id"]: t["content"].encode() for t in about["added_tokens"]}
        letter = byte_of_letter()
        self.pieces = [b""] * self.tokenizer.get_vocab_size()
        for word, i in self.tokenizer.get_vocab().items():
            self.pieces[i] = special[i] if i in special else bytes(letter[c] for c in word)
        self._measure()
        self.fast = self._fast(about, special)

    def _fast(self, about: dict, special: dict[int, bytes]):
        vocabulary, merges = about["model"].get("vocab"), about["model"].get("merges") or []
        before = about["pre_tokenizer"] or {}
        usual = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        joined = ("".join(m.split(" ") if isinstance(m, str) else m) for m in merges)
        if about["normalizer"] or not usual or any(vocabulary.get(w) != 256 + i for i, w in enumerate(joined)):
            return None
        import tiktoken

        ranks = {p: i for i, p in enumerate(self.pieces) if i not in special}
        return tiktoken.Encoding("byte level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: list[str]) -> list[list[int]]:
        texts = [f" {t}" for t in texts]
        slow = [i for i, t in enumerate(texts) if self.fast is None or LONG_PIECE.search(t)]
        found = [e.ids for e in self.tokenizer.encode_batch([texts[i] for i in slow], add_special_tokens=False)]
        out = [[] if self.fast is None or i in set(slow) else self.fast(t) for i, t in enumerate(texts)] if slow else list(map(self.fast, texts))
        for i, ids in zip(slow, found):
            out[i] = ids
        return out


class Pieces(Side):
    """A sentencepiece model, which puts a space in front by itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.pieces = [self._bytes(i) for i in range(self.model.get_piece_size())]
        self._measure()

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.buffer, self.n = np.zeros(1 << 16, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.buffer):
            self.buffer = np.concatenate([self.buffer[: self.n], np.zeros(self.n + len(values), self.buffer.dtype)])
        self.buffer[self.n : self.n + len(values)] = values
        self.n += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.buffer[: self.n]


class Lists:
    """Lists of values, one after the other."""

    def __init__(self, *kinds: type):
        self.columns, self.counts = [Growing(k) for k in kinds], Growing(np.int64)

    def add(self, counts: np.ndarray, *columns: np.ndarray) -> None:
        self.counts.add(counts)
        for old, new in zip(self.columns, columns):
            old.add(new)

    def of(self, which: np.ndarray) -> tuple[np.ndarray, ...]:
        """The lists ``which``, one after the other, and their lengths."""
        counts = self.counts.values
        begin = (np.cumsum(counts) - counts)[which]
        return (*(runs(c.values, begin, counts[which]) for c in self.columns), counts[which])


def places(counts: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """``begin``, ``begin + 1``, ... for each count."""
    return np.arange(int(counts.sum())) + np.repeat(begins - (np.cumsum(counts) - counts), counts)


def shared_groups(sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut two encodings of the same bytes wherever a token of both ends: tokens of either side in each group."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return np.diff(np.searchsorted(ends_a, shared) + 1, prepend=0), np.diff(np.searchsorted(ends_b, shared) + 1, prepend=0)


def digits(ids: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids with a sign behind each as bytes, and how many bytes each takes."""
    powers = 10 ** np.arange(len(str(int(ids.max(initial=0)))) - 1, -1, -1)
    out = np.empty((len(ids), len(powers) + 1), np.uint8)
    out[:, :-1] = ids[:, None] // powers % 10 + 48
    out[:, -1] = signs
    shown = np.ones(out.shape, bool)
    shown[:, :-2] = ids[:, None] >= powers[:-1]
    return out[shown], shown.sum(axis=1)


class Windows:
    """Aligned windows by their two id tuples (as bytes, with -1 between): text of the groups, links, sums."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b, self.codes = a, b, Codes()
        self.text, self.links = Lists(np.uint8), Lists(np.int64, np.int64)
        self.n_groups, self.n_links = Growing(np.int64), Growing(np.int64)

    @property
    def size(self) -> int:
        return self.codes.size + self.text.columns[0].n + 16 * self.links.columns[0].n + 40 * self.n_groups.n

    def numbers(self, windows: pa.Array) -> np.ndarray:
        """The number of each window; those not seen before are aligned."""
        distinct = windows.dictionary_encode()
        codes = self.codes.numbers(distinct.dictionary.to_pylist(), len(distinct.dictionary))
        if self.codes.new:
            self._align(self.codes.new)
            self.codes.new.clear()
        return codes[distinct.indices.to_numpy()]

    def _align(self, new: list[bytes]) -> None:
        flat = np.frombuffer(b"".join(new), np.int32)
        window = np.repeat(np.arange(len(new)), np.fromiter(map(len, new), np.int64, len(new)) // 4)
        middle = flat < 0
        behind = np.cumsum(middle) > window  # the sign between the sides of this window has passed
        a, b = flat[~behind].astype(np.int64), flat[behind & ~middle].astype(np.int64)
        ends = np.cumsum(np.bincount(window[~behind], minlength=len(new)))
        m, n = shared_groups(self.a.sizes[a], self.b.sizes[b])
        of = np.searchsorted(ends, np.cumsum(m))  # the window of each group
        # The text: A's ids of a group, then B's.
        first = np.cumsum(m + n) - (m + n)
        ids, signs = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[places(m, first)], ids[places(n, first + m)] = a, b
        signs[first + m - 1], signs[first + m + n - 1] = ord("|"), ord(";")
        body, width = digits(ids, signs)
        self.text.add(np.bincount(np.repeat(of, m + n), width, len(new)).astype(np.int64), body)
        self.n_groups.add(np.bincount(of, minlength=len(new)))
        self.n_links.add(np.bincount(of, m * n, len(new)).astype(np.int64))
        owner, keys, times = group_links(a, b, m, n)
        owner = of[owner]
        order = np.lexsort((keys, owner))
        owner, keys, times = owner[order], keys[order], times[order]
        head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])]))
        self.links.add(np.bincount(owner[head], minlength=len(new)), keys[head], np.add.reduceat(times, head))


def group_links(a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, pair and occurrences of all links; a pair may come up again. Large groups go by their distinct ids."""
    from_a, from_b = np.cumsum(m) - m, np.cumsum(n) - n
    large = m * n > LARGE_GROUP
    count = np.where(large, 0, m * n)
    owner = np.repeat(np.arange(len(m)), count)
    at = places(count, np.zeros(len(m), np.int64))
    keys = [a[from_a[owner] + at // n[owner]] << 32 | b[from_b[owner] + at % n[owner]]]
    owners, times = [owner], [np.ones(len(owner), np.int64)]
    for g in np.flatnonzero(large).tolist():
        x, of_x = np.unique(a[from_a[g] : from_a[g] + m[g]], return_counts=True)
        y, of_y = np.unique(b[from_b[g] : from_b[g] + n[g]], return_counts=True)
        keys.append((x[:, None] << 32 | y).ravel())
        times.append((of_x[:, None] * of_y).ravel())
        owners.append(np.full(len(keys[-1]), g))
    return np.concatenate(owners), np.concatenate(keys), np.concatenate(times)


def _anchors(side: Side, ids: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Ends of tokens that a space-marked token or a new document follows."""
    follows = np.ones(len(ids), bool)
    follows[:-1] = side.spaced[ids[1:]]
    follows[np.cumsum(counts) - 1] = True
    return ends[follows]


class Aligner:
    """Both tokenizers and the windows seen, within one worker."""

    def __init__(self, byte_level: str, pieces: str):
        self.a, self.b = ByteLevel(byte_level), Pieces(pieces)
        self.windows = Windows(self.a, self.b)

    def renew(self) -> None:
        if self.windows.size > MEMO_BYTES:
            self.windows = Windows(self.a, self.b)

    def _encoded(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and their number per text, of both sides; none for texts that a side does not give back."""
        want = [f" {t}".encode() if t else b"" for t in texts]
        sides, fine = [], np.array([bool(w) for w in want])
        for side in (self.a, self.b):
            ids, n = flat_lists([x if w else [] for x, w in zip(side.encode([t or "" for t in texts]), want)])
            raw = memoryview(runs(side.bytes, side.begins[ids], side.sizes[ids]))
            edge = np.concatenate([[0], np.cumsum(group_sums(side.sizes[ids], n))]).tolist()
            fine &= np.fromiter((raw[i:j] == w for i, j, w in zip(edge[:-1], edge[1:], want)), bool, len(want))
            sides.append((ids, n))
        return tuple(x for ids, n in sides for x in (ids[np.repeat(fine, n)], np.where(fine, n, 0)))

    def windows_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Window numbers of all texts one after the other, and per text its windows, A tokens and B tokens."""
        a, n_a, b, n_b = self._encoded(texts)
        if not len(a):
            return np.zeros(0, np.int64), n_a, n_a, n_b
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        marks = np.intersect1d(
            _anchors(self.a, a, ends_a, n_a[n_a > 0]), _anchors(self.b, b, ends_b, n_b[n_b > 0]), assume_unique=True
        )
        to_a = np.searchsorted(ends_a, marks) + 1
        in_a, in_b = np.diff(to_a, prepend=0), np.diff(np.searchsorted(ends_b, marks) + 1, prepend=0)
        size = in_a + in_b + 1
        first = np.cumsum(size) - size
        tuples = np.full(int(size.sum()), -1, np.int32)
        tuples[places(in_a, first)], tuples[places(in_b, first + in_a + 1)] = a, b
        edge = (4 * np.concatenate([[0], np.cumsum(size)])).astype(np.int64)
        keys = pa.Array.from_buffers(pa.large_binary(), len(marks), [None, pa.py_buffer(edge), pa.py_buffer(tuples)])
        last = np.searchsorted(to_a, np.cumsum(n_a), side="right")
        return self.windows.numbers(keys), np.diff(last, prepend=0), n_a, n_b

    def block(self, batch: pa.RecordBatch) -> tuple[pa.Array, bytes]:
        """Pairs of a block of documents with their number of documents, and the documents with their links."""
        parts, hashes = [], []
        for piece in slices(batch, "text", SLICE_BYTES):
            codes, n, n_a, n_b = self.windows_of(piece.column("text").to_pylist())
            text, width = self.windows.text.of(codes)
            raw = memoryview(text)
            edge = np.concatenate([[0], np.cumsum(group_sums(width, n))]).tolist()
            for i, j in zip(edge[:-1], edge[1:]):  # without the last group's sign
                hashes.append(hashlib.sha256(raw[i : j - 1]).hexdigest() if j > i else "")
            parts.append((codes, n, n_a, n_b))
        codes, n, n_a, n_b = (np.concatenate(x) for x in zip(*parts))
        size = len(n)
        doc, key, times = self.links(np.repeat(np.arange(size), n), codes)
        pairs, at = np.unique(key, return_inverse=True)
        n_docs = np.bincount(at, minlength=len(pairs))
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=size))]), pa.int32())
        body = pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(n_a), pa.array(n_b), pa.array(group_sums(self.windows.n_groups.values[codes], n)),
            pa.array(group_sums(self.windows.n_links.values[codes], n)), pa.array(hashes, pa.string()),
            pa.ListArray.from_arrays(offsets, pa.array(at, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(times)),
        ], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "times"])
        found = pa.StructArray.from_arrays(
            [pa.array(pairs >> 32, pa.int32()), pa.array(pairs & 0xFFFFFFFF, pa.int32()), pa.array(n_docs, pa.int32())],
            names=["a", "b", "n"],
        )
        return found, to_bytes(body)

    def links(self, doc: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair and occurrences of every linked pair, each pair once a document, in document order."""
        if not len(codes):
            return (np.zeros(0, np.int64),) * 3
        many = self.windows.n_groups.n
        used, often = np.unique(doc * many + codes, return_counts=True)
        keys, times, count = self.windows.links.of(used % many)
        doc, times = np.repeat(used // many, count), np.repeat(often, count) * times
        order = np.lexsort((keys, doc))
        doc, keys, times = doc[order], keys[order], times[order]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (keys[1:] != keys[:-1])]))
        return doc[new], keys[new], np.add.reduceat(times, new)


@lru_cache(maxsize=1)
def aligner_of(byte_level: str, pieces: str) -> Aligner:
    """Kept between the tasks of a Python worker."""
    return Aligner(byte_level, pieces)


def align(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document what ``RESULT`` names; ``byte_level`` and ``pieces`` are tokenizer files, there on all machines."""
    spark = docs.sparkSession

    def aligned(batches):
        aligner, part, done = aligner_of(byte_level, pieces), TaskContext.get().partitionId(), 0
        for batch in gathered(batches, "text", BLOCK_BYTES):
            aligner.renew()
            found, body = aligner.block(batch)
            pairs = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | done], pa.int64()), pairs, pa.array([body], pa.binary())], names=["block", "pairs", "body"]
            )
            done += 1

    path = scratch_path(spark, "links")
    docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(aligned, BLOCKS).write.parquet(path)
    read = lambda *columns: spark.read.schema(BLOCKS).parquet(path).select(*columns)
    hits = read("block", F.posexplode("pairs").alias("at", "p")).select("block", "at", "p.a", "p.b", "p.n")
    counts = hits.groupBy("a", "b").agg(F.sum("n").alias("count"))
    best = F.col("count") == F.max("count").over(Window.partitionBy("a"))  # at most B's vocabulary
    answers = hits.join(counts.withColumn("best", best), ["a", "b"]).select("block", "at", "count", "best")

    def finish(answers: pa.Table, block: pa.Table) -> pa.Table:
        at = answers.column("at").to_numpy()
        count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at], best[at] = answers.column("count").to_numpy(), answers.column("best").to_numpy()
        out = []
        for body in block.column("body"):
            for docs in from_bytes(body.as_buffer()):
                pair = docs.column("pair")
                edge, pair = pair.offsets.to_numpy(), pair.values.to_numpy()
                times = docs.column("times").values.to_numpy()

                def total(values):
                    sums = np.concatenate([[0], np.cumsum(values)])
                    return pa.array(sums[edge[1:]] - sums[edge[:-1]])

                named = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
                named |= {"n_best": total(times * best[pair]), "count_sum": total(times * count[pair])}
                out.append(pa.table(named | {"groups_sha256": docs.column("groups_sha256")}))
        return pa.concat_tables(out)

    return answers.groupBy("block").cogroup(read("block", "body").groupBy("block")).applyInArrow(finish, RESULT)
