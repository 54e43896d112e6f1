"""Token alignment, token files and clustering against plain Python."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidegrid.llm import clustering, queries, token_alignment, token_files

SF = "/root/testdata/sf0.001"
A, B, W = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
LONG = " ".join(f"Word{i % 977}x{i}," for i in range(30_000))
TEXTS = [
    None, "", " ", "  two  spaces\t\ttabs \n\n lines ", "naïve café — “curly” … ok", "中文没有空格的句子。日本語も", "ไทยไม่มีช่องว่าง", "<|endoftext|> <s> </s> <unk> [x]",
    "▁ is a space to one side", "á é ́x", "don't we'll THEY'RE", "🙂🙂 👩‍👩‍👧 ​", "1234567890 3.14159", "a" * 5000, "\xa0nbsp em line", "x\x00y",
    "the the the the", "the the the the", "ﬁ ligature ½ ①", LONG, "<|startoftext|>A<|EndOfText|>", "ΣΑΣ İstanbul K", "\x1c\x1dsep\x85x",
]
EXTRA = "doc_id long, text string, part int, begin long, ids string, block int, pairs int, body string, n_tokens long, a int, b int"


@pytest.fixture(scope="module")
def docs(spark):
    ids = [7, 7, None, *range(20, 20 + len(TEXTS) - 3)]
    return spark.createDataFrame([(i, t, 1, 2, "i", 3, 4, "b", 5, 6, 7) for i, t in zip(ids, TEXTS)], EXTRA).repartition(3)


def plain_alignment(rows):
    """The contract word by word: all encodings, all links, all counts."""
    a_side, b_side = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_side.encode_special_tokens = True
    letter = token_alignment.byte_of_letter()

    def b_bytes(i):
        p = b_side.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()

    found, n_docs = [], collections.Counter()
    for doc, text in rows:
        groups, links, a, b = [], collections.Counter(), [], []
        if text:
            a = a_side.encode(f" {text}", add_special_tokens=False).ids
            b = b_side.encode(text)
            pa_, pb = [bytes(letter[c] for c in a_side.id_to_token(i)) for i in a], [b_bytes(i) for i in b]
            if not b"".join(pa_) == b"".join(pb) == f" {text}".encode():
                a, b = [], []
            else:
                ends_a, ends_b = np.cumsum([len(p) for p in pa_]).tolist(), np.cumsum([len(p) for p in pb]).tolist()
                both, i, j = sorted(set(ends_a) & set(ends_b)), 0, 0
                at_a, at_b = {e: k + 1 for k, e in enumerate(ends_a)}, {e: k + 1 for k, e in enumerate(ends_b)}
                for e in both:
                    groups.append((a[i : at_a[e]], b[j : at_b[e]]))
                    i, j = at_a[e], at_b[e]
                for x, y in groups:
                    for p in x:
                        for q in y:
                            links[p, q] += 1
        n_docs.update(links.keys())
        found.append((doc, a, b, groups, links))
    top = collections.Counter()
    for (p, _), n in n_docs.items():
        top[p] = max(top[p], n)
    out = []
    for doc, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc, len(a), len(b), len(groups), sum(links.values()), sum(n for k, n in links.items() if n_docs[k] == top[k[0]]),
            sum(n * n_docs[k] for k, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if a else "",
        ))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("block,memo", [(4 << 20, 160 << 20), (500, 2000)])
def test_alignment_of_odd_texts(spark, docs, monkeypatch, block, memo):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", block)
    monkeypatch.setattr(token_alignment, "MEMO_BYTES", memo)
    rows = docs.select("doc_id", "text").collect()
    assert order(token_alignment.align(docs, A, B).collect()) == order(plain_alignment(rows))
    assert token_alignment.align(docs.limit(0), A, B).collect() == []


def test_alignment_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert order(queries.op11_token_alignment(spark, SF).collect()) == order(plain_alignment(rows))


def test_groups_equal_set_intersection():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randrange(1, 30)
        cut = lambda: np.diff([0, *sorted(rng.sample(range(1, n), rng.randrange(n))), n])
        a, b = cut(), cut()
        m, k = token_alignment.shared_groups(a, b)
        both = sorted(set(np.cumsum(a)) & set(np.cumsum(b)))
        assert np.cumsum(a)[np.cumsum(m) - 1].tolist() == both == np.cumsum(b)[np.cumsum(k) - 1].tolist()


@pytest.mark.parametrize("large", [0, 4, 1 << 16])
def test_links_of_groups(monkeypatch, large):
    monkeypatch.setattr(token_alignment, "LARGE_GROUP", large)
    rng = np.random.default_rng(2)
    m, n = rng.integers(1, 6, 40), rng.integers(1, 6, 40)
    a, b = rng.integers(0, 9, m.sum()), rng.integers(0, 9, n.sum())
    got = collections.Counter()
    for g, key, times in zip(*(x.tolist() for x in token_alignment.group_links(a, b, m, n))):
        got[g, key >> 32, key & 0xFFFFFFFF] += times
    want, i, j = collections.Counter(), 0, 0
    for g, (x, y) in enumerate(zip(m, n)):
        want.update((g, p, q) for p in a[i : i + x].tolist() for q in b[j : j + y].tolist())
        i, j = i + x, j + y
    assert got == want


def test_byte_level_ids_equal_the_library():
    side = token_alignment.ByteLevel(A)
    assert side.fast is not None
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}{c} {c}1{c} 's{c} .{c}\n {c}" for c in points[::7]] + [t for t in TEXTS if t] + ["x" * 3000, " " * 3000 + "y"]
    fast = side.encode(texts)
    side.fast = None
    assert side.encode(texts) == fast


def plain_tokens(rows):
    encode = Tokenizer.from_file(W).encode
    out, start = [], 0
    for doc, text in rows:
        ids = [*encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_query(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in queries.op13_token_files(spark, SF).collect()) == plain_tokens(rows)


@pytest.mark.parametrize("whole", [False, True])
def test_words_encode_like_texts(whole):
    """Splitting at ASCII white space changes nothing, whatever stands beside it."""
    encoder, encode = token_files.Encoder(W, whole), Tokenizer.from_file(W).encode
    rng = random.Random(3)
    letters = [" ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "́", "̧", "e", "E", "'", "s", "Σ", "İ", "한", "ᄒ", "ᅡ", ".", "7", "中", "<|endoftext|>"]
    texts = [t or "" for t in TEXTS[:-4]] + ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(500)]
    latin = [chr(c) for c in [*range(33, 127), *range(0xA1, 0x250)]]
    texts += [f"{c}a {c.upper()}b1{c}{c}c a{c}'s {c}\u0301" for c in latin]
    texts += ["".join(rng.choices(latin, k=rng.randrange(1, 12))) for _ in range(2000)]
    ids, counts = encoder(pa.array([*texts, None]))
    texts.append("")
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, docs, tmp_path, encoding):
    path = f"file://{tmp_path}/tokens"
    layout = token_files.Layout(encoding, row_group=40_000, page=4_000, page_rows=3)
    token_files.write_tokens(docs, path, W, layout=layout, file_bytes=60_000)
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()
    given = {r.text or "": r.doc_id for r in docs.collect()}
    assert len(rows) == len(TEXTS) and [r.doc_id for r in rows[:3]] == [None, 7, 7]
    assert [r.doc_id for r in rows[1:]] == sorted(r.doc_id for r in rows[1:])
    whole = [i for r in rows for i in r.ids]
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    encode = Tokenizer.from_file(W).encode
    want = collections.Counter((d, tuple(encode(t, add_special_tokens=False).ids) + (1,)) for t, d in given.items() if t)
    assert not want - collections.Counter((r.doc_id, tuple(r.ids)) for r in rows)
    # A range of positions, also across documents and parts.
    for a, b in [(0, 5), (3, 400), (len(whole) - 10, len(whole) + 10), (50, 50), (len(whole), len(whole) + 5), (100, 100_000)]:
        some = token_files.read_positions(spark, path, a, b).orderBy("start").collect()
        assert [i for r in some for i in r.ids] == whole[a:b]
    assert token_files.read_tokens(spark, path, ids=False).columns == ["doc_id", "start", "n_tokens"]
    # What the files look like.
    metas = [pq.ParquetFile(f).metadata for f in sorted((tmp_path / "tokens" / "tokens").glob("*.parquet"))]
    columns = [m.row_group(g).column(c) for m in metas for g in range(m.num_row_groups) for c in range(m.num_columns)]
    for column in columns:
        assert column.has_offset_index and (column.has_column_index or column.statistics is None or not column.statistics.has_min_max)
        assert column.compression == "ZSTD"
        if encoding == "delta" or column.path_in_schema != "ids.list.element":  # few ids may do better without a dictionary
            assert "DELTA_BINARY_PACKED" in column.encodings
    assert len(metas) > 1
    with pytest.raises(ValueError):
        token_files.Layout("plain").options()


def test_layout_of_real_documents(spark, tmp_path):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    token_files.write_tokens(given, f"file://{tmp_path}/real", W, file_bytes=1 << 30, layout=token_files.Layout(row_group=200_000, page=20_000))
    groups = []
    for f in (tmp_path / "real" / "tokens").glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        groups += [meta.row_group(g) for g in range(meta.num_row_groups)]
    assert len(groups) > 5 and max(g.total_byte_size for g in groups) < 900_000
    for g in groups:
        column = next(c for c in map(g.column, range(g.num_columns)) if c.path_in_schema == "ids.list.element")
        assert column.num_values < 3000 or ("RLE_DICTIONARY" in column.encodings and column.total_uncompressed_size < 3 * column.num_values)


def test_selective_reads_prune(spark, docs, tmp_path):
    path = f"file://{tmp_path}/pruned"
    token_files.write_tokens(docs, path, W)
    narrow = token_files.read_tokens(spark, path, ids=False).filter(F.col("doc_id").between(21, 23))
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,21)" in plan and "ids:array" not in plan.split("ReadSchema")[1].split(">")[0]
    none = f"file://{tmp_path}/none"
    token_files.write_tokens(docs.limit(0), none, W)
    assert token_files.digests(token_files.read_tokens(spark, none)).collect() == []
    assert token_files.read_positions(spark, none, 0, 10).collect() == []


def plain_clusters(rows, k, rounds, width):
    vectors = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in vectors if i is not None)[:k]
    centroids = [v for _, v in first]

    def assign():
        out = []
        for i, v in vectors:
            d = [sum((x - y) ** 2 for x, y in zip(v, c)) for c in centroids]
            out.append((i, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = [c for _, c, _ in assign()]
        for c in range(len(centroids)):
            own = [v for (_, v), x in zip(vectors, at) if x == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    return assign() if centroids else [], centroids


@pytest.mark.parametrize("k,rounds", [(40, 5), (3, 2), (7, 30)])
def test_clusters_of_odd_vectors(spark, k, rounds):
    rng = random.Random(k)
    draw = lambda: [rng.choice([-1.0, -0.26, 0.0, 0.004, 0.5, 1.5]) for _ in range(4)]
    rows = [(i, draw()) for i in range(60)] + [(3, draw()), (3, draw()), (None, draw()), (61, [0.1] * 4), (61, [0.1] * 4)]
    odd = [(70, None), (71, []), (72, [1.0, None, 0.0, 0.0]), (73, [float("nan")] * 4), (74, [float("inf")] * 4), (75, [1.0] * 5)]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], "vec_id long, embedding array<float>, cluster string, distance int")
    kept = clustering.kept_vectors(frame, width=4)
    assigned, centroids = clustering.cluster(kept, k, rounds)
    want, model = plain_clusters([(i, [float(np.float32(x)) for x in v]) for i, v in rows], k, rounds, 4)
    assert order(assigned.collect()) == order(want)
    facts = {r.cluster: r for r in centroids.collect()}
    assert [facts[c].centroid for c in range(len(facts))] == model
    assert all(facts[c].cluster_inertia == sum(d for _, x, d in want if x == c) for c in facts)
    assert {r.inertia for r in facts.values()} == {sum(d for _, _, d in want)}
    empty, none = clustering.cluster(kept.limit(0), k, rounds)
    assert empty.collect() == [] and none.collect() == []


def test_changes_add_up():
    rng = np.random.default_rng(1)
    for most in (100, 2**26):
        vectors, a, b = (rng.integers(-most, most, (n, 16)) for n in (50, 6, 6))
        b[2] = a[2]
        b[3, 1:] = a[3, 1:]
        dots = clustering.add_changes(np.zeros((50, 6), np.int64), vectors, a)
        assert (clustering.add_changes(dots, vectors, b - a) == vectors @ b.T).all()


def test_components_beyond_the_bound_fail(spark):
    frame = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="beyond"):
        clustering.kept_vectors(frame).collect()
