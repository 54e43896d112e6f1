"""Operators without SQL against plain loops, and operators with SQL where the given tables have no such case."""

import collections
import hashlib
import itertools
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidegrid.llm import (
    chat, components, decontaminate, html_extract, language_id, line_dedup, mixing, near_dedup, queries, quality, substring_dedup, topk_search, words,
)

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def shingles(text):
    w = split((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def groups(sets):
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {d: find(d) for d in sets}


def near_copies(n, seed, base_words=90):
    """Copies with a few changed words each: some link to the base, some only through others, some not at all."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(900)}" for _ in range(base_words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [near_dedup.BLOCK_SHINGLES, 2000])
def test_near_groups(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block)  # long lists in several blocks
    texts = near_copies(120, 1) + near_copies(40, 2, 30) + ["a b", "a b", "A B", "a b c", ""] + near_copies(30, 3, 7)
    random.Random(4).shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_groups(docs).collect()}
    assert got == {i: (len(sets[i]), c, c == i) for i, c in groups(sets).items()}


def test_near_pairs_around_the_sketch_size(spark):
    """One set is whole in its sketch, its partner is not: lone pairs, which only their own values bring together."""
    texts = []
    for n, m in itertools.product(range(44, 49), range(49, 65)):
        for lost in (0, 1):  # words of the smaller set's end that the larger one lacks
            if 100 * (n - lost) >= 75 * (m + lost):
                for _ in range(6):
                    i = len(texts)
                    both = [f"p{i}w{j}" for j in range(n + 4 - lost)]
                    texts.append(" ".join(both + [f"p{i}a{j}" for j in range(lost)]))
                    texts.append(" ".join(both + [f"p{i}b{j}" for j in range(m - n + lost)]))
    assert len(texts) > 800
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs).collect()}
    assert got == {i: i - i % 2 for i in sets}
    assert all(100 * len(sets[i] & sets[i + 1]) >= 75 * len(sets[i] | sets[i + 1]) for i in range(0, len(texts), 2))


def test_near_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sets = {r.doc_id: shingles(r.text) for r in docs}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in entry.queries()["op7_near_dedup"](spark, SF).collect()}
    assert got == {i: (len(sets[i]), c, c == i) for i, c in groups(sets).items()}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7)], "a long, b long")
    got = {r.id: r.component for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


def test_words_like_a_plain_split():
    texts = ["", " a  b\tc\n", None, "é ü x", "one", "\x0b\x0c\r", "tail "]
    data, offsets = words.text_bytes(pa.array(texts))
    starts, ends, first = words.word_spans(data, offsets)
    raw = data.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(starts[i:j], ends[i:j])] for i, j in itertools.pairwise(first)]
    assert got == [split(t) for t in texts]
    hashes = words.span_hash(data, starts, ends)
    by = collections.defaultdict(set)
    for a, b, h in zip(starts, ends, hashes):
        by[raw[a:b]].add(int(h))
    assert all(len(v) == 1 for v in by.values()) and len(set().union(*by.values())) == len(by)


def test_repeats_with_periods_and_hot_passages(spark):
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = ["go on " * 40, "on go " * 30, "x y z " * 25]
    for i in range(200):
        own = [f"d{rng.randrange(40)}" for _ in range(rng.randrange(60))]
        own.insert(rng.randrange(len(own) + 1), passage if i % 3 else "")
        texts.append("  ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    seen, rep = {}, collections.defaultdict(set)
    for d, t in enumerate(texts):
        w = split(t)
        for i in range(len(w) - 19):
            if seen.setdefault(tuple(w[i : i + 20]), (d, i)) != (d, i):
                rep[d].update(range(i, i + 20))
    got = {r.doc_id: (r.text, r.n_words, r.n_removed) for r in substring_dedup.drop_repeats(docs).collect()}
    assert got == {
        d: (" ".join(x for i, x in enumerate(split(t)) if i not in rep[d]), len(split(t)), len(rep[d])) for d, t in enumerate(texts)
    }


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    found = line_dedup.PerfectHash(keys)
    assert sorted(found.index(keys)) == list(range(len(keys))) and found.size == len(keys)
    assert line_dedup.PerfectHash(keys[:0]).index(keys[:3]).tolist() == [-1, -1, -1]


def test_line_index_keeps_apart_equal_first_halves():
    hashes = np.array([[5, 1], [5, 2], [5, 1], [9, 1], [5, 1]], np.uint64)
    index = line_dedup.LineIndex(hashes, np.array([1, 1, 1, 4, 1]), np.array([3, 8, 7, 2, 1]))
    counts, holders = index.probe(np.array([[5, 1], [5, 2], [9, 1], [5, 3], [1, 1]], np.uint64))
    assert counts.tolist() == [3, 1, 4, 0, 0] and holders[:3].tolist() == [7, 8, 2]


def test_mix_cut_is_nearest(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randrange(1, 30)), f"s{min(rng.randrange(40), 6)}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("text", F.expr("regexp_replace(text, 'w', 'w ')"))
    out = mixing.mix_sources(docs).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.source].append(r)
    total = sum(r.size for r in out)
    assert sum(v[0].target for v in by.values()) == pytest.approx(total)
    weights = dict(zip(sorted(by), itertools.cycle((5, 2, 1))))
    free = {s: v[0].target / weights[s] for s, v in by.items() if v[0].target < 3 * v[0].source_size - 1e-6}
    assert max(free.values()) == pytest.approx(min(free.values()))
    assert all(v[0].target <= 3 * v[0].source_size and v[0].target / weights[s] <= max(free.values()) + 1e-6 for s, v in by.items())
    for v in by.values():
        assert abs(sum(r.taken for r in v) - v[0].target) <= max(r.size for r in v)


def test_chat_round_trip_and_segments(spark):
    rng = random.Random(11)
    bits = ["\\", "### ", "#", "</turn>", "<", "/turn>", "\n", ": ", "é", "\U0001f600", "$1", "\\Q", "### User: ", "### Role ", " "]
    roles = ["user", "assistant", "system", "to: ol", "### User", "", "a\\"]
    rows = [(c, t, rng.choice(roles), "".join(rng.choices(bits, k=rng.randrange(9)))) for c in range(150) for t in range(rng.randrange(1, 7))]
    out = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).withColumn(
        "turns", chat.parse_chat(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("turns"), F.col("segments"))).collect()
    given = collections.defaultdict(list)
    for c, _, role, text in rows:
        given[c].append((role, text))
    unescape = lambda s: re.sub(r"(?s)\\(.)", r"\1", s)
    for r in out:
        assert [tuple(t) for t in r.turns] == given[r.conv_id]
        assert r.loss == "".join(t for role, t in given[r.conv_id] if role == "assistant")
        at = 0
        for s in r.segments:
            assert s.start == at
            at += s.length
        assert at == len(r.formatted)
        assert "".join(unescape(r.formatted[s.start : s.start + s.length]) for s in r.segments if s.loss) == r.loss
        before, ok = None, True
        for role, _ in given[r.conv_id]:
            ok &= role in chat.TRANSITIONS.get(before, ())
            before = role
        assert r.valid == (ok and before in chat.FINAL)


def test_search_equals_all_scores():
    rng = np.random.default_rng(5)
    for width, top in ((64, 9), (3, 2), (8, 2**29)):
        docs = rng.integers(-top, top, (3000, width))
        docs[rng.random(docs.shape) < 0.3] = 0
        docs[100:900] = docs[5]
        asked = docs[::150]
        best = topk_search.max_score(np.arange(3000), docs, asked, np.arange(0, 3000, 150), 20)
        for i, b in enumerate(best):
            scores = docs @ asked[i]
            order = [j for j in np.lexsort((np.arange(3000), -scores)) if j != 150 * i][:20]
            assert b.ids.tolist() == order and b.scores.tolist() == scores[order].tolist()


def brute_tiles(doc, item, seed):
    free_d, free_i, total = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for a in range(len(doc)):
                n = 0
                while p + n < len(item) and a + n < len(doc) and free_i[p + n] and free_d[a + n] and item[p + n] == doc[a + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, a)
        n, p, a = best
        if n < seed:
            return total
        total += n
        free_i[p : p + n] = [False] * n
        free_d[a : a + n] = [False] * n


def test_tiles_equal_plain_greedy_tiling():
    rng = random.Random(9)
    for _ in range(60):
        item = [rng.choice("abcdefgh") for _ in range(rng.randrange(4, 30))]
        doc = [rng.choice("abcdefgh") for _ in range(20)] + item[len(item) // 2 :] + ["z"] + item[: len(item) // 2 + 2]
        cut = lambda words: decontaminate.tokens(pa.array([" ".join(words)]))[0]
        got = decontaminate.Document(cut(doc), 4).cover(cut(item), np.ones(len(item), bool), 0.01)
        assert (got[0] if got else 0) == brute_tiles(doc, item, 4)


def test_reordered_passages_are_caught(spark):
    rng = random.Random(2)
    sentences = [" ".join(f"t{rng.randrange(10**6)}" for _ in range(9)) for _ in range(5)]
    items = spark.createDataFrame([(1, ". ".join(sentences))], "item_id long, text string")
    noise = " ".join(f"n{i}" for i in range(3000))
    moved = f"{noise} {sentences[3].upper()}! {noise} {sentences[0]} {sentences[4]} {noise}"
    docs = spark.createDataFrame([(1, moved), (2, f"{noise} {sentences[1]}"), (3, noise)], "doc_id long, text string")
    found = decontaminate.leaks(docs, items).collect()
    assert [(r.doc_id, r.n_tiles, round(r.coverage, 2)) for r in found] == [(1, 3, 0.6)]


def test_a_crowded_bit_table_changes_nothing(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontaminate.leaks(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "MOST_BITS", 1 << 10)
    monkeypatch.setattr(decontaminate, "PAGE_BITS", 7)
    assert sorted(map(tuple, decontaminate.leaks(docs, items).collect())) == whole and whole
    plain = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if i.text in d.text}
    assert plain <= {r[:2] for r in whole}


def test_tokens_of_any_script():
    def cut(text):
        words, first = decontaminate.tokens(pa.array(["x", text, None, text, "x"]))
        assert words[first[1] : first[2]].tolist() == words[first[3] : first[4]].tolist() and first[2] == first[3]
        return words[first[1] : first[2]].tolist()

    same = ["“Don’t—stop,” he said…", "\"don't stop\" HE-SAID", "don t\nstop he…said"]
    assert len({tuple(cut(t)) for t in same}) == 1 and len(cut(same[0])) == 5
    assert len(cut("法国的首都是哪里？")) == 8 and len(cut("ภาษาไทย")) == 7 and len(cut("naïve é１２ abc_def")) == 4
    assert cut("…—“”") == []


def test_contamination_in_any_script(spark):
    items = spark.createDataFrame(
        [(1, "法国的首都是哪座城市？"), (2, "\"It's the well-known answer,\" she said - 'to all questions'."), (3, "Forty two"), (4, "x")],
        "item_id long, text string",
    )
    docs = spark.createDataFrame([
        (1, "有人问：法国的首都是哪座城市？没有人知道。"), (2, "“It’s the well—known answer,” she said – ‘to all questions’."),
        (3, "The answer is forty-two, x."), (4, "首都是哪里？forty and two it is"), (5, None),
    ], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in decontaminate.leaks(docs, items).collect()) == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)]
    assert sorted(r.doc_id for r in decontaminate.keep_clean(docs, items).collect()) == [4, 5]


def test_a_common_stem_opens_nothing(spark):
    stem = "which of the following statements is true about"
    own = lambda i: f"thing{i} and its part{i} made in{i}"
    items = spark.range(10_000).selectExpr(
        "id AS item_id", f"concat('{stem} thing', id, ' and its part', id, ' made in', id, '?') AS text"
    )
    rows = [(1, f"Now, {stem} {own(77)}, said he"), (2, f"{stem} nothing at all. " * 30), (3, f"{stem} {own(1)}. {stem} {own(2)}. {own(9_999)}"),
            (4, f"{stem} thing5 but no more")] + [(10 + i, f"{stem} cats number{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    begin = time.time()
    found = decontaminate.leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 77), (3, 1), (3, 2), (3, 9_999)]
    assert time.time() - begin < 60
    # Items that are nothing but a stem are found all the same, each copy and each variant.
    same = spark.createDataFrame([(i, stem) for i in range(50)] + [(100 + i, f"{stem} w{i}") for i in range(50)], "item_id long, text string")
    found = decontaminate.leaks(spark.createDataFrame([(1, f"a {stem} b")], "doc_id long, text string"), same).collect()
    assert {r.item_id for r in found} == set(range(50))


def test_pages_give_their_article(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in entry.queries()["op1_html_extraction"](spark, SF).collect():
        inner = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = [re.sub(r"\s+", " ", re.sub("<[^>]*>", " ", p).replace("&amp;", "&")).strip() for p in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


SENTENCES = "It was a long day, and nobody came. The road went on, over the hill; then down again. "
PAGES = {
    "table": ("<table><tr><td class=left><a href=/a>Home</a> <a href=/b>News</a></td><td><h2>Head &eacute;</h2><div>{s}</div><div>{s} {s}</div></td>"
              "</tr></table>", "Head é\n\n{s}\n\n{s} {s}"),
    "divs": ("<div class='site-header'><h1>Site</h1></div><div id=content><h2>Title</h2><p>{s}<p>Short.<p>{s}<ul><li>{s}<li>{s}</ul></div>"
             "<div id=sidebar><p>{s}</p></div><div class='comments'><p>{s}</div><div class='cookie-notice'>We use cookies, agree?</div>",
             "Title\n\n{s}\n\nShort.\n\n{s}\n\n{s}\n\n{s}"),
    "article": ("<header>Top</header><main><article><header><h1>Title</h1></header><p>{s}</p><aside>{s}</aside><form><p>{s}</p></form>"
                "<script>if (a</b) '<p>'</script><!-- <p>no</p> --><pre>a\n b</pre></article><article class=comment><p>{s}</article></main>",
                "Title\n\n{s}\n\na b"),
}


@pytest.mark.parametrize("name", PAGES)
def test_other_layouts(name):
    page, want = (x.replace("{s}", SENTENCES.strip()) for x in PAGES[name])
    assert html_extract.main_text(f"<html><head><title>t</title><style>p{{}}</style></head><body>{page}<footer>End.</footer></body>") == want


def test_ratios_decide_outside_and_inside_of_articles():
    s = SENTENCES.strip()
    teaser = "<article class='{c}'><a href=/x>Another story of the day</a></article>"
    for c in ("teaser", "card"):
        body = f"<div class=body><h1>Title</h1><p>{s}</p><p>{s} {s}</p><p>{s}</p></div>"
        for page in (teaser.format(c=c) + body, body + teaser.format(c=c)):
            assert html_extract.main_text(f"<html><body>{page}</body></html>") == f"Title\n\n{s}\n\n{s} {s}\n\n{s}"
    low = "".join(f"<div class=box>{x}</div>" for x in ("Print", "Mail", "Save", "Top", "More"))
    page = f"<main><p>{s} {s}</p><p>{s}</p><p>{s} {s}</p>{low}</main><div class=line>Call us</div>"
    got = html_extract.main_text(page).split("\n\n")
    assert got[:3] == [f"{s} {s}", s, f"{s} {s}"] and not {"Save", "Top", "More", "Call us"} & set(got)


@pytest.mark.parametrize("frame", [
    "<div class='elementor-widget elementor-widget-text-editor'>{}</div>", "<section id=discussion>{}</section>",
    "<section id=search>{}</section>", "<div class='alert alert-info'>{}</div>", "<div class=responses>{}</div>",
    "<div id=notifications>{}</div>", "<div class=tags>{}</div>", "<section id=navigation>{}</section>",
])
def test_doubtful_names_do_not_lose_text(frame):
    s = SENTENCES.strip()
    inner = f"<h2>Title</h2><p>{s}</p><p>{s}</p>"
    want = f"Title\n\n{s}\n\n{s}"
    assert html_extract.main_text(f"<html><body><nav>Home</nav>{frame.format(inner)}</body></html>") == want
    part = frame.format(f"<p>{s}</p>")
    for around in ("<article>{}</article>", "<div>{}</div>"):
        page = around.format(f"<h2>Title</h2><p>{s}</p>{part}<p>{s}</p>")
        assert html_extract.main_text(page) == f"Title\n\n{s}\n\n{s}\n\n{s}"


def test_doubtful_names_with_little_text_go():
    s = SENTENCES.strip()
    page = f"<div><p>{s} {s}</p><p>{s}</p></div><div class=widget><div>Hot</div></div><div role=search><p>{s}</p></div>"
    assert html_extract.main_text(page) == f"{s} {s}\n\n{s}"


@pytest.mark.parametrize("frame", [
    "<div id=page class='site sidebar-right header-fixed'>{}</div>", "<div class='post comments-open'>{}</div>",
    "<div class='content ad-free'>{}</div>", "<main><div class='menu-collapsed'>{}</div></main>", "<form id=aspnetForm>{}</form>",
    "<div class=sidebar>{}</div>", "<form><div class='site header-fixed'><div class='content ad-free'>{}</div></div></form>",
])
@pytest.mark.parametrize("around", [
    "", "<nav><a href=/>Home</a></nav><footer>End</footer>",
    "<div class=sidebar><p>One, two, three.</p></div><div class=comments><p>I like it. {s}</p></div><form><label>Mail</label><input></form>",
])
def test_no_page_goes_by_a_name_alone(frame, around):
    s = SENTENCES.strip()
    inner = f"<h1>Title</h1><p>{s}</p><p>{s} {s}</p><p>{s}</p><p>{s}</p>"
    page = f"<html><body>{frame.format(inner)}{around.replace('{s}', s)}</body></html>"
    assert html_extract.main_text(page) == f"Title\n\n{s}\n\n{s} {s}\n\n{s}\n\n{s}"


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<div class=body>{}</div>", "{}"])
@pytest.mark.parametrize("part,want", [
    ("<p>The mass is <math><mi>m</mi><mo>=</mo><mn>5</mn></math>, which is much.</p>", "The mass is m=5, which is much."),
    ("<p>A<svg/>BC</p><p>{s}</p><svg><text>no</text></svg>", "ABC\n\n{s}"),
    ("<table><tr><td>Year</td><td>2001</td></tr></table>", "Year\n\n2001"),
    ("<ul><li>one</li><li>two</li></ul>", "one\n\ntwo"), ("<p><a href=/x>{s}</a></p>", "{s}"),
])
def test_nothing_of_an_article_goes(frame, part, want):
    s = SENTENCES.strip()
    inner = f"<h1>Title</h1><p>{s}</p>{part}<p>{s} {s}</p><p>{s}</p>".replace("{s}", s)
    page = f"<html><body>{frame.format(inner)}<footer>End</footer></body></html>"
    assert html_extract.main_text(page) == f"Title\n\n{s}\n\n{want}\n\n{s} {s}\n\n{s}".replace("{s}", s)


def test_long_comments_and_sidebars_go():
    s = SENTENCES.strip()
    many = f"<div class=comment><p>{s} {s}</p></div>" * 12
    for name in ("id=comments", "class=sidebar", "class='post-comments'"):
        page = f"<div class=x><h1>Title</h1><p>{s}</p><p>{s} {s}</p></div><div {name}>{many}</div>"
        assert html_extract.main_text(page) == f"Title\n\n{s}\n\n{s} {s}"
    advert = f"<div class=ad>{s} {s} {s} {s}</div><article><h1>T</h1><p>Short, this one.</p></article>"
    assert html_extract.main_text(advert) == "T\n\nShort, this one."


def test_broken_markup_ends():
    for page in ("<", "a < b", "<p", "<!--", "<a href='", "</", "<p><b>x</i></p></div>", "<![CDATA[x]]>", "<" * 2000, "<p a='" * 2000, "<div>" * 3000 + "x"):
        html_extract.main_text(page)
    assert html_extract.main_text("a < b") == "a < b"


def test_quality_held_out(spark):
    sf = SF.replace("0.001", "0.1")
    out = entry.queries()["op2_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = [r.predicted == r.quality for r in out]
    assert len(out) > 1000 and np.mean(right) > 0.97
    assert np.mean([r.predicted == 0 for r in out if r.quality == 0]) > 0.9


def test_language_held_out(spark):
    sf = SF.replace("0.001", "0.01")
    out = entry.queries()["op10_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").filter("held_out").collect()
    assert len(out) > 200 and np.mean([r.lang_pred == r.lang for r in out]) > 0.97


def plain_vector(text):
    """Counted one- and two-word sequences and repeats of a text of plain words, as a unit vector."""
    w = text.split()
    count = collections.Counter([(x,) for x in w] + list(zip(w, w[1:])))
    for back in (1, 2):
        count["again", back, None] = sum(x == y for x, y in zip(w, w[back:]))
    values = {k: math.log1p(n) for k, n in count.items() if n}
    length = math.sqrt(sum(v * v for v in values.values()))
    return {k: v / length for k, v in values.items()}


def plain_leader(rows, rounds=3, alpha=0.5, beta=1.0, l1=0.01, l2=0.1):
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(k):
        if abs(z[k]) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)

    for _ in range(rounds):
        for text, label in rows:
            x = plain_vector(text) | {"bias": 1.0}
            old = {k: weight(k) for k in x}
            miss = 1 / (1 + math.exp(-sum(old[k] * v for k, v in x.items()))) - label
            for k, v in x.items():
                g = miss * v
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha * old[k]
                n[k] += g * g
    return lambda text: 1 / (1 + math.exp(-sum(weight(k) * v for k, v in (plain_vector(text) | {"bias": 1.0}).items())))


def test_quality_equals_a_plain_learner(spark):
    rng = random.Random(8)
    good, bad = [f"good{chr(97 + i)}" for i in range(5)], [f"bad{chr(97 + i)}" for i in range(5)]
    rows = []
    for i in range(80):
        label = i % 2
        rows.append((i, " ".join(rng.choice(good + (bad if rng.random() < 0.3 else []) if label else bad + good[:3]) for _ in range(rng.randrange(1, 40))), label))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)
    weights = quality.train(quality.labelled_sample(docs.drop("label"), docs.drop("text")))
    got = {r.doc_id: r.score for r in quality.score(docs, weights).collect()}
    plain = plain_leader([(t, y) for _, t, y in sorted(rows, key=lambda r: quality._order({"doc_id": r[0]}))])
    for i, text, _ in rows:
        assert got[i] == pytest.approx(plain(text), abs=1e-4)


def plain_language(model, text, bits):
    """Family, then votes of its pairs, by loops over the text's letter trigrams."""
    clean = "".join(chr(b) if 97 <= b < 123 or b >= 128 else " " for b in f" {text.lower()} ".encode())
    codes = [[ord(c) for c in clean[i : i + 3]] for i in range(len(clean) - 2) if clean[i : i + 3] != "   "]
    bins = collections.Counter(((a << 16 | b << 8 | c) * 0x9E3779B1 % 2**32) >> (32 - bits) for a, b, c in codes)
    sums = [sum(n * float(w[b]) for b, n in bins.items()) * language_id.SCALE / max(1, len(codes)) + float(w[-1]) for w in model.weights.T]
    chance = lambda m: 1 / (1 + math.exp(-2 * m))
    likely = [chance(m) for m in sums[: len(model.families)]]
    family = max(range(len(likely)), key=lambda i: likely[i])
    own = [i for i, f in enumerate(model.of) if f == model.families[family]]
    votes, belief, met = collections.Counter(), collections.Counter(), collections.Counter()
    for (i, j), m in zip(model.pairs, sums[len(model.families) :]):
        votes[i if m > 0 else j] += 1
        for x, p in ((i, chance(m)), (j, 1 - chance(m))):
            votes[x] += 1e-6 * p
            belief[x] += p
            met[x] += 1
    best = max(own, key=lambda i: (votes[i], -i))
    share = likely[family] / sum(likely) if len(likely) > 1 else 1.0
    return model.languages[best], share * (belief[best] / met[best] if met[best] else 1.0)


def test_language_equals_plain_votes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(language_id.language_sample(docs, 30))
    got = language_id.identify(docs, model).collect()
    for r in got:
        if r.text and any(c.isalpha() for c in r.text):
            lang, score = plain_language(model, r.text, language_id.BITS)
            assert (r.lang_pred, pytest.approx(r.score, abs=1e-6)) == (lang, score)


def test_separating_planes_equal_a_plain_descent():
    rng = np.random.default_rng(0)
    rows = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4)) for _ in range(40)]
    labels = np.where([v[0] > 0.4 for _, v in rows], 1.0, -1.0)
    w = language_id.fit_svm(rows, labels, 12, rounds=2)
    dense, dual = np.array([np.append(np.bincount(b, v, 12), 1.0) for b, v in rows]), np.zeros(40)
    cap = {1.0: (labels < 0).mean(), -1.0: (labels > 0).mean()}
    for _ in range(2):
        for i in np.random.default_rng(0).permutation(40):
            margin = labels[i] * ((dual * labels) @ dense @ dense[i])
            dual[i] = min(max(dual[i] - (margin - 1) / (dense[i] @ dense[i]), 0.0), cap[labels[i]])
    assert w == pytest.approx((dual * labels) @ dense)


def test_language_ties():
    model = language_id.Model(["de", "en", "es", "fr"], np.zeros((3, 4)))
    assert model.families == ["germanic", "romance"] and model.pairs == [(0, 1), (2, 3)]
    found, _ = model.predict(np.array([[0.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [1.0, 1.0, 0.5, -1.0], [1.0, 0.0, -0.1, 0.0]]))
    assert found == ["en", "fr", "de", "en"]


def test_held_out_rows(spark):
    import zlib

    rows = spark.range(50).select("id", quality.held_out(F.col("id"), 3, 1).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_pipeline_against_plain_python(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    keys = lambda t: [k if len(k) >= 20 else None for k in (x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in t.split("\n"))]
    holders = collections.defaultdict(set)
    for d, t in rows.items():
        for k in keys(t):
            holders[k].add(d)
    rows = {
        d: "\n".join(x for x, k in zip(t.split("\n"), keys(t)) if k is None or len(holders[k]) < 3 or max(holders[k]) == d) for d, t in rows.items()
    }
    rows = {d: rows[d] for d, c in groups({d: shingles(t) for d, t in rows.items()}).items() if c == d}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    tokens = lambda t: re.findall(r"[^\W_]+", t.lower())
    cut = [tokens(i) for i in items]

    def leaks(text):
        w = tokens(text)
        mine = {tuple(w[i : i + 4]) for i in range(len(w) - 3)}
        near = [i for i in cut if sum(tuple(i[j : j + 4]) in mine for j in range(len(i) - 3)) * 4 >= 0.5 * len(i) > 0]
        return any(brute_tiles([x for x in w if x in set(i)], i, 4) >= 0.5 * len(i) for i in near)

    rows = {d: t for d, t in rows.items() if not leaks(t)}
    out = corpus_pipeline.run(spark, SF).collect()
    got = {r.doc_id: r.text for r in out}
    assert {d: hashlib.sha256(t.encode()).hexdigest() for d, t in got.items()}.items() <= {
        d: hashlib.sha256(t.encode()).hexdigest() for d, t in rows.items()
    }.items()
    sizes = collections.Counter()
    sources = {r.doc_id: r.source for r in docs.collect()}
    for d, t in rows.items():
        sizes[sources[d]] += len(split(t))
    assert {r.source: r.source_size for r in out}.items() <= sizes.items()
    assert all(r.taken % r.size == 0 and r.n_chars == len(r.text) for r in out)
    assert sum(r.taken for r in out) == pytest.approx(sum(sizes.values()), rel=0.1)
    assert queries.QUERIES


def test_common_seeds_lose_no_pair(spark, monkeypatch):
    """What opens a pair leaves out no pair that counts: every document is held against every item beside it."""
    monkeypatch.setattr(decontaminate, "COMMON", 3)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(words[: 3 + i % 10], k=rng.randint(2, 14)))) for i in range(150)]
    docs = [(i, " ".join(rng.choices(words, k=20)) + " " + rng.choice(items)[1] + " x " + rng.choice(items)[1][:15]) for i in range(60)]
    cut = {i: decontaminate.tokens(pa.array([t]))[0] for i, t in [*items]}
    seeds = {i: set(decontaminate.run_hash(t, 4).tolist()) if len(t) >= 4 else set() for i, t in cut.items()}
    held = collections.Counter(s for key in {t.tobytes(): i for i, t in cut.items()}.values() for s in seeds[key])
    want = set()
    for d, text in docs:
        document = decontaminate.Document(decontaminate.tokens(pa.array([text]))[0], 4)
        for i, own in cut.items():
            rare = np.ones(len(own), bool)
            for p, s in enumerate(decontaminate.run_hash(own, 4).tolist() if len(own) >= 4 else ()):
                if held[s] > 3:
                    rare[p : p + 4] = False
            if document.cover(own, rare, 0.5):
                want.add((d, i))
    assert max(held.values()) > 3
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) > 60
