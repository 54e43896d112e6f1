"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegrid.llm import (
    chat, decontaminate, html_extract, language_id, line_dedup, mixing, near_dedup, quality, substring_dedup, topk_search,
)

LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
SAID = "the same passage of many words stands here and there so that it repeats in more than one document of the table"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "n long, h long, size long, block int, kind int, body string, id long, score string, path string"
)
ROWS = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n ", None, "a"), (None, SAID, "en", "b"), (4, LONG, "de", "a"),
    (5, LONG, "de", "a"), (5, LONG, "de", "a"), (6, SAID, "en", ""), (7, SAID + " end", "en", "b"), (8, "12 34 !!", "fr", "b"),
    (9, "é ñ", None, None), (10, f"{SAID}\n{SAID}\n short", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 7, 1, 2, 3, 4, 5, "x", 6, "s", "p") for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


EXTRA = ["n", "h", "block", "kind", "body", "id", "path"]


def kept_columns(out, docs):
    assert [f for f in out.schema if f.name in EXTRA] == [f for f in docs.schema if f.name in EXTRA]
    assert {tuple(r) for r in out.select(*EXTRA).collect()} == {tuple(r) for r in docs.select(*EXTRA).collect()}


def test_lines(docs, none):
    out = line_dedup.dedup_lines(docs)
    rows = out.select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert (by[1].text, by[1].n_lines, by[1].n_dropped) == ("", 1, 0)
    assert (by[3].n_lines, by[3].text) == (2, " \t\n ")
    # The null id is the least, so it loses its line; the largest holder keeps all its lines.
    assert (by[None].text, by[None].n_dropped, by[6].text, by[10].n_dropped) == ("", 1, "", 0)
    # Three rows hold the long line, two of them with the largest id: both keep it.
    assert by[4].text == "" and [r.text == LONG for r in rows if r.doc_id == 5] == [True, True]
    kept_columns(out, docs)
    assert line_dedup.dedup_lines(none).collect() == []


def test_substrings(docs, none):
    out = substring_dedup.drop_repeats(docs)
    rows = out.select("doc_id", "text", "n_words", "n_removed").collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert (by[1].text, by[1].n_words, by[2].n_words, by[3].text) == ("", 0, 0, "")
    assert by[None].text == SAID and by[6].text == "" and by[7].text == "end"
    assert by[4].n_removed == 0 and [r.n_removed for r in rows if r.doc_id == 5] == [60_000] * 2
    assert by[10].text == "short"
    kept_columns(out, docs)
    assert substring_dedup.drop_repeats(none).collect() == []


def test_near(docs, none):
    out = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_groups(docs).collect()}
    assert near_dedup.near_groups(docs).count() == len(ROWS)
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 59_996, 4, True), (5, 59_996, 4, False)} <= out
    assert {(8, 1, 8, True), (9, 1, 9, True)} <= out
    n = len(SAID.split()) - 4
    assert {(None, n, None, True), (6, n, None, False), (7, n + 1, None, False)} <= out
    assert near_dedup.near_groups(none).collect() == []


def test_mix(docs, none):
    out = mixing.mix_sources(docs)
    rows = out.select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert len(rows) == len(ROWS)
    total = sum(r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert {r.source for r in rows} == {None, "", "a", "b"}
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(total)
    assert all(r.taken <= 3 * r.size for r in rows) and len({r.taken for r in rows if r.doc_id == 5}) == 1
    kept_columns(out, docs)
    assert mixing.mix_sources(none).collect() == []


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(1, SAID, 9), (1, SAID, 9), (2, None, 9), (3, "", 9), (4, "two words", 9)], "item_id long, text string, doc_id long")
    found = decontaminate.leaks(docs, items).collect()
    assert sorted({(r.doc_id or -1, r.item_id, r.coverage) for r in found}) == [(-1, 1, 1.0), (6, 1, 1.0), (7, 1, 1.0), (10, 1, 1.0)]
    assert len(found) == 8  # the repeated item counts twice
    clean = decontaminate.keep_clean(docs, items)
    assert clean.schema == docs.schema and clean.count() == len(ROWS) - 4
    assert decontaminate.leaks(none, items).collect() == [] and decontaminate.leaks(docs, items.limit(0)).collect() == []
    assert decontaminate.keep_clean(docs, items.limit(0)).count() == len(ROWS)


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(6, 1), (8, 0), (8, 0), (None, 1), (4, None), (7, 5)], "doc_id long, label int")
    weights = quality.train(quality.labelled_sample(docs, labels))
    out = quality.score(docs, weights)
    rows = out.select("doc_id", "score", "predicted").collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    kept_columns(out, docs)
    nothing = quality.train(quality.labelled_sample(docs, labels.limit(0)))
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(none, weights).collect() == []


def test_language(docs, none):
    model = language_id.train(language_id.language_sample(docs))
    out = language_id.identify(docs, model)
    by = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(ROWS)
    assert [(by[i].lang_pred, by[i].score) for i in (1, 2, 3, 8)] == [("und", 0.0)] * 4
    assert by[4].lang_pred == "de" and by[6].lang_pred == "en" and by[9].lang_pred in ("de", "en")
    kept_columns(out, docs)
    assert language_id.train(language_id.language_sample(none)) is None
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.identify(none, model).collect() == []


def test_html(docs, none):
    out = html_extract.extract(docs.withColumn("html", F.concat(F.lit("<p>"), "text")).withColumn("n_chars", F.lit("x")))
    by = {r.doc_id: r for r in out.collect()}
    assert (by[1].text, by[1].n_chars, by[2].text, by[3].text, by[6].text) == ("", 0, "", "", SAID)
    assert by[4].text == LONG
    kept_columns(out, docs)
    assert html_extract.extract(none.withColumn("html", F.col("text"))).collect() == []


def test_chat(spark):
    rows = [(1, 0, "user", None, "x"), (1, 1, "assistant", "a", "x"), (1, 1, "assistant", "a", "x"), (None, 0, "user", "q", "x"),
            (2, None, None, "late", "x"), (2, 0, "to: ol", LONG, "x"), (3, 0, "user", "", "x"), (3, 1, "assistant", "", "x")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_chat(given).withColumn("turns", chat.parse_chat(F.col("formatted")))
    by = {r.conv_id: r for r in out.collect()}
    assert [tuple(t) for t in by[1].turns] == [("user", ""), ("assistant", "a"), ("assistant", "a")] and not by[1].valid
    assert [tuple(t) for t in by[2].turns] == [("to: ol", LONG), ("", "late")] and not by[2].valid
    assert by[3].valid and [tuple(t) for t in by[None].turns] == [("user", "q")]
    assert chat.format_chat(given.limit(0)).collect() == []


def test_search(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [0.5, 0.25]), (1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (None, [0.5, 0.25]), (7, [-1.0]), (20, [1.0, 0.0, 3.0]), (20, [1.0, 0.0, 4.0])]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = given.filter(topk_search.usable(F.col("embedding"))).select("vec_id", topk_search.scaled(F.col("embedding")).alias("vector"))
    out = topk_search.search(vectors, vectors.filter("vec_id % 20 = 0"), 4).collect()
    got = {q: [(r["rank"], r.vec_id, r.score) for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 20)}
    assert got[0] == [(1, 20, 2048), (2, 20, 2048), (3, None, 1280), (4, 1, 1280)]
    assert got[20] == [(1, None, 2048), (2, 0, 2048), (3, 1, 2048), (4, 1, 2048)]
    assert topk_search.search(vectors.limit(0), vectors, 4).collect() == [] == topk_search.search(vectors, vectors.limit(0), 4).collect()


def test_pipeline_stages(spark, docs, none, tmp_path):
    spark.createDataFrame([(1, "some other test item of five words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (docs, none):
        now = given
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, str(tmp_path))
            if name != "source_mixing":
                assert out.columns == given.columns
            out.write.parquet(f"{tmp_path}/{name}-{given is docs}")
            now = spark.read.parquet(f"{tmp_path}/{name}-{given is docs}")
        assert (now.count() > 0) == (given is docs)
