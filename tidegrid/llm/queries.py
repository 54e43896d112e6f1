"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.llm import (
    chat, clustering, decontaminate, html_extract, language_id, line_dedup, mixing, near_dedup, quality, substring_dedup,
    token_alignment, token_files, topk_search,
)
from tidegrid.session import scratch_path

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, text,
    coalesce(role, '') IN ('system', 'user', 'assistant') AND coalesce(CASE lag(coalesce(role, '')) OVER w WHEN 'system' THEN role = 'user'
      WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' END,
      row_number() OVER w = 1 AND role IN ('system', 'user'), false) AS ok,
    row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AND role = 'assistant' AS ends,
    length(replace(replace(replace(text, '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>')) + 8
    + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
      ELSE 9 + 2 + length(replace(replace(replace(replace(coalesce(role, ''), '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>'), ': ', ':\ ')) END AS n
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, ''), text)
)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns, bool_and(ok) AND bool_or(ends) AS valid,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


@query("op8_chat_formatting", CHAT_SQL)
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    tricky = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], given.schema)
    out = chat.format_chat(given.unionByName(extra)).withColumn("turns", chat.parse_chat(F.col("formatted")))
    loss = chat.loss_text(F.col("turns"), F.col("segments"))
    digest = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"), "valid",
        F.sha2(digest.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::HUGEINT AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source
), w AS (
  SELECT *, CASE r % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS w FROM s
), o AS (
  SELECT *, sum(n) OVER ()::HUGEINT - 3 * coalesce(sum(n) OVER p, 0)::HUGEINT AS l,
    sum(w) OVER ()::HUGEINT - coalesce(sum(w) OVER p, 0)::HUGEINT AS wl
  FROM w WINDOW p AS (ORDER BY n::DOUBLE / w::DOUBLE, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, 3 * n * wl <= l * w AS stops FROM o
), t AS (
  SELECT source, n, CASE WHEN stops THEN (3 * n)::DOUBLE
    ELSE (max(l) FILTER (NOT stops) OVER () * w)::DOUBLE / (max(wl) FILTER (NOT stops) OVER ())::DOUBLE END AS target
  FROM f
), b AS (
  SELECT *, CASE WHEN n > 0 THEN floor(target / n::DOUBLE)::BIGINT ELSE 0 END AS rounds FROM t
), v AS (
  SELECT source, h, sum(size) AS n FROM d GROUP BY source, h
), c AS (
  SELECT v.source, v.h, 2 * sum(v.n) OVER (PARTITION BY v.source ORDER BY v.h) - v.n
    < 2 * (b.target - b.rounds * b.n::DOUBLE) AS taken
  FROM v JOIN b ON v.source IS NOT DISTINCT FROM b.source
)
SELECT d.doc_id::BIGINT AS doc_id, d.size, b.n::BIGINT AS source_size, b.target::DOUBLE AS target,
  (d.size * (b.rounds + c.taken::BIGINT))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""


@query("op9_source_mixing", MIX_SQL)
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, u.i AS i, u.line AS line,
    translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents) d,
    LATERAL (SELECT unnest(d.a) AS line, unnest(range(1, len(d.a) + 1)) AS i) u
), r AS (
  SELECT k, max(doc_id) AS holder FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT l.doc_id::BIGINT AS doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (r.k IS NOT NULL AND r.holder <> l.doc_id)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (r.k IS NULL OR r.holder = l.doc_id), '')) AS kept_sha256
FROM l LEFT JOIN r ON l.k = r.k GROUP BY l.doc_id
"""


@query("op6_line_dedup", LINES_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


REPEATS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents
), w AS (
  SELECT doc_id, unnest(a) AS word, unnest(range(1, len(a) + 1)) AS i, unnest(range(1, len(a) + 1)) <= len(a) - 19 AS starts
  FROM d
), s AS (
  SELECT doc_id, i, word, CASE WHEN starts THEN string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) END AS s
  FROM w
), r AS (
  SELECT doc_id, i, word,
    CASE WHEN s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 THEN i END AS again
  FROM s
), k AS (
  SELECT doc_id, i, word, coalesce(i - max(again) OVER (PARTITION BY doc_id ORDER BY i) <= 19, false) AS gone FROM r
), g AS (
  SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM k GROUP BY doc_id
)
SELECT d.doc_id::BIGINT AS doc_id, len(d.a)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed,
  sha256(coalesce(g.kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


@query("op5_substring_dedup", REPEATS_SQL)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return substring_dedup.drop_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


SEARCH_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.w, v.w)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id::BIGINT AS query_id,
  (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id::BIGINT AS vec_id, score
FROM p QUALIFY rank <= 20
"""


@query("op3_topk_search", SEARCH_SQL)
def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(topk_search.usable(F.col("embedding"))).select(
        "vec_id", topk_search.scaled(F.col("embedding")).alias("vector")
    )
    return topk_search.search(rows, rows.filter(F.col("vec_id") % 20 == 0))


NEAR_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS a FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) >= 5 THEN [array_to_string(a[i:i + 4], ' ') FOR i IN range(1, len(a) - 3)]
    WHEN len(a) > 0 THEN [array_to_string(a, ' ')] ELSE [] END) AS g FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), k AS (
  SELECT a, b FROM l JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b WHERE 100 * m >= 75 * (u.n + v.n - m)
), e AS (
  SELECT a, b FROM k UNION ALL SELECT b, a FROM k
), r AS (
  SELECT doc_id AS id, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id
), c AS (
  SELECT id, min(root) AS component_id FROM r GROUP BY id
)
SELECT d.doc_id::BIGINT AS doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id::BIGINT AS component_id,
  d.doc_id = c.component_id AS kept
FROM d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query("op7_near_dedup", NEAR_SQL)
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return near_dedup.near_groups(docs)


@query("op1_html_extraction")
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long"), "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars")


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long"), F.col("quality").alias("label"))
    out = quality.held_out(F.col("doc_id"), 3, 1)
    weights = quality.train(quality.labelled_sample(docs, labels.filter(~out)))
    return quality.score(docs, weights).select("doc_id", out.alias("held_out"), "score", "predicted")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text", "lang")
    out = quality.held_out(F.col("doc_id"), 4, 2)
    model = language_id.train(language_id.language_sample(docs.filter(~out)))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score"
    )


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenizer(name: str) -> str:
    """Where this machine keeps a public vocabulary; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return token_alignment.align(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def _cluster_sql(k: int = 40, rounds: int = 5) -> str:
    parts = [f"""v AS MATERIALIZED (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), w) - 1)::INTEGER AS cluster, w
  FROM v WHERE vec_id IS NOT NULL QUALIFY cluster < {k}
)"""]
    for r in range(rounds + 1):
        parts.append(f"""d{r} AS (
  SELECT v.vec_id, v.w, c.cluster, list_sum([(v.w[i] - c.w[i]) * (v.w[i] - c.w[i]) FOR i IN range(1, 65)])::BIGINT AS distance
  FROM v CROSS JOIN c{r} c
), a{r} AS MATERIALIZED (
  SELECT row_id, any_value(vec_id) AS vec_id, any_value(w) AS w, min(distance) AS distance,
    arg_min(cluster, distance * {k}::HUGEINT + cluster) AS cluster
  FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY vec_id, w) AS row_id FROM d{r}) GROUP BY row_id
)""")
        if r < rounds:
            parts.append(f"""m{r} AS (
  SELECT cluster, i, sum(x) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(w) AS x, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY cluster, i
), c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(n.w, c.w) AS w FROM c{r} c LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS w FROM m{r} GROUP BY cluster
  ) n ON n.cluster = c.cluster
)""")
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id::BIGINT AS vec_id, a.cluster, a.distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
  (sum(a.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.w, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.cluster"""


@query("op12_centroid_clustering", _cluster_sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = clustering.cluster(clustering.kept_vectors(table(spark, sf_dir, "embeddings")))
    digest = F.sha2(F.concat_ws(",", F.transform("centroid", lambda x: x.cast("string"))), 256)
    few = centroids.select("cluster", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))  # a row per centroid
    return assigned.join(F.broadcast(few), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


@query("op13_token_files")
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path, tokenizer("word_bpe_49k.json"))
    return token_files.digests(token_files.read_tokens(spark, path))
