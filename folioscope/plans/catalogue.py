"""Registered queries over the driver's tables, each with its SQL where SQL can express it.

Documents, pages, conversations and embeddings stand in for articles: a document
becomes an MDX article by ``derived_mdx``, a conversation is an article whose
turns are its images, and an embedding is an index row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import markdown, refs, text, vectors
from ..operators import articles, encoders, gates, ids, images, index, retrieval, stats
from ..sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

QUERY_TEXT = "the of and licence"
KEYWORDS = ["src1", "doc", "the"]


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark, sf):
    return table(spark, sf, "documents").withColumn("text", F.coalesce("text", F.lit("")))


def vectors_of(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_idx"), "embedding", "label")


def asked(spark, sf) -> DataFrame:
    """The stated query set: every row whose id is divisible by 100."""
    return vectors_of(spark, sf).filter("row_idx % 100 = 0").select(F.col("row_idx").alias("query_id"), "embedding")


def derived_mdx() -> Column:
    n = F.col("doc_id").cast("string")
    return F.concat(
        F.lit("---\ntitle: "), F.col("source"), F.lit("-"), n, F.lit("\nlang: "), F.col("lang"), F.lit("\n---\n# Doc "), n, F.lit("\n\n"), F.col("text"),
        F.lit("\n\n```\n<Widget />\n```\n\n<!-- hidden ![h](h.png) -->\n\n![a](img_"), (F.col("doc_id") % 7).cast("string"), F.lit(".png) ![b](https://x.example/y.png)\n"),
    )


MDX = """('---' || chr(10) || 'title: ' || source || '-' || doc_id || chr(10) || 'lang: ' || lang || chr(10) || '---' || chr(10) || '# Doc ' || doc_id || chr(10) || chr(10) || coalesce(text, '') || chr(10) || chr(10) || '```' || chr(10) || '<Widget />' || chr(10) || '```' || chr(10) || chr(10) || '<!-- hidden ![h](h.png) -->' || chr(10) || chr(10) || '![a](img_' || (doc_id % 7) || '.png) ![b](https://x.example/y.png)' || chr(10))"""


def mdx(spark, sf) -> DataFrame:
    return documents(spark, sf).withColumn("mdx", derived_mdx())


def ragged(spark, sf) -> DataFrame:
    """A conversation as an article: its turns are its images, their roles its references."""
    turns = table(spark, sf, "conversations")
    slots = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    own = turns.groupBy("conv_id").agg(slots.alias("slots"))
    return own.select(
        F.col("conv_id").alias("row_idx"), F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("id"),
        F.transform("slots", lambda s: F.concat_ws(":", s["turn"].cast("string"), s["role"])).alias("image_refs"),
        F.transform("slots", lambda s: F.struct(F.coalesce(s["text"], F.lit("")).cast("binary").alias("bytes"), F.lit(None).cast("string").alias("path"))).alias("images"),
        F.array_join(F.transform("slots", lambda s: F.coalesce(s["text"], F.lit(""))), "\n").alias("content"),
    )


# Retrieval

_COS = "list_dot_product(a.v, q.v) / ((sqrt(list_dot_product(a.v, a.v)) + 1e-12) * (sqrt(list_dot_product(q.v, q.v)) + 1e-12))"
_V = "WITH a AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), q AS (SELECT vec_id AS query_id, label, v FROM a WHERE vec_id % 100 = 0)"
_RANKED = f", s AS (SELECT query_id, vec_id AS row_idx, {_COS} AS score FROM a, q), r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_idx) AS rank, row_idx, score FROM s)"
_TOP = f"{_V}, s AS (SELECT a.vec_id AS row_idx, {_COS} AS score FROM a, q WHERE query_id = 0), r AS (SELECT row_number() OVER (ORDER BY score DESC, row_idx)::INT AS rank, row_idx, score FROM s)"


def first_vector(spark, sf) -> list[float]:
    return list(vectors_of(spark, sf).filter("row_idx = 0").first()["embedding"])


@query(f"{_TOP} SELECT rank, row_idx, round(score, 6) AS score FROM r WHERE rank <= 10")
def cosine_topk(spark, sf):
    return retrieval.topk(vectors_of(spark, sf), first_vector(spark, sf), 10).withColumn("score", F.round("score", 6))


@query(f"{_V}{_RANKED} SELECT query_id, rank::INT AS rank, row_idx, round(score, 6) AS score FROM r WHERE rank <= 10")
def cosine_topk_batch(spark, sf):
    return retrieval.topk_batch(vectors_of(spark, sf), asked(spark, sf), 10).withColumn("score", F.round("score", 6))


@query(f"{_V}{_RANKED} SELECT query_id, rank::INT AS rank, row_idx, round(score, 6) AS score FROM r WHERE rank <= 10")
def cosine_topk_native(spark, sf):
    return retrieval.topk_native(vectors_of(spark, sf), asked(spark, sf), 10).withColumn("score", F.round("score", 6))


_LINE = r"trim(regexp_replace({0}, '[ \t\n\r\f\v]+', ' ', 'g'))"
_SNIPPET = "CASE WHEN {0} = '' THEN '(no text)' WHEN length({0}) <= {1} THEN {0} ELSE rtrim(substr({0}, 1, {1} - 1)) || '…' END"


@query(
    f"{_TOP}, d AS (SELECT doc_id, source, {_LINE.format("coalesce(text, '')")} AS line FROM documents) "
    f"SELECT rank, row_idx, round(score, 6) AS score, 'doc-' || doc_id AS id, source AS title, 0 AS n_images, {_SNIPPET.format('line', 110)} AS snippet, "
    "repeat('█', round_even(greatest(0, least(1, score)) * 14, 0)::INT) || repeat('░', 14 - round_even(greatest(0, least(1, score)) * 14, 0)::INT) AS bar "
    "FROM r JOIN d ON row_idx = doc_id WHERE rank <= 10"
)
def topk_hydrated(spark, sf):
    corpus = documents(spark, sf).select(F.col("doc_id").alias("row_idx"), F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"), F.col("source").alias("title"), F.col("text").alias("content"), F.array().cast("array<string>").alias("image_refs"))
    return retrieval.hydrate(retrieval.topk(vectors_of(spark, sf), first_vector(spark, sf), 10), corpus).withColumn("score", F.round("score", 6))


_ENCODED = r"""WITH t AS (SELECT doc_id, unnest(string_split_regex(lower(coalesce(text, '')), '[ \t\n]+')) AS w FROM documents UNION ALL SELECT -1, unnest(string_split('{0}', ' '))),
b AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 6))::BIGINT % 64 AS b, count(*)::DOUBLE AS n FROM t WHERE w <> '' GROUP BY ALL),
l AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM b GROUP BY ALL),
s AS (SELECT b.doc_id, sum(b.n * q.n) AS dot FROM b JOIN b q ON q.doc_id = -1 AND q.b = b.b WHERE b.doc_id >= 0 GROUP BY ALL),
c AS (SELECT d.doc_id AS row_idx, round(coalesce(dot, 0) / coalesce(l.norm * (SELECT norm FROM l WHERE doc_id = -1), 1), 6) AS score FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN l ON l.doc_id = d.doc_id)
SELECT row_number() OVER (ORDER BY score DESC, row_idx)::INT AS rank, row_idx, score FROM c QUALIFY rank <= 10"""


@query(_ENCODED.format(QUERY_TEXT))
def text_query_topk(spark, sf):
    encoder = encoders.HashEncoder(64)
    made = documents(spark, sf).select(F.col("doc_id").alias("row_idx"), encoder.column(F.col("text")).alias("embedding"))
    scored = retrieval.scores(made, encoder.encode_queries([QUERY_TEXT])[0].tolist()).withColumn("score", F.round("score", 6))
    best = scored.orderBy(F.desc("score"), "row_idx").limit(10)
    return best.select(F.row_number().over(Window.orderBy(F.desc("score"), "row_idx")).alias("rank"), "row_idx", "score")


@query("SELECT vec_id AS row_idx, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm, round(embedding[1]::DOUBLE / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) + 1e-12), 6) AS first FROM embeddings")
def l2_normalise(spark, sf):
    rows = vectors_of(spark, sf)
    return rows.select("row_idx", F.round(vectors.norm(F.col("embedding")), 6).alias("norm"), F.round(F.get(vectors.normalised(F.col("embedding")), F.lit(0)), 6).alias("first"))


@query("SELECT count(*) AS rows, count(*) FILTER (len(list_filter(embedding, lambda x: NOT isfinite(x))) > 0) AS bad FROM embeddings")
def finite_check(spark, sf):
    return vectors_of(spark, sf).agg(F.count("*").alias("rows"), F.count_if(~vectors.finite(F.col("embedding"))).alias("bad"))


@query("SELECT count(*) AS rows, min(len(embedding))::INT AS smallest, max(len(embedding))::INT AS largest FROM embeddings")
def dim_check(spark, sf):
    return vectors_of(spark, sf).agg(F.count("*").alias("rows"), F.min(F.size("embedding")).alias("smallest"), F.max(F.size("embedding")).alias("largest"))


@query(
    f"{_V}, s AS (SELECT query_id, CASE WHEN a.label = q.label THEN 'in-domain' ELSE 'out-of-domain' END AS kind, max({_COS}) AS top FROM a, q WHERE vec_id <> query_id GROUP BY ALL) "
    "SELECT round(min(top) FILTER (kind = 'in-domain'), 6) AS in_domain_top1, round(max(top) FILTER (kind = 'out-of-domain'), 6) AS out_of_domain_top1, coalesce(max(top) FILTER (kind = 'out-of-domain') < min(top) FILTER (kind = 'in-domain'), false) AS passed FROM s"
)
def smoke_verdict(spark, sf):
    labelled = vectors_of(spark, sf).select("row_idx", "label", vectors.doubles(F.col("embedding")).alias("v"))
    probes = labelled.filter("row_idx % 100 = 0").withColumnRenamed("row_idx", "query_id")
    tops = retrieval.best_by_kind(labelled, probes)
    return retrieval.verdict(tops).select(F.round("in_domain_top1", 6).alias("in_domain_top1"), F.round("out_of_domain_top1", 6).alias("out_of_domain_top1"), "passed")


@query(f"{_TOP} SELECT coalesce(min(rank) FILTER (row_idx = 0 AND rank <= 10), -1)::INT AS rank FROM r")
def self_rank(spark, sf):
    return retrieval.rank_of(retrieval.topk(vectors_of(spark, sf), first_vector(spark, sf), 10), 0)


# Index bookkeeping

@query("SELECT (vec_id // 128)::INT AS part_id, min(vec_id) AS first_row, count(*) AS rows FROM embeddings GROUP BY ALL")
def parts_manifest(spark, sf):
    return index.part_plan(vectors_of(spark, sf))


@query("SELECT doc_id // 256 AS shard, min(doc_id) AS first_row, count(*) AS rows FROM documents GROUP BY ALL")
def shards_manifest(spark, sf):
    return tables.shard_plan(documents(spark, sf).withColumn("row_idx", F.col("doc_id")))


@query("WITH p AS (SELECT (vec_id // 128)::INT AS part_id, min(vec_id) AS first_row, count(*) AS rows FROM embeddings GROUP BY ALL) SELECT * FROM p WHERE part_id % 3 <> 0")
def resume_pending_parts(spark, sf):
    """Every third part is on disk whole, the next one a row short."""
    planned = index.part_plan(vectors_of(spark, sf))
    done = planned.filter("part_id % 3 < 2").withColumn("rows", F.col("rows") - F.col("part_id") % 3)
    return index.pending(planned, done)


@query(
    "WITH e AS (SELECT count(*)::VARCHAR AS n, arg_min(doc_id, doc_id)::VARCHAR AS i0, arg_min(coalesce(text, ''), doc_id) AS c0, arg_max(doc_id, doc_id)::VARCHAR AS i1, arg_max(coalesce(text, ''), doc_id) AS c1 FROM documents) "
    "SELECT substr(sha256(strlen(n) || n || strlen(i0) || i0 || strlen(c0) || c0 || strlen(i1) || i1 || strlen(c1) || c1), 1, 32) AS sha FROM e"
)
def head_sha(spark, sf):
    return index.head_sha(documents(spark, sf).select(F.col("doc_id").alias("row_idx"), F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content")))


# Ids and order

@query("WITH r AS (SELECT doc_id, source, source || '/' || doc_id || '/index.mdx' AS rel, row_number() OVER (PARTITION BY source ORDER BY source || '/' || doc_id || '/index.mdx') AS k FROM documents) SELECT doc_id, CASE WHEN k = 1 THEN source ELSE source || '#' || substr(sha1(rel), 1, 8) END AS id FROM r")
def id_dedupe(spark, sf):
    named = documents(spark, sf).select("doc_id", "source", F.concat_ws("/", "source", F.col("doc_id").cast("string"), F.lit("index.mdx")).alias("rel"))
    return ids.with_ids(named, "rel", F.col("source")).select("doc_id", "id")


@query("SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(url, '^https?://', ''), '/?index.mdx$', ''), ''), 'root') AS base FROM (SELECT page_id, rtrim(split_part(split_part(url, '?', 1), '#', 1), '/') AS url FROM pages)")
def path_ids(spark, sf):
    plain = F.rtrim(F.substring_index(F.substring_index("url", "?", 1), "#", 1), F.lit("/"))
    rel = F.concat(F.regexp_replace(plain, "^https?://", ""), F.lit("/index.mdx"))
    return table(spark, sf, "pages").select("page_id", ids.base_id(rel).alias("base"))


@query("SELECT count(*) - count(DISTINCT source) AS duplicates FROM documents")
def dup_ids(spark, sf):
    return stats.duplicate_ids(documents(spark, sf), "source")


@query("WITH e AS (SELECT doc_id AS row_idx, source AS id, CASE WHEN n_chars % 11 = 3 THEN source || '?' ELSE source END AS expected_id FROM documents) SELECT row_idx, expected_id, id FROM e WHERE id IS DISTINCT FROM expected_id ORDER BY row_idx LIMIT 1")
def order_prefix_check(spark, sf):
    rows = documents(spark, sf).select(F.col("doc_id").alias("row_idx"), F.col("source").alias("id"), "n_chars")
    expected = rows.withColumn("id", F.when(F.col("n_chars") % 11 == 3, F.concat("id", F.lit("?"))).otherwise(F.col("id")))
    return gates.first_divergence(rows, expected)


@query("SELECT doc_id AS row_idx, source AS id, NULL AS title, 0 AS n_images, length(coalesce(text, ''))::INT AS n_chars, 'Doc ' || doc_id AS heading FROM documents WHERE doc_id IN (0, (SELECT count(*) // 2 FROM documents), (SELECT count(*) - 1 FROM documents))")
def sample_rows(spark, sf):
    rows = documents(spark, sf)
    headed = rows.select(F.col("doc_id").alias("row_idx"), F.col("source").alias("id"), F.concat(F.lit("# Doc "), F.col("doc_id").cast("string"), F.lit("\n"), F.col("text")).alias("content"), F.array().cast("array<string>").alias("images"))
    found = gates.sample_rows(headed, rows.count())
    return found.withColumn("n_chars", F.col("n_chars") - F.char_length("heading") - 3)


@query("SELECT doc_id, source FROM documents WHERE doc_id < 100")
def limit_prefix(spark, sf):
    """The ``limit`` option: the first rows in order."""
    return documents(spark, sf).select("doc_id", "source").filter("doc_id < 100")


@query("SELECT conv_id AS row_idx, count(*)::INT AS n FROM conversations GROUP BY conv_id HAVING count(*) > 2 ORDER BY conv_id LIMIT 1")
def first_with_images(spark, sf):
    return ragged(spark, sf).select("row_idx", F.size("images").alias("n")).filter("n > 2").orderBy("row_idx").limit(1)


# Counters and gates

_TURNS = "WITH c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY ALL)"


@query(f"{_TURNS} SELECT n, count(*) AS rows FROM c GROUP BY n")
def turn_histogram_exact(spark, sf):
    return stats.exact_histogram(ragged(spark, sf), F.size("images"))


@query(f"{_TURNS} SELECT bin, count(n) AS rows FROM (VALUES ('0'), ('1'), ('2'), ('3'), ('4+')) b(bin) LEFT JOIN c ON bin = CASE WHEN n >= 4 THEN '4+' ELSE n::VARCHAR END GROUP BY bin")
def turn_histogram_binned(spark, sf):
    return stats.binned_histogram(ragged(spark, sf), F.size("images"))


@query(f"{_TURNS} SELECT count(*) AS rows, sum(n)::BIGINT AS total, max(n) AS most, count(*) FILTER (n > 0) AS with_images, count(*) FILTER (n = 0) AS text_only FROM c")
def image_count_stats(spark, sf):
    return stats.image_counts(ragged(spark, sf), F.size("images"))


@query(f"{_TURNS} SELECT conv_id AS row_idx, n FROM c WHERE n >= 5")
def large_rows(spark, sf):
    return gates.large_rows(ragged(spark, sf), 5)


@query("WITH r AS (SELECT conv_id AS row_idx, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos, row_number() OVER (ORDER BY conv_id, turn, role, text) - 1 AS k, turn || ':' || role AS ref FROM conversations), n AS (SELECT greatest(1, (count(*) + 399) // 400) AS stride FROM conversations) SELECT row_idx, pos::INT AS pos, ref FROM r, n WHERE k % stride = 0")
def stride_sample(spark, sf):
    return gates.sampled_images(ragged(spark, sf)).select("row_idx", "pos", "ref")


@query("WITH c AS (SELECT conv_id AS row_idx, count(*) AS a, count(*) FILTER (role = 'user') AS b FROM conversations GROUP BY ALL) SELECT 'C4' AS rule, row_idx, 'conv-' || row_idx AS id, 'len(images)=' || a || ' != len(image_refs)=' || b AS message FROM c WHERE a <> b")
def ragged_alignment(spark, sf):
    broken = ragged(spark, sf).withColumn("image_refs", F.filter("image_refs", lambda r: r.endswith(":user")))
    return gates.alignment_rule(broken).drop("pos")


@query(r"WITH d AS (SELECT doc_id AS row_idx, source AS id, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS t FROM documents) SELECT 'C1' AS rule, row_idx, id FROM d WHERE length(t) < 200 AND id NOT IN ('src1', 'src2')")
def content_gate(spark, sf):
    """Texts under 200 characters stand in for blank ones; two sources are flagged."""
    body = text.strip(F.col("text"))
    rows = documents(spark, sf).select(F.col("doc_id").alias("row_idx"), F.col("source").alias("id"), F.when(F.char_length(body) < 200, "").otherwise(F.col("text")).alias("content"))
    flagged = spark.createDataFrame([("src1",), ("src2",)], "id string")
    return gates.content_rule(rows, flagged).select("rule", "row_idx", "id")


@query(f"WITH d AS (SELECT doc_id, length(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13))) AS n FROM documents) SELECT doc_id, 'near-empty cleaned content (' || n || ' chars < 40)' AS reason FROM d WHERE n > 0 AND n < 40")
def content_guard(spark, sf):
    return documents(spark, sf).select("doc_id", articles.content_flag(F.col("text"), F.col("text")).alias("reason")).filter("reason IS NOT NULL")


@query("SELECT count(*) FILTER (length(coalesce(text, '')) = 0) AS empty_rows, count(*) FILTER (length(coalesce(text, '')) BETWEEN 1 AND 39) AS short_rows FROM documents")
def content_lengths(spark, sf):
    return stats.content_lengths(documents(spark, sf), F.col("text"))


@query("SELECT doc_id AS row_idx, source AS id FROM documents WHERE length(text) BETWEEN 1 AND 39 ORDER BY doc_id LIMIT 5")
def first_short_rows(spark, sf):
    rows = documents(spark, sf).select(F.col("doc_id").alias("row_idx"), F.col("source").alias("id"), "text")
    return stats.first_rows(rows, F.char_length("text").between(1, 39))


# Display

@query(f"WITH d AS (SELECT doc_id, {_LINE.format("coalesce(text, '')")} AS line FROM documents) SELECT doc_id, {_SNIPPET.format('line', 110)} AS snippet FROM d")
def snippet(spark, sf):
    return documents(spark, sf).select("doc_id", text.snippet(F.col("text")).alias("snippet"))


@query(f"WITH d AS (SELECT doc_id, {_LINE.format("coalesce(text, '')")} AS line FROM documents) SELECT doc_id, CASE WHEN length(line) <= 64 THEN line ELSE substr(line, 1, 63) || '…' END AS label FROM d")
def label_trunc(spark, sf):
    return documents(spark, sf).select("doc_id", text.label(F.col("text")).alias("label"))


@query("SELECT doc_id, CASE WHEN length(coalesce(text, '')) > 500 THEN substr(text, 1, 500) || chr(10) || chr(10) || '…[truncated — run `show 1 full` for the whole article]' ELSE coalesce(text, '') END AS shown FROM documents")
def show_trunc(spark, sf):
    return documents(spark, sf).select("doc_id", text.shown(F.col("text"), 500).alias("shown"))


@query("WITH f AS (SELECT event_id, value, round_even(greatest(0, least(1, value / 100)) * 14, 0)::INT AS n FROM events) SELECT event_id, repeat('█', n) || repeat('░', 14 - n) AS bar FROM f")
def score_bar(spark, sf):
    return table(spark, sf, "events").select("event_id", text.score_bar(F.col("value") / 100).alias("bar"))


@query(r"SELECT doc_id, substr(coalesce(regexp_extract(coalesce(text, ''), '^[ \t\n\r]*([^\n]*[^ \t\n\r])', 1), ''), 1, 96) AS first_line FROM documents")
def first_heading_line(spark, sf):
    return documents(spark, sf).select("doc_id", text.first_line(F.col("text")).alias("first_line"))


@query("SELECT doc_id, 'Doc ' || doc_id AS heading FROM documents")
def first_heading(spark, sf):
    return mdx(spark, sf).select("doc_id", text.first_heading(F.col("mdx")).alias("heading"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE 'Doc ' || doc_id END AS title FROM documents")
def display_title(spark, sf):
    title = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" "), F.col("source"))).otherwise("  ")
    return mdx(spark, sf).select("doc_id", text.display_title(title, F.col("mdx"), F.col("source")).alias("title"))


@query("SELECT doc_id, CASE WHEN contains(lower(source || ' ' || coalesce(text, '')), 'src1') THEN 'src1' WHEN contains(lower(source || ' ' || coalesce(text, '')), 'doc') THEN 'doc' WHEN contains(lower(source || ' ' || coalesce(text, '')), 'the') THEN 'the' END AS hit FROM documents")
def keyword_hit(spark, sf):
    return documents(spark, sf).select("doc_id", text.plausible(KEYWORDS, F.col("source"), F.col("text")).alias("hit"))


# Markdown rules, native

_SP = r"[ \t\n\r\f\v]"


def _html_sql(column: str) -> str:
    def replaced(own: str, pattern: str, by: str, flags: str = "gi") -> str:
        return f"regexp_replace({own}, '{pattern}', {by}, '{flags}')"

    own = column
    for name, mark in markdown.MARKED:
        own = replaced(own, f"<{_SP}*/?{_SP}*{name}\\b[^>]*>", f"'{mark}'")
    own = replaced(own, f"<{_SP}*/?{_SP}*br\\b{_SP}*/?{_SP}*>", "chr(10)")
    own = _link_sql(own)
    for name in markdown.DROPPED:
        own = replaced(own, f"<{_SP}*/?{_SP}*{name}\\b[^>]*>", "''")
    return own


def _link_sql(own: str) -> str:
    pattern = f"<{_SP}*a\\b[^>]*?href{_SP}*={_SP}*[''\"]([^''\"]+)[''\"][^>]*>{_SP}*(.*?){_SP}*</{_SP}*a{_SP}*>"
    return f"regexp_replace({own}, '{pattern}', '[\\2](\\1)', 'gis')"


@query(f"SELECT page_id, md5({_html_sql('html')}) AS md FROM pages")
def html_to_md(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(markdown.native_inline_html(F.col("html"))).alias("md"))


@query(f"SELECT page_id, {_link_sql('html')} AS md FROM pages")
def link_to_md(spark, sf):
    return table(spark, sf, "pages").select("page_id", markdown.native_links(F.col("html")).alias("md"))


@query("SELECT page_id, regexp_replace(html, '<!--.*?-->', '', 'gs') AS md FROM pages")
def strip_comments(spark, sf):
    return table(spark, sf, "pages").select("page_id", markdown.native_without_comments(F.col("html")).alias("md"))


_PROSE = "('import x from y' || chr(10) || coalesce(text, '') || chr(10) || 'export default z' || chr(10) || '{note: 1}' || chr(10) || '<Link to=\"/a\"> go </Link> <Widget n=\"1\" /> end' || chr(10))"


def prose(spark, sf) -> DataFrame:
    made = F.concat(F.lit("import x from y\n"), F.col("text"), F.lit("\nexport default z\n{note: 1}\n<Link to=\"/a\"> go </Link> <Widget n=\"1\" /> end\n"))
    return documents(spark, sf).select("doc_id", made.alias("prose"))


@query(f"SELECT doc_id, md5(regexp_replace({_PROSE}, '(^|\\n)[ \\t]*(import|export)\\b[^\\n]*', '\\1', 'g')) AS md FROM documents")
def import_lines(spark, sf):
    return prose(spark, sf).select("doc_id", F.md5(markdown.native_without_imports(F.col("prose"))).alias("md"))


@query(f"SELECT doc_id, md5(regexp_replace({_PROSE}, '<[A-Z][A-Za-z0-9]*\\b[^<>]*?/>', '', 'g')) AS md FROM documents")
def self_closed_components(spark, sf):
    return prose(spark, sf).select("doc_id", F.md5(markdown.native_without_self_closed(F.col("prose"))).alias("md"))


@query(f"SELECT doc_id, md5(regexp_replace({_PROSE}, '<Link\\b[^>]*>{_SP}*(.*?){_SP}*</Link{_SP}*>', '\\1', 'gs')) AS md FROM documents")
def link_components(spark, sf):
    return prose(spark, sf).select("doc_id", F.md5(markdown.native_link_pairs(F.col("prose"))).alias("md"))


@query(f"SELECT doc_id, md5(array_to_string(list_filter(string_split({_PROSE}, chr(10)), lambda s: NOT regexp_matches(s, '^[ \\t]*\\{{[^}}]*\\}}[ \\t]*$')), chr(10))) AS md FROM documents")
def brace_lines(spark, sf):
    return prose(spark, sf).select("doc_id", F.md5(markdown.native_without_brace_lines(F.col("prose"))).alias("md"))


@query(f"SELECT doc_id, md5(trim(regexp_replace(regexp_replace({_PROSE}, '[ \\t]+\\n', chr(10), 'g'), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'), chr(10))) AS md FROM documents")
def whitespace_tidy(spark, sf):
    return prose(spark, sf).select("doc_id", F.md5(markdown.native_tidy(F.col("prose"))).alias("md"))


@query(f"SELECT doc_id, md5({_PROSE} || ' tail') AS md FROM documents")
def props_tail(spark, sf):
    return prose(spark, sf).select("doc_id", F.md5(markdown.native_without_props(F.concat("prose", F.lit("-{props.x.y}> tail")))).alias("md"))


# Derived articles

@query("SELECT doc_id, source || '-' || doc_id AS title, '{\"lang\": \"' || lang || '\"}' AS metadata, 'Doc ' || doc_id AS h1 FROM documents")
def derived_frontmatter(spark, sf):
    front = mdx(spark, sf).withColumn("front", markdown.split_frontmatter(F.col("mdx")))
    return front.select("doc_id", F.col("front.title").alias("title"), F.col("front.meta_json").alias("metadata"), text.first_h1(F.col("front.body")).alias("h1"))


@query(f"SELECT doc_id, 'Doc ' || doc_id AS h1 FROM documents")
def derived_first_h1(spark, sf):
    return mdx(spark, sf).select("doc_id", text.first_h1(F.col("mdx")).alias("h1"))


@query(f"SELECT doc_id, md5(regexp_replace(regexp_replace({MDX}, '```.*?```\\n?', '', 'gs'), '<!--.*?-->', '', 'gs')) AS body FROM documents")
def derived_fence_strip(spark, sf):
    return mdx(spark, sf).select("doc_id", F.md5(markdown.native_effective_body(F.col("mdx"))).alias("body"))


_REFS = "(SELECT doc_id, unnest(['img_' || (doc_id % 7) || '.png', 'https://x.example/y.png']) AS ref, unnest([0, 1]) AS pos FROM documents)"


@query(f"SELECT doc_id, pos::INT AS pos, ref FROM {_REFS}")
def derived_image_refs(spark, sf):
    found = mdx(spark, sf).select("doc_id", F.posexplode(markdown.native_dests(markdown.native_effective_body(F.col("mdx")))).alias("pos", "ref"))
    return found.select("doc_id", "pos", refs.without_title(F.col("ref")).alias("ref"))


@query(f"SELECT doc_id, ref FROM {_REFS} WHERE NOT starts_with(ref, 'http')")
def derived_ref_filter(spark, sf):
    return derived_image_refs(spark, sf).filter(refs.in_scope(F.col("ref")) & refs.supported(F.col("ref"))).select("doc_id", "ref")


def listing(spark, sf) -> DataFrame:
    """A file listing: images 0 to 4 exist, 3 as a folder."""
    own = table(spark, sf, "documents").select((F.col("doc_id") % 5).alias("k")).distinct()
    path = F.concat(F.lit("img_"), F.col("k").cast("string"), F.lit(".png"))
    return own.select(path.alias("path"), F.concat(F.lit("/root/"), path).alias("abs_path"), F.when(F.col("k") == 3, "other").otherwise("file").alias("kind"))


def referenced(spark, sf) -> DataFrame:
    own = derived_ref_filter(spark, sf).withColumn("resolved", refs.resolved(F.lit(""), F.concat(F.lit("./sub/../"), F.col("ref"))))
    return images.resolve(own, listing(spark, sf))


@query(f"SELECT doc_id, ref, CASE WHEN doc_id % 7 > 4 THEN 'missing' WHEN doc_id % 7 = 3 THEN 'not-file' END AS reason FROM {_REFS} WHERE NOT starts_with(ref, 'http')")
def ref_resolution(spark, sf):
    return referenced(spark, sf).select("doc_id", "ref", "reason")


@query(f"SELECT count(*) AS refs, count(DISTINCT ref) AS files FROM {_REFS} WHERE NOT starts_with(ref, 'http') AND doc_id % 7 IN (0, 1, 2, 4)")
def ref_decode_once(spark, sf):
    return referenced(spark, sf).filter("reason IS NULL").agg(F.count("*").alias("refs"), F.count_distinct("abs_path").alias("files"))


@query("SELECT doc_id, 'text,fence,text,comment,text' AS kinds FROM documents")
def exact_chunks(spark, sf):
    front = markdown.split_frontmatter(F.col("mdx"))["body"]
    own = mdx(spark, sf).select("doc_id", front.alias("body")).select("doc_id", markdown.tokenise(F.col("body")).alias("chunks"))
    return own.select("doc_id", F.array_join(F.transform("chunks", lambda c: c["kind"]), ",").alias("kinds"))


@query(
    "SELECT doc_id, md5(trim(regexp_replace(regexp_replace('# Doc ' || doc_id || chr(10) || chr(10) || coalesce(text, '') || chr(10) || chr(10), '[ \\t]+\\n', chr(10), 'g'), '\\n{4,}', chr(10) || chr(10) || chr(10), 'g'), chr(10)) "
    "|| chr(10) || chr(10) || '```' || chr(10) || '<Widget />' || chr(10) || '```' || chr(10) || chr(10) || '![a](img_' || (doc_id % 7) || '.png) ![b](https://x.example/y.png)') AS content FROM documents"
)
def exact_clean(spark, sf):
    front = markdown.split_frontmatter(F.col("mdx"))["body"]
    return mdx(spark, sf).select("doc_id", front.alias("body")).select("doc_id", F.md5(markdown.cleaned(F.col("body"))).alias("content"))


@query(f"SELECT doc_id, pos::INT AS pos, ref FROM {_REFS}")
def exact_dests(spark, sf):
    return mdx(spark, sf).select("doc_id", F.posexplode(markdown.dests(F.col("mdx"))).alias("pos", "ref"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, array_to_string(json_keys(props), ',') AS names FROM events")
def metadata_json(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.array_join(F.json_object_keys("props"), ",").alias("names"))


# Articles of several shapes

_N = "doc_id::VARCHAR"
#: By doc_id modulo 5: a block of markup, what cleaning leaves of it in the prose before, and what follows.
_SHAPES = (
    ("<Tabs id=\"t\"><Tab>inner {n}</Tab></Tabs>", "<Tab>inner {n}</Tab>", ""),
    ("x <!-- one line --> y {n}", "x", "\n\n y {n}"),
    ("~~~\n<X />\n  ~~~\nafter {n}", "", "\n\n~~~\n<X />\n  ~~~\n\nafter {n}"),
    ("<B>bold {n}</B> and <br/>line", "bold {n} and\nline", ""),
    ("<a href=\"u/{n}\"><b>t</b></a>\n{note}\nend", "[**t**](u/{n})\nend", ""),
)


def _by_shape(k: int) -> Column:
    n = F.col("doc_id").cast("string")
    cases = [F.replace(F.lit(shape[k]), F.lit("{n}"), n) for shape in _SHAPES]
    return F.element_at(F.array(*cases), (F.col("doc_id") % 5 + 1).cast("int"))


def _shape_sql(k: int) -> str:
    return "(CASE doc_id % 5 " + " ".join(f"WHEN {i} THEN replace('" + shape[k].replace("\n", "' || chr(10) || '") + f"', '{{n}}', {_N})" for i, shape in enumerate(_SHAPES)) + " END)"


_HEADED = "'# Doc ' || doc_id || chr(10) || chr(10) || coalesce(text, '') || chr(10) || chr(10)"


@query(f"SELECT doc_id, md5(trim(regexp_replace(regexp_replace({_HEADED} || {_shape_sql(1)}, '[ \\t]+\\n', chr(10), 'g'), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'), chr(10)) || {_shape_sql(2)}) AS content FROM documents")
def shaped_clean(spark, sf):
    body = F.concat(F.lit("# Doc "), F.col("doc_id").cast("string"), F.lit("\n\n"), F.col("text"), F.lit("\n\n"), _by_shape(0))
    return documents(spark, sf).select("doc_id", body.alias("body")).select("doc_id", F.md5(markdown.cleaned(F.col("body"))).alias("content"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN 'text,comment,text' WHEN 2 THEN 'text,fence,text' ELSE 'text' END AS kinds FROM documents")
def shaped_chunks(spark, sf):
    body = F.concat(F.col("text"), F.lit("\n\n"), _by_shape(0))
    own = documents(spark, sf).select("doc_id", body.alias("body")).select("doc_id", markdown.tokenise(F.col("body")).alias("chunks"))
    return own.select("doc_id", F.array_join(F.transform("chunks", lambda c: c["kind"]), ",").alias("kinds"))


@query(
    "WITH r AS (SELECT doc_id, source, unnest(['p_(' || doc_id || ').PNG', 'i/' || doc_id || '.jpg', '../up/' || doc_id || '.gif', '../../../' || doc_id || '.webp', 'x/' || doc_id || '.txt']) AS ref, "
    "unnest([source || '/' || doc_id || '/p_(' || doc_id || ').PNG', source || '/' || doc_id || '/i/' || doc_id || '.jpg', source || '/up/' || doc_id || '.gif', doc_id || '.webp', source || '/' || doc_id || '/x/' || doc_id || '.txt']) AS resolved, unnest([true, true, true, true, false]) AS supported FROM documents) "
    "SELECT doc_id, ref, resolved, supported FROM r"
)
def shaped_refs(spark, sf):
    """References with titles, parentheses, steps above the root, templates, and other schemes; through the article's own reference rules."""
    n = F.col("doc_id").cast("string")
    links = ("![a](p_({n}).PNG)", "![b](i/{n}.jpg \"a title\")", "[![c](../up/{n}.gif)](big.png)", "![d]({{ x }}.png)", "![e](../../../{n}.webp 't')", "![f](x/{n}.txt)", "![g](/abs.png) ![h](data:x) ![i](#a)", "<!-- ![j](gone.png) -->")
    body = F.concat("text", F.lit("\n\n"), F.replace(F.lit("\n".join(links)), F.lit("{n}"), n))
    own = documents(spark, sf).select("doc_id", F.col("doc_id").alias("row_idx"), F.concat_ws("/", "source", n, F.lit("index.mdx")).alias("rel_path"), n.alias("id"), body.alias("body")).withColumn("dests", markdown.dests(F.col("body")))
    found = articles.references(own)
    return found.select(F.col("row_idx").alias("doc_id"), F.col("original_ref").alias("ref"), "resolved", refs.supported(F.col("resolved")).alias("supported"))


_BYTES = "doc_id % 10 = 3"


@query(
    f"WITH r AS (SELECT doc_id, source || '/' || doc_id AS base, {_BYTES} AS broken FROM documents) SELECT doc_id AS row_idx, base AS id, NOT broken AS readable, CASE WHEN NOT broken THEN base END AS title, CASE WHEN NOT broken THEN 1 END AS n_dests FROM r"
)
def parsed_articles(spark, sf):
    """Articles from bytes, every tenth of them no UTF-8: ids, front matter and targets of the first stage."""
    own = mdx(spark, sf)
    name = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    body = F.concat(F.lit("---\ntitle: "), name, F.lit("\n---\n"), F.col("text"), F.lit("\n\n![a](b.png)\n")).cast("binary")
    corpus = own.select(F.col("doc_id").alias("row_idx"), F.concat(name, F.lit("/index.mdx")).alias("rel_path"), F.col("source").alias("dir_name"), F.when(F.expr(_BYTES), F.concat(body, F.lit(bytearray(b"\xff")))).otherwise(body).alias("content"))
    made = articles.parsed(corpus)
    return made.select("row_idx", "id", F.col("text").isNotNull().alias("readable"), F.col("front.title").alias("title"), F.when(F.col("text").isNotNull(), F.size("dests")).alias("n_dests"))


@query(f"SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) AS row_idx FROM documents WHERE NOT ({_BYTES})")
def dense_rows(spark, sf):
    rows = documents(spark, sf).select("doc_id", F.col("doc_id").alias("row_idx"))
    return ids.dense(rows.filter(~F.expr(_BYTES)), rows.filter(F.expr(_BYTES)).select("row_idx"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR coalesce(text, '') = '' THEN source ELSE text END AS input FROM documents")
def row_text(spark, sf):
    own = documents(spark, sf).select("doc_id", F.col("source").alias("id"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text")).alias("content"), F.col("source").alias("text"))
    return own.select("doc_id", index.row_text().alias("input"))


@query("SELECT doc_id AS row_idx, 'row-' || doc_id AS id, NULL AS title, coalesce(text, '') AS content, 'row-' || doc_id AS source_path, 0 AS n_images FROM documents")
def absent_columns(spark, sf):
    view = tables.corpus_view(documents(spark, sf).select(F.col("doc_id").alias("row_idx"), "text"))
    return view.select("row_idx", "id", "title", "content", "source_path", F.size("image_refs").alias("n_images"))


# Reports and gates over whole tables

def built(spark, sf) -> articles.Build:
    """Documents as a build: in-scope references with their decoding results, flagged contents, and unreadable articles."""
    own = referenced(spark, sf).withColumnRenamed("doc_id", "row_idx").withColumn("abs_path", F.when(F.col("reason").isNull(), F.col("abs_path")))
    k = F.col("row_idx") % 7
    good = F.col("reason").isNull()
    every = own.withColumns({"error": F.when(good & (k == 4), "corrupt: x"), "png": F.when(good & (k != 4), F.lit(b"p")), "multi": good & (k == 1), "down": good & (k == 2)})
    images_of = every.filter("png IS NOT NULL").groupBy("row_idx").agg(F.collect_list("png").alias("images"))
    docs = documents(spark, sf).select(F.col("doc_id").alias("row_idx"), F.col("doc_id").cast("string").alias("id"), "text")
    rows = docs.join(images_of, "row_idx", "left").withColumn("images", F.coalesce("images", F.array().cast("array<binary>")))
    flagged = docs.select("id", articles.content_flag(F.col("text"), F.col("text")).alias("reason")).filter("reason IS NOT NULL")
    failed = docs.filter("row_idx % 50 = 7").select(F.col("id").alias("article"), F.lit("x").alias("error"))
    return articles.Build(rows, every, failed, every, flagged)


_COUNTED = """WITH d AS (SELECT doc_id, doc_id % 7 AS k, length(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13))) AS n FROM documents),
c AS (SELECT count(*) AS converted, count(*) FILTER (doc_id % 50 = 7) AS failed, count(*) FILTER (k IN (0, 1, 2)) AS pictured, count(*) FILTER (k > 4) AS missing, count(*) FILTER (k = 4) AS corrupt, count(*) FILTER (k = 3) AS not_file, count(*) FILTER (n > 0 AND n < 40) AS flagged,
  count(DISTINCT k) FILTER (k IN (0, 1, 2)) AS files, count(DISTINCT k) FILTER (k = 1) AS multi, count(DISTINCT k) FILTER (k = 2) AS down FROM d)"""


@query(f"{_COUNTED} SELECT converted + failed AS articles_total, converted, failed, pictured AS rows_with_images, converted - pictured AS text_only_rows, pictured AS resolved_local_image_refs, files AS unique_image_files_embedded, missing AS missing_refs_dropped, corrupt AS corrupt_images_dropped, not_file AS not_file_dropped, 0 AS unsupported_ext_dropped, multi AS gif_flattened, down AS images_downscaled, 1 AS max_images_in_one_article, flagged FROM c")
def build_counters(spark, sf):
    counted = stats.counters(built(spark, sf))
    names = ("articles_total", "converted", "failed", "rows_with_images", "text_only_rows", "resolved_local_image_refs", "unique_image_files_embedded", "missing_refs_dropped", "corrupt_images_dropped", "not_file_dropped", "unsupported_ext_dropped", "gif_flattened", "images_downscaled", "max_images_in_one_article")
    return spark.createDataFrame([(*(int(counted[n]) for n in names), len(counted["warn_empty_content"]))], ", ".join(f"{n} long" for n in (*names, "flagged")))


@query(f"{_COUNTED}, f AS (SELECT unnest(['failed=' || failed, 'missing_refs_dropped=' || missing, 'corrupt_images_dropped=' || corrupt, 'not_file_dropped=' || not_file]) AS failure FROM c) SELECT failure FROM f WHERE NOT ends_with(failure, '=0')")
def strict_failures(spark, sf):
    return spark.createDataFrame([(f,) for f in gates.strict_failures(stats.counters(built(spark, sf)))], "failure string")


@query(f"{_TURNS}, h AS (SELECT n, count(*) AS rows, row_number() OVER (ORDER BY n) AS k, count(*) OVER () AS bins FROM c GROUP BY n) SELECT string_agg(n || ': ' || rows, ', ' ORDER BY n) FILTER (k <= 4) || CASE WHEN max(bins) > 4 THEN ', ... ' || max(n) || ': ' || arg_max(rows, n) ELSE '' END AS line FROM h")
def compact_histogram(spark, sf):
    counted = {r["n"]: r["rows"] for r in stats.exact_histogram(ragged(spark, sf), F.size("images")).collect()}  # a row per count
    return spark.createDataFrame([(stats.compact_histogram(counted),)], "line string")


class LengthProbe:
    """A stand-in decoder for queries: an image's bytes are text, its mode and frames follow from their number."""

    def probe(self, data: bytes) -> tuple[int, int, str, int]:
        if len(data) % 11 == 0:
            raise ValueError("undecodable")
        return len(data), 1, "L" if len(data) % 7 == 0 else "RGB", 1 + (len(data) % 5 == 0)


_PROBED = "CASE WHEN b = 0 THEN 'an image without content' WHEN b % 11 = 0 THEN 'undecodable' ELSE nullif(concat_ws('; ', CASE WHEN b % 7 = 0 THEN 'mode=L' END, CASE WHEN b % 5 = 0 THEN 'n_frames=2' END), '') END"
_SLOTS = "SELECT conv_id AS row_idx, 'conv-' || conv_id AS id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1)::INT AS pos, strlen(coalesce(text, '')) AS b, role FROM conversations"


@query(f"WITH s AS ({_SLOTS}), m AS (SELECT 'C3' AS rule, row_idx, id, pos, {_PROBED} AS message FROM s) SELECT * FROM m WHERE message IS NOT NULL")
def image_check(spark, sf):
    return gates.image_rule(ragged(spark, sf), LengthProbe())


_BROKEN = f"s AS ({_SLOTS}), r AS (SELECT row_idx, id, count(*) AS a, count(*) FILTER (role = 'user') AS u FROM s GROUP BY ALL), t AS (SELECT conv_id AS row_idx, bool_and(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) = '') AS blank FROM conversations GROUP BY ALL)"
_ROW_RULES = (
    "SELECT 'C1' AS rule, row_idx, id, NULL::INT AS pos, 'empty content without a flag' AS message FROM r JOIN t USING (row_idx) WHERE (blank OR row_idx % 4 = 1) AND row_idx % 8 <> 1 "
    "UNION ALL SELECT 'C2', row_idx, id, NULL, 'images is null' FROM r WHERE row_idx % 9 = 2 "
    "UNION ALL SELECT 'C4', row_idx, id, NULL, 'len(images)=' || CASE WHEN row_idx % 9 = 2 THEN 0 ELSE a END || ' != len(image_refs)=' || u FROM r WHERE CASE WHEN row_idx % 9 = 2 THEN 0 ELSE a END <> u"
)


def broken(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Conversations as articles with blank contents, null lists and lost references; and which are flagged."""
    rows = ragged(spark, sf)
    rows = rows.withColumns({
        "content": F.when(F.col("row_idx") % 4 == 1, " ").otherwise(F.col("content")),
        "images": F.when(F.col("row_idx") % 9 != 2, F.col("images")),
        "image_refs": F.filter("image_refs", lambda r: r.endswith(":user")),
    })
    return rows, rows.filter("row_idx % 8 = 1").select("id")


@query(f"WITH {_BROKEN}, g AS ({_ROW_RULES} UNION ALL SELECT 'rows', NULL, NULL, NULL, 'expected 1 rows, found ' || count(*) FROM r UNION ALL SELECT 'C3', row_idx, id, pos, {_PROBED} FROM s WHERE row_idx % 9 <> 2 AND {_PROBED} IS NOT NULL) SELECT * FROM g")
def hard_gate(spark, sf):
    rows, flagged = broken(spark, sf)
    return gates.hard_gate(rows, flagged, 1, LengthProbe())


@query(f"WITH {_BROKEN}, g AS ({_ROW_RULES}) SELECT * FROM g WHERE row_idx < 8")
def handoff_gate(spark, sf):
    return gates.handoff_gate(*broken(spark, sf))


@query(
    f"{_TURNS}, t AS (SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn, role, text) AS content FROM conversations GROUP BY ALL), n AS (SELECT greatest(1, (count(*) + 399) // 400) AS stride, count(*) AS images FROM conversations) "
    "SELECT count(*) AS rows, any_value(n.images) AS images_total, max(c.n) AS max_images_in_row, count(*) FILTER (c.n >= 4) AS four_or_more, count(*) FILTER (length(content) = 0) AS empty_content_rows, count(*) FILTER (length(content) BETWEEN 1 AND 39) AS short_content_rows, any_value((n.images + stride - 1) // stride) AS images_sample_checked, 0 AS align_failures FROM c JOIN t USING (conv_id), n"
)
def verification(spark, sf):
    said = gates.verify(ragged(spark, sf).withColumn("text", F.col("content")), decoder=LengthProbe())
    names = ("rows", "images_total", "max_images_in_row", "four_or_more", "empty_content_rows", "short_content_rows", "images_sample_checked", "align_failures")
    said |= {"four_or_more": said["histogram"]["4+"], "align_failures": len(said["align_failures"])}
    return spark.createDataFrame([tuple(int(said[n]) for n in names)], ", ".join(f"{n} long" for n in names))


@query("SELECT sha256('{\"dim\": ' || any_value(len(embedding)) || ', \"rows\": ' || count(*) || '}') AS key FROM embeddings")
def index_key(spark, sf):
    n, dim, _, _ = index.shape(vectors_of(spark, sf))
    return spark.createDataFrame([(index.config_key({"rows": n, "dim": dim}),)], "key string")


@query("SELECT doc_id AS row_idx, CASE WHEN doc_id % 6 = 0 THEN 0 WHEN doc_id % 6 = 5 THEN 4 * (doc_id % 6) ELSE doc_id % 6 END::INT AS n FROM documents")
def encoder_slots(spark, sf):
    """What an encoder gets of a row's images by the native strategy: none for no images, else all of them."""

    @F.arrow_udf("int")
    def given(column):
        import pyarrow as pa

        return pa.array([len(images.row_image(x, "native")) for x in column.to_pylist()], pa.int32())

    n = F.col("doc_id") % 6
    held = F.array_repeat(F.lit(b"i"), F.when(n == 5, 4 * n).otherwise(n).cast("int"))
    return documents(spark, sf).select(F.col("doc_id").alias("row_idx"), given(held).alias("n"))


# Arithmetic

@query("WITH s AS (SELECT doc_id, n_chars + 1 AS w, doc_id % 5000 + 1 AS h FROM documents), c AS (SELECT *, 1000.0::DOUBLE / greatest(w, h) AS f, greatest(w, h) > 1000 AS over FROM s) SELECT doc_id, CASE WHEN over THEN greatest(1, round_even(w * f, 0))::INT ELSE w::INT END AS width, CASE WHEN over THEN greatest(1, round_even(h * f, 0))::INT ELSE h::INT END AS height, over AS downscaled FROM c")
def resize_target(spark, sf):
    size = vectors.resized((F.col("n_chars") + 1).cast("int"), (F.col("doc_id") % 5000 + 1).cast("int"), 1000)
    return documents(spark, sf).select("doc_id", size.alias("s")).select("doc_id", "s.*")


@query("SELECT conv_id AS row_idx, ceil(sqrt(n))::INT AS cols, ceil(n / ceil(sqrt(n)))::INT AS rows FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY ALL)")
def grid_shape(spark, sf):
    return ragged(spark, sf).select("row_idx", vectors.grid(F.size("images")).alias("g")).select("row_idx", "g.*")
