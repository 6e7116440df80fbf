"""The dealt operators as queries over the whole given tables, and the SQL twins where SQL can express them."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm import bpe, grace, hosts, lexical, maxscore, minhash, packing, quality, token_files, toxicity, training, trie, vptree, warc

#: Rules of the url query (fixed values).
URL_RULES = [
    hosts.Rule("allow", "org", "/"),
    hosts.Rule("block", "example.org", "/es/"),
    hosts.Rule("block", "example.org", "/en/1"),
    hosts.Rule("allow", "com", "/fr/"),
    hosts.Rule("block", "com", "/de/"),
]
#: The document that a page shows is the number at the end of its path.
PAGE_DOCUMENT = "/([0-9]{1,18})(/|[.]html)?$"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rank_tokenizer() -> str:
    import public_tokenizers

    return bpe.tokenizer_from_ranks(
        bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    )


def library_tokenizer() -> str:
    import public_tokenizers

    return Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), rank_tokenizer())


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.read(spark, token_files.write(docs, library_tokenizer(), end_id=0, added_tokens=True))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), library_tokenizer(), end_id=0, added_tokens=True)


def classified(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id",
        training.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return classified(toxicity.scores(docs, labels), toxicity.THRESHOLD)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return classified(quality.scores(docs, labels), quality.THRESHOLD)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(spark, warc.write(table(spark, sf_dir, "pages"), least=0))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vptree.nearest(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace.duplicates(table(spark, sf_dir, "documents"))


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host of every page, and whether the document it shows is labelled as good and not toxic (null: no label)."""
    host, path = hosts.host_and_path(F.col("url"))
    pages = table(spark, sf_dir, "pages").select(host.alias("host"), path.alias("path"))
    shown = pages.select("host", F.expr(f"try_cast(nullif(regexp_extract(path, '{PAGE_DOCUMENT}', 1), '') AS BIGINT)").alias("doc_id"))
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    labels = table(spark, sf_dir, "labels").select("doc_id", good.alias("good"))
    return shown.join(labels, "doc_id", "left").select("host", "good")


def op10_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(table(spark, sf_dir, "pages"), page_outcomes(spark, sf_dir), URL_RULES)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return maxscore.top_products(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.known_turns(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(trie.with_shared_heads(turns, every=20, longest=4))


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_token_files, op3_toxicity, op4_quality, op5_warc, op6_packing, op7_minhash, op8_nearest, op9_exact_dedup,
        op10_url_reputation, op11_lexical, op12_maxscore, op13_trie,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first, sha1(html) AS hex FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    (('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f""",
    "op8_nearest": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_inner_product(q.e, c.e) / (sqrt(list_inner_product(q.e, q.e)) * sqrt(list_inner_product(c.e, c.e))) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op9_exact_dedup": """
WITH n AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[ \\t-\\r]', '', 'g') AS plain FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(plain) AS text_sha256
FROM n WINDOW w AS (PARTITION BY plain ORDER BY length(text) DESC, doc_id)""",
    "op10_url_reputation": hosts.judge_sql(URL_RULES),
    "op11_lexical": r"""
WITH low AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms, row_number() OVER () AS row FROM documents),
docs AS (SELECT *, len(terms) AS n FROM low WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS words FROM docs),
times AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY row, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM times, corpus GROUP BY term, n_docs),
wanted AS (
  SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL) GROUP BY item_id, term),
scores AS (
  SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // words))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN times USING (term) JOIN docs USING (row), corpus
  WHERE doc_id IS NOT NULL GROUP BY item_id, doc_id, row)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10""",
    "op12_maxscore": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda x: x[1] * x[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10""",
    "op13_trie": r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)),
    4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
pieces AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN turns t ON t.conv_id = base AND pos <= h
  UNION ALL SELECT conv_id, 1, pos, role, text FROM convs JOIN turns USING (conv_id) WHERE pos > h),
whole AS (
  SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (pos IS NOT NULL), []) AS path
  FROM convs LEFT JOIN pieces USING (conv_id) GROUP BY conv_id),
members AS (SELECT conv_id, unnest(range(len(path) + 1)) AS depth, path FROM whole),
nodes AS (
  SELECT path[:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth)), sha256('')) AS ends_sha256
  FROM members GROUP BY prefix, depth),
found AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[:n.depth] = n.prefix) AS n_children,
    (n.n_convs - 1) * CASE WHEN n.depth = 0 THEN 0 ELSE len(regexp_extract_all(n.prefix[n.depth].text, '[^ \t-\r]+')) END AS own
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[:n.depth - 1])
SELECT t.conv_id, t.depth, t.parent_conv_id, t.n_convs, t.n_children, count(*) FILTER (b.n_children = 0) AS n_leaves,
  sum(b.own)::BIGINT AS saved_tokens, t.ends_sha256
FROM found t JOIN found b ON b.depth >= t.depth AND b.prefix[:t.depth] = t.prefix
GROUP BY ALL""",
}
