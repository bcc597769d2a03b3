"""The corpus operators over the sample tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm import (
    editprint,
    language,
    lexical,
    licences,
    mixing,
    packing,
    prefixtree,
    quality,
    secrets,
    simhash,
    toxicity,
    vectors,
    warc,
)
from seqloom.llm.common import held_out, table, tidy_session, written
from seqloom.session import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(SQL)


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, ~held_out("doc_id", 5, 0))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        "score",
        "predicted",
        "n_sentences",
        F.size("toxic_spans").alias("n_toxic_sentences"),
    )


@query
def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, ~held_out("doc_id", 4, 2))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out("doc_id", 4, 2).alias("held_out"),
        "score",
        "predicted",
        "n_lines",
        F.size("bad_lines").alias("n_bad_lines"),
    )


@query
def op3_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.systematic_sample(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL["op4_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(concat_ws(':', '17', doc_id::VARCHAR)), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS draw
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight,
         3.0 * source_size::DOUBLE AS most, sum(source_size) OVER ()::DOUBLE AS total
  FROM sources
), filled AS (
  SELECT *, most / weight AS full_at,
         coalesce(sum(most) OVER before, 0) AS filled,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
  FROM weighted
  WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT max((total - filled) / open_weight) AS level FROM filled WHERE (total - filled) / open_weight <= full_at
), targets AS (
  SELECT source, source_size, least(most, coalesce(level, 0) * weight) AS target,
         CASE WHEN source_size > 0 THEN least(most, coalesce(level, 0) * weight) / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5(concat_ws(':', '17', 'offset', coalesce('=' || source, 'null'))), 1, 12))::BIGINT
           / 281474976710656.0::DOUBLE AS off
  FROM filled, level
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.rate, t.off,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.draw, s.doc_id NULLS LAST) AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (least(floor(off + place * rate) - floor(off + (place - 1) * rate), 3) * size)::BIGINT AS taken
FROM placed
"""


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.select("doc_id", "text", "lang"), ~held_out("doc_id", 4, 2))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op5_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


SQL["op5_embedding_neardup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), component AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, component_id = vec_id AS kept
FROM embeddings JOIN component ON component.x = vec_id LEFT JOIN degree ON degree.x = vec_id
"""


@query
def op7_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    tidy = tidy_session(spark)
    docs = table(tidy, sf_dir, "documents").select("doc_id", "text")
    compared = materialize(editprint.compare_with_next(docs), "edit-compared")
    classed, path = written(editprint.with_classes(compared), "edit-classed")
    return spark.read.schema(classed.schema).parquet(path)


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rebuilt = prefixtree.share_openings(prefixtree.ordered_turns(conversations))
    return prefixtree.prefix_tree(conversations, rebuilt)


SQL["op13_prefix_trie"] = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT conv_id, digest, length(text) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
  FROM turns
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(
           list_concat([4294967295::BIGINT], list_transform(
             range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT)),
           lambda a, x: list_reduce(
             list_concat([xor(a, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, n.pos, n.digest, n.chars FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, n.pos, n.digest, n.chars FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.pos > c.h
), paths AS (
  SELECT conv_id, row_number() OVER own AS depth, string_agg(digest, '/') OVER own AS key, chars
  FROM rebuilt WINDOW own AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
), members AS (
  SELECT conv_id, depth, key, chars, coalesce(lag(key) OVER (PARTITION BY conv_id ORDER BY depth), '') AS above FROM paths
  UNION ALL SELECT conv_id, 0, '', 0, NULL FROM convs
), nodes AS (
  SELECT key, depth, above, chars, min(conv_id) AS conv_id, count(*) AS n_convs FROM members GROUP BY key, depth, above, chars
), below AS (
  SELECT above AS key, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above
), leads AS (
  SELECT m.conv_id, m.depth, n.chars, n.n_convs, m.key, n.conv_id = m.conv_id AS leads, b.key IS NULL AS leaf
  FROM members m JOIN nodes n ON n.key = m.key LEFT JOIN below b ON b.key = m.key
), sums AS (
  SELECT key, sum(leaves) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT conv_id, key,
               sum(CASE WHEN leads AND leaf THEN 1 ELSE 0 END) OVER onward AS leaves,
               sum(CASE WHEN leads THEN (n_convs - 1) * chars ELSE 0 END) OVER onward AS saved
        FROM leads WINDOW onward AS (PARTITION BY conv_id ORDER BY depth DESC ROWS UNBOUNDED PRECEDING))
  GROUP BY key
), ends AS (
  SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(key, depth) AS key FROM members GROUP BY conv_id) GROUP BY key
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(b.n_children, 0) AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
       coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s ON s.key = n.key LEFT JOIN below b ON b.key = n.key LEFT JOIN ends e ON e.key = n.key
LEFT JOIN nodes p ON p.key = n.above
"""


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op11_ranked_search"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), held AS (
  SELECT row_no, doc_id, len(terms)::BIGINT AS n, terms FROM words WHERE len(terms) > 0
), stats AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM held
), wanted AS (
  SELECT item_no, item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_no, item_id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT *, row_number() OVER () AS item_no FROM benchmark))
  GROUP BY item_no, item_id, term
), postings AS (
  SELECT row_no, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT row_no, doc_id, n, unnest(terms) AS term FROM held)
  WHERE term IN (SELECT term FROM wanted) GROUP BY row_no, doc_id, n, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, stats GROUP BY term, docs
), scored AS (
  SELECT item_no, item_id, row_no, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN postings USING (term), stats
  GROUP BY item_no, item_id, row_no, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS place
  FROM scored WHERE score > 0
)
SELECT item_id, place::INTEGER AS "rank", doc_id, score FROM ranked WHERE place <= 10
"""


@query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch_path(spark, "warc")
    warc.write_archives(warc.with_roles(table(spark, sf_dir, "pages")), where)
    records = warc.read_archives(spark, where, payload=False).where("kind = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op12_warc"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
), groups AS (
  SELECT payload, max(page_id) AS first, count(*) AS n FROM payloads GROUP BY payload
)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(digest, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - i % 4 * 5)) % 32 + 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM payloads JOIN groups USING (payload)
"""
