"""The registered queries of the numbered operators: each applies its operator,
with production parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontam, embed_dedup, exact_dedup, hard_negatives, lines, ngram_join, pii, prefix_trie, secrets, toxicity, urls, warc
from tessera.llm.common import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark)
    manifest = warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(manifest, folder).drop("payload")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def _spans(col, kinds):
    """kind:start:end by start, then kind as listed, comma-joined."""
    order = F.array(*map(F.lit, kinds))
    ranked = F.array_sort(F.transform(col, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind"))))
    return F.concat_ws(",", F.transform(ranked, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _count(kind):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _span_digest(found: DataFrame, kinds) -> DataFrame:
    return found.select(
        F.col("id").alias("doc_id"),
        *map(_count, kinds),
        F.sha2(_spans(F.col("base"), kinds), 256).alias("base_sha256"),
        _spans(F.concat("base", "added"), kinds).alias("spans"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(pii.find(table(spark, sf_dir, "documents")), pii.KINDS)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return got.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(secrets.find(table(spark, sf_dir, "documents")), secrets.KINDS)


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return got.withColumnRenamed("id", "vec_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lines.drop_boilerplate(docs).select("doc_id", "source", "text", F.length("text").cast("long").alias("n_chars"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), all_digests=True)
    return got.withColumnsRenamed({"id": "doc_id", "digest": "text_sha256"})


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(vectors, F.col("vec_id") % 100 == 0, label)


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_url_filters, op3_warc, op4_decontamination, op5_toxicity, op6_pii,
                                   op7_byte_bpe, op8_secrets, op9_embedding_near_dedup, op10_line_dedup, op11_prefix_trie, op12_exact_dedup, op13_hard_negatives)}

_URL_PARTS = """
SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz') AS host,
       regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages)"""


def _site_sql(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"


def _pattern_sql(rule: str) -> str:
    if rule.startswith("||"):
        return f"(starts_with(lower(host), '{rule[2:]}') OR contains(lower(host), '.{rule[2:]}'))"
    return f"(contains(lower(host), '{rule}') OR contains(lower(path), '{rule}'))"


#: Unsigned CRC-32 of the text ?, bit by bit: a byte is added, then -1 eight times shifts.
_CRC32_SQL = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(?, ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT)"""

_longest_first = sorted(urls.SITE_RULES, key=lambda r: -len(r[1]))

ORACLE_SQL = {
    "op2_url_filters": f"""
WITH p AS ({_URL_PARTS}),
r AS (SELECT *, CASE {' '.join(f"WHEN {_site_sql(t)} THEN '{t}'" for _, t in _longest_first)} END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE {' '.join(f"WHEN rule = '{t}' THEN '{a}'" for a, t in _longest_first)}
            WHEN {' OR '.join(_pattern_sql(t) for _, t in urls.PATTERN_RULES)} THEN 'block' ELSE 'allow' END AS verdict
FROM r""",
    "op3_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, sha256(body) AS payload_digest, CAST(strlen(body) AS BIGINT) AS payload_bytes FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f""",
    "op4_decontamination": """
WITH w AS (SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS words FROM documents
           UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') FROM benchmark),
k AS (SELECT side, id, words, least(5, len(words)) AS width FROM w WHERE side = 'i' AND len(words) > 0),
r AS (SELECT * FROM k UNION ALL SELECT w.side, id, words, u.width FROM w, (SELECT DISTINCT width FROM k) u
      WHERE side = 'd' AND len(words) >= u.width),
s AS (SELECT DISTINCT side, id, width, unnest(list_transform(range(1, len(words) - width + 2),
             lambda k: array_to_string(words[k:k + width - 1], ' '))) AS shingle FROM r),
q AS (SELECT id, count(*) AS n FROM s WHERE side = 'i' GROUP BY id),
h AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared
      FROM s d JOIN s i ON d.side = 'd' AND i.side = 'i' AND d.shingle = i.shingle AND d.width = i.width GROUP BY ALL)
SELECT doc_id, item_id, n AS item_shingles, shared FROM h JOIN q ON h.item_id = q.id
WHERE shared * 5 >= n * 4""",
    "op9_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND len(e) > 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id, vec_id AS reached FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT c.vec_id, coalesce(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept
FROM c LEFT JOIN n ON c.vec_id = n.vec_id""",
    "op10_line_dedup": """
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents),
t AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
b AS (SELECT l.source, line FROM l JOIN t ON l.source IS NOT DISTINCT FROM t.source WHERE trim(line) <> ''
      GROUP BY l.source, line, pages HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) > 0.1 * pages),
k AS (SELECT doc_id, string_agg(l.line, chr(10) ORDER BY k) AS text FROM l
      LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.line = b.line WHERE b.line IS NULL GROUP BY doc_id)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END) AS n_chars
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op11_prefix_trie": f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                  sha256(coalesce(text, ''))) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT DISTINCT c, c - c % 20 AS base, {_CRC32_SQL.replace('?', 'CAST(c AS VARCHAR)')} % 4 AS h FROM t),
b AS (SELECT h.c, t.pos AS k, role, text FROM h JOIN t ON t.c = h.base AND t.pos <= h.h
      UNION ALL SELECT h.c, t.pos + 10, role, text FROM h JOIN t ON t.c = h.c AND t.pos > h.h),
d AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY k) AS d, sha256(length(role) || ':' || role || text) AS turn,
             len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM b),
p AS (SELECT c, d, string_agg(turn, ',') OVER (PARTITION BY c ORDER BY d) AS path, words FROM d
      UNION ALL SELECT c, 0, '', 0 FROM h),
l AS (SELECT c, max(d) AS n FROM p GROUP BY c),
g AS (SELECT path, p.d, min(p.c) AS c, count(*) AS n, min(words) AS words, max(l.n > p.d) AS inner_node,
             coalesce(string_agg(CASE WHEN l.n = p.d THEN CAST(p.c AS VARCHAR) END, ',' ORDER BY p.c), '') AS ends
      FROM p JOIN l ON p.c = l.c GROUP BY path, p.d),
s AS (SELECT a.path, CAST(sum(CAST(NOT u.inner_node AS INTEGER)) AS BIGINT) AS n_leaves,
             CAST(sum((u.n - 1) * u.words) AS BIGINT) AS saved,
             count(CASE WHEN u.d = a.d + 1 THEN 1 END) AS n_children
      FROM g u JOIN p a ON a.c = u.c AND a.d <= u.d GROUP BY a.path)
SELECT g.c AS conv_id, CAST(g.d AS BIGINT) AS depth, f.c AS parent_conv_id, g.n AS n_convs, n_children, n_leaves, saved AS saved_tokens,
       sha256(g.ends) AS ends_sha256
FROM g JOIN s ON g.path = s.path LEFT JOIN p q ON q.c = g.c AND q.d = g.d - 1 LEFT JOIN g f ON f.path = q.path""",
    "op12_exact_dedup": """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.body) AS text_sha256 FROM n JOIN g ON n.body = g.body""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER) AS rank,
       s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) <= 5""",
}
