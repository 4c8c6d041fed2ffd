"""Registered text queries (T*, A11, A14, S7, S8, S14, S20) over all documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import text as TX
from tessera.operators import relational as R
from tessera.operators import summarize as SM
from tessera.operators import text as TO
from tessera.plans.catalog import query
from tessera.plans.text_sql import (ALPHA_LIST, WORD_PUNCT_LIST, LANGS, base_ctes, textrank_ctes,
                                    top_summary_body, with_ctes)
from tessera.session import cut_lineage
from tessera.sources import tables as T


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _docs(spark, sf):
    return T.table(spark, sf, "documents").select("doc_id", "text")


def _clean(spark, sf):
    return TO.clean_sentence_tokens(_docs(spark, sf))


def _tokens(spark, sf):
    """The tokens of ``_clean`` for queries that read them once."""
    return TO.clean_tokens(_docs(spark, sf))


def _bag(spark, sf):
    """Their bag of words, written once."""
    return cut_lineage(TO.bag_of_words(_tokens(spark, sf)))


# ------------------------------------------------------------ tokenizers

@query("T1_whitespace_tokens", r"""
SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, tok AS token FROM documents,
  unnest(list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> ''))
  WITH ORDINALITY AS t(tok, i)""")
def t1(spark, sf):
    return TO.ws_tokens(_docs(spark, sf))


@query("T2_alpha_tokens", "SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, tok AS token "
       "FROM documents, unnest(" + ALPHA_LIST.format(c="text") + ") WITH ORDINALITY AS t(tok, i)")
def t2(spark, sf):
    return TO.alpha_tokens(_docs(spark, sf))


@query("T3_word_tokens_per_doc", r"""
SELECT doc_id, count(*) AS n_tokens, count(DISTINCT tok) AS n_distinct FROM documents,
  unnest(regexp_extract_all(lower(text), '([\p{L}\p{N}_]+)', 1)) AS t(tok) GROUP BY doc_id""")
def t3(spark, sf):
    return (TO.word_tokens(_docs(spark, sf)).groupBy("doc_id")
            .agg(F.count(F.lit(1)).alias("n_tokens"), F.countDistinct("token").alias("n_distinct")))


@query("T4_word_punct_tokens_per_doc", "SELECT doc_id, count(*) AS n_tokens, "
       "count(DISTINCT tok) AS n_distinct FROM documents, unnest("
       + WORD_PUNCT_LIST.format(c="text") + ") AS t(tok) GROUP BY doc_id")
def t4(spark, sf):
    return (TO.word_punct_tokens(_docs(spark, sf)).groupBy("doc_id")
            .agg(F.count(F.lit(1)).alias("n_tokens"), F.countDistinct("token").alias("n_distinct")))


@query("T5_sentences", lambda: with_ctes(base_ctes("sents"),
                                         "SELECT doc_id, sent_id, sentence FROM sents"))
def t5(spark, sf):
    return TO.sentences(_docs(spark, sf))


@query("A11_max_tokens_per_doc", "SELECT max(len(" + ALPHA_LIST.format(c="text")
       + ")) AS max_size FROM documents")
def a11(spark, sf):
    d = _docs(spark, sf).select(TX.alpha_tokens(F.col("text")).alias("tokens"))
    return d.agg(F.max(F.size("tokens")).cast("bigint").alias("max_size"))


# ------------------------------------------------------------ language, stop words

@query("T7_detect_language", lambda: with_ctes(base_ctes("langs"),
                                               "SELECT doc_id, lang, hits FROM langs"))
def t7(spark, sf):
    docs = _docs(spark, sf)
    toks = TO.sentence_tokens(TO.sentences(docs))
    return TO.detect_language(toks, docs=docs)


def _lang_case():
    return "CASE l.lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TX.LANG_CODES.items()) \
        + " END"


@query("T7_language_accuracy", lambda: with_ctes(base_ctes("langs"), f"""
SELECT d.lang, count(*) AS n,
       CAST(sum(CASE WHEN {_lang_case()} = d.lang THEN 1 ELSE 0 END) AS BIGINT) AS correct
FROM documents d JOIN langs l ON d.doc_id = l.doc_id GROUP BY d.lang"""))
def t7b(spark, sf):
    docs = T.table(spark, sf, "documents")
    toks = TO.sentence_tokens(TO.sentences(docs.select("doc_id", "text")))
    det = TO.detect_language(toks, docs=docs)
    codes = spark.createDataFrame(list(TX.LANG_CODES.items()), "lang string, code string")
    j = (docs.select("doc_id", "lang").join(det.withColumnRenamed("lang", "det"), "doc_id")
         .join(F.broadcast(codes).withColumnRenamed("lang", "det"), "det", "left"))
    return j.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("code") == F.col("lang")).cast("bigint")).alias("correct"))


@query("T6_stop_word_removal", lambda: with_ctes(base_ctes("clean"), """
SELECT s.doc_id, count(*) AS n_tokens, count(c.token) AS n_clean
FROM stoks s LEFT JOIN clean c ON s.doc_id = c.doc_id AND s.sent_id = c.sent_id AND s.pos = c.pos
GROUP BY s.doc_id"""))
def t6(spark, sf):
    sents, clean, langs = _clean(spark, sf)
    toks = TO.sentence_tokens(sents)
    c = clean.select("doc_id", "sent_id", "pos", F.lit(1).alias("kept"))
    return (toks.join(c, ["doc_id", "sent_id", "pos"], "left").groupBy("doc_id")
            .agg(F.count(F.lit(1)).alias("n_tokens"), F.count("kept").alias("n_clean")))


# ------------------------------------------------------------ frequencies, weights

@query("A14_token_frequency", lambda: with_ctes(base_ctes("clean"), """
SELECT token AS term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM clean GROUP BY 1"""))
def a14(spark, sf):
    _, clean, _ = _clean(spark, sf)
    return TO.token_frequency(clean)


@query("T9_frequency_filter", lambda: with_ctes(base_ctes("clean"), """
SELECT term, df FROM (SELECT token AS term, count(DISTINCT doc_id) AS df FROM clean GROUP BY 1) f
WHERE df BETWEEN 10 AND 500"""))
def t9(spark, sf):
    _, clean, _ = _clean(spark, sf)
    kept = TO.filter_frequency(clean, 10, 500)
    return TO.token_frequency(kept).select("term", "df")


@query("T10_dictionary", lambda: with_ctes(base_ctes("clean"), """
SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS term_id, term, df FROM (
  SELECT token AS term, count(DISTINCT doc_id) AS df FROM clean GROUP BY 1) f WHERE df >= 2"""))
def t10(spark, sf):
    _, clean, _ = _clean(spark, sf)
    d = TO.dictionary(clean, 2)
    return d.select(F.col("term_id").cast("bigint").alias("term_id"), "term", "df")


@query("T11_bag_of_words", lambda: with_ctes(base_ctes("clean"), """
SELECT doc_id, token AS term, count(*) AS cnt FROM clean GROUP BY 1, 2"""))
def t11(spark, sf):
    return TO.bag_of_words(_tokens(spark, sf))


def _maxtf_sql(a):
    return with_ctes(base_ctes("clean"), f"""
WITH b AS (SELECT doc_id, token AS term, count(*) AS cnt FROM clean GROUP BY 1, 2),
m AS (SELECT doc_id, max(cnt) AS mx FROM b GROUP BY 1),
w AS (SELECT b.doc_id, b.term, {a} + {1 - a} * (b.cnt / m.mx) AS w
      FROM b JOIN m ON b.doc_id = m.doc_id)
SELECT doc_id, term, round(w, 6) AS w FROM w WHERE w < 0.9 AND w > 0.1""")


@query("T12_max_tf_normalised", lambda: _maxtf_sql(0.5))
def t12(spark, sf):
    return TO.max_tf(_tokens(spark, sf), a=0.5).withColumn("w", r6("w"))


@query("T13_max_tf_plain", lambda: _maxtf_sql(0.0))
def t13(spark, sf):
    return TO.max_tf(_tokens(spark, sf), a=0.0).withColumn("w", r6("w"))


@query("T14_tfidf_smooth_sentences", lambda: with_ctes(base_ctes("tfidf"), """
SELECT doc_id, sent_id, term, round(w, 6) AS w FROM tfidf"""))
def t14(spark, sf):
    w = TO.tfidf_smooth(_tokens(spark, sf), TO.sentences(_docs(spark, sf)).select("doc_id", "sent_id"))
    return w.withColumn("w", r6("w"))


@query("T15_tfidf_log2_documents", lambda: with_ctes(base_ctes("clean"), """
WITH b AS (SELECT doc_id, token AS term, count(*) AS cnt FROM clean GROUP BY 1, 2),
n AS (SELECT count(DISTINCT doc_id) AS n FROM b),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM b GROUP BY 1),
w AS (SELECT b.doc_id, b.term, b.cnt * log2(n.n / df.df) AS w
      FROM b JOIN df ON b.term = df.term CROSS JOIN n),
w2 AS (SELECT * FROM w WHERE w <> 0),
nm AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w2 GROUP BY 1)
SELECT w2.doc_id, w2.term, round(w2.w / nm.nrm, 6) AS w FROM w2 JOIN nm ON w2.doc_id = nm.doc_id"""))
def t15(spark, sf):
    return TO.tfidf_log2(_bag(spark, sf)).withColumn("w", r6("w"))


@query("T16_idf_ranking", lambda: with_ctes(base_ctes("clean"), """
WITH df AS (SELECT doc_id, token AS term, count(DISTINCT sent_id) AS df FROM clean GROUP BY 1, 2),
n AS (SELECT doc_id, count(*) AS n FROM sents GROUP BY 1)
SELECT df.doc_id, df.term, round(ln((n.n + 1.0) / (df.df + 1.0)) + 1, 6) AS idf
FROM df JOIN n ON df.doc_id = n.doc_id"""))
def t16(spark, sf):
    sents, clean, _ = _clean(spark, sf)
    return TO.idf_smooth(clean, sents.select("doc_id", "sent_id")).withColumn("idf", r6("idf"))


# ------------------------------------------------------------ pairwise measures

# DuckDB's levenshtein counts bytes, so letters beyond ASCII become capitals, which
# no token has; SQL fails if a token holds any other.
_LETTERS = "äöüßéèêëàâáçîïíìôóòûùúñœæ"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXY"


@query("T17_edit_distance_next_word", "WITH t AS (SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, "
       f"translate(tok, '{_LETTERS}', '{_CAPITALS}') AS token FROM documents, unnest(" + ALPHA_LIST.format(c="text")
       + r""") WITH ORDINALITY AS u(tok, i)),
p AS (SELECT CASE WHEN regexp_full_match(token, '[a-zA-Y]+') THEN token ELSE error('another letter') END AS token,
             lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM t)
SELECT levenshtein(token, nxt) AS d, count(*) AS n FROM p WHERE nxt IS NOT NULL GROUP BY 1""")
def t17(spark, sf):
    t = TO.alpha_tokens(_docs(spark, sf))
    p = t.withColumn("nxt", F.lead("token").over(Window.partitionBy("doc_id").orderBy("pos"))).dropna(subset=["nxt"])
    d = TO.edit_distance(p, "token", "nxt").withColumn("d", F.col("d").cast("bigint"))
    return d.groupBy("d").agg(F.count(F.lit(1)).alias("n"))


@query("T18_token_overlap_halves", lambda: with_ctes(base_ctes("clean"), """
WITH a AS (SELECT doc_id, token FROM clean WHERE sent_id % 2 = 0),
b AS (SELECT doc_id, token FROM clean WHERE sent_id % 2 = 1),
la AS (SELECT doc_id, count(*) AS len_a, count(DISTINCT token) AS set_a FROM a GROUP BY 1),
lb AS (SELECT doc_id, count(*) AS len_b, count(DISTINCT token) AS set_b FROM b GROUP BY 1),
c AS (SELECT x.doc_id, count(*) AS common FROM (SELECT DISTINCT doc_id, token FROM a) x
      JOIN (SELECT DISTINCT doc_id, token FROM b) y ON x.doc_id = y.doc_id AND x.token = y.token
      GROUP BY 1)
SELECT la.doc_id, coalesce(c.common, 0) AS common,
       round(coalesce(c.common, 0) / (len_a + len_b - coalesce(c.common, 0)), 6) AS overlap,
       round(coalesce(c.common, 0) / (set_a + set_b - coalesce(c.common, 0)), 6) AS jaccard
FROM la JOIN lb ON la.doc_id = lb.doc_id LEFT JOIN c ON la.doc_id = c.doc_id"""))
def t18(spark, sf):
    _, clean, _ = _clean(spark, sf)
    a = clean.filter(F.col("sent_id") % 2 == 0)
    b = clean.filter(F.col("sent_id") % 2 == 1)
    o = TO.token_overlap(a, b)
    return o.select("doc_id", "common", r6("overlap").alias("overlap"),
                    r6("jaccard").alias("jaccard"))


@query("T19_keyword_dispersion", lambda: with_ctes(base_ctes("clean"), """
WITH b AS (SELECT doc_id, token AS term, count(*) AS cnt FROM clean GROUP BY 1, 2),
m AS (SELECT doc_id, max(cnt) AS mx FROM b GROUP BY 1),
w AS (SELECT b.doc_id, b.term, 0.5 + 0.5 * (b.cnt / m.mx) AS w
      FROM b JOIN m ON b.doc_id = m.doc_id),
k AS (SELECT doc_id, term,
             row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term) - 1 AS kw_index
      FROM w WHERE w < 0.9 AND w > 0.1),
t AS (SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, tok AS token FROM documents,
      unnest(""" + ALPHA_LIST.format(c="text") + """) WITH ORDINALITY AS u(tok, i))
SELECT t.doc_id, t.pos, CAST(k.kw_index AS INTEGER) AS kw_index
FROM t JOIN k ON t.doc_id = k.doc_id AND t.token = k.term WHERE k.kw_index < 15"""))
def t19(spark, sf):
    docs = _docs(spark, sf)
    w = TO.max_tf(TO.clean_tokens(docs), a=0.5)
    win = Window.partitionBy("doc_id").orderBy(F.desc("w"), F.asc("term"))
    kw = (w.withColumn("kw_index", F.row_number().over(win) - 1).filter("kw_index < 15")
          .select("doc_id", F.col("term").alias("word"), "kw_index"))
    return TO.dispersion(TO.alpha_tokens(docs), kw)


@query("T20_main_text")
def t20(spark, sf):
    return TO.main_text(T.table(spark, sf, "pages"))


# ------------------------------------------------------------ summaries

def _s7_sql():
    wptoks = ("SELECT doc_id, sent_id, CAST(j - 1 AS BIGINT) AS pos, tok AS token FROM sents, "
              "unnest(" + WORD_PUNCT_LIST.format(c="sentence") + ") WITH ORDINALITY AS t(tok, j)")
    punct = ",".join("('" + c.replace("'", "''") + "')" for c in SM.PUNCTUATION)
    ctes = base_ctes("sents") + [
        ("stoks", wptoks), ("langs", LANGS),
        ("punct", f"SELECT * FROM (VALUES {punct}) p(token)"),
        ("wclean", """SELECT t.doc_id, t.token FROM stoks t JOIN langs l ON t.doc_id = l.doc_id
                      WHERE NOT EXISTS (SELECT 1 FROM sw WHERE sw.lang = l.lang AND sw.word = t.token)
                        AND NOT EXISTS (SELECT 1 FROM punct p WHERE p.token = t.token)"""),
        ("freq", """WITH b AS (SELECT doc_id, token AS term, count(*) AS cnt FROM wclean GROUP BY 1, 2),
                    m AS (SELECT doc_id, max(cnt) AS mx FROM b GROUP BY 1)
                    SELECT * FROM (SELECT b.doc_id, b.term, b.cnt / m.mx AS w FROM b
                                   JOIN m ON b.doc_id = m.doc_id) x WHERE w < 0.9 AND w > 0.1"""),
        ("scores", """SELECT t.doc_id, t.sent_id, sum(f.w) AS score FROM stoks t
                      JOIN freq f ON t.doc_id = f.doc_id AND t.token = f.term GROUP BY 1, 2"""),
    ]
    return with_ctes(ctes, top_summary_body(3))


def _every_document(sql):
    """The oracle of a summarizer: one row per document, empty where nothing scores."""
    return lambda: (f"SELECT d.doc_id, coalesce(s.summary, '') AS summary FROM documents d "
                    f"LEFT JOIN ({sql()}) s ON d.doc_id = s.doc_id")


@query("S7_frequency_summary", _every_document(_s7_sql))
def s7(spark, sf):
    return SM.summarize_freq(_docs(spark, sf), n=3)


@query("S8_textrank_summary", _every_document(lambda: with_ctes(textrank_ctes(100), top_summary_body(3))))
def s8(spark, sf):
    return SM.summarize_textrank(_docs(spark, sf), n=3)


LUHN_SCORES = """
WITH tf AS (SELECT doc_id, token, count(*) AS cnt FROM clean GROUP BY 1, 2),
nt AS (SELECT doc_id, count(*) AS nt FROM tf GROUP BY 1),
sig AS (SELECT doc_id, token FROM (
          SELECT tf.doc_id, tf.token, nt.nt,
                 row_number() OVER (PARTITION BY tf.doc_id ORDER BY cnt DESC, token) AS r
          FROM tf JOIN nt ON tf.doc_id = nt.doc_id) x
        WHERE r <= greatest(1, ceil(nt * 0.1))),
h AS (SELECT c.doc_id, c.sent_id, c.pos FROM clean c
      WHERE EXISTS (SELECT 1 FROM sig WHERE sig.doc_id = c.doc_id AND sig.token = c.token)),
g AS (SELECT *, CASE WHEN pos - lag(pos) OVER w IS NULL OR pos - lag(pos) OVER w > 4
                     THEN 1 ELSE 0 END AS nw
      FROM h WINDOW w AS (PARTITION BY doc_id, sent_id ORDER BY pos)),
k AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id, sent_id ORDER BY pos
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS chunk FROM g),
ch AS (SELECT doc_id, sent_id, chunk, count(*) AS h, max(pos) - min(pos) + 1 AS span
       FROM k GROUP BY 1, 2, 3)
SELECT doc_id, sent_id, max(CAST(h * h AS DOUBLE) / span) AS score FROM ch GROUP BY 1, 2"""


@query("S14_luhn_summary", _every_document(lambda: with_ctes(
    base_ctes("clean") + [("scores", LUHN_SCORES)], top_summary_body(3))))
def s14(spark, sf):
    return SM.summarize_luhn(_docs(spark, sf), n=3)


@query("S20_summary_evaluation")
def s20(spark, sf):
    docs = _docs(spark, sf)
    ideal = SM.summarize_textrank(docs, n=3)
    models = (SM.summarize_freq(docs, n=3).withColumn("model", F.lit("frequency"))
              .unionByName(SM.summarize_luhn(docs, n=3).withColumn("model", F.lit("luhn"))))
    out = SM.evaluate(models, ideal)
    return out.select("model", r6("cosine").alias("cosine"),
                      r6("unit_overlap").alias("unit_overlap"), "n_docs")


# ------------------------------------------------------------ topics, similarity

def _doc_tfidf_log2(spark, sf):
    bow = _bag(spark, sf)
    model = TO.idf_log2(bow)
    return bow, model, TO.tfidf_log2(bow, model=model)


DOC_LOG2 = """
WITH b AS (SELECT doc_id, token AS term, count(*) AS cnt FROM clean GROUP BY 1, 2),
n AS (SELECT count(DISTINCT doc_id) AS n FROM b),
idf AS (SELECT term, log2(n.n / count(DISTINCT doc_id)) AS idf FROM b, n GROUP BY term, n.n),
w AS (SELECT b.doc_id, b.term, b.cnt * idf.idf AS w FROM b JOIN idf ON b.term = idf.term
      WHERE b.cnt * idf.idf <> 0),
nm AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY 1)
SELECT w.doc_id, w.term, w.w / nm.nrm AS w FROM w JOIN nm ON w.doc_id = nm.doc_id"""


def _s3_sql():
    return with_ctes(base_ctes("clean") + [
        ("dlog", DOC_LOG2),
        ("tid", "SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM "
                "(SELECT DISTINCT token AS term FROM clean) t")], """
SELECT d.doc_id, CAST(k.dim AS INTEGER) AS dim,
       round(sum(CASE WHEN (t.term_id * 7919 + k.dim * 104729 + 0) % 2 = 0 THEN 1.0 ELSE -1.0 END
                 * d.w) / sqrt(8.0), 6) AS value
FROM dlog d JOIN tid t ON d.term = t.term CROSS JOIN (SELECT i AS dim FROM range(0, 8) r(i)) k
GROUP BY 1, 2""")


@query("S3_random_projection", _s3_sql)
def s3(spark, sf):
    from tessera.operators import topics as TP
    _, clean, _ = _clean(spark, sf)
    _, _, w = _doc_tfidf_log2(spark, sf)
    ids = TO.dictionary(clean, min_df=1).select("term", "term_id")
    return TP.random_projection(w, ids, 8, 0).withColumn("value", r6("value"))


@query("S6_cosine_distance_next_doc", lambda: with_ctes(base_ctes("clean") + [("dlog", DOC_LOG2)], """
WITH p AS (SELECT doc_id AS a, lead(doc_id) OVER (ORDER BY doc_id) AS b FROM documents),
p2 AS (SELECT * FROM p WHERE b IS NOT NULL),
dot AS (SELECT p2.a, p2.b, sum(x.w * y.w) AS dot FROM p2 JOIN dlog x ON x.doc_id = p2.a
        JOIN dlog y ON y.doc_id = p2.b AND y.term = x.term GROUP BY 1, 2)
SELECT p2.a, p2.b, round(1 - coalesce(dot.dot, 0.0), 6) AS d
FROM p2 LEFT JOIN dot ON p2.a = dot.a AND p2.b = dot.b"""))
def s6(spark, sf):
    from tessera.operators import topics as TP
    _, _, w = _doc_tfidf_log2(spark, sf)
    ids = T.table(spark, sf, "documents").select("doc_id")
    # consecutive document ids by position: range partitioning, not one task
    at = R.dense_index(ids, "doc_id", "pos")
    pairs = (at.select(F.col("doc_id").alias("a"), (F.col("pos") + 1).alias("pos"))
             .join(at.select(F.col("doc_id").alias("b"), "pos"), "pos").select("a", "b"))
    return TP.cosine_distance(w, pairs).withColumn("d", r6("d"))


@query("S4_similar_documents", lambda: with_ctes(base_ctes("clean") + [("dlog", DOC_LOG2)], """
SELECT x.doc_id AS a, y.doc_id AS b, round(sum(x.w * y.w), 6) AS cos
FROM dlog x JOIN dlog y ON x.term = y.term AND x.doc_id < y.doc_id
GROUP BY 1, 2 HAVING round(sum(x.w * y.w), 9) >= 0.5"""))
def s4(spark, sf):
    from tessera.operators import topics as TP
    _, _, w = _doc_tfidf_log2(spark, sf)
    return TP.similarity_pairs(w, 0.5).withColumn("cos", r6("cos"))


def _s5_sql():
    q = base_ctes("clean", docs="SELECT item_id AS doc_id, text FROM benchmark", prefix="q_")
    return with_ctes(base_ctes("clean") + q + [("dlog", DOC_LOG2)], """
WITH b AS (SELECT doc_id, token AS term, count(*) AS cnt FROM clean GROUP BY 1, 2),
n AS (SELECT count(DISTINCT doc_id) AS n FROM b),
idf AS (SELECT term, log2(n.n / count(DISTINCT doc_id)) AS idf FROM b, n GROUP BY term, n.n),
qb AS (SELECT doc_id AS qid, token AS term, count(*) AS cnt FROM q_clean GROUP BY 1, 2),
qw AS (SELECT qb.qid, qb.term, qb.cnt * idf.idf AS w FROM qb JOIN idf ON qb.term = idf.term
       WHERE qb.cnt * idf.idf <> 0),
qn AS (SELECT qid, sqrt(sum(w * w)) AS nrm FROM qw GROUP BY 1),
qv AS (SELECT qw.qid, qw.term, qw.w / qn.nrm AS w FROM qw JOIN qn ON qw.qid = qn.qid),
s AS (SELECT qv.qid, d.doc_id, sum(d.w * qv.w) AS cos FROM dlog d JOIN qv ON d.term = qv.term
      GROUP BY 1, 2)
SELECT qid, doc_id, round(cos, 6) AS cos FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(cos, 9) DESC, doc_id) AS r FROM s) x
WHERE r <= 5""")


@query("S5_similarity_query_top5", _s5_sql)
def s5(spark, sf):
    from tessera.operators import topics as TP
    from tessera.operators import relational as RL
    _, model, w = _doc_tfidf_log2(spark, sf)
    bench = T.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    _, qclean, _ = TO.clean_sentence_tokens(bench)
    qv = TO.tfidf_log2(TO.bag_of_words(qclean), model=model).withColumnRenamed("doc_id", "qid")
    sims = TP.similarity_query(w, qv).withColumn("cos9", F.round("cos", 9))
    top = RL.top_n_in_order(sims, ["qid"], "cos9", "doc_id", 5)
    return top.select("qid", "doc_id", r6("cos").alias("cos"))


@query("S1_lda_topics")
def s1(spark, sf):
    from tessera.operators import topics as TP
    doc_topics, _ = TP.lda(_bag(spark, sf), k=5, max_iter=10, docs=_docs(spark, sf).select("doc_id"))
    return doc_topics


# ------------------------------------------------------------ more summarizers

from tessera.plans.text_sql import sumbasic_ctes, top_ratio_body  # noqa: E402


@query("S12_ratio_summary", _every_document(lambda: with_ctes(textrank_ctes(100), top_ratio_body(0.2))))
def s12(spark, sf):
    return SM.summarize_ratio(_docs(spark, sf), ratio=0.2)


@query("S16_lexrank_summary",
       _every_document(lambda: with_ctes(textrank_ctes(100, weight="similarity"), top_summary_body(3))))
def s16(spark, sf):
    return SM.summarize_lexrank(_docs(spark, sf), n=3)


@query("S17_sumbasic_summary", _every_document(lambda: with_ctes(sumbasic_ctes(3), """
SELECT s.doc_id, string_agg(s.sentence, ' ' ORDER BY s.sent_id) AS summary
FROM pick3 p JOIN sents s ON s.doc_id = p.doc_id AND s.sent_id = p.sent_id GROUP BY 1""")))
def s17(spark, sf):
    return SM.summarize_sumbasic(_docs(spark, sf), n=3)


FEATURES = """
WITH fl AS (SELECT doc_id, min(sent_id) AS first_id, max(sent_id) AS last_id FROM sents GROUP BY 1),
nt AS (SELECT doc_id, sent_id, count(*) AS ntok FROM clean GROUP BY 1, 2),
title AS (SELECT DISTINCT c.doc_id, c.token FROM clean c JOIN fl ON c.doc_id = fl.doc_id
          WHERE c.sent_id = fl.first_id),
ts AS (SELECT doc_id, count(*) AS tsz FROM title GROUP BY 1),
tw AS (SELECT d.doc_id, d.sent_id, count(*) AS th
       FROM (SELECT DISTINCT doc_id, sent_id, token FROM clean) d
       JOIN title t ON d.doc_id = t.doc_id AND d.token = t.token GROUP BY 1, 2),
tf AS (SELECT doc_id, token, count(*) AS c FROM clean GROUP BY 1, 2),
kw AS (SELECT doc_id, token FROM (SELECT *, row_number() OVER (PARTITION BY doc_id
                                  ORDER BY c DESC, token) AS r FROM tf) x WHERE r <= 10),
kh AS (SELECT c.doc_id, c.sent_id, count(*) AS kh FROM clean c
       JOIN kw ON c.doc_id = kw.doc_id AND c.token = kw.token GROUP BY 1, 2),
mx AS (SELECT doc_id, max(ntok) AS mx FROM nt GROUP BY 1)
SELECT u.doc_id, u.sent_id,
       (coalesce(coalesce(tw.th, 0) / ts.tsz, 0.0) + coalesce(coalesce(nt.ntok, 0) / mx.mx, 0.0)
        + (1 - u.sent_id / (fl.last_id + 1))
        + coalesce(coalesce(kh.kh, 0) / nullif(coalesce(nt.ntok, 0), 0), 0.0)) / 4 AS score
FROM sents u JOIN fl ON u.doc_id = fl.doc_id
LEFT JOIN nt ON u.doc_id = nt.doc_id AND u.sent_id = nt.sent_id
LEFT JOIN tw ON u.doc_id = tw.doc_id AND u.sent_id = tw.sent_id
LEFT JOIN kh ON u.doc_id = kh.doc_id AND u.sent_id = kh.sent_id
LEFT JOIN ts ON u.doc_id = ts.doc_id LEFT JOIN mx ON u.doc_id = mx.doc_id"""


@query("S13_feature_summary", _every_document(lambda: with_ctes(
    base_ctes("clean") + [("scores", FEATURES)], top_summary_body(5))))
def s13(spark, sf):
    return SM.summarize_features(_docs(spark, sf), n=5)


@query("S10_lsa_summary")
def s10(spark, sf):
    return SM.summarize_lsa(_docs(spark, sf), n=3)


@query("S11_lsa_rank2_summary")
def s11(spark, sf):
    return SM.summarize_lsa(_docs(spark, sf), n=3, rank=2)


@query("S18_kl_summary")
def s18(spark, sf):
    return SM.summarize_kl(_docs(spark, sf), n=3)


@query("S2_lsi_singular_values")
def s2(spark, sf):
    from tessera.operators import topics as TP
    kept = cut_lineage(TO.filter_frequency(_bag(spark, sf), 2, 10 ** 9, token="term"))
    sv, _, _ = TP.lsi(TO.tfidf_log2(kept), k=10)
    return sv
