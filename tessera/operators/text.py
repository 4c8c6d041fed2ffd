"""Text operators on long tables (T1--T22).

Documents are rows ``(doc_id, text)``; everything downstream is a long table
such as ``(doc_id, sent_id, pos, token)`` or ``(doc_id, term, w)``.  Per-
document statistics are grouped aggregates (partial aggregation first), so a
single huge document is spread over many tasks until its final, already
reduced, aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as TX
from tessera.session import cut_lineage


# ------------------------------------------------------------ tokenizing

def _explode(df: DataFrame, id_cols, arr, pos="pos", name="token") -> DataFrame:
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    e = df.select(*id_cols, F.posexplode(arr).alias(pos, name))
    return e.withColumn(pos, F.col(pos).cast("bigint"))


def ws_tokens(df: DataFrame, id_col="doc_id", text="text") -> DataFrame:
    """Lower-case, split on whitespace."""
    return _explode(df, id_col, TX.ws_tokens(F.col(text)))


def alpha_tokens(df: DataFrame, id_col="doc_id", text="text",
                 min_len=TX.MIN_LEN, max_len=TX.MAX_LEN) -> DataFrame:
    """Alphabetic tokens, no digits, length bounds, not starting with '_'."""
    return _explode(df, id_col, TX.alpha_tokens(F.col(text), min_len, max_len))


def word_tokens(df: DataFrame, id_col="doc_id", text="text") -> DataFrame:
    """``\\w+`` tokens (lower-cased)."""
    return _explode(df, id_col, TX.word_tokens(F.col(text)))


def word_punct_tokens(df: DataFrame, id_col="doc_id", text="text") -> DataFrame:
    """T4: words with each punctuation character as its own token."""
    return _explode(df, id_col, TX.word_punct_tokens(F.col(text)))


def sentences(df: DataFrame, id_col="doc_id", text="text") -> DataFrame:
    """T5: ``(id, sent_id, sentence)``; split after . ! ? followed by space.

    ``sent_id`` is the position in the split (empty pieces are dropped but
    keep their numbers, so ids are stable)."""
    s = df.select(id_col, F.posexplode(TX.split_sentences(F.col(text))).alias("sent_id", "s"))
    s = s.select(id_col, F.col("sent_id").cast("bigint").alias("sent_id"),
                 TX.strip_ws(F.col("s")).alias("sentence"))
    return s.filter(F.col("sentence") != "")


def sentence_tokens(sents: DataFrame, id_col="doc_id") -> DataFrame:
    """Alphabetic tokens of every sentence: ``(id, sent_id, pos, token)``."""
    return sents.select(id_col, "sent_id",
                        F.posexplode(TX.alpha_tokens(F.col("sentence"))).alias("pos", "token"))


# ------------------------------------------------------------ stop words, language

def detect_language(tokens: DataFrame, id_col="doc_id", token="token",
                    docs: DataFrame | None = None) -> DataFrame:
    """Language whose stop-word list shares the most *distinct* tokens.

    Ties go to the alphabetically first language; a document with no hit
    gets the first language of the list (pass ``docs`` to keep such rows).
    Tokens are first cut to stop-word candidates by a map-side semi join
    with the (fixed, few-thousand-word) vocabulary, so only those are
    de-duplicated and shuffled.
    """
    spark = tokens.sparkSession
    sw = TX.stop_words_df(spark)
    vocab = F.broadcast(sw.select(F.col("word").alias(token)))
    cand = tokens.join(vocab, token, "left_semi")
    distinct = cand.select(id_col, F.col(token).alias("word")).distinct()
    hits = (distinct.join(F.broadcast(sw), "word").groupBy(id_col, "lang")
            .agg(F.count(F.lit(1)).alias("hits")))
    w = Window.partitionBy(id_col).orderBy(F.desc("hits"), F.asc("lang"))
    best = (hits.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn"))
    if docs is not None:
        best = (docs.select(id_col).distinct().join(best, id_col, "left")
                .select(id_col, F.coalesce("lang", F.lit(TX.LANGUAGES[0])).alias("lang"),
                        F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits")))
    return best


def remove_stop_words(tokens: DataFrame, langs: DataFrame, id_col="doc_id",
                      token="token") -> DataFrame:
    """Drop tokens that are stop words of the document's language.

    Tokens that are no stop word in any language are kept map-side; only
    the candidates travel to the join with the per-document language."""
    sw = TX.stop_words_df(tokens.sparkSession)
    vocab = F.broadcast(sw.select(F.col("word").alias(token)))
    rest = tokens.join(vocab, token, "left_anti")
    cand = tokens.join(vocab, token, "left_semi")
    sw2 = F.broadcast(sw.select("lang", F.col("word").alias(token)))
    kept = (cand.join(langs.select(id_col, "lang"), id_col)
            .join(sw2, ["lang", token], "left_anti").drop("lang"))
    return rest.unionByName(kept.select(*rest.columns))


def document_languages(docs: DataFrame, id_col="doc_id", text="text", tokenizer=TX.alpha_tokens) -> DataFrame:
    """``detect_language`` of whole texts, ``(id, lang)`` for every document: the
    different tokens of a text leave its row only where they are stop words, and
    one row a document and language is shuffled."""
    words = docs.select(id_col, F.explode(F.array_distinct(tokenizer(F.col(text)))).alias("token"))
    return detect_language(words, id_col, docs=docs).select(id_col, "lang")


def clean_tokens(docs: DataFrame, id_col="doc_id", text="text", tokenizer=TX.alpha_tokens) -> DataFrame:
    """``(id, sent_id, pos, token)`` without the detected language's stop words.

    The language joins the whole text, so the tokens made from it already lie
    together by document: grouping them by document and more needs no further
    shuffle, and stop words go by a broadcast of the (fixed) word lists."""
    sw = TX.stop_words_df(docs.sparkSession).withColumnRenamed("word", "token")
    known = docs.select(id_col, text).join(document_languages(docs, id_col, text, tokenizer), id_col)
    parts = known.select(id_col, "lang", F.posexplode(TX.split_sentences(F.col(text))).alias("sent_id", "s"))
    toks = parts.select(id_col, "lang", F.col("sent_id").cast("bigint").alias("sent_id"),
                        F.posexplode(tokenizer(F.col("s"))).alias("pos", "token"))
    return toks.join(F.broadcast(sw), ["lang", "token"], "left_anti").select(id_col, "sent_id", "pos", "token")


def clean_sentence_tokens(docs: DataFrame, id_col="doc_id", text="text"):
    """Sentences, their alphabetic tokens without the detected language's
    stop words, and the language per document.  Shared by the summarizers."""
    # the tokens are written once: every later step reads these instead of
    # re-running the regular-expression tokenizer per branch
    clean = cut_lineage(clean_tokens(docs, id_col, text))
    return sentences(docs, id_col, text), clean, document_languages(docs, id_col, text)


# ------------------------------------------------------------ frequencies

def token_frequency(tokens: DataFrame, id_col="doc_id", token="token") -> DataFrame:
    """Document frequency and corpus frequency per token."""
    return tokens.groupBy(F.col(token).alias("term")).agg(
        F.countDistinct(id_col).alias("df"), F.count(F.lit(1)).alias("cf"))


def filter_frequency(tokens: DataFrame, min_df: int, max_df: int, id_col="doc_id",
                     token="token", inclusive: bool = True) -> DataFrame:
    """Keep tokens whose document frequency is within the bounds
    (inclusive, as in the vectorizer; ``inclusive=False`` drops df == bound)."""
    freq = token_frequency(tokens, id_col, token)
    cond = (F.col("df").between(min_df, max_df) if inclusive
            else (F.col("df") > min_df) & (F.col("df") < max_df))
    keep = freq.filter(cond).select(F.col("term").alias(token))
    return tokens.join(keep, token, "left_semi")


def dictionary(tokens: DataFrame, min_df: int = 2, id_col="doc_id",
               token="token") -> DataFrame:
    """Terms seen in at least ``min_df`` documents with compact ids
    (0.. in term order)."""
    from tessera.operators.relational import dense_index
    freq = token_frequency(tokens, id_col, token).filter(F.col("df") >= min_df)
    return dense_index(freq, "term", "term_id").select("term_id", "term", "df")


def bag_of_words(tokens: DataFrame, id_col="doc_id", token="token") -> DataFrame:
    """``(id, term, cnt)``."""
    return tokens.groupBy(id_col, F.col(token).alias("term")).agg(
        F.count(F.lit(1)).alias("cnt"))


def max_tf(tokens: DataFrame, a: float = 0.5, lo: float = 0.1, hi: float = 0.9,
           id_col="doc_id", token="token") -> DataFrame:
    """``a + (1-a) * tf / max tf`` per document; weights >= hi or
    <= lo are dropped.  The max is a window over the bag of words."""
    bow = bag_of_words(tokens, id_col, token)
    mx = F.max("cnt").over(Window.partitionBy(id_col))
    w = F.lit(a) + F.lit(1.0 - a) * (F.col("cnt") / mx)
    out = bow.select(id_col, "term", w.alias("w"))
    return out.filter((F.col("w") < hi) & (F.col("w") > lo))


def tfidf_smooth(tokens: DataFrame, units: DataFrame, unit=("doc_id", "sent_id"),
                 corpus=("doc_id",), token="token") -> DataFrame:
    """Smooth TF-IDF with L2-normalised rows.

    ``units`` lists every unit (row of the matrix, e.g. sentence), including
    those without tokens, because they count in n.  The corpus is the group
    in which document frequencies are taken (per document for sentence
    matrices, ``()`` for a document matrix over the whole table).
    ``w = tf * (ln((1 + n) / (1 + df)) + 1)``, then ``w / ||w||``.
    """
    unit, corpus = list(unit), list(corpus)
    rest = [u for u in unit if u not in corpus]
    # counts per unit, the df window and the norm of a document's sentences all
    # reuse one shuffle by corpus; a single corpus is dealt by term
    t = tokens.select(*unit, F.col(token).alias("term")).repartition(*(corpus or ["term"]))
    tf = t.groupBy(*corpus, "term", *rest).agg(F.count(F.lit(1)).alias("tf"))
    tf = tf.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy(*corpus, "term")))
    n = units.groupBy(*corpus).agg(F.count(F.lit(1)).alias("n")) if corpus else \
        units.agg(F.count(F.lit(1)).alias("n"))
    j = tf.join(n, corpus) if corpus else tf.crossJoin(F.broadcast(n))
    w = j.select(*unit, "term", (F.col("tf") * (F.ln((F.col("n") + 1) / (F.col("df") + 1)) + 1))
                 .alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*unit)))
    return w.select(*unit, "term", (F.col("w") / norm).alias("w"))


def idf_smooth(tokens: DataFrame, units: DataFrame, unit=("doc_id", "sent_id"),
               corpus=("doc_id",), token="token") -> DataFrame:
    """``(corpus..., term, idf)`` of the smooth formula."""
    unit, corpus = list(unit), list(corpus)
    df = (tokens.select(*unit, F.col(token).alias("term")).distinct()
          .groupBy(*corpus, "term").agg(F.count(F.lit(1)).alias("df")))
    n = units.groupBy(*corpus).agg(F.count(F.lit(1)).alias("n")) if corpus else \
        units.agg(F.count(F.lit(1)).alias("n"))
    j = df.join(n, corpus) if corpus else df.crossJoin(F.broadcast(n))
    return j.select(*corpus, "term", (F.ln((F.col("n") + 1) / (F.col("df") + 1)) + 1)
                    .alias("idf"))


def tfidf_log2(bow: DataFrame, id_col="doc_id", model: DataFrame | None = None,
               n_docs: DataFrame | None = None) -> DataFrame:
    """``tf * log2(N / df)`` with L2 rows, over a bag of words
    ``(id, term, cnt)``.  ``model`` = ``(term, idf)`` from a training corpus
    applies the weights to unseen documents (unknown terms are dropped)."""
    if model is None:
        model = idf_log2(bow, id_col)
    w = bow.join(model, "term").select(id_col, "term", (F.col("cnt") * F.col("idf")).alias("w"))
    # a document's terms meet once, where they are both summed and divided
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.filter(F.col("w") != 0).select(id_col, "term", (F.col("w") / norm).alias("w"))


def idf_log2(bow: DataFrame, id_col="doc_id") -> DataFrame:
    """``log2(N / df)``; ``bow`` has one row per (document, term)."""
    n = bow.agg(F.countDistinct(id_col).alias("n"))
    df = bow.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.crossJoin(F.broadcast(n)).select(
        "term", F.log2(F.col("n") / F.col("df")).alias("idf"))


# ------------------------------------------------------------ pairwise text measures

def edit_distance(df: DataFrame, a: str, b: str, name: str = "d") -> DataFrame:
    """Levenshtein distance (built-in, codegen)."""
    return df.withColumn(name, F.levenshtein(F.col(a), F.col(b)))


def token_overlap(tokens_a: DataFrame, tokens_b: DataFrame, id_col="doc_id",
                  token="token") -> DataFrame:
    """Per id, ``common / (len A + len B - common)`` where ``common`` is
    the number of distinct shared tokens and lengths are list lengths
    (``overlap``), plus the set Jaccard index (``jaccard``)."""
    la = tokens_a.groupBy(id_col).agg(F.count(F.lit(1)).alias("len_a"),
                                      F.countDistinct(token).alias("set_a"))
    lb = tokens_b.groupBy(id_col).agg(F.count(F.lit(1)).alias("len_b"),
                                      F.countDistinct(token).alias("set_b"))
    common = (tokens_a.select(id_col, token).distinct()
              .join(tokens_b.select(id_col, token).distinct(), [id_col, token])
              .groupBy(id_col).agg(F.count(F.lit(1)).alias("common")))
    j = la.join(lb, id_col).join(common, id_col, "left").fillna(0, ["common"])
    return j.select(
        id_col, "common",
        (F.col("common") / (F.col("len_a") + F.col("len_b") - F.col("common"))).alias("overlap"),
        (F.col("common") / (F.col("set_a") + F.col("set_b") - F.col("common"))).alias("jaccard"))


def dispersion(tokens: DataFrame, keywords: DataFrame, id_col="doc_id",
               token="token", pos="pos") -> DataFrame:
    """Every occurrence of a keyword: ``(id, pos, kw_index)``.
    ``keywords`` = ``(id, word, kw_index)``."""
    kw = keywords.select(id_col, F.col("word").alias(token), "kw_index")
    return tokens.join(kw, [id_col, token]).select(id_col, pos, "kw_index")


def keyword_candidates(tokens: DataFrame, tags: DataFrame | None = None,
                       keep=("NN", "JJ"), token="token") -> DataFrame:
    """Candidate keywords.  Without a tagger the candidates are the
    stop-word-free tokens; a ``(token, tag)`` table narrows them to ``keep``."""
    if tags is None:
        return tokens
    ok = tags.filter(F.col("tag").isin(list(keep))).select(token).distinct()
    return tokens.join(ok, token, "left_semi")


def join_sentences(sel: DataFrame, id_col="doc_id", pos="sent_id", text="sentence",
                   sep: str = " ", name: str = "summary") -> DataFrame:
    """Concatenate chosen sentences in source order.  Callers select a
    bounded number of sentences per document first (top-n)."""
    g = sel.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(pos, text))).alias("_s"))
    return g.select(id_col, F.array_join(F.transform("_s", lambda s: s[text]), sep).alias(name))


# ------------------------------------------------------------ HTML main text

def main_text(pages: DataFrame, id_col="page_id", html="html") -> DataFrame:
    """Text of the element with the most direct ``<p>`` children, after
    dropping ``script``/``style``.  Runs the standard-library HTML parser in
    ``mapInPandas`` (Arrow batches, one page at a time)."""

    def parse(batches):
        import pandas as pd
        from tessera.functions.html import main_text_of
        for pdf in batches:
            yield pd.DataFrame({id_col: pdf[id_col],
                                "text": [main_text_of(h) for h in pdf[html]]})

    schema = f"{id_col} long, text string"
    return pages.select(id_col, html).mapInPandas(parse, schema)
