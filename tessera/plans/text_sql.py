"""DuckDB SQL building blocks for the text oracles (same rules as
tessera.functions.text / tessera.operators.text)."""

from __future__ import annotations

import re as _re

from tessera.functions.text import LANGUAGES, stop_words_sql

ALPHA_LIST = (r"list_filter(regexp_extract_all(lower({c}), '([\p{{L}}_]+)', 1), "
              r"lambda x: length(x) BETWEEN 2 AND 20 AND NOT starts_with(x, '_'))")
WORD_PUNCT_LIST = r"regexp_extract_all(lower({c}), '([\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s])', 1)"

SENTS = r"""
SELECT doc_id, CAST(i - 1 AS BIGINT) AS sent_id,
       regexp_replace(s, '^\s+|\s+$', '', 'g') AS sentence
FROM docs,
     unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)))
       WITH ORDINALITY AS t(s, i)
WHERE regexp_replace(s, '^\s+|\s+$', '', 'g') <> ''"""

STOKENS = ("SELECT doc_id, sent_id, CAST(j - 1 AS BIGINT) AS pos, tok AS token FROM sents, "
           "unnest(" + ALPHA_LIST.format(c="sentence") + ") WITH ORDINALITY AS t(tok, j)")

LANGS = f"""
SELECT d.doc_id, coalesce(b.lang, '{LANGUAGES[0]}') AS lang, coalesce(b.hits, 0) AS hits
FROM (SELECT DISTINCT doc_id FROM docs) d LEFT JOIN (
  SELECT doc_id, lang, hits FROM (
    SELECT doc_id, lang, hits,
           row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, lang) AS rn
    FROM (SELECT t.doc_id, sw.lang, count(*) AS hits
          FROM (SELECT DISTINCT doc_id, token FROM stoks) t JOIN sw ON sw.word = t.token
          GROUP BY 1, 2) h) r WHERE rn = 1) b ON d.doc_id = b.doc_id"""

CLEAN = """
SELECT t.doc_id, t.sent_id, t.pos, t.token FROM stoks t JOIN langs l ON t.doc_id = l.doc_id
WHERE NOT EXISTS (SELECT 1 FROM sw WHERE sw.lang = l.lang AND sw.word = t.token)"""

TFIDF = """
WITH tf AS (SELECT doc_id, sent_id, token AS term, count(*) AS tf FROM clean GROUP BY 1, 2, 3),
n AS (SELECT doc_id, count(*) AS n FROM sents GROUP BY 1),
df AS (SELECT doc_id, term, count(*) AS df FROM tf GROUP BY 1, 2),
w AS (SELECT tf.doc_id, tf.sent_id, tf.term,
             tf.tf * (ln((n.n + 1.0) / (df.df + 1.0)) + 1) AS w
      FROM tf JOIN df ON tf.doc_id = df.doc_id AND tf.term = df.term
              JOIN n ON tf.doc_id = n.doc_id),
nm AS (SELECT doc_id, sent_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY 1, 2)
SELECT w.doc_id, w.sent_id, w.term, w.w / nm.nrm AS w
FROM w JOIN nm ON w.doc_id = nm.doc_id AND w.sent_id = nm.sent_id"""


DOCS = "SELECT doc_id, text FROM documents"


def base_ctes(upto: str = "clean", docs: str = DOCS, prefix: str = "") -> list[tuple[str, str]]:
    """CTE chain sw -> docs -> sents -> stoks -> langs -> clean -> tfidf.
    ``prefix`` renames the chain (except sw) so two corpora can coexist."""
    chain = base_ctes_raw(upto, docs)
    if not prefix:
        return chain
    names = [n for n, _ in chain if n != "sw"]
    out = []
    for n, sql in chain:
        if n == "sw":
            continue
        for m in names:
            sql = _re.sub(rf"\b{m}\b", prefix + m, sql)
        out.append((prefix + n, sql))
    return out


def base_ctes_raw(upto: str = "clean", docs: str = DOCS) -> list[tuple[str, str]]:
    order = [("sw", stop_words_sql()), ("docs", docs), ("sents", SENTS), ("stoks", STOKENS),
             ("langs", LANGS), ("clean", CLEAN), ("tfidf", TFIDF)]
    out = []
    for name, sql in order:
        out.append((name, sql))
        if name == upto:
            break
    return out


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    head = "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({s})" for n, s in ctes)
    b = body.lstrip()
    if b[:5].upper() == "WITH ":
        return head + ",\n" + b[5:]
    return head + "\n" + body


def textrank_ctes(iters: int = 100, alpha: float = 0.85, tol: float = 1e-6,
                  weight: str = "distance") -> list[tuple[str, str]]:
    """Power iteration of the factorised complete-distance-graph PageRank."""
    ctes = base_ctes("tfidf")
    ctes += [
        ("tr_s", "SELECT doc_id, term, sum(w) AS s FROM tfidf GROUP BY 1, 2"),
        ("tr_dot", "SELECT a.doc_id, a.sent_id, sum(a.w * s.s) AS dot FROM tfidf a "
                   "JOIN tr_s s ON a.doc_id = s.doc_id AND a.term = s.term GROUP BY 1, 2"),
        ("tr_nodes", f"""
SELECT u.doc_id, u.sent_id, CAST(n.n AS DOUBLE) AS n,
       CASE WHEN d.dot IS NULL THEN 0.0 ELSE 1.0 END AS has,
       {"n.n - 1 - " if weight == "distance" else ""}(coalesce(d.dot, 0.0)
         - CASE WHEN d.dot IS NULL THEN 0.0 ELSE 1.0 END) AS wout
FROM sents u JOIN (SELECT doc_id, count(*) AS n FROM sents GROUP BY 1) n ON u.doc_id = n.doc_id
LEFT JOIN tr_dot d ON u.doc_id = d.doc_id AND u.sent_id = d.sent_id"""),
        ("x0", "SELECT doc_id, sent_id, 1.0 / n AS x, false AS fz FROM tr_nodes"),
    ]
    if weight == "distance":
        inflow = "(g.ytot - y.y) - (coalesce(v.v, 0.0) - y.y * y.has)"
    else:
        inflow = "(coalesce(v.v, 0.0) - y.y * y.has)"
    for k in range(iters):
        ctes += [
            (f"y{k}", f"SELECT nd.doc_id, nd.sent_id, nd.n, nd.has, nd.wout, x.x, x.fz, "
                      f"CASE WHEN nd.wout > 1e-12 THEN x.x / nd.wout ELSE 0.0 END AS y "
                      f"FROM tr_nodes nd JOIN x{k} x ON nd.doc_id = x.doc_id "
                      f"AND nd.sent_id = x.sent_id"),
            (f"g{k}", f"SELECT doc_id, sum(y) AS ytot, "
                      f"sum(CASE WHEN wout > 1e-12 THEN 0.0 ELSE x END) AS dtot FROM y{k} GROUP BY 1"),
            (f"u{k}", f"SELECT a.doc_id, a.term, sum(a.w * y.y) AS u FROM tfidf a JOIN y{k} y "
                      f"ON a.doc_id = y.doc_id AND a.sent_id = y.sent_id GROUP BY 1, 2"),
            (f"v{k}", f"SELECT a.doc_id, a.sent_id, sum(a.w * u.u) AS v FROM tfidf a "
                      f"JOIN u{k} u ON a.doc_id = u.doc_id AND a.term = u.term GROUP BY 1, 2"),
            (f"n{k}", f"SELECT y.doc_id, y.sent_id, y.n, y.x, y.fz, "
                      f"{alpha} * ({inflow} "
                      f"+ g.dtot / y.n) + {1 - alpha} / y.n AS xn "
                      f"FROM y{k} y JOIN g{k} g ON y.doc_id = g.doc_id "
                      f"LEFT JOIN v{k} v ON y.doc_id = v.doc_id AND y.sent_id = v.sent_id"),
            (f"e{k}", f"SELECT doc_id, sum(abs(xn - x)) < max(n) * {tol} AS ok FROM n{k} GROUP BY 1"),
            (f"x{k + 1}", f"SELECT nn.doc_id, nn.sent_id, "
                          f"CASE WHEN nn.fz THEN nn.x ELSE nn.xn END AS x, nn.fz OR e.ok AS fz "
                          f"FROM n{k} nn JOIN e{k} e ON nn.doc_id = e.doc_id"),
        ]
    ctes.append(("scores", f"SELECT doc_id, sent_id, x AS score FROM x{iters}"))
    return ctes


def top_summary_body(n: int) -> str:
    return f"""
SELECT s.doc_id, string_agg(s.sentence, ' ' ORDER BY s.sent_id) AS summary
FROM (SELECT doc_id, sent_id FROM (
        SELECT doc_id, sent_id,
               row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 12) DESC, sent_id) AS rn
        FROM scores) r WHERE rn <= {n}) b
JOIN sents s ON s.doc_id = b.doc_id AND s.sent_id = b.sent_id
GROUP BY s.doc_id"""


def top_ratio_body(ratio: float) -> str:
    return f"""
SELECT s.doc_id, string_agg(s.sentence, ' ' ORDER BY s.sent_id) AS summary
FROM (SELECT doc_id, sent_id FROM (
        SELECT sc.doc_id, sc.sent_id, c.n,
               row_number() OVER (PARTITION BY sc.doc_id ORDER BY round(sc.score, 12) DESC,
                                  sc.sent_id) AS rn
        FROM scores sc JOIN (SELECT doc_id, count(*) AS n FROM sents GROUP BY 1) c
          ON sc.doc_id = c.doc_id) r WHERE rn <= ceil(n * {ratio})) b
JOIN sents s ON s.doc_id = b.doc_id AND s.sent_id = b.sent_id
GROUP BY s.doc_id"""


def sumbasic_ctes(rounds: int) -> list[tuple[str, str]]:
    ctes = base_ctes("clean") + [
        ("p0", """SELECT c.doc_id, c.token, count(*) / max(t.tot) AS p FROM clean c
                  JOIN (SELECT doc_id, count(*) AS tot FROM clean GROUP BY 1) t
                    ON c.doc_id = t.doc_id GROUP BY 1, 2"""),
        ("pick0", "SELECT doc_id, sent_id FROM clean WHERE false"),
    ]
    for r in range(rounds):
        ctes += [
            (f"sc{r}", f"""SELECT c.doc_id, c.sent_id, round(avg(p.p), 12) AS score FROM clean c
                        JOIN p{r} p ON c.doc_id = p.doc_id AND c.token = p.token
                        WHERE NOT EXISTS (SELECT 1 FROM pick{r} k WHERE k.doc_id = c.doc_id
                                          AND k.sent_id = c.sent_id)
                        GROUP BY 1, 2"""),
            (f"b{r}", f"""SELECT doc_id, sent_id FROM (SELECT *, row_number() OVER (
                          PARTITION BY doc_id ORDER BY score DESC, sent_id) AS rn FROM sc{r}) x
                       WHERE rn = 1"""),
            (f"pick{r + 1}", f"SELECT * FROM pick{r} UNION ALL SELECT * FROM b{r}"),
            (f"p{r + 1}", f"""SELECT p.doc_id, p.token,
                              CASE WHEN u.token IS NULL THEN p.p ELSE p.p * p.p END AS p
                           FROM p{r} p LEFT JOIN (SELECT DISTINCT c.doc_id, c.token FROM clean c
                             JOIN b{r} b ON c.doc_id = b.doc_id AND c.sent_id = b.sent_id) u
                             ON p.doc_id = u.doc_id AND p.token = u.token"""),
        ]
    return ctes
