"""Golden toys, invariants and brute-force checks of single operators."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.html import main_text_of
from tessera.operators import cluster as C
from tessera.operators import graph as G
from tessera.operators import reduce as D
from tessera.operators import relational as R
from tessera.operators import summarize as SM
from tessera.operators import text as TO
from tessera.operators import topics as TP

# nine one-sentence documents and the toy stop list of the topic-model tutorial
TOY_DOCS = ["Human machine interface for lab abc computer applications",
            "A survey of user opinion of computer system response time",
            "The EPS user interface management system",
            "System and human system engineering testing of EPS",
            "Relation of user perceived response time to error measurement",
            "The generation of random binary unordered trees",
            "The intersection graph of paths in trees",
            "Graph minors IV Widths of trees and well quasi ordering",
            "Graph minors A survey"]
TOY_STOP = "for a of the and to in".split()


def _toy_tokens(spark):
    docs = spark.createDataFrame(list(enumerate(TOY_DOCS)), "doc_id long, text string")
    toks = TO.ws_tokens(docs)
    stop = spark.createDataFrame([(w,) for w in TOY_STOP], "word string")
    return R.drop_in(toks, "token", stop)


def test_toy_dictionary_has_twelve_terms(spark):
    toks = _toy_tokens(spark)
    d = TO.dictionary(toks, min_df=2)
    assert d.count() == 12
    assert sorted(r.term_id for r in d.collect()) == list(range(12))


def test_toy_similarity_query(spark):
    toks = _toy_tokens(spark)
    d = TO.dictionary(toks, min_df=2).select(F.col("term").alias("token"))
    kept = toks.join(d, "token", "left_semi")
    bow = TO.bag_of_words(kept)
    model = TO.idf_log2(bow)
    index = TO.tfidf_log2(bow, model=model)
    q = spark.createDataFrame([(0, "human computer interaction")], "doc_id long, text string")
    qbow = TO.bag_of_words(TO.ws_tokens(q))
    qv = TO.tfidf_log2(qbow, model=model).withColumnRenamed("doc_id", "qid")
    sims = {r.doc_id: r.cos for r in TP.similarity_query(index, qv).collect()}
    assert round(sims[0], 3) == 0.816
    assert round(sims[1], 3) == 0.314


def test_five_point_distances(spark):
    pts = [(-77, 38), (-84, 33), (-122, 45), (-111, 40), (-112, 33)]
    df = spark.createDataFrame([(i, [float(x), float(y)]) for i, (x, y) in enumerate(pts)],
                               "id long, vec array<double>")
    p = {(r.i, r.j): r.d for r in C.pairwise(df).collect()}
    assert len(p) == 10
    assert round(p[(0, 2)], 3) == 45.541
    sq = C.pairwise(df, square=True)
    assert sq.count() == 25


def test_best_mapping_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    for k in (2, 3, 4, 5):
        w = rng.integers(0, 20, size=(k, k)).astype(float)
        cols = C._assignment_max(w)
        best = max(sum(w[i, p[i]] for i in range(k)) for p in itertools.permutations(range(k)))
        assert sum(w[i, cols[i]] for i in range(k)) == best


def test_describe_quantiles_match_numpy(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 7.0, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = {r.stat: r.value for r in R.describe(df, ["x"]).collect()}
    for q, name in ((25, "25%"), (50, "50%"), (75, "75%")):
        assert d[name] == pytest.approx(np.percentile(vals, q))
    assert d["mean"] == pytest.approx(np.mean(vals))
    assert d["std"] == pytest.approx(np.std(vals, ddof=1))


def test_histogram_constant_and_empty(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    h = R.histogram(df, "x", bins=4).collect()
    assert sum(r.n for r in h) == 2
    empty = spark.createDataFrame([], "a string, b string")
    assert R.stacked_value_counts(empty, ["a", "b"]).count() == 0


def test_scaled_counts_all_equal(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    sizes = [r.size for r in R.scaled_counts(df, ["k"]).collect()]
    assert sizes == [0.0, 0.0]


def _brute_triangles(edges):
    adj = {}
    for a, b in edges:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    return sum(1 for a, b, c in itertools.combinations(sorted(adj), 3)
               if b in adj[a] and c in adj[a] and c in adj[b])


def _brute_cores(edges):
    adj = {}
    for a, b in edges:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    core, k, alive = {}, 0, set(adj)
    while alive:
        k = min(len(adj[v] & alive) for v in alive) if alive else k
        changed = True
        while changed:
            changed = False
            for v in list(alive):
                if len(adj[v] & alive) <= k:
                    core[v] = k
                    alive.discard(v)
                    changed = True
    return core


def test_triangles_and_cores_match_brute_force(spark):
    rng = np.random.default_rng(3)
    edges = sorted({tuple(sorted(map(int, rng.choice(15, 2, replace=False))))
                    for _ in range(45)})
    df = spark.createDataFrame(edges, "src long, dst long")
    assert G.triangles(df).count() == _brute_triangles(edges)
    cores = {r.id: r.core for r in G.core_numbers(df).collect()}
    assert cores == _brute_cores(edges)


def test_self_loop_counts_twice(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "src long, dst long")
    deg = {r.id: r.degree for r in G.degrees(df).collect()}
    assert deg == {1: 3, 2: 1}


def test_pagerank_matches_dense_power_iteration(spark):
    edges = [(1, 2, 1.0), (2, 3, 2.0), (3, 1, 1.0), (3, 4, 0.5)]
    df = spark.createDataFrame(edges, "src long, dst long, w double")
    got = {r.id: r.rank for r in G.pagerank(df, weight="w", tol=1e-12).collect()}
    ids = [1, 2, 3, 4]
    n = len(ids)
    W = np.zeros((n, n))
    for a, b, w in edges:
        W[ids.index(a), ids.index(b)] += w
        W[ids.index(b), ids.index(a)] += w
    P = W / W.sum(axis=1, keepdims=True)
    x = np.full(n, 1 / n)
    for _ in range(1000):
        x = 0.85 * x @ P + 0.15 / n
    for i, v in enumerate(ids):
        assert got[v] == pytest.approx(x[i], abs=1e-9)


def test_textrank_factorised_equals_dense(spark):
    text = ("Cats sit on warm mats. Dogs chase cats in the park. Warm mats please cats. "
            "The park is green and wide. Dogs sleep on mats.")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    sents, units, a = SM.sentence_tfidf(docs)
    got = {r.sent_id: r.score for r in SM.textrank_scores(a, units, tol=1e-13).collect()}
    n = units.count()
    A = np.zeros((n, 1000))
    terms = {}
    for r in a.collect():
        A[r.sent_id, terms.setdefault(r.term, len(terms))] = r.w
    cos = A @ A.T
    dist = 1 - cos
    np.fill_diagonal(dist, 0)
    P = dist / dist.sum(axis=1, keepdims=True)
    x = np.full(n, 1 / n)
    for _ in range(2000):
        x = 0.85 * x @ P + 0.15 / n
    for i in range(n):
        assert got[i] == pytest.approx(x[i], abs=1e-9)


def test_eigen_invariants(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(50, 3)) @ np.array([[2, 0, 0], [1, 1, 0], [0, 0, 0.5]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in m], "a double, b double, c double")
    vals, vecs = D.eigen_np(df, ["a", "b", "c"], "cov")
    assert vals.sum() == pytest.approx(np.trace(np.cov(m.T)))
    vr, _ = D.eigen_np(df, ["a", "b", "c"], "corr")
    assert vr.sum() == pytest.approx(3.0)
    checks = D.loading_checks(D.eigen(df, ["a", "b", "c"], "corr")).collect()
    for r in checks:
        if r.axis == "row":
            assert r.sum_sq == pytest.approx(1.0)


def test_main_text_picks_most_paragraphs():
    html = ("<html><head><style>p{}</style><script>var x='<p>';</script></head><body>"
            "<div><p>one</p></div><article><p>a</p><p>b</p><p>c</p></article></body></html>")
    assert main_text_of(html) == "abc"


def test_sentences_and_empty_document(spark):
    docs = spark.createDataFrame([(1, "One. Two!  Three?"), (2, ""), (3, "Single")],
                                 "doc_id long, text string")
    s = TO.sentences(docs).orderBy("doc_id", "sent_id").collect()
    assert [(r.doc_id, r.sentence) for r in s] == [(1, "One."), (1, "Two!"), (1, "Three?"),
                                                  (3, "Single")]


def test_levenshtein_builtin(spark):
    df = spark.createDataFrame([("kitten", "sitting")], "a string, b string")
    assert TO.edit_distance(df, "a", "b").first().d == 3


def test_haversine_quarter_circle(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 90.0)], "a double, b double, c double, d double")
    km = R.haversine(df, "a", "b", "c", "d").first().km
    assert km == pytest.approx(math.pi / 2 * 6371.0)


def test_mst_matches_prim(spark):
    rng = np.random.default_rng(7)
    pts = rng.normal(size=(25, 3))
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)],
                               "id long, vec array<double>")
    heights, lab = C.single_linkage(C.pairwise(df), k=3)
    got = sorted(r.height for r in heights.collect())
    n = len(pts)
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    inside, best, tree = {0}, d[0].copy(), []
    for _ in range(n - 1):
        best[list(inside)] = np.inf
        j = int(np.argmin(best))
        tree.append(best[j])
        inside.add(j)
        best = np.minimum(best, d[j])
    assert got == pytest.approx(sorted(tree))
    assert lab.select("cluster").distinct().count() == 3


def _brute_betweenness(edges):
    import collections
    adj = collections.defaultdict(set)
    for a, b in edges:
        adj[a].add(b)
        adj[b].add(a)
    nodes = sorted(adj)
    bc = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        dist, sigma, order = {s: 0}, {s: 1.0}, [s]
        q = [s]
        while q:
            nq = []
            for v in q:
                for w in adj[v]:
                    if w not in dist:
                        dist[w] = dist[v] + 1
                        sigma[w] = 0.0
                        nq.append(w)
                        order.append(w)
                    if dist[w] == dist[v] + 1:
                        sigma[w] += sigma[v]
            q = nq
        delta = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for v in adj[w]:
                if dist.get(v) == dist[w] - 1:
                    delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                bc[w] += delta[w]
    n = len(nodes)
    return {v: b / ((n - 1) * (n - 2)) for v, b in bc.items()}


def test_betweenness_matches_brandes(spark):
    rng = np.random.default_rng(5)
    edges = sorted({tuple(sorted(map(int, rng.choice(12, 2, replace=False))))
                    for _ in range(20)})
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.id: r.betweenness for r in G.betweenness(df).collect()}
    want = _brute_betweenness(edges)
    for v, b in want.items():
        assert got[v] == pytest.approx(b, abs=1e-12)


def test_lsa_word_ranking_matches_numpy(spark):
    text = ("Cats sit on warm mats. Dogs chase cats in the park. Warm mats please cats. "
            "The park is green and wide.")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    sents, units, a = SM.sentence_tfidf(docs)
    got = {r.term: r.score for r in SM.lsa_word_ranking(a, units).collect()}
    rows = a.collect()
    terms = sorted({r.term for r in rows})
    n = units.count()
    m = np.zeros((n, len(terms)))
    for r in rows:
        m[r.sent_id, terms.index(r.term)] = r.w
    _, s, vt = np.linalg.svd(m, full_matrices=False)
    for k in range(len(s)):
        if vt[k, np.argmax(np.abs(vt[k]))] < 0:
            vt[k] *= -1
    vt[vt <= vt.mean(axis=1, keepdims=True)] = 0
    want = (vt * s[:, None]).sum(axis=0)
    for t, v in zip(terms, want):
        assert got[t] == pytest.approx(v, abs=1e-9)


def test_kl_sum_matches_greedy(spark):
    text = ("Cats sit on warm mats. Dogs chase cats in the park. Warm mats please cats. "
            "The park is green and wide. Dogs sleep on mats near cats.")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = SM.summarize_kl(docs, n=2).first().summary
    sents, clean, _ = TO.clean_sentence_tokens(docs)
    words = {}
    for r in clean.collect():
        words.setdefault(r.sent_id, []).append(r.token)
    allw = [w for ws in words.values() for w in ws]
    p = {w: allw.count(w) / len(allw) for w in set(allw)}
    chosen = []
    for _ in range(2):
        best = None
        for sid in sorted(words):
            if sid in chosen:
                continue
            sw = [w for s in chosen + [sid] for w in words[s]]
            q = {w: sw.count(w) / len(sw) for w in set(sw)}
            kl = sum(p[w] * math.log(p[w] / q[w]) for w in q)
            if best is None or round(kl, 12) < best[0]:
                best = (round(kl, 12), sid)
        chosen.append(best[1])
    text_of = {r.sent_id: r.sentence for r in sents.collect()}
    assert got == " ".join(text_of[s] for s in sorted(chosen))


def test_greedy_matching_rounds(spark):
    e = spark.createDataFrame([(1, 10, 5.0), (1, 11, 3.0), (2, 10, 4.0), (2, 11, 4.0),
                               (3, 11, 1.0)], "src long, dst long, weight double")
    got = sorted(tuple(r) for r in G.greedy_matching(e).collect())
    assert got == [(1, 10, 5.0), (2, 11, 4.0)]


def test_dense_index_is_a_global_order(spark):
    rng = np.random.default_rng(11)
    vals = rng.permutation(500).tolist()
    df = spark.createDataFrame([(int(v), f"t{v:04d}") for v in vals], "k long, term string")
    df = df.repartition(7)
    got = {r.term: r.idx for r in R.dense_index(df, "term").collect()}
    assert sorted(got.values()) == list(range(500))
    assert all(got[f"t{v:04d}"] == v for v in range(500))
