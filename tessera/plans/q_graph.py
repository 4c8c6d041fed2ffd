"""Registered graph queries (G*) on graphs derived from the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.plans.catalog import query
from tessera.plans.views_sql import VIEWS, with_views
from tessera.session import cut_lineage
from tessera.sources import tables as T


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _e(view):
    return [("e", f"SELECT src, dst FROM {view} WHERE src <> dst")]


DEG = ("deg", "SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL "
              "SELECT dst FROM e) t GROUP BY id")
ADJ = ("adj", "SELECT src AS a, dst AS b FROM e UNION ALL SELECT dst, src FROM e")
TRI = ("tri", "SELECT a.src AS p, a.dst AS q, b.dst AS r FROM e a "
              "JOIN e b ON a.src = b.src AND a.dst < b.dst "
              "JOIN e c ON c.src = a.dst AND c.dst = b.dst")


def _sql(view, extra, body):
    return with_views([view], body, _e(view) + extra)


@query("G1_trade_edges", with_views(["actor_events"], """
SELECT DISTINCT actor1_country AS src, actor2_country AS dst FROM actor_events
WHERE actor1_country IS NOT NULL AND actor2_country IS NOT NULL"""))
def g1(spark, sf):
    return G.graph_from(T.actor_events(spark, sf), "actor1_country", "actor2_country")


@query("G2_degree_centrality", _sql("copurchase", [DEG], """
SELECT id, degree, round(degree / (SELECT count(*) - 1 FROM deg), 6) AS centrality FROM deg"""))
def g2(spark, sf):
    d = G.degrees(T.copurchase(spark, sf))
    return d.withColumn("centrality", r6("centrality"))


@query("G3_degree_histogram", _sql("copurchase", [DEG], """
SELECT CAST(g.degree AS BIGINT) AS degree, coalesce(c.n, 0) AS n
FROM (SELECT unnest(range(0, (SELECT max(degree) FROM deg) + 1)) AS degree) g
LEFT JOIN (SELECT degree, count(*) AS n FROM deg GROUP BY 1) c ON c.degree = g.degree"""))
def g3(spark, sf):
    return G.degree_histogram(T.copurchase(spark, sf))


@query("G5_graph_stats", _sql("copurchase", [DEG], """
SELECT n, m, round(m / n, 6) AS m_per_n, round(2 * m / n, 6) AS avg_degree,
       round(2 * m / (n * (n - 1)), 6) AS density
FROM (SELECT count(*) AS n FROM deg) a, (SELECT count(*) AS m FROM e) b"""))
def g5(spark, sf):
    s = G.graph_stats(T.copurchase(spark, sf))
    return s.select("n", "m", *[r6(c).alias(c) for c in ("m_per_n", "avg_degree", "density")])


CLUST = ("clust", """
SELECT d.id, d.degree, coalesce(t.t, 0) AS triangles,
       CASE WHEN d.degree > 1 THEN 2.0 * coalesce(t.t, 0) / (d.degree * (d.degree - 1))
            ELSE 0.0 END AS coeff
FROM deg d LEFT JOIN (SELECT id, count(*) AS t FROM (
    SELECT p AS id FROM tri UNION ALL SELECT q FROM tri UNION ALL SELECT r FROM tri) x
  GROUP BY id) t ON d.id = t.id""")


@query("G6_local_clustering", _sql("copurchase", [DEG, TRI, CLUST], """
SELECT id, degree, triangles, round(coeff, 6) AS coeff FROM clust"""))
def g6(spark, sf):
    return G.clustering(T.copurchase(spark, sf)).withColumn("coeff", r6("coeff"))


@query("G6_transitivity", _sql("copurchase", [DEG, TRI, CLUST], """
SELECT round(avg(coeff), 6) AS avg_clustering,
       round(sum(triangles) / sum(degree * (degree - 1) / 2), 6) AS transitivity,
       CAST(sum(triangles) / 3 AS BIGINT) AS n_triangles FROM clust"""))
def g6b(spark, sf):
    s = G.clustering_summary(T.copurchase(spark, sf))
    return s.select(r6("avg_clustering").alias("avg_clustering"),
                    r6("transitivity").alias("transitivity"), "n_triangles")


def _kcore_sql(k=4, rounds=40):
    ctes = [("c0", "SELECT src, dst FROM e")]
    for i in range(rounds):
        low = (f"SELECT id FROM (SELECT src AS id FROM c{i} UNION ALL SELECT dst FROM c{i}) t "
               f"GROUP BY id HAVING count(*) < {k}")
        ctes.append((f"c{i + 1}", f"SELECT src, dst FROM c{i} WHERE src NOT IN ({low}) "
                                  f"AND dst NOT IN ({low})"))
    return _sql("copurchase", ctes, f"SELECT src, dst FROM c{rounds} WHERE CASE WHEN "
                f"(SELECT count(*) FROM c{rounds}) <> (SELECT count(*) FROM c{rounds - 1}) "
                f"THEN error('more rounds needed') ELSE true END")


@query("G4_k_core", _kcore_sql)
def g4(spark, sf):
    return G.k_core(T.copurchase(spark, sf), 4)


def _core_sql(rounds=40):
    ctes = [DEG, ADJ, ("h0", "SELECT id, degree AS c FROM deg")]
    for i in range(rounds):
        ctes.append((f"h{i + 1}", f"""
SELECT p.id, least(p.c, hh.h) AS c FROM h{i} p JOIN (
  SELECT id, max(least(cb, atleast)) AS h FROM (
    SELECT id, cb, sum(m) OVER (PARTITION BY id ORDER BY cb DESC
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS atleast
    FROM (SELECT adj.a AS id, h.c AS cb, count(*) AS m FROM adj JOIN h{i} h ON adj.b = h.id
          GROUP BY 1, 2) x) y GROUP BY id) hh ON p.id = hh.id"""))
    return _sql("copurchase", ctes, f"SELECT id, CAST(c AS BIGINT) AS core FROM h{rounds} WHERE CASE WHEN "
                f"(SELECT sum(c) FROM h{rounds}) <> (SELECT sum(c) FROM h{rounds - 1}) "
                f"THEN error('more rounds needed') ELSE true END")


@query("G4_core_numbers", _core_sql)
def g4b(spark, sf):
    return G.core_numbers(T.copurchase(spark, sf))


def _edges(spark, sf):
    """``copurchase``, made once for a query that reads it more than once."""
    return cut_lineage(T.copurchase(spark, sf))


PARTS = "nodes JOIN part ON p_partkey = id AND p_size = 50"


def _bfs_sql(body, extra="", view="copurchase", sources=PARTS):
    """Breadth-first search from the sources; ends when no node is new."""
    return f"""WITH RECURSIVE e AS (SELECT src, dst FROM ({VIEWS[view]}) v
                                    WHERE src <> dst),
und AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
nodes AS (SELECT DISTINCT a AS id FROM und),
paths(source, id, dist) USING KEY (source, id) AS (
  SELECT id, id, 0 FROM {sources}
  UNION
  SELECT w.source, u.b, w.dist + 1 FROM paths w JOIN und u ON w.id = u.a
  LEFT JOIN recurring.paths r ON r.source = w.source AND r.id = u.b WHERE r.id IS NULL){extra}
{body}"""


_NATIONS = dict(view="nation_trade", sources="nodes")
_PATHS = ("SELECT source, id, dist FROM paths",)


@query("G7_shortest_paths", _bfs_sql(*_PATHS))
def g7(spark, sf):
    e = _edges(spark, sf)
    return G.shortest_paths(e, T.path_sources(spark, sf, e))


@query("G7_shortest_paths_nations", _bfs_sql(*_PATHS, **_NATIONS))
def g7n(spark, sf):
    return G.shortest_paths(T.nation_trade(spark, sf))


_SUMMARY = ("""
SELECT max(ecc) AS diameter, min(ecc) AS radius,
       CAST(sum(CASE WHEN ecc = (SELECT min(ecc) FROM ecc) THEN 1 ELSE 0 END) AS BIGINT) AS n_center,
       CAST(sum(CASE WHEN ecc = (SELECT max(ecc) FROM ecc) THEN 1 ELSE 0 END) AS BIGINT)
         AS n_periphery,
       round((SELECT avg(dist) FROM paths WHERE dist > 0), 6) AS avg_path_length
FROM ecc""", """,
ecc AS (SELECT source AS id, max(dist) AS ecc FROM paths GROUP BY 1)""")


def _distances(paths):
    return G.distance_summary(paths).withColumn("avg_path_length", r6("avg_path_length"))


@query("G8_distance_summary_estimate", _bfs_sql(*_SUMMARY))
def g8(spark, sf):
    e = _edges(spark, sf)
    return _distances(G.shortest_paths(e, T.path_sources(spark, sf, e)))


@query("G8_distance_summary_nations", _bfs_sql(*_SUMMARY, **_NATIONS))
def g8n(spark, sf):
    return _distances(G.shortest_paths(T.nation_trade(spark, sf)))


_CLOSENESS = ("""
SELECT id, round(CASE WHEN tot > 0 THEN (r - 1) / tot * ((r - 1) / (n - 1)) ELSE 0.0 END, 6)
         AS closeness
FROM (SELECT source AS id, count(*) AS r, sum(dist) AS tot FROM paths GROUP BY 1) p,
     (SELECT count(*) AS n FROM nodes) c""",)


@query("G9_closeness", _bfs_sql(*_CLOSENESS))
def g9(spark, sf):
    e = _edges(spark, sf)
    return G.closeness(G.shortest_paths(e, T.path_sources(spark, sf, e)), G.nodes_of(e)).withColumn(
        "closeness", r6("closeness"))


@query("G9_closeness_nations", _bfs_sql(*_CLOSENESS, **_NATIONS))
def g9n(spark, sf):
    e = T.nation_trade(spark, sf)
    return G.closeness(G.shortest_paths(e), G.nodes_of(e)).withColumn("closeness", r6("closeness"))


def _eig_sql(iters=100, tol=1e-6):
    ctes = [ADJ, ("nodes", "SELECT DISTINCT a AS id FROM adj"),
            ("x0", "SELECT id, 1.0 / (SELECT count(*) FROM nodes) AS x, false AS fz FROM nodes")]
    for k in range(iters):
        ctes += [
            (f"y{k}", f"SELECT x.id, x.x, x.fz, x.x + coalesce(s.s, 0.0) AS y FROM x{k} x "
                      f"LEFT JOIN (SELECT adj.a AS id, sum(x.x) AS s FROM adj JOIN x{k} x "
                      f"ON adj.b = x.id GROUP BY 1) s ON x.id = s.id"),
            (f"z{k}", f"SELECT id, x, fz, y / (SELECT sqrt(sum(y * y)) FROM y{k}) AS xn FROM y{k}"),
            (f"x{k + 1}", f"SELECT id, CASE WHEN fz THEN x ELSE xn END AS x, "
                          f"fz OR (SELECT sum(abs(xn - x)) FROM z{k}) < "
                          f"(SELECT count(*) FROM nodes) * {tol} AS fz FROM z{k}"),
        ]
    return _sql("copurchase", ctes, f"SELECT id, round(x, 6) AS eigenvector FROM x{iters}")


@query("G11_eigenvector_centrality", _eig_sql)
def g11(spark, sf):
    return G.eigenvector(T.copurchase(spark, sf)).withColumn("eigenvector",
                                                                    r6("eigenvector"))


def _pr_sql(edges_sql, iters=100, alpha=0.85, tol=1e-6):
    ctes = [
        ("e2", f"SELECT src, dst, w FROM ({edges_sql}) t UNION ALL "
               f"SELECT dst, src, w FROM ({edges_sql}) t WHERE src <> dst"),
        ("nodes", "SELECT DISTINCT id FROM (SELECT src AS id FROM e2 UNION ALL "
                  "SELECT dst FROM e2) t"),
        ("wo", "SELECT src AS id, sum(w) AS wo FROM e2 GROUP BY 1"),
        ("nd", "SELECT n.id, coalesce(wo.wo, 0.0) AS wo, "
               "CAST((SELECT count(*) FROM nodes) AS DOUBLE) AS n "
               "FROM nodes n LEFT JOIN wo ON n.id = wo.id"),
        ("en", "SELECT e2.src, e2.dst, e2.w / wo.wo AS p FROM e2 JOIN wo ON e2.src = wo.id "
               "WHERE e2.w / wo.wo > 0"),
        ("x0", "SELECT id, 1.0 / n AS x, false AS fz FROM nd"),
    ]
    for k in range(iters):
        ctes += [
            (f"q{k}", f"""
SELECT nd.id, nd.n, x.x, x.fz,
       {alpha} * (coalesce(i.inflow, 0.0)
         + (SELECT sum(CASE WHEN nd2.wo <= 0 THEN x2.x ELSE 0.0 END)
            FROM nd nd2 JOIN x{k} x2 ON nd2.id = x2.id) / nd.n) + {1 - alpha} / nd.n AS xn
FROM nd JOIN x{k} x ON nd.id = x.id
LEFT JOIN (SELECT en.dst AS id, sum(en.p * x.x) AS inflow FROM en JOIN x{k} x ON en.src = x.id
           GROUP BY 1) i ON nd.id = i.id"""),
            (f"x{k + 1}", f"SELECT id, CASE WHEN fz THEN x ELSE xn END AS x, "
                          f"fz OR (SELECT sum(abs(xn - x)) < max(n) * {tol} FROM q{k}) AS fz "
                          f"FROM q{k}"),
        ]
    return ctes, f"x{iters}"


def _pr_unweighted():
    ctes, last = _pr_sql("SELECT src, dst, 1.0 AS w FROM e")
    return _sql("copurchase", ctes, f"SELECT id, round(x, 6) AS rank FROM {last}")


@query("G12_pagerank", _pr_unweighted)
def g12(spark, sf):
    return G.pagerank(T.copurchase(spark, sf)).withColumn("rank", r6("rank"))


def _pr_weighted():
    ctes, last = _pr_sql("SELECT cust AS src, -supp AS dst, CAST(weight AS DOUBLE) AS w "
                         "FROM cust_supp")
    return with_views(["cust_supp"], f"SELECT id, round(x, 6) AS rank FROM {last}", ctes)


@query("G12_pagerank_weighted_bipartite", _pr_weighted)
def g12b(spark, sf):
    cs = T.cust_supp(spark, sf).select(F.col("cust").alias("src"),
                                       (-F.col("supp")).alias("dst"), "weight")
    return G.pagerank(cs, weight="weight").withColumn("rank", r6("rank"))


@query("G13_clique_counts", _sql("copurchase", [TRI], """
SELECT 3 AS k, count(*) AS n FROM tri
UNION ALL
SELECT 4, count(*) FROM tri t JOIN e e1 ON e1.src = t.p JOIN e e2 ON e2.src = t.q AND e2.dst = e1.dst
  JOIN e e3 ON e3.src = t.r AND e3.dst = e1.dst"""))
def g13(spark, sf):
    e = T.copurchase(spark, sf)
    c3 = G.k_cliques(e, 3).agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(3))
    c4 = G.k_cliques(e, 4).agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(4))
    return c3.unionByName(c4).select("k", "n")


_METRICS = ("""
SELECT 'degree' AS a, 'closeness' AS b, round(corr(degree, closeness), 6) AS corr FROM m""", """,
clo AS (SELECT source AS id, CASE WHEN sum(dist) > 0 THEN (count(*) - 1) / sum(dist)
               * ((count(*) - 1) / ((SELECT count(*) FROM nodes) - 1)) ELSE 0.0 END AS c
        FROM paths GROUP BY 1),
dg AS (SELECT a AS id, count(*) AS d FROM und GROUP BY a),
m AS (SELECT dg.id, CAST(dg.d AS DOUBLE) AS degree, clo.c AS closeness
      FROM dg JOIN clo ON dg.id = clo.id)""")


@query("G15_compare_metrics_estimate", _bfs_sql(*_METRICS))
def g15(spark, sf):
    e = _edges(spark, sf)
    return _compared(e, T.path_sources(spark, sf, e))


@query("G15_compare_metrics_nations", _bfs_sql(*_METRICS, **_NATIONS))
def g15n(spark, sf):
    return _compared(T.nation_trade(spark, sf))


def _compared(e, sources=None):
    d = G.degrees(e).select("id", F.col("degree").cast("double").alias("degree"))
    c = G.closeness(G.shortest_paths(e, sources), G.nodes_of(e))
    m = d.join(c, "id")
    return m.agg(r6(F.corr("degree", "closeness")).alias("corr")).select(
        F.lit("degree").alias("a"), F.lit("closeness").alias("b"), "corr")


@query("G16_top_nodes", _sql("copurchase", [DEG], """
SELECT d.id, d.degree, p.p_name FROM (SELECT * FROM deg ORDER BY degree DESC, id LIMIT 5) d
LEFT JOIN part p ON p.p_partkey = d.id"""))
def g16(spark, sf):
    d = G.degrees(T.copurchase(spark, sf)).select("id", "degree")
    parts = T.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_name")
    return G.top_nodes(d, parts, "degree", 5)


@query("G18_bipartite_sides", with_views(["cust_supp"], """
SELECT 0 AS side, count(DISTINCT cust) AS n FROM cust_supp
UNION ALL SELECT 1, count(DISTINCT supp) FROM cust_supp"""))
def g18(spark, sf):
    _, nodes = G.bipartite(T.cust_supp(spark, sf), "cust", "supp", "weight")
    return nodes.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("G19_greedy_matching")
def g19(spark, sf):
    return G.greedy_matching(T.cust_supp(spark, sf).select(
        F.col("cust").alias("src"), F.col("supp").alias("dst"), "weight"))


@query("G21_interactions_by_class", with_views(["actor_events"], """
SELECT actor1_country, actor2_country, quad_class, count(*) AS n FROM actor_events
GROUP BY 1, 2, 3"""))
def g21(spark, sf):
    return G.interactions(T.actor_events(spark, sf), ["actor1_country", "actor2_country"],
                          "quad_class")


def _betweenness_sql(levels=16, view="copurchase", sources=PARTS):
    ctes = [ADJ, ("nodes", "SELECT DISTINCT a AS id FROM adj"),
            ("lv0", f"SELECT id AS s, id AS v, 1.0 AS sigma FROM {sources}"),
            ("vis0", "SELECT s, v FROM lv0")]
    for i in range(levels):
        ctes += [
            (f"lv{i + 1}", f"""SELECT f.s, u.b AS v, sum(f.sigma) AS sigma FROM lv{i} f
                            JOIN adj u ON f.v = u.a
                            WHERE NOT EXISTS (SELECT 1 FROM vis{i} x WHERE x.s = f.s AND x.v = u.b)
                            GROUP BY 1, 2"""),
            (f"vis{i + 1}", f"SELECT * FROM vis{i} UNION ALL SELECT s, v FROM lv{i + 1}"),
        ]
    ctes.append((f"d{levels}", f"SELECT s, v, 0.0 AS delta FROM lv{levels}"))
    for i in range(levels - 1, 0, -1):
        ctes += [
            (f"ct{i}", f"""SELECT p.s, p.v, sum(p.sigma / l.sigma * (1 + d.delta)) AS delta
                        FROM lv{i} p JOIN adj u ON u.a = p.v
                        JOIN lv{i + 1} l ON l.s = p.s AND l.v = u.b
                        JOIN d{i + 1} d ON d.s = l.s AND d.v = l.v GROUP BY 1, 2"""),
            (f"d{i}", f"""SELECT p.s, p.v, coalesce(c.delta, 0.0) AS delta FROM lv{i} p
                       LEFT JOIN ct{i} c ON c.s = p.s AND c.v = p.v"""),
        ]
    alld = " UNION ALL ".join(f"SELECT v, delta FROM d{i}" for i in range(1, levels + 1))
    body = f"""SELECT n.id, round(CASE WHEN (SELECT count(*) FROM lv{levels}) > 0 THEN error('more levels needed')
                  ELSE coalesce(sum(d.delta), 0.0) END * (SELECT count(*) FROM nodes) / (SELECT count(*) FROM lv0)
                  / (((SELECT count(*) FROM nodes) - 1) * ((SELECT count(*) FROM nodes) - 2)), 6)
                  AS betweenness
               FROM nodes n LEFT JOIN ({alld}) d ON d.v = n.id GROUP BY n.id"""
    return _sql(view, ctes, body)


@query("G10_betweenness_estimate", _betweenness_sql)
def g10(spark, sf):
    e = _edges(spark, sf)
    return G.betweenness(e, T.path_sources(spark, sf, e)).withColumn(
        "betweenness", r6("betweenness"))


@query("G10_betweenness_nations", lambda: _betweenness_sql(**_NATIONS))
def g10n(spark, sf):
    return G.betweenness(T.nation_trade(spark, sf)).withColumn("betweenness", r6("betweenness"))


def _communities_sql(rounds=30):
    ctes = [TRI,
            ("cl", "SELECT p || ',' || q || ',' || r AS cid, p, q, r FROM tri"),
            ("subs", "SELECT cid, q || ',' || r AS sub FROM cl UNION ALL "
                     "SELECT cid, p || ',' || r FROM cl UNION ALL SELECT cid, p || ',' || q FROM cl"),
            ("lab0", "SELECT cid, cid AS label FROM cl")]
    for i in range(rounds):
        ctes += [
            (f"sl{i}", f"SELECT s.sub, min(l.label) AS sl FROM subs s JOIN lab{i} l "
                       f"ON s.cid = l.cid GROUP BY 1"),
            (f"lab{i + 1}", f"SELECT s.cid, least(min(x.sl), l.label) AS label FROM subs s "
                            f"JOIN sl{i} x ON s.sub = x.sub JOIN lab{i} l ON s.cid = l.cid "
                            f"GROUP BY s.cid, l.label"),
        ]
    body = f"""SELECT DISTINCT l.label AS community, t.id FROM cl
               JOIN lab{rounds} l ON cl.cid = l.cid, unnest([cl.p, cl.q, cl.r]) AS t(id)
               WHERE CASE WHEN EXISTS (SELECT 1 FROM lab{rounds} a JOIN lab{rounds - 1} b ON a.cid = b.cid
                                       WHERE a.label <> b.label) THEN error('more rounds needed') ELSE true END"""
    return _sql("copurchase", ctes, body)


@query("G14_clique_communities", _communities_sql)
def g14(spark, sf):
    return G.clique_communities(T.copurchase(spark, sf), 3)


# ------------------------------------------------------------ all nodes at once

@query("G7_distance_distribution_sketch")
def g7s(spark, sf):
    """Pairs at each distance over all nodes of ``copurchase``, by sketches: an
    approximation (see ``graph.reach``)."""
    return G.distance_distribution(G.reach(T.copurchase(spark, sf)))


@query("G9_reach_metrics_sketch")
def g9s(spark, sf):
    """Eccentricity, reachable nodes and closeness of all nodes of ``copurchase``,
    by sketches: an approximation."""
    return G.reach_metrics(G.reach(T.copurchase(spark, sf)))


def _maximal_sql(most=12):
    """Cliques by their last node and their common neighbours; maximal without any."""
    ctes = [ADJ, ("nb", "SELECT a, list(b) AS l FROM adj GROUP BY a"),
            ("c2", "SELECT e.dst AS last, list_intersect(x.l, y.l) AS com FROM e JOIN nb x ON e.src = x.a JOIN nb y ON e.dst = y.a")]
    for k in range(3, most + 1):
        ctes.append((f"c{k}", f"""SELECT u.v AS last, list_intersect(com, nb.l) AS com
            FROM (SELECT unnest(list_filter(com, lambda z: z > last)) AS v, com FROM c{k - 1}) u JOIN nb ON nb.a = u.v"""))
    rows = " UNION ALL ".join(f"SELECT {k} AS size, count(*) AS n FROM c{k} WHERE len(com) = 0" for k in range(2, most))
    return _sql("copurchase", ctes, f"""SELECT CAST(size AS INTEGER) AS size, n FROM ({rows}) t
        WHERE n > 0 AND CASE WHEN (SELECT count(*) FROM c{most}) > 0 THEN error('larger cliques') ELSE true END""")


@query("G13_maximal_cliques", _maximal_sql)
def g13m(spark, sf):
    return G.maximal_cliques(T.copurchase(spark, sf)).groupBy("size").agg(F.count(F.lit(1)).alias("n"))


@query("G13_clique_number", lambda: f"""
SELECT max(size) AS clique_number, CAST(sum(n) AS BIGINT) AS n_maximal, CAST(max_by(n, size) AS BIGINT) AS n_maximum
FROM ({_maximal_sql()}) t""")
def g13n(spark, sf):
    return G.clique_summary(G.maximal_cliques(T.copurchase(spark, sf)))


@query("G20_robins_alexander", with_views(["cust_supp"], """
WITH du AS (SELECT cust, count(*) - 1 AS x FROM cust_supp GROUP BY 1), dv AS (SELECT supp, count(*) - 1 AS y FROM cust_supp GROUP BY 1),
l AS (SELECT CAST(sum(x * y) AS BIGINT) AS l3 FROM cust_supp c JOIN du ON c.cust = du.cust JOIN dv ON c.supp = dv.supp),
p AS (SELECT count(*) AS c FROM cust_supp a JOIN cust_supp b ON a.cust = b.cust AND a.supp < b.supp GROUP BY a.supp, b.supp),
q AS (SELECT CAST(sum(c * (c - 1) / 2) AS BIGINT) AS c4 FROM p)
SELECT c4, l3, round(4.0 * c4 / l3, 6) AS coefficient FROM q, l"""))
def g20(spark, sf):
    e = T.cust_supp(spark, sf).select(F.col("cust").alias("src"), (-1 - F.col("supp")).alias("dst"))
    return G.robins_alexander(e).withColumn("coefficient", r6("coefficient"))


@query("G20_bipartite_clustering_nations", with_views(["nation_sides"], """
WITH adj AS (SELECT src AS a, dst AS b FROM nation_sides UNION ALL SELECT dst, src FROM nation_sides),
d AS (SELECT a, count(*) AS d FROM adj GROUP BY 1),
s AS (SELECT x.a, y.a AS v, count(*) AS c FROM adj x JOIN adj y ON x.b = y.b AND x.a <> y.a GROUP BY 1, 2),
m AS (SELECT s.a, avg(c / (du.d + dv.d - c)) AS cl FROM s JOIN d du ON s.a = du.a JOIN d dv ON s.v = dv.a GROUP BY 1)
SELECT d.a AS id, round(coalesce(cl, 0.0), 6) AS clustering FROM d LEFT JOIN m ON d.a = m.a"""))
def g20n(spark, sf):
    return G.bipartite_clustering(T.nation_sides(spark, sf)).withColumn("clustering", r6("clustering"))
