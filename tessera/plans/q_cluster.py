"""Registered clustering queries (C*) on the embeddings and the numeric view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators import cluster as C
from tessera.operators import text as TO
from tessera.operators import topics as TP
from tessera.plans.catalog import query
from tessera.plans.views_sql import with_views
from tessera.session import cut_lineage
from tessera.sources import tables as T


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


VECS = ("vecs", "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings")
CEN = ("cen", """
SELECT label AS cluster, list(m ORDER BY i) AS centre FROM (
  SELECT label, i, avg(v) AS m FROM (
    SELECT label, unnest(vec) AS v, generate_subscripts(vec, 1) AS i FROM vecs) x
  GROUP BY 1, 2) y GROUP BY 1""")
ASSIGN = ("asg", """
SELECT id, cluster, d FROM (
  SELECT v.id, c.cluster, list_distance(v.vec, c.centre) AS d,
         row_number() OVER (PARTITION BY v.id ORDER BY list_distance(v.vec, c.centre), c.cluster)
           AS rn
  FROM vecs v CROSS JOIN cen c) t WHERE rn = 1""")


def _q(extra, body):
    return with_views([], body, [VECS] + extra)


@query("C1_pairwise_euclidean", _q([], """
SELECT a.id AS i, b.id AS j, round(list_distance(a.vec, b.vec), 6) AS d
FROM vecs a JOIN vecs b ON a.id < b.id"""))
def c1(spark, sf):
    return C.pairwise(T.vectors(spark, sf)).withColumn("d", r6("d"))


@query("C3_assign_label_centres", _q([CEN, ASSIGN], "SELECT id, cluster, round(d, 6) AS d FROM asg"))
def c3(spark, sf):
    v = T.vectors(spark, sf)
    return C.assign(v, C.label_centres(v)).withColumn("d", r6("d"))


@query("C3_distortion", _q([CEN, ASSIGN], """
SELECT round(avg(d), 6) AS distortion, round(sum(d * d), 6) AS inertia, count(*) AS n FROM asg"""))
def c3b(spark, sf):
    v = T.vectors(spark, sf)
    d = C.distortion(C.assign(v, C.label_centres(v)))
    return d.select(r6("distortion").alias("distortion"), r6("inertia").alias("inertia"), "n")


@query("C5_silhouette_euclidean", _q([], """
WITH p AS (SELECT a.id AS i, b.label AS lj, list_distance(a.vec, b.vec) AS d
           FROM vecs a JOIN vecs b ON a.id <> b.id),
m AS (SELECT i, lj, avg(d) AS md FROM p GROUP BY 1, 2),
ab AS (SELECT m.i, max(CASE WHEN m.lj = v.label THEN md END) AS a,
              min(CASE WHEN m.lj <> v.label THEN md END) AS b
       FROM m JOIN vecs v ON m.i = v.id GROUP BY m.i)
SELECT v.id, v.label,
       round(coalesce(CASE WHEN a IS NULL OR b IS NULL THEN 0.0
                           ELSE (b - a) / greatest(a, b) END, 0.0), 6) AS s
FROM vecs v LEFT JOIN ab ON v.id = ab.i"""))
def c5(spark, sf):
    v = T.vectors(spark, sf)
    s = C.silhouette(C.pairwise(v, keep=["label"]), v)
    return s.withColumn("s", r6("s"))


@query("C11_cluster_indices", _q([CEN], """
WITH allc AS (SELECT list(m ORDER BY i) AS gc FROM (
    SELECT i, avg(v) AS m FROM (SELECT unnest(vec) AS v, generate_subscripts(vec, 1) AS i
                                FROM vecs) x GROUP BY 1) y),
j AS (SELECT v.label, list_distance(v.vec, c.centre) AS e FROM vecs v
      JOIN cen c ON v.label = c.cluster),
per AS (SELECT label, count(*) AS nk, sum(e * e) AS wk, avg(e) AS sk FROM j GROUP BY 1),
b AS (SELECT c.cluster AS label, pow(list_distance(c.centre, allc.gc), 2) AS cb FROM cen c, allc),
tot AS (SELECT sum(wk) AS W, sum(nk * cb) AS B, sum(nk) AS n, count(*) AS k,
               avg(wk / nk) AS ball_hall FROM b JOIN per ON b.label = per.label),
cc AS (SELECT c1.cluster AS l1, (p1.sk + p2.sk) / list_distance(c1.centre, c2.centre) AS r
       FROM cen c1 JOIN cen c2 ON c1.cluster <> c2.cluster
       JOIN per p1 ON p1.label = c1.cluster JOIN per p2 ON p2.label = c2.cluster),
db AS (SELECT avg(r) AS db FROM (SELECT l1, max(r) AS r FROM cc GROUP BY 1) z)
SELECT 'trace_w' AS "index", round(W, 6) AS value FROM tot
UNION ALL SELECT 'trace_b', round(B, 6) FROM tot
UNION ALL SELECT 'ch', round((B / (k - 1)) / (W / (n - k)), 6) FROM tot
UNION ALL SELECT 'ball_hall', round(ball_hall, 6) FROM tot
UNION ALL SELECT 'davies_bouldin', round(db, 6) FROM db"""))
def c11(spark, sf):
    return C.cluster_indices(T.vectors(spark, sf)).withColumn("value", r6("value"))


@query("C12_best_mapping_error")
def c12(spark, sf):
    v = T.vectors(spark, sf)
    model, a = C.kmeans(v, 10, seeds=(1,))
    return C.mapped_error(a.join(v.select("id", "label"), "id"), "label", "cluster")


def _components(spark, sf):
    """Vectors, and a third as many singular values and components as they have
    dimensions."""
    v = T.vectors(spark, sf)
    long = v.select("id", F.posexplode("vec").alias("term", "w"))
    values, rows, _ = TP.truncated_svd(long, max(1, V.vector_dim(v) // 3), "id")
    reduced = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("x")).select(
        "id", F.transform("x", lambda s: s["value"]).alias("vec"))
    return v.select("id", "label"), values, reduced


@query("C14_svd_singular_values")
def c14(spark, sf):
    return _components(spark, sf)[1]


@query("C14_svd_kmeans_error")
def c14k(spark, sf):
    labels, _, reduced = _components(spark, sf)
    _, a = C.kmeans(reduced, 10, seeds=(1,))
    return C.mapped_error(a.join(labels, "id"), "label", "cluster")


@query("C14_svd_bisecting_error")
def c14b(spark, sf):
    labels, _, reduced = _components(spark, sf)
    return C.mapped_error(C.bisecting(reduced, 10).join(labels, "id"), "label", "cluster")


@query("C14_svd_of_texts_kmeans_error")
def c14t(spark, sf):
    """TF-IDF of whole documents, ten components, clusters against languages."""
    docs = T.table(spark, sf, "documents")
    bow = cut_lineage(TO.bag_of_words(TO.clean_tokens(docs.select("doc_id", "text"))))
    _, rows, _ = TP.truncated_svd(TO.tfidf_log2(bow), 10)
    reduced = rows.groupBy(F.col("doc_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("x")).select(
        "id", F.transform("x", lambda s: s["value"]).alias("vec"))
    _, a = C.kmeans(reduced, 4, seeds=(1,))
    return C.mapped_error(a.join(docs.select(F.col("doc_id").alias("id"), "lang"), "id"), "lang", "cluster")


@query("C13_label_distribution", _q([CEN, ASSIGN], """
SELECT coalesce(t.label, p.label) AS label, coalesce(n_true, 0) AS n_true,
       coalesce(n_pred, 0) AS n_pred
FROM (SELECT label, count(*) AS n_true FROM vecs GROUP BY 1) t
FULL JOIN (SELECT cluster AS label, count(*) AS n_pred FROM asg GROUP BY 1) p
  ON t.label = p.label"""))
def c13(spark, sf):
    v = T.vectors(spark, sf)
    a = C.assign(v, C.label_centres(v)).join(v.select("id", "label"), "id")
    return C.label_distribution(a, "label", "cluster")


@query("C15_standardise", with_views(["numeric6"], """
SELECT round((f1 - avg(f1) OVER ()) / stddev_pop(f1) OVER (), 6) AS f1,
       round((f2 - avg(f2) OVER ()) / stddev_pop(f2) OVER (), 6) AS f2,
       round((f5 - avg(f5) OVER ()) / stddev_samp(f5) OVER (), 6) AS f5
FROM numeric6"""))
def c15(spark, sf):
    n = T.numeric6(spark, sf).select("f1", "f2", "f5")
    z = C.standardise(C.standardise(n, ["f1", "f2"], ddof=0), ["f5"], ddof=1)
    return z.select(*[r6(c).alias(c) for c in ("f1", "f2", "f5")])


@query("C2_kmeans_assignments")
def c2(spark, sf):
    _, a = C.kmeans(T.vectors(spark, sf), 10, seeds=(1, 2, 3))
    return a


@query("C4_elbow")
def c4(spark, sf):
    return C.elbow(T.vectors(spark, sf), [2, 3, 4, 5, 6])


@query("C8_bisecting_clusters")
def c8(spark, sf):
    return C.bisecting(T.vectors(spark, sf), 5, metric="cosine")


@query("J4_cross_distance_to_centres", _q([CEN], """
SELECT v.id, c.cluster, round(list_distance(v.vec, c.centre), 6) AS d
FROM vecs v CROSS JOIN cen c"""))
def j4(spark, sf):
    v = T.vectors(spark, sf)
    cen = C.label_centres(v)
    return (v.crossJoin(F.broadcast(cen))
            .select("id", "cluster", r6(V.euclidean("vec", "centre")).alias("d")))


@query("C7_single_linkage_heights")
def c7(spark, sf):
    heights, _ = C.single_linkage(C.pairwise(T.vectors(spark, sf)))
    return heights


@query("C7_single_linkage_cut10")
def c7b(spark, sf):
    _, lab = C.single_linkage(C.pairwise(T.vectors(spark, sf)), k=10)
    return lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("C9_linkage_knee")
def c9(spark, sf):
    heights, _ = C.single_linkage(C.pairwise(T.vectors(spark, sf)))
    return C.linkage_knee(heights)


@query("C10_gap_statistic")
def c10(spark, sf):
    return C.gap_statistic(T.vectors(spark, sf), [2, 3, 4, 5, 6], b=3)
