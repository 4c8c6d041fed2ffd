"""Distances, clustering and cluster validation (C1--C15).

Points are rows ``(id, vec array<double>[, label])``.  Assignments to k
centres broadcast the centre table, whose size is k x d (bounded by the
number of clusters, never by the data).  Pairwise measures (C1, C5 plain
Euclidean) are quadratic by definition; they run as a join of blocks of rows
with ``a.id < b.id`` and are meant for tables of moderate size --
the at-scale alternatives are the centroid-based measures below (C3, C11,
cosine silhouette via ``ClusteringEvaluator``).  Only C1 itself has a row per
pair: what is made of pairs (C5, C7, C9) is reduced in the tasks that find them.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators.relational import attach_row

# tasks need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block of ``pairwise``; a task has two blocks in memory.
BLOCK = 8192
#: Edges that a task of ``lightest`` holds beside its forest.
EDGES = 500_000


def pairwise(df: DataFrame, id_col="id", vec="vec", metric="euclidean",
             square: bool = False, keep=(), block: int = BLOCK) -> DataFrame:
    """Condensed pair table ``(i, j, d)`` with ``i < j``; ``square``
    adds the mirrored pairs and a zero diagonal.  ``keep`` names columns to
    add for both ends (``label_i``, ``label_j``).

    Rows are dealt by hash into blocks of about ``block``, and each pair of
    blocks is a key of the join: rows are sent once for each block, pairs never.
    ``silhouette`` and ``single_linkage`` reduce these pairs by tiles of rows
    (``tessera.operators.tiles``) and make no row of them."""
    from tessera.operators import tiles
    size = df.agg(F.max(F.size(vec)).alias("dim"), F.count(F.lit(1)).alias("n"),
                  (F.coalesce(F.max(tiles.odd(vec)), F.lit(False)) | (F.min(F.size(vec)) != F.max(F.size(vec)))).alias("odd")).first()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # enough blocks to keep the tasks busy, unless there are few rows
    dim, blocks = int(size["dim"] or 0), max(1, math.ceil(size["n"] / block), min(math.isqrt(2 * parts), size["n"] // 256))
    own = F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def side(prefix, name, mine, other):
        rows = df.select(id_col, vec, *keep, own.alias(mine), each.alias(other))
        return V.spread(rows, vec, dim, prefix, [F.col(id_col).alias(name), "ba", "bb",
                                                 *[F.col(c).alias(f"{c}_{name}") for c in keep]])

    ends = [f"{c}_{name}" for c in keep for name in "ij"]
    left, right = side("a", "i", "ba", "bb").repartition(parts, "ba", "bb"), side("b", "j", "bb", "ba")
    p = left.join(right, ["ba", "bb"]).filter(F.col("i") < F.col("j")).select(
        "i", "j", V.col_distance(metric, "a", "b", dim).alias("d"), *ends)
    if square:
        p = (p.unionByName(p.select(F.col("j").alias("i"), F.col("i").alias("j"), "d",
                                    *[F.col(f"{c}_{x}").alias(f"{c}_{y}") for c in keep for x, y in ("ji", "ij")]))
             .unionByName(df.select(F.col(id_col).alias("i"), F.col(id_col).alias("j"), F.lit(0.0).alias("d"),
                                    *[F.col(c).alias(f"{c}_{x}") for c in keep for x in "ij"])))
    else:
        p._tiles = tiles.pairs_of(df, id_col, vec, metric, keep, size, blocks)
    return p


def assign(df: DataFrame, centres: DataFrame, id_col="id", vec="vec", metric="euclidean",
           centre_id="cluster", centre_vec="centre") -> DataFrame:
    """Nearest centre per point ``(id, cluster, d)``; ties go to the
    lower centre id.  The centre table (k x d) is broadcast."""
    fn = V.METRICS[metric]
    c = F.broadcast(centres.select(F.col(centre_id).alias("_cid"),
                                   F.col(centre_vec).alias("_cv")))
    d = df.select(id_col, vec).crossJoin(c).select(id_col, "_cid", fn(vec, "_cv").alias("d"))
    best = d.groupBy(id_col).agg(F.min(F.struct("d", "_cid")).alias("_b"))
    return best.select(id_col, F.col("_b._cid").alias("cluster"), F.col("_b.d").alias("d"))


def distortion(assigned: DataFrame) -> DataFrame:
    """Mean distance to the nearest centre and within-cluster sum of squares."""
    return assigned.agg(F.avg("d").alias("distortion"),
                        F.sum(F.col("d") * F.col("d")).alias("inertia"),
                        F.count(F.lit(1)).alias("n"))


def label_centres(df: DataFrame, label="label", vec="vec") -> DataFrame:
    return V.mean_vectors(df, label, vec, "centre").withColumnRenamed(label, "cluster")


def silhouette(pairs: DataFrame, labels: DataFrame, id_col="id", label="label") -> DataFrame:
    """Silhouette per point from a condensed pair table and labels:
    ``a`` = mean distance inside the own cluster, ``b`` = smallest mean
    distance to another cluster, ``s = (b - a) / max(a, b)``; 0 for a point
    alone in its cluster and where all distances are 0.

    With the labels of both ends in the pair table (``pairwise(keep=[label])``)
    the pairs are summed where they are found and never shuffled."""
    tiled = vars(pairs).get("_tiles") if f"{label}_i" in pairs.columns else None
    if tiled:
        return _silhouette(tiled.by_label().groupBy("i", "lj").agg((F.sum("total") / F.sum("n")).alias("md")), labels, id_col, label)
    if f"{label}_i" not in pairs.columns:
        for end in "ij":
            pairs = pairs.join(labels.select(F.col(id_col).alias(end), F.col(label).alias(f"{label}_{end}")), end)
    both = pairs.select("d", F.explode(F.array(
        F.struct(F.col("i").alias("i"), F.col(f"{label}_j").alias("lj")),
        F.struct(F.col("j").alias("i"), F.col(f"{label}_i").alias("lj")))).alias("e"))
    return _silhouette(both.groupBy("e.i", "e.lj").agg(F.avg("d").alias("md")), labels, id_col, label)


def _silhouette(per: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """From the mean distances ``(i, lj, md)`` of each point to each cluster."""
    own = labels.select(F.col(id_col).alias("i"), F.col(label).alias("li"))
    j = per.join(own, "i")
    ab = j.groupBy("i").agg(
        F.max(F.when(F.col("lj") == F.col("li"), F.col("md"))).alias("a"),
        F.min(F.when(F.col("lj") != F.col("li"), F.col("md"))).alias("b"))
    s = F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise(
        F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")))
    out = own.join(ab, "i", "left").select(F.col("i").alias(id_col), F.col("li").alias(label),
                                           F.coalesce(s, F.lit(0.0)).alias("s"))
    return out


def standardise(df: DataFrame, cols, ddof: int = 0) -> DataFrame:
    """``(x - mean) / sd`` with population (ddof=0) or sample sd; a
    constant column (and a single row) becomes 0."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                   *[sd(c).alias(f"_s_{c}") for c in cols])
    j = attach_row(df, stats)
    return j.select(*[c for c in df.columns if c not in cols],
                    *[F.when(F.col(c).isNotNull(), F.coalesce(F.try_divide(
                        F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")), F.lit(0.0))).alias(c) for c in cols])


def label_distribution(df: DataFrame, y: str, p: str) -> DataFrame:
    """Counts per class of the truth and of the prediction."""
    t = df.groupBy(F.col(y).alias("label")).agg(F.count(F.lit(1)).alias("n_true"))
    q = df.groupBy(F.col(p).alias("label")).agg(F.count(F.lit(1)).alias("n_pred"))
    return t.join(q, "label", "full").fillna(0, ["n_true", "n_pred"])


def _assignment_max(w: np.ndarray) -> list[int]:
    """Exact maximum-weight assignment (Hungarian algorithm, O(k^3)) for a
    square k x k matrix; returns the column chosen for every row."""
    n = w.shape[0]
    cost = w.max() - w
    u = np.zeros(n + 1)
    v = np.zeros(n + 1)
    p = np.zeros(n + 1, dtype=int)
    way = np.zeros(n + 1, dtype=int)
    for i in range(1, n + 1):
        p[0] = i
        j0 = 0
        minv = np.full(n + 1, np.inf)
        used = np.zeros(n + 1, dtype=bool)
        while True:
            used[j0] = True
            i0 = p[j0]
            delta, j1 = np.inf, 0
            for j in range(1, n + 1):
                if not used[j]:
                    cur = cost[i0 - 1, j - 1] - u[i0] - v[j]
                    if cur < minv[j]:
                        minv[j], way[j] = cur, j0
                    if minv[j] < delta:
                        delta, j1 = minv[j], j
            for j in range(n + 1):
                if used[j]:
                    u[p[j]] += delta
                    v[j] -= delta
                else:
                    minv[j] -= delta
            j0 = j1
            if p[j0] == 0:
                break
        while True:
            j1 = way[j0]
            p[j0] = p[j1]
            j0 = j1
            if j0 == 0:
                break
    col_of_row = [0] * n
    for j in range(1, n + 1):
        if p[j]:
            col_of_row[p[j] - 1] = j - 1
    return col_of_row


def best_mapping(df: DataFrame, y: str, p: str) -> DataFrame:
    """Relabel predictions by the one-to-one mapping that minimises the
    error fraction (the best permutation), found exactly on the k x k
    confusion matrix -- a small aggregate -- with the Hungarian method.
    Returns the mapping table ``(p, mapped)``."""
    cm = df.groupBy(F.col(p).alias("p"), F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    rows = cm.collect()  # k x k cells: bounded by the number of classes
    preds = sorted({r["p"] for r in rows})
    truth = sorted({r["y"] for r in rows})
    k = max(len(preds), len(truth))
    w = np.zeros((k, k))
    pi = {v: i for i, v in enumerate(preds)}
    ti = {v: i for i, v in enumerate(truth)}
    for r in rows:
        w[pi[r["p"]], ti[r["y"]]] = r["n"]
    cols = _assignment_max(w)
    pairs = [(preds[i], truth[cols[i]] if cols[i] < len(truth) else None)
             for i in range(len(preds))]
    spark = df.sparkSession
    schema = f"p {df.schema[p].dataType.simpleString()}, mapped {df.schema[y].dataType.simpleString()}"
    return spark.createDataFrame(pairs, schema)


def mapped_error(df: DataFrame, y: str, p: str) -> DataFrame:
    m = best_mapping(df, y, p)
    j = df.join(F.broadcast(m), df[p] == m["p"], "left")
    return j.agg((F.avg((F.col("mapped") != F.col(y)).cast("double"))).alias("error"),
                 F.count(F.lit(1)).alias("n"))


def cluster_indices(df: DataFrame, label="label", vec="vec") -> DataFrame:
    """C11 (centroid-based part of the battery): trace W, trace B,
    Calinski-Harabasz, Ball-Hall and Davies-Bouldin as ``(index, value)``."""
    cen = label_centres(df, label, vec).withColumnRenamed("cluster", label)
    allc = V.mean_vectors(df.withColumn("_g", F.lit(0)), "_g", vec, "gc").drop("_g")
    j = df.join(cen, label)
    j = j.select(label, V.sq_dist(vec, "centre").alias("sq"), V.euclidean(vec, "centre").alias("e"))
    per = j.groupBy(label).agg(F.count(F.lit(1)).alias("nk"), F.sum("sq").alias("wk"),
                               F.avg("e").alias("sk"))
    b = (cen.crossJoin(F.broadcast(allc)).select(label, V.sq_dist("centre", "gc").alias("cb"))
         .join(per, label))
    tot = b.agg(F.sum("wk").alias("W"), F.sum(F.col("nk") * F.col("cb")).alias("B"),
                F.sum("nk").alias("n"), F.count(F.lit(1)).alias("k"),
                F.avg(F.col("wk") / F.col("nk")).alias("ball_hall"))
    c1 = cen.select(F.col(label).alias("l1"), F.col("centre").alias("c1"))
    c2 = cen.select(F.col(label).alias("l2"), F.col("centre").alias("c2"))
    s1 = per.select(F.col(label).alias("l1"), F.col("sk").alias("s1"))
    s2 = per.select(F.col(label).alias("l2"), F.col("sk").alias("s2"))
    cc = (c1.join(c2, F.col("l1") != F.col("l2")).join(s1, "l1").join(s2, "l2")
          .select("l1", ((F.col("s1") + F.col("s2")) / V.euclidean("c1", "c2")).alias("r")))
    db = cc.groupBy("l1").agg(F.max("r").alias("r")).agg(F.avg("r").alias("db"))
    row = tot.crossJoin(db).select(
        F.col("W").alias("trace_w"), F.col("B").alias("trace_b"),
        ((F.col("B") / (F.col("k") - 1)) / (F.col("W") / (F.col("n") - F.col("k")))).alias("ch"),
        "ball_hall", F.col("db").alias("davies_bouldin"))
    names = row.columns
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("index"),
                                                   F.col(n).cast("double").alias("value"))
                                          for n in names])).alias("s")).select("s.*")


# ---------------------------------------------------------------- fitted models

def _vectorised(df: DataFrame, vec: str):
    from pyspark.ml.functions import array_to_vector
    return df.withColumn("features", array_to_vector(F.col(vec)))


def kmeans(df: DataFrame, k: int, seeds=(1,), id_col="id", vec="vec", max_iter: int = 20):
    """K-means (k-means|| init); the best of several seeds by cost.
    Returns ``(model, assignments(id, cluster))``."""
    from pyspark.ml.clustering import KMeans
    data = _vectorised(df, vec).cache()
    best = None
    for s in seeds:
        m = KMeans(k=k, seed=s, maxIter=max_iter, featuresCol="features").fit(data)
        cost = m.summary.trainingCost
        if best is None or cost < best[0]:
            best = (cost, m)
    model = best[1]
    out = model.transform(data).select(id_col, F.col("prediction").alias("cluster"))
    return model, out


def elbow(df: DataFrame, ks, seed: int = 1, id_col="id", vec="vec") -> DataFrame:
    """C4: k -> inertia (within SS) and mean distortion (mean distance to
    the nearest centre) for every k."""
    spark = df.sparkSession
    rows = []
    for k in ks:
        model, _ = kmeans(df, k, (seed,), id_col, vec)
        cen = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in
                                     enumerate(model.clusterCenters())],
                                    "cluster int, centre array<double>")
        d = distortion(assign(df, cen, id_col, vec)).withColumn("k", F.lit(k))
        rows.append(d)
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select("k", "inertia", "distortion")


def bisecting(df: DataFrame, k: int, metric: str = "euclidean", seed: int = 1,
              id_col="id", vec="vec") -> DataFrame:
    """C8 (re-aimed hierarchical clustering): bisecting k-means."""
    from pyspark.ml.clustering import BisectingKMeans
    data = _vectorised(df, vec)
    m = BisectingKMeans(k=k, seed=seed, distanceMeasure=metric, featuresCol="features").fit(data)
    return m.transform(data).select(id_col, F.col("prediction").alias("cluster"))


def silhouette_cosine(assigned: DataFrame, vec="vec", cluster="cluster") -> float:
    """C5 at scale for the cosine metric (Spark's evaluator, linear time)."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    ev = ClusteringEvaluator(featuresCol="features", predictionCol=cluster,
                             distanceMeasure="cosine")
    return ev.evaluate(_vectorised(assigned, vec))


# ---------------------------------------------------------------- single linkage

def _components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components ``(id, comp)`` over an undirected edge list
    ``(u, v)``, named by the least id.  Each round a node and its parent take the
    least grandparent around the node, so trees halve in depth and chains of any
    length take a logarithm of rounds."""
    from tessera.session import cut_lineage
    adj = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"),
                                                          F.col("u").alias("v")))
    adj = cut_lineage(adj)
    lab = cut_lineage(nodes.select("id", F.col("id").alias("comp")))
    while True:
        up = cut_lineage(lab.join(lab.select(F.col("id").alias("comp"), F.col("comp").alias("up")), "comp"))
        m = (adj.join(up.select(F.col("id").alias("v"), F.col("up").alias("cv")), "v")
             .groupBy(F.col("u").alias("id")).agg(F.min("cv").alias("m")))
        near = cut_lineage(up.join(m, "id", "left").select("id", "comp", F.least("up", F.coalesce("m", "up")).alias("m")))
        hook = near.groupBy(F.col("comp").alias("id")).agg(F.min("m").alias("h"))
        least = F.least("comp", "m", F.coalesce("h", "comp"))
        new = cut_lineage(near.join(hook, "id", "left").select("id", least.alias("comp"), (least < F.col("comp")).alias("chg")))
        done = new.filter("chg").isEmpty()
        lab = new.select("id", "comp")
        if done:
            break
    return lab


def _merged(picked: DataFrame) -> DataFrame:
    """``(comp, nc)``: the components that components ``u`` join by the edge each
    picked to ``v``.  The picks form trees whose roots picked each other, so
    following them from both ends of a step takes a logarithm of rounds."""
    from tessera.session import cut_lineage
    back = picked.select(F.col("u").alias("v"), F.col("v").alias("back"))
    to = cut_lineage(picked.select("u", "v").join(back, "v").select(
        F.col("u").alias("comp"), F.when((F.col("back") == F.col("u")) & (F.col("u") < F.col("v")), F.col("u")).otherwise(
            F.col("v")).alias("nc")))
    while True:
        new = cut_lineage(to.join(to.select(F.col("comp").alias("nc"), F.col("nc").alias("up")), "nc").select(
            "comp", F.col("up").alias("nc"), (F.col("up") != F.col("nc")).alias("chg")))
        done = new.filter("chg").isEmpty()
        to = new.select("comp", "nc")
        if done:
            return to


def _forest(i: np.ndarray, j: np.ndarray, d: np.ndarray, null: np.ndarray):
    """Minimum spanning forest of edges in the order (d, i, j), a null d first:
    which edges are in it, the nodes, and their components."""
    order = np.lexsort((j, i, d, ~null))
    nodes, ends = np.unique(np.concatenate((i[order], j[order])), return_inverse=True)
    u, v = ends.reshape(2, -1)
    comp, left, chosen = np.arange(len(nodes)), np.arange(len(order)), np.zeros(len(order), bool)
    while True:
        left = left[comp[u[left]] != comp[v[left]]]
        if not len(left):
            break
        best = np.full(len(nodes), len(order))
        np.minimum.at(best, comp[u[left]], left)
        np.minimum.at(best, comp[v[left]], left)
        roots = np.flatnonzero(best < len(order))
        edge = best[roots]
        chosen[edge] = True
        # each root points to the component at the other end of its edge; of two that chose the same edge the smaller stays
        to = np.arange(len(nodes))
        to[roots] = np.where(comp[u[edge]] == roots, comp[v[edge]], comp[u[edge]])
        mutual = (to[to] == np.arange(len(nodes))) & (np.arange(len(nodes)) < to)
        to[mutual] = np.flatnonzero(mutual)
        while (to[to] != to).any():
            to = to[to]
        comp = to[comp]
    return order[chosen], nodes, comp


def lightest(pairs: DataFrame, edges: int = EDGES) -> DataFrame:
    """Of ``(i, j, d)``, ``i <= j``, the edges that a minimum spanning forest in the
    order (d, i, j) can have: each task keeps the forest of the pairs it finds, as
    an edge outside of it is the last of a cycle.  So the rows left are in
    proportion to the nodes, not to the pairs.  A pair of a node with itself stays."""
    schema = pairs.select("i", "j", "d").schema

    def run(batches):
        shape, held, rows = None, [], 0
        nodes = comp = most = None
        selfs = None

        def reduced():
            nonlocal nodes, comp, most
            i, j, d, null = (np.concatenate(c) for c in zip(*held))
            at, nodes, comp = _forest(i, j, d, null)
            i, j, d, null = i[at], j[at], d[at], null[at]
            most = np.full(len(nodes), -np.inf)
            np.maximum.at(most, comp[nodes.searchsorted(i)], np.where(null, -np.inf, d))
            return [(i, j, d, null)]

        for b in batches:
            shape = b.schema
            i, j = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            null = b.column(2).is_null().to_numpy(zero_copy_only=False)
            d = b.column(2).cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
            loop = i == j
            if loop.any():
                own = pa.Table.from_batches([b.filter(pa.array(loop))])
                selfs = (own if selfs is None else pa.concat_tables([selfs, own])).group_by(["i", "j"]).aggregate(
                    [("d", "min")]).rename_columns(["i", "j", "d"]).select(["i", "j", "d"])
            keep = ~loop
            if nodes is not None:       # longer than all edges of the component it lies in
                x, y = (np.minimum(nodes.searchsorted(e), len(nodes) - 1) for e in (i, j))
                keep &= ~((nodes[x] == i) & (nodes[y] == j) & (comp[x] == comp[y]) & (d > most[comp[x]]) & ~null)
            held.append((i[keep], j[keep], d[keep], null[keep]))
            rows += int(keep.sum())
            if rows > edges:
                held[:] = reduced()
                rows = 0
        if held and sum(len(h[0]) for h in held):
            i, j, d, null = reduced()[0]
            yield pa.RecordBatch.from_arrays([pa.array(i, shape.field(0).type), pa.array(j, shape.field(1).type),
                                              pa.array(d, pa.float64(), mask=null).cast(shape.field(2).type)], schema=shape)
        if selfs is not None:
            yield from selfs.cast(shape).to_batches()

    return pairs.select("i", "j", "d").mapInArrow(run, schema)


def minimum_spanning_tree(pairs: DataFrame) -> DataFrame:
    """Boruvka: every component picks its lightest outgoing edge (ties by
    the node ids), the picked edges join components; O(log n) rounds.
    ``pairs`` = ``(i, j, d)``; returns the tree edges ``(i, j, d)``.  Only the
    ``lightest`` pairs are written."""
    from tessera.session import cut_lineage
    e = cut_lineage(lightest(pairs.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"),
                                          "d").filter(F.col("i") != F.col("j"))))
    both = cut_lineage(e.select(F.col("i").alias("u"), F.col("j").alias("v"), "d", "i", "j")
                       .unionByName(e.select(F.col("j").alias("u"), F.col("i").alias("v"),
                                             "d", "i", "j")))
    nodes = both.select(F.col("u").alias("id")).distinct()
    comp = cut_lineage(nodes.select("id", F.col("id").alias("comp")))
    tree = None
    while True:
        ec = (both.join(comp.select(F.col("id").alias("u"), F.col("comp").alias("cu")), "u")
              .join(comp.select(F.col("id").alias("v"), F.col("comp").alias("cv")), "v")
              .filter(F.col("cu") != F.col("cv")))
        best = ec.groupBy("cu").agg(F.min(F.struct("d", "i", "j", "cv")).alias("b"))
        picked = cut_lineage(best.select(F.col("b.i").alias("i"), F.col("b.j").alias("j"),
                                         F.col("b.d").alias("d"), F.col("cu").alias("u"),
                                         F.col("b.cv").alias("v")))
        if picked.isEmpty():
            break
        new_edges = picked.select("i", "j", "d").distinct()
        tree = new_edges if tree is None else tree.unionByName(new_edges)
        comp = cut_lineage(comp.join(_merged(picked), "comp").select("id", F.col("nc").alias("comp")))
    return e.limit(0) if tree is None else tree


def single_linkage(pairs: DataFrame, k: int | None = None):
    """Single-linkage merge heights (= sorted MST edge weights) as
    ``(step, height)``; with ``k``, also the flat clusters ``(id, cluster)``
    obtained by removing the k-1 heaviest tree edges."""
    from tessera.operators.relational import dense_index
    from tessera.session import cut_lineage
    tiled = vars(pairs).get("_tiles")
    pairs = cut_lineage(lightest(tiled.forest() if tiled else pairs.select(
        F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "d")))
    tree = minimum_spanning_tree(pairs)
    heights = dense_index(tree, ["d", "i", "j"], "step").select(
        (F.col("step") + 1).alias("step"), F.col("d").alias("height"), "i", "j")
    if k is None:
        return heights.select("step", "height"), None
    n_edges = heights.count()
    keep = heights.filter(F.col("step") <= n_edges - (k - 1))
    nodes = (pairs.select(F.col("i").alias("id")).unionByName(pairs.select(F.col("j").alias("id")))
             .distinct())
    lab = _components(nodes, keep.select(F.col("i").alias("u"), F.col("j").alias("v")))
    return heights.select("step", "height"), lab.withColumnRenamed("comp", "cluster")


def linkage_knee(heights: DataFrame) -> DataFrame:
    """Second difference of the merge heights from the top
    (``h[r] - 2 h[r+1] + h[r+2]`` with r = 1 for the last merge); the best
    number of clusters is ``argmax + 2``, the second best the next maximum."""
    # r = 1 for the last merge; neighbours by equi-joins on the position
    n = heights.agg(F.max("step").alias("_n"))
    h = attach_row(heights, n).select((F.col("_n") - F.col("step") + 1).alias("r"), "height")
    h1 = h.select((F.col("r") - 1).alias("r"), F.col("height").alias("h1"))
    h2 = h.select((F.col("r") - 2).alias("r"), F.col("height").alias("h2"))
    d = h.join(h1, "r").join(h2, "r").select(
        "r", (F.col("height") - 2 * F.col("h1") + F.col("h2")).alias("knee"))
    best = d.orderBy(F.desc("knee"), F.asc("r")).limit(2)   # top-2 report
    w = Window.orderBy(F.desc("knee"), F.asc("r"))          # over the 2 rows kept
    return best.select(F.row_number().over(w).alias("choice"), (F.col("r") + 1).alias("k"),
                       "knee")


def gap_statistic(df: DataFrame, ks, b: int = 3, seed: int = 1, id_col="id", vec="vec",
                  se_factor: float = 1.0) -> DataFrame:
    """Gap statistic.  ``log W_k`` is the k-means within sum of squares
    of the data; reference sets (as many rows as the data) are uniform in
    each column's [min, max] (seeded ``rand`` per column, generated on the
    executors); ``gap = E[log W*] - log W``, ``se = sd * sqrt(1 + 1/B)``.
    Returns ``(k, logw, e_logw, gap, se, firstmax, tibs2001)`` where the two
    last columns flag the chosen k of each rule."""
    import math
    spark = df.sparkSession
    ranges = (df.select(F.posexplode(vec).alias("i", "v")).groupBy("i")
              .agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("i").collect())
    rows = []
    for k in ks:
        model, _ = kmeans(df, k, (seed,), id_col, vec)
        logw = math.log(model.summary.trainingCost)
        refs = []
        for r in range(b):
            ref = df.select(F.col(id_col), F.array(*[
                (F.lit(x.lo) + F.lit(x.hi - x.lo) * F.rand(seed * 100003 + r * 1009 + x.i))
                for x in ranges]).alias(vec))
            m, _ = kmeans(ref, k, (seed,), id_col, vec)
            refs.append(math.log(m.summary.trainingCost))
        e = sum(refs) / b
        sd = math.sqrt(sum((x - e) ** 2 for x in refs) / b)
        rows.append((int(k), logw, e, e - logw, sd * math.sqrt(1 + 1.0 / b)))
    t = spark.createDataFrame(rows, "k int, logw double, e_logw double, gap double, se double")
    w = Window.orderBy("k")
    nxt_gap, nxt_se = F.lead("gap").over(w), F.lead("se").over(w)
    t = t.withColumn("_tibs", nxt_gap.isNull() | (F.col("gap") >= nxt_gap - se_factor * nxt_se))
    t = t.withColumn("_fm", nxt_gap.isNull() | (F.col("gap") >= nxt_gap))
    first_t = t.filter("_tibs").agg(F.min("k").alias("_kt"))
    first_m = t.filter("_fm").agg(F.min("k").alias("_km"))
    out = t.crossJoin(first_t).crossJoin(first_m)
    return out.select("k", "logw", "e_logw", "gap", "se",
                      (F.col("k") == F.col("_km")).alias("firstmax"),
                      (F.col("k") == F.col("_kt")).alias("tibs2001"))
