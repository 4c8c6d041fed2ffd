"""Graph operators on edge-list DataFrames (G1--G21).

Undirected graphs are stored once per edge in canonical form ``src < dst``;
``both_ways`` gives the symmetric adjacency.  Iterative operators (core
numbers, BFS, eigenvector centrality, PageRank) run one Spark job per round
and cut lineage with a reliable checkpoint each round, so a lost executor
only costs the current round.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.relational import attach_row
from tessera.session import cut_lineage


def graph_from(df: DataFrame, src: str, dst: str, attrs=()) -> DataFrame:
    """G1: directed edge list from two columns; duplicates collapse (the
    attribute values of the greatest row win, deterministically)."""
    e = df.select(F.col(src).alias("src"), F.col(dst).alias("dst"), *attrs).dropna(
        subset=["src", "dst"])
    if not attrs:
        return e.distinct()
    return e.groupBy("src", "dst").agg(*[F.max(a).alias(a) for a in attrs])


def canonical(edges: DataFrame) -> DataFrame:
    """Undirected form: one row per edge with ``src <= dst``."""
    return edges.select(F.least("src", "dst").alias("src"),
                        F.greatest("src", "dst").alias("dst")).distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    """Symmetric adjacency ``(a, b)`` of an undirected edge list."""
    e = edges.select(F.explode(F.array(F.struct(F.col("src").alias("a"), F.col("dst").alias("b")),
                                       F.struct(F.col("dst").alias("a"), F.col("src").alias("b"))))
                     .alias("p"))
    return e.select("p.a", "p.b")


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def degrees(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Degree (a self-loop counts twice) and degree centrality
    ``deg / (n - 1)``; isolated nodes from ``nodes`` get degree 0."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    deg = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    if nodes is not None:
        deg = (nodes.select("id").distinct().join(deg, "id", "left")
               .fillna(0, ["degree"]))
    n = deg.agg(F.count(F.lit(1)).alias("_n"))
    return attach_row(deg, n).select(
        "id", "degree", F.coalesce(F.try_divide("degree", F.col("_n") - 1), F.lit(0.0)).alias("centrality"))


def degree_histogram(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Number of nodes per degree 0..max (zero counts included)."""
    d = degrees(edges, nodes)
    counts = d.groupBy("degree").agg(F.count(F.lit(1)).alias("n"))
    mx = d.agg(F.max("degree").alias("_mx"))
    grid = mx.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_mx"))).alias("degree"))
    return grid.join(counts, "degree", "left").fillna(0, ["n"])


def graph_stats(edges: DataFrame) -> DataFrame:
    """Order, size, edges per node, mean degree and density."""
    n = nodes_of(edges).agg(F.count(F.lit(1)).alias("n"))
    m = edges.agg(F.count(F.lit(1)).alias("m"))
    j = n.crossJoin(m)
    return j.select("n", "m", F.try_divide("m", "n").alias("m_per_n"),
                    F.try_divide(2 * F.col("m"), F.col("n")).alias("avg_degree"),
                    F.try_divide(2 * F.col("m"), F.col("n") * (F.col("n") - 1)).alias("density"))


def _oriented(edges: DataFrame) -> DataFrame:
    """Orient every undirected edge from lower to higher (degree, id); each
    node then has O(sqrt(m)) out-neighbours."""
    d = degrees(edges).select("id", "degree")
    e = canonical(edges).filter(F.col("src") != F.col("dst"))
    e = (e.join(d.select(F.col("id").alias("src"), F.col("degree").alias("ds")), "src")
         .join(d.select(F.col("id").alias("dst"), F.col("degree").alias("dd")), "dst"))
    low_first = (F.col("ds") < F.col("dd")) | ((F.col("ds") == F.col("dd"))
                                               & (F.col("src") < F.col("dst")))
    return e.select(F.when(low_first, F.col("src")).otherwise(F.col("dst")).alias("u"),
                    F.when(low_first, F.col("dst")).otherwise(F.col("src")).alias("v"))


def triangles(edges: DataFrame) -> DataFrame:
    """All triangles ``(a, b, c)`` with ``a < b < c``, found by closing wedges
    of the degree-ordered orientation (O(m^1.5) wedges in total)."""
    o = _oriented(edges)
    w = (o.alias("x").join(o.alias("y"), (F.col("x.u") == F.col("y.u"))
                           & (F.col("x.v") < F.col("y.v")))
         .select(F.col("x.u").alias("p"), F.col("x.v").alias("q"), F.col("y.v").alias("r")))
    closed = w.join(canonical(edges).select(F.col("src").alias("q2"), F.col("dst").alias("r2")),
                    (F.least("q", "r") == F.col("q2")) & (F.greatest("q", "r") == F.col("r2")),
                    "left_semi")
    arr = F.array_sort(F.array("p", "q", "r"))
    return closed.select(arr[0].alias("a"), arr[1].alias("b"), arr[2].alias("c"))


def clustering(edges: DataFrame) -> DataFrame:
    """Per node triangles and local clustering ``2T / (d (d - 1))``
    (0 for degree < 2)."""
    t = triangles(edges)
    per = (t.select(F.explode(F.array("a", "b", "c")).alias("id"))
           .groupBy("id").agg(F.count(F.lit(1)).alias("triangles")))
    d = degrees(canonical(edges).filter(F.col("src") != F.col("dst"))).select("id", "degree")
    j = d.join(per, "id", "left").fillna(0, ["triangles"])
    coeff = F.when(F.col("degree") > 1, 2.0 * F.col("triangles")
                   / (F.col("degree") * (F.col("degree") - 1))).otherwise(0.0)
    return j.select("id", "degree", "triangles", coeff.alias("coeff"))


def clustering_summary(edges: DataFrame) -> DataFrame:
    """Average clustering and transitivity ``3 triangles / connected triples``."""
    c = clustering(edges)
    return c.agg(F.avg("coeff").alias("avg_clustering"),
                 F.try_divide(F.sum("triangles"), F.sum(F.col("degree") * (F.col("degree") - 1) / 2))
                 .alias("transitivity"),
                 (F.sum("triangles") / 3).cast("bigint").alias("n_triangles"))


def k_core(edges: DataFrame, k: int) -> DataFrame:
    """Edges of the k-core, by repeated removal of nodes with degree < k."""
    e = cut_lineage(canonical(edges).filter(F.col("src") != F.col("dst")))
    while True:
        d = degrees(e).filter(F.col("degree") < k).select("id")
        if d.isEmpty():
            break
        e = (e.join(d.withColumnRenamed("id", "src"), "src", "left_anti")
             .join(d.withColumnRenamed("id", "dst"), "dst", "left_anti").select("src", "dst"))
        e = cut_lineage(e)
    return e


def core_numbers(edges: DataFrame) -> DataFrame:
    """Core number of every node by h-index iteration (Lu et al. 2016):
    start from the degree and replace each value by the h-index of the
    neighbours' values until nothing changes.

    The h-index of a node reads only (value, multiplicity) pairs of its
    neighbours, so a hub sends a partially aggregated histogram, never its
    raw adjacency, to one task."""
    e = canonical(edges).filter(F.col("src") != F.col("dst"))
    adj = cut_lineage(both_ways(e))
    c = cut_lineage(degrees(e).select("id", F.col("degree").alias("c")))
    while True:
        # merged, not broadcast: values of all nodes would go to the driver in each round
        hist = (adj.join(c.select(F.col("id").alias("b"), F.col("c").alias("cb")).hint("merge"), "b")
                .groupBy(F.col("a").alias("id"), "cb").agg(F.count(F.lit(1)).alias("m")))
        w = (Window.partitionBy("id").orderBy(F.desc("cb"))
             .rowsBetween(Window.unboundedPreceding, 0))
        h = (hist.withColumn("atleast", F.sum("m").over(w))
             .groupBy("id").agg(F.max(F.least("cb", "atleast")).alias("h")))
        nxt = cut_lineage(c.join(h.hint("merge"), "id").select("id", F.least("c", "h").alias("c"),
                                                 (F.col("h") < F.col("c")).alias("chg")))
        changed = not nxt.filter("chg").isEmpty()
        c = nxt.select("id", "c")
        if not changed:
            break
    return c.withColumnRenamed("c", "core")


#: Words of 64 sources in a row of ``shortest_paths``.
WORDS = 16


def shortest_paths(edges: DataFrame, sources: DataFrame | None = None,
                   max_hops: int | None = None) -> DataFrame:
    """BFS hop distances ``(source, id, dist)`` from every source node
    (all nodes by default), one frontier join + anti-join per level.

    The sources that reach a node are bits.  A task walks the graph for a share of
    the sources (``tessera.operators.paths``), and ``closeness`` and ``distance_summary`` then have
    the rows counted where they are found.  Where a graph is too large for a task, a node has a row for each
    ``64 * WORDS`` sources, and a level unites its neighbours' rows.  A row for each source is
    only made of the result, where it is read."""
    from tessera.operators import paths as P
    from tessera.operators.relational import dense_index
    e = cut_lineage(canonical(edges).filter(F.col("src") != F.col("dst")))
    nodes = cut_lineage(nodes_of(edges))
    src = cut_lineage((sources if sources is not None else nodes).select(F.col("id").alias("source")).distinct())
    ids = src.select(F.col("source").alias("id"))
    every = cut_lineage(nodes.unionByName(ids).distinct()) if sources is not None else nodes
    if P.fits(e, every):
        graph = P.Packed(e, every)
        out = P.paths(graph, ids, max_hops)
        out._counts = functools.cache(lambda: cut_lineage(P.counts(graph, ids, max_hops)))
        return out
    adj = cut_lineage(both_ways(e))
    num = cut_lineage(dense_index(src, ["source"], "k").select("source", F.col("k").cast("long").alias("k")))
    room, bits = 64 * WORDS, [f"b{j}" for j in range(WORDS)]
    chunk = F.expr(f"k div {room}").alias("chunk")
    names = num.groupBy(chunk).agg(F.array_sort(F.collect_list(F.struct("k", "source"))).alias("s")).select("chunk", F.col("s.source").alias("names"))
    state = cut_lineage(num.select(F.col("source").alias("id"), chunk, *[
        F.expr(f"IF(k % {room} div 64 = {j}, shiftleft(1L, CAST(k % 64 AS INT)), 0L)").alias(b) for j, b in enumerate(bits)]))
    seen, frontier, levels, level = state, state, [state.withColumn("dist", F.lit(0))], 0
    while max_hops is None or level < max_hops:
        level += 1
        around = (frontier.join(adj, frontier.id == adj.a).groupBy(F.col("b").alias("id"), "chunk")
                  .agg(*[F.bit_or(b).alias(b) for b in bits]))
        old = seen.select("id", "chunk", *[F.col(b).alias(f"o_{b}") for b in bits])
        new = around.join(old, ["id", "chunk"], "left").select("id", "chunk", *[
            F.col(b).bitwiseAND(F.bitwise_not(F.coalesce(f"o_{b}", F.lit(0).cast("long")))).alias(b) for b in bits])
        frontier = cut_lineage(new.filter(functools.reduce(lambda x, y: x | y, [F.col(b) != 0 for b in bits])))
        if frontier.isEmpty():
            break
        levels.append(frontier.withColumn("dist", F.lit(level)))
        seen = cut_lineage(seen.unionByName(frontier).groupBy("id", "chunk").agg(*[F.bit_or(b).alias(b) for b in bits]))
    return (functools.reduce(DataFrame.unionByName, levels).join(names, "chunk")
            .select("id", "dist", "names", F.posexplode(F.array(*bits)).alias("word", "bits")).filter("bits <> 0")
            .select("id", "dist", F.explode(F.expr(
                "transform(filter(sequence(0, 63), x -> (shiftrightunsigned(bits, x) & 1) = 1), x -> names[word * 64 + x])"
            )).alias("source")).select("source", "id", "dist"))


def _counted(paths: DataFrame) -> DataFrame:
    """``(source, dist, n)``: nodes at each distance from each source."""
    own = vars(paths).get("_counts")
    return own() if own else paths.groupBy("source", "dist").agg(F.count(F.lit(1)).alias("n"))


def eccentricity(paths: DataFrame) -> DataFrame:
    """Eccentricity per node (within its component)."""
    return _counted(paths).groupBy(F.col("source").alias("id")).agg(F.max("dist").alias("ecc"))


def distance_summary(paths: DataFrame) -> DataFrame:
    """Diameter, radius, numbers of centre and periphery nodes, and the
    average shortest-path length over reachable ordered pairs."""
    ecc = eccentricity(paths)
    agg = ecc.agg(F.max("ecc").alias("diameter"), F.min("ecc").alias("radius"))
    j = attach_row(ecc, agg)
    s = j.agg(F.first("diameter").alias("diameter"), F.first("radius").alias("radius"),
              F.sum((F.col("ecc") == F.col("radius")).cast("int")).alias("n_center"),
              F.sum((F.col("ecc") == F.col("diameter")).cast("int")).alias("n_periphery"))
    avg = _counted(paths).filter(F.col("dist") > 0).agg(
        F.try_divide(F.sum(F.col("dist") * F.col("n")), F.sum("n")).alias("avg_path_length"))
    return s.crossJoin(avg)


def closeness(paths: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Closeness ``(r-1)/sum d * (r-1)/(n-1)`` of every source, with r =
    reachable nodes (incl. itself) and n = rows of ``nodes`` (the sources if
    not given); 0 for an isolated node or a single one."""
    per = _counted(paths).groupBy(F.col("source").alias("id")).agg(
        F.sum("n").alias("r"), F.sum(F.col("dist") * F.col("n")).alias("tot"))
    n = (per if nodes is None else nodes).agg(F.count(F.lit(1)).alias("_n"))
    c = F.coalesce(F.try_divide(F.col("r") - 1, F.col("tot"))
                   * F.try_divide(F.col("r") - 1, F.col("_n") - 1), F.lit(0.0))
    return attach_row(per, n).select("id", c.alias("closeness"))


def eigenvector(edges: DataFrame, max_iter: int = 100, tol: float = 1e-6) -> DataFrame:
    """Eigenvector centrality by power iteration on ``A + I`` with L2
    normalisation; stops when the L1 change is below ``n * tol``."""
    adj = cut_lineage(both_ways(canonical(edges)).filter(F.col("a") != F.col("b")))
    nodes = nodes_of(edges)
    n = nodes.count()
    x = cut_lineage(nodes.select("id", F.lit(1.0 / max(n, 1)).alias("x")))
    for _ in range(max_iter):
        s = (adj.join(x.select(F.col("id").alias("b"), "x"), "b")
             .groupBy(F.col("a").alias("id")).agg(F.sum("x").alias("s")))
        y = x.join(s, "id", "left").select("id", (F.col("x") + F.coalesce("s", F.lit(0.0)))
                                           .alias("y"), F.col("x").alias("x_prev"))
        norm = y.agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("_nrm"))
        nxt = cut_lineage(attach_row(y, norm).select(
            "id", (F.col("y") / F.col("_nrm")).alias("x"), "x_prev"))
        err = nxt.agg(F.sum(F.abs(F.col("x") - F.col("x_prev")))).first()[0]
        x = nxt.select("id", "x")
        if err is None or err < n * tol:
            break
    else:
        raise RuntimeError(f"no convergence in {max_iter} iterations")
    return x.withColumnRenamed("x", "eigenvector")


def pagerank(edges: DataFrame, graph_id: str | None = None, weight: str | None = None,
             alpha: float = 0.85, max_iter: int = 100, tol: float = 1e-6,
             directed: bool = False) -> DataFrame:
    """Weighted PageRank of many graphs at once (keyed by ``graph_id``).

    Undirected edges count in both directions; out-weights are normalised
    per node, dangling mass and teleport are spread uniformly in the
    node's graph.  Each graph stops once its L1 change is below
    ``n * tol`` and is frozen from then on.
    """
    g = [graph_id] if graph_id else []
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    e = edges.select(*g, "src", "dst", w.alias("w"))
    if not directed:
        e = e.unionByName(e.select(*g, F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
                          .filter(F.col("src") != F.col("dst")))
    nodes = (e.select(*g, F.col("src").alias("id")).unionByName(e.select(*g, F.col("dst")
                                                                         .alias("id"))).distinct())
    outw = e.groupBy(*g, F.col("src").alias("id")).agg(F.sum("w").alias("wo"))
    n = nodes.groupBy(*g).agg(F.count(F.lit(1)).cast("double").alias("n")) if g else \
        nodes.agg(F.count(F.lit(1)).cast("double").alias("n"))
    base = (nodes.join(outw, g + ["id"], "left") if g else nodes.join(outw, "id", "left"))
    base = base.join(n, g) if g else base.crossJoin(n)
    st = cut_lineage(base.select(*g, "id", "n", F.coalesce("wo", F.lit(0.0)).alias("wo"),
                                 (1.0 / F.col("n")).alias("x")))
    en = cut_lineage(e.join(outw.withColumnRenamed("id", "src"), g + ["src"])
                     .select(*g, "src", "dst", (F.col("w") / F.col("wo")).alias("p"))
                     .filter(F.col("p") > 0))
    done_parts = []
    active = st
    for _ in range(max_iter):
        inflow = (en.join(active.select(*g, F.col("id").alias("src"), "x"), g + ["src"])
                  .groupBy(*g, F.col("dst").alias("id")).agg(F.sum(F.col("p") * F.col("x"))
                                                              .alias("inflow")))
        dang = active.groupBy(*g).agg(F.sum(F.when(F.col("wo") <= 0, F.col("x"))
                                            .otherwise(0.0)).alias("dm")) if g else \
            active.agg(F.sum(F.when(F.col("wo") <= 0, F.col("x")).otherwise(0.0)).alias("dm"))
        j = active.join(inflow, g + ["id"], "left")
        j = j.join(dang, g) if g else j.crossJoin(dang)
        x_new = (F.lit(alpha) * (F.coalesce("inflow", F.lit(0.0)) + F.col("dm") / F.col("n"))
                 + F.lit(1 - alpha) / F.col("n"))
        nxt = cut_lineage(j.select(*g, "id", "n", "wo", x_new.alias("x"),
                                   F.col("x").alias("x_prev")))
        if not g:  # one graph: a single one-row aggregate decides
            e = nxt.agg(F.sum(F.abs(F.col("x") - F.col("x_prev"))).alias("e"),
                        F.max("n").alias("n")).first()
            active = nxt.drop("x_prev")
            if e["e"] is None or e["e"] < e["n"] * tol:
                break
            continue
        err = (nxt.groupBy(*g).agg((F.sum(F.abs(F.col("x") - F.col("x_prev")))
                                    < F.max("n") * tol).alias("done")) if g else
               nxt.agg((F.sum(F.abs(F.col("x") - F.col("x_prev"))) < F.max("n") * tol)
                       .alias("done")))
        nxt = cut_lineage((nxt.join(err, g) if g else nxt.crossJoin(err)).drop("x_prev"))
        done_parts.append(nxt.filter("done").drop("done"))
        active = nxt.filter(~F.col("done")).drop("done")
        if active.isEmpty():
            break
    else:
        raise RuntimeError(f"no convergence in {max_iter} iterations")
    out = active
    for d in done_parts:
        out = out.unionByName(d)
    return out.select(*g, "id", F.col("x").alias("rank"))


def k_cliques(edges: DataFrame, k: int) -> DataFrame:
    """All k-cliques as sorted node arrays, grown level by level on the
    degree-ordered orientation (each clique found once).

    A clique goes with the nodes that can follow it: common out-neighbours of its
    nodes, by rank.  To take one in, those after it are sent to that node and held
    against its out-neighbours: an array a (clique, node), never a row or a
    check for each node of it."""
    e = _oriented(edges)
    if k == 2:
        return e.select(F.array_sort(F.array("u", "v")).alias("nodes"))
    ranked = e.join(degrees(edges).select(F.col("id").alias("v"), "degree"), "v")
    out = cut_lineage(ranked.groupBy("u").agg(F.array_sort(F.collect_list(F.struct("degree", "v"))).alias("r"))
                      .select("u", F.col("r.v").alias("outs")))
    cl = out.select(F.array("u").alias("nodes"), F.col("outs").alias("next"))
    last = out.select(F.col("u").alias("node"), "outs")
    for size in range(1, k - 1):
        grown = cl.select("nodes", "next", F.posexplode("next").alias("at", "node")).select(
            "nodes", "node", F.slice("next", F.col("at") + 2, F.size("next")).alias("next")).filter(
            F.size("next") >= k - size - 1).join(last, "node")
        cl = cut_lineage(grown.select(F.concat("nodes", F.array("node")).alias("nodes"),
                                      F.array_intersect("next", "outs").alias("next")).filter(F.size("next") >= k - size - 1))
    return cl.select("nodes", F.explode("next").alias("node")).select(
        F.array_sort(F.concat("nodes", F.array("node"))).alias("nodes"))


def maximal_cliques(edges: DataFrame, max_size: int = 32, min_size: int = 2) -> DataFrame:
    """All maximal cliques ``(nodes, size)``, sorted node arrays.

    Cliques grow by a level a round, each once, by nodes greater than its last
    one; a table of all common neighbours of each clique says which have none and
    so are maximal.  With ``min_size`` the search runs inside the core of nodes with
    that many neighbours, where larger cliques lie.  Raises if there are cliques of
    more than ``max_size`` nodes."""
    e = cut_lineage(canonical(edges).filter(F.col("src") != F.col("dst")))
    if min_size > 2:
        e = k_core(e, min_size - 1)
    adj = cut_lineage(both_ways(e))
    cliques = e.select(F.array("src", "dst").alias("nodes"))
    # common neighbours of an edge are the third nodes of its triangles
    tri = cut_lineage(triangles(e))
    common = cut_lineage(tri.select(F.array("a", "b").alias("nodes"), F.col("c").alias("x")).unionByName(
        tri.select(F.array("a", "c").alias("nodes"), F.col("b").alias("x"))).unionByName(
        tri.select(F.array("b", "c").alias("nodes"), F.col("a").alias("x"))))
    out, size = None, 2
    while True:
        own = cliques.join(common.select("nodes").distinct(), "nodes", "left_anti").select("nodes", F.lit(size).alias("size"))
        if size >= min_size:
            out = own if out is None else out.unionByName(own)
        grown = common.filter(F.col("x") > F.element_at("nodes", -1))
        if grown.isEmpty():
            return cut_lineage(out) if out is not None else cliques.limit(0).select("nodes", F.lit(0).alias("size"))
        if size == max_size:
            raise RuntimeError(f"there are cliques of more than {max_size} nodes")
        size += 1
        longer = F.concat("nodes", F.array("x"))
        # a common neighbour of the clique stays one of the larger clique if it knows the new node
        common = cut_lineage(grown.join(common.withColumnRenamed("x", "y"), "nodes").filter(F.col("x") != F.col("y"))
                             .join(adj.select(F.col("a").alias("x"), F.col("b").alias("y")), ["x", "y"], "left_semi")
                             .select(longer.alias("nodes"), F.col("y").alias("x")))
        cliques = cut_lineage(grown.select(longer.alias("nodes")))


def clique_summary(cliques: DataFrame) -> DataFrame:
    """Clique number, number of maximal cliques, and how many reach it."""
    largest = cliques.agg(F.max("size").alias("_m"))
    return attach_row(cliques, largest).agg(F.max("size").alias("clique_number"), F.count(F.lit(1)).alias("n_maximal"),
                                            F.sum((F.col("size") == F.col("_m")).cast("bigint")).alias("n_maximum"))


def reach(edges: DataFrame, lg_k: int = 10, max_hops: int = 100) -> DataFrame:
    """G7, G8, G9 for every node at once: ``(id, hop, n)``, an approximation of
    the number of nodes within ``hop`` steps of each node, itself included.

    Each node has a HyperLogLog sketch of the nodes it reaches (2 ** lg_k
    registers, relative error about 1.04 / sqrt(2 ** lg_k)); a hop unites it with
    its neighbours' sketches, so a hub only receives partial unions, and neither a
    (source, node) row nor a sketch for each edge exists (``tessera.operators.reach``).  A node has a row for each hop at which its sketch
    still grew, so its last hop is a lower bound of its eccentricity, and within the
    sketches' error the value.  Ends when no sketch grows, raises after ``max_hops``."""
    from tessera.operators import reach as R
    e = cut_lineage(canonical(edges))
    return R.reach(e.filter(F.col("src") != F.col("dst")), nodes_of(e), lg_k, max_hops)


def distance_distribution(reached: DataFrame) -> DataFrame:
    """``(dist, n_pairs)``: ordered pairs of nodes at each distance, from
    ``reach``."""
    w = Window.partitionBy("id").orderBy("hop")
    step = reached.withColumn("new", F.col("n") - F.coalesce(F.lag("n").over(w), F.lit(0)))
    return step.filter("hop > 0").groupBy(F.col("hop").alias("dist")).agg(F.sum("new").alias("n_pairs"))


def reach_metrics(reached: DataFrame) -> DataFrame:
    """``(id, ecc, reachable, closeness)`` of every node, from ``reach``."""
    w = Window.partitionBy("id").orderBy("hop")
    step = reached.withColumn("new", F.col("n") - F.coalesce(F.lag("n").over(w), F.lit(0)))
    per = step.groupBy("id").agg(F.max("hop").alias("ecc"), F.max("n").alias("reachable"), F.sum(F.col("new") * F.col("hop")).alias("tot"))
    n = per.agg(F.count(F.lit(1)).alias("_n"))
    c = F.coalesce(F.try_divide(F.col("reachable") - 1, F.col("tot"))
                   * F.least(F.lit(1.0), F.try_divide(F.col("reachable") - 1, F.col("_n") - 1)), F.lit(0.0))
    return attach_row(per, n).select("id", "ecc", "reachable", c.alias("closeness"))


def four_cycles(edges: DataFrame) -> DataFrame:
    """Number of four-cycles of an undirected graph, one row ``(c4)``.

    Nodes are ranked by degree, then id.  A cycle is counted at its node of highest
    rank: over wedges from it by a node of lower rank to a third of lower rank,
    c wedges between the same two ends are c (c - 1) / 2 cycles.  That is
    O(m ** 1.5) wedges, and a hub is never the middle of one to a higher node."""
    e = cut_lineage(canonical(edges).filter(F.col("src") != F.col("dst")))
    rank = F.struct("degree", "id")
    d = degrees(e).select("id", rank.alias("rank"))
    adj = both_ways(e).join(d.select(F.col("id").alias("a"), F.col("rank").alias("ra")), "a").join(
        d.select(F.col("id").alias("b"), F.col("rank").alias("rb")), "b")
    adj = cut_lineage(adj)
    down = adj.filter(F.col("ra") > F.col("rb")).select(F.col("a").alias("u"), "ra", F.col("b").alias("w"))
    on = adj.select(F.col("a").alias("w"), F.col("b").alias("v"), F.col("rb").alias("rv"))
    pairs = down.join(on, "w").filter(F.col("rv") < F.col("ra")).groupBy("u", "v").agg(F.count(F.lit(1)).alias("c"))
    return pairs.agg(F.coalesce(F.sum(F.col("c") * (F.col("c") - 1) / 2), F.lit(0)).cast("bigint").alias("c4"))


def robins_alexander(edges: DataFrame) -> DataFrame:
    """Bipartite clustering of a whole graph, four times the four-cycles by
    the paths of three edges: ``(c4, l3, coefficient)``; 0 without such paths."""
    e = canonical(edges)
    d = degrees(e).select("id", (F.col("degree") - 1).alias("rest"))
    l3 = (e.join(d.withColumnRenamed("id", "src").withColumnRenamed("rest", "x"), "src")
          .join(d.withColumnRenamed("id", "dst").withColumnRenamed("rest", "y"), "dst")
          .agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0)).alias("l3")))
    return four_cycles(e).crossJoin(l3).select("c4", "l3", F.coalesce(F.try_divide(4.0 * F.col("c4"), F.col("l3")), F.lit(0.0))
                                               .alias("coefficient"))


def bipartite_clustering(edges: DataFrame, max_pairs: int = 10 ** 9) -> DataFrame:
    """Per node the mean over the nodes two steps away of shared neighbours
    by neighbours of either (``(id, clustering)``, 0 without any).

    Needs a row for every pair of nodes with a common neighbour, so the number
    of two-step walks is counted first and ``max_pairs`` of them are allowed."""
    adj = cut_lineage(both_ways(canonical(edges)).filter(F.col("a") != F.col("b")))
    d = cut_lineage(adj.groupBy("a").agg(F.count(F.lit(1)).alias("d")))
    walks = d.agg(F.coalesce(F.sum(F.col("d") * (F.col("d") - 1)), F.lit(0))).first()[0]
    if walks > max_pairs:
        raise RuntimeError(f"{walks} pairs with a common neighbour")
    shared = (adj.alias("x").join(adj.alias("y"), F.col("x.b") == F.col("y.b")).filter(F.col("x.a") != F.col("y.a"))
              .groupBy(F.col("x.a").alias("a"), F.col("y.a").alias("v")).agg(F.count(F.lit(1)).alias("c")))
    part = (shared.join(d, "a").join(d.select(F.col("a").alias("v"), F.col("d").alias("dv")), "v")
            .groupBy("a").agg(F.avg(F.col("c") / (F.col("d") + F.col("dv") - F.col("c"))).alias("cl")))
    return d.select("a").join(part, "a", "left").select(F.col("a").alias("id"), F.coalesce("cl", F.lit(0.0)).alias("clustering"))


def top_nodes(metric: DataFrame, nodes: DataFrame, score: str, n: int = 10) -> DataFrame:
    """Best ``n`` nodes by a metric with their attributes."""
    return metric.orderBy(F.desc(score), F.asc("id")).limit(n).join(nodes, "id", "left")


def bipartite(df: DataFrame, left: str, right: str, weight: str | None = None):
    """Bipartite edge list plus node table tagged with its side."""
    e = df.select(F.col(left).alias("src"), F.col(right).alias("dst"),
                  *([F.col(weight).alias("weight")] if weight else []))
    nodes = (e.select(F.col("src").alias("id"), F.lit(0).alias("side")).distinct()
             .unionByName(e.select(F.col("dst").alias("id"), F.lit(1).alias("side")).distinct()))
    return e, nodes


def greedy_matching(edges: DataFrame, weight: str = "weight") -> DataFrame:
    """Greedy maximal matching: each round matches every edge that is
    the best (weight, then ids) edge of both of its endpoints, then drops
    the matched nodes."""
    # dealt by src once: the edges of a src then stay in one file, so each round
    # shuffles a row per src and a row per task and dst, whatever the number of edges
    e = cut_lineage(edges.select("src", "dst", F.col(weight).cast("double").alias("w")).repartition("src"))
    matched, gone = [], []
    while True:
        live = e
        for end in ("src", "dst") if gone else ():
            live = live.join(functools.reduce(DataFrame.unionByName, [g.select(end) for g in gone]), end, "left_anti")
        # after rounds 1, 2, 4, 8, .. the edges left are written: however many rounds
        # there are, the edges are written a logarithm of that number of times
        if gone and len(matched) & (len(matched) - 1) == 0:
            e = live = cut_lineage(live.select("src", "dst", "w"))
            gone = []
        # best edge per endpoint as partial aggregates (a hub's edges are
        # reduced map-side, never sorted in one task); ties: smaller other id
        bs = live.groupBy("src").agg(F.max(F.struct("w", (-F.col("dst")).alias("o"))).alias("b"))
        bd = live.groupBy("dst").agg(F.max(F.struct("w", (-F.col("src")).alias("o"))).alias("b"))
        best = (bs.select("src", (-F.col("b.o")).alias("dst"), F.col("b.w").alias("w"))
                .join(bd.select((-F.col("b.o")).alias("src"), "dst"), ["src", "dst"]))
        best = cut_lineage(best)
        if best.isEmpty():          # while there are edges, the best of all is matched
            break
        matched.append(best)
        gone.append(best)
    out = matched[0] if matched else e.limit(0)
    for m in matched[1:]:
        out = out.unionByName(m)
    return out


def interactions(df: DataFrame, keys, cls: str) -> DataFrame:
    """Interaction count per ordered key pair and class."""
    return df.groupBy(*keys, cls).agg(F.count(F.lit(1)).alias("n"))


def betweenness(edges: DataFrame, sources: DataFrame | None = None,
                normalized: bool = True) -> DataFrame:
    """Brandes betweenness for an unweighted undirected graph,
    level-synchronous: a forward BFS per source carries shortest-path counts
    ``sigma`` level by level; the backward pass
    accumulates ``delta(v) = sum_w sigma_v / sigma_w (1 + delta_w)`` from the
    deepest level up.  A task does so for a share of the sources (``tessera.operators.paths``);
    where a graph is too large for a task, a level is a join and an aggregate.  ``sources`` restricts the sum to a set of sources and
    scales it by nodes per source, an unbiased estimate if they are random."""
    from tessera.operators import paths as P
    e = cut_lineage(canonical(edges).filter(F.col("src") != F.col("dst")))
    nodes = cut_lineage(nodes_of(edges))
    n = nodes.count()
    src = cut_lineage((sources if sources is not None else nodes).select(F.col("id").alias("s")))
    if P.fits(e, nodes):
        b = P.dependencies(P.Packed(e, nodes), src.select(F.col("s").alias("id")))
        return _scaled(nodes, b, n, src, sources, normalized)
    adj = cut_lineage(both_ways(e))
    level = cut_lineage(src.select("s", F.col("s").alias("v"), F.lit(1.0).alias("sigma")))
    seen = level.select("s", "v")
    levels = [level]
    while True:
        nxt = (levels[-1].join(adj, F.col("v") == F.col("a"))
               .select("s", F.col("b").alias("v"), "sigma")
               .join(seen, ["s", "v"], "left_anti")
               .groupBy("s", "v").agg(F.sum("sigma").alias("sigma")))
        nxt = cut_lineage(nxt)
        if nxt.isEmpty():
            break
        levels.append(nxt)
        seen = cut_lineage(seen.unionByName(nxt.select("s", "v")))
    delta = levels[-1].select("s", "v", F.lit(0.0).alias("delta"))
    parts = [delta] if len(levels) > 1 else []
    for depth in range(len(levels) - 2, 0, -1):
        child = (levels[depth + 1].join(delta, ["s", "v"])
                 .select("s", F.col("v").alias("w"), F.col("sigma").alias("sw"), "delta"))
        par = levels[depth].select("s", "v", "sigma")
        contrib = (par.join(adj, F.col("v") == F.col("a"))
                   .join(child, (F.col("b") == F.col("w")) & (par.s == child.s))
                   .select(par.s.alias("s"), par.v.alias("v"),
                           (F.col("sigma") / F.col("sw") * (1 + F.col("delta"))).alias("c"))
                   .groupBy("s", "v").agg(F.sum("c").alias("delta")))
        delta = cut_lineage(par.select("s", "v").join(contrib, ["s", "v"], "left")
                            .fillna(0.0, ["delta"]))
        parts.append(delta)
    tot = None
    for p in parts:
        tot = p if tot is None else tot.unionByName(p)
    if tot is None:
        return nodes.select("id", F.lit(0.0).alias("betweenness"))
    return _scaled(nodes, tot.groupBy(F.col("v").alias("id")).agg(F.sum("delta").alias("b")), n, src, sources, normalized)


def _scaled(nodes: DataFrame, b: DataFrame, n: int, src: DataFrame, sources, normalized: bool) -> DataFrame:
    scale = 1.0 / ((n - 1) * (n - 2)) if normalized and n > 2 else 0.5
    if sources is not None:
        scale *= n / max(1, src.count())
    return (nodes.join(b, "id", "left")
            .select("id", (F.coalesce("b", F.lit(0.0)) * scale).alias("betweenness")))


def clique_communities(edges: DataFrame, k: int = 3) -> DataFrame:
    """K-clique percolation: k-cliques sharing k-1 nodes form one
    community.  Adjacent cliques are never paired up: cliques and their
    (k-1)-subsets form a bipartite graph whose connected components are found
    by min-label propagation.  Returns ``(community, id)``; the community is
    labelled by its smallest clique (as a sorted node string)."""
    cl = k_cliques(edges, k).select(F.array_join("nodes", ",").alias("cid"), "nodes")
    cl = cut_lineage(cl)
    # every (k-1)-subset of a clique: drop one position
    subs = cl.select("cid", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda i: F.array_join(F.filter("nodes", lambda x, j: j != i), ","))).alias("sub"))
    subs = cut_lineage(subs)
    lab = cl.select("cid", F.col("cid").alias("label"))
    while True:
        sl = (subs.join(lab, "cid").groupBy("sub").agg(F.min("label").alias("sl")))
        new = (subs.join(sl, "sub").groupBy("cid").agg(F.min("sl").alias("nl"))
               .join(lab, "cid").select("cid", F.least("label", "nl").alias("label"),
                                         (F.col("nl") < F.col("label")).alias("chg")))
        new = cut_lineage(new)
        changed = not new.filter("chg").isEmpty()
        lab = new.select("cid", "label")
        if not changed:
            break
    return (cl.join(lab, "cid").select(F.col("label").alias("community"),
                                       F.explode("nodes").alias("id")).distinct())
