"""What is made of all pairs: no task writes or shuffles a row per pair."""

import numpy as np
import pytest

from tessera.operators import cluster as C


def points(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=(n // 2, 3)), rng.integers(0, 3, (n - n // 2, 3)).astype(float)])
    return x, spark.createDataFrame([(k, v.tolist(), k % 3 if k % 7 else None) for k, v in enumerate(x)],
                                    "id long, vec array<double>, label int")


def prim(x):
    """Heights of the minimum spanning tree."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    near, inside, out = d[0].copy(), np.zeros(len(x), bool), []
    inside[0] = True
    for _ in range(len(x) - 1):
        k = int(np.where(inside, np.inf, near).argmin())
        out.append(near[k])
        inside[k] = True
        near = np.minimum(near, d[k])
    return np.sort(out)


def test_pairs_in_blocks(spark):
    x, df = points(spark, 60)
    got = {(r.i, r.j): r.d for r in C.pairwise(df, block=7).collect()}
    assert sorted(got) == [(a, b) for a in range(60) for b in range(a + 1, 60)]
    assert all(abs(np.sqrt(((x[a] - x[b]) ** 2).sum()) - d) < 1e-12 for (a, b), d in got.items())
    assert C.pairwise(df, square=True, keep=["label"]).count() == 3600


def test_single_linkage_writes_rows_by_node(spark, monkeypatch):
    import tessera.session as S
    written, cut = [], S.cut_lineage

    def counted(df):
        out = cut(df)
        written.append(out.count())
        return out
    monkeypatch.setattr(S, "cut_lineage", counted)
    n = 400
    x, df = points(spark, n)
    heights, labels = C.single_linkage(C.pairwise(df), k=5)
    got = np.array([r.height for r in heights.orderBy("step").collect()])
    assert np.allclose(got, prim(x)) and labels.count() == n and labels.select("cluster").distinct().count() == 5
    assert max(written) < n * (n - 1) / 8       # all pairs, and both ways, before


@pytest.mark.parametrize("edges", [1, 50, 10 ** 6])
def test_forest_of_any_pieces(spark, edges):
    """Ties, null distances and loops, however often a task reduces."""
    rows = [(a, b, None if (a + b) % 11 == 0 else float((a * b) % 4)) for a in range(20) for b in range(a, 20)]
    df = spark.createDataFrame(rows, "i long, j long, d double").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    left = [tuple(r) for r in C.lightest(df, edges).collect()]
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    root, tree = list(range(20)), set()

    def of(k):
        return k if root[k] == k else of(root[k])
    for a, b, d in sorted((r for r in rows if r[0] != r[1]), key=lambda r: (r[2] is not None, r[2] or 0, r[0], r[1])):
        if of(a) != of(b):
            root[of(a)] = of(b)
            tree.add((a, b, d))
    assert tree <= set(left) and {r[0] for r in left if r[0] == r[1]} == set(range(20)) and len(left) <= 3 * 19 + 60


def test_silhouette_sums_pairs_where_they_are_found(spark):
    _, df = points(spark, 50)
    pairs = C.pairwise(df, keep=["label"])
    new = {r.id: r.s for r in C.silhouette(pairs, df).collect()}
    old = {r.id: r.s for r in C.silhouette(pairs.select("i", "j", "d"), df).collect()}
    assert new.keys() == old.keys() and all(abs(new[k] - old[k]) < 1e-12 for k in new)
    own = [C.silhouette(p, df)._jdf.queryExecution().optimizedPlan().toString().count("Join ") for p in (pairs, pairs.select("i", "j", "d"))]
    assert own[1] - own[0] == 2


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    import tessera.session as S
    calls, cut = [], S.cut_lineage
    monkeypatch.setattr(S, "cut_lineage", lambda df: calls.append(1) or cut(df))
    nodes = spark.range(300).select("id")
    got = C._components(nodes, nodes.filter("id % 100 <> 99").selectExpr("id AS u", "id + 1 AS v"))
    assert sorted((r.id, r.comp) for r in got.collect()) == [(k, k // 100 * 100) for k in range(300)]
    assert len(calls) < 40      # over a hundred rounds of labels before
