"""Greedy matching of a graph that takes a round per edge matched."""

from tessera.operators import graph as G


def test_edges_left_are_written_a_logarithm_of_the_rounds(spark, monkeypatch):
    n, written = 12, []
    cut = G.cut_lineage

    def counted(df):
        out = cut(df)
        written.append(out.count())
        return out
    monkeypatch.setattr(G, "cut_lineage", counted)
    # a path: weights fall along it, so only its first edge left is the best of both ends
    rows = [(k, 100 + k, float(2 * n - 2 * k)) for k in range(n)] + [(k, 101 + k, float(2 * n - 2 * k - 1)) for k in range(n - 1)]
    e = spark.createDataFrame(rows, "src long, dst long, weight double")
    got = sorted((r.src, r.dst) for r in G.greedy_matching(e).collect())
    assert got == [(k, 100 + k) for k in range(n)]
    assert sum(written) < 6 * len(rows)


def test_no_edges(spark):
    e = spark.createDataFrame([], "src long, dst long, weight double")
    assert G.greedy_matching(e).collect() == [] and G.greedy_matching(e).columns == ["src", "dst", "w"]
