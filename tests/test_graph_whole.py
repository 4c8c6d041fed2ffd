"""Maximal cliques, four-cycles, bipartite clustering and reach sketches against
plain definitions on small graphs."""

import itertools
import random

import pytest

from tessera.operators import graph as G


def edges(spark, pairs):
    return spark.createDataFrame([(a, b) for a, b in pairs], "src long, dst long")


def some(n=24, p=0.35, seed=2):
    rng = random.Random(seed)
    return [(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < p]


def adjacency(pairs):
    adj = {}
    for a, b in pairs:
        if a != b:
            adj.setdefault(a, set()).add(b)
            adj.setdefault(b, set()).add(a)
    return adj


def brute_maximal(adj):
    out = set()

    def grow(r, p, x):
        if not p and not x and len(r) > 1:
            out.add(tuple(sorted(r)))
        for v in sorted(p):
            grow(r | {v}, p & adj[v], x & adj[v])
            p, x = p - {v}, x | {v}
    grow(set(), set(adj), set())
    return out


def test_maximal_cliques(spark):
    pairs = some() + [(100, 101), (101, 102), (5, 5), (101, 100)]
    adj = adjacency(pairs)
    want = brute_maximal(adj)
    got = G.maximal_cliques(edges(spark, pairs))
    assert {tuple(r.nodes) for r in got.collect()} == want
    r = G.clique_summary(got).first()
    most = max(map(len, want))
    assert (r.clique_number, r.n_maximal, r.n_maximum) == (most, len(want), sum(len(c) == most for c in want))
    large = G.maximal_cliques(edges(spark, pairs), min_size=4)
    assert {tuple(x.nodes) for x in large.collect()} == {c for c in want if len(c) >= 4}
    with pytest.raises(RuntimeError, match="cliques of more"):
        G.maximal_cliques(edges(spark, pairs), max_size=3)
    assert G.maximal_cliques(edges(spark, [])).collect() == []


def test_bipartite_clustering(spark):
    rng = random.Random(5)
    pairs = [(a, -b) for a in range(1, 13) for b in range(1, 9) if rng.random() < 0.4] + [(50, -50)]
    adj = adjacency(pairs)
    c4 = sum(1 for a, b in itertools.combinations(sorted(x for x in adj if x > 0), 2)
             for _ in itertools.combinations(sorted(adj[a] & adj[b]), 2))
    l3 = sum((len(adj[a]) - 1) * (len(adj[b]) - 1) for a, b in pairs)
    r = G.robins_alexander(edges(spark, pairs)).first()
    assert (r.c4, r.l3) == (c4, l3) and abs(r.coefficient - 4 * c4 / l3) < 1e-12
    got = {r.id: r.clustering for r in G.bipartite_clustering(edges(spark, pairs)).collect()}
    assert set(got) == set(adj)
    for u in adj:
        two = {v for w in adj[u] for v in adj[w]} - {u}
        want = sum(len(adj[u] & adj[v]) / len(adj[u] | adj[v]) for v in two) / len(two) if two else 0.0
        assert abs(got[u] - want) < 1e-12
    with pytest.raises(RuntimeError, match="common neighbour"):
        G.bipartite_clustering(edges(spark, pairs), max_pairs=3)
    assert G.robins_alexander(edges(spark, [(1, -1)])).first().coefficient == 0


def test_four_cycles_of_any_graph(spark):
    pairs = some(16, 0.4, 7)
    adj = adjacency(pairs)
    cycles = {frozenset([frozenset((a, b)), frozenset((b, c)), frozenset((c, d)), frozenset((d, a))])
              for a, b, c, d in itertools.permutations(adj, 4) if b in adj[a] and c in adj[b] and d in adj[c] and a in adj[d]}
    assert G.four_cycles(edges(spark, pairs)).first().c4 == len(cycles)


def distances(adj, source):
    dist, todo = {source: 0}, [source]
    for a in todo:
        for b in sorted(adj[a] - dist.keys()):
            dist[b] = dist[a] + 1
            todo.append(b)
    return dist


def test_reach_against_exact_search(spark):
    """All parts of ``copurchase`` and a long path: sketches within their error."""
    from tessera.sources import tables as T
    e = T.copurchase(spark, "/root/testdata/sf0.001")
    pairs = [(r.src, r.dst) for r in e.collect()] + [(-k, -k - 1) for k in range(1, 12)]
    adj = adjacency(pairs)
    exact = {s: distances(adj, s) for s in adj}
    reached = G.reach(edges(spark, pairs), lg_k=12)
    got = {r.id: r for r in G.reach_metrics(reached).collect()}
    assert set(got) == set(adj)
    n = len(adj)
    for s, d in exact.items():
        r = len(d)
        want = (r - 1) / sum(d.values()) * (r - 1) / (n - 1)
        assert got[s].ecc <= max(d.values()) and abs(got[s].closeness - want) <= 0.06 * want + 0.01
        assert abs(got[s].reachable - r) <= 0.05 * r + 1
    assert sum(got[s].ecc == max(d.values()) for s, d in exact.items()) > 0.9 * n
    pairs_at = {r.dist: r.n_pairs for r in G.distance_distribution(reached).collect()}
    for k in range(1, 4):
        want = sum(x == k for d in exact.values() for x in d.values())
        assert abs(pairs_at[k] - want) <= 0.06 * want + 5
    with pytest.raises(RuntimeError, match="longer"):
        G.reach(edges(spark, pairs), max_hops=2)
