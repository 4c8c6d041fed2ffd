"""Paths and betweenness of a share of the sources are found in one task: a level is no join."""

import random
from collections import deque

import pytest

from tessera.operators import graph as G
from tessera.operators import paths as P
from tessera.operators import reach as R


def graph():
    rng = random.Random(3)
    pairs = {(a, a + 1) for a in range(0, 90) if a not in (30, 60)} | {(rng.randrange(31), rng.randrange(31)) for _ in range(25)}
    pairs |= {(70, b) for b in range(61, 91)} | {(200, 200)}
    near = {200: set()}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    return sorted(pairs), near


def search(near, s):
    """Distances, numbers of paths, and Brandes' dependencies of one source."""
    dist, paths, order, todo = {s: 0}, {s: 1.0}, [], deque([s])
    while todo:
        v = todo.popleft()
        order.append(v)
        for w in near.get(v, ()):
            if w not in dist:
                dist[w], paths[w] = dist[v] + 1, 0.0
                todo.append(w)
            if dist[w] == dist[v] + 1:
                paths[w] += paths[v]
    delta = dict.fromkeys(order, 0.0)
    for w in reversed(order):
        for v in near.get(w, ()):
            if dist[v] == dist[w] - 1:
                delta[v] += paths[v] / paths[w] * (1 + delta[w])
    return dist, {v: d for v, d in delta.items() if v != s}


@pytest.fixture(params=["whole", "pieces", "joins"])
def form(request, monkeypatch):
    if request.param == "pieces":
        for module, name, value in ((P, "GATHER", 64), (P, "TABLE", 1), (P, "COUNTS", 1), (P, "ROWS", 1), (R, "PIECE", 7)):
            monkeypatch.setattr(module, name, value)
    if request.param == "joins":
        monkeypatch.setattr(P, "MOST_NODES", 0)


def test_against_plain_search(spark, form):
    pairs, near = graph()
    edges = spark.createDataFrame(pairs, "src long, dst long")
    sources = spark.createDataFrame([(s,) for s in [0, 5, 40, 70, 200, 999]], "id long")
    for src, own in ((None, sorted(near)), (sources, [0, 5, 40, 70, 200, 999])):
        want = {s: search(near, s)[0] for s in own}
        paths = G.shortest_paths(edges, src)
        got = [tuple(r) for r in paths.collect()]
        assert len(got) == len(set(got)) and set(got) == {(s, v, d) for s in own for v, d in want[s].items()}
        assert {r.id: r.ecc for r in G.eccentricity(paths).collect()} == {s: max(want[s].values()) for s in own}
        n = len(own) if src is None else len(near)
        tot = {s: sum(want[s].values()) for s in own}
        close = {r.id: r.closeness for r in G.closeness(paths, None if src is None else G.nodes_of(edges)).collect()}
        assert all(abs(close[s] - ((len(want[s]) - 1) ** 2 / tot[s] / (n - 1) if tot[s] else 0)) < 1e-12 for s in own) and len(close) == len(own)
        far = [d for s in own for d in want[s].values() if d]
        row = G.distance_summary(paths).first()
        assert row.diameter == max(far) and abs(row.avg_path_length - sum(far) / len(far)) < 1e-12


def test_betweenness_against_plain_search(spark, form):
    pairs, near = graph()
    edges = spark.createDataFrame(pairs, "src long, dst long")
    for own in (sorted(near), [0, 5, 40, 70, 999]):
        want = dict.fromkeys(near, 0.0)
        for s in own:
            for v, d in search(near, s)[1].items():
                if v in want:
                    want[v] += d
        scale = len(near) / len(own) / (len(near) - 1) / (len(near) - 2)
        got = {r.id: r.betweenness for r in G.betweenness(edges, spark.createDataFrame([(s,) for s in own], "id long")).collect()}
        assert got.keys() == want.keys() and all(abs(got[v] - want[v] * scale) < 1e-12 for v in want)


def test_a_level_writes_nothing(spark, monkeypatch):
    """A table or two for each of 59 levels before."""
    calls, cut = [], G.cut_lineage
    for module in (G, P):
        monkeypatch.setattr(module, "cut_lineage", lambda df: calls.append(1) or cut(df))
    edges = spark.createDataFrame([(a, a + 1) for a in range(59)], "src long, dst long")
    src = spark.createDataFrame([(0,)], "id long")
    assert G.shortest_paths(edges, src).count() == 60 and G.betweenness(edges, src).count() == 60
    assert len(calls) < 20


def test_no_edges(spark):
    edges = spark.createDataFrame([], "src long, dst long")
    assert G.shortest_paths(edges).count() == 0 and G.betweenness(edges).count() == 0
    alone = spark.createDataFrame([(7,)], "id long")
    assert [tuple(r) for r in G.shortest_paths(edges, alone).collect()] == [(7, 7, 0)]
