"""Distances from more sources than a word, or a row, has bits."""

import random
from collections import deque

from tessera.operators import graph as G


def test_against_plain_search(spark, monkeypatch):
    monkeypatch.setattr(G, "WORDS", 2)
    rng = random.Random(1)
    pairs = {(a, a + 1) for a in range(0, 150) if a not in (60, 100)} | {(rng.randrange(61), rng.randrange(61)) for _ in range(20)}
    near = {}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = set()
    for s in near:
        dist, todo = {s: 0}, deque([s])
        while todo:
            v = todo.popleft()
            for w in near[v]:
                if w not in dist and dist[v] < 6:
                    dist[w] = dist[v] + 1
                    todo.append(w)
        want |= {(s, v, d) for v, d in dist.items()}
    written, cut = [], G.cut_lineage

    def counted(df):
        out = cut(df)
        written.append(out.count())
        return out
    monkeypatch.setattr(G, "cut_lineage", counted)
    got = [tuple(r) for r in G.shortest_paths(spark.createDataFrame(sorted(pairs), "src long, dst long"), max_hops=6).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert max(written) < len(want) / 3     # a row for each source and node before
