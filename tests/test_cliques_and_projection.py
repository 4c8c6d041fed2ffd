"""Cliques by arrays of followers, projection by one row a document."""

import itertools
import math
import random

from tessera.operators import graph as G
from tessera.operators import topics as TP


def test_cliques_of_every_size(spark, monkeypatch):
    rng = random.Random(3)
    pairs = [p for p in itertools.combinations(range(24), 2) if rng.random() < 0.5 or 0 in p]
    e = spark.createDataFrame(pairs + [(b, a) for a, b in pairs[::3]] + [(5, 5)], "src long, dst long")
    written, cut = [], G.cut_lineage

    def counted(df):
        out = cut(df)
        written.append(out.count())
        return out
    monkeypatch.setattr(G, "cut_lineage", counted)
    known = set(pairs)
    for k in (2, 3, 4, 5):
        brute = [c for c in itertools.combinations(range(24), k) if all(p in known for p in itertools.combinations(c, 2))]
        got = [tuple(r.nodes) for r in G.k_cliques(e, k).collect()]
        assert sorted(got) == brute
        if k == 3:      # one row an edge at most, not one a triangle
            assert max(written) <= len(pairs) < len(brute)


def test_projection_by_documents(spark):
    rows = [(d, f"t{t}", 0.1 * (1 + (d * t) % 5)) for d in range(6) for t in range(9)]
    w = spark.createDataFrame(rows, "doc_id long, term string, w double")
    ids = spark.createDataFrame([(f"t{t}", t) for t in range(8)], "term string, term_id long")
    df = TP.random_projection(w, ids, 5, 3)
    got = {(r.doc_id, r.dim): r.value for r in df.collect()}
    for d in range(6):
        for j in range(5):
            own = sum((1 if (t * 7919 + j * 104729 + 3) % 2 == 0 else -1) * x for a, term, x in rows if a == d
                      for t in [int(term[1:])] if t < 8) / math.sqrt(5)
            assert abs(got[d, j] - own) < 1e-12
    assert len(got) == 30 and "CartesianProduct" not in (plan := df._jdf.queryExecution().toString()) and "NestedLoop" not in plan
