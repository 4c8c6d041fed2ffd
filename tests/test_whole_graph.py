"""Path metrics of a whole graph: every node is a source."""

from collections import Counter

import duckdb

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def nation_graph():
    pairs = duckdb.connect().execute(f"""
        SELECT c_nationkey, s_nationkey FROM '{SF_SMALL}/lineitem.parquet' JOIN '{SF_SMALL}/orders.parquet' ON l_orderkey = o_orderkey
        JOIN '{SF_SMALL}/customer.parquet' ON o_custkey = c_custkey JOIN '{SF_SMALL}/supplier.parquet' ON l_suppkey = s_suppkey""").fetchall()
    n = Counter(frozenset(p) for p in pairs if p[0] != p[1])
    adj = {}
    for p, k in n.items():
        if k * len(n) >= sum(n.values()):
            a, b = p
            adj.setdefault(a, set()).add(b)
            adj.setdefault(b, set()).add(a)
    return adj


def distances(adj, source):
    dist, todo = {source: 0}, [source]
    for a in todo:
        for b in sorted(adj[a] - dist.keys()):
            dist[b] = dist[a] + 1
            todo.append(b)
    return dist


def test_path_metrics_of_all_nodes(spark):
    adj = nation_graph()
    dist = {s: distances(adj, s) for s in adj}
    got = E.queries()["G7_shortest_paths_nations"](spark, SF_SMALL).collect()
    assert {(r.source, r.id): r.dist for r in got} == {(s, v): d for s, ds in dist.items() for v, d in ds.items()}
    ecc = [max(d.values()) for d in dist.values()]
    far = [d for ds in dist.values() for d in ds.values() if d]
    r = E.queries()["G8_distance_summary_nations"](spark, SF_SMALL).first()
    assert (r.diameter, r.radius, r.n_center, r.n_periphery) == (max(ecc), min(ecc), ecc.count(min(ecc)), ecc.count(max(ecc)))
    assert abs(r.avg_path_length - sum(far) / len(far)) < 1e-6
    # shortest paths through a node, over all pairs: sum of (d - 1) shares
    r = E.queries()["G10_betweenness_nations"](spark, SF_SMALL).collect()
    n = len(adj)
    assert {x.id for x in r} == set(adj)
    assert abs(sum(x.betweenness for x in r) - sum(d - 1 for d in far) / ((n - 1) * (n - 2))) < 1e-4


def test_subset_of_sources_is_named_an_estimate():
    names = E.queries()
    for old in ("G8_distance_summary", "G10_betweenness", "G15_compare_metrics"):
        assert old not in names and any(k.startswith(f"{old}_estimate") for k in names)
