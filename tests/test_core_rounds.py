"""Core numbers: no round sends the values of all nodes through the driver."""

from tessera.operators import graph as G


def test_values_are_not_broadcast(spark, monkeypatch):
    plans, cut = [], G.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    monkeypatch.setattr(G, "cut_lineage", seen)
    pairs = [(a, b) for a in range(5) for b in range(a)] + [(5, 0), (6, 5), (7, 7)]
    got = {r.id: r.core for r in G.core_numbers(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    assert got == {0: 4, 1: 4, 2: 4, 3: 4, 4: 4, 5: 1, 6: 1}
    assert len(plans) > 2 and not any("BroadcastHashJoin" in p for p in plans)
