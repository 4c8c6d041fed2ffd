"""Silhouette and single linkage from tiles of pairs equal those from a row for each pair."""

import numpy as np
import pytest

from tessera.operators import cluster as C
from tessera.operators import tiles as T


def points(spark, ties):
    """Duplicates, a repeated id, null labels; with ``ties`` many equal distances."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, (90, 3)).astype(float) if ties else np.concatenate([rng.normal(size=(80, 3)) + 1e4, np.full((10, 3), 1e4)])
    return spark.createDataFrame([(min(k, 85), v.tolist(), None if k % 13 == 0 else k % 5) for k, v in enumerate(x)],
                                 "id long, vec array<double>, label int")


def plain(pairs):
    return pairs.select(*pairs.columns)     # a row for each pair


@pytest.mark.parametrize("ties", [True, False])
def test_equal_to_rows(spark, monkeypatch, ties):
    monkeypatch.setattr(T, "TILE", 7)
    df = points(spark, ties)
    pairs = C.pairwise(df, keep=["label"], block=30)
    labels = df.dropDuplicates(["id"])
    new, old = ({r.id: r.s for r in C.silhouette(p, labels).collect()} for p in (pairs, plain(pairs)))
    assert new.keys() == old.keys() and all(abs(new[k] - old[k]) < 1e-9 for k in new)
    pairs = C.pairwise(df, block=30)
    out = []
    for p in (pairs, plain(pairs)):
        heights, labels = C.single_linkage(p, 6)
        out.append((sorted(r.height for r in heights.collect()), sorted(map(tuple, labels.collect()))))
    assert len(out[0][0]) == 85 and out[0] == out[1]


def test_no_row_for_a_pair(spark):
    """Rows for all pairs before."""
    df = points(spark, False)
    pairs = C.pairwise(df, keep=["label"])
    plans = [C.silhouette(p, df)._jdf.queryExecution().optimizedPlan().toString() for p in (pairs, plain(pairs))]
    assert ["MapInArrow" in p for p in plans] == [True, False]
    assert vars(pairs)["_tiles"].forest().count() < 90 * 89 / 4


@pytest.mark.parametrize("odd", [None, [1.0, None, 2.0], [1.0, 2.0], [float("nan"), 1.0, 1.0], [1e200, 1.0, 1.0]])
def test_odd_rows_keep_the_rows_of_pairs(spark, odd):
    df = points(spark, True).unionByName(spark.createDataFrame([(99, odd, 1)], "id long, vec array<double>, label int"))
    pairs = C.pairwise(df, keep=["label"])
    assert vars(pairs)["_tiles"] is None and C.silhouette(pairs, df).filter("id = 99").count() == 1
