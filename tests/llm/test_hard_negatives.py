"""Hard-negative mining against all pairs, and the bounds that spare most of them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("corpus_pipeline")
from tessera.llm import hard_negatives as H  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, id long, score long, rank int, dim int"


def brute(rows, is_anchor, few=5):
    """{(anchor, positive, rank): (negative, positive score, negative score)} in plain Python."""
    ok = sorted({(i, lab, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, lab in rows
                 if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)})
    out = {}
    for i, lab, a in ok:
        if not is_anchor(i):
            continue
        score = lambda v: sum(x * y for x, y in zip(a, v))
        others = [(j, m, score(v)) for j, m, v in ok if j != i and len(v) == len(a)]
        positives = sorted({(-s, j) for j, m, s in others if m == lab})[:few]
        for s, p in positives:
            s = -s
            found = sorted({(-t, j) for j, m, t in others if m != lab and 80 * s <= 100 * t <= 100 * s})[:few]
            for r, (t, j) in enumerate(found, 1):
                out.setdefault((i, p, r), []).append((j, s, -t))
    return {k: sorted(v) for k, v in out.items()}


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.anchor_id, r.positive_id, r.rank), []).append((r.negative_id, r.positive_score, r.negative_score))
    return {k: sorted(v) for k, v in out.items()}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, 2, 3, 4) for i, v, lab in rows], SCHEMA)


def some(seed=3, n=400, dim=20):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [(k, (centres[k % 6] + rng.normal(size=dim) * 0.6).astype(np.float32).tolist(), int(rng.integers(0, 4)))
            for k in range(n)]
    rows += [(k + 10_000, rows[k][1], rows[k + 1][2]) for k in range(60)]                   # ties
    rows += rows[5:15]                                                                     # repeated rows
    rows += [(20_000, None, 1), (20_010, [], 1), (20_020, [float("nan")] * dim, 1), (20_030, [1.0, None] * (dim // 2), 1),
             (20_040, [float("inf")] * dim, 1), (20_050, [0.0] * dim, 1), (20_060, rows[0][1], None), (None, rows[0][1], 1),
             (20_070, [1.0, 2.0, 3.0], 1), (20_080, [1.0, 2.0, 3.5], 1), (20_090, [1.0, 2.0, 2.9], 2), (-10, rows[3][1], 2),
             (20_100, [-x for x in rows[0][1]], 0), (20_110, [3e4] * dim, 0), (20_121, [2.5e4] * dim, 1)]
    return rows


@pytest.mark.parametrize("block", [4096, 7])
def test_brute_force(spark, block):
    rows = some()
    df = frame(spark, rows)
    found = got(H.mined(df, F.col("vec_id") % 10 == 0, F.col("label"), block=block))
    assert found == brute(rows, lambda i: math.fmod(i, 10) == 0) and len(found) > 100


def test_empty_and_alone(spark):
    df = frame(spark, some())
    assert H.mined(df.limit(0), F.col("vec_id") % 10 == 0, F.col("label")).collect() == []
    assert H.mined(df, F.lit(None).cast("boolean"), F.col("label")).collect() == []
    assert H.mined(frame(spark, [(0, [1.0], 1)]), F.col("vec_id") % 10 == 0, F.col("label")).collect() == []


def test_too_large_for_a_long(spark):
    with pytest.raises(Exception, match="long"):
        H.mined(frame(spark, [(0, [3e38], 1), (1, [3e38], 1)]), F.col("vec_id") == 0, F.col("label")).collect()


def test_large_scores_are_exact():
    x = np.array([[1 << 30, 3], [(1 << 30) + 1, 5]], np.int64)
    v = H.Vectors([0, 1], [0, 0], x, H.summaries(x))
    assert H.scores(v, v, np.array([0]), np.array([1])).tolist() == [(1 << 30) * ((1 << 30) + 1) + 15]
    big = x << 2
    v = H.Vectors([0, 1], [0, 0], big, H.summaries(big))
    with pytest.raises(OverflowError):
        H.scores(v, v, np.array([1]), np.array([1]))


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(0)
    for dim in (1, 3, 4, 5, 64, 100):
        x = rng.integers(-200, 200, (50, dim)) + rng.integers(-100, 100, (50, 1))
        v = H.Vectors(range(50), [0] * 50, x, H.summaries(x))
        exact, last = x @ x.T, None
        for level in v.levels:
            mid, spread = level[0] @ level[0].T, level[1] @ level[1].T + H.slack(v.norms[:, None], v.norms[None])
            assert (mid - spread <= exact).all() and (exact <= mid + spread).all()
            assert last is None or (spread <= last * (1 + 1e-6) + 1).all()
            last = spread


def test_summaries_spare_most_pairs():
    """On vectors whose neighbouring components go together, few pairs are
    multiplied out; the best are those of all pairs."""
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(40, 64)).cumsum(1)[rng.integers(0, 40, 6000)] * 30 + rng.normal(size=(6000, 64)) * 20).astype(np.int64)
    ids, labels = np.arange(6000), rng.integers(0, 3, 6000)
    at = np.flatnonzero(ids % 100 == 0)
    anchors = H.Vectors(ids[at], labels[at], x[at], H.summaries(x[at]))
    best, block, pairs = H.Best(len(at), 5), H.Block(anchors, 5), 0
    for k in range(0, len(x), H.SLICE):
        part = H.Vectors(ids[k:k + H.SLICE], labels[k:k + H.SLICE], x[k:k + H.SLICE], H.summaries(x[k:k + H.SLICE]))
        pairs += block.positive_pairs(part, best)
    same = (labels[at][:, None] == labels[None]) & (ids[at][:, None] != ids[None])
    exact = np.where(same, x[at] @ x.T, np.iinfo(np.int64).min)
    assert (np.sort(exact, 1)[:, :-6:-1] == best.score).all()
    assert pairs < 0.4 * same.sum(), (pairs, same.sum())
