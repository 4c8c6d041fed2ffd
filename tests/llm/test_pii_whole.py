"""Spans of any length, overlaps, and the trees against plain definitions."""

import random
import time

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")
from tessera.llm import pii  # noqa: E402


def test_long_names_are_whole():
    name = "n" * 300
    text = f"write to {name} [at] example [dot] org now"
    got = [text[s.start:s.end] for s in pii.candidates(text) if s.kind == "email"]
    assert got == [f"{name} [at] example [dot] org"]


def test_spans_apart():
    """Against comparing each with all that were taken before it."""
    rng = random.Random(4)
    for _ in range(300):
        spans = [{"start": a, "end": a + rng.randint(1, 9)} for a in (rng.randrange(60) for _ in range(12))]
        want = []
        for s in spans:
            if not any(s["start"] < o["end"] and o["start"] < s["end"] for o in want):
                want.append(s)
        assert pii.apart(spans) == sorted(want, key=lambda s: s["start"])


def test_planted_by_hand(spark):
    """Added spans of texts written by hand, not by the respelling code; prose and
    numbers of other kinds add nothing."""
    rng = random.Random(1)
    rows = []
    for k in range(300):
        rows.append(f"note {k}: mail user{k}.name{k % 7}@mail{k % 9}.example.org or call +1 {200 + k % 700} {300 + k % 600} "
                    f"{1000 + k * 7 % 9000}, host 10.{k % 250}.{k * 7 % 250}.{k * 3 % 250}, done.")
        rows.append(" ".join(rng.choice(["the", "river", "ran", "over", "stones", "in", "2019", "about", "12", "days"]) for _ in range(40)))
    planted = {"Please call 415-555-0132 tomorrow.": "415-555-0132", "Phone (212) 555-0187 for details": "(212) 555-0187",
               "mail me: jane.doe [at] example [dot] com ok": "jane.doe [at] example [dot] com",
               "contact bob (at) example.org please": "bob (at) example.org"}
    clean = ["In 1999 the river ran 12 days.", "version 1.2.3 of 2019-05-04 came out", "we met at noon and left at six"]
    every = rows + list(planted) + clean
    df = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string")
    got = {r.id: [every[r.id][s.start:s.end] for s in r.added] for r in pii.find(df).collect()}
    found = {every[i]: spans for i, spans in got.items()}
    assert sum(found[t] == [s] for t, s in planted.items()) >= 3, [found[t] for t in planted]
    assert [found[t] for t in clean] == [[], [], []]
    assert sum(bool(found[t]) for t in rows[1::2]) <= 3


def test_trees_against_plain_splits():
    """The first tree's root is the best split of all, and boosting fits a table
    that no single feature explains."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, (400, 4)).astype(float)
    y = ((x[:, 1] > 4) ^ (x[:, 2] > 3)).astype(float)
    w = rng.choice([1.0, 0.5], 400)
    model = pii.Boosted(rounds=30, depth=3).fit(x, y, w)
    p0 = 1 / (1 + np.exp(-model.bias))
    g, h = w * (y - p0), w * p0 * (1 - p0)
    best = max(((g[m].sum() ** 2 / (h[m].sum() + 1) + g[~m].sum() ** 2 / (h[~m].sum() + 1), f, c)
                for f in range(4) for c in range(9) for m in [x[:, f] <= c] if m.any() and not m.all()))
    feature, cut = model.trees[0][0][0][0]
    m = model.binned(x)[:, feature] <= cut
    gain = g[m].sum() ** 2 / (h[m].sum() + 1) + g[~m].sum() ** 2 / (h[~m].sum() + 1)
    assert gain >= best[0] - 1e-6
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.97


def test_many_candidates_take_linear_time():
    text = "call 415-555-0132, " * 20_000
    start = time.process_time()
    spans = [s._asdict() for s in pii.candidates(text)]
    assert len(pii.apart(spans)) >= 20_000 and time.process_time() - start < 20
