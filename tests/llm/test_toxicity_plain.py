"""The decoder against all lattice paths, the fit against a plain one on a dense
matrix, and scores recomputed from the features of a text."""

import itertools

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")
from tessera.llm import toxicity as T  # noqa: E402


def model():
    text = ("you are an idiot and a fool he said stupid things to the loser who hates all of us " * 40
            + "the house on the hill is old and the dog sleeps all day long " * 60)
    c = T.codes("  " + text + "  ")
    return T.CharModel(np.bincount((c[:-2] * T.SIZE + c[1:-1]) * T.SIZE + c[2:], minlength=T.SIZE ** 3).astype(float))


def cost(path, m):
    """Cost of one way through the lattice, and its text."""
    x = y = 0
    total, out = 0.0, ""
    for chars, extra in path:
        total += extra
        for c in chars:
            z = T.CODE.get(c, 63 if c.isalpha() else 0)
            if not (z == 0 and y == 0):
                total -= float(m.log[x, y, z])
                x, y = y, z
        out += chars
    return total, out.strip()


@pytest.mark.parametrize("stretch", ["1d10t", "st00pid", "l0ser", "f.o.o.l", "i d i o t", "haates", "f00ool", "$tupid", "a$$",
                                     "hell0!", "dog", "x+y", "h*te"])
def test_decoder_takes_the_best_of_all_paths(stretch):
    m = model()
    ways = T.lattice(stretch) + [[(" ", 0.0)]]
    assert np.prod([len(w) for w in ways]) < 3e6
    best = {}
    for path in itertools.product(*ways):
        total, text = cost(path, m)
        best[text] = min(total, best.get(text, np.inf))
    low = min(best.values())
    assert best[T.decode(stretch, m)] <= low + 1e-4


def plain_fit(sets, y, rounds=2, stages=100, gain=11.0):
    names = sorted({f for s in sets for f in s})
    x = np.array([[f in s for f in names] for s in sets], float)
    keep = x.sum(0) >= 5
    names, x, y = [f for f, k in zip(names, keep) if k], x[:, keep], np.array(y, float)

    def solve(cols, steps, bias, w):
        a = np.hstack([np.ones((len(y), 1)), x[:, cols]])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-(bias + x[:, cols] @ w)))
            step = np.clip(np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag([1e-6] + [0.02] * len(w)),
                                           a.T @ (y - p) - 0.02 * np.append(0, w)), -2, 2)
            bias, w = bias + step[0], w + step[1:]
            if np.abs(step).max() < 1e-3:
                break
        return bias, w

    start, chosen, banned = np.log(y.mean() / (1 - y.mean())), [], np.zeros(len(names), bool)
    for _ in range(rounds):
        active, bias, w = [], start, np.empty(0)
        while len(active) < stages:
            bias, w = solve(active, 8, bias, w)
            p = 1 / (1 + np.exp(-(bias + x[:, active] @ w)))
            g = x.T @ (y - p)
            chi = g * np.abs(g) / (x.T @ (p * (1 - p)) + 1)
            chi[banned] = 0
            chi[active] = 0
            if chi.max() < gain:
                break
            active.append(int(chi.argmax()))
            w = np.append(w, 0.0)
        chosen += active
        for f in active:
            banned |= x.T @ x[:, f] >= 0.9 * np.maximum(x.sum(0), x[:, f].sum())
    bias, w = solve(chosen, 50, start, np.zeros(len(chosen)))
    return bias, {names[k]: v for k, v in zip(chosen, w)}


def test_fit_against_a_plain_one():
    rng = np.random.default_rng(6)
    sets, y = [], []
    for _ in range(600):
        bad = rng.random() < 0.25
        s = set(rng.choice(400, rng.integers(5, 40)).tolist())
        if bad:
            s |= set((1000 + rng.choice(6, rng.integers(1, 3))).tolist())
        sets.append(s)
        y.append(int(bad and rng.random() < 0.95))
    ids = np.concatenate([np.array(sorted(s), np.int32) for s in sets])
    bias, weights = T.fit(ids, np.array([len(s) for s in sets]), np.array(y))
    want_bias, want = plain_fit(sets, y)
    assert set(weights) == set(want) and len(want) >= 6
    assert abs(bias - want_bias) < 1e-6 and all(abs(weights[k] - want[k]) < 1e-6 for k in want)


def test_scores_from_features():
    m = model()
    words = ["idiot", "stupid", "loser", "fool", "hates", "house", "dog", "hill"]
    rng = np.random.default_rng(1)
    weights = {}
    for w in words:
        own, begins = T.word_features(w)
        weights[own] = float(rng.normal())
        for b in begins:
            for n in (1, 2, 3):
                if rng.random() < 0.5:
                    weights[T.level(b, n)] = float(rng.normal())
    rate = T.scorer(T.Model(m, -1.0, weights))
    for text in ["you 1d10t", "the stupid stupids stupidest loser", "", None, "a dog on the hill", "f.o.o.l and h0use houses housed",
                 "IDIOT!!! " * 50]:
        z = -1.0 + sum(weights.get(f, 0.0) for f in T.features(T.Restorer(m).words(text or "")))
        assert abs(rate(text) - 1 / (1 + np.exp(-z))) < 1e-9
