"""The prefix trie against plain dictionaries, with small chunks, hot prefixes,
long conversations and odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")
from tessera.llm import prefix_trie  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, conv long, c long, k1 long, ext long, rep string"


def brute(rows):
    """The nodes as a set of rows, from the definition alone."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(),
                                            text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in convs.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        whole[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members, kids, nodes = {}, {}, set()
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
            if d:
                kids.setdefault(ts[:d - 1], set()).add(ts[:d])

    def below(n):
        out, todo = [], [n]
        while todo:
            n = todo.pop()
            out.append(n)
            todo += kids.get(n, ())
        return out

    for n, m in members.items():
        sub = below(n)
        saved = sum((len(members[u]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", u[-1][1])) for u in sub if u)
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(n))))
        nodes.add((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids.get(n, ())),
                   sum(u not in kids for u in sub), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return nodes


def got(spark, rows):
    df = spark.createDataFrame([(c, t, r, x, 0, 0, 0, 0, "") for c, t, r, x in rows], SCHEMA)
    found = prefix_trie.prefix_nodes(df).collect()
    out = {(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
           for r in found}
    assert len(out) == len(found)
    return out


def some(seed=1, n=150):
    """Conversations that share prefixes of all lengths, equal ones among them."""
    rng = np.random.default_rng(seed)
    rows, made = [], []
    for c in range(n):
        size = int(rng.integers(1, 12))
        if made and rng.random() < 0.7:
            old = made[rng.integers(0, len(made))]
            turns = old[:rng.integers(0, len(old) + 1)]
        else:
            turns = []
        turns = turns + [("user", " ".join(rng.choice(["a", "b", "c"], rng.integers(0, 3)))) for _ in range(size - len(turns))]
        made.append(turns or [("x", "")])
        rows += [(c, k, r, t) for k, (r, t) in enumerate(made[-1])]
    return rows


ODD = [(400, None, "r", "first"), (400, 1, None, "a b\tc"), (400, 1, None, "a b\tc"), (400, 1, "b", None), (400, 1, "a", "é x y"),
       (None, 1, "r", "no one's"), (419, 1, "q", "only turn"), (1001, 1, "q", "base absent"), (-5, 3, "n", "negative"),
       (-20, 1, "n", "negative base"), (1002, 9, "q", "\x0b"), (1003, 9, "q", ""), (1004, 9, "q", None)]


@pytest.mark.parametrize("chunk,ends", [(3, 2)])
def test_brute_force(spark, monkeypatch, chunk, ends):
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "ENDS", ends)
    rows = some() + ODD
    assert got(spark, rows) == brute(rows)


def test_long_and_hot(spark):
    """Two conversations of 700 turns that part late, and many equal ones."""
    rows = [(c, k, "u", f"turn {k}" if k < 690 or c == 0 else "other") for c in (0, 1) for k in range(700)]
    rows += [(c, k, "u", f"hello {k}") for c in range(100, 180) for k in range(2)]
    rows += [(c, k, "u", f"hello {k}" if k < 1 else f"{c}") for c in range(200, 220) for k in range(3)]
    assert got(spark, rows) == brute(rows)


def test_empty(spark):
    assert got(spark, []) == set()
    assert got(spark, [(None, 1, "a", "b")]) == set()


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)] + [(2 ** 40 - 1, 2 ** 41 + 5)]
    f = spark.createDataFrame(pairs, "a long, b long").selectExpr("a", "b", prefix_trie.fattest("a", "b") + " AS f")
    for r in f.collect():
        best = max((k & -k, k) for k in (range(r.a + 1, r.b + 1) if r.b < 100 else [2 ** 41]))
        assert r.f == best[1]
