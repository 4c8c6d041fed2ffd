"""A large group of near copies is not compared with each of its keys' heads."""

import random

from tessera.llm import ngram_join as N


def test_pairs_of_a_group_of_near_copies(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    texts = []
    for i in range(150):
        own = list(words)
        own[rng.randrange(300)] = f"x{i}"
        texts.append((i, " ".join(own)))
    texts += [(1000 + i, " ".join(f"y{i}z{k}" for k in range(40))) for i in range(5)]
    seen, plain = [], N.sketch_filter

    def counted(pairs, *how):
        seen.append(pairs.count())
        return plain(pairs, *how)
    monkeypatch.setattr(N, "sketch_filter", counted)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.id: r.component_id for r in N.components(docs, width=5, num=80, den=100).collect()}
    assert got == {i: 0 if i < 150 else i for i, _ in texts}
    assert sum(seen) < 3 * 150      # 2,906 with six heads of every key
