"""The examples that the trees learn from, in corpora of unlike kinds."""

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")
from tessera.llm import common, pii  # noqa: E402


def test_shares():
    assert common.shares({"a": 5, "b": 100, "c": 70}, 60) == {"a": 5, "c": 27, "b": 28}
    assert common.shares({"a": 5, "b": 6}, 60) == {"a": 5, "b": 6} and common.shares({}, 9) == {}


def test_samples_are_of_every_kind_without_copies(spark):
    rows = [("email", f"u{k}") for k in range(5000)] + [("card", "hot")] * 5000 + [("phone", f"p{k}") for k in range(7)]
    df = spark.createDataFrame(rows, "kind string, text string").repartition(7)
    got = [tuple(r)[:2] for r in common.bounded_samples(df, 100, "kind", "kind", "text")]
    kinds = [k for k, _ in got]
    assert len(set(got)) == len(got) == 100 and (kinds.count("card"), kinds.count("phone"), kinds.count("email")) == (1, 7, 92)
    again = common.bounded_samples(df.distinct().coalesce(2), 100, "kind", "kind", "text")
    assert [tuple(r)[:2] for r in again] == got
    assert common.bounded_samples(df.limit(0), 100, "kind", "kind", "text") == []


def test_a_rare_kind_is_learned_beside_a_frequent_one(spark):
    """Telephone numbers in other spellings are found whatever the number of mail addresses."""
    rng = np.random.default_rng(3)
    rows = [(k, f"write to user{k}@mail{k % 9}.example.com today") for k in range(12_000)]
    for k in range(300):
        n = "".join(map(str, rng.integers(2, 10, 10)))
        rows.append((20_000 + k, f"ring me at +1 ({n[:3]}) {n[3:6]}-{n[6:]} today"))
    rows.append((30_000, "call (284) 555-0850 now"))
    got = {r.id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), sample=400).collect()}
    assert [(s.kind, s.start, s.end) for s in got[30_000].added] == [("phone", 5, 19)]
