"""Exact dedup against plain grouping, with small bitmaps, short prefixes and odd rows."""

import hashlib
import re

import pytest

pytest.importorskip("corpus_pipeline")
from tessera.llm import exact_dedup  # noqa: E402

SCHEMA = "doc_id long, text string, id long, digest string, again boolean, group_size long, keep_id long"
LONG = "lorem  ipsum\n" * 50_000


def plain(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, "", True, 9, 9) for i, t in rows], SCHEMA)


ROWS = [(5, "a  b"), (3, "a\tb"), (3, "a\tb"), (9, " a b"), (1, "a b "), (2, None), (4, ""), (6, " "), (7, "\n\r\n"), (8, LONG),
        (10, LONG.replace("\n", " ")), (11, LONG + "x"), (12, LONG + "y"), (None, "a b"), (None, "only"), (13, "é ß"),
        (14, "é ß"), (15, "é ß"), (16, "ab"), (17, "ba"), (18, "x\x0by"), (19, "x\x0cy"), (20, "x\x85y")]


@pytest.mark.parametrize("how", [{}, {"most_bits": 32768, "prefix": 2}, {"all_digests": True}])
def test_odd_rows(spark, how):
    got = exact_dedup.exact_duplicates(frame(spark, ROWS), **how).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(plain(t), []).append(i)
    want = []
    for i, t in ROWS:
        own = groups[plain(t)]
        keep = min((k for k in own if k is not None), default=None)
        want.append((i, keep, len(own), i == keep))
    assert sorted(map(str, want)) == sorted(str((r.id, r.keep_id, r.group_size, r.kept)) for r in got)
    digests = {(i, hashlib.sha256(plain(t).encode()).hexdigest()) for i, t in ROWS}
    assert {(r.id, r.digest) for r in got if r.digest} <= digests
    assert all(r.digest for r in got if r.group_size > 1 or how.get("all_digests"))


def test_drop(spark):
    kept = exact_dedup.drop_duplicates(frame(spark, ROWS))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 1, 2, 3, 3, 6, 8, 9, 11, 12, 13, 15, 16, 17, 18, 20]
    assert exact_dedup.exact_duplicates(frame(spark, ROWS).limit(0)).collect() == []


def test_texts_alone_are_not_hashed_whole(spark):
    rows = [(k, "x" * k) for k in range(300)] + [(1000 + k, f"{k:03d}" + "y" * 500) for k in range(100)]
    got = exact_dedup.exact_duplicates(frame(spark, rows)).collect()
    assert sum(r.digest is not None for r in got) < 60


def test_hot_group(spark):
    """A third of all rows is one group; its join is by broadcast, the rest by key."""
    rows = [(k, "same" if k % 3 == 0 else f"t{k // 4}") for k in range(3000)]
    got = {r.id: r for r in exact_dedup.exact_duplicates(frame(spark, rows)).collect()}
    assert len(got) == 3000 and got[2997].keep_id == 0 and got[2997].group_size == 1000 and not got[2997].kept
    assert all(got[k].group_size == sum(j % 3 != 0 for j in range(k // 4 * 4, k // 4 * 4 + 4)) for k in range(3000) if k % 3)
