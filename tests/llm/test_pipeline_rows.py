"""The whole pipeline on empty tables, nulls, repeated rows and texts that its
stages have to treat alike; effects of line dedup and BPE looked at in full."""

from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tessera.llm.common import cut_lineage  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, rows, labels=(), items=()):
    spark.createDataFrame([(i, t, None, s, len(t or "")) for i, t, s in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_empty(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path / "in", [])).collect() == []


def test_nulls_and_repeats(spark, tmp_path):
    import public_tokenizers
    import tiktoken
    from tessera.llm import bpe
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron".split()
    rows = [(k, " ".join(words[(k * 7 + j * (k + 1)) % 15] + str((k * j) % 9) for j in range(30)) + "\nshared line", "a") for k in range(12)]
    rows += [(20, None, "a"), (21, "", "a"), (22, " \n", None), (20, None, "a"), (3, rows[3][1], "a"), (None, "one of a kind here now", None),
             (30, rows[5][1], "b"), (31, "x " * 20_000, "b"), (32, "the benchmark item about seven red foxes stands here", "b")]
    folder = write(spark, tmp_path / "in", rows, [(None, None, 1), (1, 1, 0), (99, 0, None)],
                   [(1, "benchmark item about seven red foxes"), (2, None), (3, "")])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = cut_lineage(stages["toxicity"](spark, docs, folder))
    assert kept.count() == len(rows) and kept.columns == docs.columns
    lined = cut_lineage(stages["line dedup"](spark, kept, folder))
    per, pages = Counter(), Counter()
    for _, t, s in rows:
        pages[s] += 1
        per.update({(s, line) for line in (t or "").split("\n")})
    gone = {k for k, n in per.items() if n >= 3 and n > 0.1 * pages[k[0]] and k[1].strip()}
    want = sorted((str(i), "\n".join(x for x in t.split("\n") if (s, x) not in gone) if t is not None else None) for i, t, s in rows)
    assert sorted((str(r.doc_id), r.text) for r in lined.collect()) == want and ("a", "shared line") in gone
    once = cut_lineage(stages["n-gram Jaccard join"](spark, lined, folder))
    ids = sorted(str(r.doc_id) for r in once.collect())
    assert "30" not in ids and ids.count("3") == 2 and "None" in ids and ids.count("20") == 2
    clean = cut_lineage(stages["benchmark decontamination"](spark, once, folder))
    assert sorted(str(r.doc_id) for r in clean.collect()) == [i for i in ids if i != "32"]
    out = corpus_pipeline.run(spark, folder).collect()
    texts = Counter((str(r.doc_id), r.text or "") for r in clean.collect())
    assert Counter((str(r.doc_id), len(t)) for r, t in ((r, own.decode_bytes(list(r.ids))) for r in out)) == Counter(
        (i, len(t.encode())) for i, t in texts.elements())
    assert sorted((str(r.doc_id), list(r.ids), r.n_tokens, r.n_bytes) for r in out) == sorted(
        (i, own.encode_ordinary(t), len(own.encode_ordinary(t)), len(t.encode())) for i, t in texts.elements())
