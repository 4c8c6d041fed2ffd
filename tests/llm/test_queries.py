"""Registered queries against their SQL, and against brute force where SQL
cannot express them."""

import hashlib
import re

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tessera.llm import bpe, lines, ngram_join, pii, queries, secrets, toxicity  # noqa: E402

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def rows(name, sf=SF_SMALL, columns="*"):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()


def texts(sf=SF_SMALL):
    return rows("documents", sf, "doc_id, text")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    r = compare(spark, duck(SF_SMALL), name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF_SMALL)
    assert r["ok"], r


def test_registered():
    have = E.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(have)
    assert [int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES] == list(range(1, 14))


def shingles(text, width):
    ws = WORD.findall((text or "").translate(LOWER))
    if not ws:
        return frozenset()
    k = min(width, len(ws))
    return frozenset(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))


def brute_components(docs, width, num, den):
    """{id: (set size, least id reachable)} by comparing all pairs of sets."""
    sets = {i: shingles(t, width) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if a and b and den * min(len(a), len(b)) >= num * max(len(a), len(b)):
                n = len(a & b)
                if den * n >= num * (len(a) + len(b) - n):
                    p, q = find(i), find(j)
                    root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def varied(seed=5):
    """Documents with groups of near copies around the threshold, chains, and
    short texts."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out, i = [], 0
    for size in (3, 8, 12, 25, 60, 200, 700):
        for _ in range(3):
            base = list(rng.choice(vocabulary, size))
            for copies in range(7):
                words = list(base)
                for _ in range(rng.integers(0, 1 + max(1, size * copies // 90))):
                    words[rng.integers(0, size)] = str(rng.choice(vocabulary))
                if copies == 5:
                    base = words            # the chain goes on from here
                out.append((i, " ".join(words).upper() if copies == 2 else " ".join(words)))
                i += 1
    return out + [(i, ""), (i + 1, " \n "), (i + 2, None), (i + 3, "one"), (i + 4, "ONE"), (i + 5, "one two")]


@pytest.mark.parametrize("width,num", [(3, 90), (5, 80), (1, 60)])
def test_ngram_join_brute_force(spark, width, num):
    docs = varied()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.components(df, width=width, num=num).collect()}
    assert got == brute_components(docs, width, num, 100)


def test_ngram_join_remaining_pairs_alone(spark):
    """Without the comparison with a key's heads, the block comparison finds all."""
    docs = varied(6)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.components(df, heads=0).collect()}
    assert got == brute_components(docs, 3, 90, 100)


def test_ngram_join_query(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op1_ngram_jaccard_join(spark, SF_SMALL).collect()}
    assert got == brute_components(texts(), 3, 90, 100)


def test_sketch_bounds():
    rng = np.random.default_rng(1)
    th = ngram_join.Threshold(90, 100)
    for n in (1, 9, 30, 500, 5000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.append(a[: len(a) - n // 12], rng.integers(0, 1 << 63, n // 12).astype(np.uint64)))
        x, y = ngram_join.folded([ngram_join.bit_sketch(a, th), ngram_join.bit_sketch(b, th)])
        differ = len(np.setxor1d(a, b))
        assert int(np.bitwise_count(x ^ y).sum()) <= differ
        if th.links(len(np.intersect1d(a, b)), len(a), len(b)) and differ:
            assert np.intersect1d(ngram_join.block_keys(a, th), ngram_join.block_keys(b, th)).size


def test_bpe_query(spark):
    import public_tokenizers
    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert bpe.PATTERN == public_tokenizers.PATTERN
    own = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op7_byte_bpe(spark, SF_SMALL).collect()}
    for i, t in texts():
        ids = own.encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256((t or "").encode()).hexdigest())


def plain_pii(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        odd, even = map(int, d[::-1][::2]), [2 * int(c) for c in d[::-1][1::2]]
        if 12 <= len(d) <= 19 and (sum(odd) + sum(e // 10 + e % 10 for e in even)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def plain_secrets(t):
    out = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.A):
        if len(m[1]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


@pytest.mark.parametrize("module,plain,query", [(pii, plain_pii, queries.op6_pii), (secrets, plain_secrets, queries.op8_secrets)])
def test_span_queries(spark, module, plain, query):
    got = {r.doc_id: r for r in query(spark, SF_SMALL).collect()}
    for i, t in texts():
        base = plain(t or "")
        joined = ",".join(f"{module.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in module.KINDS] == [sum(s[1] == x for s in base) for x in range(len(module.KINDS))]
        spans = got[i].spans.split(",") if got[i].spans else []
        assert set(joined.split(",")) - {""} <= set(spans)
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op5_toxicity(spark, sf).collect()}
    assert len(got) == len(texts(sf))
    held = [(got[i].score, y) for i, y in rows("labels", sf, "doc_id, toxic") if got[i].held_out]
    caught = [s >= 0.3 for s, y in held if y == 1]
    wrong = [s >= 0.3 for s, y in held if y == 0]
    assert len(caught) > 50 and np.mean(caught) > 0.9 and np.mean(wrong) < 0.02


def test_pipeline_stages(spark):
    """Each stage against a plain account of what it has to do with its input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = kept.get("docs", {r.doc_id: r for r in docs.collect()})
        docs = ngram_join.cut_lineage(stage(spark, docs, SF_SMALL))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name != "byte-level BPE":
            assert docs.columns == names
        if name == "toxicity":
            model = toxicity.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"),
                                   spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
            rate = toxicity.scorer(model)
            assert set(after) == {i for i, r in before.items() if rate(r.text) < 0.3}
        elif name == "line dedup":
            assert set(after) == set(before)
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "n-gram Jaccard join":
            found = brute_components([(i, r.text) for i, r in before.items()], 5, 80, 100)
            assert set(after) == {i for i, (_, c) in found.items() if i == c}
        elif name == "benchmark decontamination":
            items = [brute_words(t) for _, t in rows("benchmark")]
            assert set(after) == {i for i, r in before.items() if not any(held(brute_words(r.text), q) for q in items)}
        else:
            assert {i: r.n_bytes for i, r in after.items()} == {i: len(r.text.encode()) for i, r in before.items()}
        kept["docs"] = after
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF_SMALL).collect()) == sorted(after)


def brute_words(text):
    ws = re.findall(r"[^\W_]+", (text or "").lower())
    k = min(5, len(ws))
    return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} if ws else set()


def held(doc, item):
    return bool(item) and 5 * len(doc & item) >= 4 * len(item)


def test_line_dedup_threshold(spark):
    pages = [(k, "a", f"top\nline {k}\n" + ("rare" if k < 2 else "")) for k in range(20)] + [(99, "b", "top\nrare")]
    df = spark.createDataFrame(pages, "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in lines.drop_boilerplate(df).collect()}
    assert got[0] == "line 0\nrare" and got[5] == "line 5\n" and got[99] == "top\nrare"
