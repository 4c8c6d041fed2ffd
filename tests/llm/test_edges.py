"""Nulls, empty and long texts, ties, repeated rows, empty tables and columns
with clashing names, for every operator."""

import hashlib
import struct

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")
from tessera.llm import (bpe, decontam, embed_dedup, lines, ngram_join, pii, secrets, toxicity, urls,  # noqa: E402
                         warc)

LONG = "lorem ipsum dolor sit amet " * 40_000
#: Besides id and text, columns that operators use as names of their own.
SCHEMA = "doc_id long, text string, id long, score double, cls long, source string, ids string, n long, best string"


@pytest.fixture(scope="module")
def docs(spark):
    some = [(1, "alpha beta gamma delta"), (1, "alpha beta gamma delta"), (2, None), (3, ""), (4, "\x00\n \t"),
            (None, "alpha beta gamma delta"), (5, LONG), (6, LONG + "x"), (7, "é 😀 ​ ﬁ ½"), (1, "other text altogether")]
    return spark.createDataFrame([(i, t, 0, 0.0, 0, "s", "", 0, "") for i, t in some], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_ngram_join(docs, none):
    got = sorted((r.id or 0, r.n_shingles, r.component_id) for r in ngram_join.components(docs).collect())
    assert got == [(0, 2, 1), (1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 5, 5), (6, 6, 6),
                   (7, 3, 7)]
    assert ngram_join.components(none).collect() == []
    assert ngram_join.keep_one(docs).count() == 10 and ngram_join.keep_one(none).count() == 0


def test_bpe(docs, none):
    got = bpe.decode(bpe.encode(docs, path()), path()).collect()
    want = sorted((t or "").encode() for _, t in docs.select("doc_id", "text").collect())
    assert sorted(bytes(r.bytes) for r in got) == want
    assert bpe.decode(bpe.encode(none, path()), path()).collect() == []


def test_bpe_rank_queue():
    import tiktoken
    ranks = bpe.load_ranks(path())
    own = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    enc = bpe.Encoder(ranks, keep=50)
    rng = np.random.default_rng(2)
    some = ["a" * 3000, " " * 999 + "x", "the", "abab" * 300, "日本語" * 99, "x\n\n  y", " \n a \n"]
    some += ["".join(rng.choice(list("aeinrst é\n1!'"), 60)) for _ in range(300)]
    assert [np.frombuffer(b, "<i4").tolist() for b in enc(some)] == [own.encode_ordinary(t) for t in some]
    one = bpe.RankQueue(ranks)
    for t in ("a" * 700, "tionstionst", "Zusammenhang"):
        assert list(one.encode(t.encode())) == own._encode_single_piece(t)


def test_spans(docs, none):
    for module in (pii, secrets):
        got = module.find(docs).collect()
        assert len(got) == 10 and not any(r.base or r.added for r in got)
        assert module.find(none).collect() == []


def test_pii_adds_what_the_base_misses(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(400):
        n = "".join(map(str, rng.integers(2, 10, 10)))
        rows.append((k, f"ring me at +1 ({n[:3]}) {n[3:6]}-{n[6:]} or write to user{k}@mail{k % 9}.example.com today"))
    rows.append((1000, "call (284) 555-0850 now"))
    rows.append((1001, "contact: jane [at] example [dot] com"))
    rows.append((1002, "on 2021-04-05 the order 2021 was paid"))
    got = {r.id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.kind, s.start, s.end) for s in got[1000].added] == [("phone", 5, 19)]
    assert [s.kind for s in got[1001].added] == ["email"]
    assert not got[1002].added
    assert sum(bool(got[k].added) for k in range(400)) == 0


def test_secrets_lexer():
    text = ('DB_PASS = "s3cr3t-Hunter2!x"\npassword = DB_PASS\ncfg = {"passwordFile": "/etc/app/pw.txt", "pwd": "Tr0ub4dor&3"}\n'
            'password: changeme\n<privateKey>MIIBVwIBADANBg</privateKey>\nname = "Tr0ub4dor&4"\ntimeout=30seconds1\n')
    base = secrets.base_spans(text)
    got = [text[s.start:s.end] for s in secrets.added_spans(text, base)]
    assert got == ["s3cr3t-Hunter2!x", "Tr0ub4dor&3", "MIIBVwIBADANBg"]
    # ASCII letters only match in either case
    assert secrets.base_spans("toKen=abcdefgh1") == [] and len(secrets.base_spans("ToKeN=abcdefgh1")) == 1


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0.0), (2, 0, 0.0), (None, 1, 0.0), (3, None, 0.0)], "doc_id long, toxic int, score double")
    for d, n in ((docs, 10), (none, 0)):
        model = toxicity.train(d, labels)
        got = toxicity.score(d, model).collect()
        assert len(got) == n and all(0 <= r.score <= 1 for r in got)
        assert toxicity.without_toxic(d, model, 1.1).count() == n
    assert toxicity.train(docs, labels.limit(0)).weights == {}


def test_deobfuscation():
    corpus = "the idiot and the stupid loser is worthless trash of a clown and that is pathetic " * 50
    c = toxicity.codes(corpus)
    model = toxicity.CharModel(np.bincount((c[:-2] * 64 + c[1:-1]) * 64 + c[2:], minlength=64 ** 3).astype(float))
    restore = toxicity.Restorer(model)
    for hidden, word in {"1d10t": "idiot", "s t u p i d": "stupid", "looooser": "loser", "tr@$h": "trash", "cl*wn": "clown",
                         "w-o-r-t-h-l-e-s-s": "worthless", "p4th3tic!!": "pathetic"}.items():
        assert word in restore.words(f"and {hidden} that"), hidden
    assert restore.words("The idea, of it.") == {"the", "idea", "of", "it"}


def test_urls(spark):
    some = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "https://A.Example.NET/en/x?y#z"), (6, "http://example.net"),
            (7, "http://x.org/fr/"), (8, "http://x.org/FR/"), (9, "http://notnet/"), (10, "http://b.example.com/de/" + "a" * 100_000),
            (11, "http://q.com:80/x"), (12, "http://ads-track.com/"), (12, "http://ads-track.com/"), (13, "ftp://y.net/"),
            (None, "http://net/")]
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in some], "page_id long, url string, host string, path string")
    got = {r.id: (r.host, r.rule, r.verdict) for r in urls.judge(df).collect()}
    assert urls.judge(df).count() == 15 and urls.judge(df.limit(0)).count() == 0
    assert got[1] == got[2] == got[3] == got[4] == ("", None, "allow")
    assert got[5] == ("a.example.net", "example.net/en/", "allow") and got[6] == ("example.net", None, "allow")
    assert got[7][1:] == ("org/fr/", "allow") and got[8][1:] == (None, "allow") and got[9][1] is None
    assert got[10][1:] == ("example.com/de/", "block") and got[11][0] == "q.com:80"
    assert got[12][1:] == (None, "block") and got[13][1:] == got[None][1:] == ("net/", "block")
    # the same in blocks of two rules
    assert {r.id: (r.host, r.rule, r.verdict) for r in urls.judge(df, block=2).collect()} == got


def test_warc(spark):
    big, other = "<p>" + "same " * 50, "<p>" + "ñ" * 99
    some = [(4, "u4", big), (2, "u2", big), (2, "u2", big), (9, None, big), (1, "u1", None), (5, "u5", ""), (6, "a\r\nb", "short"),
            (7, "u7", "short"), (8, "u8", other), (None, "u", big), (None, "v", "only null " * 30), (3, "u3", LONG)]
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in some], "page_id long, url string, html string, digest string")
    folder = warc.new_folder(spark)
    manifest = warc.write(df, folder)
    got = warc.read(manifest, folder).collect()
    assert len(got) == len(some) and manifest.agg({"records": "sum"}).first()[0] == len(some)
    for r in got:
        if r.payload is not None:
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got if r.payload_bytes == len(big))
    assert kinds == [(0, "revisit", 2), (2, "response", None), (2, "response", None), (4, "revisit", 2), (9, "revisit", 2)]
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 100 or r.page_id in (3, 8))
    assert warc.read(warc.write(df.limit(0), folder), folder).collect() == []


def test_warc_frames():
    """A skippable frame with the dictionary, then one frame for each record."""
    import io
    import zstandard
    records = [warc.record("response", k, f"http://x/{k}", (f"<html>page {k} " + "words of a page " * (k % 40)).encode(), "d" * 64)
               for k in range(300)]
    parts = list(warc.compressed(records))
    magic, size = struct.unpack("<II", parts[0][:8])
    assert magic == 0x184D2A5D and size == len(parts[0]) - 8 > 0
    d = zstandard.ZstdCompressionDict(parts[0][8:])
    assert [zstandard.ZstdDecompressor(dict_data=d).decompress(p) for p in parts[1:]] == records
    got = list(warc.records_of(io.BytesIO(b"".join(parts))))
    assert len(got) == 300 and got[7][0]["X-Page-Id"] == "7" and got[7][1].startswith(b"<html>page 7 ")
    assert sum(map(len, parts)) < sum(map(len, records)) / 3


def test_lines(docs, none):
    got = lines.drop_boilerplate(docs)
    assert got.columns == docs.columns and got.count() == 10 and lines.drop_boilerplate(none).count() == 0
    texts = [r.text for r in got.where("doc_id = 1 or doc_id is null").collect()]
    assert sorted(texts) == ["", "", "", "other text altogether"]       # on 3 of the 10 rows of the source
    assert got.where("doc_id = 2").first().text is None


def test_decontam(spark, docs, none):
    items = spark.createDataFrame([(1, "lorem ipsum dolor sit amet lorem", "x"), (2, None, "x"), (3, "", "x"), (4, "alpha BETA gamma, delta", "x"),
                                   (5, "quite another item of some length", "x"), (1, "lorem ipsum dolor sit amet lorem", "x")],
                                  "item_id long, text string, doc_id string")
    got = sorted((r.doc_id or 0, r.item_id, r.shared) for r in decontam.contaminated(docs, items).collect())
    assert got == [(0, 4, 1), (1, 4, 1), (1, 4, 1), (5, 1, 2), (5, 1, 2), (6, 1, 2), (6, 1, 2)]
    assert decontam.contaminated(none, items).count() == 0 and decontam.contaminated(docs, items.limit(0)).count() == 0
    assert sorted(r.doc_id for r in decontam.without_contaminated(docs, items).collect()) == [1, 2, 3, 4, 7]
    # in several blocks of items
    assert sorted((r.doc_id or 0, r.item_id, r.shared) for r in
                  decontam.contaminated(docs, items, block_shingles=1).collect()) == got


def test_decontam_short_items(spark):
    """Items of fewer words than a shingle are found inside longer documents."""
    docs = spark.createDataFrame([(1, "we say Hello, World! twice a day"), (2, "hello there world"), (3, "hello world"),
                                  (4, "x yes"), (5, ""), (6, None), (7, "one two three four five six seven")], "doc_id long, text string")
    items = spark.createDataFrame([(10, "hello world"), (11, "YES"), (12, ""), (13, None), (14, "two three four five"),
                                   (15, "two three four five six"), (16, "seven eight")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.item_shingles, r.shared) for r in decontam.contaminated(docs, items).collect())
    assert got == [(1, 10, 1, 1), (3, 10, 1, 1), (4, 11, 1, 1), (7, 14, 1, 1), (7, 15, 1, 1)]
    assert sorted(r.doc_id for r in decontam.without_contaminated(docs, items).collect()) == [2, 5, 6]


def test_decontam_scattered_and_partial(spark):
    rng = np.random.default_rng(4)
    item = [f"i{k}" for k in range(44)]
    noise = [f"n{k}" for k in rng.integers(0, 10 ** 6, 20_000)]
    halves = noise[:500] + item[:24] + noise[500:900] + item[20:] + noise[900:]
    part = noise[:700] + item[:34] + noise[700:]        # 30 of 40 shingles
    most = noise[:700] + item[:36] + noise[700:]        # 32 of 40
    df = spark.createDataFrame([(1, " ".join(halves)), (2, " ".join(part)), (3, " ".join(most)), (4, " ".join(noise))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert sorted((r.doc_id, r.shared) for r in decontam.contaminated(df, items).collect()) == [(1, 40), (3, 32)]


def test_embeddings(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(6, 24))
    some, k = [], 0
    for b in base:
        for eps in (0, 0, 0.03, 0.05, 0.1, 0.2):
            some.append((k, (b + eps * rng.normal(size=24)).tolist(), int(k % 3 == 0)))
            k += 1
    some += [(100, None, 1), (101, [0.0] * 24, 1), (102, [float("nan")] * 24, 1), (103, [1.0, None], 1), (104, [], 1),
             (105, base[0].tolist(), None), (106, [float("inf")] + [1.0] * 23, 1), (107, [1.0, 2.0], 1), (108, [2.0, 4.0], 1),
             (None, [1.0, 2.0], 1), (3, [3.0, 6.0], 1)]
    df = spark.createDataFrame([(i, v, y, 0) for i, v, y in some], "vec_id long, embedding array<double>, label int, cls int")
    ok = [v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v) and y is not None for _, v, y in some]
    links = [[b for b in range(len(some)) if b != a and ok[a] and ok[b] and some[a][2] == some[b][2] and len(some[a][1]) == len(some[b][1])
              and np.dot(some[a][1], some[b][1]) / np.linalg.norm(some[a][1]) / np.linalg.norm(some[b][1]) >= 0.98] for a in range(len(some))]
    want = []
    for a in range(len(some)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        least = min((some[b][0] for b in seen if some[b][0] is not None), default=None)
        want.append((some[a][0], len(links[a]), least, some[a][0] is not None and some[a][0] == least))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    got = [tuple(r) for r in embed_dedup.near_duplicates(df).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_chunks(spark, monkeypatch):
    """A bucket beyond a chunk's size is compared in pairs of chunks."""
    monkeypatch.setattr(embed_dedup, "CHUNK", 8)
    rng = np.random.default_rng(1)
    x = rng.normal(size=16) + 0.01 * rng.normal(size=(60, 16))
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = embed_dedup.near_duplicates(df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(59, 0)}


def test_ngram_join_chunks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 4)
    monkeypatch.setattr(ngram_join, "SMALL", 1)
    words = [f"w{k}" for k in range(300)]
    docs = [(k, " ".join(words[:k * 3] + ["x%d" % k] + words[k * 3:])) for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = ngram_join.components(df, heads=0).collect()
    assert {r.component_id for r in got} == {0}
