"""Tokens of a document stay together: no shuffle deals them by word or sentence."""

import re

import pytest

from tessera.operators import summarize as SM
from tessera.operators import text as TO


@pytest.fixture
def docs(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    rows = [(k, f"Cats sit on mat {k}. The dogs chase cats. Mats please all cats and dogs! A park is green.") for k in range(40)]
    yield spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")


def shuffle_keys(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)]


def of_tokens(keys):
    return [k for k in keys if re.search(r"\b(token|term|w|pos)\b", k)]


def test_frequency_scores(docs):
    assert of_tokens(shuffle_keys(SM.frequency_scores(docs)[1])) == []


def test_luhn_scores(docs):
    assert of_tokens(shuffle_keys(SM.luhn_scores(docs)[0])) == []


def test_feature_scores(docs):
    assert of_tokens(shuffle_keys(SM.feature_scores(docs)[1])) == []


@pytest.mark.parametrize("summarize", [SM.summarize_sumbasic, SM.summarize_kl])
def test_greedy_summaries_read_the_tokens_in_one_plan(docs, summarize, monkeypatch):
    """No round writes a table, none deals tokens or sentences anew."""
    monkeypatch.setattr(TO, "cut_lineage", lambda df: pytest.fail("the tokens were written"))
    assert of_tokens(shuffle_keys(summarize(docs, n=3))) == []


def test_bag_and_weights(docs):
    tokens = TO.clean_tokens(docs)
    assert of_tokens(shuffle_keys(TO.max_tf(tokens, a=0.0))) == []
    units = TO.sentences(docs).select("doc_id", "sent_id")
    keys = shuffle_keys(TO.tfidf_smooth(tokens, units))
    assert of_tokens(keys) == [] and not [k for k in keys if "sent_id" in k]


def test_clean_tokens_without_words_or_language(spark):
    rows = [(1, None), (2, ""), (3, "the cat and the dog. Il gatto"), (4, "qwzx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in TO.clean_tokens(docs).collect())
    assert got == [(3, 0, 1, "cat"), (3, 0, 4, "dog"), (3, 1, 0, "il"), (3, 1, 1, "gatto"), (4, 0, 0, "qwzx")]


@pytest.mark.parametrize("weight", ["distance", "similarity"])
def test_textrank_rounds_write_nothing(docs, weight, tmp_path, monkeypatch):
    """All rounds run in one plan, and documents of unlike sizes do not touch each other."""
    import tessera.session
    for module in (SM, TO, tessera.session):
        monkeypatch.setattr(module, "cut_lineage", lambda df: pytest.fail("a table was written"), raising=False)
    more = [(100 + k, " ".join(f"Word{j} follows word{j * k % 7} here. Alone{j}!" for j in range(2 + k))) for k in range(5)]
    mixed = docs.unionByName(docs.sparkSession.createDataFrame(more + [(200, ""), (201, "42. 43.")], docs.schema))
    def scores(df):
        _, units, a = SM.sentence_tfidf(df)
        return {(r.doc_id, r.sent_id): r.score for r in SM.textrank_scores(a, units, weight=weight).collect()}
    got = scores(mixed)
    assert len(got) == mixed.sparkSession.createDataFrame(TO.sentences(mixed).collect()).count()
    for i in (0, 100, 104, 201):
        alone = scores(mixed.filter(f"doc_id = {i}"))
        assert alone and all(got[k] == pytest.approx(v, abs=1e-12) for k, v in alone.items())
        assert sum(alone.values()) == pytest.approx(1, abs=1e-6)


def test_lsa_of_many_documents_in_one_batch(docs):
    _, units, a = SM.sentence_tfidf(docs)
    got = {(r.doc_id, r.term): r.score for r in SM.lsa_word_ranking(a, units, rank=2).collect()}
    _, units, a = SM.sentence_tfidf(docs.filter("doc_id = 7"))
    alone = {(r.doc_id, r.term): r.score for r in SM.lsa_word_ranking(a, units, rank=2).collect()}
    assert alone and all(got[k] == pytest.approx(v, abs=1e-12) for k, v in alone.items())
    assert "ArrowEvalPython" not in (plan := SM.lsa_word_ranking(a, units)._jdf.queryExecution().executedPlan().toString())
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan
