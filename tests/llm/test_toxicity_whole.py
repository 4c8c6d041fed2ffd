"""Words disguised at any position, and tokens of any length."""

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")
from tessera.llm import toxicity  # noqa: E402

TOXIC = ("idiot", "stupid", "loser", "worthless", "trash", "clown", "pathetic", "hate", "whore", "hell", "moronic", "ass")


@pytest.fixture(scope="module")
def restore():
    corpus = f"the {' and the '.join(TOXIC)} is on a road that we know " * 50
    c = toxicity.codes(corpus)
    return toxicity.Restorer(toxicity.CharModel(
        np.bincount((c[:-2] * 64 + c[1:-1]) * 64 + c[2:], minlength=64 ** 3).astype(float)))


def test_recall_at_every_position(restore):
    found, missed = 0, []
    for word in TOXIC:
        for k, letter in enumerate(word):
            for symbol, stands in toxicity.LEET.items():
                if letter in stands and len(stands) <= 2:
                    hidden = word[:k] + symbol + word[k + 1:]
                    ok = word in restore.words(f"and {hidden} that")
                    found += ok
                    missed += [] if ok else [hidden]
    assert found / (found + len(missed)) > 0.95, missed


@pytest.mark.parametrize("hidden,word", [("hat3", "hate"), ("whor3", "whore"), ("a$$", "ass"), ("a55", "ass"), ("idio7!", "idiot"),
                                         ("stupid!!", "stupid"), ("trash*", "trash"), ("whor3.", "whore"), ("moroni(", "moronic")])
def test_at_the_end(restore, hidden, word):
    assert word in restore.words(f"and {hidden} that")


def test_token_without_spaces(restore):
    """A disguised word stands across 64 characters from another symbol."""
    for k in range(12):
        gap = "/that" * (9 + k // 4) + "/we" * (k % 4)
        assert "stupid" in restore.words(f"1d10t{gap}/stup1d/that/road/is"), k
    assert "stupid" in restore.words("1d10t/" + "that/" * 40_000 + "stup1d")
