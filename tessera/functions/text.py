"""Column-level text helpers: tokenizer expressions and stop-word tables.

Stop words are Spark ML's default lists, kept as data files beside this module
(see ``stopwords/NOTICE``), so that the same words feed the Spark operators and
the SQL oracle and neither needs Spark's jars.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Token patterns of the original analyses.
#   alphabetic token: maximal run of letters or underscore (no digits),
#                     lower-cased, length 2..20, not starting with '_'
#   word token:       maximal run of letters, digits or underscore
#   word-or-punct:    a word token, or one character that is neither a word
#                     character nor whitespace
#   sentence end:     '.', '!' or '?' followed by whitespace
ALPHA_RE = r"([\p{L}_]+)"
WORD_RE = r"([\p{L}\p{N}_]+)"
WORD_PUNCT_RE = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])"
SENT_END_RE = r"([.!?])\s+"
SENT_MARK = "\u0001"
MIN_LEN, MAX_LEN = 2, 20

LANGUAGES = ("danish dutch english finnish french german hungarian italian norwegian "
             "portuguese russian spanish swedish turkish").split()
# language name -> code used in documents.lang
LANG_CODES = {"english": "en", "french": "fr", "german": "de", "spanish": "es",
              "danish": "da", "dutch": "nl", "finnish": "fi", "hungarian": "hu",
              "italian": "it", "norwegian": "no", "portuguese": "pt", "russian": "ru",
              "swedish": "sv", "turkish": "tr"}


@functools.lru_cache(maxsize=None)
def stop_word_list(language: str) -> tuple[str, ...]:
    path = os.path.join(os.path.dirname(os.path.abspath(__file__)), "stopwords", f"{language}.txt")
    with open(path, encoding="utf-8") as f:
        return tuple(f.read().split("\n")[:-1])


def stop_word_rows(languages=LANGUAGES) -> list[tuple[str, str]]:
    return [(lang, w) for lang in languages for w in stop_word_list(lang)]


def stop_words_df(spark: SparkSession, languages=LANGUAGES) -> DataFrame:
    """(lang, word) table; a few thousand rows, fixed size -> safe to broadcast."""
    return spark.createDataFrame(stop_word_rows(languages), "lang string, word string")


def stop_words_sql(languages=LANGUAGES) -> str:
    """The same table as a DuckDB VALUES list."""
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    vals = ",".join(f"({q(a)},{q(b)})" for a, b in stop_word_rows(languages))
    return f"SELECT * FROM (VALUES {vals}) t(lang, word)"


# ------------------------------------------------------------ Column helpers

def alpha_tokens(text: Column, min_len: int = MIN_LEN, max_len: int = MAX_LEN) -> Column:
    """Maximal letter/underscore runs of length min..max not starting with
    '_'.  The bounds live in the pattern (look-around marks the run ends), so
    no per-element filter function is evaluated."""
    pat = (r"(?<![\p{L}_])\p{L}[\p{L}_]{%d,%d}(?![\p{L}_])"
           % (max(min_len, 1) - 1, max_len - 1))
    return F.regexp_extract_all(F.lower(text), F.lit(pat), 0)


def word_tokens(text: Column, lower: bool = True) -> Column:
    return F.regexp_extract_all(F.lower(text) if lower else text, F.lit(WORD_RE), 1)


def word_punct_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PUNCT_RE), 1)


def ws_tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != "")


def split_sentences(text: Column) -> Column:
    return F.split(F.regexp_replace(text, SENT_END_RE, "$1" + SENT_MARK), SENT_MARK)


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")
