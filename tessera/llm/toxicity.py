"""Toxicity of texts behind a noisy channel.

Writers hide words by leetspeak (``1d10t``), spacing (``s t u p i d``) and
repetition (``looooser``).  Every stretch that may be so written becomes a
lattice of characters: each symbol is itself, a letter it stands for, or
nothing, each repeated letter once or twice.  The Viterbi path of the lattice
under a character trigram model of the whole corpus restores the text, and a
linear model scores the restored words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Shared, arrow_schema, bounded_sample, factory, filter_rows, map_texts, tidy

#: Letters of the model; anything else is a boundary (0), other letters are 63.
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßéèêëàâáçîïíìôóòûùúñœæ"
CODE = {c: k for k, c in enumerate(LETTERS, 1)}
SIZE = 64
_CODES = np.array([CODE.get(chr(i), 63 if chr(i).isalpha() else 0) for i in range(0x500)], np.int32)

_ANY = "abcdefghijklmnopqrstuvwxyz"
#: What a symbol may stand for (fixed values of common leetspeak).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i", "§": "s",
    "*": _ANY, "#": _ANY, "%": _ANY,
}
_SYMBOLS = re.escape("".join(LEET))
#: What makes a stretch suspect: a symbol or separator before a letter or a symbol
#: after one (the whole token is read then), single letters apart, a letter three
#: times in a row.
_INSIDE = re.compile(rf"[{_SYMBOLS}._~-](?=[^\W\d_])|(?<=[^\W\d_])[{_SYMBOLS}]")
_APART = re.compile(r"(?<!\w)[^\W_](?:[\x20._*~-][^\W_])(?:[\x20._*~-][^\W_])+(?!\w)")
_THRICE = re.compile(r"([^\W\d_])\1\1", re.I)
_TOKEN = re.compile(r"\S*")


def stretches(text: str) -> list[str]:
    """Stretches that may be disguised."""
    out, end = [], 0
    for m in _INSIDE.finditer(text):
        i = m.start()
        if i < end:
            continue
        lo, end = i, _TOKEN.match(text, i).end()
        while lo and not text[lo - 1].isspace():
            lo -= 1
        out.append(text[lo:end])
    out += [m[0] for m in _APART.finditer(text)]
    end = 0
    for m in _THRICE.finditer(text):
        if m.start() < end:
            continue
        lo, end = m.span()
        while lo and text[lo - 1].isalpha():
            lo -= 1
        while end < len(text) and text[end].isalpha():
            end += 1
        out.append(text[lo:end])
    return out


_WORD = re.compile(r"[^\W\d_]+")

#: Costs of the channel, in nats: reading a symbol as a letter, as nothing; a
#: separator as nothing, as a boundary; a doubled letter as one.  Of the symbols
#: at the end of a stretch those that prose ends with are nothing at no cost.
AS_LETTER, AS_NOTHING, JOINED, APART, ONCE = 1.0, 8.0, 0.5, 3.0, 1.5


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    return np.where(points < len(_CODES), _CODES[np.minimum(points, len(_CODES) - 1)], 0)


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of character trigrams in all texts, each text between boundaries.

    Tasks count in arrays and send one row per trigram that they met; these are
    summed by trigram, and at most 64^3 sums reach the driver.
    """
    shape = arrow_schema("gram int, n long")

    def run(batches):
        total = np.zeros(SIZE ** 3, np.int64)
        for b in batches:
            texts = [t for t in b.column(0).to_pylist() if t]
            at = 0
            while at < len(texts):
                part, size = [], 0
                while at < len(texts) and size < 2_000_000:
                    part.append(texts[at])
                    size += len(texts[at])
                    at += 1
                c = codes("  ".join(["", *part, ""]))
                total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE ** 3)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], schema=shape)

    got = (docs.select(docs[text_col].alias("text")).mapInArrow(run, "gram int, n long")
           .groupBy("gram").agg(F.sum("n").alias("n")))
    counts = np.zeros(SIZE ** 3)
    for r in got.collect():
        counts[r.gram] = r.n
    return counts


class CharModel:
    """Log probabilities of a character after two others, interpolated with
    the shorter contexts."""

    def __init__(self, counts: np.ndarray):
        c3 = counts.reshape(SIZE, SIZE, SIZE)
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 1) / (c1.sum() + SIZE)
        p2 = (c2 + 8 * p1) / (c2.sum(1, keepdims=True) + 8)
        p3 = (c3 + 4 * p2[None]) / (c3.sum(2, keepdims=True) + 4)
        self.log = np.log(p3).astype(np.float32)


def lattice(stretch: str) -> list[list[tuple[str, float]]]:
    """Per position the readings (characters, cost); a run of one letter is one
    position."""
    low = stretch.lower().rstrip(".,;:?-~_\"')")
    out, tail = [], len(low.rstrip("!*#%|+(.,;:?-~_\"')"))
    spaced = re.fullmatch(r"(?:[^\W_][\x20._*~-])+[^\W_]", low) is not None
    k = 0
    while k < len(low):
        c = low[k]
        run = k + 1
        while run < len(low) and low[run] == c and (c.isalpha() or c in LEET):
            run += 1
        n = run - k
        if c.isalpha():
            out.append([(c, 0.0)] if n == 1 else [(c + c, 0.0), (c, ONCE)] if n == 2 else [(c, 0.0), (c + c, 0.5)])
        elif c in LEET and not (spaced and c == "*"):
            one, two = (AS_LETTER, 99.0) if n == 1 else (AS_LETTER + ONCE, AS_LETTER)
            if len(LEET[c]) > 2:
                one += AS_LETTER
            ways = [(x, one) for x in LEET[c]] + [("", AS_NOTHING if k < tail else 0.0)]
            if n > 1:
                ways += [(x + x, two) for x in LEET[c]]
            out.append(ways)
        elif k >= tail:
            out.append([("", 0.0)])
        else:
            out.append([("", JOINED), (" ", APART)])
        k = run
    return out


def decode(stretch: str, model: CharModel) -> str:
    """The Viterbi path.  A state is the last two characters, so the work grows
    with the length of the stretch; what all paths share is kept as text."""
    log, out = model.log, []
    states = {(0, 0): (0.0, None)}          # -> (cost, back pointer)
    for ways in lattice(stretch) + [[(" ", 0.0)]]:
        new: dict = {}
        for (a, b), (cost, back) in states.items():
            for chars, extra in ways:
                x, y, total = a, b, cost + extra
                for c in chars:
                    z = CODE.get(c, 63 if c.isalpha() else 0)
                    if z == 0 and y == 0:
                        continue
                    total -= float(log[x, y, z])
                    x, y = y, z
                old = new.get((x, y))
                if old is None or total < old[0]:
                    new[x, y] = (total, (back, chars))
        states = new
        if len(states) == 1:
            (key, (cost, back)), = states.items()
            out.append(_path(back))
            states = {key: (cost, None)}
    _, back = min(states.values(), key=lambda s: s[0])
    return "".join([*out, _path(back)]).strip()


def _path(back) -> str:
    """The characters that a back pointer leads over."""
    out = []
    while back:
        back, chars = back
        out.append(chars)
    return "".join(reversed(out))


class Restorer:
    """Restored words of a text; readings are remembered, up to ``keep``."""

    def __init__(self, model: CharModel, keep: int = 200_000):
        self.model, self.keep, self.known = model, keep, {}

    def words(self, text: str) -> set[str]:
        """Words of the text as written and as restored, in lower case."""
        out = set(_WORD.findall(text.lower()))
        for s in stretches(text):
            got = self.known.get(s)
            if got is None:
                if len(self.known) > self.keep:
                    self.known.clear()
                got = tuple(_WORD.findall(decode(s, self.model)))
                if len(s) <= 128:
                    self.known[s] = got
            out.update(got)
        return out


#: Features are hashes of so many bits.
MASK = (1 << 22) - 1


def _hash(s: str) -> int:
    import xxhash
    return xxhash.xxh32_intdigest(s) & MASK


def word_features(word: str) -> tuple[int, tuple[int, ...]]:
    """Hash of a word, and those of its first three, four and five letters, the
    stems that it may share with others."""
    return _hash(word), tuple(_hash(word[:k] + "~") for k in (3, 4, 5) if len(word) > k)


def level(stem: int, n: int) -> int:
    """Feature of a stem that n different words of a text share."""
    return (stem + n * 0x1E3779B1) & MASK


def features(words: set[str]) -> set[int]:
    """Features of a text: its words, and the stems that one, two, or three and
    more different words share."""
    out, stems = set(), Counter()
    for w in words:
        own, begins = word_features(w)
        out.add(own)
        stems.update(begins)
    for stem, n in stems.items():
        out.update(level(stem, k) for k in range(1, min(n, 3) + 1))
    return out


class Model(NamedTuple):
    chars: CharModel
    bias: float
    weights: dict[int, float]


def fit(ids: np.ndarray, sizes: np.ndarray, y: np.ndarray, rounds: int = 2, stages: int = 100,
        gain: float = 11.0) -> tuple[float, dict[int, float]]:
    """Logistic regression on presence of features, given text after text
    (``sizes`` of them each).

    A round goes forward in stages: each adds the feature whose score statistic,
    a chi-square, is largest and refits; it ends when none reaches ``gain`` (four
    texts that nothing explains yet) or after ``stages``.  What the stems already
    explain so lends no weight to the chance words of copied documents.  The
    next round starts afresh without the features of the earlier ones, and without
    those that stand in nine tenths of the same texts, and finds words that mostly
    stood beside those.  At last all are fitted together.
    """
    y = y.astype(float)
    if not len(y) or y.min() == y.max():
        return (float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))) if len(y) else -5.0), {}
    often = np.bincount(ids, minlength=MASK + 1) >= 5
    names, number = np.flatnonzero(often), np.cumsum(often, dtype=np.int32) - 1
    keep = often[ids]
    # entries (feature, text) sorted by both, packed while they are sorted
    entries = number[ids[keep]].astype(np.int64) << 32
    entries |= np.repeat(np.arange(len(y), dtype=np.int32), sizes)[keep]
    del ids, keep, often, number
    entries.sort()
    starts = np.searchsorted(entries, np.arange(len(names) + 1, dtype=np.int64) << 32)
    doc = entries.astype(np.int32)
    del entries
    ridge = 0.02
    edges = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(doc), 1 << 20)), len(names)))

    def per_feature(values):
        """Sums over the texts that hold each feature, some features at a time."""
        out = np.empty(len(names))
        for f, g in zip(edges[:-1], edges[1:]):
            out[f:g] = np.add.reduceat(values[doc[starts[f]:starts[g]]], starts[f:g] - starts[f])
        return out

    def columns(features):
        x = np.zeros((len(y), len(features)))
        for k, f in enumerate(features):
            x[doc[starts[f]:starts[f + 1]], k] = 1
        return x

    def newton(x, bias, w, steps):
        for _ in range(steps):
            p = 1 / (1 + np.exp(-(bias + x @ w)))
            a = np.hstack([np.ones((len(y), 1)), x])
            g = a.T @ (y - p) - ridge * np.append(0, w)
            h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(np.append(1e-6, np.full(len(w), ridge)))
            step = np.clip(np.linalg.solve(h, g), -2, 2)
            bias, w = bias + step[0], w + step[1:]
            if np.abs(step).max() < 1e-3:
                break
        return bias, w

    start = math.log(y.mean() / (1 - y.mean()))
    chosen: list[int] = []
    df, banned = np.diff(starts), np.zeros(len(names), bool)
    for _ in range(rounds if len(names) else 0):
        active, bias, w = [], start, np.empty(0)
        while len(active) < stages:
            x = columns(active)
            bias, w = newton(x, bias, w, 8)
            p = 1 / (1 + np.exp(-(bias + x @ w)))
            g = per_feature(y - p)
            chi = g * np.abs(g) / (per_feature(p * (1 - p)) + 1.0)
            chi[banned] = 0                             # and only features that speak for the label
            chi[active] = 0
            best = int(chi.argmax())
            if chi[best] < gain:
                break
            active.append(best)
            w = np.append(w, 0.0)
        chosen += active
        for f in active:
            both = per_feature(np.bincount(doc[starts[f]:starts[f + 1]], minlength=len(y)).astype(float))
            banned |= both >= 0.9 * np.maximum(df, df[f])
    bias, w = newton(columns(chosen), start, np.zeros(len(chosen)), 50)
    return float(bias), {int(names[k]): float(v) for k, v in zip(chosen, w)}


def held_out(id_col):
    """Rows whose crc32 of the id as text leaves 2 divided by 4."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = 10_000) -> Model:
    """The trigram model of all ``docs`` and the classifier.

    The classifier is fitted on at most ``sample`` labelled rows that are not
    held out, those with the smallest hashes of their ids; their ids and words'
    hashes are all that reaches the driver.
    """
    chars = CharModel(trigram_counts(docs, text_col))
    spark = docs.sparkSession
    shared = Shared(spark, chars)
    chosen = bounded_sample(
        labels.where(labels[label_col].isin(0, 1) & labels[id_col].isNotNull() & ~held_out(labels[id_col]))
        .select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("y")), sample, "id", "y")
    rows = (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
            .join(F.broadcast(chosen), "id").select("id", "y", "text"))     # at most `sample` small rows

    @factory
    def make():
        restore = Restorer(shared.value)

        def work(ids, y, texts):
            got = [np.array(sorted(features(restore.words(t or ""))), np.int32) for t in texts]
            return {"id": ids, "y": y, "f": got}
        return work

    kind = rows.schema["id"].dataType.simpleString()
    got = map_texts(rows, make, f"id {kind}, y int, f array<int>").toArrow().sort_by([("id", "ascending"), ("y", "ascending")])
    sizes = np.array([len(f) for f in got["f"]], np.int64)
    y = got["y"].to_numpy()
    ids = np.concatenate([np.asarray(f.values) for f in got["f"]]) if len(sizes) else np.empty(0, np.int32)
    del got
    tidy()
    return Model(chars, *fit(ids, sizes, y))


def scorer(model: Model, readings: int = 200_000, words: int = 400_000):
    """Function from a text to its score; it remembers so many readings and words."""
    restore, weights, known = Restorer(model.chars, readings), model.weights, {}

    def carry(word):
        own, begins = word_features(word)
        return (own if own in weights else None,
                tuple(b for b in begins if any(level(b, n) in weights for n in (1, 2, 3))))

    def rate(text: str | None) -> float:
        found, shared = set(), {}
        if len(known) > words:
            known.clear()
        for w in restore.words(text) if text else ():
            f = known.get(w)
            if f is None:
                f = carry(w)
                f = known[w] = f if f[0] is not None or f[1] else ()
            if f:
                if f[0] is not None:
                    found.add(f[0])
                for b in f[1]:
                    shared[b] = shared.get(b, 0) + 1
        for b, n in shared.items():
            found.update(k for k in (level(b, i) for i in range(1, min(n, 3) + 1)) if k in weights)
        z = model.bias + sum(weights[k] for k in sorted(found))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    return rate


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): probability of label 1, one row per input row; a null or
    empty text has the score of no words at all."""
    shared = Shared(docs.sparkSession, model)

    @factory
    def make():
        rate = scorer(shared.value)
        return lambda ids, texts: {"id": ids, "score": [rate(t) for t in texts]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), make,
                     f"id {kind}, score double")


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns."""
    shared = Shared(docs.sparkSession, model)

    @factory
    def make():
        rate = scorer(shared.value, 100_000, 150_000)       # less memory: other stages share the executors
        return lambda texts: [rate(t) < limit for t in texts]

    return filter_rows(docs, text_col, make)
