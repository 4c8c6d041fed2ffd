"""Personal data: candidate spans judged by gradient-boosted trees.

Generators of high recall propose spans that may overlap.  A base detector per
kind (a pattern with a check of its digits) marks spans that always count.
Boosted trees score the other candidates by format and context; a threshold per
kind, calibrated on held-out candidates, selects the ones to redact.

The trees learn from the corpus itself: base spans, and respellings of them that
the base patterns miss (a number without its plus sign, other separators, a
spelled-out ``at``), are positive; numbers and names that no base pattern takes,
and corrupted spans, are negative.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from itertools import accumulate
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Shared, bounded_samples, cut_lineage, factory, map_texts

KINDS = ("email", "ip", "card", "phone")
#: Characters of the longest span that the trees learn from; all are scored, whole.
EXAMPLE = 1000

#: Base patterns (fixed by the contract), possessive where that changes nothing.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

#: High-recall candidates: (kind, pattern).
GENERATORS = [
    ("ip", re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20./-]?[0-9]{2,6}){2,5}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+])(?:00[0-9]{1,3}[\x20./-]?)?\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){1,4}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+])[0-9]{7,15}(?![0-9A-Za-z])")),
]

#: A spelled-out ``at`` and a host; the name before it is found backwards.
_AT_WORD = re.compile(r"(?:\x20?[\[({<]\x20?(?:at|AT)\x20?[\])}>]\x20?|\x20(?:at|AT)\x20)[A-Za-z0-9-]{1,63}"
                      r"(?:(?:\.|\x20?[\[({<]\x20?(?:dot|DOT)\x20?[\])}>]\x20?|\x20(?:dot|DOT)\x20)"
                      r"[A-Za-z0-9-]{1,63}){1,4}")

#: Words near a span that speak for a kind, or against personal data.
CUES = {
    "email": re.compile(r"(?i)mail|contact|write to|address|correo|kontakt"),
    "ip": re.compile(r"(?i)\bip\b|ipv|host|server|login from|client|addr"),
    "card": re.compile(r"(?i)card|visa|master|amex|credit|debit|carte|tarjeta|karte|payment"),
    "phone": re.compile(r"(?i)phone|call|tel\b|tel[.:]|mobile|fax|cell|whatsapp|sms|telefon|tél|móvil"),
    "none": re.compile(r"(?i)isbn|order|version|invoice|doi|page|vol|no\.|id\b|date|year|total|price|[$€£%#]"),
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping matches, found from each ``@`` outwards."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        i = at
        while i > free and text[i - 1] in _LOCAL:
            i -= 1
        m = _DOMAIN.match(text, at + 1) if i < at else None
        if m:
            out.append(Span("email", i, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Base spans of all kinds, by start and then kind."""
    out = emails(text) if "@" in text else []
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append(Span("ip", *m.span()))
        for m in _CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append(Span("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.findall(m[0])) <= 15:
                out.append(Span("phone", *m.span()))
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def candidates(text: str) -> list[Span]:
    """Proposed spans, also overlapping ones; base spans are not among them."""
    out = []
    for m in _AT_WORD.finditer(text):
        i = m.start()
        while i and text[i - 1] in _LOCAL:
            i -= 1
        if i < m.start():
            out.append(Span("email", i, m.end()))
    if _DIGITS.search(text):
        for kind, pattern in GENERATORS:
            out.extend(Span(kind, *m.span()) for m in pattern.finditer(text))
    return out


#: Features of a candidate, in this order.
FEATURES = ("kind", "length", "digits", "letters", "groups", "longest_group", "shortest_group", "first_group",
            "last_group", "seps", "kinds_of_sep", "dots", "colons", "slashes", "plus", "paren", "luhn", "distinct",
            "year", "run", "lead", "at", "spelled", "word_before", "word_after", "digit_near",
            *(f"cue_{k}" for k in CUES))


def features(text: str, span: Span) -> list[float]:
    """Format of the span and context of 48 characters before, 16 after it."""
    s = text[span.start:span.end]
    groups = re.findall(r"[0-9]+", s) or [""]
    digits = "".join(groups)
    seps = re.findall(r"[^0-9A-Za-z]+", s)
    before, after = text[max(0, span.start - 48):span.start], text[span.end:span.end + 16]
    near = before[-24:] + " " + after
    return [
        KINDS.index(span.kind), len(s), len(digits), sum(map(str.isalpha, s)), len(groups),
        max(map(len, groups)), min(map(len, groups)), len(groups[0]), len(groups[-1]), len(seps), len(set(seps)),
        s.count("."), s.count(":"), s.count("/"), s.startswith("+"), "(" in s,
        12 <= len(digits) <= 19 and luhn(digits), len(set(digits)),
        any(len(g) == 4 and g[:2] in ("19", "20") for g in groups),
        max((len(m[0]) for m in re.finditer(r"([0-9])\1*", digits)), default=0),
        int(digits[0]) if digits else -1, "@" in s or bool(re.search(r"(?i)\bat\b", s)),
        len(re.findall(r"(?i)[\[({<]\x20?(?:at|dot)\x20?[\])}>]|\x20dot\x20", s)),
        before[-1:].isalnum(), after[:1].isalnum(), bool(re.search(r"[0-9]", before[-6:] + after[:6])),
        *(bool(p.search(before if k != "none" else near)) for k, p in CUES.items()),
    ]


def respelled(span_text: str, kind: str, rng: random.Random) -> str:
    """A spelling of a base span that the base pattern misses."""
    if kind == "email":
        name, _, host = span_text.partition("@")
        if host.count(".") > 1 and rng.random() < 0.5:  # hosts of fewer labels
            host = host.split(".", 1)[1]
        if rng.random() < 0.5:                          # names and hosts without digits
            name, host = (re.sub("[0-9.]", "", x) or "info" if k == 0 else re.sub("[0-9]", "", x).strip(".") or "example.org"
                          for k, x in enumerate((name, host)))
        at, dot = rng.choice([(" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "."), (" [at] ", ".")])
        return name + at + host.replace(".", dot)
    digits = re.sub("[^0-9]", "", span_text)
    if kind == "phone":
        d = digits[-10:]
        return rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"]).format(d[:3], d[3:6], d[6:])
    if kind == "card":
        sep = rng.choice([".", "/"])
        return sep.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    return ":".join([f"{int(p):x}" for p in span_text.split(".")] + ["0", "1", "abcd", "1f"])


def corrupted(kind: str, rng: random.Random) -> str:
    """A look-alike that is no personal data: dates, amounts, ratios, codes."""
    r = rng.randint
    if kind == "email":
        return rng.choice(["look at this.place", "was at home.He", "meet at noon dot", "stay at x.y"])
    if kind == "ip":
        return rng.choice([f"{r(0, 23):02}:{r(0, 59):02}:{r(0, 59):02}:{r(0, 99):02}", "1:2:3:4"])
    if kind == "card":
        return rng.choice([f"{r(1900, 2030)}-{r(1, 12):02}-{r(1, 28):02}-{r(0, 99):02}", "0000 0000 0000 0000",
                           f"{r(1000, 9999)} {r(10, 99)} {r(10, 99)}", f"{r(1900, 2030)}{r(10 ** 7, 10 ** 9)}"])
    return rng.choice([f"{r(1900, 2030)}-{r(1, 12):02}-{r(1, 28):02}", f"{r(1, 28):02}.{r(1, 12):02}.{r(1900, 2030)}",
                       f"{r(1, 28):02}/{r(1, 12):02}/{r(1900, 2030)}", f"{r(10 ** 6, 10 ** 12)}", f"{r(10, 99)} {r(10, 99)}",
                       f"{r(10, 999)} {r(100, 999)} {r(100, 999)}", f"{r(100, 999)}-{r(10, 99)}", f"{r(1, 99)}.{r(10, 99)}"])


class Boosted:
    """Gradient-boosted trees of logistic loss on binned features."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "Boosted":
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T]
        b = self.binned(x)
        mean = float(np.average(y, weights=weight))
        self.bias = float(np.log((mean + 1e-6) / (1 - mean + 1e-6)))
        score, self.trees = np.full(len(y), self.bias), []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._tree(b, weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6))
            score += self._apply(tree, b)
            self.trees.append(tree)
        return self

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([c.searchsorted(v, "right") for c, v in zip(self.cuts, x.T)], 1)

    def _tree(self, b, grad, hess):
        """Complete tree: feature and cut of each inner node, value of each leaf."""
        inner, node = [], np.zeros(len(b), np.int64)
        for level in range(self.depth):
            n = 1 << level
            g0, h0 = np.bincount(node, grad, n), np.bincount(node, hess, n)
            best, choice = np.full(n, 1e-9), np.zeros((n, 2), np.int64)
            choice[:, 1] = self.bins
            for f in range(b.shape[1]):
                k = node * self.bins + b[:, f]
                g = np.bincount(k, grad, n * self.bins).reshape(n, -1).cumsum(1)
                h = np.bincount(k, hess, n * self.bins).reshape(n, -1).cumsum(1)
                gr, hr = g0[:, None] - g, h0[:, None] - h
                gain = g ** 2 / (h + 1) + gr ** 2 / (hr + 1) - (g0 ** 2 / (h0 + 1))[:, None]
                gain[(h < 0.5) | (hr < 0.5)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(n), at]
                choice[top > best] = np.stack([np.full(n, f), at], 1)[top > best]
                best = np.maximum(best, top)
            inner.append(choice)
            node = node * 2 + (b[np.arange(len(b)), choice[node, 0]] > choice[node, 1])
        n = 1 << self.depth
        return inner, self.rate * np.bincount(node, grad, n) / (np.bincount(node, hess, n) + 1)

    @staticmethod
    def _apply(tree, b):
        inner, leaf = tree
        node = np.zeros(len(b), np.int64)
        for choice in inner:
            node = node * 2 + (b[np.arange(len(b)), choice[node, 0]] > choice[node, 1])
        return leaf[node]

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        return 1 / (1 + np.exp(-(self.bias + sum(self._apply(t, b) for t in self.trees))))


class Model(NamedTuple):
    trees: Boosted
    thresholds: dict[str, float]


def train(examples: list[tuple[str, str, str, str, bool]], precision: float = 0.98, seed: int = 7) -> Model | None:
    """From (kind, span text, text before, text after, is a base span).

    Every base span gives a respelled positive and a look-alike negative in the
    same place; candidates that no base pattern takes may be personal data all the
    same, so they are negatives of a tenth of the weight.  Cue words are put before one half of the positives and one in
    ten of the negatives.  A third of the examples is held out; a kind's
    threshold lies halfway below the lowest score, 0.5 or more, at which the
    held-out candidates above are positive with the given precision (1.01, never
    reached, if there is none).
    """
    rng = random.Random(seed)
    x, y, kinds, weights = [], [], [], []
    words = {"email": "mail ", "ip": "ip ", "card": "card ", "phone": "call "}

    def add(kind, span, before, after, label, weight=1.0):
        for s in ((kind,) if label else {kind, *KINDS[2:]} if kind in KINDS[2:] else (kind,)):
            x.append(features(before + span + after, Span(s, len(before), len(before) + len(span))))
            y.append(label)
            kinds.append(s)
            weights.append(weight)

    for kind, span, before, after, is_base in examples:
        cue = words[kind]
        if is_base:
            add(kind, respelled(span, kind, rng), before + cue * (rng.random() < 0.5), after, True)
            add(kind, corrupted(kind, rng), before + cue * (rng.random() < 0.1), after, False)
            add(kind, corrupted(kind, rng), before + rng.choice(["", "version ", "date ", "order ", "page "]), after, False)
        else:
            add(kind, span, before, after, False, 0.1)
    if not any(y) or all(y):
        return None
    x, y, kinds, weights = np.array(x, float), np.array(y, float), np.array(kinds), np.array(weights)
    held = np.array([rng.random() < 1 / 3 for _ in y])
    trees = Boosted().fit(x[~held], y[~held], weights[~held])
    score, thresholds = trees.score(x[held]), {}
    for k in KINDS:
        own = kinds[held] == k
        order = score[own].argsort()[::-1]
        s, w = score[own][order], weights[held][own][order]
        right = (w * y[held][own][order]).cumsum() / w.cumsum()
        good = np.flatnonzero((right >= precision) & (s >= 0.5))
        below = s[good[-1] + 1] if len(good) and good[-1] + 1 < len(s) else 0.0
        thresholds[k] = max(0.5, float(s[good[-1]] + below) / 2) if len(good) else 1.01
    return Model(trees, thresholds)


def about(text: str, span: Span) -> dict:
    """A span with its text and context."""
    return span._asdict() | {"text": text[span.start:span.end], "before": text[max(0, span.start - 48):span.start],
                             "after": text[span.end:span.end + 16]}


def apart(spans: list[dict]) -> list[dict]:
    """The spans, each unless it overlaps one before it in the list; by start."""
    starts, out = [], []
    for s in spans:
        k = bisect_left(starts, s["end"])
        if not k or out[k - 1]["end"] <= s["start"]:
            starts.insert(k, s["start"])
            out.insert(k, s)
    return out


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, proposed): base spans, and for other candidates the features;
    one row per input row.  One pass over the whole texts."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(ids, texts):
        base, more = [], []
        for t in texts:
            t = t or ""
            own = base_spans(t)
            starts, ends = [b.start for b in own], list(accumulate((b.end for b in own), max))

            def free(s):
                k = bisect_left(starts, s.end)          # base spans that begin before s ends
                return not k or ends[k - 1] <= s.start

            base.append([about(t, s) for s in own])
            more.append([about(t, s) for s in candidates(t) if free(s)])
        return {"id": ids, "base": base, "proposed": more}

    span = "array<struct<kind: string, start: int, end: int, text: string, before: string, after: string>>"
    return map_texts(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), work,
                     f"id {kind}, base {span}, proposed {span}")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 6_000) -> DataFrame:
    """(id, base, added): arrays of (kind, start, end) in code points, by start
    and kind; one row per input row, repeated rows included.

    ``added`` spans overlap neither base spans nor each other (of overlapping
    ones the likeliest stays).  Null and empty texts have none.  The trees are
    fitted on at most ``sample`` different base spans and ``sample`` other
    candidates of the corpus (span and context), shared out evenly among the kinds:
    of each kind those with the smallest hashes, and all of a rare one, spans
    of more than ``EXAMPLE`` characters left out; without any base span nothing is added.  All texts are searched and all candidates scored.
    """
    table = cut_lineage(proposals(docs, id_col, text_col))
    examples = []
    for column, is_base in (("base", True), ("proposed", False)):
        rows = bounded_samples(table.select(F.explode(column).alias("s")).select("s.*").where(F.length("text") <= EXAMPLE),
                               sample, "kind",
                               "kind", "text", "before", "after")
        examples += [(r.kind, r.text, r.before, r.after, is_base) for r in rows]
    model = train(examples)
    shared = Shared(table.sparkSession, model)
    kind = table.schema["id"].dataType.simpleString()

    @factory
    def make():
        model = shared.value

        def work(ids, base, proposed):
            own = [(i, s) for i, spans in enumerate(proposed) for s in spans]
            added = [[] for _ in ids]
            if own and model:
                x = np.array([features(s["before"] + s["text"] + s["after"],
                                       Span(s["kind"], len(s["before"]), len(s["before"]) + len(s["text"])))
                              for _, s in own], float)
                score = model.trees.score(x)
                for k in np.lexsort(([s["start"] for _, s in own], -score)).tolist():
                    i, s = own[k]
                    if score[k] >= model.thresholds[s["kind"]]:
                        added[i].append({f: s[f] for f in ("kind", "start", "end")})
                added = list(map(apart, added))
            keep = ("kind", "start", "end")
            return {"id": ids, "base": [[{f: s[f] for f in keep} for s in b] for b in base],
                    "added": [sorted(a, key=lambda s: (s["start"], KINDS.index(s["kind"]))) for a in added]}
        return work

    span = "array<struct<kind: string, start: int, end: int>>"
    return map_texts(table, make, f"id {kind}, base {span}, added {span}")
