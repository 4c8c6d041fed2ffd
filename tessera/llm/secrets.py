"""Secret scan with assignment-aware lexing.

A tolerant lexer reads source and configuration syntax (assignments, keyword
arguments, mappings, command-line flags, environment lines, XML elements) into
pairs of a name and a literal.  A constant named elsewhere in the text carries
its literal to the names that it is assigned to.  A literal is scored by how
sensitive its target names are and by its own form; placeholders score low.

Base patterns mark spans that always count; the lexer adds literals that they
miss.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate
from typing import Iterator, NamedTuple

from pyspark.sql import DataFrame

from tessera.llm.common import map_texts

KINDS = ("assign", "access", "hex")

#: Base patterns (fixed by the contract): the span is the whole match.
_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def base_spans(text: str) -> list[Span]:
    """Base spans of all kinds, by start and then kind."""
    out = []
    low = text.lower()
    if (":" in text or "=" in text) and any(w in low for w in _WORDS):
        out += [Span("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [Span("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [Span("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


#: Parts of names and how far they speak for a secret (fixed values).
SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "pwd": 2.5, "passphrase": 3.0, "passcode": 2.5, "pass": 1.8, "secret": 3.0,
    "token": 2.5, "apikey": 3.0, "credential": 2.5, "credentials": 2.5, "auth": 1.6, "authorization": 2.2,
    "bearer": 2.2, "private": 1.5, "signing": 1.4, "encryption": 1.4, "access": 0.9, "client": 0.4, "api": 1.2,
    "key": 1.3, "salt": 1.2, "jwt": 2.2, "session": 0.8, "webhook": 1.0, "cert": 0.8,
}
#: Parts that speak against one: names of places, sizes and kinds of secrets.
HARMLESS = {
    "file": -2.5, "path": -2.5, "dir": -2.5, "url": -2.0, "uri": -2.0, "name": -1.4, "id": -0.8, "type": -1.5,
    "length": -2.0, "len": -2.0, "count": -2.0, "size": -2.0, "min": -1.5, "max": -1.5, "expiry": -1.5,
    "expires": -1.5, "ttl": -2.0, "timeout": -2.0, "regex": -2.0, "pattern": -2.0, "label": -2.0, "field": -1.5,
    "hint": -2.0, "prompt": -2.0, "public": -1.5, "algorithm": -2.0, "format": -2.0, "policy": -2.0,
    "primary": -1.2, "foreign": -1.2, "sort": -1.5, "cache": -0.8, "column": -1.5,
}
_PLACEHOLDER = re.compile(
    r"(?i)^(?:x+|\*+|\.+|-+|none|null|nil|true|false|undefined|string|str|int|todo|tbd|change.?me|changeit|example.*|"
    r"sample.*|dummy.*|test|your.*|my.?(?:password|secret|token|key)|placeholder.*|redacted|<.*>|\$\{?.*|%.*%|\{.*\}|"
    r"os\.environ.*|process\.env.*|getenv.*|env\..*)$")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: A text without any of these has no sensitive name.
_HINT = re.compile(r"(?i)passw|pwd|passphrase|passcode|pass|secret|token|key|credential|auth|bearer|jwt|salt|webhook|"
                   r"private|signing|encryption|session|access|cert|api")

#: Without one of these there is no pair.
_SYNTAX = re.compile(r"[=:]|--|</")

#: A string may hold escapes but no line break, and is of any length.
_STRING = {q: re.compile(p, re.S) for q, p in (
    ('"', r'"(?:[^"\\\n]|\\.)*+'), ("'", r"'(?:[^'\\\n]|\\.)*+"), ("`", r"`[^`\n]*+"))}

#: Lexemes other than strings.
_LEX = re.compile(r"""
    (?P<space>[\x20\t]+) | (?P<line>\r?\n)
  | (?P<xml></?[A-Za-z_][\w.:-]*+>)
  | (?P<op>:=|=>|===?|!==?|<=|>=|[=:+])
  | (?P<flag>--[A-Za-z][\w-]*+)
  | (?P<word>[A-Za-z0-9_$.@/\\%{}*!^&~?#+-]+)
  | (?P<other>.)
""", re.X | re.S)


class Lexeme(NamedTuple):
    kind: str
    text: str
    start: int
    end: int


class Pair(NamedTuple):
    name: str
    start: int
    end: int
    value: str
    quoted: bool


def lex(text: str) -> Iterator[Lexeme]:
    """Lexemes of the text, spaces left out.

    A quote that is never closed is a lexeme by itself, and so are all quotes of
    its kind up to where the search for its end stopped: a search from them would
    stop there too.  So no part is searched twice for the same quote.  Of a string
    in triple quotes the lexeme has the innermost ones only.
    """
    at, n, unclosed, triples = 0, len(text), dict.fromkeys(_STRING, 0), {"\"", "'"}
    while at < n:
        quote = text[at]
        if quote in triples and text.startswith(quote * 3, at):
            end = text.find(quote * 3, at + 3)
            if end >= 0:
                yield Lexeme("string", text[at + 2:end + 1], at + 2, end + 1)
                at = end + 3
                continue
            triples.discard(quote)
        if quote in unclosed and at >= unclosed[quote]:
            end = _STRING[quote].match(text, at).end()
            if end < n and text[end] == quote:
                yield Lexeme("string", text[at:end + 1], at, end + 1)
                at = end + 1
                continue
            unclosed[quote] = end
        m = _LEX.match(text, at)
        at = m.end()
        if m.lastgroup != "space":
            yield Lexeme(m.lastgroup, m[0], *m.span())


def _name(t: Lexeme) -> str | None:
    if t.kind == "string":
        return t.text[1:-1]
    if t.kind == "flag":
        return t.text[2:]
    if t.kind == "word" and re.match(r"[A-Za-z_$@]", t.text):
        return t.text
    return None


def _target(tokens: list[Lexeme], k: int) -> str | None:
    """Name of what ends with lexeme k; of ``a["name"]``, what is inside."""
    if tokens[k].text == "]" and k > 2 and tokens[k - 2].text == "[":
        k -= 1
    return _name(tokens[k])


def _literal(t: Lexeme) -> tuple[int, int, str, bool] | None:
    if t.kind == "string":
        return t.start + 1, t.end - 1, t.text[1:-1], True
    if t.kind == "word":
        return t.start, t.end, t.text, False
    return None


_BLOCK = re.compile(r"[+0-9-]*[\x20\t]*\r?\n")
_LINE = re.compile(r"(\x20*)([^\n]*)\n?")


class Blocks:
    """Block literals: the lines after a key's that are indented further than it;
    blank ones between them belong to them."""

    def __init__(self, text: str):
        self.starts, self.spans, self.last = [], [], []      # of the lines that are not blank
        below: list[int] = []                                # those whose block is still open
        for m in _LINE.finditer(text):
            if not m[2].strip():
                continue
            k, indent = len(self.starts), len(m[1])
            self.starts.append(m.start())
            self.spans.append((m.end(1), m.start(2) + len(m[2].rstrip()), indent))
            self.last.append(k)
            while below and self.spans[below[-1]][2] >= indent:
                self.last[below.pop()] = k - 1
            below.append(k)
        for k in below:
            self.last[k] = len(self.starts) - 1

    def of(self, key: int) -> tuple[int, int] | None:
        """Start and end of the block of the line that ``key`` is on."""
        k = bisect_right(self.starts, key) - 1
        return (self.spans[k + 1][0], self.spans[self.last[k]][1]) if k >= 0 and self.last[k] > k else None


def pairs(text: str) -> tuple[list[Pair], dict[str, list[str]]]:
    """Pairs of a name and a literal, and the names each constant is given to.

    A literal is a string, several strings joined by ``+``, a block of indented
    lines after ``: |`` or ``: >``, or the bare rest of a word.  An unquoted value that looks like a name also counts as a reference
    to a constant of that name.
    """
    found, uses, blocks, lines = [], {}, [], None
    tokens = list(lex(text))
    n = len(tokens)
    for k, t in enumerate(tokens):
        if t.kind == "xml" and not t.text.startswith("</") and k + 2 < n and tokens[k + 2].text == f"</{t.text[1:]}":
            got = _literal(tokens[k + 1])
            if got:
                found.append(Pair(t.text[1:-1], *got[:3], True))
            continue
        if t.kind == "flag" and k + 1 < n and tokens[k + 1].kind in ("string", "word"):
            found.append(Pair(t.text[2:], *_literal(tokens[k + 1])))
            continue
        if t.kind != "op" or t.text not in ("=", ":", ":=", "=>") or not 0 < k < n - 1:
            continue
        name = _target(tokens, k - 1)
        if tokens[k - 1].text in ("str", "String", "string") and k > 2 and tokens[k - 2].text == ":":
            name = _target(tokens, k - 3)           # name: str = literal
        if not name:
            continue
        if t.text == ":" and tokens[k + 1].text in ("|", ">"):
            if _BLOCK.match(text, tokens[k + 1].end):
                lines = lines or Blocks(text)
                got = lines.of(tokens[k - 1].start)
                if got:
                    blocks.append((name, *got))
            continue
        j = k + 1
        while j < n:
            got = _literal(tokens[j])
            if not got:
                break
            found.append(Pair(name, *got))
            if not got[3] and re.fullmatch(r"[A-Za-z_][\w.]*", got[2]):
                uses.setdefault(got[2], []).append(name)
            if j + 2 < n and tokens[j + 1].text == "+":
                j += 2
            else:
                break
    # a block that holds pairs of its own is no literal
    inner = sorted([p.start for p in found] + [a for _, a, _ in blocks])
    found += [Pair(name, a, b, text[a:b], True) for name, a, b in blocks if bisect_left(inner, b) == bisect_right(inner, a)]
    return found, uses


def sensitivity(name: str) -> float:
    """Sum of what the parts of a name say; camel, snake and kebab case."""
    parts = [p.lower() for p in _PART.findall(name)]
    joined = "".join(parts)
    score = sum(SENSITIVE.get(p, 0) + HARMLESS.get(p, 0) for p in parts)
    for whole in ("apikey", "accesskey", "secretkey", "privatekey", "passphrase"):
        if whole in joined and whole not in parts:
            score += 1.5
    return score


def quality(value: str, quoted: bool) -> float:
    """How much a literal looks like a secret: length, mixture and entropy."""
    if len(value) < 6 or _PLACEHOLDER.match(value) or (not quoted and re.search(r"[(){}\[\];,]", value)):
        return -9.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    score = 0.35 * (entropy - 2.5) + 0.5 * (classes - 1) + (0.4 if n >= 12 else 0)
    if re.fullmatch(r"[A-Za-z]+", value):
        score -= 0.6 if quoted else 4.0             # prose, or another name
    if not quoted and not re.search("[0-9]", value):
        score -= 2.0
    if re.search(r"\s", value) and n > 40:
        score -= 1.5                                # a sentence
    if re.match(r"(?:\.{0,2}/|[A-Za-z]:\\|[a-z]+://)[\w./\\-]*$", value):
        score -= 3.0                                # a place
    return score


def reached(names: set[str], uses: dict[str, list[str]]) -> dict[str, float]:
    """The highest sensitivity of each name and of those that its value is given
    to, through any number of assignments.

    Names are visited by falling sensitivity, and the assignments walked backwards
    from each; what was reached before keeps what it has, so every assignment is
    walked once."""
    best = {n: sensitivity(n) for n in names.union(uses, *uses.values())}
    givers: dict[str, list[str]] = {}
    for giver, takers in uses.items():
        for taker in takers:
            givers.setdefault(taker, []).append(giver)
    settled = set()
    for name in sorted(best, key=best.get, reverse=True):
        todo = [name]
        while todo:
            at = todo.pop()
            if at not in settled:
                settled.add(at)
                best[at] = max(best[at], best[name])
                todo += givers.get(at, ())
    return best


def added_spans(text: str, base: list[Span], threshold: float = 2.2) -> list[Span]:
    """Literals that score at least ``threshold`` and meet no base span."""
    if not _SYNTAX.search(text) or not _HINT.search(text):
        return []
    found, uses = pairs(text)
    best = reached({p.name for p in found}, uses)
    starts = sorted(b.start for b in base)
    ends = list(accumulate((b.end for b in sorted(base, key=lambda b: b.start)), max))
    out, taken = [], set()
    for p in found:
        k = bisect_left(starts, p.end)              # base spans that begin before p ends
        if p.start in taken or (k and ends[k - 1] > p.start):
            continue
        if best[p.name] >= 1.5 and best[p.name] + quality(p.value, p.quoted) >= threshold:
            out.append(Span("assign", p.start, p.end))
            taken.add(p.start)
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 2.2) -> DataFrame:
    """(id, base, added): arrays of (kind, start, end) in code points, by start
    and kind; one row per input row, repeated rows included.

    Base spans are the contract's; ``added`` holds literals (kind ``assign``)
    that meet none of them.  Null and empty texts have no spans.  Each text is
    read whole, in one pass and one task; nothing is shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(ids, texts):
        base, added = [], []
        for t in texts:
            own = base_spans(t or "")
            base.append([s._asdict() for s in own])
            more = added_spans(t or "", own, threshold)
            added.append([s._asdict() for s in sorted(more, key=lambda s: s.start)])
        return {"id": ids, "base": base, "added": added}

    span = "array<struct<kind: string, start: int, end: int>>"
    return map_texts(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), work,
                     f"id {kind}, base {span}, added {span}")
