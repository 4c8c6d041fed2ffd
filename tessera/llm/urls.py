"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a pattern over a URL.  Of the literal tokens that every URL it fits
must hold, the one that the fewest URLs of the whole table hold is its index
key.  A URL's tokens fetch the candidate rules, and only those run their
regular expression.  Rules without a literal token are tried on every URL.

Rule forms (as in public filter lists, and plain site rules):

=====================  ====================================================
``example.net/en/``    site rule: host and all subdomains, path prefix
``||ads.example^``     that domain or a subdomain, then the host's end
``/banner/*/img^``     anywhere in the URL; ``*`` any text, ``^`` a separator
=====================  ====================================================
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Shared, factory, map_texts

#: Tokens of URLs and rules: runs of letters, digits and per cent signs.
TOKEN = "[a-z0-9%]+"

#: Site rules of the standing policy (fixed values): (action, rule).
SITE_RULES = [("block", "net/"), ("allow", "example.net/en/"),
              ("block", "example.com/de/"), ("allow", "org/fr/")]

#: Pattern rules for urls that no site rule fits: (action, pattern).
PATTERN_RULES = [
    ("block", "ads-track."), ("block", "||adserver."), ("block", "||doubleclick."),
    ("block", "/adserver/"), ("block", "/popunder/"), ("block", "-banner-ad."),
    ("block", "/casino/"), ("block", "/phishing/"),
]


#: What is carried along for the best rule so far.
BEST = "struct<site: boolean, length: int, number: int, action: string, text: string>"


class Rule(NamedTuple):
    action: str
    text: str
    pattern: str            # regular expression, searched in the normal form of a URL
    tokens: list[str]       # literal tokens that every fitting URL holds, whole
    site: bool


def site_rule(action: str, text: str) -> Rule:
    """Host (and subdomains) up to the first ``/``, then a path prefix."""
    host, _, path = text.partition("/")
    path = "/" + path
    # the last token of the prefix may go on in the URL, unless a separator ends it
    whole = re.findall(TOKEN + r"(?=[^a-z0-9%])", path.lower())
    return Rule(action, text, r"^(?:[^/]*\.)?" + re.escape(host.lower()) + "\x00" + re.escape(path),
                re.findall(TOKEN, host.lower()) + whole, True)


def pattern_rule(action: str, text: str) -> Rule:
    """``||`` a domain boundary, ``*`` any text, ``^`` a separator or the end."""
    low = text.lower()
    body = low.removeprefix("||")
    expr = re.escape(body).replace(r"\*", ".*").replace(r"\^", "(?:[^a-z0-9%_.-]|$)")
    expr = expr.replace("/", "\x00?/")      # the host's end stands before its path
    if body is not low:
        expr = r"^(?:[^/\x00]*\.)?" + expr
    open_left = body is low and not low.startswith(("*", "^")) and re.match(TOKEN, low)
    tokens = [m[0] for m in re.finditer(TOKEN, body)
              if not (m.start() == 0 and open_left) and m.end() < len(body)
              and not body[m.end()] == "*" and not (m.start() and body[m.start() - 1] == "*")]
    return Rule(action, text, expr, tokens, False)


def parts(col):
    """(host, path) of a URL column: the host follows the first ``://`` up to
    ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path goes on to ``?``,
    ``#`` or the end.  Null or without ``://``: both empty."""
    at = F.instr(col, "://")
    rest = F.when(at > 0, F.substr(col, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def token_counts(urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many of all the URLs each of the rules' ``tokens`` stands; at most
    that many counts reach the driver."""
    if not tokens:
        return {}
    spark = urls.sparkSession
    wanted = spark.createDataFrame([(t,) for t in tokens], "token string")
    got = (urls.select(F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower(F.concat_ws("/", "host", "path")), F.lit(f"({TOKEN})"), F.lit(1)))).alias("token"))
        .join(wanted, "token", "left_semi").groupBy("token").count())
    return {r[0]: r[1] for r in got.toLocalIterator()}


class Matcher:
    """The best rule of one block of rules for a URL."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.index: dict[str, list[tuple]] = {}
        self.always: list[tuple] = []
        for k, r in enumerate(rules):
            entry = (r.site, len(r.text), -k, r.action, r.text, re.compile(r.pattern, re.S))
            if r.tokens:
                rarest = min(r.tokens, key=lambda t: (counts.get(t, 0), t))
                self.index.setdefault(rarest, []).append(entry)
            else:
                self.always.append(entry)
        self.find = re.compile(TOKEN).findall

    def __call__(self, host: str, path: str) -> tuple | None:
        """(site, length, -number, action, text) of the winning rule."""
        normal = host + "\x00" + path
        best = None
        for t in {*self.find(host), *self.find(path.lower()), None}:
            for r in self.always if t is None else self.index.get(t, ()):
                # site rules compare the path as it is, pattern rules in lower case
                if r[5].search(normal if r[0] else normal.lower()) and (best is None or r[:3] > best[:3]):
                    best = r
        return best and best[:5]


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=None,
          block: int = 50_000) -> DataFrame:
    """(id, host, path, rule, verdict) for every row, repeated rows included.

    A fitting site rule decides, the longest first (of equal length the earlier
    one); its text is ``rule``.  Else the longest fitting pattern rule gives the
    verdict and ``rule`` is null; with none the verdict is ``allow``.  Null,
    empty or malformed URLs have an empty host and path, fit no site rule and
    are allowed.  Rules travel to the tasks in blocks of at most ``block``, one
    pass over the rows for each block in the same stage; no rows are shuffled
    but the counts of the rules' own tokens.
    """
    rules = rules if rules is not None else (
        [site_rule(*r) for r in SITE_RULES] + [pattern_rule(*r) for r in PATTERN_RULES])
    host, path = parts(pages[url_col])
    rows = pages.select(pages[id_col].alias("id"), host.alias("host"), path.alias("path"))
    counts = token_counts(rows, sorted({t for r in rules for t in r.tokens}))
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.withColumn("best", F.lit(None).cast(BEST))
    for at in range(0, len(rules), block):
        mine = rules[at:at + block]
        own = {t: counts.get(t, 0) for r in mine for t in r.tokens}
        shared = Shared(rows.sparkSession, (mine, own, at))

        @factory
        def make(shared=shared):
            some, own, at = shared.value
            match = Matcher(some, own)
            keys = ("site", "length", "number", "action", "text")

            def work(ids, hosts, paths, old):
                out = []
                for h, p, o in zip(hosts, paths, old):
                    b = match(h, p)
                    b = b and dict(zip(keys, (b[0], b[1], b[2] - at, b[3], b[4])))
                    if b and o and tuple(o.values())[:3] > tuple(b.values())[:3]:
                        b = o
                    out.append(b or o)
                return {"id": ids, "host": hosts, "path": paths, "best": out}
            return work

        rows = map_texts(rows, make, f"id {kind}, host string, path string, best {BEST}")
    return rows.select("id", "host", "path",
                       F.when(F.col("best.site"), F.col("best.text")).alias("rule"),
                       F.coalesce(F.col("best.action"), F.lit("allow")).alias("verdict"))
