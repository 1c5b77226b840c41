"""URL filter: pattern rules indexed by their rarest literal token.

A rule is written as in ad-block lists: ``||`` anchors at the start of the
host or of one of its parent domains, ``^`` stands for a separator or the end,
``*`` for anything; a rule that starts with ``@@`` allows, any other blocks.
Every rule compiles to one regular expression and to the literal tokens
(runs of letters and digits) that a URL has to contain for it to match.  The
index files each rule under its rarest such token, counted over all URLs.
A URL fetches the rules filed under its own tokens and runs the expressions
of these candidates only; the longest match wins (then the longer host, then
the order of the list).

Cases: a null URL or one without ``://`` has an empty host and path; no
anchored rule fits an empty host.  Rules without a whole literal token are
candidates for every URL.  Other columns of the input are not read, repeated
rows are judged each, an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[0-9A-Za-z]+")
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})

SCHEMA = "host string, path string, rule string, verdict string, matched string"


@dataclass(frozen=True)
class Rule:
    """``source``: the rule as listed; ``name``: what the result shows for it
    (None: only the verdict shows)."""

    source: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    size: int
    host_size: int
    name: str | None = None


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL."""
    m = _PARTS.search(url) if url else None
    return (m[1].translate(_LOWER), m[2]) if m else ("", "")


def compile_rule(source: str, name: str | None = None) -> Rule:
    """Regular expression over host + path, and the whole tokens it implies."""
    verdict, body = ("allow", source[2:]) if source.startswith("@@") else ("block", source)
    anchored = body.startswith("||")
    body = body[2:] if anchored else body
    regex = r"\A(?:[^/]*\.)?" if anchored else ""
    for piece in re.split(r"([*^])", body):
        regex += {"*": ".*", "^": r"(?:[^0-9A-Za-z_.%-]|\Z)"}.get(piece) or re.escape(piece)
    tokens = []
    for m in TOKEN.finditer(body):
        before, after = body[:m.start()][-1:], body[m.end():][:1]
        # a token at an open end or beside a wildcard may go on in the URL
        if (before or anchored) and after and "*" not in (before, after):
            tokens.append(m[0])
    host = re.split(r"[/^*]", body)[0] if anchored else ""
    return Rule(source, verdict, regex, tuple(tokens), len(body), len(host), name)


def host_path_rule(verdict: str, rule: str) -> Rule:
    """A rule ``host/path-prefix`` for the host and all its subdomains."""
    return compile_rule(("@@" if verdict == "allow" else "") + "||" + rule, rule)


class RuleIndex:
    """Rules under their rarest literal token; ``counts``: URLs per token."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        self.rules, self.found = rules, [re.compile(r.regex, re.S) for r in rules]
        for i, r in enumerate(rules):
            rarest = min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default=None)
            (self.by_token.setdefault(rarest, []) if rarest else self.always).append(i)

    def candidates(self, url: str) -> list[int]:
        out = set(self.always)
        for t in set(TOKEN.findall(url)):
            out.update(self.by_token.get(t, ()))
        return sorted(out)

    def match(self, host: str, path: str) -> Rule | None:
        url = host + path
        hits = [i for i in self.candidates(url) if self.found[i].search(url)]
        # named rules (the given list) go before the method's own patterns
        best = max(hits, key=lambda i: (self.rules[i].name is not None, self.rules[i].size,
                                        self.rules[i].host_size, -i), default=None)
        return None if best is None else self.rules[best]


def token_counts(df: DataFrame, url: str, rules: list[Rule]) -> dict[str, int]:
    """URLs that hold each of the rules' tokens, over the whole table.

    The result has one row per token of the rule list, however large ``df`` is.
    """
    tokens = sorted({t for r in rules for t in r.tokens})
    hit = F.array_intersect(F.split(F.col(url), "[^0-9A-Za-z]+"), F.array(*map(F.lit, tokens)) if tokens
                            else F.array().cast("array<string>"))
    rows = df.select(F.explode(hit).alias("t")).groupBy("t").count().collect()
    return {r["t"]: r["count"] for r in rows}


def filter_urls(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict, matched) for every row of ``df``.

    ``rule`` is the name of the winning given rule or null, ``matched`` the
    winning rule of any kind as it is written, ``verdict`` its verdict or
    ``default``.
    """
    index = RuleIndex(rules, token_counts(df, url_col, rules))
    thin = df.select(F.col(id_col), F.col(url_col).alias("_url"))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for url in b["_url"]:
                host, path = split_url(url)
                r = index.match(host, path)
                rows.append((host, path, r and r.name, r.verdict if r else default, r and r.source))
            out = pd.DataFrame(rows, columns=["host", "path", "rule", "verdict", "matched"], dtype=object)
            out.insert(0, id_col, b[id_col].to_numpy())
            yield out

    kind = dict(df.dtypes)[id_col]
    return thin.mapInPandas(judge, f"`{id_col}` {kind}, {SCHEMA}")
