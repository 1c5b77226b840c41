"""Main text of web pages: the maximum-scoring run of words and tags.

A page becomes a list of items: stretches of text, tags, and elements that are
no text at all (RAW and NEVER: scripts, the head, form fields, ...).  Words
score above zero, tags below; one linear scan finds the contiguous run with
the greatest sum, and its words are the text.

Weights are log odds of lying inside or outside of ``<article>``, counted on
labelled pages (those that have one), at most about SAMPLE of them drawn by a
hash of their ids, on top of prior counts, so pages without any labels work as
well.  Words inside an element whose evidence speaks against it score below
zero: its evidence is the least of those of its classes, id, role and, for
landmarks such as ``<footer>``, its tag.  A class is one key as a whole
(``related-posts``, not ``related``).  The prior speaks against LANDMARKS,
ROLES and names made of the words of BOILERPLATE and those that go with them;
labels outweigh it both ways.  Such an element costs a run no more than
BRIDGE, and next to nothing inside of an article, so text on both sides stays
one run, but a few words behind it do not.  Its words are left out.

Names of headings and inside of code say nothing.  Elements named so, and
forms, count as text if they hold an article or are a wrapper of the page's
text (see ``lift_wrappers``).

Cases: null html counts as empty and gives an empty text; so does a page
without words; unclosed elements end with their parent; unclosed tags are
text; pages of any length and repeated rows are read as they come; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound on the labelled pages whose tags and words are counted.
SAMPLE = 2000
#: Score of a skipped element: a run may go on behind it, but not end on it.
SKIPPED = -0.1
#: The most that an element whose words score below zero costs a run outside of an article.
BRIDGE = -20.0
#: Keys that fewer elements of the labelled pages bear keep their prior.
SUPPORT = 2
LEAST, TOUCH, WORD_RANGE, PRIOR = -4.0, -0.01, (0.5, 3.0), 8.0

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*+)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME_PART = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i img ins kbd mark q s samp small span strike "
                   "strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mspace "
                   "mpadded mphantom merror menclose mfenced msub msup msubsup munder mover munderover mmultiscripts "
                   "mprescripts semantics".split())
CONTENT = frozenset("article main section p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption br hr table thead "
                    "tbody tr td th caption dl dt dd body html div ol ul li center picture mtable mtr mtd".split()) \
    | INLINE - {"a"}
#: Text of these is not markup; it ends at the closing tag.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
LANDMARKS = frozenset("nav aside footer dialog menu".split())
NEVER = RAW | frozenset("head form noscript template button select svg canvas object fieldset audio video map "
                        "annotation annotation-xml".split())
INVISIBLE = frozenset("script style template noscript annotation annotation-xml".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                  "toolbar".split())
#: Words of class and id attributes that speak against an element before any label does.
BOILERPLATE = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promoted promotion sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices banner popup "
    "modal newsletter subscribe subscription signup login comment comments commentlist disqus reply replies respond "
    "share sharing social related recommended recommendations widget widgets pagination pager toolbar masthead toc "
    "copyright disclaimer alert overlay topbar".split())
#: Words that go with them in one name; a name with any other word says something else.
COMPANIONS = frozenset(
    "area bar block body bottom box btn button buttons card cards center container dfp div fixed footer global google "
    "gpt header heading holder icon icons inner item items left link links list lists outer page pane panel post posts "
    "article articles primary right row secondary section site slot sticky stories story text thread title top unit "
    "wrap wrapper".split())
#: Threads are often longer than the text they are about.
THREAD = frozenset("comment comments commentlist disqus reply replies respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NUMBER = re.compile(r"\d+(?:x\d+)?")
_TOP = frozenset("article main".split())
#: Why an element is no text: for its tag, role or being hidden; for its name or as a form; as a thread by name.
HARD, SOFT, TALK = 1, 2, 3


def _prior(key: str) -> int:
    """What is known of a key without labels: HARD, SOFT or TALK if it speaks against an element, else 0."""
    kind, words = key[0], set(key[1:].split("-"))
    if kind != ".":
        return HARD
    if words <= BOILERPLATE | COMPANIONS and (words & BOILERPLATE or {"site", "header"} <= words):
        return TALK if words & THREAD else SOFT
    return 0


def evidence_keys(name: str, attrs: str, in_article: bool, in_code: bool = False) -> list[str]:
    """Keys of an element: ``<tag`` of a landmark, ``@role``, ``.class`` and ``.id``."""
    out = ["<" + name] if name in LANDMARKS or (name == "header" and not in_article) else []
    if not attrs or name in ("html", "body", "article", "main"):
        return out
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), "".join(values)
        if key == "role" and value.lower().strip() in ROLES:
            out.append("@" + value.lower().strip())
        if key in ("class", "id") and name not in HEADINGS and not in_code:
            for token in value.split():
                words = [w.lower() for w in _NAME_PART.findall(token) if not _NUMBER.fullmatch(w.lower())]
                of_site = {"site", "header"} <= set(words) and not set(words) & BOILERPLATE
                if words and not (in_article and of_site):
                    out.append("." + "-".join(words))
    return out


def _hidden(attrs: str) -> bool:
    return bool(attrs) and bool(re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs) or any(
        key.lower() == "style" and re.search(r"display\s*:\s*none", "".join(values), re.I)
        for key, *values in _ATTR.findall(attrs)))


class Item:
    """``kind``: t text, a text of a link, or a tag's name (closing: with /).
    ``skip``: number of the skipped element it lies in, or -1."""

    __slots__ = ("kind", "text", "skip", "inside")

    def __init__(self, kind: str, text: str, skip: int, inside: bool):
        self.kind, self.text, self.skip, self.inside = kind, text, skip, inside


class Skip:
    """An element that is no text: the one around it or -1, its tag, why (0: it
    is text after all), whether it lies in an article or main, and the score of
    each of its words (0: they are not looked at)."""

    __slots__ = ("outer", "name", "why", "inside", "word")

    def __init__(self, outer: int, name: str, why: int, inside: bool, word: float):
        self.outer, self.name, self.why, self.inside, self.word = outer, name, why, inside, word


def items(page: str, weights: Weights, seen: list | None = None) -> tuple[list[Item], list[Skip]]:
    """The items of a page and its elements that are no text, outer ones first.

    ``seen`` gets [keys, whether in an article, whether around one] of each
    element with keys.
    """
    out: list[Item] = []
    skips: list[Skip] = []
    stack: list[tuple[str, int]] = []  # open elements with the skipped element they lie in
    around: list[tuple[int, list]] = []  # open elements with keys, by their place in the stack
    depth = Counter()
    at, end = 0, len(page)

    def text(a: int, b: int) -> None:
        if a < b:
            out.append(Item("a" if depth["a"] else "t", html.unescape(page[a:b]), stack[-1][1] if stack else -1,
                            depth["article"] > 0))

    while at < end:
        m = _TAG.search(page, at)
        if not m:
            text(at, end)
            break
        text(at, m.start())
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["close"]:
            if depth[name]:
                while stack:
                    top, skip = stack.pop()
                    depth[top] -= 1
                    if top == name:
                        break
                out.append(Item("/" + name, "", skip, depth["article"] > 0 or name == "article"))
            continue
        skip = stack[-1][1] if stack else -1
        if name in _TOP:
            s = skip
            while s >= 0:  # an article is no part of a sidebar, whatever the names of its wrappers
                if skips[s].name not in NEVER | LANDMARKS or skips[s].name == "form":
                    skips[s].why = 0
                s = skips[s].outer
        inside = depth["article"] + depth["main"] > 0
        while around and around[-1][0] >= len(stack):
            around.pop()
        if name == "article":
            for _, mark in around:
                mark[2] = True
        keys = evidence_keys(name, m["attrs"], inside, depth["pre"] + depth["code"] > 0)
        if seen is not None and keys:
            seen.append([keys, depth["article"] > 0, False])
            if name not in VOID:
                around.append((len(stack), seen[-1]))
        why, word = weights.against(keys)
        if name in NEVER or _hidden(m["attrs"]):
            why, word = (SOFT if name == "form" else HARD), 0.0
        if why:
            skips.append(Skip(skip, name, why, inside, word))
            skip = len(skips) - 1
        out.append(Item(name, "", skip, depth["article"] > 0 or name == "article"))
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = close.end() if close else end
        elif name not in VOID and not m["attrs"].endswith("/"):
            stack.append((name, skip))
            depth[name] += 1
        elif skip >= 0 and name in VOID:
            pass
    return out, skips


def lift_wrappers(found: list[Item], skips: list[Skip]) -> None:
    """Skip no longer what holds most of the page's words outside of links and
    hard skips, if it also holds an ``<h1>`` or next to no words are left
    without it.  A thread needs the ``<h1>``; beside an article nothing is lifted.
    """
    if not any(s.why > HARD for s in skips):
        return
    own, titled = [0] * (len(skips) + 1), [False] * (len(skips) + 1)  # the last: outside of all
    top = False
    for x in found:
        if x.kind == "t":
            own[x.skip] += len(x.text.split())
        elif x.kind == "h1":
            titled[x.skip] = True
        elif x.kind in _TOP:
            top = True
    words = list(own)
    for i in range(len(skips) - 1, -1, -1):
        if skips[i].why != HARD:
            words[skips[i].outer] += words[i]
            titled[skips[i].outer] |= titled[i]
    live = [False] * (len(skips) + 1)
    for i, s in enumerate(skips):
        live[i] = live[s.outer] or s.why > 0
    left = own[-1] + sum(n for n, on in zip(own, live[:-1]) if not on)
    for i, s in enumerate(skips):
        live[i] = live[s.outer] or s.why > 0
        if live[s.outer] or s.why <= HARD or (top and not s.inside) or 2 * words[i] <= words[-1]:
            continue
        if titled[i] or (s.why == SOFT and 10 * left < words[i]):
            s.why, live[i] = 0, False
            left += own[i]


def count_labels(page: str) -> Counter:
    """Items inside (key, True) and outside (key, False) of the article."""
    found: Counter = Counter()
    seen: list = []
    for x in items(page, Weights(), seen)[0]:
        if x.kind in ("t", "a"):
            found[("#" + x.kind, x.inside)] += len(x.text.split())
        else:
            found[(x.kind, x.inside)] += 1
    for keys, inside, wraps in seen:
        if not wraps:
            found.update((k, inside) for k in set(keys))
    return found


class Weights:
    """Scores of words (``#t``, in links ``#a``), tags and keys of elements,
    from label counts.  Without ``known`` no key has a prior against it."""

    def __init__(self, counts: dict[tuple[str, bool], int] | None = None, known: bool = True):
        counts = counts or {}
        self.known = known
        self.score = {k: self._weigh(k, counts.get((k, True), 0), counts.get((k, False), 0))
                      for k in {k for k, _ in counts} | {"#t", "#a"}}

    def _weigh(self, key: str, inside: int, outside: int) -> float:
        if key[0] in ".@<":
            against = self.known and _prior(key)
            return math.log((inside + (1 if against else PRIOR)) / (outside + (PRIOR if against else 1)))
        fits = 1.0 if key == "#t" or key.lstrip("/") in CONTENT else 0.35
        a, b = PRIOR * fits, PRIOR * (1 - 0.7 * fits)
        odds = math.log((inside + a) / (outside + b))
        if key == "#t":
            return min(max(odds, WORD_RANGE[0]), WORD_RANGE[1])
        if key == "#a":
            return min(max(odds, 0.2), 1.0)
        return min(max(odds, LEAST), TOUCH)

    def of(self, key: str) -> float:
        if key not in self.score:
            self.score[key] = self._weigh(key, 0, 0)
        return self.score[key]

    def against(self, keys: list[str]) -> tuple[int, float]:
        """Why an element with these keys is no text, and the score of its words; (0, 0.0) if it is text."""
        told = [(self.of(k), k) for k in keys]
        told = [(x, k) for x, k in told if x < 0]
        return (max(_prior(k) or SOFT for _, k in told), min(told)[0]) if told else (0, 0.0)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the greatest positive sum; the
    longer of equal ones."""
    best, where, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += s
        if total > best or (total == best and total > 0 and i + 1 - start > where[1] - where[0]):
            best, where = total, (start, i + 1)
    return where


def main_text(page: str | None, weights: Weights) -> str:
    """The article of a page: its blocks in order, joined by one blank."""
    found, skips = items(page or "", weights)
    lift_wrappers(found, skips)
    live: list[int] = []  # the skipped element that holds this one, or -1
    for s in skips:
        live.append(len(live) if s.why else (live[s.outer] if s.outer >= 0 else -1))
    scores, texts, seen = [], [], -1
    for x in found:
        skip = live[x.skip] if x.skip >= 0 else -1
        if skip >= 0:
            inline = skips[skip].name in INVISIBLE
            if skip != seen:
                scores.append(SKIPPED if not inline else 0.0)
                texts.append("" if inline else " ")
            if skips[skip].word and x.text:
                least = SKIPPED if skips[skip].inside else BRIDGE
                scores[-1] = max(least, scores[-1] + skips[skip].word * len(x.text.split()))
            seen = skip
            continue
        seen = -1
        if x.kind in ("t", "a"):
            scores.append(weights.of("#" + x.kind) * len(x.text.split()))
            texts.append(x.text)
        else:
            scores.append(weights.of(x.kind))
            texts.append("" if x.kind.lstrip("/") in INLINE else " ")
    a, b = best_run(scores)
    return " ".join("".join(texts[a:b]).split())


def learn_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> Weights:
    """Weights from labelled pages; the driver gets one row per tag name and
    per key that at least SUPPORT elements of the sample bear."""
    known = pages.where(F.lower(F.col(html_col)).contains("<article")).select(
        F.col(html_col).alias("html"), F.pmod(F.xxhash64(F.lit("label"), F.col(id_col).cast("string")),
                                              F.lit(1_000_003)).alias("u"))
    n = known.count()
    if not n:
        return Weights()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for b in batches:
            for page in b["html"]:
                total.update(count_labels(page))
        yield pd.DataFrame([(k, total[(k, True)], total[(k, False)]) for k in {k for k, _ in total}],
                           columns=["k", "inside", "outside"])

    rows = known.where(F.col("u") < int(min(1.0, sample / n) * 1_000_003)).mapInPandas(
        count, "k string, inside long, outside long")
    totals = rows.groupBy("k").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    told = totals.where(F.col("inside") + F.col("outside") >= SUPPORT).collect()
    return Weights({(r["k"], side): n for r in told for side, n in ((True, r["inside"]), (False, r["outside"])) if n})


def extract_text(pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [main_text(p, weights) for p in b["_html"]]
            yield pd.DataFrame({id_col: b[id_col].to_numpy(), url_col: b[url_col].to_numpy(), "text": text,
                                "n_chars": [len(t) for t in text]})

    kinds = dict(pages.dtypes)
    return pages.select(id_col, url_col, F.col(html_col).alias("_html")).mapInPandas(
        run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
