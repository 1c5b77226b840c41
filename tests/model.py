"""A plain sequential model of the tagging rules, used only by the tests.

Written from the rule list (N1-N3, T1-T6, tree rule B), line by line, so
the Spark plans can be checked against something that shares no code.
"""

from __future__ import annotations

import re

BLANK = re.compile(r"^\s*$")
CONT = re.compile(r"^[a-z]")
EXHIBIT = re.compile("^\ufeff?Exhibit.")
TITLE = re.compile("^\ufeff?[\\w ]")
SECTION = re.compile(r"^[A-Z][a-z ]+[^.]?$")
EXACT = re.compile(r"^(Section.*|[A-Z ]+|\d+\.\s*[A-Z ]+)$")
LIST = re.compile(r"^\s*(\d+[.)]|\w[.)]|\(\w+\)|[•*-])")
SINGLENUM = re.compile(r"^\s*[\d.)]+\s*$")


class Failed(Exception):
    pass


def normalise(lines: list[str]) -> tuple[list[str], str]:
    if not lines:
        raise Failed("error_empty")
    if BLANK.match(lines[0]):
        if any(CONT.match(x) for x in lines[1:]):
            raise Failed("error_blank_first")
        return [lines[0]], "blank_first_collapsed"
    out = [lines[0]]
    for x in lines[1:]:
        if CONT.match(x):
            out[-1] = out[-1] + x
        elif not BLANK.match(x):
            out.append(x)
    return out, "ok"


def tag(lines: list[str]) -> tuple[list[tuple[int, str | None]], list[str], str]:
    norm, status = normalise(lines)
    n = len(norm)
    tags: list[str | None] = [None] * n
    start = 0
    if EXHIBIT.match(norm[0]):
        if n == 1:
            raise Failed("error_exhibit_only")
        tags[1] = "title"
        start = 2
    elif TITLE.match(norm[0]):
        tags[0] = "title"
        start = 1
    for i in range(start, n):
        x = norm[i]
        if BLANK.match(x):
            continue
        if SECTION.match(x) or EXACT.match(x):
            tags[i] = "s"
        elif LIST.match(x) and not SINGLENUM.match(x):
            tags[i] = "l"
    secs = [i for i in range(n) if tags[i] == "s"]
    if not all(norm[i].isupper() for i in secs):
        for i in secs:
            if norm[i].isupper():
                tags[i] = None
    for i in range(n):
        if tags[i] is None and not BLANK.match(norm[i]):
            tags[i] = "p"
    bits = [0] * n
    for i in range(n):
        if tags[i] == "title":
            bits[i] = 1
        elif tags[i] in ("l", "p"):
            bits[i] = 3
        elif tags[i] == "s":
            bits[i] = 1
    count = 0
    for i in range(n):
        if tags[i] == "s":
            count += 1
            if i + 1 < n and tags[i + 1] == "s" and count % 2 == 1:
                bits[i] = 3
    if count > 0 and count % 2 == 0:
        tags[n - 1], bits[n - 1] = "s", 2
    return list(zip(bits, tags)), norm, status


def render(flags, norm) -> str:
    out = []
    for (b, t), x in zip(flags, norm):
        if t:
            if b & 1:
                x = f"<{t}> " + x
            if b & 2:
                x = x.rstrip() + f" </{t}>"
        out.append(x)
    return "\n".join(out)


def tree(flags) -> tuple[list[tuple[int, int, int, str, int]], int]:
    """Nodes (pos, parent, depth, tag, cl_pos) and the root's cl_pos."""
    n = len(flags)
    nodes = {}
    stack = [-1]
    root_cl = n
    for i, (b, t) in enumerate(flags):
        if not t:
            continue
        if b & 1:
            nodes[i] = [i, stack[-1], len(stack), t, i]
            stack.append(i)
        if b & 2:
            top = stack.pop()
            if top == -1:
                root_cl = i
            else:
                nodes[top][4] = i
    return [tuple(v) for v in nodes.values()], root_cl
