"""Chat formatting with a compiled, sandboxed template language.

``compile_template`` parses the source to a syntax tree, folds constant
expressions and branches, and turns every node into a Python closure.  The
language has literal text and

    {{ expression }}                      output
    {% for x in expression %} .. {% endfor %}
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% generation %} .. {% endgeneration %}   text the model is trained on

with strings, integers, true/false/none, ``x.key``, ``loop.index0``,
``loop.first``, ``loop.last``, ``== != + and or not ( )`` and the filters
named in FILTERS.  A name reaches only the values given to ``stream`` and a
key only the entries of a dict, so a template can run no Python.

``stream`` yields (text, in_generation) pieces while it reads the messages,
so a conversation of any length is rendered in the memory of a few turns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

#: Control strings have the form ``<|name|>``; one backslash more between
#: ``<`` and ``|`` makes them plain text, and taking it away restores them.
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No control string can appear in the result; reversed by ``unescape``."""
    return _OPEN.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def escape_line(text: str) -> str:
    """``escape`` for a text that has to stay on one line."""
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "escape_line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower,
}

_PIECES = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
_TOKENS = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[+|().]))""")
_ESCAPES = {"n": "\n", "t": "\t"}
_CONSTANTS = {"true": True, "false": False, "none": None}


class TemplateError(ValueError):
    """The template does not follow the language above."""


# ---- syntax tree: tuples (kind, ...) ---------------------------------------

class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append(next((k, v) for k, v in zip(("str", "int", "name", "op"), m.groups()) if v is not None))
            at = m.end()
        self.at = 0

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][1] in values and self.tokens[self.at][0] != "str":
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def parse(self) -> tuple:
        tree = self.binary(0)
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    LEVELS = (("or",), ("and",), ("==", "!="), ("+",))

    def binary(self, level: int) -> tuple:
        if level == len(self.LEVELS):
            return self.postfix()
        if level == 2 and self.take("not"):
            return ("not", self.binary(2))
        left = self.binary(level + 1)
        while op := self.take(*self.LEVELS[level]):
            left = ("binary", op, left, self.binary(level + 1))
        return left

    def postfix(self) -> tuple:
        tree = self.atom()
        while op := self.take(".", "|"):
            kind, word = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or (op == "|" and word not in FILTERS):
                raise TemplateError(f"unknown name {word!r} after {op}")
            self.at += 1
            tree = ("key", tree, word) if op == "." else ("filter", word, tree)
        return tree

    def atom(self) -> tuple:
        if self.take("("):
            tree = self.binary(0)
            if not self.take(")"):
                raise TemplateError("missing )")
            return tree
        if self.at == len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "int":
            return ("const", int(value))
        if kind != "name" or value in ("and", "or", "not", "in"):
            raise TemplateError(f"unexpected {value!r}")
        return ("const", _CONSTANTS[value]) if value in _CONSTANTS else ("name", value)


def parse(source: str) -> tuple:
    """The syntax tree of a template: ("block", [nodes])."""
    pieces, at = _PIECES.split(source), 0

    def block(ends: tuple[str, ...]) -> tuple[tuple, str, str]:
        nonlocal at
        nodes: list[tuple] = []
        while at < len(pieces):
            piece = pieces[at]
            at += 1
            if piece.startswith("{{"):
                nodes.append(("out", _Expression(piece[2:-2]).parse()))
            elif piece.startswith("{%"):
                word, _, rest = piece[2:-2].strip().partition(" ")
                if word in ends:
                    return ("block", nodes), word, rest
                nodes.append(statement(word, rest))
            elif piece:
                nodes.append(("text", piece))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return ("block", nodes), "", ""

    def statement(word: str, rest: str) -> tuple:
        if word == "generation":
            return ("generation", block(("endgeneration",))[0])
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            return ("for", m[1], _Expression(m[2]).parse(), block(("endfor",))[0])
        if word == "if":
            arms, other = [], ("block", [])
            while True:
                test = _Expression(rest).parse()
                body, end, rest = block(("elif", "else", "endif"))
                arms.append((test, body))
                if end == "else":
                    other = block(("endif",))[0]
                if end != "elif":
                    return ("if", arms, other)
        raise TemplateError(f"unknown statement {word!r}")

    return block(())[0]


def _plain(value: object) -> str:
    return "" if value is None else str(value)


def fold(node: tuple) -> tuple:
    """Evaluate what depends on no input; merge neighbouring text."""
    kind = node[0]
    if kind == "binary":
        _, op, a, b = node[0], node[1], fold(node[2]), fold(node[3])
        tree = ("binary", op, a, b)
        return ("const", _value(tree)({})) if a[0] == b[0] == "const" else tree
    if kind in ("not", "filter", "key"):
        i = 2 if kind == "filter" else 1
        inner = fold(node[i])
        tree = (*node[:i], inner, *node[i + 1:])
        return ("const", _value(tree)({})) if inner[0] == "const" and kind != "key" else tree
    if kind == "out":
        inner = fold(node[1])
        return ("text", _plain(inner[1])) if inner[0] == "const" else ("out", inner)
    if kind == "generation":
        return ("generation", fold(node[1]))
    if kind == "for":
        return ("for", node[1], fold(node[2]), fold(node[3]))
    if kind == "if":
        arms, other = [], fold(node[2])
        for test, body in node[1]:
            test, body = fold(test), fold(body)
            if test[0] != "const":
                arms.append((test, body))
            elif test[1]:
                other = body
                break
        return ("if", arms, other) if arms else other
    if kind == "block":
        nodes: list[tuple] = []
        for x in map(fold, node[1]):
            for y in x[1] if x[0] == "block" else [x]:
                if y[0] == "text" and nodes and nodes[-1][0] == "text":
                    nodes[-1] = ("text", nodes[-1][1] + y[1])
                elif y != ("text", ""):
                    nodes.append(y)
        return ("block", nodes)
    return node


# ---- closures ---------------------------------------------------------------

def _value(node: tuple) -> Callable[[dict], object]:
    """Closure that computes an expression from the names in scope."""
    kind = node[0]
    if kind == "const":
        constant = node[1]
        return lambda scope: constant
    if kind == "name":
        name = node[1]
        return lambda scope: scope.get(name)
    if kind == "key":
        of, key = _value(node[1]), node[2]

        def entry(scope: dict) -> object:
            holder = of(scope)
            return holder.get(key) if isinstance(holder, dict) else None
        return entry
    if kind == "filter":
        apply, of = FILTERS[node[1]], _value(node[2])
        return lambda scope: apply(_plain(of(scope)))
    if kind == "not":
        of = _value(node[1])
        return lambda scope: not of(scope)
    op, a, b = node[1], _value(node[2]), _value(node[3])
    if op == "and":
        return lambda scope: a(scope) and b(scope)
    if op == "or":
        return lambda scope: a(scope) or b(scope)
    if op == "==":
        return lambda scope: a(scope) == b(scope)
    if op == "!=":
        return lambda scope: a(scope) != b(scope)

    def add(scope: dict) -> object:
        x, y = a(scope), b(scope)
        return x + y if isinstance(x, int) and isinstance(y, int) else _plain(x) + _plain(y)
    return add


Piece = tuple[str, bool]


def _emit(node: tuple, trained: bool) -> Callable[[dict], Iterator[Piece]]:
    """Closure that yields the output of a node piece by piece."""
    kind = node[0]
    if kind == "text":
        piece = (node[1], trained)
        return lambda scope: iter((piece,))
    if kind == "out":
        of = _value(node[1])
        return lambda scope: iter(((_plain(of(scope)), trained),))
    if kind == "generation":
        return _emit(node[1], True)
    if kind == "if":
        arms = [(_value(t), _emit(b, trained)) for t, b in node[1]]
        other = _emit(node[2], trained)
        return lambda scope: next((b for t, b in arms if t(scope)), other)(scope)
    if kind == "for":
        name, of, body = node[1], _value(node[2]), _emit(node[3], trained)

        def loop(scope: dict) -> Iterator[Piece]:
            items, done = iter(of(scope) or ()), object()
            item, index = next(items, done), 0
            while item is not done:
                after = next(items, done)
                yield from body({**scope, name: item,
                                 "loop": {"index0": index, "first": index == 0, "last": after is done}})
                item, index = after, index + 1
        return loop
    parts = [_emit(x, trained) for x in node[1]]

    def block(scope: dict) -> Iterator[Piece]:
        for part in parts:
            yield from part(scope)
    return block


class Template:
    """A compiled template.  ``tree`` is the folded syntax tree."""

    def __init__(self, source: str):
        self.source = source
        self.tree = fold(parse(source))
        self._emit = _emit(self.tree, False)

    def stream(self, messages: Iterable[dict], **names: object) -> Iterator[Piece]:
        """(text, in_generation) pieces of one conversation, read lazily."""
        return self._emit({**names, "messages": messages})

    def render(self, messages: Iterable[dict], **names: object) -> tuple[str, list[tuple[int, int]]]:
        """The whole text and its (start, end) generation spans."""
        text, spans, at = [], [], 0
        for piece, trained in self.stream(messages, **names):
            if trained and piece:
                spans.append((at, at + len(piece)))
            text.append(piece)
            at += len(piece)
        return "".join(text), spans

    def __reduce__(self):
        return (Template, (self.source,))
