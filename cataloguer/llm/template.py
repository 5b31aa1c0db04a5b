"""A small sandboxed template language, compiled to Python closures.

Source is parsed to a syntax tree, constants are folded, and each node becomes a
closure; nothing is evaluated as Python source, so a template can reach only the
values it is given. Rendering is a stream: a loop takes its items one by one and
pieces leave as they are made, so memory does not follow a conversation's length.

Syntax::

    text {{ expr }}  {% for x in expr %}..{% endfor %}
    {% if e %}..{% elif e %}..{% else %}..{% endif %}  {% set x = expr %}
    {% generation %}..{% endgeneration %}     marks generated text (the loss mask)
    {# comment #}   a '-' inside a tag's edge strips white space on that side

Expressions: strings, whole numbers, true/false/none, names, ``a.b`` and ``a['b']``
(mapping keys only), ``not and or``, ``== != < <= > >= in``, ``~`` (text concatenation),
``+``, parentheses and filters ``| name``. In a loop ``loop.index0``, ``loop.index``,
``loop.first`` and ``loop.last`` are known.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

_TAGS = re.compile(r"\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\}", re.S)
_LEX = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>~+|().\[\]=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    """The template, or a value it asks for, is not valid."""


@dataclass(frozen=True)
class Node:
    """kind and its parts: children, names or a constant."""

    kind: str
    parts: tuple = ()


# ---- parsing ---------------------------------------------------------------

class _Expr:
    """Recursive-descent parser of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _LEX.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if values and not self.peek(*values):
            return None
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def need(self, value: str) -> None:
        if self.take(value) is None:
            raise TemplateError(f"{value!r} expected")

    def whole(self) -> Node:
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.take("or"):
            node = Node("or", (node, self.both()))
        return node

    def both(self) -> Node:
        node = self.negation()
        while self.take("and"):
            node = Node("and", (node, self.negation()))
        return node

    def negation(self) -> Node:
        return Node("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self) -> Node:
        node = self.joined()
        while self.peek("==", "!=", "<", "<=", ">", ">=", "in"):
            op = self.take()
            node = Node("compare", (op, node, self.joined()))
        return node

    def joined(self) -> Node:
        node = self.filtered()
        while self.peek("~", "+"):
            op = self.take()
            node = Node("join" if op == "~" else "add", (node, self.filtered()))
        return node

    def filtered(self) -> Node:
        node = self.atom()
        while True:
            if self.take("."):
                node = Node("item", (node, Node("const", (self.take(),))))
            elif self.take("["):
                node = Node("item", (node, self.either()))
                self.need("]")
            elif self.take("|"):
                node = Node("filter", (self.take(), node))
            else:
                return node

    def atom(self) -> Node:
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends too early")
        kind = self.tokens[self.at][0]
        value = self.take()
        if kind == "str":
            return Node("const", (re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S),))
        if kind == "int":
            return Node("const", (int(value),))
        if kind == "name":
            known = {"true": True, "false": False, "none": None}
            return Node("const", (known[value],)) if value in known else Node("name", (value,))
        if value == "(":
            node = self.either()
            self.need(")")
            return node
        raise TemplateError(f"unexpected {value!r}")


def _pieces(source: str) -> list[tuple[str, str]]:
    """(kind, body): text, out ({{ }}) and tag ({% %}) pieces, white space stripped at '-' edges."""
    out: list[tuple[str, str]] = []
    at, strip = 0, False
    for m in _TAGS.finditer(source):
        text = source[at : m.start()]
        tag = m[0]
        if strip:
            text = text.lstrip()
        if tag[2] == "-":
            text = text.rstrip()
        out.append(("text", text))
        strip = tag[-3] == "-" and not tag.startswith("{#")
        if not tag.startswith("{#"):
            out.append(("out" if tag.startswith("{{") else "tag", tag[2:-2].strip("-").strip()))
        at = m.end()
    tail = source[at:]
    out.append(("text", tail.lstrip() if strip else tail))
    return [p for p in out if p[0] != "text" or p[1]]


def parse(source: str) -> Node:
    """Syntax tree of a template."""
    pieces = _pieces(source)
    at = 0

    def block(*ends: str) -> tuple[Node, str]:
        nonlocal at
        nodes = []
        while at < len(pieces):
            kind, body = pieces[at]
            at += 1
            if kind == "text":
                nodes.append(Node("out", (Node("const", (body,)),)))
            elif kind == "out":
                nodes.append(Node("out", (_Expr(body).whole(),)))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return Node("block", tuple(nodes)), body
                nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return Node("block", tuple(nodes)), ""

    def statement(word: str, rest: str) -> Node:
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not m:
                raise TemplateError("for needs: name in expression")
            return Node("for", (m[1], _Expr(m[2]).whole(), block("endfor")[0]))
        if word == "if":
            test = _Expr(rest).whole()
            then, end = block("elif", "else", "endif")
            if end.startswith("elif"):
                return Node("if", (test, then, statement("if", end[4:])))
            return Node("if", (test, then, block("endif")[0] if end == "else" else Node("block")))
        if word == "set":
            name, eq, value = rest.partition("=")
            if not eq or not name.strip().isidentifier():
                raise TemplateError("set needs: name = expression")
            return Node("set", (name.strip(), _Expr(value).whole()))
        if word == "generation":
            return Node("generation", (block("endgeneration")[0],))
        raise TemplateError(f"unknown tag {word!r}")

    return block()[0]


# ---- folding ---------------------------------------------------------------

def _text(v) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)


def _add(a, b):
    if type(a) is not type(b) or not isinstance(a, (str, int)):
        raise TemplateError("+ needs two texts or two numbers")
    return a + b


_COMPARE: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
}


def fold(node: Node, filters: dict[str, Callable]) -> Node:
    """The tree with constant expressions worked out, dead branches gone and neighbouring texts joined."""
    parts = tuple(fold(p, filters) if isinstance(p, Node) else p for p in node.parts)
    node = Node(node.kind, parts)
    inner = [p for p in parts if isinstance(p, Node)]
    if node.kind in ("not", "and", "or", "compare", "join", "add", "filter") and all(p.kind == "const" for p in inner):
        return Node("const", (_expression(node, filters)({}),))
    if node.kind == "if" and parts[0].kind == "const":
        return parts[1] if parts[0].parts[0] else parts[2]
    if node.kind == "block":
        flat: list[Node] = []
        for p in parts:
            for q in p.parts if p.kind == "block" else (p,):
                if flat and q.kind == flat[-1].kind == "out" and q.parts[0].kind == flat[-1].parts[0].kind == "const":
                    flat[-1] = Node("out", (Node("const", (_text(flat[-1].parts[0].parts[0]) + _text(q.parts[0].parts[0]),)),))
                else:
                    flat.append(q)
        return Node("block", tuple(flat))
    return node


# ---- closures --------------------------------------------------------------

def _expression(node: Node, filters: dict[str, Callable]) -> Callable[[dict], object]:
    p = node.parts
    if node.kind == "const":
        return lambda env, v=p[0]: v
    if node.kind == "name":
        def name(env):
            if p[0] not in env:
                raise TemplateError(f"{p[0]!r} is not known here")
            return env[p[0]]
        return name
    if node.kind == "item":
        a, b = _expression(p[0], filters), _expression(p[1], filters)

        def item(env):
            value, key = a(env), b(env)
            if not isinstance(value, dict):
                raise TemplateError("only mappings have members")
            return value.get(key)
        return item
    if node.kind == "filter":
        if p[0] not in filters:
            raise TemplateError(f"no filter {p[0]!r}")
        f, a = filters[p[0]], _expression(p[1], filters)
        return lambda env: f(_text(a(env)))
    if node.kind == "not":
        a = _expression(p[0], filters)
        return lambda env: not a(env)
    if node.kind == "compare":
        f, a, b = _COMPARE[p[0]], _expression(p[1], filters), _expression(p[2], filters)
        return lambda env: f(a(env), b(env))
    a, b = _expression(p[0], filters), _expression(p[1], filters)
    if node.kind == "and":
        return lambda env: a(env) and b(env)
    if node.kind == "or":
        return lambda env: a(env) or b(env)
    if node.kind == "join":
        return lambda env: _text(a(env)) + _text(b(env))
    return lambda env: _add(a(env), b(env))


Piece = tuple[str, bool]


def _looped(items: Iterable) -> Iterator[tuple[object, int, bool]]:
    """(item, index, is last) with one item of look-ahead."""
    it = iter(items)
    held = next(it, it)
    i = 0
    while held is not it:
        following = next(it, it)
        yield held, i, following is it
        held, i = following, i + 1


def _statement(node: Node, filters: dict[str, Callable], generated: bool) -> Callable[[dict], Iterator[Piece]]:
    p = node.parts
    if node.kind == "out":
        if p[0].kind == "const":
            constant = ((_text(p[0].parts[0]), generated),)
            return lambda env: constant
        value = _expression(p[0], filters)
        return lambda env: ((_text(value(env)), generated),)
    if node.kind == "block":
        steps = [_statement(q, filters, generated) for q in p]

        def block(env):
            for s in steps:
                yield from s(env)
        return block
    if node.kind == "generation":
        return _statement(p[0], filters, True)
    if node.kind == "set":
        value = _expression(p[1], filters)

        def assign(env):
            env[p[0]] = value(env)
            return ()
        return assign
    if node.kind == "if":
        test, then, other = _expression(p[0], filters), _statement(p[1], filters, generated), _statement(p[2], filters, generated)
        return lambda env: then(env) if test(env) else other(env)
    items, body = _expression(p[1], filters), _statement(p[2], filters, generated)

    def loop(env):
        for value, i, last in _looped(items(env)):
            inner = env | {p[0]: value, "loop": {"index0": i, "index": i + 1, "first": i == 0, "last": last}}
            yield from body(inner)
    return loop


def compile_template(source: str, filters: dict[str, Callable[[str], str]] | None = None) -> Callable[[dict], Iterator[Piece]]:
    """A function from values to the stream of (text, is generated) pieces."""
    filters = {"trim": str.strip, "upper": str.upper, "lower": str.lower} | (filters or {})
    return _statement(fold(parse(source), filters), filters, False)
