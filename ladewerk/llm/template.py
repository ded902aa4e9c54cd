"""A small sandboxed template language for chats, compiled to Python closures.

    text  {{ expression }}  {% for x in name %} .. {% endfor %}
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% set name = e %}  {% generation %} .. {% endgeneration %}

Expressions: strings, whole numbers, true, false, none, names, x.field and x['field']
(fields of mappings only), not, and, or, ==, !=, in, + and ~ (join texts), | filter, and
parentheses. Nothing else can be reached: no attributes, calls or imports. A tag cut with
a dash ({%- or -%}) drops the white space beside it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

TAGS = re.compile(r"(?s)(\{\{.*?\}\}|\{%.*?%\})")
TOKENS = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[-+~|().\[\]=]))""")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
#: A piece of text, and whether it is what a model is to write.
Piece = tuple[str, bool]
Render = Callable[[dict], Iterable[Piece]]


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: Any
    field: Any


@dataclass(frozen=True)
class Op:
    sign: str
    args: tuple


@dataclass(frozen=True)
class Filtered:
    name: str
    of: Any


@dataclass(frozen=True)
class Out:
    value: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    arms: tuple  # (condition, body)


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


def _text(value: Any) -> str:
    return "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def _field(of: Any, field: Any) -> Any:
    if not isinstance(of, Mapping):
        raise TemplateError("only mappings have fields")
    return of.get(field)


BASE_FILTERS: dict[str, Callable[[Any], Any]] = {"trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(), "length": lambda x: len(x or "")}
BINARY: dict[str, Callable[[Any, Any], Any]] = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: a in (b or ()), "~": lambda a, b: _text(a) + _text(b), "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b)}


class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, end = 0, len(source.rstrip())
        while at < end:
            m = TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup or "", m[m.lastgroup or 0]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *wanted: str) -> str | None:
        kind, value = self.peek()
        if kind in ("name", "sign") and value in wanted:
            self.at += 1
            return value
        return None

    def need(self, kind: str, value: str | None = None) -> str:
        k, v = self.peek()
        if k != kind or value not in (None, v):
            raise TemplateError(f"expected {value or kind}, found {v!r}")
        self.at += 1
        return v

    def whole(self) -> Any:
        e = self.either()
        self.done()
        return e

    def done(self) -> None:
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    def either(self) -> Any:
        e = self.both()
        while self.take("or"):
            e = Op("or", (e, self.both()))
        return e

    def both(self) -> Any:
        e = self.negated()
        while self.take("and"):
            e = Op("and", (e, self.negated()))
        return e

    def negated(self) -> Any:
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        e = self.summed()
        while sign := self.take("==", "!=", "in"):
            e = Op(sign, (e, self.summed()))
        return e

    def summed(self) -> Any:
        e = self.filtered()
        while sign := self.take("+", "~"):
            e = Op(sign, (e, self.filtered()))
        return e

    def filtered(self) -> Any:
        e = self.single()
        while self.take("|"):
            e = Filtered(self.need("name"), e)
        return e

    def single(self) -> Any:
        kind, value = self.peek()
        self.at += 1
        if kind == "text":
            e: Any = Const(re.sub(r"(?s)\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1]))
        elif kind == "number":
            e = Const(int(value))
        elif kind == "name" and value in ("true", "false", "none"):
            e = Const({"true": True, "false": False, "none": None}[value])
        elif kind == "name":
            e = Name(value)
        elif (kind, value) == ("sign", "("):
            e = self.either()
            self.need("sign", ")")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while True:
            if self.take("."):
                e = Field(e, Const(self.need("name")))
            elif self.take("["):
                e = Field(e, self.either())
                self.need("sign", "]")
            else:
                return e


def parse(source: str) -> tuple:
    """The syntax tree: a tuple of nodes."""
    parts = TAGS.split(source)
    for i in range(1, len(parts), 2):
        if parts[i][2] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
        if parts[i][-3] == "-":
            parts[i + 1] = parts[i + 1].lstrip()
    items = [("text", p) if i % 2 == 0 else ("out" if p[1] == "{" else "tag", p[2:-2].strip("-").strip()) for i, p in enumerate(parts)]
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        body: list = []
        while at < len(items):
            kind, value = items[at]
            at += 1
            if kind == "text":
                if value:
                    body.append(Out(Const(value)))
            elif kind == "out":
                body.append(Out(_Expression(value).whole()))
            else:
                word = value.split(None, 1)[0] if value else ""
                if word in ends:
                    return tuple(body), value
                body.append(statement(word, value))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(body), ""

    def statement(word: str, value: str) -> Any:
        e = _Expression(value)
        e.at = 1
        if word == "for":
            name = e.need("name")
            e.need("name", "in")
            over = e.whole()
            return For(name, over, block("endfor")[0])
        if word == "set":
            name = e.need("name")
            e.need("sign", "=")
            return Set(name, e.whole())
        if word == "generation":
            e.done()
            return Generation(block("endgeneration")[0])
        if word == "if":
            arms, condition = [], e.whole()
            while True:
                body, end = block("elif", "else", "endif")
                arms.append((condition, body))
                if end.startswith("elif"):
                    condition = _Expression(end[4:]).whole()
                elif end == "else":
                    arms.append((Const(True), block("endif")[0]))
                    return If(tuple(arms))
                else:
                    return If(tuple(arms))
        raise TemplateError(f"unknown tag {word!r}")

    return block()[0]


def fold(node: Any) -> Any:
    """The node with what is constant worked out; a body drops arms that cannot be taken
    and joins neighbouring texts."""
    if isinstance(node, tuple):
        out: list = []
        for n in map(fold, node):
            for x in n if isinstance(n, tuple) else (n,):
                if isinstance(x, Out) and isinstance(x.value, Const) and out and isinstance(out[-1], Out) and isinstance(out[-1].value, Const):
                    out[-1] = Out(Const(_text(out[-1].value.value) + _text(x.value.value)))
                else:
                    out.append(x)
        return tuple(out)
    if isinstance(node, Op):
        args = tuple(map(fold, node.args))
        if all(isinstance(a, Const) for a in args):
            return Const(_expression(Op(node.sign, args), {})({}))
        if node.sign in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.sign == "and") else args[0]
        return Op(node.sign, args)
    if isinstance(node, Field):
        return Field(fold(node.of), fold(node.field))
    if isinstance(node, Filtered):
        of = fold(node.of)
        return Const(BASE_FILTERS[node.name](of.value)) if isinstance(of, Const) and node.name in BASE_FILTERS else Filtered(node.name, of)
    if isinstance(node, Out):
        return Out(fold(node.value))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, If):
        arms = []
        for condition, body in node.arms:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            arms.append((condition, fold(body)))
            if isinstance(condition, Const):
                break
        if arms and isinstance(arms[0][0], Const):
            return arms[0][1]
        return If(tuple(arms)) if arms else ()
    return node


def _expression(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Field):
        of, field = _expression(node.of, filters), _expression(node.field, filters)
        return lambda scope: _field(of(scope), field(scope))
    if isinstance(node, Filtered):
        of = _expression(node.of, filters)
        if node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        run = filters[node.name]
        return lambda scope: run(of(scope))
    args = [_expression(a, filters) for a in node.args]
    if node.sign == "not":
        return lambda scope: not args[0](scope)
    if node.sign == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.sign == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    binary = BINARY[node.sign]
    return lambda scope: binary(args[0](scope), args[1](scope))


def _body(nodes: Iterable, filters: Mapping[str, Callable], generated: bool) -> Render:
    steps: list[Render] = []
    for node in nodes:
        if isinstance(node, Out):
            value = _expression(node.value, filters)
            steps.append(lambda scope, value=value: ((_text(value(scope)), generated),))
        elif isinstance(node, Set):
            value = _expression(node.value, filters)
            steps.append(lambda scope, name=node.name, value=value: scope.__setitem__(name, value(scope)) or ())
        elif isinstance(node, Generation):
            steps.append(_body(node.body, filters, True))
        elif isinstance(node, If):
            arms = [(_expression(c, filters), _body(b, filters, generated)) for c, b in node.arms]

            def choose(scope, arms=arms):
                for condition, body in arms:
                    if condition(scope):
                        return body(scope)
                return ()

            steps.append(choose)
        else:
            over, inner = _expression(node.over, filters), _body(node.body, filters, generated)

            def loop(scope, over=over, inner=inner, name=node.name):
                for item in over(scope) or ():
                    yield from inner({**scope, name: item})

            steps.append(loop)

    def run(scope: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return run


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[[Mapping[str, Any]], Iterator[Piece]]:
    """A function of names that gives (text, generated) piece by piece, as they are asked
    for, so what a loop runs over may be an iterator of any length."""
    run = _body(fold(parse(source)), {**BASE_FILTERS, **(filters or {})}, False)
    return lambda names: run(dict(names))
