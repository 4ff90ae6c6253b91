"""A small sandboxed template language for conversations, compiled to Python closures.

    {% for turn in turns %}
      {% if turn.role == 'user' %}..{% elif .. %}..{% else %}..{% endif %}
      {% generation %}{{ turn.text | escape }}{% endgeneration %}
    {% endfor %}

Names are `turn.role`, `turn.text`, `loop.first`, `loop.last` and the constants given to the
compiler. Expressions are strings, `true`, `false`, `==`, `!=`, `not`, `and`, `or`, `~` (joins strings),
`a if c else b`, parentheses, and the filters `escape`, `trim`, `upper` and `lower`. There are
no calls, attributes, assignments or loops besides the one over turns, so a
template ends and reaches nothing but its turn. A `-` inside a tag strips the
white space on that side.

A template is parsed into a tree, constants are folded (also whole branches), and the
rest becomes nested closures that append pieces to an output. The loop may be
left at any turn: what stands before, in and after it are programs of their own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

MAX_CHARS = 1 << 16
MAX_TOKENS = 400  # of one expression
MAX_DEPTH = 50
FIELDS = ("turn.role", "turn.text", "loop.first", "loop.last")


class TemplateError(ValueError):
    """The template is not in the language."""


class Controls:
    """Control strings, and a reversible way to write them inside texts.

    A control string is an opening character and a tail. In texts a backslash is put between
    them, and one more where backslashes stand there already, so no bare control
    string is left, and taking one out again gives the text back.
    """

    def __init__(self, strings: Sequence[str]) -> None:
        openers = {s[:1] for s in strings}
        for s in strings:
            if len(s) < 2 or "\\" in s or openers & set(s[1:]):
                raise TemplateError(f"not usable as a control string: {s!r}")
        self.strings = tuple(sorted(strings))
        parts = [f"{re.escape(s[0])}(?=\\\\*{re.escape(s[1:])})" for s in self.strings]
        self._bare = re.compile("|".join(parts) or r"(?!)")
        parts = [f"(?<={re.escape(s[0])})\\\\(?=\\\\*{re.escape(s[1:])})" for s in self.strings]
        self._escaped = re.compile("|".join(parts) or r"(?!)")

    def escape(self, text: str) -> str:
        return self._bare.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        if "\\" not in text:  # the pattern looks behind itself at every place
            return text
        return self._escaped.sub("", text)


# The syntax tree.
@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Field:
    name: str


@dataclass(frozen=True)
class Apply:
    """An operator or filter on its operands."""

    name: str
    operands: tuple


@dataclass(frozen=True)
class Choose:
    """`then` if `test`, else `other`: an expression, or a tuple of nodes each."""

    test: object
    then: object
    other: object


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass(frozen=True)
class Turns:
    body: tuple


def _text(value: object) -> str:
    return ("true" if value else "false") if isinstance(value, bool) else str(value)


OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "~": lambda a, b: _text(a) + _text(b),
    "not": lambda a: not a,
    "trim": lambda a: _text(a).strip(),
    "upper": lambda a: _text(a).upper(),
    "lower": lambda a: _text(a).lower(),
}
FILTERS = ("escape", "trim", "upper", "lower")

_TAGS = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_][\w.]*)|(==|!=|[()|~]))", re.DOTALL)


def _closed(text: str) -> str:
    if "{%" in text or "{{" in text or "{#" in text:
        raise TemplateError("a tag is not closed")
    return text


def _pieces(source: str) -> Iterator[tuple[str, str]]:
    """('text' | 'output' | 'tag', content) in order."""
    at, strip = 0, False
    for m in _TAGS.finditer(source):
        text = _closed(source[at : m.start()])
        text = text.lstrip() if strip else text
        yield "text", text.rstrip() if "-" in (m[1], m[4], m[7]) else text
        at, strip = m.end(), "-" in (m[3], m[6], m[8])
        if m[2] is not None:
            yield "output", m[2]
        elif m[5] is not None:
            yield "tag", m[5].strip()
    text = _closed(source[at:])
    yield "text", text.lstrip() if strip else text


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, constants: Mapping[str, object]) -> None:
        self.tokens, self.at, self.constants, self.depth = [], 0, constants, 0
        end = 0
        while end < len(source.rstrip()):
            m = _TOKEN.match(source, end)
            if not m:
                raise TemplateError(f"cannot read {source[end:]!r}")
            self.tokens.append((m.lastindex, m[m.lastindex]))
            end = m.end()
        if len(self.tokens) > MAX_TOKENS:
            raise TemplateError("an expression is too long")

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return None if kind == 1 else value

    def take(self, *wanted: str) -> bool:
        if self.peek() in wanted:
            self.at += 1
            return True
        return False

    def whole(self) -> object:
        value = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return value

    def choice(self) -> object:
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("nested too deeply")
        value = self.either()
        if self.take("if"):
            test = self.either()
            if not self.take("else"):
                raise TemplateError("`if` without `else` in an expression")
            value = Choose(test, value, self.choice())
        self.depth -= 1
        return value

    def either(self) -> object:
        value = self.both()
        while self.take("or"):
            value = Choose(value, Const(True), Apply("not", (Apply("not", (self.both(),)),)))
        return value

    def both(self) -> object:
        value = self.negated()
        while self.take("and"):
            value = Choose(value, Apply("not", (Apply("not", (self.negated(),)),)), Const(False))
        return value

    def negated(self) -> object:
        times = 0
        while self.take("not"):
            times += 1
        value = self.compared()
        for _ in range(min(times, 2 + times % 2)):
            value = Apply("not", (value,))
        return value

    def compared(self) -> object:
        value = self.joined()
        if (name := self.peek()) in ("==", "!="):
            self.at += 1
            value = Apply(name, (value, self.joined()))
        return value

    def joined(self) -> object:
        value = self.filtered()
        while self.take("~"):
            value = Apply("~", (value, self.filtered()))
        return value

    def filtered(self) -> object:
        value = self.single()
        while self.take("|"):
            name = self.peek()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            value = Apply(name, (value,))
        return value

    def single(self) -> object:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == 1:
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1], flags=re.DOTALL))
        if value == "(":
            inner = self.choice()
            if not self.take(")"):
                raise TemplateError("a parenthesis is not closed")
            return inner
        if value in ("true", "false"):
            return Const(value == "true")
        if value in self.constants:
            return Const(self.constants[value])
        if value in FIELDS:
            return Field(value)
        raise TemplateError(f"no name {value!r}")


def parse(source: str, constants: Mapping[str, object] | None = None) -> tuple:
    """The template as a tuple of nodes."""
    if len(source) > MAX_CHARS:
        raise TemplateError("the template is too long")
    constants = constants or {}
    pieces = [p for p in _pieces(source) if p != ("text", "")]
    at = 0

    def expression(text: str) -> object:
        return _Expression(text, constants).whole()

    def body(closers: Sequence[str], depth: int, inside: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal at
        if depth > MAX_DEPTH:
            raise TemplateError("nested too deeply")
        nodes: list = []
        while at < len(pieces):
            kind, content = pieces[at]
            at += 1
            if kind == "text":
                nodes.append(Output(Const(content)))
            elif kind == "output":
                nodes.append(Output(expression(content)))
            else:
                word = content.split(None, 1)[0] if content else ""
                if word in closers:
                    return tuple(nodes), content
                if word == "if":
                    nodes.append(branches(content[2:], depth, inside))
                elif word == "generation" and content == word:
                    if "generation" in inside:
                        raise TemplateError("a generation inside a generation")
                    nodes.append(Generation(body(["endgeneration"], depth + 1, (*inside, word))[0]))
                elif content.split() == "for turn in turns".split():
                    if inside or depth:
                        raise TemplateError("the loop over turns stands inside something")
                    nodes.append(Turns(body(["endfor"], depth + 1, ("for",))[0]))
                else:
                    raise TemplateError(f"no statement {content!r}")
        if closers:
            raise TemplateError(f"{closers[-1]} is missing")
        return tuple(nodes), ""

    def branches(test: str, depth: int, inside: tuple[str, ...]) -> Choose:
        then, closer = body(["elif", "else", "endif"], depth + 1, inside)
        if closer.startswith("elif"):
            other: tuple = (branches(closer[4:], depth + 1, inside),)
        elif closer == "else":
            other, _ = body(["endif"], depth + 1, inside)
        else:
            other = ()
        return Choose(expression(test), then, other)

    return body([], 0, ())[0]


def _folded_value(node: object, escape: Callable[[str], str]) -> object:
    if isinstance(node, Choose):
        test = _folded_value(node.test, escape)
        if isinstance(test, Const):
            return _folded_value(node.then if test.value else node.other, escape)
        return Choose(test, _folded_value(node.then, escape), _folded_value(node.other, escape))
    if isinstance(node, Apply):
        operands = tuple(_folded_value(x, escape) for x in node.operands)
        if all(isinstance(x, Const) for x in operands):
            function = (lambda a: escape(_text(a))) if node.name == "escape" else OPERATORS[node.name]
            return Const(function(*(x.value for x in operands)))
        return Apply(node.name, operands)
    return node


def fold(nodes: tuple, escape: Callable[[str], str]) -> tuple:
    """The same tree with constants worked out, decided branches taken, and neighbouring texts made one."""
    out: list = []
    for node in nodes:
        if isinstance(node, Output):
            node = Output(_folded_value(node.value, escape))
            if isinstance(node.value, Const):
                text = _text(node.value.value)
                if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                    text = out.pop().value.value + text
                if text:
                    out.append(Output(Const(text)))
                continue
            out.append(node)
        elif isinstance(node, Choose):
            test = _folded_value(node.test, escape)
            if isinstance(test, Const):
                out += fold(node.then if test.value else node.other, escape)
            else:
                out.append(Choose(test, fold(node.then, escape), fold(node.other, escape)))
        else:
            out.append(type(node)(fold(node.body, escape)))
    merged: list = []
    for node in out:  # a branch that was taken may bring texts next to each other
        if merged and all(isinstance(x, Output) and isinstance(x.value, Const) for x in (node, merged[-1])):
            merged[-1] = Output(Const(merged[-1].value.value + node.value.value))
        else:
            merged.append(node)
    return tuple(merged)


class Turn(NamedTuple):
    role: str
    text: str
    first: bool
    last: bool


class Written:
    """Pieces of the output, and the stretches (start, stop; in code points) that a model is to generate."""

    __slots__ = ("pieces", "size", "generated")

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.size = 0
        self.generated: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.pieces.append(text)
        self.size += len(text)


_READERS: dict[str, Callable[[Turn], object]] = {
    "turn.role": lambda turn: turn.role,
    "turn.text": lambda turn: turn.text,
    "loop.first": lambda turn: turn.first,
    "loop.last": lambda turn: turn.last,
}

Value = Callable[[Turn], object]
Step = Callable[[Turn, Written], None]


def _value(node: object, escape: Callable[[str], str]) -> Value:
    if isinstance(node, Const):
        constant = node.value
        return lambda turn: constant
    if isinstance(node, Field):
        return _READERS[node.name]
    if isinstance(node, Choose):
        test, then, other = (_value(x, escape) for x in (node.test, node.then, node.other))
        return lambda turn: then(turn) if test(turn) else other(turn)
    operands = [_value(x, escape) for x in node.operands]
    if node.name == "escape":
        (inner,) = operands
        return lambda turn: escape(_text(inner(turn)))
    function = OPERATORS[node.name]
    if len(operands) == 1:
        (inner,) = operands
        return lambda turn: function(inner(turn))
    left, right = operands
    return lambda turn: function(left(turn), right(turn))


def _program(nodes: tuple, escape: Callable[[str], str]) -> Step:
    steps = [_step(node, escape) for node in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(turn: Turn, out: Written) -> None:
        for step in steps:
            step(turn, out)

    return run


def _step(node: object, escape: Callable[[str], str]) -> Step:
    if isinstance(node, Output):
        value = _value(node.value, escape)
        return lambda turn, out: out.add(_text(value(turn)))
    if isinstance(node, Choose):
        test, then, other = _value(node.test, escape), _program(node.then, escape), _program(node.other, escape)
        return lambda turn, out: then(turn, out) if test(turn) else other(turn, out)
    body = _program(node.body, escape)

    def generate(turn: Turn, out: Written) -> None:
        start = out.size
        body(turn, out)
        out.generated.append((start, out.size))

    return generate


def _uses(node: object) -> Iterator[str]:
    if isinstance(node, Field):
        yield node.name
    elif isinstance(node, tuple):
        for x in node:
            yield from _uses(x)
    elif hasattr(node, "__dataclass_fields__") and not isinstance(node, Const):
        for name in node.__dataclass_fields__:
            yield from _uses(getattr(node, name))


class Compiled:
    """The closure that renders one turn; with the first and the last goes what stands around the loop."""

    def __init__(self, source: str, controls: Controls, constants: Mapping[str, object] | None = None) -> None:
        self.controls = controls
        self.tree = fold(parse(source, constants), controls.escape)
        loops = [i for i, node in enumerate(self.tree) if isinstance(node, Turns)]
        if len(loops) != 1:
            raise TemplateError("a template has one loop over turns")
        before, after = self.tree[: loops[0]], self.tree[loops[0] + 1 :]
        if any(_uses((before, after))):
            raise TemplateError("turn and loop are known inside the loop only")
        self._before, self._after = _program(before, controls.escape), _program(after, controls.escape)
        self._turn = _program(self.tree[loops[0]].body, controls.escape)

    def render(self, turn: Turn, out: Written) -> None:
        if turn.first:
            self._before(turn, out)
        self._turn(turn, out)
        if turn.last:
            self._after(turn, out)
