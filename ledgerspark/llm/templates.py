"""Compiler of a sandboxed template language for chat formats.

A template is text with ``{{ expression }}``, ``{% if %}``/``{% elif %}``/``{% else %}``/``{% endif %}``,
``{% for name in expression %}``/``{% endfor %}``, ``{% set name = expression %}``,
``{% generation %}``/``{% endgeneration %}`` (what a model has to produce) and ``{# remarks #}``.
A ``-`` inside a tag (``{%-``, ``-}}``) strips the white space beside it.

Expressions: strings, whole numbers, ``true``, ``false``, ``none``, names, ``a.key``, ``a['key']``,
``+`` (numbers or texts), ``~`` (texts), ``-``, ``%``, comparisons, ``in``, ``not in``, ``and``, ``or``, ``not``,
``x if c else y``, ``is defined``, brackets, and filters after ``|`` (``trim``, ``lower``, ``upper``,
``length``, ``default(value)``, ``replace(old, new)``, ``guard``). Inside a loop ``loop.index``,
``loop.index0``, ``loop.first`` and ``loop.last`` are known.

The sandbox: values are texts, numbers, truth values, dictionaries and row iterators; a key is
looked up in dictionaries only, never as an attribute of a Python object; there are no calls but
the listed filters. A template is read into tokens, then a syntax tree; constant parts are folded
(joined texts, decided branches, filters of constants), and each node becomes a Python closure.
Loops take their rows one by one (one ahead, for ``loop.last``), so rendering needs no list of a
conversation's turns.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator
from typing import Any, NamedTuple

from pyspark import cloudpickle


class TemplateError(ValueError):
    """A template that cannot be compiled, or a value of a kind that the language lacks."""


# Marks in the rendered stream where the text of a generation block starts and ends.
BEGIN, END = object(), object()
# Deepest nesting of a template, and characters a folded constant may have.
DEEPEST, LONGEST = 50, 100_000

Piece = Any
Closure = Callable[[dict], Any]


class Undefined:
    """Value of an unknown name or key: empty as a text, false as a condition."""

    def __bool__(self) -> bool:
        return False


UNDEFINED = Undefined()


# --- syntax tree


class Const(NamedTuple):
    value: Any


class Name(NamedTuple):
    name: str


class Key(NamedTuple):
    of: Any
    key: Any


class Filter(NamedTuple):
    of: Any
    name: str
    args: tuple


class Binary(NamedTuple):
    op: str
    left: Any
    right: Any


class Not(NamedTuple):
    of: Any


class Defined(NamedTuple):
    of: Any


class Choice(NamedTuple):
    test: Any
    yes: Any
    no: Any


class Text(NamedTuple):
    text: str


class Output(NamedTuple):
    value: Any


class If(NamedTuple):
    test: Any
    yes: tuple
    no: tuple


class For(NamedTuple):
    name: str
    rows: Any
    body: tuple


class Set(NamedTuple):
    name: str
    value: Any


class Generation(NamedTuple):
    body: tuple


# --- reading

_TAG = re.compile(r"\{(?:\{(-?)(.*?)(-?)\}\}|%(-?)(.*?)(-?)%\}|#.*?#\})", re.S)
_OPEN = re.compile(r"\{[{%#]")
_TOKEN = re.compile(r"""\s*(?:(\d+)|([A-Za-z_]\w*)|('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(==|!=|<=|>=|[<>+\-%~|.,()\[\]=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}
_RESERVED = {"and", "or", "not", "in", "if", "else", "is", "for"}


def _tokens(source: str) -> list[tuple[str, Any]]:
    found, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at : at + 20]!r}")
        number, name, text, sign = m.groups()
        if number:
            found.append(("const", int(number)))
        elif name:
            found.append(("const", _WORDS[name.lower()]) if name.lower() in _WORDS else ("name", name))
        elif text:
            found.append(("const", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), text[1:-1], flags=re.S)))
        else:
            found.append(("sign", sign))
        at = m.end()
    return found


class _Expression:
    """Reader of one expression, by descent from the loosest operator to the tightest."""

    _LEVELS = (("==", "!=", "<", "<=", ">", ">=", "in", "not in"), ("~",), ("+", "-"), ("%",))

    def __init__(self, tokens: list[tuple[str, Any]]):
        self.tokens, self.at, self.deep = tokens, 0, 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> bool:
        if self.peek(*values):
            self.at += 1
            return True
        return False

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name" or self.tokens[self.at][1] in _RESERVED:
            raise TemplateError("expected a name")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> Any:
        found = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return found

    def choice(self) -> Any:
        self.deep += 1
        if self.deep > DEEPEST:
            raise TemplateError("nested too deeply")
        found = self.either()
        if self.take("if"):
            test = self.either()
            found = Choice(test, found, self.choice() if self.take("else") else Const(""))
        self.deep -= 1
        return found

    def either(self) -> Any:
        found = self.both()
        while self.take("or"):
            found = Binary("or", found, self.both())
        return found

    def both(self) -> Any:
        found = self.negated()
        while self.take("and"):
            found = Binary("and", found, self.negated())
        return found

    def negated(self) -> Any:
        turned = False
        while self.take("not"):
            turned = not turned
        found = self.level(0)
        return Not(found) if turned else found

    def operator(self, level: int) -> str | None:
        signs = self._LEVELS[level]
        if "not in" in signs and self.peek("not") and self.tokens[self.at + 1 : self.at + 2] == [("name", "in")]:
            self.at += 2
            return "not in"
        return self.tokens[self.at - 1][1] if self.take(*signs) else None

    def level(self, level: int) -> Any:
        if level == len(self._LEVELS):
            return self.filtered()
        found = self.level(level + 1)
        while op := self.operator(level):
            found = Binary(op, found, self.level(level + 1))
        return found

    def filtered(self) -> Any:
        found = self.simple()
        while True:
            if self.take("."):
                found = Key(found, Const(self.name()))
            elif self.take("["):
                found = Key(found, self.choice())
                self.need("]")
            elif self.take("|"):
                name, args = self.name(), []
                if self.take("("):
                    while not self.take(")"):
                        args.append(self.choice())
                        if not self.peek(")"):
                            self.need(",")
                found = Filter(found, name, tuple(args))
            elif self.take("is"):
                turned = self.take("not")
                self.need("defined")
                found = Not(Defined(found)) if turned else Defined(found)
            else:
                return found

    def simple(self) -> Any:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "const":
            self.at += 1
            return Const(self.tokens[self.at - 1][1])
        if self.take("("):
            found = self.choice()
            self.need(")")
            return found
        if self.take("-"):
            return Binary("-", Const(0), self.simple())
        return Name(self.name())


def parse(template: str) -> tuple:
    """The syntax tree: a tuple of statements."""
    pieces: list[tuple[str, str]] = []
    at, strip = 0, False
    for m in _TAG.finditer(template):
        text = template[at : m.start()]
        left, right = m[1] or m[4], m[3] or m[6]
        pieces.append(("text", _stripped(text, strip, bool(left))))
        if m[2] is not None:
            pieces.append(("output", m[2]))
        elif m[5] is not None:
            pieces.append(("tag", m[5].strip()))
        at, strip = m.end(), bool(right)
    pieces.append(("text", _stripped(template[at:], strip, False)))
    found, end, rest = _statements(iter(pieces), 0)
    if end:
        raise TemplateError(f"{end!r} closes nothing")
    return found


def _stripped(text: str, left: bool, right: bool) -> str:
    if _OPEN.search(text):
        raise TemplateError("a tag is not closed")
    text = text.lstrip() if left else text
    return text.rstrip() if right else text


def _read(source: str) -> Any:
    return _Expression(_tokens(source)).whole()


def _statements(pieces: Iterator[tuple[str, str]], deep: int) -> tuple[tuple, str, str]:
    """Statements up to a tag that closes them; that tag's word and what follows it."""
    if deep > DEEPEST:
        raise TemplateError("nested too deeply")
    found: list = []
    for kind, source in pieces:
        if kind == "text":
            if source:
                found.append(Text(source))
            continue
        if kind == "output":
            found.append(Output(_read(source)))
            continue
        word, _, rest = source.partition(" ")
        if word == "if":
            found.append(_if(pieces, rest, deep))
        elif word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m or m[1] in _RESERVED:
                raise TemplateError("a loop is 'for name in rows'")
            body, end, _ = _statements(pieces, deep + 1)
            _closed(end, "endfor")
            found.append(For(m[1], _read(m[2]), body))
        elif word == "set":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)(.+)", rest, re.S)
            if not m or m[1] in _RESERVED:
                raise TemplateError("a value is 'set name = expression'")
            found.append(Set(m[1], _read(m[2])))
        elif word == "generation":
            body, end, _ = _statements(pieces, deep + 1)
            _closed(end, "endgeneration")
            found.append(Generation(body))
        elif word in ("elif", "else", "endif", "endfor", "endgeneration"):
            return tuple(found), word, rest
        else:
            raise TemplateError(f"unknown tag {word!r}")
    return tuple(found), "", ""


def _if(pieces: Iterator[tuple[str, str]], test: str, deep: int) -> If:
    yes, end, rest = _statements(pieces, deep + 1)
    if end == "elif":
        return If(_read(test), yes, (_if(pieces, rest, deep + 1),))
    no: tuple = ()
    if end == "else":
        no, end, _ = _statements(pieces, deep + 1)
    _closed(end, "endif")
    return If(_read(test), yes, no)


def _closed(end: str, by: str) -> None:
    if end != by:
        raise TemplateError(f"expected {by!r}, found {end!r}")


# --- values


def shown(value: Any) -> str:
    if isinstance(value, str):
        return value
    if value is None or value is UNDEFINED:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    raise TemplateError("only texts and numbers can be shown")


def _add(a: Any, b: Any) -> Any:
    if isinstance(a, int) and isinstance(b, int):
        return a + b
    return shown(a) + shown(b)


def _numbers(op: Callable[[int, int], int]) -> Callable[[Any, Any], int]:
    def run(a: Any, b: Any) -> int:
        if not isinstance(a, int) or not isinstance(b, int) or op is _MOD and b == 0:
            raise TemplateError("expected whole numbers")
        return op(a, b)

    return run


_MOD = int.__mod__


def _ordered(op: Callable[[Any, Any], bool]) -> Callable[[Any, Any], bool]:
    def run(a: Any, b: Any) -> bool:
        if isinstance(a, int) and isinstance(b, int) or isinstance(a, str) and isinstance(b, str):
            return op(a, b)
        raise TemplateError("expected two numbers or two texts")

    return run


def _inside(a: Any, b: Any) -> bool:
    if isinstance(b, str):
        return shown(a) in b
    if isinstance(b, dict):
        return a in b
    raise TemplateError("expected a text or a dictionary")


_BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "+": _add,
    "~": lambda a, b: shown(a) + shown(b),
    "-": _numbers(int.__sub__),
    "%": _numbers(_MOD),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": _ordered(lambda a, b: a < b),
    "<=": _ordered(lambda a, b: a <= b),
    ">": _ordered(lambda a, b: a > b),
    ">=": _ordered(lambda a, b: a >= b),
    "in": _inside,
    "not in": lambda a, b: not _inside(a, b),
}


def _length(value: Any) -> int:
    if isinstance(value, (str, dict)):
        return len(value)
    raise TemplateError("expected a text or a dictionary")


FILTERS: dict[str, tuple[int, Callable]] = {
    "trim": (0, lambda v: shown(v).strip()),
    "lower": (0, lambda v: shown(v).lower()),
    "upper": (0, lambda v: shown(v).upper()),
    "length": (0, _length),
    "default": (1, lambda v, other: other if v is UNDEFINED or v is None else v),
    "replace": (2, lambda v, old, new: shown(v).replace(shown(old), shown(new))),
}


def key_of(value: Any, key: Any) -> Any:
    """Entry of a dictionary. There is no way to an attribute of an object."""
    return value.get(key, UNDEFINED) if isinstance(value, dict) else UNDEFINED


# --- folding


class Compiler:
    """Folds a syntax tree and turns it into closures. ``extra``: filters besides the listed ones."""

    def __init__(self, extra: dict[str, tuple[int, Callable]] | None = None):
        self.filters = FILTERS | (extra or {})

    def fold(self, node: Any) -> Any:
        """The same expression with its constant parts evaluated."""
        kind = type(node)
        if kind in (Const, Name):
            return node
        if kind is Choice:
            test, yes, no = map(self.fold, node)
            return (yes if test.value else no) if type(test) is Const else Choice(test, yes, no)
        if kind is Filter:
            if node.name not in self.filters:
                raise TemplateError(f"unknown filter {node.name!r}")
            if len(node.args) != self.filters[node.name][0]:
                raise TemplateError(f"filter {node.name!r} takes {self.filters[node.name][0]} values")
            node = Filter(self.fold(node.of), node.name, tuple(map(self.fold, node.args)))
            return self._value(node, (node.of, *node.args))
        if kind is Binary:
            node = Binary(node.op, self.fold(node.left), self.fold(node.right))
            if node.op in ("and", "or") and type(node.left) is Const:
                return node.right if bool(node.left.value) == (node.op == "and") else node.left
            return self._value(node, (node.left, node.right))
        if kind is Key:
            node = Key(self.fold(node.of), self.fold(node.key))
            return self._value(node, (node.of, node.key))
        node = kind(self.fold(node.of))
        return self._value(node, (node.of,))

    def _value(self, node: Any, parts: tuple) -> Any:
        if not all(type(p) is Const for p in parts):
            return node
        value = self.expression(node)({})
        if isinstance(value, str) and len(value) > LONGEST:
            raise TemplateError("a constant grows too long")
        return node if value is UNDEFINED else Const(value)

    def fold_all(self, body: tuple) -> tuple:
        """Statements with constants folded, decided branches taken and texts joined."""
        found: list = []
        for node in body:
            for x in self._folded(node):
                if type(x) is Text and found and type(found[-1]) is Text:
                    found[-1] = Text(found[-1].text + x.text)
                elif type(x) is not Text or x.text:
                    found.append(x)
        return tuple(found)

    def _folded(self, node: Any) -> tuple:
        kind = type(node)
        if kind is Output:
            value = self.fold(node.value)
            return (Text(shown(value.value)) if type(value) is Const else Output(value),)
        if kind is If:
            test = self.fold(node.test)
            yes, no = self.fold_all(node.yes), self.fold_all(node.no)
            if type(test) is Const:
                return yes if test.value else no
            return (If(test, yes, no),) if yes or no else ()
        if kind is For:
            return (For(node.name, self.fold(node.rows), self.fold_all(node.body)),)
        if kind is Set:
            return (Set(node.name, self.fold(node.value)),)
        if kind is Generation:
            return (Generation(self.fold_all(node.body)),)
        return (node,)

    # --- closures

    def expression(self, node: Any) -> Closure:
        kind = type(node)
        if kind is Const:
            value = node.value
            return lambda scope: value
        if kind is Name:
            name = node.name
            return lambda scope: scope.get(name, UNDEFINED)
        if kind is Key:
            of, key = self.expression(node.of), self.expression(node.key)
            if type(node.key) is Const and type(node.of) is Name:
                name, known = node.of.name, node.key.value
                return lambda scope: key_of(scope.get(name), known)
            return lambda scope: key_of(of(scope), key(scope))
        if kind is Choice:
            test, yes, no = map(self.expression, node)
            return lambda scope: yes(scope) if test(scope) else no(scope)
        if kind is Not:
            of = self.expression(node.of)
            return lambda scope: not of(scope)
        if kind is Defined:
            of = self.expression(node.of)
            return lambda scope: of(scope) is not UNDEFINED
        if kind is Filter:
            of, args, run = self.expression(node.of), tuple(map(self.expression, node.args)), self.filters[node.name][1]
            return (lambda scope: run(of(scope), *(a(scope) for a in args))) if args else (lambda scope: run(of(scope)))
        left, right = self.expression(node.left), self.expression(node.right)
        if node.op == "and":
            return lambda scope: left(scope) and right(scope)
        if node.op == "or":
            return lambda scope: left(scope) or right(scope)
        run = _BINARY[node.op]
        return lambda scope: run(left(scope), right(scope))

    def body(self, nodes: tuple) -> Callable[[dict], Iterator[Piece]]:
        steps = tuple(map(self.statement, nodes))
        if len(steps) == 1:
            return steps[0]

        def run(scope: dict) -> Iterator[Piece]:
            for step in steps:
                yield from step(scope)

        return run

    def statement(self, node: Any) -> Callable[[dict], Iterator[Piece]]:
        kind = type(node)
        if kind is Text:
            once = (node.text,)
            return lambda scope: once
        if kind is Output:
            value = self.expression(node.value)
            return lambda scope: (shown(value(scope)),)
        if kind is If:
            test, yes, no = self.expression(node.test), self.body(node.yes), self.body(node.no)
            return lambda scope: yes(scope) if test(scope) else no(scope)
        if kind is Set:
            value, name = self.expression(node.value), node.name

            def put(scope: dict) -> Iterable[Piece]:
                scope[name] = value(scope)
                return ()

            return put
        if kind is Generation:
            inner = self.body(node.body)

            def marked(scope: dict) -> Iterator[Piece]:
                yield BEGIN
                yield from inner(scope)
                yield END

            return marked
        return self._loop(node)

    def _loop(self, node: For) -> Callable[[dict], Iterator[Piece]]:
        rows, inner, name = self.expression(node.rows), self.body(node.body), node.name

        def run(scope: dict) -> Iterator[Piece]:
            values = rows(scope)
            if isinstance(values, (str, dict)) or not isinstance(values, Iterable):
                raise TemplateError("a loop needs rows")
            place, ahead = 0, iter(values)
            value = next(ahead, UNDEFINED)
            while value is not UNDEFINED:
                after = next(ahead, UNDEFINED)
                yield from inner(scope | {name: value, "loop": {"index0": place, "index": place + 1, "first": place == 0, "last": after is UNDEFINED}})
                place, value = place + 1, after

        return run


def compiled(template: str, extra: dict[str, tuple[int, Callable]] | None = None) -> Callable[[dict], Iterator[Piece]]:
    """A function from a scope to the rendered pieces: texts, and ``BEGIN`` and ``END`` around
    generation blocks."""
    compiler = Compiler(extra)
    return compiler.body(compiler.fold_all(parse(template)))


# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
