"""A compiler for a small sandboxed template language for chats.

    {% for m in messages %}<|im_start|>{{ m.role | line }}
    {% if m.role == "assistant" %}{% generation %}{{ m.text | control }}{% endgeneration %}{% endif %}{% endfor %}

Statements: ``for``/``endfor``, ``if``/``elif``/``else``/``endif``, ``set name = expression``, ``generation``/``endgeneration``,
comments ``{# #}``; a ``-`` next to a bracket strips white space on that side. Expressions: strings, integers, ``true false none``,
lists, names, ``a.b`` and ``a["b"]`` of mappings, ``a[0]`` of lists, ``or and not``, comparisons, ``in``, ``+ - ~``, ``x if c else y``,
filters and ``error("...")``. ``loop`` has ``index``, ``index0``, ``first`` and ``last``. An unknown name or key is ``none``, which prints as nothing.

It is a sandbox because there is nothing to break out with: no attributes of Python objects, no calls but the filters
below, no repetition of strings, no loops but over what was given. The source becomes a syntax tree, constant parts of it are
computed once, and each node becomes a Python closure. What is rendered comes in pieces, each with the number of the
``generation`` block that it belongs to (0 outside), so that neither the messages nor the text need to be held.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, fields, replace
from typing import Any

Scope = dict[str, Any]
MOST_DEPTH = 40


class TemplateError(ValueError):
    """A template that cannot be compiled or rendered."""


def control(text: Any) -> str:
    """Text in which no ``<|`` is left; :func:`plain` undoes it."""
    return printed(text).replace("\\", "\\\\").replace("<|", "<\\|")


def line(text: Any) -> str:
    """Like :func:`control`, and on one line."""
    return control(text).replace("\n", "\\n")


def plain(text: str) -> str:
    """The text before :func:`control` or :func:`line`."""
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL) if "\\" in text else text


def printed(value: Any) -> str:
    """A value as text."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return value if isinstance(value, str) else str(value) if isinstance(value, int) else json.dumps(value, ensure_ascii=False)


FILTERS: dict[str, tuple[int, Callable]] = {
    "control": (0, control),
    "line": (0, line),
    "trim": (0, lambda x: printed(x).strip()),
    "upper": (0, lambda x: printed(x).upper()),
    "lower": (0, lambda x: printed(x).lower()),
    "length": (0, lambda x: len(x) if isinstance(x, (str, list, dict)) else 0),
    "default": (1, lambda x, other: other if x is None else x),
    "join": (1, lambda x, between: printed(between).join(map(printed, x or []))),
    "json": (0, lambda x: json.dumps(x, ensure_ascii=False)),
}


@dataclass(frozen=True)
class Node:
    """A part of a template."""


@dataclass(frozen=True)
class Const(Node):
    value: Any


@dataclass(frozen=True)
class Name(Node):
    name: str


@dataclass(frozen=True)
class Listing(Node):
    items: tuple[Node, ...]


@dataclass(frozen=True)
class Item(Node):
    base: Node
    key: Node


@dataclass(frozen=True)
class Operation(Node):
    op: str
    items: tuple[Node, ...]


@dataclass(frozen=True)
class Filtered(Node):
    name: str
    items: tuple[Node, ...]


@dataclass(frozen=True)
class Failure(Node):
    message: Node


@dataclass(frozen=True)
class Text(Node):
    text: str


@dataclass(frozen=True)
class Output(Node):
    value: Node


@dataclass(frozen=True)
class If(Node):
    condition: Node
    then: tuple[Node, ...]
    other: tuple[Node, ...]


@dataclass(frozen=True)
class For(Node):
    name: str
    items: Node
    body: tuple[Node, ...]


@dataclass(frozen=True)
class Set(Node):
    name: str
    value: Node


@dataclass(frozen=True)
class Generation(Node):
    body: tuple[Node, ...]


# From source to tree

_OPEN = re.compile(r"\{\{-?|\{%-?|\{#")
_TOKEN = re.compile(r"""\s*(?:(?P<close>-?(?:\}\}|%\}))|(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~<>=.,|()\[\]]))""", re.DOTALL)
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class Parser:
    """Recursive descent over a template's source."""

    def __init__(self, source: str) -> None:
        self.source, self.at, self.depth = source, 0, 0
        self.strip = False
        self.token: tuple[str, str] = ("", "")

    def fail(self, what: str) -> TemplateError:
        """The error at the present place."""
        return TemplateError(f"line {self.source.count(chr(10), 0, self.at) + 1}: {what}")

    def next(self) -> None:
        """Go to the next token inside brackets."""
        found = _TOKEN.match(self.source, self.at)
        if not found:
            raise self.fail("not a token, or brackets not closed")
        self.at = found.end()
        kind = found.lastgroup
        self.token = (kind, found[kind])

    def take(self, text: str) -> None:
        """Pass a token that has to come."""
        if self.token[1] != text or self.token[0] == "string":
            raise self.fail(f"expected {text}, not {self.token[1]}")
        self.next()

    def passed(self, *texts: str) -> str | None:
        """Pass the present token if it is one of these."""
        kind, text = self.token
        if kind in ("op", "name") and text in texts:
            self.next()
            return text
        return None

    def close(self, bracket: str) -> None:
        """The end of a pair of brackets."""
        kind, text = self.token
        if kind != "close" or not text.endswith(bracket):
            raise self.fail(f"expected {bracket}, not {text}")
        self.strip = text.startswith("-")

    def body(self, *ends: str) -> tuple[tuple[Node, ...], str]:
        """Nodes up to one of the statements ``ends``, and which it was."""
        self.depth += 1
        if self.depth > MOST_DEPTH:
            raise self.fail("nested too deeply")
        nodes: list[Node] = []
        while True:
            found = _OPEN.search(self.source, self.at)
            text = self.source[self.at : found.start() if found else len(self.source)]
            text = text.lstrip() if self.strip else text
            self.strip = False
            if found and found[0].endswith("-"):
                text = text.rstrip()
            if text:
                nodes.append(Text(text))
            if not found:
                self.at = len(self.source)
                if ends:
                    raise self.fail(f"{ends[-1]} is missing")
                return tuple(nodes), ""
            self.at = found.end()
            if found[0] == "{#":
                stop = self.source.find("#}", self.at)
                if stop < 0:
                    raise self.fail("comment not closed")
                self.at = stop + 2
                continue
            self.next()
            if found[0].startswith("{{"):
                nodes.append(Output(self.expression()))
                self.close("}}")
                continue
            kind, word = self.token
            if kind != "name":
                raise self.fail("a statement has to start with a word")
            self.next()
            if word in ends:
                self.depth -= 1
                return tuple(nodes), word
            nodes.append(self.statement(word))

    def statement(self, word: str) -> Node:
        """The statement after its first word."""
        if word == "set":
            name = self.name()
            self.take("=")
            node: Node = Set(name, self.expression())
            self.close("%}")
            return node
        if word == "for":
            name = self.name()
            self.take("in")
            items = self.expression()
            self.close("%}")
            node = For(name, items, self.body("endfor")[0])
        elif word == "generation":
            self.close("%}")
            node = Generation(self.body("endgeneration")[0])
        elif word == "if":
            return self.branches()
        else:
            raise self.fail(f"no statement {word}")
        self.close("%}")
        return node

    def branches(self) -> Node:
        """An ``if`` after its word."""
        condition = self.expression()
        self.close("%}")
        then, end = self.body("elif", "else", "endif")
        if end == "elif":
            return If(condition, then, (self.branches(),))
        other: tuple[Node, ...] = ()
        if end == "else":
            self.close("%}")
            other, _ = self.body("endif")
        self.close("%}")
        return If(condition, then, other)

    def name(self) -> str:
        """A name that may be given a value."""
        kind, text = self.token
        if kind != "name" or text in _WORDS or text in ("loop", "and", "or", "not", "in", "if", "else"):
            raise self.fail(f"{text} cannot be a name")
        self.next()
        return text

    def expression(self) -> Node:
        """``x if c else y`` and all that binds closer."""
        self.depth += 1
        if self.depth > MOST_DEPTH:
            raise self.fail("nested too deeply")
        value = self.binary(0)
        if self.passed("if"):
            condition = self.binary(0)
            self.take("else")
            value = Operation("if", (condition, value, self.expression()))
        self.depth -= 1
        return value

    LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in", "not in"), ("+", "-", "~"))

    def binary(self, level: int) -> Node:
        """Operators from the loosest on."""
        if level == len(self.LEVELS):
            return self.filtered()
        if level == 2:
            return Operation("not", (self.binary(level),)) if self.passed("not") else self.binary(level + 1)
        value = self.binary(level + 1)
        while True:
            op = self.passed(*self.LEVELS[level], *(("not",) if level == 3 else ()))
            if not op:
                return value
            if op == "not":
                self.take("in")
                op = "not in"
            value = Operation(op, (value, self.binary(level + 1)))

    def filtered(self) -> Node:
        """A value with its keys and filters."""
        value = self.primary()
        while True:
            op = self.passed(".", "[", "|")
            if not op:
                return value
            if op == "[":
                value = Item(value, self.expression())
                self.take("]")
                continue
            kind, text = self.token
            if kind != "name":
                raise self.fail("expected a name")
            self.next()
            if op == ".":
                value = Item(value, Const(text))
                continue
            if text not in FILTERS:
                raise self.fail(f"no filter {text}")
            given = self.listed("(", ")") if self.token[1] == "(" else ()
            if len(given) != FILTERS[text][0]:
                raise self.fail(f"{text} takes {FILTERS[text][0]} values")
            value = Filtered(text, (value, *given))

    def listed(self, begin: str, end: str) -> tuple[Node, ...]:
        """Expressions between brackets."""
        self.take(begin)
        items: list[Node] = []
        while not self.passed(end):
            items.append(self.expression())
            if not self.passed(","):
                self.take(end)
                break
        return tuple(items)

    def primary(self) -> Node:
        """A constant, a name, a list, or an expression in brackets."""
        kind, text = self.token
        if kind == "string":
            self.next()
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.DOTALL))
        if kind == "number":
            self.next()
            return Const(int(text))
        if kind == "op" and text == "-":
            self.next()
            return Operation("-", (Const(0), self.primary()))
        if text == "(":
            self.next()
            value = self.expression()
            self.take(")")
            return value
        if text == "[":
            return Listing(self.listed("[", "]"))
        if kind == "name" and text in _WORDS:
            self.next()
            return Const(_WORDS[text])
        if kind == "name" and text == "error":
            self.next()
            given = self.listed("(", ")")
            if len(given) != 1:
                raise self.fail("error takes 1 value")
            return Failure(given[0])
        if kind == "name":
            self.next()
            return Name(text)
        raise self.fail(f"expected a value, not {text}")


# Folding

_OPERATIONS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "not in": lambda a, b: a not in b,
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "~": lambda a, b: printed(a) + printed(b),
}


def fold(node: Node) -> Node:
    """``node`` with its constant parts computed."""
    changed = {}
    for f in fields(node):
        value = getattr(node, f.name)
        if isinstance(value, Node):
            changed[f.name] = fold(value)
        elif isinstance(value, tuple):
            statements = f.name in ("body", "then", "other")
            changed[f.name] = fold_body(value) if statements else tuple(map(fold, value))
    node = replace(node, **changed)
    if isinstance(node, (Operation, Filtered, Listing)) and all(isinstance(i, Const) for i in node.items):
        return Const(closure(node)({}))
    if isinstance(node, Operation) and isinstance(node.items[0], Const):
        first, *rest = node.items
        if node.op == "if":
            return rest[0] if first.value else rest[1]
        if node.op in ("and", "or"):
            return rest[0] if bool(first.value) == (node.op == "and") else first
    return node


def fold_body(nodes: Iterable[Node]) -> tuple[Node, ...]:
    """Statements with constant branches resolved and neighbouring texts joined."""
    out: list[Node] = []

    def put(node: Node) -> None:
        if isinstance(node, Output) and isinstance(node.value, Const):
            node = Text(printed(node.value.value))
        if isinstance(node, If) and isinstance(node.condition, Const):
            for n in node.then if node.condition.value else node.other:
                put(n)
        elif isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif not (node == Text("") or isinstance(node, For) and (not node.body or node.items == Const([]))):
            out.append(node)

    for node in nodes:
        put(fold(node))
    return tuple(out)


# From tree to closures

Value = Callable[[Scope], Any]
Pieces = Callable[[Scope, int], Iterator[tuple[str, int]]]


def closure(node: Node) -> Value:
    """A closure that computes an expression."""
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Listing):
        items = [closure(i) for i in node.items]
        return lambda scope: [i(scope) for i in items]
    if isinstance(node, Item):
        base, key = closure(node.base), closure(node.key)
        return lambda scope: _item(base(scope), key(scope))
    if isinstance(node, Failure):
        message = closure(node.message)

        def fail(scope: Scope) -> Any:
            raise TemplateError(printed(message(scope)))

        return fail
    items = [closure(i) for i in node.items]
    if isinstance(node, Filtered):
        apply = FILTERS[node.name][1]
        return lambda scope: _checked(apply, [i(scope) for i in items])
    a = items[0]
    if node.op == "not":
        return lambda scope: not a(scope)
    b = items[1]
    if node.op == "and":
        return lambda scope: a(scope) and b(scope)
    if node.op == "or":
        return lambda scope: a(scope) or b(scope)
    if node.op == "if":
        c = items[2]
        return lambda scope: b(scope) if a(scope) else c(scope)
    operation = _OPERATIONS[node.op]
    return lambda scope: _checked(operation, (a(scope), b(scope)))


def _item(base: Any, key: Any) -> Any:
    if isinstance(base, dict):
        return base.get(key) if isinstance(key, (str, int)) else None
    if isinstance(base, list) and isinstance(key, int):
        return base[key] if -len(base) <= key < len(base) else None
    return None


def _checked(operation: Callable, values: Iterable[Any]) -> Any:
    try:
        return operation(*values)
    except (TypeError, ValueError) as error:
        raise TemplateError(str(error)) from None


class Counter:
    """Numbers the ``generation`` blocks as they are rendered."""

    def __init__(self) -> None:
        self.last = 0

    def next(self) -> int:
        """The number of the next block."""
        self.last += 1
        return self.last


def pieces(node: Node) -> Pieces:
    """A closure that renders a statement."""
    if isinstance(node, Text):
        text = node.text

        def fixed(scope: Scope, block: int) -> Iterator[tuple[str, int]]:
            yield text, block

        return fixed
    if isinstance(node, Output):
        value = closure(node.value)

        def output(scope: Scope, block: int) -> Iterator[tuple[str, int]]:
            yield printed(value(scope)), block

        return output
    if isinstance(node, Set):
        name, own = node.name, closure(node.value)

        def assign(scope: Scope, block: int) -> Iterator[tuple[str, int]]:
            scope[name] = own(scope)
            return iter(())

        return assign
    if isinstance(node, If):
        condition, then, other = closure(node.condition), sequence(node.then), sequence(node.other)
        return lambda scope, block: (then if condition(scope) else other)(scope, block)
    if isinstance(node, Generation):
        inner = sequence(node.body)

        def generation(scope: Scope, block: int) -> Iterator[tuple[str, int]]:
            block = block or scope["\0blocks"].next()
            yield "", block
            yield from inner(scope, block)

        return generation
    return _loop(node)


def _loop(node: For) -> Pieces:
    name, items, body = node.name, closure(node.items), sequence(node.body)
    ahead = any(n == Item(Name("loop"), Const("last")) for n in walk(node.body))

    def repeat(scope: Scope, block: int) -> Iterator[tuple[str, int]]:
        given = items(scope)
        if given is None:
            return
        if isinstance(given, (str, int, dict)):
            raise TemplateError("only lists can be looped over")
        for i, (item, last) in enumerate(_with_last(given) if ahead else ((x, None) for x in given)):
            loop = {"index": i + 1, "index0": i, "first": i == 0, "last": last}
            yield from body({**scope, name: item, "loop": loop}, block)

    return repeat


def _with_last(items: Iterable[Any]) -> Iterator[tuple[Any, bool]]:
    held: list[Any] = []
    for item in items:
        if held:
            yield held.pop(), False
        held.append(item)
    if held:
        yield held.pop(), True


def sequence(nodes: tuple[Node, ...]) -> Pieces:
    """A closure that renders statements one after the other."""
    parts = [pieces(n) for n in nodes]
    if len(parts) == 1:
        return parts[0]

    def run(scope: Scope, block: int) -> Iterator[tuple[str, int]]:
        for part in parts:
            yield from part(scope, block)

    return run


def walk(value: Any) -> Iterator[Node]:
    """All nodes of a tree, or of several."""
    if isinstance(value, Node):
        yield value
        for f in fields(value):
            yield from walk(getattr(value, f.name))
    elif isinstance(value, tuple):
        for item in value:
            yield from walk(item)


class Template:
    """A compiled template."""

    def __init__(self, source: str) -> None:
        self.tree = fold_body(Parser(source).body()[0])
        self._run = sequence(self.tree)
        uses = sum(n == Name("messages") for n in walk(self.tree))
        loops = [n for n in walk(self.tree) if isinstance(n, For) and n.items == Name("messages")]
        outer = [n for n in self.tree if isinstance(n, For) and n.items == Name("messages")]
        #: Whether the messages are gone through once, so that they need not be held.
        self.streams = uses <= 1 and len(loops) == uses and loops == outer
        #: Whether nothing but each message by itself is rendered, so that a conversation can be rendered in parts.
        self.by_turn = self.streams and len(self.tree) == 1 and len(outer) == 1 and Name("loop") not in walk(outer[0].body)

    def render(self, messages: Iterable[Scope], **values: Any) -> Iterator[tuple[str, int]]:
        """Pieces of text, each with the number of its ``generation`` block, 0 outside. A block without text gives an empty piece."""
        return self._run({**values, "messages": messages if self.streams else list(messages), "\0blocks": Counter()}, 0)
