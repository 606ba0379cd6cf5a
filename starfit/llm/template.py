"""Compiler of chat templates: text to syntax tree, constants folded, tree to Python closures.

The language has ``{{ expression }}``, ``{% if %}``, ``{% elif %}``, ``{% else %}``, ``{% endif %}``,
``{% set name = expression %}``, one ``{% for message in messages %}`` at the outermost level,
``{% generation %}`` around what a model shall learn, ``{# comments #}``, and a minus sign at a tag's
inner edge that strips the blanks beyond it. Expressions know strings, whole numbers, ``true``,
``false``, ``none``, names, ``a.key`` and ``a['key']``, ``+`` and ``~``, comparisons, ``in``, ``and``, ``or``,
``not``, ``x if c else y`` and the filters handed to the compiler.

Templates are sandboxed by what the language lacks: keys are looked up in dictionaries only, there
are no calls, attributes, products or loops but the one over the messages, so a template can neither
reach the interpreter nor run long. Names set inside a block end with it. The loop's body hence knows
nothing of other turns, and each turn may be rendered where it is.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import regex

TAG = regex.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", regex.DOTALL)
TOKEN = regex.compile(
    r"\s*(?:(?P<number>\d+)|(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<sign>==|!=|<=|>=|[<>+~|().,\[\]=]))"
)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
COMPARE = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    ">": operator.gt,
    "<=": operator.le,
    ">=": operator.ge,
    "in": lambda a, b: a in b,
    "not in": lambda a, b: a not in b,
}
LITERALS = {"true": True, "false": False, "none": None}
KEYWORDS = {"and", "or", "not", "in", "if", "else", *LITERALS}


class TemplateError(ValueError):
    """A template that the language does not allow."""


# ---- Syntax tree


@dataclass(frozen=True)
class Literal:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    key: object


@dataclass(frozen=True)
class Call:
    """A pure function of its parts: an operator or a filter."""

    function: Callable
    parts: tuple


@dataclass(frozen=True)
class Choice:
    """``kind`` is if, and, or."""

    kind: str
    parts: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class If:
    arms: tuple  # (condition, block), the last condition may be Literal(True)


@dataclass(frozen=True)
class Generation:
    block: tuple


@dataclass(frozen=True)
class Turns:
    name: str
    block: tuple


# ---- Parsing


def as_text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def joined(*parts: object) -> str:
    return "".join(map(as_text, parts))


def added(a: object, b: object) -> object:
    if isinstance(a, str) != isinstance(b, str):
        raise TemplateError("only texts or only numbers can be added")
    return a + b


class _Expression:
    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.filters = filters
        self.tokens: list[tuple[str, str]] = []
        at = 0
        source = source.rstrip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            at = found.end()
        self.at = 0

    def peek(self, *texts: str) -> bool:
        if self.at >= len(self.tokens):
            return False
        kind, text = self.tokens[self.at]
        return kind != "string" and text in texts

    def take(self, *texts: str) -> str | None:
        if not self.peek(*texts):
            return None
        self.at += 1
        return self.tokens[self.at - 1][1]

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} expected")

    def whole(self) -> object:
        out = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} not expected")
        return out

    def choice(self) -> object:
        value = self.either()
        if not self.take("if"):
            return value
        condition = self.either()
        other = self.choice() if self.take("else") else Literal(None)
        return Choice("if", (condition, value, other))

    def either(self) -> object:
        left = self.both()
        while self.take("or"):
            left = Choice("or", (left, self.both()))
        return left

    def both(self) -> object:
        left = self.inverse()
        while self.take("and"):
            left = Choice("and", (left, self.inverse()))
        return left

    def inverse(self) -> object:
        if self.take("not"):
            return Call(operator.not_, (self.inverse(),))
        return self.comparison()

    def comparison(self) -> object:
        left = self.sum()
        sign = self.take("==", "!=", "<", ">", "<=", ">=", "in")
        if not sign and self.take("not"):
            self.need("in")
            sign = "not in"
        return Call(COMPARE[sign], (left, self.sum())) if sign else left

    def sum(self) -> object:
        left = self.filtered()
        while sign := self.take("+", "~"):
            left = Call(added if sign == "+" else joined, (left, self.filtered()))
        return left

    def filtered(self) -> object:
        value = self.keyed()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            parts = [value]
            if self.take("("):
                while not self.take(")"):
                    parts.append(self.choice())
                    if not self.peek(")"):
                        self.need(",")
            value = Call(self.filters[name], tuple(parts))
        return value

    def keyed(self) -> object:
        value = self.atom()
        while sign := self.take(".", "["):
            if sign == "[":
                value = Key(value, self.choice())
                self.need("]")
                continue
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name":
                raise TemplateError("a key must follow '.'")
            self.at += 1
            value = Key(value, Literal(name))
        return value

    def atom(self) -> object:
        if self.take("("):
            value = self.choice()
            self.need(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "number":
            return Literal(int(text))
        if kind == "string":
            return Literal(regex.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), text[1:-1], flags=regex.DOTALL))
        if kind == "name" and text in LITERALS:
            return Literal(LITERALS[text])
        if kind == "name" and text not in KEYWORDS and not text.startswith("_"):
            return Name(text)
        raise TemplateError(f"{text!r} not expected")


class _Parser:
    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.filters = filters
        self.parts: list[tuple[str, str]] = []
        at, strip = 0, False
        for tag in TAG.finditer(source):
            text = source[at : tag.start()]
            self._text(text, strip, bool(tag[1] or tag[4] or tag[7]))
            strip = bool(tag[3] or tag[6] or tag[8])
            if tag[2] is not None:
                self.parts.append(("output", tag[2]))
            elif tag[5] is not None:
                self.parts.append(("tag", tag[5].strip()))
            at = tag.end()
        self._text(source[at:], strip, False)
        self.at = 0

    def _text(self, text: str, left: bool, right: bool) -> None:
        text = text.lstrip() if left else text
        text = text.rstrip() if right else text
        if text:
            self.parts.append(("text", text))

    def expression(self, source: str) -> object:
        return _Expression(source, self.filters).whole()

    def block(self, *ends: str, outermost: bool = False) -> tuple[tuple, str]:
        """Nodes up to one of the tags named, and that tag."""
        nodes: list[object] = []
        while self.at < len(self.parts):
            kind, body = self.parts[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(Text(body))
            elif kind == "output":
                nodes.append(Output(self.expression(body)))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return tuple(nodes), body
                nodes.append(self.tag(word, rest.strip(), outermost))
        if ends:
            raise TemplateError(f"no {ends[-1]!r}")
        return tuple(nodes), ""

    def tag(self, word: str, rest: str, outermost: bool) -> object:
        if word == "if":
            arms, condition = [], self.expression(rest)
            while True:
                block, end = self.block("elif", "else", "endif")
                arms.append((condition, block))
                if end == "endif":
                    return If(tuple(arms))
                if end == "else":
                    block, _ = self.block("endif")
                    return If((*arms, (Literal(True), block)))
                condition = self.expression(end.partition(" ")[2])
        if word == "generation" and not rest:
            block, _ = self.block("endgeneration")
            return Generation(block)
        if word == "set":
            name, sign, value = rest.partition("=")
            if not sign or not name.strip().isidentifier() or name.strip().startswith("_"):
                raise TemplateError(f"cannot read set {rest!r}")
            return Set(name.strip(), self.expression(value))
        if word == "for":
            name, _, over = rest.partition(" in ")
            if not outermost or over.strip() != "messages" or not name.strip().isidentifier():
                raise TemplateError("the only loop is over messages, at the outermost level")
            block, _ = self.block("endfor")
            return Turns(name.strip(), block)
        raise TemplateError(f"no tag {word!r}")


def parse(source: str, filters: Mapping[str, Callable]) -> tuple:
    return _Parser(source, filters).block(outermost=True)[0]


# ---- Folding


def fold(node: object, known: Mapping[str, object]) -> object:
    """The expression with everything worked out that depends on constants alone."""
    if isinstance(node, Name) and node.name in known:
        return Literal(known[node.name])
    if isinstance(node, Key):
        of, key = fold(node.of, known), fold(node.key, known)
        if isinstance(of, Literal) and isinstance(key, Literal):
            return Literal(looked_up(of.value, key.value))
        return Key(of, key)
    if isinstance(node, Call):
        parts = tuple(fold(p, known) for p in node.parts)
        if all(isinstance(p, Literal) for p in parts):
            return Literal(node.function(*(p.value for p in parts)))
        return Call(node.function, parts)
    if isinstance(node, Choice):
        parts = tuple(fold(p, known) for p in node.parts)
        if isinstance(parts[0], Literal):
            true = bool(parts[0].value)
            if node.kind == "if":
                return parts[1] if true else parts[2]
            return parts[0] if true == (node.kind == "or") else parts[1]
        return Choice(node.kind, parts)
    return node


def fold_block(block: Sequence, known: Mapping[str, object]) -> tuple:
    """Nodes with constant parts worked out, dead branches left out, neighbouring texts joined."""
    out: list[object] = []
    known = dict(known)

    def give(node: object) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif not (isinstance(node, Text) and not node.text):
            out.append(node)

    for node in block:
        if isinstance(node, Output):
            value = fold(node.value, known)
            give(Text(as_text(value.value)) if isinstance(value, Literal) else Output(value))
        elif isinstance(node, Set):
            value = fold(node.value, known)
            known.pop(node.name, None)
            if isinstance(value, Literal):
                known[node.name] = value.value
            give(Set(node.name, value))
        elif isinstance(node, If):
            arms = []
            for condition, inner in node.arms:
                condition = fold(condition, known)
                if isinstance(condition, Literal) and not condition.value:
                    continue
                arms.append((condition, fold_block(inner, known)))
                if isinstance(condition, Literal):
                    break
            if arms and isinstance(arms[0][0], Literal) and not any(isinstance(n, Set) for n in arms[0][1]):
                for inner in arms[0][1]:
                    give(inner)
            elif arms:
                give(If(tuple(arms)))
        elif isinstance(node, Generation):
            give(Generation(fold_block(node.block, known)))
        elif isinstance(node, Turns):
            inner = {k: v for k, v in known.items() if k not in (node.name, "loop")}
            give(Turns(node.name, fold_block(node.block, inner)))
        else:
            give(node)
    return tuple(out)


# ---- Closures


def looked_up(of: object, key: object) -> object:
    if not isinstance(of, Mapping):
        raise TemplateError(f"no key {key!r} in something that is no dictionary")
    return of.get(key)


@dataclass
class Page:
    """What a template writes, and which spans of it lie in generation blocks."""

    parts: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    length: int = 0

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)

    @property
    def text(self) -> str:
        return "".join(self.parts)


def value_of(node: object) -> Callable[[dict], object]:
    if isinstance(node, Literal):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name

        def read(scope: dict) -> object:
            if name not in scope:
                raise TemplateError(f"no name {name!r}")
            return scope[name]

        return read
    if isinstance(node, Key):
        of, key = value_of(node.of), value_of(node.key)
        return lambda scope: looked_up(of(scope), key(scope))
    if isinstance(node, Call):
        function, parts = node.function, [value_of(p) for p in node.parts]
        if len(parts) == 1:
            (one,) = parts
            return lambda scope: function(one(scope))
        if len(parts) == 2:
            one, two = parts
            return lambda scope: function(one(scope), two(scope))
        return lambda scope: function(*[p(scope) for p in parts])
    first, *rest = (value_of(p) for p in node.parts)
    if node.kind == "if":
        return lambda scope: rest[0](scope) if first(scope) else rest[1](scope)
    if node.kind == "and":
        return lambda scope: first(scope) and rest[0](scope)
    return lambda scope: first(scope) or rest[0](scope)


def writer_of(block: Sequence) -> Callable[[dict, Page], None]:
    """A closure that writes the block."""
    steps = [_step(node) for node in block]

    def run(scope: dict, page: Page) -> None:
        for step in steps:
            step(scope, page)

    return run


def _step(node: object) -> Callable[[dict, Page], None]:
    if isinstance(node, Text):
        text = node.text
        return lambda scope, page: page.write(text)
    if isinstance(node, Output):
        value = value_of(node.value)
        return lambda scope, page: page.write(as_text(value(scope)))
    if isinstance(node, Set):
        name, value = node.name, value_of(node.value)

        def put(scope: dict, page: Page) -> None:
            scope[name] = value(scope)

        return put
    if isinstance(node, If):
        arms = [(value_of(condition), writer_of(block)) for condition, block in node.arms]

        def choose(scope: dict, page: Page) -> None:
            for condition, write in arms:
                if condition(scope):
                    return write(dict(scope), page)

        return choose
    if isinstance(node, Generation):
        inside = writer_of(node.block)

        def mark(scope: dict, page: Page) -> None:
            start = page.length
            inside(dict(scope), page)
            page.spans.append((start, page.length - start))

        return mark
    raise TemplateError("the only loop is over messages, at the outermost level")


class Template:
    """A compiled template; ``turn`` renders one turn where it is, ``render`` a whole conversation."""

    def __init__(self, source: str, filters: Mapping[str, Callable], constants: Mapping[str, object] | None = None):
        self.tree = fold_block(parse(source, filters), constants or {})
        loops = [k for k, node in enumerate(self.tree) if isinstance(node, Turns)]
        if len(loops) != 1 or any(isinstance(n, Set) for n in self.tree):
            raise TemplateError("a template has one loop over messages, and sets names inside it")
        at = loops[0]
        self.name = self.tree[at].name
        self.before, self.behind = writer_of(self.tree[:at]), writer_of(self.tree[at + 1 :])
        self.body = writer_of(self.tree[at].block)

    def turn(self, message: Mapping[str, object], index: int, last: bool, page: Page) -> None:
        """Write a turn, with what comes before the first and behind the last one."""
        if index == 0:
            self.before({}, page)
        loop = {"index0": index, "index": index + 1, "first": index == 0, "last": last}
        self.body({self.name: message, "loop": loop}, page)
        if last:
            self.behind({}, page)

    def render(self, messages: Iterable[Mapping[str, object]]) -> Page:
        page = Page()
        messages = list(messages)
        for index, message in enumerate(messages):
            self.turn(message, index, index + 1 == len(messages), page)
        if not messages:
            self.before({}, page)
            self.behind({}, page)
        return page
