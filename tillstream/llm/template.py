"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}                          output
    {% for name in expression %} .. {% endfor %}
    {% if expression %} .. {% elif expression %} .. {% else %} .. {% endif %}
    {% set name = expression %}
    {% generation %} .. {% endgeneration %}   what a model is trained on

Expressions know strings, integers, true, false, none, names, `a.b`, `a['b']`, `+`, `==`, `!=`,
`in`, `and`, `or`, `not`, brackets and filters (`x | trim`). There are no calls, no attributes of
Python objects (`a.b` looks into mappings only) and no loops but those over given values, so a
template can neither reach the interpreter nor run forever.

Source text is parsed into a tree of tuples; operators and filters on constants are computed and
neighbouring constant outputs joined at compile time. Each node becomes a closure that is given the
variables and yields fragments (text, in generation), so a loop over an iterator streams.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

Fragment = tuple[str, bool]
MARK = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}", re.DOTALL)
TOKEN = re.compile(
    r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)"""
    r"""|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[+.|()\[\]]))""")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
CONSTANTS = {"true": True, "false": False, "none": None}


class TemplateError(ValueError):
    """The template is not valid, or names something that is not there."""


def as_text(value: object) -> str:
    return "" if value is None else str(value)


FILTERS: dict[str, Callable] = {
    "trim": lambda v: as_text(v).strip(), "upper": lambda v: as_text(v).upper(),
    "lower": lambda v: as_text(v).lower(), "length": lambda v: len(v),
}


# --- parsing ---------------------------------------------------------------------------------

class _Expressions:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            at = found.end()
        self.at = 0

    def peek(self, *wanted: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "text" \
            and self.tokens[self.at][1] in wanted

    def take(self, kind: str | None = None, value: str | None = None) -> str:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        found_kind, found = self.tokens[self.at]
        if (kind and found_kind != kind) or (value and found != value):
            raise TemplateError(f"unexpected {found!r}")
        self.at += 1
        return found

    def whole(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self):
        left = self.both()
        while self.peek("or"):
            self.take()
            left = ("or", left, self.both())
        return left

    def both(self):
        left = self.negated()
        while self.peek("and"):
            self.take()
            left = ("and", left, self.negated())
        return left

    def negated(self):
        if self.peek("not"):
            self.take()
            return ("not", self.negated())
        return self.compared()

    def compared(self):
        left = self.summed()
        if self.peek("==", "!=", "in"):
            return (self.take(), left, self.summed())
        return left

    def summed(self):
        left = self.filtered()
        while self.peek("+"):
            self.take()
            left = ("+", left, self.filtered())
        return left

    def filtered(self):
        value = self.single()
        while self.peek("|", ".", "["):
            sign = self.take()
            if sign == "|":
                value = ("filter", value, self.take("name"))
            elif sign == ".":
                value = ("item", value, ("constant", self.take("name")))
            else:
                value = ("item", value, self.either())
                self.take("sign", "]")
        return value

    def single(self):
        if self.peek("("):
            self.take()
            inner = self.either()
            self.take("sign", ")")
            return inner
        kind = self.tokens[self.at][0] if self.at < len(self.tokens) else None
        found = self.take()
        if kind == "text":
            return ("constant", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), found[1:-1],
                                       flags=re.DOTALL))
        if kind == "number":
            return ("constant", int(found))
        if kind == "name":
            return ("constant", CONSTANTS[found]) if found in CONSTANTS else ("name", found)
        raise TemplateError(f"unexpected {found!r}")


def parse_expression(source: str):
    return _Expressions(source).whole()


def parse(source: str) -> tuple:
    """("block", [node, ...]) of the whole template."""
    pieces, at = [], 0
    for mark in MARK.finditer(source):
        if mark.start() > at:
            pieces.append(("raw", source[at:mark.start()]))
        pieces.append(("output", mark[1]) if mark[1] is not None else ("tag", mark[2].strip()))
        at = mark.end()
    if at < len(source):
        pieces.append(("raw", source[at:]))

    def block(i: int, ends: tuple[str, ...]) -> tuple[tuple, int, str]:
        nodes: list[tuple] = []
        while i < len(pieces):
            kind, body = pieces[i]
            i += 1
            if kind == "raw":
                nodes.append(("output", ("constant", body)))
                continue
            if kind == "output":
                nodes.append(("output", parse_expression(body)))
                continue
            word, _, rest = body.partition(" ")
            if word in ends:
                return ("block", nodes), i, body
            if word == "for":
                found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.DOTALL)
                if not found:
                    raise TemplateError(f"cannot read the loop {body!r}")
                inner, i, _ = block(i, ("endfor",))
                nodes.append(("for", found[1], parse_expression(found[2]), inner))
            elif word == "if":
                branches, otherwise = [], ("block", [])
                condition = parse_expression(rest)
                while True:
                    inner, i, end = block(i, ("elif", "else", "endif"))
                    branches.append((condition, inner))
                    end_word, _, end_rest = end.partition(" ")
                    if end_word == "elif":
                        condition = parse_expression(end_rest)
                        continue
                    if end_word == "else":
                        otherwise, i, _ = block(i, ("endif",))
                    break
                nodes.append(("if", branches, otherwise))
            elif word == "set":
                found = re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest.strip(), re.DOTALL)
                if not found:
                    raise TemplateError(f"cannot read {body!r}")
                nodes.append(("set", found[1], parse_expression(found[2])))
            elif word == "generation":
                inner, i, _ = block(i, ("endgeneration",))
                nodes.append(("generation", inner))
            else:
                raise TemplateError(f"unknown or misplaced tag {body!r}")
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return ("block", nodes), i, ""

    return block(0, ())[0]


# --- folding constants -----------------------------------------------------------------------

def fold(tree, filters: Mapping[str, Callable] = FILTERS):
    kind = tree[0]
    if kind in ("constant", "name"):
        return tree
    if kind in ("+", "==", "!=", "in", "and", "or", "item"):
        left, right = fold(tree[1], filters), fold(tree[2], filters)
        if left[0] == right[0] == "constant":
            return ("constant", _value((kind, left, right), filters)({}))
        return (kind, left, right)
    if kind in ("not", "filter"):
        inner = fold(tree[1], filters)
        folded = (kind, inner, *tree[2:])
        return ("constant", _value(folded, filters)({})) if inner[0] == "constant" else folded
    if kind == "output":
        return ("output", fold(tree[1], filters))
    if kind == "set":
        return ("set", tree[1], fold(tree[2], filters))
    if kind == "generation":
        return ("generation", fold(tree[1], filters))
    if kind == "for":
        return ("for", tree[1], fold(tree[2], filters), fold(tree[3], filters))
    if kind == "if":
        branches = []
        for condition, inner in tree[1]:
            condition = fold(condition, filters)
            if condition[0] != "constant":
                branches.append((condition, fold(inner, filters)))
            elif condition[1]:
                otherwise = fold(inner, filters)
                break
        else:
            otherwise = fold(tree[2], filters)
        return ("if", branches, otherwise) if branches else otherwise
    nodes: list[tuple] = []
    for node in (fold(n, filters) for n in tree[1]):
        for part in node[1] if node[0] == "block" else [node]:
            before = nodes[-1] if nodes else None
            if part[0] == "output" and part[1][0] == "constant" and before \
                    and before[0] == "output" and before[1][0] == "constant":
                nodes[-1] = ("output", ("constant", as_text(before[1][1]) + as_text(part[1][1])))
            else:
                nodes.append(part)
    return ("block", nodes)


# --- closures --------------------------------------------------------------------------------

def _value(tree, filters: Mapping[str, Callable]) -> Callable[[Mapping], object]:
    kind = tree[0]
    if kind == "constant":
        return lambda variables, value=tree[1]: value
    if kind == "name":
        def look_up(variables, name=tree[1]):
            if name not in variables:
                raise TemplateError(f"{name} is not defined")
            return variables[name]

        return look_up
    if kind == "filter":
        if tree[2] not in filters:
            raise TemplateError(f"unknown filter {tree[2]}")
        inner, apply = _value(tree[1], filters), filters[tree[2]]
        return lambda variables: apply(inner(variables))
    left = _value(tree[1], filters)
    if kind == "not":
        return lambda variables: not left(variables)
    right = _value(tree[2], filters)
    if kind == "item":
        def item(variables):
            owner, key = left(variables), right(variables)
            if isinstance(owner, Mapping):
                return owner.get(key)
            if isinstance(owner, (list, tuple, str)) and isinstance(key, int):
                return owner[key] if -len(owner) <= key < len(owner) else None
            raise TemplateError(f"{key!r} cannot be looked up")

        return item
    if kind == "+":
        def add(variables):
            a, b = left(variables), right(variables)
            return a + b if isinstance(a, int) and isinstance(b, int) else as_text(a) + as_text(b)

        return add
    return {
        "==": lambda variables: left(variables) == right(variables),
        "!=": lambda variables: left(variables) != right(variables),
        "in": lambda variables: left(variables) in right(variables),
        "and": lambda variables: left(variables) and right(variables),
        "or": lambda variables: left(variables) or right(variables),
    }[kind]


def _emit(tree, filters, generation: bool) -> Callable[[dict], Iterator[Fragment]]:
    kind = tree[0]
    if kind == "output":
        value = _value(tree[1], filters)

        def output(variables):
            yield as_text(value(variables)), generation

        return output
    if kind == "generation":
        return _emit(tree[1], filters, True)
    if kind == "set":
        name, value = tree[1], _value(tree[2], filters)

        def assign(variables):
            variables[name] = value(variables)
            yield from ()

        return assign
    if kind == "for":
        name, items = tree[1], _value(tree[2], filters)
        body = _emit(tree[3], filters, generation)

        def repeat(variables):
            inner = dict(variables)
            for index, value in enumerate(items(variables)):
                inner[name], inner["loop"] = value, {"index0": index, "first": index == 0}
                yield from body(inner)

        return repeat
    if kind == "if":
        branches = [(_value(c, filters), _emit(b, filters, generation)) for c, b in tree[1]]
        otherwise = _emit(tree[2], filters, generation)

        def choose(variables):
            for condition, body in branches:
                if condition(variables):
                    yield from body(variables)
                    return
            yield from otherwise(variables)

        return choose
    parts = [_emit(node, filters, generation) for node in tree[1]]

    def run(variables):
        for part in parts:
            yield from part(variables)

    return run


def compile_template(source: str, filters: Mapping[str, Callable] | None = None
                     ) -> Callable[[Mapping], Iterator[Fragment]]:
    """A function from variables to fragments (text, whether it is inside a generation)."""
    known = {**FILTERS, **(filters or {})}
    emit = _emit(fold(parse(source), known), known, False)
    return lambda variables: emit(dict(variables))
