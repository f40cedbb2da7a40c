"""Chat formatting: a small sandboxed template language, compiled to Python closures.

``{{ value }}``, ``{% for m in messages %}``, ``{% if %} {% elif %} {% else %}``,
``{% set x = value %}`` and ``{% generation %}`` blocks. Values are strings, integers,
``true/false/none``, names, ``m.role`` (a key of a message, nothing else), ``==``,
``!=``, ``and``, ``or``, ``not``, ``+`` and the filters below. There are no calls, no
Python attributes and no other loops than those over messages, so a template always ends.

A template is parsed to a syntax tree, constants are folded (also whole branches),
neighbouring texts are joined, and the tree becomes nested closures. Rendering yields
the text and the character spans of the generation blocks.

Texts are escaped reversibly: a backslash is doubled, and wherever a control string
starts a backslash goes after its first character, so no control string is left
even where two overlap.

Conversations are brought together by one shuffle and a sort; a task holds one
conversation at a time. Its formatted text is one string, which is the operator's result.

Defined cases: null roles and texts are empty; rows of equal turn go by role, then text;
rows without ``conv_id`` are one conversation; a null turn comes first.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

#: The strings that steer common chat formats.
CONTROLS = (
    "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)

TEMPLATE = (
    "{{ bos }}{% for m in messages %}<|im_start|>{{ m.role | escape }}<|im_sep|>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}<|im_end|>{{ '\\n' }}{% endfor %}"
)
CONSTANTS = {"bos": "<s>"}

_STARTS = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + r")(.)|(\\)", re.S)


def escape(text: str) -> str:
    return _STARTS.sub(lambda m: m[1] + "\\" if m[1] else "\\\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


_FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower,
}

# --- parsing ------------------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|+.()]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    """The template isn't part of the language."""


class _Values:
    """Recursive descent over one expression; makes nested tuples."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"unexpected {source[at:]!r}")
            quoted, number, name, sign = found.groups()
            if quoted is not None:
                body = re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), quoted[1:-1], flags=re.S)
                self.tokens.append(("const", body))
            elif number is not None:
                self.tokens.append(("const", int(number)))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            at = found.end()

    def parse(self) -> tuple:
        tree = self.any_of()
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return tree

    def take(self, *wanted: str) -> str | None:
        if self.tokens and self.tokens[0][0] != "const" and self.tokens[0][1] in wanted:
            return self.tokens.pop(0)[1]
        return None

    def any_of(self) -> tuple:
        left = self.all_of()
        while self.take("or"):
            left = ("or", left, self.all_of())
        return left

    def all_of(self) -> tuple:
        left = self.negation()
        while self.take("and"):
            left = ("and", left, self.negation())
        return left

    def negation(self) -> tuple:
        return ("not", self.negation()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        left = self.added()
        while sign := self.take("==", "!="):
            left = (sign, left, self.added())
        return left

    def added(self) -> tuple:
        left = self.filtered()
        while self.take("+"):
            left = ("+", left, self.filtered())
        return left

    def filtered(self) -> tuple:
        value = self.atom()
        while self.take("|"):
            name = self.tokens.pop(0)[1] if self.tokens else None
            if name not in _FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = ("filter", name, value)
        return value

    def atom(self) -> tuple:
        if not self.tokens:
            raise TemplateError("a value is missing")
        if self.take("("):
            inner = self.any_of()
            if not self.take(")"):
                raise TemplateError("')' is missing")
            return inner
        kind, value = self.tokens.pop(0)
        if kind == "const":
            return ("const", value)
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        if value in ("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[value])
        tree = ("name", value)
        while self.take("."):
            if not self.tokens or self.tokens[0][0] != "name":
                raise TemplateError("a key is missing")
            tree = ("key", tree, self.tokens.pop(0)[1])
        return tree


def parse(source: str) -> list[tuple]:
    """The syntax tree: a list of text, value, set, if, for and generation nodes."""
    parts, at = [], 0
    for tag in _TAG.finditer(source):
        parts.append(("text", source[at : tag.start()]))
        parts.append(("value", _Values(tag[1]).parse()) if tag[1] is not None else ("tag", tag[2].strip()))
        at = tag.end()
    parts = [p for p in [*parts, ("text", source[at:])] if p != ("text", "")]
    body, rest, end = _block(parts, ())
    if rest or end:
        raise TemplateError(f"unexpected {end!r}")
    return body


def _block(parts: list[tuple], ends: tuple[str, ...]) -> tuple[list[tuple], list[tuple], str]:
    body: list[tuple] = []
    while parts:
        kind, value = parts[0]
        parts = parts[1:]
        if kind != "tag":
            body.append((kind, value))
            continue
        word = value.split(None, 1)[0] if value else ""
        if word in ends:
            return body, parts, value
        if word == "set" and (found := re.fullmatch(r"set\s+([A-Za-z_]\w*)\s*=(?!=)(.*)", value, re.S)):
            body.append(("set", found[1], _Values(found[2]).parse()))
        elif found := re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", value):
            inner, parts, _ = _block(parts, ("endfor",))
            body.append(("for", found[1], inner))
        elif word == "generation":
            inner, parts, _ = _block(parts, ("endgeneration",))
            body.append(("generation", inner))
        elif word == "if":
            branches, test = [], value[2:]
            while True:
                inner, parts, end = _block(parts, ("elif", "else", "endif"))
                branches.append((_Values(test).parse() if test is not None else ("const", True), inner))
                if end == "endif":
                    break
                if test is None:
                    raise TemplateError("nothing but endif may follow else")
                test = end[4:] if end.startswith("elif") else None
            body.append(("if", branches))
        else:
            raise TemplateError(f"unexpected {value!r}")
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return body, parts, ""


# --- folding ------------------------------------------------------------------

_BINARY: dict[str, Callable] = {
    "+": lambda a, b: _text(a) + _text(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "and": lambda a, b: a and b, "or": lambda a, b: a or b,
}


def _text(value: object) -> str:
    return "" if value is None else str(value)


def fold_value(tree: tuple, constants: dict[str, object]) -> tuple:
    kind = tree[0]
    if kind == "name" and tree[1] in constants:
        return ("const", constants[tree[1]])
    if kind == "filter":
        inner = fold_value(tree[2], constants)
        return ("const", _FILTERS[tree[1]](_text(inner[1]))) if inner[0] == "const" else ("filter", tree[1], inner)
    if kind == "not":
        inner = fold_value(tree[1], constants)
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    if kind in _BINARY:
        a, b = (fold_value(x, constants) for x in tree[1:])
        if a[0] == "const" and (b[0] == "const" or kind in ("and", "or") and bool(a[1]) == (kind == "or")):
            return ("const", _BINARY[kind](a[1], b[1] if b[0] == "const" else None))
        return (kind, a, b)
    return tree


def fold(body: list[tuple], constants: dict[str, object]) -> list[tuple]:
    """The same tree with constants worked out, dead branches gone and texts joined."""
    out: list[tuple] = []
    known = dict(constants)
    for node in _assigned(body):
        known.pop(node, None)
    for node in body:
        kind = node[0]
        if kind == "value":
            value = fold_value(node[1], known)
            made = [("text", _text(value[1]))] if value[0] == "const" else [("value", value)]
        elif kind == "set":
            made = [("set", node[1], fold_value(node[2], known))]
        elif kind == "for":
            made = [("for", node[1], fold(node[2], {k: v for k, v in known.items() if k != node[1]}))]
        elif kind == "generation":
            made = [("generation", fold(node[1], known))]
        elif kind == "if":
            branches = []
            for test, inner in node[1]:
                test = fold_value(test, known)
                if test[0] == "const" and not test[1]:
                    continue
                branches.append((test, fold(inner, known)))
                if test[0] == "const":
                    break
            made = branches[0][1] if branches and branches[0][0][0] == "const" else [("if", branches)] if branches else []
        else:
            made = [node]
        for new in made:
            if new[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + new[1])
            elif new != ("text", ""):
                out.append(new)
    return out


def _assigned(body: list[tuple]) -> set[str]:
    names: set[str] = set()
    for node in body:
        if node[0] == "set":
            names.add(node[1])
        for inner in ([b for _, b in node[1]] if node[0] == "if" else [node[-1]] if node[0] in ("for", "generation") else []):
            names |= _assigned(inner)
    return names


# --- closures -----------------------------------------------------------------


def _value(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        return lambda env, v=tree[1]: v
    if kind == "name":
        return lambda env, n=tree[1]: env.get(n)
    if kind == "key":
        def key(env, inner=_value(tree[1]), name=tree[2]):
            holder = inner(env)
            return holder.get(name) if type(holder) is dict else None
        return key
    if kind == "filter":
        return lambda env, f=_FILTERS[tree[1]], inner=_value(tree[2]): f(_text(inner(env)))
    if kind == "not":
        return lambda env, inner=_value(tree[1]): not inner(env)
    a, b = _value(tree[1]), _value(tree[2])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    return lambda env, f=_BINARY[kind]: f(a(env), b(env))


class _Output:
    """Pieces of text, and where generated ones start and end."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)


def _closure(body: list[tuple]) -> Callable[[dict, _Output], None]:
    steps: list[Callable[[dict, _Output], None]] = []
    for node in body:
        kind = node[0]
        if kind == "text":
            steps.append(lambda env, out, s=node[1]: out.add(s))
        elif kind == "value":
            steps.append(lambda env, out, v=_value(node[1]): out.add(_text(v(env))))
        elif kind == "set":
            steps.append(lambda env, out, n=node[1], v=_value(node[2]): env.__setitem__(n, v(env)))
        elif kind == "generation":
            def generation(env, out, run=_closure(node[1])):
                start = out.length
                run(env, out)
                out.spans.append((start, out.length))
            steps.append(generation)
        elif kind == "for":
            def loop(env, out, name=node[1], run=_closure(node[2])):
                for message in env["messages"]:
                    run(env | {name: message}, out)
            steps.append(loop)
        else:
            def branch(env, out, ways=[(_value(t), _closure(b)) for t, b in node[1]]):
                for test, run in ways:
                    if test(env):
                        return run(env, out)
            steps.append(branch)

    def run_all(env: dict, out: _Output) -> None:
        for step in steps:
            step(env, out)

    return run_all


def compile_template(source: str, constants: dict[str, object] | None = None) -> Callable[[list[dict]], tuple[str, list]]:
    """A function from messages to ``(text, generation spans in characters)``."""
    run = _closure(fold(parse(source), constants or {}))

    def render(messages: list[dict]) -> tuple[str, list]:
        out = _Output()
        run({"messages": messages}, out)
        return "".join(out.pieces), out.spans

    return render


# --- on Spark -----------------------------------------------------------------

_OUT_BYTES = 8 << 20


def format_conversations(rows: DataFrame, template: str = TEMPLATE, constants: dict[str, object] | None = None) -> DataFrame:
    """``(conv_id, formatted, loss_spans)`` from rows ``(conv_id, turn, role, text)``."""
    constants = CONSTANTS if constants is None else constants
    compile_template(template, constants)  # an error shows here, not in a task
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, formatted string, loss_spans array<struct<start:int,stop:int>>"

    def format_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, constants)
        id_type = None

        def turns() -> Iterator[tuple]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def made(done: list[tuple]) -> pa.RecordBatch:
            spans = pa.array([[{"start": a, "stop": b} for a, b in s] for _, _, s in done],
                             pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
            return pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], id_type), pa.array([d[1] for d in done], pa.string()), spans],
                names=["conv_id", "formatted", "loss_spans"])

        done, held = [], 0
        for conv, group in groupby(turns(), key=lambda t: t[0]):
            text, spans = render([{"role": role or "", "text": body or ""} for _, role, body in group])
            done.append((conv, text, spans))
            held += len(text)
            if held > _OUT_BYTES:
                yield made(done)
                done, held = [], 0
        if done:
            yield made(done)

    ordered = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(format_part, schema)


_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>\n", re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts out of a conversation formatted by :data:`TEMPLATE`."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def read_loss(formatted: str, spans: list) -> str:
    """All text under the loss mask, unescaped, nothing between."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)
