"""JSON in Python for what Spark's own readers can't keep: open-ended nesting, key order, JSON text within JSON."""

from __future__ import annotations

import json
import re
from json.decoder import scanstring

_SPACE = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"(-?(?:0|[1-9]\d*))(\.\d+)?([eE][-+]?\d+)?|true|false|null|NaN|-?Infinity")
_WORDS = {"true": True, "false": False, "null": None, "NaN": float("nan"), "Infinity": float("inf"), "-Infinity": float("-inf")}
_NOT_ALNUM = re.compile(r"[\W_]+")


def loads(text: str):
    """json.loads that any nesting depth may be given. Raises ValueError for text that is not one whole JSON value."""
    try:
        return json.loads(text)
    except RecursionError:
        return _deep_loads(text)


def _deep_loads(text: str):
    """The same with a stack of our own in place of recursion."""
    top: list = []
    stack: list = [top]
    keys: list = [None]
    at, want = _SPACE.match(text, 0).end(), "value"
    while True:
        c = text[at : at + 1]
        if want == "value":
            if c in ("{", "["):
                new: dict | list = {} if c == "{" else []
                _put(stack[-1], keys[-1], new)
                stack.append(new)
                keys.append(None)
                at = _SPACE.match(text, at + 1).end()
                if text[at : at + 1] == ("}" if c == "{" else "]"):
                    want = "end"
                else:
                    want = "key" if c == "{" else "value"
                continue
            if c == '"':
                value, at = scanstring(text, at + 1)
            elif m := _SCALAR.match(text, at):
                value = _WORDS[m[0]] if m[0] in _WORDS else float(m[0]) if m[2] or m[3] else int(m[0])
                at = m.end()
            else:
                raise ValueError(f"no value at {at}")
            _put(stack[-1], keys[-1], value)
            want = "next"
        elif want == "key":
            if c != '"':
                raise ValueError(f"no key at {at}")
            keys[-1], at = scanstring(text, at + 1)
            at = _SPACE.match(text, at).end()
            if text[at : at + 1] != ":":
                raise ValueError(f"no colon at {at}")
            at, want = _SPACE.match(text, at + 1).end(), "value"
            continue
        elif want == "end":
            stack.pop()
            keys.pop()
            at, want = at + 1, "next"
        at = _SPACE.match(text, at).end()
        if len(stack) == 1:
            if at != len(text):
                raise ValueError(f"more after the value at {at}")
            return top[0]
        c = text[at : at + 1]
        if c == ",":
            at, want = _SPACE.match(text, at + 1).end(), "key" if isinstance(stack[-1], dict) else "value"
        elif c == ("}" if isinstance(stack[-1], dict) else "]"):
            want = "end"
        else:
            raise ValueError(f"no end at {at}")


def _put(holder, key, value) -> None:
    if isinstance(holder, dict):
        holder[key] = value
    else:
        holder.append(value)


def opened(value):
    """The value, or what it holds if it is a string of the JSON text of an object or a list."""
    while isinstance(value, str):
        text = value.strip()
        if text[:1] + text[-1:] not in ("{}", "[]", '""') or len(text) < 2:
            return value
        try:
            inner = loads(text)
        except ValueError:
            return value
        if isinstance(inner, str):
            deeper = opened(inner)
            return deeper if isinstance(deeper, dict | list) else value
        value = inner
    return value


def record_of(text: str | None) -> dict | None:
    """The JSON object that a whole text is, also where it is the JSON text of a string of one; None for anything else."""
    if not text or text.isspace():
        return None
    try:
        value = opened(loads(text))
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def fold(text: str) -> str:
    """Letters and digits alone, without letter case."""
    return _NOT_ALNUM.sub("", text).casefold()


def canonical(text: str | None) -> str | None:
    """One spelling for all writings of a JSON text: strings folded, fields in order of their names, names, list order,
    numbers, booleans and nulls kept. Text that is no JSON is a string; it never equals a JSON string's spelling. Null stays null."""
    if text is None:
        return None
    try:
        value = loads(text)
    except ValueError:
        return "?" + fold(text)
    try:
        return json.dumps(_folded(value), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    except RecursionError:
        return _deep_dumps(value)


def _folded(value):
    if isinstance(value, str):
        return _NOT_ALNUM.sub("", value).casefold()
    if isinstance(value, dict):
        return {k: _folded(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_folded(v) for v in value]
    return value


def _deep_dumps(value) -> str:
    """What json.dumps(_folded(value), ...) gives, without recursion."""
    out: list[str] = []
    todo: list = [("value", value)]
    while todo:
        kind, item = todo.pop()
        if kind == "text":
            out.append(item)
        elif isinstance(item, dict):
            todo.append(("text", "}"))
            for i, k in enumerate(reversed(names := sorted(item))):
                todo.append(("value", item[k]))
                todo.append(("text", ("," if i < len(names) - 1 else "") + json.dumps(k, ensure_ascii=False) + ":"))
            out.append("{")
        elif isinstance(item, list):
            todo.append(("text", "]"))
            for i, v in enumerate(reversed(item)):
                todo.append(("value", v))
                if i < len(item) - 1:
                    todo.append(("text", ","))
            out.append("[")
        else:
            out.append(json.dumps(fold(item) if isinstance(item, str) else item, ensure_ascii=False))
    return "".join(out)
