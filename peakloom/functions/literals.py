"""Stream parser for nested text records: JSON and the literal texts Python writers leave.

``scan`` walks a text once, left to right, and appends ``(path, ordinals, value)``
triples.  A path names keys (``.key``) and repeated levels (``[]`` for list members,
``{}`` for members of an object keyed by numbers); the ordinals give the position at
each repeated level, outermost first.  A list of plain scalars comes as *one* triple
whose value is the list of its texts: the last ordinal is then the index in it, which
keeps long traces out of the per-value loop.
"""

from __future__ import annotations

import json
import math
import re

_SPACE = re.compile(r"\s*")
_BARE = re.compile(r"[^\[\](){}\"':]*([\])])")
_QUOTED = re.compile(r"[^\[\](){}:]*([\])])")
_STRING = re.compile(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'", re.S)
_ATOM = re.compile(r"[^\s\[\](){},:\"']+")
_SCALAR_CALL = re.compile(r"\b(?:np|numpy)\.\w+\(([^()\[\]]*)\)")
_CLOSES = {"[": "]", "(": ")", "{": "}"}
KEY_DIGITS = 18  # digits of a number key: what a 64-bit ordinal holds
MISSING, EARLY, MALFORMED, KEY = "missing", "ends early", "malformed", "key too large"


class Broken(ValueError):
    """The text is no nested literal; its one argument says why."""


def _at(text: str, at: int) -> Broken:
    return Broken(MALFORMED if text[at:].strip() else EARLY)


def _text(token: str) -> str:
    if "\\" not in token:
        return token[1:-1]
    if token[0] == '"':
        try:
            return json.loads(token, strict=False)
        except ValueError:
            pass
    return re.sub(r"\\(.)", r"\1", token[1:-1], flags=re.S)


def _scalars(text: str, start: int, closer: str) -> tuple[list[str], int] | None:
    """Members of a list of scalars that starts at ``start``, and where it ends."""
    if m := _BARE.match(text, start):
        parts = text[start : m.start(1)].split(",")
        if not parts[-1].strip():
            parts.pop()
    else:
        m = _QUOTED.match(text, start)
        if not m or "\\" in m[0]:
            return None
        parts = [p.strip() for p in text[start : m.start(1)].split(",")]
        if parts[-1] == "":
            parts.pop()
        quotes = sum(p.count("'") + p.count('"') for p in parts)
        if quotes != 2 * len(parts) or not all(len(p) > 1 and p[0] in "'\"" and p[0] == p[-1] for p in parts):
            return None
        parts = [p[1:-1] for p in parts]
    if m[1] != closer:
        raise Broken(MALFORMED)
    return parts, m.end()


def scan(text: str | None, path: str = "", ords: tuple = ()) -> list[tuple]:
    """Triples of one text; raises ``Broken`` if it is null, empty, ends early or is malformed.

    Open lists, objects and calls lie on a stack of this function's own, so a record may be nested
    as deeply as it likes; a path is put together only where a value is met.
    """
    if text is None or not text.strip():
        raise Broken(MISSING)
    if "np." in text or "numpy." in text:
        text = _SCALAR_CALL.sub(r"\1", text)
    out: list[tuple] = []
    names, places = [path], [*ords]  # pieces of the current path, and the ordinals of its repeated levels
    stack: list[str] = []  # what closes each open level: ] or ) of a list, } of an object, ! of a call
    at = 0

    def here() -> str:
        return "".join(names).removeprefix(".")

    def key(at: int) -> int:
        """The key of an object's member, and where its value begins."""
        m = _STRING.match(text, at) or _ATOM.match(text, at)
        if not m:
            raise _at(text, at)
        name = _text(m[0]) if m[0][0] in "'\"" else m[0]
        at = _SPACE.match(text, m.end()).end()
        if text[at : at + 1] != ":":
            raise _at(text, at)
        if name.isascii() and name.isdigit():
            if len(name) > KEY_DIGITS:
                raise Broken(KEY)
            names.append("{}")
            places.append(int(name))
        else:
            names.append("." + name)
        return at + 1

    while True:
        c = text[at : at + 1]
        if c.isspace():
            at = _SPACE.match(text, at).end()
            c = text[at : at + 1]
        if c and c in "[(":
            at += 1
            if flat := _scalars(text, at, _CLOSES[c]):
                out.append((here() + "[]", tuple(places), flat[0]))
                at = flat[1]
            else:
                stack.append(_CLOSES[c])
                names.append("[]")
                places.append(0)
                at = _SPACE.match(text, at).end()
                if text[at : at + 1] != _CLOSES[c]:
                    continue
        elif c == "{":
            at = _SPACE.match(text, at + 1).end()
            stack.append("}")
            if text[at : at + 1] != "}":
                at = key(at)
                continue
            names.append(".")
        elif c and c in "'\"":
            m = _STRING.match(text, at)
            if not m:
                raise Broken(EARLY)
            out.append((here(), tuple(places), _text(m[0])))
            at = m.end()
        else:
            m = _ATOM.match(text, at)
            if not m:
                raise _at(text, at)
            at = m.end()
            if text[at : at + 1] == "(":  # a call such as array([...]): its first argument
                stack.append("!")
                at += 1
                continue
            out.append((here(), tuple(places), m[0]))
        # a value has ended: close what ends with it, until a further member follows
        while stack:
            closer = stack[-1]
            c = text[at : at + 1]
            if c.isspace():
                at = _SPACE.match(text, at).end()
                c = text[at : at + 1]
            if closer == "!":
                at = text.find(")", at) + 1
                if not at:
                    raise Broken(EARLY)
                stack.pop()
                continue
            if c == ",":
                at += 1
                c = text[at : at + 1]
                if c.isspace():
                    at = _SPACE.match(text, at).end()
                    c = text[at : at + 1]
                if c != closer:
                    if closer == "}":
                        if names.pop() == "{}":
                            places.pop()
                        at = key(at)
                    else:
                        places[-1] += 1
                    break
            elif c != closer:
                raise _at(text, at)
            at += 1
            stack.pop()
            if names.pop() in ("[]", "{}"):
                places.pop()
        else:
            if text[at:].strip():
                raise Broken(MALFORMED)
            return out


def number(text: str | None) -> float:
    """The finite number a scalar text holds, else NaN; digits grouped by ``_`` are no number."""
    try:
        x = float(text)
    except (TypeError, ValueError):
        return math.nan
    return x if math.isfinite(x) and "_" not in text else math.nan


def numbers(texts: list[str]) -> list[float]:
    try:
        if "_" not in "".join(texts):
            return list(map(float, texts))
    except (TypeError, ValueError):
        pass
    return [number(t) for t in texts]
