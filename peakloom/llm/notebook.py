"""The cells of a notebook document, and where their characters stand in its raw text."""

from __future__ import annotations

import json
import re

from peakloom.llm.located import Located, pieces

# The lines that begin a cell in the two plain-text layouts.
_MARKS = {
    "console": re.compile(r"^(?:Text|Error|Image|(?:In |Out)\[[ \d]*\]):[ \t]*$", re.M),
    "script": re.compile(r"^# %%.*$", re.M),
}
_JSON = re.compile(r'\s*(?:"((?:[^"\\]|\\.)*+)"|([\[{])|([\]}])|([,:])|([^\s\[\]{},:"]+))', re.S)


class Placed(str):
    """A string of a JSON text with its place there, quotes not counted."""

    place: tuple[int, int]


def placed(text: str) -> object:
    """A JSON text whose strings know their place.  Open levels lie on a list, so depth has no limit; raises ``ValueError`` where lists and objects do not close."""
    root: list = []
    stack: list[tuple] = [(root, [])]  # container, and of an object the key that waits for its value
    at, end = 0, len(text.rstrip())
    while at < end:
        m = _JSON.match(text, at)
        if not m:
            raise ValueError(f"no JSON at {at}")
        at = m.end()
        holder, key = stack[-1]
        if m[4]:
            continue
        if m[3]:
            if len(stack) == 1 or m[3] != ("}" if isinstance(holder, dict) else "]"):
                raise ValueError(f"nothing to close at {at}")
            stack.pop()
            continue
        if m[1] is not None:
            value = Placed("".join([p[0] for p in pieces(text, m.start(1), m.end(1))]))
            value.place = m.span(1)
            if isinstance(holder, dict) and not key:
                key.append(value)
                continue
        else:
            value = {} if m[2] == "{" else [] if m[2] else json.loads(m[5])
        if isinstance(holder, dict):
            if not key:
                raise ValueError(f"a value without a key at {at}")
            holder[key.pop()] = value
        else:
            holder.append(value)
        if m[2]:
            stack.append((value, []))
    if len(stack) > 1 or len(root) != 1:
        raise ValueError("the text ends early")
    return root[0]


def _lines(x: object) -> list[str]:
    return [x] if isinstance(x, str) else [s for s in x if isinstance(s, str)] if isinstance(x, list) else []


def _texts(x: object) -> list[list[str]]:
    """Texts in nested data, each as its lines; the strings of a list are lines of one text."""
    out, todo = [], [x]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            todo.extend(reversed(x.values()))
            continue
        out.append(_lines(x))
        if isinstance(x, list):
            todo.extend(reversed([v for v in x if isinstance(v, (dict, list))]))
    return out


def _of_book(book: object) -> list[list[str]]:
    out, errors = [], []
    for cell in book["cells"]:
        out.append(_lines(cell.get("source")))
        for o in cell.get("outputs") or []:
            out.append(_lines(o.get("text")))
            out.append([part for line in o.get("traceback") or [] if isinstance(line, str) for part in (line, "\n")])
            out += _texts(o.get("data") or {})
            errors += _texts(o.get("evalue"))
    return out + errors


_NO_BOOK = (ValueError, KeyError, TypeError, AttributeError)


def _plain(text: str, layout: str | None) -> list[tuple[int, int]] | None:
    """Places of the cells of a plain layout."""
    if layout not in _MARKS:
        return None
    marks = [m.span() for m in _MARKS[layout].finditer(text)]
    return list(zip([0, *(b for _, b in marks)], [*(a for a, _ in marks), len(text)]))


def _loaded(text: str) -> object:
    try:
        return json.loads(text)
    except RecursionError:
        return placed(text)


def cells(text: str, layout: str | None) -> list[str]:
    """Sources and outputs of a document, each on its own; one that is no notebook is one cell, without its escapes."""
    if (places := _plain(text, layout)) is not None:
        return [text[a:b] for a, b in places]
    try:
        return ["".join(lines) for lines in _of_book(_loaded(text))]
    except _NO_BOOK:
        return [text if text.lstrip()[:1] != "{" else "".join([p[0] for p in pieces(text, 0, len(text))])]


def located(text: str, layout: str | None) -> list[Located]:
    """The same cells, with the places of their characters."""
    if (places := _plain(text, layout)) is not None:
        return [Located(text, [(text[a:b], a, b)], False) for a, b in places]
    try:
        _loaded(text)
        return [Located(text, [p for s in lines for p in (pieces(text, *s.place) if isinstance(s, Placed) else [(s, 0, 0)])] or [("", 0, 0)], True) for lines in _of_book(placed(text))]
    except _NO_BOOK:
        if text.lstrip()[:1] != "{":
            return [Located(text, [(text, 0, len(text))], False)]
        return [Located(text, pieces(text, 0, len(text)) or [("", 0, 0)], True)]
