"""Decoded texts whose characters know their place in the raw text, so that spans found in the one can be changed in the other."""

from __future__ import annotations

import json
import re
from bisect import bisect_right

HALF = "￿"  # stands for half a surrogate pair, which is no character; not U+FFFD, which would mark the text as garbled

_TOKEN = re.compile(r'"((?:[^"\\]|\\.)*+)"', re.S)
_CLEAN = re.compile(r'(?:[\x00-\x21\x23-\x7f]*+"(?:[\x00-\x21\x23-\x5b\x5d-\x7f]|\\[\x00-\x74\x76-\x7f])*+")*+')  # strings without anything to judge
_ESCAPE = re.compile(r"\\(?:u([dD][89abAB][0-9a-fA-F]{2})\\u([dD][c-fC-F][0-9a-fA-F]{2})|u([0-9a-fA-F]{4})|(.))", re.S)
_PLAIN = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}


def _char(m: re.Match) -> str:
    if m[1]:
        return chr(0x10000 + ((int(m[1], 16) - 0xD800) << 10) + int(m[2], 16) - 0xDC00)
    if m[3]:
        n = int(m[3], 16)
        return HALF if 0xD800 <= n < 0xE000 else chr(n)
    return _PLAIN.get(m[4], m[4])


def pieces(raw: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """(text, from, to) of raw[start:end] without its JSON escapes; an escape is a piece of its own."""
    if raw.find("\\", start, end) < 0:
        return [(raw[start:end], start, end)]
    out = []
    for m in _ESCAPE.finditer(raw, start, end):
        if m.start() > start:
            out.append((raw[start : m.start()], start, m.start()))
        out.append((_char(m), m.start(), m.end()))
        start = m.end()
    if start < end:
        out.append((raw[start:end], start, end))
    return out


class Located:
    def __init__(self, raw: str, parts: list[tuple[str, int, int]], escaped: bool):
        self.raw, self.parts, self.escaped = raw, parts, escaped
        self.text = parts[0][0] if len(parts) == 1 else "".join([p[0] for p in parts])
        self._starts: list[int] | None = None

    @classmethod
    def suspects(cls, raw: str) -> "Located":
        """What of a text can have other than ASCII characters: all of a plain text; of a JSON text its strings (values and keys
        alike) and whatever stands between them that is not ASCII, each on a line of its own."""
        if raw.lstrip()[:1] != "{":
            return cls(raw, [(raw, 0, len(raw))], False)
        parts: list[tuple[str, int, int]] = []

        def add(start: int, end: int) -> None:
            own = raw[start:end]
            if not own.isascii() or "\\u" in own:
                parts.extend(pieces(raw, start, end))
                parts.append(("\n", end, end))

        at = 0
        while m := _TOKEN.search(raw, at := _CLEAN.match(raw, at).end()):
            add(at, m.start())
            add(m.start(1), m.end(1))
            at = m.end()
        add(at, len(raw))
        return cls(raw, parts or [("", 0, 0)], True)

    def spans(self, start: int, end: int) -> list[tuple[int, int]]:
        """Places in the raw text of the characters from start to end, those side by side as one."""
        if self._starts is None:
            self._starts, at = [], 0
            for p in self.parts:
                self._starts.append(at)
                at += len(p[0])
        out: list[list[int]] = []
        k = max(0, bisect_right(self._starts, start) - 1)
        while k < len(self.parts) and self._starts[k] < end:
            text, a, b = self.parts[k]
            if b - a == len(text):
                first = self._starts[k]
                a, b = a + max(0, start - first), a + min(len(text), end - first)
            if a < b:
                if out and out[-1][1] == a:
                    out[-1][1] = b
                else:
                    out.append([a, b])
            k += 1
        return [(a, b) for a, b in out]

    def replaced(self, changes: list[tuple[int, int, str]]) -> str:
        """The raw text with characters from start to end replaced, in order; all else stays as it is, byte for byte."""
        out, done = [], 0
        for start, end, new in changes:
            for k, (a, b) in enumerate(self.spans(start, end)):
                own = new if k == 0 else ""
                if self.escaped:
                    own = json.dumps(own, ensure_ascii=self.raw[a:b].isascii())[1:-1]
                out += [self.raw[done:a], own]
                done = b
        return "".join([*out, self.raw[done:]])
