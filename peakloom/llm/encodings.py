"""Texts decoded in a wrong encoding: finding and undoing (problem 8).

A hidden Markov model labels the characters of a text.  It has one clean state, one state per pair
of encodings (written in one, read in another) and one for text lost to replacement
characters.  The clean state emits characters by a character-class bigram model, or a word as a
whole by the number of texts that hold it; a pair state emits the characters that one character
became, at the clean model's score of that character.  Viterbi's best path gives the spans, each to be
undone by its own state's inverse; a span may begin and end inside a word, as in text
without blanks.  The path is found word by word: what a word does to it is worked out once
(``Labeller.gains``), so that repeated words cost nothing and texts in which no span can pay are passed over.

The clean model is counted over all documents, and once more without the words that the
first count shows to be garbled (Viterbi training); only this second count knows whole
words, so that garbled ones do not speak for themselves.  Words that read as UTF-8
under some pair, or hold replacement characters, are left out of the count: correct
text hardly ever does.  The counts are one number per character and class on either side, so at most
the size of Unicode times ``len(CLASSES)`` squared, and one per word for at most ``BUCKETS * WORDS``
words, whatever the corpus; they go to the tasks as a broadcast.  Labelling is a map over documents without any shuffle.

Defined cases: a null text is not affected; an empty one neither; repeated documents are
each judged, by their own rows; of JSON texts the decoded strings are judged, keys as well as values, and
what stands between them, so one that is not valid is judged whole too; half a surrogate pair
is no character and stays as it is; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakloom.llm.located import Located

ROUNDS = 2  # counts of the clean model: the first over all words, the next without those found garbled
REPEATED = 0.3  # most that a word adds which the text has shown before: repeats are no new evidence
SWITCH = 9.0  # cost in nats of entering a garbled span; leaving it between words is free
INSIDE = 3.0  # further cost of a border between garbled and other non-ASCII characters inside a word
BACKOFF = 5.0  # characters' worth of trust in P(character | class) where a character stands alone
BAD = 9.0  # cost of a character or byte that the pair cannot explain
LOST_CLEAN = 40.0  # cost of a replacement character in clean text
BUCKETS, WORDS = 64, 1024  # hash buckets of words, and how many of each are known as a whole: those in most texts
LONGEST = 40  # characters of a word known as a whole
MARK = 3.0  # cost of an ASCII mark at the end of a word known as a whole
MEMO = 50_000  # words remembered per worker, some 200 MB; beyond it they are forgotten and scored again

# Pairs (written in, read in) that occur in practice.
UTF8_READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1253", "iso8859-15", "iso8859-2", "koi8-r", "cp866", "mac_roman", "cp437", "cp850", "cp852", "cp932", "gbk")
SINGLE = (
    ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("cp1252", "cp1250"), ("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"),
    ("cp1250", "cp1252"), ("iso8859-2", "cp1252"), ("cp1250", "mac_roman"), ("cp852", "cp1252"),
    ("cp1251", "cp1252"), ("koi8-r", "cp1252"), ("iso8859-5", "cp1252"), ("cp866", "cp1252"), ("mac_cyrillic", "cp1252"), ("cp1251", "mac_roman"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("iso8859-5", "cp1251"), ("cp1251", "iso8859-5"), ("koi8-r", "iso8859-5"), ("cp1251", "cp437"),
    ("cp1253", "cp1252"), ("iso8859-7", "cp1252"), ("cp1253", "mac_roman"), ("cp1253", "cp1251"),
    ("cp932", "cp1252"), ("euc_jp", "cp1252"), ("cp932", "mac_roman"), ("euc_jp", "cp932"), ("cp932", "cp437"), ("cp932", "cp1251"),
)

CLASSES = " aA0.lLgGcChkjKPQSMBECF?+"
# a word with a non-ASCII character; tried at the start of words only, so linear in their length
_WORD = re.compile(r"(?<![^ \n\r\t])[^ \n\r\t\x80-\U0010ffff]*+[^\x00-\x7f][^ \n\r\t]*+")
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_NON_ASCII = re.compile(r"[^\x00-\x7f]+")
_NEVER = (-math.inf,) * 4
_NONE = (-math.inf, ())
_INDEX = {k: n for n, k in enumerate(CLASSES)}
_BLANK = _INDEX[" "]


def char_class(c: str) -> str:
    n = ord(c)
    if n < 128:
        return "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else " " if c in " \n\r\t" else "."
    if n < 0xA0:
        return "?"
    if n == 0xA0 or 0x2000 <= n < 0x2010 or n == 0x202F:
        return " "
    if n == 0xFFFD:
        return "F"
    name = unicodedata.name(c, "")
    if name.startswith("LATIN"):
        return "l" if c.islower() else "L"
    if name.startswith("GREEK"):
        return "g" if not c.isupper() else "G"
    if name.startswith("CYRILLIC"):
        return "c" if not c.isupper() else "C"
    if name.startswith("HIRAGANA"):
        return "h"
    if name.startswith("KATAKANA"):
        return "k"
    if name.startswith("HALFWIDTH"):
        return "K"
    if name.startswith("CJK"):
        return "j"
    if 0x3000 <= n < 0x3040 or 0xFF00 <= n < 0xFF60:
        return "P"
    if 0x2010 <= n < 0x2040:
        return "Q"
    if n < 0x100:
        return "S"
    if 0x2190 <= n < 0x2400:
        return "M"
    if 0x2500 <= n < 0x2600:
        return "B"
    kind = unicodedata.category(c)
    return "E" if kind == "So" else "?" if kind[0] == "C" else "+"


_CLASS: dict[str, str] = {}


def _class(c: str) -> str:
    k = _CLASS.get(c)
    if k is None:
        k = _CLASS[c] = char_class(c)
    return k


def _byte_map(codec: str) -> dict[str, bytes]:
    """Character to byte(s) of an encoding; bytes it leaves undefined pass as controls of the same number."""
    out = {}
    if codec in ("cp932", "gbk"):
        return out
    for b in range(256):
        try:
            out[bytes([b]).decode(codec)] = bytes([b])
        except UnicodeDecodeError:
            out[chr(b)] = bytes([b])
    if codec == "cp1252":
        out |= {chr(b): bytes([b]) for b in range(128, 160) if chr(b) not in out}  # control characters read as such
    return out


class Inverse:
    """Undoes one pair: ``word`` as it was written, and how many of its characters could not be explained."""

    def __init__(self, written: str, read: str, times: int = 1):
        self.written, self.read, self.times = written, read, times
        self.name = f"{written}>{read}" + "*2" * (times > 1)
        self.bytes = _byte_map(read)
        self.japanese = written in ("cp932", "euc_jp")
        self.utf8 = written == "utf-8"
        self._leads: re.Pattern | None = None
        self.ones: dict[str, bytes | None] = {}  # at most one for every character of a two-byte encoding
        if self.bytes and (self.utf8 or self.japanese):
            own = lambda low, high: "".join(map(re.escape, (c for c, b in self.bytes.items() if low <= b[0] <= high)))
            self._leads = re.compile(f"[{own(0xC2, 0xF4)}][{own(0x80, 0xBF)}]" if self.utf8 else f"[{own(0x81, 0xFC)}][{own(0x40, 0xFC)}]|[{own(0xA1, 0xDF)}]")
        # one character to one: what each non-ASCII character was
        self.table: dict[str, str] | None = None
        if not self.japanese and not self.utf8:
            own = {c: b.decode(written, "ignore") for c, b in self.bytes.items() if c > "\x7f"}
            self.table = {c: x for c, x in own.items() if x}

    def may(self, word: str) -> bool:
        """Whether a unit can begin anywhere in the word; quick, and never false where one does."""
        return any(map(self._starts, word)) if self._leads is None else self._leads.search(word) is not None

    def units(self, word: str) -> dict[int, list[tuple[int, str]]]:
        """Place to (end, original) of the units that begin there: the fewest characters whose bytes make up whole characters."""
        out: dict[int, list[tuple[int, str]]] = {}
        for i, c in enumerate(word):
            if c > "\x7f" and (self._leads or self._starts(c)) and (own := self._units(word, i)):
                out[i] = own
        if self.japanese and not any(_class(x) in "hkjKPB" for own in out.values() for _, text in own for x in text):
            return {}
        return out

    def _units(self, word: str, i: int) -> list[tuple[int, str]]:
        if self.utf8 and self.bytes:
            got = self._utf8(word, i)
            if got and self.times > 1:
                return self._twice(word, got)
            return [got] if got else []
        out, raw = [], b""
        for j in range(i, min(len(word), i + 8)):
            one = self.bytes.get(word[j]) if self.bytes else self._one(word[j])
            if not one:
                break
            raw += one
            try:
                text = raw.decode(self.written)
            except UnicodeDecodeError as e:
                if e.end < len(raw) or "illegal" in e.reason or "invalid" in e.reason:
                    break
                continue
            if j == i and not self.utf8 and len(text) == 1 and self.written == "cp932" and _class(text) != "K":
                break
            if len(text) <= 3:
                out.append((j + 1, text))
            if self.written != "cp932" or j > i:
                break
        return out

    def _starts(self, c: str) -> bool:
        """Whether the two bytes of a character of a two-byte encoding can begin a unit."""
        b = self._one(c) if c > "\x7f" else None
        if not b:
            return False
        return 0xC2 <= b[0] <= 0xF4 and 0x80 <= b[-1] <= 0xBF or len(b) == 1 and b[0] >= 0xC2 if self.utf8 else b[0] >= 0xA1 and b[-1] >= 0xA1 or b[0] in (0x8E, 0x8F)

    def _one(self, c: str) -> bytes | None:
        if c not in self.ones:
            self.ones[c] = self._encode(c)
        return self.ones[c]

    def _utf8(self, word: str, i: int) -> tuple[int, str] | None:
        first = self.bytes.get(word[i], b"\0")[0]
        n = 2 if 0xC2 <= first < 0xE0 else 3 if 0xE0 <= first < 0xF0 else 4 if 0xF0 <= first < 0xF5 else 0
        if not n or i + n > len(word):
            return None
        raw = b"".join([self.bytes.get(c, b"\0") for c in word[i : i + n]])
        try:
            return i + n, raw.decode()
        except UnicodeDecodeError:
            return None

    def _twice(self, word: str, got: tuple[int, str]) -> list[tuple[int, str]]:
        at, text = got
        for _ in range(3):
            if (own := self._utf8(text, 0)) is not None and own[0] == len(text):
                return [(at, own[1])]
            if at >= len(word) or (more := self._utf8(word, at)) is None:
                return []
            at, text = more[0], text + more[1]
        own = self._utf8(text, 0)
        return [(at, own[1])] if own is not None and own[0] == len(text) else []

    def _plausible(self, text: str, bad: int) -> tuple[str, int] | None:
        """Two bytes that make up nothing Japanese are no Japanese text."""
        return (text, bad) if not self.japanese or any(_class(c) in "hkjKPB" for c in text) else None

    def _encode(self, text: str) -> bytes | None:
        if not self.bytes:
            try:
                return text.encode(self.read)
            except UnicodeEncodeError:
                return None
        try:
            return b"".join([self.bytes[c] for c in text])
        except KeyError:
            return None

    def _once(self, word: str) -> tuple[str, int] | None:
        raw = self._encode(word)
        if raw is not None:
            try:
                return self._plausible(raw.decode(self.written), 0)
            except UnicodeDecodeError:
                pass
        if self.japanese:
            if raw is None:
                return None
            text = raw.decode(self.written, errors="replace")
            return self._plausible(text, n) if (n := text.count("�")) * 4 <= len(text) else None
        bad = done = 0

        def run(m: re.Match) -> str:
            nonlocal bad, done
            own = self._encode(m[0])
            if own is not None:
                try:
                    text = own.decode(self.written)
                    done += 1
                    return text
                except UnicodeDecodeError:
                    pass
            bad += 1
            return m[0]

        text = _NON_ASCII.sub(run, word)
        return (text, bad) if done else None

    def __call__(self, word: str) -> tuple[str, int] | None:
        bad = 0
        for _ in range(self.times):
            if word.isascii():
                return None
            got = self._once(word)
            if got is None or got[0] == word:
                return None
            word, bad = got[0], bad + got[1]
        return word, bad


def inverses() -> list[Inverse]:
    twice = [Inverse("utf-8", c, 2) for c in ("cp1252", "latin-1", "cp1251", "mac_roman", "cp437", "cp850")]
    return [Inverse("utf-8", c) for c in UTF8_READ_AS] + twice + [Inverse(w, r) for w, r in SINGLE]


def _suspect(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows whose text has non-ASCII characters or JSON escapes; all others are clean."""
    own = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return own.where((F.octet_length("text") != F.length("text")) | F.contains("text", F.lit("\\u")))


def clean_counts(docs: DataFrame, earlier=None) -> DataFrame:
    """(before, c, after, n): how often each character stands between each two classes in the non-ASCII words of ``docs``;
    with ``earlier`` also, before and after being empty, how many texts hold the word c, the empty c for all words together.

    earlier: broadcast counts; words that lie in garbled spans under them are left out.
    """
    multi = [Inverse("utf-8", c) for c in UTF8_READ_AS if c not in ("cp932", "gbk")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm = labeller(earlier) if earlier else None
        for batch in batches:
            words: Counter = Counter()
            texts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                own: Counter = Counter()
                judged = Located.suspects(text).text
                own.update(_WORD.findall(judged))
                if hmm and (active := hmm.active(own)):
                    own.subtract([judged[start:end] for start, end, _, _ in hmm.words(judged, active, cut=False)])
                own = +own
                words.update(own)
                texts.update(own.keys())
            pairs: Counter = Counter()
            for word, n in words.items():
                if "�" in word:
                    continue
                if hmm:
                    if 1 < len(core := word.strip(_MARKS)) <= LONGEST:
                        pairs["", core, ""] += texts[word]
                    pairs["", "", ""] += texts[word]
                if any(f(word) for f in multi):
                    continue
                kinds = [" ", *map(_class, word), " "]
                for before, c, after in zip(kinds, word, kinds[2:]):
                    pairs[before, c, after] += n
                pairs[kinds[-2], " ", " "] += n
            columns = [pa.array([k[i] for k in pairs], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(pairs.values()), pa.int64())], ["before", "c", "after", "n"])

    counts = docs.select("text").mapInArrow(count, "before string, c string, after string, n bigint").groupBy("before", "c", "after").agg(F.sum("n").alias("n"))
    most = Window.partitionBy(F.pmod(F.hash("c"), F.lit(BUCKETS)), F.col("before") == "").orderBy(F.desc("n"), "c")
    return counts.withColumn("rank", F.row_number().over(most)).where((F.col("before") != "") | (F.col("c") == "") | (F.col("rank") <= WORDS)).drop("rank")


class Clean:
    """log P(class | class before) + log P(character | class), smoothed; the second of a character that
    stands alone is its share of those of its class that do.  A word that texts hold has at least its share of all words."""

    def __init__(self, rows: list[tuple[str, str, str, int]]):
        self.texts = {c: n for b, c, _, n in rows if not b and c}
        self.total = sum(n for b, c, _, n in rows if not b and not c) or 1
        rows = [r for r in rows if r[0]]
        step, chars, of, before, between = Counter(), Counter(), Counter(), Counter(), Counter()
        for b, c, a, n in rows:
            k = _class(c)
            step[b, k] += n
            before[b] += n
            chars[c] += n
            of[k] += n
            between[b, k, a] += n
        kinds = {k: 60 for k in CLASSES} | {"j": 6000, "E": 1000, "+": 1000}
        self.step = {(b, k): math.log((step[b, k] + 0.02) / (before[b] + 0.02 * len(CLASSES))) for b in CLASSES for k in CLASSES}
        self.share = {c: (n + 0.05) / (of[_class(c)] + 0.05 * kinds[_class(c)]) for c, n in chars.items()}
        self.rare = {k: 0.05 / (of[k] + 0.05 * n) for k, n in kinds.items()}
        self.lone = {k: between[" ", k, " "] + BACKOFF for k in CLASSES}
        alone = {c: n for b, c, a, n in rows if b == a == " "}
        self.alone = {c: math.log((alone.get(c, 0) + BACKOFF * p) / self.lone[_class(c)]) for c, p in self.share.items()}
        self.log = {c: math.log(p) for c, p in self.share.items()}

        self.step_list = [[self.step[b, k] for k in CLASSES] for b in CLASSES]
        self.steps = np.array(self.step_list)
        self.of: dict[str, float] = {}

    def character(self, c: str) -> float:
        """log P(character | class) within a word."""
        p = self.of.get(c)  # at most one for every character of Unicode
        if p is None:
            p = self.log.get(c)
            p = self.of[c] = math.log(self.rare[_class(c)]) if p is None else p
        return p

    def run(self, text: str, before: int) -> float:
        """log P of characters after one of class ``before``."""
        total = 0.0
        for c in text:
            k = _INDEX[_class(c)]
            total += self.step_list[before][k] + self.character(c)
            before = k
        return total

    def __call__(self, word: str, own: int = 0) -> float:
        """own: texts not to count, as that in which the word was met says nothing for it."""
        core = word.strip(_MARKS)
        held = self.texts.get(core, 0) - own
        whole = math.log(held / self.total) - MARK * (len(word) - len(core)) if held > 0 else -math.inf
        return max(whole, self.spelt(word))

    def commoner(self, word: str, other: str) -> bool:
        return self.texts.get(word.strip(_MARKS), 0) > self.texts.get(other.strip(_MARKS), 0)

    def spelt(self, word: str) -> float:
        before, total = " ", 0.0
        step, known = self.step, self.alone if len(word) == 1 else self.log
        for c in word:
            k, p = _class(c), known.get(c)
            if p is None:
                p = math.log(self.rare[k] * BACKOFF / self.lone[k] if len(word) == 1 else self.rare[k])
            total += step[before, k] + p
            before = k
        return total + step[before, " "]


class Labeller:
    """Viterbi over the characters of one text, word by word.

    Within a word the path runs over its characters: each is emitted by the clean state, or is part of a unit (the
    characters that one character became) emitted by a pair state, whose inverse then continues the word for the
    clean model.  What a word does to a path is remembered as four gains over its being clean throughout, by the state the path
    comes in and the one it leaves with; a word whose only span is all of it also gains what it is known for as a whole.
    """

    def __init__(self, rows: list[tuple[str, str, str, int]]):
        self.clean, self.inverses, self.memo, self.tops, self.cuts = Clean(rows), inverses(), {}, {}, {}
        self.tables = [k for k, i in enumerate(self.inverses) if i.table is not None]
        self.column = {k: c for c, k in enumerate(self.tables)}
        self.pairs: dict[tuple[str, str], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.never = np.full(len(self.tables), -np.inf)

    def _pair(self, before: str, c: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What character ``c`` after ``before`` adds to a path of each table state over the clean one: staying, entering, leaving."""
        got = self.pairs.get((before, c))
        if got is None:
            step, clean = self.clean.steps, self.clean.steps[_INDEX[_class(before)], _INDEX[_class(c)]]
            seen = [self._seen(k, before) for k in self.tables], [self._seen(k, c) for k in self.tables]
            b, to = ([_INDEX[_class(x)] for x, _ in own] for own in seen)
            log = np.array([self.clean.character(x) - cost for x, cost in seen[1]]) - self.clean.character(c)
            kind = _INDEX[_class(c)]
            got = step[b, to] + log - clean, step[_INDEX[_class(before)], to] + log - clean, step[b, kind] - clean - INSIDE
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            self.pairs[before, c] = got
        return got

    def _seen(self, k: int, c: str) -> tuple[str, float]:
        """What a character was under a table state, and the cost of leaving it as it is where it cannot have been anything."""
        x = c if c < "\x80" else self.inverses[k].table.get(c)
        return (c, BAD) if x is None else (x, 0.0)

    def _sweep(self, word: str) -> np.ndarray:
        """Four gains (clean to clean, clean to state, state to clean, state to state) of every table state over the characters of
        ``word``, the first entry counted as free."""
        held = np.stack([self.never, np.zeros(len(self.tables))])  # of a path that began clean, and of one that began in the state
        left = np.stack([self.never, self.never])  # paths that are clean again
        before, seen = " ", 0.0
        for c in word:
            if c > "\x7f":
                stay, fresh, leave = self._pair(before, c)
                enter = left - (SWITCH + seen)
                np.maximum(enter[0], -seen, out=enter[0])
                np.maximum(left, held + leave, out=left)
                held = np.maximum(held + stay, enter + fresh)
                seen = INSIDE
            elif before > "\x7f":
                held = held + self._pair(before, c)[0]
            before = c
        if before > "\x7f":
            held = held + self._pair(before, " ")[0]
        left = np.maximum(left, held)
        return np.stack([left[0], held[0], left[1], held[1]])

    def _base(self, word: str) -> tuple[list[int], list[float]]:
        """Classes of a word's characters, and the clean path's score up to each place, the blank after the word included."""
        kind, base, before = [_INDEX[_class(c)] for c in word], [0.0], _BLANK
        for c, k in zip(word, kind):
            base.append(base[-1] + self.clean.step_list[before][k] + self.clean.character(c))
            before = k
        return kind, [*base, base[-1] + self.clean.step_list[before][_BLANK]]

    def _units(self, word: str, k: int) -> dict[int, list[tuple[int, str]]]:
        undo = self.inverses[k]
        return undo.units(word) if undo.table is None else {i: [(i + 1, undo.table[c])] for i, c in enumerate(word) if c in undo.table}

    def _most(self, units: dict[int, list[tuple[int, str]]], base: list[float], kind: list[int]) -> float:
        """No path over these units can gain more: each at best cost-free steps into it and out of it."""
        step, total = self.clean.step_list, 0.0
        for i, own in units.items():
            top = 0.0
            for j, text in own:
                after = step[kind[j - 1]][kind[j] if j < len(kind) else _BLANK]
                top = max(top, sum(map(self.clean.character, text)) - (base[j] - base[i]) - after)
            total += top
        return total

    def _path(self, word: str, k: int, units: dict | None = None, shape: tuple | None = None) -> list[tuple[float, tuple]]:
        """The same for any one state, with the spans of each of the four paths."""
        n, step, clean = len(word), self.clean.step_list, self.clean
        kind, base = shape or self._base(word)
        before = [_BLANK, *kind]
        first, units = next(i for i in range(n) if word[i] > "\x7f"), self._units(word, k) if units is None else units
        out = []
        for began in (False, True):
            # places ahead to value, class before, spans so far, start of the open one; those behind are let go
            nodes: dict[int, tuple] = {0: (0.0, _BLANK, (), 0)} if began else {}
            left = None
            for i, c in enumerate(word):
                node, inner = nodes.pop(i, None), INSIDE * (i > first)
                as_is = node and (node[0] + step[node[1]][kind[i]] - step[before[i]][kind[i]], kind[i], *node[2:])
                if c <= "\x7f":
                    if as_is and (i + 1 not in nodes or as_is[0] > nodes[i + 1][0]):
                        nodes[i + 1] = as_is
                    continue
                sources = [node] if node else []
                if left and (began or left[0] - SWITCH > 0):
                    sources.append((left[0] - SWITCH - inner, before[i], left[1], i))
                elif not began:
                    sources.append((-inner, before[i], (), i))
                options = [(i + 1, (as_is[0] - BAD, *as_is[1:]))] if as_is else []
                for j, text in units.get(i, ()):
                    for value, b, spans, start in sources:
                        options.append((j, (value + clean.run(text, b) - (base[j] - base[i]), _INDEX[_class(text[-1])], spans, start)))
                for j, new in options:
                    if j not in nodes or new[0] > nodes[j][0]:
                        nodes[j] = new
                if as_is and (left is None or as_is[0] - INSIDE > left[0]):
                    left = (as_is[0] - INSIDE, (*node[2], (node[3], i)))
            end = n in nodes and (nodes[n][0] + step[nodes[n][1]][_BLANK] - step[before[n]][_BLANK], (*nodes[n][2], (nodes[n][3], n)))
            options = [x for x in (end, left) if x]
            out += [max(options, key=lambda x: x[0]) if options else _NONE, end or _NONE]
        return out

    def gains(self, word: str) -> dict[int, tuple[float, float, float, float]]:
        """State to its four gains, entering counted as free; -1 is the lost state.  A state that gains no more than -SWITCH is left
        out: leaving it before the word and entering it again after costs less, so no best path is in it."""
        known = self.memo.get(word)
        if known is not None:
            return known
        marks = [c for c in word if c > "\x7f"]
        if all(_class(c) == " " for c in marks):
            return {}  # spaces of another width are no sign
        base, out = self.clean(word, 1), {}
        known_by = base - self.clean.spelt(word)  # what the word has for being known as a whole
        # spans that are not all of the word: of table states at once, of others where they could pay for a border inside
        # it, unless the inverse, being UTF-8's, explains all of it
        several = len(marks) > 1
        tables = self._sweep(word).T.tolist() if several else []
        kind, marks_base = shape = self._base(word) if several else ((), ())
        for k, undo in enumerate(self.inverses):
            got, inside = undo(word), _NEVER
            if several and undo.table is not None:
                inside = tables[self.column[k]]
            elif several and (undo.japanese or got is None or got[1]) and undo.may(word):
                if (units := undo.units(word)) and self._most(units, marks_base, kind) > known_by + INSIDE:
                    inside = [x for x, _ in self._path(word, k, units, shape)]
            four = [x - known_by for x in inside]
            if got is not None:
                gain = self.clean(got[0]) - base
                if self.clean.commoner(got[0], word):  # what the first count missed must not speak for itself
                    gain = max(gain, self.clean.spelt(got[0]) - self.clean.spelt(word))
                gain -= BAD * got[1]
                four = [max(x, gain) for x in four]
            if max(four) > -SWITCH:
                out[k] = tuple(four)
        if lost := word.count("�"):
            out[-1] = (lost * LOST_CLEAN,) * 4
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[word] = out
        return out

    def cut(self, word: str, state: int, way: int) -> list[tuple[int, int]]:
        """Spans of the best of the four paths of ``word`` in a state."""
        got = self.cuts.get((word, state, way))
        if got is None:
            if len(self.cuts) >= MEMO:
                self.cuts.clear()
            got = self.cuts[word, state, way] = self._cut(word, state, way)
        return got

    def _cut(self, word: str, state: int, way: int) -> list[tuple[int, int]]:
        if state < 0:
            return [m.span() for m in re.finditer("�+", word)]
        start = next(i for i, c in enumerate(word) if c > "\x7f")
        end = len(word) if self.inverses[state].japanese else max(i for i, c in enumerate(word) if c > "\x7f") + 1
        if sum(c > "\x7f" for c in word) > 1:
            gain, spans = self._path(word, state)[way]
            known_by = self.clean(word, 1) - self.clean.spelt(word)
            if spans and gain - known_by >= self.gains(word)[state][way] - 1e-9:
                return [(max(a, start), min(b, end)) for a, b in spans]
        return [(start, end)]

    def active(self, counted: Counter) -> set[int]:
        """States that a best path through a text of these words can be in: those whose words' best gains, repeats as far as they
        count, exceed the cost of entering; a span of another state would lose."""
        total: dict[int, float] = {}
        for word, n in counted.items():
            tops = self.tops.get(word)
            if tops is None:
                tops = [(k, top, top if k < 0 else min(top, REPEATED)) for k, four in self.gains(word).items() if (top := max(four)) > 0]
                if len(self.tops) >= MEMO:
                    self.tops.clear()
                self.tops[word] = tops
            for k, top, again in tops:
                total[k] = total.get(k, 0.0) + top + (n - 1) * again
        return {k for k, v in total.items() if v > SWITCH}

    def words(self, text: str, active: set[int] | None = None, cut: bool = True) -> list[tuple[int, int, int, list[tuple[int, int]]]]:
        """(start, end, state, spans) of the words of ``text`` that hold garbled characters, in order; without ``cut`` no spans."""
        active = self.active(Counter(_WORD.findall(text))) if active is None else active
        if not active:
            return []
        words = [(m.start(), m.end(), self.gains(m[0])) for m in _WORD.finditer(text)]
        clean, best = 0.0, {}
        back: list[tuple] = []
        shown: set[str] = set()
        for start, end, gains in words:
            word = text[start:end]
            repeated = word in shown
            shown.add(word)
            new_clean, came, new, into = clean, None, {}, {}
            for k in active & gains.keys():
                four = gains[k] if k < 0 or not repeated else [min(x, REPEATED) for x in gains[k]]
                held = best.get(k, -math.inf)
                stay, enter = held + four[3], clean - SWITCH + four[1]
                new[k], into[k] = (stay, (k, k, 3)) if stay >= enter else (enter, (None, k, 1))
                for value, way in ((held + four[2], (k, k, 2)), (clean - SWITCH + four[0], (None, k, 0)), (new[k], into[k])):
                    if value > new_clean:
                        new_clean, came = value, way
            clean, best = new_clean, new
            back.append((came, into))
        state, out = None, []
        for (start, end, _), (came, into) in zip(reversed(words), reversed(back)):
            way = came if state is None else into[state]
            if way is not None:
                state, k, which = way
                out.append((start, end, k, [(start + a, start + b) for a, b in self.cut(text[start:end], k, which)] if cut else []))
        return out[::-1]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, state) of the garbled characters of ``text``, in order."""
        return [(a, b, state) for _, _, state, own in self.words(text) for a, b in own]

    def changes(self, text: str) -> tuple[list[tuple[int, int, int, str | None]], Counter]:
        """(start, end, state, original) of every span, the original null where it cannot be had, and how many words each state holds."""
        out, seen = [], Counter()
        for _, _, state, own in self.words(text):
            seen[self.name(state)] += 1
            for a, b in own:
                got = self.inverses[state](text[a:b]) if state >= 0 else None
                out.append((a, b, state, got[0] if got else None))
        return out, seen

    def name(self, state: int) -> str:
        return "lost" if state < 0 else self.inverses[state].name


def labeller(model: Broadcast) -> Labeller:
    """The labeller of a broadcast {"rows": counts}.  A worker process keeps a broadcast's value from task to task, and with it the
    labeller put beside the counts and the words that it has worked out."""
    held = model.value
    if "made" not in held:
        held["made"] = Labeller(held["rows"])
    return held["made"]


_SPANS = "key bigint, first_char int, end_char int, pair string, garbled string, original string"


def _model(docs: DataFrame) -> Broadcast:
    model = None
    for _ in range(ROUNDS):
        model = docs.sparkSession.sparkContext.broadcast({"rows": [tuple(r) for r in clean_counts(docs, model).collect()]})  # at most Unicode x classes squared, some thousands in practice
    return model


def label(df: DataFrame, key: str, text: str, restored: bool = False) -> DataFrame:
    """(key, words, pairs[, text]): affected rows, the number of their garbled words, the pairs that explain
    them, most words first, and if wanted the text restored as far as it can be: outside the labelled spans it is the text as it was, byte for byte."""
    docs = _suspect(df, key, text)
    model = _model(docs)
    schema = "key bigint, words int, pairs string" + ", text string" * restored

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm = labeller(model)
        for batch in batches:
            keys, words, pairs, texts = [], [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = Located.suspects(t)
                changes, seen = hmm.changes(own.text)
                if seen:
                    keys.append(k)
                    words.append(sum(seen.values()))
                    pairs.append(",".join(p for p, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))))
                    if restored:
                        texts.append(own.replaced([(a, b, new) for a, b, _, new in changes if new is not None]))
            columns = [pa.array(keys, pa.int64()), pa.array(words, pa.int32()), pa.array(pairs, pa.string())] + [pa.array(texts, pa.string())] * restored
            yield pa.RecordBatch.from_arrays(columns, ["key", "words", "pairs", *["text"] * restored])

    out = docs.mapInArrow(judge, schema)
    return out.withColumnsRenamed({"key": key, "text": text})


def garbled_spans(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, first_char, end_char, pair, garbled, original): every labelled span, its place in the raw text and what its state's
    inverse makes of it; null where nothing can be restored."""
    docs = _suspect(df, key, text)
    model = _model(docs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm = labeller(model)
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = Located.suspects(t)
                for a, b, state, new in hmm.changes(own.text)[0]:
                    raw = own.spans(a, b)
                    rows.append((k, raw[0][0], raw[-1][1], hmm.name(state), own.text[a:b], new))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.string()] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["key", "first_char", "end_char", "pair", "garbled", "original"])

    return docs.mapInArrow(judge, _SPANS).withColumnRenamed("key", key)
