"""Evaluation passages inside a training corpus (problem 7).

Every task turns its documents into shards of words and builds one FM-index of each: the
suffixes sorted, the Burrows-Wheeler transform in a wavelet matrix for ranks, and every
``SAMPLE``-th suffix position kept.  All phrases of ``length`` words of the test items are
searched backward at once, last word first; occurrences are located by walking to the
next sampled position, and overlapping phrases of an item are merged into one span.

The index's alphabet is the items' vocabulary.  Words outside it are borders, as are the
ends of cells, and stretches shorter than a phrase are left out: neither can be part of
an occurrence, so nothing is lost and the index is much smaller than the text.

Documents are only mapped, never shuffled.  The items come to the driver a partition at a time and go to the
tasks as phrases, in blocks of about ``BLOCK`` characters; a shard is indexed once and searched for ``BLOCKS`` of
them, and only more items than that take another pass over the corpus.

Defined cases: null and empty texts hold nothing; items of fewer words than a phrase, and
null items, are never found; every copy of a document and every repeated item counts by
its own id; a notebook that is no JSON is read as one cell of plain text, and one may be nested as deeply as
it likes; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.llm.notebook import cells, located

PHRASE = 12
SHARD_WORDS = 1 << 20  # words in a shard, before borders and short stretches go
SAMPLE = 8
BLOCK = 4_000_000  # characters of items in a block, so some tens of MB of phrases
BLOCKS = 8  # blocks that a task holds at a time

_LETTERS = bytes(c if chr(c) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for c in range(256))
_WORD = re.compile("[a-z0-9]+")


def words(text: str) -> list[bytes]:
    """Maximal runs of a-z and 0-9 after lower-casing."""
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).split()


def word_places(text: str) -> list[tuple[int, int]]:
    """Where the same words stand in the text."""
    low = text.lower()
    if len(low) == len(text):
        return [m.span() for m in _WORD.finditer(low)]
    own = [k for k, c in enumerate(text) for _ in c.lower()]  # a character may become several
    return [(own[a], own[b - 1] + 1) for a, b in (m.span() for m in _WORD.finditer("".join([c.lower() for c in text])))]


def suffixes(seq: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; a round sorts only the suffixes that are not yet told apart."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    step = np.concatenate([[0], np.flatnonzero(np.diff(seq[order])) + 1])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(step, np.diff(np.concatenate([step, [n]])))  # of a group: its first place
    h = 1
    while True:
        of = rank[order]
        same = of[1:] == of[:-1]
        open_ = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(open_):
            return order
        at = order[open_]
        after = np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        first = rank[at]
        sort = np.lexsort((after, first))
        at, first, after = at[sort], first[sort], after[sort]
        order[open_] = at
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (after[1:] != after[:-1])])
        rank[at] = open_[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        h *= 2


class WaveletMatrix:
    """Ranks and symbols of a sequence, for arrays of places at once."""

    def __init__(self, seq: np.ndarray, size: int):
        self.levels, self.zeros = [], []
        self.bits = max(1, int(size - 1).bit_length())
        for k in reversed(range(self.bits)):
            bit = (seq >> k) & 1
            self.levels.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        low = np.zeros_like(at)
        for level, zeros, k in zip(self.levels, self.zeros, reversed(range(self.bits))):
            one = ((symbol >> k) & 1).astype(bool)
            low = np.where(one, zeros + level[low], low - level[low])
            at = np.where(one, zeros + level[at], at - level[at])
        return at - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for level, zeros in zip(self.levels, self.zeros):
            one = level[at + 1] > level[at]
            out = out * 2 + one
            at = np.where(one, zeros + level[at], at - level[at])
        return out


class FmIndex:
    def __init__(self, seq: np.ndarray, size: int):
        """seq: symbols from 1 to size - 1; 0 is kept for the end."""
        seq = np.concatenate([seq, [0]])
        order = suffixes(seq)
        self.matrix = WaveletMatrix(seq[order - 1], size)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=size))])[:-1]
        sampled = order % SAMPLE == 0
        self.sampled, self.place = sampled, np.cumsum(sampled) - 1
        self.kept = order[sampled]
        self.n = len(seq)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [low, high) of the suffixes that begin with each phrase."""
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        alive = np.arange(len(phrases))
        for k in reversed(range(phrases.shape[1])):
            c = phrases[alive, k].astype(np.int64)
            low[alive] = self.before[c] + self.matrix.rank(c, low[alive])
            high[alive] = self.before[c] + self.matrix.rank(c, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        rows, steps, out = rows.copy(), 0, np.full(len(rows), -1, dtype=np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            hit = self.sampled[rows[todo]]
            done = todo[hit]
            out[done] = self.kept[self.place[rows[done]]] + steps
            todo = todo[~hit]
            c = self.matrix.symbol(rows[todo])
            rows[todo] = self.before[c] + self.matrix.rank(c, rows[todo])
            steps += 1
        return out


class Shard:
    """The long stretches of item words in some documents, indexed once."""

    def __init__(self, docs: list[list[list[bytes]]], ids: dict[bytes, int], length: int):
        get, sizes, self.owner = ids.get, [], []
        flat: list[int] = []
        for doc, parts in enumerate(docs):
            for cell, ws in enumerate(parts):
                flat += [get(w, 1) for w in ws]
                flat.append(1)
                sizes.append(len(ws) + 1)
                self.owner.append((doc, cell))
        seq = np.array(flat, dtype=np.int64)
        border = np.concatenate([[-1], np.flatnonzero(seq == 1)])
        gap = np.diff(border) - 1
        long = gap >= length
        starts, gaps = border[:-1][long] + 1, gap[long]
        self.length, self.index = length, None
        if len(starts):  # long stretches only, each followed by one border
            ends = np.cumsum(gaps + 1)
            self.source = np.arange(ends[-1]) + np.repeat(starts - (ends - gaps - 1), gaps + 1)
            held = seq[self.source]
            self.present = np.bincount(held, minlength=len(ids) + 2) > 0
            self.index = FmIndex(held, len(ids) + 2)
            self.cell_start = np.concatenate([[0], np.cumsum(sizes)])

    def search(self, rows: np.ndarray, first: np.ndarray, items: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(item, document's place, cell, first word, word after the last) of every span of phrases ``rows``, whose items
        are items[first[k] : first[k + 1]]."""
        if self.index is None or not len(rows):
            return
        which = np.flatnonzero(self.present[rows[:, -1]] & self.present[rows[:, 0]])
        low, high = self.index.search(rows[which])
        hits = high - low
        of = np.repeat(which, hits)
        row = np.arange(hits.sum()) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(low, hits)
        at = self.source[self.index.locate(row)]
        many = first[of + 1] - first[of]
        item = items[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[of], many)]
        at = np.repeat(at, many)
        cell = np.searchsorted(self.cell_start, at, side="right") - 1
        order = np.lexsort((at, cell, item))
        item, cell, at = item[order], cell[order], at[order]
        if not len(at):
            return
        new = np.concatenate([[True], (item[1:] != item[:-1]) | (cell[1:] != cell[:-1]) | (at[1:] > at[:-1] + self.length)])
        begins = np.flatnonzero(new)
        ends = np.concatenate([begins[1:], [len(at)]]) - 1
        base = self.cell_start[cell[begins]]
        for i, c, a, b in zip(item[begins].tolist(), cell[begins].tolist(), (at[begins] - base).tolist(), (at[ends] + self.length - base).tolist()):
            yield (i, *self.owner[c], a, b)


def phrases(items: list[tuple[int, list[bytes]]], length: int, ids: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct phrases of items as rows of word numbers (new words are added to ``ids``; 1 is the border), and
    the items of each: those of phrase k at first[k] to first[k + 1]."""
    rows, owner = [], []
    for item, ws in items:
        own = [ids.setdefault(w, len(ids) + 2) for w in ws]
        if len(own) >= length:
            rows.append(np.lib.stride_tricks.sliding_window_view(np.array(own, dtype=np.int32), length))
            owner.append(np.full(len(own) - length + 1, item, dtype=np.int64))
    if not rows:
        return np.empty((0, length), np.int32), np.zeros(1, np.int64), np.empty(0, np.int64)
    table, owner = np.concatenate(rows), np.concatenate(owner)
    order = np.lexsort((owner, *table.T[::-1]))
    table, owner = table[order], owner[order]
    new = np.concatenate([[True], (table[1:] != table[:-1]).any(axis=1)])
    pair = new | np.concatenate([[True], owner[1:] != owner[:-1]])  # an item that repeats a phrase counts once
    at = np.cumsum(pair) - 1
    return table[new], np.concatenate([at[new], [pair.sum()]]), owner[pair]


def _sent(items: DataFrame, item: tuple[str, str], length: int, block: int) -> Iterator[tuple[list[Broadcast], Broadcast]]:
    """Blocks of phrases and the vocabulary, for one pass over the corpus at a time."""
    context = items.sparkSession.sparkContext
    own = items.select(F.col(item[0]).cast("bigint"), item[1]).dropna()
    held, size, ids, blocks = [], 0, {}, []
    for key, text in own.toLocalIterator():
        held.append((key, words(text)))
        size += len(text)
        if size >= block:
            blocks.append(context.broadcast(phrases(held, length, ids)))
            held, size = [], 0
            if len(blocks) == BLOCKS:
                yield blocks, context.broadcast(ids)
                ids, blocks = {}, []
    if held or blocks:
        blocks.append(context.broadcast(phrases(held, length, ids)))
        yield blocks, context.broadcast(ids)


def _found(docs: DataFrame, doc: tuple[str, str, str], items: DataFrame, item: tuple[str, str], length: int, shard: int, block: int, schema: str, rows) -> DataFrame:
    """Union of the passes: ``rows`` makes rows of the schema of a document (key, text, layout) and its spans (item, cell, first word, end word)."""
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [{"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[f.split()[1]] for f in schema.split(", ")]
    out = None
    for blocks, vocabulary in _sent(items, item, length, block):

        def search(batches: Iterator[pa.RecordBatch], blocks=blocks, vocabulary=vocabulary) -> Iterator[pa.RecordBatch]:
            ids, held, size = vocabulary.value, [], 0

            def found() -> Iterator[pa.RecordBatch]:
                index, spans = Shard([parts for *_, parts in held], ids, length), {}
                for sent in blocks:
                    for i, d, *span in index.search(*sent.value):
                        spans.setdefault(d, []).append((i, *span))
                made = [row for d in sorted(spans) for row in rows(*held[d][:3], sorted(spans[d]))]
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], names)

            for key, text, layout in chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches):
                if not text or not ids:
                    continue
                parts = [words(c) for c in cells(text, layout)]
                held.append((key, text, layout, parts))
                size += sum(map(len, parts))
                if size >= shard:
                    yield from found()
                    held, size = [], 0
            if held:
                yield from found()

        one = docs.select(F.col(doc[0]).cast("bigint"), doc[1], doc[2]).mapInArrow(search, schema)
        out = one if out is None else out.unionByName(one)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


_SPAN = "item_id bigint, doc_id bigint, cell int, first_word int, end_word int, first_char int, end_char int"


def spans(docs: DataFrame, doc: tuple[str, str, str], items: DataFrame, item: tuple[str, str], length: int = PHRASE, shard: int = SHARD_WORDS, block: int = BLOCK) -> DataFrame:
    """(item_id, doc_id, cell, first_word, end_word, first_char, end_char) of every passage of at least ``length`` words that an item shares with one
    cell of a document, in words and in characters of the cell.  doc: columns of id, text and layout; item: id and text."""

    def rows(key: int, text: str, layout: str | None, found: list[tuple]) -> Iterator[tuple]:
        own, places = cells(text, layout), {}
        for i, cell, a, b in found:
            if cell not in places:
                places[cell] = word_places(own[cell])
            yield i, key, cell, a, b, places[cell][a][0], places[cell][b - 1][1]

    return _found(docs, doc, items, item, length, shard, block, _SPAN, rows)


def removed(docs: DataFrame, doc: tuple[str, str, str], items: DataFrame, item: tuple[str, str], length: int = PHRASE, shard: int = SHARD_WORDS, block: int = BLOCK) -> DataFrame:
    """(doc_id, removed, text) of every affected document: its raw text without the leaked passages, all else as it was, byte for byte, and
    how many characters went.  Of passages of several items that overlap each character goes once.  With more than ``BLOCKS`` blocks of items a document may
    have a row for each pass, which removes that pass's passages."""

    def rows(key: int, text: str, layout: str | None, found: list[tuple]) -> Iterator[tuple]:
        own, places, gone = located(text, layout), {}, set()
        for _, cell, a, b in found:
            if cell not in places:
                places[cell] = word_places(own[cell].text)
            gone.update(own[cell].spans(places[cell][a][0], places[cell][b - 1][1]))
        left, at = [], 0
        for a, b in sorted(gone):
            if b > at:
                left.append(text[at : max(at, a)])
                at = b
        kept = "".join([*left, text[at:]])
        yield key, len(text) - len(kept), kept

    return _found(docs, doc, items, item, length, shard, block, "doc_id bigint, removed int, text string", rows)
