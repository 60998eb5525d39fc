"""Deeply nested records into flat tables that keep parent-child links (problem 1).

Each record is stream-parsed into path-value-ordinal triples
(``functions.literals.scan``).  Triples whose paths share their repeated ancestor
belong to one table; its rows are keyed by the ordinals down to that ancestor, which
are at the same time the foreign key into the table one level up.  All triples of a
record lie in that record's row, so grouping and pivoting need no shuffle: each Arrow
batch goes in as records and comes out as rows of the wanted table, and only the
columns named are read.

Defined cases: a null, empty, truncated or malformed text gives no rows for its record
(for a record split over several cells: if any of them is so, unless they are read apart); null members keep their
position; a missing list has no rows; values that are no finite number are null in
numeric columns; lists of uneven length are filled up with nulls; repeated records are
kept as delivered; other columns of the input are ignored, whatever their names.  A record
may be nested as deeply as it likes.  An object keyed by numbers is a repeated level; a key
of more than ``KEY_DIGITS`` digits, which is no 64-bit number, makes the text malformed.
``rejected`` lists every text that gave no rows and why.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from peakloom.functions.literals import Broken, numbers, scan

_LEAF = re.compile(r"(?:^|\.)([^.\[\]{}]+)((?:\[\]|\{\})*)$")


@dataclass(frozen=True)
class Flat:
    """One output table.

    ancestor: pattern of the repeated path whose members are its rows: the path without the
    leaf's own name, ``a[].b[]`` for both ``a[].b[].leaf`` and ``a[].b.leaf[]``; keys: one
    name for each repeated level; fields: output column to the leaf's name, or names with
    ``|`` between; numeric: fields read as numbers; complete: rows that lack one of the
    fields are left out; present: pattern of the start of paths, down to a member; one that
    holds anything there is a row, its fields null if it has none of them.
    """

    ancestor: str
    keys: tuple[str, ...]
    fields: tuple[tuple[str, str], ...]
    numeric: tuple[str, ...] = ()
    complete: bool = False
    present: str = ""

    def schema(self, record_key: str, nested: int = 0) -> pa.Schema:
        def wrap(t: pa.DataType, times: int) -> pa.DataType:
            return wrap(pa.list_(t), times - 1) if times > 0 else t

        keys = [(k, wrap(pa.int64(), nested - n)) for n, k in enumerate(reversed(self.keys))][::-1]
        return pa.schema([(record_key, pa.int64()), *keys, *((c, wrap(pa.float64() if c in self.numeric else pa.string(), nested)) for c, _ in self.fields)])


class _Paths(dict):
    """Of a path: the field that its leaf is of the table, or none, and whether it passes through a member that makes a row."""

    def __init__(self, spec: Flat):
        self.names = {leaf: k for k, (_, leaves) in enumerate(spec.fields) for leaf in leaves.split("|")}
        self.pattern, self.present = re.compile(spec.ancestor), re.compile(spec.present) if spec.present else None

    def __missing__(self, path: str) -> tuple[int | None, bool]:
        m = _LEAF.search(path)
        field = self.names.get(m[1]) if m else None
        if field is not None and not self.pattern.fullmatch(path[: m.start()] + m[2]):
            field = None
        got = field, bool(self.present and self.present.match(path))
        if len(self) < 10_000:  # shapes are few, but keys may be data
            self[path] = got
        return got


def _pivot(triples: list[tuple], spec: Flat, paths: _Paths) -> Iterator[tuple[tuple, list]]:
    """Rows of one record as blocks: the key of the parent and, per field, either the list
    over the last ordinal or a dict by it."""
    depth, groups = len(spec.keys), {}
    empty = [None] * (len(spec.fields) + (paths.present is not None))
    for path, ords, value in triples:
        field, present = paths[path]
        if present:
            slot = groups.setdefault(ords[: depth - 1], [*empty])
            slot[-1] = slot[-1] or {}
            slot[-1][ords[depth - 1]] = ""
        if field is None:
            continue
        listed = isinstance(value, list)
        if len(ords) + listed != depth:
            continue
        parent = ords if listed else ords[:-1]
        slot = groups.get(parent)
        if slot is None:
            slot = groups[parent] = [*empty]
        if listed:
            slot[field] = value
        else:
            if not isinstance(slot[field], dict):
                slot[field] = {}
            slot[field][ords[-1]] = value
    yield from groups.items()


def _columns(slot: list, spec: Flat) -> tuple[list[int], list[list]]:
    """Positions and values of one block; lists of uneven length are filled with nulls."""
    if all(isinstance(v, list) or v is None for v in slot):
        lists = [[] if v is None else numbers(v) if c in spec.numeric else v for (c, _), v in zip(spec.fields, slot)]
        n = (min if spec.complete else max)(map(len, lists))
        gap = [math.nan if c in spec.numeric else None for c, _ in spec.fields]
        return list(range(n)), [x[:n] + [g] * (n - len(x)) for x, g in zip(lists, gap)]
    maps = [dict(enumerate(v)) if isinstance(v, list) else v or {} for v in slot]
    at = sorted(set().union(*maps))
    return at, [numbers([m.get(k, "") for k in at]) if c in spec.numeric else [m.get(k) for k in at] for (c, _), m in zip(spec.fields, maps)]


def _lists(starts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values)


def flatten(
    df: DataFrame, record_key: str, cells: dict[str, tuple[str, tuple[int, ...]]], spec: Flat, nested: int = 0, apart: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Rows of one flat table of every record of ``df``.

    cells: text columns to the path and ordinals at which their text hangs; several
    cells of a record are read as parts of one nested value.  nested: how many of the last
    levels are folded into lists, so that what is computed per parent (1) or grandparent (2)
    needs no shuffle.  apart: a broken cell takes no other cell's rows with it.  carry: columns
    of the record that its rows repeat.
    """
    arrow, depth = spec.schema(record_key, nested), len(spec.keys)
    own = StructType([df.schema[c] for c in carry])
    if clash := set(carry) & set(arrow.names):
        raise ValueError(f"carried columns have names of the table's own: {sorted(clash)}")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = _Paths(spec)
        for batch in batches:
            record_ids, carried = batch.column(record_key), [batch.column(c) for c in carry]
            blocks: list[tuple[int, int, tuple]] = []  # row of the batch, size, key of the parent
            places: list[int] = []
            values: list[list] = [[] for _ in spec.fields]

            def out() -> pa.RecordBatch:
                sizes = np.array([b[1] for b in blocks], dtype=np.int64)
                row = np.array([b[0] for b in blocks], dtype=np.int64)
                keys = np.array([b[2] for b in blocks], dtype=np.int64).reshape(len(blocks), depth - 1)
                owner = np.repeat(np.arange(len(blocks)), sizes)
                columns = [np.array(v, dtype=np.float64) if c in spec.numeric else v for (c, _), v in zip(spec.fields, values)]
                keep = np.ones(len(places), dtype=bool)
                for (c, _), v in zip(spec.fields, columns):
                    if c in spec.numeric:
                        v[~np.isfinite(v)] = np.nan
                        if spec.complete:
                            keep &= ~np.isnan(v)
                    elif spec.complete:
                        keep &= np.array([x is not None for x in v], dtype=bool)
                made = [pa.array(v, pa.float64(), from_pandas=True) if c in spec.numeric else pa.array(v, pa.string()) for (c, _), v in zip(spec.fields, columns)]
                at = np.flatnonzero(keep)
                owner = owner[at]
                if nested > 1:  # blocks of one grandparent side by side, in order
                    order = np.lexsort([*keys.T[::-1], row])
                    nth = np.empty(len(order), dtype=np.int64)
                    nth[order] = np.arange(len(order))
                    sort = np.argsort(nth[owner], kind="stable")
                    at, owner = at[sort], nth[owner][sort]
                    row, keys = row[order], keys[order]
                made = [c.take(pa.array(at)) for c in (pa.array(places, pa.int64()), *made)]
                heads = []
                if nested:
                    sizes = np.bincount(owner, minlength=len(row))
                    owner = np.flatnonzero(sizes)
                    made = [_lists(np.concatenate([[0], np.cumsum(sizes[owner])]), c) for c in made]
                if nested > 1:
                    line = np.column_stack([row[owner], keys[owner, : depth - 2]])
                    first = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]).any(axis=1)])) if len(line) else np.array([], dtype=np.int64)
                    starts = np.concatenate([first, [len(line)]])
                    heads = [_lists(starts, pa.array(keys[owner, depth - 2]))]
                    made = [_lists(starts, c) for c in made]
                    owner = owner[first]
                heads = [*(pa.array(keys[owner, k]) for k in range(depth - 1 - len(heads))), *heads]
                of = pa.array(row[owner])
                return pa.RecordBatch.from_arrays([record_ids.take(of), *heads, *made, *(c.take(of) for c in carried)], names=[*arrow.names, *carry])

            for k, texts in enumerate(zip(*(batch.column(c).to_pylist() for c in cells))):
                triples, broken = [], False
                for (path, ords), text in zip(cells.values(), texts):
                    try:
                        triples += scan(text, path, ords)
                    except Broken:
                        broken = True
                if broken and not apart:
                    continue
                for parent, slot in _pivot(triples, spec, paths):
                    at, block = _columns(slot, spec)
                    blocks.append((k, len(at), parent))
                    places += at
                    for v, b in zip(values, block):
                        v += b
                if len(places) > 200_000:
                    yield out()
                    blocks.clear()
                    places.clear()
                    for v in values:
                        v.clear()
            if places:
                yield out()

    inputs = dict.fromkeys([*cells, *carry])
    return df.select(F.col(record_key).cast("bigint").alias(record_key), *inputs).mapInArrow(rows, StructType([*from_arrow_schema(arrow), *own]))


def rejected(df: DataFrame, record_key: str, cells: tuple[str, ...]) -> DataFrame:
    """(record_key, cell, reason) of every cell that cannot be read: missing, ends early, malformed, or keyed by too large a number.
    What ``flatten`` leaves out is all of it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for c in cells:
                for rec, text in zip(batch.column(record_key).to_pylist(), batch.column(c).to_pylist()):
                    try:
                        scan(text)
                    except Broken as e:
                        found.append((rec, c, e.args[0]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.string(), pa.string()))], [record_key, "cell", "reason"])

    return df.select(F.col(record_key).cast("bigint").alias(record_key), *cells).mapInArrow(rows, f"`{record_key}` bigint, cell string, reason string")
