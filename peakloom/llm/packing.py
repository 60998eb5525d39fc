"""Packing items of varying size into containers of fixed capacity (problem 6).

Bounded-space online packing: every partition keeps at most ``windows`` containers open,
puts an item into the one it fills best, and when it fits none gives out the fullest and
opens a new one.  What is open at a partition's end is merged: open containers are items
themselves and are packed again in a sixteenth of the partitions, until one is left, so
that no task ever sees more than 16 x ``windows`` of them.

An item above the capacity is cut into full containers and a rest, no other item is cut.
Partitions are formed by the key's hash and sorted by it, so an item's place does not
depend on the order of arrival, and each round is written down before it is used.

Defined cases: a null or empty text has 0 tokens and is placed like any item; rows with
a null key are placed too; repeated keys are separate items; sizes below 0 count as 0;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.session import bounded, staged

# Fixed value: how the byte-level BPE vocabulary cuts text into words before merging.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WINDOWS = 64
FAN_IN = 16


def token_counts(df: DataFrame, key: str, text: str, vocabulary: str) -> DataFrame:
    """(key, size): tokens of each whole text under a rank file of a public byte-level BPE.

    The driver reads the file, of fixed size, and sends it to the tasks; a worker process builds the coder once.
    """
    with open(vocabulary, "rb") as f:
        ranks = f.read()
    name, sent = f"peakloom-{hashlib.sha256(ranks).hexdigest()}", df.sparkSession.sparkContext.broadcast(ranks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from tiktoken.registry import ENCODINGS

        coder = ENCODINGS.get(name)
        if coder is None:
            pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, sent.value.splitlines())}
            coder = ENCODINGS[name] = tiktoken.Encoding(name, pat_str=WORDS, mergeable_ranks=pairs, special_tokens={})
        for batch in batches:
            sizes = [len(coder.encode_ordinary(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["key", "size"])

    return df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).mapInArrow(count, "key bigint, size bigint")


def _packer(capacity: int, windows: int, step: int):
    """Arrow map from (key, size) rows to (key, piece, size, bin, at, open) rows, each given out
    at once; what is still open at the end follows as rows without a piece, with its tokens as size."""
    names = ["key", "piece", "size", "bin", "at", "open"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = (step << 58) + (TaskContext.get().partitionId() << 34)
        count, room, rows = 0, [], []  # room: sorted (space left, bin)

        def place(key: int, piece: int, size: int) -> None:
            nonlocal count
            k = bisect_left(room, (size, -1))
            if k < len(room):
                left, own = room.pop(k)
            else:
                if len(room) >= windows:
                    room.pop(0)  # the fullest
                left, own = capacity, first + count
                count += 1
            rows.append((key, piece, size, own, capacity - left, False))
            if left > size:
                insort(room, (left - size, own))

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
            rows.clear()
            return batch

        for batch in batches:
            for key, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                size, piece = max(0, size or 0), 0
                while size > capacity:
                    place(key, piece, capacity)
                    size, piece = size - capacity, piece + 1
                place(key, piece, size)
                if len(rows) > 20_000:
                    yield out()
        rows.extend((None, None, capacity - left, own, None, True) for left, own in room)
        if rows:
            yield out()

    return pack


_PACKED = "key bigint, piece int, size bigint, bin bigint, at bigint, open boolean"


def packed(items: DataFrame, capacity: int, windows: int = WINDOWS, partitions: int | None = None) -> DataFrame:
    """(key, piece, size, container, at) for items (key, size): container and offset in it of every piece."""
    parts = partitions or int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = items.select("key", "size").repartition(parts, F.hash("key"), F.hash("size")).sortWithinPartitions("key", "size")
    placed = staged(spread.mapInArrow(_packer(capacity, windows, 0), _PACKED))
    left = placed.where("open").select("bin", "size")
    moved = left.select("bin", F.col("bin").alias("container"), F.lit(0).cast("bigint").alias("base"))  # so far: where each open container is
    step = 0
    while parts > 1:
        parts, step = -(-parts // FAN_IN), step + 1
        merged = left.withColumnRenamed("bin", "key").repartition(parts, F.hash("key")).sortWithinPartitions(F.desc("size"), "key")
        merged = staged(merged.mapInArrow(_packer(capacity, windows, step), _PACKED))
        into = merged.where("NOT open").select(F.col("key").alias("container"), F.col("bin").alias("next"), "at")
        moved = staged(moved.join(bounded(into), "container", "left").select("bin", F.coalesce("next", "container").alias("container"), (F.col("base") + F.coalesce("at", F.lit(0))).alias("base")))
        left = merged.where("open").select("bin", "size")
    # an open container was packed into another, at an offset; all others are where they were
    final = placed.where("NOT open").join(bounded(moved.withColumnRenamed("container", "into")), "bin", "left")
    return final.select("key", "piece", "size", F.coalesce("into", "bin").alias("container"), (F.col("at") + F.coalesce("base", F.lit(0))).alias("at"))
