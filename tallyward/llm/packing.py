"""Operator 2: bounded-space online packing of token sequences.

Every partition reads its documents once and keeps a fixed number of open windows. A document's
full windows go out at once; its remainder goes to the open window it fits best, or a new one;
where none fits and no more may be opened, the fullest is emitted. What is still open at the end
of a partition is merged in rounds, ``FAN_IN`` partitions at a time: best fit by falling length,
the nearly full windows are emitted and at most ``windows`` stay open. The last round pours the
rest into full windows, cutting pieces at their ends, and cuts what is left at powers of two.
A task holds at most FAN_IN * windows * size ids, whatever the table's size.

Contract: null counts as empty, an empty document is its end id alone. Repeated rows are packed
once each. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.pretokens import word_ids
from tallyward.llm.tables import slices, stored

SIZE = 4096
WINDOWS = 64
FAN_IN = 16

PIECE = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ("part", pa.int64()), ("ids", pa.binary())])
PIECE_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
             "sequence_id long, offset long, part long, ids binary")
RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Emitter:
    """Rows of emitted windows (part null) and of open ones (part and ids given)."""

    def __init__(self, round_: int, part: int):
        self.part, self.next = part, round_ << 58 | part << 30
        self.rows: list[list] = [[] for _ in PIECE.names]

    def window(self, pieces: list[tuple], still_open: bool = False) -> None:
        """Pieces are (doc_id, start, doc_tokens, ids)."""
        offset = 0
        for doc_id, start, tokens, ids in pieces:
            data = ids.tobytes()
            row = (doc_id, start, len(ids), zlib.crc32(data), tokens, self.next, offset,
                   self.part if still_open else None, data if still_open else None)
            for column, value in zip(self.rows, row):
                column.append(value)
            offset += len(ids)
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(self.rows, PIECE.types)], schema=PIECE)
        self.rows = [[] for _ in PIECE.names]
        return made


class OpenWindows:
    """At most ``most`` open windows, found by their free space."""

    def __init__(self, most: int, size: int):
        self.most, self.size = most, size
        self.free: list[tuple[int, int]] = []
        self.pieces: dict[int, list] = {}
        self.made = 0

    def place(self, piece: tuple) -> list | None:
        """Puts a piece into the window that it fits best; the window emitted for it, if any."""
        need, out = len(piece[3]), None
        at = bisect_left(self.free, (need, -1))
        if at < len(self.free):
            room, key = self.free.pop(at)
        else:
            if len(self.free) >= self.most:
                out = self.pieces.pop(self.free.pop(0)[1])
            room, key, self.made = self.size, self.made, self.made + 1
            self.pieces[key] = []
        self.pieces[key].append(piece)
        if room == need:  # a piece as long as a window is emitted without coming here
            return self.pieces.pop(key)
        insort(self.free, (room - need, key))
        return out


def split_document(doc_id, ids: np.ndarray, size: int) -> Iterator[tuple]:
    for start in range(0, len(ids), size):
        yield doc_id, start, len(ids), ids[start:start + size]


def merge(pieces: list[tuple], emit: Emitter, size: int, keep: int, last: bool) -> None:
    """Best fit by falling length over the pieces of a group of partitions."""
    bins = OpenWindows(len(pieces) + 1, size)
    for piece in sorted(pieces, key=lambda p: -len(p[3])):
        if (full := bins.place(piece)) is not None:
            emit.window(full)
    left = []
    for free, key in bins.free:  # fullest first
        if free * 64 <= size:
            emit.window(bins.pieces[key])
        else:
            left.append(bins.pieces[key])
    if not last:
        for window in left[:-keep] if len(left) > keep else []:
            emit.window(window)
        for window in left[-keep:]:
            emit.window(window, still_open=True)
        return
    pour([p for window in left for p in window], emit, size)


def pour(pieces: list[tuple], emit: Emitter, size: int) -> None:
    """Full windows, then windows of falling powers of two: no padding at all."""
    total = sum(len(p[3]) for p in pieces)
    room = [size] * (total // size) + [1 << b for b in range(size.bit_length())[::-1] if total % size >> b & 1]
    window, used, slots = [], 0, iter(room)
    capacity = next(slots, 0)
    for doc_id, start, tokens, ids in pieces:
        while len(ids):
            take = ids[:capacity - used]
            window.append((doc_id, start, tokens, take))
            start, ids, used = start + len(take), ids[len(take):], used + len(take)
            if used == capacity:
                emit.window(window)
                window, used, capacity = [], 0, next(slots, 0)


def pack(docs: DataFrame, path: str, size: int = SIZE, windows: int = WINDOWS) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    ``size`` is a power of two."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_ids(path), TaskContext.get().partitionId()
        emit, bins = Emitter(0, part), OpenWindows(windows, size)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                ids, counts = encoder.encode(texts[a:b], end=True)
                begin = 0
                for key, n in zip(keys[a:b], counts.tolist()):
                    for piece in split_document(key, ids[begin:begin + n], size):
                        if len(piece[3]) == size:
                            emit.window([piece])
                        else:
                            held = piece[:3] + (piece[3].copy(),)
                            if (full := bins.place(held)) is not None:
                                emit.window(full)
                    begin += n
                yield emit.batch()
        for _, key in bins.free:
            emit.window(bins.pieces[key], still_open=True)
        yield emit.batch()

    done, open_ = [], stored(chosen.mapInArrow(first, PIECE_DDL), "packing")
    round_ = 0
    while True:
        done.append(open_.filter("part is null"))
        left = open_.filter("part is not null")
        parts = left.agg(F.max("part")).first()[0]
        if parts is None:
            break
        round_ += 1
        last = parts < FAN_IN
        open_ = stored(_merged(left, round_, size, windows, last), "packing")
    return reduce(DataFrame.unionAll, done).select(*RESULT)


def _merged(left: DataFrame, round_: int, size: int, windows: int, last: bool) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        part = group.column("grp")[0].as_py()
        rows = group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).select(
            ["doc_id", "start", "doc_tokens", "ids"]).to_pylist()
        pieces = [(r["doc_id"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], np.uint32)) for r in rows]
        emit = Emitter(round_, part)
        merge(pieces, emit, size, windows, last)
        return pa.Table.from_batches([emit.batch()])

    grouped = left.withColumn("grp", (F.col("part") / FAN_IN).cast("long")).groupBy("grp")
    return grouped.applyInArrow(run, PIECE_DDL)
