"""Operator 10: token ids as directly addressable codes in files.

A file holds the ids of neighbouring documents. Every id is split into chunks of fixed bit widths.
Level 0 has the lowest chunk of each id and a bitmap that says which ids go on; level 1 has the
next chunk of those, and so on. A rank directory counts a bitmap's ones before each block of
BLOCK bits, so the place of an id's next chunk is one look-up and a count within one block: any
token is reached without decoding others.

Layout (little-endian): b"DAC1", uint32 length of the header, the header (JSON: documents, ids,
widths, and place and bytes of each array), then the arrays: doc_id int64, known uint8 (0: null
doc_id), first int64 (documents + 1), and for each level chunks (packed bits, lowest bit first),
more (bitmap) and rank (uint32).

Documents are range-partitioned and sorted by doc_id (equal ids by text), each task writes its
files under another name and renames them, so a task that is run again replaces what it wrote.
Files go through pyarrow's file systems (file, hdfs, s3, gs) to the shared folder.

Contract: null text counts as empty; a null doc_id sorts first and comes back as null; repeated
rows are kept; an empty table has no files and no rows.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.pretokens import word_ids
from tallyward.llm.tables import new_path, slices, stored

WIDTHS = (12, 4, 16)
BLOCK = 512
FILE_IDS = 1 << 20
MAGIC = b"DAC1"


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little")


def _unpack(data: np.ndarray, width: int, n: int) -> np.ndarray:
    bits = np.unpackbits(data, count=n * width, bitorder="little").reshape(n, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def encode(doc_ids: list, counts: np.ndarray, ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """The bytes of one file."""
    arrays = {
        "doc_id": np.array([d or 0 for d in doc_ids], np.int64),
        "known": np.array([d is not None for d in doc_ids], np.uint8),
        "first": np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)}
    rest = ids.astype(np.uint32)
    for level, width in enumerate(widths):
        arrays[f"chunks{level}"] = _pack(rest & np.uint32((1 << width) - 1), width)
        rest = rest >> np.uint32(width)
        more = rest > 0
        arrays[f"more{level}"] = np.packbits(more.view(np.uint8), bitorder="little")
        ones = np.concatenate([[0], np.cumsum(more, dtype=np.uint32)])
        arrays[f"rank{level}"] = ones[:-1][::BLOCK].astype(np.uint32)
        rest = rest[more]
    if len(rest):
        raise ValueError("an id is wider than all levels together")
    places, at = {}, 0
    for name, array in arrays.items():
        places[name] = [at, array.nbytes]
        at += array.nbytes
    header = json.dumps({"documents": len(doc_ids), "ids": len(ids), "widths": widths, "arrays": places}).encode()
    return b"".join([MAGIC, np.uint32(len(header)).tobytes(), header, *(a.tobytes() for a in arrays.values())])


class Codes:
    """A file's content: single tokens by place, documents, or everything."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n = int(np.frombuffer(data, np.uint32, 1, 4)[0])
        head = json.loads(data[8:8 + n])
        self.ids, self.widths = head["ids"], head["widths"]

        def array(name: str, kind=np.uint8) -> np.ndarray:
            at, size = head["arrays"][name]
            return np.frombuffer(data, kind, size // np.dtype(kind).itemsize, 8 + n + at)

        known = array("known")
        self.doc_id = [d if k else None for d, k in zip(array("doc_id", np.int64).tolist(), known.tolist())]
        self.first = array("first", np.int64)
        levels = range(len(self.widths))
        self.chunks = [array(f"chunks{i}") for i in levels]
        self.more = [array(f"more{i}") for i in levels]
        self.rank = [array(f"rank{i}", np.uint32) for i in levels]

    def __len__(self) -> int:
        return self.ids

    def __getitem__(self, place: int) -> int:
        """The id at a place, from one chunk of each of its levels."""
        if not 0 <= place < self.ids:
            raise IndexError(place)
        value = shift = 0
        for width, chunks, more, rank in zip(self.widths, self.chunks, self.more, self.rank):
            first, last = place * width, place * width + width
            own = int.from_bytes(chunks[first // 8:(last + 7) // 8].tobytes(), "little")
            value |= (own >> first % 8 & (1 << width) - 1) << shift
            if not more[place // 8] >> place % 8 & 1:
                break
            block = place // BLOCK
            before = int.from_bytes(more[block * BLOCK // 8:place // 8 + 1].tobytes(), "little")
            place = int(rank[block]) + (before & (1 << place - block * BLOCK) - 1).bit_count()
            shift += width
        return value

    def all(self) -> np.ndarray:
        """Every id in order."""
        out = np.zeros(self.ids, np.uint32)
        at, shift = np.arange(self.ids), 0
        for width, chunks, more in zip(self.widths, self.chunks, self.more):
            if not len(at):
                break
            out[at] |= _unpack(chunks, width, len(at)) << np.uint32(shift)
            at = at[np.unpackbits(more, count=len(at), bitorder="little").astype(bool)]
            shift += width
        return out


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def write(docs: DataFrame, path: str, folder: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files to ``folder``; a stored row for each: file, part, number, documents, ids."""
    ordered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions(
        "doc_id", "tie", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_ids(path), TaskContext.get().partitionId()
        store, base = _place(folder)
        number, keys, counts, parts, held = 0, [], [], [], 0
        made: list[tuple] = []

        def flush() -> None:
            nonlocal number, keys, counts, parts, held
            if not keys:
                return
            name = f"part-{part:07d}-{number:07d}.dac"
            data = encode(keys, np.concatenate(counts), np.concatenate(parts))
            store.create_dir(base, recursive=True)
            trial = f"{base}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(trial) as out:
                out.write(data)
            store.move(trial, f"{base}/{name}")
            made.append((name, part, number, len(keys), held))
            number, keys, counts, parts, held = number + 1, [], [], [], 0

        for batch in batches:
            own, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                ids, n = encoder.encode(texts[a:b], end=True)
                keys += own[a:b]
                counts.append(n)
                parts.append(ids)
                held += len(ids)
                if held >= file_ids:
                    flush()
        flush()
        names = ["file", "part", "number", "documents", "ids"]
        kinds = [pa.string(), *[pa.int64()] * 4]
        columns = list(zip(*made)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return stored(ordered.mapInArrow(run, "file string, part long, number long, documents long, ids long"), "codes")


READ_TASKS = 4096


def read(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files' content.

    The running total goes over parts first (one row for each write task), then within a part. There are
    as many tasks as files, READ_TASKS at most: with a number of its own the deal is not folded together,
    however small the table of file names is."""
    tasks = min(READ_TASKS, max(1, files.count()))
    parts = files.groupBy("part").agg(F.sum("ids").alias("all"))
    before = parts.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("before"))
    own = Window.partitionBy("part").orderBy("number")
    placed = files.join(before, "part").select(
        "file", (F.col("before") + F.sum("ids").over(own) - F.col("ids")).alias("base")).repartition(tasks, "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _place(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_stream(f"{top}/{name}") as f:
                    codes = Codes(f.read())
                ids, first = codes.all(), codes.first.tolist()
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes.doc_id, pa.int64()), pa.array(codes.first[:-1] + base),
                     pa.array(np.diff(codes.first)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    folder = new_path(docs.sparkSession, "codes-files")
    return read(write(docs, path, folder), folder)
