"""Operator 11: alignment of two tokenizers over the same texts.

Every text is tokenised whole by both (A byte-level with a blank put before it, B with pieces that
mark blanks). Both spell the same bytes, which is verified, so places in the text are byte offsets.
A shared end of tokens is an anchor where a space-marked token follows on both sides, or nothing.
Anchors cut a document into windows: some ids of A and the ids of B that spell the same bytes. A
window's alignment follows from its ids alone, so it is worked out once and remembered by them:
the groups between shared ends, and the pairs of tokens whose bytes overlap.

How many documents hold a pair is counted over the whole corpus without one row for each pair and
document. A task numbers the pairs it meets; these numberings (blocks) end after BLOCK_CHARS
characters. A document keeps the numbers of its pairs, a block its pairs and in how many of its
documents they are. Blocks' counts are summed up, each block asks for the totals of its own pairs,
and meets its documents again in the order answers first, documents then, streamed: a task holds
the answers of one block.

Contract: a text that is null, empty, or not spelt by both tokenizers has no tokens: zeros and an
empty groups_sha256. Each row is a document of its own, repeated and null doc_ids included. Other
columns are dropped. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm.byte_bpe import parts, ragged
from tallyward.llm.tables import slices, stored, worker_cache

PART = 1_000_000
BLOCK_CHARS = 32_000_000
SHIFT = 32  # a pair is (id of A) * 2 ** SHIFT + (id of B)
MARK = "▁"
BLANK_STRETCH = re.compile(r"\s{1000}")
OF_B = np.uint32(1 << 31)  # tells ids of B from those of A in a window's key


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: visible Latin-1 characters
    for themselves, all others for code points from 256 on, in ascending order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Spelling:
    """The bytes of every id of a vocabulary."""

    def __init__(self, pieces: list[bytes]):
        self.size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.place = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.spaced = np.fromiter((p[:1] == b" " for p in pieces), bool, len(pieces))
        self.sizes = self.size.tolist()
        self.names = list(map(str, range(len(pieces))))

    def spell(self, ids: np.ndarray) -> bytes:
        return self.bytes[ragged(self.place[ids], self.size[ids])].tobytes()


def align(a: list[int], b: list[int], of_a: Spelling, of_b: Spelling) -> tuple[bytes, int, list[int]]:
    """One window: its groups as text, how many they are, and its linked pairs."""
    size_a, size_b, name_a, name_b = of_a.sizes, of_b.sizes, of_a.names, of_b.names
    i = j = 0
    end_a, end_b = size_a[a[0]], size_b[b[0]]
    left, right = name_a[a[0]], name_b[b[0]]  # the open group
    groups, pairs = [], [a[0] << SHIFT | b[0]]
    while True:
        if end_a == end_b:
            groups.append(f"{left}|{right}")
            i, j = i + 1, j + 1
            if i == len(a):
                return ";".join(groups).encode(), len(groups), pairs
            end_a += size_a[a[i]]
            end_b += size_b[b[j]]
            left, right = name_a[a[i]], name_b[b[j]]
        elif end_a < end_b:
            i += 1
            end_a += size_a[a[i]]
            left += "," + name_a[a[i]]
        else:
            j += 1
            end_b += size_b[b[j]]
            right += "," + name_b[b[j]]
        pairs.append(a[i] << SHIFT | b[j])


class Windows:
    """Alignments by id tuples; at most ``most`` windows of at most ``longest`` ids are remembered."""

    def __init__(self, a: Spelling, b: Spelling, most: int = 400_000, longest: int = 64):
        self.a, self.b, self.most, self.longest = a, b, most, longest
        self.forget()

    def forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.text: list[bytes] = []
        self.groups, self.pairs, self.begin = array("q"), array("q"), array("q", [0])

    def _add(self, key: bytes, n_a: int) -> int:
        ids = (np.frombuffer(key, np.uint32) & ~OF_B).tolist()
        text, groups, pairs = align(ids[:n_a], ids[n_a:], self.a, self.b)
        self.text.append(text)
        self.groups.append(groups)
        self.pairs.extend(pairs)
        self.begin.append(len(self.pairs))
        return len(self.text) - 1

    def find(self, keys: list[bytes], n_a: list[int]) -> tuple[list[int], int]:
        """Slots of windows, and how many slots were there before this call's long windows."""
        if len(self.slot) > self.most:
            self.forget()
        own, found, late = self.slot, [], []
        for key, n in zip(keys, n_a):
            slot = own.get(key)
            if slot is None:
                if len(key) > 4 * self.longest:
                    late.append((len(found), key, n))
                    slot = -1
                else:
                    slot = own[key] = self._add(key, n)
            found.append(slot)
        kept = len(self.text)
        for at, key, n in late:
            found[at] = self._add(key, n)
        return found, kept

    def drop(self, kept: int) -> None:
        """Forgets the slots from ``kept`` on."""
        del self.pairs[self.begin[kept]:]
        del self.text[kept:], self.groups[kept:], self.begin[kept + 1:]


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.library = tok = Tokenizer.from_file(path_a)
        tok.encode_special_tokens = True
        alphabet = byte_alphabet()
        pieces = [b""] * tok.get_vocab_size()
        for token, i in tok.get_vocab().items():
            pieces[i] = bytes(alphabet[c] for c in token)
        self.a = Spelling(pieces)
        # The file's ids ascend as its merges do, so they serve as ranks: tiktoken then gives the same
        # ids as the file's own library (a test compares both) in less than half the time. Very long
        # blank stretches exceed its stack; texts with such go to the library.
        special = set(tok.get_added_tokens_decoder())
        self.tok = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
            piece: i for i, piece in enumerate(pieces) if i not in special})
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.b = Spelling([bytes([int(n[3:5], 16)]) if self.sp.is_byte(i) else n.replace(MARK, " ").encode()
                           for i, n in enumerate(names)])
        # No piece goes on over a blank: then a text may be cut before one.
        self.cuts = not any(MARK in n.lstrip(MARK) for n in names)
        self.windows = Windows(self.a, self.b)

    def _tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and B and their number for each text."""
        own = [list(parts(" " + t, PART)) if self.cuts else [" " + t] for t in texts]
        flat = [p for ps in own for p in ps]
        a = [self.library.encode(p, add_special_tokens=False).ids if BLANK_STRETCH.search(p) else self.tok.encode_ordinary(p)
             for p in flat]
        b = self.sp.encode([p[1:] for p in flat], num_threads=1)

        def one(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            text = np.repeat(np.arange(len(own)), [len(p) for p in own])
            return (np.fromiter(chain.from_iterable(lists), np.uint32, int(n.sum())),
                    np.bincount(text, n, len(own)).astype(np.int64))

        return *one(a), *one(b)

    def verified(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """_tokens() without those of texts that the ids do not spell."""
        a, n_a, b, n_b = self._tokens(texts)
        data = [(" " + t).encode() for t in texts]
        length = np.fromiter(map(len, data), np.int64, len(data))
        good = np.fromiter(map(bool, texts), bool, len(texts))
        for ids, n, spelling in ((a, n_a, self.a), (b, n_b, self.b)):
            upto = np.concatenate([[0], np.cumsum(spelling.size[ids])])
            ends = np.concatenate([[0], np.cumsum(n)])
            good &= upto[ends[1:]] - upto[ends[:-1]] == length
            spelt = memoryview(spelling.spell(ids))
            at = upto[ends].tolist()
            for i in np.flatnonzero(good).tolist():
                good[i] = spelt[at[i]:at[i + 1]] == data[i]
        return a[np.repeat(good, n_a)], np.where(good, n_a, 0), b[np.repeat(good, n_b)], np.where(good, n_b, 0)

    def align(self, texts: list[str]) -> tuple:
        """n_a, n_b, n_groups, n_links and groups_sha256 of each text, and all links: text and pair."""
        a, n_a, b, n_b = self.verified(texts)
        if not len(a):
            zero = np.zeros(len(texts), np.int64)
            return zero, zero, zero, zero, [""] * len(texts), zero[:0], zero[:0]
        end_a, end_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        shared, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        last = np.isin(at_a + 1, np.cumsum(n_a))
        next_a, next_b = np.minimum(at_a + 1, len(a) - 1), np.minimum(at_b + 1, len(b) - 1)
        anchor = last | (self.a.spaced[a[next_a]] & self.b.spaced[b[next_b]])
        stop_a, stop_b = at_a[anchor] + 1, at_b[anchor] + 1
        from_a, from_b = np.concatenate([[0], stop_a[:-1]]), np.concatenate([[0], stop_b[:-1]])
        in_a, in_b = stop_a - from_a, stop_b - from_b
        both = np.empty(len(a) + len(b), np.uint32)  # a window's ids of A, then those of B
        both[np.arange(len(a)) + np.repeat(from_b, in_a)] = a
        both[np.arange(len(b)) + np.repeat(stop_a, in_b)] = b | OF_B
        raw, cut = both.tobytes(), (4 * np.concatenate([[0], stop_a + stop_b])).tolist()
        memo = self.windows
        found, kept = memo.find([raw[i:j] for i, j in zip(cut, cut[1:])], in_a.tolist())
        slot = np.array(found)
        groups, begin = np.array(memo.groups), np.array(memo.begin)
        size = begin[slot + 1] - begin[slot]
        pairs = np.array(memo.pairs)[ragged(begin[slot], size)]
        document = np.searchsorted(np.cumsum(n_a), from_a, "right")
        bounds = np.searchsorted(document, np.arange(len(texts) + 1)).tolist()
        digests = [hashlib.sha256(b";".join([memo.text[s] for s in found[x:y]])).hexdigest() if y > x else ""
                   for x, y in zip(bounds, bounds[1:])]
        memo.drop(kept)

        def sums(values: np.ndarray) -> np.ndarray:
            return np.bincount(document, values, len(texts)).astype(np.int64)

        return n_a, n_b, sums(groups[slot]), sums(size), digests, np.repeat(document, size), pairs


class Numbering:
    """Numbers of the pairs of a block, in the order in which they were met."""

    def __init__(self) -> None:
        self.known = np.empty(0, np.int64)  # sorted pairs
        self.number = np.empty(0, np.int64)
        self.documents = np.empty(0, np.int64)  # by number

    def add(self, pairs: np.ndarray) -> np.ndarray:
        found, back = np.unique(pairs, return_inverse=True)
        at = np.searchsorted(self.known, found)
        there = np.zeros(len(found), bool)
        if len(self.known):
            there = self.known[np.minimum(at, len(self.known) - 1)] == found
        number = np.empty(len(found), np.int64)
        number[there] = self.number[at[there]]
        new = np.flatnonzero(~there)
        number[new] = len(self.documents) + np.arange(len(new))
        self.known = np.insert(self.known, at[new], found[new])
        self.number = np.insert(self.number, at[new], number[new])
        self.documents = np.concatenate([self.documents, np.zeros(len(new), np.int64)])
        return number[back]

    def by_number(self) -> np.ndarray:
        return self.known[np.argsort(self.number)]


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for each Python worker."""
    made = worker_cache("aligner")
    if (path_a, path_b) not in made:
        made[path_a, path_b] = Aligner(path_a, path_b)
    return made[path_a, path_b]


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Stored rows of two kinds. Documents: block, doc_id, figures, groups_sha256, numbers and times
    (4-byte numbers of the distinct pairs, and how often each occurs). Pairs: block, number, pair and
    documents, where pair is not null."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"block long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "numbers binary, times binary, number long, pair long, documents long")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, part = aligner(path_a, path_b), TaskContext.get().partitionId()
        block, held, numbering = 0, 0, Numbering()
        types: dict[str, pa.DataType] = {}

        def rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
            columns["block"] = pa.array(np.full(n, part << 24 | block), pa.int64())
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, types[c])) for c in names], names=names)

        def finished() -> Iterator[pa.RecordBatch]:
            pairs = numbering.by_number()
            for a in range(0, len(pairs), 1 << 16):
                some = pairs[a:a + (1 << 16)]
                yield rows(len(some), number=pa.array(np.arange(a, a + len(some))), pair=pa.array(some),
                           documents=pa.array(numbering.documents[a:a + (1 << 16)]))

        for batch in batches:
            if not types:
                types = dict.fromkeys(names, pa.int64()) | {
                    "doc_id": batch.schema.field(0).type, "groups_sha256": pa.string(),
                    "numbers": pa.binary(), "times": pa.binary()}
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, PART):
                *figures, digests, document, pairs = worker.align(texts[a:b])
                number = numbering.add(pairs)
                base = len(numbering.documents) + 1
                distinct, times = np.unique(document * base + number, return_counts=True)
                number = distinct % base
                numbering.documents += np.bincount(number, minlength=len(numbering.documents))
                cut = (4 * np.searchsorted(distinct // base, np.arange(b - a + 1))).tolist()
                raw, often = number.astype("<u4").tobytes(), times.astype("<u4").tobytes()
                yield rows(b - a, doc_id=batch.column(0).slice(a, b - a), **{
                    c: pa.array(f, pa.int64()) for c, f in zip(FIGURES, figures)},
                    groups_sha256=pa.array(digests, pa.string()),
                    numbers=pa.array([raw[x:y] for x, y in zip(cut, cut[1:])], pa.binary()),
                    times=pa.array([often[x:y] for x, y in zip(cut, cut[1:])], pa.binary()))
                held += sum(map(len, texts[a:b]))
                if held >= block_chars:
                    yield from finished()
                    block, held, numbering = block + 1, 0, Numbering()
        if types:
            yield from finished()

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return stored(texts.mapInArrow(run, schema), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, count (documents that hold it) and best (no pair of its id of A has more). An id of A
    has at most as many pairs as B has ids."""
    totals = blocks.filter("pair is not null").groupBy("pair").agg(F.sum("documents").alias("count"))
    same = Window.partitionBy(F.shiftright("pair", SHIFT))
    return totals.select("pair", "count", (F.col("count") == F.max("count").over(same)).alias("best"))


def alignments(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = aligned_blocks(docs, path_a, path_b, block_chars)
    counts = stored(pair_counts(blocks), "pair-counts")
    asked = blocks.filter("pair is not null").select("block", "number", "pair")
    answers = asked.join(counts, "pair").select("block", "number", "count", "best")
    documents = blocks.filter("pair is null").drop("number", "pair", "documents")
    both = documents.unionByName(answers, allowMissingColumns=True).repartition("block").sortWithinPartitions(
        "block", F.col("number").isNull(), "number").select(
        "block", "number", "count", "best", "doc_id", *FIGURES, "groups_sha256", "numbers", "times")
    names = ["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held_count, held_best = None, [], []
        for batch in batches:
            ids = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                some = batch.slice(a, b - a)
                if ids[a] != block:
                    block, held_count, held_best = ids[a], [], []
                n = b - a - some.column(1).null_count  # answers stand first
                if n:
                    held_count.append(some.column(2).slice(0, n).to_numpy())
                    held_best.append(some.column(3).slice(0, n).to_numpy(zero_copy_only=False))
                rest = some.slice(n)
                if not rest.num_rows:
                    continue
                if len(held_count) > 1:
                    held_count, held_best = [np.concatenate(held_count)], [np.concatenate(held_best)]
                count, best = (held_count[0], held_best[0]) if held_count else (np.empty(0, np.int64), np.empty(0, bool))
                n_best, count_sum = [], []
                for own, often in zip(rest.column(10).to_pylist(), rest.column(11).to_pylist()):
                    own, often = np.frombuffer(own, "<u4"), np.frombuffer(often, "<u4").astype(np.int64)
                    n_best.append(int(often[best[own].astype(bool)].sum()))
                    count_sum.append(int((often * count[own]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [rest.column(4), *(rest.column(i) for i in range(5, 9)), pa.array(n_best, pa.int64()),
                     pa.array(count_sum, pa.int64()), rest.column(9)], names=names)

    return both.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
                                "n_best long, count_sum long, groups_sha256 string")
