"""Operator 13: byte-level BPE encoding and decoding.

Pre-tokens are located without a regular expression. Each code point becomes a class; the next two
code points decide the classes of blanks and apostrophes. A class stands for a function over the
states of a small automaton ("inside letters", "a blank waits for its word", ...). Composing such
functions is associative and all compositions are few, so they are numbered and kept in a table:
prefix compositions are found by a scan, first within blocks (all blocks at once), then over the
blocks. The state before a code point and its class say whether a pre-token starts there.

The slices between starts are looked up in a cache that holds the ids of every slice met so far;
a new slice is encoded by merging pairs in the order of their ranks. Every id keeps the byte place
where it begins in its text, so that any range of ids can be decoded and found again.

Texts of more than PART characters are cut where a blank follows no blank and starts a word: a
pre-token starts there whatever stands before, so the parts are encoded one by one.

Contract: null text counts as empty and has no ids. Special strings are ordinary text. One row for
each row of the input, repeated and null doc_ids included; other columns are dropped. An empty
table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.tables import slices, worker_cache

PART = 1_000_000
BLOCK = 256

# Classes of code points. LAST_BLANK and LAST_SPACE stand right before a visible one.
LETTER, NUMBER, OTHER, LAST_BLANK, LAST_SPACE, SPACE, SHORT, LONG = range(8)
# States: what the code points before have left open.
NEW, IN_LETTERS, IN_NUMBERS, IN_OTHERS, BLANK_WAITS, IN_SPACES, ONE_MORE, TWO_MORE = range(8)
# The endings that make a contraction with an apostrophe.
SHORT_ENDINGS = "sdmt"
LONG_ENDINGS = ("ll", "ve", "re")


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a code point, and whether a pre-token starts at it."""
    if state in (ONE_MORE, TWO_MORE) and kind == LETTER:
        return (NEW if state == ONE_MORE else ONE_MORE), False
    if kind in (SHORT, LONG):
        if state not in (IN_OTHERS, BLANK_WAITS):
            return (ONE_MORE if kind == SHORT else TWO_MORE), True
        kind = OTHER
    if kind in (LETTER, NUMBER, OTHER):
        inside = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}[kind]
        return inside, state not in (inside, BLANK_WAITS)
    if kind == SPACE:
        return IN_SPACES, state != IN_SPACES
    return (BLANK_WAITS if kind == LAST_BLANK else NEW), True


def _closure() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the functions of the classes (the second half for the first code point of a text,
    which forgets the state), the table of compositions, and the state each function gives."""
    plain = [tuple(_step(s, k)[0] for s in range(8)) for k in range(8)]
    first = [(f[NEW],) * 8 for f in plain]
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(8)), *plain, *first]))}
    while True:
        found = {tuple(g[s] for s in f) for f in known for g in known} - set(known)
        if not found:
            break
        known |= {f: len(known) + i for i, f in enumerate(sorted(found))}
    table = np.array([[known[tuple(g[s] for s in f)] for g in known] for f in known], np.int16)
    return np.array([known[f] for f in plain + first]), table, np.array(list(known), np.int8)


FUNCTION, COMPOSED, STATE = _closure()
STARTS = np.array([[_step(s, k)[1] for k in range(8)] for s in range(8)])


def _members(pattern: str) -> np.ndarray:
    """The code points that match, as the library's own Unicode tables have them: an encoder whose
    pre-tokens are the runs of such code points skips all others."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    bytes_only = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)},
                                   special_tokens={})
    raw = np.array(bytes_only.encode_ordinary(every), np.uint8).tobytes()
    return np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)


def _kinds() -> np.ndarray:
    kind = np.full(0x110000, OTHER, np.uint8)
    for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        kind[_members(pattern)] = value
    return kind


def compose_prefixes(functions: np.ndarray) -> np.ndarray:
    """For each place the number of the composition of all functions up to it, itself included."""
    n = len(functions)
    rows = -(-n // BLOCK)
    grid = np.zeros(rows * BLOCK, np.int16)  # number 0 is the identity
    grid[:n] = functions
    grid = grid.reshape(rows, BLOCK)
    for j in range(1, BLOCK):
        grid[:, j] = COMPOSED[grid[:, j - 1], grid[:, j]]
    total = grid[:, -1].copy()
    reach = 1
    while reach < rows:  # the blocks' totals, doubling the reach
        total[reach:] = COMPOSED[total[:-reach], total[reach:]]
        reach *= 2
    if rows > 1:
        grid[1:] = COMPOSED[total[:-1, None], grid[1:]]
    return grid.reshape(-1)[:n]


def starts(points: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a pre-token starts. ``kind`` has the class of each code point without its
    neighbours; ``first`` marks the first code point of each text."""
    n = len(points)
    kind = kind.copy()
    inner = np.zeros(n, bool)  # the next code point belongs to the same text
    inner[:-1] = ~first[1:]
    last = np.zeros(n, bool)
    last[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE)
    last &= inner
    kind[last] = np.where(points[last] == ord(" "), LAST_BLANK, LAST_SPACE)
    quote = np.flatnonzero((points == ord("'")) & inner)
    if len(quote):
        kind[quote[np.isin(points[quote + 1], [ord(c) for c in SHORT_ENDINGS])]] = SHORT
        quote = quote[inner[quote + 1]]
        for a, b in LONG_ENDINGS:
            kind[quote[(points[quote + 1] == ord(a)) & (points[quote + 2] == ord(b))]] = LONG
    before = np.zeros(n, np.int16)
    before[1:] = compose_prefixes(FUNCTION[kind + 8 * first])[:-1]
    return STARTS[np.where(first, NEW, STATE[before, NEW]), kind]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """merge_pairs() with a heap of pairs: the time does not grow with the square of the length."""
    n = len(piece)
    stop = list(range(1, n + 1))  # where the part that begins here ends; 0: no part begins here
    back = list(range(-1, n))
    heap = [(ranks[piece[i:i + 2]], i, i + 2) for i in range(n - 1) if piece[i:i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, a, c = heapq.heappop(heap)
        b = stop[a]
        if not b or b >= n or stop[b] != c:  # one of the two has been merged since
            continue
        stop[a], stop[b] = c, 0
        if c < n:
            back[c] = a
            pair = ranks.get(piece[a:stop[c]])
            if pair is not None:
                heapq.heappush(heap, (pair, a, stop[c]))
        if a:
            pair = ranks.get(piece[back[a]:c])
            if pair is not None:
                heapq.heappush(heap, (pair, back[a], c))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:stop[at]]])
        at = stop[at]
    return out


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: of all neighbours the pair of the lowest rank is merged first, the leftmost
    one of equal ranks, until no pair has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 64:
        return _merge_long(piece, ranks)
    none, rank = len(ranks) + (1 << 32), ranks.get
    held = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [rank(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        i = pairs.index(least)
        held[i] += held.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank(held[i] + held[i + 1], none)
        if i:
            pairs[i - 1] = rank(held[i - 1] + held[i], none)
    return [ranks[h] for h in held]


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin[i], begin[i] + 1, ... of all stretches one after the other."""
    upto = np.cumsum(size)
    return np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(begin - (upto - size), size)


class ByteBpe:
    """Encodes and decodes with the ranks of a .tiktoken file. At most ``most`` slices of at most
    ``longest`` bytes are remembered."""

    def __init__(self, path: str, most: int = 400_000, longest: int = 200):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        top = max(self.ranks.values()) + 1
        pieces: list[bytes] = [b""] * top
        for token, rank in self.ranks.items():
            pieces[rank] = token
        self.size = np.fromiter(map(len, pieces), np.int64, top)
        self.place = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.kind = _kinds()
        self.most, self.longest = most, longest
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.flat, self.begin = array("I"), array("q", [0])

    def _slots(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place and number of ids of each slice, and the ids they point into."""
        if len(self.slot) > self.most:
            self._forget()
        found = list(map(self.slot.get, pieces))
        new = {p for p, s in zip(pieces, found) if s is None}
        if new:
            own = self.slot
            short = [p for p in new if len(p) <= self.longest]
            for p in short:
                own[p] = len(self.begin) - 1
                self.flat.extend(merge_pairs(p, self.ranks))
                self.begin.append(len(self.flat))
            once = {}
            for p in new.difference(short):  # not remembered: behind the kept ones, for this call
                once[p] = len(self.begin) - 1
                self.flat.extend(merge_pairs(p, self.ranks))
                self.begin.append(len(self.flat))
            found = [own[p] if p in own else once[p] for p in pieces] if once else list(map(own.__getitem__, pieces))
            flat, begin = np.array(self.flat), np.array(self.begin)
            if once:
                keep = len(self.begin) - 1 - len(once)
                del self.flat[self.begin[keep]:]
                del self.begin[keep + 1:]
        else:
            flat, begin = np.array(self.flat), np.array(self.begin)
        slot = np.array(found, np.int64)
        return begin[slot], begin[slot + 1] - begin[slot], flat

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, the number of ids of each text, and the byte of its text where each id begins."""
        joined = "".join(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        n = len(joined)
        if not n:
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64), np.empty(0, np.int64)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        first = np.zeros(n, bool)
        first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
        start = np.flatnonzero(starts(points, self.kind[points], first))
        data = joined.encode()
        if len(data) == n:
            cut = np.append(start, n)
            edge = np.cumsum(lengths)
        else:
            width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            upto = np.concatenate([[0], np.cumsum(width)])
            cut = np.append(upto[start], len(data))
            edge = upto[np.cumsum(lengths)]
        stops = cut.tolist()
        at, per, flat = self._slots([data[a:b] for a, b in zip(stops, stops[1:])])
        ids = flat[ragged(at, per)]
        ends = np.cumsum(self.size[ids])
        bounds = np.searchsorted(ends, edge, "right")  # no id reaches over the end of a text
        counts = np.diff(bounds, prepend=0)
        offsets = ends - self.size[ids] - np.repeat(np.concatenate([[0], edge[:-1]]), counts)
        return ids, counts, offsets

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes[ragged(self.place[ids], self.size[ids])].tobytes()


def parts(text: str, limit: int = PART) -> Iterator[str]:
    """Pieces of a text whose ids are those of the whole text, one after the other."""
    begin = 0
    while len(text) - begin > limit:
        at = text.find(" ", begin + limit)
        while 0 < at < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if not 0 < at < len(text) - 1:
            break
        yield text[begin:at]
        begin = at
    yield text[begin:]


def byte_bpe(path: str) -> ByteBpe:
    """One encoder for each Python worker."""
    made = worker_cache("byte_bpe")
    if path not in made:
        made[path] = ByteBpe(path)
    return made[path]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and offsets (the byte of the text where each id begins) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, PART):
                done = [coder.encode([p]) for p in parts(texts[a])] if b == a + 1 else [coder.encode(texts[a:b])]
                ids = np.concatenate([d[0] for d in done])
                base = np.cumsum([0, *(coder.size[d[0]].sum() for d in done[:-1])])
                places = np.concatenate([d[2] + at for d, at in zip(done, base)])
                counts = sum(d[1] for d in done)
                bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32))),
                     pa.ListArray.from_arrays(bounds, pa.array(places))], names=["doc_id", "ids", "offsets"])

    return _texts(docs).mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<long>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and data (the bytes that ids spell; UTF-8 where they come from whole texts)."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path)
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(1).slice(i, 1).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([coder.decode(ids)], pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: whole texts are encoded, then
    their ids are decoded, part by part, and only digests leave the worker."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows: list[tuple[int, str, str]] = []
            for a, b in slices(texts, PART):
                if b == a + 1:
                    n, own, spelt = 0, hashlib.sha256(), hashlib.sha256()
                    for part in parts(texts[a]):
                        ids, _, _ = coder.encode([part])
                        n += len(ids)
                        own.update(ids.astype("<u4").tobytes())
                        spelt.update(coder.decode(ids))
                    rows.append((n, own.hexdigest(), spelt.hexdigest()))
                    continue
                ids, counts, _ = coder.encode(texts[a:b])
                packed, data = memoryview(ids.astype("<u4").tobytes()), memoryview(coder.decode(ids))
                ends = np.concatenate([[0], np.cumsum(counts)])
                spelt_ends = np.concatenate([[0], np.cumsum(coder.size[ids])])[ends].tolist()
                ends = ends.tolist()
                for i in range(b - a):
                    rows.append((ends[i + 1] - ends[i], hashlib.sha256(packed[4 * ends[i]:4 * ends[i + 1]]).hexdigest(),
                                 hashlib.sha256(data[spelt_ends[i]:spelt_ends[i + 1]]).hexdigest()))
            n, own, spelt = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(spelt, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
