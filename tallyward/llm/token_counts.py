"""Operator 1: token counts by a finite-state transducer.

The vocabulary's merges are compiled to a deterministic transducer over bytes. A state is what a
pre-token read so far can still do: its kind (letters, digit, other, a quote that may open a
contraction) and, for every suffix of it that some longer vocabulary entry begins with, the entry
that ends before this suffix. A transition carries the change of the token count. States and
transitions are made when a text first needs them and kept in one table of bounded size.

Why this is exact: a sequence of entries is the BPE result of a pre-token if and only if every
two neighbours are the BPE result of their own text, that is, if no merge across their border comes
before the merges that use up its two sides. So the last entry after one more byte is the
longest entry whose join with the entry before it holds; only the suffixes in the state matter.

Texts are cut into chunks. White space leads every state to the same one, so a chunk that holds
white space maps all states to one state; composed over the chunks of a text by a running maximum
(the prefix scan: the latest constant map wins), these maps give every chunk its first state. All
chunks then advance together, one byte a step, as numpy gathers.

Contract: null counts as an empty text (0 bytes, 0 tokens). Special tokens within a text count
one, as the library has it. Rows are kept as they are, repeated ones too; other columns are
passed on when asked for.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.pretokens import DIGIT, LETTER, OTHER, SPACE, Alphabet
from tallyward.llm.tables import slices, worker_cache

CHUNK = 256
OFFSET = 64  # a transition is stored as next state * 128 + change of the count + 64


class Merges:
    """Plain BPE on short byte strings, and whether two entries are neighbours in a result."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte = _bytes_of_characters()
        end = model["end_of_word_suffix"]

        def entry(text: str) -> tuple[bytes, bool]:
            last = text.endswith(end) and text != end
            return bytes(byte[c] for c in (text[:-len(end)] if last else text)), last

        self.rank, self.made, after = {}, {}, {}
        for rank, (a, b) in enumerate(model["merges"]):
            a, b = entry(a), entry(b)
            self.rank[a, b] = rank
            self.made[a[0] + b[0], b[1]] = a, b, rank
            after.setdefault(a, []).append((b, rank))
        self.after = {a: sorted(found) for a, found in after.items()}
        self.inner, self.last = set(), set()
        for text in model["vocab"]:
            own, last = entry(text)
            (self.last if last else self.inner).add(own)
        self.open = {own[:i] for own in self.inner | self.last for i in range(len(own))}
        self.pairs: dict = {}
        self.edges: dict = {}
        self.classes: dict = {}

    def _edge(self, entry: tuple[bytes, bool], right: bool) -> list[tuple]:
        """The parts of an entry on one side, outermost first, each with the rank of the merge that
        uses it up."""
        if (found := self.edges.get((entry, right))) is None:
            found, part, used = [], entry, 1 << 30
            while True:
                found.append((part, used))
                if part not in self.made:
                    break
                a, b, used = self.made[part]
                part = b if right else a
            self.edges[entry, right] = found
        return found

    def neighbours(self, a: bytes, b: bytes, last: bool) -> bool:
        """True if a, b is the result for their join: no merge across the border comes first."""
        key = a, b, last
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            left, right = self._edge((a, False), True), self._edge((b, last), False)
            rank = self.rank.get
            known = self.pairs[key] = not any(
                (r := rank((p, q))) is not None and r < used and r <= gone
                for p, used in left for q, gone in right)
        return known

    def kind_of(self, a: bytes, text: bytes) -> frozenset:
        """What matters of an entry before one that begins with ``text``: the merges that may take
        place across the border. Entries with the same set are alike there."""
        if (known := self.classes.get((a, text))) is None:
            if len(self.classes) > 1_000_000:
                self.classes.clear()
            found = []
            for p, used in self._edge((a, False), True):
                after = self.after.get(p, [])
                i = bisect_left(after, ((text, False), -1))
                while i < len(after) and after[i][0][0].startswith(text):
                    if after[i][1] < used:
                        found.append(after[i])
                    i += 1
                for n in range(1, len(text)):
                    q = text[:n], False
                    if (r := self.rank.get((p, q))) is not None and r < used:
                        found.append((q, r))
            known = self.classes[a, text] = frozenset(found)
        return known

    def encode(self, text: bytes, last: bool) -> list[tuple[bytes, bool]]:
        parts = [(text[i:i + 1], last and i == len(text) - 1) for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            rank = self.rank.get((parts[best], parts[best + 1]))
            if rank is None:
                break
            parts[best:best + 2] = [(parts[best][0] + parts[best + 1][0], parts[best + 1][1])]
        return parts


def _bytes_of_characters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


# State kinds. IDLE: no open pre-token. QUOTE: a quote that starts a pre-token. R, L: a quote and
# the first letter of 're, 've or 'll, which may still be a quote and a word.
IDLE, QUOTE, R, L = "idle", "quote", "re", "ll"
START = ((b"", None, 0),)


class Transducer:
    """The compiled tokenizer; ``cells`` bounds its table, which starts anew when it is full."""

    def __init__(self, path: str, cells: int = 24_000_000):
        self.alphabet, self.merges, self.cells = Alphabet(path), Merges(path), cells
        self._reset()

    def _reset(self) -> None:
        self.column = np.full(640, -1, np.int64)  # of a symbol
        self.symbols: list[int] = []
        self.width, self.height = 128, 4096
        self.table = np.full((self.height, self.width), -1, np.int32)
        self.closing = np.zeros(self.height, np.int64)  # count still to come when the text ends here
        self.states: list[tuple] = []
        self.number: dict = {}
        self._state((IDLE, None, b""))

    def _state(self, state: tuple) -> int:
        kind, chain, byte = state
        if chain:  # entries that no vocabulary entry goes on from are of no use
            m = self.merges
            chain = tuple(x for x in chain if (t := x[0] + byte) in m.open or t in m.inner or t in m.last)
            state = kind, chain, byte
            key = kind, tuple((s, n, b and m.kind_of(b, s + byte)) for s, b, n in chain), byte
        else:
            key = state
        if (i := self.number.get(key)) is None:
            i = self.number[key] = len(self.states)
            self.states.append(state)
            if i == self.height:
                self.height *= 2
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.closing = np.concatenate([self.closing, np.zeros_like(self.closing)])
            self.closing[i] = self._close(state)
        return i

    # ---- meaning of states: (kind, suffixes, byte not yet placed)

    def _place(self, chain: tuple, byte: bytes, last: bool) -> tuple[int, tuple]:
        """The change of the count when ``byte`` is placed behind the open pre-token."""
        known = self.merges.last if last else self.merges.inner
        for suffix, before, count in chain:
            entry = suffix + byte
            if entry in known and (before is None or self.merges.neighbours(before, entry, last)):
                change = count + 1
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        if last:
            return change, ()
        kept = tuple((s + byte, b, n - change) for s, b, n in chain if s + byte in self.merges.open)
        return change, (*kept, (b"", entry, 0))

    def _close(self, state: tuple) -> int:
        kind, chain, byte = state
        if kind == IDLE:
            return 0
        if kind in (R, L):
            return self._close((OTHER, START, b"'")) + self._close((LETTER, START, byte))
        return self._place(START if kind == QUOTE else chain, byte, True)[0]

    def _next(self, state: tuple, symbol: int) -> tuple[int, tuple]:
        """The change of the count and the next state."""
        kind, chain, byte = state
        cls, value = _meaning(symbol)
        own = bytes([value])
        if kind == QUOTE:
            if value < 128 and chr(value) in "stmd":
                return len(self.merges.encode(b"'" + own, True)), (IDLE, None, b"")
            if value < 128 and chr(value) in "rvl":
                return 0, (L if own == b"l" else R, None, own)
            kind, chain = OTHER, START
        elif kind in (R, L):
            if own == (b"l" if kind == L else b"e"):
                return len(self.merges.encode(b"'" + byte + own, True)), (IDLE, None, b"")
            count, after = self._next((LETTER, START, byte), symbol)
            return count + self._close((OTHER, START, b"'")), after
        follows = 0x80 <= value < 0xC0
        if kind == cls and (cls != DIGIT or follows):
            count, chain = self._place(chain, byte, False)
            return count, (kind, chain, own)
        count = self._close((kind, chain, byte))
        if cls == SPACE:
            return count, (IDLE, None, b"")
        return count, (QUOTE, None, own) if own == b"'" else (cls, START, own)

    # ---- the table

    def _learn(self, states: np.ndarray, columns: np.ndarray) -> None:
        for cell in set((states * self.width + columns).tolist()):
            i, j = divmod(cell, self.width)
            count, after = self._next(self.states[i], self.symbols[j])
            to = self._state(after)
            self.table[i, j] = to * 2 * OFFSET + count + OFFSET

    def _columns(self, symbols: np.ndarray) -> np.ndarray:
        columns = self.column[symbols]
        if (columns < 0).any():
            for s in np.unique(symbols[columns < 0]).tolist():
                self.column[s] = len(self.symbols)
                self.symbols.append(s)
            if len(self.symbols) > self.width:
                wide = np.full((self.height, max(2 * self.width, len(self.symbols))), -1, np.int32)
                wide[:, :self.width] = self.table
                self.table, self.width = wide, wide.shape[1]
            columns = self.column[symbols]
        return columns

    def _run(self, columns: np.ndarray, begin: np.ndarray, size: np.ndarray, state: np.ndarray):
        """Lanes advance together: last state and sum of changes of each."""
        order = np.argsort(-size, kind="stable")
        at, size, state = begin[order], size[order], state[order].astype(np.int64)
        count = np.zeros(len(order), np.int64)
        live = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right") if len(size) else []
        for step, n in enumerate(live):
            column = columns[at[:n] + step]
            cell = state[:n] * self.width + column
            found = self.table.ravel()[cell]
            if found.min() < 0:
                new = found < 0
                self._learn(state[:n][new], column[new])
                found = self.table.ravel()[cell]
            state[:n] = found >> 7
            count[:n] += (found & 127) - OFFSET
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if len(self.states) * self.width > self.cells:
            self._reset()
        split = re.compile("|".join(map(re.escape, self.alphabet.specials)))
        own, extra, whose = [], np.zeros(len(texts), np.int64), []
        for i, text in enumerate(texts):
            parts = split.split(text) if self.alphabet.special(text) else [text]
            extra[i] = len(parts) - 1
            own += parts
            whose += [i] * len(parts)
        points, lengths = self.alphabet.points(own)
        total = self._count(points, lengths)
        return extra + np.bincount(whose, total, len(texts)).astype(np.int64)

    def _count(self, points: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lengths), np.int64)
        if not len(points):
            return out
        kinds = self.alphabet.kinds(points)
        wide = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        data = np.frombuffer(points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
        upto = np.concatenate([[0], np.cumsum(wide)])
        ends = np.cumsum(lengths)
        first, last = upto[ends - lengths], upto[ends]  # bytes of each text
        kind = np.repeat(kinds, wide) if len(data) > len(points) else kinds
        symbols = np.where(data < 128, data, 128 * kind.astype(np.int64) + data)
        columns = self._columns(symbols)

        # Chunks: CHUNK bytes of a text each.
        many = -(-(last - first) // CHUNK)
        text = np.repeat(np.arange(len(lengths)), many)
        place = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        begin = first[text] + place * CHUNK
        stop = np.minimum(begin + CHUNK, last[text])
        blanks = np.append(np.flatnonzero(kind == SPACE), len(data))
        blank = blanks[np.searchsorted(blanks, begin)]
        opening = place == 0
        constant = opening | (blank < stop)  # the chunk's map sends all states to one
        body = np.where(opening, begin, np.minimum(blank + 1, stop))
        state, count = self._run(columns, body, stop - body, np.zeros(len(text), np.int64))

        # Prefix scan: the latest chunk with a constant map, before each chunk.
        index = np.arange(len(text))
        latest = np.maximum.accumulate(np.where(constant, index, -1))
        # A head runs from the end of a constant chunk to the first blank of the next one with one.
        heads = np.flatnonzero(constant & ~opening)
        source = latest[heads - 1]
        ending = index[np.append(place[1:] == 0, True)]
        tails = ending[~constant[ending]]
        source = np.concatenate([source, latest[tails]])
        upto_ = np.concatenate([blank[heads] + 1, stop[tails]])
        from_ = stop[source]
        head_state, head_count = self._run(columns, from_, upto_ - from_, state[source])
        out += np.bincount(text[constant], count[constant], len(lengths)).astype(np.int64)
        out += np.bincount(text[np.concatenate([heads, tails])], head_count, len(lengths)).astype(np.int64)
        final = state.copy()
        final[tails] = head_state[len(heads):]
        out[text[ending]] += self.closing[final[ending]]
        return out


def _meaning(symbol: int) -> tuple[int, int]:
    """Class and byte of a symbol: ASCII bytes as they are, others 128 * class + byte."""
    if symbol >= 128:
        kind, value = divmod(symbol - 128, 128)
        return kind, value + 128
    ch = chr(symbol)
    if ch.isalpha():
        return LETTER, symbol
    if ch.isdigit():
        return DIGIT, symbol
    return (SPACE if ch in "\t\n\v\f\r " else OTHER), symbol


def transducer(path: str) -> Transducer:
    made = worker_cache("transducer")
    if path not in made:
        made[path] = Transducer(path)
    return made[path]


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and n_tokens (long) of every row's whole text."""
    chosen = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("__text"))
    fields = [f"`{name}` {kind}" for name, kind in chosen.dtypes if name != "__text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            counts = [machine.count(texts[a:b]) for a, b in slices(texts, 4_000_000)]
            found = np.concatenate(counts) if counts else np.empty(0, np.int64)
            arrays = [batch.column(c) for c in batch.schema.names if c != "__text"]
            names = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.int64())], names=[*names, "n_tokens"])

    return chosen.mapInArrow(run, ", ".join([*fields, "n_tokens long"]))


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row."""
    sized = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "n_bytes", F.octet_length("text").cast("long"))
    return count_tokens(sized, path, keep=("doc_id", "n_bytes")).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
