"""Pre-tokens of a word-end BPE vocabulary, found for many texts at once with numpy.

The vocabulary file states the rules: NFC, white space to blanks, lower case; then contractions
('s 't 're 've 'm 'll 'd), runs of letters, single digits and runs of anything else. Both users of
this module (the counting transducer and the id encoder) see a text as an array of code points
with one class each. Classes and lower-case forms come from the tokenizers library itself, so
both agree with it whatever its Unicode version.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
from tokenizers import Tokenizer

from tallyward.llm.tables import worker_cache
from tallyward.llm.word_hashes import stretches

LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3
TABLED = 0x3000
END_ID = 2


class Alphabet:
    """Class and lower-case form of code points, asked from the library once for each."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lower = np.arange(TABLED, dtype=np.uint32)
        self.kind = np.full(TABLED, OTHER, np.uint8)
        self.plain = np.zeros(TABLED, bool)  # one code point to one, whatever stands beside it
        for c in range(TABLED):
            ch = chr(c)
            normal = self.tokenizer.normalizer.normalize_str(ch)
            jamo = 0x1100 <= c < 0x1200
            if len(normal) == 1 and not jamo and unicodedata.category(ch)[0] != "M" \
                    and unicodedata.normalize("NFC", ch) == ch:
                self.lower[c], self.plain[c] = ord(normal), True
            self.kind[c] = self._ask(ch)
        self.rare: dict[int, int] = {}

    def _ask(self, ch: str) -> int:
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        if not split(ch):
            return SPACE
        if len(split("a" + ch)) == 1:
            return LETTER
        return DIGIT if len(split(ch + ch)) == 2 else OTHER

    def kinds(self, points: np.ndarray) -> np.ndarray:
        low = points < TABLED
        if low.all():
            return self.kind[points]
        out = np.empty(len(points), np.uint8)
        out[low] = self.kind[points[low]]
        found, at = np.unique(points[~low], return_inverse=True)
        for c in found.tolist():
            if c not in self.rare:
                if len(self.rare) > 200_000:
                    self.rare.clear()
                self.rare[c] = self._ask(chr(c))
        out[~low] = np.array([self.rare[c] for c in found.tolist()], np.uint8)[at]
        return out

    def special(self, text: str) -> bool:
        return "<|" in text and any(s in text for s in self.specials)

    def points(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the normalised texts, one after the other, and the length of each.
        No text may hold a special token."""
        joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        if len(joined) == 0 or joined.max() < TABLED and self.plain[joined].all():
            return self.lower[joined], lengths
        normalize = self.tokenizer.normalizer.normalize_str
        ends = np.cumsum(lengths)
        parts = []
        for i, text in enumerate(texts):
            own = joined[ends[i] - lengths[i]:ends[i]]
            if len(own) == 0 or own.max() < TABLED and self.plain[own].all():
                parts.append(self.lower[own])
            else:
                parts.append(np.frombuffer(normalize(text).encode("utf-32-le"), np.uint32))
            lengths[i] = len(parts[-1])
        return np.concatenate(parts), lengths


def word_starts(points: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a pre-token starts. ``first`` marks the first code point of each text."""
    n = len(points)
    start = np.ones(n, bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    start |= first
    start &= kind != SPACE
    quote = np.flatnonzero((points == ord("'")) & start)
    if len(quote):
        # The padding stands for the end; a contraction does not reach into the next text.
        near = np.concatenate([points, np.zeros(2, points.dtype)])
        edge = np.concatenate([first, np.ones(2, bool)])
        one, two = near[quote + 1], near[quote + 2]
        inside = ~edge[quote + 1]
        short = inside & np.isin(one, [ord(c) for c in "stmd"])
        long = inside & ~edge[quote + 2] & (
            (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        for hit, size in ((short, 2), (long, 3)):
            at = quote[hit]
            start[at + 1] = False
            after = at + size
            after = after[after < n]
            start[after[kind[after] == LETTER]] = True
    return start


class WordIds:
    """Token ids of whole texts: each distinct pre-token is encoded once by the tokenizers library
    and found again by its 64-bit hash (about 1e-7 for any two of a million to meet by chance; blocks of
    code points are mixed with their places, so no shape of text makes hashes meet). At
    most ``most`` pre-tokens are remembered; texts with special tokens or characters that need full
    normalisation are left to the library as they are."""

    def __init__(self, path: str, most: int = 800_000):
        self.alphabet = Alphabet(path)
        vocabulary = self.alphabet.tokenizer.get_vocab()
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)
        self.final[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.most = most
        self._forget()

    def _forget(self) -> None:
        """Slot i holds the ids flat[begin[i]:begin[i + 1]]; keys are sorted, slots go with them."""
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.flat, self.begin = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens. Blanks keep them apart in one call of the library, and the last id of
        each is one that ends a word, so that the ids can be told apart again."""
        texts = [" ".join(words[i:i + 500]) for i in range(0, len(words), 500)]
        found = self.alphabet.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in found])
        upto = np.flatnonzero(self.final[ids]) + 1
        if len(upto) != len(words):
            raise ValueError("a pre-token did not come back as one")
        return ids, upto

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        ids, upto = self._ids(words)
        new = len(self.begin) - 1 + np.arange(len(words))
        self.begin = np.concatenate([self.begin, len(self.flat) + upto])
        self.flat = np.concatenate([self.flat, ids])
        keys, slots = np.concatenate([self.keys, keys]), np.concatenate([self.slots, new])
        order = np.argsort(keys, kind="stable")
        self.keys, self.slots = keys[order], slots[order]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """-1 for a key not seen yet."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slots[at], -1)

    def encode(self, texts: list[str], end: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text.

        An empty text has no ids. ``end`` adds END_ID to every text."""
        if len(self.keys) > self.most:
            self._forget()
        alone: dict[int, np.ndarray] = {}
        tok = self.alphabet.tokenizer
        plain = []
        for i, text in enumerate(texts):
            if not text.isascii() and not self._quick(text) or self.alphabet.special(text):
                alone[i] = np.array(tok.encode(text, add_special_tokens=False).ids, np.uint32)
                text = ""
            plain.append(text)
        ids, counts = self._encode(plain)
        if not alone and not end:
            return ids, counts
        ends = np.cumsum(counts)
        if alone:
            parts, last = [], 0
            for i, own in alone.items():
                parts += [ids[last:ends[i]], own]
                last = ends[i]
                counts[i] = len(own)
            ids = np.concatenate([*parts, ids[last:]])
            ends = np.cumsum(counts)
        if end:
            ids = np.insert(ids, ends, END_ID)
            counts = counts + 1
        return ids, counts

    def _quick(self, text: str) -> bool:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return bool(points.max() < TABLED and self.alphabet.plain[points].all())

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points, lengths = self.alphabet.points(texts)
        n = len(points)
        if n == 0:
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        kind = self.alphabet.kind[points]
        text_begin = np.cumsum(lengths) - lengths
        first = np.zeros(n + 1, bool)
        first[text_begin] = True
        first = first[:n]
        start = word_starts(points, kind, first)
        begin = np.flatnonzero(start)
        # A pre-token ends where the next one starts or at the first blank after it.
        stop = np.ones(n + 1, bool)
        stop[:n] = start | (kind == SPACE)
        stops = np.flatnonzero(stop)
        finish = stops[np.searchsorted(stops, begin, "right")] if len(begin) else begin
        size = finish - begin
        key = stretches(points.view(np.uint8), 4 * begin, 4 * size)
        keys, at, back = np.unique(key, return_index=True, return_inverse=True)
        slots = self._slots(keys)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            where = at[missing]
            words = [text[b:f] for text in (points.tobytes().decode("utf-32-le"),)
                     for b, f in zip(begin[where].tolist(), finish[where].tolist())]
            self._learn(keys[missing], words)
            slots = self._slots(keys)
        slot = slots[back]
        from_ = self.begin[slot]
        per = self.begin[slot + 1] - from_
        total = np.cumsum(per)
        m = int(total[-1]) if len(total) else 0
        step = np.arange(m, dtype=np.int64) + np.repeat(from_ - (total - per), per)
        ids = self.flat[step]
        upto = np.concatenate([[0], total])
        word_of_text = np.searchsorted(begin, np.concatenate([text_begin, [n]]))
        counts = upto[word_of_text[1:]] - upto[word_of_text[:-1]]
        return ids, counts


def word_ids(path: str) -> WordIds:
    """One encoder for each Python worker."""
    made = worker_cache("word_ids")
    if path not in made:
        made[path] = WordIds(path)
    return made[path]
