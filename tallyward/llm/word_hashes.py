"""64-bit hashes of the words of whole texts, made with numpy.

Words are runs of anything but the six ASCII blanks; A-Z are lower-cased. Two of a billion distinct
words have the same hash with a chance of about one in forty, whatever they look like: each block of
eight bytes goes through a mixing function together with its place. (A polynomial modulo a power of
two has pairs of words that meet for every base.)"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of a common public generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stretches(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of raw[begin[i]:begin[i] + size[i]], bytes. Every block of eight bytes is mixed with its
    place in the stretch, and the mixed blocks are added up; no stretch is empty."""
    if not len(begin):
        return np.empty(0, np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(raw) + 1, "<u8", buffer=padded.data, strides=(1,))  # one from every byte on
    n = -(-size // 8)
    first = np.cumsum(n) - n
    step = np.arange(int(n.sum())) - np.repeat(first, n)
    value = blocks[np.repeat(begin, n) + 8 * step]
    rest = np.repeat(size, n) - 8 * step
    short = np.flatnonzero(rest < 8)
    value[short] &= (np.uint64(1) << (8 * rest[short]).astype(np.uint64)) - np.uint64(1)
    with np.errstate(over="ignore"):
        mixed = mix(value ^ mix(step.astype(np.uint64) + np.uint64(BASE)))
        return mix(np.add.reduceat(mixed, first) + size.astype(np.uint64))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and the number of words of each text."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = _LOWER[np.frombuffer(b" ".join(data) + b" ", np.uint8)]
    ends = np.cumsum(np.fromiter((len(d) + 1 for d in data), np.int64, len(data)))
    edge = np.diff(np.concatenate([[True], _BLANK[raw]]).astype(np.int8))
    begin, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    found = stretches(raw, begin, stop - begin)
    return found, np.diff(np.concatenate([[0], np.searchsorted(begin, ends)]))
