"""Words of a batch of texts as numpy arrays.

Texts are laid out in one byte buffer; byte classes cut it into words, and every
word gets a 64-bit hash (per-position multilinear over random byte values, then
mixed), all vectorised. Hashes are a pure function of the word's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

LONG_WORD = 64  # longer words are hashed one by one

_rng = np.random.Generator(np.random.PCG64(77))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = _rng.integers(0, 1 << 63, LONG_WORD, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GRAM = _rng.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_C1, _C2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

_bytes = np.arange(256)
LOWER = _bytes.astype(np.uint8)
LOWER[65:91] += 32
NOT_SPACE = ~((_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13)))
ALNUM = ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _C1
    h = (h ^ (h >> np.uint64(33))) * _C2
    return h ^ (h >> np.uint64(33))


@dataclass
class Words:
    """Words of a batch: ``hashes``; word ``i`` is ``buffer[starts[i]:ends[i]]``;
    text ``t`` has the words ``bounds[t]:bounds[t + 1]``."""
    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def word(self, i: int) -> bytes:
        return self.buffer[self.starts[i]:self.ends[i]].tobytes()


def layout(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with a space after each, and where each text starts (and the end)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    buffer = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    return buffer, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]).astype(np.int64)


def cut(buffer: np.ndarray, texts_at: np.ndarray, word_bytes: np.ndarray) -> Words:
    """Words are the maximal runs of bytes of the class ``word_bytes``."""
    inside = np.concatenate([[False], word_bytes[buffer], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    bounds = np.searchsorted(starts, texts_at)
    return Words(buffer, starts, ends, bounds, hash_slices(buffer, starts, ends))


def words(texts: list[str], word_bytes: np.ndarray = NOT_SPACE) -> Words:
    buffer, at = layout(texts)
    return cut(LOWER[buffer], at, word_bytes)


def hash_slices(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lens = ends - starts
    out = np.empty(len(starts), dtype=np.uint64)
    short = lens <= LONG_WORD
    s, n = starts[short], lens[short]
    if len(s):
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        at = place + np.repeat(s, n)
        out[short] = np.add.reduceat(_BYTE[buffer[at]] * PLACES[place], first)
    for i in np.flatnonzero(~short).tolist():
        out[i] = xxhash.xxh64_intdigest(buffer[starts[i]:ends[i]].tobytes())
    return mix(out)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n`` consecutive words inside a text, and each gram's text
    bounds (as ``Words.bounds``). Texts with fewer words have none."""
    total = len(w.hashes) - n + 1
    counts = np.maximum(w.counts - n + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if total <= 0:
        return np.zeros(0, dtype=np.uint64), bounds
    h = np.zeros(total, dtype=np.uint64)
    for k in range(n):
        h += w.hashes[k:k + total] * _GRAM[k]
    # Drop grams that cross a text's end.
    at = np.repeat(w.bounds[:-1], counts) + np.arange(int(counts.sum())) - np.repeat(bounds[:-1], counts)
    return mix(h[at]), bounds


def pieces(texts: list, limit: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    """(position, texts) in turns of about ``limit`` characters; null is empty."""
    held, size, first = [], 0, 0
    for i, t in enumerate(texts):
        held.append(t or "")
        size += len(held[-1])
        if size >= limit:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held
