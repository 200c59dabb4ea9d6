"""Hashes of the words of many texts at once, without making the words.

Texts are laid end to end as bytes. A running sum of bytes times powers of an odd
number, taken at a word's two ends and divided by the power at its begin, is a
hash of the word alone, so that all words of all texts are hashed by a few passes
over arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: White space beyond ASCII.
SPACES = "\x85\xa0                　"
#: Bytes of text taken at once, unless one text has more, and bytes of it that running sums are kept for.
CHUNK = PIECE = 1 << 20

_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers, ``PIECE`` at most, of the multiplier and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _INVERSE)):
            steps = np.full(min(max(n, 1 << 16), PIECE + 1), base, np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes, wherever in the data it is; starts and ends are in order.

    The running sums are made for ``PIECE`` bytes at once, so a long text takes no more memory for them than a short one.
    """
    before, after, down = (np.zeros(len(starts), np.uint64) for _ in range(3))
    carry = np.uint64(0)
    with np.errstate(over="ignore"):
        for at in range(0, len(data) or 1, PIECE):
            part = data[at : at + PIECE]
            up, inverse = _powers_of(len(part) + 1)
            base, undone = (np.uint64(pow(x, at, 1 << 64)) for x in (_P, _INVERSE))
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = carry
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
            sums[1:] = sums[1:] * base + carry
            a, b = np.searchsorted(starts, (at, at + PIECE))
            before[a:b], down[a:b] = sums[starts[a:b] - at], inverse[starts[a:b] - at] * undone
            a, b = np.searchsorted(ends, (at, at + PIECE), "right") if at else (0, np.searchsorted(ends, PIECE, "right"))
            after[a:b] = sums[ends[a:b] - at]
            carry = sums[-1]
        return mix((after - before) * down + (ends - starts).astype(np.uint64))


def hash_of(word: str) -> int:
    """The hash that a word has in a text; the word is taken as it is."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(range_hashes(data, np.array([0]), np.array([len(data)]))[0])


@dataclass
class Chunk:
    """Some texts: their bytes in lower case, the words' ends there, and where each text's words begin in the list of words."""

    texts: list[str]
    first: int  # number of the first text
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    places: np.ndarray  # one more than texts

    def hashes(self) -> np.ndarray:
        return range_hashes(self.data, self.starts, self.ends)


def spaced(text: str | None) -> str:
    """The text with white space beyond ASCII as blanks; null is empty."""
    if not text:
        return ""
    if not text.isascii():
        for c in SPACES:
            if c in text:
                text = text.replace(c, " ")
    return text


def chunks(texts) -> Iterator[Chunk]:
    """All texts in order, in chunks."""
    held: list[str] = []
    first = size = 0
    for text in texts:
        held.append(spaced(text))
        size += len(held[-1])
        if size >= CHUNK:
            yield _chunk(held, first)
            first, held, size = first + len(held), [], 0
    if held:
        yield _chunk(held, first)


def _chunk(texts: list[str], first: int) -> Chunk:
    parts = [t.lower().encode() for t in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.cumsum([0] + [len(p) + 1 for p in parts])
    return Chunk(texts, first, data, starts, ends, np.searchsorted(starts, offsets))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; there must be that many."""
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = (out ^ words[k : k + n]) * np.uint64(_P)
            out ^= out >> np.uint64(32)
    return out
