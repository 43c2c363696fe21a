"""Many texts as one numpy array of code points: classes, words and word hashes at array speed.

Memory is about 60 bytes a code point of the texts taken at once; ``portions`` keeps
that to PORTION code points, or one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

PORTION = 1 << 18
LETTER, DIGIT, UPPER, SPACE = 1, 2, 4, 8
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93
_PLANES = 0x20000            # code points whose class is looked up; above only letters are told apart


def portions(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) in runs of about PORTION code points; null becomes empty."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t or ""
        if held and size + len(t) > PORTION:
            yield first, held
            first, held, size = i, [], 0
        held.append(t)
        size += len(t)
    if held:
        yield first, held


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.zeros(0x110000, dtype=np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(_PLANES):
        c = chr(i)
        kind[i] = LETTER * c.isalpha() | DIGIT * c.isdecimal() | UPPER * c.isupper() | SPACE * c.isspace()
        if len(low := c.lower()) == 1:
            lower[i] = ord(low)
    kind[0x20000:0x32400] = LETTER              # the ideographs of the planes above
    return kind, lower


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(n + 1, dtype=np.uint64)
    up, down = one.copy(), one.copy()
    up[1:] = np.uint64(_STEP)
    down[1:] = np.uint64(pow(_STEP, -1, 1 << 64))
    return np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Codes:
    """Texts joined by line feeds: ``codes``, their ``kind`` and lower-case form, ``starts`` of
    the texts and the text ``of`` each code point on demand."""

    def __init__(self, texts: list[str]):
        self.codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), dtype=np.uint32)
        self.lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)])[:-1]
        kind, lower = _tables()
        self.kind, self.lower = kind[self.codes], lower[self.codes]

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of code points where ``member`` holds.  The
        joining line feed must not be a member."""
        edge = np.diff(np.concatenate([[0], member.view(np.int8), [0]]))
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the lower-case code points from start to end, by place-independent
        polynomial sums."""
        n = len(self.codes)
        size = 1 << max(PORTION, n).bit_length()
        up, down = _powers(size)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(self.lower.astype(np.uint64) + _ODD) * up[:n], out=sums[1:])
        return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
