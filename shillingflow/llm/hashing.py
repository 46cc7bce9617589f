"""Hashes of many pieces of text at once."""

from __future__ import annotations

import re

import numpy as np

SPACES = b" \t\n\v\f\r"


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class SpanHasher:
    """64-bit hashes of spans of a byte array: differences of one running polynomial sum."""

    BASE = 0x9E3779B97F4A7C15
    _known: list[SpanHasher] = []

    def __init__(self) -> None:
        self._known.append(self)
        self.letters = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.powers = self.inverse = np.ones(1, np.uint64)

    @classmethod
    def shrink_all(cls) -> None:
        """Drops tables that a long buffer has left; they grow again when needed."""
        for hasher in cls._known:
            if len(hasher.powers) > 2 * PART:
                hasher.powers = hasher.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            step = np.full(n, self.BASE, np.uint64)
            step[0] = 1
            self.powers = np.cumprod(step, dtype=np.uint64)
            step[1:] = np.uint64(pow(self.BASE, -1, 1 << 64))
            self.inverse = np.cumprod(step, dtype=np.uint64)

    def _sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.multiply(self.letters[data], self.powers[: len(data)], out=sums[1:])
        return np.cumsum(sums, out=sums)

    def __call__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self._sums(data)
        return mix((sums[end] - sums[begin]) * self.inverse[begin])

    def of(self, data, begin: np.ndarray, end: np.ndarray, part: int = 1 << 20) -> np.ndarray:
        """Hashes of spans of a long buffer, ``part`` bytes at a time, with their lengths mixed in."""
        out, order, at = np.empty(len(begin), np.uint64), np.argsort(begin, kind="stable"), 0
        begin, end = begin[order], end[order]
        while at < len(order):
            to = max(int(np.searchsorted(begin, begin[at] + part)), at + 1)
            low, high = int(begin[at]), int(end[at:to].max())
            a, b = begin[at:to] - low, end[at:to] - low
            out[order[at:to]] = mix(self(np.frombuffer(data, np.uint8, high - low, low), a, b) + (b - a).astype(np.uint64))
            at = to
        return out

    def rolling(self, data: np.ndarray, size: int) -> np.ndarray:
        """Hashes of all spans of one size, by their starts."""
        sums = self._sums(data)
        h = sums[size:] - sums[:-size]
        h *= self.inverse[: len(h)]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h


_GAP = re.compile(b"[ \t\n\v\f\r]")
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_SPANS = SpanHasher()
PART = 1 << 20  # bytes hashed at a time


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Hashes of each text's words (runs of anything but ASCII white space)."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        data = np.frombuffer(b" ".join(t for _, t in held) + b" ", np.uint8)
        space = _SPACE[data]
        begin = np.flatnonzero(~space & np.append(True, space[:-1]))
        end = np.flatnonzero(space & ~np.append(True, space[:-1]))
        ends = np.cumsum([len(t) + 1 for _, t in held])
        for (i, _), h in zip(held, np.split(_SPANS(data, begin, end), np.searchsorted(begin, ends[:-1]))):
            out[i].append(h)
        held.clear()

    for i, text in enumerate(texts):
        for part in _parts(text):
            if held and size + len(part) > PART:
                flush()
                size = 0
            held.append((i, part))
            size += len(part)
    if held:
        flush()
    return [h[0] if len(h) == 1 else np.concatenate(h) for h in out]


def _parts(text: bytes) -> list[bytes]:
    """A long text in parts that end with a word."""
    if len(text) <= 2 * PART:
        return [text]
    out, at = [], 0
    while at < len(text):
        found = _GAP.search(text, at + PART)
        to = found.start() if found else len(text)
        out.append(text[at:to])
        at = to
    return out


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of the ``n``-word shingles, sorted; fewer words count as one shingle, none as no shingle."""
    if not len(words):
        return words
    size = min(n, len(words))
    h = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(SpanHasher.BASE) + words[k:k + len(h)])
    return np.unique(h)
