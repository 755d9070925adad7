"""Words of many texts as arrays: where each begins and ends, and a 64-bit code of its bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time (arrays take about 60 bytes for each).
PORTION = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS = {int(BASE): np.ones(1, np.uint64), int(INVERSE): np.ones(1, np.uint64)}


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of :data:`BASE` or :data:`INVERSE`, kept for the next call."""
    if len(_POWERS[int(base)]) < n:
        more = np.full(max(n, PORTION + 1), base, np.uint64)
        more[0] = 1
        _POWERS[int(base)] = np.multiply.accumulate(more)
    return _POWERS[int(base)][:n]


class Words:
    """``data`` is the texts' bytes, ``first[i]`` to ``first[i + 1]`` the words of text i."""

    def __init__(self, data: bytes, ends: np.ndarray):
        """``ends`` are the offsets of the texts in ``data``, 0 first."""
        self.data = data
        raw = np.frombuffer(data, np.uint8)
        word = ~SPACE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[ends] = True  # a word ends with its text
        begins = word.copy()
        begins[1:] &= ~word[:-1] | edge[1:-1]
        stops = word.copy()
        stops[:-1] &= ~word[1:] | edge[1:-1]
        self.start, self.stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, ends)
        # A polynomial of the word's bytes, from sums over the whole portion.
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=sums[1:])
        shift = powers(INVERSE, len(raw) + 1)
        self.codes = mixed((sums[self.stop] - sums[self.start]) * shift[self.start])

    def words(self, a: int, b: int) -> list[bytes]:
        return self.data[self.start[a]:self.stop[b - 1]].split() if b > a else []


def portions(texts: pa.Array, size: int = PORTION):
    """(index of the first text, :class:`Words`) over an Arrow column of strings; null is empty.
    A portion holds whole texts, so a longer text is a portion by itself."""
    values = [t.as_buffer() if t.is_valid else None for t in texts]
    at = 0
    while at < len(values):
        held, ends, parts = 0, [0], []
        first = at
        while at < len(values) and (not parts or held < size):
            part = bytes(values[at]) if values[at] is not None else b""
            parts.append(part)
            held += len(part)
            ends.append(held)
            at += 1
        yield first, Words(b"".join(parts), np.array(ends))


def runs(codes: np.ndarray, length: int) -> np.ndarray:
    """A code of the ``length`` words from each place on (texts are not told apart here)."""
    n = max(0, len(codes) - length + 1)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * BASE + codes[k:k + n]
    return mixed(out)
