"""Hashes of words and of shingles of words, for many texts at once."""

from __future__ import annotations

import numpy as np

#: Odd bases of the polynomials, and of the mixing behind them.
_BASE, _STEP, _ODD = 0xD6E8FEB86659FD95, np.uint64(0x9FB21C651E98DF25), np.uint64(0xFF51AFD7ED558CCD)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: ASCII white space by byte.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


class Powers:
    """Powers of an odd base and of its inverse, modulo the type's range, as far as they were asked for."""

    def __init__(self, base: int, kind: type):
        self.kind, self.bases = kind, (base, pow(base, -1, 1 << np.dtype(kind).itemsize * 8))
        self.held: tuple = (np.ones(0, kind),) * 2

    def __getstate__(self) -> tuple:
        return self.kind, self.bases

    def __setstate__(self, state: tuple) -> None:
        self.kind, self.bases = state
        self.held = (np.ones(0, self.kind),) * 2

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.held[0]) < n:
            made = []
            for base in self.bases:
                out = np.full(n, base, self.kind)
                out[0] = 1
                made.append(np.multiply.accumulate(out, dtype=self.kind))
            self.held = tuple(made)
        return self.held[0][:n], self.held[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _ODD
    return h ^ (h >> np.uint64(29))


class Words:
    """64-bit hashes of the words of texts, A-Z lower-cased; words are parted by ASCII white space."""

    def __init__(self):
        self.powers = Powers(_BASE, np.uint64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, number of words of each text)."""
        b = np.frombuffer(b"\n".join([*texts, b""]).translate(_LOWER), np.uint8)
        edge = np.flatnonzero(np.diff(SPACE[b].view(np.int8), prepend=1))
        starts, ends = edge[::2], edge[1::2]
        up, down = self.powers(len(b) + 1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        bounds = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        return mixed((sums[ends] - sums[starts]) * down[starts]), np.diff(np.searchsorted(starts, bounds), prepend=0)

    def shingles(self, texts: list[bytes], width: int) -> list[np.ndarray]:
        """Sorted hashes of each text's distinct shingles of ``width`` words; a text of fewer words is one shingle, one of none has none."""
        h, counts = self(texts)
        n = max(0, len(h) - width + 1)
        own = np.zeros(n, np.uint64)
        for k in range(width):
            own = own * _STEP + h[k : k + n]
        own, out, at = mixed(own), [], 0
        for c in counts.tolist():
            if c >= width:
                out.append(np.unique(own[at : at + c - width + 1]))
            else:
                one = np.zeros(min(c, 1), np.uint64)
                for x in h[at : at + c]:
                    one = one * _STEP + x
                out.append(mixed(one + np.uint64(c)))
            at += c
        return out


def word_hash(word: bytes) -> int:
    return int(Words()([word])[0][0])


def slices(texts: list[bytes], limit: int = 1 << 20):
    """Ranges of neighbouring texts with together about ``limit`` bytes."""
    lo = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= limit:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
