"""Texts as one flat array of code points, cut into segments, with what is known of each distinct segment."""

from __future__ import annotations

import numpy as np

from . import common as C

#: Code points that one flat pass works on; a longer text is worked on alone.
PASS = 500_000


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the texts, with a blank behind each, and the n + 1 offsets."""
    data = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    return data, np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))


def hashes(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each segment."""
    up, down = C.powers(len(cp))
    total = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum(C.mix(cp.astype(np.uint64) + np.uint64(1)) * up[: len(cp)], out=total[1:])
    return C.mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def take(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of all segments' members, one segment after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Known:
    """Integer rows of distinct segments by hash, in sorted arrays of bounded size."""

    def __init__(self, kind, most: int = 300_000):
        self.kind, self.most = kind, most
        self.clear()

    def clear(self) -> None:
        self.keys, self.start, self.size, self.store = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.kind)

    def rows(self, h: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        """Where each segment's row starts in ``store`` and its size. make(i) gives flat values and sizes for the segments at i, one for each hash that is new."""
        keys, first, back = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        lack = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(lack):
            if len(self.keys) + len(lack) > self.most:
                self.clear()
                lack = np.arange(len(keys))
            values, sizes = make(first[lack])
            start = len(self.store) + np.cumsum(sizes) - sizes
            self.store = np.concatenate((self.store, values.astype(self.kind)))
            order = np.argsort(np.concatenate((self.keys, keys[lack])), kind="stable")
            self.keys, self.start, self.size = (np.concatenate(x)[order] for x in ((self.keys, keys[lack]), (self.start, start), (self.size, sizes)))
            at = np.searchsorted(self.keys, keys)
        return self.start[at][back], self.size[at][back]
