"""Suffixes of a text in order, by difference-cover blockwise sorting.

Positions whose residue mod v lies in a difference cover are the sample. Its ranks to a fixed depth are computed once,
by doubling. The wanted suffixes are then dealt into blocks by their first bytes and sorted a block at a time: by their
first v bytes, and where those tie, by the ranks of the sample positions that the cover promises at one common distance
behind any two suffixes. So memory beyond the text and the sample is that of a block.
"""

from __future__ import annotations

import numpy as np

V = 8
U = np.uint64


def difference_cover(v: int) -> list[int]:
    """Residues of which some two have any given difference mod v, found greedily."""
    cover, missing = [0], set(range(1, v))
    while missing:
        gain = lambda c: len(missing & {(c - x) % v for x in cover} | missing & {(x - c) % v for x in cover})
        best = max((c for c in range(v) if c not in cover), key=gain)
        cover.append(best)
        missing -= {(a - b) % v for a in cover for b in cover}
    return sorted(cover)


COVER = difference_cover(V)
#: SHIFT[r, s]: the least distance behind positions of residues r and s at which both are in the sample.
SHIFT = np.array([[next(d for d in range(V) if (r + d) % V in COVER and (s + d) % V in COVER) for s in range(V)] for r in range(V)])


def words_at(text: np.ndarray, n: int) -> np.ndarray:
    """The 8 bytes from each of the first n positions on, as big-endian numbers; text goes on for 7 bytes at least."""
    x = text[: n + 7].astype(np.uint16)
    x = (x[:-1] << np.uint16(8)) | x[1:]
    x = x.astype(np.uint32)
    x = (x[:-2] << np.uint32(16)) | x[2:]
    x = x.astype(U)
    return (x[:-4] << U(32)) | x[4:]


class SuffixOrder:
    def __init__(self, text: np.ndarray, depth: int, block: int = 1 << 18):
        """depth: how far suffixes have to be told apart. block: suffixes sorted at a time."""
        self.n, self.depth, self.block = len(text), depth, block
        self.text = np.concatenate([text, np.zeros(2 * depth + 2 * V + 8, np.uint8)])
        self.words = words_at(self.text, self.n + depth + V)
        self.rank = self._sample_ranks()

    def _sample_ranks(self) -> np.ndarray:
        """By position; of sample positions the rank of the suffix to the depth, elsewhere 0."""
        total = self.n + V
        sample = np.flatnonzero(np.isin(np.arange(total) % V, COVER))
        rank = np.zeros(total + self.depth + V, np.int32)
        rank[sample] = np.unique(self.words[sample], return_inverse=True)[1]
        reach = V
        while reach < self.depth:
            step = min(reach, -(-(self.depth - reach) // V) * V)  # a multiple of V leads from sample to sample
            rank[sample] = np.unique((rank[sample].astype(np.int64) << 32) | rank[sample + step], return_inverse=True)[1]
            reach += step
        return rank

    def order(self, positions: np.ndarray) -> np.ndarray:
        """positions in the order of the suffixes that begin there."""
        first = self.words[positions]
        if len(positions) <= self.block:
            return self._block(positions, first)
        probe = np.sort(first[:: max(1, len(first) // 4096)])
        cuts = np.unique(probe[:: max(1, len(probe) * self.block // (2 * len(first)))])
        where = np.searchsorted(cuts, first, "right")
        out = []
        by_block = np.argsort(where, kind="stable")
        ends = np.searchsorted(where[by_block], np.arange(len(cuts) + 2))
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            some = by_block[a:b]
            out.append(self._block(positions[some], first[some]))
        return np.concatenate(out)

    def _block(self, positions: np.ndarray, first: np.ndarray) -> np.ndarray:
        order = np.argsort(first, kind="stable")
        positions, first = positions[order], first[order]
        if len(positions) < 2:
            return positions
        same = first[1:] == first[:-1]
        group = np.concatenate([[0], np.cumsum(~same)])
        tied = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        if tied.any():
            at = np.flatnonzero(tied)
            p, g = positions[at], group[at].astype(np.int64) << 32
            residue, below = p % V, np.zeros(len(at), np.int64)
            classes = [np.flatnonzero(residue == r) for r in range(V)]
            for r in range(V):
                for s in range(V):
                    mine, other, shift = classes[r], classes[s], int(SHIFT[r, s])
                    if len(mine) and len(other):
                        keys = g[other] | self.rank[p[other] + shift]
                        keys.sort()
                        below[mine] += np.searchsorted(keys, g[mine] | self.rank[p[mine] + shift], "right" if s < r else "left")
            positions[at] = p[np.lexsort((below, g))]
        return positions

    def equal_to_next(self, ordered: np.ndarray) -> np.ndarray:
        """Of each suffix but the last: whether it equals the next to the depth."""
        a, b, out = ordered[:-1], ordered[1:], np.ones(max(0, len(ordered) - 1), bool)
        for at in [*range(0, self.depth - V, V), self.depth - V]:
            out &= self.words[a + at] == self.words[b + at]
        return out
