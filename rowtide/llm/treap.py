"""A K2-treap: a sparse grid of positive numbers below 2 ** 31 as a succinct quadtree of maxima.

The square grid of side 2 ** height is cut into quadrants down to single cells.  A level holds
four bits for each of its cells, which say what quadrants are not empty, and for each quadrant
that is not how far its maximum lies below that of its cell.  A rank over the bits leads from a
cell to its quadrants, so no pointers are kept, and what is empty takes no room.  Levels are
compressed one by one as soon as they are made, and opened one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from rowtide.llm.jaccard import packed, unpacked


def squeezed(data: bytes) -> bytes:
    """``data`` compressed, behind its length."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def expanded(data: bytes) -> bytes:
    """What ``squeezed`` got."""
    return pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def spread(x: np.ndarray) -> np.ndarray:
    """Bits of numbers below 2 ** 31 moved to the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def build(rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> dict:
    """The treap of different cells: height, root (the largest value), squeezed bits and drops of each level from the top."""
    height = max(1, int(max(rows.max(), columns.max())).bit_length())
    code = (spread(rows) << np.uint64(1)) | spread(columns)
    order = np.argsort(code)
    code, best = code[order], values[order].astype(np.int64)
    bits, drops = [], []
    for _ in range(height):
        upper = code >> np.uint64(2)
        starts = np.flatnonzero(np.append(True, upper[1:] != upper[:-1]))
        own = np.left_shift(1, (code & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
        nibbles = np.bitwise_or.reduceat(own, starts)
        top = np.maximum.reduceat(best, starts)
        drops.append(squeezed(packed(np.repeat(top, np.diff(starts, append=len(code))) - best)))
        wide = np.zeros(-(-len(starts) // 16) * 16, np.uint8)
        wide[: len(starts)] = nibbles
        bits.append(squeezed((wide[::2] | (wide[1::2] << 4)).tobytes()))
        code, best = upper[starts], top
    return {"height": height, "root": int(best[0]), "bits": bits[::-1], "drops": drops[::-1]}


class Treap:
    """What ``build`` made; levels are opened when they are first reached."""

    def __init__(self, height: int, root: int, bits: list[bytes], drops: list[bytes]):
        self.height, self.bits, self.drops = height, bits, drops
        self.words: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        self.best = [np.array([root], np.int32)]

    def open(self, level: int) -> None:
        while len(self.words) <= level:
            at = len(self.words)
            words = np.frombuffer(expanded(self.bits[at]), np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.ranks.append((np.cumsum(ones) - ones).astype(np.int32))
            two = words.view(np.uint8)
            quadrants = np.bitwise_count(np.stack([two & 15, two >> 4], axis=1).ravel()[: len(self.best[at])])
            self.best.append(np.repeat(self.best[at], quadrants) - unpacked(expanded(self.drops[at])).view(np.int32))

    def quadrant(self, level: int, cells: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For cells of a level (-1: none), the given quadrant's number in the next level, -1 if empty, and its maximum."""
        slot = np.maximum(cells, 0) * 4 + digit
        word = self.words[level][slot >> 6]
        bit = (slot & 63).astype(np.uint64)
        there = ((word >> bit) & np.uint64(1) > 0) & (cells >= 0)
        below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        at = np.where(there, self.ranks[level][slot >> 6] + below, -1)
        return at, np.where(there, self.best[level + 1][at], 0).astype(np.int64)

    def heaviest(self, rows: np.ndarray, weights: np.ndarray, floor: int, width: int = 60_000):
        """Columns by sums of ``weights`` times their values in ``rows``, best first, in batches.

        The paths of all rows descend together: a range of columns is bounded by the maxima of
        the rows' cells over it, and the ranges with the highest bounds are halved next.  Yields
        (columns, sums) and is told the least sum that is still of interest.
        """
        least = max(1, floor)
        open_: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {
            0: (np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int64), np.array([int(weights.sum()) * int(self.best[0][0])]))
        }
        most = max(16, width // max(1, len(rows)))
        while open_:
            level = max(open_, key=lambda v: (open_[v][2].max(), v))
            columns, cells, bound = open_.pop(level)
            keep = bound >= least
            if not keep.any():
                continue
            columns, cells, bound = columns[keep], cells[keep], bound[keep]
            if len(bound) > most:
                order = np.argpartition(-bound, most)
                rest, order = order[most:], order[:most]
                open_[level] = columns[rest], cells[rest], bound[rest]
                columns, cells = columns[order], cells[order]
            self.open(level)
            shift = self.height - 1 - level
            row_bit = ((rows >> shift) & 1) << 1
            parts = []
            for half in (0, 1):
                at, top = self.quadrant(level, cells, (row_bit | half)[None, :])
                sums = top @ weights
                good = sums >= least
                parts.append((columns[good] * 2 + half, at[good], sums[good]))
            columns, cells, bound = (np.concatenate(p) for p in zip(*parts, strict=True))
            if not len(bound):
                continue
            if level + 1 == self.height:
                least = max(least, (yield columns, bound) or 0)
            elif level + 1 in open_:
                open_[level + 1] = tuple(np.concatenate(p) for p in zip(open_[level + 1], (columns, cells, bound), strict=True))
            else:
                open_[level + 1] = columns, cells, bound
