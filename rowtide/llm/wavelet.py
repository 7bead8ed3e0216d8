"""A wavelet matrix: a sequence of token ids as one bit-plane per bit of an id.

Plane 0 holds the highest bits in text order; each later plane holds the next bit after a
stable split of the sequence by the bit before.  Ranks inside the planes answer "which token
stands here", "how often does this token occur before here" and "where is its n-th
occurrence" in a number of steps that depends only on the number of bits.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WVM1"
#: Bits between stored ranks.
STRIDE = 4096
HEAD = struct.Struct("<4sBQ")


class WaveletMatrix:
    """``planes``: packed bits of each level; ``zeros``: zero bits of each level; ``n``: tokens."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], n: int):
        self.planes, self.zeros, self.n = planes, zeros, n
        self._ranks: list[np.ndarray] | None = None

    @staticmethod
    def build(ids: np.ndarray, bits: int) -> WaveletMatrix:
        ids = np.ascontiguousarray(ids, np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        for level in range(bits):
            one = (ids & ids.dtype.type(1 << (bits - 1 - level))) != 0
            planes.append(np.packbits(one))
            low = ids.take(np.flatnonzero(~one))
            zeros.append(len(low))
            ids = np.concatenate([low, ids.take(np.flatnonzero(one))])
        return WaveletMatrix(planes, zeros, len(planes) and len(ids))

    def tokens(self) -> np.ndarray:
        """The whole sequence."""
        bits = len(self.planes)
        kind = np.uint16 if bits <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for level in range(bits - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n).view(bool)
            up = np.empty(self.n, kind)
            up[np.flatnonzero(~one)] = ids[: self.zeros[level]]
            up[np.flatnonzero(one)] = ids[self.zeros[level] :] | kind(1 << (bits - 1 - level))
            ids = up
        return ids

    def ranks(self, level: int) -> np.ndarray:
        """One bits before every STRIDE-th bit of a plane."""
        if self._ranks is None:
            step = STRIDE // 8
            counts = [np.add.reduceat(np.bitwise_count(p).astype(np.uint64), np.arange(0, len(p), step)) if len(p) else np.zeros(0, np.uint64) for p in self.planes]
            self._ranks = [np.concatenate(([0], np.cumsum(c))).astype(np.int64) for c in counts]
        return self._ranks[level]

    def ones(self, level: int, i: int) -> int:
        """One bits among the first ``i`` of a plane."""
        block, plane = i // STRIDE, self.planes[level]
        first, last = block * (STRIDE // 8), i // 8
        inside = int(np.bitwise_count(plane[first:last]).sum())
        if i % 8:
            inside += int(plane[last] >> (8 - i % 8)).bit_count()
        return int(self.ranks(level)[block]) + inside

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for level, zeros in enumerate(self.zeros):
            bit = int(self.planes[level][i // 8]) >> (7 - i % 8) & 1
            before = self.ones(level, i)
            i = zeros + before if bit else i - before
            token = token << 1 | bit
        return token

    def _span(self, token: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` among the first ``i`` tokens lie after all splits."""
        start, bits = 0, len(self.planes)
        if token >> bits:
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            if token >> (bits - 1 - level) & 1:
                start, i = zeros + self.ones(level, start), zeros + self.ones(level, i)
            else:
                start, i = start - self.ones(level, start), i - self.ones(level, i)
        return start, i

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` among the first ``i`` tokens."""
        start, end = self._span(token, min(max(i, 0), self.n))
        return end - start

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _find(self, level: int, bit: int, nth: int) -> int:
        """Position of the ``nth`` (from 0) ``bit`` of a plane."""
        marks = self.ranks(level)
        if not bit:
            marks = np.minimum(np.arange(len(marks)) * STRIDE, self.n) - marks
        block = int(np.searchsorted(marks, nth, side="right")) - 1
        first = block * (STRIDE // 8)
        count = min(STRIDE, self.n - block * STRIDE)
        inside = np.unpackbits(self.planes[level][first : first + STRIDE // 8], count=count)
        return block * STRIDE + int(np.flatnonzero(inside == bit)[nth - int(marks[block])])

    def select(self, token: int, nth: int) -> int:
        """Position of the ``nth`` (from 0) occurrence of ``token``."""
        start, end = self._span(token, self.n)
        if not 0 <= nth < end - start:
            raise IndexError(nth)
        i = start + nth
        for level in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - level) & 1
            i = self._find(level, bit, i - self.zeros[level] if bit else i)
        return i

    def to_bytes(self) -> bytes:
        """One compressed file: a head, the length of each plane's frame and its zeros, the frames."""
        pack = zstandard.ZstdCompressor(level=1)
        frames = [pack.compress(p.tobytes()) for p in self.planes]
        sizes = b"".join(struct.pack("<QQ", len(f), z) for f, z in zip(frames, self.zeros, strict=True))
        return HEAD.pack(MAGIC, len(frames), self.n) + sizes + b"".join(frames)

    @staticmethod
    def from_bytes(data: bytes) -> WaveletMatrix:
        magic, bits, n = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        sizes = [struct.unpack_from("<QQ", data, HEAD.size + 16 * i) for i in range(bits)]
        at, planes, unpack = HEAD.size + 16 * bits, [], zstandard.ZstdDecompressor()
        for size, _ in sizes:
            planes.append(np.frombuffer(unpack.decompress(data[at : at + size]), np.uint8))
            at += size
        return WaveletMatrix(planes, [z for _, z in sizes], n)
