"""Wavelet matrix over small integers: bit planes with rank and select.

The file keeps a directory of rank samples, one for each block of
``BLOCK_WORDS`` words of a plane, and each block compressed on its own: looking
at one position, counting a value or finding an occurrence unzips just the
blocks that the search passes through.
"""

import struct

import numpy as np
import zstandard

BLOCK_WORDS = 1024
_HEAD = struct.Struct("<4sBQI")
_MAGIC = b"WVM2"


class Plane:
    """Bits with a running count of ones for each 64-bit word, in blocks that are loaded when needed."""

    def __init__(self, n: int, ones: int, words: np.ndarray | None = None, samples: np.ndarray | None = None, blocks: list[memoryview] | None = None, block_words: int = BLOCK_WORDS):
        self.n, self.ones, self.zeros = n, ones, n - ones
        self.block_words, self.samples, self.blocks = block_words, samples, blocks
        if words is not None:
            self.words, self.missing = words, None
            self.before = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=self.before[1:])
            return
        self.words, self.before = np.zeros(n // 64 + 1, "<u8"), np.zeros(n // 64 + 2, np.int64)
        self.missing = np.ones(len(blocks), bool)

    @classmethod
    def of(cls, bits: np.ndarray) -> "Plane":
        packed = np.packbits(bits, bitorder="little")
        # One word more than needed, so that rank(n) has a word to look at.
        room = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        room[: len(packed)] = packed
        words = room.view("<u8")
        return cls(len(bits), int(np.bitwise_count(words).sum()), words)

    def _load(self, wanted: np.ndarray) -> None:
        """Unzips the blocks of these words that aren't there yet."""
        if self.missing is None:
            return
        here = wanted // self.block_words
        unzip = zstandard.ZstdDecompressor()
        for k in np.unique(here[self.missing[here]]).tolist():
            at = k * self.block_words
            block = np.frombuffer(unzip.decompress(self.blocks[k]), "<u8")
            self.words[at : at + len(block)] = block
            self.before[at : at + len(block) + 1] = self.samples[k] + np.concatenate([[0], np.cumsum(np.bitwise_count(block))])
            self.missing[k] = False
        if not self.missing.any():
            self.missing = None

    def get(self, i: np.ndarray) -> np.ndarray:
        self._load(i >> 6)
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        self._load(i >> 6)
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & mask)

    def bits(self) -> np.ndarray:
        self._load(np.arange(0, len(self.words), self.block_words))
        return np.unpackbits(self.words.view(np.uint8), count=self.n, bitorder="little").view(bool)

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) such bit, by bisection on the rank."""
        low, high = np.zeros_like(k), np.full_like(k, self.n)
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            ones = self.rank1(np.minimum(mid + 1, self.n))
            more = (ones if bit else mid + 1 - ones) > k
            high = np.where(open_ & more, mid, high)
            low = np.where(open_ & ~more, mid + 1, low)
        return low


class WaveletMatrix:
    """Planes from the highest bit down; each plane's zeros come before its ones in the next."""

    def __init__(self, planes: list[Plane], n: int):
        self.planes, self.n = planes, n

    @classmethod
    def of(cls, values: np.ndarray, n_bits: int) -> "WaveletMatrix":
        planes = []
        for p in range(n_bits - 1, -1, -1):
            bits = (values & values.dtype.type(1 << p)).astype(bool)
            planes.append(Plane.of(bits))
            # By positions: numpy takes a mask of mixed bits several times slower.
            values = np.concatenate([values[np.flatnonzero(~bits)], values[np.flatnonzero(bits)]])
        return cls(planes, len(values))

    def access(self, i: np.ndarray) -> np.ndarray:
        return self.access_rank(i)[0]

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value at each position and how often it occurs before that position."""
        i, value, low = i.astype(np.int64), np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for plane in self.planes:
            bit = plane.get(i).astype(bool)
            value = value * 2 + bit
            one, base = plane.rank1(i), plane.rank1(low)
            i = np.where(bit, plane.zeros + one, i - one)
            low = np.where(bit, plane.zeros + base, low - base)
        return value, i - low

    def rank(self, value: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each value occurs before each position."""
        low, i = np.zeros(len(i), np.int64), i.astype(np.int64)
        for p, plane in zip(range(len(self.planes) - 1, -1, -1), self.planes, strict=True):
            bit = (value >> p) & 1 != 0
            one, base = plane.rank1(i), plane.rank1(low)
            i = np.where(bit, plane.zeros + one, i - one)
            low = np.where(bit, plane.zeros + base, low - base)
        return i - low

    def count(self, value: int) -> int:
        if value < 0 or value >> len(self.planes):
            return 0
        return int(self.rank(np.array([value]), np.array([self.n]))[0])

    def select(self, value: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) occurrence of a value."""
        n_bits, low = len(self.planes), np.zeros(1, np.int64)
        for p, plane in enumerate(self.planes):
            ones = plane.rank1(low)
            low = plane.zeros + ones if value >> (n_bits - 1 - p) & 1 else low - ones
        i = low + np.asarray(k, np.int64)
        for p, plane in zip(range(n_bits), reversed(self.planes), strict=True):
            bit = value >> p & 1
            i = plane.select(bit, i - plane.zeros if bit else i)
        return i

    def occurrences(self, value: int) -> np.ndarray:
        return self.select(value, np.arange(self.count(value)))

    def decode(self) -> np.ndarray:
        """All values, from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for p, plane in enumerate(reversed(self.planes)):
            bits = plane.bits()
            above = np.empty_like(values)
            above[np.flatnonzero(~bits)] = values[: plane.zeros]
            above[np.flatnonzero(bits)] = values[plane.zeros :] | kind(1 << p)
            values = above
        return values

    def to_bytes(self) -> bytes:
        """Head; for each plane its number of ones, rank samples and sizes of blocks; then the blocks."""
        zipped, directory, blocks = zstandard.ZstdCompressor(level=1), [], []
        for plane in self.planes:
            plane._load(np.arange(0, len(plane.words), plane.block_words))
            mine = [zipped.compress(plane.words[at : at + BLOCK_WORDS].tobytes()) for at in range(0, len(plane.words), BLOCK_WORDS)]
            directory.append(np.concatenate([[plane.ones], plane.before[: len(plane.words) : BLOCK_WORDS], [len(b) for b in mine]]).astype("<i8").tobytes())
            blocks += mine
        return b"".join([_HEAD.pack(_MAGIC, len(self.planes), self.n, BLOCK_WORDS), *directory, *blocks])

    @classmethod
    def from_bytes(cls, blob: bytes) -> "WaveletMatrix":
        magic, n_bits, n, block_words = _HEAD.unpack_from(blob)
        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix file")
        n_blocks = -(-(n // 64 + 1) // block_words)
        directory = np.frombuffer(blob, "<i8", n_bits * (1 + 2 * n_blocks), _HEAD.size).reshape(n_bits, 1 + 2 * n_blocks)
        bounds = np.cumsum([_HEAD.size + directory.nbytes, *directory[:, 1 + n_blocks :].ravel()]).tolist()
        view = memoryview(blob)
        blocks = [view[a:b] for a, b in zip(bounds, bounds[1:])]
        return cls([Plane(n, int(d[0]), None, d[1 : 1 + n_blocks], blocks[k * n_blocks : (k + 1) * n_blocks], block_words) for k, d in enumerate(directory)], n)
