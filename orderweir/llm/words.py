"""Words of many texts at once: places and 64-bit hashes by array arithmetic over the bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are taken together up to this many bytes; a longer text is taken alone.
GROUP_BYTES = 1 << 20

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
FACTOR = 0x5851F42D4C957F2D
BYTE_VALUES = np.random.default_rng(1_201).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: ASCII lower case.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Byte classes after lower case: words apart by white space; words of letters, digits and non-ASCII.
NOT_SPACE = np.array([b not in (9, 10, 11, 12, 13, 32) for b in range(256)])
LETTERS = np.array([b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 for b in range(256)])

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR to the power 0..n-1 and the inverses, modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 2 * GROUP_BYTES)
        for name, factor in (("up", FACTOR), ("down", pow(FACTOR, -1, 2**64))):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX2
    return x ^ (x >> np.uint64(29))


@dataclass
class Scan:
    """Words of a group of texts; text i has the words bounds[i] to bounds[i + 1]."""

    raw: np.ndarray
    low: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    sums: np.ndarray

    def hashes(self, most: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first bytes."""
        ends = self.ends if most is None else np.minimum(self.ends, self.starts + most)
        return mixed((self.sums[ends] - self.sums[self.starts]) * powers(len(self.raw))[1][self.starts])

    def word(self, i: int) -> bytes:
        return self.low[self.starts[i] : self.ends[i]].tobytes()


def scan(
    texts: list[bytes], word_bytes: np.ndarray, join: np.ndarray | None = None, latin: bool = False
) -> Scan:
    """word_bytes: which bytes, after lower case, belong to words; line ends must not.

    join: bytes that are part of a number if digits are on both sides. latin: also fold the
    capitals of Latin-1.
    """
    joined = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(joined, np.uint8)
    low = np.frombuffer(joined.translate(LOWER), np.uint8)
    if latin:  # in UTF-8 the second byte after 0xC3
        low = low.copy()
        low[1:][(low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)] += 0x20
    inside = word_bytes[low]
    if join is not None:
        digit = (low >= 48) & (low <= 57)
        inside[1:-1] |= join[low[1:-1]] & digit[:-2] & digit[2:]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[::2], edge[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[low] * powers(len(raw))[0][: len(raw)], out=sums[1:])
    return Scan(raw, low, offsets, starts, ends, np.searchsorted(starts, offsets), sums)


def hash_of(word: bytes) -> int:
    """The hash that `Scan.hashes` gives the word."""
    return int(scan([word], np.arange(256) != 10).hashes()[0])


def groups(batch: pa.RecordBatch, column: int = 1) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of consecutive rows of about GROUP_BYTES."""
    texts, size, first = [], 0, 0
    for i, text in enumerate(batch.column(column)):
        body = text.as_py()
        if texts and size + len(body) > GROUP_BYTES:
            yield first, texts
            texts, size, first = [], 0, i
        texts.append(body)
        size += len(body)
    if texts:
        yield first, texts


def runs(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` values."""
    count = max(len(values) - width + 1, 0)
    out = np.full(count, width, np.uint64)
    for i in range(width):
        out = (out ^ (out >> np.uint64(29))) * MIX + values[i : i + count]
    return mixed(out)


class Lookup:
    """Number of a hash among given ones, -1 for others."""

    def __init__(self, hashes: np.ndarray):
        """hashes: distinct; their places are the numbers."""
        self.bits = np.uint64(64 - max(10, int(len(hashes) * 8).bit_length()))
        self.order = np.argsort(hashes, kind="stable")
        self.sorted = hashes[self.order]
        self.seen = np.zeros(1 << int(64 - int(self.bits)), bool)
        self.seen[(hashes >> self.bits).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.seen[(hashes >> self.bits).astype(np.int64)])
        if len(maybe) and len(self.sorted):
            spot = np.minimum(np.searchsorted(self.sorted, hashes[maybe]), len(self.sorted) - 1)
            hit = self.sorted[spot] == hashes[maybe]
            out[maybe[hit]] = self.order[spot[hit]]
        return out
