"""Vectorised 64-bit hashes of byte ranges, and words of byte buffers.

A range is read in chunks of eight bytes (the last one padded), and each chunk goes through a non-linear mixing with the
state before it, which starts from a key and the range's length. So two different ranges of at most eight bytes never
collide, and no structure of longer ones (a string and its complement, say) cancels out, as it does for polynomials modulo
2**64. Where a result depends on one word alone, callers compare the chunks themselves (`packing`)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the 64-bit finaliser of MurmurHash3)."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


#: Ranges of more bytes are hashed one by one.
LONG = 256
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


def chunks(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, which ranges have it, its bytes as a little-endian number) of the eight-byte chunks of ranges, in order."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    which, k = np.flatnonzero(end > start), 0
    while len(which):
        at = start[which] + 8 * k
        left = end[which] - at
        yield k, which, eight[at] & _MASKS[np.minimum(left, 8)]
        which, k = which[left > 8], k + 1


class RangeHash:
    """Hashes of many ranges of one buffer at once, under a key."""

    def __init__(self, seed: int = 1):
        self.key = np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, 2, dtype=np.uint64)

    def of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = mix((end - start).astype(np.uint64) * self.key[0] + self.key[1])
        long = np.flatnonzero(end - start > LONG)
        stop = end if not len(long) else np.where(end - start > LONG, start, end)
        for _, which, x in chunks(data, start, stop):
            out[which] = mix((out[which] + self.key[1]) ^ x)
        for i in long.tolist():
            found = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=self.key.tobytes())
            out[i] = np.frombuffer(found.digest(), np.uint64)[0]
        return out


def _is(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: [\x20\x09-\x0D]
SPACE = _is(b" \t\n\x0b\x0c\r")
#: ASCII letters and digits, and every byte of other characters.
ALNUM = _is(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
#: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of bytes that are inside a word; no word crosses the start of a row."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[[0, n]] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
