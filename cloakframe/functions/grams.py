"""n-grams of lists of words by 64-bit hash, in Arrow batches: those that may repeat, and the text of those that are wanted."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a kernel works on at once; a longer document is a block of its own.
BLOCK = 1 << 19
#: Bits of a filter by hash, for few and for many n-grams; more than a 256th of the latter only let more others through.
FEW_BITS, MANY_BITS = 1 << 16, 1 << 29

_M1, _M2, _ODD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_S33 = np.uint64(33)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the 64-bit finaliser of MurmurHash3)."""
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


def _blocks(words: pa.ListArray, n: int) -> tuple[pa.Array, Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The distinct words, and by block each n-gram's row, hash and n numbers of words."""
    coded = words.values.dictionary_encode()
    codes, ends = coded.indices.to_numpy(zero_copy_only=False), words.offsets.to_numpy()
    own = np.array([int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)

    def of() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        first = 0
        while first < len(words):
            last = max(first + 1, int(np.searchsorted(ends, int(ends[first]) + BLOCK, "right")) - 1)
            row = np.repeat(np.arange(first, last), np.diff(ends[first : last + 1]))
            at = np.flatnonzero(row[: max(0, len(row) - n + 1)] == row[n - 1 :])
            parts = np.stack([codes[ends[first] + at + j] for j in range(n)])
            h = np.zeros(len(at), np.uint64)
            for part in parts:
                h = _mix(h * _ODD + own[part])
            yield row[at], h, parts
            first = last

    return coded.dictionary, of()


def _runs(row: np.ndarray, h: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each n-gram of each row, and how often it stands there; the words are compared, not only hashes."""
    order = np.argsort(_mix(h + row.astype(np.uint64) * _ODD))
    new = np.ones(len(order), bool)
    new[1:] = np.diff(row[order]) != 0
    for part in parts:
        new[1:] |= np.diff(part[order]) != 0
    start = np.flatnonzero(new)
    return order[start], np.diff(np.append(start, len(order)))


def repeated(n: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, words, whole) to (doc_id, hash, blocking, places): n-grams that repeat in their row, all of them where `whole`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("whole").to_numpy(zero_copy_only=False)
            vocabulary, blocks = _blocks(batch.column("words"), n)
            digit = pc.match_substring_regex(vocabulary, "[0-9]").to_numpy(zero_copy_only=False)
            for row, h, parts in blocks:
                at, places = _runs(row, h, parts)
                keep = (places > 1) | whole[row[at]]
                at, places = at[keep], places[keep]
                blocking = digit[parts[:, at]].any(axis=0) if len(at) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row[at])), pa.array(h[at].view(np.int64)), pa.array(blocking), pa.array(places, pa.int64())], ["doc_id", "hash", "blocking", "places"])

    return run


def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash) to one value a batch, eight bytes a hash."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.column("hash").to_numpy(zero_copy_only=False).tobytes()], pa.binary())], ["hashes"])


def bits(count: int, parts: Iterable[bytes]) -> np.ndarray:
    """A filter by hash that lets `count` hashes through, and few others."""
    size = min(MANY_BITS, max(FEW_BITS, 1 << (256 * count).bit_length()))
    out = np.zeros(size >> 3, np.uint8)
    for part in parts:
        h = np.frombuffer(part, np.uint64)
        np.bitwise_or.at(out, _byte(h, out), _bit(h))
    return out


def _byte(h: np.ndarray, out: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(3)) & np.uint64(len(out) - 1)).astype(np.int64)


def _bit(h: np.ndarray) -> np.ndarray:
    return np.left_shift(np.uint8(1), (h & np.uint64(7)).astype(np.uint8))


def wanted(n: int, shared) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, words) to (doc_id, ngram, places): all n-grams that a broadcast filter lets through, as text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter = shared.value
        for batch in batches:
            vocabulary, blocks = _blocks(batch.column("words"), n)
            word = vocabulary.to_pylist()
            for row, h, parts in blocks:
                hit = np.flatnonzero(filter[_byte(h, filter)] & _bit(h))
                row, parts = row[hit], parts[:, hit]
                at, places = _runs(row, h[hit], parts)
                text = [" ".join([word[i] for i in g]) for g in parts[:, at].T.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row[at])), pa.array(text, pa.string()), pa.array(places, pa.int64())], ["doc_id", "ngram", "places"])

    return run
