"""Best-fit-decreasing packing of tokenised documents into sequences.

The packing depends on the pieces' lengths alone, and a length is 1..capacity. So the driver packs the histogram of lengths
(capacity numbers, however many documents): for each length, longest first, a segment tree over the remaining capacities
finds the tightest open bins in logarithmic time, and one step fills all bins of a run with equal remainders at once, to the
same end as one document at a time. A run that takes part is left with less than half its remainder, so there are at most
16 * capacity * log2(capacity) steps. Each step says which pieces of a length, by rank, go to which bins; the pieces' ranks
come from counts by written partition, so no task holds all pieces of a length."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytehash import LONG, LOWER, RangeHash, chunks, mix, words
from .shared import materialize, small, text_blocks, trimmed, utf8_column

#: Runs of which a worker keeps the tokens.
WORDS = 600_000


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_RANGE = RangeHash(41)


class _Words:
    """Token ids of texts, run by run; a run is what stands between spaces and line feeds.

    The tokenizer splits at white space and never joins over it, so a text's ids are those of its runs in order. It also
    lower-cases and splits letters from signs: a run of letters (ASCII, and the Latin-1 ones of two bytes) has the ids of its
    lower-cased letters, and with a full stop or comma behind them also the sign's. Ids are kept by hash of the run beside
    its bytes, which are compared before they are used; only runs that are new to the worker (and those of more than LONG
    bytes, which are not kept) go to the tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.signs = {c: self._one(chr(c)) for c in b".,"}
        self._forget()

    def _one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _forget(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted hashes, and places in first and size
        self.first, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")
        self.length, self.bytes_at, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)  # the runs, in chunks

    def _encode(self, runs: list[str], letters: np.ndarray) -> list[np.ndarray]:
        """Runs of letters alone are a word each, and a word's last token says so: they go as one text."""
        out: list = [None] * len(runs)
        plain = np.flatnonzero(letters).tolist()
        if plain:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([runs[i] for i in plain])], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(plain):
                for i, a, b in zip(plain, [0, *cut[:-1].tolist()], cut.tolist(), strict=True):
                    out[i] = ids[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, found in zip(rest, self.tokenizer.encode_batch_fast([runs[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(found.ids, "<u4")
        return out

    def _add(self, runs: list[bytes], letters: np.ndarray) -> np.ndarray:
        """The slots of runs that are tokenised now; the bytes of long ones are not kept."""
        found = self._encode([x.decode("utf-8", "replace") for x in runs], letters)
        size, slot = np.array([len(x) for x in found], np.int64), len(self.first) + np.arange(len(runs))
        first = len(self.pool) + np.concatenate(([0], np.cumsum(size)[:-1]))
        self.first, self.size, self.pool = np.append(self.first, first), np.append(self.size, size), np.concatenate((self.pool, *found))
        held = [b"" if len(x) > LONG else x + bytes(-len(x) % 8) for x in runs]
        places = np.cumsum([0, *(len(x) // 8 for x in held)])[:-1] + len(self.bytes)
        self.length, self.bytes_at = np.append(self.length, [len(x) for x in runs]), np.append(self.bytes_at, places)
        self.bytes = np.append(self.bytes, np.frombuffer(b"".join(held), "<u8"))
        return slot

    def _learn(self, keys: np.ndarray, runs: list[bytes], letters: np.ndarray) -> None:
        slot = self._add(runs, letters)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slot = np.insert(self.keys, at, keys), np.insert(self.slot, at, slot)

    def _same(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Whether each range has the very bytes of its slot's run."""
        same = end - start == self.length[slot]
        for k, which, x in chunks(data, start, np.where(same, end, start)):
            same[which] &= self.bytes[self.bytes_at[slot[which]] + k] == x
        return same

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, where each text's begin and end) for texts given as bytes and offsets."""
        start, end, row = words((data != 32) & (data != 10), offsets)
        if not len(start):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        if len(self.first) > WORDS or len(self.pool) > 16 * WORDS:
            self._forget()
        # two-byte letters of Latin-1: 0xC3 and 0x80 .. 0xBF but the signs 0x97 and 0xB7
        low = LOWER[data]
        second = np.zeros(len(data), bool)
        second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        upper = second & (data >= 0x80) & (data <= 0x9E)
        low = np.where(upper, data + np.uint8(32), low)
        letter = _LETTER[data] | second
        letter[:-1] |= second[1:]
        other = np.concatenate(([0], np.cumsum(~letter)))
        last = data[end - 1]
        sign = np.where((last == 46) | (last == 44), last, 0)
        sign[end - start < 2] = 0
        stop = end - (sign > 0)
        letters = other[stop] == other[start]
        sign[~letters] = 0
        stop = np.where(letters, stop, end)
        key = np.empty(len(start), np.uint64)
        key[letters] = _RANGE.of(low, start[letters], stop[letters])
        key[~letters] = mix(_RANGE.of(data, start[~letters], stop[~letters]) + np.uint64(1))

        def runs(which: np.ndarray) -> list[bytes]:
            return [(low if ok else data)[a:b].tobytes() for a, b, ok in zip(start[which].tolist(), stop[which].tolist(), letters[which].tolist(), strict=True)]

        slot = np.zeros(len(start), np.int64)
        short = np.flatnonzero(stop - start <= LONG)
        unique, at, inverse = np.unique(key[short], return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        known[place < len(self.keys)] = self.keys[place[place < len(self.keys)]] == unique[place < len(self.keys)]
        if not known.all():
            new = short[at[~known]]
            self._learn(unique[~known], runs(new), letters[new])
            place = np.searchsorted(self.keys, unique)
        slot[short] = self.slot[place][inverse]
        same = stop - start <= LONG
        for of, kind in ((low, letters), (data, ~letters)):
            which = np.flatnonzero(same & kind)
            same[which] = self._same(of, start[which], stop[which], slot[which])
        other_runs = np.flatnonzero(~same)  # long, or another run with the hash of a known one
        if len(other_runs):
            found = runs(other_runs)
            first_of = {x: i for i, x in reversed(list(enumerate(found)))}
            one = np.array(sorted(first_of.values()))
            added = dict(zip(one.tolist(), self._add([found[i] for i in one], letters[other_runs[one]]).tolist(), strict=True))
            slot[other_runs] = [added[first_of[x]] for x in found]
        # each run's ids and then its sign's, taken from the pool with the signs behind it
        pool, more = self.pool, {}
        for c, ids in self.signs.items():
            more[c] = (len(pool), len(ids))
            pool = np.concatenate((pool, ids))
        first, size = np.zeros((len(slot), 2), np.int64), np.zeros((len(slot), 2), np.int64)
        first[:, 0], size[:, 0] = self.first[slot], self.size[slot]
        for c, (a, n) in more.items():
            first[sign == c, 1], size[sign == c, 1] = a, n
        first, size = first.ravel(), size.ravel()
        total = np.concatenate(([0], np.cumsum(size)))
        out = pool[np.repeat(first - total[:-1], size) + np.arange(total[-1])]
        return out, total[2 * np.searchsorted(row, np.arange(len(offsets)))]


_HELD: dict[str, _Words] = {}


def words_of(path: str) -> _Words:
    """One per worker process, for all its tasks."""
    if path not in _HELD:
        _HELD[path] = _Words(path)
    return _HELD[path]


def _tokenised(path: str, capacity: int, end: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        known = words_of(path)
        last = np.array([end], "<u4").tobytes()
        ranks = np.zeros(capacity + 1, np.int64)
        size = 4 * capacity

        def out(rows: list[tuple]) -> pa.RecordBatch:
            doc, piece, start, length, rank, ids = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array([part] * len(rows), pa.int64()), pa.array(rank, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "piece", "start", "length", "part", "rank", "ids"],
            )

        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            docs = batch.column(0).to_pylist()
            for a, b in text_blocks(offsets):
                flat, bounds = known.ids(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                flat, rows = flat.tobytes(), []
                for k, doc in enumerate(docs[a:b]):
                    tokens = flat[4 * bounds[k] : 4 * bounds[k + 1]] + last
                    for piece, at in enumerate(range(0, len(tokens), size)):
                        ids = tokens[at : at + size]
                        n = len(ids) // 4
                        rows.append((doc, piece, at // 4, n, int(ranks[n]), ids))
                        ranks[n] += 1
                yield out(rows)

    return run


class _Tree:
    """Segment tree over remaining capacities: whether a run of bins has that remainder."""

    def __init__(self, size: int):
        self.leaves = 1 << (size - 1).bit_length()
        self.any = bytearray(2 * self.leaves)

    def put(self, at: int, value: bool) -> None:
        at += self.leaves
        self.any[at] = value
        at >>= 1
        while at:
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]
            at >>= 1

    def tightest(self, least: int) -> int:
        """The smallest remainder of at least `least` that is there, or -1."""
        at = least + self.leaves
        if self.any[at]:
            return least
        while at > 1:
            if not at & 1 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Steps (length, first rank, pieces, pieces a bin, first bin, offset in the bin) that pack counts[length] pieces.

    Piece number i of a step goes to bin first + i // a, at offset + (i % a) * length."""
    tree, runs = _Tree(capacity + 1), [[] for _ in range(capacity + 1)]  # runs[remainder]: (first bin, bins)
    steps, bins = [], 0

    def add(remainder: int, first: int, n: int) -> None:
        if n and remainder:
            runs[remainder].append((first, n))
            tree.put(remainder, True)

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left, rank = counts[length], 0
        while left:
            remainder = tree.tightest(length)
            if remainder < 0:
                fit = capacity // length
                n = -(-left // fit)
                first, remainder = bins, capacity
                bins += n
            else:
                first, n = runs[remainder].pop()
                if not runs[remainder]:
                    tree.put(remainder, False)
                fit = remainder // length
            full = min(n, left // fit)
            if full:
                steps.append((length, rank, full * fit, fit, first, capacity - remainder))
                rank, left = rank + full * fit, left - full * fit
                add(remainder - fit * length, first, full)
            if left and full < n:  # fewer than fill a bin
                steps.append((length, rank, left, left, first + full, capacity - remainder))
                add(remainder - left * length, first + full, 1)
                full, left = full + 1, 0
            if full < n and remainder < capacity:
                add(remainder, first + full, n - full)
    return steps


def _slots(steps: np.ndarray) -> Callable:
    """(part, length, ranks from .. to) of one partition's pieces of a length, with where they go."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length, first = steps[:, 0], steps[:, 1]
        for pdf in batches:
            out = []
            for part, size, base, n in zip(*(pdf[c].to_numpy() for c in ("part", "length", "base", "n")), strict=True):
                lo, hi = np.searchsorted(length, [size, size + 1])
                k = lo + int(np.searchsorted(first[lo:hi], base, "right")) - 1
                while k < hi and first[k] < base + n:
                    a, b = max(base, first[k]), min(base + n, first[k] + steps[k, 2])
                    out.append((part, size, a - base, b - base, base - first[k], *steps[k, 3:6]))
                    k += 1
            yield pd.DataFrame(out, columns=["part", "length", "lo", "hi", "skip", "each", "bin", "at"], dtype="int64")

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) of every piece of every document.

    A document is its tokens (file `tokenizer`, no special tokens) and then the id `end`; only one longer than capacity is
    cut, into pieces of capacity tokens and a last shorter one. ids is binary: little-endian unsigned 32-bit ids. Null text
    counts as empty: one piece of the id `end`. A null id stays null, and rows that repeat an id are packed each. An empty
    table gives an empty result; further columns are not looked at. The tokenizer's file must be there on every machine."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, part long, rank long, ids binary"
    pieces = materialize(texts.mapInArrow(trimmed(_tokenised(tokenizer, capacity, end)), schema), "pieces")
    counts = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    steps = np.array(sorted(best_fit_decreasing(histogram, capacity)), np.int64).reshape(-1, 6)
    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = counts.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0)))
    slots = materialize(based.mapInPandas(_slots(steps), "part long, length long, lo long, hi long, skip long, each long, bin long, at long"), "slots")
    s = small(slots, 500_000).alias("s")
    here = (F.col("p.part") == F.col("s.part")) & (F.col("p.length") == F.col("s.length")) & (F.col("p.rank") >= F.col("s.lo")) & (F.col("p.rank") < F.col("s.hi"))
    nth = F.col("p.rank") + F.col("s.skip")
    return pieces.alias("p").join(s, here).select(
        "p.doc_id", "p.piece", "p.start", "p.length", "p.ids",
        (F.col("s.bin") + F.floor(nth / F.col("s.each"))).cast("long").alias("sequence_id"),
        (F.col("s.at") + (nth % F.col("s.each")) * F.col("p.length")).cast("long").alias("offset"),
    )
