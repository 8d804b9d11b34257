"""Removal of repeated byte strings: a suffix array sorted no deeper than the threshold.

A suffix of depth `window` is a window of that many bytes; groups of equal windows are exactly the repeats. The windows are
radix-sorted by most-significant-digit passes, and a pass only hands on what is still in a group of several:

1. Digit one is the synchronising gram of a window: its smallest-hashed GRAM-byte string. Equal windows have equal grams at
   equal places, and neighbouring windows share theirs, so one row (an anchor) stands for a run of windows and the pass
   shuffles about 2 / (window - GRAM + 2) rows a byte instead of one. Digit two is the context, all bytes that the windows
   of the run cover. Anchors equal in both digits are equal windows throughout: all but the first are repeats.
2. Where a gram has several contexts, the windows of the first anchor of each context are written out, and the last digit
   is the whole window (96 bits of hash).

A context's and a window's hash chains the hashes of its 32-byte strings through a non-linear mixing; two different contexts
are taken for one only if that hash and the gram's agree (128 bits).

Rows of a very frequent string: within a batch of documents only the first anchor (window) of each digit goes into the
shuffle by digit; the later ones are known to be repeats and are spread evenly. Grams that are frequent over all documents
are counted first (a table of bounded size that decides on cost alone): their anchors are dealt by both digits at once, and
their windows all go on to the last digit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytehash import as_long, mix
from .shared import NULL_ID, materialize, small, text_blocks, trimmed, utf8_column

GRAM = 52
#: Bytes of one document that are worked on at once; longer documents go in pieces that overlap by a window.
PIECE = 1 << 20

#: The table of frequent grams: at most so many, each counted this often in one batch and in all.
FREQUENT, IN_BATCH, IN_ALL = 1 << 16, 8, 4096

# run is start << 16 | windows; kind is 1 for a repeat within the batch, 2 for a frequent gram
_ANCHORS = "kg long, ctx long, doc long, part long, run long, kind byte"
_WINDOWS = "h1 long, h2 int, doc long, part long, run long, kind byte"


_DRAW = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_TABLE = np.random.Generator(np.random.PCG64(8)).integers(0, 2**64, 256, dtype=np.uint64)
_WIDEST = 32


def _levels(data: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the 1, 2, 4 .. 32 bytes from each place, by doubling."""
    out, span = {1: _TABLE[data]}, 1
    while span < _WIDEST:
        h = out[span]
        both = h[:-span] * _DRAW[span.bit_length()] + h[span:]
        out[2 * span] = mix(both) if span in (2, 8, 16) else both
        span *= 2
    return out


def _strings(levels: dict[int, np.ndarray], at: np.ndarray | None, size: int, key: int) -> np.ndarray:
    """Hash of the `size` bytes from each place in `at` (None: from every place), by 32 bytes and the rest in powers of two."""
    places = len(levels[1]) - size + 1
    out, done = np.full(places if at is None else len(at), _DRAW[key], np.uint64), 0
    while done < size:
        span = min(_WIDEST, 1 << ((size - done).bit_length() - 1))
        h = levels[span]
        out = mix((out + _DRAW[key + 1]) ^ (h[done : done + places] if at is None else h[at + done]))
        done += span
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _runs(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(gram, context, row, start in data, windows) of each anchor of a block of whole rows."""
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    levels = _levels(data)
    grams = _strings(levels, None, GRAM, 40)
    place = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64(24)
    at = _sliding_min(((grams >> low) << low) | place, window - GRAM + 1) & np.uint64((1 << 24) - 1)
    at = at.astype(np.int64)
    lengths = np.diff(offsets)
    ends = np.repeat(offsets[1:], lengths)[: len(at)]
    start = np.flatnonzero(np.arange(len(at)) + window <= ends)
    if not len(start):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    at = at[start]
    new = np.empty(len(start), bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    lo, anchor = start[first], at[first]
    # a run of fewer windows than bytes in one: its first and last window have all its bytes
    ctx = mix(_strings(levels, lo, window, 42) + count.astype(np.uint64)) ^ _strings(levels, lo + count - 1, window, 44)
    ctx = mix(ctx + (anchor - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return grams[anchor], ctx, np.searchsorted(offsets, lo, "right") - 1, lo, count


def _pieces(data: np.ndarray, offsets: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, place in its row, bytes, offsets): blocks of whole rows, and overlapping pieces of long ones."""
    for a, b in text_blocks(offsets, PIECE):
        lo, hi = int(offsets[a]), int(offsets[b])
        if b == a + 1 and hi - lo > PIECE:
            for at in range(0, hi - lo - window + 1, PIECE):
                end = min(hi, lo + at + PIECE + window - 1)
                yield a, at, data[lo + at : end], np.array([0, end - lo - at], np.int64)
        else:
            yield a, 0, data[lo:hi], offsets[a : b + 1] - lo


def _later(keys: list[np.ndarray], place: list[np.ndarray]) -> np.ndarray:
    """Whether an equal key stands at a smaller place (document, part, start)."""
    out = np.zeros(len(place[0]), bool)
    both = mix(keys[0]) ^ keys[1]
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    several = np.zeros(len(out), bool)
    several[1:] |= same
    several[:-1] |= same
    rows = order[several]
    if len(rows):
        rows = rows[np.lexsort((*(p[rows] for p in reversed(place)), keys[1][rows], keys[0][rows]))]
        begins = np.ones(len(rows), bool)
        begins[1:] = (keys[0][rows[1:]] != keys[0][rows[:-1]]) | (keys[1][rows[1:]] != keys[1][rows[:-1]])
        first = rows[np.maximum.accumulate(np.where(begins, np.arange(len(rows)), 0))]
        out[rows] = np.any([p[rows] != p[first] for p in place], axis=0)
    return out


def _batch(keys: list[np.ndarray], place: list[np.ndarray], count: np.ndarray, hot: np.ndarray, names: str) -> pa.RecordBatch:
    doc, part, start = place
    dup = _later(keys, place)
    spread = mix(doc.view(np.uint64) * np.uint64(31) + start.view(np.uint64) + part.view(np.uint64))
    first = np.where(dup, spread, np.where(hot, mix(keys[0] ^ mix(keys[1].astype(np.uint64))), keys[0]))
    second = keys[1].view(np.int32) if keys[1].dtype == np.uint32 else as_long(keys[1])
    columns = [as_long(first), second, doc, part, start << 16 | count, (dup + 2 * hot).astype(np.int8)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in names.split(", ")])


def _frequent_grams(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_column(batch.column(0))
            found = [_runs(block, rows, window)[0] for _, _, block, rows in _pieces(data, offsets, window)]
            gram, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(as_long(gram[n >= IN_BATCH])), pa.array(n[n >= IN_BATCH])], ["kg", "n"])

    return run


def frequent_grams(texts: DataFrame, window: int) -> np.ndarray:
    """The sorted hashes of the most frequent synchronising grams of texts (text)."""
    counted = texts.select("text").mapInArrow(trimmed(_frequent_grams(window)), "kg long, n long").groupBy("kg").agg(F.sum("n").alias("n"))
    top = counted.filter(F.col("n") >= IN_ALL).orderBy(F.desc("n"), "kg").limit(FREQUENT).toArrow()
    return np.sort(np.asarray(top.column("kg"), np.int64).view(np.uint64))


def _anchors(window: int, frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, part_of = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            data, offsets = utf8_column(batch.column(2))
            parts = []
            for a, at, block, rows in _pieces(data, offsets, window):
                kg, ctx, row, lo, count = _runs(block, rows, window)
                parts.append((kg, ctx, ids[a + row], part_of[a + row], lo - rows[row] + at, count))
            if parts:
                kg, ctx, doc, part, start, count = (np.concatenate(x) for x in zip(*parts, strict=True))
                hot = np.isin(kg, frequent) if len(frequent) else np.zeros(len(kg), bool)
                yield _batch([kg, ctx], [doc, part, start], count, hot, _ANCHORS)

    return run


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, part_of = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            data, offsets = utf8_column(batch.column(2))
            flagged = batch.column(3)
            bounds, coded = np.asarray(flagged.offsets), np.asarray(flagged.values)
            parts: list[tuple[np.ndarray, ...]] = []
            size = 0
            for i in range(len(ids)):
                runs = coded[bounds[i] : bounds[i + 1]]
                lo, n = runs >> 16, runs & 65535
                levels = _levels(data[offsets[i] : offsets[i + 1]])
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                at = at[at + window <= offsets[i + 1] - offsets[i]]
                h1, h2 = _strings(levels, at, window, 46), (_strings(levels, at, window, 48) >> np.uint64(32)).astype(np.uint32)
                parts.append((h1, h2, np.full(len(at), ids[i]), np.full(len(at), part_of[i]), at))
                size += len(at)
                if size > 1 << 20 or i == len(ids) - 1:
                    h1, h2, doc, part, start = (np.concatenate(x) for x in zip(*parts, strict=True))
                    yield _batch([h1, h2], [doc, part, start], np.ones(len(doc), np.int64), np.zeros(len(doc), bool), _WINDOWS)
                    parts, size = [], 0

    return run


def _cut(window: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            marked = batch.column(2)
            bounds, coded = np.asarray(marked.offsets), np.asarray(marked.values)
            has = np.asarray(marked.is_valid())
            kept, spans = [], []
            for i in range(len(has)):
                text = data[offsets[i] : offsets[i + 1]]
                runs = coded[bounds[i] : bounds[i + 1]] if has[i] else coded[:0]
                if not len(runs):
                    kept.append(text.tobytes())
                    spans.append([])
                    continue
                runs = np.sort(runs)
                lo, end = runs >> 16, (runs >> 16) + (runs & 65535) - 1 + window
                reach = np.maximum.accumulate(end)
                new = np.flatnonzero(np.concatenate(([True], lo[1:] > reach[:-1])))
                lo, end = lo[new], reach[np.append(new[1:] - 1, len(reach) - 1)]
                out, at = [], 0
                for s, e in zip(lo.tolist(), end.tolist(), strict=True):
                    out.append(text[at:s].tobytes())
                    at = e
                out.append(text[at:].tobytes())
                kept.append(b"".join(out))
                spans.append([{"start": s, "end": e} for s, e in zip(lo.tolist(), end.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(kept, pa.binary()), pa.array(spans, kind)], ["doc_id", "n_bytes", "kept", "spans"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 100) -> DataFrame:
    """Cut every byte that a `window`-byte string covers which also starts earlier in the corpus.

    Earlier is a smaller id, or the same document and an earlier start; strings are judged on the input. Returns doc_id,
    n_bytes, kept (binary: a cut may fall inside a character) and spans (the maximal cut runs, half-open byte ranges).
    Null or empty text: no bytes, no spans. A null id stands before all others. Rows that repeat an id with the same text
    are one document and all get its result; rows that repeat an id with other texts are documents of their own, in order of
    xxhash64 of the text. An empty table gives an empty result; further columns are not looked at."""
    if window < GRAM or window > 4096:
        raise ValueError(f"window must be in {GRAM}..4096")
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), F.col(text_col).cast("string").alias("text"))
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    same_id = texts.select("doc", digest.alias("d")).groupBy("doc").agg(F.min("d").alias("a"), F.max("d").alias("b")).filter("a <> b").select("doc", F.lit(True).alias("several"))
    same_id = materialize(same_id, "repeated-ids")
    if same_id.isEmpty():
        keyed = texts.select("doc", F.lit(0).cast("long").alias("part"), "text")
    else:
        keyed = texts.join(small(same_id), "doc", "left").select("doc", F.when(F.col("several"), digest).otherwise(0).alias("part"), "text")
    own = ["doc", "part"]

    anchors = keyed.mapInArrow(trimmed(_anchors(window, frequent_grams(texts, window))), _ANCHORS)
    sort = Window.partitionBy("kg").orderBy("ctx", *own, "run")
    whole = sort.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.lag(F.struct("ctx", *own, F.shiftright("run", 16).alias("start"))).over(sort)
    placed = anchors.select(*own, "run", "kind", "ctx", before.alias("p"), (F.first("ctx").over(whole) != F.last("ctx").over(whole)).alias("several"))
    # the same place of the same document (a repeated row) is no repeat of itself
    itself = (F.col("p.doc") == F.col("doc")) & (F.col("p.part") == F.col("part")) & (F.col("p.start") == F.shiftright("run", 16))
    repeat = F.coalesce((F.col("kind").bitwiseAND(1) > 0) | ((F.col("p.ctx") == F.col("ctx")) & ~itself), F.lit(False))
    placed = placed.select(*own, "run", repeat.alias("repeat"), (F.col("several") | (F.col("kind") >= 2)).alias("mixed"))
    digits = materialize(placed.filter("repeat or mixed").select(*own, "run", "repeat"), "repeats-1")

    open_runs = digits.filter("not repeat").groupBy(*own).agg(F.collect_list("run").alias("runs"))
    windows = keyed.join(open_runs, own).select(*own, "text", "runs").mapInArrow(trimmed(_windows(window)), _WINDOWS)
    sort = Window.partitionBy("h1", "h2").orderBy(*own, "run")
    later = windows.select(*own, "run", "kind", F.first(F.struct(*own, "run")).over(sort).alias("f"))
    later = later.filter("kind = 1 or f.doc <> doc or f.part <> part or f.run <> run")
    marks = materialize(digits.filter("repeat").select(*own, "run").union(later.select(*own, "run")), "repeats-2")

    cut = keyed.join(marks.groupBy(*own).agg(F.collect_list("run").alias("runs")), own, "left").select("doc", "text", "runs")
    out = cut.mapInArrow(trimmed(_cut(window)), "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))
