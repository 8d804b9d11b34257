"""Benchmark decontamination: a BM25 index of the test items, queried by every passage of every document.

A passage is a run of 2 * stride words, a new one every stride words, and stride is at least the longest item's length, so an
item that a document holds lies within one passage. An item is a question and, where the benchmark has a column of answers,
an answer; both must be found. The index holds the items as documents (their impacts are BM25 term
scores) in blocks of BLOCK items with each term's largest impact in each block. For a passage the block maxima of its
distinct terms are added up, and only blocks whose sum reaches the threshold are scored (block-max WAND, for a block of
passages at once). A found item's word shingles are then compared with the passage's, for its question and its answer.

The score threshold loses nothing: a part of S shingles of which a share v is in the passage lacks at most
floor((1 - v) S) words, as each missing word takes a shingle of its own with it. An item's score is its own full score less at
most as many of its largest impacts as its question and answer may lack, and that is its threshold."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import ALNUM, RangeHash, mix, words
from .shared import text_blocks, trimmed, utf8_column

K1, B = 1.2, 0.75
BLOCK = 8
#: Items of one index, and indexes that one scan of the documents searches.
ITEMS, INDEXES = 4096, 8
SHINGLE, SHARE = 5, 0.8

_HASH = RangeHash(21)
_OUT = "doc_id long, item_id long, passage long, score double, overlap double, question_overlap double, answer_overlap double"


def _lowered(column: pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.utf8_lower(column.cast(pa.string()).fill_null(""))


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, word hashes, row of each) of blocks of texts; words are runs of letters and digits, lower-cased."""
    data, offsets = utf8_column(_lowered(column))
    for a, b in text_blocks(offsets):
        block, rows = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        start, end, row = words(ALNUM[block], rows)
        yield a, b - a, _HASH.of(block, start, end), row


def _shingles(h: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hash of the n words from each word; of fewer words, of all of them."""
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)]
    return mix(out + np.uint64(n))


@dataclass
class Index:
    ids: np.ndarray
    question: list[tuple[int, np.ndarray]]  # of each item the words of a shingle and the distinct shingles
    answer: list[tuple[int, np.ndarray]]
    whole: list[tuple[int, np.ndarray]]
    terms: np.ndarray  # sorted hashes
    first: np.ndarray  # of each term, of its postings
    item: np.ndarray
    impact: np.ndarray  # as shares of the item's threshold: 1 or more in sum is a hit
    bounds: np.ndarray  # terms x blocks
    longest: int


def build(items: list[tuple[int, list[np.ndarray], np.ndarray]], share: float = SHARE) -> Index:
    """Index of (id, [question words, answer words], all words), each as hashes."""
    n = len(items)
    terms, inverse, postings = np.unique(np.concatenate([x[2] for x in items])), [], []
    df = np.zeros(len(terms))
    mean = sum(len(x[2]) for x in items) / n
    for _, _, h in items:
        t, tf = np.unique(np.searchsorted(terms, h), return_counts=True)
        df[t] += 1
        inverse.append((t, tf))
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    whole = [_part(h) for _, _, h in items]
    parts = [[_part(p) for p in x[1]] for x in items]
    for i, (t, tf) in enumerate(inverse):
        impact = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(items[i][2]) / mean))
        lacking = sum(int((1 - share) * len(p[1]) + 1e-9) for p in parts[i])
        least = impact.sum() - np.sort(impact)[::-1][:lacking].sum()
        postings.append(np.stack([t, np.full(len(t), i), impact / max(least * (1 - 1e-9), 1e-12)], axis=1))
    every = np.concatenate(postings)
    every = every[np.argsort(every[:, 0], kind="stable")]
    term, item = every[:, 0].astype(np.int64), every[:, 1].astype(np.int64)
    blocks = min(64, -(-n // BLOCK))
    width = -(-n // blocks)
    bounds = np.zeros((len(terms), blocks), np.float32)
    np.maximum.at(bounds, (term, item // width), np.nextafter(every[:, 2].astype(np.float32), np.float32(np.inf)))
    return Index(np.array([x[0] for x in items]), [p[0] for p in parts], [p[1] for p in parts], whole, terms, np.searchsorted(term, np.arange(len(terms) + 1)), item, every[:, 2], bounds, max(len(x[2]) for x in items))


def _part(h: np.ndarray) -> tuple[int, np.ndarray]:
    return min(SHINGLE, len(h)), np.unique(_shingles(h))


def _share(part: tuple[int, np.ndarray], passage: np.ndarray) -> float:
    """Of a part's shingles, the share that the passage's words have."""
    n, shingles = part
    return float(np.isin(shingles, _shingles(passage, n)).mean()) if n else 1.0


def _search(held, share: float) -> Callable:
    def block(index: Index, stride: int, a: int, h: np.ndarray, row: np.ndarray, ids: list) -> Iterator[tuple]:
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        size = np.diff(np.append(first, len(row)))
        cells = -(-size // stride)  # of each text that has words
        text = np.repeat(np.arange(len(first)), size)
        cell = (np.arange(len(row)) - first[text]) // stride
        base = np.concatenate(([0], np.cumsum(np.maximum(cells - 1, 1))))  # passages: cells j and j + 1
        term = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
        known = np.flatnonzero(index.terms[term] == h)
        term, cell, text = term[known], cell[known], text[known]
        last = np.maximum(cells[text] - 2, 0)
        one = base[text] + np.minimum(cell, last)
        both = (cell >= 1) & (cell <= last)
        pairs = np.unique(np.concatenate((one * len(index.terms) + term, (one[both] - 1) * len(index.terms) + term[both])))
        if not len(pairs):
            return
        passage, term = pairs // len(index.terms), pairs % len(index.terms)
        starts = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
        ends = np.append(starts[1:], len(passage))
        bound = np.add.reduceat(index.bounds[term], starts, axis=0)
        for k in np.flatnonzero((bound >= 0.999).any(axis=1)):
            own = term[starts[k] : ends[k]]
            n = index.first[own + 1] - index.first[own]
            at = np.repeat(index.first[own] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            score = np.bincount(index.item[at], index.impact[at], len(index.ids))
            hits = np.flatnonzero(score >= 1)
            if not len(hits):
                continue
            p = int(passage[starts[k]])
            t = int(np.searchsorted(base, p, "right")) - 1
            nth = p - int(base[t])
            lo = int(first[t]) + nth * stride
            here = h[lo : min(lo + 2 * stride, int(first[t] + size[t]))]
            for i in hits.tolist():
                question, answer = _share(index.question[i], here), _share(index.answer[i], here)
                if question >= share and answer >= share:
                    yield ids[a + int(row[first[t]])], int(index.ids[i]), nth, float(score[i]), _share(index.whole[i], here), question, answer if index.answer[i][0] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = [r for a, _, h, row in _words(batch.column(1)) if len(h) for index, stride in held.value for r in block(index, stride, a, h, row, ids)]
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = [pa.int64()] * 3 + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "passage", "score", "overlap", "question_overlap", "answer_overlap"])

    return run


def _items(benchmark: DataFrame, id_col: str, text_col: str, answer_col: str | None) -> list[tuple[int, list[np.ndarray], np.ndarray]]:
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), (F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")).alias("answer"))
    found = rows.filter("id is not null").distinct().orderBy("id", "text", "answer").toArrow()

    def hashes(column: pa.ChunkedArray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for _, n, h, row in _words(column):
            cut = np.searchsorted(row, np.arange(n + 1))
            out += [h[cut[i] : cut[i + 1]] for i in range(n)]
        return out

    out = []
    for i, q, a in zip(found.column("id").to_pylist(), hashes(found.column("text")), hashes(found.column("answer")), strict=True):
        if len(q) + len(a):
            out.append((i, [q, a], np.concatenate((q, a))))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, passage, score, overlap, question_overlap, answer_overlap) of each document and item that it holds.

    A document holds an item if some passage has at least `share` of the distinct five-word shingles of its question, and of
    its answer if there is an answer_col (an answer of fewer words is one shingle); without one an item is a question alone
    and answer_overlap is null. The row is that of the best passage; overlap is that of question and answer together. Items
    without words or with a null id take no part; an item id with several texts is several items. Null or empty texts hold
    nothing; rows with a null id are found as such; rows that repeat an id give one row together. Empty tables give an empty
    result; further columns are not looked at. The benchmark is held on the driver; a scan of the documents searches
    ITEMS * INDEXES items."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = _items(benchmark, item_col, item_text, answer_col)
    indexes = [build(items[at : at + ITEMS], share) for at in range(0, len(items), ITEMS)]
    out = spark.createDataFrame([], _OUT)
    for at in range(0, len(indexes), INDEXES):
        held = spark.sparkContext.broadcast([(index, max(64, index.longest)) for index in indexes[at : at + INDEXES]])
        found = texts.mapInArrow(trimmed(_search(held, share)), _OUT)
        out = found if at == 0 else out.union(found)
    best = F.max_by(F.struct("passage", "score", "overlap", "question_overlap", "answer_overlap"), F.struct("overlap", "score", -F.col("passage"))).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")
