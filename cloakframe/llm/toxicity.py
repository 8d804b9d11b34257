"""Toxicity by a chain of linear classifiers.

The categories stand in a fixed order. The classifier of a category sees the text's terms and the probabilities of the
earlier categories; in training these are out-of-fold predictions (of models that did not see the row), so a later model
learns to weigh them as they are on new texts. Terms are words, their prefixes of PREFIXES bytes and runs of other signs,
lower-cased; each counts once a text. The chain is fitted on the driver on at most SAMPLE labelled rows (as many of each
combination of labels, in order of a hash of the id) and TERMS terms a category."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytehash import ALNUM, SPACE, RangeHash, mix, words
from .shared import text_blocks, trimmed, utf8_column

SAMPLE, TERMS, FOLDS = 4000, 768, 4
#: Least association (in standard deviations) of a term with a category.
LEAST_Z = 5.0
PREFIXES = (6, 7, 8)
RIDGE, STEPS = 3e-4, 300
_HASH = RangeHash(31)


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, term hashes, row of each) of blocks of texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offsets = utf8_column(pc.utf8_lower(column.cast(pa.string()).fill_null("")))
    for a, b in text_blocks(offsets):
        block, rows = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        start, end, row = words(ALNUM[block], rows)
        out, at = [_HASH.of(block, start, end)], [row]
        for n in PREFIXES:
            long = end - start > n
            out.append(mix(_HASH.of(block, start[long], start[long] + n) + np.uint64(n)))
            at.append(row[long])
        start, end, row = words(~ALNUM[block] & ~SPACE[block], rows)
        out.append(_HASH.of(block, start, end))
        at.append(row)
        yield a, b - a, np.concatenate(out), np.concatenate(at)


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression, by accelerated gradient steps.

    Both classes weigh the same, so a rare category is not drowned."""
    n, d = x.shape
    w = np.zeros(d + 1, np.float32)
    each = np.where(y > 0, 0.5 / max(float(y.mean()), 1 / n), 0.5 / max(float(1 - y.mean()), 1 / n)).astype(np.float32)
    step = 4.0 / (float((x * x).sum(axis=1).mean()) + 1)
    ahead, t = w.copy(), 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead[:-1] + ahead[-1], -30, 30)))
        error = (p - y) * each
        g = np.append(x.T @ error / n + RIDGE * ahead[:-1], error.mean()).astype(np.float32)
        new = ahead - np.float32(step) * g
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + np.float32((before - 1) / t) * (new - w), new
    return w


def _chance(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class Chain:
    categories: list[str]
    terms: np.ndarray  # sorted hashes
    weights: np.ndarray  # terms x categories
    links: np.ndarray  # categories x categories: of the earlier probabilities
    bias: np.ndarray

    def predict(self, column: pa.Array) -> np.ndarray:
        """Of each text the probability of each category."""
        n = len(column)
        total = np.zeros((n, len(self.categories)))
        for a, b, h, row in _terms(column):
            if not len(h) or not len(self.terms):
                continue
            at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
            known = self.terms[at] == h
            both = np.unique(row[known] * len(self.terms) + at[known])
            where, term = both // len(self.terms), both % len(self.terms)
            for k in range(len(self.categories)):
                total[a : a + b, k] += np.bincount(where, self.weights[term, k], b)
        out = np.zeros_like(total)
        for k in range(len(self.categories)):
            z = total[:, k] + out[:, :k] @ self.links[k, :k] + self.bias[k]
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def train(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text") -> Chain | None:
    """A chain from texts and labels (by id, a 0/1 column for each category, in this order); None without labelled texts.

    Rows with a null id, label or text are left out; a category is set for an id if any of its rows sets it. The sample is
    drawn from the labels alone, so SAMPLE ids at most go to the texts."""
    names = [f"c{i}" for i in range(len(categories))]
    marks = [(F.col(c).cast("int") > 0).cast("int").alias(n) for c, n in zip(categories, names, strict=True)]
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), *marks).dropna().groupBy("doc_id").agg(*[F.max(n).alias(n) for n in names])
    known = known.withColumn("_h", F.xxhash64("doc_id"))
    counts = known.groupBy(*names).agg(F.count("*").alias("n")).collect()  # a row a combination of labels
    sizes = len(counts)
    if not sizes:
        return None
    # a large combination is first thinned by hash to about three times its part, so no task sorts all of it
    keep = F.lit(True)
    for r in counts:
        own = F.lit(True)
        for name in names:
            own = own & (F.col(name) == r[name])
        keep = F.when(own, F.pmod("_h", F.lit(max(1, r["n"] * sizes // (3 * SAMPLE)))) == 0).otherwise(keep)
    known = known.filter(keep)
    nth = F.row_number().over(Window.partitionBy(*names).orderBy("_h", "doc_id"))
    sample = known.withColumn("_n", nth).filter(F.col("_n") <= SAMPLE // sizes).select("doc_id", "_h", *names)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    got = texts.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]).orderBy("_h", "doc_id").select("text", *names).toArrow()
    if not got.num_rows:
        return None
    y = np.stack([np.asarray(got.column(c)) for c in names], axis=1).astype(np.float32)
    n = len(y)
    pairs = [(a + row, h) for a, _, h, row in _terms(got.column("text"))]
    doc, h = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    vocabulary, term = np.unique(h, return_inverse=True)
    both = np.unique(doc.astype(np.int64) * max(1, len(vocabulary)) + term)
    doc, term = both // max(1, len(vocabulary)), both % max(1, len(vocabulary))
    df = np.bincount(term, minlength=len(vocabulary))
    chosen: set[int] = set()
    for k in range(len(categories)):
        inside = np.bincount(term, y[doc, k], len(vocabulary))
        rate = y[:, k].mean()
        z = np.abs(inside - df * rate) / np.sqrt(df * rate * (1 - rate) + 1)
        z[df < 4] = 0
        chosen |= set(np.argsort(-z, kind="stable")[:TERMS][np.sort(-z, kind="stable")[:TERMS] < -LEAST_Z].tolist())
    pick = np.array(sorted(chosen), np.int64)
    x = np.zeros((n, len(pick)), np.float32)
    if len(pick):
        at = np.minimum(np.searchsorted(pick, term), len(pick) - 1)
        ok = pick[at] == term
        x[doc[ok], at[ok]] = 1
    fold = np.arange(n) % FOLDS
    weights, links, bias = np.zeros((len(pick), len(categories))), np.zeros((len(categories),) * 2), np.zeros(len(categories))
    earlier = np.zeros((n, 0), np.float32)  # out-of-fold probabilities
    for k in range(len(categories)):
        seen = np.concatenate((x, earlier), axis=1)
        held = np.zeros(n, np.float32)
        for f in range(FOLDS if k + 1 < len(categories) else 0):
            out = fold == f
            if out.any() and (~out).any():
                held[out] = _chance(seen[out], _fit(seen[~out], y[~out, k]))
        w = _fit(seen, y[:, k])
        weights[:, k], links[k, :k], bias[k] = w[: len(pick)], w[len(pick) : -1], w[-1]
        earlier = np.concatenate((earlier, held[:, None]), axis=1)
    return Chain(categories, vocabulary[pick] if len(pick) else np.zeros(0, np.uint64), weights, links, bias)


def _predict(held) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = held.value.predict(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.ascontiguousarray(c)) for c in p.T]], ["doc_id", *held.value.categories])

    return run


def score(docs: DataFrame, chain: Chain | None, categories: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the probability of each category, of every row.

    Null and empty texts have no terms and get the probabilities of such a text. Without a chain (no labelled rows) all
    probabilities are null. Ids may be null or repeat; an empty table gives an empty result; further columns are not looked
    at. Equal texts get equal results."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if chain is None:
        return texts.select("doc_id", *[F.lit(None).cast("double").alias(c) for c in categories])
    held = docs.sparkSession.sparkContext.broadcast(chain)  # TERMS a category at most
    return texts.mapInArrow(trimmed(_predict(held)), "doc_id long, " + ", ".join(f"`{c}` double" for c in categories))
