"""Language identification by error-correcting output codes.

Every language gets a codeword; one binary n-gram classifier predicts each bit (a naive Bayes log ratio between the
languages with that bit set and the others, all languages weighing the same). A bit's margin costs log(1 + exp(-margin)) if
the codeword wants it positive, log(1 + exp(margin)) otherwise, times the bit's weight; the codeword with the least total
loss is chosen, and a text whose second choice costs nearly as little is flagged as ambiguous.

Training counts n-grams over all labelled rows that may be learned from, summed by language and n-gram before they come to
the driver: languages * 2**DIM_BITS numbers at most. The bits' weights are their accuracies on about WEIGH_ROWS rows, picked by hash (twice as many at most)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytehash import ALNUM, LOWER
from .shared import give_back, text_blocks, trimmed, utf8_column

DIM_BITS = 15
#: Lengths of the n-grams, in bytes.
GRAMS = (2, 3)
#: A margin grows with this many n-grams at most: a long text is not endlessly sure.
EVIDENCE = 40.0
#: A text is ambiguous if its second choice's probability comes within this ratio of the first's.
AMBIGUOUS = 0.9
WEIGH_ROWS = 2000
UNKNOWN = "und"

_LETTER = ALNUM.copy()
_LETTER[48:58] = False
_CLEAN = np.where(_LETTER, LOWER, 32).astype(np.uint8)


def _grams(block: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature, whether it counts) at each byte, of each length; n-grams of blanks alone or over a row's end don't."""
    x = _CLEAN[block].astype(np.uint32)
    ends = np.repeat(rows[1:], np.diff(rows))
    place = np.arange(len(x))
    for n in GRAMS:
        if len(x) < n:
            continue
        m = len(x) - n + 1
        code = np.zeros(m, np.uint32)
        letters = np.zeros(m, bool)
        for k in range(n):
            code = code * np.uint32(0x01000193) + x[k : k + m] + np.uint32(n)
            letters |= x[k : k + m] != 32
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x9E3779B1)
        yield code >> np.uint32(32 - DIM_BITS), letters & (place[:m] + n <= ends[:m])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = utf8_column(batch.column(0))
        langs = batch.column(1).to_pylist()
        for a, b in text_blocks(offsets):
            lo = offsets[a]
            block, rows = data[lo : offsets[b]], offsets[a : b + 1] - lo
            names, code = np.unique(np.array(langs[a:b], dtype=object).astype(str), return_inverse=True)
            of = np.repeat(code, np.diff(rows))
            for feature, ok in _grams(block, rows):
                both = np.bincount((of[: len(feature)][ok].astype(np.int64) << DIM_BITS) | feature[ok], minlength=len(names) << DIM_BITS)
                for name, c in zip(names.tolist(), both.reshape(len(names), -1), strict=True):
                    total[name] = total.get(name, 0) + c
    for name, c in total.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.int64))], ["lang", "feature", "n"])


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language: all splits of up to 6 languages, else random words kept far apart."""
    if languages <= 1:
        return np.ones((max(languages, 1), 1), np.int8)
    if languages <= 6:
        splits = np.arange(1, 1 << (languages - 1))  # the first language's bit is always set
        bits = np.array([[1 if i == 0 else (0 if s >> (i - 1) & 1 else 1) for s in splits] for i in range(languages)], np.int8)
        return 2 * bits - 1
    rng, length, best, far = np.random.Generator(np.random.PCG64(5)), int(np.ceil(10 * np.log2(languages))), None, -1
    for _ in range(200):
        words = rng.integers(0, 2, (languages, length)).astype(np.int8) * 2 - 1
        if (abs(words.sum(axis=0)) == languages).any():
            continue
        apart = (length - words.astype(int) @ words.T) // 2
        least = int(apart[~np.eye(languages, dtype=bool)].min())
        if least > far:
            best, far = words, least
    return best


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # features x bits: log ratios
    bit_weight: np.ndarray

    def margins(self, column: pa.Array) -> np.ndarray:
        """Of each text the margin of each bit."""
        data, offsets = utf8_column(column)
        n = len(offsets) - 1
        total, count = np.zeros((n, self.weights.shape[1])), np.zeros(n)
        for a, b in text_blocks(offsets):
            lo = offsets[a]
            block, rows = data[lo : offsets[b]], offsets[a : b + 1] - lo
            for feature, ok in _grams(block, rows):
                at = np.flatnonzero(ok)
                if not len(at):
                    continue
                row = np.searchsorted(rows, at, "right") - 1
                starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                total[a + row[starts]] += np.add.reduceat(self.weights[feature[at]], starts, axis=0)
                count[a + row[starts]] += np.diff(np.append(starts, len(row)))
        return total / np.maximum(count, 1)[:, None] * np.minimum(count, EVIDENCE)[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, its probability, whether ambiguous) of each row of margins."""
        loss = np.stack([(np.logaddexp(0, -margins * code) * self.bit_weight).sum(axis=1) for code in self.codes.astype(np.float64)], axis=1)
        chance = np.exp(loss.min(axis=1, keepdims=True) - loss)
        chance /= chance.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        top = np.sort(chance, axis=1)
        close = top[:, -2] >= AMBIGUOUS * top[:, -1] if chance.shape[1] > 1 else np.zeros(len(best), bool)
        return best, chance[np.arange(len(best)), best], close


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model from labelled rows (null labels and texts are left out); None if there are none."""
    labelled = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text is not null and lang is not null")
    counted = labelled.mapInArrow(trimmed(_counts), "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    if not counted.num_rows:
        return None
    languages = sorted(set(counted.column("lang").to_pylist()))
    n = np.zeros((len(languages), 1 << DIM_BITS))
    where = {name: i for i, name in enumerate(languages)}
    n[[where[x] for x in counted.column("lang").to_pylist()], np.asarray(counted.column("feature"))] = np.asarray(counted.column("n"))
    share = n / n.sum(axis=1, keepdims=True)
    codes = codewords(len(languages))
    floor = 1e-6
    weights = np.stack([np.log((share[bit > 0].mean(axis=0) if (bit > 0).any() else 0) + floor) - np.log((share[bit < 0].mean(axis=0) if (bit < 0).any() else 0) + floor) for bit in codes.T], axis=1)
    model = Model(languages, codes, weights.astype(np.float32), np.ones(codes.shape[1]))
    if len(languages) > 1:
        total = labelled.count()
        some = labelled.filter(F.pmod(F.xxhash64("text"), F.lit(max(1, total // WEIGH_ROWS))) == 0).orderBy(F.xxhash64("text", F.lit(1)), "lang").limit(2 * WEIGH_ROWS).toArrow()
    if len(languages) > 1 and some.num_rows:
        some = some.combine_chunks()
        margins = model.margins(some.column("text").combine_chunks())
        wanted = codes[[where[x] for x in some.column("lang").to_pylist()]]
        right = np.clip(((margins * wanted) > 0).mean(axis=0), 0.55, 0.999)
        weight = np.log(right / (1 - right))
        model.bit_weight = weight / weight.sum() * len(weight) / 2
    return model


def _predict(held) -> Callable:
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    def run(text: pa.Array, letters: pa.Array) -> pa.Array:
        model = held.value
        best, score, close = model.decode(model.margins(text))
        letters = np.asarray(letters)
        names = np.array([*model.languages, UNKNOWN], dtype=object)[np.where(letters, best, len(model.languages))]
        out = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(close & letters)], fields=list(kind))
        give_back()
        return out

    return run


def judged(rows: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """(row, told): the columns `keep` as one struct, which no name of theirs can clash with, and (lang_pred, score, ambiguous).

    Null text or one without a letter: `und`, 0.0, false. A text of letters without any known n-gram: the codewords decide
    among equals, with score 1 / languages. Without a model every text is `und`. Rows stay as they are, also repeated ones;
    an empty table gives an empty result; further columns are not looked at."""
    letters: Column = F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        told = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    else:
        held = rows.sparkSession.sparkContext.broadcast(model)  # languages and features are bounded
        told = F.arrow_udf(_predict(held), "lang_pred string, score double, ambiguous boolean")(F.col(text_col).cast("string"), letters)
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), told.alias("told"))


def predict(rows: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` with lang_pred, score (0 to 1) and ambiguous, as `judged` has them.

    A kept column with the name of a result, in whatever case, gives way to the result."""
    results = ("lang_pred", "score", "ambiguous")
    return judged(rows, model, [c for c in keep if c.lower() not in results], text_col).select("row.*", "told.*")
