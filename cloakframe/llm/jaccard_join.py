"""Exact set similarity join on word shingles: a size-aware join with a light and a heavy side.

A and B link when 100 |A & B| >= threshold |A | B|. Equal sets are one class from the start (a digest of the whole set), and
only one set a class goes on. Then:

* Light sets (up to `boundary` shingles): |A - B| <= floor((100 - threshold) |A| / 100), so A & B is one of few subsets of A;
  all of them are enumerated and equal subsets meet.
* Heavy sets: inverted lists. Two linked sets differ in H shingles at most, so of H + 1 + z blocks of the shingle space 1 + z
  agree. A list is that of a block's shingles (one shingle would make lists of unrelated texts). A block is strong by its
  number of rare shingles, or else by its rarest one; each set leaves out its weakest blocks, all up to a strength that at
  most z do not reach, as among the blocks that agree one is then stronger in both sets. What counts as frequent is a table
  of bounded size and decides on cost alone.

Below a threshold of RARE_BELOW sets have so many blocks that those without a partner are found first: a set with more
shingles of its own alone than it may lack has none. Shingles are counted by range, packed, over all texts.

The boundary is where the keys of both kinds, counted over the sizes in the table, cost least. Sets that share a key form
candidate components; every set of these travels once to its component, and exact intersections there find the links: sets
that links connect already are not compared with each other, so copies are not expanded into pairs. Components of
more than GROUP sets are compared block by block, so no task holds more than two blocks of about GROUP sets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytehash import LOWER, SPACE, RangeHash, as_long, mix, words
from .components import components
from .shared import materialize, small, text_blocks, trimmed, utf8_column

GROUP = 2048
#: Classes of equal sets that are dealt in parts, at most: those with over a HOTth of all rows.
HOT = 10_000
#: The table of frequent shingles: at most so many, each counted this often in one batch and in all.
FREQUENT, IN_BATCH, IN_ALL = 1 << 17, 4, 32
#: Threshold below which sets without a partner are left out first; shingles of one range in that step.
RARE_BELOW, RANGE = 85, 4_000_000
#: A size class holds the sizes from L to L * STEP * 100 / threshold.
STEP = 1.25
#: Largest light boundary that is looked at.
LIGHTEST, LIGHT_MOST = 1, 29

_HASH = RangeHash(11)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of its shingles of `size` words.

    Words are runs of bytes other than \\x20 and \\x09-\\x0D after A-Z became a-z; a text of fewer words is one shingle, a
    text without words (or null) has none."""
    data, offsets = utf8_column(column)
    for a, b in text_blocks(offsets):
        block, rows = LOWER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
        start, end, row = words(~SPACE[block], rows)
        h = _HASH.of(block, start, end)
        first = np.searchsorted(row, np.arange(b - a + 1))
        whole = np.zeros(max(0, len(h) - size + 1), np.uint64)
        for k in range(size):
            whole = whole * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(whole)]
        whole = mix(whole + np.uint64(size))
        for i in range(b - a):
            lo, n = first[i], first[i + 1] - first[i]
            if n >= size:
                s = np.sort(whole[lo : lo + n - size + 1])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif n:
                x = np.zeros(1, np.uint64)
                for k in range(n):
                    x = x * np.uint64(0x9E3779B97F4A7C15) + h[lo + k]
                yield mix(x + np.uint64(n))
            else:
                yield np.zeros(0, np.uint64)


def _digest(s: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64).tolist())  # type: ignore[return-value]


def _sizes(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), *_digest(s)) for s in shingle_sets(batch.column(1), size)]
            n, hi, lo = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], ["doc_id", "n", "hi", "lo"])

    return run


def _frequent(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(0), size))
            token, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            often = n >= IN_BATCH
            yield pa.RecordBatch.from_arrays([pa.array(as_long(token[often])), pa.array(n[often].astype(np.int64))], ["token", "n"])

    return run


def frequent_shingles(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, class by logarithm of the count) of the most frequent shingles of texts (text)."""
    counted = texts.select("text").mapInArrow(trimmed(_frequent(size)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= IN_ALL)
    top = counted.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    token, n = np.asarray(top.column("token"), np.int64).view(np.uint64), np.asarray(top.column("n"))
    order = np.argsort(token)
    return token[order], (np.log2(n[order]) // 2).astype(np.int64)


def _spread(size: int, buckets: int) -> Callable:
    """The shingles of a batch by range: 5 bytes of hash each, and the class (65535: of several texts of the batch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in (whole.slice(a, 60_000) for a in range(0, whole.num_rows, 60_000)):
                sets = list(shingle_sets(batch.column(0), size))
                if not sum(map(len, sets)):
                    continue
                ids = np.array([_digest(s)[0] for s in sets], np.int64)
                token, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]).astype(np.uint16)
                order = np.argsort(token)
                token, doc = token[order], doc[order]
                new = np.concatenate(([True], token[1:] != token[:-1]))
                first = np.flatnonzero(new)
                several = np.diff(np.append(first, len(token))) > 1
                token, doc = token[first], np.where(several, np.uint16(65535), doc[first])
                edge = np.searchsorted(token >> np.uint64(32), (np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets))
                edge[-1] = len(token)
                out = []
                number += 1
                for k in range(buckets):
                    t, d = token[edge[k] : edge[k + 1]], doc[edge[k] : edge[k + 1]]
                    if len(t):
                        used, at = np.unique(d, return_inverse=True)
                        named = np.append(ids, 0)[np.where(used == 65535, len(ids), used)]
                        low = (t & np.uint64((1 << 40) - 1)).view(np.uint8).reshape(-1, 8)[:, :5]
                        at = np.where(d == 65535, 65535, at).astype(np.uint16)
                        out.append((k, number, np.ascontiguousarray(low).tobytes(), at.tobytes(), named.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["bucket", "batch", "hashes", "texts", "docs"])

    return run


def _alone(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of each batch and its classes the number of their shingles in this range that no other has, packed: one row a batch."""
    token = np.zeros((sum(map(len, pdf["hashes"])) // 5, 8), np.uint8)
    token[:, :5] = np.frombuffer(b"".join(pdf["hashes"]), np.uint8).reshape(-1, 5)
    token = token.view(np.uint64).ravel()
    order = np.argsort(token)
    same = token[order][1:] == token[order][:-1]
    alone = np.ones(len(token), bool)
    alone[order[1:][same]] = alone[order[:-1][same]] = False
    out, at = [], 0
    for batch, texts, docs in zip(pdf["batch"], pdf["texts"], pdf["docs"], strict=True):
        text, doc = np.frombuffer(texts, np.uint16), np.frombuffer(docs, np.int64)
        own = text[alone[at : at + len(text)] & (text != 65535)]
        at += len(text)
        n = np.bincount(own, minlength=len(doc))[: len(doc)]
        out.append((batch, doc[n > 0].tobytes(), n[n > 0].astype(np.int32).tobytes()))
    return pd.DataFrame(out, columns=["batch", "docs", "counts"])


def _alone_in_all(pdf: pd.DataFrame) -> pd.DataFrame:
    """The counts of one batch's classes over all ranges."""
    doc, at = np.unique(np.frombuffer(b"".join(pdf["docs"]), np.int64), return_inverse=True)
    n = np.bincount(at, np.frombuffer(b"".join(pdf["counts"]), np.int32), len(doc)).astype(np.int64)
    return pd.DataFrame({"hi": doc, "alone": n})


class Keys:
    """The keys of a set under a threshold in hundredths and a light boundary."""

    def __init__(self, threshold: int, boundary: int, frequent: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.int64))):
        self.t, self.boundary = threshold, boundary
        self.tokens, self.commons = frequent
        self.classes = [1]
        while self.classes[-1] < 1 << 40:
            self.classes.append(max(self.classes[-1] + 1, int(self.classes[-1] * STEP)))

    def light_deletions(self, n: int) -> int:
        return (100 - self.t) * n // 100

    def heavy_classes(self, n: int) -> list[tuple[int, int, int]]:
        """(class, blocks, weak blocks that may be left out) of each size class that holds n."""
        out = []
        k = int(np.searchsorted(self.classes, n, "right")) - 1
        while k >= 0 and n * self.t <= (self.classes[k + 1] - 1) * 100:
            far = (100 - self.t) * (self.classes[k + 1] - 1) // self.t
            if k == int(np.searchsorted(self.classes, n, "right")) - 1 or n > self.boundary:
                spare = far // 8 + 1
                out.append((k, far + 1 + spare, spare))
            k -= 1
        return out

    def is_heavy(self, n: int) -> bool:
        """Also a light set is listed if a heavy one may link to it."""
        return n > self.boundary or n * 100 // self.t > self.boundary

    def of(self, s: np.ndarray) -> np.ndarray:
        n, mixed, out = len(s), mix(s + np.uint64(0x632BE59BD9B4E019)), []
        if n <= self.boundary:
            total = mixed.sum(dtype=np.uint64)
            out.append(mix(np.array([total]) + np.uint64(n)))
            for gone in range(1, self.light_deletions(n) + 1):
                picks = np.array(list(combinations(range(n), gone)), np.int64).reshape(-1, gone)
                out.append(mix(total - mixed[picks].sum(axis=1, dtype=np.uint64) + np.uint64(n - gone)))
        if self.is_heavy(n):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)))
            common = np.zeros(n, np.int64)
            if len(self.tokens):
                at = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
                common = np.where(self.tokens[at] == s, self.commons[at], 0)
            rare = np.concatenate(([0], np.cumsum(common == 0)))
            for k, blocks, spare in self.heavy_classes(n):
                edge = np.searchsorted(s >> np.uint64(32), ((np.arange(blocks + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(blocks)))
                edge[-1] = n
                count = np.diff(edge)
                key = mix(mix(sums[edge[1:]] - sums[edge[:-1]] + np.uint64(k * 0xD6E8FEB86659FD93 % 2**64)) + np.arange(blocks, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
                strength = rare[edge[1:]] - rare[edge[:-1]] + 100
                for j in np.flatnonzero(strength == 100):
                    strength[j] = 99 - common[edge[j] : edge[j + 1]].min() if count[j] else 0
                out.append(key[strength >= np.partition(strength, spare)[spare]])
        return np.concatenate(out)

    def cost(self, n: int) -> tuple[float, float]:
        """Expected keys of a set of n shingles as a light and as a heavy one; a weak key also costs the list it meets."""
        k = self.light_deletions(n)
        light = sum(float(np.prod([(n - i) / (i + 1) for i in range(g)])) for g in range(k + 1))
        heavy = 0.0
        for _, blocks, spare in self.heavy_classes(n):
            mean = n / blocks
            weak = blocks * float(np.exp(-mean)) * (1 + mean + mean * mean / 2)
            heavy += blocks + (8 * weak if weak > spare else 0)
        return light, heavy


def light_boundary(sizes: dict[int, int], threshold: int) -> int:
    """The boundary with the fewest keys, given the number of sets of each size up to LIGHT_MOST."""
    keys = Keys(threshold, 0)
    cost = {n: keys.cost(n) for n in range(1, LIGHT_MOST + 1)}
    total = {b: sum(sizes.get(n, 0) * cost[n][n > b] for n in cost) for b in range(LIGHTEST, LIGHT_MOST + 1)}
    return min(total, key=lambda b: (total[b], b))


def _keyed(size: int, keys: Keys) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            out, who, n = [], [], 0
            for s in shingle_sets(batch.column(0), size):
                if not len(s) or (own := _digest(s)) in seen:
                    continue
                seen.add(own)
                out.append(keys.of(s))
                who.append(np.full(len(out[-1]), own[0]))
                n += len(out[-1])
                if n > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(as_long(np.concatenate(out))), pa.array(np.concatenate(who))], ["key", "set"])
                    out, who, n = [], [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(as_long(np.concatenate(out))), pa.array(np.concatenate(who))], ["key", "set"])

    return run


def _sets(size: int) -> Callable:
    """The sets of the rows whose text is of the class it was sent for (an id may have texts of several classes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            sets = [s.tobytes() if _digest(s) == own else None for s, own in zip(shingle_sets(batch.column(3), size), wanted, strict=True)]
            found = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], ["group", "set", "shingles"])
            yield found.filter(found.column(2).is_valid())

    return run


def _links(threshold: int) -> Callable:
    """Of one group: links that connect its sets as all links do.

    Every set leads, against the later sets of other components: a pair is only left out when it is connected already."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("set").sort_values("set")
        doc = pdf["set"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        size = np.array([len(s) for s in sets])
        whole, where = np.concatenate(sets), np.concatenate(([0], np.cumsum(size)))
        _, token, n = np.unique(whole, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), size)
        # each set's prefix: its rarest shingles here, one more than it may lack
        order = np.lexsort((token, n[token], owner))
        nth = np.arange(len(whole)) - where[owner]  # order is by owner, so places are as in whole
        prefix = order[nth <= size[owner] - -(-size[owner] * threshold // 100)]
        prefix = prefix[n[token[prefix]] > 1]
        by_owner = np.searchsorted(owner[prefix], np.arange(len(sets) + 1))
        listed = np.argsort(token[prefix], kind="stable")
        lists, members = token[prefix][listed], owner[prefix][listed]
        starts = np.flatnonzero(np.concatenate(([True], lists[1:] != lists[:-1]))) if len(lists) else np.zeros(0, np.int64)
        ends, nth_list = np.append(starts[1:], len(lists)), np.searchsorted(lists[starts], token[prefix])
        root = np.arange(len(sets))  # the group's component so far, by its smallest member
        mixed, merged = np.ones(len(starts), bool), 0  # lists of more than one component, as of the last look; merges since
        out = []
        for i in range(len(sets)):
            if merged * 16 > len(sets):
                mixed, merged = np.minimum.reduceat(root[members], starts) != np.maximum.reduceat(root[members], starts), 0
            own = nth_list[by_owner[i] : by_owner[i + 1]]
            own = own[mixed[own]]
            near = np.zeros(len(sets), bool)
            for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True):
                near[members[a:b]] = True
            rows = np.flatnonzero(near[i + 1 :]) + i + 1
            rows = rows[(size[rows] * threshold <= size[i] * 100) & (size[i] * threshold <= size[rows] * 100) & (root[rows] != root[i])]
            if not len(rows):
                continue
            if len(rows) * 4 > len(sets):
                hit = sets[i][np.minimum(np.searchsorted(sets[i], whole), size[i] - 1)] == whole
                both = np.add.reduceat(hit, where[:-1], dtype=np.int64)[rows]
            else:
                both = np.array([np.count_nonzero(sets[i][np.minimum(np.searchsorted(sets[i], sets[r]), size[i] - 1)] == sets[r]) for r in rows])
            linked = rows[100 * both >= threshold * (size[rows] + size[i] - both)]
            for r in linked:
                if root[r] != root[i]:
                    out.append((doc[i], doc[r]))
                    merged += 1
                    a, b = min(root[r], root[i]), max(root[r], root[i])
                    root[root == b] = a
            if (root == root[0]).all():
                break
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, threshold: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents linked by 100 |A & B| >= threshold |A | B|, through any chain of links.

    component_id is the smallest id reachable. A text without words or null has no shingles and is its own component. A
    null id is returned with its n_shingles and a null component, and links with nothing. Rows that repeat an id with the
    same words get the same result each; rows that repeat an id with other words are documents of their own, which are not
    linked by the id they share. Empty tables give empty results; further columns are not looked at."""
    if not 50 <= threshold <= 100:
        raise ValueError("threshold must be in 50..100")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sizes = materialize(texts.mapInArrow(trimmed(_sizes(shingle)), "doc_id long, n long, hi long, lo long"), "sets")
    classes = materialize(sizes.filter("n > 0 and doc_id is not null").groupBy("hi", "lo").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.count("*").alias("copies")), "classes")
    counted = {r["n"]: r["c"] for r in classes.filter(F.col("n") <= LIGHT_MOST).groupBy("n").agg(F.count("*").alias("c")).collect()}
    partners = texts.filter("doc_id is not null")
    if threshold < RARE_BELOW:
        shingles = sizes.agg(F.sum("n")).first()[0] or 0
        buckets = max(1, -(-shingles // RANGE))
        spread = partners.select("text").mapInArrow(trimmed(_spread(shingle, buckets)), "bucket int, batch long, hashes binary, texts binary, docs binary")
        alone = spread.groupBy("bucket").applyInPandas(_alone, "batch long, docs binary, counts binary")
        alone = alone.groupBy("batch").applyInPandas(_alone_in_all, "hi long, alone long").groupBy("hi").agg(F.max("alone").alias("alone"))
        left = classes.join(alone, "hi", "left").filter(F.coalesce("alone", F.lit(0)) * 100 <= (100 - threshold) * F.col("n")).select(F.col("doc").alias("doc_id")).distinct()
        partners = partners.join(small(materialize(left, "partners")), "doc_id")
    keys = Keys(threshold, light_boundary(counted, threshold), frequent_shingles(texts, shingle))

    listed = partners.select("text").mapInArrow(trimmed(_keyed(shingle, keys)), "key long, set long")
    centre = F.min("set").over(Window.partitionBy("key"))
    candidates = listed.select(centre.alias("a"), F.col("set").alias("b")).filter("a <> b").distinct()
    groups = components(candidates)
    members = classes.join(groups, F.col("hi") == F.col("id")).select("hi", "lo", "doc", F.col("component").alias("group"))
    members = materialize(members, "members")
    # about GROUP sets a block, by hash: a large group is counted before the shuffle and never in one task
    counted = members.groupBy("group").agg(F.ceil(F.count("*") / GROUP).alias("blocks"))
    blocks = members.join(counted, "group").select("hi", "lo", "doc", "group", F.pmod(F.xxhash64("hi"), F.col("blocks")).alias("block"), "blocks")
    blocks = materialize(blocks, "blocks")
    own = texts.select(F.col("doc_id").alias("doc"), "text").join(small(blocks.select("doc", "group", "hi", "lo")), "doc").select("group", "hi", "lo", "text")
    sets = own.mapInArrow(trimmed(_sets(shingle)), "group long, set long, shingles binary")
    sets = materialize(sets, "shingles").join(blocks.select(F.col("hi").alias("set"), "block", "blocks"), "set")
    # pair (i, j), i <= j, of a group's blocks: a set of block b goes to (b, j) and (i, b)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    spread = sets.select("group", "set", "shingles", "block", other.alias("o")).select("group", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "set", "shingles")
    links = spread.groupBy("group", "i", "j").applyInPandas(_links(threshold), "a long, b long")
    reached = classes.join(components(links).select(F.col("id").alias("hi"), "component"), "hi").select("hi", "lo", "doc", "component")
    smallest = reached.groupBy("component").agg(F.min("doc").alias("c"))
    of_class = classes.join(reached.join(smallest, "component").select("hi", "lo", "c"), ["hi", "lo"], "left").select("hi", "lo", "copies", F.coalesce("c", "doc").alias("c"))
    # a class with very many copies is dealt in parts, so no task holds all of them; HOT classes at most have more than one
    most = max(1000, (classes.agg(F.sum("copies")).first()[0] or 0) // HOT)
    parts = F.ceil(F.col("copies") / most)
    hot = F.broadcast(materialize(classes.filter(F.col("copies") > most).select("hi", "lo", parts.alias("parts")), "hot-classes"))
    dealt = sizes.join(hot, ["hi", "lo"], "left").withColumn("part", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.coalesce("parts", F.lit(1))))
    every = of_class.select("hi", "lo", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(parts, F.lit(1)).cast("long") - 1)).alias("part"))
    return dealt.join(every, ["hi", "lo", "part"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("c")).otherwise(F.col("doc_id"))).alias("component_id")
    )
