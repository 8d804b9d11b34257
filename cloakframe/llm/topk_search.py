"""Exact top-k by inner product: norm-sorted blocks, SVD-rotated partial sums and Cauchy-Schwarz residual bounds.

Vectors are sorted by descending length and cut into blocks; queries are cut into blocks too. The rotation (right singular
vectors of the candidates, from one d x d Gram matrix) moves the energy of all vectors into the leading dimensions, so
q.c <= partial sum over the leading dimensions + |q rest| |c rest| is tight after a few of them. Each query's k-th score
within the block of longest vectors is a floor for its result; a pair of a query block and a candidate block is formed
only if some query's length times the block's longest length reaches its floor. What survives the bounds is scored exactly."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, trimmed

#: Vectors of a candidate block, and queries of a query block.
BLOCK, QUERIES = 4096, 512
#: Candidates that are bounded at once, in descending length.
STEP = 512
#: Share of the squared length that the partial sums should hold.
ENERGY = 0.8

_PACKED = "block long, top double, ids binary, kind string, vectors binary, norms binary"


def _pack_matrix(x: np.ndarray) -> tuple[str, bytes]:
    """A matrix of whole numbers in the smallest type that holds them."""
    most = float(np.abs(x).max(initial=0))
    kind = next((k for k, n in (("<i1", 127), ("<i2", 32767), ("<i4", 2**31 - 1)) if most <= n), "<f8")
    return kind, x.astype(kind).tobytes()


def _matrix(kind: str, packed: bytes, d: int) -> np.ndarray:
    return np.frombuffer(packed, kind).reshape(-1, d).astype(np.float64)


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        lists = batch.column(0)
        n = len(lists)
        if n:
            x = np.asarray(lists.flatten(), np.float64).reshape(n, -1)
            total = x.T @ x + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "v"])


def _pack(d: int) -> Callable:
    """Rows of one block, in descending length, as one row."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["norm", "id"], ascending=[False, True], kind="stable")
        x = np.stack(pdf["x"].to_numpy()).astype(np.float64)
        norms = np.sqrt((x * x).sum(axis=1))
        kind, packed = _pack_matrix(x)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "top": [float(norms.max())], "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "kind": [kind], "vectors": [packed], "norms": [norms.tobytes()]})

    return run


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query its k highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    starts = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    keep = rank < k
    return query[keep], ids[keep], score[keep]


def _search(d: int, rotation: np.ndarray, lead: int, k: int) -> Callable:
    """The k best of a candidate block for each query of a query block, given the queries' floors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                q_ids, c_ids = np.frombuffer(row.q_ids, np.int64), np.frombuffer(row.ids, np.int64)
                q, c = _matrix(row.q_kind, row.q_vectors, d), _matrix(row.kind, row.vectors, d)
                q_norm, c_norm = np.frombuffer(row.q_norms), np.frombuffer(row.norms)
                floor = np.frombuffer(row.floors).copy() if row.floors is not None else np.full(len(q_ids), -np.inf)
                q_rot, c_rot = q @ rotation, c @ rotation
                q_rest = np.sqrt(np.maximum((q_rot[:, lead:] ** 2).sum(axis=1), 0))
                c_rest = np.sqrt(np.maximum((c_rot[:, lead:] ** 2).sum(axis=1), 0))
                slack = 1e-9 * float(q_norm.max(initial=0) * c_norm.max(initial=0)) + 1e-9
                held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
                exact = float(q_norm.max(initial=0) * c_norm.max(initial=0)) < 2**52  # then float products of integers are exact
                for at in range(0, len(c_ids), STEP):
                    end = min(at + STEP, len(c_ids))
                    alive = np.flatnonzero(q_norm * c_norm[at] + slack >= floor)
                    if not len(alive):
                        break  # the rest is no longer
                    bound = q_rot[alive, :lead] @ c_rot[at:end, :lead].T + np.outer(q_rest[alive], c_rest[at:end])
                    r, s = np.nonzero((bound + slack >= floor[alive][:, None]) & (q_ids[alive][:, None] != c_ids[None, at:end]))
                    if len(r) * 4 > bound.size and exact:
                        score = (q[alive] @ c[at:end].T)[r, s].astype(np.int64)
                    elif exact:
                        score = np.einsum("ij,ij->i", q[alive[r]], c[at + s]).astype(np.int64)
                    else:
                        score = (q[alive[r]].astype(np.int64) * c[at + s].astype(np.int64)).sum(axis=1)
                    query = alive[r]
                    high = score >= floor[query]
                    held = _best(*(np.concatenate(x) for x in zip(held, (query[high], c_ids[at + s[high]], score[high]), strict=True)), k)
                    seen, count = np.unique(held[0], return_counts=True)
                    full = seen[count == k]
                    lowest = held[2][np.cumsum(count) - 1][count == k]
                    floor[full] = np.maximum(floor[full], lowest)
                yield pd.DataFrame({"q_block": row.q_block, "q_at": held[0], "query_id": q_ids[held[0]], "vec_id": held[1], "score": held[2], "n": 1})

    return run


def _search_one(block: dict, search: Callable) -> Callable:
    """search of query blocks in one candidate block that goes with the code."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            more = {c: [block[c]] * len(pdf) for c in ("ids", "kind", "vectors", "norms")}
            yield from search(iter([pdf.assign(floors=None, **{c: [bytes(v) if isinstance(v, bytearray) else v for v in x] for c, x in more.items()})]))

    return run


_FOUND = "q_block long, q_at long, query_id long, vec_id long, score long, n int"


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "vector", k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query row the k highest integer inner products with the other rows.

    vector_col is an array of whole numbers (double). Null ids, null vectors and vectors with null or non-finite components
    take no part; a shorter vector is taken as padded with zeros; a zero or empty vector is one like others. Rows with a
    query's own id are not its candidates; further rows that repeat an id are candidates (and queries) of their own. Ties go
    to the smaller vec_id. An empty table gives an empty result; further columns are not looked at."""
    spark = vectors.sparkSession
    ok = F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"), is_query.alias("is_query")).filter(F.col("id").isNotNull()).filter(ok)
    facts = rows.agg(F.max(F.size("x")).alias("d"), F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    out = "query_id long, rank int, vec_id long, score long"
    if not facts["q"] or not facts["n"]:
        return spark.createDataFrame([], out)
    d = max(1, facts["d"])
    x = F.when(F.size("x") == d, F.col("x")).otherwise(F.concat("x", F.array_repeat(F.lit(0.0), F.lit(d) - F.size("x"))))
    rows = rows.select("id", x.alias("x"), "is_query").withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)))

    cells = rows.select("x").mapInArrow(trimmed(_gram), "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()  # d * d numbers
    gram = np.zeros(d * d)
    for r in cells:
        gram[r["cell"]] = r["v"]
    power, rotation = np.linalg.eigh(gram.reshape(d, d))
    power, rotation = np.maximum(power[::-1], 0), np.ascontiguousarray(rotation[:, ::-1])
    lead = int(np.searchsorted(np.cumsum(power), ENERGY * power.sum())) + 1
    lead = min(d, max(1, lead))

    # blocks of about BLOCK rows in descending length: bounds of equal counts, and equal lengths dealt out by id
    n_blocks, n_queries = -(-facts["n"] // BLOCK), -(-facts["q"] // QUERIES)
    cuts = [F.lit(float(c)) for c in rows.approxQuantile("norm", [i / min(n_blocks, 1024) for i in range(1, min(n_blocks, 1024))], 0.0005)] if n_blocks > 1 else []
    spread = -(-n_blocks // 1024)
    level = F.lit(0).cast("long")
    if cuts:
        level = F.size(F.filter(F.array(*cuts), lambda c: c <= F.col("norm"))).cast("long")
    salted = rows.withColumn("level", level)
    counts = {r["level"]: r["c"] for r in salted.groupBy("level").agg(F.count("*").alias("c")).collect()}  # 1024 at most
    parts = F.create_map(*[F.lit(v) for kv in sorted((a, max(spread, -(-c // BLOCK))) for a, c in counts.items()) for v in kv])
    block = F.col("level") * F.lit(1 << 32) + F.pmod(F.xxhash64("id"), parts[F.col("level")])
    packed = materialize(salted.withColumn("block", block).select("block", "id", "x", "norm").groupBy("block").applyInPandas(_pack(d), _PACKED), "candidates")
    asked = rows.filter("is_query").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_queries)))
    asked = materialize(asked.select("block", "id", "x", "norm").groupBy("block").applyInPandas(_pack(d), _PACKED), "queries")
    asked = asked.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("kind").alias("q_kind"), F.col("vectors").alias("q_vectors"), F.col("norms").alias("q_norms"), F.col("top").alias("q_top"))

    columns = ["q_block", "q_ids", "q_kind", "q_vectors", "q_norms", "floors", "ids", "kind", "vectors", "norms"]
    longest = packed.orderBy(F.desc("top"), "block").first()  # one block, of bounded size
    head = asked.repartition(min(n_queries, 4096), "q_block").select("q_block", "q_ids", "q_kind", "q_vectors", "q_norms")
    first = materialize(head.mapInPandas(_search_one(longest.asDict(), _search(d, rotation, lead, k)), _FOUND), "floors")

    def floors(pdf: pd.DataFrame) -> pd.DataFrame:
        size = len(pdf["q_ids"].iloc[0]) // 8
        floor = np.full(size, -np.inf)
        found = pdf[pdf["q_at"].notna()]
        for at, scores in found.groupby("q_at")["score"]:
            if len(scores) >= k:
                floor[int(at)] = float(scores.min())
        norms = np.frombuffer(pdf["q_norms"].iloc[0])
        with np.errstate(divide="ignore", invalid="ignore"):
            need = float(np.where(norms > 0, floor / norms, np.where(floor <= 0, -np.inf, np.inf)).min())
        return pd.DataFrame({"q_block": [int(pdf["q_block"].iloc[0])], "floors": [floor.tobytes()], "need": [need]})

    with_floor = asked.select("q_block", "q_ids", "q_norms").join(first.select("q_block", "q_at", "score"), "q_block", "left")
    floor = materialize(with_floor.groupBy("q_block").applyInPandas(floors, "q_block long, floors binary, need double"), "needs")
    # which blocks a query block still needs: lengths only, then the blocks travel to their pairs
    wanted = packed.select("block", "top").join(F.broadcast(floor.select("q_block", "need")) if n_queries <= 100_000 else floor.select("q_block", "need"), F.col("top") * (1 + 1e-9) + 1e-9 >= F.col("need"))
    pairs = asked.join(floor.select("q_block", "floors"), "q_block").join(wanted.select("q_block", "block"), "q_block").join(packed.select("block", "ids", "kind", "vectors", "norms"), "block")
    found = pairs.select(*columns).mapInPandas(_search(d, rotation, lead, k), _FOUND)
    order = Window.partitionBy("q_block", "q_at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
