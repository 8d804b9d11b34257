"""Shards as runs of a Hilbert curve over several metadata dimensions, in DataFrame operations only.

Each dimension is quantised to 2**BITS steps that keep its order and hold about as many rows each (cuts at quantiles, numbers
of bounded count); the curve index of a cell keeps cells that are near in all dimensions near in order, so a run of it covers
small ranges in every dimension and a reader skips files by the least and largest value of any of them.

Within a cell rows stand by a hash of their group, so the rows of a group that share a cell are next to each other. A row's
place is found from counts by cell, bucket of groups and group; a group of more than ROWS rows is dealt to several tasks by
its ties. So no task holds a hot cell or a hot group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name, materialize

BITS = 5
#: Rows of one bucket of groups, or of one part of a large group, on average.
ROWS = 50_000


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index along the Hilbert curve of a cell, each coordinate in 0 .. 2**bits - 1.

    By Skilling's method (AIP Conf. Proc. 707, 381, 2004): undo the excess work from the highest bit down, Gray-encode, and
    interleave the bits."""
    n = len(cells)
    axes = F.array(*[c.cast("int") for c in cells])
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x: Column, s: Column) -> Column:
        low = s["q"] - F.lit(1)
        own = F.get(x, s["i"])
        swap = F.get(x, F.lit(0)).bitwiseXOR(own).bitwiseAND(low)
        flip = own.bitwiseAND(s["q"]) != 0
        return F.transform(x, lambda v, i: F.when(flip, F.when(i == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(F.when((i == 0) & (s["i"] == 0), v).when((i == 0) | (i == s["i"]), v.bitwiseXOR(swap)).otherwise(v)))

    undone = F.aggregate(steps, axes, undo)
    # Gray code: each axis takes the exclusive or of those before it
    gray = F.aggregate(F.array(*[F.lit(i) for i in range(1, n)]), undone, lambda x, i: F.transform(x, lambda v, k: F.when(k == i, v.bitwiseXOR(F.get(x, i - 1))).otherwise(v)))
    turn = F.aggregate(
        F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]),
        F.struct(gray.alias("x"), F.lit(0).alias("t")),
        lambda a, q: F.struct(a["x"].alias("x"), F.when(F.get(a["x"], F.lit(n - 1)).bitwiseAND(q) != 0, a["t"].bitwiseXOR(q - 1)).otherwise(a["t"]).alias("t")),
        lambda a: F.transform(a["x"], lambda v: v.bitwiseXOR(a["t"])),
    )
    places = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.aggregate(
        places,
        F.struct(turn.alias("x"), F.lit(0).cast("long").alias("h")),
        lambda a, p: F.struct(a["x"].alias("x"), (a["h"] * 2 + F.when(F.get(a["x"], p["i"]).bitwiseAND(p["q"]) != 0, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("h")),
        lambda a: a["h"],
    )


def label_number(c: Column) -> Column:
    """A number that keeps the order of labels as far as their first six bytes tell it; null comes first."""
    head = F.substring(c.cast("string").cast("binary"), 1, 6)
    return F.coalesce(F.conv(F.rpad(F.hex(head), 12, "0"), 16, 10).cast("double"), F.lit(-1.0))


def size_number(c: Column) -> Column:
    """A number as it is; null and not-a-number come first."""
    value = c.cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(float("-inf"))).otherwise(value)


def cuts(rows: DataFrame, dimensions: list[Column], bits: int = BITS) -> list[list[float]]:
    """Of each dimension the values at which its steps end: 2**bits - 1 quantiles.

    A frequent value is several of them: the steps of a dimension with few values are as far apart as those of one with many,
    so the curve splits it as early."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = rows.agg(*[F.percentile_approx(d, shares, 10_000).alias(f"d{i}") for i, d in enumerate(dimensions)]).first()
    return [sorted(x or []) for x in found]


def step(c: Column, ends: list[float]) -> Column:
    """How many of the ends are below a value."""
    if not ends:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(x) for x in ends]), lambda x: x < c))


def hilbert_shards(rows: DataFrame, dimensions: list[Column], group: Column, tie: Column, shards: int = 16, bits: int = BITS) -> DataFrame:
    """rows with curve_index, shard and slot: in curve order, cut into shards whose row counts differ by one at most.

    dimensions: numbers to quantise (`label_number`, `size_number`). group: rows with equal groups in a cell stand together.
    tie: orders the rows of a group; equal ties may come in either order. slot counts from 0 in each shard. Rows are never
    dropped: nulls have places of their own, repeated rows are placed each, and an empty table gives an empty result. A
    column of rows that has the name of a result, in whatever case, stays, and the result's name gets underscores."""
    axes = [f"s{i}" for i in range(len(dimensions))]
    # one struct holds the row, so no name can clash with a helper's
    quantised = [step(d, ends).cast("int").alias(n) for n, d, ends in zip(axes, dimensions, cuts(rows, dimensions, bits), strict=True)]
    cells = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *quantised, F.xxhash64(group).alias("g"), tie.alias("tie"))
    cells = materialize(cells, "cells")
    buckets = max(1, -(-cells.count() // ROWS))
    cells = cells.withColumn("bucket", F.pmod("g", F.lit(buckets)))

    # a group larger than ROWS is dealt by its ties; there are at most rows / ROWS of these
    hot = cells.groupBy(*axes, "g").agg(F.count("*").alias("n")).filter(F.col("n") > ROWS).select(*axes, "g", F.ceil(F.col("n") / ROWS).alias("parts"))
    hot = materialize(hot, "hot-groups")
    part = F.pmod(F.xxhash64("tie"), F.coalesce("parts", F.lit(1)))
    cells = cells.join(F.broadcast(hot), [*axes, "g"], "left").withColumn("part", part).drop("parts")

    key = [*axes, "bucket", "g", "part"]
    counts = cells.groupBy(*key).agg(F.count("*").alias("n"))
    buckets_of = counts.groupBy(*axes, "bucket").agg(F.sum("n").alias("n")).withColumn("curve_index", hilbert_index([F.col(n) for n in axes], bits))
    by_cell = buckets_of.groupBy("curve_index").agg(F.sum("n").alias("c"))  # 2 ** (bits * dimensions) rows at most
    earlier = Window.orderBy("curve_index").rowsBetween(Window.unboundedPreceding, -1)
    by_cell = by_cell.select("curve_index", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"), F.sum("c").over(Window.partitionBy()).alias("total"))
    in_cell = Window.partitionBy("curve_index").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets_of.withColumn("inside", F.coalesce(F.sum("n").over(in_cell), F.lit(0))).join(by_cell, "curve_index")
    starts = starts.select(*axes, "bucket", "curve_index", (F.col("before") + F.col("inside")).alias("start"), "total")
    in_bucket = Window.partitionBy(*axes, "bucket").orderBy("g", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("behind", F.coalesce(F.sum("n").over(in_bucket), F.lit(0))).join(starts, [*axes, "bucket"])
    bases = bases.select(*key, "curve_index", (F.col("start") + F.col("behind")).alias("base"), "total")

    nth = F.row_number().over(Window.partitionBy(*key).orderBy("tie")) - 1
    placed = cells.withColumn("nth", nth).join(bases, key).withColumn("at", F.col("base") + F.col("nth"))
    # the shard of place r is floor(r * shards / total); it starts at ceil(shard * total / shards)
    placed = placed.withColumn("shard", F.expr(f"at * {shards} div total"))
    slot = F.expr(f"at - (shard * total + {shards - 1}) div {shards}").cast("long")
    names = [free_name(rows, n) for n in ("curve_index", "shard", "slot")]
    own = [F.col(f"row.`{c}`") for c in rows.columns]
    return placed.select(*own, F.col("curve_index").alias(names[0]), F.col("shard").cast("int").alias(names[1]), slot.alias(names[2]))
