"""Column functions over a series ordered by bar_idx within entity_id. All return columns; nothing here runs a job."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

#: The labels of the buckets.
FIVE = ("VERY_LOW", "LOW", "MEDIUM", "HIGH", "VERY_HIGH")
THREE = ("LOW", "MEDIUM", "HIGH")


def by_series() -> WindowSpec:
    """The order of a series; made on call, as a window needs a session."""
    return Window.partitionBy("entity_id").orderBy("bar_idx")


def frame(first: int, last: int) -> WindowSpec:
    return by_series().rowsBetween(first, last)


def log_return(price: str = "close") -> Column:
    """ln(p / previous p); 0 if either is not positive; null for the first bar."""
    before = F.lag(price).over(by_series())
    return F.when(before.isNull(), F.lit(None).cast("double")).when((before > 0) & (F.col(price) > 0), F.ln(F.col(price) / before)).otherwise(F.lit(0.0))


def rebased(column: str, base: float = 100.0) -> Column:
    """Times base / first close (1 if that is not positive)."""
    first = F.first("close").over(frame(Window.unboundedPreceding, 0))
    return F.col(column) * F.when(first > 0, F.lit(base) / first).otherwise(F.lit(1.0))


def volume_percentile(rows: int, alone: float) -> Column:
    """Share of the last `rows` bars (itself included) with a smaller volume; `alone` if it is the only one."""
    seen = F.collect_list("volume").over(frame(1 - rows, 0))
    return F.when(F.size(seen) > 1, F.size(F.filter(seen, lambda x: x < F.col("volume"))) / F.size(seen)).otherwise(F.lit(alone))


def momentum(price: str, w: int) -> Column:
    """W04."""
    before = F.lag(price, w).over(by_series())
    return F.coalesce(F.when(before > 0, (F.col(price) - before) / before), F.lit(0.0))


def volatility(returns: str, w: int, number: str) -> Column:
    """Population deviation of the w returns before this one; 0 for the first w."""
    return F.when(F.col(number) >= w, F.stddev_pop(returns).over(frame(-w, -1))).otherwise(F.lit(0.0))


def drawdown(price: str = "close") -> Column:
    """From the highest price so far."""
    peak = F.max(price).over(frame(Window.unboundedPreceding, 0))
    return F.when(peak > 0, (F.col(price) - peak) / peak).otherwise(F.lit(0.0))


def edges(values: Column, n: int) -> Column:
    """The upper edges of n buckets of a sorted array: its element number int(size * i / n), or the last for number 0."""
    size = F.size(values)

    def edge(i: int) -> Column:
        k = F.floor(size * F.lit(i) / n).cast("int")
        return F.get(values, F.when(k > 0, k - 1).otherwise(size - 1))

    return F.array(*[edge(i) for i in range(1, n + 1)])


def bucket(value: Column, bounds: Column, labels: tuple[str, ...] = FIVE) -> Column:
    """The label of the first edge that the value does not exceed, else the last."""
    out = F.when(value <= F.get(bounds, F.lit(0)), F.lit(labels[0]))
    for i in range(1, len(labels)):
        out = out.when(value <= F.get(bounds, F.lit(i)), F.lit(labels[i]))
    return out.otherwise(F.lit(labels[-1]))
