"""Running values over series of which one may hold most of all rows.

A window by series is one task's work for each series. Here a series with more rows than a task should have is cut into blocks, ranges of its
order column between quantiles; windows run by series and block, and what a block needs from those before it (the carry) is a window over one row per
block. Carries are broadcast: there are at most some blocks per shuffle partition, however many rows there are."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK = "__block"
#: A series is cut if it has more rows than this, and than a quarter of a shuffle partition's share.
LEAST = 1_000_000
PER_PARTITION = 4
_CHUNK = 64


def spread(rows: DataFrame, keys: Sequence[str], order: str = "seq", least: int | None = None) -> DataFrame | None:
    """rows with __block: -1 for series that stay whole, else 0, 1, ... in order; None if all stay whole (or rows are a stream).

    One pass counts series; only if one is to be cut, another takes its quantiles."""
    if rows.isStreaming:
        return None
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total, most = counts.agg(F.sum("__n"), F.max("__n")).first()
    limit = max(LEAST if least is None else least, (total or 0) // (PER_PARTITION * parts))
    if not most or most <= limit:
        return None
    hot = counts.filter(F.col("__n") > limit)
    cuts = -(-most // limit)
    shares = [k / cuts for k in range(1, cuts)]
    same = lambda a, b: reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))
    mine = rows.select(*keys, F.col(order).cast("long").alias("__at")).alias("a").join(F.broadcast(hot.alias("b")), same(_of("a"), _of("b"))).select("a.*", "b.__n")
    bounds = mine.groupBy(*keys).agg(F.percentile_approx("__at", shares, max(10_000, 10 * cuts)).alias("__q"), F.first("__n").alias("__n"))
    # A series gets as many blocks as its rows need, so all of them together are at most twice the partitions' quarters.
    stride = F.floor(F.lit(cuts) * limit / F.col("__n")).cast("int")
    thin = F.array_distinct(F.filter("__q", lambda _, i: (i + 1) % F.greatest(stride, F.lit(1)) == 0))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size("__q") - 1) / _CHUNK).cast("int")), lambda k: F.slice("__q", k * _CHUNK + 1, _CHUNK))
    bounds = bounds.withColumn("__q", thin).filter(F.size("__q") > 0).withColumn("__chunks", chunks).withColumn("__heads", F.transform("__chunks", lambda c: F.get(c, 0)))
    at = F.col(order).cast("long")
    k = F.size(F.filter("__heads", lambda b: b < at))
    block = F.when(k == 0, 0).otherwise((k - 1) * _CHUNK + F.size(F.filter(F.get("__chunks", k - 1), lambda b: b < at)))
    joined = rows.alias("a").join(F.broadcast(bounds.alias("b")), same(_of("a"), _of("b")), "left")
    return joined.select("a.*", F.when(F.col("__heads").isNull(), -1).otherwise(block).alias(BLOCK))


def _of(alias: str):
    class Side:
        def __getitem__(self, name: str) -> Column:
            return F.col(f"{alias}.`{name}`")

    return Side()


def carried(rows: DataFrame, keys: Sequence[str], own: dict[str, Column], *steps: Callable[[WindowSpec], dict[str, Column]]) -> DataFrame:
    """rows of spread() with columns that come from the blocks before. own: aggregates of a block; each step adds columns over one row per block, w being a series' blocks in order.
    rows get the last step's.

    Series that stay whole have null in them. Rows keep their partitions."""
    blocks = rows.filter(F.col(BLOCK) >= 0).groupBy(*keys, BLOCK).agg(*(c.alias(n) for n, c in own.items()))
    for step in steps:
        made = step(Window.partitionBy(*keys).orderBy(BLOCK))
        blocks = blocks.withColumns(made)
    edges = blocks.select(*keys, BLOCK, *made)
    a, b = _of("a"), _of("b")
    same = reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys), a[BLOCK] == b[BLOCK])
    return rows.alias("a").join(F.broadcast(edges.alias("b")), same, "left").select("a.*", *(b[n].alias(n) for n in made))
