"""Statistics of the pipeline and of deliveries."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .counters import deltas_of

#: A block's weight falls by exp(-PER_BLOCK); below exp(-VISIBLE) of the rate nothing shows in a double.
PER_BLOCK = 14.0
VISIBLE = 42.0


def pipeline_stats(samples: DataFrame, points: DataFrame) -> DataFrame:
    """One row: scrapes and samples read, points made."""
    read = samples.groupBy("scrape_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(1).alias("batches_processed"), F.col("n").alias("samples_processed"), F.lit(0).alias("samples_produced"))
    made = points.select(F.lit(0).alias("batches_processed"), F.lit(0).alias("samples_processed"), F.lit(1).alias("samples_produced"))
    return read.unionByName(made).agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in read.columns))


def points_by_status(deliveries: DataFrame) -> DataFrame:
    """(status, points) of deliveries(total, success, errors array<struct<code, points>>, status): 0 is success.

    A delivery with a list of errors counts points by their codes; one that failed as a whole counts all under its status."""
    good = F.struct(F.lit(0).alias("code"), F.col("success").alias("points"))
    whole = F.array(F.struct(F.col("status").alias("code"), F.col("total").alias("points")))
    parts = F.when(F.size("errors") > 0, F.concat(F.array(good), F.col("errors"))).when(F.col("status") != 0, whole).otherwise(F.array(F.struct(F.lit(0).alias("code"), F.col("total").alias("points"))))
    rows = deliveries.select(F.explode(parts.cast("array<struct<code:int,points:bigint>>")).alias("p"))
    return rows.groupBy(F.col("p.code").alias("status")).agg(F.sum("p.points").alias("points")).filter("points > 0")


def explicit_distribution(df: DataFrame, value: Column, edges: Sequence[float]) -> DataFrame:
    """(bucket, n, count, mean, sum_sq_dev): n values lie in each bucket; bucket k holds values from the k-th bound on; the rest is over all values."""
    numbered = df.select(value.cast("double").alias("x")).filter("x is not null")
    index = F.lit(0)
    for edge in edges:
        index = index + F.when(F.col("x") >= edge, 1).otherwise(0)
    by_bucket = numbered.groupBy(index.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("var"))
    # A row per bucket is all that is left: their means and variances add up to those of all values.
    w = Window.partitionBy()
    total = F.sum("n").over(w)
    centre = F.sum(F.col("n") * F.col("m")).over(w) / total
    rows = by_bucket.withColumns({"count": total, "mean": centre})
    dev = F.sum(F.col("n") * (F.col("var") + F.pow(F.col("m") - F.col("mean"), 2))).over(w)
    return rows.withColumn("sum_sq_dev", dev).select("bucket", "n", "count", "mean", "sum_sq_dev")


def last_point_per_series(points: DataFrame, key: str = "series_key") -> DataFrame:
    rest = [c for c in points.columns if c != key]
    return points.groupBy(key).agg(F.max_by(F.struct(*rest), "seq").alias("p")).select(key, "p.*")


def ewma_rate(events: DataFrame, key: str = "key", ts: str = "ts", tick: str = "15 seconds", alpha: float = 0.2) -> DataFrame:
    """(key, tick_end, rate): events per second, smoothed. The first tick sets the rate, each later one moves it by alpha; ticks without events count as 0.

    A tick is a map of the rate, r -> (1 - alpha) r + alpha x, and so is a run of ticks. Ticks are dealt into blocks of a fixed number; what a block adds to the rate at its
    end is one sum over its events, and its weight falls by the same factor with every block after it. So each block gets the rate that it begins with
    from the few blocks before it whose weight a double still shows, and its ticks are folded from there: a key's ticks are many tasks' work."""
    width = events.sparkSession.range(1).select(F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00+00:00' + interval {tick})")).first()[0]
    size = max(1, math.ceil(PER_BLOCK / -math.log(1 - alpha))) if 0 < alpha < 1 else 64
    reach = math.ceil(VISIBLE / PER_BLOCK) if alpha < 1 else 1
    number = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / width)
    ticks = events.groupBy(key, number.alias("tick")).agg(F.count(F.lit(1)).alias("n"))
    span = ticks.groupBy(key).agg(F.min("tick").alias("lo"), F.max("tick").alias("hi"))
    block = F.floor(F.col("tick") / size)
    x = F.col("n") / (width / 1e6)
    at = (F.col("tick") - F.col("block") * size).cast("int")
    full = ticks.withColumn("block", block).groupBy(key, "block").agg(F.map_from_entries(F.collect_list(F.struct(at, x))).alias("xs"), F.sum(x * alpha * F.pow(F.lit(1 - alpha), size - 1 - at)).alias("adds"), F.min_by(F.struct(at.alias("at"), x.alias("x")), "tick").alias("first"))
    # The first tick of all counts in full.
    first = (F.col("first.at") + F.col("block") * size == F.col("lo")).cast("int")
    full = full.join(span.withColumnRenamed(key, "__key"), F.col(key).eqNullSafe(F.col("__key"))).withColumn("adds", F.col("adds") + first * (1 - alpha) * F.col("first.x") * F.pow(F.lit(1 - alpha), size - 1 - F.col("first.at")))
    later = F.explode(F.transform(F.sequence(F.lit(1), F.lit(reach)), lambda k: F.struct((F.col("block") + k).alias("block"), (F.col("adds") * F.pow(F.lit((1 - alpha) ** size), k - 1)).alias("rate"))))
    carry = full.select(key, later.alias("c")).groupBy(key, F.col("c.block").alias("block")).agg(F.sum("c.rate").alias("rate"))
    blocks = span.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / size), F.floor(F.col("hi") / size))))
    # All that is known of a block, in one shuffle; a null key is a key.
    parts = blocks.unionByName(full.select(key, "block", "xs"), allowMissingColumns=True).unionByName(carry, allowMissingColumns=True)
    blocks = parts.groupBy(key, "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("lo", "hi", "xs", "rate"))).filter("lo is not null")
    begin = F.greatest(F.col("lo") - F.col("block") * size, F.lit(0)).cast("int")
    end = F.least(F.col("hi") - F.col("block") * size, F.lit(size - 1)).cast("int")
    fresh = F.col("lo") >= F.col("block") * size
    state = F.struct(F.when(~fresh, F.coalesce("rate", F.lit(0.0))).alias("r"), F.array().cast("array<double>").alias("rs"))
    move = lambda s, i: F.coalesce(s["r"] + alpha * (_at(i) - s["r"]), _at(i))
    rates = F.aggregate(F.sequence(begin, end), state, lambda s, i: F.struct(move(s, i).alias("r"), F.concat(s["rs"], F.array(move(s, i))).alias("rs")))["rs"]
    rows = blocks.select(key, (F.col("block") * size + begin).alias("from"), F.posexplode(rates).alias("k", "rate"))
    return rows.select(key, F.timestamp_micros((F.col("from") + F.col("k") + 1) * width).alias("tick_end"), "rate")


def _at(i: Column) -> Column:
    """The rate of a block's i-th tick; most have no events."""
    return F.coalesce(F.try_element_at("xs", i), F.lit(0.0))


def rate_5m(samples: DataFrame, period: str = "5 minutes", seconds: float = 300.0) -> DataFrame:
    """(ref, period_end, rate): growth of a counter per second over each period."""
    deltas = deltas_of(samples)
    return deltas.groupBy("ref", F.window(F.timestamp_millis("t"), period).alias("w")).agg((F.sum("delta") / seconds).alias("rate")).select("ref", F.col("w.end").alias("period_end"), "rate")
