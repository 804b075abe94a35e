"""Histograms: assembling the series of one histogram and scrape into a distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L

BUCKET = "array<struct<bound:double,value:bigint>>"


def bucket_counts(buckets: Column) -> Column:
    """Of cumulative buckets in order of bound: how many values each has of its own."""
    before = lambda i: F.when(i == 0, 0).otherwise(F.get(buckets, i - 1)["value"])
    return F.transform(buckets, lambda x, i: (x["value"] - before(i)).cast("long"))


def bounds(buckets: Column) -> Column:
    """The bounds but the infinite one."""
    return F.transform(F.filter(buckets, lambda x: x["bound"] != float("inf")), lambda x: x["bound"])


def mean(total: Column, count: Column) -> Column:
    return F.when(count > 0, total / count).otherwise(0.0)


def sum_squared_deviation(buckets: Column, counts: Column, centre: Column) -> Column:
    """Sum over buckets of their count times the squared distance of their middle from the mean. The lowest begins at 0; the infinite one's middle is its lower bound."""
    lower = lambda i: F.when(i == 0, 0.0).otherwise(F.get(buckets, i - 1)["bound"])
    middle = lambda x, i: F.when(x["bound"] == float("inf"), lower(i)).otherwise((lower(i) + x["bound"]) / 2)
    parts = F.transform(buckets, lambda x, i: F.get(counts, i) * F.pow(middle(x, i) - centre, 2))
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


#: Which rows of members() count.
MEMBER = "(suffix in ('_sum', '_count') or (suffix = '_bucket' and bound is not null))"


def members(rows: DataFrame) -> DataFrame:
    """rows(labels, suffix) with the key of their histogram and their bucket's bound."""
    return rows.withColumns({"key": L.histogram_key(F.col("labels")), "bound": F.when(F.col("suffix") == "_bucket", L.bucket_bound(L.get(F.col("labels"), "le")))})


def assemble(samples: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(base, key, scrape_id, t, seq, start, count, total, buckets, *extra) of each complete histogram sample.

    samples are reset-adjusted ones with labels, base and suffix. A histogram is the series of one base name with the same
    labels but `le`; its start is that of its count. It goes if its count is missing or any member is a first sample. A
    bucket with a bound that isn't a number is ignored. Of one bound's buckets all stay, in order of their value."""
    rows = members(samples).filter(MEMBER)
    of = lambda s, c: F.max(F.when(F.col("suffix") == s, F.col(c)))
    bucket = F.when(F.col("suffix") == "_bucket", F.struct("bound", F.col("adjusted").cast("long").alias("value")))
    grouped = rows.groupBy("base", "key", "scrape_id", "t").agg(
        F.min("seq").alias("seq"), of("_count", "start").alias("start"), of("_count", "adjusted").alias("count"), F.coalesce(of("_sum", "adjusted"), F.lit(0.0)).alias("total"),
        F.array_sort(F.collect_list(bucket)).alias("buckets"), F.bool_or("first").alias("fresh"), *(F.first(c).alias(c) for c in extra),
    )
    return grouped.filter("not fresh and start is not null").drop("fresh")


def distribution(histograms: DataFrame) -> DataFrame:
    """histograms with distribution: count, mean, sum of squared deviation, bounds and bucket counts."""
    rows = histograms.withColumns({"__n": bucket_counts(F.col("buckets")), "__mean": mean(F.col("total"), F.col("count"))})
    made = F.struct(
        F.col("count").cast("long").alias("count"), F.col("__mean").alias("mean"), sum_squared_deviation(F.col("buckets"), F.col("__n"), F.col("__mean")).alias("sum_sq_dev"),
        bounds(F.col("buckets")).alias("bounds"), F.col("__n").alias("bucket_counts"),
    )
    return rows.withColumn("distribution", made).drop("__n", "__mean")
