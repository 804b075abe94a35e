"""Requests: at most so many series each, never two points of one series, each series in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_SIZE = 200


def bucket(key: str, n: int) -> Column:
    """0 to n - 1 by the first 32 bits of a key's MD5, which any engine can work out."""
    return (F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % n).cast("int")


def assign_batches(points: DataFrame, max_size: int = MAX_SIZE, lanes: int = 64, key: str = "series_key") -> DataFrame:
    """points with round, lane and chunk, which together name a request.

    A series' n-th point is in round n, so requests of increasing round keep its order. A round's points are numbered within lanes
    (by hash of the series), so no task has to see a whole round."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy("seq"))
    rows = points.withColumns({"round": nth, "lane": bucket(key, lanes)})
    place = F.row_number().over(Window.partitionBy("round", "lane").orderBy(key))
    return rows.withColumn("chunk", F.floor((place - 1) / max_size).cast("int"))


def assign_shards(points: DataFrame, shards: int, key: str = "series_key") -> DataFrame:
    """points with shard; all points of a series have one, and a partition of its own."""
    return points.withColumn("shard", bucket(key, shards)).repartition(shards, "shard")


def write_requests(points: DataFrame, path: str, max_size: int = MAX_SIZE, lanes: int = 64) -> None:
    """Writes points as JSON lines, a folder for each lane, with the names of their requests."""
    batched = assign_batches(points, max_size, lanes)
    batched.repartition("lane").sortWithinPartitions("lane", "round", "chunk").write.mode("append").partitionBy("lane").json(path)
