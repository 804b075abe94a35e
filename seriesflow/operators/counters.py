"""Counter resets, deltas and aggregated counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.matchers import Filterset
from .series import join_series, match_counters
from .spread import BLOCK, carried, spread


def drop_nan(samples: DataFrame) -> DataFrame:
    return samples.filter(~F.isnan("v"))


def reset_adjust(samples: DataFrame, key: str | Sequence[str] = "ref", least: int | None = None) -> DataFrame:
    """samples with adjusted value, start (ms) and first.

    A series' first sample is the baseline: it has no adjusted value. A value below the one before it is a reset: from there
    on values count from zero and start is a millisecond before the reset. A series with very many samples is worked on in blocks (spread)."""
    keys = [key] if isinstance(key, str) else list(key)
    dealt = spread(samples, keys, least=least)
    w = Window.partitionBy(*keys, *([] if dealt is None else [BLOCK])).orderBy("seq")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = (samples if dealt is None else dealt).withColumn("__p", F.lag("v").over(w))
    falls = lambda p: F.when(F.col("v") < p, F.col("t") - 1)
    if dealt is None:
        carry = {n: F.lit(None) for n in ("__before", "__v", "__t", "__since")}
    else:
        own = {"__lo": F.min_by(F.struct("v", "t"), "seq"), "__hi": F.max_by("v", "seq"), "__fell": F.max(F.when(falls(F.col("__p")).isNotNull(), F.struct("seq", falls(F.col("__p")).alias("at"))))["at"]}
        rows = carried(rows, keys, own, _fallen, _carried_resets)
        carry = {n: F.col(n) for n in ("__before", "__v", "__t", "__since")}
    p = F.coalesce("__p", carry["__before"])
    rows = rows.withColumns({"__p": p, "__v0": F.coalesce(carry["__v"], F.first("v").over(so_far)), "__t0": F.coalesce(carry["__t"], F.first("t").over(so_far))})
    rows = rows.withColumn("__reset", F.coalesce(F.last(falls(F.col("__p")), ignorenulls=True).over(so_far), carry["__since"]))
    first = F.col("__p").isNull()
    base = F.when(F.col("__reset").isNull(), F.col("__v0")).otherwise(0.0)
    out = {"first": first, "start": F.when(~first, F.coalesce("__reset", "__t0")), "adjusted": F.when(~first, F.col("v") - base)}
    return rows.withColumns(out).select(*samples.columns, *out)


def _fallen(w: WindowSpec) -> dict[str, Column]:
    """Of a block: the value before it, and the last reset that it ends with, be it within or at its edge."""
    before = F.lag("__hi").over(w)
    return {"__before": before, "__own": F.coalesce("__fell", F.when(F.col("__lo.v") < before, F.col("__lo.t") - 1))}


def _carried_resets(w: WindowSpec) -> dict[str, Column]:
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    since = F.last("__own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return {"__before": F.col("__before"), "__v": F.first("__lo.v").over(so_far), "__t": F.first("__lo.t").over(so_far), "__since": since}


def drop_out_of_order(samples: DataFrame, key: str = "ref", least: int | None = None) -> DataFrame:
    """samples without those that are older than an earlier one of their series; equal times stay. A series with very many samples is worked on in blocks (spread)."""
    dealt = spread(samples, [key], least=least)
    return _in_order(samples if dealt is None else dealt, key, dealt is not None).select(*samples.columns)


def _in_order(rows: DataFrame, key: str, blocks: bool) -> DataFrame:
    before = Window.partitionBy(key, *([BLOCK] if blocks else [])).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max("t").over(before)
    if blocks:
        kept = rows.columns
        rows = carried(rows, [key], {"__most": F.max("t")}, lambda w: {"__earlier": F.max("__most").over(w.rowsBetween(Window.unboundedPreceding, -1))})
        rows = rows.withColumn("__latest", F.greatest(latest, "__earlier")).select(*kept, "__latest")
    else:
        rows = rows.withColumn("__latest", latest)
    return rows.filter("__latest is null or t >= __latest").drop("__latest")


def counter_deltas(samples: DataFrame, key: str = "ref", least: int | None = None) -> DataFrame:
    """samples with delta: what the counter grew by; after a fall the value itself. The first sample and zero deltas go. A series with very many samples is worked on in blocks (spread)."""
    dealt = spread(samples, [key], least=least)
    return _grown(samples if dealt is None else dealt, key, dealt is not None).select(*samples.columns, "delta")


def _grown(rows: DataFrame, key: str, blocks: bool) -> DataFrame:
    last = F.lag("v").over(Window.partitionBy(key, *([BLOCK] if blocks else [])).orderBy("seq"))
    if blocks:
        rows = carried(rows, [key], {"__hi": F.max_by("v", "seq")}, lambda w: {"__before": F.lag("__hi").over(w)})
        last = F.coalesce(last, "__before")
    delta = F.when(F.col("v") < last, F.col("v")).otherwise(F.col("v") - last)
    return rows.withColumn("delta", delta).filter("delta is not null and delta <> 0")


def deltas_of(samples: DataFrame, least: int | None = None) -> DataFrame:
    """Deltas of samples in their order, NaN and older ones left out. Both windows share one sorted shuffle by ref (and block)."""
    live = drop_nan(samples)
    dealt = spread(live, ["ref"], least=least)
    rows, blocks = (live, False) if dealt is None else (dealt, True)
    return _grown(_in_order(rows, "ref", blocks), "ref", blocks).select(*samples.columns, "delta")


def aggregated_counter(samples: DataFrame, series: DataFrame, counters: Mapping[str, Sequence[Filterset]]) -> DataFrame:
    """(counter, total, points): the sum of the deltas of all series that feed each counter. Series are matched once, before the samples join."""
    feeds = match_counters(series, counters).select("ref", "counter")
    wanted = samples.join(feeds.select("ref").distinct(), "ref", "left_semi")
    grown = deltas_of(wanted).groupBy("ref").agg(F.sum("delta").alias("delta"), F.count(F.lit(1)).alias("points"))
    return join_series(grown, feeds).groupBy("counter").agg(F.sum("delta").alias("total"), F.sum("points").alias("points"))


def aggregated_counter_series(samples: DataFrame, series: DataFrame, counters: Mapping[str, Sequence[Filterset]], period: str = "60 seconds") -> DataFrame:
    """(counter, period_end, total): each counter's cumulative value at the end of each period with a change."""
    feeds = match_counters(series, counters).select("ref", "counter")
    deltas = join_series(deltas_of(samples).select("ref", "t", "delta"), feeds)
    by_period = deltas.groupBy("counter", F.window(F.timestamp_millis("t"), period).alias("w")).agg(F.sum("delta").alias("delta"))
    w = Window.partitionBy("counter").orderBy("period_end").rowsBetween(Window.unboundedPreceding, 0)
    return by_period.select("counter", F.col("w.end").alias("period_end"), "delta").withColumn("total", F.sum("delta").over(w)).drop("delta")
