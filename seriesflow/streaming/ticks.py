"""Rates and reports of a stream at fixed ticks, also where nothing happens: timers in state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .streams import rocks


class Rates(StatefulProcessor):
    """Per key: the smoothed rate, the tick that is open, and its events so far. A tick closes when a later event comes, or when the watermark passes its end."""

    def __init__(self, width: int, alpha: float):
        self.width, self.alpha = width, alpha

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rate", "rate double, tick long, n long, timer long")

    def _closed(self, rate: float, first: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tick ends, rates) of consecutive ticks. Without a rate yet (NaN) the first tick sets it."""
        ends = (first + np.arange(len(counts)) + 1) * self.width
        rates = np.empty(len(counts))
        for k, n in enumerate(counts.tolist()):
            x = n * 1000 / self.width
            rate = x if rate != rate else rate + self.alpha * (x - rate)
            rates[k] = rate
        return ends, rates

    def _advance(self, key, rate: float, tick: int, n: int, until: int, counts: dict[int, int]) -> tuple[pd.DataFrame, tuple]:
        """Closes the ticks from `tick` (with n events) up to before `until`; counts has the events of those after it."""
        each = np.zeros(until - tick, np.int64)
        each[0] = n
        for t, c in counts.items():
            if t < until:
                each[t - tick] += c
        ends, rates = self._closed(rate, tick, each)
        return pd.DataFrame({"key": [key[0]] * len(ends), "tick_end": ends, "rate": rates}), (float(rates[-1]), until, counts.get(until, 0))

    def _keep(self, rate: float, tick: int, n: int, timer: int | None) -> None:
        """Stores the open tick, with one timer at its end."""
        end = (tick + 1) * self.width
        if timer != end:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(end)
        self.state.update((rate, tick, n, end))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ticks = np.concatenate([r["tick"].to_numpy(np.int64) for r in rows])
        found, n = np.unique(ticks, return_counts=True)
        rate, tick, have, timer = self.state.get() if self.state.exists() else (float("nan"), int(found[0]), 0, None)
        # What is older than the open tick has been reported without it.
        counts = {t: c for t, c in zip(found.tolist(), n.tolist(), strict=True) if t >= tick}
        have += counts.pop(tick, 0)
        last = max(counts, default=tick)
        if last > tick:
            out, (rate, tick, have) = self._advance(key, rate, tick, have, last, counts)
            yield out
        self._keep(rate, tick, have, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rate, tick, n, timer = self.state.get()
        until = timerValues.getCurrentWatermarkInMs() // self.width
        if until > tick:
            out, (rate, tick, n) = self._advance(key, rate, tick, n, until, {})
            yield out
        end = (tick + 1) * self.width
        self.handle.registerTimer(end)
        self.state.update((rate, tick, n, end))

    def close(self) -> None:
        pass


def stream_ewma_rate(events: DataFrame, key: str = "key", ts: str = "ts", seconds: int = 15, alpha: float = 0.2, delay: str = "0 seconds") -> DataFrame:
    """(key, tick_end, rate) of a stream of events, as stats.ewma_rate has them, and for each key on through all ticks that the watermark has passed, with events or without.

    The watermark follows the latest event of all keys, less delay; events that come later than that are left out."""
    rocks(events.sparkSession)
    width = seconds * 1000
    rows = events.select(F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("ts")).withWatermark("ts", delay)
    rows = rows.withColumn("tick", F.floor(F.unix_millis("ts") / width))
    out = rows.groupBy("key").transformWithStateInPandas(Rates(width, alpha), "key string, tick_end long, rate double", "Append", "EventTime")
    return out.select(F.col("key").alias(key), F.timestamp_millis("tick_end").alias("tick_end"), "rate")


class Totals(StatefulProcessor):
    """Per counter: the sum of all periods so far."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        data = pd.concat(list(rows)).sort_values("period_end")
        total = self.total.get()[0] if self.total.exists() else 0.0
        data["total"] = total + data["delta"].cumsum()
        self.total.update((float(data["total"].iloc[-1]),))
        yield data[["counter", "period_end", "total"]]

    def close(self) -> None:
        pass


def stream_counter_series(deltas: DataFrame, feeds: DataFrame, period: str = "60 seconds", delay: str = "0 seconds") -> DataFrame:
    """(counter, period_end, total) of a stream of deltas (stream_counter_deltas, written and read again): each counter's value at the end of each period with a change.

    Deltas are summed by period before a counter's state sees them, so a counter that many series feed has a row a period there. A period is reported when the watermark,
    the latest delta's time less delay, has passed its end. feeds(ref, counter) is static."""
    rocks(deltas.sparkSession)
    timed = deltas.withColumn("ts", F.timestamp_millis("t")).withWatermark("ts", delay).join(feeds.select("ref", "counter"), "ref")
    sums = timed.groupBy("counter", F.window("ts", period).alias("w")).agg(F.sum("delta").alias("delta"))
    rows = sums.select("counter", F.col("w.end").alias("period_end"), "delta")
    return rows.groupBy("counter").transformWithStateInPandas(Totals(), "counter string, period_end timestamp, total double", "Append", "None")
