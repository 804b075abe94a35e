import datetime
import random

import pytest
from pyspark.sql import functions as F

from seriesflow.operators import stats


@pytest.mark.parametrize("alpha", [0.2, 0.05, 0.9, 1.0])
def test_rates_of_ticks_with_long_gaps_equal_a_sequential_run(spark, alpha):
    rng = random.Random(1)
    data, counts = [], {}
    for key in ("a", "b", None):
        t = 1_700_000_003
        for _ in range(300):
            t += rng.choice((0, 1, 3, 20, 70, 2500 if rng.random() < 0.05 else 5))
            data.append((key, datetime.datetime.fromtimestamp(t, datetime.UTC)))
            counts.setdefault(key, {})
            counts[key][t // 15] = counts[key].get(t // 15, 0) + 1
    want = []
    for key, of in counts.items():
        rate = None
        for tick in range(min(of), max(of) + 1):
            x = of.get(tick, 0) / 15
            rate = x if rate is None else rate + alpha * (x - rate)
            want.append((key, (tick + 1) * 15, rate))
    got = stats.ewma_rate(spark.createDataFrame(data, "key string, ts timestamp"), alpha=alpha).select("key", F.unix_seconds("tick_end"), "rate").collect()
    by = lambda r: (r[0] is None, *r[:2])
    got = sorted((tuple(r) for r in got), key=by)
    assert [r[:2] for r in got] == [w[:2] for w in want]
    assert [r[2] for r in got] == pytest.approx([w[2] for w in want], rel=1e-12, abs=1e-15)


def test_a_key_of_very_many_ticks_is_many_tasks_work(spark):
    """Two events, years apart: no row holds more than a block of ticks."""
    df = spark.createDataFrame([("a", datetime.datetime(2001, 1, 1, tzinfo=datetime.UTC)), ("a", datetime.datetime(2002, 1, 1, tzinfo=datetime.UTC))], "key string, ts timestamp")
    out = stats.ewma_rate(df, tick="1 minute")
    n, last = out.agg(F.count(F.lit(1)), F.max_by("rate", "tick_end")).first()
    assert n == 365 * 1440 + 1 and last == pytest.approx(0.2 / 60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert out.select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
