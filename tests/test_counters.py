import math
import random

import pytest
from pyspark.sql import functions as F

from seriesflow.functions.matchers import Matcher
from seriesflow.operators import counters as C
from seriesflow.operators import overlap as O
from seriesflow.operators import spread as S

from .util import rows

SAMPLES = "seq long, ref long, t long, v double"


def table(spark, points, ref=1):
    return spark.createDataFrame([(k, ref, t, float(v)) for k, (t, v) in enumerate(points)], SAMPLES)


@pytest.mark.parametrize(
    ("points", "want"),
    [
        ([(2000, 5.5), (3000, 8), (4000, 9), (5000, 7)], [(2000, 3000, 2.5), (2000, 4000, 3.5), (4999, 5000, 7.0)]),
        (
            [(2000, 5), (3000, 8), (4000, 9), (5000, 8), (6000, 4), (7000, 12), (8000, 1)],
            [(2000, 3000, 3.0), (2000, 4000, 4.0), (4999, 5000, 8.0), (5999, 6000, 4.0), (5999, 7000, 12.0), (7999, 8000, 1.0)],
        ),
        ([(1000, 3), (2000, 3)], [(1000, 2000, 0.0)]),
    ],
)
def test_reset_adjust(spark, points, want):
    out = C.reset_adjust(table(spark, points)).filter("not first")
    assert rows(out, "start", "t", "adjusted", order="seq") == want


@pytest.mark.parametrize(
    ("points", "want"),
    [
        ([(1, 15), (2, 25)], [10.0]),
        ([(1, 15), (2, 25), (3, 5), (4, 25), (5, 15)], [10.0, 5.0, 20.0, 15.0]),
        ([(1, 15), (2, math.nan), (3, 25)], [10.0]),
        ([(1, 15), (3, 25), (2, 20), (4, 30)], [10.0, 5.0]),
        ([(1, 15), (2, 15)], []),
    ],
)
def test_deltas(spark, points, want):
    assert [r[0] for r in rows(C.deltas_of(table(spark, points)), "delta", order="seq")] == want


def test_overlap_of_two_feeders(spark):
    # Two series that feed one output series, as (ref, t, v).
    data = [(1, 1000, 4), (2, 1500, 4), (1, 2000, 9), (2, 2500, 9), (1, 3500, 3), (2, 3600, 10)]
    df = spark.createDataFrame([(k, r, t, float(v), "s") for k, (r, t, v) in enumerate(data)], SAMPLES + ", series_key string")
    points = C.reset_adjust(df).filter("not first").drop("v", "first")
    assert rows(O.reject_overlaps(points), "start", "t", "adjusted", order="seq") == [(1000, 2000, 5.0), (3499, 3500, 3.0)]


def fold(samples):
    """Sequential resets and overlaps, to compare with."""
    state, last, out = {}, {}, []
    for seq, ref, t, v, key in samples:
        if ref not in state:
            state[ref] = (v, t, v)
            continue
        base, start, previous = state[ref]
        if v < previous:
            base, start = 0.0, t - 1
        state[ref] = (base, start, v)
        if key in last and not O.accepts(start, t, *last[key]):
            continue
        last[key] = (start, t)
        out.append((seq, start, t, v - base))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_windows_and_fold_match_a_sequential_run(spark, seed):
    rng = random.Random(seed)
    clock = {}
    data = []
    for k in range(1500):
        ref = rng.randrange(12)
        clock[ref] = clock.get(ref, 1000) + rng.choice((0, 5, 10, -3, 20))
        data.append((k, ref, clock[ref], float(rng.randrange(30)), f"s{ref // 3}" if ref < 9 else f"own{ref}"))
    df = spark.createDataFrame(data, SAMPLES + ", series_key string")
    points = O.reject_overlaps(C.reset_adjust(df).filter("not first").drop("v", "first"))
    assert rows(points, "seq", "start", "t", "adjusted", order="seq") == fold(data)


def test_aggregated_counter_uses_every_filterset(spark):
    samples = spark.createDataFrame([(0, 1, 1, 1.0), (1, 1, 2, 4.0), (2, 2, 1, 5.0), (3, 2, 2, 6.0), (4, 3, 1, 0.0), (5, 3, 2, 9.0)], SAMPLES)
    series = spark.createDataFrame([(1, {"__name__": "a"}), (2, {"__name__": "b"}), (3, {"__name__": "c"})], "ref long, labels map<string,string>")
    config = {"x": [[Matcher("__name__", "=", "a")], [Matcher("__name__", "=~", "b.*")]], "all": [[Matcher("missing", "=", "")]]}
    assert rows(C.aggregated_counter(samples, series, config), "counter", "total") == [("all", 13.0), ("x", 4.0)]


def test_gauges_need_later_ends(spark):
    df = table(spark, [(1, 0), (3, 0), (3, 0), (2, 0), (4, 0)]).withColumnRenamed("ref", "series_key")
    assert [r[0] for r in rows(O.reject_overlaps_gauge(df), "t", order="seq")] == [1, 3, 4]


@pytest.mark.parametrize("seed", range(2))
def test_a_hot_series_is_cut_and_gives_the_same(spark, seed):
    """Two refs, one of them null, have most of all samples; with blocks of few samples all results are those of one window per series."""
    rng = random.Random(seed)
    clock, data = {}, []
    for k in range(3000):
        ref = rng.choice((1,) * 12 + (None,) * 3 + (2, 3))
        clock[ref] = clock.get(ref, 1000) + rng.choice((0, 5, 10, -30, 20))
        # A long time without a reset, then many.
        v = float(k + rng.randrange(3)) if k < 2000 else float(rng.randrange(30))
        data.append((7 * k, ref, clock[ref], math.nan if k % 50 == 3 else v))
    df = spark.createDataFrame(data, SAMPLES)
    dealt = S.spread(df, ["ref"], least=40)
    sizes = {(r[0], r[1]): r[2] for r in dealt.groupBy("ref", S.BLOCK).count().collect()}
    # A quarter of a partition's share is 94.
    assert max(sizes.values()) <= 200 and len([1 for r, _ in sizes if r == 1]) > 15 and len([1 for r, b in sizes if r is None and b >= 0]) > 3
    live = C.drop_nan(df)
    for f, columns in ((C.reset_adjust, ("seq", "ref", "first", "start", "adjusted")), (C.drop_out_of_order, ("seq", "ref", "t", "v")), (C.counter_deltas, ("seq", "ref", "delta"))):
        assert rows(f(live, least=40), *columns, order="seq") == rows(f(live), *columns, order="seq")
    assert rows(C.deltas_of(df, least=40), "seq", "ref", "delta", order="seq") == rows(C.deltas_of(df), "seq", "ref", "delta", order="seq")
    assert S.spread(df, ["ref"], least=5000) is None


def test_a_hot_series_is_read_by_many_tasks(spark):
    """No task of the window has more than some blocks of a series that has all rows."""
    df = spark.range(20000).selectExpr("id seq", "1L ref", "id * 10 t", "cast(id % 977 as double) v")
    out = C.reset_adjust(df, least=500)
    per = [r[0] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).select("n").collect()]
    assert sum(per) == 20000 and max(per) < 10000
    assert out.agg(F.sum("adjusted")).first()[0] == C.reset_adjust(df).agg(F.sum("adjusted")).first()[0]


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_of_a_hot_key_in_blocks(spark, seed):
    """Random intervals of one key (some outlast many blocks), of a null key and of others, against one fold per key."""
    rng = random.Random(seed)
    data, t = [], {}
    for k in range(2500):
        key = rng.choice(("hot",) * 12 + (None,) * 3 + ("a", "b"))
        now = t[key] = t.get(key, 0) + rng.choice((0, 1, 4, 9, -6))
        start = None if rng.random() < 0.05 else now - rng.randrange(1, 12) if seed else now // 40 * 40
        data.append((5 * k, key, start, now + (400 * (seed == 2 and rng.random() < 0.004)), f"x{k}"))
    df = spark.createDataFrame(data, "seq long, series_key string, start long, t long, more string")
    want, last = [], {}
    for seq, key, start, end, _ in data:
        if key not in last or O.accepts(start or 0, end, *last[key]):
            last[key] = (start or 0, end)
            want.append((seq, f"x{seq // 5}"))
    assert S.spread(df, ["series_key"], least=20).filter("series_key = 'hot'").select(S.BLOCK).distinct().count() > 15
    assert rows(O.reject_overlaps(df, least=20), "seq", "more", order="seq") == want
    assert rows(O.reject_overlaps(df), "seq", "more", order="seq") == want
