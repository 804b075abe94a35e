"""Points of one output series may not overlap: a point is kept only if its interval extends or follows the last kept one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.shared import written
from .spread import BLOCK, spread

Interval = tuple[int, int] | None


def accepts(start: int, end: int, last_start: int, last_end: int) -> bool:
    """Whether an interval may follow the last kept one: the same start and a later end, or a later start that isn't before that end."""
    return (start == last_start and end > last_end) or (start > last_start and start >= last_end)


def accepted(start: np.ndarray, end: np.ndarray, last_start: np.ndarray, last_end: np.ndarray) -> np.ndarray:
    """The same of arrays."""
    return ((start == last_start) & (end > last_end)) | ((start > last_start) & (start >= last_end))


def _follows(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of each interval but the first: whether it may follow the one before."""
    return accepted(start[1:], end[1:], start[:-1], end[:-1])


def _fold(batches):
    """Rows in order of key and seq without the rejected ones. State is the last kept interval of the present key."""
    now, last = _fold, None
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column("__key").dictionary_encode()
        names, of = [*codes.dictionary.to_pylist(), None], codes.indices.fill_null(len(codes.dictionary)).to_numpy(zero_copy_only=False)
        starts, ends = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__start", "__end"))
        keep = np.ones(len(of), bool)
        edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
        # A row that may follow the one before it, as all before it may, is kept.
        calm = np.append(True, _follows(starts, ends))
        broken = np.append(0, np.cumsum(~calm))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if names[of[a]] != now:
                now, last = names[of[a]], None
            if broken[b] == broken[a + 1] and (last is None or accepts(starts[a], ends[a], *last)):
                last = (starts[b - 1], ends[b - 1])
                continue
            for k in range(a, b):
                keep[k] = last is None or accepts(starts[k], ends[k], *last)
                if keep[k]:
                    last = (starts[k], ends[k])
        yield batch.filter(pa.array(keep)).drop_columns(["__key", "__start", "__end"])


def reject_overlaps(points: DataFrame, key: str = "series_key", least: int | None = None) -> DataFrame:
    """points(key, seq, start (null for gauges), t) without the rejected ones.

    Only the last kept point counts, so rows are folded in order of seq: one shuffle by key, and a pass that holds a batch and one interval.
    A key with very many points is cut into blocks (spread), and each of its blocks is folded by itself, see _entries."""
    rows = points.withColumns({"__key": F.col(key), "__start": F.coalesce("start", F.lit(0)).cast("long"), "__end": F.col("t").cast("long")})
    dealt = spread(rows, ["__key"], least=least)
    folded = lambda x: x.repartition(key).sortWithinPartitions(key, "seq").mapInArrow(_fold, points.schema)
    if dealt is None:
        return folded(rows)
    dealt = written(dealt, "blocks")
    hot = dealt.filter(F.col(BLOCK) >= 0)
    entries = _entries(hot.select("__key", BLOCK, "seq", "__start", "__end"))

    def fold(batches):
        yield from _fold_blocks(batches, entries)

    blocks = hot.repartition("__key", BLOCK).sortWithinPartitions("__key", BLOCK, "seq").mapInArrow(fold, points.schema)
    return blocks.unionByName(folded(dealt.filter(F.col(BLOCK) < 0).drop(BLOCK)))


def _blocks_of(batches):
    """(key, block, batch) of runs of rows of one block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, blocks = batch.column("__key").dictionary_encode(), batch.column(BLOCK).to_numpy(zero_copy_only=False)
        names, of = [*keys.dictionary.to_pylist(), None], keys.indices.fill_null(len(keys.dictionary)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero((of[1:] != of[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), len(of)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield names[of[a]], int(blocks[a]), batch.slice(a, b - a)


def _kept(starts: np.ndarray, ends: np.ndarray, last: Interval) -> tuple[np.ndarray, Interval]:
    """Which of a run of intervals are kept after `last`, and the last one kept then."""
    keep = np.ones(len(starts), bool)
    if (last is None or accepts(starts[0], ends[0], *last)) and _follows(starts, ends).all():
        return keep, (int(starts[-1]), int(ends[-1]))
    for k, (start, end) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        keep[k] = last is None or accepts(start, end, *last)
        if keep[k]:
            last = (start, end)
    return keep, last


def _fold_blocks(batches, entries: dict[tuple, Interval]):
    now, last = None, None
    for key, block, part in _blocks_of(batches):
        if (key, block) != now:
            now, last = (key, block), entries.get((key, block))
        keep, last = _kept(*(part.column(c).to_numpy(zero_copy_only=False) for c in ("__start", "__end")), last)
        yield part.filter(pa.array(keep)).drop_columns(["__key", "__start", "__end", BLOCK])


def _entries(rows: DataFrame) -> dict[tuple, Interval]:
    """The last kept interval before each block of rows(__key, __block, seq, __start, __end).

    What a block ends with depends on what it begins with, but little: folds from different beginnings soon keep the same points. So all blocks are folded
    at once, first from nothing, then each from the end of the one before it, as found so far. A key is walked from its first block on over what is
    known; where the walk meets a beginning that its block hasn't been folded from, that fold is wanted, and so are folds of the next blocks from the same
    interval (which a long one outlasts), twice as many each round. A round is a job over the wanted blocks; it ends a walk or takes it further, so the
    result is that of one fold. Per block, of which a cluster has some for each shuffle partition, only intervals come here."""
    spark = rows.sparkSession
    blocks: dict[object, int] = {r[0]: r[1] for r in rows.groupBy("__key").agg(F.max(BLOCK)).collect()}
    known: dict[tuple, dict[Interval, Interval]] = {(k, b): {} for k, most in blocks.items() for b in range(most + 1)}
    wanted: dict[tuple, set[Interval]] = {at: {None} for at in known}
    entries, ahead = {}, 1
    schema = T.StructType([rows.schema["__key"], *(T.StructField(n, T.LongType()) for n in ("block", "in_start", "in_end", "out_start", "out_end"))])
    while wanted:
        told = spark.sparkContext.broadcast(wanted)

        def ends(batches, told=told):
            now, states = None, {}

            def out():
                rows = [(*now, *(begin or (None, None)), *(last or (None, None))) for begin, last in states.items()]
                return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], arrow)

            arrow = to_arrow_schema(schema)
            for key, block, part in _blocks_of(batches):
                if (key, block) != now:
                    if now is not None:
                        yield out()
                    now, states = (key, block), {x: x for x in told.value.get((key, block), ())}
                starts, stops = (part.column(c).to_numpy(zero_copy_only=False) for c in ("__start", "__end"))
                states = {begin: _kept(starts, stops, last)[1] for begin, last in states.items()}
            if now is not None:
                yield out()

        mine = rows
        if len(wanted) < len(known):
            some = spark.createDataFrame(list(wanted), T.StructType([rows.schema["__key"], rows.schema[BLOCK]]))
            mine = rows.alias("a").join(F.broadcast(some.alias("b")), F.col(f"a.{BLOCK}").eqNullSafe(F.col(f"b.{BLOCK}")) & F.col("a.__key").eqNullSafe(F.col("b.__key"))).select("a.*")
        found = mine.repartition("__key", BLOCK).sortWithinPartitions("__key", BLOCK, "seq").mapInArrow(ends, schema).collect()
        told.destroy()
        pair = lambda a, b: None if a is None else (a, b)
        for key, block, *x in found:
            known[key, block][pair(*x[:2])] = pair(*x[2:])
        wanted, first = {}, ahead == 1
        for key, most in blocks.items():
            last = None
            for b in range(most + 1):
                entries[key, b] = last
                if last not in known[key, b]:
                    for then in range(b, min(b + ahead, most + 1)):
                        if last not in known[key, then]:
                            wanted.setdefault((key, then), set()).add(last)
                    break
                last = known[key, b][last]
            if first:
                # Each block from the end of the one before, as if that had begun with nothing.
                for b in range(1, most + 1):
                    guess = known[key, b - 1].get(None)
                    if guess not in known[key, b]:
                        wanted.setdefault((key, b), set()).add(guess)
        ahead *= 2
    return entries


def reject_overlaps_gauge(points: DataFrame, key: str = "series_key") -> DataFrame:
    """The same for keys that have gauges only: ends have to increase."""
    before = Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return points.withColumn("__last", F.max("t").over(before)).filter("__last is null or t > __last").drop("__last")
