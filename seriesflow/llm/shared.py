"""Tables written to the shared folder, and text kernels over Arrow string columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that count as white space in texts.
SPACE = "\\x20\\x09-\\x0D"
CHUNK_BYTES = 1 << 19
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches that go to Python are bounded by bytes as well as by rows, unless the session says otherwise: texts are long."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or, where that is unset and Spark is one local process, a temporary one."""
    bounded_batches(spark)
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="seriesflow-")
    context.setCheckpointDir(path)
    return context.getCheckpointDir()


#: Per open scratch, the paths made since.
_made: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _made:
        _made[-1].append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession):
    """What is written into the shared folder in here is deleted at the end."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            delete(spark, path)


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or URI, for tasks that read or write files by themselves, and the path in it."""
    if path.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: what follows starts from files that survive a lost executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_counted(rows: DataFrame, counted: DataFrame, on: str | list[str], m: str = "m") -> DataFrame:
    """rows joined with a written table of one row a key, which has in m how many of rows have the key.

    Keys with so many rows that a task would notice are few, at most four a partition: they are broadcast, so that their rows stay where they are."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bound = (counted.agg(F.sum(m)).first()[0] or 0) // (4 * parts) + 1
    hot = counted.filter(F.col(m) > bound)
    if hot.isEmpty():
        return rows.join(counted, on)
    others = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(counted.filter(F.col(m) <= bound), on)
    return rows.join(F.broadcast(hot), on).unionByName(others)


def ranged(values: DataFrame, column: str) -> DataFrame:
    """A written table of different values with __part: parts are ranges of the column, in order, and no task or group holds more than one."""
    return cut(values.repartitionByRange(column).withColumn("__part", F.spark_partition_id()), "ranged")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer until no column of df has them, in whatever case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold_spaces(text: Column) -> Column:
    """Each run of white space becomes one space; only runs that change are matched. Null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x09-\\x0D][\\x20\\x09-\\x0D]*|\\x20[\\x20\\x09-\\x0D]+", " ")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets) of pieces of a batch with about `limit` bytes each; a longer text is a piece of its own."""
    col = batch.column(column)
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        kind = np.int32
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if not n:
        return
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, kind)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        end = min(end, n)
        yield at, end, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_CODES = mix64(np.arange(1, 257, dtype=np.uint64))
class _Local(dict):
    """A dictionary that each process fills for itself: functions that are sent to executors take it along empty."""

    def __reduce__(self):
        return type(self), ()


_powers = _Local()


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_powers.get("up", ())):
        size = 1 << n.bit_length()
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def words(data: np.ndarray, offs: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a piece's words (runs without white space): 64-bit hash, start, end, and the position of each text's first word.

    A hash is a sum of byte codes times powers of an odd number, modulo 2^64, then mixed."""
    folded = _LOWER[data] if lower else data
    n = len(data)
    solid = ~_IS_SPACE[data]
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    inner = offs[:-1][offs[:-1] < n]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    ends_at = offs[1:][offs[1:] > 0] - 1
    after[ends_at] = False
    ends = np.flatnonzero(solid & ~after) + 1
    up, down = _power(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[folded] * up[:n], out=total[1:])
    hashes = mix64((total[ends] - total[starts]) * down[starts])
    return hashes, starts, ends, np.searchsorted(starts, offs)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of `size` words of each text, text after text, and the position of each text's first. A text with fewer words has one, of all its words; a text without words none."""
    counts = np.diff(first)
    per = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    at = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(per, out=at[1:])
    out = np.zeros(at[-1], np.uint64)
    full = counts >= size
    if len(hashes) >= size:
        run = np.zeros(len(hashes) - size + 1, np.uint64)
        for k in range(size):
            run = mix64(run + hashes[k : len(hashes) - size + 1 + k] + np.uint64(k + 1))
        text = np.repeat(np.flatnonzero(full), per[full])
        inside = np.arange(len(text)) - np.repeat(np.cumsum(per[full]) - per[full], per[full])
        out[at[:-1][text] + inside] = run[first[:-1][text] + inside]
    for k in np.flatnonzero(~full & (counts > 0)):
        h = np.zeros(1, np.uint64)
        for j in range(counts[k]):
            h = mix64(h + hashes[first[k] + j] + np.uint64(j + 1))
        out[at[k]] = h[0] ^ np.uint64(counts[k])
    return out, at
