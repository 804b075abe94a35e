"""Line deduplication by range-partitioned hashes.

Occurrences of lines (hash, document, position) are range-partitioned by hash and document, so that a very common line is
spread over many partitions, and sorted within each partition by hash, document (largest first) and position. A streaming
pass decides all lines whose occurrences lie inside one partition. Lines at the two ends of a partition may go on in the
next one: of these the pass returns partial counts, which are added up, and the occurrences, which are decided by the sum.
What comes back is one compressed bitmap per document that loses lines, not text.

A line's key is the line without white space at both ends and with A-Z lower-cased. Null and empty texts are one empty
line. Of the documents that hold a line, the largest id keeps all its copies of it. Rows that repeat an id are treated as one document's texts with separate bitmaps. Rows without an id count as one
document whose lines are never kept in favour of a document with an id. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, documents, lower_ascii, unused

MIN_CHARS = 40
MIN_DOCS = 5
#: Bitmaps of up to so many bytes are broadcast.
BROADCAST_BYTES = 32 << 20
_EMPTY_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def occurrences(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h, tag, doc, salt, pos) of each line whose key has at least min_chars characters; h and tag are two hashes of the key."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_EMPTY_ID)).alias("doc"), F.xxhash64(body).alias("salt"), F.posexplode(F.split(body, "\n", -1)).alias("pos", "line"))
    keyed = lines.filter(F.length("line") >= min_chars).select("doc", "salt", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= min_chars).select(F.xxhash64("key").alias("h"), F.hash("key").alias("tag"), "doc", "salt", "pos")


_STREAMED = pa.schema([("h", pa.int64()), ("tag", pa.int32()), ("doc", pa.int64()), ("salt", pa.int64()), ("pos", pa.int32()), ("open", pa.bool_()), ("n_docs", pa.int64())])


class _Key:
    """What a partition's pass knows of the line that it is at."""

    def __init__(self, key: tuple[int, int], opening: bool):
        self.key, self.opening = key, opening
        self.keeper = self.last = None
        self.docs = 0
        #: Rows that go if the line turns out to be in enough documents; those of min_docs - 1 documents at most.
        self.pending: list[pa.RecordBatch] = []


def _streamed(min_docs: int):
    """Per partition, over rows in order of (h, tag, doc descending, pos): drops of decided lines, and the open ends.

    A line's rows are passed on as they come. Only those before its min_docs-th document wait."""

    def told(rows: pa.RecordBatch, is_open: bool) -> pa.RecordBatch:
        n = rows.num_rows
        return pa.RecordBatch.from_arrays([*rows.columns, pa.repeat(pa.scalar(is_open), n), pa.repeat(pa.scalar(0, pa.int64()), n)], schema=_STREAMED)

    def end(at: _Key) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"h": at.key[0], "tag": at.key[1], "doc": at.keeper, "salt": 0, "pos": -1, "open": True, "n_docs": at.docs}], _STREAMED)

    def stream(batches):
        now: _Key | None = None

        def add(rows: pa.RecordBatch, doc: np.ndarray):
            """Rows of the present line."""
            before = doc[0] if now.last is None else now.last
            now.docs += int(now.last is None) + int(doc[0] != before) + int(np.count_nonzero(doc[1:] != doc[:-1]))
            now.keeper = int(doc[0]) if now.keeper is None else now.keeper
            now.last = int(doc[-1])
            if now.opening:
                yield told(rows, True)
                return
            now.pending.append(rows.filter(pa.array(doc != now.keeper)))
            if now.docs >= min_docs:
                for part in now.pending:
                    yield told(part, False)
                now.pending = []

        def decided(rows: pa.RecordBatch, doc: np.ndarray, new_key: np.ndarray):
            """Rows of lines that begin and end in a batch."""
            new_doc = new_key.copy()
            new_doc[1:] |= doc[1:] != doc[:-1]
            run, at = np.cumsum(new_key) - 1, np.flatnonzero(new_key)
            n_docs = np.add.reduceat(new_doc.astype(np.int64), at)
            yield told(rows.filter(pa.array((n_docs[run] >= min_docs) & (doc != doc[at][run]))), False)

        for batch in batches:
            if not batch.num_rows:
                continue
            h, tag, doc = (batch.column(c).to_numpy() for c in ("h", "tag", "doc"))
            new_key = np.ones(len(h), bool)
            new_key[1:] = (h[1:] != h[:-1]) | (tag[1:] != tag[:-1])
            at = np.flatnonzero(new_key)
            last, done = int(at[-1]), 0
            if now is not None and now.key == (h[0], tag[0]):
                done = int(at[1]) if len(at) > 1 else len(h)
                yield from add(batch.slice(0, done), doc[:done])
            if done == len(h):
                continue
            if now is not None and now.opening:
                yield end(now)
            if now is None and len(at) > 1:
                # The partition's first line may have begun in the one before.
                now, done = _Key((h[0], tag[0]), True), int(at[1])
                yield from add(batch.slice(0, done), doc[:done])
                yield end(now)
            if last > done:
                yield from decided(batch.slice(done, last - done), doc[done:last], new_key[done:last])
            now = _Key((h[last], tag[last]), now is None)
            yield from add(batch.slice(last), doc[last:])
        if now is not None:
            yield end(now)
            for part in now.pending:
                yield told(part, True)

    return stream


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, salt, pos) of each line to drop: its key is in min_docs documents or more, and this document isn't the largest of them."""
    # Range partitioning reads its input twice (bounds, then rows): texts are split once.
    rows = cut(occurrences(docs, id_col, text_col, min_chars), "occurrences")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["h", "tag", F.desc("doc"), "pos"]
    ranged = rows.repartitionByRange(parts, "h", "tag", F.desc("doc")).sortWithinPartitions(*order)
    schema = "h long, tag int, doc long, salt long, pos int, open boolean, n_docs long"
    streamed = cut(ranged.mapInArrow(_streamed(min_docs), schema), "streamed")
    # At most two partial counts a partition, whatever the data.
    ends = streamed.filter("pos = -1").groupBy("h", "tag").agg(F.sum("n_docs").alias("docs"), F.max("doc").alias("keeper"))
    open_rows = streamed.filter("open and pos >= 0").join(F.broadcast(ends), ["h", "tag"])
    late = open_rows.filter((F.col("docs") >= min_docs) & (F.col("doc") != F.col("keeper")))
    return streamed.filter("not open").select("doc", "salt", "pos").unionByName(late.select("doc", "salt", "pos"))


def _packed(dropped: list[int]) -> bytes:
    # Whole bytes, so that what fills the last one is kept.
    bits = np.ones((max(dropped) // 8 + 1) * 8, np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, salt, keep): for each document that loses lines, a zlib-compressed bitmap with a 1 for each line to keep, 0 for each to drop.

    Lines after its last bit are kept. doc is the id (null ids: the smallest long), salt a hash of the text."""
    gone = dropped_lines(docs, id_col, text_col, min_chars, min_docs).groupBy("doc", "salt").agg(F.collect_set("pos").alias("lines"))

    def pack(batches):
        for batch in batches:
            packed = [_packed(x) for x in batch.column("lines").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("salt"), pa.array(packed, pa.binary())], ["doc", "salt", "keep"])

    return gone.mapInArrow(pack, "doc long, salt long, keep binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with kept_text, n_lines (before) and n_dropped; columns of docs with these names are replaced.

    Bitmaps are measured: up to BROADCAST_BYTES they go to the texts, and only beyond it both are shuffled."""
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    bitmaps = cut(bitmaps, "bitmaps")
    # 64 bytes for ids, hashes and what a row costs in a table of the join.
    small = (bitmaps.agg(F.sum(F.octet_length("keep") + 64)).first()[0] or 0) <= BROADCAST_BYTES
    bitmaps = F.broadcast(bitmaps) if small else bitmaps
    doc, salt, keep = unused(docs, "__doc", "__salt", "__keep")
    keyed = docs.withColumns({doc: F.coalesce(F.col(id_col).cast("long"), F.lit(_EMPTY_ID)), salt: F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    maps = bitmaps.select(F.col("doc").alias(doc), F.col("salt").alias(salt), F.col("keep").alias(keep))
    joined = keyed.join(maps, [doc, salt], "left").drop(doc, salt)
    schema = joined.drop(keep).schema
    for name, kind in (("kept_text", "string"), ("n_lines", "long"), ("n_dropped", "long")):
        schema = schema.add(name, kind)

    def thin(batches):
        for batch in batches:
            texts, maps, kept, counts, losses = batch.column(text_col), batch.column(keep), [], [], []
            for text, packed in zip(texts.to_pylist(), maps.to_pylist(), strict=True):
                text = text or ""
                lost = 0
                if packed is None:
                    counts.append(text.count("\n") + 1)
                    kept.append(text)
                else:
                    lines = text.split("\n")
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), bitorder="little")[: len(lines)]
                    gone = set(np.flatnonzero(bits == 0).tolist())
                    lost = len(gone)
                    counts.append(len(lines))
                    kept.append("\n".join(x for k, x in enumerate(lines) if k not in gone))
                losses.append(lost)
            cols = [batch.column(n) for n in batch.schema.names if n != keep]
            names = [n for n in batch.schema.names if n != keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(losses, pa.int64())], [*names, "kept_text", "n_lines", "n_dropped"])

    return joined.mapInArrow(thin, schema)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    thinned = apply_bitmaps(docs, keep_bitmaps(docs))
    return thinned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents),
l as (select doc_id, generate_subscripts(ls, 1) pos, unnest(ls) line from d),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from l),
c as (select key, count(distinct doc_id) n, max(doc_id) keeper from k where length(key) >= 40 group by key),
m as (select k.*, coalesce(c.n >= 5 and k.doc_id <> c.keeper, false) gone from k left join c using (key))
select doc_id, count(*) n_lines, count(*) filter (where gone) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) kept_sha256
from m group by doc_id
"""
