"""Readers of series, samples, targets and metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..schemas import LOG, METADATA_RESPONSE, SCRAPES, SERIES, TARGET_RESPONSE


def _read(spark: SparkSession, path: str, schema, form: str) -> DataFrame:
    return spark.read.schema(schema).format(form).load(path)


def read_series(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    """(ref, labels, segment, seq)."""
    return _read(spark, path, SERIES, form)


def unpack_scrapes(scrapes: DataFrame) -> DataFrame:
    """(seq, scrape_id, ref, t, v) of rows that hold a scrape each."""
    return scrapes.select("scrape_id", F.explode("samples").alias("s")).select("s.seq", "scrape_id", "s.ref", "s.t", "s.v")


def pack_scrapes(samples: DataFrame) -> DataFrame:
    """The reverse: one row per scrape, its samples in order."""
    return samples.groupBy("scrape_id").agg(F.array_sort(F.collect_list(F.struct("seq", "ref", "t", "v"))).alias("samples"))


#: Streams take older files first, so files whose order counts are given times from here on (in milliseconds), a second each.
EARLIEST = 1_000_000_000_000


def set_times(spark: SparkSession, files: Sequence, time: int) -> None:
    """Gives files (Hadoop paths of one folder) a time."""
    if files:
        store = files[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for f in files:
            store.setTimes(f, time, -1)


def append_in_order(rows: DataFrame, path: str) -> None:
    """Adds rows to a folder of JSON lines, a file each partition, and makes the files' times follow the order of partitions."""
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = lambda: {f.getPath().getName(): f.getModificationTime() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-")}
    before = found() if store.exists(folder) else {}
    rows.write.mode("append").json(path)
    begin = max(before.values(), default=EARLIEST)
    for k, name in enumerate(sorted(set(found()) - set(before)), 1):
        set_times(spark, [jvm.org.apache.hadoop.fs.Path(folder, name)], begin + 1000 * k)


def read_samples(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    return unpack_scrapes(_read(spark, path, SCRAPES, form))


def read_samples_stream(spark: SparkSession, path: str, form: str = "json", files_per_trigger: int = 1) -> DataFrame:
    """An unbounded table of samples: new files of scrapes are picked up as they come."""
    return unpack_scrapes(read_scrapes_stream(spark, path, form, files_per_trigger))


def read_scrapes_stream(spark: SparkSession, path: str, form: str = "json", files_per_trigger: int = 1) -> DataFrame:
    """The same, a row for each scrape."""
    return spark.readStream.schema(SCRAPES).format(form).option("maxFilesPerTrigger", files_per_trigger).load(path)


def _documents(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON documents with place: struct<file, block, row>, which is in order of files' names, then of lines.

    A block of a file is read by one task, line after line, so that within a block the task's own counter tells the order; between blocks, their begin does.
    No number is made of these: places compare field by field, whatever the number and size of files."""
    docs = spark.read.schema(schema).json(path)
    meta = docs.withColumns({"__file": F.col("_metadata.file_path"), "__block": F.col("_metadata.file_block_start"), "__row": F.monotonically_increasing_id()})
    return meta.withColumn("place", F.struct(F.col("__file").alias("file"), F.col("__block").alias("block"), F.col("__row").alias("row"))).drop("__file", "__block", "__row")


def _ordinal() -> Column:
    return F.struct("place.file", "place.block", "place.row", "pos").alias("ordinal")


def pack_log(samples: DataFrame, records: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """One row per scrape: its samples, and what the log has there of series records(scrape_id, seq, ref, labels, segment) and removals(scrape_id, seq, ref, checkpoint)."""
    fields = {n: [f.name for f in LOG[n].dataType.elementType.fields] for n in ("samples", "series", "removed")}
    part = lambda df, n: df.select("scrape_id", F.struct(*fields[n]).alias(n))
    rows = part(samples, "samples").unionByName(part(records, "series"), allowMissingColumns=True)
    if removed is not None:
        rows = rows.unionByName(part(removed, "removed"), allowMissingColumns=True)
    in_order = lambda c: F.array_sort(F.collect_list(c), lambda x, y: F.signum(x["seq"] - y["seq"]).cast("int")).alias(c)
    return rows.groupBy("scrape_id").agg(*(in_order(n) for n in fields if n in rows.columns))


def read_log_stream(spark: SparkSession, path: str, form: str = "json", files_per_trigger: int = 1) -> DataFrame:
    """(seq, ref, scrape_id, t, v, labels, segment, checkpoint) of an unbounded log: t and v are a sample's, labels and segment a series record's, checkpoint a removal's; the others are null."""
    rows = spark.readStream.schema(LOG).format(form).option("maxFilesPerTrigger", files_per_trigger).load(path)
    own = ("t", "v", "labels", "segment", "checkpoint")
    kinds = {f.name: f.dataType for n in ("samples", "series", "removed") for f in LOG[n].dataType.elementType.fields}
    part = lambda n, has: F.transform(F.coalesce(n, F.array().cast(LOG[n].dataType)), lambda s: F.struct(s["seq"].alias("seq"), s["ref"].alias("ref"), *((s[c] if c in has else F.lit(None)).cast(kinds[c]).alias(c) for c in own)))
    every = F.concat(part("series", ("labels", "segment")), part("samples", ("t", "v")), part("removed", ("checkpoint",)))
    return rows.select("scrape_id", F.explode(every).alias("r")).select("r.seq", "r.ref", "scrape_id", *(f"r.{c}" for c in own))


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, labels, discovered) of target responses (a JSON document per line or file); documents without success are left out.

    ordinal, a struct, orders targets within a document as they stand there, documents as their lines, and files by name."""
    docs = _documents(spark, path, TARGET_RESPONSE).filter("status = 'success'")
    numbered = docs.select("place", F.posexplode("data.activeTargets").alias("pos", "t"))
    return numbered.select(_ordinal(), "t.labels", F.col("t.discoveredLabels").alias("discovered"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, metric, metric_type, help) of metadata responses; not_found is empty, any other error raises when it is reached. ordinal: as of read_targets."""
    docs = _documents(spark, path, METADATA_RESPONSE)
    bad = F.col("errorType").isNotNull() & ~F.col("errorType").isin("", "not_found")
    rows = F.when(bad, F.raise_error(F.concat(F.lit("metadata lookup failed: "), F.coalesce("error", F.lit(""))))).otherwise(F.col("data"))
    numbered = docs.select("place", F.posexplode(rows).alias("pos", "m"))
    return numbered.select(_ordinal(), "m.metric", L.normal_type(F.col("m.type")).alias("metric_type"), "m.help")


def with_static_labels(targets: DataFrame, static: Mapping[str, str]) -> DataFrame:
    """targets with constant discovered labels; empty ones are left out, and a constant replaces a label of its name."""
    return targets.withColumn("discovered", L.with_static(F.col("discovered"), dict(static)))


def resume_from(samples: DataFrame, offset: int, margin: int) -> DataFrame:
    """The samples from a saved place on, less a margin: none is lost, some come again."""
    return samples.filter(F.col("seq") >= offset - margin)
