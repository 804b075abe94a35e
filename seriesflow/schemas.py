"""Schemas of the tables that the engine reads and makes."""

from __future__ import annotations

from pyspark.sql import types as T

LABELS = T.MapType(T.StringType(), T.StringType())


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


SERIES = _struct(ref=T.LongType(), labels=LABELS, segment=T.IntegerType(), seq=T.LongType())
#: One row per scrape; its samples are applied together.
SCRAPES = _struct(scrape_id=T.LongType(), samples=T.ArrayType(_struct(seq=T.LongType(), ref=T.LongType(), t=T.LongType(), v=T.DoubleType())))
#: One row per scrape with the records that define series (anew) or remove them on the way; seq orders all.
LOG = T.StructType(SCRAPES.fields).add("series", T.ArrayType(_struct(seq=T.LongType(), ref=T.LongType(), labels=LABELS, segment=T.IntegerType()))).add("removed", T.ArrayType(_struct(seq=T.LongType(), ref=T.LongType(), checkpoint=T.IntegerType())))
SAMPLES = _struct(seq=T.LongType(), scrape_id=T.LongType(), ref=T.LongType(), t=T.LongType(), v=T.DoubleType())
TARGET_RESPONSE = _struct(status=T.StringType(), data=_struct(activeTargets=T.ArrayType(_struct(labels=LABELS, discoveredLabels=LABELS))))
METADATA_RESPONSE = _struct(status=T.StringType(), errorType=T.StringType(), error=T.StringType(), data=T.ArrayType(_struct(metric=T.StringType(), type=T.StringType(), help=T.StringType())))
DISTRIBUTION = _struct(count=T.LongType(), mean=T.DoubleType(), sum_sq_dev=T.DoubleType(), bounds=T.ArrayType(T.DoubleType()), bucket_counts=T.ArrayType(T.LongType()))
METRIC_TYPES = ("counter", "gauge", "histogram", "summary", "unknown")
VALUE_TYPES = ("double", "int64")
