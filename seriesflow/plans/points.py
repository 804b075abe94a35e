"""From samples and resolved series to points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators.counters import drop_nan, reset_adjust
from ..operators.histograms import assemble, distribution
from ..operators.overlap import reject_overlaps
from ..operators.series import join_series_asof
from ..sources.shared import side, written

POINT = ("series_key", "ref", "seq", "t", "start", "metric", "metric_kind", "value_type", "double_value", "int64_value", "distribution")
SERIES = ("ref", "series_key", "metric", "metric_kind", "metric_type", "value_type", "suffix", "base", "labels")


def typed_scalars(points: DataFrame) -> DataFrame:
    """points(value, value_type, metric_type) with double_value, int64_value and an empty distribution."""
    whole = F.when(F.col("metric_type") == "summary", F.col("value").try_cast("long")).otherwise(F.round("value").try_cast("long"))
    none = F.lit(None).cast("struct<count:bigint,mean:double,sum_sq_dev:double,bounds:array<double>,bucket_counts:array<bigint>>")
    return points.withColumns({"double_value": L.typed_double(F.col("value_type"), F.col("value")), "int64_value": F.when(F.col("value_type") == "int64", whole), "distribution": none})


def make_points(samples: DataFrame, resolved: DataFrame, definitions: DataFrame | None = None) -> DataFrame:
    """POINT columns of every point, overlaps not yet rejected.

    The dimension is written once. Samples are shuffled by ref, as numbers only, for one pass over all kinds of series; what they are
    joins afterwards. Only where histograms and scalars both occur that pass is written, for both to read.
    definitions(ref, seq) tells where the log defines a ref (anew): each definition starts the series' resets anew, and samples before a ref's first one go.
    If resolved has `defined`, it is what each definition (its seq) resolves to, and samples of one that doesn't resolve go."""
    each = ["ref", "defined"] if "defined" in resolved.columns else ["ref"]
    dimension = written(resolved.select(*SERIES, *each[1:]), "resolved")
    known = side(dimension.select(*each, F.col("metric_kind").alias("kind")))
    rows = drop_nan(samples).select("ref", "seq", "scrape_id", "t", "v")
    if definitions is None:
        rows = rows.join(known, each)
    else:
        # Of refs that don't resolve at all no sample has to find its definition.
        rows = rows.join(side(dimension.select("ref").distinct()), "ref", "left_semi")
        rows = join_series_asof(rows, definitions.select("ref", "seq", F.lit(None).cast("string").alias("labels"))).drop("labels").join(known, each)
    moved = reset_adjust(rows, ["ref"] if definitions is None else ["ref", "defined"])
    gauge = F.col("kind") == "GAUGE"
    moved = moved.select(*each, "seq", "scrape_id", "t", F.when(~gauge, F.col("start")).alias("start"), F.when(gauge, F.col("v")).otherwise(F.col("adjusted")).alias("value"), (~gauge & F.col("first")).alias("first"))
    kinds = {r[0] for r in dimension.select(F.col("value_type") == "distribution").distinct().collect()}
    made = []
    if len(kinds) > 1:
        moved = written(moved, "moved")
    if kinds != {True}:
        own = dimension.filter("value_type <> 'distribution'").drop("suffix", "base", "labels")
        made.append(typed_scalars(moved.filter("not first").join(side(own), each)).select(*POINT))
    if True in kinds:
        parts = moved.withColumnRenamed("value", "adjusted").join(side(dimension.filter("value_type = 'distribution'")), each)
        found = distribution(assemble(parts, ("series_key", "metric", "metric_kind", "value_type")))
        found = found.withColumns({"double_value": F.lit(None).cast("double"), "int64_value": F.lit(None).cast("long")})
        # A histogram is one feeder, whichever of its series comes first.
        made.append(found.withColumn("ref", F.xxhash64("base", "key")).select(*POINT))
    return reduce(DataFrame.unionByName, made)


def points(samples: DataFrame, resolved: DataFrame, definitions: DataFrame | None = None) -> DataFrame:
    """POINT columns of the points that are kept."""
    return reject_overlaps(make_points(samples, resolved, definitions))
