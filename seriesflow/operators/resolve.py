"""From series records to resolved series: target, resource, labels, metadata, kind, value type, name and identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..sources.shared import side, written
from .resources import RULES, Rule, resolve_resource
from .series import MAX_LABELS, match_target, metadata_lookup, rename_metrics


def typing() -> Column:
    """struct<metric_kind, out_type, emitted, error> from metric_type, value_type, base, suffix and name."""
    kind = lambda k, v, emitted: F.struct(F.lit(k).alias("metric_kind"), v.alias("out_type"), emitted.alias("emitted"), F.lit(None).cast("string").alias("error"))
    none = F.lit(None).cast("string")
    error = lambda e: F.struct(none.alias("metric_kind"), none.alias("out_type"), none.alias("emitted"), F.lit(e).alias("error"))
    value, name, suffix = F.coalesce("value_type", F.lit("double")), F.col("name"), F.col("suffix")
    double, int64 = F.lit("double"), F.lit("int64")
    metric = F.col("metric_type")
    return (
        F.when(metric == "counter", kind("CUMULATIVE", value, F.when(suffix == "_total", F.col("base")).otherwise(name)))
        .when(metric.isin("gauge", "unknown"), kind("GAUGE", value, name))
        .when((metric == "summary") & (suffix == "_sum"), kind("CUMULATIVE", double, name))
        .when((metric == "summary") & (suffix == "_count"), kind("CUMULATIVE", int64, name))
        .when((metric == "summary") & (suffix == ""), kind("GAUGE", double, name))
        .when(metric == "summary", error("unexpected_suffix"))
        .when((metric == "histogram") & suffix.isin("_bucket", "_sum", "_count"), kind("CUMULATIVE", F.lit("distribution"), F.col("base")))
        .when(metric == "histogram", error("invalid_histogram_series"))
        .when(metric.isNotNull(), error("unexpected_type"))
    )


def type_series(df: DataFrame) -> DataFrame:
    """df with metric_kind, value_type, emitted and error."""
    return df.withColumn("__t", typing()).withColumns({"metric_kind": F.col("__t.metric_kind"), "value_type": F.col("__t.out_type"), "emitted": F.col("__t.emitted"), "error": F.col("__t.error")}).drop("__t")


def _named(names: DataFrame, static: DataFrame, fetched: DataFrame, renames: DataFrame | None, prefix: str) -> DataFrame:
    """What a series' name alone decides: metadata, kind, type and the emitted name. It is worked out once a name, not once a series, and written, as a filter on it would else repeat it."""
    rows = type_series(metadata_lookup(names, static, fetched))
    if renames is not None:
        rows = rename_metrics(rows, renames, "emitted")
    rows = rows.withColumn("metric", L.metric_type_name(F.col("emitted"), prefix))
    return side(written(rows, "names"))


def resolve_all(series: DataFrame, targets: DataFrame, static: DataFrame, fetched: DataFrame, rules: Sequence[Rule] = RULES, renames: DataFrame | None = None, prefix: str = L.PREFIX, best_effort: Rule | None = None, most: int = MAX_LABELS) -> DataFrame:
    """Every series with what it resolves to, and reason where it doesn't (null where it does)."""
    # A ref may have several records, each defining it anew.
    ids = [c for c in ("ref", "seq") if c in series.columns]
    rows = match_target(series.withColumns({"raw_labels": F.col("labels"), "name": L.get(F.col("labels"), "__name__")}), targets, ids)
    names = rows.select("name").distinct()
    rows = resolve_resource(rows, rules, best_effort)
    left = L.drop_label(L.drop_target_labels(F.col("labels"), F.coalesce("target_labels", F.create_map().cast("map<string,string>"))), "__name__")
    rows = rows.withColumn("metric_labels", left).join(_named(names, static, fetched, renames, prefix), "name")
    reason = (
        F.when(F.col("target_labels").isNull(), "target_not_found")
        .when(F.col("resource_type").isNull(), "unknown_resource")
        .when(F.size("metric_labels") > most, "too_many_labels")
        .when(F.col("metric_type").isNull(), "metadata_not_found")
    )
    rows = rows.withColumn("reason", F.coalesce(reason, F.col("error")))
    # After the limit, which counts it.
    rows = rows.withColumn("metric_labels", F.when(F.col("metric_type") == "histogram", L.drop_label(F.col("metric_labels"), "le")).otherwise(F.col("metric_labels")))
    key = F.when(F.col("reason").isNull(), L.series_key(F.col("resource_type"), F.col("resource_labels"), F.col("metric"), F.col("metric_labels")))
    keep = [c for c in series.columns if c != "labels"]
    return rows.select(*keep, F.col("raw_labels").alias("labels"), "name", "base", "suffix", "resource_type", "resource_labels", "metric", "metric_labels", "metric_type", "metric_kind", "value_type", key.alias("series_key"), "reason")


def resolve_series(*args, **options) -> DataFrame:
    """The series that resolve."""
    return resolve_all(*args, **options).filter("reason is null").drop("reason")


def dropped_series(resolved: DataFrame) -> DataFrame:
    """(reason, n) from resolve_all."""
    return resolved.filter("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
