"""Operators on tables of series: filtering, targets, metadata, renames, pruning and which counters a series feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.matchers import Filterset, any_of
from ..schemas import METRIC_TYPES, VALUE_TYPES
from ..sources.shared import side, written

#: Metrics that every scrape produces; all are gauges of doubles.
INTERNAL_METRICS = ("up", "scrape_samples_scraped", "scrape_duration_seconds", "scrape_samples_post_metric_relabeling")
MAX_LABELS = 10
#: Up to so many targets of a job and instance all of them are looked at for each of its series.
MOST_TARGETS = 64


def export_flags(series: DataFrame, include: Sequence[Filterset] | None, counters: Mapping[str, Sequence[Filterset]]) -> DataFrame:
    """series with exported and tracked; those with neither go."""
    flagged = series.withColumns({"exported": any_of(include), "tracked": L.any_true(any_of(f) for f in counters.values())})
    return flagged.filter("exported or tracked")


def limit_labels(series: DataFrame, most: int = MAX_LABELS, labels: str = "labels") -> DataFrame:
    return series.filter(F.size(labels) <= most)


def match_counters(series: DataFrame, counters: Mapping[str, Sequence[Filterset]]) -> DataFrame:
    """A row for each series and each aggregated counter that it feeds."""
    names = F.array(*(F.when(any_of(f), F.lit(n)) for n, f in counters.items()))
    return series.withColumn("counter", F.explode(F.array_compact(names)))


def latest_series(series: DataFrame) -> DataFrame:
    """The last record of each ref."""
    return series.groupBy("ref").agg(F.max_by("labels", "seq").alias("labels"))


def join_series(samples: DataFrame, series: DataFrame) -> DataFrame:
    """samples with what is known of their series; samples of unknown refs go. Spark broadcasts series if they are few."""
    return samples.join(series, "ref")


def join_series_asof(samples: DataFrame, series: DataFrame) -> DataFrame:
    """samples with the labels (and the place) of the series record that precedes them in the log; others go."""
    records = series.select("ref", F.col("seq").alias("at"), F.lit(0).alias("kind"), "labels", F.col("seq").alias("defined"))
    rows = samples.select("ref", F.col("seq").alias("at"), F.lit(1).alias("kind"), F.struct(*(c for c in samples.columns if c != "ref")).alias("sample"))
    both = records.unionByName(rows, allowMissingColumns=True)
    before = Window.partitionBy("ref").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("known", F.last(F.when(F.col("kind") == 0, F.struct("labels", "defined")), ignorenulls=True).over(before))
    return seen.filter("kind = 1 and known is not null").select("ref", "sample.*", "known.labels", "known.defined")


def match_target(series: DataFrame, targets: DataFrame, ids: Sequence[str] = ("ref",), most: int = MOST_TARGETS) -> DataFrame:
    """series (a row for each ids) with target_labels and discovered of the first target (by ordinal) of their job and instance whose labels agree.

    A target's label agrees if the series hasn't it or has the same value. Series without a target keep null.
    Series and the targets of their jobs and instances are written once: of large dimensions only what some series asks for is paired or broadcast.
    If no job and instance of these has more than `most` targets, series meet all targets of theirs. Else they meet signatures, see _by_signature."""
    series = written(series, "series")
    sides = targets.select("ordinal", F.col("labels").alias("target_labels"), "discovered", L.get(F.col("labels"), "job").alias("t_job"), L.get(F.col("labels"), "instance").alias("t_instance"))
    keyed = series.select(*ids, "labels", L.get(F.col("labels"), "job").alias("s_job"), L.get(F.col("labels"), "instance").alias("s_instance"))
    asked = written(keyed.select(F.col("s_job").alias("t_job"), F.col("s_instance").alias("t_instance")).distinct(), "asked")
    sides = written(sides.join(side(asked), ["t_job", "t_instance"], "left_semi").select(*sides.columns), "targets")
    largest = sides.groupBy("t_job", "t_instance").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest > most:
        found = _by_signature(keyed, sides, ids)
    else:
        agrees = F.forall(F.map_entries("target_labels"), lambda e: F.coalesce(F.try_element_at("labels", e["key"]), F.lit("")).isin("", e["value"]))
        found = keyed.join(side(sides), (F.col("s_job") == F.col("t_job")) & (F.col("s_instance") == F.col("t_instance"))).filter(agrees)
    first = found.groupBy(*ids).agg(F.min_by(F.struct("target_labels", "discovered"), "ordinal").alias("target"))
    return series.join(first, list(ids), "left").select(*series.columns, "target.target_labels", "target.discovered")


def _by_signature(keyed: DataFrame, sides: DataFrame, ids: Sequence[str]) -> DataFrame:
    """(*ids, ordinal, target_labels, discovered): of each signature the first target that agrees with a series.

    A target's signature are its labels' names; those that a series has as well are what has to be equal. So per signature (and names in common) targets are
    indexed by the values of these names, one target a value, and a series looks one value up. Series meet as many rows as there are signatures at their job and instance, not targets."""
    place = ("job", "instance", "names")
    named = sides.select("ordinal", "target_labels", "discovered", F.col("t_job").alias("job"), F.col("t_instance").alias("instance"), F.array_sort(F.map_keys("target_labels")).alias("names"))
    own = F.map_keys(F.map_filter("labels", lambda _, v: v != ""))
    asks = keyed.withColumnsRenamed({"s_job": "job", "s_instance": "instance"}).join(named.select(*place).distinct(), ["job", "instance"])
    asks = asks.withColumn("common", F.array_intersect("names", own)).withColumn("values", F.transform("common", lambda n: L.get(F.col("labels"), n)))
    index = named.join(asks.select(*place, "common").distinct(), list(place)).withColumn("values", F.transform("common", lambda n: L.get(F.col("target_labels"), n)))
    first = index.groupBy(*place, "common", "values").agg(F.min_by(F.struct("ordinal", "target_labels", "discovered"), "ordinal").alias("t"))
    return asks.select(*ids, *place, "common", "values").join(first, [*place, "common", "values"]).select(*ids, "t.*")


def first_metadata(fetched: DataFrame) -> DataFrame:
    """One row per metric: the first that was fetched."""
    return fetched.groupBy("metric").agg(F.min_by(F.struct(L.normal_type(F.col("metric_type")).alias("metric_type"), "help"), "ordinal").alias("m")).select("metric", "m.*")


def metadata_union(static: DataFrame, fetched: DataFrame) -> DataFrame:
    """(metric, metric_type, value_type, help, origin), one row per metric: static, else internal, else first fetched."""
    names = "metric", "metric_type", "value_type", "help"
    mine = static.select("metric", L.normal_type(F.col("metric_type")).alias("metric_type"), "value_type", "help", F.lit("static").alias("origin"), F.lit(0).alias("rank"))
    got = first_metadata(fetched).select("metric", "metric_type", F.lit(None).cast("string").alias("value_type"), "help", F.lit("fetched").alias("origin"), F.lit(2).alias("rank"))
    spark = static.sparkSession
    internal = spark.createDataFrame([(m, "gauge", "double", "") for m in INTERNAL_METRICS], ", ".join(f"{n} string" for n in names))
    every = mine.unionByName(internal.select("*", F.lit("internal").alias("origin"), F.lit(1).alias("rank"))).unionByName(got)
    best = every.groupBy("metric").agg(F.min_by(F.struct(*names[1:], "origin"), "rank").alias("m"))
    return best.select("metric", "m.*")


def metadata_lookup(names: DataFrame, static: DataFrame, fetched: DataFrame, name: str = "name") -> DataFrame:
    """names with metric_type, value_type, suffix and base: by the full name, else (recording rules are gauges) by the name without its suffix.

    suffix and base are '' unless the short name was needed; metric_type is null where nothing is known."""
    # Two joins read it.
    known = side(written(metadata_union(static, fetched).select("metric", F.struct("metric_type", "value_type").alias("entry")), "metadata"))
    base, suffix = L.split_suffix(F.col(name))
    rows = names.withColumns({"short": base, "tail": suffix})
    rows = rows.join(known.select(F.col("metric").alias(name), F.col("entry").alias("full")), name, "left")
    rows = rows.join(known.select(F.col("metric").alias("short"), F.col("entry").alias("less")), "short", "left")
    gauge = F.struct(F.lit("gauge").alias("metric_type"), F.lit(None).cast("string").alias("value_type"))
    full = F.coalesce("full", F.when(L.is_recording_rule(F.col(name)), gauge))
    less = F.when(F.col("tail") != "", F.coalesce("less", F.when(L.is_recording_rule(F.col("short")), gauge)))
    by_base = full.isNull() & (F.col("tail") != "")
    entry = F.coalesce(full, less)
    out = {"metric_type": entry["metric_type"], "value_type": entry["value_type"], "base": F.when(by_base, F.col("short")).otherwise(""), "suffix": F.when(by_base, F.col("tail")).otherwise("")}
    return rows.select(*names.columns, *(c.alias(n) for n, c in out.items()))


def rename_metrics(df: DataFrame, renames: DataFrame, name: str = "name") -> DataFrame:
    """df with the names that renames(from, to) lists replaced."""
    return df.join(renames.select(F.col("from").alias(name), F.col("to").alias("__to")), name, "left").withColumn(name, F.coalesce("__to", name)).select(*df.columns)


def validate_static_metadata(entries: DataFrame) -> DataFrame:
    """The entries that can't be used, with an error: unknown types, or a metric that is listed more than once."""
    counted = entries.join(entries.groupBy("metric").agg(F.count(F.lit(1)).alias("times")), "metric")
    error = (
        F.when(~L.normal_type(F.col("metric_type")).isin(*METRIC_TYPES) | F.col("metric_type").isNull(), "invalid metric type")
        .when(F.col("value_type").isNotNull() & ~F.col("value_type").isin(*VALUE_TYPES), "invalid value type")
        .when(F.col("times") > 1, "duplicate metric")
    )
    return counted.withColumn("error", error).filter("error is not null").select(*entries.columns, "error")


def prune_series(series: DataFrame, live: DataFrame, checkpoint: int) -> DataFrame:
    """series without those of a segment up to the checkpoint that aren't live."""
    doomed = series.filter(F.col("segment") <= checkpoint).join(live.select("ref"), "ref", "left_anti").select("ref")
    return series.join(doomed, "ref", "left_anti")
