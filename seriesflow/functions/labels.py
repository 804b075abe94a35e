"""Columns over label sets (maps of strings; a label that isn't there reads as '') and over names, times and values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The suffixes of complex metrics, and the default prefix of metric types.
SUFFIXES = ("_bucket", "_count", "_sum", "_total")
PREFIX = "external.googleapis.com/prometheus"


def get(labels: Column, name: str | Column) -> Column:
    return F.coalesce(F.try_element_at(labels, F.lit(name) if isinstance(name, str) else name), F.lit(""))


def labels_of(**values: Column) -> Column:
    """A label set; labels whose value is null or empty are left out."""
    every = F.create_map(*(x for name, v in values.items() for x in (F.lit(name), v)))
    return F.map_filter(every, lambda _, v: v.isNotNull() & (v != ""))


def split_suffix(name: Column) -> tuple[Column, Column]:
    """(base, suffix): the name without a complex metric's suffix, and that suffix or ''."""
    suffix = F.coalesce(*(F.when(F.endswith(name, F.lit(s)), F.lit(s)) for s in SUFFIXES), F.lit(""))
    return F.substring(name, F.lit(1), F.length(name) - F.length(suffix)), suffix


def metric_type_name(name: Column, prefix: str = PREFIX) -> Column:
    return F.concat_ws("/", F.lit(prefix), name)


def drop_label(labels: Column, *names: str) -> Column:
    return F.map_filter(labels, lambda k, _: ~k.isin(*names))


def drop_target_labels(labels: Column, target: Column) -> Column:
    """The labels whose value differs from the target's label of that name."""
    return F.map_filter(labels, lambda k, v: F.coalesce(F.try_element_at(target, k), F.lit("")) != v)


def with_static(labels: Column, static: dict[str, str]) -> Column:
    """The labels with constant ones added or replaced; empty constants are left out."""
    static = {k: v for k, v in static.items() if v}
    if not static:
        return labels
    constants = F.create_map(*(F.lit(x) for pair in static.items() for x in pair))
    return F.map_concat(F.map_filter(labels, lambda k, _: ~k.isin(*static)), constants)


def timestamp_of_ms(t: Column) -> Column:
    return F.timestamp_millis(t)


def ms_of_timestamp(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def typed_double(value_type: Column, v: Column) -> Column:
    return F.when(value_type != "int64", v)


def typed_int(value_type: Column, v: Column) -> Column:
    """Half away from zero; null beyond 64 bits."""
    return F.when(value_type == "int64", F.round(v).try_cast("long"))


def bucket_bound(le: Column) -> Column:
    """The number that an `le` label states, or null."""
    number = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
    infinite = r"(?i)\A[+]?inf(?:inity)?\z"
    minus = r"(?i)\A-inf(?:inity)?\z"
    return F.when(le.rlike(number), le.try_cast("double")).when(le.rlike(infinite), F.lit(float("inf"))).when(le.rlike(minus), F.lit(float("-inf")))


def normal_type(metric_type: Column) -> Column:
    return F.when(metric_type == "untyped", "unknown").otherwise(metric_type)


def is_recording_rule(name: Column) -> Column:
    return F.contains(name, F.lit(":"))


def canonical(labels: Column) -> Column:
    """A label set as text: equal exactly for equal sets. Names and values are written with their lengths, so nothing can be confused."""
    entry = lambda e: F.concat(F.length(e["key"]).cast("string"), F.lit(":"), e["key"], F.lit("="), F.length(e["value"]).cast("string"), F.lit(":"), e["value"])
    # sort_array compares natively; array_sort would call a function of Spark's for each pair. Names are unique, so values are never compared.
    return F.array_join(F.transform(F.sort_array(F.map_entries(labels)), entry), ",")


def series_key(resource_type: Column, resource_labels: Column, metric_type: Column, metric_labels: Column) -> Column:
    """The identity of an output series."""
    return F.concat_ws("|", resource_type, canonical(resource_labels), metric_type, canonical(metric_labels))


def histogram_key(labels: Column) -> Column:
    """The identity of a histogram among raw series: all labels but the bucket bound and the name."""
    return canonical(drop_label(labels, "le", "__name__"))


def all_true(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_true(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
