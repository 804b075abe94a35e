"""Registered queries of the metric engine and their DuckDB equivalents.

Each query reads the star schema's tables through seriesflow.sources.fixtures."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import labels as L
from .functions.matchers import Matcher, all_of, any_of
from .operators import batching, counters, histograms, overlap, resolve, resources, series, stats
from .plans import points as plans
from .sources import fixtures as X
from .sources import readers
from .sources.shared import shared_path, written
from .streaming import observed, streams, ticks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        name = f.__name__.removeprefix("q_")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def _with(*parts: str, recursive: bool = False) -> str:
    return ("with recursive " if recursive else "with ") + ",\n".join(parts) + "\n"


def _flat(df: DataFrame, *names: str, labels: str = "labels") -> list:
    return [L.get(F.col(labels), n).alias(n) for n in names]


# Sources


@query(_with(X.SERIES) + "select ref, name, job, instance, usr, device, segment, seq from fx_series")
def q_src_series(spark, d):
    path = shared_path(spark, "series")
    X.series(spark, d).write.json(path)
    s = readers.read_series(spark, path)
    return s.select("ref", L.get(F.col("labels"), "__name__").alias("name"), *_flat(s, "job", "instance", "usr", "device"), "segment", "seq")


@query(_with(X.SAMPLES) + "select seq, scrape_id, ref, t, v from fx_samples where not isnan(v)")
def q_src_samples(spark, d):
    path = shared_path(spark, "samples")
    readers.pack_scrapes(X.samples(spark, d)).write.json(path)
    return counters.drop_nan(readers.read_samples(spark, path)).select("seq", "scrape_id", "ref", "t", "v")


def _target_documents(spark, d):
    """A response per hundred targets; every third is without success."""
    t = X.targets(spark, d).withColumn("doc", F.expr("ordinal div 100"))
    in_order = F.array_sort(F.collect_list(F.struct("ordinal", "labels", "discovered")), lambda x, y: (x["ordinal"] - y["ordinal"]).cast("int"))
    rows = F.transform(in_order, lambda x: F.struct(x["labels"].alias("labels"), x["discovered"].alias("discoveredLabels")))
    docs = t.groupBy("doc").agg(rows.alias("targets")).repartitionByRange(8, "doc").sortWithinPartitions("doc")
    path = shared_path(spark, "targets")
    docs.select(F.when(F.col("doc") % 3 == 2, "error").otherwise("success").alias("status"), F.struct(F.col("targets").alias("activeTargets")).alias("data")).write.json(path)
    return path


@query(
    _with(X.TARGETS)
    + "select job, instance, case when kind = 1 then 'vm' || n else '' end vm, case when kind = 0 then 'pod' || n else '' end pod, row_number() over (partition by n // 500 order by ordinal)::int place from fx_targets where (ordinal // 100) % 3 <> 2"
)
def q_src_targets(spark, d):
    """Targets of files of documents; place is their order among those of 500 instances, over several documents and files."""
    t = readers.read_targets(spark, _target_documents(spark, d))
    group = F.expr("cast(substr(instance, 5) as long) div 500")
    t = t.select("ordinal", *_flat(t, "job", "instance"), L.get(F.col("discovered"), "__meta_gce_instance_id").alias("vm"), L.get(F.col("discovered"), "__meta_kubernetes_pod_name").alias("pod"))
    return t.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("ordinal"))).drop("ordinal")


@query(
    _with(X.PART_METADATA)
    + "select metric, case when metric_type = 'untyped' then 'unknown' else metric_type end metric_type, help, row_number() over (partition by metric order by ordinal)::int place from fx_part where (ordinal // 50) % 50 <> 7"
)
def q_src_metadata(spark, d):
    """Metadata of files of documents; place is their order among those of one metric."""
    path = shared_path(spark, "metadata")
    p = X.part_metadata(spark, d).withColumn("doc", F.expr("ordinal div 50"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "metric", "metric_type", "help"))), lambda x: F.struct(x["metric"].alias("metric"), x["metric_type"].alias("type"), x["help"].alias("help")))
    docs = p.groupBy("doc").agg(rows.alias("rows")).repartitionByRange(8, "doc").sortWithinPartitions("doc").select(F.lit("success").alias("status"), F.when(F.col("doc") % 50 == 7, "not_found").alias("errorType"), F.when(F.col("doc") % 50 != 7, F.col("rows")).alias("data"))
    docs.write.json(path)
    read = readers.read_metadata(spark, path)
    return read.select("metric", "metric_type", "help", F.row_number().over(Window.partitionBy("metric").orderBy("ordinal")).alias("place"))


@query(_with(X.TARGETS) + "select ordinal, 'proj' project, 'clu' cluster, 'gloc' generic_location, case when kind = 2 then 'gns' else '' end generic_namespace, 'x' other, (1 + 4 + case kind when 0 then 3 when 1 then 3 when 2 then 1 else 0 end)::int n from fx_targets")
def q_targets_static_labels(spark, d):
    t = readers.with_static_labels(X.targets(spark, d), X.STATIC)
    g = lambda n: L.get(F.col("discovered"), n)
    return t.select("ordinal", g(resources.PROJECT).alias("project"), g(resources.CLUSTER).alias("cluster"), g(resources.GENERIC_LOCATION).alias("generic_location"), g(resources.GENERIC_NAMESPACE).alias("generic_namespace"), g("other").alias("other"), F.size("discovered").alias("n"))


@query(_with(X.SAMPLES) + "select scrape_id, count(*) n, min(seq) lo from fx_samples where seq >= 3000 - 512 group by scrape_id")
def q_resume_offset(spark, d):
    return readers.resume_from(X.samples(spark, d), 3000, 512).groupBy("scrape_id").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("lo"))


# Filters

_SERIES_OUT = "select ref, name from fx_series where "


def _series_names(df):
    return df.select("ref", L.get(F.col("labels"), "__name__").alias("name"))


@query(_with(X.SERIES) + _SERIES_OUT + "job = 'job1'")
def q_filter_eq(spark, d):
    return _series_names(X.series(spark, d).filter(Matcher("job", "=", "job1").col()))


@query(_with(X.SERIES) + _SERIES_OUT + "instance <> 'inst3'")
def q_filter_ne(spark, d):
    return _series_names(X.series(spark, d).filter(Matcher("instance", "!=", "inst3").col() & Matcher("none", "!=", "x").col()))


@query(_with(X.SERIES) + _SERIES_OUT + "regexp_full_match(name, '.*_(total|sum)')")
def q_filter_re(spark, d):
    return _series_names(X.series(spark, d).filter(Matcher("__name__", "=~", ".*_(total|sum)").col()))


@query(_with(X.SERIES) + _SERIES_OUT + "not regexp_full_match(usr, 'u[0-4].*')")
def q_filter_nre(spark, d):
    return _series_names(X.series(spark, d).filter(Matcher("usr", "!~", "u[0-4].*").col()))


ALL = (Matcher("job", "=", "job1"), Matcher("device", "!=", "eth0"), Matcher("__name__", "=~", "(clicks|purchase)_.*"))
ANY = (ALL, (Matcher("__name__", "=", "signup"), Matcher("instance", "=~", "inst1.?")))
_ALL = "(job = 'job1' and device <> 'eth0' and regexp_full_match(name, '(clicks|purchase)_.*'))"
_ANY = f"({_ALL} or (name = 'signup' and regexp_full_match(instance, 'inst1.?')))"


@query(_with(X.SERIES) + _SERIES_OUT + _ALL)
def q_filter_all(spark, d):
    return _series_names(X.series(spark, d).filter(all_of(ALL)))


@query(_with(X.SERIES) + _SERIES_OUT + _ANY)
def q_filter_any(spark, d):
    return _series_names(X.series(spark, d).filter(any_of(ANY)))


COUNTERS = {
    "clicks_all": ((Matcher("__name__", "=", "clicks_total"),),),
    "job1_or_errors": ((Matcher("job", "=", "job1"), Matcher("__name__", "!=", "signup")), (Matcher("__name__", "=~", "errors:.*"),)),
    "eth2": ((Matcher("device", "=", "eth2"),),),
}
_COUNTERS = {"clicks_all": "name = 'clicks_total'", "job1_or_errors": "((job = 'job1' and name <> 'signup') or name like 'errors:%')", "eth2": "device = 'eth2'"}
_FEEDS = "feeds as (" + " union all ".join(f"select ref, '{n}' counter from fx_series where {c}" for n, c in _COUNTERS.items()) + ")"


@query(_with(X.SERIES) + f"select ref, name, {_ANY} exported, name = 'signup' or device = 'eth2' tracked from fx_series where {_ANY} or name = 'signup' or device = 'eth2'")
def q_export_flags(spark, d):
    out = series.export_flags(X.series(spark, d), ANY, {"a": ((Matcher("__name__", "=", "signup"),),), "b": ((Matcher("device", "=", "eth2"),),)})
    return out.select("ref", L.get(F.col("labels"), "__name__").alias("name"), "exported", "tracked")


@query(_with(X.SAMPLES) + "select ref, count(*) n, round(sum(v), 4) total from fx_samples where not isnan(v) group by ref")
def q_drop_nan(spark, d):
    return counters.drop_nan(X.samples(spark, d)).groupBy("ref").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 4).alias("total"))


@query(_with(X.SERIES) + "select ref, (5 + ref % 9)::int n from fx_series where 5 + ref % 9 <= 10")
def q_too_many_labels(spark, d):
    extra = F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.struct(F.concat(F.lit("x"), i.cast("string")), i.cast("string"))))
    s = X.series(spark, d).withColumn("labels", F.map_concat("labels", F.map_filter(extra, lambda k, v: v.cast("long") <= F.col("ref") % 9)))
    return series.limit_labels(s).select("ref", F.size("labels").alias("n"))


# Scalars


@query(_with(X.PART_METADATA) + "select ordinal, metric, case when regexp_full_match(metric, '.*(_bucket|_count|_sum|_total)') then regexp_extract(metric, '^(.*)(_bucket|_count|_sum|_total)$', 1) else metric end base, regexp_extract(metric, '(_bucket|_count|_sum|_total)$', 1) suffix from fx_part")
def q_strip_suffix(spark, d):
    base, suffix = L.split_suffix(F.col("metric"))
    return X.part_metadata(spark, d).select("ordinal", "metric", base.alias("base"), suffix.alias("suffix"))


@query(_with(X.SERIES) + f"select ref, '{L.PREFIX}/' || name metric from fx_series")
def q_metric_type_name(spark, d):
    return X.series(spark, d).select("ref", L.metric_type_name(L.get(F.col("labels"), "__name__")).alias("metric"))


@query(_with(X.SERIES) + "select ref, case when ref % 2 = 0 then '' else job end job, case when ref % 3 = 0 then instance else '' end instance, usr, '' empty, (2 + (ref % 2 <> 0)::int + (ref % 3 = 0)::int + 1)::int n from fx_series")
def q_drop_target_labels(spark, d):
    target = F.map_concat(F.when(F.col("ref") % 2 == 0, F.create_map(F.lit("job"), L.get(F.col("labels"), "job"))).otherwise(F.create_map().cast("map<string,string>")), F.when(F.col("ref") % 3 != 0, F.create_map(F.lit("instance"), L.get(F.col("labels"), "instance"))).otherwise(F.create_map(F.lit("instance"), F.lit("other"))))
    s = X.series(spark, d).withColumn("labels", F.map_concat("labels", F.create_map(F.lit("empty"), F.lit(""))))
    left = s.select("ref", L.drop_target_labels(F.col("labels"), target).alias("labels"))
    return left.select("ref", *_flat(left, "job", "instance", "usr", "empty"), F.size("labels").alias("n"))


@query(_with(X.SERIES) + "select ref, job, '' name, case when ref % 2 = 0 then '' else '0.5' end le, (4 + (ref % 2 <> 0)::int)::int n from fx_series")
def q_metric_labels(spark, d):
    s = X.series(spark, d).withColumn("labels", F.map_concat("labels", F.create_map(F.lit("le"), F.lit("0.5"))))
    less = L.drop_label(F.col("labels"), "__name__")
    left = s.select("ref", F.when(F.col("ref") % 2 == 0, L.drop_label(less, "le")).otherwise(less).alias("labels"))
    return left.select("ref", *_flat(left, "job"), L.get(F.col("labels"), "__name__").alias("name"), *_flat(left, "le"), F.size("labels").alias("n"))


@query(_with(X.SAMPLES) + "select seq, epoch_us(make_timestamp(t * 1000)) us, t // 1000 s, (t % 1000) * 1000000 nanos from fx_samples")
def q_ms_to_timestamp(spark, d):
    ts = L.timestamp_of_ms(F.col("t"))
    return X.samples(spark, d).select("seq", F.unix_micros(ts).alias("us"), F.unix_seconds(ts).alias("s"), (F.expr("t % 1000") * 1000000).alias("nanos"))


@query(_with(X.SAMPLES) + "select seq, case when ref % 2 = 0 then (sign(w) * floor(abs(w) + 0.5))::bigint end int64_value, case when ref % 2 = 1 then w end double_value from (select *, floor(v * 2) / 2 - 5 w from fx_samples where not isnan(v))")
def q_typed_value(spark, d):
    s = counters.drop_nan(X.samples(spark, d)).withColumns({"w": F.floor(F.col("v") * 2) / 2 - 5, "kind": F.when(F.col("ref") % 2 == 0, "int64").otherwise("double")})
    return s.select("seq", L.typed_int(F.col("kind"), F.col("w")).alias("int64_value"), L.typed_double(F.col("kind"), F.col("w")).alias("double_value"))


# Resources


def _machine_oracle(kind: int | None) -> str:
    """(id, resource_type, labels as sorted text, rest) as the rules give them; written from the rules' data."""
    cases, keys = [], []
    for k, rule in enumerate(resources.RULES):
        sources = list(rule.labels)
        parts = []
        for i, s in enumerate(sources):
            v = f"'v{i}/' || id"
            if i == 1:
                v = f"case when own then 'own/' || id else {v} end"
            name = rule.labels[s]
            if s == "__meta_gce_zone":
                v = f"split_part({v}, '/', -1)"
            if s == "__meta_ec2_availability_zone":
                v = f"'aws:' || {v}"
            parts.append((name, f"'{name}=' || {v}"))
        text = " || ';' || ".join(t for _, t in sorted(parts))
        cases.append(f"when kind = {k} and (not cut or own) then {text}")
        keys.append(f"when kind = {k} and (not cut or own) then '{rule.resource_type}'")
    where = "" if kind is None else f" where kind = {kind}"
    return f"""with m as (select s_suppkey id, s_suppkey % 12 kind, (s_suppkey // 12) % 7 = 0 cut, (s_suppkey // 12) % 5 = 0 own from supplier)
select id, case {' '.join(keys)} end resource_type, case {' '.join(cases)} end resource, 1 rest from m{where}"""


def _machines(spark, d, kind=None):
    m = X.machines(spark, d)
    out = resources.resolve_resource(m if kind is None else m.filter(F.col("kind") == kind))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("resource_labels")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return out.select("id", "resource_type", text.alias("resource"), F.when(F.col("resource_type").isNull(), 1).otherwise(F.size("labels")).alias("rest"))


_KINDS = {r.resource_type: k for k, r in enumerate(resources.RULES)}


@query(_machine_oracle(None))
def q_resource_resolve(spark, d):
    return _machines(spark, d)


@query(_machine_oracle(_KINDS["aws_ec2_instance"]))
def q_resource_ec2(spark, d):
    return _machines(spark, d, _KINDS["aws_ec2_instance"])


@query(_machine_oracle(_KINDS["gce_instance"]))
def q_resource_gce(spark, d):
    return _machines(spark, d, _KINDS["gce_instance"])


@query(_machine_oracle(_KINDS["generic_task"]))
def q_resource_generic(spark, d):
    return _machines(spark, d, _KINDS["generic_task"])


@query(_with(X.TARGETS) + "select ordinal, 'gke_container' resource_type, case when kind in (0, 2) then 'proj' else '' end project_id, case when kind = 0 then 'pod' || n else '' end pod_id, '' instance_id, 7 n from fx_targets")
def q_resource_best_effort(spark, d):
    out = resources.resolve_resource(X.targets(spark, d), best_effort=resources.GKE_CONTAINER)
    return out.select("ordinal", "resource_type", *_flat(out, "project_id", "pod_id", "instance_id", labels="resource_labels"), F.size("resource_labels").alias("n"))


# Joins

_MATCHED = "matched as (select s.*, t.ordinal, t.kind, t.n from fx_series s left join fx_targets t on s.job = t.job and s.instance = t.instance)"


@query(_with(X.SAMPLES, X.SERIES) + "select s.seq, s.ref, name, usr from fx_samples s join fx_series r on s.ref = r.ref")
def q_join_series(spark, d):
    out = series.join_series(X.samples(spark, d), series.latest_series(X.series(spark, d)))
    return out.select("seq", "ref", L.get(F.col("labels"), "__name__").alias("name"), *_flat(out, "usr"))


@query(
    _with(X.SAMPLES)
    + """, def as (select ref, seq since, 'g' || (seq // 2000) gen from (select ref, seq, row_number() over (partition by ref, seq // 2000 order by seq) k from fx_samples) where k = 2)
select s.seq, s.ref, d.gen, d.since defined from fx_samples s asof join def d on s.ref = d.ref and s.seq >= d.since"""
)
def q_join_series_asof(spark, d):
    s = X.samples(spark, d)
    nth = F.row_number().over(Window.partitionBy("ref", F.expr("seq div 2000")).orderBy("seq"))
    records = s.withColumn("k", nth).filter("k = 2").select("ref", "seq", F.create_map(F.lit("gen"), F.concat(F.lit("g"), F.expr("cast(seq div 2000 as string)"))).alias("labels"))
    out = series.join_series_asof(s, records)
    return out.select("seq", "ref", *_flat(out, "gen"), "defined")


@query(_with(X.SERIES, X.TARGETS, _MATCHED) + "select ref, ordinal is not null found, case when kind = 1 then 'vm' || n else '' end vm from matched")
def q_match_target(spark, d):
    out = series.match_target(X.series(spark, d), X.targets(spark, d))
    return out.select("ref", F.col("target_labels").isNotNull().alias("found"), L.get(F.coalesce("discovered", F.create_map().cast("map<string,string>")), "__meta_gce_instance_id").alias("vm"))


@query(
    _with(X.SERIES)
    + """, t as (select c_custkey ordinal, 'job' || (c_custkey % 3) job, c_custkey // 3 % 200 shard, case when c_custkey % 2 = 0 then 'z' || (c_custkey // 600 % 2) end zone from customer),
s as (select *, ref // 10 % 250 shard, case when ref % 3 = 0 then 'z' || (ref % 2) end sz from fx_series)
select s.ref, min(t.ordinal) ordinal from s left join t on s.job = t.job and s.shard = t.shard and (s.sz is null or t.zone is null or s.sz = t.zone) group by s.ref"""
)
def q_match_target_shared(spark, d):
    """All targets of a job at one instance, told apart by other labels only, of which some have fewer."""
    number = lambda c: c.cast("long").cast("string")
    t = X.table(spark, d, "customer").select("c_custkey", F.expr("c_custkey div 3").alias("n"))
    zone = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("z"), number(F.expr("c_custkey div 600 % 2"))))
    targets = t.select(F.col("c_custkey").alias("ordinal"), L.labels_of(job=F.concat(F.lit("job"), number(F.col("c_custkey") % 3)), instance=F.lit("all"), shard=number(F.col("n") % 200), zone=zone).alias("labels"), L.labels_of(ordinal=number(F.col("c_custkey"))).alias("discovered"))
    own = {"job": L.get(F.col("labels"), "job"), "instance": F.lit("all"), "usr": L.get(F.col("labels"), "usr"), "shard": number(F.expr("ref div 10 % 250")), "zone": F.when(F.col("ref") % 3 == 0, F.concat(F.lit("z"), number(F.col("ref") % 2)))}
    out = series.match_target(X.series(spark, d).select("ref", L.labels_of(**own).alias("labels")), targets)
    return out.select("ref", F.element_at("discovered", "ordinal").cast("long").alias("ordinal"))


_INTERNAL = "('up'), ('scrape_samples_scraped'), ('scrape_duration_seconds'), ('scrape_samples_post_metric_relabeling')"
_UNION = f"""u as (select metric, case when metric_type = 'untyped' then 'unknown' else metric_type end metric_type, value_type, 'static' origin, 0 rank, ordinal from fx_part where ordinal % 10 = 0 and ordinal < 1500
  union all select m, 'gauge', 'double', 'internal', 1, 0 from (values {_INTERNAL}) i(m)
  union all select metric, case when metric_type = 'untyped' then 'unknown' else metric_type end, null, 'fetched', 2, ordinal from fx_part where not (ordinal % 10 = 0 and ordinal < 1500)
  union all select m, 'counter', null, 'fetched', 2, 0 from (values {_INTERNAL}) i(m)),
best as (select * from (select *, row_number() over (partition by metric order by rank, ordinal) k from u) where k = 1)"""


def _both_metadata(spark, d):
    """Static entries (of every tenth part the first with its metric), and fetched ones (all others, and internal metrics under a wrong type)."""
    p = X.part_metadata(spark, d)
    wrong = spark.createDataFrame([(m,) for m in series.INTERNAL_METRICS], "metric string").select(F.lit(0).cast("long").alias("ordinal"), "metric", F.lit("counter").alias("metric_type"), F.lit("").alias("help"))
    return p.filter("ordinal % 10 = 0 and ordinal < 1500"), p.filter("not (ordinal % 10 = 0 and ordinal < 1500)").select("ordinal", "metric", "metric_type", "help").unionByName(wrong)


@query(_with(X.PART_METADATA, _UNION) + "select metric, metric_type, value_type, origin from best")
def q_metadata_union(spark, d):
    return series.metadata_union(*_both_metadata(spark, d)).select("metric", "metric_type", "value_type", "origin")


@query(_with(X.PART_METADATA, _UNION) + "select metric, metric_type, value_type, origin from best where origin = 'internal'")
def q_metadata_internal(spark, d):
    return series.metadata_union(*_both_metadata(spark, d)).filter("origin = 'internal'").select("metric", "metric_type", "value_type", "origin")


_NAMES = "names as (select l_orderkey * 10 + l_linenumber id, 'm_' || (l_partkey % 1700) || case l_partkey % 5 when 0 then '_total' when 1 then ':rate' when 2 then '_sum' when 3 then '_count' else '' end nm from lineitem)"


def _names(spark, d):
    tail = F.expr("case l_partkey % 5 when 0 then '_total' when 1 then ':rate' when 2 then '_sum' when 3 then '_count' else '' end")
    return X.table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.concat(F.lit("m_"), F.expr("cast(l_partkey % 1700 as string)"), tail).alias("name"))


_LOOKED = """looked as (select id, nm, b.metric_type full_type, b.value_type full_value, regexp_extract(nm, '(_bucket|_count|_sum|_total)$', 1) tail, case when tail = '' then nm else left(nm, len(nm) - len(tail)) end short from names left join best b on nm = b.metric),
found as (select l.*, s.metric_type short_type, s.value_type short_value, full_type is not null or contains(nm, ':') by_full from looked l left join best s on l.tail <> '' and s.metric = l.short)"""


@query(_with(X.PART_METADATA, _UNION, _NAMES, _LOOKED) + "select metric_type, value_type, count(*) n from (select case when full_type is not null then full_type when contains(nm, ':') then 'gauge' end metric_type, full_value value_type from found) where metric_type is not null group by all")
def q_metadata_lookup(spark, d):
    out = series.metadata_lookup(_names(spark, d), *_both_metadata(spark, d)).filter("base = '' and metric_type is not null")
    return out.groupBy("metric_type", "value_type").agg(F.count(F.lit(1)).alias("n"))


@query(_with(X.PART_METADATA, _UNION, _NAMES, _LOOKED) + "select short base, tail suffix, short_type metric_type, short_value value_type, count(*) n from found where not by_full and tail <> '' group by all")
def q_metadata_fallback(spark, d):
    out = series.metadata_lookup(_names(spark, d), *_both_metadata(spark, d)).filter("base <> ''")
    return out.groupBy("base", "suffix", "metric_type", "value_type").agg(F.count(F.lit(1)).alias("n"))


@query(_with(X.SERIES) + "select ref, case name when 'page_view' then 'web/views' else name end name from fx_series")
def q_rename_metrics(spark, d):
    return series.rename_metrics(_series_names(X.series(spark, d)), X.renames(spark))


@query(
    _with(X.PART_METADATA)
    + """select ordinal, metric, error from (select *, case when metric_type not in ('counter', 'gauge', 'histogram', 'summary', 'unknown', 'untyped') then 'invalid metric type'
when value_type not in ('double', 'int64') then 'invalid value type' when count(*) over (partition by metric) > 1 then 'duplicate metric' end error from fx_part) where error is not null"""
)
def q_validate_static_metadata(spark, d):
    return series.validate_static_metadata(X.part_metadata(spark, d)).select("ordinal", "metric", "error")


@query(_with(X.SERIES) + "select ref, segment from fx_series where not (segment <= 2 and ref % 4 <> 0)")
def q_prune_series(spark, d):
    s = X.series(spark, d)
    return series.prune_series(s, s.filter("ref % 4 = 0").select("ref"), 2).select("ref", "segment")


@query(_with(X.SERIES, _FEEDS) + "select ref, counter from feeds")
def q_match_counters(spark, d):
    return series.match_counters(X.series(spark, d), COUNTERS).select("ref", "counter")


# Typing and resolution


@query(
    _with(X.PART_METADATA)
    + """, k as (select ordinal, case when metric_type = 'untyped' then 'unknown' else metric_type end mt, value_type vt, ['_bucket', '_count', '_sum', '_total', ''][ordinal % 5 + 1] sx from fx_part)
select ordinal, case when mt = 'counter' then 'CUMULATIVE' when mt in ('gauge', 'unknown') then 'GAUGE' when mt = 'summary' and sx in ('_sum', '_count') then 'CUMULATIVE' when mt = 'summary' and sx = '' then 'GAUGE' when mt = 'histogram' and sx in ('_bucket', '_count', '_sum') then 'CUMULATIVE' end metric_kind,
case when mt in ('counter', 'gauge', 'unknown') then coalesce(vt, 'double') when mt = 'summary' and sx = '_count' then 'int64' when mt = 'summary' and sx in ('_sum', '') then 'double' when mt = 'histogram' and sx in ('_bucket', '_count', '_sum') then 'distribution' end value_type,
case when mt = 'counter' then case when sx = '_total' then 'b' else 'b' || sx end when mt in ('gauge', 'unknown') then 'b' || sx when mt = 'summary' and sx in ('_sum', '_count', '') then 'b' || sx when mt = 'histogram' and sx in ('_bucket', '_count', '_sum') then 'b' end emitted,
case when mt = 'summary' and sx in ('_bucket', '_total') then 'unexpected_suffix' when mt = 'histogram' and sx in ('_total', '') then 'invalid_histogram_series' when mt = 'timer' then 'unexpected_type' end error from k"""
)
def q_type_series(spark, d):
    rows = X.part_metadata(spark, d).withColumn("suffix", F.expr("element_at(array('_bucket', '_count', '_sum', '_total', ''), cast(ordinal % 5 + 1 as int))"))
    rows = rows.select("ordinal", L.normal_type(F.col("metric_type")).alias("metric_type"), "value_type", "suffix", F.when(F.col("suffix") == "", "").otherwise("b").alias("base"), F.concat(F.lit("b"), "suffix").alias("name"))
    return resolve.type_series(rows).select("ordinal", "metric_kind", "value_type", "emitted", "error")


def _resolved(spark, d, of=None):
    return resolve.resolve_all(X.series(spark, d) if of is None else of, X.targets(spark, d), X.static_metadata(spark), X.fetched_metadata(spark), renames=X.renames(spark))


_REASON = "case when ordinal is null then 'target_not_found' when kind = 3 then 'unknown_resource' when name = 'signup' then 'metadata_not_found' end"
_RESOLVED = f"""resolved as (select ref, seq, name, job, instance, usr, device, kind, n, case kind when 0 then 'k8s_container' when 1 then 'gce_instance' else 'generic_task' end resource_type,
  case name when 'clicks_total' then 'clicks' when 'page_view' then 'web/views' else name end emitted, case name when 'clicks_total' then 'CUMULATIVE' when 'purchase_sum' then 'CUMULATIVE' else 'GAUGE' end metric_kind,
  case name when 'page_view' then 'int64' else 'double' end value_type from matched where {_REASON} is null)"""
_DIMENSIONS = (X.SERIES, X.TARGETS, _MATCHED)


@query(_with(*_DIMENSIONS) + f"select reason, count(*) n from (select {_REASON} reason from matched) where reason is not null group by reason")
def q_dropped_series(spark, d):
    return resolve.dropped_series(_resolved(spark, d))


@query(
    _with(*_DIMENSIONS, _RESOLVED)
    + f"select ref, resource_type, case kind when 0 then 'main' else '' end container_name, case kind when 1 then 'z' || n else '' end zone, case kind when 2 then instance else '' end task_id, '{L.PREFIX}/' || emitted metric, metric_kind, value_type, usr, device, 2 n_labels from resolved"
)
def q_resolve_series(spark, d):
    out = _resolved(spark, d).filter("reason is null")
    return out.select("ref", "resource_type", *_flat(out, "container_name", "zone", "task_id", labels="resource_labels"), "metric", "metric_kind", "value_type", *_flat(out, "usr", "device", labels="metric_labels"), F.size("metric_labels").alias("n_labels"))


def _text(*pairs: str) -> str:
    """The canonical text of a label set in SQL: pairs are a name and an expression each, in order of names."""
    names, values = pairs[::2], pairs[1::2]
    return " || ',' || ".join(f"'{len(n)}:{n}=' || len({v}) || ':' || {v}" for n, v in zip(names, values, strict=True))


_KEY = f"""case kind when 0 then {_text('cluster_name', "'clu'", 'container_name', "'main'", 'location', "'loc'", 'namespace_name', "'ns'", 'pod_name', "('pod' || n)", 'project_id', "'proj'")}
 when 1 then {_text('instance_id', "('vm' || n)", 'project_id', "'gproj'", 'zone', "('z' || n)")}
 else {_text('job', 'job', 'location', "'gloc'", 'namespace', "'gns'", 'project_id', "'proj'", 'task_id', 'instance')} end"""
_KEYED = f"keyed as (select *, resource_type || '|' || {_KEY} || '|{L.PREFIX}/' || emitted || '|' || {_text('device', 'device', 'usr', 'usr')} series_key from resolved)"


@query(_with(*_DIMENSIONS, _RESOLVED, _KEYED) + "select ref, series_key from keyed")
def q_series_key(spark, d):
    return _resolved(spark, d).filter("reason is null").select("ref", "series_key")


# Windows

_LIVE = "live as (select * from fx_samples where not isnan(v))"
_RESET = """ra as (select *, lag(v) over w p, first_value(v) over w v0, first_value(t) over w t0 from live window w as (partition by ref order by seq)),
rb as (select *, last_value(case when v < p then t - 1 end ignore nulls) over (partition by ref order by seq rows unbounded preceding) rt from ra),
rc as (select *, coalesce(rt, t0) start, case when rt is null then v - v0 else v end adjusted from rb where p is not null)"""


@query(_with(X.SAMPLES, _LIVE, _RESET) + "select seq, ref, t, start, round(adjusted, 4) adjusted from rc")
def q_reset_adjust(spark, d):
    out = counters.reset_adjust(counters.drop_nan(X.samples(spark, d))).filter("not first")
    return out.select("seq", "ref", "t", "start", F.round("adjusted", 4).alias("adjusted"))


def _shaken(spark, d):
    """Samples of which every seventh comes an hour late by its time."""
    return X.samples(spark, d).withColumn("t", F.when(F.col("seq") % 7 == 0, F.col("t") - 3_600_000).otherwise(F.col("t")))


_SHAKEN = "shaken as (select * replace (case when seq % 7 = 0 then t - 3600000 else t end as t) from fx_samples where not isnan(v)), ordered as (select * from (select *, max(t) over (partition by ref order by seq rows between unbounded preceding and 1 preceding) before from shaken) where before is null or t >= before)"
_DELTAS = "deltas as (select * from (select *, case when v < p then v else v - p end delta from (select *, lag(v) over (partition by ref order by seq) p from {}) where p is not null) where delta <> 0)"


@query(_with(X.SAMPLES, _LIVE, _DELTAS.format("live")) + "select seq, ref, t, round(delta, 4) delta from deltas")
def q_counter_deltas(spark, d):
    return counters.counter_deltas(counters.drop_nan(X.samples(spark, d))).select("seq", "ref", "t", F.round("delta", 4).alias("delta"))


@query(_with(X.SAMPLES, _SHAKEN) + "select seq, ref, t, v from ordered")
def q_drop_out_of_order(spark, d):
    return counters.drop_out_of_order(counters.drop_nan(_shaken(spark, d))).select("seq", "ref", "t", "v")


_PAIR_RESET = """pa as (select *, lag(v) over w p, first_value(t) over w t0 from fx_pts window w as (partition by ref order by seq)),
pb as (select *, coalesce(last_value(case when v < p then t - 1 end ignore nulls) over (partition by ref order by seq rows unbounded preceding), t0) st from pa),
pts as (select *, row_number() over (partition by sk order by seq) rn from pb where p is not null),
f(sk, rn, ls, le, ok) as (select sk, rn, st, t, true from pts where rn = 1 union all
 select p.sk, p.rn, case when k then p.st else f.ls end, case when k then p.t else f.le end, k from f join pts p on p.sk = f.sk and p.rn = f.rn + 1,
 lateral (select (p.st = f.ls and p.t > f.le) or (p.st > f.ls and p.st >= f.le) as k) z)"""


@query(_with(X.PAIRS, _PAIR_RESET, recursive=True) + "select p.sk series_key, p.seq, p.t, p.st start from f join pts p using (sk, rn) where ok")
def q_reject_overlaps(spark, d):
    moved = counters.reset_adjust(X.pair_points(spark, d)).filter("not first").select("series_key", "ref", "seq", "t", "start")
    return overlap.reject_overlaps(moved).select("series_key", "seq", "t", "start")


@query(_with(X.PAIRS) + "select sk series_key, seq, t from (select *, max(t) over (partition by sk order by seq rows between unbounded preceding and 1 preceding) before from fx_pts) where before is null or t > before")
def q_reject_overlaps_gauge(spark, d):
    return overlap.reject_overlaps_gauge(X.pair_points(spark, d)).select("series_key", "seq", "t")


@query(
    """with recursive e as (select event_type, time_bucket(interval '15 minutes', ts) tick, count(*) n from events group by all),
g as (select event_type, unnest(generate_series(min(tick), max(tick), interval '15 minutes')) tick from e group by event_type),
r as (select g.event_type, g.tick, coalesce(n, 0) / 900.0::double x, row_number() over (partition by g.event_type order by g.tick) k from g left join e on g.event_type = e.event_type and g.tick = e.tick),
f as (select event_type, tick, k, x rate from r where k = 1 union all select r.event_type, r.tick, r.k, f.rate + 0.2 * (r.x - f.rate) from f join r on r.event_type = f.event_type and r.k = f.k + 1)
select event_type, epoch_us(tick) // 1000000 + 900 tick_end, round(rate, 9) rate from f"""
)
def q_ewma_rate(spark, d):
    e = X.table(spark, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    out = stats.ewma_rate(e, "event_type", "ts", "15 minutes")
    return out.select("event_type", F.unix_seconds("tick_end").alias("tick_end"), F.round("rate", 9).alias("rate"))


# Histograms


def _assembled(spark, d):
    # The series' own order: one ref per flag, status and bound.
    return histograms.assemble(counters.reset_adjust(X.histogram_samples(spark, d)), ("labels",))


@query(_with(X.HISTOGRAM) + "select rf, ls, t, start, cnt::bigint count, round(total, 4) total, count(*) n_buckets, sum(cum)::bigint cumulative from hist group by all")
def q_hist_assemble(spark, d):
    h = _assembled(spark, d)
    return h.select(*_flat(h, "rf", "ls"), "t", "start", F.col("count").cast("long").alias("count"), F.round("total", 4).alias("total"), F.size("buckets").cast("long").alias("n_buckets"), F.aggregate("buckets", F.lit(0).cast("long"), lambda s, x: s + x["value"]).alias("cumulative"))


@query(_with(X.HISTOGRAM) + "select rf, ls, t, case when le = 'Infinity'::double then null else le end bound, cum - coalesce(lag(cum) over (partition by rf, ls, t order by le), 0) n from hist")
def q_hist_buckets(spark, d):
    h = histograms.distribution(_assembled(spark, d))
    h = h.select(*_flat(h, "rf", "ls"), "t", F.posexplode("distribution.bucket_counts").alias("i", "n"), F.col("distribution.bounds").alias("b"))
    return h.select("rf", "ls", "t", F.get("b", F.col("i")).alias("bound"), "n")


@query(
    _with(X.HISTOGRAM)
    + """, b as (select *, case when cnt > 0 then total / cnt else 0 end mean, cum - coalesce(lag(cum) over w, 0) n, coalesce(lag(le) over w, 0) lower from hist window w as (partition by rf, ls, t order by le))
select rf, ls, t, any_value(cnt)::bigint count, round(any_value(mean), 6) mean, round(sum(n * pow(case when le = 'Infinity'::double then lower else (lower + le) / 2 end - mean, 2)), 3) sum_sq_dev from b group by rf, ls, t"""
)
def q_hist_stats(spark, d):
    h = histograms.distribution(_assembled(spark, d))
    return h.select(*_flat(h, "rf", "ls"), "t", F.col("distribution.count").alias("count"), F.round("distribution.mean", 6).alias("mean"), F.round("distribution.sum_sq_dev", 3).alias("sum_sq_dev"))


# Aggregated counters


@query(_with(X.SAMPLES, X.SERIES, _FEEDS, _LIVE, _DELTAS.format("live")) + "select counter, round(sum(delta), 2) total, count(*) points from deltas join feeds using (ref) group by counter")
def q_aggregated_counter(spark, d):
    out = counters.aggregated_counter(X.samples(spark, d), X.series(spark, d), COUNTERS)
    return out.select("counter", F.round("total", 2).alias("total"), "points")


@query(
    _with(X.SAMPLES, X.SERIES, _FEEDS, _LIVE, _DELTAS.format("live"))
    + "select counter, (t // 60000 + 1) * 60 period_end, round(sum(sum(delta)) over (partition by counter order by t // 60000), 2) total from deltas join feeds using (ref) group by counter, t // 60000"
)
def q_aggregated_counter_series(spark, d):
    out = counters.aggregated_counter_series(X.samples(spark, d), X.series(spark, d), COUNTERS)
    return out.select("counter", F.unix_seconds("period_end").alias("period_end"), F.round("total", 2).alias("total"))


@query(_with(X.SAMPLES, _LIVE, _DELTAS.format("live")) + "select ref, (t // 300000 + 1) * 300 period_end, round(sum(delta) / 300, 6) rate from deltas group by ref, t // 300000")
def q_rate_5m(spark, d):
    return stats.rate_5m(X.samples(spark, d)).select("ref", F.unix_seconds("period_end").alias("period_end"), F.round("rate", 6).alias("rate"))


# Points and delivery

_POINTS = """pj as (select s.*, k.series_key, k.metric_kind, k.value_type from live s join keyed k on s.ref = k.ref),
pr as (select *, lag(v) over w p, first_value(v) over w v0, first_value(t) over w t0 from pj window w as (partition by ref order by seq)),
ps as (select *, last_value(case when v < p then t - 1 end ignore nulls) over (partition by ref order by seq rows unbounded preceding) rt from pr),
points as (select seq, ref, t, series_key, case when metric_kind = 'GAUGE' then null else coalesce(rt, t0) end start, case when metric_kind = 'GAUGE' or rt is not null then v else v - v0 end val, value_type from ps where metric_kind = 'GAUGE' or p is not null)"""
_ALL_POINTS = (X.SAMPLES, _LIVE, *_DIMENSIONS, _RESOLVED, _KEYED, _POINTS)
_POINT = "select seq, series_key, t, start, case when value_type = 'int64' then (sign(val) * floor(abs(val) + 0.5))::bigint end int64_value, case when value_type <> 'int64' then round(val, 4) end double_value from points"


def _points(spark, d):
    return plans.points(X.samples(spark, d), _resolved(spark, d).filter("reason is null"))


@query(_with(*_ALL_POINTS) + _POINT)
def q_points(spark, d):
    return _points(spark, d).select("seq", "series_key", "t", "start", "int64_value", F.round("double_value", 4).alias("double_value"))


_ASOF_POINTS = _POINTS.replace("from live s join keyed k on s.ref = k.ref", "k.seq defined from (select s.*, r.seq since from live s asof join fx_series r on s.ref = r.ref and s.seq >= r.seq) s join keyed k on s.ref = k.ref and s.since = k.seq").replace("k.value_type k.seq", "k.value_type, k.seq").replace("partition by ref", "partition by ref, defined")
_REDEFINED_POINTS = (X.SAMPLES, _LIVE, X.REDEFINED, X.TARGETS, _MATCHED, _RESOLVED, _KEYED, _ASOF_POINTS)


def _redefined(spark, d):
    """The log's definitions, and what each resolves to."""
    records = X.redefined_series(spark, d)
    resolved = _resolved(spark, d, records.drop("scrape_id")).filter("reason is null").withColumnRenamed("seq", "defined")
    return records, resolved


@query(_with(*_REDEFINED_POINTS) + _POINT)
def q_points_redefined(spark, d):
    """A log that defines refs anew, some with other labels: their samples go on as another output series."""
    records, resolved = _redefined(spark, d)
    out = plans.points(X.samples(spark, d), resolved, records.select("ref", "seq"))
    return out.select("seq", "series_key", "t", "start", "int64_value", F.round("double_value", 4).alias("double_value"))


@query(
    _with(
        X.HISTOGRAM,
        "h as (select rf, ls, t, any_value(start) st, any_value(cnt)::bigint cnt, any_value(total) total from hist group by rf, ls, t)",
        "pts as (select *, row_number() over (partition by rf order by t, ls) rn from h)",
        """f(rf, rn, ls, le, ok) as (select rf, rn, st, t, true from pts where rn = 1 union all
 select p.rf, p.rn, case when k then p.st else f.ls end, case when k then p.t else f.le end, k from f join pts p on p.rf = f.rf and p.rn = f.rn + 1,
 lateral (select (p.st = f.ls and p.t > f.le) or (p.st > f.ls and p.st >= f.le) as k) z)""",
        recursive=True,
    )
    + "select 'h' || rf series_key, p.t, p.st start, p.cnt, null::double val from f join pts p using (rf, rn) where ok union all select 's' || rf || ls, t, st, null, round(total, 4) from h"
)
def q_points_histograms(spark, d):
    """Histograms and scalars in one run. The histograms of two line statuses feed one output series, so half of their points overlap and go; each sum is a counter of its own as well."""
    flag, status = (L.get(F.col("labels"), n) for n in ("rf", "ls"))
    rows = X.histogram_samples(spark, d).withColumn("seq", F.expr("seq div 10 * 100 + seq % 10") + F.ascii(status) % 10 * 10)
    sums = rows.filter("suffix = '_sum'").withColumns({"ref": F.col("ref") + 1_000_000, "base": F.lit(""), "suffix": F.lit(""), "seq": F.col("seq") + 2})
    kind = lambda df, key, t, v: df.select("ref", key.alias("series_key"), F.lit("m").alias("metric"), F.lit("CUMULATIVE").alias("metric_kind"), F.lit(t).alias("metric_type"), F.lit(v).alias("value_type"), "suffix", "base", "labels")
    one = lambda df: df.groupBy("ref").agg(*(F.first(c).alias(c) for c in ("labels", "suffix", "base")))
    resolved = kind(one(rows), F.concat(F.lit("h"), flag), "histogram", "distribution").unionByName(kind(one(sums), F.concat(F.lit("s"), flag, status), "counter", "double"))
    out = plans.points(rows.unionByName(sums).select("ref", "seq", "scrape_id", "t", "v"), resolved)
    return out.select("series_key", "t", "start", F.col("distribution.count").alias("cnt"), F.round("double_value", 4).alias("val"))


@query(_with(*_ALL_POINTS) + "select (select count(distinct scrape_id) from fx_samples) batches_processed, (select count(*) from fx_samples) samples_processed, (select count(*) from points) samples_produced")
def q_pipeline_stats(spark, d):
    return stats.pipeline_stats(X.samples(spark, d), _points(spark, d))


@query(_with(X.PAIRS) + "select sk series_key, max(seq) seq, arg_max(t, seq) t, arg_max(v, seq) v from fx_pts group by sk")
def q_last_point_per_series(spark, d):
    return stats.last_point_per_series(X.pair_points(spark, d).drop("ref")).select("series_key", "seq", "t", "v")


def _bucket(key: str, n: int) -> str:
    """The SQL of batching.bucket."""
    return f"(('0x' || substr(md5({key}::varchar), 1, 8))::bigint % {n})::int"


_BATCHES = f"ba as (select seq, ref series_key, row_number() over (partition by ref order by seq) round, {_bucket('ref', 64)} lane from fx_samples), bb as (select *, ((row_number() over (partition by round, lane order by series_key) - 1) // 200)::int chunk from ba)"


@query(_with(X.SAMPLES, _BATCHES) + "select seq, series_key, round, lane, chunk from bb")
def q_assign_batches(spark, d):
    return batching.assign_batches(X.samples(spark, d).withColumnRenamed("ref", "series_key")).select("seq", "series_key", "round", "lane", "chunk")


@query(_with(X.SAMPLES) + f"select {_bucket('ref', 8)} shard, count(*) n, count(distinct ref) series from fx_samples group by 1")
def q_assign_shards(spark, d):
    return batching.assign_shards(X.samples(spark, d).withColumnRenamed("ref", "series_key"), 8).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("series_key").alias("series"))


@query(_with(X.SAMPLES) + "select ref series_key, count(*) n, count(distinct seq) requests, min(seq) first_seq from fx_samples where not isnan(v) group by ref")
def q_sink_requests(spark, d):
    path = shared_path(spark, "requests")
    batching.write_requests(counters.drop_nan(X.samples(spark, d)).withColumnRenamed("ref", "series_key"), path)
    back = spark.read.schema("series_key long, seq long, round int, lane int, chunk int, v double").json(path)
    return back.groupBy("series_key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("round", "lane", "chunk").alias("requests"), F.min("seq").alias("first_seq"))


@query(
    """with r as (select o_orderkey, o_custkey % 200 + 1 total, case when o_orderkey % 5 = 0 then 14 when o_orderkey % 11 = 0 then 4 else 0 end st, o_orderkey % 3 = 0 and o_orderkey % 5 <> 0 and o_orderkey % 11 <> 0 part from orders),
p as (select st status, total pts from r where not part union all select 0, total - total // 2 from r where part union all select 3, total // 2 from r where part)
select status, sum(pts)::bigint points from p group by status having sum(pts) > 0"""
)
def q_points_by_status(spark, d):
    o = X.table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 200 + 1).alias("total"), F.expr("case when o_orderkey % 5 = 0 then 14 when o_orderkey % 11 = 0 then 4 else 0 end").alias("status"))
    partly = (F.col("o_orderkey") % 3 == 0) & (F.col("status") == 0)
    half = F.expr("total div 2")
    errors = F.when(partly, F.array(F.struct(F.lit(3).alias("code"), half.alias("points")))).otherwise(F.array().cast("array<struct<code:int,points:bigint>>"))
    return stats.points_by_status(o.select("total", F.when(partly, F.col("total") - half).otherwise(0).alias("success"), errors.alias("errors"), "status")).select("status", "points")


@query(
    """with x as (select o_totalprice x, (o_totalprice >= 10000)::int + (o_totalprice >= 50000)::int + (o_totalprice >= 100000)::int + (o_totalprice >= 200000)::int bucket from orders)
select bucket, count(*) n, (select count(*) from x) count, round((select avg(x) from x), 4) mean, round((select var_pop(x) * count(*) from x) / 1e9, 3) sum_sq_dev from x group by bucket"""
)
def q_explicit_distribution(spark, d):
    out = stats.explicit_distribution(X.table(spark, d, "orders"), F.col("o_totalprice"), (10000, 50000, 100000, 200000))
    return out.select("bucket", "n", "count", F.round("mean", 4).alias("mean"), F.round(F.col("sum_sq_dev") / 1e9, 3).alias("sum_sq_dev"))


# Streams


SCRAPES_PER_FILE = 2500
#: A micro-batch takes a file of a small log, and of larger ones an eighth of their files, but no more than so many, so that all tasks have some to read.
FILES_PER_BATCH = 16


class _Log(NamedTuple):
    path: str
    files_per_trigger: int


def _append(packed: DataFrame, path: str) -> _Log:
    """Writes scrapes as JSON files of bounded size (four at least), whose order in time is that of the scrapes, after what is there."""
    packed = written(packed, "packed")
    files = max(4, -(-packed.count() // SCRAPES_PER_FILE))
    readers.append_in_order(packed.repartitionByRange(files, "scrape_id").sortWithinPartitions("scrape_id"), path)
    return _Log(path, min(FILES_PER_BATCH, -(-files // 8)))


def _log(spark, d, samples=None, path: str | None = None) -> _Log:
    return _append(readers.pack_scrapes(samples if samples is not None else X.samples(spark, d)), path or shared_path(spark, "log"))


def _samples_stream(spark, log: _Log) -> DataFrame:
    return readers.read_samples_stream(spark, log.path, files_per_trigger=log.files_per_trigger)


@query(_with(*_ALL_POINTS) + "select seq, series_key, t, start, round(val, 4) val, value_type from points")
def q_stream_points(spark, d):
    log, out = _log(spark, d), shared_path(spark, "points")
    resolved = _resolved(spark, d).filter("reason is null")
    streams.to_table(streams.stream_points(_samples_stream(spark, log), resolved), out, shared_path(spark, "checkpoint"))
    return spark.read.parquet(out).select("seq", "series_key", "t", "start", F.round("value", 4).alias("val"), "value_type")


@query(_with(*_REDEFINED_POINTS) + "select seq, series_key, t, start, round(val, 4) val, value_type from points")
def q_stream_points_redefined(spark, d):
    """The same as a stream: definitions and samples in one log, the definition of each ref in state, chained with the state of each output series."""
    records, resolved = _redefined(spark, d)
    log, out = _append(readers.pack_log(X.samples(spark, d), records), shared_path(spark, "log")), shared_path(spark, "points")
    defined = streams.stream_join_asof(readers.read_log_stream(spark, log.path, files_per_trigger=log.files_per_trigger)).drop("labels")
    streams.to_table(streams.stream_points(defined, resolved), out, shared_path(spark, "checkpoint"))
    return spark.read.parquet(out).select("seq", "series_key", "t", "start", F.round("value", 4).alias("val"), "value_type")


@query(_with(X.SAMPLES, _LIVE, _DELTAS.format("live")) + "select seq, ref, t, round(delta, 4) delta from deltas")
def q_stream_counter_deltas(spark, d):
    log, out = _log(spark, d), shared_path(spark, "deltas")
    streams.to_table(streams.stream_counter_deltas(_samples_stream(spark, log)), out, shared_path(spark, "checkpoint"))
    return spark.read.parquet(out).select("seq", "ref", "t", F.round("delta", 4).alias("delta"))


@query(_with(X.SAMPLES, _SHAKEN, _DELTAS.format("ordered")) + "select seq, ref, t, round(delta, 4) delta from deltas")
def q_stream_late(spark, d):
    log, out = _log(spark, d, _shaken(spark, d)), shared_path(spark, "late")
    streams.to_table(streams.stream_counter_deltas(_samples_stream(spark, log)), out, shared_path(spark, "checkpoint"))
    return spark.read.parquet(out).select("seq", "ref", "t", F.round("delta", 4).alias("delta"))


@query(
    _with(X.SAMPLES, _LIVE, X.SERIES)
    + """, half as (select max(scrape_id) // 2 * 100 mid from fx_samples)
select s.seq, s.ref, r.usr, r.seq defined from live s join fx_series r on s.ref = r.ref and s.seq >= r.seq, half where s.seq >= mid and not (r.segment <= 2 and r.ref % 4 <> 0 and r.seq < mid)"""
)
def q_stream_prune(spark, d):
    """The second half of a log. What its first half has defined is the initial state; then the dead series of an old segment are removed, as prune_series removes them."""
    s, records = X.samples(spark, d), written(X.series(spark, d).withColumn("scrape_id", F.expr("seq div 100")), "series")
    half = (s.agg(F.max("scrape_id")).first()[0] or 0) // 2
    known, later = records.filter(F.col("scrape_id") < half), records.filter(F.col("scrape_id") >= half)
    # Removals stand at the begin of the half.
    gone = streams.removals(known, records.filter("ref % 4 = 0"), 2).select(F.lit(half).cast("long").alias("scrape_id"), F.lit(100 * half - 1).cast("long").alias("seq"), "ref", "checkpoint")
    log, out = _append(readers.pack_log(s.filter(F.col("scrape_id") >= half), later, gone), shared_path(spark, "log")), shared_path(spark, "pruned")
    left = streams.stream_join_asof(readers.read_log_stream(spark, log.path, files_per_trigger=log.files_per_trigger), initial=known)
    streams.to_table(left.select("seq", "ref", L.get(F.col("labels"), "usr").alias("usr"), "defined"), out, shared_path(spark, "checkpoint"))
    return spark.read.parquet(out)


def _event_log(spark, d) -> str:
    path = shared_path(spark, "events")
    readers.append_in_order(X.table(spark, d, "events").select("event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).repartitionByRange(4, "us"), path)
    return path


@query(
    """with recursive e as (select event_type, time_bucket(interval '15 minutes', ts) tick, count(*) n from events group by all),
stop as (select time_bucket(interval '15 minutes', date_trunc('millisecond', max(ts))) - interval '15 minutes' tick from events),
g as (select event_type, unnest(generate_series(min(e.tick), any_value(stop.tick), interval '15 minutes')) tick from e, stop group by event_type),
r as (select g.event_type, g.tick, coalesce(n, 0) / 900.0::double x, row_number() over (partition by g.event_type order by g.tick) k from g left join e on g.event_type = e.event_type and g.tick = e.tick),
f as (select event_type, tick, k, x rate from r where k = 1 union all select r.event_type, r.tick, r.k, f.rate + 0.2 * (r.x - f.rate) from f join r on r.event_type = f.event_type and r.k = f.k + 1)
select event_type, epoch_us(tick) // 1000000 + 900 tick_end, round(rate, 9) rate from f"""
)
def q_stream_ewma_rate(spark, d):
    """Smoothed rates of a stream, up to the last tick that has ended for all."""
    path, out = _event_log(spark, d), shared_path(spark, "rates")
    rows = spark.readStream.schema("event_type string, us long").option("maxFilesPerTrigger", 1).json(path).select("event_type", F.timestamp_micros("us").alias("ts"))
    streams.to_table(ticks.stream_ewma_rate(rows, "event_type", "ts", 900), out, shared_path(spark, "checkpoint"))
    return spark.read.parquet(out).select("event_type", F.unix_seconds("tick_end").alias("tick_end"), F.round("rate", 9).alias("rate"))


@query(
    _with(X.SAMPLES, X.SERIES, _FEEDS, _LIVE, _DELTAS.format("live"))
    + """select * from (select counter, (t // 60000 + 1) * 60 period_end, round(sum(sum(delta)) over (partition by counter order by t // 60000), 2) total from deltas join feeds using (ref) group by counter, t // 60000)
where period_end * 1000 <= (select max(t) from deltas)"""
)
def q_stream_counter_series(spark, d):
    """Aggregated counters' 60 s series of a stream: deltas, then periods that have ended."""
    log, grown, out = _log(spark, d), shared_path(spark, "deltas"), shared_path(spark, "counters")
    streams.to_table(streams.stream_counter_deltas(_samples_stream(spark, log)), grown, shared_path(spark, "checkpoint"))
    deltas = spark.readStream.schema("ref long, seq long, t long, delta double").parquet(grown)
    feeds = series.match_counters(X.series(spark, d), COUNTERS).select("ref", "counter")
    streams.to_table(ticks.stream_counter_series(deltas, feeds), out, shared_path(spark, "checkpoint"))
    return spark.read.parquet(out).select("counter", F.unix_seconds("period_end").alias("period_end"), F.round("total", 2).alias("total"))


@query(_with(*_ALL_POINTS) + "select (select count(distinct scrape_id) from fx_samples) batches_processed, (select count(*) from fx_samples) samples_processed, (select count(*) from points) samples_produced")
def q_stream_stats(spark, d):
    """What a stream of points counts as it runs."""
    log, stats_of = _log(spark, d), observed.PipelineStats()
    scrapes = readers.read_scrapes_stream(spark, log.path, files_per_trigger=log.files_per_trigger)
    points = streams.stream_points(observed.counted_samples(scrapes), _resolved(spark, d).filter("reason is null"))
    spark.streams.addListener(stats_of)
    try:
        stats_of.wait_for(streams.to_table(observed.counted_points(points), shared_path(spark, "points"), shared_path(spark, "checkpoint")))
    finally:
        spark.streams.removeListener(stats_of)
    return spark.createDataFrame([tuple(stats_of.totals().values())], ", ".join(f"{n} long" for n in observed.COUNTED))


@query(_with(X.SAMPLES) + "select ref, t, count(distinct t) n from fx_samples group by ref, t")
def q_stream_dedup(spark, d):
    """The log with its last quarter replayed."""
    s = X.samples(spark, d)
    log, out = _log(spark, d, s), shared_path(spark, "dedup")
    last = s.agg(F.max("scrape_id")).first()[0] or 0
    _log(spark, d, s.filter(F.col("scrape_id") > last * 3 // 4), log.path)
    stream = streams.drop_replays(_samples_stream(spark, log), "400 days").select("seq", "ref", "t", "v")
    streams.to_table(stream, out, shared_path(spark, "checkpoint"))
    return spark.read.parquet(out).groupBy("ref", "t").agg(F.count(F.lit(1)).alias("n"))


@query(_with(*_ALL_POINTS) + "select s.seq, k.series_key, p.t, p.start, round(p.val, 4) val, p.value_type from fx_samples s join keyed k on s.ref = k.ref left join points p on s.seq = p.seq")
def q_stream_refresh(spark, d):
    """Resolution with dimensions that are read anew with every micro-batch, then points of the resolved samples: every one of these, with the point that it makes if it makes one."""
    log, table, samples, points = _log(spark, d), shared_path(spark, "resolved"), shared_path(spark, "resolved-samples"), shared_path(spark, "points")
    # The series' records are derived from all events: that is done once.
    records = written(X.series(spark, d), "series")
    resolve_refs = lambda s, refs: streams.dimension(_resolved(s, d, records.join(refs, "ref", "left_semi")).filter("reason is null"))
    streams.refresh_dimensions(_samples_stream(spark, log), resolve_refs, table, samples, shared_path(spark, "checkpoint"))
    stream = streams.resolved_points(streams.refreshed_samples(spark, samples))
    streams.to_table(stream, points, shared_path(spark, "checkpoint"))
    made = spark.read.schema(stream.schema).parquet(points).select("seq", "t", "start", F.round("value", 4).alias("val"), "value_type")
    return spark.read.parquet(samples).select("seq", "series_key").join(made, "seq", "left")


@query(_with(*_ALL_POINTS) + "select series_key, count(*) points, count(*) requests, true in_limits from points group by series_key")
def q_stream_sink(spark, d):
    """Points delivered by foreachBatch: in how many requests each series went, and whether all of these held their limits."""
    log, out = _log(spark, d), shared_path(spark, "sink")
    resolved = _resolved(spark, d).filter("reason is null")
    points = streams.stream_points(_samples_stream(spark, log), resolved)
    streams.for_each_batch(points, lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(out), shared_path(spark, "checkpoint"))
    sent, request = spark.read.parquet(out), ("batch", "round", "lane", "chunk")
    limits = sent.groupBy(*request).agg((F.count(F.lit(1)) <= batching.MAX_SIZE).alias("small"), (F.count(F.lit(1)) == F.countDistinct("series_key")).alias("once"))
    told = sent.join(limits, list(request))
    return told.groupBy("series_key").agg(F.count(F.lit(1)).alias("points"), F.countDistinct(*request).alias("requests"), F.bool_and(F.col("small") & F.col("once")).alias("in_limits"))
