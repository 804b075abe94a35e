"""The engine's tables, derived from a star schema's (events, orders, lineitem, customer, supplier, part).

Each function's counterpart in DuckDB's SQL stands beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators import resources as R


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


REF = "user_id * 10 + case event_type when 'click' then 0 when 'view' then 1 when 'purchase' then 2 when 'error' then 3 else 4 end"
NAME = "case event_type when 'click' then 'clicks_total' when 'view' then 'page_view' when 'purchase' then 'purchase_sum' when 'error' then 'errors:rate' else 'signup' end"


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = L.ms_of_timestamp(F.col("ts"))
    v = F.when(F.col("event_id") % 97 == 0, float("nan")).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.expr("event_id div 100").alias("scrape_id"), F.expr(REF).alias("ref"), t.alias("t"), v.alias("v"))


SAMPLES = f"fx_samples as (select event_id seq, event_id // 100 scrape_id, {REF} ref, epoch_us(ts) // 1000 t, case when event_id % 97 = 0 then 'NaN'::double else value end v from events)"


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ref, labels, segment, seq)."""
    flat = table(spark, sf_dir, "events").groupBy(F.expr(REF).alias("ref"), "user_id", F.expr(NAME).alias("name")).agg(F.min("event_id").alias("seq"))
    part = lambda text, n: F.concat(F.lit(text), (F.col("user_id") % n).cast("string"))
    made = L.labels_of(__name__=F.col("name"), job=part("job", 3), instance=part("inst", 20), usr=F.concat(F.lit("u"), "user_id"), device=part("eth", 3))
    return flat.select("ref", made.alias("labels"), F.expr("cast(seq div 1000 as int)").alias("segment"), "seq")


SERIES = f"fx_series as (select {REF} ref, {NAME} name, 'job' || (user_id % 3) job, 'inst' || (user_id % 20) instance, 'u' || user_id usr, 'eth' || (user_id % 3) device, min(event_id) seq, (min(event_id) // 1000)::int segment from events group by all)"

def redefined_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ref, labels, segment, seq, scrape_id): every third ref is defined again 2000 places later, every sixth then with another user."""
    once = series(spark, sf_dir)
    other = F.when(F.col("ref") % 2 == 0, F.concat(L.get(F.col("labels"), "usr"), F.lit("b"))).otherwise(L.get(F.col("labels"), "usr"))
    again = once.filter("ref % 3 = 0").withColumns({"labels": F.map_concat(L.drop_label(F.col("labels"), "usr"), F.create_map(F.lit("usr"), other)), "seq": F.col("seq") + 2000})
    return once.unionByName(again).withColumn("scrape_id", F.expr("seq div 100"))


REDEFINED = SERIES.replace("fx_series", "fx_once", 1) + """, fx_series as (select ref, name, job, instance, usr, device, seq, segment from fx_once
    union all select ref, name, job, instance, case when ref % 2 = 0 then usr || 'b' else usr end, device, seq + 2000, segment from fx_once where ref % 3 = 0)"""

STATIC = {R.PROJECT: "proj", R.LOCATION: "loc", R.CLUSTER: "clu", R.GENERIC_LOCATION: "gloc", R.GENERIC_NAMESPACE: ""}


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, labels, discovered), by customer: of four kinds: containers, virtual machines, generic tasks, and ones that no rule knows."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.expr("c_custkey div 3").alias("number"))
    kind = F.col("number") % 4
    when = lambda k, v: F.when(kind.isin(k) if isinstance(k, int) else kind.isin(*k), v)
    n = F.col("number").cast("string")
    labels = L.labels_of(job=F.concat(F.lit("job"), (F.col("c_custkey") % 3).cast("string")), instance=F.concat(F.lit("inst"), n))
    found = {
        R.PROJECT: when((0, 2), F.lit("proj")), R.LOCATION: when(0, F.lit("loc")), R.CLUSTER: when(0, F.lit("clu")), R.KUBERNETES + "namespace": when(0, F.lit("ns")),
        R.KUBERNETES + "pod_name": when(0, F.concat(F.lit("pod"), n)), R.KUBERNETES + "pod_container_name": when(0, F.lit("main")),
        "__meta_gce_project": when(1, F.lit("gproj")), "__meta_gce_instance_id": when(1, F.concat(F.lit("vm"), n)), "__meta_gce_zone": when(1, F.concat(F.lit("projects/p/zones/z"), n)),
        R.GENERIC_LOCATION: when(2, F.lit("gloc")), R.GENERIC_NAMESPACE: when(2, F.lit("gns")), "other": F.lit("x"),
    }
    return rows.select(F.col("c_custkey").alias("ordinal"), labels.alias("labels"), L.labels_of(**found).alias("discovered"))


TARGETS = "fx_targets as (select c_custkey ordinal, 'job' || (c_custkey % 3) job, 'inst' || (c_custkey // 3) instance, c_custkey // 3 n, (c_custkey // 3) % 4 kind from customer)"


def static_metadata(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("page_view", "gauge", "int64", "views")], "metric string, metric_type string, value_type string, help string")


def fetched_metadata(spark: SparkSession) -> DataFrame:
    rows = [(0, "clicks", "counter", "clicks"), (1, "purchase", "summary", "amounts"), (2, "page_view", "counter", "hidden by the static entry"), (3, "clicks", "gauge", "seen later")]
    return spark.createDataFrame(rows, "ordinal int, metric string, metric_type string, help string")


def renames(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("page_view", "web/views"), ("other", "unused")], "`from` string, `to` string")


def part_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata entries by part: (ordinal, metric, metric_type, value_type, help), with types and value types that don't exist, and metrics that repeat."""
    kind = F.expr("element_at(array('counter', 'gauge', 'histogram', 'summary', 'untyped', 'unknown', 'timer'), cast(p_partkey % 7 + 1 as int))")
    value = F.expr("case p_partkey % 5 when 0 then 'int64' when 1 then 'double' when 2 then 'string' end")
    metric = F.concat(F.lit("m_"), F.expr("cast(p_partkey % 1500 as string)"), F.expr("case p_partkey % 4 when 0 then '_total' when 1 then ':rate' when 2 then '_sum' else '' end"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), metric.alias("metric"), kind.alias("metric_type"), value.alias("value_type"), F.col("p_name").alias("help"))


PART_METADATA = """fx_part as (select p_partkey ordinal, 'm_' || (p_partkey % 1500) || case p_partkey % 4 when 0 then '_total' when 1 then ':rate' when 2 then '_sum' else '' end metric,
    ['counter', 'gauge', 'histogram', 'summary', 'untyped', 'unknown', 'timer'][p_partkey % 7 + 1] metric_type, case p_partkey % 5 when 0 then 'int64' when 1 then 'double' when 2 then 'string' end value_type, p_name help from part)"""


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, kind, cut, labels, discovered) by supplier: what rule s_suppkey % 12 needs, split over both sets, and for every seventh one label short."""
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 12).alias("kind"), (F.expr("s_suppkey div 12") % 7 == 0).alias("cut"), (F.expr("s_suppkey div 12") % 5 == 0).alias("own"))
    labels, found = {}, {}
    for k, rule in enumerate(R.RULES):
        for i, source in enumerate([*rule.labels, *([rule.match_label] if rule.match_label else [])]):
            here = (F.col("kind") == k) & ~(F.col("cut") & (i == 1 if i else False))
            value = F.concat(F.lit(f"v{i}/"), F.col("id").cast("string"))
            # The second label of every fifth one is the series' own as well, with another value.
            found.setdefault(source, []).append(F.when(here, value))
            if i == 1:
                labels.setdefault(source, []).append(F.when((F.col("kind") == k) & F.col("own"), F.concat(F.lit("own/"), F.col("id").cast("string"))))
    one = lambda d: L.labels_of(**{n: F.coalesce(*v) for n, v in d.items()})
    extra = F.create_map(F.lit("keep"), F.lit("me"))
    return rows.select("id", "kind", "cut", "own", F.map_concat(one(labels), extra).alias("labels"), one(found).alias("discovered"))


def histogram_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ref, seq, scrape_id, t, v, labels, base, suffix): cumulative histograms of quantities by flag and status, a scrape a month, restarting each year."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("rf"), F.col("l_linestatus").alias("ls"), F.date_trunc("month", F.col("l_shipdate").cast("timestamp")).alias("m"), F.col("l_quantity").alias("q"))
    edges = (10.0, 20.0, 30.0, 40.0, float("inf"))
    monthly = items.groupBy("rf", "ls", "m").agg(*(F.sum((F.col("q") <= e).cast("int")).alias(f"b{i}") for i, e in enumerate(edges)), F.sum("q").alias("s"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("rf", "ls", F.year("m")).orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    total = monthly.select("rf", "ls", "m", *(F.sum(c).over(w).cast("double").alias(c) for c in [*(f"b{i}" for i in range(len(edges))), "s", "n"]))
    texts = ("10", "20", "30", "40", "+Inf")
    members = [F.struct(F.lit("_bucket").alias("suffix"), F.lit(texts[i]).alias("le"), F.col(f"b{i}").alias("v"), F.lit(i).alias("i")) for i in range(len(edges))]
    members += [F.struct(F.lit("_sum").alias("suffix"), F.lit(None).cast("string").alias("le"), F.col("s").alias("v"), F.lit(5).alias("i")), F.struct(F.lit("_count").alias("suffix"), F.lit(None).cast("string").alias("le"), F.col("n").alias("v"), F.lit(6).alias("i"))]
    rows = total.select("rf", "ls", "m", F.explode(F.array(*members)).alias("x"))
    labels = L.labels_of(__name__=F.concat(F.lit("quantity"), "x.suffix"), rf=F.col("rf"), ls=F.col("ls"), le=F.col("x.le"))
    t = F.unix_millis("m")
    ref = F.ascii("rf") * 1000 + F.ascii("ls") * 10 + F.col("x.i")
    return rows.select(ref.cast("long").alias("ref"), (t * 10 + F.col("x.i")).alias("seq"), t.alias("scrape_id"), t.alias("t"), F.col("x.v").alias("v"), labels.alias("labels"), F.lit("quantity").alias("base"), F.col("x.suffix").alias("suffix"))


HISTOGRAM = """raw as (select l_returnflag rf, l_linestatus ls, date_trunc('month', l_shipdate) m, year(l_shipdate) y, b.le, sum(case when l_quantity <= b.le then 1 else 0 end) c0, sum(l_quantity) s0, count(*) n0
    from lineitem, (values (10.0::double), (20.0::double), (30.0::double), (40.0::double), ('Infinity'::double)) b(le) group by all),
fx_hist as (select rf, ls, m, epoch_ms(m) t, le, (sum(c0) over w)::double c, (sum(s0) over w)::double s, (sum(n0) over w)::double n from raw window w as (partition by rf, ls, le, y order by m)),
adj as (select *, lag(c) over w pc, first_value(c) over w c1, lag(s) over w ps, first_value(s) over w s1, lag(n) over w pn, first_value(n) over w n1, first_value(t) over w t1 from fx_hist window w as (partition by rf, ls, le order by t)),
adj2 as (select *, last_value(case when c < pc then t - 1 end ignore nulls) over w rc, last_value(case when s < ps then t - 1 end ignore nulls) over w rs, last_value(case when n < pn then t - 1 end ignore nulls) over w rn
    from adj window w as (partition by rf, ls, le order by t rows unbounded preceding)),
hist as (select rf, ls, t, le, trunc(case when rc is null then c - c1 else c end)::bigint cum, case when rs is null then s - s1 else s end total, case when rn is null then n - n1 else n end cnt, coalesce(rn, t1) start from adj2 where pn is not null)"""


def pair_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples (seq, ref, series_key, t, v) of feeders that make up one output series in pairs."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    # A place in time order without one task for all: day, then key.
    t = L.ms_of_timestamp(F.col("o_orderdate"))
    return rows.select((F.unix_seconds(F.col("o_orderdate").cast("timestamp")) * 10_000_000 + F.col("o_orderkey")).alias("seq"), (F.col("o_custkey") % 40).alias("ref"), F.expr("(o_custkey % 40) div 2").alias("series_key"), t.alias("t"), F.col("o_totalprice").alias("v"))


PAIRS = "fx_pts as (select epoch_us(o_orderdate) // 1000000 * 10000000 + o_orderkey seq, o_custkey % 40 ref, (o_custkey % 40) // 2 sk, epoch_us(o_orderdate) // 1000 t, o_totalprice v from orders)"
