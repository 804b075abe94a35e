import json
import random

import pytest
from pyspark.sql import functions as F

from seriesflow.functions import labels as L
from seriesflow.functions.matchers import Matcher, any_of
from seriesflow.operators import resolve, resources, series
from seriesflow.plans.points import points
from seriesflow.queries import QUERIES
from seriesflow.sources import fixtures, readers

from .util import rows

GENERIC = {resources.PROJECT: "p", resources.GENERIC_LOCATION: "l", resources.GENERIC_NAMESPACE: "n"}
SERIES = "ref long, labels map<string,string>"
TARGETS = "ordinal int, labels map<string,string>, discovered map<string,string>"
STATIC = "metric string, metric_type string, value_type string, help string"
FETCHED = "ordinal int, metric string, metric_type string, help string"


def resolved(spark, names, metadata, static=(), extra=None, **options):
    labels = [{"__name__": n, "job": "j", "instance": "i", **(extra or {})} if isinstance(n, str) else {"job": "j", "instance": "i", **n} for n in names]
    s = spark.createDataFrame(list(enumerate(labels)), SERIES)
    t = spark.createDataFrame([(0, {"job": "j", "instance": "i"}, GENERIC)], TARGETS)
    return resolve.resolve_all(s, t, spark.createDataFrame(list(static), STATIC), spark.createDataFrame([(k, *m) for k, m in enumerate(metadata)], FETCHED), **options)


def test_kinds_and_names(spark):
    names = ["a_total", "b_total", "g", "s_sum", "s_count", "s", "h_bucket", "h_total", "s_total", "r:x", "none"]
    meta = [("a", "counter", ""), ("b_total", "counter", ""), ("g", "untyped", ""), ("s", "summary", ""), ("h", "histogram", "")]
    out = resolved(spark, names, meta, static=[("g", "gauge", "int64", "")])
    prefix = L.PREFIX + "/"
    want = [
        (prefix + "a", "CUMULATIVE", "double", None), (prefix + "b_total", "CUMULATIVE", "double", None), (prefix + "g", "GAUGE", "int64", None), (prefix + "s_sum", "CUMULATIVE", "double", None),
        (prefix + "s_count", "CUMULATIVE", "int64", None), (prefix + "s", "GAUGE", "double", None), (prefix + "h", "CUMULATIVE", "distribution", None), (prefix, None, None, "invalid_histogram_series"),
        (prefix, None, None, "unexpected_suffix"), (prefix + "r:x", "GAUGE", "double", None), (prefix, None, None, "metadata_not_found"),
    ]
    got = [(m or prefix if r is None else prefix, k, v, r) for m, k, v, r in rows(out, "metric", "metric_kind", "value_type", "reason", order="ref")]
    assert got == want


def test_label_limit_counts_the_bucket_bound(spark):
    ten = {f"l{k}": "x" for k in range(9)}
    out = resolved(spark, ["h_bucket"], [("h", "histogram", "")], extra={**ten, "le": "1"})
    assert rows(out, "reason") == [(None,)]
    out = resolved(spark, ["h_bucket"], [("h", "histogram", "")], extra={**ten, "le": "1", "more": "x"})
    assert rows(out, "reason") == [("too_many_labels",)]


def test_renames_and_prefix(spark):
    out = resolved(spark, ["g"], [("g", "gauge", "")], renames=spark.createDataFrame([("g", "z/y")], "`from` string, `to` string"), prefix="me")
    assert rows(out, "metric") == [("me/z/y",)]


def test_rules_look_each_label_up_once_a_row(spark):
    """However many rules ask for it; own labels win, also empty ones, and a rule without all of its labels, or without a target, doesn't match."""
    gce = {"__meta_gce_project": "p", "__meta_gce_instance_id": "vm", "__meta_gce_zone": "projects/p/zones/z"}
    made = [(0, {"x": "1", "__meta_gce_project": ""}, gce), (1, {}, {k: v for k, v in gce.items() if "zone" not in k}), (2, gce, None), (3, {"job": "j"}, {**gce, **GENERIC, "instance": "i"})]
    out = resources.resolve_resource(spark.createDataFrame(made, "ref int, labels map<string,string>, discovered map<string,string>"))
    best = resources.resolve_resource(spark.createDataFrame(made[1:3], "ref int, labels map<string,string>, discovered map<string,string>"), best_effort=resources.GCE)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("element_at(") <= 4
    assert rows(out, "resource_type", "resource_labels", "labels", order="ref") == [
        ("gce_instance", {"project_id": "", "instance_id": "vm", "zone": "z"}, {"x": "1"}), (None, None, {}), (None, None, gce), ("gce_instance", {"project_id": "p", "instance_id": "vm", "zone": "z"}, {"job": "j"}),
    ]
    assert rows(best, "resource_type", "resource_labels", order="ref") == [("gce_instance", {"project_id": "p", "instance_id": "vm", "zone": ""}), (None, None)]


def test_first_rule_that_matches_wins_and_own_labels_go_first(spark):
    df = spark.createDataFrame([(0, {"job": "mine", "x": "1"}, {**GENERIC, "job": "found", "instance": "i"}), (1, {}, {"other": "x"})], "ref int, labels map<string,string>, discovered map<string,string>")
    out = resources.resolve_resource(df)
    assert rows(out, "resource_type", "resource_labels", "labels", order="ref") == [
        ("generic_task", {"project_id": "p", "location": "l", "namespace": "n", "job": "mine", "task_id": "i"}, {"x": "1"}),
        (None, None, {}),
    ]


@pytest.mark.parametrize(("le", "want"), [("0.5", 0.5), ("+Inf", float("inf")), ("1e3", 1000.0), ("abc", None), ("1d", None), (" 1", None), ("", None)])
def test_bucket_bound(spark, le, want):
    assert spark.range(1).select(L.bucket_bound(F.lit(le))).first()[0] == want


def test_target_needs_agreeing_labels_and_goes_by_order(spark):
    t = spark.createDataFrame([(1, {"job": "j", "instance": "i", "port": "a"}, {"n": "1"}), (0, {"job": "j", "instance": "i", "port": "b"}, {"n": "0"})], TARGETS)
    s = spark.createDataFrame([(0, {"job": "j", "instance": "i"}), (1, {"job": "j", "instance": "i", "port": "a"}), (2, {"job": "j", "instance": "i", "port": "c"}), (3, {"job": "k"})], SERIES)
    assert rows(series.match_target(s, t), "discovered", order="ref") == [({"n": "0"},), ({"n": "1"},), (None,), (None,)]


def test_filters(spark):
    df = spark.createDataFrame([(0, {"a": "x"}), (1, {"a": "x\n"}), (2, {})], SERIES)
    keep = lambda c: [r[0] for r in rows(df.filter(c), "ref")]
    assert keep(Matcher("a", "=~", "x").col()) == [0]
    assert keep(Matcher("a", "!~", "x").col()) == [1, 2]
    assert keep(Matcher("a", "=", "").col()) == [2]
    assert keep(Matcher("a", "!=", "").col()) == [0, 1]
    assert keep(any_of(None)) == [0, 1, 2]
    assert keep(any_of([])) == []
    with pytest.raises(ValueError, match="no such matcher"):
        Matcher("a", "==", "x")


def test_prune(spark):
    s = spark.createDataFrame(list(zip(range(1, 8), (0, 5, 9, 10, 11, 12, 13), strict=True)), "ref long, segment int")
    live = lambda *refs: spark.createDataFrame([(r,) for r in refs], "ref long")
    assert [r[0] for r in rows(series.prune_series(series.prune_series(s, live(3, 4), 10), live(4), 12), "ref")] == [4, 7]


def scrape(spark, members, t, seq):
    return [(seq + k, t, r, t, float(v)) for k, (r, v) in enumerate(members)]


def test_histogram_points(spark):
    les = ["0.1", "0.5", "1", "2.5", "+Inf"]
    names = [{"__name__": "h_sum"}, {"__name__": "h_count"}, *({"__name__": "h_bucket", "le": x} for x in les)]
    dim = resolved(spark, names, [("h", "histogram", "")]).filter("reason is null")
    first = [(0, 55.1), (1, 10), *((k + 2, v) for k, v in enumerate((2, 5, 6, 8, 10)))]
    second = [(0, 123.4), (1, 21), *((k + 2, v) for k, v in enumerate((4, 9, 11, 15, 21)))]
    samples = spark.createDataFrame(scrape(spark, first, 1000, 0) + scrape(spark, second, 2000, 10), "seq long, scrape_id long, ref long, t long, v double")
    (got,) = points(samples, dim).collect()
    d = got.distribution
    assert (got.start, got.t, d["count"], d.bounds, d.bucket_counts) == (1000, 2000, 11, [0.1, 0.5, 1.0, 2.5], [2, 2, 1, 2, 4])
    assert d.mean == pytest.approx(6.20909090909091)
    assert d.sum_sq_dev == pytest.approx(270.301590909091)


def test_histogram_without_count_or_with_a_new_bucket_is_left_out(spark):
    names = [{"__name__": "h_sum"}, {"__name__": "h_count"}, {"__name__": "h_bucket", "le": "1"}]
    dim = resolved(spark, names, [("h", "histogram", "")]).filter("reason is null")
    data = scrape(spark, [(0, 1), (1, 1)], 1000, 0) + scrape(spark, [(0, 2), (1, 2), (2, 1)], 2000, 10) + scrape(spark, [(0, 3), (2, 2)], 3000, 20) + scrape(spark, [(0, 9), (1, 5), (2, 3)], 4000, 30)
    samples = spark.createDataFrame(data, "seq long, scrape_id long, ref long, t long, v double")
    assert rows(points(samples, dim), "t", "distribution.count", "distribution.bucket_counts") == [(4000, 4, [2])]


def test_summary_counts_truncate_and_counters_round(spark):
    dim = resolved(spark, ["s_count", "c", "g"], [("s", "summary", "")], static=[("c", "counter", "int64", ""), ("g", "gauge", "int64", "")]).filter("reason is null")
    data = [(0, 1, 0, 1, 0.0), (1, 1, 1, 1, 0.0), (2, 2, 0, 2, 2.9), (3, 2, 1, 2, 12.5), (4, 2, 2, 2, -12.5)]
    samples = spark.createDataFrame(data, "seq long, scrape_id long, ref long, t long, v double")
    assert rows(points(samples, dim), "int64_value", order="seq") == [(2,), (13,), (-13,)]


def test_static_labels_replace_and_leave_out_empty_ones(spark):
    t = spark.createDataFrame([(0, {}, {"a": "1", "b": "2"})], TARGETS)
    assert readers.with_static_labels(t, {"a": "9", "c": "3", "d": ""}).first().discovered == {"a": "9", "b": "2", "c": "3"}


def test_series_key_tells_confusable_sets_apart(spark):
    df = spark.createDataFrame([({"a": "1,1:b=1:2"},), ({"a": "1", "b": "2"},), ({"b": "2", "a": "1"},)], "m map<string,string>")
    a, b, c = (r[0] for r in df.select(L.canonical(F.col("m"))).collect())
    assert a != b and b == c


def test_first_metadata_wins_and_not_found_is_empty(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"status":"success","data":[{"metric":"a","type":"untyped","help":"1"},{"metric":"a","type":"gauge","help":"2"}]}\n{"status":"error","errorType":"not_found"}\n')
    got = readers.read_metadata(spark, str(tmp_path))
    assert rows(series.first_metadata(got), "metric", "metric_type", "help") == [("a", "unknown", "1")]
    (tmp_path / "m.json").write_text('{"status":"error","errorType":"bad_data","error":"no"}\n')
    with pytest.raises(Exception, match="metadata lookup failed"):
        readers.read_metadata(spark, str(tmp_path)).collect()


def test_samples_of_unknown_series_go(spark):
    samples = spark.createDataFrame([(0, 1), (1, 2), (2, 1), (3, 3)], "seq long, ref long")
    known = spark.createDataFrame([(1, {"a": "x"}, 0, 0), (3, {"a": "y"}, 7, 1)], "ref long, labels map<string,string>, segment int, seq long")
    assert rows(series.join_series(samples, series.latest_series(known)), "seq", "ref") == [(0, 1), (2, 1), (3, 3)]


def test_all_series_join(spark):
    """Also those that a longer log sees first in its later segments."""
    d = "/root/testdata/sf0.1"
    assert QUERIES["join_series"](spark, d).count() == fixtures.samples(spark, d).count()


def test_documents_keep_the_order_of_files_and_lines(spark, tmp_path):
    """Files of very different sizes in more than a thousand blocks, the larger ones later by name and first to be read."""
    want = []
    for name, n in (("a", 3), ("b", 1500), ("c", 40)):
        lines = []
        for k in range(n):
            want += [f"{name}{k}x", f"{name}{k}y"]
            lines.append(json.dumps({"status": "success", "data": {"activeTargets": [{"labels": {"job": "j", "instance": f"{name}{k}{p}"}, "discoveredLabels": {}} for p in "xy"]}}))
        (tmp_path / f"{name}.json").write_text("\n".join(lines) + "\n")
    settings = {"spark.sql.files.maxPartitionBytes": "256", "spark.sql.files.openCostInBytes": "64"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        targets = readers.read_targets(spark, str(tmp_path))
        assert targets.rdd.getNumPartitions() > 1074
        assert [r[0] for r in rows(targets, F.col("labels.instance"), order="ordinal")] == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_first_target_is_that_of_the_first_file(spark, tmp_path):
    for name, zone in (("a", "first"), ("b", "second")):
        document = {"status": "success", "data": {"activeTargets": [{"labels": {"job": "j", "instance": "i"}, "discoveredLabels": {"zone": zone}}] * (1 if name == "a" else 500)}}
        (tmp_path / f"{name}.json").write_text(json.dumps(document) + "\n")
    one = spark.createDataFrame([(1, {"job": "j", "instance": "i"})], SERIES)
    assert rows(series.match_target(one, readers.read_targets(spark, str(tmp_path))), "ref", F.col("discovered.zone")) == [(1, "first")]


def test_targets_by_signature_are_those_of_all_pairs(spark):
    """Random label sets, some of them empty or missing, several signatures at one job and instance."""
    rng = random.Random(3)
    some = lambda names: {n: rng.choice(("", "1", "2")) for n in names if rng.random() < 0.6}
    targets = spark.createDataFrame([(k, {**({"job": "j"} if k % 5 else {}), "instance": "i", **some("abc")}, {"n": str(k)}) for k in range(60)], TARGETS)
    found = spark.createDataFrame([(k, {**({"job": "j"} if k % 7 else {}), "instance": "i", **some("abcd")}) for k in range(200)], SERIES)
    # A target that agrees with little else comes first, so that the order decides among many.
    picked = lambda most: rows(series.match_target(found, targets, most=most), "ref", F.col("discovered.n"))
    assert picked(0) == picked(1000) and len({r[1] for r in picked(0)}) >= 10


def test_ten_thousand_targets_of_one_instance_make_no_pairs(spark):
    n = 10_000
    targets = spark.range(n).selectExpr("cast(id as int) ordinal", "map('job', 'j', 'instance', 'i', 'shard', cast(id as string)) labels", "map('n', cast(id as string)) discovered")
    found = spark.range(n).selectExpr("id ref", "map('job', 'j', 'instance', 'i', 'shard', cast(id as string)) labels")
    keyed = found.select("ref", "labels", F.lit("j").alias("s_job"), F.lit("i").alias("s_instance"))
    sides = targets.select("ordinal", F.col("labels").alias("target_labels"), "discovered", F.lit("j").alias("t_job"), F.lit("i").alias("t_instance"))
    assert series._by_signature(keyed, sides, ("ref",)).count() == n
    out = series.match_target(found, targets)
    assert out.filter("discovered['n'] = cast(ref as string)").count() == n


def test_targets_that_no_series_asks_for_are_left_out_first(spark, monkeypatch):
    """A large dimension is neither paired nor looked at for its largest job and instance where series ask for few of its targets."""
    monkeypatch.setattr(series, "_by_signature", lambda *_: pytest.fail("the largest job and instance has no series"))
    met = []
    monkeypatch.setattr(series, "side", lambda table: met.append(table.count()) or table)
    targets = spark.range(500).selectExpr("cast(id as int) ordinal", "map('job', if(id < 400, 'j', 'k'), 'instance', if(id < 400, 'i', cast(id as string))) labels", "map('n', cast(id as string)) discovered")
    found = spark.createDataFrame([(0, {"job": "k", "instance": "450"}), (1, {"job": "k", "instance": "9"}), (2, {})], SERIES)
    assert rows(series.match_target(found, targets), "discovered", order="ref") == [({"n": "450"},), (None,), (None,)]
    assert met == [3, 1]


def test_what_a_name_decides_is_worked_out_once_a_name(spark, sf_dir, monkeypatch):
    asked, lookup = [], resolve.metadata_lookup
    monkeypatch.setattr(resolve, "metadata_lookup", lambda names, *rest: asked.append(names.count()) or lookup(names, *rest))
    every = fixtures.series(spark, sf_dir)
    out = resolve.resolve_all(every, fixtures.targets(spark, sf_dir), fixtures.static_metadata(spark), fixtures.fetched_metadata(spark), renames=fixtures.renames(spark))
    assert asked == [every.select(L.get(F.col("labels"), "__name__")).distinct().count()] and asked[0] < every.count()
    assert out.count() == every.count()
