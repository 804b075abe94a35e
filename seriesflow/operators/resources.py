"""Monitored resources: an ordered list of rules, compiled to columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of static labels, and below the rules' types, labels and order.
PROJECT = "_project_id"
LOCATION = "_kubernetes_location"
CLUSTER = "_kubernetes_cluster_name"
GENERIC_LOCATION = "_generic_location"
GENERIC_NAMESPACE = "_generic_namespace"
KUBERNETES = "__meta_kubernetes_"
POD_LABEL = "__meta_kubernetes_pod_label_"
L4LB = "__meta_kubernetes_service_annotation_gke_googleapis_com_anthos_l4lb_"


@dataclass(frozen=True)
class Rule:
    """labels: source label -> resource label. A rule with a match label needs it among the discovered labels."""

    resource_type: str
    labels: Mapping[str, str]
    match_label: str | None = None
    convert: Mapping[str, Callable[[Column], Column]] | None = None


ANTHOS_L4LB = Rule("anthos_l4lb", {PROJECT: "project_id", LOCATION: "location", L4LB + "kind": "kind", L4LB + "group_name": "group_name", L4LB + "hostname": "hostname"}, L4LB + "type")
CONNECTION = Rule("connectors.googleapis.com/Connection", {PROJECT: "resource_container", LOCATION: "location", "connection": "connection"}, POD_LABEL + "type_connection")
TARGET_V2 = Rule(
    "apigee.googleapis.com/TargetV2",
    {PROJECT: "resource_container", LOCATION: "location", "org": "org", "env": "env", "proxy_name": "proxy_name", "type": "type", "endpoint": "endpoint", "runtime_version": "runtime_version", "instance_id": "instance_id"},
    POD_LABEL + "type_target_v2",
)
PROXY_V2 = Rule(
    "apigee.googleapis.com/ProxyV2",
    {PROJECT: "resource_container", LOCATION: "location", "org": "org", "env": "env", "proxy_name": "proxy_name", "runtime_version": "runtime_version", "instance_id": "instance_id"},
    POD_LABEL + "type_proxy_v2",
)
PROXY = Rule(
    "apigee.googleapis.com/Proxy",
    {PROJECT: "resource_container", LOCATION: "location", POD_LABEL + "org": "org", POD_LABEL + "env": "env", "proxy_name": "proxy_name", "revision": "revision", KUBERNETES + "pod_name": "host"},
    POD_LABEL + "type_proxy",
)
DEVAPP = Rule(
    "apigee.googleapis.com/Devapp",
    {PROJECT: "resource_container", LOCATION: "location", POD_LABEL + "org": "org", POD_LABEL + "env": "env", "api_product_name": "api_product_name", KUBERNETES + "pod_name": "host"},
    POD_LABEL + "type_devapp",
)
K8S_NODE_LABELS = {PROJECT: "project_id", LOCATION: "location", CLUSTER: "cluster_name"}
K8S_POD_LABELS = {**K8S_NODE_LABELS, KUBERNETES + "namespace": "namespace_name", KUBERNETES + "pod_name": "pod_name"}
K8S_CONTAINER = Rule("k8s_container", {**K8S_POD_LABELS, KUBERNETES + "pod_container_name": "container_name"})
K8S_POD = Rule("k8s_pod", K8S_POD_LABELS)
K8S_NODE = Rule("k8s_node", {**K8S_NODE_LABELS, KUBERNETES + "node_name": "node_name"})
EC2 = Rule(
    "aws_ec2_instance",
    {PROJECT: "project_id", "__meta_ec2_instance_id": "instance_id", "__meta_ec2_availability_zone": "region", "__meta_ec2_owner_id": "aws_account"},
    convert={"__meta_ec2_availability_zone": lambda zone: F.concat(F.lit("aws:"), zone)},
)
GCE = Rule("gce_instance", {"__meta_gce_project": "project_id", "__meta_gce_instance_id": "instance_id", "__meta_gce_zone": "zone"}, convert={"__meta_gce_zone": lambda zone: F.substring_index(zone, "/", -1)})
GENERIC = Rule("generic_task", {PROJECT: "project_id", GENERIC_LOCATION: "location", GENERIC_NAMESPACE: "namespace", "job": "job", "instance": "task_id"})
GKE_CONTAINER = Rule(
    "gke_container",
    {PROJECT: "project_id", LOCATION: "zone", CLUSTER: "cluster_name", KUBERNETES + "namespace": "namespace_id", KUBERNETES + "node_name": "instance_id", KUBERNETES + "pod_name": "pod_id", KUBERNETES + "pod_container_name": "container_name"},
)
RULES = (ANTHOS_L4LB, CONNECTION, TARGET_V2, PROXY_V2, PROXY, DEVAPP, K8S_CONTAINER, K8S_POD, K8S_NODE, EC2, GCE, GENERIC)


def _table(rules: Sequence[Rule], at: Mapping[tuple, int], best_effort: Rule | None) -> Column:
    """The rules as rows of one constant: of each its type, its labels' names, where their values are, the labels that it uses, and the one that it needs. A lenient one matches without values."""
    every = [(r, False) for r in rules] if best_effort is None else [(best_effort, True), *((r, False) for r in rules)]
    texts = lambda values: F.array(*(F.lit(v) for v in values)).cast("array<string>")
    row = lambda r, lenient: F.struct(
        F.lit(r.resource_type).alias("type"), texts(r.labels.values()).alias("names"), F.array(*(F.lit(at[s, (r.convert or {}).get(s)]) for s in r.labels)).cast("array<int>").alias("at"),
        texts(r.labels).alias("used"), F.lit(r.match_label).cast("string").alias("needs"), F.lit(lenient).alias("lenient"),
    )
    return F.array(*(row(r, lenient) for r, lenient in every))


def resolve_resource(df: DataFrame, rules: Sequence[Rule] = RULES, best_effort: Rule | None = None, labels: str = "labels", discovered: str = "discovered") -> DataFrame:
    """df with resource_type and resource_labels of the first rule that matches (null if none does), and labels without those that it used.

    What rules ask for is looked up once a row, as an array; the series' own labels win over discovered ones. Rules are rows of a constant table, not branches of an expression:
    code for all branches is a method too long for the JVM to compile."""
    every = [*rules, *([best_effort] if best_effort else [])]
    sources = list(dict.fromkeys(s for r in every for s in r.labels))
    converted = list(dict.fromkeys((s, f) for r in every for s, f in (r.convert or {}).items() if s in r.labels))
    at = {k: n for n, k in enumerate([*((s, None) for s in sources), *converted])}
    own, others = F.col(labels), F.col(discovered)
    values = F.transform(F.array(*(F.lit(s) for s in sources)), lambda s: F.coalesce(F.try_element_at(own, s), F.try_element_at(others, s)))
    rows = df.withColumn("__values", values)
    if converted:
        rows = rows.withColumn("__values", F.concat("__values", F.array(*(f(F.col("__values")[sources.index(s)]) for s, f in converted))))
    has = lambda r: r["lenient"] | F.forall(r["at"], lambda k: F.get("__values", k).isNotNull())
    matches = lambda r: has(r) & (r["needs"].isNull() | F.array_contains(F.map_keys(others), r["needs"]))
    # A null map (no target) matches no rule.
    found = rows.withColumn("__hit", F.when(others.isNotNull(), F.get(F.filter(_table(rules, at, best_effort), matches), F.lit(0))))
    value = lambda k: F.coalesce(F.get("__values", k), F.when(F.col("__hit.lenient"), F.lit("")))
    rest = F.when(F.col("__hit").isNull(), F.col(labels)).otherwise(F.map_filter(labels, lambda k, _: ~F.array_contains("__hit.used", k)))
    out = {"resource_type": F.col("__hit.type"), "resource_labels": F.map_from_arrays("__hit.names", F.transform("__hit.at", value)), labels: rest}
    return found.withColumns(out).drop("__hit", "__values")
