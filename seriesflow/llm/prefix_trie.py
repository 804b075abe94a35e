"""Conversation prefix trie with depth-band rollup.

A node is a distinct sequence of first turns. Nodes are named by SHA-256 (its first 128 bits) of the turns on their path, in bands
of BAND depths: within a band names chain from turn to turn; the name of all turns before a band comes from the sequence of whole
bands' digests, which is named in the same way, a level up. So names need log(depth) rounds and no pass along a conversation.

Sums over subtrees: nodes with something to add explode to their ancestors within their band. Band roots are the nodes of a trie of
their own, BAND times less deep: their completed totals come from the same rollup over it, and then go to the ancestors in the band
above. Rounds are log(depth), and no row explodes to more than BAND.

No group of unbounded size is one task's: turns are numbered in range partitions (a conversation may span many), bands have at most
BAND rows, totals are sums that combine before the shuffle, and the ids that end at a node are packed in sorted ranges before
its digest is streamed over the packs (SHA-256 itself is sequential; a pack holds PACK ids).

Null roles and texts are empty. Turns are ordered by turn (null first), then role, then text; rows that repeat are turns of their
own. Rows without a conv_id belong to no conversation and are left out. Texts of any length are hashed and counted whole. Extra columns
are ignored. An empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import bounded_batches, cut, join_counted

BAND = 8
PACK = 8192
#: Conversations share the first turns of that one of every FAMILY, CHOICES - 1 turns at most.
FAMILY = 20
CHOICES = 4
NAME_HEX = 32


def _name(x: Column) -> Column:
    return F.unhex(F.substring(F.sha2(x, 256), 1, NAME_HEX))


def _number(batches):
    """Rows in order of conv_id, with `at`: how many rows of the conversation lie before, in this partition."""
    now, seen = None, 0
    for batch in batches:
        ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
        if not len(ids):
            continue
        edges = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        at = np.arange(len(ids)) - np.repeat(edges, np.diff(np.append(edges, len(ids))))
        if ids[0] == now:
            at[: edges[1] if len(edges) > 1 else len(ids)] += seen
        now, seen = ids[-1], int(at[-1]) + 1
        yield batch.append_column("at", pa.array(at, pa.int64()))


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, i, term, words) of each turn, i from 1, and (conv_id, n) of each conversation."""
    bounded_batches(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    term = _name(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    turn = F.col("turn").asc_nulls_first()
    dealt = rows.repartitionByRange(F.col("conv_id"), turn, F.col("role"), F.substring("text", 1, 32)).sortWithinPartitions("conv_id", turn, "role", "text")
    # Made after the shuffle: its ranges take a pass over the rows of their own.
    local = dealt.select("conv_id", term.alias("term"), words.alias("words"), F.spark_partition_id().alias("part"))
    local = cut(local.mapInArrow(_number, "conv_id long, term binary, words long, part int, at long"), "turns")
    per = local.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # The conversation at the beginning of a partition is the only one that may go on from others: a row a partition at most.
    crossing = per.withColumn("before", before).filter("before > 0").select("conv_id", "part", "before")
    turns = local.join(F.broadcast(crossing), ["conv_id", "part"], "left").select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0)) + 1).alias("i"), "term", "words")
    return turns, per.groupBy("conv_id").agg(F.sum("n").alias("n"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, d, term, words, last): each conversation's turns after those of its family's first that it takes over; d = 0 is the root, last is true once a conversation."""
    turns, convs = numbered(conversations)
    convs = convs.withColumns({"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % CHOICES, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    known = convs.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(known, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = cut(convs.select("conv_id", "base", "n", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("end")), "conversations")
    own = join_counted(turns, convs.select("conv_id", "n", "h", "m", "end"), "conv_id", "n").filter("i > h").select("conv_id", (F.col("i") - F.col("h") + F.col("m")).alias("d"), "term", "words", "end")
    heads = turns.filter((F.col("i") < CHOICES) & (F.col("conv_id") % FAMILY == 0)).select(F.col("conv_id").alias("base"), F.col("i").alias("d"), "term", "words")
    lead = convs.join(heads, "base").filter("d <= m").select("conv_id", "d", "term", "words", "end")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("d"), _name(F.lit("root")).alias("term"), F.lit(0).cast("long").alias("words"), "end")
    return own.unionByName(lead).unionByName(root).select("conv_id", "d", "term", "words", (F.col("d") == F.col("end")).alias("last"))


def _banded(rows: DataFrame, band: int, *columns: str) -> DataFrame:
    """(conv_id, b, rows): the rows of each band of a conversation in order of d."""
    return rows.groupBy("conv_id", F.expr(f"d div {band}").alias("b")).agg(F.array_sort(F.collect_list(F.struct("d", *columns))).alias("rows"))


def named(turns: DataFrame, deepest: int, band: int = BAND) -> DataFrame:
    """(conv_id, b, rows, ids): ids[k] names the whole sequence up to the band's k-th row."""
    bands = _banded(turns, band, *(c for c in turns.columns if c not in ("conv_id", "d")))
    nothing = F.lit(b"").cast("binary")
    if deepest >= band:
        digest = _name(F.aggregate("rows", nothing, lambda a, x: F.concat(a, x["term"])))
        above = named(bands.select("conv_id", F.col("b").alias("d"), digest.alias("term")), deepest // band, band)
        # The name of all bands up to one is what the next starts from.
        carries = above.select("conv_id", F.posexplode(F.arrays_zip(F.col("rows.d").alias("d"), F.col("ids").alias("id")))).select("conv_id", (F.col("col.d") + 1).alias("b"), F.col("col.id").alias("carry"))
        bands = bands.join(carries, ["conv_id", "b"], "left").withColumn("carry", F.coalesce("carry", nothing))
    else:
        bands = bands.withColumn("carry", nothing)
    chain = F.aggregate("rows", F.array("carry"), lambda a, x: F.concat(a, F.array(_name(F.concat(F.element_at(a, -1), x["term"])))))
    return bands.select("conv_id", "b", "rows", F.slice(chain, 2, band).alias("ids"))


def _with_above(bands: DataFrame) -> DataFrame:
    """bands(conv_id, b, ids, ...) with above: the ids of the conversation's band before, null for the first."""
    return bands.join(bands.select("conv_id", (F.col("b") + 1).alias("b"), F.col("ids").alias("above")), ["conv_id", "b"], "left")


def _lineage(bands: DataFrame, *rest: Column) -> DataFrame:
    """(id, near, above, ...) of each row of bands: near are its ancestors in the band and itself; above, for a band's root, all of the band before."""
    rows = bands.select("*", F.posexplode("ids").alias("k", "id"))
    return rows.select("id", F.slice("ids", F.lit(1), F.col("k") + 1).alias("near"), F.when(F.col("k") == 0, F.col("above")).alias("above"), *rest)


def rolled(nodes: DataFrame, paths: DataFrame, deepest: int, sums: tuple[str, ...], band: int = BAND) -> DataFrame:
    """(id, *sums): over the subtree of each node that has anything to sum. nodes: (id, near, above, *sums); paths: (conv_id, b, ids)."""
    added = lambda rows: rows.groupBy("id").agg(*(F.sum(s).alias(s) for s in sums))
    some = F.lit(False)
    for s in sums:
        some = some | (F.col(s) != 0)
    local = added(nodes.filter(some).select(F.explode("near").alias("id"), *sums))
    if deepest < band:
        return local
    local = cut(local, "band-sums")
    tops = paths.select("conv_id", F.col("b").alias("d"), F.get("ids", 0).alias("id"))
    upper = cut(_with_above(_banded(tops, band, "id").select("conv_id", "b", F.col("rows.id").alias("ids"))), "band-roots")
    lines = _lineage(upper).groupBy("id").agg(F.first("near").alias("near"), F.first("above", ignorenulls=True).alias("above"))
    roots = lines.join(local, "id", "left").select("id", "near", "above", *(F.coalesce(s, F.lit(0)).alias(s) for s in sums))
    totals = rolled(roots, upper, deepest // band, sums, band)
    down = totals.join(nodes.filter("above is not null").select("id", "above"), "id").select(F.explode("above").alias("id"), *sums)
    return cut(added(local.unionByName(down)), "subtree-sums")


def _packed(batches):
    """(id, first, ids): runs of at most PACK sorted conv_ids of a node, joined by commas."""
    for batch in batches:
        ids = batch.column("id").to_pylist()
        convs = batch.column("conv_id").to_pylist()
        out, start = [], 0
        for k in range(1, len(ids) + 1):
            if k == len(ids) or ids[k] != ids[start] or k - start == PACK:
                out.append((ids[start], convs[start], ",".join(map(str, convs[start:k]))))
                start = k
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)], ["id", "first", "ids"])


def _digested(batches):
    """(id, ends_sha256) of packs in order of id and first."""
    now, state = None, None
    for batch in batches:
        out = []
        for node, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if node != now:
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(f",{ids}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out])], ["id", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["id", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): SHA-256 of the sorted, comma-joined conv_ids of ends(id, conv_id)."""
    packs = ends.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(_packed, "id binary, first long, ids string")
    return packs.repartition("id").sortWithinPartitions("id", "first").mapInArrow(_digested, "id binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of turns(conv_id, d, term, words, last), where d is dense from 0, the root, and last marks each conversation's last row:
    node (its name), parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = cut(turns, "rebuilt")
    deepest = turns.agg(F.max("d")).first()[0] or 0
    bands = named(turns, deepest, band).select("conv_id", "b", "ids", F.col("rows.words").alias("words"), F.col("rows.last").alias("last"))
    paths = cut(bands, "named")
    paths = cut(_with_above(paths), "paths") if deepest >= band else paths.withColumn("above", F.lit(None).cast("array<binary>"))
    at = F.col("k").cast("long")
    parent = F.coalesce(F.when(F.col("k") > 0, F.get("ids", F.col("k") - 1)), F.element_at("above", -1))
    rows = _lineage(paths, F.col("conv_id"), (F.col("b") * band + at).alias("d"), F.get("words", F.col("k")).alias("words"), parent.alias("parent"))
    nodes = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), *(F.first(c, ignorenulls=True).alias(c) for c in ("d", "words", "parent", "near", "above")))
    nodes = cut(nodes, "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    known = nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    known = known.withColumns({"n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved_tokens": (F.col("n") - 1) * F.col("words")})
    known = cut(known, "valued")
    totals = rolled(known.select("id", "near", "above", "n_leaves", "saved_tokens"), paths, deepest, ("n_leaves", "saved_tokens"), band)
    ends = ends_digest(paths.select("conv_id", F.explode(F.arrays_zip("ids", "last")).alias("x")).filter("x.last").select(F.col("x.ids").alias("id"), "conv_id"))
    facts = known.select(F.col("id").alias("node"), "parent", "conv_id", F.col("d").alias("depth"), F.col("n").alias("n_convs"), "n_children")
    parents = facts.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("m"))
    below = join_counted(facts.filter("parent is not null"), parents, "parent").drop("m")
    every = below.unionByName(facts.filter("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long")))
    every = every.join(totals.withColumnRenamed("id", "node"), "node", "left").join(ends.withColumnRenamed("id", "node"), "node", "left")
    zero = F.lit(0).cast("long")
    return every.select("node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet"))).drop("node", "parent")


ORACLE = """with recursive t as (select conv_id, coalesce(role, '') role, coalesce(text, '') txt, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) i
    from conversations where conv_id is not null),
digits as (select distinct conv_id, conv_id::varchar s from t),
steps as (select conv_id, flatten(list_transform(range(1, length(s) + 1), lambda k: [ascii(s[k]) + 1, 0, 0, 0, 0, 0, 0, 0, 0]))::bigint[] ops from digits),
hashed as (select conv_id, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, ops), lambda a, x: case when x > 0 then xor(a, x - 1) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) % 4 h from steps),
n as (select conv_id, count(*) n from t group by 1),
c as (select h.conv_id, h.h, h.conv_id - h.conv_id % 20 base, least(h.h, coalesce(b.n, 0)) m from hashed h left join n b on b.conv_id = h.conv_id - h.conv_id % 20),
seq as (select c.conv_id, t.i d, role, txt from c join t on t.conv_id = c.base and t.i <= c.m
    union all select c.conv_id, t.i - c.h + c.m, role, txt from c join t on t.conv_id = c.conv_id and t.i > c.h
    union all select conv_id, 0, '', '' from c),
keyed as (select conv_id, d, case when d = 0 then 0 else len(regexp_extract_all(txt, '[^\\x20\\x09-\\x0D]+')) end words,
    string_agg(sha256(length(role) || ':' || role || txt), ',') over (partition by conv_id order by d) k, d = max(d) over (partition by conv_id) last from seq),
p as (select conv_id, d, words, last, sha256(k) k from keyed),
node as (select k, any_value(d) d, any_value(words) words, count(*) n, min(conv_id) c, string_agg(case when last then conv_id::varchar end, ',' order by conv_id) ends from p group by 1),
up as (select node.*, q.k parent from node left join p q on q.conv_id = node.c and q.d = node.d - 1),
kids as (select parent, count(*) n_children from up where parent is not null group by 1),
val as (select up.*, coalesce(n_children, 0) n_children, case when n_children is null then 1 else 0 end leaf, (n - 1) * words saved from up left join kids on kids.parent = up.k),
sums as (select a.k, sum(val.leaf)::bigint n_leaves, sum(val.saved)::bigint saved_tokens from val join p a on a.conv_id = val.c and a.d <= val.d group by 1)
select val.c conv_id, val.d::bigint "depth", pv.c parent_conv_id, val.n n_convs, val.n_children::bigint n_children, sums.n_leaves, sums.saved_tokens, sha256(coalesce(val.ends, '')) ends_sha256
from val join sums using (k) left join val pv on pv.k = val.parent"""
