"""Similarity join on word shingles: T-occurrence search with DivideSkip, and the classes that links form.

Two documents link when their sets of shingles have a Jaccard similarity of at least num / den. Of the n inverted lists of
a document, a partner with the needed overlap T occurs in at least one of the n - T + 1 shortest.

1. A pass over all documents counts shingles and tells which are frequent; it gives the order of lists by length. (Any
   order gives right results; a good one gives short lists.)
2. Documents with identical sets are one class, which goes on as its smallest id.
3. The short lists deal documents to blocks. Each list first proposes a member of each class of set sizes as a query against the class's other members,
   so thousands of near copies cost a search each, not all pairs. Lists that then still hold several components propose the pairs
   between different components, within neighbouring classes of set sizes. A pair has to pass the bounds by size, by position, and by
   a vector of counts of shingles by hash (about one count for four shingles): what two vectors differ by is a lower bound of what
   the sets differ by.
4. A block is a query and sets to search: these are indexed as inverted lists, and DivideSkip finds the sets that occur in T of
   the query's lists. The L longest lists are set apart, L being where merging and probing cost least. The others are merged; a set
   that occurs in T - L of them is looked up by binary search in each of the L long ones, and is retained if it reaches T.

Nothing is capped: a list of any length is dealt out, and one that holds a large share of all rows stays where it is and meets what
it joins by a broadcast of such lists' heads, of which there are few.

Null and empty texts, and texts of white space, have an empty set and link with nothing. Rows that repeat an id are
different texts of one document. Rows without an id are one document whose id sorts last. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import cut, documents, join_counted, mix64, shingles, text_chunks, words

SLOT_BITS = 20
#: A set's vector has a power of two of counts, at least a quarter of its size, within these bounds.
LEAST_COUNTS, MOST_COUNTS = 32, 1 << 16
NO_ID = (1 << 63) - 1
#: Up to so many ids (of 8 bytes) a table of ids is broadcast; a larger one is joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Shingles of a block of sets that are searched together, about.
BLOCK_ITEMS = 50_000


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _sets(batch: pa.RecordBatch, size: int):
    """(row, sorted different shingles) of each text with any."""
    for start, end, data, offs in text_chunks(batch, "text"):
        hashes, _, _, first = words(data, offs)
        every, at = shingles(hashes, first, size)
        for k in range(end - start):
            if at[k] < at[k + 1]:
                yield start + k, np.unique(every[at[k] : at[k + 1]])


def _counts(mixed: np.ndarray) -> bytes:
    """How many of a set's shingles have each of the possible top bits of their hash, up to 255."""
    bits = (max(LEAST_COUNTS, min(MOST_COUNTS, len(mixed) // 4)) - 1).bit_length()
    found = np.bincount((mixed >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(found, 255).astype(np.uint8).tobytes()


def _difference(x: bytes, y: bytes) -> int:
    """A lower bound of how many shingles are in one set only."""
    a, b = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    if len(a) != len(b):
        # Counts that reached 255 are unknown beyond it; such a place tells nothing.
        large, small = (a, b) if len(a) > len(b) else (b, a)
        step = len(large) // len(small)
        capped = (large == 255).reshape(-1, step).any(axis=1) | (small == 255)
        return int(np.abs(large.reshape(-1, step).sum(axis=1) - small)[~capped].sum())
    return int(np.abs(a - b).sum())


def frequent_slots(docs: DataFrame, size: int) -> np.ndarray:
    """Document frequency by slot of a table of 2^20 slots, 0 where no task sees more than chance. A table of fixed size."""

    def count(batches):
        table = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for _, s in _sets(batch, size):
                np.add.at(table, _slots(s), 1)
        mean = table.mean()
        high = np.flatnonzero(table >= mean + 4 * np.sqrt(mean) + 6)
        yield pa.RecordBatch.from_arrays([pa.array(high, pa.int64()), pa.array(table[high], pa.int64())], ["slot", "n"])

    rows = docs.select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << SLOT_BITS, np.int64)
    found = rows.toPandas()
    out[found["slot"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return np.minimum(out, 65535).astype(np.uint16)


def profiles(docs: DataFrame, size: int, num: int, den: int, slots: np.ndarray) -> DataFrame:
    """(id, n, k1, k2, prefix, counts) of every document; k1 and k2 identify the set, prefix has the shingles of the shortest lists in order."""
    table = docs.sparkSession.sparkContext.broadcast(slots)
    out = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("prefix", pa.list_(pa.int64())), ("counts", pa.binary())])

    def profile(batches):
        freq = table.value
        for batch in batches:
            rows = batch.num_rows
            n, k1, k2 = np.zeros(rows, np.int64), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            lengths, prefixes, counts = np.zeros(rows + 1, np.int64), [], [b""] * rows
            for k, s in _sets(batch, size):
                n[k] = len(s)
                mixed = mix64(s)
                k1[k], k2[k] = s.sum(dtype=np.uint64), mixed.sum(dtype=np.uint64)
                short = len(s) - (num * len(s) + den - 1) // den + 1
                order = np.argsort(freq[_slots(s)], kind="stable")[:short]
                prefixes.append(s[order])
                lengths[k + 1] = short
                counts[k] = _counts(mixed)
            flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64)
            prefix = pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), prefix, pa.array(counts, pa.binary())], schema=out)

    return docs.mapInArrow(profile, "id long, n long, k1 long, k2 long, prefix array<long>, counts binary")


def _may_link(na: str, pa_: str, nb: str, pb: str, num: int, den: int) -> Column:
    """Bounds by size and by the positions of a first common shingle."""
    least = f"least({na} - {pa_}, {nb} - {pb})"
    return F.expr(f"{den} * least({na}, {nb}) >= {num} * greatest({na}, {nb}) and {num + den} * {least} >= {num} * ({na} + {nb})")


def _near(pairs: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose vectors of counts allow the needed overlap."""
    side = reps.select("id", "n", "counts")
    both = pairs.join(side.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca")), "a")
    both = both.join(side.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb")), "b")

    def filtered(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            differ = np.fromiter((_difference(x, y) for x, y in zip(batch.column("ca").to_pylist(), batch.column("cb").to_pylist(), strict=True)), np.int64, batch.num_rows)
            # Overlap is at most (na + nb - differ) / 2.
            keep = pa.array((num + den) * (na + nb - differ) >= 2 * num * (na + nb))
            yield batch.select(["a", "b"]).filter(keep)

    return both.select("a", "b", "na", "nb", "ca", "cb").mapInArrow(filtered, "a long, b long").distinct()


def _few(ids: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if it is small enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _sets_of(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(id, items) of the documents of pairs: their sorted shingles."""
    ids = cut(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ids")

    def gather(batches):
        for batch in batches:
            keep, lengths, parts = [], [0], []
            for k, s in _sets(batch, size):
                keep.append(k)
                parts.append(s.view(np.int64))
                lengths.append(len(s))
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(keep, pa.int64())), pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(flat))], ["id", "items"])

    return cut(docs.join(_few(ids), "id", "left_semi").mapInArrow(gather, "id long, items array<long>"), "sets")


def _blocks(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(c, block, a, b): pairs by their first document c, those of a document with many dealt out to blocks of bounded size by b."""
    sizes = sets.groupBy(F.col("id").alias("b")).agg(F.max(F.size("items")).alias("n"))
    many = pairs.join(sizes, "b").groupBy("a").agg((F.expr(f"sum(n) div {BLOCK_ITEMS}") + 1).alias("blocks"), F.count(F.lit(1)).alias("m")).filter("blocks > 1")
    many = cut(many, "large")
    few = pairs.join(F.broadcast(many) if many.count() <= BROADCAST_IDS else many, "a", "left")
    return few.select(F.col("a").alias("c"), F.pmod(F.xxhash64("b"), F.coalesce("blocks", F.lit(1))).alias("block"), "a", "b")


class Lists:
    """Inverted lists of a block's sets: for each shingle the sets that have it, in order."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        items = np.concatenate(sets)
        order = np.argsort(items, kind="stable")
        self.members = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.items, begins = np.unique(items[order], return_index=True)
        self.begins = np.append(begins, len(items))

    def reaching(self, query: np.ndarray, num: int, den: int) -> np.ndarray:
        """The sets whose overlap with the query is large enough, by DivideSkip."""
        needed = -(-num * (len(query) + self.sizes) // (num + den))
        at = np.searchsorted(self.items, query)
        at[at == len(self.items)] = 0
        at = at[self.items[at] == query]
        lengths = self.begins[at + 1] - self.begins[at]
        by = np.argsort(-lengths, kind="stable")
        at, lengths = at[by], lengths[by]
        n_long = self._long(lengths, int(needed.min()))
        short = at[n_long:]
        # Lists laid end to end are merged by one sort; a run is a set, its length the number of its lists.
        found, occurs = np.unique(self.members[_ranges(self.begins[short], lengths[n_long:])], return_counts=True)
        if n_long:
            # Sets of no short list stay out: more than n_long occurrences are needed.
            near = occurs >= needed[found] - n_long
            found, occurs = found[near], occurs[near]
            for k in range(n_long):
                one = self.members[self.begins[at[k]] : self.begins[at[k]] + lengths[k]]
                place = np.searchsorted(one, found)
                place[place == len(one)] = 0
                occurs = occurs + (one[place] == found)
                # What can't reach its threshold any more isn't looked up again.
                left = occurs + (n_long - 1 - k) >= needed[found]
                found, occurs = found[left], occurs[left]
                if not len(found):
                    break
        return found[occurs >= needed[found]]

    def _long(self, lengths: np.ndarray, needed: int) -> int:
        """How many of the longest lists to probe: less than needed, and where merging the others and probing these cost least."""
        most = min(len(lengths), needed - 1)
        if most <= 0:
            return 0
        n = np.arange(most + 1)
        merged = lengths.sum() - np.append(0, np.cumsum(lengths[:most]))
        candidates = np.minimum(merged / (needed - n), len(self.sizes))
        # A probe of a list by itself costs a call, as much as some hundred entries of a merge.
        cost = merged * np.log2(merged + 2) + n * (candidates * np.log2(lengths[0] + 1) + 100)
        return int(cost.argmin())


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of begins[k] .. begins[k] + lengths[k], one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - lengths), lengths)


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs with the needed overlap.

    A block has its query's sets first (several if the query's id has several texts), then those to search, each once."""
    blocks = cut(_blocks(pairs, sets), "blocks")
    rows = blocks.select("c", "block", F.lit(0).alias("kind"), F.col("a").alias("id")).distinct().unionByName(blocks.select("c", "block", F.lit(1).alias("kind"), F.col("b").alias("id")).distinct())
    rows = rows.join(sets, "id")

    def search(batches):
        now, queries, ids, members = None, [], [], []

        def found():
            if not queries or not members:
                return np.zeros(0, np.int64)
            lists = Lists(members)
            hits = np.unique(np.concatenate([lists.reaching(q, num, den) for q in queries]))
            return np.unique(np.array(ids, np.int64)[hits])

        for batch in batches:
            items = batch.column("items")
            offs, values = items.offsets.to_numpy(), items.values.to_numpy(zero_copy_only=False).view(np.uint64)
            c, block, kind, of = (batch.column(n).to_numpy() for n in ("c", "block", "kind", "id"))
            out = []
            for k in range(batch.num_rows):
                if (c[k], block[k]) != now:
                    if now is not None:
                        out.append((now[0], found()))
                    now, queries, ids, members = (c[k], block[k]), [], [], []
                one = values[offs[k] : offs[k + 1]].copy()
                if kind[k] == 0:
                    queries.append(one)
                else:
                    ids.append(of[k])
                    members.append(one)
            yield linked(out)
        if now is not None:
            yield linked([(now[0], found())])

    def linked(out):
        a = np.repeat(np.array([x[0] for x in out], np.int64), [len(x[1]) for x in out]) if out else np.zeros(0, np.int64)
        b = np.concatenate([x[1] for x in out]) if out else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("c", "block", "kind", "id", "items").repartition(parts, "c", "block").sortWithinPartitions("c", "block", "kind", "id")
    return cut(dealt.mapInArrow(search, "a long, b long"), "links")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable by links, itself included).

    Words are runs without white space, with A-Z lower-cased; a link needs den * intersection >= num * union."""
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    every = cut(profiles(docs, size, num, den, frequent_slots(docs, size)), "profiles")
    full = every.filter("n > 0")
    same = cut(full.groupBy("k1", "k2", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    copies = full.select("id", "k1", "k2", "n").join(same.filter("copies > 1"), ["k1", "k2", "n"]).filter("id <> rep").select("id").distinct()
    # An id that repeats may stand for a class of its own as well.
    copies = cut(copies.join(same.select(F.col("rep").alias("id")), "id", "left_anti"), "copies")
    reps = full.select("id", "n", "prefix", "counts").join(_few(copies), "id", "left_anti")
    # Sets that link have sizes of the same class or of neighbouring ones: classes are wider than the ratio that a link allows.
    kind = F.floor(F.log("n") / float(np.log(1.001 * den / num))).cast("int")
    lists = reps.select("id", "n", kind.alias("kind"), F.posexplode("prefix").alias("pos", "h"))
    # The queries that a list proposes, one for each class of sizes: the member in whose order the list comes first. Fewest of its shingles are rarer, so of near copies it is the one that changed least.
    hub = F.min(F.struct("pos", "id", "n")).alias("hub")
    heads = lists.groupBy("h", "kind").agg(hub, F.count(F.lit(1)).alias("same"))
    # A list has a row for each of its classes, few whatever its length; most lists have one member and go.
    heads = heads.groupBy("h").agg(F.sum("same").alias("m"), F.collect_list(F.struct("kind", "hub", "same")).alias("classes")).filter("m > 1")
    heads = cut(heads.select("h", "m", F.inline("classes")), "heads")
    told = ("h", "kind", "id", "n", "pos", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.pos").alias("hub_pos"), "same", "m")
    merged = cut(join_counted(lists, heads, ["h", "kind"], "same").select(*told), "merged")
    small = reps.select("id", "n", "counts")
    stars = merged.filter("id <> hub").filter(_may_link("n", "pos", "hub_n", "hub_pos", num, den)).select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    stars = cut(_near(stars, small, num, den), "stars")
    sets = _sets_of(stars, docs, size)
    links = _verified(stars, sets, num, den)
    first = components(links)
    # Two members of one class have met already.
    named = cut(merged.filter("m > 2 or same < m").join(first.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("c", F.coalesce("component", "id")), "named")
    several = cut(named.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("rows")).filter("lo < hi").select("h", "rows"), "several")
    rest = cut(join_counted(named.select("h", "kind", "id", "n", "pos", "c", (F.col("id") == F.col("hub")).alias("was")), several, "h", "rows"), "rest")
    x = rest.select("h", F.explode(F.array(*(F.col("kind") + k for k in (-1, 0, 1)))).alias("kind"), F.col("kind").alias("ka"), F.col("was").alias("was_a"), F.col("id").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("c").alias("ca"))
    y = rest.select("h", "kind", F.col("was").alias("was_b"), F.col("id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("c").alias("cb"))
    pairs = x.join(y, (x["h"] == y["h"]) & (x["kind"] == y["kind"]) & ~((x["ka"] == y["kind"]) & (x["was_a"] | y["was_b"])) & (x["a"] < y["b"]) & (x["ca"] != y["cb"]) & _may_link("na", "pa", "nb", "pb", num, den)).select("a", "b").distinct()
    pairs = cut(_near(pairs, small, num, den), "pairs")
    more = pairs if pairs.isEmpty() else _verified(pairs, _sets_of(pairs, docs, size), num, den)
    # An id with several texts belongs to the classes of all of them.
    repeated = full.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("id")
    own = full.join(repeated, "id", "left_semi").join(same, ["k1", "k2", "n"]).select(F.col("rep").alias("a"), F.col("id").alias("b"))
    # The second links connect components of the first ones: each end is replaced by its component.
    extra = cut(more.unionByName(own), "extra")
    to = lambda side: first.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
    lifted = extra.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    second = components(lifted).select(F.col("node").alias("c"), F.col("component").alias("second"))
    member = same.join(first.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("c", F.coalesce("component", "rep")).drop("component")
    member = member.join(second, "c", "left").withColumn("component", F.coalesce("second", "c"))
    found = full.select("id", "n", "k1", "k2").join(cut(member.select("k1", "k2", "n", "component"), "members"), ["k1", "k2", "n"]).select("id", "n", "component")
    out = found.unionByName(every.filter("n = 0").select("id", "n", F.col("id").alias("component")))
    blank = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(blank("id").alias(id_col), F.col("n").alias("n_shingles"), blank("component").alias("component_id"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir), size=3, num=90, den=100)
