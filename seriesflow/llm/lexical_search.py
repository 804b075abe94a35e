"""Ranked lexical search over a document FP-tree: the best documents of each item of a query set.

Each document becomes a vector: its terms that any item has, with their counts, ordered by document frequency, the most frequent first.
A task builds trees of the vectors it has, TREE_ENTRIES entries at a time: vectors with the same first terms share a path. A node's interval
of documents has the largest count of each term below it (tf maxima) and the smallest length factor (m minimum); as a score grows with tf
and falls with m, they bound every score below the node. For each item a tree is searched depth first, the best child first, and a node is
left out if its bound doesn't reach the item's K-th best so far (or reaches it with larger ids only). Nodes of up to LEAF documents are
scored as a whole. The K best of an item go on from tree to tree of a task, and are merged over all tasks, K rows of each.

Document frequencies, the number of documents and their length count all documents. Vectors that agree in full have equal scores, so
of those a tree keeps the K smallest ids. Items are taken in blocks of BLOCK_CHARS, one broadcast at a time, and every block is searched in all
documents. Scores are integers, without rounding anywhere else than in div.

Null texts have no terms. Texts of any length are split in pieces of PIECE bytes that end where terms end. Rows that repeat are ranked
each for itself; a null doc_id is ranked after others of its score; items with the same item_id are ranked each for itself. Items or documents without terms
give no rows, and so do empty tables. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import bounded_batches, cut, documents, text_chunks

K = 10
BLOCK_CHARS = 4_000_000
TREE_ENTRIES = 1 << 20
LEAF = 64
PIECE = 1 << 20
#: Fixed values of the score.
SCALE, COUNT, LENGTH, SHARE = 1_000_000_000, 1000, 8, 75
NO_ID = 1 << 63
#: ASCII characters that are no letters or digits end terms; A-Z are lower-cased.
FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))


def terms_of(folded: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a folded text, piece by piece."""
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + piece)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def vectors(docs: DataFrame, shared: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, codes, tfs) of each document with a term: how many terms, and which of the given ones (term: code) how often."""
    bounded_batches(docs.sparkSession)

    def count(batches):
        get = shared.value.get
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at, _, data, offs in text_chunks(batch, "text"):
                folded = data.tobytes().translate(FOLD)
                out = []
                for k, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
                    found, n = Counter(), 0
                    for terms in terms_of(folded[a:b]):
                        n += len(terms)
                        found.update(map(get, terms))
                    found.pop(None, None)
                    if n:
                        out.append((ids[at + k], n, list(found), list(found.values())))
                if out:
                    kinds = pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n", "codes", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, codes array<int>, tfs array<int>")


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of runs, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Tree:
    """A trie of vectors; arrays over its nodes, its documents in order of their paths, and their entries."""

    def __init__(self, ids: list[int | None], m: np.ndarray, ranks: np.ndarray, tfs: np.ndarray, ptr: np.ndarray, k: int):
        sizes = np.diff(ptr)
        order = np.lexsort((ranks, np.repeat(np.arange(len(sizes)), sizes)))
        ranks, tfs = ranks[order], tfs[order]
        path, count = ranks.astype(">u4").tobytes(), tfs.astype(">u4").tobytes()
        keys = [(path[4 * a : 4 * b], count[4 * a : 4 * b], x, NO_ID if i is None else i) for a, b, x, i in zip(ptr[:-1].tolist(), ptr[1:].tolist(), m.tolist(), ids, strict=True)]
        kept, same = [], 0
        last = None
        for d in sorted(range(len(keys)), key=keys.__getitem__):
            same = same + 1 if keys[d][:3] == last else 0
            last = keys[d][:3]
            if same < k:
                kept.append(d)
        of = np.array(kept, np.int64)
        at = _gather(ptr[:-1][of], sizes[of])
        self.ids = [keys[d][3] for d in kept]
        self.m, self.ranks, self.tfs = m[of], ranks[at], tfs[at].astype(np.int64)
        self.ptr = np.append(0, np.cumsum(sizes[of]))
        self.value = SCALE * self.tfs // (COUNT * self.tfs + LENGTH * np.repeat(self.m, sizes[of]))
        self._split()
        self._bound()

    def _split(self) -> None:
        """lo, hi: the documents of each node; child, children: its first child and how many it has; parent."""
        sizes = np.diff(self.ptr)
        lo, hi, child, children, parent = [np.array([0])], [np.array([len(sizes)])], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.array([-1])]
        made = 1
        node, begin, end, depth = np.array([0]), lo[0], hi[0], np.zeros(1, np.int64)
        first, many = {}, {}
        while True:
            wide = end - begin > LEAF
            node, begin, end, depth = node[wide], begin[wide], end[wide], depth[wide]
            if not len(node):
                break
            width = end - begin
            docs, deep = _gather(begin, width), np.repeat(depth, width)
            # Documents that end at the node come before those that go on.
            step = np.where(sizes[docs] > deep, self.ranks[np.minimum(self.ptr[docs] + deep, len(self.ranks) - 1)], -1)
            heads = np.cumsum(width) - width
            edge = np.append(True, step[1:] != step[:-1])
            edge[heads] = True
            cuts = np.flatnonzero(edge)
            groups = np.add.reduceat(edge, heads)
            one = groups == 1
            # A node whose documents all take the same step is the same node, a step further; if all end, it is whole.
            on = one & (step[heads] >= 0)
            stay = (node[on], begin[on], end[on], depth[on] + 1)
            owner = np.repeat(np.arange(len(node)), groups)
            fresh = ~one[owner]
            starts = docs[cuts][fresh]
            stops = (docs[np.append(cuts[1:], len(docs)) - 1] + 1)[fresh]
            mine = owner[fresh]
            new = made + np.arange(len(starts))
            made += len(starts)
            lo.append(starts)
            hi.append(stops)
            parent.append(node[mine])
            split = np.flatnonzero(~one)
            if len(split):
                firsts = np.searchsorted(mine, split)
                for n, f, g in zip(node[split].tolist(), new[firsts].tolist(), groups[split].tolist(), strict=True):
                    first[n], many[n] = f, g
            going = step[cuts][fresh] >= 0
            node, begin, end, depth = (np.concatenate(x) for x in zip(stay, (new[going], starts[going], stops[going], depth[mine][going] + 1), strict=True))
        self.lo, self.hi, self.parent = np.concatenate(lo), np.concatenate(hi), np.concatenate(parent)
        self.child, self.children = np.zeros(made, np.int64), np.zeros(made, np.int64)
        self.child[list(first)], self.children[list(many)] = list(first.values()), list(many.values())

    def _bound(self) -> None:
        """By rank: the nodes that have it below them, and the most that it can add to a score there for each unit of weight. Also each node's smallest id."""
        ends = np.flatnonzero(self.children == 0)
        ends = ends[np.argsort(self.lo[ends])]
        top = int(self.ranks.max()) + 1
        m = np.full(len(self.lo), np.iinfo(np.int64).max)
        ids = np.array([min(i, np.iinfo(np.int64).max) for i in self.ids], np.int64)
        low = np.full(len(self.lo), np.iinfo(np.int64).max)
        m[ends], low[ends] = np.minimum.reduceat(self.m, self.lo[ends]), np.minimum.reduceat(ids, self.lo[ends])
        owner = np.repeat(ends, self.ptr[self.hi[ends]] - self.ptr[self.lo[ends]])

        def most(nodes, ranks, tfs):
            order = np.lexsort((ranks, nodes))
            key = (nodes * top + ranks)[order]
            heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            return nodes[order][heads], ranks[order][heads], np.maximum.reduceat(tfs[order], heads)

        found = [most(owner, self.ranks.astype(np.int64), self.tfs)]
        # Nodes are made level by level, so those of a higher number never lie above one of a lower: from the last on, each level goes to its parents.
        level = np.zeros(len(self.lo), np.int64)
        for n in range(1, len(self.lo)):
            level[n] = level[self.parent[n]] + 1
        waiting = found[0]
        for depth in range(int(level.max()), 0, -1):
            here = np.flatnonzero(level == depth)
            np.minimum.at(m, self.parent[here], m[here])
            np.minimum.at(low, self.parent[here], low[here])
            mine = level[waiting[0]] == depth
            up = most(self.parent[waiting[0][mine]], waiting[1][mine], waiting[2][mine])
            found.append(up)
            waiting = tuple(np.concatenate(x) for x in zip((w[~mine] for w in waiting), up, strict=True))
        nodes, ranks, tfs = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(ranks, kind="stable")
        self.nodes, tfs = nodes[order], tfs[order]
        self.most = SCALE * tfs // (COUNT * tfs + LENGTH * m[self.nodes])
        self.of_rank = np.searchsorted(ranks[order], np.arange(top + 1))
        self.low = low.tolist()
        self.links = list(zip(self.child.tolist(), self.children.tolist(), self.lo.tolist(), self.hi.tolist(), strict=True))

    def search(self, item: list[tuple[int, int]], weights: np.ndarray, best: list[tuple[int, int]], k: int) -> None:
        """Adds to best, a heap of (score, -id), the documents that belong to an item's k best. item: (rank, weight); weights: zeros over ranks."""
        bound = np.zeros(len(self.lo), np.int64)
        for rank, w in item:
            if rank < len(self.of_rank) - 1:
                part = slice(self.of_rank[rank], self.of_rank[rank + 1])
                bound[self.nodes[part]] += w * self.most[part]
            weights[rank] = w
        stack = [(int(bound[0]), 0)]
        while stack:
            limit, node = stack.pop()
            if not limit or len(best) == k and (limit, -self.low[node]) < best[0]:
                continue
            child, children, lo, hi = self.links[node]
            if children:
                below = bound[child : child + children]
                stack += [(int(below[c]), child + c) for c in np.argsort(below, kind="stable").tolist() if below[c]]
                continue
            begin, end = self.ptr[lo], self.ptr[hi]
            scores = np.add.reduceat(weights[self.ranks[begin:end]] * self.value[begin:end], self.ptr[lo:hi] - begin)
            for d in np.flatnonzero(scores >= (best[0][0] if len(best) == k else 1)).tolist():
                now = (int(scores[d]), -self.ids[lo + d])
                if len(best) < k:
                    heapq.heappush(best, now)
                elif now > best[0]:
                    heapq.heapreplace(best, now)
        for rank, _ in item:
            weights[rank] = 0


def ranked(vecs: DataFrame, shared: Broadcast, n: int, length: int, k: int = K, entries: int = TREE_ENTRIES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of each item. shared: the rank of each code, and (item_id, [(rank, weight)]) of each item; n documents with `length` terms in all."""

    def search(batches):
        rank, items = shared.value
        best = [[] for _ in items]
        weights = np.zeros(len(rank), np.int64)

        def flush(parts):
            ids, m, codes, tfs, sizes = ([x for p in parts for x in p[0]], *(np.concatenate([p[c] for p in parts]) for c in range(1, 5)))
            tree = Tree(ids, m, rank[codes].astype(np.int64), tfs, np.append(0, np.cumsum(sizes)), k)
            for of, (_, item) in zip(best, items, strict=True):
                tree.search(item, weights, of, k)

        parts, held = [], 0
        for batch in batches:
            codes, tfs = batch.column("codes"), batch.column("tfs")
            sizes = np.diff(codes.offsets.to_numpy())
            lengths = batch.column("n").to_pylist()
            m = np.array([100 - SHARE + SHARE * x * n // length for x in lengths], np.int64)
            parts.append((batch.column("doc_id").to_pylist(), m, codes.flatten().to_numpy(), tfs.flatten().to_numpy(), sizes))
            held += len(parts[-1][2])
            if held >= entries:
                flush(parts)
                parts, held = [], 0
        if held:
            flush(parts)
        out = [(no, item_id, None if -i == NO_ID else -i, score) for no, ((item_id, _), of) in enumerate(zip(items, best, strict=True)) for score, i in of]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["no", "item_id", "doc_id", "score"])

    found = vecs.filter(F.size("codes") > 0).select("doc_id", "n", "codes", "tfs").mapInArrow(search, "no long, item_id long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _blocks(items: DataFrame, chars: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    block, held = [], 0
    for r in items.toLocalIterator():
        terms = [t for part in terms_of((r.text or "").encode().translate(FOLD)) for t in part]
        if not terms:
            continue
        if block and held + len(r.text) > chars:
            yield block
            block, held = [], 0
        block.append((r.item_id, terms))
        held += len(r.text)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, entries: int = TREE_ENTRIES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest score above 0 of each of items(item_id, text)."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in _blocks(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")), block_chars):
        codes = {t: c for c, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        shared = spark.sparkContext.broadcast(codes)
        vecs = cut(vectors(docs, shared, id_col, text_col), "vectors")
        shared.destroy()
        n, length = vecs.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n:
            break
        df = np.zeros(len(codes), np.int64)
        # A row for each term of the block at most.
        for r in vecs.select(F.explode("codes").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect():
            df[r.c] = r.n
        rank = np.empty(len(codes), np.int64)
        rank[np.argsort(-df, kind="stable")] = np.arange(len(codes))
        weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()]
        wanted = [(i, [(int(rank[codes[t]]), weight[codes[t]] * times) for t, times in Counter(terms).items()]) for i, terms in block]
        shared = spark.sparkContext.broadcast((rank, wanted))
        out = out.unionByName(cut(ranked(vecs, shared, n, length, k, entries), "ranked"))
        shared.destroy()
    return out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""with d as (select row_number() over () r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w from documents),
i as (select row_number() over () q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w from benchmark),
all_of as (select count(*) n, sum(len(w))::bigint l from d where len(w) > 0),
wanted as (select q, term, count(*) times from (select q, unnest(w) term from i) group by all),
tf as (select r, term, count(*) tf from (select r, unnest(w) term from d) where term in (select term from wanted) group by all),
df as (select term, count(*) df from tf group by 1),
weight as (select term, floor(1000 * ln((2 * n + 2)::double / (2 * df + 1)))::bigint w from df, all_of),
size as (select r, doc_id, 25 + (75 * len(w) * n) // l m from d, all_of where len(w) > 0),
scored as (select q, doc_id, r, sum(times * weight.w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint score from wanted join weight using (term) join tf using (term) join size using (r) group by all),
placed as (select *, row_number() over (partition by q order by score desc, doc_id nulls last) rank from scored where score > 0)
select item_id, rank::int rank, doc_id, score from placed join i using (q) where rank <= 10"""
