"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A text region within k edits of a benchmark item of m characters shares at least m - q + 1 - k q of the item's q-grams with
it, all on diagonals (position in the text less position in the item) that differ by at most k. Shared q-grams are counted in bands of
diagonals, each overlapping the next by half, so that every such region lies in one band; bands that reach the bound are
aligned with the item in a band of edit-distance cells, and those within the budget of edits are leaks.

Characters (code points) are compared after A-Z are lower-cased and each run of white space has become one space. The budget is `rate` of the item's length, but never so much that the bound falls below one shared q-gram; items
shorter than q leak where a text has them exactly. Items without any visible character match nothing.

Items are a stated query set: they go to the tasks in blocks of bounded size, and each block meets all documents. Shared q-grams are
counted in parts of bounded size, and long texts in overlapping slices, so that a q-gram of many items or a long text costs time, not memory. Null and empty texts
have no leaks. Of items that repeat an id the least edits count. Rows that repeat are judged each by itself. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import _IS_SPACE, _LOWER, documents, text_chunks

Q = 12
RATE = 0.06
#: Characters of items that go to the tasks at a time.
BLOCK_CHARS = 4_000_000
SLOT_BITS = 22
#: Pairs of a q-gram in a text and in an item that are counted at a time.
PART = 4_000_000
#: Characters of a text that are searched at a time.
SLICE = 4_000_000
_NO_CHARACTER = 0x110000


@dataclass
class Items:
    """A block of items, as index of their q-grams."""

    ids: np.ndarray
    texts: list[np.ndarray]
    budgets: np.ndarray
    needed: np.ndarray
    keys: np.ndarray
    begins: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    short: list[int]


def _normal(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points, and each text's place in them, of UTF-8 bytes after lower-casing and merging of white space."""
    space = _IS_SPACE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    inner = offs[:-1][offs[:-1] < len(data)]
    keep[inner] = True
    out = np.where(space, np.uint8(32), _LOWER[data])[keep]
    begins = keep & ((data & 0xC0) != 0x80)
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(begins, out=total[1:])
    return np.frombuffer(out.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), total[offs]


_BASE = 0x9E3779B97F4A7C15


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the q-gram that begins at each character, for all but the last Q - 1."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    power = lambda n: np.uint64(pow(_BASE, n, 1 << 64))
    x = data.astype(np.uint64)
    two = x[:-1] * power(1) + x[1:]
    four = two[:-2] * power(2) + two[2:]
    eight = four[:-4] * power(4) + four[4:]
    n = len(data) - Q + 1
    return (eight[:n] * power(4) + four[8 : 8 + n]) * np.uint64(0xC2B2AE3D27D4EB4F)


def _text(data: np.ndarray) -> str:
    return data.tobytes().decode("utf-32-le")


def index_items(ids: list[int], texts: list[str], rate: float = RATE) -> Items:
    clean = []
    for t in texts:
        raw = np.frombuffer((t or "").encode("utf-8", "replace"), np.uint8)
        body = _normal(raw, np.array([0, len(raw)]))[0]
        clean.append(np.frombuffer(_text(body).strip(" ").encode("utf-32-le"), np.uint32))
    size = np.array([len(c) for c in clean], np.int64)
    budgets = np.maximum(np.minimum((rate * size).astype(np.int64), (size - Q) // Q), 0)
    needed = np.maximum(size - Q + 1 - budgets * Q, 1)
    grams = [_grams(c) for c in clean]
    every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(clean)), [len(g) for g in grams])
    offset = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
    order = np.argsort(every, kind="stable")
    keys, begins = np.unique(every[order], return_index=True)
    return Items(np.array(ids, np.int64), clean, budgets, needed, keys, np.append(begins, len(every)), item[order], offset[order], [k for k, n in enumerate(size) if 0 < n < Q])


def banded_edits(item: np.ndarray, text: np.ndarray, first: int, width: int, budget: int) -> int:
    """Least number of edits that turn the item into some part of text, or budget + 1 if there are more.

    Only cells whose diagonal (place in text less place in item) is in first .. first + width are looked at."""
    inf = budget + 1
    band = np.arange(width + 1)
    row = np.where((first + band >= 0) & (first + band <= len(text)), 0, inf)
    padded = np.full(len(item) + len(text) + 2 * width + abs(first) + 4, _NO_CHARACTER, np.int64)
    shift = abs(first) + width + 1
    padded[shift : shift + len(text)] = text
    for i, c in enumerate(item, 1):
        # Cell d of row i is at place first + d + i of the text; its last character is the one before.
        at = first + band + i
        own = padded[shift + at[0] - 1 : shift + at[-1]] if shift + at[0] - 1 >= 0 else None
        inside = (at >= 0) & (at <= len(text))
        new = np.where((at >= 1) & inside, row + (own != c), inf)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new = np.where(inside, new, inf)
        row = np.minimum(np.minimum.accumulate(new - band) + band, inf)
        row = np.where(inside, row, inf)
        if row.min() >= inf:
            return inf
    return int(row.min())


def _bands(block: Items, hits: np.ndarray, at: np.ndarray, row: np.ndarray, place: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, band) with enough shared q-grams; hits[k] is where the text `row[k]`, at its `place[k]`, has the q-gram keys[at[k]]."""
    n_items = len(block.texts)
    half = block.budgets + 1
    width = int((int(place.max()) + longest) // int(half.min())) + 3 if len(place) else 1
    total = int((block.begins[at + 1] - block.begins[at]).sum())
    # A q-gram's entries are in order of items: a range of items is a part of each.
    ranges = -(-total // (8 * PART)) or 1
    entry_gram = np.repeat(np.arange(len(block.keys)), np.diff(block.begins)) if ranges > 1 else None
    rows, items, bands = [], [], []
    for r in range(ranges):
        if ranges == 1:
            low, high = block.begins[at], block.begins[at + 1]
        else:
            code = entry_gram * n_items + block.item
            low, high = (np.searchsorted(code, at * n_items + n_items * x // ranges) for x in (r, r + 1))
        each = high - low
        sums = np.cumsum(each)
        code, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        begin = 0
        while begin < len(at):
            done = int(sums[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(sums, done + PART, "right")))
            part = slice(begin, end)
            spread = np.repeat(np.arange(begin, end), each[part])
            entry = np.repeat(low[part], each[part]) + np.arange(len(spread)) - np.repeat(sums[part] - each[part] - done, each[part])
            item = block.item[entry]
            # Counting from the least diagonal there can be keeps band numbers positive.
            band = (place[spread] - block.offset[entry] + longest) // half[item]
            # Each half belongs to two bands: its own and the next.
            new = (row[spread].astype(np.int64) * n_items + item) * width + band
            code = np.concatenate([code, new, new + 1])
            code, which = np.unique(code, return_inverse=True)
            count = np.bincount(which, np.concatenate([count, np.ones(2 * len(new), np.int64)]), len(code)).astype(np.int64)
            begin = end
        item = code // width % n_items
        good = count >= block.needed[item]
        rows.append(code[good] // width // n_items)
        items.append(item[good])
        bands.append(code[good] % width)
    return np.concatenate(rows), np.concatenate(items), np.concatenate(bands)


def _search(block: Items, marked: np.ndarray, data: np.ndarray, offs: np.ndarray) -> dict:
    """(row, item) -> (edits, start, end) of each item found in normalised texts."""
    grams = _grams(data)
    hits = np.flatnonzero(marked[grams >> np.uint64(64 - SLOT_BITS)]) if len(block.keys) else np.zeros(0, np.int64)
    at = row = np.zeros(0, np.int64)
    if len(hits):
        at = np.searchsorted(block.keys, grams[hits])
        at[at == len(block.keys)] = 0
        found = block.keys[at] == grams[hits]
        hits, at = hits[found], at[found]
        row = np.searchsorted(offs, hits, "right") - 1
        inside = hits + Q <= offs[row + 1]
        hits, at, row = hits[inside], at[inside], row[inside]
    out = {}
    longest = max((len(t) for t in block.texts), default=0)
    if len(hits):
        for r, i, b in zip(*(x.tolist() for x in _bands(block, hits, at, row, hits - offs[row], longest)), strict=True):
            if out.get((r, i), (1,))[0] == 0:
                continue
            budget = int(block.budgets[i])
            first = (b - 1) * (budget + 1) - longest
            text = data[offs[r] : offs[r + 1]]
            begin, end = max(0, first), min(len(text), first + 2 * (budget + 1) + len(block.texts[i]) + budget)
            region = text[begin:end]
            if _text(block.texts[i]) in _text(region):
                edits = 0
            else:
                # Diagonals of a path within the budget stray from a shared q-gram's by the budget at most.
                edits = banded_edits(block.texts[i], region, first - begin - budget, 2 * (budget + 1) + 2 * budget, budget)
            if edits <= budget:
                now = (edits, begin, end)
                out[r, i] = min(out.get((r, i), now), now)
    whole = _text(data) if block.short else ""
    for i in block.short:
        word = _text(block.texts[i])
        at = whole.find(word)
        while at >= 0:
            r = int(np.searchsorted(offs, at, "right")) - 1
            inside = at + len(word) <= offs[r + 1]
            if inside:
                out.setdefault((r, i), (0, int(at - offs[r]), int(at - offs[r]) + len(word)))
            # A text needs to be found once.
            at = whole.find(word, int(offs[r + 1]) if inside else at + 1)
    return out


def find_leaks(block: Items, marked: np.ndarray, data: np.ndarray, offs: np.ndarray):
    """(row, item, edits, start, end) of each item found in a piece of UTF-8 texts; start and end are those of the normalised text's band."""
    data, offs = _normal(data, offs)
    if len(offs) > 2 or len(data) <= SLICE:
        out = _search(block, marked, data, offs)
    else:
        # An item with its edits lies in a slice as a whole.
        overlap = max((len(t) + 4 * (int(k) + 1) for t, k in zip(block.texts, block.budgets, strict=True)), default=0)
        out = {}
        for begin in range(0, len(data), SLICE):
            part = data[begin : begin + SLICE + overlap]
            for key, (edits, start, end) in _search(block, marked, part, np.array([0, len(part)])).items():
                now = (edits, begin + start, begin + end)
                out[key] = min(out.get(key, now), now)
    return [(r, i, *v) for (r, i), v in sorted(out.items())]


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item_id, edits) of each document and each benchmark item in it."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_chars + 1
    docs = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("text"))
    schema = T.StructType([docs.schema[id_col], T.StructField("item_id", T.LongType()), T.StructField("edits", T.IntegerType())])
    out = None
    for k in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect() if blocks > 1 else items.collect()
        ids = [r.item_id for r in mine]
        block = index_items([-1 if i is None else i for i in ids], [r.text for r in mine], rate)
        shared = docs.sparkSession.sparkContext.broadcast((block, ids))

        def search(batches, shared=shared):
            block, ids = shared.value
            marked = np.zeros(1 << SLOT_BITS, bool)
            marked[block.keys >> np.uint64(64 - SLOT_BITS)] = True
            for batch in batches:
                of = batch.column(id_col)
                for at, _, data, offs in text_chunks(batch, "text"):
                    found = find_leaks(block, marked, data, offs)
                    rows = pa.array([at + f[0] for f in found], pa.int64())
                    yield pa.RecordBatch.from_arrays([of.take(rows), pa.array([ids[f[1]] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int32())], [id_col, "item_id", "edits"])

        part = docs.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return out


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """One row per document with a leak: id, n_items, items (sorted ids of the benchmark items), least_edits."""
    found = leaks(docs, items, id_col, text_col, rate)
    return found.groupBy(id_col).agg(F.countDistinct("item_id").alias("n_items"), F.sort_array(F.collect_set("item_id")).alias("items"), F.min("edits").alias("least_edits"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
