"""Character language models of several labels, counted and smoothed in Spark and kept as sorted hash arrays.

A gram of k symbols is packed into 64 bits, `bits` for each symbol; its hash is a bijection of that word, so no two grams
share one. Per label and order, a model has the sorted hashes of seen grams with the logarithm of the interpolated
probability of their last symbol, and the sorted hashes of seen contexts with the weight that they leave to shorter ones.
All of them are kept: tasks write the arrays as files into the shared folder and map them into memory where they score.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import CHUNK_BYTES, cut, filesystem, mix64, new_path

BOS, EOS = 1, 2
#: About how many grams of a label and order one file holds.
SHARD_GRAMS = 1 << 21


@dataclass
class Alphabet:
    """How texts become symbols: `table` maps code points, `fold` lower-cases, `join` merges runs of spaces."""

    bits: int
    order: int
    fold: bool
    join: bool
    kind: str
    _table: np.ndarray | None = field(default=None, repr=False)

    def table(self) -> np.ndarray:
        if self._table is None:
            top = (1 << self.bits) - 1
            if self.kind == "letters":
                out = np.full(0x110000, 32, np.uint32)
                letters = np.fromiter((c for c in range(0x110000) if chr(c).isalpha()), np.int64)
                out[letters] = np.minimum(letters, top)
            else:
                out = np.minimum(np.arange(0x110000), top).astype(np.uint32)
                out[:3] = 32
            self._table = out
        return self._table

    def __getstate__(self):
        return {**self.__dict__, "_table": None}

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Packed grams of the full order that end at each symbol and at the end of each text, and where each text's begin."""
        pad = self.order - 1
        fill = "\x20" * pad
        full = "".join([fill + (t.lower() if self.fold else t) + "\x20" for t in texts])
        lens = np.fromiter(((len(t.lower()) if self.fold else len(t)) for t in texts), np.int64, len(texts)) + pad + 1
        ends = np.cumsum(lens)
        starts = ends - lens
        symbols = self.table()[np.frombuffer(full.encode("utf-32-le", "replace"), np.uint32)]
        edge = np.zeros(len(symbols), bool)
        for j in range(pad):
            symbols[starts + j] = BOS
            edge[starts + j] = True
        symbols[ends - 1] = EOS
        if self.join:
            keep = np.ones(len(symbols), bool)
            keep[1:] = (symbols[1:] != 32) | (symbols[:-1] != 32)
            symbols, edge = symbols[keep], edge[keep]
            total = np.zeros(len(keep) + 1, np.int64)
            np.cumsum(keep, out=total[1:])
            starts = total[starts]
        packed = symbols.astype(np.uint64)
        key = packed.copy()
        for j in range(1, self.order):
            key[j:] |= packed[: len(packed) - j] << np.uint64(self.bits * j)
        inside = ~edge
        begin = np.zeros(len(edge) + 1, np.int64)
        np.cumsum(inside, out=begin[1:])
        return key[inside], begin[starts]


    def parts(self, text: str, limit: int = CHUNK_BYTES):
        """The packed grams of one text, of about limit characters at a time."""
        pad, table, at = self.order - 1, self.table(), 0
        tail = np.full(pad, BOS, np.uint32)
        while at <= len(text):
            end = at + limit
            if end < len(text):
                # Lower-casing may look at neighbours, but not over a space.
                space = text.rfind(" ", at + limit // 2, end)
                end = space if space > 0 else end
            part = text[at:end]
            codes = np.frombuffer((part.lower() if self.fold else part).encode("utf-32-le", "replace"), np.uint32)
            symbols = np.concatenate([tail, table[codes], np.full(int(end >= len(text)), EOS, np.uint32)])
            if self.join:
                keep = np.ones(len(symbols), bool)
                keep[pad:] = (symbols[pad:] != 32) | (symbols[pad - 1 : -1] != 32)
                symbols = symbols[keep]
            packed = symbols.astype(np.uint64)
            key = packed.copy()
            for j in range(1, self.order):
                key[j:] |= packed[: len(packed) - j] << np.uint64(self.bits * j)
            yield key[pad:]
            tail = symbols[len(symbols) - pad :]
            at = end if end < len(text) else len(text) + 1


def text_pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES):
    """(first row, texts) of pieces of about `limit` characters, a longer text alone; null is empty."""
    texts = [t or "" for t in batch.column(column).to_pylist()]
    at, size = 0, 0
    for k, t in enumerate(texts):
        if len(t) >= limit and at < k:
            yield at, texts[at:k]
            at, size = k, 0
        size += len(t)
        if size >= limit:
            yield at, texts[at : k + 1]
            at, size = k + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def gram_counts(texts: DataFrame, alphabet: Alphabet) -> DataFrame:
    """texts(label, text) -> (label, key, n): how often each gram of the full order occurs."""

    def count(batches):
        held: dict[str, list] = {}
        size = 0

        def merged(parts):
            keys, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            out, at = np.unique(keys, return_inverse=True)
            return out, np.bincount(at, n, len(out)).astype(np.int64)

        def rows():
            for label, parts in held.items():
                keys, n = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["label", "key", "n"])
            held.clear()

        for batch in batches:
            labels = batch.column("label").to_pylist()
            for at, piece in text_pieces(batch, "text"):
                mine = labels[at : at + len(piece)]
                names = sorted(set(mine))
                if len(piece) == 1 and len(piece[0]) >= CHUNK_BYTES:
                    for keys in alphabet.parts(piece[0]):
                        part = np.unique(keys, return_counts=True)
                        held[names[0]] = [merged([*held.get(names[0], ()), part])]
                        size += len(part[0])
                    continue
                keys, begin = alphabet.grams(piece)
                which = np.fromiter((names.index(x) for x in mine), np.int64, len(mine))
                of = np.repeat(which, np.diff(np.append(begin, len(keys))))
                for k, name in enumerate(names):
                    part = np.unique(keys[of == k] if len(names) > 1 else keys, return_counts=True)
                    held.setdefault(name, []).append(part)
                    size += len(part[0])
                    if len(held[name]) >= 16:
                        held[name] = [merged(held[name])]
            if size > 8_000_000:
                yield from rows()
                size = 0
        yield from rows()

    counted = texts.filter(F.col("label").isNotNull()).select("label", "text").mapInArrow(count, "label string, key long, n long")
    return counted.groupBy("label", "key").agg(F.sum("n").alias("n"))


def _mapped(folder: str, name: str, kind: type) -> np.ndarray:
    """A file of numbers, mapped into memory; one of a store that isn't mounted is copied to the process's temporary folder before."""
    store, path = filesystem(f"{folder}/{name}")
    if isinstance(store, fs.LocalFileSystem):
        return np.asarray(np.memmap(path, kind, "r"))
    with tempfile.TemporaryFile() as copy:
        with store.open_input_stream(path) as source:
            shutil.copyfileobj(source, copy)
        copy.flush()
        return np.asarray(np.memmap(copy, kind, "r"))


@dataclass
class Model:
    labels: list[str]
    order: int
    bits: int
    folder: str
    #: Of "gram" or "context", order, shard and label: the name of its files. A shard is what hashes begin with.
    files: dict[tuple[str, int, int, str], str]
    shard_bits: int
    floor: float
    _arrays: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_arrays": {}}

    def _find(self, kind: str, k: int, label: str, hashes: np.ndarray, shards: list) -> tuple[np.ndarray, np.ndarray]:
        """The logarithms that are stored for hashes, and which hashes are stored."""
        values, found = np.zeros(len(hashes)), np.zeros(len(hashes), bool)
        for shard, mine in shards:
            part = (kind, k, shard, label)
            if part not in self.files:
                continue
            if part not in self._arrays:
                name = self.files[part]
                self._arrays[part] = (_mapped(self.folder, name + ".hashes", np.int64), _mapped(self.folder, name + ".values", np.float64))
            stored, logs = self._arrays[part]
            at = np.searchsorted(stored, hashes[mine])
            at[at == len(stored)] = 0
            hit = stored[at] == hashes[mine]
            found[mine] = hit
            values[mine] = np.where(hit, logs[at], 0.0)
        return values, found

    def _shards(self, hashes: np.ndarray) -> list:
        """(shard, positions) of hashes."""
        if not self.shard_bits:
            return [(0, slice(None))]
        shard = hashes >> np.int64(64 - self.shard_bits)
        by = np.argsort(shard, kind="stable")
        names, first = np.unique(shard[by], return_index=True)
        return list(zip(names.tolist(), np.split(by, first[1:]), strict=True))

    def log_probability(self, keys: np.ndarray) -> np.ndarray:
        """(labels, keys): log probability of each packed gram's last symbol given those before it."""
        out = np.full((len(self.labels), len(keys)), self.floor)
        for k in range(1, self.order + 1):
            short = keys & np.uint64((1 << (self.bits * k)) - 1)
            hashes, above = mix64(short).view(np.int64), mix64(short >> np.uint64(self.bits)).view(np.int64)
            mine, theirs = self._shards(hashes), self._shards(above)
            for i, label in enumerate(self.labels):
                weight, _ = self._find("context", k, label, above, theirs)
                value, found = self._find("gram", k, label, hashes, mine)
                out[i] = np.where(found, value, out[i] + weight)
        return out

    def means(self, texts: list[str], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
        """(texts, labels): mean log probability per symbol; and the number of symbols."""
        if len(texts) == 1 and len(texts[0]) >= CHUNK_BYTES:
            # Its grams are never there all at once.
            total, size = np.zeros(len(self.labels)), 0
            for keys in alphabet.parts(texts[0]):
                different, n = np.unique(keys, return_counts=True)
                total += self.log_probability(different) @ n
                size += len(keys)
            return total[None, :] / size, np.array([size])
        keys, begin = alphabet.grams(texts)
        different, at = np.unique(keys, return_inverse=True)
        logp = self.log_probability(different)
        sizes = np.diff(np.append(begin, len(keys)))
        sums = np.stack([np.add.reduceat(logp[i][at], begin) for i in range(len(self.labels))], axis=1)
        return sums / sizes[:, None], sizes


def _store(rows: DataFrame, shard_bits: int) -> tuple[str, dict[tuple[str, int, int, str], str]]:
    """rows(kind, k, label, key, value) -> the folder and names of Model. Only the names of files come to the driver."""
    folder = new_path(rows.sparkSession, "model")

    def hashed(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            at = batch.schema.get_field_index("key")
            yield batch.set_column(at, "key", pa.array(mix64(keys.view(np.uint64)).view(np.int64)))

    def write(batches):
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        now, name, out, done = None, None, (), []

        def close():
            for o in out:
                o.close()
            if now is not None:
                done.append((now, name))

        for batch in batches:
            parts = batch.column("part").dictionary_encode()
            names, codes = parts.dictionary.to_pylist(), parts.indices.to_numpy()
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "value")]
            edges = [0, *(np.flatnonzero(np.diff(codes)) + 1), len(codes)] if len(codes) else [0]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if names[codes[a]] != now:
                    close()
                    # An attempt that fails leaves files that nothing names.
                    now, name = names[codes[a]], uuid.uuid4().hex
                    out = [store.open_output_stream(f"{root}/{name}.{end}") for end in ("hashes", "values")]
                for o, column in zip(out, columns, strict=True):
                    o.write(column[a:b].tobytes())
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in done], pa.string()) for j in range(2)], ["part", "name"])

    shard = F.shiftright("key", 64 - shard_bits) if shard_bits else F.lit(0)
    parts = rows.mapInArrow(hashed, rows.schema).select(F.concat_ws("/", "kind", "k", shard, "label").alias("part"), "key", "value")
    written = parts.repartition("part").sortWithinPartitions("part", "key").mapInArrow(write, "part string, name string").collect()
    files = {}
    for r in written:
        kind, k, of, label = r.part.split("/", 3)
        if files.setdefault((kind, int(k), int(of), label), r.name) != r.name:
            raise ValueError(f"{r.part} was written by two tasks")
    return folder, files


def fit(counts: DataFrame, alphabet: Alphabet, smoothing: str = "kneser-ney", shard_grams: int = SHARD_GRAMS) -> Model:
    """counts(label, key, n) of the full order -> Model.

    kneser-ney: shorter grams count their different left neighbours, and an absolute discount n1 / (n1 + 2 n2) per label and
    order goes to shorter contexts. witten-bell: plain counts, and a context gives N / (n + N) to shorter ones, N being its
    number of different continuations. All grams are stored, in files of about shard_grams each."""
    bits, order = alphabet.bits, alphabet.order
    level = cut(counts, "grams")
    levels = {order: level}
    for k in range(order - 1, 0, -1):
        suffix = F.col("key").bitwiseAND(F.lit((1 << (bits * k)) - 1))
        n = F.count(F.lit(1)) if smoothing == "kneser-ney" else F.sum("n")
        level = cut(level.groupBy("label", suffix.alias("key")).agg(n.alias("n")), "grams")
        levels[k] = level
    symbols = levels[1].select("key").distinct().count() + 1
    stored = []
    lower = None
    for k in range(1, order + 1):
        level = levels[k]
        level = level.withColumn("context", F.shiftrightunsigned("key", bits))
        stats = level.groupBy("label", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        if smoothing == "kneser-ney":
            ones = level.groupBy("label").agg(F.sum((F.col("n") == 1).cast("long")).alias("n1"), F.sum((F.col("n") == 2).cast("long")).alias("n2"))
            ones = ones.select("label", F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.expr("n1 / (n1 + 2 * n2)")).otherwise(0.5).alias("d"))
            # One row a label.
            stats = stats.join(F.broadcast(ones), "label").withColumns({"z": F.col("total") * 1.0, "left": F.expr("d * kinds / total")})
        else:
            stats = stats.withColumns({"d": F.lit(0.0), "z": F.expr("1.0 * total + kinds"), "left": F.expr("kinds / (total + kinds)")})
        joined = level.join(stats, ["label", "context"])
        if lower is None:
            p = (F.col("n") - F.col("d")) / F.col("z") + F.col("left") / symbols
            lower = joined.select("label", "key", "n", "context", p.alias("p"))
        else:
            short = lower.select("label", F.col("key").alias("suffix"), F.col("p").alias("q"))
            joined = joined.withColumn("suffix", F.col("key").bitwiseAND(F.lit((1 << (bits * (k - 1))) - 1))).join(short, ["label", "suffix"])
            lower = joined.select("label", "key", "n", "context", ((F.col("n") - F.col("d")) / F.col("z") + F.col("left") * F.col("q")).alias("p"))
        lower = cut(lower, "probabilities")
        of = lambda kind, k=k: (F.lit(kind).alias("kind"), F.lit(k).alias("k"), "label")
        stored.append(lower.select(*of("gram"), "key", F.log("p").alias("value")))
        stored.append(stats.select(*of("context"), F.col("context").alias("key"), F.log("left").alias("value")))
    # No order has more grams than the longest.
    shard_bits = max(0, -(-levels[order].count() // shard_grams) - 1).bit_length()
    folder, files = _store(reduce(DataFrame.unionByName, stored), shard_bits)
    return Model(sorted({label for _, _, _, label in files}), order, bits, folder, files, shard_bits, float(-np.log(symbols)))
