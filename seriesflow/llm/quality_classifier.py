"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all that is learnt from: which texts were labelled negative is never used. With class prior
p, the risk of a linear model of style features is p * R_pos(+) + max(0, R_unl(-) - p * R_pos(-)), the non-negative unbiased
estimate, for the logistic loss. Under that loss the first part of both terms joins to -p * (mean of the positives' margins), so the risk is
convex, and Newton's method finds its least; where the part in max() gets below zero, and so overfits, its square is a penalty that
turns steps back. Each step is a pass over all training texts, whose partial sums the tasks return: nothing is sampled.

The prior is the least share of unlabelled to positive texts among those that score above some bound (with a margin for chance, which
picks the bound), as above a good bound nearly all unlabelled texts are positive. Model and prior are fitted in turn. The logistic
loss makes the model's output a probability under that prior; no label calibrates it.

Features come from the whole text only: character classes, line and word shapes, repetition, and a hashed histogram of
byte pairs. Labels, language, source and id are never features. Null and empty texts have the features of an empty text
and get a score like any other. Rows that repeat get the same score, and count as often as they occur. Rows without an id are never in a
training fold (nor held out). Without a positive text every score is 0.5. Extra columns are ignored, or kept where columns are passed on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import cut, documents, shingles, text_chunks, words

PAIRS = 96
THRESHOLD = 0.3
#: Weight of the squared weights in the risk.
DECAY = 1e-3
#: Most passes of a fit; it ends before when a step changes the risk by less than TOLERANCE.
PASSES = 12
TOLERANCE = 1e-5
#: Weight of the penalty on a negative estimate of the negatives' risk.
PENALTY = 100.0
#: Times that model and prior are fitted in turn.
TURNS = 3
BINS = 2000
#: Texts whose features are worked on at a time.
BLOCK = 1024

_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate((range(65, 91), range(97, 123), range(48, 58), b"!?", b"|", b"#$%&*@^~<>{}[]\\=_", b".,;:", b"'\"()-/", range(128, 192), range(192, 256), b"\n", b" \t\r"), 1):
    for _c in _chars:
        _CLASS[_c] = _k
N_CLASSES = 13


def _ratio(a, b):
    return a / np.maximum(b, 1)


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of features for each text of a piece (UTF-8 bytes and offsets)."""
    n = len(offs) - 1
    size = np.diff(offs)
    of = np.repeat(np.arange(n), size)
    kinds = np.bincount(of * N_CLASSES + _CLASS[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES).astype(float)
    pair = np.zeros(len(data), np.int64)
    if len(data) > 1:
        pair[1:] = (data[:-1].astype(np.int64) * 31 + data[1:] * 17 + (data[1:] >> 3)) % PAIRS
        # A text's first byte has none before it.
        pair[offs[:-1][size > 0]] = 0
    pairs = np.bincount(of * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS).astype(float)
    hashes, starts, ends, first = words(data, offs, lower=False)
    count = np.diff(first)
    word_of = np.repeat(np.arange(n), count)

    def per_text(flags):
        return np.bincount(word_of, flags, n)

    length = ends - starts
    same = np.zeros(len(hashes))
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (word_of[1:] == word_of[:-1])
    odd_end = np.isin(data[ends - 1], np.frombuffer(b"!#$%&*|", np.uint8)).astype(float) if len(ends) else np.zeros(0)
    upper = (_CLASS[data[starts]] == 1).astype(float) if len(starts) else np.zeros(0)
    runs, at = shingles(hashes, first, 3)
    distinct_words, distinct_runs = np.zeros(n), np.zeros(n)
    for k in range(n):
        distinct_words[k] = len(np.unique(hashes[first[k] : first[k + 1]]))
        distinct_runs[k] = len(np.unique(runs[at[k] : at[k + 1]]))
    lines = kinds[:, 11] + 1
    shape = [
        np.log1p(size), np.log1p(count), _ratio(per_text(length), count), _ratio(per_text(length.astype(float) ** 2), count) ** 0.5, _ratio(per_text(same), count), _ratio(per_text(odd_end), count),
        _ratio(per_text(upper), count), _ratio(per_text((length == 1).astype(float)), count), _ratio(distinct_words, np.sqrt(np.maximum(count, 1)) * 8), _ratio(distinct_words, count), _ratio(distinct_runs, np.diff(at)), np.log1p(_ratio(count, lines)), np.log1p(lines),
    ]
    total = np.maximum(size, 1)[:, None]
    return np.column_stack([*shape, kinds / total, np.sqrt(kinds[:, 1:8] / total), pairs / total])


WIDTH = features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]


def text_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the text, with its features as the bytes of 32-bit floats."""
    rest = [c for c in docs.columns if c != text_col]
    schema = T.StructType([docs.schema[c] for c in rest]).add("features", "binary")

    def compute(batches):
        for batch in batches:
            parts = [features(data, offs) for _, _, data, offs in text_chunks(batch, text_col)]
            flat = (np.concatenate(parts) if parts else np.zeros((0, WIDTH))).astype(np.float32)
            offsets = np.arange(len(flat) + 1, dtype=np.int32) * (4 * WIDTH)
            cells = pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), cells], [*rest, "features"])

    return docs.select(*rest, text_col).mapInArrow(compute, schema)


@dataclass
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _added(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """rows(positive, features) -> the sum over all batches of what `of` makes of their features and which are positive.

    Tasks add up their batches, and a shuffle of one row a task those of tasks, before the driver gets them."""

    def part(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                column = batch.column("features")
                data = np.frombuffer(column.buffers()[2], np.float32)
                first = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset]) // 4
                x = data[first : first + batch.num_rows * WIDTH].reshape(-1, WIDTH)
                y = batch.column("positive").to_numpy(zero_copy_only=False)
                for k in range(0, len(x), BLOCK):
                    one = of(x[k : k + BLOCK].astype(np.float64), y[k : k + BLOCK])
                    total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def join(batches):
        total = None
        for batch in batches:
            for one in batch.column("sums").to_pylist():
                one = np.frombuffer(one)
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = [np.frombuffer(r.sums) for r in rows.mapInArrow(part, "sums binary").repartition(parts).mapInArrow(join, "sums binary").collect()]
    return np.sum(sums, axis=0) if sums else np.zeros(0)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def risk_terms(x: np.ndarray, positive: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over a batch of standardised features with a last column of ones: number, loss when called negative, the loss's gradient
    and its second derivatives of all texts; number, loss, gradient and features of the positives."""
    z = x @ w
    s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    p = x[positive]
    return np.concatenate([[len(x), _softplus(z).sum()], x.T @ s, ((x * (s * (1 - s))[:, None]).T @ x).ravel(), [len(p), _softplus(z[positive]).sum()], p.T @ s[positive], p.sum(axis=0)])


def fit_nnpu(terms: Callable[[np.ndarray], np.ndarray], width: int, prior: float, start: np.ndarray | None = None, passes: int = PASSES, decay: float = DECAY, tolerance: float = TOLERANCE) -> np.ndarray:
    """The weights (the bias last) that minimise the non-negative risk; terms(w) are the sums of risk_terms over all texts."""
    size = width + 1
    ridge = np.append(np.full(width, decay), 1e-9)
    places = np.cumsum([2, size, size * size, 2, size])
    best = None
    w = np.zeros(size) if start is None else start
    for _ in range(passes):
        (n, loss), gradient, hessian, (n_pos, loss_pos), gradient_pos, centre = np.split(terms(w), places)
        negative = loss / n - prior * loss_pos / n_pos
        below = min(0.0, negative)
        risk = loss / n - prior * w @ centre / n_pos + ridge @ (w * w) / 2 + PENALTY / 2 * below**2
        if best is not None and risk > best[0]:
            w = (best[1] + w) / 2
            continue
        done = best is not None and best[0] - risk < tolerance
        best = (risk, w)
        if done:
            break
        slope = gradient / n - prior * gradient_pos / n_pos
        bend = hessian.reshape(size, size) / n + np.diag(ridge) + (PENALTY * np.outer(slope, slope) if below else 0)
        w = w - np.linalg.solve(bend, gradient / n - prior * centre / n_pos + ridge * w + PENALTY * below * slope)
    return best[1]


def prior_of(positive: np.ndarray, unlabelled: np.ndarray, gamma: float = 0.01, delta: float = 0.1) -> float:
    """The class prior from histograms of scores, bins in rising order."""
    n_p, n_u = positive.sum(), unlabelled.sum()
    above_p, above_u = np.cumsum(positive[::-1]) / n_p, np.cumsum(unlabelled[::-1]) / n_u
    ok = above_p > 0
    above_p, above_u = above_p[ok], above_u[ok]
    chance = np.sqrt(np.log(4 / delta) / (2 * n_u)) + np.sqrt(np.log(4 / delta) / (2 * n_p))
    k = int((above_u / above_p + (1 + gamma) / above_p * chance).argmin())
    return float(np.clip(above_u[k] / above_p[k], 0.01, 0.99))


def train(rows: DataFrame) -> Scorer | None:
    """rows(positive, features), a written table of the training texts: all of them are the unlabelled ones. None without positives."""
    sums = _added(rows, lambda x, y: np.concatenate([[len(x), np.count_nonzero(y)], x.sum(axis=0), (x * x).sum(axis=0)]))
    if not len(sums) or not sums[1]:
        return None
    mean = sums[2 : 2 + WIDTH] / sums[0]
    scale = np.sqrt(np.maximum(sums[2 + WIDTH :] / sums[0] - mean * mean, 0)) + 1e-6
    out = Scorer(mean, scale, np.zeros(WIDTH), 0.0, 0.5)
    decay = DECAY + 1 / sums[0]

    def terms(w):
        return _added(rows, lambda x, y: risk_terms(np.column_stack([out.standard(x), np.ones(len(x))]), y, w))

    def scores(x, y):
        bins = np.minimum((out.score(x) * BINS).astype(np.int64), BINS - 1)
        return np.concatenate([np.bincount(bins[y], minlength=BINS), np.bincount(bins, minlength=BINS)]).astype(float)

    w = None
    for turn in range(TURNS):
        # Only the last turn's model stays.
        w = fit_nnpu(terms, WIDTH, out.prior, w, decay=decay, tolerance=TOLERANCE if turn == TURNS - 1 else 100 * TOLERANCE)
        out = Scorer(mean, scale, w[:-1], float(w[-1]), out.prior)
        if turn < TURNS - 1:
            histogram = _added(rows, scores)
            out.prior = prior_of(histogram[:BINS], histogram[BINS:])
    return out


def score(docs: DataFrame, scorer: Scorer | None, text_col: str = "text", keep_text: bool = False, name: str = "score") -> DataFrame:
    """docs with a column `name` for the score, in place of one that has this name, and without the text unless keep_text."""
    docs = docs.drop(name)
    rest = [c for c in docs.columns if c != text_col]
    kept = docs.columns if keep_text else rest
    if scorer is None:
        return docs.select(*kept, F.lit(0.5).alias(name))
    schema = T.StructType([docs.schema[c] for c in kept]).add(name, "double")

    def compute(batches):
        for batch in batches:
            parts = [scorer.score(features(data, offs)) for _, _, data, offs in text_chunks(batch, text_col)]
            flat = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(flat)], [*kept, name])

    return docs.select(*rest, text_col).mapInArrow(compute, schema)


def fold_scorer(docs: DataFrame, labels: DataFrame) -> Scorer | None:
    """A scorer learnt from the texts of rows whose crc32(id) mod 5 isn't 0, and which of them are labelled 1 (and never 0)."""
    fold = docs.select("doc_id", "text").filter("doc_id is not null").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    trusted = labels.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality")).filter("quality = 1").select("doc_id", F.lit(True).alias("positive"))
    # Features join labels, so that no text is shuffled.
    marked = text_features(fold).join(trusted, "doc_id", "left").select(F.coalesce("positive", F.lit(False)).alias("positive"), "features")
    return train(cut(marked, "features"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scorer = fold_scorer(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = score(docs.select("doc_id", held_out.alias("held_out"), "text"), scorer)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
