"""Language identification by interpolated Kneser-Ney character models, one per language.

Texts are lower-cased; what is no letter counts as a space, and runs of spaces as one. Each language's model gives a text a
cross-entropy per symbol; the lowest wins. The score is the winner's share when the entropies are turned into weights
exp(-sharpness * entropy); the sharpness is the one under which the calibration texts are likeliest. A text is
`rejected` if the winner's entropy is above what all but one in a thousand of those texts have in their own language. They are
a tenth of the different labelled texts, all of it, which the models aren't counted on. Of languages with equal entropy the first in order of names wins.

`und` is the answer for null texts and texts without a letter (score 0, not rejected). Rows whose language is null are no
training texts, nor are rows without an id, which aren't held out either. Without any training text every answer is `und`. Repeated rows count as often as they occur, and get the same answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .char_models import Alphabet, Model, fit, gram_counts, text_pieces
from .shared import cut, documents, ranged

UNKNOWN = "und"
SHARPNESS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)


def alphabet() -> Alphabet:
    return Alphabet(bits=16, order=4, fold=True, join=True, kind="letters")


def train(texts: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    return fit(gram_counts(texts.select(F.col(lang_col).alias("label"), F.col(text_col).alias("text")).filter("text is not null"), alphabet()), alphabet(), "kneser-ney")


def _entropies(model: Model, letters: Alphabet, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    means, _ = model.means(texts, letters)
    is_letter = letters.table()
    known = np.fromiter((any(is_letter[ord(c)] != 32 for c in t[:256]) or any(is_letter[ord(c)] != 32 for c in t[256:]) for t in texts), bool, len(texts))
    return -means, known


def _quantile(values: DataFrame, column: str, share: float) -> float:
    """The exact quantile of a table's column, as numpy has it. Different values are counted and cut into ranges; the driver has a row for each range."""
    table = ranged(values.groupBy(column).agg(F.count(F.lit(1)).alias("n")), column)
    parts = table.groupBy("__part").agg(F.sum("n").alias("n")).orderBy("__part").collect()
    place = share * (sum(r.n for r in parts) - 1)
    found = []
    for rank in (int(np.floor(place)), int(np.ceil(place))):
        before = 0
        for part in parts:
            if rank < before + part.n:
                break
            before += part.n
        upto = F.sum("n").over(Window.partitionBy("__part").orderBy(column).rowsBetween(Window.unboundedPreceding, 0))
        mine = table.filter(F.col("__part") == part["__part"]).select(column, upto.alias("upto"))
        found.append(mine.filter(F.col("upto") > rank - before).agg(F.min(column)).first()[0])
    return float(np.quantile(found, place - np.floor(place)))


def calibrate(model: Model, texts: DataFrame, lang_col: str = "lang", text_col: str = "text", rows: int | None = None) -> tuple[float, float]:
    """(sharpness, highest entropy to accept) from all different labelled texts, each scored whole and once a label; with rows, from at most so many, those with the smallest hash."""
    known = texts.select(F.col(lang_col).alias("label"), F.col(text_col).alias("text")).filter(F.col("label").isin(model.labels) & F.col("text").isNotNull())
    if rows is not None:
        known = known.withColumn("h", F.xxhash64("text"))
        bound = known.select("h").distinct().orderBy("h").limit(rows).agg(F.max("h")).first()[0]
        known = known.filter(F.col("h") <= bound if bound is not None else F.lit(False))
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        letters, known_model = alphabet(), shared.value
        for batch in batches:
            labels = batch.column("label").to_pylist()
            for at, piece in text_pieces(batch, "text"):
                h, spelt = _entropies(known_model, letters, piece)
                h, truth = h[spelt], [known_model.labels.index(labels[at + k]) for k in np.flatnonzero(spelt)]
                own, low = h[np.arange(len(h)), truth], h.min(axis=1)
                # Of each sharpness, the logarithm of the share that the text's own language has.
                shares = [-beta * (own - low) - np.log(np.exp(-beta * (h - low[:, None])).sum(axis=1)) for beta in SHARPNESS]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.float64()), *(pa.array(x, pa.float64()) for x in shares)], names)

    names = ["own", *(f"share{k}" for k in range(len(SHARPNESS)))]
    # Numbers alone are written; what comes to the driver are their means and a quantile.
    measured = cut(known.select("label", "text").dropDuplicates().mapInArrow(measure, ", ".join(f"{n} double" for n in names)), "calibration")
    means = measured.agg(*(F.avg(n) for n in names[1:])).first()
    if means[0] is None:
        return SHARPNESS[0], float("inf")
    return SHARPNESS[int(np.argmax(means))], _quantile(measured, "own", 0.999) + 0.05


def fitted(texts: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[Model, float, float]:
    """A model counted on nine tenths of the different texts, and its calibration on the others. Languages whose texts all belong to the others are counted on these, and not calibrated on."""
    apart = F.pmod(F.xxhash64(text_col), F.lit(10)) == 0
    # Languages come here, as they do with the model.
    usual = [r[0] for r in texts.filter(~apart & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(lang_col).distinct().collect()]
    rare = ~F.col(lang_col).isin(usual)
    model = train(texts.filter(~apart | rare), lang_col, text_col)
    return model, *calibrate(model, texts.filter(apart & ~rare), lang_col, text_col)


def predict(docs: DataFrame, model: Model, sharpness: float, highest: float, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score (0 to 1), entropy (of the answer, per symbol) and rejected, in place of columns with these names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score", "entropy", "rejected")
    schema = T.StructType(list(docs.schema.fields))
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("entropy", "double"), ("rejected", "boolean")):
        schema = schema.add(name, kind)

    def guess(batches):
        letters, known_model = alphabet(), shared.value
        for batch in batches:
            names, scores, best, rejected = [], [], [], []
            for _, piece in text_pieces(batch, text_col):
                if not known_model.labels:
                    names += [UNKNOWN] * len(piece)
                    scores += [0.0] * len(piece)
                    best += [None] * len(piece)
                    rejected += [False] * len(piece)
                    continue
                h, known = _entropies(known_model, letters, piece)
                low = h.min(axis=1)
                share = 1 / np.exp(-sharpness * (h - low[:, None])).sum(axis=1)
                for k, i in enumerate(h.argmin(axis=1)):
                    names.append(known_model.labels[i] if known[k] else UNKNOWN)
                    scores.append(float(share[k]) if known[k] else 0.0)
                    best.append(float(low[k]) if known[k] else None)
                    rejected.append(bool(known[k] and low[k] > highest))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(best, pa.float64()), pa.array(rejected, pa.bool_())], [*batch.schema.names, "lang_pred", "score", "entropy", "rejected"])

    return docs.mapInArrow(guess, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", held_out.alias("held_out"))
    learn = docs.filter("not held_out and doc_id is not null and lang is not null").select("lang", "text")
    model, sharpness, highest = fitted(learn)
    out = predict(docs.select("doc_id", "held_out", "text"), model, sharpness, highest)
    return out.select("doc_id", "held_out", "lang_pred", "score", "entropy", "rejected")
