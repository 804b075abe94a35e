"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

1. quality: documents that the positive-unlabelled classifier scores below its threshold go.
2. lines: lines that many documents share stay in one of them; the text and n_chars of the others change.
3. near_duplicates: one document of each class of near copies (five-word shingles, similarity 0.8) stays, the one with the smallest id.
4. benchmark: documents with a benchmark passage go.
5. mixing: a sample by raked weights of source, language and topic; adds weight and probability.

Stages that take documents out by id tell rows by their id where no other row has it, and else by id and text: a text without an id,
or with the id of another text, is judged by itself, and of rows that repeat id and text one passes near_duplicates. In a class of near
copies such rows give way to rows with an id of their own. Empty texts pass every stage but the sample by chance. An empty table passes
through. Extra columns pass through, whatever their names; those named weight or probability are replaced in the last stage, and one
named topic is its topic.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.llm import decontamination, line_dedup, mixing, ngram_join, quality_classifier
from seriesflow.llm.shared import cut, delete, documents, new_path, scratch

#: Up to so many ids a list of documents to drop is broadcast.
BROADCAST_IDS = 1_000_000
#: Columns that stages know; others are renamed while operators work, so that none of their own columns has the name of one.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars", "topic")
KEY = "__key"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def guarded(stage: Stage) -> Stage:
    """The stage with the extra columns of docs renamed, and named as before in what it returns. Names that differ by case alone are one, as to Spark."""

    @wraps(stage)
    def with_names(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c if c in KNOWN else f"__extra_{k}": c for k, c in enumerate(docs.columns)}
        out = stage(spark, docs.toDF(*names), sf_dir)
        made = {c.lower() for c in out.columns if c not in names}
        return out.select(*(F.col(c).alias(names.get(c, c)) for c in out.columns if c not in names or names[c].lower() not in made))

    return with_names


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with KEY: the id, or, for rows whose id is null or another row's as well, a number beyond all ids from a hash of id and text."""
    ids = docs.select("doc_id")
    several = cut(ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1 and doc_id is not null").select("doc_id", F.lit(True).alias("__several")), "repeated-ids")
    number = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), 2)
    if several.isEmpty():
        return docs.withColumn(KEY, F.coalesce("doc_id", number))
    joined = docs.join(F.broadcast(several) if several.count() <= BROADCAST_IDS else several, "doc_id", "left")
    return joined.withColumn(KEY, F.when(F.col("__several").isNull() & F.col("doc_id").isNotNull(), F.col("doc_id")).otherwise(number)).select(*docs.columns, KEY)


def _without(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    keys = cut(keys.select(KEY).distinct(), "dropped")
    return keyed.join(F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys, KEY, "left_anti").drop(KEY)


@guarded
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scorer = quality_classifier.fold_scorer(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = quality_classifier.score(docs, scorer, keep_text=True, name="__score").filter(F.col("__score") >= quality_classifier.THRESHOLD)
    return kept.select(*docs.columns)


@guarded
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    thinned = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return thinned.select(*(F.col("kept_text").alias("text") if c == "text" else F.length("kept_text").cast("long").alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns))


@guarded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    own = F.col(KEY) < 1 << 62
    # Rows that repeat id and text are one.
    rows = keyed if keyed.filter(~own).isEmpty() else keyed.filter(own).unionByName(keyed.filter(~own).dropDuplicates([KEY]))
    classes = ngram_join.jaccard_classes(rows.select(KEY, "text"), id_col=KEY, size=5, num=80, den=100)
    return _without(rows, classes.filter(F.col(KEY) != F.col("component_id")))


@guarded
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    return _without(keyed, decontamination.leaks(keyed.select(KEY, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=KEY))


@guarded
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    added = [c for c in ("topic",) if c not in docs.columns]
    return mixing.mixed(docs).filter("sampled").select(*docs.columns, *added, "weight", "probability")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mixing", mix)]
#: The first stage is a fitted classifier, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
