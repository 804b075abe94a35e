"""URL filters: host and path rules, and a character language-model ratio for the URLs that no rule fits.

URLs that rules allow and block are the accepted and rejected examples. For each kind a variable-order Markov model of
characters (contexts of up to five characters, shorter where a longer one wasn't seen, smoothed after Witten and Bell) is counted over
all of them. A URL's score is the mean log-likelihood per character under the accepted model less that under the rejected one;
it is allowed if the score reaches a threshold calibrated for the best mean of both kinds' accuracy on all examples of a tenth of the
different URLs, which the models aren't counted on (0 if that has one kind only). With examples of one kind only, or none, every such URL is allowed.

The host is what follows the first :// up to / ? # or the end, with A-Z lower-cased; the path goes on up to ? # or the end. A
null URL, or one without ://, has both empty. Of rules of equal length that fit, the first in the list counts. Repeated rows give repeated
results. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .char_models import Alphabet, Model, fit, gram_counts, text_pieces
from .shared import lower_ascii, ranged

#: verdict, host, path.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))


def alphabet() -> Alphabet:
    return Alphabet(bits=8, order=6, fold=True, join=False, kind="bytes")


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://(.*)\z", 1)
    return lower_ascii(F.regexp_extract(rest, r"\A[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct<verdict, rule> of the longest rule that fits, or null. A rule fits its host and all its subdomains."""
    by_length = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))) for verdict, h, p in by_length]
    return F.coalesce(*fits)


def score_urls(urls: DataFrame, model: Model, url_col: str = "url") -> DataFrame:
    """urls with lm_score: mean log-likelihood per character as `allow` less that as `block`."""
    shared = urls.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(list(urls.schema.fields)).add("lm_score", "double")

    def compute(batches):
        symbols, known = alphabet(), shared.value
        a, b = known.labels.index("allow"), known.labels.index("block")
        for batch in batches:
            parts = [known.means(piece, symbols)[0] for _, piece in text_pieces(batch, url_col)]
            means = np.concatenate(parts) if parts else np.zeros((0, 2))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(means[:, a] - means[:, b])], [*batch.schema.names, "lm_score"])

    return urls.mapInArrow(compute, schema)


def _threshold(scored) -> float:
    """The score with the best mean accuracy of both kinds, of rows that are at hand."""
    scored = sorted((r.lm_score, r.label == "allow") for r in scored)
    yes = np.array([x[1] for x in scored])
    values = np.array([x[0] for x in scored])
    blocked = np.concatenate([[0], np.cumsum(~yes)]) / max(1, (~yes).sum())
    allowed = 1 - np.concatenate([[0], np.cumsum(yes)]) / max(1, yes.sum())
    k = int((blocked + allowed).argmax())
    low, high = values[max(k - 1, 0)], values[min(k, len(values) - 1)]
    return float((low + high) / 2)


def threshold(scored: DataFrame) -> float | None:
    """What _threshold gives for all rows of a table(lm_score, label); none if they are of one kind. Different scores are counted, cut into ranges, and summed up within these; the driver has a row for each range."""
    yes = F.col("label") == "allow"
    table = ranged(scored.groupBy("lm_score").agg(F.sum((~yes).cast("long")).alias("no"), F.sum(yes.cast("long")).alias("yes")), "lm_score")
    parts = table.groupBy("__part").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"), F.min("lm_score").alias("low")).orderBy("__part").collect()
    no, yes = (sum(r[c] for r in parts) for c in ("no", "yes"))
    if not no or not yes:
        return None
    before, after, rows = (0, 0), [r.low for r in parts[1:]] + [None], []
    for r, follows in zip(parts, after, strict=True):
        rows.append((r["__part"], *before, follows))
        before = before[0] + r["no"], before[1] + r["yes"]
    carried = table.join(F.broadcast(table.sparkSession.createDataFrame(rows, "__part int, no0 long, yes0 long, follows double")), "__part")
    w = Window.partitionBy("__part").orderBy("lm_score")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    at = carried.select(
        "lm_score", "no", "yes", (F.col("no0") + F.sum("no").over(upto)).alias("blocked"), (F.col("yes0") + F.sum("yes").over(upto) - F.col("yes")).alias("lost"),
        F.coalesce(F.lead("lm_score").over(w), "follows", "lm_score").alias("next"),
    )
    # The best cut is right after blocked examples of a score, before allowed ones; or before all.
    first = (F.col("blocked") == 0) & (F.col("lost") == 0)
    cuts = at.filter((F.col("no") > 0) | first).select(
        (F.col("blocked") / F.lit(float(no)) + (F.lit(1.0) - F.col("lost") / F.lit(float(yes)))).alias("accuracy"), "lm_score",
        F.when((F.col("no") > 0) & (F.col("yes") == 0), (F.col("lm_score") + F.col("next")) / 2).otherwise(F.col("lm_score")).alias("cut"),
    )
    return cuts.orderBy(F.desc("accuracy"), "lm_score").first()["cut"]


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, lm_score."""
    parts = pages.select(F.col(id_col), F.col(url_col).alias("url"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    named = parts.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)).select(id_col, "url", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("label"))
    examples = named.filter("label is not null").select("label", F.col("url").alias("text"))
    apart = F.pmod(F.xxhash64("text"), F.lit(10)) == 0

    def fit_on(rows: DataFrame) -> Model | None:
        counts = gram_counts(rows, alphabet())
        model = None if counts.isEmpty() else fit(counts, alphabet(), "witten-bell")
        return model if model is not None and len(model.labels) == 2 else None

    model, limit = fit_on(examples.filter(~apart)), 0.0
    if model is None:
        # Too few examples to set some apart.
        model = fit_on(examples)
    else:
        found = threshold(score_urls(examples.filter(apart).select("label", F.col("text").alias("url")), model).select("label", "lm_score"))
        limit = limit if found is None else found
    if model is None:
        return named.select(id_col, "host", "path", "rule", F.coalesce("label", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("lm_score"))
    guess = F.when(F.col("lm_score") >= limit, "allow").otherwise("block")
    return score_urls(named, model).select(id_col, "host", "path", "rule", F.coalesce("label", guess).alias("verdict"), "lm_score")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
