"""Mixing sources to target weights by iterative proportional fitting. DataFrame functions only.

Tokens are summed per cell of source, language and topic. Raking multiplies the cells' weights, one margin after the other and round
after round, by target over present share, until no weight changes any more, or for ROUNDS at most: the weighted tokens then have all target marginals. Where weights still change by more than 1 in
10,000 (few documents a cell, or targets that no weights meet together), a warning says by how much; the last margin is met even then. A document is then sampled
with probability min(1, c * weight of its cell); c is calibrated so that the expected tokens are the budget.

Targets of a margin are shares by value; values without a target get none of it, targets without tokens are left out and the
others scaled to add up to 1. Without given targets a margin's target is its tokens' shares to a power below 1, which
lifts small values. Null values are a value of their own (shown as ''), null and empty texts have no tokens (weight of
their cell, or 0 where a cell has no tokens at all). The draw depends on the id alone, so rows that repeat share their fate, and so do
rows without an id. Texts of any length count whole. An empty table gives an empty result.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, documents, unused

MARGINS = ("source", "lang", "topic")
#: Raking ends when no weight changes by more than this share, or after so many rounds.
TOLERANCE = 1e-10
ROUNDS = 10
POWER = 0.5
#: Expected tokens of the sample, of all.
BUDGET = 0.8
FILLS = 8
#: Up to so many cells their table is broadcast.
BROADCAST_CELLS = 200_000
DIGITS = 6


def tokens_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by what a text has: licence terms, listings, addresses, or nothing of it."""
    return F.when(F.contains(text, F.lit("icense")), "legal").when(F.contains(text, F.lit(" | ")), "listing").when(F.contains(text, F.lit("@")), "contact").otherwise("prose")


def _cells(docs: DataFrame, text_col: str) -> DataFrame:
    keyed = docs.select(*(F.coalesce(F.col(m).cast("string"), F.lit("")).alias(m) for m in MARGINS), tokens_of(F.col(text_col)).alias("tokens"))
    return keyed.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))


def _targets(cells: DataFrame, margin: str, given: DataFrame | None, power: float) -> DataFrame:
    """(margin, share) of the values that have tokens; shares add up to 1."""
    present = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).filter("t > 0")
    if given is None:
        raw = present.select(margin, F.pow(F.col("t").cast("double"), power).alias("raw"))
    else:
        raw = present.join(given.select(F.coalesce(F.col(margin).cast("string"), F.lit("")).alias(margin), F.col("share").cast("double").alias("raw")), margin).select(margin, "raw")
    total = raw.agg(F.sum("raw")).first()[0] or 1.0
    return raw.select(margin, (F.col("raw") / total).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], most: int = ROUNDS) -> DataFrame:
    """cells with weight: after it, weighted tokens have the target shares of each margin.

    Cells are only ever summed up per value, which tasks begin by themselves, and join tables of one row a value; a value with many cells is
    a skewed key of that join, which Spark splits. Each step is written: the next ones start from it."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    now = cells.withColumn("weight", F.lit(1.0))
    for m, wanted in targets.items():
        now = now.join(wanted.select(m, (F.col("share") * total).alias(f"__{m}")).hint("merge"), m, "left")
    now = cut(now.withColumns({f"__{m}": F.coalesce(f"__{m}", F.lit(0.0)) for m in targets}), "cells")
    change = 0.0
    for _ in range(most):
        change = 0.0
        for m in targets:
            mass = now.groupBy(m).agg(F.sum(F.col("tokens") * F.col("weight")).alias("__mass"), F.max(f"__{m}").alias("__wanted"))
            # A value without tokens, or without weight so far, has no factor.
            factor = mass.select(m, F.when(F.col("__mass") > 0, F.col("__wanted") / F.col("__mass")).otherwise(0.0).alias("__factor"))
            # A table of one row a value would be broadcast at every step, and stay in executors' memory long after.
            now = cut(now.drop("__factor").join(factor.hint("merge"), m).withColumn("weight", F.col("weight") * F.col("__factor")), "cells")
            change = max(change, now.agg(F.max(F.when(F.col("weight") > 0, F.abs(F.col("__factor") - 1)))).first()[0] or 0.0)
        if change < TOLERANCE:
            break
    if change > 1e-4:
        warnings.warn(f"raking has not converged: weights still change by a share of {change:.3g}", stacklevel=2)
    return now.select(*MARGINS, "tokens", "weight")


def calibrate(cells: DataFrame, budget: float) -> DataFrame:
    """cells with probability min(1, c * weight): c makes the expected tokens `budget` of all, as far as weights above zero allow.

    Each step raises c, and ends when no more cells have reached 1: after a few steps, and never more than there are cells."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    c, reached = 0.0, -1
    while True:
        full = F.col("weight") * c >= 1
        row = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("weight"))).alias("mass"), F.coalesce(F.sum(full.cast("int")), F.lit(0)).alias("reached")).first()
        if not row.mass or row.reached == reached:
            break
        c, reached = (budget * total - row.full) / row.mass, row.reached
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * c))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, rounds: int = ROUNDS, power: float = POWER, seed: str = "mix") -> DataFrame:
    """docs (with source and lang; topic is added if there is none) with weight, probability and sampled, in place of columns with these names."""
    docs = docs.drop("weight", "probability", "sampled")
    if "topic" not in docs.columns:
        docs = docs.withColumn("topic", topic_of(F.coalesce(F.col(text_col), F.lit(""))))
    cells = cut(_cells(docs, text_col), "cells")
    wanted = {m: cut(_targets(cells, m, (targets or {}).get(m), power), "targets") for m in MARGINS}
    keys = dict(zip(MARGINS, unused(docs, *(f"__{m}" for m in MARGINS)), strict=True))
    done = cut(calibrate(rake(cells, wanted, rounds), budget).select(*(F.col(m).alias(k) for m, k in keys.items()), F.round("weight", DIGITS).alias("weight"), F.round("probability", DIGITS).alias("probability")), "mixed")
    side = F.broadcast(done) if done.count() <= BROADCAST_CELLS else done
    match = [F.coalesce(F.col(m).cast("string"), F.lit("")) == F.col(k) for m, k in keys.items()]
    joined = docs.join(side, match[0] & match[1] & match[2]).drop(*keys.values())
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 12), 16, 10).cast("double") / float(16**12)
    return joined.withColumn("sampled", draw < F.col("probability"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(documents(spark, sf_dir).select("doc_id", "text", "source", "lang"))
    return out.select("doc_id", "source", "lang", "topic", tokens_of(F.col("text")).alias("tokens"), "weight", "probability", "sampled")


def _oracle() -> str:
    steps = [
        r"""d as (select doc_id, coalesce(source, '') source, coalesce(lang, '') lang, coalesce(text, '') txt,
        case when contains(txt, 'icense') then 'legal' when contains(txt, ' | ') then 'listing' when contains(txt, '@') then 'contact' else 'prose' end topic,
        len(regexp_extract_all(txt, '[^\x20\x09-\x0D]+'))::bigint tokens from documents)""",
        "cells as materialized (select source, lang, topic, sum(tokens)::double tokens from d group by all)",
        "total as (select sum(tokens) total from cells)",
        "w0 as (select *, 1.0::double weight from cells)",
    ]
    for m in MARGINS:
        steps.append(f"r_{m} as (select {m}, pow(sum(tokens), {POWER}) raw from cells group by {m} having sum(tokens) > 0)")
        steps.append(f"t_{m} as materialized (select {m}, raw / (select sum(raw) from r_{m}) share from r_{m})")
    n = 0
    for _ in range(ROUNDS):
        for m in MARGINS:
            steps.append(f"s{n} as (select {m}, sum(tokens * weight) mass from w{n} group by {m})")
            steps.append(
                f"w{n + 1} as materialized (select w.source, w.lang, w.topic, w.tokens, w.weight * case when s.mass > 0 then coalesce(t.share, 0) * (select total from total) / s.mass else 0 end weight from w{n} w join s{n} s on w.{m} = s.{m} left join t_{m} t on t.{m} = w.{m})"
            )
            n += 1
    steps.append("c0 as (select 0.0::double c)")
    for k in range(FILLS):
        steps.append(f"c{k + 1} as materialized (select ({BUDGET} * (select total from total) - sum(case when weight * c >= 1 then tokens else 0 end)) / sum(case when weight * c >= 1 then 0 else tokens * weight end) c from w{n}, c{k})")
    return (
        "with " + ",\n".join(steps) + f"\nselect doc_id, d.source, d.lang, d.topic, d.tokens, round(weight, {DIGITS}) weight, round(least(1.0, weight * c), {DIGITS}) probability,"
        f" ('0x' || substr(md5('mix' || doc_id), 1, 12))::bigint::double / {16**12}::double < round(least(1.0, weight * c), {DIGITS}) sampled"
        f" from d join w{n} w on d.source = w.source and d.lang = w.lang and d.topic = w.topic, c{FILLS}"
    )


ORACLE = _oracle()
