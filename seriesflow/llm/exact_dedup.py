"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of characters. Sorting the different blocks gives each an integer name.
Pairs of adjacent names are then named in the same way, again and again, until each document has one name. Two documents
of the same number of naming rounds have the same name only if their blocks are identical: names never rest on a hash.

Empty and null texts are one (empty) block and so copies of each other. Rows that repeat an id give one result row each, also
if the id is null, and are told apart by their text's SHA-256; a null id is a group's keeper only if no row of the group has an id. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, documents, fold_spaces

BLOCK_CHARS = 1024


def _name_blocks(blocks: DataFrame) -> DataFrame:
    """blocks(row, pos, h, block, sha) -> (row, pos, name, sha); h is a 64-bit hash of the block.

    Content is shuffled once, as different blocks by their hash. Where a hash has one content, which its smallest and
    largest block prove, occurrences find their name by the hash. Contents that share a hash are named and joined by content."""
    by_hash = blocks.groupBy("h").agg(F.min("block").alias("lo"), F.max("block").alias("hi"))
    named = by_hash.sortWithinPartitions("lo").select("h", (F.monotonically_increasing_id() * 2).alias("name"), (F.col("lo") != F.col("hi")).alias("shared"))
    named = cut(named, "block-names")
    out = blocks.select("row", "pos", "h", "sha").join(named.filter("not shared"), "h").select("row", "pos", "name", "sha")
    shared = named.filter("shared").select("h")
    if shared.isEmpty():
        return out
    clash = cut(blocks.join(shared, "h"), "clash")
    contents = clash.select("h", "block").distinct().sortWithinPartitions("block").select("h", "block", (F.monotonically_increasing_id() * 2 + 1).alias("name"))
    return out.unionByName(clash.join(cut(contents, "clash-names"), ["h", "block"]).select("row", "pos", "name", "sha"))


def _name_pairs(names: DataFrame) -> DataFrame:
    """names(row, pos, name) -> names of the pairs of adjacent names; an odd last name is paired with -1."""
    even = F.col("pos") % 2 == 0
    pairs = names.groupBy("row", F.expr("pos div 2").alias("pos")).agg(F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"))
    different = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions("a", "b").select("a", "b", F.monotonically_increasing_id().alias("name"))
    return pairs.join(cut(different, "pair-names"), ["a", "b"]).select("row", "pos", "name")


def identities(docs: DataFrame, id_col: str, text: Column, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, copies, text_sha256, rounds, name): rounds and name together identify the text; copies counts the rows of this id and text."""
    body = docs.select(F.col(id_col).alias("id"), text.alias("body"))
    # The hash tells texts of the same id apart; it takes no part in naming.
    body = body.select("id", "body", F.sha2("body", 256).alias("sha")).select(F.struct("id", F.unhex("sha").alias("salt")).alias("row"), "body", "sha")
    # One pass over the text, however long it is.
    cells = F.when(F.col("body") == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all("body", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0)))
    blocks = body.select("row", F.posexplode(cells).alias("pos", "block"), F.col("sha"))
    blocks = blocks.select("row", "pos", F.xxhash64("block").alias("h"), "block", F.when(F.col("pos") == 0, F.col("sha")).alias("sha"))
    level = cut(_name_blocks(blocks), "blocks")
    first = F.col("pos") == 0
    last = level.groupBy("row").agg(F.max("pos").alias("last"), F.max("sha").alias("sha"), F.max(F.when(first, F.col("name"))).alias("name"), F.count(F.when(first, 1)).alias("copies"))
    last = cut(last, "rows")
    longest = last.agg(F.max("last")).first()[0] or 0
    done = last.filter("last = 0").select("row", F.lit(0).alias("rounds"), "name")
    level = level.join(last.filter("last > 0").select("row"), "row", "left_semi").select("row", "pos", "name")
    rounds = 0
    while longest > 0:
        rounds += 1
        longest //= 2
        level = cut(_name_pairs(level), f"round-{rounds}")
        alone = level.groupBy("row").agg(F.max("pos").alias("last"), F.max("name").alias("name"))
        done = done.unionByName(alone.filter("last = 0").select("row", F.lit(rounds).alias("rounds"), "name"))
        level = level.join(alone.filter("last > 0").select("row"), "row", "left_semi")
    return last.select("row", "sha", "copies").join(done, "row").select(F.col("row.id").alias(id_col), "copies", F.col("sha").alias("text_sha256"), "rounds", "name")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: id, keep_id (smallest id of its group), group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of white space has become one space."""
    named = cut(identities(docs, id_col, fold_spaces(F.col(text_col)), block_chars), "identities")
    groups = named.groupBy("rounds", "name").agg(F.min(id_col).alias("group_id"), F.sum("copies").alias("group_rows"))
    # A table of its own: a skewed join can then be split.
    out = named.join(cut(groups.filter("group_rows > 1"), "groups"), ["rounds", "name"], "left")
    out = out.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    keep = F.coalesce("group_id", id_col)
    return out.select(id_col, keep.alias("keep_id"), F.coalesce("group_rows", F.lit(1)).cast("long").alias("group_size"), keep.eqNullSafe(F.col(id_col)).alias("kept"), "text_sha256")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


ORACLE = r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t from documents),
g as (select t, min(doc_id) keep_id, count(*) group_size from n group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from n join g using (t)
"""
