"""Secret scans: patterns, and sliding-window Shannon entropy per character class. DataFrame functions only.

Base kinds (whole matches, leftmost and not overlapping within a kind):
  assign  a password-like name, = or :, and a value of at least 6 characters
  access  AKIA with at least 16 more capitals or digits
  hex     at least 24 digits a-f and 0-9

Entropy: placeholder words are blanked first; candidate strings are runs of at least WINDOW base64 characters with a digit in
them. A window of WINDOW characters moves over a candidate; counts per character and the sum of c * log2(c) are updated by the one
character that enters and the one that leaves, so each step gives the entropy log2(WINDOW) - sum / WINDOW without counting anew. The
threshold depends on the candidate's character class (hex, one case with digits, mixed). Windows over the threshold that touch
join to spans. Candidates on the allow-list (identifiers of a fixed form) are left out, and so are spans that lie inside a base one.

Every step is linear in the text: running values are made in blocks, and long candidates are cut into pieces whose windows
overlap. A window that has the same entropy as the threshold counts. Extra columns are ignored. An empty table gives an empty result.
Null texts are empty and have no spans. Repeated rows give repeated results. Positions are code points, the end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents

ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA)([A-Z0-9]+)"
HEX = r"()([0-9a-f]{24,})"
#: kind, pattern, shortest second group that counts, shortest whole match that counts.
BASE_KINDS = (("assign", ASSIGN, 6, 0), ("access", ACCESS, 0, 20), ("hex", HEX, 24, 24))

WINDOW = 20
CANDIDATE = r"()([A-Za-z0-9+/_=-]{20,})"
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_="
#: Character class of a whole candidate, and the bits per character from which a window counts.
CLASSES = (("hex", r"\A(?:[0-9a-f]+|[0-9A-F]+)\z", 2.9), ("one case", r"\A(?:[a-z0-9+/_=-]+|[A-Z0-9+/_=-]+)\z", 3.6), ("mixed", r"", 3.75))
#: Words that stand for a secret; a candidate ends at them.
PLACEHOLDER = r"(?i)example|placeholder|your[_-]|x{6,}|0123456789|1234567890"
#: Candidates that are no secrets: without a digit, UUIDs, plain numbers and dates, paths of words.
ALLOW = (
    r"\A[^0-9]*\z",
    r"\A[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z",
    r"\A[0-9+/_=-]+\z",
    r"\A[a-z]++(?:[/_-][a-z]++)*+[/_-][0-9]{1,4}\z",
)
#: Arrays grow by at most so many elements at a time, as each step of a fold copies them.
BLOCK = 256
#: A count of a window takes 5 bits, and a word of counts 60.
PER_WORD = 12


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _blocks(values: Column) -> Column:
    """values in arrays of BLOCK elements."""
    starts = lambda v: F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
    return _let(values, lambda v: F.when(F.size(v) > 0, F.transform(starts(v), lambda b: F.slice(v, b * BLOCK + 1, BLOCK))).otherwise(F.array().cast("array<array<int>>")))


def running(values: Column, join: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """For each of an array of ints, what it and those before it join to. Blocks are folded each for itself, then joined with what came before, which is folded in the same way."""
    grow = lambda s, x: F.concat(s, F.array(F.coalesce(join(F.try_element_at(s, F.lit(-1)), x), x)))
    fold = lambda v: F.aggregate(v, F.array().cast("array<int>"), grow)
    if not levels:
        return fold(values)

    def joined(parts: Column) -> Column:
        before = running(F.transform(parts, lambda p: F.element_at(p, -1)), join, levels - 1)
        first = F.array(F.lit(None).cast("int"))
        pairs = F.arrays_zip(parts.alias("part"), F.slice(F.concat(first, before), 1, F.size(parts)).alias("before"))
        return F.flatten(F.transform(pairs, lambda x: F.transform(x["part"], lambda y: F.coalesce(join(x["before"], y), y))))

    return _let(F.transform(_blocks(values), fold), joined)


def _gaps(text: Column, pattern: str) -> Column:
    """array<struct<gap, whole>>: what lies before each match, and the match; the last has no match."""
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"))


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of a pattern's matches; value is the second group.

    What lies between matches and the matches themselves add up to positions."""
    sizes = F.transform(_gaps(text, pattern), lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("whole")))

    def placed(x: Column) -> Column:
        ends = running(F.transform(x, lambda y: y["gap"] + F.coalesce(y["whole"], F.lit(0))), lambda p, q: p + q)
        rows = F.arrays_zip(x.alias("size"), ends.alias("end"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("value"))
        hits = F.filter(rows, lambda y: y["size"]["whole"].isNotNull())
        return F.transform(hits, lambda y: F.struct((y["end"] - y["size"]["whole"]).alias("start"), y["end"].alias("end"), y["value"].alias("value")))

    return F.when(text.rlike(pattern), _let(sizes, placed)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def _blanked(text: Column, pattern: str) -> Column:
    """text with spaces in place of a pattern's matches."""
    parts = F.transform(_gaps(text, pattern), lambda x: F.concat(x["gap"], F.repeat(F.lit(" "), F.coalesce(F.length(x["whole"]), F.lit(0)))))
    return F.when(text.rlike(pattern), F.array_join(parts, "")).otherwise(text)


def _high(piece: Column, least: Column) -> Column:
    """array<int>: where in a piece the windows begin whose entropy is at least `least`."""
    kind = "struct<counts:array<bigint>,sum:double,high:array<int>>"
    words = len(SYMBOLS) // PER_WORD + 1
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), words).alias("counts"), F.lit(0.0).alias("sum"), F.array().cast("array<int>").alias("high")).cast(kind)
    weigh = lambda c: F.when(c > 1, c * F.log2(c)).otherwise(0.0)
    count = lambda counts, code: F.call_function("shiftright", F.get(counts, F.floor(code / PER_WORD).cast("int")), (code % PER_WORD) * 5).bitwiseAND(F.lit(31))
    one = lambda code, k: F.when(F.floor(code / PER_WORD) == k, F.call_function("shiftleft", F.lit(1).cast("long"), (code % PER_WORD) * 5)).otherwise(F.lit(0).cast("long"))

    def step(state: Column, x: Column) -> Column:
        enters, leaves, i = x["enters"], x["leaves"], x["i"]
        counts, still = state["counts"], enters == leaves
        into, out_of = count(counts, enters), F.when(leaves >= 0, count(counts, leaves)).otherwise(F.lit(0))
        gained = F.when(still, 0.0).otherwise(weigh(into + 1) - weigh(into))
        lost = F.when(still | (leaves < 0), 0.0).otherwise(weigh(out_of) - weigh(out_of - 1))
        moved = F.when(still, counts).otherwise(F.transform(counts, lambda c, k: c + one(enters, k) - F.when(leaves >= 0, one(leaves, k)).otherwise(F.lit(0).cast("long"))))
        total = state["sum"] + gained - lost
        # Rounding of sums of logarithms must not decide.
        over = (i >= WINDOW - 1) & (F.log2(F.lit(float(WINDOW))) - total / WINDOW >= least - 1e-9)
        high = F.when(over, F.concat(state["high"], F.array(i - (WINDOW - 1)))).otherwise(state["high"])
        return F.struct(moved.alias("counts"), total.alias("sum"), high.alias("high")).cast(kind)

    def moves(codes: Column) -> Column:
        gone = F.slice(F.concat(F.array_repeat(F.lit(-1), WINDOW), codes), 1, F.size(codes))
        return F.transform(F.arrays_zip(codes.alias("enters"), gone.alias("leaves")), lambda x, i: F.struct(x["enters"].alias("enters"), x["leaves"].alias("leaves"), i.alias("i")))

    return F.aggregate(_let(F.transform(F.split(piece, ""), _code), moves), start, step)["high"]


def _windows(value: Column, least: Column) -> Column:
    """array<struct<start, end>> within value: joined windows whose entropy is at least `least`."""
    # A piece has BLOCK windows; the next begins where its last one does, plus one.
    pieces = F.regexp_extract_all(value, F.lit(f"(?s)(?=(.{{1,{BLOCK + WINDOW - 1}}})).{{1,{BLOCK}}}"), F.lit(1))
    high = F.flatten(F.transform(pieces, lambda p, k: F.transform(_high(p, least), lambda i: k * BLOCK + i)))

    def spans(high: Column) -> Column:
        far = F.array(F.lit(None).cast("int"))
        before = F.arrays_zip(high.alias("at"), F.slice(F.concat(far, high), 1, F.size(high)).alias("next"))
        after = F.arrays_zip(high.alias("at"), F.slice(F.concat(high, far), 2, F.size(high)).alias("next"))
        alone = lambda x: x["next"].isNull() | (F.abs(x["next"] - x["at"]) > WINDOW)
        starts = F.transform(F.filter(before, alone), lambda x: x["at"])
        ends = F.transform(F.filter(after, alone), lambda x: x["at"] + WINDOW)
        return F.arrays_zip(starts.alias("start"), ends.alias("end"))

    return _let(high, spans)


def _code(c: Column) -> Column:
    """0 to len(SYMBOLS): the place of a character in SYMBOLS."""
    return F.call_function("locate", c, F.lit(SYMBOLS))


def entropy_spans(text: Column) -> Column:
    """array<struct<start, end>> of the text's spans of high entropy."""
    candidates = _let(_blanked(text, PLACEHOLDER), lambda t: F.filter(located(t, CANDIDATE), lambda x: ~_any(x["value"].rlike(p) for p in ALLOW)))

    def spans(x: Column) -> Column:
        least = F.coalesce(*(F.when(x["value"].rlike(p), F.lit(bits)) for _, p, bits in CLASSES))
        return F.transform(_let(least, lambda bits: _windows(x["value"], bits)), lambda w: F.struct((x["start"] + w["start"]).alias("start"), (x["start"] + w["end"]).alias("end")))

    return F.when(text.rlike(CANDIDATE), F.flatten(F.transform(candidates, spans))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def _outside(spans: Column, base: Column) -> Column:
    """spans that no base span holds: in order of start (base ones first), none of the ends so far is as far as a span's own."""
    row = lambda x, added: F.struct(x["start"].alias("start"), F.lit(int(added)).alias("added"), x["end"].alias("end"), x["kind"].alias("kind"))
    every = F.array_sort(F.concat(F.transform(base, lambda x: row(x, False)), F.transform(spans, lambda x: row(x, True))))

    def left(rows: Column) -> Column:
        reach = running(F.transform(rows, lambda x: F.when(x["added"] == 0, x["end"]).otherwise(-1)), lambda p, q: F.when(p > q, p).otherwise(q))
        kept = F.filter(F.arrays_zip(rows.alias("row"), reach.alias("reach")), lambda x: (x["row"]["added"] == 1) & (x["reach"] < x["row"]["end"]))
        return F.transform(kept, lambda x: F.struct(x["row"]["start"].alias("start"), x["row"]["kind"].alias("kind"), x["row"]["end"].alias("end")))

    return F.when(F.size(spans) > 0, _let(every, left)).otherwise(spans)


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in [*(x[0] for x in BASE_KINDS), "entropy"]))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _base_spans(text: Column, k: int, pattern: str, least: int, whole: int) -> Column:
    hits = F.filter(located(text, pattern), lambda x: (F.length(x["value"]) >= least) & (x["end"] - x["start"] >= whole))
    return F.transform(hits, lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end")))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_<kind> of each base kind, base_sha256, spans ("kind:start:end" by start, then kind)."""
    docs = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    text = F.col("__text")
    found = {}
    for k, (kind, pattern, least, whole) in enumerate(BASE_KINDS):
        found[kind] = _base_spans(text, k, pattern, least, whole)
    found["entropy"] = F.transform(entropy_spans(text), lambda x: F.struct(x["start"].alias("start"), F.lit(len(BASE_KINDS)).alias("kind"), x["end"].alias("end")))
    # Few texts have any of it: the rest pass one test each and go no further.
    some = _any(text.rlike(p) for p in [*(x[1] for x in BASE_KINDS), CANDIDATE])
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    docs = docs.select(id_col, *(F.when(some, v).otherwise(none).alias(f"__{k}") for k, v in found.items()))
    base = F.concat(*(F.col(f"__{k[0]}") for k in BASE_KINDS))
    docs = docs.withColumn("__base", base)
    docs = docs.withColumn("__added", _outside(F.col("__entropy"), F.col("__base")))
    added = F.col("__added")
    return docs.select(
        id_col, *(F.size(f"__{k[0]}").cast("long").alias(f"n_{k[0]}") for k in BASE_KINDS), F.sha2(_joined(F.col("__base")), 256).alias("base_sha256"), _joined(F.concat("__base", added)).alias("spans"), F.size(added).cast("long").alias("n_entropy")
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(documents(spark, sf_dir))
