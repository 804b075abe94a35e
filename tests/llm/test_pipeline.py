"""The pipeline's stages, each against a brute-force version on its own input."""

import re

import pytest

import corpus_pipeline as P
from seriesflow.llm import decontamination, quality_classifier
from seriesflow.llm.registry import ORACLES, QUERIES
from tests.test_queries import compare, duck  # noqa: F401

from .test_operators import brute_classes, brute_edits, brute_lines

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):  # noqa: F811
    compare(spark, duck, DIR, QUERIES[name], ORACLES[name])


def has_leak(text, item):
    """Whether text has the item within its budget of edits, by brute force where a common run of letters allows it at all."""
    fold = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    text, item = fold(text), fold(item).strip(" ")
    budget = max(0, min(int(decontamination.RATE * len(item)), (len(item) - decontamination.Q) // decontamination.Q))
    # Of budget + 1 equal pieces of the item, one is free of edits.
    size = len(item) // (budget + 1)
    near = any(item[k * size : (k + 1) * size] in text for k in range(budget + 1))
    return near and brute_edits(item, text) <= budget


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    seen = {"": docs}
    for name, stage in P.STAGES:
        docs = stage(spark, docs, DIR)
        docs.write.parquet(str(tmp_path / name))
        docs = seen[name] = spark.read.parquet(str(tmp_path / name))
        assert docs.columns[: len(columns)] == columns
    text = {name: {r.doc_id: r.text for r in df.collect()} for name, df in seen.items()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in text["quality"] for d in good) >= 0.97 * len(good)
    # The smallest table has some sixty labelled training rows; test_quality_on_held_out_rows looks at a larger one.
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in text["quality"] for d in bad) <= 0.6 * len(bad)
    assert text["lines"] == {i: t for i, _, _, t in brute_lines(sorted(text["quality"].items()))}
    kept = {i for i, _, c in brute_classes(sorted(text["lines"].items()), 5, 80, 100) if c == i}
    assert set(text["near_duplicates"]) == kept
    items = [r.text for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    leaked = {i for i, t in text["near_duplicates"].items() if any(has_leak(t, x) for x in items)}
    assert leaked and set(text["benchmark"]) == set(text["near_duplicates"]) - leaked
    assert set(text["mixing"]) <= set(text["benchmark"])
    sampled = sum(len(t.split()) for t in text["mixing"].values()) / sum(len(t.split()) for t in text["benchmark"].values())
    assert sampled == pytest.approx(0.8, abs=0.15)


CLASHES = {"score": "s", "n_lines": 1, "n_dropped": 2, "kept_text": "k", "weight": 7.0, "probability": 8.0, "id": 3, "h": 4, "tokens": 5, "__key": 6, "component_id": 9}


def odd_docs(spark, rows):
    kinds = ", ".join(f"{c} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}" for c, v in CLASHES.items())
    return spark.createDataFrame([(*r, *CLASHES.values()) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {kinds}")


def test_odd_rows_and_clashing_columns_pass_through(spark):
    docs = odd_docs(spark, [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "A text of a few words.", "en", "s", 22), (2, "A text of a few words.", "en", "s", 22), (3, "word " * 50_000, "en", "s", 250_000)])
    columns = docs.columns
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, DIR)
        assert docs.columns == columns
    assert docs.count() >= 1
    last = P.STAGES[-1][1](spark, docs, DIR)
    assert sorted(last.columns) == sorted([*columns, "topic"])
    assert quality_classifier.THRESHOLD == 0.3
    empty = odd_docs(spark, [])
    for _, stage in P.STAGES:
        empty = stage(spark, empty, DIR)
    assert empty.count() == 0


def test_rows_that_share_an_id(spark):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(2, text(0)), (2, text(0)), (3, text(0)), (4, text(1)), (4, text(2)), (5, text(1)), (None, text(2)), (None, text(3)), (None, text(3)), (6, text(4))]
    docs = odd_docs(spark, [(i, t, "en", "s", len(t)) for i, t in rows])
    got = sorted((tuple(r) for r in P.near_duplicates(spark, docs, DIR).select("doc_id", "text").collect()), key=str)
    # One row of each text; those whose id is theirs alone come first.
    assert sorted(t for _, t in got) == sorted(text(k) for k in range(5))
    assert {(3, text(0)), (5, text(1)), (6, text(4))} <= set(got)
    item = spark.read.parquet(f"{DIR}/benchmark.parquet").first().text
    rows = [(7, item), (7, text(5)), (None, "x " + item), (None, text(6)), (8, text(7))]
    docs = odd_docs(spark, [(i, t, "en", "s", len(t)) for i, t in rows])
    assert sorted(r.text for r in P.benchmark(spark, docs, DIR).collect()) == sorted(text(k) for k in (5, 6, 7))
