"""Prefix trie, lexical search and licence scan on small tables with odd rows, against brute force or SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from seriesflow.llm import lexical_search as S
from seriesflow.llm import license_scan as V
from seriesflow.llm import prefix_trie as P

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# 11

TURNS = "conv_id long, turn long, role string, text string, d long, term string, id string, b long, rows string, ids string, near string, part long, at long"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2, "z", "i", "n", 3, 4) for r in rows], TURNS)


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = [*convs.get(c - int(math.fmod(c, 20)), [])[:h], *turns[h:]]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, of in members.items():
        own = (len(of) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own
    out = []
    for p, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(rebuilt[c]) == len(p))
        out.append((min(of), len(p), min(members[p[:-1]]) if p else None, len(of), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("band", [2, 8])
def test_trie_of_odd_conversations(spark, band):
    rng = random.Random(band)
    rows = [(c, t, rng.choice(("user", "bot", None)), rng.choice(("a b", "", None, "é c  d", " \n"))) for c in [*range(-45, 70), 1 << 60] for t in range(rng.randrange(7)) if c % 9]
    # A deep conversation and two that follow it for long; its rows come in several range partitions.
    deep = [(40 + k, t, "user", "deep " * 3) for k in (0, 1, 2) for t in range(150 if k else 170)]
    rows += deep + [(41, 150, "user", "other"), (61, None, "user", "null turn comes first"), (61, 3, "user", "tie b"), (61, 3, "user", "tie a"), (61, 3, "user", "tie a"), (None, 1, "user", "nobody"), (7, 100, "user", "long " * 100_000)]
    # Many equal conversations.
    rows += [(1000 + k, t, "user", f"same {t}") for k in range(60) for t in range(3)]
    rng.shuffle(rows)
    got = P.prefix_trie(P.rebuilt(turns_of(spark, rows)), band=band)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert P.prefix_trie(P.rebuilt(turns_of(spark, []))).count() == 0
    assert P.prefix_trie(P.rebuilt(turns_of(spark, [(None, 0, "user", "x")]))).count() == 0


def test_packs_of_ids_are_digested_in_order():
    import pyarrow as pa

    ids = list(range(0, 3 * P.PACK, 2))
    batch = pa.RecordBatch.from_arrays([pa.array([b"n"] * len(ids) + [b"o"], pa.binary()), pa.array([*ids, 5], pa.int64())], ["id", "conv_id"])
    packs = list(P._packed([batch]))
    assert packs[0].num_rows == 3
    got = [r for b in P._digested(packs) for r in b.to_pylist()]
    want = {b"n": ",".join(map(str, ids)), b"o": "5"}
    assert {r["id"]: r["ends_sha256"] for r in got} == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


# 12


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k=10):
    docs = [(i, terms(t)) for i, t in docs if terms(t)]
    n, length = len(docs), sum(len(t) for _, t in docs)
    df = Counter(t for _, ts in docs for t in set(ts))
    out = []
    for item, text in items:
        scored = []
        for i, ts in docs:
            tf, m = Counter(ts), 25 + 75 * len(ts) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in terms(text))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def random_docs(rng, n):
    vocabulary = [f"w{k}" for k in range(40)] + ["Éa", "ÉA", "x-y", "Z9"]
    return [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60), weights=[1 / (1 + j) for j in range(44)]))) for k in range(n)]


@pytest.mark.parametrize(("entries", "chars"), [(1 << 20, 4_000_000), (300, 150)])
def test_search_of_odd_documents(spark, entries, chars):
    rng = random.Random(entries)
    docs = random_docs(rng, 400)
    # Thirty copies, ties, nulls, repeated rows, ids that repeat with another text, texts without terms, a long one.
    docs += [(500 + k, "rare w1 w2 copies") for k in range(30)] + [(None, "rare w1"), (None, "rare w1 w2 copies"), (3, "rare w5"), (3, "rare w5"), (700, None), (701, ""), (702, " ,.; "), (703, "w3 w4 " * 60_000 + "unique")]
    items = [(k, t) for k, t in random_docs(rng, 12)] + [(50, "rare copies"), (50, "w1 w1 W1 w2"), (None, "rare"), (51, None), (52, " .."), (53, "nowhere"), (54, "unique w3")]
    d = spark.createDataFrame([(*x, "c", 1, "t", 2) for x in docs], "doc_id long, text string, codes string, n long, tfs string, score long").repartition(3)
    i = spark.createDataFrame([(*x, 1, "s") for x in items], "item_id long, text string, rank int, no string")
    got = S.search(d, i, entries=entries, block_chars=chars)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == brute_search(docs, items)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert S.search(none, item).count() == 0
    assert S.search(spark.createDataFrame([(1, "a")], "doc_id long, text string"), item.filter("false")).count() == 0


@pytest.mark.parametrize("leaf", [1, 8])
def test_trees_prune_and_lose_nothing(monkeypatch, leaf):
    """A tree whose nodes are split to the end, with many equal and nested vectors."""
    monkeypatch.setattr(S, "LEAF", leaf)
    rng = random.Random(leaf)
    vectors = [sorted(rng.sample(range(12), rng.randrange(1, 8))) for _ in range(300)]
    tfs = [[rng.choice((1, 1, 2, 5)) for _ in v] for v in vectors]
    ids, m = [None if k == 7 else k for k in range(300)], np.array([rng.choice((30, 100, 400)) for _ in vectors], np.int64)
    ptr = np.append(0, np.cumsum([len(v) for v in vectors]))
    tree = S.Tree(ids, m, np.concatenate(vectors).astype(np.int64), np.concatenate(tfs), ptr, 5)
    assert len(tree.lo) > 50
    visited = 0
    for _ in range(20):
        item = [(r, rng.randrange(0, 3000)) for r in rng.sample(range(14), 4)]
        weights, best = np.zeros(14, np.int64), []
        tree.search(item, weights, best, 5)
        w = dict(item)
        scores = [(sum(w.get(r, 0) * (10**9 * t // (1000 * t + 8 * int(x))) for r, t in zip(v, ts, strict=True)), -(S.NO_ID if i is None else i)) for i, v, ts, x in zip(ids, vectors, tfs, m, strict=True)]
        assert sorted(best) == sorted(sorted(s for s in scores if s[0] > 0)[-5:]) and not weights.any()
        visited += 1
    assert visited == 20


def test_terms_of_long_texts_are_whole():
    text = b" ".join(b"t%d" % (k % 1000) * (k % 7) for k in range(20_000)) + b"end"
    assert [t for part in S.terms_of(text, 100) for t in part] == text.split()
    assert S.FOLD == bytes(32 if c < 128 and not chr(c).isalnum() else c + 32 if 65 <= c <= 90 else c for c in range(256))


# 13


def scan_sql(docs):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    cur = con.execute(V.ORACLE)
    return [c[0] for c in cur.description], sorted(cur.fetchall(), key=str)


LABELS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def test_licenses_of_odd_documents(spark):
    full = {k: t for k, (_, t, _) in enumerate(V.TEMPLATES)}
    filler = "lorem ipsum dolor " * 30
    texts = [None, "", " .,;", "mit license", "MIT-License, the Apache\nLICENSE and the general  public license. mit license", "xmit license mit licenses mit licensé", "mit licenſe the MİT License"]
    texts += [filler + t + filler for t in full.values()] + [" ".join(full.values())]
    # Changed in places, without a key phrase, words in another order, or only some words.
    texts += [full[0].replace("obtaining a copy", "who obtains one or more copies"), full[0].replace("free of charge", "at no cost"), " ".join(reversed(full[7].split())), "software warranty copies permission", "4.0 by CC BY-NC 4.0 licensed"]
    # A long text: phrases over the border of pieces, and at its end.
    border = "a " * (V.PIECE // 2 - 1)
    texts += [border + "mit license " + border + filler + full[0], border[:-3] + "general public license", "é" * (V.PIECE + 5) + " mit license", "license " * 30_000]
    docs = [(k, t) for k, t in enumerate(texts)] + [(3, "mit license"), (3, "mit license"), (None, full[2])]
    d = spark.createDataFrame([(*x, 1, "h", "p") for x in docs], "doc_id long, text string, row long, hits string, parts string").repartition(4)
    got = V.licenses(d)
    names, want = scan_sql(docs)
    assert sorted(names) == sorted(LABELS)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == want
    by = {r[names.index("doc_id")]: r for r in want}
    of = lambda k, c: by[k][names.index(c)]
    assert of(4, "n_base") == 4 and of(4, "base_labels") == "apache,gpl,mit" and (of(4, "first_word"), of(4, "last_word")) == (0, 10)
    assert of(5, "n_base") == 0 and of(6, "n_base") == 0
    n = len(full)
    assert [of(7 + k, "labels").split(",") for k in range(n)] and all(V.TEMPLATES[k][0] in of(7 + k, "labels").split(",") for k in range(n))
    assert of(7 + n + 1, "labels") == "mit" and of(7 + n + 2, "labels") == "" and of(7 + n + 3, "labels") == "" and of(7 + n + 4, "labels") == ""


def test_licenses_of_nothing(spark):
    assert V.licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert V.licenses(spark.createDataFrame([(1, "no such words")], "doc_id long, text string")).select("labels", "score").first() == ("", 0.0)


def test_the_license_scan_has_no_python_worker(spark, sf_dir):
    plan = V.op13_license_scan(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
