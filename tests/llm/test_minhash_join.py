"""MinHash join against all pairs, and the join's parts."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from telemark.llm import minhash_join as M
from telemark.llm import queries as Q

R = random.Random(3)


def text(n, pool=400):
    return " ".join(f"w{R.randrange(pool)}" for _ in range(n))


def edited(body, places):
    words = body.split()
    for p in places:
        words[p % len(words)] = f"x{R.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    line = text(30)
    base = text(120)
    out = [base, base.upper(), base + "\n", None, "", " \t", "one", "One", "two words", "a b c", "a b c d", text(20_000)]
    out += [edited(base, [R.randrange(120) for _ in range(R.randrange(7))]) for _ in range(60)]    # a group with outsiders
    chain = base
    for _ in range(25):                                                                           # each near the one before
        chain = edited(chain, [R.randrange(120), R.randrange(120)])
        out.append(chain)
    out += [text(R.randrange(5, 60)) + " " + line for _ in range(60)]                              # a line of many
    out += [edited(text(40), []) for _ in range(20)]
    return out


def expected(rows, k=4, percent=80):
    """{id: component} with rows of one id linked."""
    found = brute.groups({i: t for i, (_, t) in enumerate(rows)}, k, percent)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i, (doc, _) in enumerate(rows):
        if doc is not None and found[i][0]:
            root[find(("t", i))] = find(("t", found[i][1]))
            root[find(("d", doc))] = find(("t", i))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and found[i][0]:
            at = find(("d", doc))
            least[at] = min(doc, least.get(at, doc))
    return sorted(((doc is not None, doc or 0, found[i][0], (least[find(("d", doc))] if found[i][0] else doc) if doc is not None else None)
                   for i, (doc, _) in enumerate(rows)), key=str)


def got(frame):
    rows = frame.collect()
    assert all(r.kept == (r.doc_id == r.component_id if r.doc_id is not None else True) for r in rows)
    return sorted(((r.doc_id is not None, r.doc_id or 0, r.n_shingles, r.component_id) for r in rows), key=str)


def test_awkward_rows(spark, texts):
    rows = list(enumerate(texts)) + [(0, texts[0]), (5, "five is two texts"), (5, "w1 w2 w3 w4 and more of it"), (200, "w1 w2 w3 w4 and more of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(None).cast("string") for c in ("id", "key", "n", "sig", "comp", "kept", "component_id")}).repartition(4)
    assert got(M.near_duplicates(docs, k=4)) == expected(rows)
    assert M.near_duplicates(docs.filter("false")).count() == 0
    alone = spark.createDataFrame([(None, texts[0]), (None, None), (7, texts[0])], "doc_id long, text string")
    assert [tuple(r)[2:] for r in M.near_duplicates(alone).orderBy("doc_id").collect()] == [(None, True), (None, True), (7, True)]


def test_small_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(M.N, "BLOCK_SETS", 7)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(M.near_duplicates(docs, k=4)) == expected(rows)


def test_signatures_estimate_similarity():
    g = np.random.default_rng(1)
    one = g.integers(1, 1 << 63, 4000, dtype=np.uint64)
    for common in (3800, 3000, 500):
        two = np.concatenate([one[:common], g.integers(1, 1 << 63, 4000 - common, dtype=np.uint64)])
        sig = M.signatures(np.concatenate([one, two]), np.array([0, 4000, 8000]))
        assert abs((sig[0] == sig[1]).mean() - common / (8000 - common)) < 0.2
    assert len(np.unique(sig)) == 2 * M.COORDINATES - int((sig[0] == sig[1]).sum())
    assert M.signatures(one, np.array([0, 0, 4000, 4000])).shape == (1, M.COORDINATES)


def test_threshold_loses_next_to_nothing():
    from math import comb
    missed = sum(comb(M.COORDINATES, i) * 0.8**i * 0.2 ** (M.COORDINATES - i) for i in range(M.MATCHES))
    assert missed < 2e-5


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert got(Q.queries()["op11_minhash_dedup"](spark, "/root/testdata/sf0.01")) == expected(rows)
