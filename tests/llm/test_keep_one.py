"""Near copies go row by row, whatever ids rows share."""
import random

import numpy as np
import pytest

import brute
from telemark.llm import ngram_join as N

R = random.Random(8)
B, C, D, E = (" ".join(f"{x}{R.randrange(90)}" for _ in range(40)) for x in "bcde")
FIVE = "doc_id long, text string, source string"


def test_other_texts_of_an_id_stay(spark):
    rows = [(1, B, "p"), (2, B, "q"), (2, C, "r"), (3, D, "s"), (3, E, "t")]
    for parts in (1, 3):
        docs = spark.createDataFrame(rows, FIVE).repartition(parts)
        assert sorted(map(tuple, N.keep_one(docs).collect())) == [rows[0], *rows[2:]]


def test_repeated_rows_and_nulls(spark):
    rows = [(1, B, "p"), (1, B, "p"), (1, B, "a"), (None, B, "n"), (None, B, "n"), (4, None, "x"), (4, None, "x"), (5, " ", "y")]
    kept = [tuple(r) for r in N.keep_one(spark.createDataFrame(rows, FIVE).repartition(4)).collect()]
    assert sum(r[0] == 1 for r in kept) == 1 and sum(r[0] is None for r in kept) == 2
    assert sum(r[0] == 4 for r in kept) == 2 and sum(r[0] == 5 for r in kept) == 1


def test_rows_of_one_id_share_a_component(spark):
    rows = [(1, B), (2, B), (2, C), (3, C), (4, D)]
    found = {tuple(r) for r in N.link(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 4)}


@pytest.mark.parametrize("percent", [80, 90])
def test_signatures_of_short_sparse_and_long_sets(percent):
    r = random.Random(percent + 1)
    for turn in range(1500):
        n = r.choice([1, 2, 3, 4, 5, 7, 8, 15, 16, 31, 33, 64, 127, 130, 255, 257, 900])
        # Crowded sets lie in a narrow part of the order and leave most fragments empty.
        draw = (lambda: r.getrandbits(64)) if turn % 2 else (lambda: r.getrandbits(52) | r.getrandbits(3) << 61)
        one = {draw() for _ in range(n)}
        most = N.allowed(len(one), percent)
        gone = r.randint(0, most)
        two = set(r.sample(sorted(one), len(one) - gone)) | {draw() for _ in range(r.choice([0, most - gone]))}
        both = len(one & two)
        if not two or 100 * both < percent * (len(one) + len(two) - both):
            continue
        values = np.array(sorted(one) + sorted(two), dtype=np.uint64)
        rows, sig = N.signatures(values, np.array([0, len(one), len(values)]), percent)
        assert set(sig[rows == 0].tolist()) & set(sig[rows == 1].tolist())


def test_chain_of_near_copies_at_80_percent(spark):
    words = [f"w{R.randrange(10**6)}" for _ in range(120)]
    chain = []
    for i in range(1500):
        words[R.randrange(120)] = f"n{i}"
        chain.append((i, " ".join(words)))
    docs = spark.createDataFrame(chain, "doc_id long, text string")
    assert {r.component_id for r in N.link(docs, k=5, percent=80).collect()} == {0}
    assert N.link(docs, k=5, percent=80).first()["n_shingles"] == len(brute.shingles(chain[0][1], 5))
