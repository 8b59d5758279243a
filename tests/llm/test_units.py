"""The parts that run inside tasks, against plain Python."""
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from telemark.llm import bytewords as BW
from telemark.llm import decontaminate as D
from telemark.llm import ngram_join as N
from telemark.llm import packing, toxicity, transcripts
from telemark.llm.neighbours import Forest, nearest, visits

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ é\n\t.1\x00ñ", max_size=60)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_and_shingles(rows):
    for table, pattern in ((BW.ALNUM, brute.ALNUM), (BW.NONBLANK, brute.NONBLANK)):
        found = BW.words(pa.array(rows, pa.string()), table)
        want = [pattern.findall(brute.fold(t)) for t in rows]
        assert np.diff(found.bounds).tolist() == [len(w) for w in want]
        names = {}
        for word, h in zip((w for ws in want for w in ws), found.hashes.tolist()):
            assert names.setdefault(word, h) == h
        assert len(set(names.values())) == len(names)
    found = BW.words(pa.array(rows, pa.string()), BW.NONBLANK)
    _, cut = BW.shingle_sets(found, 3)
    assert np.diff(cut).tolist() == [len(brute.shingles(t, 3)) for t in rows]


def test_shards_keep_every_row_and_slices_agree():
    rows = ["ab cd " * n if n % 7 else None for n in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], ["text"])
    parts = list(BW.shards([batch, batch.slice(0, 0)], "text", 100))
    assert [t for p in parts for t in p.column(0).to_pylist()] == rows
    whole = BW.words(batch.column(0), BW.ALNUM).hashes.tolist()
    assert [h for p in parts for h in BW.words(p.column(0), BW.ALNUM).hashes.tolist()] == whole


@pytest.mark.parametrize("seed", range(60))
def test_suffix_array_search(seed):
    r = random.Random(seed)
    word = lambda: r.choice("a b c d".split() if seed % 2 else [f"w{i}" for i in range(40)])
    docs = [" ".join(word() for _ in range(r.choice([0, 1, 5, 60]))) for _ in range(12)] + [None, ""]
    items = [(i, " ".join(word() for _ in range(r.choice([0, 1, 2, 4, 9])))) for i in range(6)]
    items += [(6, " ".join((docs[0] or "").split()[:5])), (7, None)]
    tests = D.TestSet([str(i) for i, _ in items], [t for _, t in items], 4)
    counts, masks, best = D.search_shard(pa.array(docs, pa.string()), tests)
    for text, n, mask, found in zip(docs, counts, masks, best):
        n_words, n_hit, n_items, _ = brute.contamination(text, items, 4)
        assert (n, int(mask.sum()), len(found)) == (n_words, n_hit, n_items)
        words = brute.ALNUM.findall(brute.fold(text))
        for item, (a, b, size) in found.items():
            other = brute.ALNUM.findall(brute.fold(dict((str(i), t) for i, t in items)[item]))
            assert words[b: b + size] == other[a: a + size]
            longest = max((k for k in range(1, len(other) + 1) for i in range(len(other) - k + 1) for j in range(len(words) - k + 1)
                           if other[i: i + k] == words[j: j + k]), default=0)
            assert size == longest


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_a_signature(percent):
    r = random.Random(percent)
    for _ in range(300):
        n = r.choice([1, 2, 3, 5, 9, 20, 63, 64, 127, 128, 129, 400])
        one = {r.getrandbits(64) for _ in range(n)}
        two = set(r.sample(sorted(one), n - r.randint(0, max(0, N.allowed(n, percent) // 2))))
        two |= {r.getrandbits(64) for _ in range(r.randint(0, N.allowed(n, percent) // 2))}
        both = len(one & two)
        if 100 * both < percent * (len(one) + len(two) - both) or not two:
            continue
        values = np.array(sorted(one) + sorted(two), dtype=np.uint64)
        rows, sig = N.signatures(values, np.array([0, len(one), len(values)]), percent)
        assert set(sig[rows == 0].tolist()) & set(sig[rows == 1].tolist())


def test_block_links_span_what_is_linked():
    r = random.Random(5)
    base = [r.getrandbits(60) for _ in range(60)]
    sets = [sorted({*r.sample(base, 60 - r.randint(0, 8)), *(r.getrandbits(60) for _ in range(r.randint(0, 3)))}) for _ in range(40)]
    keys = np.arange(2, 82, 2)
    items = [np.array(s, dtype=np.int64) for s in sets]
    for part in (np.zeros(40, dtype=np.int64), np.arange(40) % 2):
        want = {i: i for i in range(40)}

        def find(x, root=want):
            while root[x] != x:
                x = root[x]
            return x
        for a in range(40):
            for b in range(a):
                if part.any() and part[a] == part[b]:
                    continue
                both = len(set(sets[a]) & set(sets[b]))
                if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    want[y] = x
        got = {i: i for i in range(40)}
        links = N.block_links(keys, part, items, 90)
        assert len(links) < 40
        for a, b in links:
            x, y = sorted((find(a // 2 - 1, got), find(b // 2 - 1, got)))
            got[y] = x
        assert [find(i) for i in range(40)] == [find(i, got) for i in range(40)]


@pytest.mark.parametrize("seed", range(80))
def test_best_fit(seed):
    r = random.Random(seed)
    n, capacity = r.randint(0, 120), r.choice([5, 50, 300])
    sizes = sorted((r.randint(1, capacity) for _ in range(n)), reverse=bool(seed % 2))
    sources = [r.choice([None, "a", "a", "a", "b", "c", "d"]) for _ in range(n)]
    clusters = [r.choice([None, 1, 2, 3, *range(10, 60)]) for _ in range(n)]
    assert packing.best_fit(sizes, sources, clusters, capacity) == brute.best_fit(sizes, sources, clusters, capacity)


def test_chain_feeds_earlier_probabilities():
    """The second label equals the first; its own features are useless, so only the chain can learn it."""
    r = np.random.default_rng(1)
    y = r.integers(0, 2, 600)
    column = pa.array([f"{'bad' if a else 'good'} w{i % 50}" for i, a in enumerate(y)])
    rows, feats = toxicity.features(column)
    pair = np.unique((rows << toxicity.FEATURE_BITS) | feats)
    rows, feats = pair >> toxicity.FEATURE_BITS, pair & ((1 << toxicity.FEATURE_BITS) - 1)
    models = toxicity.fit_chain(np.bincount(rows), feats, r.integers(0, 3, 600), np.column_stack([y, y]))
    assert models[1].earlier[0] > 0.5
    p = toxicity.probabilities(pa.array(["bad x", "good x", None, ""]), models)
    assert p[0].min() > 0.5 > p[1].max() and np.isfinite(p).all()


def test_one_kind_of_label_gives_its_share():
    models = toxicity.fit_chain(np.array([1, 1]), np.array([3, 4]), np.array([0, 1]), np.array([[0], [0]]))
    assert 0 <= toxicity.probabilities(pa.array(["x"]), models)[0, 0] < 0.5


def test_tree_of_matrices_equals_plain_viterbi():
    r = np.random.default_rng(3)
    k, lengths = 4, np.array([1, 7, 130, 3])
    steps = np.log(r.random((lengths.sum(), k, k)))
    entry = np.log(r.random((len(lengths), k)))
    whole = transcripts.best_paths(steps, lengths, entry, np.full(len(lengths), -1))
    first = np.cumsum(lengths) - lengths
    folded = transcripts.combine(steps, lengths)
    for s in range(len(lengths)):
        # Best total score by brute recursion.
        score = entry[s]
        for t in range(lengths[s]):
            score = (score[:, None] + steps[first[s] + t]).max(0)
        assert np.allclose(score, (entry[s][:, None] + folded[s]).max(0))
        path = whole[first[s]: first[s] + lengths[s]]
        assert path[-1] == score.argmax()


def test_forest_queue_and_exact_scores():
    r = np.random.default_rng(2)
    x = r.normal(size=(400, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = Forest(x.astype(np.float32), trees=3, depth=3)
    leaf = forest.route(x.astype(np.float32))
    cost = forest.queue(x[:5].astype(np.float32))
    assert all(cost[i, leaf[i]].max() == 0 for i in range(5))
    sizes = np.bincount(leaf.ravel(), minlength=24)
    query, taken = visits(cost, sizes, 24, 0)
    assert len(query) == 5 * (sizes > 0).sum()
    ids = np.arange(400)
    for i, (found, score) in enumerate(nearest(ids, x, ids[:5], x[:5], 7)):
        s = x @ x[i]
        s[i] = -9
        want = np.lexsort((ids, -s))[:7]
        assert found.tolist() == want.tolist() and np.allclose(score, s[want])
    same = np.ones((50, 2))
    (found, _), = nearest(np.arange(50)[::-1], same, np.array([3]), same[:1], 5)
    assert found.tolist() == [0, 1, 2, 4, 5]


def test_safe_boundaries():
    from telemark.llm.token_counts import split_text
    r = random.Random(4)
    for _ in range(300):
        text = "".join(r.choice("ab  ▁\n") for _ in range(r.randint(0, 80)))
        parts = split_text(text, 5)
        assert " ".join(parts) == text
        assert all(not re.match(r"[ ▁]", p) for p in parts[1:])


def test_parity_bits_never_hide_a_link():
    r = np.random.default_rng(6)
    base = r.integers(0, 1 << 63, 700).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for n in (1, 5, 63, 64, 65, 129, 500):
        for m in {n, max(1, n - 1), max(1, int(n * 0.9)), max(1, n // 2)}:
            for shift in (0, n // 10, n // 3):
                one, two = np.sort(base[:n]), np.sort(base[shift: shift + m])
                x, y = N.parity_bits(np.concatenate([one, two]), np.array([0, n, n + m]))
                words = min(len(x), len(y))
                apart = int(N._bit_count(N.folded(x[None], words) ^ N.folded(y[None], words)).sum())
                different = len(set(one.tolist()) ^ set(two.tolist()))
                assert apart <= different and (different - apart) % 2 == 0
                alive = N.survivors(np.array([2, 4]), np.zeros(2, np.int64), np.array([n, m]), np.array([2, 4]), [x, y], 80)
                both = (n + m - different) / 2
                assert alive.all() or 100 * both < 80 * (n + m - both)
