"""The fit reads the (row, feature) pairs in pieces: its memory is a few bytes a pair."""
import tracemalloc

import numpy as np

from telemark.llm import toxicity as TX


def test_fit_copies_only_pairs_of_chosen_features(monkeypatch):
    monkeypatch.setattr(TX, "PIECE", 1 << 16, raising=False)
    docs, each = 4000, 1500
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, (docs, 2)).astype(np.int32)
    feats = rng.integers(100, 1 << TX.FEATURE_BITS, (docs, each), dtype=np.int32)
    feats[:, 0], feats[:, 1] = labels[:, 0], 10 + labels[:, 1]
    lengths, folds = np.full(docs, each, np.int32), np.arange(docs) % TX.FOLDS
    feats = feats.ravel()
    tracemalloc.start()
    models = TX.fit_chain(lengths, feats, folds, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [set(want) <= set(m.chosen) for want, m in zip(((0, 1), (10, 11)), models)] == [True, True]
    assert peak < 24 * len(feats)
