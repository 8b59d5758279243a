"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another: the model of a category sees the text's
features and the probabilities of all earlier categories. In training those are
out-of-fold predictions (each row's come from models that did not see the row), so a
later model meets them as they will be at scoring.

Features are presences, hashed to FEATURE_BITS bits: words (A-Z lower-cased runs of
letters, digits and characters beyond ASCII), their first 4, 5 and 6 bytes if they are
longer, and classes of symbol share, repetition and length. Each category keeps the
features that the training rows tie to it beyond chance (Z_MIN), at most KEPT of them.

Training takes at most SAMPLE_ROWS labelled documents, those with the smallest hash of
their id: a documented bound, so the fit costs the same at any size. Scoring reads every
whole text once and shuffles nothing; the models (KEPT numbers per category) are sent to
the tasks.

Labels are 1, 0 or null (not used for that category). Without labelled rows of both kinds
a category is predicted by its share in the sample. Null, empty and very long texts are
scored like all others. Repeated label rows of an id count once (the largest label).
Columns of `docs` with the name of a result are replaced, all others are kept on request.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemark.llm import bytewords as BW
from telemark.llm.tables import restrict, stored

SAMPLE_ROWS = 16_000
FEATURE_BITS = 20
KEPT = 8192
Z_MIN = 4.5
FOLDS = 3
THRESHOLD = 0.5
PREFIXES = (4, 5, 6)
PIECE = 1 << 20  # (row, feature) pairs of the fit that are worked on at once


def features(column) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs of a text column, repeats included."""
    found = BW.words(column, BW.ALNUM)
    rows, n = found.rows(), len(found.bounds) - 1
    counts = np.diff(found.bounds)
    out_rows, out = [rows], [found.hashes]
    for size in PREFIXES:
        h = found.prefixes(size)
        longer = h != 0
        out_rows.append(rows[longer])
        out.append(h[longer] + np.uint64(size))
    _, offsets = BW.utf8(column)
    size = np.diff(offsets)
    lengths = np.bincount(rows, weights=found.ends - found.starts, minlength=n)
    symbols = np.where(size > 0, 1 - lengths / np.maximum(size, 1), 0)
    half = np.bincount(rows, weights=(found.hashes & np.uint64(0xFFF)) == 0, minlength=n)  # 1 word in 4096
    classes = (np.minimum(symbols * 20, 19).astype(np.int64), np.log2(counts + 1).astype(np.int64),
               np.minimum(half, 7).astype(np.int64))
    for kind, value in enumerate(classes):
        out_rows.append(np.arange(n))
        out.append(BW.mix(value.astype(np.uint64) + np.uint64(1000 * (kind + 1))))
    return np.concatenate(out_rows), (np.concatenate(out) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Linear:
    """Logistic regression on a few chosen presences and the earlier probabilities."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray, earlier: np.ndarray, bias: float):
        self.chosen, self.weights, self.earlier, self.bias = chosen, weights, earlier, bias

    def probability(self, rows: np.ndarray, feats: np.ndarray, n: int, before: np.ndarray) -> np.ndarray:
        """`rows, feats` are distinct pairs; `before` holds a column per earlier category."""
        place = np.searchsorted(self.chosen, feats)
        if len(self.chosen):
            place = np.minimum(place, len(self.chosen) - 1)
            have = self.chosen[place] == feats
        else:
            have = np.zeros(len(feats), bool)
        margin = np.bincount(rows[have], weights=self.weights[place[have]], minlength=n) + self.bias
        return _sigmoid(margin + before @ self.earlier)


def _pieces(n: int) -> Iterator[slice]:
    for begin in range(0, n, PIECE):
        yield slice(begin, min(begin + PIECE, n))


def choose(rows: np.ndarray, feats: np.ndarray, use: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The features whose share of positive rows differs from the overall share beyond chance,
    among the rows in `use`."""
    size = 1 << FEATURE_BITS
    total, good = np.zeros(size), np.zeros(size)
    mine, positive = use.astype(float), use * y.astype(float)
    for part in _pieces(len(feats)):
        r, f = rows[part], feats[part].astype(np.int64)
        total += np.bincount(f, weights=mine[r], minlength=size)
        good += np.bincount(f, weights=positive[r], minlength=size)
    share = y[use].astype(float).mean() if use.any() else 0.0
    spread = np.sqrt(np.maximum(total * share * (1 - share), 1e-9))
    z = np.where(total >= 3, np.abs(good - total * share) / spread, 0)
    best = np.argsort(-z, kind="stable")[:KEPT]
    return np.sort(best[z[best] >= Z_MIN])


def entries(rows: np.ndarray, feats: np.ndarray, use: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows in `use` and chosen features, both by their number among these."""
    place = np.full(1 << FEATURE_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    number = (np.cumsum(use) - 1).astype(np.int32)
    out_rows, out = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for part in _pieces(len(feats)):
        r, c = rows[part], place[feats[part]]
        have = use[r] & (c >= 0)
        out_rows.append(number[r[have]])
        out.append(c[have])
    return np.concatenate(out_rows), np.concatenate(out)


def fit(rows: np.ndarray, feats: np.ndarray, use: np.ndarray, y: np.ndarray, before: np.ndarray, steps: int = 150) -> Linear:
    """The model of the rows in `use`. All pairs are read in pieces; only those of chosen
    features are copied."""
    n = int(use.sum())
    known, before = y[use].astype(float), before[use]
    share = float(known.mean()) if n else 0.0
    bias = float(np.log((share * n + 0.5) / ((1 - share) * n + 0.5)))
    earlier = np.zeros(before.shape[1])
    if not 0 < share < 1:
        return Linear(np.zeros(0, np.int64), np.zeros(0), earlier, bias if n else -10.0)
    chosen = choose(rows, feats, use, y)
    r, c = entries(rows, feats, use, chosen)
    k = len(chosen)
    theta = np.zeros(k + before.shape[1] + 1)
    theta[-1] = bias
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        margin = np.bincount(r, weights=theta[c], minlength=n) + before @ theta[k:-1] + theta[-1]
        error = (_sigmoid(margin) - known) / n
        slope = np.concatenate([np.bincount(c, weights=error[r], minlength=k), before.T @ error, [error.sum()]])
        slope[:-1] += 1e-5 * theta[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        theta -= 0.1 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    return Linear(chosen, theta[:k], theta[k:-1], float(theta[-1]))


def gathered(lists: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and items of all lists, one after another."""
    lengths = [np.diff(np.asarray(x.offsets)) for x in lists]
    return np.concatenate(lengths), np.concatenate([np.asarray(x.flatten(), dtype=np.int32) for x in lists])


def fit_chain(lengths: np.ndarray, feats: np.ndarray, folds: np.ndarray, labels: np.ndarray) -> list[Linear]:
    """One model per label column (values 1, 0, -1 for unknown) in order."""
    n = len(lengths)
    rows = np.repeat(np.arange(n, dtype=np.int32), lengths)
    before = np.zeros((n, 0))
    models = []
    for j in range(labels.shape[1]):
        y = labels[:, j]
        known = y >= 0
        unseen = np.zeros(n)
        for f in range(FOLDS):
            model = fit(rows, feats, known & (folds != f), y, before)
            held = folds == f
            r, c = entries(rows, feats, held, model.chosen)
            unseen[held] = model.probability(r, model.chosen[c], int(held.sum()), before[held])
        models.append(fit(rows, feats, known, y, before))
        before = np.column_stack([before, unseen])
    return models


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str], id_col: str = "doc_id",
          text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Linear]:
    """Fit the chain on at most `sample_rows` labelled documents."""
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        *(F.max(F.col(c).cast("int")).alias(f"y{j}") for j, c in enumerate(categories)))
    sample = stored(marks.orderBy(F.xxhash64("id"), "id").limit(sample_rows), "sample")
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in BW.shards(batches, "text"):
            rows, feats = features(part.column(1))
            pair = np.unique((rows << FEATURE_BITS) | feats)
            bounds = np.searchsorted(pair >> FEATURE_BITS, np.arange(part.num_rows + 1))
            items = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array((pair & ((1 << FEATURE_BITS) - 1)).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), items], ["id", "feats"])

    got = restrict(slim, sample, "id").mapInArrow(extract, f"id {kind}, feats array<int>")
    # Repeated documents of an id count once, so the bound holds.
    rows = got.dropDuplicates(["id"]).join(sample, "id").select(
        "feats", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"),
        *(F.coalesce(f"y{j}", F.lit(-1)).alias(f"y{j}") for j in range(len(categories))), F.xxhash64("id").alias("h"), "id")
    names = [f"y{j}" for j in range(len(categories))]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, others = [], []
        for batch in batches:
            lists.append(batch.column("feats"))
            others.append(batch.select(["fold", *names]))
        if not sum(map(len, lists)):
            return
        lengths, feats = gathered(lists)
        lists.clear()
        table = pa.Table.from_batches(others)
        marks = np.column_stack([np.asarray(table[n]) for n in names])
        for j, m in enumerate(fit_chain(lengths, feats, np.asarray(table["fold"]), marks)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([j]), pa.array([m.chosen.tolist()], pa.list_(pa.int64())), pa.array([m.weights.tolist()], pa.list_(pa.float64())),
                 pa.array([m.earlier.tolist()], pa.list_(pa.float64())), pa.array([m.bias])],
                ["category", "chosen", "weights", "earlier", "bias"])

    fitted = rows.repartition(1).sortWithinPartitions("h", "id").mapInArrow(
        learn, "category long, chosen array<long>, weights array<double>, earlier array<double>, bias double").collect()
    models = {r.category: Linear(np.array(r.chosen, np.int64), np.array(r.weights), np.array(r.earlier), r.bias) for r in fitted}
    return [models.get(j, Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(j), -10.0)) for j in range(len(categories))]


def probabilities(column, models: Sequence[Linear]) -> np.ndarray:
    """A column per category."""
    rows, feats = features(column)
    n = len(column)
    wanted = np.zeros(1 << FEATURE_BITS, dtype=bool)
    for m in models:
        wanted[m.chosen] = True
    keep = wanted[feats]
    pair = np.unique((rows[keep] << FEATURE_BITS) | feats[keep])
    rows, feats = pair >> FEATURE_BITS, pair & ((1 << FEATURE_BITS) - 1)
    before = np.zeros((n, 0))
    for m in models:
        before = np.column_stack([before, m.probability(rows, feats, n, before)])
    return before


def score(docs: DataFrame, models: Sequence[Linear], categories: Sequence[str], keep: Sequence[str],
          text_col: str = "text") -> DataFrame:
    """The columns `keep` of every document and p_<category> for each category."""
    names = [f"p_{c}" for c in categories]
    keep = [c for c in keep if c not in names]
    carry = docs.select(*keep, F.col(text_col).alias("_tm_text"))
    out = T.StructType([*carry.schema.fields[:-1], *(T.StructField(n, T.DoubleType()) for n in names)])
    sent = docs.sparkSession.sparkContext.broadcast([(m.chosen, m.weights, m.earlier, m.bias) for m in models])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = [Linear(*m) for m in sent.value]
        for part in BW.shards(batches, "_tm_text"):
            p = probabilities(part.column(part.num_columns - 1), chain)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *(pa.array(p[:, j]) for j in range(p.shape[1]))], [f.name for f in out])

    return carry.mapInArrow(run, out)


# The label table's two marks, the more general first: junk is quality 0.
CHAIN = ("junk", "toxic")


def corpus_chain(docs: DataFrame, labels: DataFrame) -> list[Linear]:
    return train(docs, labels.withColumn("junk", 1 - F.col("quality")), CHAIN)


def drop_toxic(docs: DataFrame, models: Sequence[Linear], threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the documents of toxic probability `threshold` or more; columns as before."""
    spare = {c: f"_tm_own_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in spare.items()))
    scored = score(renamed, models, CHAIN, list(spare.values()), spare["text"])
    return scored.filter(F.col("p_toxic") < threshold).select(*(F.col(n).alias(c) for c, n in spare.items()))
