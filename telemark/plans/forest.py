"""Isolation forest over hourly features: sample, grow, score, distil, publish.

Trees grow in parallel, one small sample per tree; scoring walks all trees for
a batch of rows at once. Both are the only Python code that touches rows.
"""
from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from telemark.operators.aggregates import FEATURES
from telemark.operators.joins import attach
from telemark.plans.baseline import FAR_FUTURE, IQR_K, ISOLATION_THRESHOLD
from telemark.schema import SEASON_KEYS
from telemark.sinks.tables import read_batches, write_micro_batch

# Fixed parameters of the model.
TREES = 100
SAMPLE = 256
SEED = 42
CONTAMINATION = 0.05
RULE_DEPTH = 4
ROW_KEYS = ("device_id", "interface_name", "window_start")
NODE_DDL = "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"


def fit_scaler(features: DataFrame, names: tuple[str, ...] = FEATURES) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per feature: one aggregate, one row to the driver."""
    aggs = []
    for n in names:
        col = F.coalesce(F.col(n), F.lit(0.0))
        aggs += [F.avg(col).alias(f"m_{n}"), F.stddev_pop(col).alias(f"s_{n}")]
    row = features.agg(*aggs).first()
    return {n: (row[f"m_{n}"] or 0.0, row[f"s_{n}"] or 1.0) for n in names}


def scale(features: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    """Missing features count as 0; a constant feature is only centred."""
    return features.withColumns({
        n: (F.coalesce(F.col(n), F.lit(0.0)) - F.lit(mean)) / F.lit(std)
        for n, (mean, std) in scaler.items()
    })


def tree_samples(
    features: DataFrame, total: int, trees: int = TREES, size: int = SAMPLE, seed: int = SEED,
) -> DataFrame:
    """About `size` rows for each tree, chosen by a hash of row, tree and seed, so
    that a task run again picks the same rows. One pass, no shuffle."""
    key = [F.col(k) for k in ROW_KEYS]
    picked = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.pmod(F.xxhash64(*key, t, F.lit(seed)), F.lit(max(total, 1))) < size,
    )
    return features.withColumn("tree", F.explode(picked)).select("tree", *ROW_KEYS, *FEATURES)


def grow(sample: np.ndarray, seed: int) -> list[tuple]:
    """Nodes of one isolation tree over a sample of a few hundred rows."""
    rng = np.random.default_rng(seed)
    limit = max(1, math.ceil(math.log2(max(len(sample), 2))))
    nodes: list[list] = []
    todo = [(np.arange(len(sample)), 0, None, None)]
    while todo:
        rows, depth, parent, side = todo.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][side] = me
        part = sample[rows]
        low, high = (part.min(axis=0), part.max(axis=0)) if len(rows) else (np.zeros(0), np.zeros(0))
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes.append([me, -1, 0.0, -1, -1, len(rows), depth])
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        below = part[:, feature] <= cut
        nodes.append([me, feature, cut, -1, -1, len(rows), depth])
        todo.append((rows[~below], depth + 1, me, 4))
        todo.append((rows[below], depth + 1, me, 3))
    return [tuple(n) for n in nodes]


def _grow_group(seed: int):
    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        ordered = group.sort_values(list(ROW_KEYS))
        nodes = grow(ordered[list(FEATURES)].to_numpy(dtype=float), seed * 1_000_003 + tree)
        out = pd.DataFrame(
            nodes, columns=["node", "feature", "threshold", "left", "right", "size", "depth"])
        out.insert(0, "tree", tree)
        return out

    return build


def average_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    many = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """A fitted model: at most trees x 2 x sample nodes, whatever the data size."""

    nodes: pd.DataFrame
    scaler: dict[str, tuple[float, float]]
    sample_size: float
    threshold: float = float("-inf")

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_DDL).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = [(n, float(m), float(s)) for n, (m, s) in self.scaler.items()]
        meta += [("_sample_size", float(self.sample_size), 0.0), ("_threshold", float(self.threshold), 0.0)]
        spark.createDataFrame(meta, "name string, a double, b double").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        meta = {r["name"]: (r["a"], r["b"]) for r in spark.read.parquet(f"{path}/meta").collect()}
        size, threshold = meta.pop("_sample_size")[0], meta.pop("_threshold")[0]
        return cls(nodes, {n: meta[n] for n in FEATURES}, size, threshold)


POINTER = "version string, published_at timestamp"


def live_version(spark: SparkSession, model: str) -> str | None:
    """The version that readers of a model folder use: the one named last."""
    named = read_batches(spark, f"{model}/current", POINTER).agg(F.max_by("version", "published_at")).first()
    return named[0]


def live(spark: SparkSession, model: str) -> Forest | None:
    version = live_version(spark, model)
    return None if version is None else Forest.load(spark, f"{model}/{version}")


def publish(spark: SparkSession, model: str, version: str, run: int, at: Column) -> None:
    """Make a saved version the live one. Versions are whole folders and never change; the
    pointer is one row, written after them, so a reader gets one model or the other."""
    row = spark.createDataFrame([(version,)], "version string").withColumn("published_at", at)
    write_micro_batch(row.coalesce(1), run, f"{model}/current")


def train(
    features: DataFrame, trees: int = TREES, size: int = SAMPLE, seed: int = SEED,
    contamination: float = CONTAMINATION,
) -> Forest:
    scaler = fit_scaler(features)
    scaled = scale(features, scaler)
    total = features.count()
    if total == 0:
        raise ValueError("no rows to train on")
    # A fixed width: the samples are small, and adaptive execution would
    # otherwise put all trees into one task.
    width = min(trees, features.sparkSession.sparkContext.defaultParallelism)
    samples = tree_samples(scaled, total, trees, size, seed).repartition(width, "tree")
    nodes = samples.groupBy("tree").applyInPandas(_grow_group(seed), NODE_DDL).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    forest = Forest(nodes, scaler, float(min(size, total)))
    scores = score(features, forest)
    cut = scores.agg(F.percentile_approx("score", contamination, 10000).alias("cut")).first()["cut"]
    forest.threshold = float(cut)
    return forest


def _walker(forest: Forest):
    trees = [
        {c: g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "size", "depth")}
        for _, g in forest.nodes.sort_values(["tree", "node"]).groupby("tree", sort=True)
    ]
    norm = float(average_path(max(forest.sample_size, 2)))

    def walk(x: np.ndarray) -> np.ndarray:
        depth = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in trees:
            at = np.zeros(len(x), dtype=int)
            inner = t["feature"][at] >= 0
            while inner.any():
                r, n = rows[inner], at[inner]
                low = x[r, t["feature"][n]] <= t["threshold"][n]
                at[r] = np.where(low, t["left"][n], t["right"][n])
                inner = t["feature"][at] >= 0
            depth += t["depth"][at] + average_path(t["size"][at])
        return -np.power(2.0, -(depth / max(len(trees), 1)) / norm)

    return walk


def score(features: DataFrame, forest: Forest) -> DataFrame:
    """Rows with `score`: minus the anomaly score, so lower is more anomalous."""
    scaled_names = [f"_x{i}" for i in range(len(FEATURES))]
    scaled = scale(features.withColumns({s: F.col(n) for s, n in zip(scaled_names, FEATURES)}),
                   {s: forest.scaler[n] for s, n in zip(scaled_names, FEATURES)})
    walk = _walker(forest)
    keep = list(features.columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[keep].copy()
            out["score"] = walk(pdf[scaled_names].to_numpy(dtype=float))
            yield out

    schema = StructType([*features.schema.fields, StructField("score", DoubleType())])
    return scaled.mapInPandas(run, schema)


def label(scored: DataFrame, forest: Forest) -> DataFrame:
    return scored.withColumn("label", F.when(F.col("score") < forest.threshold, -1).otherwise(1))


def detect(features: DataFrame, forest: Forest) -> DataFrame:
    """Anomalous rows in the common anomaly layout."""
    hits = label(score(features, forest), forest).filter(F.col("label") == -1)
    return hits.select(
        "device_id", F.lit(None).cast("string").alias("site_id"), "interface_name", "window_start",
        (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
        F.lit("MODEL").alias("anomaly_type"), F.lit("MULTIVARIATE_ANOMALY").alias("anomaly_subtype"),
        "score", F.col("avg_in").alias("mean_util_in"), F.col("std_in").alias("std_util_in"),
        (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("detected_at"),
    )


# -- distillation ---------------------------------------------------------------


def distill(labelled: DataFrame, depth: int = RULE_DEPTH, seed: int = SEED) -> dict:
    """A shallow decision tree that imitates the forest's labels, as a nested dict.

    It is fitted on unscaled features, so its rules apply to rows as they are.
    """
    zeroed = labelled.fillna(0.0, list(FEATURES)).withColumn(
        "target", (F.col("label") == -1).cast("double"))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(zeroed)
    model = DecisionTreeClassifier(
        featuresCol="features", labelCol="target", maxDepth=depth, seed=seed,
    ).fit(vectors.select("features", "target"))

    def node(j) -> dict:
        if j.getClass().getSimpleName() == "LeafNode":
            return {"anomalous": int(j.prediction())}
        split = j.split()
        return {
            "feature": FEATURES[split.featureIndex()], "threshold": float(split.threshold()),
            "below": node(j.leftChild()), "above": node(j.rightChild()),
        }

    return {"source": "isolation_forest", "feature_names": list(FEATURES),
            "tree": node(model._java_obj.rootNode())}


def rules_text(rules: dict) -> str:
    return json.dumps(rules, separators=(",", ":"))


def rules_case(rules: dict) -> Column:
    """The rules as one CASE expression over the feature columns: 1 = anomalous."""

    def build(node: dict) -> Column:
        if "anomalous" in node:
            return F.lit(node["anomalous"])
        value = F.coalesce(F.col(node["feature"]), F.lit(0.0))
        return F.when(value <= node["threshold"], build(node["below"])).otherwise(build(node["above"]))

    return build(rules["tree"])


def fan_out(series: DataFrame, params: DataFrame, rules: str, as_of: Column) -> DataFrame:
    """One parameter row per (device, interface) and season slot, carrying the rules.

    Means and deviations come from the slot's baseline; a slot without one stays
    NULL, which scores 0, rather than 0, which would flag every reading.
    """
    slots = series.select("device_id", "interface_name").distinct().withColumn(
        "hour_of_day", F.explode(F.sequence(F.lit(0), F.lit(23)))
    ).withColumn("day_of_week", F.explode(F.sequence(F.lit(0), F.lit(6))))
    known = params.select(*SEASON_KEYS, "baseline_mean", "baseline_std")
    return attach(slots, known, list(SEASON_KEYS)).withColumns({
        "iqr_k": F.lit(IQR_K),
        "isolation_score_threshold": F.lit(ISOLATION_THRESHOLD),
        "distilled_rules": F.lit(rules),
        "valid_from": as_of,
        "valid_until": F.lit(FAR_FUTURE).cast("timestamp"),
    })


# -- promotion gate -------------------------------------------------------------


def gate(held_out: DataFrame, candidate: Forest, current: Forest, truth: str = "truth") -> DataFrame:
    """Precision and recall of both models on held-out rows, and whether the
    candidate is at least as good in both. `truth` marks known anomalies with 1."""
    both = label(score(held_out, candidate), candidate).withColumnsRenamed(
        {"score": "_s1", "label": "_cand"})
    both = label(score(both, current), current).withColumnRenamed("label", "_curr")
    hit = F.col(truth) == 1

    def ratio(a: Column, b: Column) -> Column:
        return a / F.greatest(b, F.lit(1))

    def metrics(name: str, col: str) -> list[Column]:
        flagged = F.col(col) == -1
        right = F.count_if(flagged & hit)
        return [ratio(right, F.count_if(flagged)).alias(f"{name}_precision"),
                ratio(right, F.count_if(hit)).alias(f"{name}_recall")]

    out = both.agg(*metrics("candidate", "_cand"), *metrics("current", "_curr"))
    better = (F.col("candidate_precision") >= F.col("current_precision")) & (
        F.col("candidate_recall") >= F.col("current_recall"))
    return out.withColumn("promoted", better)
