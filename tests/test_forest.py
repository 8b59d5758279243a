"""The forest finds planted outliers, is repeatable, and survives saving."""
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemark.operators.aggregates import FEATURES
from telemark.plans import forest as IF
from telemark.session import scratch

T0 = datetime(2024, 3, 4, tzinfo=timezone.utc)
N, PLANTED = 2000, 40


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(30, 5, (N, len(FEATURES)))
    x[:PLANTED] += rng.choice([-40, 60], (PLANTED, len(FEATURES)))
    rows = [(f"d{i % 7}", "e", T0 + timedelta(hours=i), *map(float, v)) for i, v in enumerate(x)]
    ddl = "device_id string, interface_name string, window_start timestamp, " + ", ".join(
        f"{f} double" for f in FEATURES)
    return spark.createDataFrame(rows, ddl).repartition(4)


@pytest.fixture(scope="module")
def forest(features):
    return IF.train(features)


def planted():
    return F.col("window_start") < F.lit(T0 + timedelta(hours=PLANTED))


def test_planted_outliers_rank_lowest(features, forest):
    hits = IF.label(IF.score(features, forest), forest).filter("label = -1")
    total, found = hits.agg(F.count("*"), F.count_if(planted())).first()
    assert found == PLANTED and total <= 0.06 * N


def test_model_size_does_not_depend_on_the_data(forest):
    assert forest.nodes["tree"].nunique() == IF.TREES
    assert forest.nodes.groupby("tree")["size"].max().max() < 2 * IF.SAMPLE


def test_same_seed_same_model(features, forest):
    """On other partitions too, up to the last bit of the means used for scaling."""
    again = IF.train(features.repartition(3))
    shape = ["tree", "node", "feature", "left", "right", "size", "depth"]
    assert again.nodes[shape].equals(forest.nodes[shape])
    assert np.allclose(again.nodes["threshold"], forest.nodes["threshold"])


def test_saved_model_scores_the_same(spark, features, forest):
    path = scratch(spark, "forest")
    forest.save(spark, path)
    loaded = IF.Forest.load(spark, path)
    assert loaded.threshold == forest.threshold
    a = IF.score(features, forest).orderBy("window_start").toPandas()["score"]
    b = IF.score(features, loaded).orderBy("window_start").toPandas()["score"]
    assert np.array_equal(a, b)


def test_rules_imitate_the_forest(features, forest):
    labelled = IF.label(IF.score(features, forest), forest)
    rules = IF.distill(labelled)
    same = (F.col("label") == -1).cast("int") == IF.rules_case(rules)
    share = labelled.agg(F.avg(same.cast("double"))).first()[0]
    assert share > 0.97 and '"source":"isolation_forest"' in IF.rules_text(rules)


def test_gate_rejects_a_worse_model(features, forest):
    held = features.withColumn("truth", planted().cast("int"))
    blind = IF.Forest(forest.nodes, forest.scaler, forest.sample_size)  # flags nothing
    assert IF.gate(held, forest, blind).first()["promoted"]
    assert not IF.gate(held, blind, forest).first()["promoted"]


def test_fan_out_leaves_unknown_slots_empty(spark):
    series = spark.createDataFrame([("d", "e"), ("d", "e"), ("d", "f")], "device_id string, interface_name string")
    params = spark.createDataFrame(
        [("d", "e", 3, 2, 40.0, 2.0)], "device_id string, interface_name string, hour_of_day int, "
        "day_of_week int, baseline_mean double, baseline_std double")
    out = IF.fan_out(series, params, "{}", F.lit(T0))
    assert out.count() == 2 * 168 and out.filter("baseline_mean IS NOT NULL").count() == 1


def test_no_rows_is_an_error(features):
    with pytest.raises(ValueError):
        IF.train(features.filter("false"))
