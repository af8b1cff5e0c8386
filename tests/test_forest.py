"""Forests grown in tasks, against MLlib's and against themselves."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tessera.operators import classify as C
from tessera.operators import forest as T


def _noisy(spark, n=900, classes=2, parts=2):
    """Rows whose class follows two of five features only now and then, as ``id, Class, scaled, weight``;
    one feature has few values, one a single one, one many zeros."""
    u = lambda salt: C.hash_uniform("id", seed=3, salt=salt)
    x = F.array(u(1), u(2) * 100 - 50, F.floor(u(3) * 5).cast("double"), F.lit(7.0), F.when(u(4) < 0.4, 0.0).otherwise(u(5) - 0.5))
    sure = F.when(u(1) + u(2) > 1.2, 1).otherwise(0)
    return spark.range(n).repartition(parts, "id").select("id", F.when(u(6) < 0.3, F.floor(u(7) * classes)).otherwise(sure).cast("int").alias("Class"),
                                                          array_to_vector(x).alias("scaled"), F.when(u(8) < 0.5, 0.5).otherwise(2.25).alias("weight"))


def _scores(model, df):
    rows = model.copy().transform(df).select("id", vector_to_array("probability").alias("p"), vector_to_array("rawPrediction").alias("raw"), "prediction").orderBy("id").collect()
    return [np.array([r[c] for r in rows]) for c in ("p", "raw", "prediction")]


def _learner(**params):
    return RandomForestClassifier(featuresCol="scaled", labelCol="Class", **params)


@pytest.mark.parametrize("classes,weighted,depth,least", [(2, False, 30, 1), (2, True, 6, 4), (3, True, 30, 2)])
def test_a_tree_without_draws_is_mllibs(spark, classes, weighted, depth, least):
    """Thresholds, splits, joined leaves and scores of Spark's own tree."""
    df = _noisy(spark, classes=classes)
    rf = _learner(numTrees=1, maxDepth=depth, minInstancesPerNode=least, featureSubsetStrategy="all", bootstrap=False, seed=5)
    rf = rf.setWeightCol("weight") if weighted else rf
    theirs, ours = rf.fit(df), T.fit(T.training_rows(df, rf), rf)
    assert (ours.totalNumNodes, ours.numClasses, ours.numFeatures, ours.getNumTrees) == (theirs.totalNumNodes, theirs.numClasses, theirs.numFeatures, 1)
    for a, b in zip(_scores(ours, df), _scores(theirs, df), strict=True):
        assert np.allclose(a, b, atol=1e-12)


def test_a_large_forest_stays_in_a_table(spark, monkeypatch):
    """Beyond the rows that MLlib gets, no node comes to the driver, the partitions don't matter,
    every row is scored as often as it comes, and the scores are near those of MLlib's forest."""
    monkeypatch.setattr(T, "BLOCK_ROWS", 200)
    monkeypatch.setattr(T, "BLOCK_NODES", 7)
    df = _noisy(spark)
    small = C.rf_fit(df, "scaled", "Class", num_trees=60, seed=4)
    monkeypatch.setattr(T, "MLLIB_ROWS", 899)
    models = [C.rf_fit(x, "scaled", "Class", num_trees=60, seed=4) for x in (df, df.repartition(1).orderBy(F.desc("id")))]
    assert all(isinstance(m, T.ForestModel) and m.trees.count() == 60 for m in models) and not isinstance(small, T.ForestModel)
    new = _noisy(spark, 1500, parts=5)
    a, b = (_scores(m, new)[0] for m in models)
    assert a.shape == (1500, 2) and (a == b).all() and np.allclose(a.sum(1), 1)
    theirs = _scores(small, new)[0]
    assert np.abs(a - theirs).mean() < 0.05 and ((a > 0.5) == (theirs > 0.5)).mean() > 0.95
    assert 0.9 < models[0].totalNumNodes / small.totalNumNodes < 1.1
    twice = new.filter("id < 40").union(new.filter("id < 40")).withColumn("id", F.lit(None).cast("long"))
    assert C.positive_probability(models[0], twice).count() == 80
    assert C.positive_probability(models[0], new.limit(0)).count() == 0


def test_search_in_tasks_equals_its_forests_alone(spark, monkeypatch):
    """Shared trees, cut off at a depth or a number, give each map and fold the F1 of a forest of its own."""
    monkeypatch.setattr(T, "MLLIB_ROWS", 100)
    monkeypatch.setattr(T, "BLOCK_TREES", 4)
    df = _noisy(spark, 600)
    space = {"numTrees": [3, 9], "maxDepth": [2, None], "minInstancesPerNode": [2], "featureSubsetStrategy": ["sqrt"]}
    got = C.random_search(df, "scaled", "Class", n_iter=4, folds=2, seed=6, id_col="id", weight_col="weight", space=space)
    ev = MulticlassClassificationEvaluator(labelCol="Class", metricName="fMeasureByLabel", metricLabel=1.0)
    folds = C.held(C.stratified_folds(df, "Class", "id", 2, 6))
    assert len(set(got.avgMetrics)) == 4
    rf = _learner(numTrees=3, maxDepth=2, minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=6).setWeightCol("weight")
    f1 = [ev.evaluate(T.fit(T.training_rows(folds.filter(F.col("_fold") != f), rf), rf).transform(folds.filter(F.col("_fold") == f))) for f in range(2)]
    assert any(np.isclose(np.mean(f1), m) and np.isclose(np.std(f1), s) for m, s in zip(got.avgMetrics, got.stdMetrics, strict=True))
    with pytest.raises(ValueError):
        C.random_search(df.filter("id < 150 or Class = 0").withColumn("Class", F.lit(0)), "scaled", "Class", n_iter=1, folds=2, seed=1, id_col="id", space=space)


def test_thresholds_part_equal_weights():
    v = np.repeat(np.arange(10.0), [1, 1, 1, 1, 1, 1, 1, 1, 1, 91])
    assert T.split_points(v, None, 4).tolist() == [8.5]
    assert T.split_points(np.arange(100.0), None, 4).tolist() == [19.5, 39.5, 59.5, 79.5]
    assert T.split_points(np.arange(4.0), np.array([1.0, 1, 1, 97]), 3).tolist() == [0.5, 1.5, 2.5]
    assert T.split_points(np.full(5, 2.0), None, 31).tolist() == []
