"""Trees on sparse vectors: MLlib's trees, without a dense row."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from chirpflow.operators import models as M
from chirpflow.operators import trees
from chirpflow.session import scratch_path

SCHEMA = T.StructType([T.StructField(M.WEIGHTS, VectorUDT()), T.StructField("label", T.IntegerType())])


def vectors(spark, rows, width, seed=1, parts=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(rows):
        at = np.sort(rng.choice(width, rng.integers(0, 8), replace=False))
        x = rng.integers(1, 6, len(at)) * (1.0 + at % 7)
        label = int((x.sum() + 3 * (3 in at) + 20 * rng.random()) > 40)
        out.append((Vectors.sparse(width, at.tolist(), x.tolist()), label))
    return spark.createDataFrame(out, SCHEMA).repartition(parts).cache()


def body(model):
    return model.toDebugString.split("\n")[1:]


def test_decision_tree_equals_mllib(spark):
    data = vectors(spark, 400, 60)
    for change in ({}, {"maxBins": 3}, {"maxDepth": 2}):
        own = trees.fit(M.classifier("dt").setParams(**change), data)
        assert body(own) == body(M.classifier("dt").setParams(**change).fit(data))
    path = scratch_path(spark, "models", "tree")
    own.save(path)
    assert body(DecisionTreeClassificationModel.load(path)) == body(own) and own.getMaxDepth() == 2


def test_boosted_trees_and_forest(spark):
    data = vectors(spark, 400, 60)
    labels = np.asarray([r.label for r in data.select("label").collect()])

    def predicted(model):
        return np.asarray([r.prediction for r in model.transform(data).select("prediction").collect()])
    small = M.classifier("gbt").setParams(maxIter=4)
    own, theirs = trees.fit(small, data), small.fit(data)
    assert (predicted(own) != predicted(theirs)).mean() < 0.02 and own.treeWeights == theirs.treeWeights
    forest = trees.fit(M.classifier("rf").setParams(seed=5), data)
    assert forest.getNumTrees == 20 and len(set(map(str, forest.trees))) == 20
    assert (predicted(forest) == labels).mean() > max(labels.mean(), 1 - labels.mean())


def test_a_rare_split_is_found_in_a_large_vocabulary(spark):
    """12,000 rows over 200,000 terms; MLlib would make 2.4 billion numbers of them and
    looks for thresholds in a sample of 10,000 rows."""
    width = 200_000
    rows = [(Vectors.sparse(width, [i % 1000, width - 1], [1.0, 2.0 if i % 1500 else 3.0]), int(i % 1500 == 0))
            for i in range(12_000)]
    model = trees.fit(M.classifier("dt"), spark.createDataFrame(rows, SCHEMA))
    assert f"If (feature {width - 1} <= 2.5)" in model.toDebugString and model.depth == 1


def test_nodes_in_several_passes_and_layouts(spark, monkeypatch):
    data = vectors(spark, 300, 40)
    whole = body(trees.fit(M.classifier("dt"), data))
    monkeypatch.setattr(trees, "CELLS", 10)
    assert body(trees.fit(M.classifier("dt"), data.repartition(7))) == whole


def test_thresholds_as_mllib_chooses_them():
    held = pd.DataFrame({"term": [5, 5, 5, 2], "value": [3.0, 1.0, 2.0, 4.0], "n": [1, 1, 1, 8]})
    assert trees.thresholds(held, 8, 31).to_dict("list") == {"term": [5, 5, 5], "threshold": [0.5, 1.5, 2.5]}
    assert trees.thresholds(held, 3, 1).query("term == 5")["threshold"].tolist() == [2.5]


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_or_no_entry_is_a_leaf(spark, label):
    rows = [(Vectors.sparse(4, [1], [float(i)]), label) for i in range(1, 5)]
    assert trees.fit(M.classifier("dt"), spark.createDataFrame(rows, SCHEMA)).numNodes == 1
    empty = [(Vectors.sparse(4, [], []), i % 2) for i in range(6)]
    assert trees.fit(M.classifier("dt"), spark.createDataFrame(empty, SCHEMA)).numNodes == 1
