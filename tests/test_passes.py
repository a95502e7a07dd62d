"""Passes of the lasso and rows of the logistic fit."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from stopline.models import lasso, linear


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.RandomState(3)
    rows = [(i, *[float(v) for v in rng.rand(3)], float(rng.rand() < 0.4)) for i in range(700)]
    df = spark.createDataFrame(rows, "key long, a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).persist()


def test_a_pass_scores_the_models_asked_for(data):
    rows = lasso.sparse_rows(data, "key", 2)
    models = np.random.RandomState(4).randn(3, 4, 4)
    every = lasso.pass_over(rows, np.zeros(3), np.ones(3), models, 2, [1, 6])
    asked = np.zeros((3, 4), bool)
    asked[1, 2] = asked[2, 3] = True
    some = lasso.pass_over(rows, np.zeros(3), np.ones(3), models, 2, [1, 6], asked)
    asked[0, 1] = True  # a knot is scored in any case
    for whole, part in zip(every[:3], some[:3]):
        assert np.allclose(part[asked], whole[asked]) and not part[~asked].any()
    assert np.allclose(every[3], some[3])
    x = np.array([[r["a"], r["b"], r["c"]] for r in data.collect()])
    y = np.array([r["label"] for r in data.collect()])
    link = models[0, 0, 0] + x @ models[0, 0, 1:]
    assert every[1][0, 0] == pytest.approx((np.logaddexp(0, link) - y * link).sum())


def test_logistic_rows_are_kept_once(data):
    model = linear.logistic_glm(data, terms=[0, 2])
    assert model.training_rows.storageLevel.useMemory and model.training_rows.columns == ["label", "features_used"]
    assert len(model.stages[-1].coefficients) == 2 and model.transform(data).count() == 700
    model.training_rows.unpersist()
