"""The whole lasso path: optimality at every penalty of every fold, held-out losses, rules and scores."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stopline.models import lasso
from stopline.models.trees import with_fold


@pytest.fixture(scope="module")
def data(spark):
    """Factors with rare levels, a constant column, a far-off scale and two equal columns."""
    rng = np.random.RandomState(5)
    n = 700
    a, b = rng.randint(0, 6, n), np.where(rng.rand(n) < 0.01, 2, rng.randint(0, 2, n))
    year, v = 2000 + rng.randint(0, 20, n), rng.normal(size=n)
    x = np.column_stack([(a[:, None] == np.arange(1, 6)), (b[:, None] == np.arange(1, 3)), year, v, v, np.zeros(n)]).astype(float)
    link = 0.8 * (a == 2) - 1.5 * (b == 1) + 0.05 * (year - 2010) + 0.4 * v
    y = (rng.rand(n) < 1 / (1 + np.exp(-link))).astype(float)
    rows = [(int(i), float(y[i]), Vectors.dense(x[i]) if i % 2 else Vectors.sparse(
        x.shape[1], [(j, float(t)) for j, t in enumerate(x[i]) if t])) for i in range(n)]
    df = spark.createDataFrame(rows, ["key", "label", "features"]).repartition(4)
    fold = {r["key"]: r["fold"] for r in with_fold(df, "key", 5).select("key", "fold").collect()}
    return df, x, y, np.array([fold[i] for i in range(n)])


@pytest.fixture(scope="module")
def path(data):
    df, x, _, _ = data
    return lasso.lasso_path(df, "key", [f"x{i}" for i in range(x.shape[1])])


def losses(x, y, b0, beta):
    link = b0 + x @ beta
    return np.logaddexp(0, link) - y * link


def test_every_penalty_of_every_fold_is_optimal(data, path):
    _, x, y, fold = data
    assert len(path.lambdas) == 100 and path.beta.shape == (6, 100, x.shape[1])
    assert path.lambdas[-1] == pytest.approx(1e-4 * path.lambdas[0])
    for g in range(6):
        seen = fold != g - 1
        xs, ys = x[seen], y[seen]
        spread = xs.std(0)
        for k, lam in enumerate(path.lambdas):
            beta = path.beta[g, k]
            pull = xs.T @ (ys - 1 / (1 + np.exp(-(path.intercept[g, k] + xs @ beta)))) / len(ys)
            at_rest = np.abs(ys.mean() - (1 / (1 + np.exp(-(path.intercept[g, k] + xs @ beta)))).mean())
            assert at_rest <= 2e-3 * lam
            centred = pull - at_rest * 0
            slack = 2e-3 * lam * np.maximum(x.std(0), 1e-9) + at_rest * np.abs(xs).max(0) * 2
            on = beta != 0
            assert (np.abs(centred - lam * spread * np.sign(beta))[on] <= slack[on]).all()
            assert (np.abs(centred[~on]) <= lam * spread[~on] + slack[~on]).all()
    assert path.violation.max() <= lasso.TOLERANCE and path.steps < 40
    assert (path.beta[:, 0] == 0).all() or np.abs(path.beta[0, 0]).max() < 1e-6
    assert (path.beta[:, :, -1] == 0).all()


def test_held_out_losses(data, path):
    _, x, y, fold = data
    for f in range(5):
        for k in (0, 30, 99):
            out = fold == f
            want = losses(x[out], y[out], path.intercept[1 + f, k], path.beta[1 + f, k]).mean()
            assert path.fold_loss[f, k] == pytest.approx(want, abs=1e-9)
    assert path.loss[99] == pytest.approx(losses(x, y, path.intercept[0, 99], path.beta[0, 99]).mean(), abs=1e-9)


def test_agrees_with_single_fits(data, path):
    df, x, _, _ = data
    for k in (10, 40):
        model = LogisticRegression(elasticNetParam=1.0, regParam=path.lambdas[k], maxIter=500, tol=1e-12).fit(df)
        twice = model.coefficients.toArray()
        # the two equal columns may share their effect in any way
        join = lambda b: np.append(np.delete(b, [8, 9]), b[8] + b[9])
        assert np.allclose(join(twice), join(path.beta[0, k]), atol=2e-3)


def test_scores_are_the_link(data, path):
    df, x, _, _ = data
    lam = path.lambdas[60]
    got = {r["key"]: r for r in lasso.predict(df, path, lam).collect()}
    link = path.intercept[0, 60] + x @ path.beta[0, 60]
    for i in range(len(x)):
        assert got[i]["probability"] == pytest.approx(1 / (1 + np.exp(-link[i])), abs=1e-9)
        assert got[i]["prediction"] == float(link[i] > 0)


def test_rules_and_tables(spark, path):
    low, high = lasso.lambda_rule(path, "min"), lasso.lambda_rule(path, "1se")
    assert low <= high and path.mean[path.at(low)] == min(path.mean)
    table = lasso.path_table(spark, path).orderBy(F.desc("lambda")).collect()
    assert len(table) == 100 and table[0]["nonzero"] == 0 and table[0]["deviance_ratio"] == pytest.approx(0, abs=1e-6)
    assert table[-1]["deviance_ratio"] > 0.05
    terms = lasso.path_coefficients(spark, path, low)
    assert terms.where("estimate = 0 and term <> '(Intercept)'").count() == 0


def test_one_class_is_refused(data):
    df, x, _, _ = data
    with pytest.raises(ValueError):
        lasso.lasso_path(df.where("label = 1"), "key", ["x"] * x.shape[1])
