"""Metrics with known values, and models against small direct computations."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stopline.models import bagging, encode, evaluate, lasso, linear, trees
from stopline.sources import tables

# Published counts (tp, fp, fn, tn) with accuracy, kappa, sensitivity, specificity, balanced
PUBLISHED = [
    ((64853, 3729, 12445, 111750), (0.9161, 0.822, 0.8390, 0.9677, 0.9034)),
]


@pytest.mark.parametrize("counts, want", PUBLISHED)
def test_published_metrics(spark, counts, want):
    df = spark.createDataFrame([counts], "tp long, fp long, fn long, tn long")
    m = evaluate.confusion_metrics(df).first()
    names = ("accuracy", "kappa", "sensitivity", "specificity", "balanced_accuracy")
    for name, value in zip(names, want):
        digits = 3 if name == "kappa" else 4
        assert round(m[name], digits) == value
    assert round(m["pos_pred_value"], 4) == 0.9456
    assert round(m["neg_pred_value"], 4) == 0.8998
    assert round(m["prevalence"], 4) == 0.4010
    assert round(m["detection_rate"], 4) == 0.3364
    assert round(m["detection_prevalence"], 4) == 0.3558
    assert round(m["no_information_rate"], 3) == 0.599
    tests = evaluate.exact_tests(*counts)
    assert round(tests["accuracy_low"], 4) == 0.9149
    assert round(tests["accuracy_high"], 4) == 0.9173
    assert tests["p_accuracy_above_nir"] < 2.2e-16 and tests["mcnemar_p"] < 2.2e-16


def test_published_test_error(spark):
    # Published table of the full logistic model
    assert round(1 - (22467 + 61773) / (22467 + 7304 + 23398 + 61773), 7) == 0.2671086
    df = spark.createDataFrame([("a", "a")] * 3 + [("a", "b")], "p string, a string")
    assert evaluate.test_error(df, "p", "a").first()[0] == 0.25


def test_exact_binomial_against_direct_sums():
    tp, fp, fn, tn = 30, 8, 6, 16
    t = evaluate.exact_tests(tp, fp, fn, tn)
    n, right, nir = 60, 46, 36 / 60
    tail = sum(math.comb(n, k) * nir**k * (1 - nir) ** (n - k) for k in range(right, n + 1))
    assert abs(t["p_accuracy_above_nir"] - tail) < 1e-10
    low = t["accuracy_low"]
    above = sum(math.comb(n, k) * low**k * (1 - low) ** (n - k) for k in range(right, n + 1))
    assert abs(above - 0.025) < 1e-9
    high = t["accuracy_high"]
    below = sum(math.comb(n, k) * high**k * (1 - high) ** (n - k) for k in range(right + 1))
    assert abs(below - 0.025) < 1e-9
    assert abs(t["mcnemar_p"] - math.erfc(math.sqrt((1 / 14) / 2))) < 1e-12
    assert evaluate.exact_tests(5, 0, 0, 5)["accuracy_high"] == 1.0


def test_thresholds(spark):
    df = spark.createDataFrame([(0.49,), (0.5,)], "p double")
    got = [r[0] for r in df.select(evaluate.threshold_class(F.col("p"))).collect()]
    assert got == ["Citation", "Warning"]


def test_report_is_long_and_stored(spark, tmp_path):
    df = spark.createDataFrame([(3, 1, 2, 4)], "tp long, fp long, fn long, tn long")
    for run in ("a", "b"):
        tables.write_report(evaluate.confusion_report(spark, df, run), str(tmp_path / "r"))
    back = spark.read.parquet(str(tmp_path / "r"))
    assert back.columns == ["run", "section", "metric", "value"]
    assert {r["run"]: r["count"] for r in back.groupBy("run").count().collect()} == {"a": 19, "b": 19}


@pytest.fixture(scope="module")
def data(spark):
    """A small two-class frame with two factors and one number."""
    rng = np.random.default_rng(11)
    n = 1200
    a = rng.choice(list("xyz"), n)
    b = rng.choice(["no", "yes"], n, p=[0.7, 0.3])
    v = rng.normal(size=n)
    score = 1.2 * (a == "y") - 0.8 * (b == "yes") + 0.9 * v - 0.2
    label = (rng.random(n) < 1 / (1 + np.exp(-score))).astype(float)
    rows = [(i, str(p), str(q), float(x), float(y))
            for i, (p, q, x, y) in enumerate(zip(a, b, v, label))]
    return spark.createDataFrame(rows, "key long, a string, b string, v double, label double").cache()


@pytest.fixture(scope="module")
def coded(data):
    df = encode.encode(data, ["a", "b"], ["v"]).transform(data)
    return df, encode.feature_names(df)


def matrix(coded):
    df, names = coded
    rows = df.select("features", "label").collect()
    return np.array([r[0].toArray() for r in rows]), np.array([r[1] for r in rows])


def test_first_level_is_the_base(coded, data):
    df, names = coded
    assert sorted(names) == ["a=y", "a=z", "b=yes", "v"]
    x, _ = matrix(coded)
    col = names.index("a=y")
    assert x[:, col].sum() == data.where("a = 'y'").count()
    plain = encode.dummy_columns(data, ["a", "b"], ["key"])
    assert plain.columns == ["key", "a_y", "a_z", "b_yes"]


def test_gram_forms_agree(coded, spark):
    df, names = coded
    x, y = matrix(coded)
    g = linear.gram(df, "features", "label", names)
    full = np.column_stack([np.ones(len(y)), x, y])
    assert np.allclose(g.matrix, full.T @ full)
    assert g.n == len(y)
    table = {(r["i"], r["j"]): r["s"] for r in
             linear.gram_matrix(df.select("v", "label"), ["v", "label"]).collect()}
    v = x[:, names.index("v")]
    assert abs(table["v", "label"] - v @ y) < 1e-5 and len(table) == 3


def rss_of(x, y, cols):
    design = np.column_stack([np.ones(len(y)), x[:, cols]])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    return float(((y - design @ beta) ** 2).sum())


def test_stepwise_against_refits(coded, spark):
    df, names = coded
    x, y = matrix(coded)
    g = linear.gram(df, "features", "label", names)
    forward = linear.stepwise(spark, g, "forward").orderBy("size").collect()
    chosen = []
    for step in forward:
        best = min((c for c in range(len(names)) if c not in chosen),
                   key=lambda c: rss_of(x, y, [*chosen, c]))
        chosen.append(best)
        assert step["term"] == names[best]
        assert abs(step["rss"] - rss_of(x, y, chosen)) < 1e-6
    sizes = [s["rss"] for s in forward]
    assert sizes == sorted(sizes, reverse=True)
    backward = linear.stepwise(spark, g, "backward").orderBy(F.desc("size")).collect()
    left = list(range(len(names)))
    for step in backward:
        assert abs(step["rss"] - rss_of(x, y, left)) < 1e-6
        worst = min(left, key=lambda c: rss_of(x, y, [k for k in left if k != c]))
        assert step["term"] == names[worst]
        left.remove(worst)
    n, p = len(y), len(names) + 1
    last, null = forward[-1], float(((y - y.mean()) ** 2).sum())
    assert abs(last["adj_r2"] - (1 - last["rss"] / null * (n - 1) / (n - p))) < 1e-9
    assert abs(last["cp"] - p) < 1e-6
    assert abs(last["bic"] - (n * math.log(last["rss"] / null) + p * math.log(n))) < 1e-6
    picked = linear.selection_sizes(linear.stepwise(spark, g, "forward")).first()
    assert picked["rss"] == len(names)
    coefs = {r["term"]: r["estimate"] for r in linear.subset_coefficients(
        spark, g, [names[c] for c in chosen[:2]]).collect()}
    design = np.column_stack([np.ones(n), x[:, chosen[:2]]])
    assert np.allclose(list(coefs.values()), np.linalg.lstsq(design, y, rcond=None)[0])


def test_aliased_columns_are_left_out(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(2, 80))
    y = (a + rng.normal(size=80) > 0).astype(float)
    rows = [(Vectors.dense([p, 2 * p, q, 1.0, p + q]), float(t)) for p, q, t in zip(a, b, y)]
    df = spark.createDataFrame(rows, ["features", "label"])
    names = ["a", "twice_a", "b", "constant", "a_plus_b"]
    g = linear.gram(df, "features", "label", names)
    assert linear.independent_terms(g) == [0, 2]
    steps = linear.stepwise(spark, g, "backward").collect()
    assert {s["size"] for s in steps} == {1, 2}
    model = linear.logistic_glm(df, terms=[0, 2])
    table = {r["term"]: r["estimate"] for r in
             linear.glm_coefficients(spark, model, names, [0, 2]).collect()}
    assert table["twice_a"] is None and table["a"] is not None


def newton(x, y, steps=30):
    design = np.column_stack([np.ones(len(y)), x])
    beta = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-design @ beta))
        info = (design * (p * (1 - p))[:, None]).T @ design
        beta += np.linalg.solve(info, design.T @ (y - p))
    return beta, np.sqrt(np.diag(np.linalg.inv(info))), p


def test_logistic_matches_newton(coded, spark):
    df, names = coded
    x, y = matrix(coded)
    beta, se, p = newton(x, y)
    model = linear.logistic_glm(df)
    table = linear.glm_coefficients(spark, model, names).collect()
    assert [r["term"] for r in table] == ["(Intercept)", *names]
    assert np.allclose([r["estimate"] for r in table], beta, atol=1e-5)
    assert np.allclose([r["std_error"] for r in table], se, atol=1e-4)
    fit = {r["metric"]: r["value"] for r in linear.glm_fit_statistics(spark, model).collect()}
    deviance = -2 * float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
    assert abs(fit["residual_deviance"] - deviance) < 1e-4
    assert abs(fit["aic"] - deviance - 2 * len(beta)) < 1e-4


def test_lasso_path(coded, spark):
    df, names = coded
    path = lasso.lasso_path(df, "key", names, penalties=4, ratio=0.05, folds=3)
    lambdas = path.lambdas
    assert lambdas == sorted(lambdas, reverse=True)
    assert lasso.path_coefficients(spark, path, lambdas[0]).count() == 1  # the intercept
    some = lasso.lasso_path(df, "key", names, penalties=2, ratio=0.9, folds=3)
    assert lasso.path_coefficients(spark, some, some.lambdas[1]).count() == 2  # and one term
    assert len(path.mean) == 4 and path.mean[0] == max(path.mean)
    assert lasso.lambda_rule(path, "1se") >= lasso.lambda_rule(path, "min")


def test_lambda_rules():
    held = np.array([[0.60, 0.51, 0.50 + d] for d in (-0.04, 0.04, -0.04, 0.04)])
    path = lasso.Path([], [1.0, 0.1, 0.01], None, None, held, None, 0.0, None, 0)
    assert path.mean == pytest.approx([0.60, 0.51, 0.50]) and path.std == pytest.approx([0, 0, 0.04])
    assert lasso.lambda_rule(path, "min") == 0.01
    assert lasso.lambda_rule(path, "1se") == 0.1


@pytest.fixture(scope="module")
def forest(spark, data, tmp_path_factory):
    encoder = encode.index_only(data, ["a", "b"], ["v"])
    df = encoder.transform(data)
    model = trees.random_forest(encode.max_levels(encoder), 7, 2, 4).fit(df)
    path = str(tmp_path_factory.mktemp("forest") / "model")
    tables.save_model(model, path)
    names = ["a", "b", "v"]
    return model, df, encoder, trees.tree_nodes(spark, path, names).cache(), names


def test_tree_table(forest):
    model, df, _, nodes, _ = forest
    assert nodes.select("tree").distinct().count() == 7
    assert nodes.count() == model.totalNumNodes
    roots = nodes.where("node = 0")
    assert roots.count() == 7
    assert nodes.where("variable is null and left is not null").count() == 0
    deep = trees.node_depths(nodes)
    assert deep.count() == nodes.count()
    assert deep.agg(F.max("depth")).first()[0] == max(t.depth for t in model.trees)


def test_minimal_depths(forest):
    *_, nodes, names = forest
    rows = {(r["tree"], r["node"]): r for r in nodes.collect()}

    def walk(tree, node, depth, seen):
        r = rows[tree, node]
        if r["left"] is not None:
            seen[r["variable"]] = min(seen.get(r["variable"], 99), depth)
            walk(tree, r["left"], depth + 1, seen)
            walk(tree, r["right"], depth + 1, seen)
        return seen

    want = {(t, v, d) for t in range(7) for v, d in walk(t, 0, 0, {}).items()}
    got = {tuple(r) for r in trees.min_depth_distribution(nodes).select(
        "tree", "variable", "minimal_depth").collect()}
    assert got == want
    measures = trees.forest_measures(nodes).collect()
    assert sum(m["times_a_root"] for m in measures) == 7
    assert sum(m["no_of_nodes"] for m in measures) == nodes.where("left is not null").count()


def test_importances(spark, forest):
    model, df, encoder, _, names = forest
    table = trees.impurity_importance(spark, model, names)
    assert abs(sum(r["importance"] for r in table.collect()) - 1) < 1e-9
    scaled = trees.scaled_importance(table).collect()
    assert abs(scaled[0]["overall"] - 100) < 1e-9
    scorer = PipelineModel([encoder.stages[-1], model])
    cols = ["a_ix", "b_ix", "v"]
    got = {r["variable"]: r for r in trees.permutation_importance(
        scorer, df.drop("features"), cols, "key", bucket_rows=300).collect()}
    assert set(got) == set(cols)
    assert got["v"]["accuracy_decrease"] > 0.02
    share = df.agg(F.avg("label")).first()[0]
    for r in got.values():
        both = share * r["positive_decrease"] + (1 - share) * r["negative_decrease"]
        assert abs(both - r["accuracy_decrease"]) < 1e-9


def test_forest_grid_and_store(spark, forest, tmp_path):
    from pyspark.ml.classification import RandomForestClassificationModel

    model, df, _, _, _ = forest
    train, test = df.where("key % 3 > 0"), df.where("key % 3 = 0")
    grid = [{"trees": 5, "mtry": 2, "max_depth": 4}, {"trees": 9, "mtry": 1, "max_depth": 4}]
    models = bagging.fit_forests(train, "key", 3, grid)
    votes = {g: (bagging.out_of_bag(train, "key", bagging.read_trees(spark, bagging.saved(spark, m)), 3), 0)
             for g, m in models.items()}
    scores = bagging.forest_scores(spark, models, votes, test)
    assert set(models) == {(5, 2), (9, 1)}
    for r in scores.collect():
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == test.count()
        assert r["accuracy"] > 0.6 and abs(r["oob_error"] - r["holdout_error"]) < 0.12
    path = str(tmp_path / "m")
    tables.save_model(models[5, 2], path)
    again = RandomForestClassificationModel.load(path)
    one = models[5, 2].transform(test).select("key", "prediction")
    two = again.transform(test).select("key", "prediction")
    assert one.exceptAll(two).count() == 0


def test_boosted_grid(spark, forest):
    _, df, _, _, _ = forest
    model, best, table = trees.fit_gbt_grid(
        df, "key", 3, trees=(2, 5), depths=(1,), shrinkages=(0.1,), folds=2, parallelism=2)
    rows = table.collect()
    assert len(rows) == 2 and model.getNumTrees == best[2]
    assert max(r["accuracy"] for r in rows) == [
        r["accuracy"] for r in rows if r["trees"] == best[2]][0]
    folds = trees.with_fold(df, "key", 5).groupBy("fold").count().collect()
    assert len(folds) == 5 and min(r["count"] for r in folds) > 150


def test_levels_of_rows_held_out_are_known(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "key long, f string")
    indexed = encode.fit_indexer(df.where("f is not null"), ["f"]).transform(df.where("key = 2"))
    assert indexed.first()["f_ix"] == 0.0
