"""Known bootstraps, out-of-bag votes, local importance and staged boosting, against direct computations."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stopline.models import bagging, boosting, encode, trees


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.RandomState(8)
    rows = []
    for i in range(600):
        a, b, v = "pqrst"[rng.randint(5)], "xy"[rng.randint(2)], float(rng.randint(0, 50))
        rows.append((i, a, b, v, float(rng.rand() < 0.15 + 0.5 * (a in "pq") + 0.2 * (v > 25) * (b == "x"))))
    df = spark.createDataFrame(rows, "key long, a string, b string, v double, label double").repartition(4)
    encoder = encode.index_only(df, ["a", "b"], ["v"])
    return encoder.transform(df).select("key", "label", "features").persist(), encode.max_levels(encoder), ["a", "b", "v"]


@pytest.fixture(scope="module")
def forest(spark, data):
    df, bins, _ = data
    model = bagging.fit_forests(df, "key", bins, [{"trees": 5, "mtry": 2, "max_depth": 6}])[5, 2]
    return model, bagging.read_trees(spark, bagging.saved(spark, model))


def rows_of(df):
    got = df.withColumn("x", vector_to_array("features")).orderBy("key").collect()
    return [r["key"] for r in got], np.array([r["label"] for r in got]), np.array([r["x"] for r in got])


def test_samples_are_bootstraps(spark):
    df = spark.range(20_000).select(F.col("id").alias("key"), *[bagging.copies("key", t).alias(f"c{t}") for t in range(3)])
    rows = np.array([list(r)[1:] for r in df.collect()])
    assert np.allclose(rows.mean(0), 1, atol=0.03) and np.allclose(rows.var(0), 1, atol=0.06)
    assert np.allclose((rows == 0).mean(0), np.exp(-1), atol=0.02)
    assert abs(np.corrcoef(rows.T)[0, 1]) < 0.03


def test_arrays_walk_as_the_trees_do(data, forest):
    df, *_ = data
    model, arrays = forest
    _, _, x = rows_of(df)
    for t, tree in enumerate(model.trees):
        got = tree.setPredictionCol("p").setRawPredictionCol("r").setProbabilityCol("q").transform(df).orderBy("key")
        assert [int(r["p"]) for r in got.select("p").collect()] == arrays.walk(t, x).tolist()
    assert len(arrays.members) and (arrays.codes >= 0).any() and (arrays.cut > -np.inf).any()


def test_out_of_bag_votes_and_local_importance(data, forest):
    df, _, names = data
    model, arrays = forest
    keys, y, x = rows_of(df)
    votes = bagging.out_of_bag(df, "key", arrays, 3, sizes=(2, 5))
    copies = {r[0]: list(r)[1:] for r in df.select("key", *[bagging.copies("key", t).alias(str(t)) for t in range(5)]).collect()}
    partner = {r["key"]: np.array(r["z"]) for r in bagging.with_partner(df, "key").withColumn(
        "z", vector_to_array("partner")).collect()}
    assert sorted(map(tuple, partner.values())) == sorted(map(tuple, x))  # a shuffle of the rows
    z = np.array([partner[k] for k in keys])
    out = np.array([[c == 0 for c in copies[k]] for k in keys])
    each = np.column_stack([arrays.walk(t, x) for t in range(5)])
    got = {r["key"]: r for r in votes.collect()}
    for i, k in enumerate(keys):
        assert got[k]["seen"] == [int(out[i, :2].sum()), int(out[i].sum())] and got[k]["lost"] is None
        assert got[k]["positive"] == [int((out[i, :2] * each[i, :2]).sum()), int((out[i] * each[i]).sum())]
    seen, ones = out.sum(1), (out * each).sum(1)
    said = (2 * ones > seen).astype(float)
    table = {r["label"]: r for r in bagging.oob_class_table(votes, 1).collect()}
    for c in (0.0, 1.0):
        mine = (y == c) & (seen > 0)
        assert table[c]["votes_1"] == (said[mine] == 1).sum() and table[c]["votes_0"] == (said[mine] == 0).sum()
        assert table[c]["class_error"] == pytest.approx((said[mine] != c).mean())
    full = bagging.out_of_bag(df, "key", arrays, 3, importance=True)
    local = {(r["key"], r["variable"]): r["decrease"] for r in bagging.local_importance(full, "key", names).collect()}
    want = {}
    for j, name in enumerate(names):
        changed = x.copy()
        changed[:, j] = z[:, j]
        moved = np.column_stack([arrays.walk(t, changed) for t in range(5)])
        lost = (out * ((each == y[:, None]).astype(int) - (moved == y[:, None]))).sum(1)
        want[name] = lost / np.maximum(seen, 1)
        for i, k in enumerate(keys):
            assert (k, name) in local if seen[i] else (k, name) not in local
            if seen[i]:
                assert local[k, name] == pytest.approx(want[name][i])
    for r in bagging.accuracy_importance(full, names).collect():
        for column, mine in (("accuracy_decrease", seen > 0), ("positive_decrease", (seen > 0) & (y == 1)),
                             ("negative_decrease", (seen > 0) & (y == 0))):
            assert r[column] == pytest.approx(want[r["variable"]][mine].mean())
    assert max(want, key=lambda v: want[v][seen > 0].mean()) == "a"


def test_smaller_forests_are_prefixes(data):
    df, bins, _ = data
    found = bagging.fit_forests(df, "key", bins, [{"trees": n, "mtry": 1, "max_depth": 3} for n in (2, 4)])
    text = [[t.toDebugString.split("\n", 1)[1] for t in found[n, 1].trees] for n in (2, 4)]
    assert text[0] == text[1][:2] and len(text[1]) == 4
    one = found[4, 1].transform(df)
    assert one.where("probability is null").count() == 0


def test_staged_scores_equal_separate_fits(spark, data):
    df, bins, _ = data
    _, best, table = trees.fit_gbt_grid(df, "key", bins, trees=(2, 5), depths=(1, 2), shrinkages=(0.1,), min_rows=5, folds=3)
    folded = trees.with_fold(df, "key", 3)
    for r in table.collect():
        scores = [trees.score_counts(
            trees.boosted_trees(bins, r["trees"], r["depth"], r["shrinkage"], 5).fit(folded.where(F.col("fold") != f)),
            folded.where(F.col("fold") == f), "label") for f in range(3)]
        assert r["accuracy"] == pytest.approx(np.mean([s["accuracy"] for s in scores]))
        assert r["kappa"] == pytest.approx(np.mean([s["kappa"] for s in scores]))
        assert r["accuracy_sd"] == pytest.approx(np.std([s["accuracy"] for s in scores], ddof=1))
    assert best in {(0.1, d, t) for d in (1, 2) for t in (2, 5)}


def test_depths_of_a_deep_tree(spark):
    """A chain of 20 splits beside a stump: no plan grows with the depth."""
    rows = [(0, 2 * i, 2 * i + 1 if i < 20 else None, 2 * i + 2 if i < 20 else None, f"v{i % 3}" if i < 20 else None)
            for i in range(21)] + [(0, 2 * i + 1, None, None, None) for i in range(20)]
    rows += [(1, 0, None, None, None)]
    nodes = spark.createDataFrame(pa.table({
        "tree": pa.array([r[0] for r in rows], pa.int32()), **{c: pa.array([r[i] for r in rows], pa.int32())
                                                               for i, c in ((1, "node"), (2, "left"), (3, "right"))},
        "variable": pa.array([r[4] for r in rows], pa.string())}))
    deep = {(r["tree"], r["node"]): r["depth"] for r in trees.node_depths(nodes).collect()}
    assert deep[1, 0] == 0 and all(deep[0, 2 * i] == i for i in range(21)) and deep[0, 39] == 20
    least = {r["variable"]: r["minimal_depth"] for r in trees.min_depth_distribution(nodes).collect()}
    assert least == {"v0": 0, "v1": 1, "v2": 2}


def test_sums_by_code():
    rng = np.random.default_rng(3)
    sizes, n = [3, 200, 5], boosting.CHUNK_ROWS + 77
    codes, numbers = np.array([rng.integers(0, s, n) for s in sizes]), rng.normal(size=(2, n))
    sums = boosting.code_sums(codes, np.cumsum([0, *sizes]), sizes, numbers)
    want = [np.concatenate([np.bincount(c, x, s) for c, s in zip(codes, sizes)]) for x in numbers]
    assert np.allclose(sums, np.transpose(want))


def test_joint_boosting_equals_separate_fits(spark):
    """Numbers of many values, a factor of many levels, several stored scores: the counts are those of Spark's own ensembles."""
    rng = np.random.default_rng(5)
    n = 1500
    x = {"key": np.arange(n), "a": rng.normal(size=n), "b": rng.integers(0, 9, n) / 4, "f": rng.integers(0, 150, n), "g": rng.integers(0, 2, n)}
    push = 1.5 * x["a"] + x["b"] + (x["f"] % 7 == 0) * 2 - (x["g"] == 1) * (x["a"] > 0) + rng.normal(size=n)
    plain = spark.createDataFrame(pa.table({**x, "f": x["f"].astype(str), "g": x["g"].astype(str), "label": (push > 1.3).astype(float)}))
    encoder = encode.index_only(plain, ["f", "g"], ["a", "b"])
    df, bins = encoder.transform(plain).select("key", "label", "features").cache(), encode.max_levels(encoder)
    folded = trees.with_fold(df, "key", 3)
    stages, shrinkages, depths = (1, 7, 12), (0.1, 0.4), (1, 3)
    found = boosting.grid_counts(folded, bins, stages, depths, shrinkages, 15, 3)
    assert len(found) == len(stages) * len(shrinkages) * len(depths) * 3
    for s in shrinkages:
        for d in depths:
            for f in range(3):
                fit = trees.boosted_trees(bins, max(stages), d, s, 15).fit(folded.where(F.col("fold") != f))
                want = trees.stage_scores([bagging.boosted_prefix(spark, fit, t) for t in stages], folded.where(F.col("fold") == f), "label")
                assert [found[s, d, f, t] for t in stages] == [tuple(w[c] for c in ("tp", "fp", "fn", "tn")) for w in want]


def test_only_the_best_point_is_fitted_apart(data, monkeypatch):
    df, bins, _ = data
    fits = []
    plain = trees.boosted_trees
    monkeypatch.setattr(trees, "boosted_trees", lambda *a, **k: fits.append(a) or plain(*a, **k))
    _, best, table = trees.fit_gbt_grid(df, "key", bins, trees=(1, 2), depths=(1, 2), shrinkages=(0.1, 0.5), min_rows=5, folds=2)
    assert len(fits) == 1 and table.count() == 8 and best[2] in (1, 2)
