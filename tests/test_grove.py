"""Forests grown in Spark, against a plain walk and a brute-force search of splits."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stopline.models import bagging, encode, grove, trees

COUNT, DEPTH, NAMES = 6, 7, ["a", "b", "v", "u"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.RandomState(8)
    rows = []
    for i in range(900):
        a, b, v, u = "pqrst"[rng.randint(5)], "xy"[rng.randint(2)], float(rng.randint(0, 9)), float(rng.rand())
        rows.append((i // 2 if i < 40 else i, a, b, v, u, float(rng.rand() < 0.15 + 0.5 * (a in "pq") + 0.2 * (v > 4) * (b == "x"))))
    df = spark.createDataFrame(rows, "key long, a string, b string, v double, u double, label double").repartition(4)
    encoder = encode.index_only(df, ["a", "b"], ["v", "u"])
    df = encoder.transform(df).select("key", "label", "features", F.col("label").cast("string").alias("kind")).persist()
    train, test = df.where("key % 5 > 0"), df.where("key % 5 = 0")
    bins = grove.bins_of(df)
    mine = grove.blocks(train, "key", bins, COUNT, held=False, partner=True)
    return train, test, bins, mine, mine.unionByName(grove.blocks(test, "key", bins, COUNT, held=True, carry="kind"))


def table_of(nodes):
    return {(r["tree"], r["node"]): r for r in nodes.collect()}


def walk(nodes, tree, x, factor=(True, True, False, False)):
    r = nodes[tree, 0]
    while r["feature"] is not None:
        j = r["feature"]
        left = x[j] in r["split_code"] if factor[j] else x[j] <= r["split_code"][0]
        r = nodes[tree, r["left"] if left else r["right"]]
    return r["prediction"]


@pytest.fixture(scope="module")
def forest(data):
    _, _, bins, mine, _ = data
    return grove.fit(mine, bins, COUNT, 2, DEPTH)


def test_trees_do_not_depend_on_where_they_are_grown(data, forest):
    _, _, bins, mine, _ = data
    whole = table_of(grove.tree_nodes(forest, bins, NAMES))
    for most in (300, 60, 5):
        parts = grove.fit(mine, bins, COUNT, 2, DEPTH, group_rows=most)
        got = table_of(grove.tree_nodes(parts, bins, NAMES))
        assert got == whole and parts.count() > COUNT
    assert {t for t, _ in whole} == set(range(COUNT)) and any(r["feature"] is None for r in whole.values())


def test_trees_are_those_of_a_single_fit(spark, data):
    """With every column tried at every node there is no chance left but the sample."""
    df = VectorSlicer(inputCol="features", outputCol="cut", indices=[0, 1, 2]).transform(data[0]).select(
        "key", "label", F.col("cut").alias("features")).persist()
    bins = grove.bins_of(df)
    rows = grove.blocks(df, "key", bins, 3, held=False)
    got = grove.tree_nodes(grove.fit(rows, bins, 3, 3, 4, group_rows=200), bins, NAMES[:3])
    model = bagging.joined_forest(spark, [t for t, _ in bagging.fit_trees(df, "key", 5, 3, 3, 4)], 3)
    want = trees.tree_nodes(spark, bagging.saved(spark, model), NAMES[:3])

    def shape(nodes):
        return sorted((r["tree"], r["variable"] or "", r["weight"], r["prediction"], round(max(r["gain"], 0), 9),
                       tuple(r["split_code"])) for r in nodes.collect())
    assert shape(got) == shape(want)
    mine = {r["variable"]: r["importance"] for r in grove.impurity_importance(spark, got, NAMES[:3]).collect()}
    for r in trees.impurity_importance(spark, model, NAMES[:3]).collect():
        assert mine[r["variable"]] == pytest.approx(r["importance"])


def test_jobs_do_not_grow_with_the_trees(spark, data):
    _, _, bins, mine, _ = data
    spark.sparkContext.setJobGroup("grow", "")
    grove.fit(mine, bins, COUNT, 2, DEPTH)
    ran = len(spark.sparkContext.statusTracker().getJobIdsForGroup("grow"))
    spark.sparkContext._jsc.clearJobGroup()
    assert 0 < ran < COUNT


def test_samples_weights_and_root_splits(data, forest):
    train, _, bins, _, _ = data
    rows = train.withColumn("x", vector_to_array("features")).select(
        "label", "x", *[bagging.copies("key", t).alias(f"c{t}") for t in range(COUNT)]).collect()
    y, x = np.array([r["label"] for r in rows]), bins.codes(np.array([r["x"] for r in rows]))
    nodes = table_of(grove.tree_nodes(forest, bins, NAMES))
    for t in range(COUNT):
        w = np.array([r[f"c{t}"] for r in rows], float)
        root = nodes[t, 0]
        assert root["weight"] == (w > 0).sum() and root["copies"] == w.sum()

        def gini(mine):
            share = (w * y)[mine].sum() / w[mine].sum()
            return w[mine].sum() / w.sum() * 2 * share * (1 - share)
        best = 0
        for j in grove.candidates(7, np.array([t]), np.array([1]), 4, 2)[0]:
            codes = np.unique(x[w > 0, j])
            order = sorted(codes, key=lambda c: ((w * y)[x[:, j] == c].sum(), c) if j < 2 else c)
            for k in range(1, len(order)):
                left = np.isin(x[:, j], order[:k])
                best = max(best, gini(w > 0) - gini(left) - gini(~left))
        assert root["gain"] == pytest.approx(best)


def test_votes_and_lost_votes(data, forest):
    train, test, bins, mine, rows = data
    nodes = table_of(grove.tree_nodes(forest, bins, NAMES))
    seen = bagging.with_partner(train.select("key", "label", "features"), "key").select(
        "key", "label", vector_to_array("features").alias("x"), vector_to_array("partner").alias("z"),
        *[bagging.copies("key", t).alias(f"c{t}") for t in range(COUNT)]).collect()
    got = grove.votes(forest, rows, "key", bins, COUNT, [2, COUNT])
    full = grove.votes(forest, mine, "key", bins, COUNT, [COUNT], importance=True)
    want, lost = [], []
    for r in seen:
        out = [t for t in range(COUNT) if r[f"c{t}"] == 0]
        said = {t: walk(nodes, t, r["x"]) for t in out}
        want.append((r["key"], [sum(t < 2 for t in out), len(out)],
                     [int(sum(said[t] for t in out if t < 2)), int(sum(said.values()))]))
        changed = [[z if i == j else v for i, (v, z) in enumerate(zip(r["x"], r["z"]))] for j in range(4)]
        lost.append((r["key"], [sum((said[t] == r["label"]) - (walk(nodes, t, c) == r["label"]) for t in out) for c in changed]))
    mine_rows = got.where("not held").collect()
    assert sorted((r["key"], r["seen"], r["positive"]) for r in mine_rows) == sorted(want)
    assert sorted((r["key"], r["lost"]) for r in full.collect()) == sorted(lost)
    held = grove.predicted(got, 1, "kind")
    assert held.count() == test.count() and held.where("kind <> cast(label as string)").count() == 0
    assert held.where("(prediction = 1) <> (probability > 0.5) or size(seen) <> 2 or seen[1] <> 6").count() == 0
    assert held.where("prediction = label").count() / test.count() > 0.65


def test_wide_and_numeric_codes(spark):
    """A factor of more than 256 levels, a constant column, and a single class."""
    df = spark.range(2000).selectExpr("id as key", "concat('l', id % 300) as a", "1.0 as c", "cast(id % 300 < 90 as double) as label")
    df = encode.index_only(df, ["a"], ["c"]).transform(df)
    bins = grove.bins_of(df)
    assert bins.size == 300 and len(bins.cuts[1]) == 0
    rows = grove.blocks(df, "key", bins, 2, held=False)
    nodes = grove.tree_nodes(grove.fit(rows, bins, 2, 2, 5), bins, ["a", "c"]).collect()
    assert sorted(r["node"] for r in nodes) == [0, 0, 1, 1, 2, 2]
    one = grove.blocks(df.withColumn("label", F.lit(1.0)), "key", bins, 2, held=False)
    assert [r["prediction"] for r in grove.tree_nodes(grove.fit(one, bins, 2, 2, 5), bins, ["a", "c"]).collect()] == [1.0, 1.0]
    with pytest.raises(ValueError):
        grove.fit(rows.where("n < 0"), bins, 2, 2, 5)
