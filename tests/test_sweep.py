"""The forest sweep keeps all cores busy: small files are dealt out, columns share passes, forests grow side by side."""

import threading

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stopline import session
from stopline.bindings import jobs as bound
from stopline.models import encode, grove
from stopline.operators.selection import exact_quantiles
from stopline.plans import jobs


def numbers(spark, width):
    rng = np.random.RandomState(5)
    rows = [(i, "pqr"[i % 3], *map(float, rng.randint(0, 12 if width < 0 else 5000, abs(width)) * [1, -1][i % 2])) for i in range(700)]
    names = [f"v{j}" for j in range(abs(width))]
    df = spark.createDataFrame(rows, "key long, a string, " + ", ".join(f"{n} double" for n in names))
    return encode.index_only(df, ["a"], names).transform(df), names


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_bins_of_all_columns_come_from_common_passes(spark):
    counts = []
    for width in (1, 7):
        df, names = numbers(spark, width)
        bins, n = jobs_of(spark, f"bins {width}", lambda: grove.bins_of(df))  # noqa: B023
        counts.append(n)
        x = df.select(vector_to_array("features").alias("x")).select(*[F.get("x", F.lit(j + 1)).alias(c) for j, c in enumerate(names)])
        assert bins.cuts[0] is None
        for j, c in enumerate(names):
            assert bins.cuts[j + 1].tolist() == np.unique(exact_quantiles(x, c, [k / grove.BINS for k in range(1, grove.BINS)])).tolist()
    assert counts[1] <= counts[0] + 4
    df, _ = numbers(spark, -2)  # few values: cut between them
    values = sorted(r[0] for r in df.select("v0").distinct().collect())
    assert grove.bins_of(df).cuts[1].tolist() == [(a + b) / 2 for a, b in zip(values, values[1:])]


def test_two_sums_in_one_are_exact():
    rng = np.random.RandomState(1)
    w, y, cell = rng.randint(0, 10, 1 << 16), rng.randint(0, 2, 1 << 16), rng.randint(0, 40, 1 << 16)
    weight, ones = grove.apart(np.bincount(cell, w.astype(np.uint8) * (1.0 + grove.BOTH * y.astype(np.uint8)), 41))
    assert (weight == np.bincount(cell, w, 41)).all() and (ones == np.bincount(cell, w * y, 41)).all()


def test_forests_of_a_sweep_are_grown_side_by_side(spark, monkeypatch):
    rng = np.random.RandomState(3)
    rows = [(i, "pqrst"[rng.randint(5)], float(rng.randint(9)), float(rng.rand())) for i in range(400)]
    df = spark.createDataFrame(rows, "key long, a string, v double, u double").withColumn(
        "label", ((F.col("u") < 0.4) | (F.col("a") == "p")).cast("double")).withColumn(
        "violation_type", F.when(F.col("label") == 1, "Citation").otherwise("Warning"))
    encoder = encode.index_only(df, ["a"], ["v", "u"])
    df = encoder.transform(df).persist()
    meet, fit = threading.Barrier(3, timeout=60), grove.fit

    def together(*args):
        meet.wait()  # broken unless three forests are under way
        return fit(*args)

    monkeypatch.setattr(grove, "fit", together)
    grid = [{"trees": t, "mtry": m} for t, m in ((3, 2), (5, 2), (3, 1), (4, 3))]
    out = jobs.forest_results(df.where("key % 4 > 0"), df.where("key % 4 = 0"), encoder, ["a", "v", "u"], "key", grid, 5)
    scores = {(r["trees"], r["mtry"]): r.asDict() for r in out["scores"].collect()}
    assert list(scores) and set(scores) == {(3, 2), (5, 2), (3, 1), (4, 3)}
    monkeypatch.undo()
    bins = out["bins"]
    for (t, m), found in scores.items():  # each as if it were grown alone
        alone = grove.votes(grove.fit(out["rows"].where("not held"), bins, t, m, 5), out["rows"], "key", bins, t, [t])
        scored = grove.predicted(alone, 0, "violation_type")
        assert found["tp"] == scored.where("prediction = 1 and label = 1").count()
        assert found["fp"] == scored.where("prediction = 1 and label = 0").count()
    assert out["importance"].agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert out["local"].count() % 3 == 0 and out["nodes"].select("tree").distinct().count() == 3


def test_a_small_file_is_work_for_all_cores(spark, sf, monkeypatch):
    events = spark.read.parquet(f"{sf}/events.parquet")
    dealt = session.spread(events, "events")
    cores = spark.sparkContext.defaultParallelism
    assert dealt.rdd.getNumPartitions() >= cores and session.spread(dealt, "events") is dealt
    assert dealt.exceptAll(events).count() == events.exceptAll(dealt).count() == 0
    used = []
    monkeypatch.setattr("stopline.bindings.common.spread", lambda df, name: used.append(name) or df)
    few, all_of = bound.featured(spark, sf), bound.featured(spark, sf, wide=True)
    assert used == ["events"] and few.exceptAll(all_of).count() == 0


def test_only_rows_that_a_column_decides_are_judged_again(spark):
    """Local importance equals that of a plain walk of every row with every column changed."""
    rng = np.random.RandomState(4)
    rows = [(i, *map(float, rng.randint(0, 6, 5))) for i in range(500)]
    names = [f"v{j}" for j in range(5)]
    df = spark.createDataFrame(rows, "key long, " + ", ".join(f"{n} double" for n in names)).withColumn(
        "label", ((F.col("v0") > 2) != (F.col("v1") > 3)).cast("double")).withColumn("u", F.lit("u"))
    df = encode.index_only(df, ["u"], names).transform(df)
    bins = grove.bins_of(df)
    mine = grove.blocks(df, "key", bins, 2, held=False, partner=True)
    grown = grove.fit(mine, bins, 2, 2, 5)
    found = {r["key"]: (r["seen"][0], r["lost"]) for r in grove.votes(grown, mine, "key", bins, 2, [2], importance=True).collect()}
    nodes = {(r["tree"], r["node"]): r for r in grove.tree_nodes(grown, bins, ["u", *names]).collect()}

    def said(tree, x):
        r = nodes[tree, 0]
        while r["feature"] is not None:
            j = r["feature"]
            left = x[j] in r["split_code"] if j == 0 else (bins.cuts[j][:x[j]].size == 0 or bins.cuts[j][x[j] - 1] < r["split_code"][0])
            r = nodes[tree, r["left"] if left else r["right"]]
        return r["prediction"]

    for b in mine.collect():
        x, z = (np.frombuffer(b[c], bins.kind).reshape(b["n"], 6) for c in ("codes", "other"))
        y, copies = np.frombuffer(b["label"], np.uint8), np.frombuffer(b["copies"], np.uint8).reshape(2, -1)
        for i, key in enumerate(b["keys"]):
            lost = [0] * 6
            trees = [t for t in range(2) if copies[t, i] == 0]
            for t in trees:
                for j in range(6):
                    other = x[i].copy()
                    other[j] = z[i, j]
                    lost[j] += int(said(t, x[i]) == y[i]) - int(said(t, other) == y[i])
            assert found[key] == (len(trees), lost)
    assert any(sum(map(abs, v[1])) for v in found.values())


def test_a_node_of_200_thousand_rows_is_one_task():
    assert grove.GROUP_ROWS >= 200_000
