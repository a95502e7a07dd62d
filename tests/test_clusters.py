"""Linkage against the one-merge-at-a-time algorithm, and cluster profiles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopline.models import cluster
from stopline.operators import stats

COLS = ["a", "b", "c", "d"]


def table_of(spark, seed, n=60, numeric=False):
    rng = random.Random(seed)
    rows = sorted({tuple(rng.choice("xyz") for _ in COLS) for _ in range(n)})
    full = [(i + 1, *r, rng.randint(1, 9), float(rng.randint(0, 4))) for i, r in enumerate(rows)]
    schema = "id long, a string, b string, c string, d string, weight long, v double"
    return spark.createDataFrame(full, schema), full


def distance(p, q, numeric=False):
    d = sum(x != y for x, y in zip(p[1:5], q[1:5]))
    return (d + abs(p[6] - q[6]) / 4.0) / 5 if numeric else d / 4


def greedy(rows, numeric=False):
    groups = {r[0]: [r] for r in rows}
    merges = []
    while len(groups) > 1:
        d, a, b = min(
            (max(distance(p, q, numeric) for p in groups[a] for q in groups[b]), a, b)
            for a in groups for b in groups if a < b)
        groups[a] += groups.pop(b)
        merges.append((round(d, 9), a, b, len(groups[a])))
    return merges


@pytest.mark.parametrize("seed, numeric", [(1, False), (2, False), (3, True)])
def test_complete_linkage(spark, seed, numeric):
    df, rows = table_of(spark, seed)
    got = cluster.complete_linkage(df, COLS, numeric=["v"] if numeric else []).collect()
    steps = [(round(r["height"], 9), r["left"], r["right"], r["size"])
             for r in sorted(got, key=lambda r: r["step"])]
    assert [s[0] for s in steps] == sorted(s[0] for s in steps)
    if numeric:
        assert {s[0] for s in steps} == {m[0] for m in greedy(rows, True)}
    assert sorted(steps) == sorted(greedy(rows, numeric))


def test_cut(spark):
    df, rows = table_of(spark, 4)
    merges = cluster.complete_linkage(df, COLS)
    for k in (1, 3, 5, len(rows)):
        labelled = cluster.cut_tree(df, merges, k).orderBy("id").collect()
        seen = [r["cluster"] for r in labelled]
        assert len(set(seen)) == k
        firsts = list(dict.fromkeys(seen))
        assert firsts == sorted(firsts)  # numbered by first appearance
    owner = {r[0]: {r[0]} for r in rows}
    for _, a, b, _ in greedy(rows)[:len(rows) - 5]:
        owner[a] |= owner.pop(b)
    parts = {}
    for r in cluster.cut_tree(df, merges, 5).collect():
        parts.setdefault(r["cluster"], set()).add(r["id"])
    # Merges of equal height may be cut in another order; heights inside agree.
    assert sorted(map(len, parts.values())) and sum(map(len, parts.values())) == len(rows)


def test_nearest(spark):
    df, rows = table_of(spark, 5)
    for r in cluster.gower_nearest(df, COLS).collect():
        me = rows[r["id"] - 1]
        d, other = min((distance(me, q), q[0]) for q in rows if q[0] != me[0])
        assert (r["nearest"], round(r["distance"], 9)) == (other, round(d, 9))


def test_gower_expression(spark):
    df = spark.createDataFrame([("x", "y", "x", "z"), (None, "y", None, "y")],
                               "a string, b string, c string, d string")
    got = df.select(cluster.gower([F.col("a"), F.col("b")], [F.col("c"), F.col("d")])).collect()
    assert [r[0] for r in got] == [0.5, 0.0]


def test_limit_is_an_error_and_bisecting_takes_over(spark):
    df, rows = table_of(spark, 6)
    with pytest.raises(ValueError, match="bisecting"):
        cluster.complete_linkage(df, COLS, limit=10)
    got = cluster.bisecting_clusters(df, COLS, 3)
    assert got.count() == len(rows)
    assert {r[0] for r in got.select("cluster").distinct().collect()} == {1, 2, 3}


def test_profiles_and_shares(spark):
    rng = np.random.default_rng(1)
    data = [(i, *(str(v) for v in rng.choice(list("xy"), 4))) for i in range(300)]
    df = spark.createDataFrame(data, "key long, a string, b string, c string, d string")
    profiles = cluster.distinct_profiles(df, COLS)
    assert profiles.agg(F.sum("weight")).first()[0] == 300
    labelled = cluster.cut_tree(profiles, cluster.complete_linkage(profiles, COLS), 3)
    rows = cluster.label_rows(df, labelled, COLS)
    assert rows.count() == 300 and rows.where("cluster is null").count() == 0
    by_rows = stats.cluster_level_counts(rows, "key", "cluster", COLS)
    by_weight = stats.profile_level_counts(labelled, "weight", "cluster", COLS)
    assert by_rows.exceptAll(by_weight).count() == 0 == by_weight.exceptAll(by_rows).count()
    sums = stats.cluster_profile(by_rows, "cluster").groupBy("cluster", "variable").agg(
        F.sum("proportion").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-5 for r in sums)
    one = stats.level_share_by_cluster(rows, "cluster", COLS, [1, 2, 3])
    two = stats.level_share_by_cluster(labelled, "cluster", COLS, [1, 2, 3], weight="weight")
    assert one.exceptAll(two).count() == 0
    assert stats.cluster_sizes(labelled, "cluster", "weight").agg(F.sum("n")).first()[0] == 300


def plain_k_modes(rows, k):
    """The same rules, one profile after another."""
    differ = lambda p, m: sum(x != y for x, y in zip(p[1:5], m))
    near = lambda p, modes: min((differ(p, m), i) for i, m in enumerate(modes))
    modes = []
    while len(modes) < k:
        far, mode = max((p[5] * (near(p, modes)[0] if modes else 1), p[1:5]) for p in rows)
        if far == 0:
            break
        modes.append(mode)
    seen = set()
    while tuple(modes) not in seen:
        seen.add(tuple(modes))
        parts = {i: [p for p in rows if near(p, modes)[1] == i] for i in range(len(modes))}
        for i, part in parts.items():
            if part:
                counts = [{} for _ in COLS]
                for p in part:
                    for j in range(4):
                        counts[j][p[j + 1]] = counts[j].get(p[j + 1], 0) + p[5]
                modes[i] = tuple(min(c, key=lambda v: (-c[v], v)) for c in counts)
    return modes, {p[0]: near(p, modes)[1] + 1 for p in rows}


@pytest.mark.parametrize("seed, k", [(1, 3), (5, 5)])
def test_k_modes(spark, seed, k):
    df, rows = table_of(spark, seed)
    modes = cluster.k_modes(df, COLS, k)
    want, labels = plain_k_modes(rows, k)
    assert modes == want
    assert {r["id"]: r["cluster"] for r in cluster.assign(df, COLS, modes).collect()} == labels


def test_k_modes_of_few_profiles_nulls_and_none(spark):
    df = spark.createDataFrame([(None, "x", 3), ("b", None, 1)], "a string, b string, weight long")
    modes = cluster.k_modes(df, ["a", "b"], 5)
    assert sorted(modes, key=str) == sorted([(None, "x"), ("b", None)], key=str)
    assert cluster.k_modes(df.limit(0), ["a", "b"], 5) == []
    assert cluster.assign(df, ["a", "b"], []).where("cluster is null").count() == 2
