"""The distributed forms against plain ones: ranks, buckets, samples, skewed keys."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stopline import session
from stopline.operators import cleaning, joins, selection, skew, stats


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"key long, x {kind}")


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("kind", ["double", "long"])
def test_order_statistics(spark, monkeypatch, kind, small):
    rng = random.Random(3)
    values = [rng.choice([0, rng.randint(-10**6, 10**6), rng.randint(0, 3)]) for _ in range(3000)]
    values = [float(v) / 7 if kind == "double" else v for v in values]
    if small:
        monkeypatch.setattr(selection, "RANGES", 8)  # forces many passes
    df = column(spark, values + [None], kind)
    ranks = [1, 2, 750, 1000, 1500, 2250, 2999, 3000]
    got = selection.order_statistics(df, "x", ranks)
    ordered = sorted(values)
    for r in ranks:
        v = ordered[r - 1]
        assert got[r].value == v
        assert got[r].below == sum(x < v for x in values)
        assert got[r].equal == values.count(v)
    with pytest.raises(ValueError):
        selection.order_statistics(df, "x", [3001])


def test_large_longs(spark):
    values = [2**62 + i for i in range(50)] + [-(2**61) + i for i in range(50)]
    got = selection.order_statistics(column(spark, values, "long"), "x", [1, 50, 51, 100])
    assert [got[r].value for r in (1, 50, 51, 100)] == [sorted(values)[r - 1] for r in (1, 50, 51, 100)]


def test_quantiles_match_linear_interpolation(spark):
    values = np.random.default_rng(5).normal(size=777)
    df = column(spark, [float(v) for v in values])
    got = selection.exact_quantiles(df, "x", [0, 0.25, 0.5, 0.9, 1])
    assert np.allclose(got, np.quantile(values, [0, 0.25, 0.5, 0.9, 1]))


@pytest.mark.parametrize("k", [1, 5, 7, 10, 300])
def test_ntile(spark, k):
    rng = random.Random(k)
    # Nine in ten rows share one value.
    values = [rng.choice([0.0] * 9 + [rng.random()]) for _ in range(1003)] + [None] * 5
    df = column(spark, values)
    got = selection.with_ntile(df, "x", "key", k)
    plain = df.where("x is not null").withColumn(
        "want", F.ntile(k).over(Window.orderBy("x", "key")))
    wrong = got.join(plain, "key").where("bin != want").count()
    assert wrong == 0
    assert got.where("x is null and bin is not null").count() == 0


def test_legacy_ntile(spark):
    n, k = 103, 10
    got = selection.with_ntile(column(spark, [float(i) for i in range(n)]), "x", "key", k, legacy=True)
    assert all(r["bin"] == k * r["key"] // n + 1 for r in got.collect())


def test_ntile_refuses_a_repeated_key(spark):
    df = spark.createDataFrame([(1, 0.0)] * 10, "key long, x double")
    with pytest.raises(ValueError, match="unique"):
        selection.with_ntile(df, "x", "key", 3).count()


@pytest.mark.parametrize("fraction", [0.0, 0.6, 0.7, 0.8, 1.0])
def test_split_exact(spark, fraction):
    df = spark.range(2**33, 2**33 + 997).withColumnRenamed("id", "key")
    train, test = selection.split_exact(df, "key", fraction)
    assert train.count() == math.floor(fraction * 997 + 1e-9)
    assert train.count() + test.count() == 997
    assert train.join(test, "key").count() == 0


def test_published_split_size():
    assert math.floor(0.7 * 574818 + 1e-9) == 402372


def test_key_hash(spark):
    keys = [0, 1, 2**31, 2**32 - 1, 2**32 + 1, 2**62]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r[0] for r in df.select(selection.key_hash(F.col("k"))).collect()]
    assert got == [k * 2654435761 % 2**32 for k in keys]


def test_dense_row_id(spark):
    values = [random.Random(1).random() for _ in range(500)]
    got = selection.dense_row_id(column(spark, values), ["x"], partitions=7).collect()
    assert [r["row_id"] for r in sorted(got, key=lambda r: r["x"])] == list(range(1, 501))


@pytest.mark.parametrize("most", [0, session.BROADCAST_BYTES])
def test_repeat_flag_with_a_hot_key(spark, monkeypatch, most):
    """Kept keys joined by shuffle, and by broadcast."""
    monkeypatch.setattr(session, "BROADCAST_BYTES", most)
    rows = [("hot",)] * 300 + [("warm",)] * 20 + [("two",)] * 2 + [(None,)] * 30
    rows += [(f"k{i}",) for i in range(100)]
    df = spark.createDataFrame(rows, "k string")
    got = {r["k"]: (r["f"], r["n"]) for r in joins.repeat_flag(df, "k", "f").groupBy("k", "f").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    want = {None: (True, 30), "hot": (True, 300), "warm": (True, 20), "two": (True, 2)}
    want.update({f"k{i}": (False, 1) for i in range(100)})
    assert got == want
    kept = cleaning.drop_rare_levels(df, "k", 25)
    assert {r[0]: r[1] for r in kept.groupBy("k").count().collect()} == {"hot": 300, None: 30}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [r[0] for r in joins.duplicate_keys(df, "k").collect()] == [1]
    assert [r["multi_infr"] for r in joins.repeat_flag(df, "k").orderBy("k").collect()] == [
        True, True, False]


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_join_beyond_the_broadcast_limit(spark, monkeypatch, how):
    rng = random.Random(8)
    left = spark.createDataFrame(
        [(i, rng.choice([1, 1, 1, 2, None, rng.randint(3, 90)])) for i in range(600)],
        "id long, k long")
    right = spark.createDataFrame([(k, k * 10) for k in range(1, 60)], "k long, v long")
    right = right if how == "inner" else right.select("k")
    want = left.join(right, "k", how)
    small = skew.join_any_size(left, right, ["k"], how)
    monkeypatch.setattr(session, "BROADCAST_BYTES", 5)
    large = skew.join_any_size(left, right, ["k"], how)
    assert want.count() > 0
    for got in (small, large):
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_five_thousand_keys_of_equal_heat(spark, monkeypatch):
    """Every key is repeated: no window over rows, and no limit on the number of hot keys."""
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    df = spark.range(20_000).select((F.col("id") % 5001).alias("k"), "id")
    got = joins.repeat_flag(df.where("k < 5000 or id = 5000"), "k")
    assert {(r[0], r[1]) for r in got.groupBy("multi_infr").count().collect()} == {(True, 19_997), (False, 1)}
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_measured_size_counts_long_text(spark):
    short = session.data_bytes(spark.range(10).select(F.lit("x").alias("t")))
    long = session.data_bytes(spark.range(10).select(F.repeat(F.lit("x"), 5000).alias("t")))
    assert session.data_bytes(spark.range(0).select(F.lit("x").alias("t"))) == 0
    assert 10 < short < 1000 < 50_000 <= long


def test_neighbours_match_brute_force(spark):
    rng = random.Random(9)
    rows = sorted({tuple(rng.choice("ab") for _ in range(4)) for _ in range(40)})
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "id long, a string, b string, c string, d string")
    got = {(r["i"], r["j"]) for r in joins.profile_neighbours(df, list("abcd")).collect()}
    want = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
            if sum(x != y for x, y in zip(rows[i], rows[j])) == 1}
    assert got == want


def test_topk_forms_agree(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xy"), rng.choice("abcdefg")) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v string")
    grouped = {(r["g"], r["v"], r["n"]) for r in stats.topk(df, "v", 3, by="g").collect()}
    single = set()
    for g in "xy":
        single |= {(g, r["v"], r["n"]) for r in stats.topk(df, "v", 3, F.col("g") == g).collect()}
    flags = {(r["flag"], r["level"], r["n"]) for r in stats.topk_by_flags(
        df, "v", {g: F.col("g") == g for g in "xy"}, 3).collect()}
    assert grouped == single == flags


def test_approximate_summary_is_close(spark):
    df = column(spark, [float(i) for i in range(1001)])
    a = stats.numeric_summary(df, ["x"]).first()
    b = stats.numeric_summary(df, ["x"], exact=False).first()
    assert (a["q1"], a["median"], a["q3"]) == (250.0, 500.0, 750.0)
    assert abs(a["median"] - b["median"]) <= 1


def many(spark, first):
    """The given values, and 40,000 plain ones beside them."""
    rest = [float(i % 20_011) for i in range(40_000)]
    return column(spark, first + rest), sorted([v for v in first if not math.isnan(v)] + rest)


@pytest.mark.parametrize("first", [
    [math.inf], [-math.inf, math.inf, math.inf], [math.nan, math.nan],
    [-1.7e308, 1.7e308], [1e300, 5e-324, -0.0], [math.nan, -math.inf, 1e308, -1e308, math.inf]])
def test_ranks_of_any_doubles(spark, first):
    df, values = many(spark, first)
    n = len(values)
    ranks = [1, 2, 3, n // 4, n // 2, n - 2, n - 1, n]
    got = selection.order_statistics(df, "x", ranks)
    assert [got[r].value for r in ranks] == [values[r - 1] for r in ranks]
    assert selection.extents(df, ["x"])["x"] == (values[0], values[-1], n)
    tiles = selection.with_ntile(df, "x", "key", 4).groupBy("bin").count().collect()
    sizes = {r["bin"]: r["count"] for r in tiles}
    assert [sizes[b] for b in (1, 2, 3, 4)] == [n // 4 + (b < n % 4) for b in range(4)]
    assert sizes.get(None, 0) == len(first) + 40_000 - n
    row = stats.numeric_summary(df, ["x"], digits=12).first()
    assert (row["min"], row["max"], row["n_null"]) == (values[0], values[-1], len(first) + 40_000 - n)
    assert row["median"] == np.median(values)


def test_ranks_over_all_longs(spark):
    edges = [-2**63, -2**63 + 1, 2**63 - 2, 2**63 - 1]
    values = edges + [(i * 0x9E3779B97F4A7C15 + 2**63) % 2**64 - 2**63 for i in range(40_000)]
    df = column(spark, values, "long")
    order = sorted(values)
    ranks = [1, 2, 10_000, 20_000, len(values) - 1, len(values)]
    got = selection.order_statistics(df, "x", ranks)
    assert [got[r].value for r in ranks] == [order[r - 1] for r in ranks]
