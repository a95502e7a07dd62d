"""The batch jobs end to end on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from stopline import schema
from stopline.bindings import jobs as bound
from stopline.bindings.common import stops_raw, weather_raw
from stopline.plans import jobs
from stopline.sources import tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def features(spark):
    return bound.stored(bound.featured(spark, SF), "features")


@pytest.fixture(scope="module")
def frame(spark, features):
    return bound.stored(jobs.exploration_frame(features), "exploration")


@pytest.fixture(scope="module")
def model_rows(spark, frame):
    return bound.stored(jobs.model_frame(frame), "model")


def test_layout_and_idempotence(spark):
    merged = jobs.merge_weather(stops_raw(spark, SF), weather_raw(spark, SF))
    cleaned = jobs.clean(merged)
    assert len(schema.CLEAN_COLUMNS) == len(set(schema.CLEAN_COLUMNS)) == 51
    assert cleaned.columns == [*schema.CLEAN_COLUMNS, "row_key"]
    assert jobs.score(cleaned).first()["percent_bad"] < jobs.score(
        merged.withColumn("year", F.col("year").try_cast("int"))).first()["percent_bad"]


def test_csv_round_trip(spark, features, tmp_path):
    path = str(tmp_path / "clean")
    part = features.select("seq_id", "latitude", "year", "arrest")
    tables.write_table(part, path)
    back = tables.read_table(spark, path, part.schema)
    assert back.exceptAll(part).count() == 0 == part.exceptAll(back).count()
    with pytest.raises(Exception, match="exists"):
        tables.write_table(part, path)


def test_explore(spark, frame):
    found = jobs.explore(frame)
    total = frame.count()
    assert found["dow"].agg(F.sum("n")).first()[0] == total
    assert found["hour"].agg(F.sum("n")).first()[0] == total
    for name in ("temperature_hist", "wind_hist"):
        assert found[name].agg(F.sum("n")).first()[0] == total
    assert found["temperature_buckets"].count() <= 10
    for name, df in found.items():
        assert df.limit(1).count() == 1, name


def test_descriptive(spark, features):
    found = jobs.descriptive(features)
    assert found["levels_race"].agg(F.sum("n")).first()[0] == features.count()
    assert found["numbers"].count() == 7
    for name, df in found.items():
        df.limit(1).count()


def test_model_frame(model_rows):
    assert model_rows.count() == model_rows.select("row_key").distinct().count()
    cats, nums = jobs.predictor_kinds(model_rows)
    assert "hour" in cats and "temperature" in nums
    assert len(cats) + len(nums) == 33  # 27 predictors and the six weak flags
    slim = model_rows.drop(*schema.WEAK_FLAGS)
    assert sum(map(len, jobs.predictor_kinds(slim))) == 27


def test_forest(spark, model_rows):
    out = jobs.forest(model_rows, grid=[{"trees": 10, "mtry": 4}], max_depth=6)
    report = {r["metric"]: r["value"] for r in out["confusion"].collect()}
    n = sum(report[c] for c in ("tp", "fp", "fn", "tn"))
    total = model_rows.count()
    assert n == total - int(0.7 * total + 1e-9)
    assert out["scores"].first()["accuracy"] == report["accuracy"]
    seen = out["out_of_bag"].agg(F.sum(F.col("citation") + F.col("warning"))).first()[0]
    assert 0.9 * 0.7 * total < seen <= 0.7 * total
    sections = {r[0] for r in jobs.forest_report(out).select("section").distinct().collect()}
    assert sections == {"scores", "out_of_bag", "confusion", "importance", "permutation", "min_depth", "measures"}
    assert report["accuracy_low"] <= report["accuracy"] <= report["accuracy_high"]
    measures = out["measures"].collect()
    assert sum(m["times_a_root"] for m in measures) == 10
    assert {m["variable"] for m in measures} <= {r["variable"] for r in out["importance"].collect()}


def test_lasso_and_refit(spark, model_rows):
    out = jobs.lasso(model_rows, n_lambda=3, folds=2, ratio=0.1,
                     drop_extra=schema.LASSO_SECOND_DROP, rule="min")
    terms = {r["term"] for r in out["coefficients"].collect()}
    assert not any(t.startswith(("color=", "conditions=")) for t in terms)
    assert out["largest"].where("probability not between 0 and 1").count() == 0
    assert out["path"].count() == 3
    report = jobs.lasso_report(out)
    assert {r[0] for r in report.select("section").distinct().collect()} == {
        "path", "coefficients", "largest", "smallest", "confusion"}


def test_subset(spark, model_rows):
    out = jobs.subset(model_rows, trees_count=5, max_depth=5)
    errors = {r["run"]: r["test_error"] for r in out["errors"].collect()}
    assert set(errors) == {"logistic full", "forest full", "logistic subset", "forest subset"}
    assert all(0 < e < 0.6 for e in errors.values())
    sizes = {r["method"]: r for r in out["sizes"].collect()}
    assert set(sizes) == {"forward", "backward"}
    assert sizes["forward"]["bic"] <= sizes["forward"]["rss"]
    look = [r["estimate"] for r in out["smallest_forward"].collect()]
    assert look == sorted(look) and len(look) == 50
    rows = jobs.subset_report(out).collect()
    assert {r["section"] for r in rows} >= {"errors", "tables", "fit full", "fit subset", "steps", "smallest_forward"}
    for run, e in errors.items():
        cells = {r["item"]: r["value"] for r in rows if r["section"] == "tables" and r["item"].startswith(run + ",")}
        right = sum(v for k, v in cells.items() if k.split(", ")[1] == k.split(", ")[2])
        assert abs(1 - right / sum(cells.values()) - e) < 1e-6


def test_clusters(spark, features):
    df = jobs.accident_frame(features)
    out = jobs.clusters(df)
    assert out["sizes"].count() == 5
    assert out["sizes"].agg(F.sum("n")).first()[0] == df.count() == out["rows"].count()
    shares = out["shares"].collect()
    for r in shares:
        assert abs(sum(r[f"c{k}"] for k in range(1, 6)) - 1) <= 0.03
    counts = {r["cluster"]: r["n"] for r in out["sizes"].collect()}
    assert counts == {r["cluster"]: r["count"] for r in out["rows"].groupBy("cluster").count().collect()}
    for r in out["heat"].groupBy("cluster", "variable").agg(F.sum("count").alias("n")).collect():
        assert r["n"] == counts[r["cluster"]]


def test_factor_files(spark, frame, tmp_path):
    path = str(tmp_path / "rates")
    tables.factor_rate_tables(frame, ["race", "gender"], "violation_type", "Citation", path)
    back = spark.read.option("header", True).csv(path)
    assert {r[0] for r in back.select("factor").distinct().collect()} == {"race", "gender"}
