"""Hand-worked cases of the row rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stopline import schema
from stopline.functions import calendar, geo, text
from stopline.operators import cleaning, joins, quality, stats


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def one(spark, expr_of, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expr_of(F.col("v"))).first()[0]


@pytest.mark.parametrize("when, want", [
    ("2019-05-01 10:29:59", "2019-05-01 10:00:00"),
    ("2019-05-01 10:30:00", "2019-05-01 11:00:00"),
    ("2019-12-31 23:45:00", "2020-01-01 00:00:00"),
])
def test_round_hour(spark, when, want):
    got = one(spark, lambda c: calendar.round_hour(calendar.parse_timestamp(c)), when)
    assert str(got) == want


def test_stop_without_weather_hour_is_dropped(spark):
    stops = spark.createDataFrame(
        [(1, dt.datetime(2019, 12, 31, 23, 45)), (2, dt.datetime(2019, 12, 31, 23, 10))],
        "id int, date_time timestamp_ntz")
    weather = spark.createDataFrame(
        [(dt.datetime(2019, 12, 31, 23), 40.0, "here")],
        "date_time timestamp_ntz, temperature double, address string")
    got = joins.join_nearest_hour(stops, weather, "date_time")
    assert values(got, "id") == [2]
    assert "address" not in got.columns


def test_sentinels(spark):
    df = spark.createDataFrame(
        [(0.0, 41.0, 0.0), (5.0, 40.0, 0.0), (6.0, 41.0, 3.0)],
        "heat_index double, temperature double, wind_chill double")
    got = cleaning.null_if(cleaning.null_if(df, ["heat_index"]), ["wind_chill"],
                           when=F.col("temperature") > 40)
    assert values(got, "heat_index") == [None, 5.0, 6.0]
    assert values(got, "wind_chill") == [None, 0.0, 3.0]


def test_latitude_limits(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 38.89, 38.90, 39.33, 39.34, None)], "lat double")
    assert values(cleaning.filter_lat_range(df, "lat"), "lat") == [None, 38.90, 39.33]


def test_longitude_limits(spark):
    df = spark.createDataFrame([(x,) for x in (-77.53, -77.52, -76.0, 0.0, 5.0)], "lon double")
    assert values(cleaning.filter_lon_range(df, "lon"), "lon") == [-77.52, -76.0, None]
    strict = cleaning.filter_lon_range(df, "lon", as_written=False)
    assert values(strict, "lon") == [-77.52, None]


def test_state_list(spark):
    df = spark.createDataFrame([("PE",), (None,), ("XX",), ("MD",)], "state string")
    assert values(cleaning.filter_in_list(df, "state", schema.STATE_CODES), "state") == ["XX", "MD"]
    lookup = spark.createDataFrame([("XX",), ("XX",)], "code string")
    assert values(cleaning.filter_in_list(df, "state", lookup), "state") == ["XX"]
    assert len(schema.STATE_CODES) == len(set(schema.STATE_CODES)) == 69


def test_contradictory_states(spark):
    df = spark.createDataFrame(
        [("MB", "MD"), ("MB", "VA"), ("MB", None), ("MD", None), ("PA", "NJ")], "a string, b string")
    got = cleaning.filter_contradictions(df, "a", "b").collect()
    assert [tuple(r) for r in got] == [("MB", "VA"), ("MD", None)]


def test_year_rules(spark):
    df = spark.createDataFrame(
        [(0, "02 - Automobile"), (None, "02 - Automobile"), (0, "01 - Motorcycle"),
         (None, "01 - Motorcycle"), (1924, "x"), (1925, "x"), (2020, "x"), (2021, "x")],
        "year int, kind string")
    kept = cleaning.filter_year_range(
        cleaning.filter_year_by_type(df, "year", "kind"), "year")
    assert values(kept, "year") == [None, None, 1925, 2020]


def test_casts_do_not_fail(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "y string")
    assert values(cleaning.cast_types(df, {"y": "int"}), "y") == [12, None, None]


def test_arrest(spark):
    df = spark.createDataFrame([("Arrest",), ("Warning",), (None,)], "o string")
    assert values(cleaning.derive_equals(df, "o", "Arrest", "a"), "a") == [True, False, False]


def test_pedestrians(spark):
    rows = [("PEDESTRIAN UNSAFELY CROSSING", "MD", "02 - Automobile", 2001, "A", "B", "RED"),
            ("FAILURE TO YIELD TO PEDESTRIAN", "MD", "02 - Automobile", 2001, "A", "B", "RED"),
            ("FAILURE TO YIELD TO PEDESTRIAN", "XX", "02 - Automobile", 2001, "A", "B", "RED"),
            (None, None, "02 - Automobile", 2001, "A", "B", "RED")]
    df = spark.createDataFrame(
        rows, "description string, state string, vehicle_type string, year int, make string, "
              "model string, color string")
    got = [tuple(r)[1:] for r in cleaning.pedestrian_overwrite(df).collect()]
    gone = ("XX", "29 - Unknown", None, "None", "None", "N/A")
    assert got == [gone, rows[1][1:], gone, rows[3][1:]]


def test_roads(spark):
    df = spark.createDataFrame(
        [("I 270 NB",), ("12705 MAIN ST",), (None,), ("16TH ST",), ("CONNECTICUT AVE",),
         ("GEORGIA AVE",)], "p string")
    p = F.col("p")
    assert values(df, text.highway_flag(p)) == [True, True, False, False, False, False]
    assert values(df, text.major_road_flag(p)) == [True, True, False, False, False, True]
    assert values(df, text.major_road_flag(p, repaired=True)) == [True, True, False, True, True, True]


@pytest.mark.parametrize("charge, code, short, head", [
    ("21-801.1", "21-801", "21-8", "21"), ("TA-12", "TA", None, None), (None, None, None, None)])
def test_codes(spark, charge, code, short, head):
    got = one(spark, text.extract_code, charge)
    assert got == code
    assert one(spark, text.shorten_code, got) == short
    assert one(spark, lambda c: text.shorten_code(c, r"\d\d"), short) == head


def test_geohash(spark):
    df = spark.createDataFrame([(57.64911, 10.40744), (None, 1.0), (90.0, 180.0)],
                               "a double, b double")
    got = values(df, geo.geohash(F.col("a"), F.col("b")))
    assert got == ["u4pruyd", None, "zzzzzzz"]
    assert values(df, geo.geohash(F.col("a"), F.col("b"), 11))[0] == "u4pruydqqvj"


def test_regions_and_bands(spark):
    assert [one(spark, text.region_flag, v) for v in ("VA", "PA", None)] == ["DMV", "Other", "Other"]
    hours = {4: "Night", 5: "Morning", 10: "Morning", 11: "Midday", 17: "Evening", 23: "Night"}
    assert {h: one(spark, calendar.hour_band, h, "int") for h in hours} == hours
    assert one(spark, calendar.weekpart, "Thursday") == "Weekday"
    assert one(spark, calendar.weekpart, "Friday") == "Weekend"
    years = {1979: "1979", 1989: "1980s", 2020: "2010s"}
    assert {y: one(spark, calendar.decade_label, y, "int") for y in years} == years


def test_rate_drops_levels_without_positives(spark):
    df = spark.createDataFrame(
        [("a", "Citation")] * 3 + [("a", "Warning")] + [("b", "Warning")] * 2
        + [(None, "Citation")], "f string, r string")
    got = {tuple(r) for r in stats.rate_by(df, "f", "r", "Citation").collect()}
    assert got == {("a", "Citation", 3, 0.75), (None, "Citation", 1, 1.0)}
    every = stats.rate_by(df, "f", "r").groupBy("f").agg(F.sum("rate").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-6 for r in every)
    wide = {(r["level"], r["n"], r["rate"]) for r in
            stats.rate_by_all(df, ["f", "not_there"], "r", "Citation").collect()}
    assert wide == {("a", 3, 0.75), (None, 1, 1.0)}


@pytest.mark.parametrize("rows, maxsum, want", [
    ("aaaaabbbbcccd", 3, {"a": 5, "b": 4, "(Other)": 4}),
    ("aaaaabbbbccc", 3, {"a": 5, "b": 4, "c": 3}),
    ("aaaaabbbbccc??", 3, {"a": 5, "(Other)": 7, "NA's": 2}),
    ("aab??", 3, {"a": 2, "b": 1, "NA's": 2}),
])
def test_factor_summary(spark, rows, maxsum, want):
    df = spark.createDataFrame([(None if c == "?" else c,) for c in rows], "v string")
    got = {r["level"]: r["n"] for r in stats.factor_summary(df, "v", maxsum).collect()}
    assert got == want


def test_quality_counts_a_missing_state_twice(spark):
    df = spark.createDataFrame([("MD", 0.0), (None, 39.0), ("PE", 40.0)], "state string, lat double")
    report = quality.quality_report(df, {"lat": schema.LAT_SCORE}, {"state": schema.STATE_CODES},
                                    ["lat"])
    got = {r["column"]: (r["missing"], r["wrong"]) for r in report.collect()}
    assert got == {"state": (1, 2), "lat": (1, 1)}
    score = quality.quality_score(report).first()
    assert (score["bad_cells"], score["cells"], score["percent_bad"]) == (5, 6, 83.33)


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in (2.5, 3, 7.5, 7.6, 12.5)], "x double")
    got = {(r["center"], r["n"]) for r in stats.histogram(df, "x", width=5.0).collect()}
    # 2.5 lies on an edge and is the minimum, so it joins the bin above it.
    assert got == {(5.0, 3), (10.0, 2)}
    assert sum(r["n"] for r in stats.histogram(df, "x", bins=10).collect()) == 5


def test_rare_levels_and_low_variance(spark):
    df = spark.createDataFrame([("a", "x")] * 5 + [("b", "x")] + [("a", "y")], "l string, f string")
    assert set(values(cleaning.drop_rare_levels(df, "l", 2), "l")) == {"a"}
    assert cleaning.drop_low_variance(df, ["l", "f"], 2).columns == []
    assert cleaning.drop_low_variance(df, ["l", "f"], 1).columns == ["l", "f"]


def test_names():
    assert schema.extend_values([1], [2], [3]) == [1, 2, 3]


def test_snake_case(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Date.time", "DL.State", "VehicleType", "SeqID"])
    assert schema.snake_case_columns(df).columns == ["date_time", "dl_state", "vehicle_type", "seq_id"]
