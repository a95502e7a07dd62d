"""Registered queries: the batch jobs on the derived stops and weather tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline import schema
from stopline.bindings.common import STOPS_RAW, WEATHER_RAW, kept, query, stops_raw, weather_raw
from stopline.operators import cleaning, stats
from stopline.plans import jobs
from stopline.session import compiled_methods, discard_at_exit, new_path, store
from stopline.sources import tables

_NUMBERS = ", ".join(f"coalesce({c}, 0) AS {c}" for c in schema.WEATHER_NUMBERS)
MERGED = f"""SELECT s.* EXCLUDE (x, date_of_stop, time_of_stop, dt), w.* EXCLUDE (address)
  FROM (SELECT *, date_trunc('hour', cast(concat(date_of_stop, ' ', time_of_stop) AS timestamp)
          + INTERVAL 30 MINUTE) AS dt FROM ({STOPS_RAW}) r) s
  JOIN (SELECT address, date_time, conditions, {_NUMBERS} FROM ({WEATHER_RAW}) v) w
  ON s.dt = w.date_time"""

_CODES = ", ".join(f"'{c}'" for c in schema.STATE_CODES)
_TYPES = "('02 - Automobile', '03 - Station Wagon', '05 - Light Duty Truck')"
_PED = "contains(description, 'PEDESTRIAN') AND state2 = 'XX'"
_CLEAN_COLUMNS = ", ".join(schema.CLEAN_COLUMNS)
CLEANED = f"""SELECT {_CLEAN_COLUMNS}, row_key FROM (SELECT * EXCLUDE (state2) REPLACE (state2 AS state,
    CASE WHEN {_PED} THEN '29 - Unknown' ELSE vehicle_type END AS vehicle_type,
    CASE WHEN {_PED} THEN NULL ELSE nullif(year, 0) END AS year,
    CASE WHEN {_PED} THEN 'None' ELSE make END AS make,
    CASE WHEN {_PED} THEN 'None' ELSE model END AS model,
    CASE WHEN {_PED} THEN 'N/A' ELSE color END AS color)
  FROM (SELECT * REPLACE (nullif(latitude, 0) AS latitude, nullif(longitude, 0) AS longitude,
      nullif(heat_index, 0) AS heat_index,
      CASE WHEN temperature > 40 AND wind_chill = 0 THEN NULL ELSE wind_chill END AS wind_chill,
      coalesce(search_conducted, 'No') AS search_conducted,
      coalesce(article, 'Safety Violation') AS article),
    coalesce(search_outcome = 'Arrest', false) AS arrest, search_arrest_reason AS arrest_reason,
    arrest_type AS asset_type,
    CASE WHEN contains(description, 'PEDESTRIAN FAILURE')
      OR contains(description, 'PEDESTRIAN CROSS') OR contains(description, 'PEDESTRIAN UNSAFELY')
      THEN 'XX' ELSE state END AS state2
    FROM (SELECT * REPLACE (try_cast(year AS int) AS year) FROM ({MERGED}) m) t
    WHERE violation_type IS NOT NULL AND fatal IS NOT NULL AND personal_injury IS NOT NULL
    AND model IS NOT NULL AND driver_city IS NOT NULL
    AND NOT (latitude > 39.33e0) AND NOT (latitude < 38.90e0 AND latitude > 0)
    AND NOT (longitude < -77.52e0) AND NOT (longitude > -76.88e0 AND longitude > 0)
    AND state IN ({_CODES}) AND driver_state IN ({_CODES}) AND dl_state IN ({_CODES})
    AND NOT (state = 'MB' AND dl_state = 'MD') AND NOT (state = 'NB' AND dl_state = 'NJ')
    AND NOT (state = 'NB' AND dl_state = 'NY') AND NOT (state = 'PA' AND dl_state = 'NJ')
    AND NOT (year = 0 AND vehicle_type IN {_TYPES})
    AND NOT (coalesce(year, 0) < 1925 AND coalesce(year, 0) > 0)
    AND NOT coalesce(year, 0) > 2020) u) c"""

_ROADS = "|".join(r for r in schema.MAJOR_ROADS if r not in schema.UNREACHED_ROADS)
FEATURED = rf"""SELECT *, regexp_matches(location, '270|495') AS highway,
  regexp_matches(location, '{_ROADS}') AS major_road,
  coalesce(nullif(regexp_extract(charge, '\d+-\d\d\d'), ''), substring(charge, 1, 2)) AS short_charge
  FROM ({CLEANED}) c"""


def merged(spark, sf, wide=False) -> DataFrame:
    return jobs.merge_weather(stops_raw(spark, sf, wide), weather_raw(spark, sf))


def featured(spark, sf, wide=False) -> DataFrame:
    return jobs.features(jobs.clean(merged(spark, sf, wide)))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table between two jobs, written once and read back."""
    return store(df, name)


def model_table(spark, sf) -> DataFrame:
    """The stored modelling frame all model queries start from."""
    def make():
        with compiled_methods(spark):
            return stored(jobs.model_frame(jobs.exploration_frame(featured(spark, sf, wide=True))), "model-frame")
    return kept(spark, sf, "model-frame", make)


@query(MERGED)
def job_merge_weather(spark, sf):
    return merged(spark, sf)


@query(CLEANED)
def job_clean(spark, sf):
    return jobs.clean(merged(spark, sf))


@query(FEATURED)
def job_features(spark, sf):
    return featured(spark, sf)


def _score_sql(stage, frame):
    """Missing and wrong cells of a frame, whatever its columns."""
    def outside(c, low, high):
        return (f"count(*) FILTER (WHERE {c} < {low}) + count(*) FILTER (WHERE {c} > {high}) "
                f"- count(*) FILTER (WHERE {c} = 0)")
    wrong = " + ".join(
        [outside("latitude", "38.90e0", "39.50e0"), outside("longitude", "-77.52e0", "-76.88e0"),
         outside("year", 1929, 2020), "count(*) FILTER (WHERE latitude = 0) + count(*) FILTER (WHERE longitude = 0)"]
        + [f"count(*) - count(*) FILTER (WHERE {c} IN ({_CODES}))" for c in ("state", "driver_state", "dl_state")])
    return f"""SELECT '{stage}' AS stage, cast(missing + wrong AS bigint) AS bad_cells, cast(n * width AS bigint) AS cells,
      round((missing + wrong) * 100.0e0 / (n * width), 2) AS percent_bad
    FROM (SELECT list_sum(list_value(*COLUMNS(*))) AS missing, len(list_value(*COLUMNS(*))) AS width
      FROM (SELECT count(*) - count(COLUMNS(*)) FROM ({frame}) f) m) a, (SELECT count(*) AS n, {wrong} AS wrong FROM ({frame}) f) b"""


@query(_score_sql("merged", f"SELECT * REPLACE (try_cast(year AS int) AS year) FROM ({MERGED}) r")
       + " UNION ALL " + _score_sql("cleaned", CLEANED))
def job_clean_score(spark, sf):
    """The quality score before and after cleaning."""
    before = stored(cleaning.cast_types(merged(spark, sf), {"year": "int"}), "merged")
    return stats.union_reports(*[
        jobs.score(df).select(F.lit(stage).alias("stage"), "*")
        for stage, df in (("merged", before), ("cleaned", stored(jobs.clean(before), "cleaned")))])


@query(f"SELECT short_charge, count(*) AS n FROM ({FEATURED}) f GROUP BY 1")
def job_features_frequency(spark, sf):
    """How often each short charge code occurs."""
    return stats.frequency(featured(spark, sf), "short_charge")


@query(MERGED)
def job_merge_weather_csv(spark, sf):
    """The merge from CSV files to a CSV file: both inputs and the result are written and read again."""
    def through_csv(df, name):
        path = new_path(spark, name)
        tables.write_table(df, path)
        discard_at_exit(spark, path)
        return tables.read_table(spark, path, df.schema)

    stops, weather = through_csv(stops_raw(spark, sf), "stops-csv"), through_csv(weather_raw(spark, sf), "weather-csv")
    return through_csv(jobs.merge_weather(stops, weather), "merged-csv")


def _rate(section, level, frame="e", key=None):
    return f"""SELECT '{section}' AS section, cast({key or level} AS string) AS level,
    count(*) FILTER (WHERE violation_type = 'Citation') AS n,
    round(count(*) FILTER (WHERE violation_type = 'Citation') / cast(count(*) AS double), 6) AS rate
    FROM {frame} GROUP BY 1, 2 HAVING count(*) FILTER (WHERE violation_type = 'Citation') > 0"""


def _bucket(section, col, k):
    inner = f"""(SELECT violation_type, CASE WHEN {col} IS NOT NULL THEN
      ntile({k}) OVER (PARTITION BY {col} IS NULL ORDER BY {col}, row_key) END AS b FROM e)"""
    return _rate(section, "b", inner + " q")


def _hist(col, width, keep="true"):
    return f"""SELECT '{col}_hist' AS section, cast(cast(greatest(ceil((x - w / 2) / w - 1e-8),
      floor((low - w / 2) / w) + 1) AS bigint) AS string) || ' ' || violation_type AS level,
      count(*) AS n, cast(NULL AS double) AS rate
    FROM (SELECT *, CASE WHEN span = 0 THEN 0.1e0 ELSE {width} END AS w FROM (
      SELECT violation_type, {col} AS x, max({col}) OVER () - min({col}) OVER () AS span, min({col}) OVER () AS low
      FROM e WHERE {keep} AND {col} IS NOT NULL) v) z GROUP BY 1, 2"""


_FACTORS = [f for f in schema.RATE_FACTORS if f != "commercial_license"]
_EDA = f"""WITH f AS ({FEATURED}), e AS (SELECT *,
  CASE WHEN state IN ('MD', 'DC', 'VA') THEN 'DMV' ELSE 'Other' END AS veh_state_group,
  CASE WHEN dl_state IN ('MD', 'DC', 'VA') THEN 'DMV' ELSE 'Other' END AS dl_state_group,
  count(*) OVER (PARTITION BY seq_id) > 1 AS multi_infr
  FROM f WHERE violation_type IN ('Warning', 'Citation'))
""" + " UNION ALL ".join(
    [_rate(f, f) for f in _FACTORS]
    + [_rate("dow", "dayname(date_time)"), _rate("dom", "strftime(date_time, '%dd')"),
       _rate("hour", "strftime(date_time, '%H')"),
       _bucket("temperature", "temperature", 10), _bucket("precipitation", "precipitation", 5),
       _bucket("wind_speed", "wind_speed", 10),
       _hist("temperature", "5.0e0"), _hist("precipitation", "span / 9", "precipitation <> 0"),
       _hist("wind_speed", "span / 9"), _hist("year", "span / 49.0e0")])


@query(_EDA)
def job_eda(spark, sf):
    frame = stored(jobs.exploration_frame(featured(spark, sf)), "exploration")
    found = jobs.explore(frame)
    parts = [found["factors"].select(F.col("factor").alias("section"), "level", "n", "rate")]
    for section in ("dow", "dom", "hour"):
        parts.append(found[section].where("violation_type = 'Citation'").select(
            F.lit(section).alias("section"), "level", "n", "rate"))
    for section in ("temperature", "precipitation", "wind_speed"):
        parts.append(found[f"{section}_buckets"].select(
            F.lit(section).alias("section"), F.col("bin").cast("string").alias("level"),
            "n", "rate"))
    for col in ("temperature", "precipitation", "wind", "year"):
        section = "wind_speed" if col == "wind" else col
        parts.append(found[f"{col}_hist"].select(
            F.lit(f"{section}_hist").alias("section"),
            F.concat_ws(" ", F.col("bin").cast("string"), "violation_type").alias("level"),
            "n", F.lit(None).cast("double").alias("rate")))
    return stats.union_reports(*parts)


def _top(section, col, where="true", k=5):
    return f"""SELECT * FROM (SELECT '{section}' AS section, {col} AS level, count(*) AS n FROM f
    WHERE {where} AND {col} IS NOT NULL GROUP BY 2 ORDER BY n DESC, level LIMIT {k}) z"""


_LEVELS = ["sub_agency", "conditions", "accident", "personal_injury", "property_damage", "fatal",
           "alcohol", "search_conducted", "race", "gender", "arrest_reason"]
_COUNTED = ["search_disposition", "search_type", "state", "driver_city"]
_BY_RACE = ["location", "description", "search_disposition", "search_reason"]


def _all_levels(section, level):
    return f"SELECT '{section}' AS section, {level} AS level, count(*) AS n FROM f GROUP BY 2"


_FLAGS = {"accident": "accident = 'Yes'", "personal_injury": "personal_injury = 'Yes'",
          "property_damage": "property_damage = 'Yes'", "fatal": "fatal = 'Yes'",
          "alcohol": "alcohol = 'Yes'", "search_conducted": "search_conducted = 'Yes'",
          "arrest": "arrest", "arrest_reason=Stop": "arrest_reason = 'Stop'",
          "gender=F": "gender = 'F'"}
_STATS = f"WITH f AS ({FEATURED}) " + " UNION ALL ".join(
    [_top("top", c) for c in ("description", "location", "search_reason", "color", "vehicle_type")]
    + [_top(name, c, cond) for c in ("location", "description") for name, cond in _FLAGS.items()]
    + [_top(r, c, f"race = '{r}'") for c in _BY_RACE
       for r in ("WHITE", "BLACK", "HISPANIC", "ASIAN", "OTHER", "NATIVE AMERICAN")]
    + [_all_levels(c, f"coalesce({c}, '{stats.MISSING.replace("'", "''")}')") for c in _LEVELS]
    + [_all_levels(f"frequency_{c}", c) for c in _COUNTED] + [_all_levels("arrest", "cast(arrest AS string)")])


_METRICS = {"min": "min(x)", "q1": "quantile_cont(x, 0.25)", "median": "quantile_cont(x, 0.5)", "mean": "avg(x)",
            "q3": "quantile_cont(x, 0.75)", "max": "max(x)", "n_null": "count(*) - count(x)"}
_NESTED = """SELECT 'at ' || location AS section, description AS level, n FROM (SELECT location, description, count(*) AS n,
    row_number() OVER (PARTITION BY location ORDER BY count(*) DESC, description) AS rn FROM f
    WHERE description IS NOT NULL AND location IN (SELECT level FROM (""" + _top("top", "location") + """) t)
    GROUP BY 1, 2) z WHERE rn <= 3"""


def _most(section, where="true"):
    return f"""SELECT * FROM (SELECT '{section}' AS section, sub_agency AS level, count(*) AS n FROM f
    WHERE {where} AND sub_agency IS NOT NULL GROUP BY 2 ORDER BY n DESC, level DESC LIMIT 1) z"""


_STATS_ALL = _STATS + " UNION ALL " + " UNION ALL ".join(
    [_most("top_sub_agency"), _most("top_injury_sub_agency", "personal_injury = 'Yes'"), _NESTED])
_STATS_ALL = f"SELECT section, level, n, cast(NULL AS double) AS value FROM ({_STATS_ALL}) s" + "".join(
    f""" UNION ALL SELECT 'extent_{name}', strftime({end}(date_time), '%Y-%m-%d %H:%M:%S'), NULL, NULL FROM ({FEATURED}) f"""
    for name, end in (("first", "min"), ("last", "max"))) + "".join(
    f""" UNION ALL SELECT 'summary_{c}', '{m}', NULL, round(cast({e} AS double), 6) FROM (
    SELECT cast({c} AS double) AS x FROM ({FEATURED}) f) g""" for c in jobs.WEATHER_SUMMARY for m, e in _METRICS.items())


@query(_STATS_ALL)
def job_stats(spark, sf):
    """All lists, extents and summaries; one scan of the input gives every list."""
    return jobs.descriptive_report(jobs.descriptive(stored(featured(spark, sf), "features")))


_MERGE = {
    "vehicle_type": [("Cars", schema.CAR_TYPES), ("Non-Cars", schema.NON_CAR_TYPES)],
    "color": [("Neutral_Color", schema.NEUTRAL_COLORS), ("NonNeutral_Color", schema.OTHER_COLORS)],
    "conditions": [("Not_Clear", schema.CLOUDED_CONDITIONS)],
    "race": [("Other", schema.MERGED_RACES)],
}


def _merged_levels(col):
    arms = " ".join("WHEN {} IN ({}) THEN '{}'".format(
        col, ", ".join(f"'{v}'" for v in values), label) for label, values in _MERGE[col])
    return f"CASE {arms} ELSE {col} END AS {col}"


_COMPLETE = ["maximum_temperature", "minimum_temperature", "precipitation", "snow_depth",
             "wind_speed", "cloud_cover", "relative_humidity", "conditions", "belts",
             "personal_injury", "property_damage", "alcohol", "work_zone", "vehicle_type", "year",
             "color", "race", "highway"]
ACCIDENTS = f"""SELECT seq_id, row_key, maximum_temperature, minimum_temperature, precipitation,
  snow_depth, wind_speed, cloud_cover, relative_humidity, property_damage, work_zone,
  {", ".join(_merged_levels(c) for c in _MERGE)},
  'Belts' || belts AS belts, 'Alcohol' || alcohol AS alcohol,
  'PersInjury' || personal_injury AS personal_injury,
  CASE gender WHEN 'F' THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN highway THEN 'Yes' ELSE 'No' END AS highway,
  CASE WHEN year >= 2010 THEN '2010s' WHEN year >= 2000 THEN '2000s' WHEN year >= 1990 THEN '1990s'
    WHEN year >= 1980 THEN '1980s' ELSE cast(year AS string) END AS year,
  CASE WHEN dayname(date_time) IN ('Friday', 'Saturday', 'Sunday') THEN 'Weekend'
    ELSE 'Weekday' END AS dow,
  CASE WHEN hour(date_time) BETWEEN 5 AND 10 THEN 'Morning'
    WHEN hour(date_time) BETWEEN 11 AND 16 THEN 'Midday'
    WHEN hour(date_time) BETWEEN 17 AND 22 THEN 'Evening' ELSE 'Night' END AS hour,
  CASE WHEN state IN ('MD', 'DC', 'VA') THEN 'DMV' ELSE 'Other' END AS veh_state_group,
  CASE WHEN dl_state IN ('MD', 'DC', 'VA') THEN 'DMV' ELSE 'Other' END AS dl_state_group
  FROM ({FEATURED}) f WHERE gender IN ('F', 'M') AND accident = 'Yes'
  AND {" AND ".join(f"{c} IS NOT NULL" for c in _COMPLETE)}"""


@query(ACCIDENTS)
def accident_frame(spark, sf):
    return jobs.accident_frame(featured(spark, sf))


@query()
def job_cluster(spark, sf):
    """Sizes of the clusters, levels in each with their share, and each level's shares over the clusters."""
    out = jobs.clusters(jobs.accident_frame(stored(featured(spark, sf), "features")))
    nothing, share = F.lit(None).cast("string"), F.col("proportion")
    over = out["shares"].unpivot(["variable", "value"], [c for c in out["shares"].columns if c[0] == "c"],
                                 "cluster", "proportion")
    heat = out["heat"].select(F.lit("heat").alias("section"), "cluster", "variable", "value", "count", share)
    sizes = out["sizes"].select(F.lit("size"), "cluster", nothing, nothing, "n", F.lit(None).cast("double"))
    return heat.union(sizes).union(over.select(
        F.lit("share"), F.substring("cluster", 2, 9).cast("int"), "variable", "value",
        F.lit(None).cast("long"), share))
