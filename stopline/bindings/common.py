"""The query registry, and the frames the registered queries run on.

Every frame is read or derived from the given tables. There is no stops table
among them, so a stops-shaped one is derived from `events` and `orders` by SQL
that Spark and the checking engine both run; all of its rows are used.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.operators.skew import join_any_size
from stopline.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query, with the SQL that must give the same rows."""
    def add(fn):
        key = name or fn.__name__.removeprefix("q_")
        if key in QUERIES:
            raise KeyError(key)
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn
    return add


_KEPT: dict = {}


def kept(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """What several queries start from (a stored frame, a fitted forest), made once a session and table folder."""
    key = spark.sparkContext.applicationId, sf_dir, name
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- lineitem with a two-class response ----

def coded_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with `outcome`: R is Citation, A is Warning, the rest Other."""
    code = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").withColumn(
        "outcome", F.when(code == "R", "Citation").when(code == "A", "Warning").otherwise("Other"))


CODED_SQL = """(SELECT *, CASE l_returnflag WHEN 'R' THEN 'Citation' WHEN 'A' THEN 'Warning'
  ELSE 'Other' END AS outcome FROM lineitem)"""


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-class lineitem rows with their order's columns."""
    lines = coded_lineitem(spark, sf_dir).where("l_returnflag in ('R', 'A')")
    return with_order(spark, sf_dir, lines, "o_orderpriority", "o_orderstatus", "o_orderdate")


def with_order(spark: SparkSession, sf_dir: str, lines: DataFrame, *cols: str) -> DataFrame:
    """lineitem rows with columns of their order, however many lines an order has."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), *cols)
    return join_any_size(lines, orders, ["l_orderkey"])


CASES_SQL = f"""(SELECT l.*, o_orderpriority, o_orderstatus, o_orderdate
  FROM {CODED_SQL} l JOIN orders ON l_orderkey = o_orderkey
  WHERE outcome IN ('Citation', 'Warning'))"""


def coded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with `outcome`: purchases are Citation, the rest Warning."""
    return table(spark, sf_dir, "events").withColumn(
        "outcome", F.when(F.col("event_type") == "purchase", "Citation").otherwise("Warning"))


EVENTS_SQL = """(SELECT *, CASE WHEN event_type = 'purchase' THEN 'Citation' ELSE 'Warning' END
  AS outcome FROM events)"""


def zero_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem where a zero tax or discount stands for a missing value."""
    return table(spark, sf_dir, "lineitem").withColumns(
        {"l_tax": F.nullif("l_tax", F.lit(0.0)), "l_discount": F.nullif("l_discount", F.lit(0.0))})


ZERO_TAX_SQL = """(SELECT * REPLACE (nullif(l_tax, 0) AS l_tax, nullif(l_discount, 0) AS l_discount)
  FROM lineitem)"""


# ---- stops and weather, derived from events and orders ----

def pick(number: str, values: Sequence[str | None]) -> str:
    """SQL that picks a value by a number modulo the list length; see `for_spark`."""
    listed = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"[{listed}][cast(({number}) % {len(values)} + 1 AS int)]"


def for_spark(sql: str) -> str:
    """The list lookups of `pick` in Spark's spelling."""
    return re.sub(r"\[(('|NULL)[^\]]*)\]\[", r"array(\1)[-1 + ", sql)


def yes_every(number: str, every: int) -> str:
    return f"CASE WHEN ({number}) % {every} = 0 THEN 'Yes' ELSE 'No' END"


# m mixes the row number and the user; h mixes it once more.
_M, _H = "m", "h"
STOPS_RAW = f"""
SELECT cast(event_id % 1000000 AS int) AS x,
  CASE WHEN event_id % 5 < 2 THEN concat('M', cast(floor(event_id / 5) AS bigint))
       ELSE concat('S', event_id) END AS seq_id,
  event_id AS row_key,
  cast(cast(ts AS date) AS string) AS date_of_stop,
  substring(cast(ts AS string), 12, 8) AS time_of_stop,
  'MCP' AS agency,
  {pick("user_id", ["1st District", "2nd District", "3rd District", "4th District",
                    "5th District", "6th District", "Headquarters"])} AS sub_agency,
  {pick(_M, ["DRIVER FAILURE TO STOP AT RED SIGNAL", "EXCEEDING MAXIMUM SPEED",
             "PEDESTRIAN FAILURE TO OBEY SIGNAL", "DRIVING WITHOUT REGISTRATION",
             "FAILURE TO YIELD TO PEDESTRIAN", "USING HANDHELD TELEPHONE",
             "PEDESTRIAN UNSAFELY CROSSING", "HEADLIGHTS OUT", "EXPIRED PLATES",
             "DRIVER USING SIGNAL", "NEGLIGENT DRIVING", "FAILURE TO DISPLAY CARD",
             "FAILURE TO CONTROL SPEED"])} AS description,
  concat(cast((user_id * 37) % 400 + 1 AS string), ' ',
    {pick("user_id * 3 + event_id % 4", ["GEORGIA AVE", "I 270 NB", "CONNECTICUT AVE", "RIVER RD",
          "16TH ST", "MAIN ST", "VEIRS MILL RD", "ELM LN", "ROCKVILLE PIKE", "OAK DR",
          "QUINCE ORCHARD RD"])}) AS location,
  CASE WHEN event_id % 41 = 0 THEN 0.0e0 WHEN event_id % 53 = 0 THEN 39.45e0
       WHEN event_id % 59 = 0 THEN NULL
       ELSE 38.85e0 + (event_id % 4700) / 10000.0e0 END AS latitude,
  CASE WHEN event_id % 41 = 0 THEN 0.0e0 WHEN event_id % 61 = 0 THEN 5.0e0
       ELSE -77.55e0 + (event_id % 6700) / 10000.0e0 END AS longitude,
  {yes_every(_M, 9)} AS accident,
  {yes_every(_H + " + 3", 17)} AS belts,
  CASE WHEN event_id % 401 = 0 THEN NULL ELSE {yes_every(_M, 27)} END AS personal_injury,
  {yes_every(_M, 18)} AS property_damage,
  CASE WHEN event_id % 397 = 0 THEN NULL ELSE {yes_every(_M + " + 5", 997)} END AS fatal,
  'No' AS commercial_license,
  {yes_every(_M + " + 7", 499)} AS hazmat,
  {yes_every(_M + " + 8", 31)} AS commercial_vehicle,
  {yes_every(_H + " + 9", 23)} AS alcohol,
  {yes_every(_M + " + 11", 211)} AS work_zone,
  CASE WHEN event_id % 13 = 0 THEN 'Yes' WHEN event_id % 13 = 1 THEN NULL ELSE 'No' END
    AS search_conducted,
  CASE WHEN event_id % 13 = 0 THEN {pick(_M, ["Nothing", "Contraband Only", "Property"])} END
    AS search_disposition,
  CASE WHEN event_id % 13 = 0 THEN {pick(_M + " + 1", ["Arrest", "Warning", "Citation", None])} END
    AS search_outcome,
  CASE WHEN event_id % 13 = 0 THEN {pick(_M + " + 2", ["Incident to Arrest", "Consensual",
       "Probable Cause", "K-9"])} END AS search_reason,
  CASE WHEN event_id % 13 = 0 THEN 'reason' END AS search_reason_for_stop,
  CASE WHEN event_id % 13 = 0 THEN {pick(_M, ["Both", "Person", "Property"])} END AS search_type,
  CASE WHEN event_id % 26 = 0 THEN {pick(_M, ["Stop", "Search", "Other"])} END
    AS search_arrest_reason,
  {pick(_M + " + 12", ["MD", "MD", "MD", "VA", "DC", "MD", "PA", "MB", "NB", "NY", "PE", "MD",
                       "XX", None, "MD", "MD", "VA"])} AS state,
  {pick(_M, ["02 - Automobile", "02 - Automobile", "02 - Automobile", "05 - Light Duty Truck",
             "03 - Station Wagon", "01 - Motorcycle", "28 - Other", "19 - Moped",
             "06 - Heavy Duty Truck", "24 - Camper", "02 - Automobile"])} AS vehicle_type,
  CASE WHEN event_id % 71 = 0 THEN '0' WHEN event_id % 73 = 0 THEN 'unknown'
       WHEN event_id % 79 = 0 THEN '1900' WHEN event_id % 83 = 0 THEN '2050'
       ELSE cast(1975 + ({_M}) % 46 AS string) END AS year,
  {pick(_H, ["TOYOTA", "HONDA", "FORD", "NISSAN", "BMW"])} AS make,
  CASE WHEN event_id % 307 = 0 THEN NULL ELSE {pick(_M, ["4S", "TK", "CAMRY", "ACCORD", "VN"])} END
    AS model,
  {pick(_H, ["BLACK", "SILVER", "WHITE", "GRAY", "RED", "BLUE", "GREEN", "GOLD", "TAN",
                      "MAROON", "BEIGE", "BLUE, DARK", "CHROME"])} AS color,
  CASE WHEN ({_M}) % 19 = 0 THEN 'ESERO'
       WHEN value * (1 + event_id % 5) > 90 OR ({_M}) % 27 = 0 THEN 'Citation'
       ELSE 'Warning' END AS violation_type,
  {pick(_H, ["21-801.1", "21-202(h1)", "13-401(b1)", "22-412.3(b)", "TA-12", "16-303(c)",
             "21-1124.2(d2)", "20-102", "13-411(f)", "22-201.1", "11-393.9"])} AS charge,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'Transportation Article' END AS article,
  {yes_every(_M + " + 13", 41)} AS contributed_to_accident,
  {pick("user_id * 5 + event_id % 3", ["WHITE", "BLACK", "HISPANIC", "ASIAN", "OTHER",
        "NATIVE AMERICAN", "WHITE", "BLACK"])} AS race,
  CASE WHEN event_id % 199 = 0 THEN 'U' WHEN user_id % 3 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE WHEN event_id % 311 = 0 THEN NULL
       ELSE {pick("user_id", ["ROCKVILLE", "SILVER SPRING", "GAITHERSBURG", "BETHESDA"])} END
    AS driver_city,
  {pick("user_id * 7 + event_id % 2", ["MD", "MD", "VA", "DC", "PA", "MD", "NY", "ZZ", "MD"])}
    AS driver_state,
  {pick(_M + " + 15", ["MD", "MD", "VA", "DC", "NJ", "MD", "NY", None, "MD", "MD", "PA"])}
    AS dl_state,
  {pick(_H, ["A - Marked Patrol", "B - Unmarked Patrol", "Q - Marked Laser", "A - Marked Patrol",
             "L - Motorcycle", "K - Aircraft Assist"])} AS arrest_type,
  'geo' AS geolocation
FROM (SELECT *, (m % 99991) * 48271 % 2147483647 AS h FROM (SELECT *,
  event_id * 7919 + user_id * 104729 + 17 AS m FROM events) a) b"""

# One row per hour in which anything was recorded.
WEATHER_RAW = f"""
SELECT 'Gaithersburg' AS address, date_time, 'Gaithersburg' AS location, 'MD' AS resolved_address,
  20.0e0 + h % 700 / 10.0e0 AS maximum_temperature, 10.0e0 + h % 500 / 10.0e0 AS minimum_temperature,
  15.0e0 + h % 600 / 10.0e0 AS temperature,
  CASE WHEN h % 3 = 0 THEN NULL ELSE h % 300 / 10.0e0 END AS wind_chill,
  CASE WHEN h % 4 > 0 THEN NULL ELSE 80.0e0 + h % 200 / 10.0e0 END AS heat_index,
  CASE WHEN h % 5 > 0 THEN 0.0e0 ELSE h % 90 / 100.0e0 END AS precipitation,
  CASE WHEN h % 50 = 0 THEN 1.5e0 END AS snow_depth,
  h % 250 / 10.0e0 AS wind_speed,
  CASE WHEN h % 7 = 0 THEN h % 400 / 10.0e0 END AS wind_gust,
  h % 1000 / 10.0e0 AS cloud_cover, 30.0e0 + h % 690 / 10.0e0 AS relative_humidity,
  {pick("h", ["Clear", "Overcast", "Partially cloudy", "Clear", "Rain, Overcast", "Clear",
              "Rain, Partially cloudy"])} AS conditions
FROM (SELECT date_trunc('hour', ts) AS date_time, cast(round(avg(value) * 100) AS bigint) AS h
  FROM events GROUP BY 1) w"""


def derived(spark: SparkSession, sf_dir: str, sql: str, wide: bool = False) -> DataFrame:
    """Run portable SQL over the given tables; `wide` work per event is spread over all cores."""
    events = table(spark, sf_dir, "events")
    return spark.sql(for_spark(sql).replace("FROM events", "FROM {events}"), events=spread(events, "events") if wide else events)


def stops_raw(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return derived(spark, sf_dir, STOPS_RAW, wide)


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly weather, with its time as the text the weather files carry."""
    hourly = derived(spark, sf_dir, WEATHER_RAW)
    return hourly.withColumn("date_time", F.date_format("date_time", "MM/dd/yyyy HH:mm"))
