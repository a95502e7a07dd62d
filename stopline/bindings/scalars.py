"""Registered queries: scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopline import schema
from stopline.bindings.common import STOPS_RAW, query, stops_raw, table
from stopline.functions import calendar, geo, text
from stopline.operators import stats


def _events(spark, sf, **columns):
    return table(spark, sf, "events").select(
        "event_id", *[c.alias(n) for n, c in columns.items()])



@query("SELECT event_id, date_trunc('hour', ts + INTERVAL 30 MINUTE) AS hour FROM events")
def round_hour(spark, sf):
    return _events(spark, sf, hour=calendar.round_hour(F.col("ts")))


@query("SELECT event_id, dayname(ts) AS day FROM events")
def day_name(spark, sf):
    return _events(spark, sf, day=calendar.day_name(F.col("ts")))


@query("SELECT event_id, substring(dayname(ts), 1, 3) AS day, cast(dayofweek(ts) + 1 AS int) AS place FROM events")
def day_label_ordered(spark, sf):
    return _events(spark, sf, day=calendar.day_label(F.col("ts")), place=F.dayofweek("ts"))


@query("SELECT event_id, strftime(ts, '%H') AS hour_text, cast(hour(ts) AS int) AS hour_int FROM events")
def hour_text(spark, sf):
    return _events(spark, sf, hour_text=calendar.hour_text(F.col("ts")), hour_int=F.hour("ts"))


@query("""SELECT event_id, CASE WHEN hour(ts) BETWEEN 5 AND 10 THEN 'Morning'
  WHEN hour(ts) BETWEEN 11 AND 16 THEN 'Midday' WHEN hour(ts) BETWEEN 17 AND 22 THEN 'Evening'
  ELSE 'Night' END AS band FROM events""")
def hour_band(spark, sf):
    return _events(spark, sf, band=calendar.hour_band(calendar.hour_text(F.col("ts"))))


@query("""SELECT event_id, CASE WHEN dayname(ts) IN ('Monday', 'Tuesday', 'Wednesday', 'Thursday')
  THEN 'Weekday' ELSE 'Weekend' END AS part FROM events""")
def weekpart(spark, sf):
    return _events(spark, sf, part=calendar.weekpart(calendar.day_name(F.col("ts"))))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN y >= 2010 THEN '2010s' WHEN y >= 2000 THEN '2000s'
  WHEN y >= 1990 THEN '1990s' WHEN y >= 1980 THEN '1980s' ELSE cast(y AS string) END AS decade
  FROM (SELECT *, cast(year(l_shipdate) - 18 + l_linenumber AS int) AS y FROM lineitem) l""")
def decade_label(spark, sf):
    year = F.year("l_shipdate") - 18 + F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", calendar.decade_label(year).alias("decade"))


@query("SELECT page_id, regexp_matches(url, '270|495') AS hit FROM pages")
def contains_any(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.contains_any(F.col("url"), ["270", "495"]).alias("hit"))


def _roads(names):
    return "|".join(names)


@query(f"""SELECT row_key, regexp_matches(location, '270|495') AS highway,
  regexp_matches(location, '{_roads(r for r in schema.MAJOR_ROADS
                                    if r not in schema.UNREACHED_ROADS)}') AS major_road,
  regexp_matches(location, '{_roads(schema.MAJOR_ROADS)}') AS major_road_repaired
  FROM ({STOPS_RAW}) s""")
def major_road_flag(spark, sf):
    place = F.col("location")
    return stops_raw(spark, sf).select(
        "row_key", text.highway_flag(place).alias("highway"),
        text.major_road_flag(place).alias("major_road"),
        text.major_road_flag(place, repaired=True).alias("major_road_repaired"))


_CHARGE = "concat(cast(l_suppkey AS string), '-', cast(l_partkey AS string))"


def _charges(spark, sf):
    charge = F.concat(F.col("l_suppkey").cast("string"), F.lit("-"),
                      F.col("l_partkey").cast("string"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", charge.alias("charge"))


_CODE_SQL = r"coalesce(nullif(regexp_extract(charge, '\d+-\d\d\d'), ''), substring(charge, 1, 2))"


@query(f"""SELECT l_orderkey, l_linenumber, charge, {_CODE_SQL} AS code
  FROM (SELECT *, {_CHARGE} AS charge FROM lineitem) l""")
def extract_code(spark, sf):
    return _charges(spark, sf).withColumn("code", text.extract_code(F.col("charge")))


@query(r"""SELECT l_orderkey, l_linenumber, code2, nullif(regexp_extract(code2, '\d\d'), '') AS code3
  FROM (SELECT *, nullif(regexp_extract(code, '\d\d-\d'), '') AS code2
  FROM (SELECT *, """ + _CODE_SQL + " AS code FROM (SELECT *, " + _CHARGE + """ AS charge
  FROM lineitem) l) m) n""")
def shorten_code(spark, sf):
    code = text.extract_code(F.col("charge"))
    rows = _charges(spark, sf).withColumn("code2", text.shorten_code(code))
    return rows.select("l_orderkey", "l_linenumber", "code2",
                       text.shorten_code(F.col("code2"), r"\d\d").alias("code3"))


def _bit(cell, width, place):
    return f"(({cell} >> {width - 1 - place}) & 1)"


def _geohash_sql():
    """Seven characters out of 18 longitude bits and 17 latitude bits."""
    letters = []
    for start in range(0, 35, 5):
        bits = [
            _bit("x", 18, p // 2) if p % 2 == 0 else _bit("y", 17, p // 2)
            for p in range(start, start + 5)
        ]
        code = " + ".join(f"{b} * {2 ** (4 - i)}" for i, b in enumerate(bits))
        letters.append(f"substring('{geo.GEOHASH_ALPHABET}', cast({code} + 1 AS int), 1)")
    return " || ".join(letters)


@query(f"""SELECT event_id, {_geohash_sql()} AS geohash FROM (SELECT event_id,
  cast(floor((lon + 180) / 360 * 262144) AS bigint) AS x,
  cast(floor((lat + 90) / 180 * 131072) AS bigint) AS y FROM (SELECT event_id,
  38.90e0 + (event_id % 4300) / 10000.0e0 AS lat, -77.52e0 + (event_id % 6400) / 10000.0e0 AS lon
  FROM events) e) f""")
def geohash7(spark, sf):
    lat = F.lit(38.90) + F.col("event_id") % 4300 / F.lit(10000.0)
    lon = F.lit(-77.52) + F.col("event_id") % 6400 / F.lit(10000.0)
    return _events(spark, sf, geohash=geo.geohash(lat, lon))


@query(f"""SELECT row_key, CASE WHEN state IN ('MD', 'DC', 'VA') THEN 'DMV' ELSE 'Other' END AS veh,
  CASE WHEN dl_state IN ('MD', 'DC', 'VA') THEN 'DMV' ELSE 'Other' END AS dl
  FROM ({STOPS_RAW}) s""")
def region_flag(spark, sf):
    return stops_raw(spark, sf).select(
        "row_key", text.region_flag(F.col("state")).alias("veh"),
        text.region_flag(F.col("dl_state")).alias("dl"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Rush'
  WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'Calm' ELSE o_orderpriority END
  AS priority FROM orders""")
def combine_levels(spark, sf):
    merged = text.combine_levels(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"], "Rush")
    merged = text.combine_levels(merged, ["4-NOT SPECIFIED", "5-LOW"], "Calm")
    return table(spark, sf, "orders").select("o_orderkey", merged.alias("priority"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open'
  ELSE o_orderstatus END AS status FROM orders""")
def recode_values(spark, sf):
    status = text.map_levels(F.col("o_orderstatus"), {"F": "Filled", "O": "Open"})
    return table(spark, sf, "orders").select("o_orderkey", status.alias("status"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN 'Yes' ELSE 'No' END AS large
  FROM lineitem""")
def bool_to_yesno(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text.yes_no(F.col("l_quantity") > 25).alias("large"))


@query("""SELECT l_orderkey, l_linenumber,
  round(exp(b) / (1 + exp(b)), 6) AS p FROM (SELECT *, round(l_discount * 20 - 1.23456e0, 4) AS b
  FROM lineitem) l""")
def inv_logit(spark, sf):
    p = text.inv_logit(F.col("l_discount") * 20 - 1.23456)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(p, 6).alias("p"))


@query("SELECT event_id, round(value / 7, 2) AS two, round(value / 7, 4) AS four FROM events")
def round_scale(spark, sf):
    return _events(spark, sf, two=F.round(F.col("value") / 7, 2),
                   four=F.round(F.col("value") / 7, 4))


@query("""SELECT cast(l_linenumber AS string) || '  |  ' || cast(count(*) AS string) AS label
  FROM lineitem GROUP BY l_linenumber""")
def concat_text(spark, sf):
    counts = stats.count_by(table(spark, sf, "lineitem"), "l_linenumber")
    return counts.select(F.concat_ws("  |  ", "l_linenumber", "n").alias("label"))


@query("""SELECT p_partkey, CASE WHEN p_size / 1000.0e0 > 0.045e0 OR p_retailprice > 1000 THEN 'Top'
  ELSE 'Other' END AS rank FROM part""")
def topn_rank_flag(spark, sf):
    flag = text.top_flag(F.col("p_size") / 1000.0, F.col("p_retailprice"), 0.045, 1000)
    return table(spark, sf, "part").select("p_partkey", flag.alias("rank"))


@query("""SELECT o_orderkey, o_orderdate > timestamp '1996-12-31 00:00:00' AS late
  FROM orders""")
def date_literal_cmp(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_orderdate") > calendar.parse_date(F.lit("12/31/1996"))).alias("late"))
