"""Registered queries: quality, counts, rates, summaries, buckets, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopline import schema
from stopline.bindings.common import (
    CASES_SQL, EVENTS_SQL, STOPS_RAW, ZERO_TAX_SQL, cases, coded_events, query, stops_raw, table,
    with_order, zero_tax,
)
from stopline.bindings.prepare import RATE_FACTORS, _rates_sql
from stopline.functions import calendar
from stopline.operators import quality, stats

# ---- quality ----

_Z = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
      "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM {ZERO_TAX_SQL} z"
    for c in _Z))
def missing_by_column(spark, sf):
    return quality.missing_by_column(zero_tax(spark, sf))


def _range_sql(col, low, high):
    return f"""SELECT '{col}' AS "column", count(*) FILTER (WHERE {col} < {low}) AS below,
    count(*) FILTER (WHERE {col} > {high}) AS above, count(*) FILTER (WHERE {col} = 0) AS zero,
    count(*) FILTER (WHERE {col} < {low}) + count(*) FILTER (WHERE {col} > {high})
      - count(*) FILTER (WHERE {col} = 0) AS wrong
    FROM (SELECT latitude, longitude, try_cast(year AS int) AS year FROM ({STOPS_RAW}) s) t"""


def _stops_typed(spark, sf):
    from stopline.operators.cleaning import cast_types

    return cast_types(stops_raw(spark, sf), {"year": "int"})


@query(" UNION ALL ".join([_range_sql("latitude", "38.90e0", "39.50e0"),
                           _range_sql("longitude", "-77.52e0", "-76.88e0"),
                           _range_sql("year", 1929, 2020)]))
def range_violations(spark, sf):
    return quality.range_violations(
        _stops_typed(spark, sf),
        {"latitude": schema.LAT_SCORE, "longitude": schema.LON_SCORE, "year": schema.YEAR_SCORE})


_CODES = ", ".join(f"'{c}'" for c in schema.STATE_CODES)


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count(*) FILTER (WHERE {c} IN ({_CODES})) AS invalid
    FROM ({STOPS_RAW}) s""" for c in ("state", "driver_state", "dl_state")))
def invalid_category_counts(spark, sf):
    return quality.invalid_category_counts(
        stops_raw(spark, sf),
        {c: schema.STATE_CODES for c in ("state", "driver_state", "dl_state")})


_SCORED = ["row_key", *schema.STOPS_RAW_SCHEMA.names]
_SCORE_SQL = f"""SELECT bad AS bad_cells, cells, round(bad * 100.0e0 / cells, 2) AS percent_bad FROM (
  SELECT cast(count(*) * {len(_SCORED)} AS bigint) AS cells, cast(
    {" + ".join(f"(count(*) - count({c}))" for c in _SCORED)}
    + count(*) FILTER (WHERE latitude = 0) + count(*) FILTER (WHERE longitude = 0)
    + count(*) FILTER (WHERE latitude < 38.90e0) + count(*) FILTER (WHERE latitude > 39.50e0)
    - count(*) FILTER (WHERE latitude = 0)
    + count(*) FILTER (WHERE longitude < -77.52e0) + count(*) FILTER (WHERE longitude > -76.88e0)
    - count(*) FILTER (WHERE longitude = 0)
    + count(*) FILTER (WHERE year < 1929) + count(*) FILTER (WHERE year > 2020)
    - count(*) FILTER (WHERE year = 0)
    {" ".join(f"+ count(*) - count(*) FILTER (WHERE {c} IN ({_CODES}))"
              for c in ("state", "driver_state", "dl_state"))} AS bigint) AS bad
  FROM (SELECT * REPLACE (try_cast(year AS int) AS year) FROM ({STOPS_RAW}) s) t) u"""


@query(_SCORE_SQL)
def quality_score(spark, sf):
    return quality.score_stops(_stops_typed(spark, sf))


@query(f"""SELECT missing, cells, round(missing / cast(cells AS double), 6) AS share FROM (SELECT
  cast(count(*) - count(search_type) + count(*) - count(search_reason) AS bigint) AS missing,
  cast(count(*) * {len(_SCORED)} AS bigint) AS cells FROM ({STOPS_RAW}) s) t""")
def quality_effective(spark, sf):
    return quality.effective_share(stops_raw(spark, sf), ["search_type", "search_reason"])


# ---- counts and rates ----

def _all_rates_sql(frame, key, name):
    return f"""SELECT *, round(n / cast(sum(n) OVER (PARTITION BY {name}) AS double), 6) AS rate
    FROM (SELECT {key} AS {name}, outcome, count(*) AS n FROM {frame} t GROUP BY 1, 2) u"""


@query(f"SELECT o_orderpriority, outcome, count(*) AS n FROM {CASES_SQL} c GROUP BY 1, 2")
def count_by(spark, sf):
    return stats.count_by(cases(spark, sf), "o_orderpriority", "outcome")


@query(f"""SELECT o_orderpriority, 'Citation' AS outcome,
  count(*) FILTER (WHERE outcome = 'Citation') AS n,
  round(count(*) FILTER (WHERE outcome = 'Citation') / cast(count(*) AS double), 6) AS rate
  FROM {CASES_SQL} c GROUP BY 1 HAVING count(*) FILTER (WHERE outcome = 'Citation') > 0""")
def rate_by_factor(spark, sf):
    return stats.rate_by(cases(spark, sf), "o_orderpriority", "outcome", "Citation")


@query(_rates_sql(CASES_SQL, RATE_FACTORS))
def rate_by_all_factors(spark, sf):
    return stats.rate_by_all(cases(spark, sf), RATE_FACTORS, "outcome", "Citation")


@query(_all_rates_sql(EVENTS_SQL, "dayname(ts)", "dow"))
def rate_by_dow(spark, sf):
    return stats.rate_by(coded_events(spark, sf), calendar.day_name(F.col("ts")), "outcome",
                         name="dow")


@query(_all_rates_sql(EVENTS_SQL, "concat(strftime(ts, '%d'), 'd')", "dom"))
def rate_by_dom(spark, sf):
    return stats.rate_by(coded_events(spark, sf), calendar.day_of_month(F.col("ts")), "outcome",
                         name="dom")


@query(_all_rates_sql(EVENTS_SQL, "strftime(ts, '%H')", "hour"))
def rate_by_hour(spark, sf):
    return stats.rate_by(coded_events(spark, sf), calendar.hour_text(F.col("ts")), "outcome",
                         name="hour")


@query(_all_rates_sql(CASES_SQL, "o_orderstatus", "o_orderstatus"))
def share_in_group(spark, sf):
    counts = stats.count_by(cases(spark, sf), "o_orderstatus", "outcome")
    return stats.share_in_group(counts, "o_orderstatus")


def _quantile_sql(col, k):
    return f"""SELECT bin, 'Citation' AS outcome, count(*) FILTER (WHERE outcome = 'Citation') AS n,
    round(count(*) FILTER (WHERE outcome = 'Citation') / cast(count(*) AS double), 6) AS rate
    FROM (SELECT outcome, CASE WHEN x IS NOT NULL THEN
            cast(ntile({k}) OVER (PARTITION BY x IS NULL ORDER BY x, event_id) AS int) END AS bin
          FROM (SELECT event_id, outcome, {col} AS x FROM {EVENTS_SQL} e) t) u
    GROUP BY 1 HAVING count(*) FILTER (WHERE outcome = 'Citation') > 0"""


def _rate_by_quantile(spark, sf, x, k):
    events = coded_events(spark, sf).select("event_id", "outcome", x.alias("x"))
    return stats.rate_by_quantile(events, "x", "event_id", k, "outcome", "Citation")


@query(_quantile_sql("value", 10))
def rate_by_decile(spark, sf):
    return _rate_by_quantile(spark, sf, F.col("value"), 10)


# Most rows are 0, as with precipitation, so the buckets cut through a tie.
@query(_quantile_sql("CASE WHEN value > 60 THEN value ELSE 0 END", 5))
def rate_by_quintile(spark, sf):
    return _rate_by_quantile(spark, sf, F.when(F.col("value") > 60, F.col("value")).otherwise(0), 5)


# Few distinct values and some missing ones, as with wind speed.
@query(_quantile_sql("CASE WHEN value >= 5 THEN floor(value / 5) END", 10))
def rate_by_decile_wind(spark, sf):
    x = F.when(F.col("value") >= 5, F.floor(F.col("value") / 5).cast("double"))
    return _rate_by_quantile(spark, sf, x, 10)


# ---- summaries ----

def _numeric_sql(frame, c):
    return f"""SELECT '{c}' AS "column", round(min({c}), 6) AS min,
    round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median,
    round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.75), 6) AS q3,
    round(max({c}), 6) AS max, count(*) - count({c}) AS n_null FROM {frame} f"""


@query(_numeric_sql("events", "value") + " UNION ALL " + _numeric_sql("events", "user_id"))
def numeric_summary(spark, sf):
    return stats.numeric_summary(table(spark, sf, "events"), ["value", "user_id"])


def _factor_sql(frame, c, maxsum):
    return f"""WITH c AS (SELECT cast({c} AS string) AS level, count(*) AS n FROM {frame} f GROUP BY 1),
    r AS (SELECT *, row_number() OVER (PARTITION BY level IS NULL ORDER BY n DESC, level) AS rn,
      count(level) OVER () AS levels,
      {maxsum} - max(CASE WHEN level IS NULL THEN 1 ELSE 0 END) OVER () AS room FROM c)
    SELECT CASE WHEN level IS NULL THEN 'NA''s' WHEN levels <= room OR rn < room THEN level
      ELSE '(Other)' END AS level, cast(sum(n) AS bigint) AS n FROM r GROUP BY 1"""


@query(_factor_sql("part", "p_name", 20))
def factor_summary(spark, sf):
    return stats.factor_summary(table(spark, sf, "part"), "p_name", 20)


@query(_factor_sql(f"({STOPS_RAW})", "search_reason", 3))
def factor_summary_missing(spark, sf):
    return stats.factor_summary(stops_raw(spark, sf), "search_reason", 3)


@query("SELECT l_quantity > 25 AS value, count(*) AS n FROM lineitem GROUP BY 1")
def logical_summary(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.col("l_quantity") > 25).alias("large"))
    return stats.logical_summary(rows, "large")


@query("SELECT min(ts) AS first, max(ts) AS last FROM events")
def time_extent(spark, sf):
    return stats.time_extent(table(spark, sf, "events"), "ts")


@query("SELECT p_name, count(*) AS n FROM part GROUP BY 1")
def frequency_table(spark, sf):
    return stats.frequency(table(spark, sf, "part"), "p_name", ascending=True)


@query("SELECT p_name, count(*) AS n FROM part GROUP BY 1")
def frequency_desc(spark, sf):
    return stats.frequency(table(spark, sf, "part"), "p_name")


def _histogram_sql(width, keep="true"):
    return f"""WITH v AS (SELECT value AS x, outcome FROM {EVENTS_SQL} e WHERE {keep}),
    w AS (SELECT *, {width} AS w, min(x) OVER () AS low FROM
          (SELECT *, max(x) OVER () - min(x) OVER () AS span FROM v) s)
    SELECT bin, round(bin * any_value(w), 6) AS center, outcome, count(*) AS n FROM (
      SELECT *, cast(greatest(ceil((x - w / 2) / w - 1e-8), floor((low - w / 2) / w) + 1) AS bigint)
        AS bin FROM w) b GROUP BY bin, outcome"""


@query(_histogram_sql("5.0e0"))
def histogram_width(spark, sf):
    return stats.histogram(coded_events(spark, sf), "value", "outcome", width=5.0)


@query(_histogram_sql("span / 9", "value <> 0"))
def histogram_bins(spark, sf):
    rows = coded_events(spark, sf).where("value != 0")
    return stats.histogram(rows, "value", "outcome", bins=10)


@query("SELECT count(*) AS n FROM events")
def row_count(spark, sf):
    return stats.row_count(table(spark, sf, "events"))


# ---- sorts and top-k ----

@query("SELECT event_id, ts, event_type FROM events")
def order_by_time(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return stats.order_by_time(rows, "ts", "event_id")


_HOST = "regexp_extract(url, '//([^/]+)/', 1)"


def _hosts(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", F.regexp_extract("url", "//([^/]+)/", 1).alias("host"),
                        F.regexp_extract("url", "^([a-z]+):", 1).alias("scheme"))


_HOSTS_SQL = f"""(SELECT page_id, {_HOST} AS host, regexp_extract(url, '^([a-z]+):', 1) AS scheme
  FROM pages)"""


@query(f"SELECT host, count(*) AS n FROM {_HOSTS_SQL} p GROUP BY 1 ORDER BY n DESC, host LIMIT 5")
def topk_values(spark, sf):
    return stats.topk(_hosts(spark, sf), "host", 5)


@query("""SELECT p_name, count(*) AS n FROM part WHERE p_type = 'STANDARD'
  GROUP BY 1 ORDER BY n DESC, p_name LIMIT 5""")
def topk_values_filtered(spark, sf):
    return stats.topk(table(spark, sf, "part"), "p_name", 5, F.col("p_type") == "STANDARD")


@query("""SELECT * FROM (SELECT p_type, p_name, n,
  cast(row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_name) AS int) AS rank
  FROM (SELECT p_type, p_name, count(*) AS n FROM part GROUP BY 1, 2) c) r WHERE rank <= 5""")
def topk_per_group(spark, sf):
    return stats.topk(table(spark, sf, "part"), "p_name", 5, by="p_type")


@query("""SELECT p_name AS level, count(*) AS n FROM part GROUP BY 1
  ORDER BY n DESC, level DESC LIMIT 1""")
def arg_max_level(spark, sf):
    return stats.arg_max_level(table(spark, sf, "part"), "p_name")


@query("SELECT DISTINCT p_name FROM part")
def sorted_distinct(spark, sf):
    return stats.sorted_distinct(table(spark, sf, "part"), "p_name")


# ---- cluster profiles ----

_CLUSTERED = """(SELECT l_orderkey, l_linenumber % 5 AS cluster, l_returnflag, l_linestatus,
  o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_LEVELS = ["l_returnflag", "l_linestatus", "o_orderpriority"]
_LONG = " UNION ALL ".join(
    f"SELECT l_orderkey, cluster, '{c}' AS variable, cast({c} AS string) AS value FROM {_CLUSTERED} c"
    for c in _LEVELS)
_LEVEL_COUNTS = f"""SELECT cluster, variable, value, count(DISTINCT l_orderkey) AS count
  FROM ({_LONG}) l GROUP BY 1, 2, 3"""


def clustered(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", (F.col("l_linenumber") % 5).alias("cluster"), "l_returnflag", "l_linestatus")
    return with_order(spark, sf, lines, "o_orderpriority")


@query(_LEVEL_COUNTS)
def cluster_level_counts(spark, sf):
    return stats.cluster_level_counts(clustered(spark, sf), "l_orderkey", "cluster", _LEVELS)


@query(f"""SELECT *, round(count / cast(sum(count) OVER (PARTITION BY cluster, variable) AS double), 6)
  AS proportion FROM ({_LEVEL_COUNTS}) k""")
def cluster_level_share(spark, sf):
    counts = stats.cluster_level_counts(clustered(spark, sf), "l_orderkey", "cluster", _LEVELS)
    return stats.cluster_level_share(counts, "cluster")


@query(f"""SELECT *, round(count / cast(sum(count) OVER (PARTITION BY cluster, variable) AS double), 6)
  AS proportion FROM ({_LEVEL_COUNTS}) k""")
def cluster_profile(spark, sf):
    counts = stats.cluster_level_counts(clustered(spark, sf), "l_orderkey", "cluster", _LEVELS)
    return stats.cluster_profile(counts, "cluster")


@query("SELECT variable, value, " + ", ".join(
    f"round(count(*) FILTER (WHERE cluster = {k}) / cast(count(*) AS double), 6) AS c{k}"
    for k in range(5)) + f" FROM ({_LONG}) l GROUP BY 1, 2")
def level_share_by_cluster(spark, sf):
    return stats.level_share_by_cluster(clustered(spark, sf), "cluster", _LEVELS, range(5))


@query(f"SELECT cluster, count(*) AS n FROM {_CLUSTERED} c GROUP BY 1")
def cluster_sizes(spark, sf):
    return stats.cluster_sizes(clustered(spark, sf), "cluster")


@query(_LONG)
def cluster_long(spark, sf):
    return stats.to_long(clustered(spark, sf), ["l_orderkey", "cluster"], _LEVELS)
